"""Personal information inside free text, found and replaced in place.

Detection reads the whole text. Mailboxes, street addresses, identity numbers
(validated where they have a check) and phone numbers follow grammars, strongest
form first; what one found is masked for the next, so no mention lies inside
another. Names are found by a linear tagger (``name_model``) that is fitted on
columns of names and on texts; it knows no sentences.

Replacement keeps the form of a value: a keyed Feistel network permutes digits,
letters and dates within their format. Numbers with a check stay valid if they were
(the walk goes on until one is), phone numbers are permuted by their national
digits whatever the way of writing, names word by word, letters within the alphabet
of their script. So equal values keep equal pseudonyms in all documents, also where
they are written in another way, while the text around them stays as it was.

Defined results: null and empty texts have no mentions and stay as they are;
texts of any length are read as a whole; a mention at the cut end of a text
counts if its grammar still matches; repeated rows give their mentions each.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm.name_model import (
    LEAST_SEEN, PART, TITLES, AtHand, NameModel, base_model, block_of, blocks_of, learn_texts, learn_weights, name_words, numbered, set_least, text_counts, token_texts,
    training_rows,
)
from traceloom.session import cut

EMAIL, PHONE, ID_NUMBER, ADDRESS, NAME = "EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME"
#: Masks of what has been found, by type, for the grammars that follow.
MASK = {EMAIL: "", PHONE: "", ID_NUMBER: "", ADDRESS: "", NAME: ""}

_AT = r"(?:@|＠|\s*[(\[{]\s*(?i:at)\s*[)\]}]\s*|\s+AT\s+)"
_DOT = r"(?:\.|\s*[(\[{]\s*(?i:dot)\s*[)\]}]\s*|\s+DOT\s+)"
# Every repetition is possessive and begins where its run begins, so that a text of any
# length takes time in proportion to it and a mention of any length is found whole.
_LOCAL = r"(?<![\w.+%-])[._+%-]*+(?P<m{0}>[^\W_][\w.+%-]*+"
EMAIL_RE = re.compile(
    _LOCAL.format(1) + rf"{_AT}[\w-]++(?:{_DOT}[\w-]++)+(?![\w.]*+@))|" + _LOCAL.format(2) + r"\s+at\s+[\w-]++(?:\s+dot\s+[\w-]++)+)"
)

#: What every mailbox holds; a test that costs little.
_MAYBE_MAIL = re.compile(r"[@＠]|[\s(\[{](?i:at)[\s)\]}]")

_TYPES = (
    "Row", "Street", "Lane", "Avenue", "Close", "Crescent", "Terrace", "Road", "Drive", "Way", "Hall", "Court", "Gardens", "Grove", "Place", "Square",
    "Mews", "Hill", "Walk", "Rd", "St", "Ave", "Cres", "Ln", "Dr", "Ter", "Cl",
)
_WORD = r"(?<![\w'’-])[A-ZÀ-Þ][\w'’-]*+"
_TYPE = rf"(?:{'|'.join(_TYPES)})\b\.?"
_STREET = rf"(?:{_WORD}\s+){{1,2}}{_TYPE}"
_SEP = r"(?:\s*[,;]\s*|\s*[\r\n]+\s*|\s+)"
_POST = r"[A-Za-z]{1,2}\d{1,2}[A-Za-z]?\s?\d[A-Za-z]{2}\b"
_TOWN = _WORD
_TAIL = rf"(?:{_SEP}{_TOWN})?(?:{_SEP}{_POST})?"
ADDRESS_RE = re.compile(
    rf"\b(?:(?:Flat|Apartment|Apt|Unit)\s+\w+{_SEP})?\d{{1,4}}[A-Za-z]?\s+{_STREET}{_TAIL}"
    rf"|\bRoom\s+[A-Z]?\d+{_SEP}(?:Block\s+\w+{_SEP})?(?:\d+[A-Za-z]?\s+)?{_STREET}{_TAIL}"
    rf"|\b(?:The\s+|Number\s+)?{_WORD}(?:\s+{_WORD})?(?:\s*,\s*|\s*[\r\n]+\s*){_STREET}{_SEP}{_TOWN}(?:{_SEP}{_POST})?"
    rf"|\b(?:The\s+Old\s+{_WORD}|Number\s+{_WORD}\s+{_WORD}|{_WORD}\s+(?:House|Cottage|Lodge|Mill|Farm|Barn|Villa|Grange|Manor)|{_WORD}bank){_SEP}{_STREET}{_TAIL}"
)

#: Person numbers by their published formats; check digits where there are any.
ID_RE = re.compile(
    # What every kind begins with, so that other words cost one test and not one a kind.
    r"(?<![\w-])(?=[A-Z]{0,5}+[ -]?\d|CAS-|passport)(?:"
    r"(?:STU|STA|EXT)[ -]?\d{6,10}"
    r"|CAS-[A-Z]{2}-\d{5,9}"
    r"|(?P<nino>[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D])"
    r"|(?P<licence>[A-Z]{1,5}9{0,4}\d{6}[A-Z9]{2}[A-Z0-9][A-Z]{2})"
    r"|P\d{9}"
    r"|(?P<nhs>\d{3}([ -]?)\d{3}\4\d{4})"
    r"|\d{3}-\d{2}-\d{4}"
    r"|passport(?:\s+(?:number|no\.?))?[\s:#]+(?P<passport>[A-Z]{1,2}\d{6,8})"
    r")(?![\w]|-\d)",
    re.I,
)
_DIGIT = re.compile(r"\d")
PHONE_RE = re.compile(r"(?<![\w.+/£-])(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?|00\d{2}[ .-]?(?:\(0\)[ .-]?)?|\(0|0)\(?\d(?:[ .()-]{0,2}\d){7,11}(?![\d/])")


def _nhs_ok(digits: str) -> bool:
    check = 11 - sum(int(d) * w for d, w in zip(digits, range(10, 1, -1))) % 11
    return digits.startswith("999") or (check % 11 == int(digits[9]) and check != 10)


def _masked(text: str, kind: str, spans: list[tuple[int, int]]) -> str:
    out, last = [], 0
    for a, b in spans:
        out += [text[last:a], MASK[kind] * (b - a)]
        last = b
    return "".join([*out, text[last:]])


def numbers_and_places(text: str) -> tuple[list[tuple[str, int, int]], str]:
    """(mentions of all types but names, the text with them masked)."""
    found: list[tuple[str, int, int]] = []
    masked = text

    def mask(kind: str, spans: list[tuple[int, int]]) -> str:
        found.extend((kind, a, b) for a, b in spans)
        return _masked(masked, kind, spans) if spans else masked

    if _MAYBE_MAIL.search(text):
        masked = mask(EMAIL, [m.span("m1") if m["m1"] else m.span("m2") for m in EMAIL_RE.finditer(masked)])
    if any(t in text for t in _TYPES):
        masked = mask(ADDRESS, [m.span() for m in ADDRESS_RE.finditer(masked)])
    if _DIGIT.search(text):
        ids = []
        for m in ID_RE.finditer(masked):
            nhs = m.group("nhs")
            if nhs and not _nhs_ok(re.sub(r"\D", "", nhs)):
                continue
            if nhs and re.search(r"\+\d{1,3}[ -]?$", masked[max(0, m.start() - 5):m.start()]):
                continue
            ids.append(m.span("passport") if m["passport"] else m.span())
        masked = mask(ID_NUMBER, ids)
        masked = mask(PHONE, [m.span() for m in PHONE_RE.finditer(masked) if 9 <= sum(c.isdigit() for c in m.group()) <= 14])
    return found, masked


def find_mentions(text: str, model: NameModel) -> list[tuple[str, int, int]]:
    """(type, start, end) of every mention, by start; names are those the model tells."""
    found, masked = numbers_and_places(text)
    found += [(NAME, a, b) for a, b in model.spans(masked)]
    return sorted(found, key=lambda x: x[1])


# --- pseudonyms -------------------------------------------------------------


def _round(key: bytes, tag: bytes, i: int, value: int) -> int:
    return int.from_bytes(hmac.new(key, tag + b"%d:%d" % (i, value), hashlib.sha256).digest()[:12], "big")


def permute(value: int, size: int, key: bytes, tag: bytes, rounds: int = 8, back: bool = False) -> int:
    """Keyed permutation of 0..size-1: a Feistel network over a*b >= size, walked until it is inside."""
    if size < 2:
        return value
    a = max(2, int(size ** 0.5))
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        order = range(rounds) if not back else range(rounds - 1, -1, -1)
        for i in order:
            f = _round(key, tag, i, right if i % 2 == 0 else left)
            if i % 2 == 0:
                left = (left - f if back else left + f) % a
            else:
                right = (right - f if back else right + f) % b
        value = left * b + right
        if value < size:
            return value


#: Alphabets by their first and last letter; a letter is replaced by one of its own.
ALPHABETS = (
    ("a", "z"), ("а", "я"), ("α", "ω"), ("ա", "ֆ"), ("א", "ת"), ("ء", "ي"), ("अ", "ह"), ("ก", "ฮ"), ("ა", "ჰ"), ("ぁ", "ゖ"), ("ァ", "ヺ"), ("가", "힣"), ("一", "鿿"),
)
#: Letters whose plain form no decomposition tells (fixed values).
PLAIN = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ß": "s", "þ": "t", "æ": "a", "œ": "o", "ı": "i", "ħ": "h", "ŋ": "n", "ŧ": "t", "ς": "σ", "ё": "е"}


def _plain_letter(c: str) -> tuple[int, int]:
    """(alphabet, place in it) of a letter without its marks; of a letter of no alphabet, one of a to z."""
    c = c.lower()[0]
    for form in (c, PLAIN.get(c, c), unicodedata.normalize("NFD", c)[0]):
        for k, (first, last) in enumerate(ALPHABETS):
            if first <= form <= last:
                return k, ord(form) - ord(first)
    return 0, ord(c) % 26


def _digits(text: str, key: bytes, tag: str, back: bool, good: Callable[[str], bool] | None = None) -> str:
    """Digits as one number, permuted among those of their length that are as good as they are."""
    if not text:
        return text
    n, want = text, good(text) if good else None
    while True:
        n = str(permute(int(n), 10 ** len(n), key, f"{tag}:d{len(n)}".encode(), back=back)).zfill(len(n))
        if good is None or good(n) == want:
            return n


def _word(text: str, key: bytes, tag: str, back: bool) -> str:
    """A run of letters, permuted within their alphabets, case by place; marks on letters are dropped."""
    kinds = [_plain_letter(c) for c in text]
    sizes = [ord(ALPHABETS[k][1]) - ord(ALPHABETS[k][0]) + 1 for k, _ in kinds]
    total, n = 1, 0
    for (_, at), size in zip(kinds, sizes):
        n, total = n * size + at, total * size
    name = f"{tag}:w{'.'.join(map(str, sizes)) if len(set(sizes)) > 1 else (sizes[0], len(sizes))}".encode()
    if len(text) == 1:
        # A letter moves by a keyed step, so that none stays what it is.
        move = 1 + _round(key, name, 0, 0) % (total - 1)
        n = (n - move if back else n + move) % total
    else:
        n = permute(n, total, key, name, back=back)
    out = []
    for (k, _), size in zip(reversed(kinds), reversed(sizes)):
        n, at = divmod(n, size)
        out.append(chr(ord(ALPHABETS[k][0]) + at))
    return "".join(x.upper() if c.isupper() else x for x, c in zip(reversed(out), text))


_PARTS = re.compile(r"[^\W\d_]+|[0-9]+|[^\W_]|.", re.S)


def _parts(text: str, key: bytes, tag: str, back: bool, keep: Callable[[str], bool] = lambda part: False) -> str:
    """Words and numbers permuted one by one, all else and what is to be kept in its place."""
    out = []
    for part in _PARTS.findall(text):
        if keep(part) or not part[0].isalnum():
            out.append(part)
        elif part.isascii() and part.isdigit():
            out.append(_digits(part, key, tag, back))
        elif part[0].isalpha():
            out.append(_word(unicodedata.normalize("NFC", part), key, tag, back))
        else:
            out.append(str(_plain_letter(part)[1] % 10))
    return "".join(out)


def _refill(form: str, fresh: str) -> str:
    """The digits of a form, one by one, from a fresh number."""
    new = iter(fresh)
    return "".join(next(new) if c in "0123456789" else c for c in form)


#: Country codes of two digits (fixed values); 1 and 7 stand alone, all others have three.
_TWO = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(value: str, key: bytes, back: bool) -> str:
    """The national digits permuted, so that one number keeps one pseudonym with country code and without."""
    lead = re.match(r"\+|00", value)
    if lead:
        rest = re.sub(r"\D", "", value[lead.end():])
        size = 1 if rest[:1] in ("1", "7") else 2 if rest[:2] in _TWO else 3
        country, seen, at = rest[:size], 0, lead.end()
        while seen < size:
            seen += value[at].isdigit()
            at += 1
        trunk = re.match(r"[ .-]*\(0\)", value[at:])
        at += trunk.end() if trunk else 0
    else:
        zero = re.match(r"\D*0", value)
        country, at = "44", zero.end() if zero else 0
    digits = "".join(c for c in value[at:] if c in "0123456789")
    return value[:at] + _refill(value[at:], _digits(digits, key, f"{PHONE}:{country}", back))


def _id_number(value: str, key: bytes, back: bool) -> str:
    """Digits and letters of a person number permuted, what names its kind kept, checks kept valid."""
    if re.fullmatch(r"\d{3}[ -]?\d{3}[ -]?\d{4}", value):
        digits = re.sub(r"\D", "", value)
        return _refill(value, _digits(digits, key, "nhs", back, lambda n: _nhs_ok(n) and not n.startswith("999")))
    kind = re.match(r"(?i)(?:STU|STA|EXT|CAS)(?=[ -]?[A-Z-]*\d)|P(?=\d{9}$)", value)
    at = kind.end() if kind else 0
    tag = f"{ID_NUMBER}:{value[:at].upper()}"
    licence = re.fullmatch(r"(?i)([A-Z]{1,5}9{0,4})(\d{6})([A-Z9]{2}[A-Z0-9][A-Z]{2})", value)
    if licence:
        def born(n: str) -> bool:
            return int(n[1:3]) % 50 in range(1, 13) and int(n[1:3]) < 63 and 1 <= int(n[3:5]) <= 31

        return _parts(licence[1], key, tag, back, str.isdigit) + _digits(licence[2], key, "born", back, born) + _parts(licence[3], key, tag, back, str.isdigit)
    rest = value[at:]
    digits = "".join(c for c in rest if c in "0123456789")
    suffix = re.search(r"(?i)(?<=\d)\s*([A-D])$", rest) if not kind else None
    end = suffix.start(1) if suffix else len(rest)
    body = _refill("".join(_word(w, key, tag, back) if w.isalpha() else w for w in _PARTS.findall(rest[:end])), _digits(digits, key, tag, back))
    if not suffix:
        return value[:at] + body
    step = 1 + _round(key, b"suffix", 0, 0) % 3
    letter = chr(65 + (ord(suffix[1].upper()) - 65 + (-step if back else step)) % 4)
    return value[:at] + body + (letter if suffix[1].isupper() else letter.lower())


def _mailbox(value: str, key: bytes, back: bool) -> str:
    """Name and domain permuted piece by piece; separators, however written, and the last label stay."""
    marks = list(re.finditer(rf"{_AT}|{_DOT}|\s+at\s+|\s+dot\s+", value))
    last = marks[-1].end() if marks else len(value)
    out, at = [], 0
    for m in marks:
        out += [_parts(value[at:m.start()], key, EMAIL, back), m.group()]
        at = m.end()
    return "".join([*out, value[last:]])


def pseudonym(value: str, kind: str, key: bytes, back: bool = False) -> str:
    """Another value of the same form; the same for all ways of writing one value.

    Letters lose their accents first, so ``back`` restores the plain form of a value.
    """
    if kind == PHONE:
        return _phone(value, key, back)
    if kind == ID_NUMBER:
        return _id_number(value, key, back)
    if kind == EMAIL:
        return _mailbox(value, key, back)
    if kind == ADDRESS:
        return _parts(value, key, ADDRESS, back, lambda part: part in _TYPES or part in ("Flat", "Room", "Block", "Unit", "Apartment", "Apt"))
    return _parts(value, key, NAME, back, lambda part: part.lower() in TITLES)


FIRST, DAYS = date(1900, 1, 1), 73049  # 1900 to 2099


def pseudonym_date(text: str, key: bytes, back: bool = False) -> str:
    """A valid date (ISO or dd/mm/yyyy) as another valid date in the same form; else unchanged."""
    for pattern, order in ((r"(\d{4})-(\d{2})-(\d{2})", "ymd"), (r"(\d{2})/(\d{2})/(\d{4})", "dmy")):
        m = re.fullmatch(pattern, text)
        if m:
            got = dict(zip(order, map(int, m.groups())))
            try:
                n = (date(got["y"], got["m"], got["d"]) - FIRST).days
            except ValueError:
                return text
            if not 0 <= n < DAYS:
                return text
            d = FIRST + timedelta(days=permute(n, DAYS, key, b"date", back=back))
            return d.isoformat() if order == "ymd" else d.strftime("%d/%m/%Y")
    return text


_DATE = re.compile(r"(?<![\w/-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})(?![\w/-])")


def redact(text: str, key: bytes, model: NameModel, dates: bool = False) -> tuple[str, list[tuple[str, int, int, str]]]:
    """(text with typed placeholders, mentions with their pseudonyms).

    Dates are no mentions; with ``dates`` those outside mentions are permuted in place.
    """
    other = (lambda t: _DATE.sub(lambda m: pseudonym_date(m.group(), key), t)) if dates else (lambda t: t)
    out, last, rows = [], 0, []
    for kind, a, b in find_mentions(text, model):
        fake = pseudonym(text[a:b], kind, key)
        rows.append((kind, a, b, fake))
        out += [other(text[last:a]), f"[{kind}:{fake}]"]
        last = b
    return "".join([*out, other(text[last:])]), rows


# --- over tables ------------------------------------------------------------

MENTIONS = "row_key long, pii_type string, char_start long, char_end long, mention string"


#: Keys that a task counts before it hands them on; rows of features up to which the driver sums them.
HELD, AT_HAND = 200_000, 1_000_000


def _counted(df: DataFrame, count: Callable[[pd.DataFrame], Counter], keys: str) -> DataFrame:
    """(keys, n): what ``count`` tells of all batches, added up by its keys."""
    names = [c.split()[0] for c in keys.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame([(*(k if isinstance(k, tuple) else (k,)), n) for k, n in held.items()], columns=[*names, "n"])

        for batch in batches:
            held.update(count(batch))
            if len(held) > HELD:
                yield out()
                held.clear()
        yield out()

    return df.mapInPandas(run, f"{keys}, n long").groupBy(*names).agg(F.sum("n").alias("n"))


class Spread(AtHand):
    """Blocks of an RDD."""

    def map(self, change):
        return Spread(self.blocks.map(change))

    def total(self, tell):
        return self.blocks.map(tell).treeReduce(lambda a, b: a + b)


def fit_names(names: DataFrame, texts: DataFrame) -> NameModel:
    """A name model from one column of names and one of texts, from all their distinct values.

    Counts are aggregates over all names and all texts of more than one word. Words that
    texts use in lower case, those of names, and features come to the driver, as the model
    holds them. Equal rows of features are one row; up to AT_HAND of them are summed on
    the driver, more of them by tasks, once a step.
    """
    spark = names.sparkSession
    values = names.toDF("x").where("x IS NOT NULL AND x <> ''").distinct()
    held = _counted(values, lambda b: Counter(w for v in b["x"] for w in name_words(v)), "w string")
    model = base_model({r.w: r.n for r in held.collect()})

    def masked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [PART.join(token_texts(numbers_and_places(x)[1])) for x in batch["x"]]})

    many = cut(texts.toDF("x").where(F.col("x").contains(" ")).distinct().mapInPandas(masked, "x string"))
    n_texts = many.count()
    rows_of = lambda batch: (x.split(PART) for x in batch["x"] if x)
    known = spark.sparkContext.broadcast(model)
    seen = cut(_counted(many, lambda b: text_counts(rows_of(b), known.value.names), "kind string, w string"))
    # Of words, those that stand in lower case somewhere; of pairs, the frequent ones.
    small = seen.where("kind = 'l'").select("w")
    told = seen.where((F.col("kind") != "w") & ((F.col("kind") != "f") | (F.col("n") >= set_least(n_texts)))).unionByName(seen.where("kind = 'w'").join(small, "w", "left_semi"))
    learn_texts(model, {(r.kind, r.w): r.n for r in told.collect()}, n_texts)
    known = spark.sparkContext.broadcast(model)
    found = cut(_counted(many, lambda b: training_rows(rows_of(b), known.value), "features string, label int"))
    each = found.select(F.explode(F.split("features", PART)).alias("f"), "n").groupBy("f").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_SEEN)
    place = {f: i for i, f in enumerate(sorted(r.f for r in each.collect()), 1)}
    if not place:
        return model
    numbers = spark.sparkContext.broadcast(place)
    small_rows = cut(_counted(
        found, lambda b: numbered({(f, k): n for f, k, n in zip(b["features"], b["label"], b["n"])}, numbers.value), "features binary, label int"))
    if small_rows.count() <= AT_HAND:
        columns = small_rows.select("features", "label", "n").toArrow().columns
        learn_weights(model, place, AtHand(blocks_of(*block_of(zip(*(c.to_pylist() for c in columns))))))
        return model
    parts = small_rows.rdd.mapPartitions(lambda rs: iter([list(rs)])).filter(len).map(block_of).persist(StorageLevel.MEMORY_AND_DISK)
    learn_weights(model, place, Spread(parts))
    parts.unpersist()
    return model


def mentions(df: DataFrame, key: str, text: str, model: NameModel) -> DataFrame:
    """One row per mention in the column ``text``; offsets count Unicode characters."""
    names = [c.split()[0] for c in MENTIONS.split(", ")]
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Equal texts of a batch are read once.
            found = {t: find_mentions(t, held.value) for t in set(batch["text"])}
            rows = [(k, kind, a, b, t[a:b]) for k, t in zip(batch["row_key"], batch["text"]) for kind, a, b in found[t]]
            yield pd.DataFrame(rows, columns=names)

    rows = df.select(F.col(f"`{key}`").cast("long").alias("row_key"), F.col(f"`{text}`").alias("text"))
    return rows.where(F.col("text").isNotNull()).mapInPandas(run, MENTIONS)


def redacted(df: DataFrame, key: str, text: str, secret: str, model: NameModel, dates: bool = False) -> DataFrame:
    """(row_key, redacted): every row, its mentions replaced."""
    secret_key, held = secret.encode(), df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "row_key": batch["row_key"],
                "redacted": [redact(t, secret_key, held.value, dates)[0] if isinstance(t, str) else None for t in batch["text"]],
            })

    rows = df.select(F.col(f"`{key}`").cast("long").alias("row_key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(run, "row_key long, redacted string")


def dated(df: DataFrame, key: str, column: str, secret: str) -> DataFrame:
    """(row_key, pseudonym): a column of dates, each valid one permuted in its own form; others stay."""
    secret_key = secret.encode()

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: pseudonym_date(v, secret_key) if isinstance(v, str) else None)

    return df.select(F.col(f"`{key}`").cast("long").alias("row_key"), run(F.col(f"`{column}`").cast("string")).alias("pseudonym"))
