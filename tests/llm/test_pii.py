"""Mentions in free text and format-preserving pseudonyms."""

import random
import re
import time

import pytest

from traceloom.llm.name_model import NameModel, fit
from traceloom.llm import pii
from traceloom.llm.pii import EMAIL, NAME, _nhs_ok, dated, find_mentions, fit_names, mentions, numbers_and_places, permute, pseudonym, pseudonym_date, redact, redacted

GIVEN = "Ada Piotr Thandiwe Kenji Uzma Mehmet Siobhan Tomasz Ffion Karim Lakshmi Noor Dewei Hope Mark Rose Frank Grace Søren Renée Ike Bram Dilnoza Wilhelmina".split()
HEADS, TAILS = "Sten Kirk Umber Wen Thorn Pell Jor Skel Garr Marl Esk Holm Vell Ulqu Ravn".split(), "pool ford croft ley lark dale gate wick ridge moor brook strand".split()
FRAMES = (  # What the model is fitted on ...
    "Spoke to {0} on 02/03/2026 about the frank discussion; call back later.", "Handover from {0} to {1}, keys left at the rose garden.",
    "Next of kin {0}, see the hope fund.", "{0} asked the visa desk to write instead.", "full name: {0} / status open", "Owner unclear. File mentions {0} but no number.",
    "Reviewed with registry. Nothing personal found.", "Duplicate of a file? Same surname, see mark sheet.", "Please ask for Dr {0}.", "closed by finance office, signed {0}",
    "Exported by job from a server, no person named.", "Fee waiver agreed at data office meeting, see grace period.", "No contact since March; the mark sheet applies until April.",
)
HELD_OUT = (  # ... and sentences of other kinds that it is tested on.
    "Yesterday {0} and {1} came to the front desk together.", "The letter was written by {0} in great haste.", "I have met {0} twice this week, said the porter.",
    "Minutes: present were {0}, the chair, and later {1}.", "According to {0} the parcel never arrived.", "We thank {0} for the help with the move.",
    "Complaint against {0} was dropped after the hearing.", "From: {0}\nTo: {1}\nSubject: keys", "Patient: {0}, seen by nurse {1}", "Nobody but {0} had access to the building.",
    "The office was open all day and the tea was cold.", "Please send the form before the end of the month.",
)


def full_names(n: int, seed: int, tails: list[str] = TAILS) -> list[str]:
    rng = random.Random(seed)
    last = lambda: rng.choice(HEADS) + rng.choice(tails)
    forms = (lambda g, x: f"{g} {x}", lambda g, x: f"{x}, {g}", lambda g, x: f"{g[0]}. {x}", lambda g, x: f"{g} van der {x}", lambda g, x: f"{g} {last()}-{x}", lambda g, x: f"{g} {x}")
    return [rng.choice(forms)(rng.choice(GIVEN), last()) for _ in range(n)]


@pytest.fixture(scope="module")
def model() -> NameModel:
    names, pool = full_names(1500, 1), full_names(3000, 2)
    rng = random.Random(3)
    texts = [f.format(rng.choice(pool), rng.choice(pool)) for f in FRAMES for _ in range(60)]
    texts += [f.format(rng.choice(pool).lower(), rng.choice(pool).lower()) for f in FRAMES for _ in range(4)]
    return fit(names, [numbers_and_places(t)[1] for t in texts])


@pytest.fixture
def found(model):
    return lambda text: [(k, text[a:b]) for k, a, b in find_mentions(text, model)]


@pytest.mark.parametrize("known", [True, False])
def test_names_in_other_sentences(model, known):
    """Recall and precision on sentences the model has not seen; also with family names that no column holds."""
    pool = full_names(400, 7) if known else full_names(400, 8, ["thwaite", "burn", "combe", "shaw", "more", "quist"])
    rng = random.Random(9)
    hit = want = got = 0
    for frame in HELD_OUT:
        for _ in range(40):
            pair = rng.choice(pool), rng.choice(pool)
            text = frame.format(*pair)
            true = {m.start() for p in pair for m in re.finditer(re.escape(p), text)}
            mine = {a for k, a, _ in find_mentions(text, model) if k == NAME}
            hit, want, got = hit + len(true & mine), want + len(true), got + len(mine)
    assert hit / want >= 0.9 and hit / got >= 0.9, (hit / want, hit / got)


def test_names_without_any_table():
    """Common names are known from the start."""
    plain = fit([], ["Meeting with the board about the lease.", "The form was sent to the office."])
    assert plain.spans("") == [] and plain.spans("no names here") == []


@pytest.mark.parametrize("text,want", [
    ("Spoke to Mr Piotr van der Lark on 02/03/2026 about the frank discussion; call back on 07700 900571.",
     [("NAME", "Piotr van der Lark"), ("PHONE", "07700 900571")]),
    ("Handover from de Bram, Ada to A. Stenpool, keys left at the Harrow Lane car park.", [("NAME", "de Bram, Ada"), ("NAME", "A. Stenpool")]),
    ("Next of kin Ada Jorley, Fernbank, Cooper Row, Eskerby, FW2 5SL, tel +44 (0)7700 900688",
     [("NAME", "Ada Jorley"), ("ADDRESS", "Fernbank, Cooper Row, Eskerby, FW2 5SL"), ("PHONE", "+44 (0)7700 900688")]),
    ("cc <ada+x@example.net, IKE (at) post [dot] test -- live", [("EMAIL", "ada+x@example.net"), ("EMAIL", "IKE (at) post [dot] test")]),
    ("Dr Ulquist (qq 12 38 89 c) asked the visa desk", [("NAME", "Ulquist"), ("ID_NUMBER", "qq 12 38 89 c")]),
    ("Fee waiver £539.54 agreed 08/03/2026, see hope fund, page 12 of 40, v4.12.52 from 198.51.100.101, INV-7516.", []),
    ("Moved to 191 Gorse Row\nMarlwick\nHK3 7ED as of 2026-07-07.", [("ADDRESS", "191 Gorse Row\nMarlwick\nHK3 7ED")]),
    ("callback 07700-900-407 / søren de brin", [("PHONE", "07700-900-407"), ("NAME", "søren de brin")]),
    ("old record under CAS-ER-5604349 merged", [("ID_NUMBER", "CAS-ER-5604349")]),
    ("", []), ("   ", []),
])
def test_mentions(found, text, want):
    assert found(text) == want


def test_long_text(found):
    text = "filler words here. " * 20000 + "Spoke to Ada Lark on 1 May."
    assert found(text) == [("NAME", "Ada Lark")]


@pytest.mark.parametrize("part", ["a", "A", "a.", "A-", "7", "Aa ", "a@", "+", " at ", "A, ", "\n", "é", "(dot)"])
def test_long_runs_take_linear_time(found, part):
    start = time.time()
    found(part * 60000)
    keys = "Dr Row @ at 7 name: dear see Ada's note signed ask for of kin present notified at now studying spoke to mentions "
    found(keys + part * 20000 + keys)
    assert time.time() - start < 20


@pytest.mark.parametrize("size", [2, 7, 10, 1000, 73049])
def test_permutation(size):
    n = min(size, 500)
    out = [permute(i, size, b"k", b"t") for i in range(n)]
    assert len(set(out)) == n and all(0 <= x < size for x in out)
    assert [permute(x, size, b"k", b"t", back=True) for x in out] == list(range(n))


def test_pseudonyms_keep_format_and_come_back():
    for kind, value in [
        ("PHONE", "+44 (0)7700 900688"), ("PHONE", "+1 202-555-0124"), ("PHONE", "(01632) 960 458"), ("ID_NUMBER", "STU-1234567"), ("ID_NUMBER", "943 476 5919"), ("ID_NUMBER", "AB123456C"),
        ("ID_NUMBER", "SMITH801105JN9AB"), ("ID_NUMBER", "CAS-ER-5604349"), ("EMAIL", "Ada.B@x.org"), ("EMAIL", "ike (at) post [dot] test"), ("NAME", "Jose O'Lark"), ("NAME", "Иван Петров"),
        ("ADDRESS", "Flat 5, 124 Cinder Close, Dunsmere MR11 3ZE"),
    ]:
        fake = pseudonym(value, kind, b"k")
        assert len(fake) == len(value) and fake != value, value
        assert pseudonym(fake, kind, b"k", back=True) == value
    assert pseudonym("07700900571", "PHONE", b"k") != pseudonym("07700900571", "PHONE", b"other")
    assert pseudonym_date(pseudonym_date("29/02/2004", b"k"), b"k", back=True) == "29/02/2004"
    assert pseudonym_date("2004-13-01", b"k") == "2004-13-01"


def test_one_value_has_one_pseudonym_however_it_is_written():
    digits = lambda v: re.sub(r"\D", "", pseudonym(v, "PHONE", b"k"))[-10:]
    assert len({digits(v) for v in ("+44 7700 900123", "07700 900123", "07700900123", "0044 (0)7700-900-123", "+44(0)7700 900 123")}) == 1
    words = lambda v: sorted(re.findall(r"\w+", pseudonym(v, "NAME", b"k").lower()))
    assert words("Anna Smith") == words("Smith, Anna") == words("SMITH, ANNA") and words("José Đurić") == words("Jose Duric")
    assert pseudonym("AB 12 34 56 C", "ID_NUMBER", b"k").replace(" ", "") == pseudonym("AB123456C", "ID_NUMBER", b"k")


@pytest.mark.parametrize("name", ["Иван Петров", "Đurić", "李小龙", "A", "Ωραία", "Øystein Åse", "محمد"])
def test_no_name_stays_readable(name):
    fake = pseudonym(name, "NAME", b"k")
    assert fake != name and all(a != b for a, b in zip(fake.split(), name.split()))


def test_checks_stay_valid():
    rng = random.Random(4)
    valid = [n for n in (str(rng.randrange(10**9, 999 * 10**7)) for _ in range(600)) if _nhs_ok(n)]
    assert len(valid) > 20 and all(_nhs_ok(pseudonym(n, "ID_NUMBER", b"k")) for n in valid)


def test_redaction_leaves_the_rest(model):
    text = "File mentions Ada Umberlark but no number; ring 07700 900571 before 02/03/2026."
    out, rows = redact(text, b"k", model)
    for kind, a, b, fake in rows:
        out = out.replace(f"[{kind}:{fake}]", text[a:b], 1)
    assert out == text and len(rows) == 2
    other = redact(text, b"k", model, dates=True)[0]
    assert "02/03/2026" not in other and re.search(r"before \d\d/\d\d/\d{4}\.$", other)


def test_long_mentions_are_whole(found):
    assert found("to " + "a" * 500 + "@" + "b" * 300 + ".test now") == [(EMAIL, "a" * 500 + "@" + "b" * 300 + ".test")]


def test_tables(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "in_review", "x"), (4, "call 07700 900571", "x"), (4, "call 07700 900571", "x"), (5, "Stenpool, Ada", "x")]
    df = spark.createDataFrame(rows, "row_key long, text string, pii_type string")
    assert sorted((r.row_key, r.pii_type, r.char_start) for r in mentions(df, "row_key", "text", model).collect()) == [(4, "PHONE", 5)] * 2 + [(5, "NAME", 0)]
    got = redacted(df, "row_key", "text", "s", model).collect()
    assert len(got) == 6 and got[0].redacted is None and got[2].redacted == "in_review"
    assert mentions(df.limit(0), "row_key", "text", model).count() == 0
    days = spark.createDataFrame([(1, "29/02/2004"), (2, None), (3, "unknown")], "k long, d string")
    out = {r.row_key: r.pseudonym for r in dated(days, "k", "d", "s").collect()}
    assert out[2] is None and out[3] == "unknown" and out[1] != "29/02/2004" and re.fullmatch(r"\d\d/\d\d/\d{4}", out[1])
    assert fit_names(df.select("text").limit(0), df.select("text").limit(0)).spans("Ada") == []


def test_a_model_counts_every_name_and_every_text(spark, monkeypatch):
    """No name or text is left out of the counts, and tasks come to the weights of the driver."""
    letters = "abcdefghijklmnopqrst"
    rare = [f"Ada X{a}{b}{c}{d}o" for a in letters for b in letters for c in letters for d in letters[:3]]
    texts = [f"Note {i} by Ada X{a}{b}ao about the lease" for i, (a, b) in enumerate((a, b) for a in letters for b in letters)]
    texts += [f"Dear Ada X{a}{b}bo, your file {i} is open" for i in range(20) for a in letters for b in letters]
    names = spark.createDataFrame([(x,) for x in [*rare, "Dear Ada"]], "x string")
    said = spark.createDataFrame([(x,) for x in [*texts, *texts]], "x string")
    model = fit_names(names, said)
    assert len(rare) > 20_000 and all(r.split()[1].lower() in model.names for r in rare)
    assert model.lower["lease"] == (400, 400) and model.lower["file"] == (8000, 8000)
    # A column holds this word by mistake.
    assert "dear" not in model.names
    monkeypatch.setattr(pii, "AT_HAND", 0)
    spread = fit_names(names, said)
    assert spread.weights.keys() == model.weights.keys()
    assert all(abs(w - model.weights[f]) < 1e-6 for f, w in spread.weights.items())


def test_each_token_is_looked_up_once(monkeypatch):
    from traceloom.llm.name_model import TOKEN, NameModel, base_model, tokens_of

    calls = []
    known = NameModel.known
    monkeypatch.setattr(NameModel, "known", lambda self, token: calls.append(token) or known(self, token))
    text = "Ann's _x_ note__1 ½ l’Ann A. Lark,\n\nMr  Lark's s's"
    base_model({"ann": 3, "lark": 3}).spans(text)
    assert len(calls) == len(tokens_of(text)) + 2
    # Places are those of the grammar, whatever lies between the tokens.
    assert [a for _, a, _ in tokens_of(text)] == [m.start() for m in TOKEN.finditer(text)]
    assert all(text[a:b] == t for t, a, b in tokens_of(text))
