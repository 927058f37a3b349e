"""What a person's name looks like in running text: a linear tagger.

Nothing here knows a sentence that carries a name. Four things are learned when a
model is fitted, all from every value of the columns and every text:

* how often a token stands in columns of names, and how often it is written in
  lower case in texts (``hope`` and ``mark`` are names and words);
* a logistic regression over the character n-grams of tokens, names against
  words, for tokens that no column held;
* labels of tokens in texts: runs of two or more tokens that the name columns
  hold, and tokens after a title, are names; tokens that no column holds are not;
  all others have no label at first;
* a logistic regression over shape, the facts above and the neighbours of a
  token, trained on those labels and once more with its own sure answers.

A token's score is a sum of three numbers that depend on the token, the one before
and the one after, and of one number per pair of neighbouring classes. All are
looked up by token, so a text takes time in proportion to its tokens.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

import numpy as np

from traceloom.llm.people import NICKNAMES
from traceloom.llm.tokens import TOKENIZER, encoder

#: Rows of features that are summed at once; what parts the pieces of a key that is counted.
BLOCK, PART = 50_000, "\x1f"
#: Titles that announce a name and are left out of it, particles that belong to one (fixed values).
TITLES = frozenset("dr mr mrs ms miss mx prof professor sir dame rev revd lord lady".split())
PARTICLES = frozenset("van der den de la von di al del da bin ibn ter le du".split())
#: Words that make a place or an institution of the capitalised word before them (fixed values).
PLACES = frozenset("Lane Street Road Avenue Close Crescent Terrace Drive Row Gardens Square Mews Building House Centre College University School Hospital Department Office".split())
#: Names in common use, beside those that the columns bring.
COMMON = (
    "james john robert michael david william richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan jessica sarah karen anna maria"
    " helen peter paul mark george kevin brian edward laura emma olivia daniel matthew andrew"
    " smith jones taylor brown williams wilson johnson davies robinson wright thompson evans walker white roberts green hall wood jackson clarke"
    " lewis harris clark martin cooper king ward baker morris scott lopez garcia martinez miller anderson hill ford stone connor nguyen khan patel"
).split()
#: Buckets of the n-gram regression's hash; n-gram lengths.
GRAM_BITS, GRAMS = 14, (2, 3, 4)

_WORD = r"[^\W\d_]+(?:['’‘`\-‐‑][^\W\d_]+)*"
#: Masks, numbers, an initial with its point, words, line ends, other marks.
TOKEN = re.compile(rf"[\ue010-\ue01f]+|\w*\d[\w]*|(?<!\w)[^\W\d_]\.|{_WORD}|\n|[^\w\s]")
_OWNED = re.compile(r"['’]s$")
START, END = "<s>", "</s>"
#: Scores from which a token is surely one of a name, and is one beside a sure one.
SURE, NEARLY = 1.0, -2.0
#: Share of a word's places that lie in one pair of words, from which the pair is a set phrase.
SET_SHARE = 0.2
#: Times that a set phrase is seen at least, and texts that hold it once at least on average.
SET_LEAST, SET_TEXTS = 5, 1200
#: Values of columns from which a word is often held; times the usual number of places for its
#: values from which a word is held by mistake.
OFTEN, STRAY = 5, 20
#: Times that a feature has to be seen to say anything.
LEAST_SEEN = 3


def _fold(token: str) -> str:
    return token.lower().replace("’", "'")


def shape_of(token: str) -> str:
    """i(nitial), U(pper case), C(apitalised), l(ower case), x (letters without case), d(igits), m(ask), p(oint or other mark)."""
    c = token[0]
    if "" <= c <= "":
        return "m" + c
    if not c.isalpha():
        return "d" if any(x.isdigit() for x in token) else "p"
    if any(x.isdigit() for x in token):
        return "d"
    if len(token) == 1 or token[1] == ".":
        return "i" if c.isupper() else "l" if c.islower() else "x"
    if c.isupper():
        return "U" if token.isupper() else "C"
    return "l" if c.islower() else "x"


def tokens_of(text: str) -> list[tuple[str, int, int]]:
    """(token, start, end); an owner's ``'s`` is left out of its token."""
    out, at = [], 0
    for t in TOKEN.findall(text):
        # Only blanks and underscores lie between tokens, so the next place of a token is its own.
        a = text.find(t, at)
        at = b = a + len(t)
        if t[-1] == "s" and len(t) > 2 and t[0].isalpha() and _OWNED.search(t):
            t, b = t[:-2], b - 2
        out.append((t, a, b))
    return out


def token_texts(text: str) -> list[str]:
    """The tokens of ``tokens_of`` without their places."""
    return [t[:-2] if t[-1] == "s" and len(t) > 2 and t[0].isalpha() and _OWNED.search(t) else t for t in TOKEN.findall(text)]


def _gram_ids(token: str) -> list[int]:
    t = f"^{_fold(token)}$"
    mask = (1 << GRAM_BITS) - 1
    out = []
    for n in GRAMS:
        for i in range(len(t) - n + 1):
            h = 2166136261
            for ch in t[i:i + n]:
                h = ((h ^ ord(ch)) * 16777619) & 0xFFFFFFFF
            out.append((h ^ (h >> 15)) & mask)
    return out


#: Rows of feature numbers (0: none), their labels (-1: not known) and weights.
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def _sure(block: Block, w: np.ndarray) -> Block:
    """A block whose labels that are not known are the sure answers of weights."""
    x, y, times = block
    z = w[x].sum(1)
    return x, np.where(y >= 0, y, np.where(z > 2, 1.0, np.where(z < -2, 0.0, -1.0))), times


def _gradient(block: Block, w: np.ndarray) -> np.ndarray:
    x, y, times = block
    z = w[x].sum(1)
    miss = np.where(y >= 0, times, 0.0) * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
    return sum(np.bincount(column, weights=miss, minlength=len(w)) for column in x.T)


def logistic(total: Callable[[Callable[[Block], np.ndarray]], np.ndarray], size: int, mass: float, steps: int, rate: float, decay: float = 1e-6) -> np.ndarray | None:
    """Weights of a logistic regression, the first of none and always 0, by adaptive gradient steps; none without labels.

    ``total`` adds up what a function tells of each block of rows, wherever they are;
    weights of the rows are scaled so that they add up to ``mass``.
    """
    seen_rows = float(total(lambda b: np.where(b[1] >= 0, b[2], 0.0).sum()))
    if not seen_rows:
        return None
    w, seen = np.zeros(size + 1), np.full(size + 1, 1e-8)
    for _ in range(steps):
        grad = total(lambda b: _gradient(b, w)) * (mass / seen_rows) + decay * w  # noqa: B023
        seen += grad * grad
        w = w - rate * grad / np.sqrt(seen)
        w[0] = 0.0
    return w


def blocks_of(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> list[Block]:
    return [(x[i:i + BLOCK], y[i:i + BLOCK], times[i:i + BLOCK]) for i in range(0, len(x), BLOCK)]


class AtHand:
    """Blocks on the driver."""

    def __init__(self, blocks: list[Block]):
        self.blocks = blocks

    def map(self, change: Callable[[Block], Block]) -> AtHand:
        return AtHand([change(b) for b in self.blocks])

    def total(self, tell: Callable[[Block], np.ndarray]) -> np.ndarray:
        return sum(tell(b) for b in self.blocks)


@dataclass
class NameModel:
    """Weights of a fitted model; what is computed for a token is kept in ``memo``."""

    names: dict[str, int] = field(default_factory=dict)
    lower: dict[str, tuple[int, int]] = field(default_factory=dict)
    phrases: frozenset[tuple[str, str]] = frozenset()
    vocabulary: dict[str, str] = field(default_factory=dict)
    grams: np.ndarray = field(default_factory=lambda: np.zeros(1 << GRAM_BITS))
    weights: dict[str, float] = field(default_factory=dict)
    memo: dict[str, tuple] = field(default_factory=dict)
    pairs: dict[tuple, float] = field(default_factory=dict)

    def __getstate__(self):
        return {"names": self.names, "lower": self.lower, "phrases": self.phrases, "vocabulary": self.vocabulary, "grams": self.grams, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.memo, self.pairs = {}, {}

    def likeness(self, token: str) -> float:
        """Log odds that a token is one of a name, by its n-grams."""
        ids = _gram_ids(token)
        return float(self.grams[ids].sum()) if ids else 0.0

    def facts(self, token: str) -> tuple[str, str]:
        """(class, word) of a token, on which all its features rest."""
        shape = shape_of(token)
        low = _fold(token)
        if shape[0] in "mdp":
            return (shape, token) if shape != "d" else ("d", "<d>")
        if low in TITLES:
            return "title", low
        if low in PARTICLES and shape != "i":
            return "part" + shape, low
        if shape == "i":
            return "i", "<i>"
        held, (small, all_) = self.names.get(low, 0), self.lower.get(low, (0, 0))
        if not held and "-" in low:  # a double name is known by its parts
            held = min(self.names.get(x, 0) for x in low.split("-"))
        known = "0" if held == 0 else "1" if held == 1 else "2" if held < 5 else "3"
        common = "0" if small == 0 else "1" if small < 0.1 * all_ else "2" if small < 0.5 * all_ or (small < 3 and held) else "3" if small < 10 else "4"
        like = "n" if held else "+" if self.likeness(token) > 0 else "-"
        return f"{shape}{known}{common}{like}", low

    def features(self, token: str) -> tuple[list[str], list[str], list[str], str]:
        """Names of the features of a token itself, as the one before, and as the one after; its class."""
        kind, word = self.facts(token)
        usual = self.vocabulary.get(word, "0")
        return [f"o:{kind}", f"w:{word}", f"v:{usual}{kind[:2]}"], [f"pc:{kind}", f"p:{word}", f"ps:{kind[:1]}"], [f"nc:{kind}", f"n:{word}", f"ns:{kind[:1]}"], kind

    def known(self, token: str) -> tuple[float, float, float, str, str, bool]:
        """Sums for a token itself, as the one before, and as the one after; its class; its plain form; whether it is usually in lower case."""
        got = self.memo.get(token)
        if got is None:
            own, before, after, kind = self.features(token)
            w = self.weights
            low = _fold(token)
            got = tuple(sum(w.get(f, 0.0) for f in fs) for fs in (own, before, after)) + (kind, low, self.vocabulary.get(low) == "w")
            if len(self.memo) > 400_000:
                self.memo.clear()
            self.memo[token] = got
        return got

    def pair(self, a: str, b: str) -> tuple[float, float]:
        """Weights of two neighbouring classes: for the later one, and for the earlier one."""
        got = self.pairs.get((a, b))
        if got is None:
            got = self.pairs[a, b] = (self.weights.get(f"b:{a}|{b}", 0.0), self.weights.get(f"f:{a}|{b}", 0.0))
        return got

    def scores(self, tokens: list[str]) -> list[float]:
        return self._scores(tokens, [self.known(t) for t in (START, *tokens, END)])

    def _scores(self, tokens: list[str], rows: list[tuple]) -> list[float]:
        """Scores of tokens from what is known of each, and of a start and an end."""
        out = []
        for i in range(1, len(rows) - 1):
            before, own, after = rows[i - 1], rows[i], rows[i + 1]
            kind = own[3]
            if kind[0] in "mdpt" and not kind.startswith("part"):
                out.append(-9.0)
                continue
            titled = before[3] == "title" or (i > 1 and tokens[i - 2] == "." and rows[i - 2][3] == "title")
            # An ordinary word in lower case that no column of names holds.
            if kind[:2] == "l0" and own[5]:
                out.append(-9.0)
                continue
            if i < len(tokens) and tokens[i] in PLACES and kind[0] in "CU":
                out.append(-9.0)
                continue
            if self.phrases and (own[4], after[4]) in self.phrases:
                out.append(-9.0)
                continue
            if titled and kind[0] in "CUi":
                out.append(9.0)
                continue
            out.append(own[0] + before[1] + after[2] + self.pair(before[3], kind)[0] + self.pair(kind, after[3])[1])
        return out

    def spans(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of every name in a text."""
        found = tokens_of(text)
        if not any(t[0].isalpha() for t, _, _ in found):
            return []
        tokens = [t for t, _, _ in found]
        rows = [self.known(t) for t in (START, *tokens, END)]
        return _runs(text, found, self._scores(tokens, rows), [r[3] for r in rows[1:-1]])


def _runs(text: str, found: list[tuple[str, int, int]], marks: list[float], kinds: list[str]) -> list[tuple[int, int]]:
    """Names from the scores of tokens: particles and initials beside a name belong to it, turned parts are one name."""
    n = len(found)
    # Beside a sure part of a name, also across the comma of turned parts, weaker evidence
    # is enough; in lower case only for what columns hold, and without a comma.
    inside = [m > 0 for m in marks]
    for i in range(n):
        k = kinds[i]
        if inside[i] or marks[i] <= (NEARLY if k[0] in "CU" else 2 * NEARLY) or not (k[0] in "CU" or k[0] == "l" and k[-1] == "n"):
            continue
        small = k[0] == "l"
        left = i - 2 if i > 1 and found[i - 1][0] == "," and not small else i - 1
        right = i + 2 if i + 2 < n and found[i + 1][0] == "," and not small else i + 1
        inside[i] = any(0 <= j < n and marks[j] > SURE and kinds[j] != "i" and (not small or kinds[j][0] == "l") for j in (left, right)) or (
            left == i - 1 and left >= 0 and kinds[left] == "i" and not small)
    solid = [x and not (k == "i" or k.startswith("part")) for x, k in zip(inside, kinds)]

    def joined(i: int, j: int) -> bool:
        """Whether tokens i < j are neighbours with blanks between them, or an initial and what it touches."""
        between = text[found[i][2]:found[j][1]]
        return j == i + 1 and not between.strip(" \t") and (between != "" or kinds[i] == "i")

    parts: list[list[int]] = []
    i = 0
    while i < n:
        if not solid[i]:
            i += 1
            continue
        first = last = i
        while first > 0 and joined(first - 1, first) and (kinds[first - 1].startswith("part") or kinds[first - 1] == "i") and (not parts or first - 1 > parts[-1][1]):
            first -= 1
        while last + 1 < n and joined(last, last + 1):
            j = last + 1
            while j + 1 < n and kinds[j].startswith("part") and joined(j, j + 1):
                j += 1
            # Behind a particle a word that no text is known to use belongs to the name.
            if solid[j] or (j > last + 1 and kinds[j][1:3] in ("00", "01") and kinds[j][0] in "lCU") or (j == last + 1 and kinds[j] == "i" and (len(found[j][0]) == 2 or inside[j])):
                last = j
                continue
            break
        parts.append([first, last])
        i = last + 1

    def size(p: list[int]) -> int:
        return sum(not kinds[k].startswith("part") and kinds[k] != "p" for k in range(p[0], p[1] + 1))

    out: list[tuple[int, int]] = []
    i = 0
    while i < len(parts):
        p = parts[i]
        last, taken = p[1], 1
        # "Last, First": one family name before the comma, given names or initials behind.
        k = last + 2
        if k < n and found[k - 1][0] == "," and size(p) <= 2:
            q = parts[i + 1] if i + 1 < len(parts) else None
            if q and q[0] == k and size(q) <= 2 and (size(p) == 1 or size(q) == 1) and _alike(found, p, q):
                last, taken = q[1], 2
            elif kinds[k] == "i" and len(found[k][0]) == 2:
                last = k
                while last + 1 < n and kinds[last + 1] == "i" and joined(last, last + 1):
                    last += 1
        out.append((found[p[0]][1], found[last][2]))
        i += taken
    return out


def _alike(found: list[tuple[str, int, int]], p: list[int], q: list[int]) -> bool:
    """Both parts begin in upper case or neither does."""
    return found[p[1]][0][0].isupper() == found[q[1]][0][0].isupper()


def usual_case(path: str = TOKENIZER) -> dict[str, str]:
    """w(ord) or c(apitalised) by which form of a word comes first in a public vocabulary, which is in order of use."""
    ranks = encoder(path)[0]._mergeable_ranks
    place: dict[str, dict[str, int]] = {}
    for token, rank in ranks.items():
        if token[:1] == b" " and token[1:].isalpha() and len(token) > 2:
            t = token[1:].decode("ascii")
            if t.islower() or t.istitle():
                place.setdefault(t.lower(), {})["w" if t.islower() else "c"] = rank
    return {w: min(forms, key=forms.get) for w, forms in place.items()}


class _Memo(dict):
    """What a function tells of a token, kept."""

    def __init__(self, tell: Callable[[str], object]):
        super().__init__()
        self.tell = tell

    def __missing__(self, token: str):
        got = self[token] = self.tell(token)
        return got


def name_words(value: str) -> set[str]:
    """Words of one value of a name column."""
    return {w for w in (_fold(t) for t, _, _ in tokens_of(value) if t[0].isalpha()) if len(w) > 1 and w not in TITLES and w not in PARTICLES}


def base_names() -> dict[str, int]:
    """Names that are known without any column."""
    out = dict.fromkeys(COMMON, 3)
    for full, shorts in NICKNAMES.items():
        for w in (full, *shorts.split()):
            out[w] = max(2, out.get(w, 0))
    return out


def base_model(counts: Mapping[str, int], path: str = TOKENIZER) -> NameModel:
    """A model that knows names by how many values of name columns hold each word."""
    model = NameModel(base_names(), vocabulary=usual_case(path))
    for w, n in counts.items():
        model.names[w] = model.names.get(w, 0) + n
    return model


def text_counts(rows: Iterable[list[str]], names: Mapping[str, int]) -> Counter:
    """Numbers of places in tokens of texts, by kind of key: ``w`` words, ``l`` those in lower case,
    ``e`` words that columns hold, ``f`` pairs of such a word and one that no column holds."""
    held = _Memo(lambda t: t[0].isalpha() and _fold(t) in names)
    singles: Counter = Counter()
    pairs: Counter = Counter()
    for row in rows:
        singles.update(row)
        pairs.update(p for p in zip(row, row[1:]) if held[p[0]])
    out: Counter = Counter()
    for a, n in singles.items():
        # Tokens with digits are of one class, whatever they are.
        if a[0].isalpha() and shape_of(a) != "d":
            out["w", _fold(a)] += n
            if a[0].islower():
                out["l", _fold(a)] += n
    for (a, b), n in pairs.items():
        out["e", _fold(a)] += n
        if b[0].isalpha() and _fold(b) not in PARTICLES and (_fold(b) not in names and b[0].isupper() == a[0].isupper() or b.islower()):
            out["f", _fold(a) + PART + _fold(b)] += n
    return out


def set_least(texts: int) -> int:
    """Times that a set phrase is seen at least, in so many texts."""
    return max(SET_LEAST, texts // SET_TEXTS)


def learn_texts(model: NameModel, counts: Mapping[tuple[str, str], int], texts: int) -> None:
    """Share of lower case, set phrases and n-grams from the counts of all texts.

    A set phrase is a pair in which a good share of its first word's places lie. Columns
    also hold words by mistake: one that texts write without lower case many times more
    often, for its values, than names in general is no name.
    """
    model.lower = {w: (n, counts["w", w]) for (kind, w), n in counts.items() if kind == "l"}
    least = set_least(texts)
    pairs = ((w.split(PART), n) for (kind, w), n in counts.items() if kind == "f" and n >= least)
    model.phrases = frozenset((a, b) for (a, b), n in pairs if n >= SET_SHARE * counts["e", a])
    places = {w: n - model.lower.get(w, (0, 0))[0] for (kind, w), n in counts.items() if kind == "e"}
    ratios = sorted(n / model.names[w] for w, n in places.items() if model.names[w] >= OFTEN)
    if ratios:
        most, sure = STRAY * ratios[len(ratios) // 2], base_names()
        model.names = {w: n for w, n in model.names.items() if w in sure or places.get(w, 0) <= max(OFTEN, most * n)}
    # Words: tokens of texts, mostly in lower case, that no column holds.
    words = sorted(w for w, (s, a) in model.lower.items() if s >= 0.5 * a and w not in model.names and len(w) > 1)
    people = sorted(w for w in model.names if len(w) > 1 and (w not in model.lower or model.lower[w][0] < 0.5 * model.lower[w][1]))
    if words and people:
        grams = [_gram_ids(w) for w in (*people, *words)]
        table = np.zeros((len(grams), max(map(len, grams))), dtype=np.int32)
        for i, g in enumerate(grams):
            table[i, :len(g)] = np.array(g) + 1
        y = np.array([1.0] * len(people) + [0.0] * len(words))
        weight = np.where(y > 0, 0.5 / len(people), 0.5 / len(words))
        model.grams = logistic(AtHand(blocks_of(table, y, weight)).total, 1 << GRAM_BITS, len(y), 60, 0.3)[1:]


def training_rows(rows: Iterable[list[str]], model: NameModel) -> Counter:
    """How often each row of features, with its label, stands in tokens of texts.

    A fifth of the names count as not known while features are made, so that the
    weights also fit names that no column holds.
    """
    everyone = model.names
    fewer = NameModel({w: n for w, n in everyone.items() if zlib.crc32(w.encode()) % 5}, model.lower, model.phrases, model.vocabulary, model.grams)
    kinds = _Memo(lambda t: model.facts(t)[0])
    # Tokens of equal features have one number.
    numbers: dict[tuple[str, str, str, str], int] = {}

    def tell(token: str) -> int:
        own, before, after, kind = fewer.features(token)
        return numbers.setdefault((PART.join(own), PART.join(before), PART.join(after), kind), len(numbers))

    ids = _Memo(tell)
    seen: Counter = Counter()
    for row in rows:
        info = [ids[t] for t in (START, *row, END)]
        seen.update(zip(info, info[1:], info[2:], _first_labels(row, [kinds[t] for t in row], model.phrases)))
    told = list(numbers)
    out: Counter = Counter()
    for (i, j, k, label), n in seen.items():
        before, own, after = told[i], told[j], told[k]
        out[f"{own[0]}{PART}{before[1]}{PART}{after[2]}{PART}b:{before[3]}|{own[3]}{PART}f:{own[3]}|{after[3]}", int(label)] += n
    return out


def numbered(rows: Mapping[tuple[str, int], int], place: Mapping[str, int]) -> Counter:
    """Rows of features as numbers; those of no number say nothing, and rows that become equal count together."""
    out: Counter = Counter()
    for (features, label), n in rows.items():
        out[np.array([place.get(f, 0) for f in features.split(PART)], dtype=np.int32).tobytes(), label] += n
    return out


def block_of(rows: Iterable[tuple[bytes, int, int]]) -> Block:
    """Numbered rows, their labels and numbers as arrays, in an order of their own."""
    held = sorted((bytes(k), label, n) for k, label, n in rows)
    x = np.frombuffer(b"".join(k for k, _, _ in held), dtype=np.int32).reshape(len(held), -1).astype(np.intp, order="F")
    return x, np.array([r[1] for r in held], dtype=float), np.array([r[2] for r in held], dtype=float)


def learn_weights(model: NameModel, place: Mapping[str, int], rows: AtHand, steps: int = 80) -> None:
    """The tagger's weights from labels, and once more with its own sure answers."""
    w = logistic(rows.total, len(place), 1000, steps, 0.25, 1e-4)
    if w is not None:
        w = logistic(rows.map(lambda b, w=w: _sure(b, w)).total, len(place), 1000, steps, 0.25, 1e-4)
        model.weights = {f: float(w[i]) for f, i in place.items() if w[i] != 0.0}
    model.memo.clear()


def fit(names: list[str], texts: list[str], steps: int = 80, path: str = TOKENIZER) -> NameModel:
    """A model from values of name columns and texts whose other mentions are masked."""
    model = base_model(Counter(w for value in set(names) for w in name_words(value)), path)
    rows = [[t for t, _, _ in tokens_of(x)] for x in texts]
    learn_texts(model, text_counts(rows, model.names), len(rows))
    found = training_rows(rows, model)
    if found:
        seen: Counter = Counter()
        for (features, _), n in found.items():
            for f in features.split(PART):
                seen[f] += n
        place = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= LEAST_SEEN), 1)}
        learn_weights(model, place, AtHand(blocks_of(*block_of((*k, n) for k, n in numbered(found, place).items()))), steps)
    return model


def _first_labels(row: list[str], kinds: list[str], phrases: frozenset) -> list[float]:
    """1 name, 0 none, -1 not known, of each token of a text."""
    held = [k[0] in "UClx" and len(k) == 4 and k[1] in "123" for k in kinds]
    for i in range(len(row) - 1):
        if held[i] and (_fold(row[i]), _fold(row[i + 1])) in phrases:
            held[i] = False
    # A lower-case token that texts mostly write so is a word first.
    strong = [h and not (k[0] == "l" and k[2] in "34") for h, k in zip(held, kinds)]
    out = [(-1.0 if h else 0.0) for h in held]
    n = len(row)
    for i in range(n):
        if not strong[i]:
            continue
        j = i + 1
        while j < n and (kinds[j].startswith("part") or row[j] in ".," or kinds[j] == "i") and j - i <= 3:
            j += 1
        if j < n and strong[j] and (row[i][0].isupper() == row[j][0].isupper() or kinds[j - 1].startswith("part")) and "," not in row[i + 1:j - 1]:
            out[i] = out[j] = 1.0
        if i and kinds[i - 1] == "title" or i > 1 and kinds[i - 2] == "title" and row[i - 1] == "." or i and kinds[i - 1] == "i":
            out[i] = 1.0
    return out
