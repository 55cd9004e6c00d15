"""Secret scans: patterns, and a linear-chain conditional random field for what patterns do not name."""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import ship

# The kinds in their order, and what they match.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Around what the patterns find lies the text that the field learns from.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}+")
CONTEXT = 60
TOKEN_SIGN = re.compile(r"[A-Za-z0-9+/_.=-]")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+|[^\sA-Za-z0-9+/_.=-]")
# Tokens of any other place of a text that it learns from too, and tokens whose scores are held at once.
ORDINARY = 48
BLOCK = 1 << 16
# Different words whose place in the table of weights a task remembers until it starts anew.
REMEMBERED = 200_000
# Words that have weights of their own, if so many chains hold them; others share those of their looks.
KNOWN = 4096
KNOWN_FROM = 3
FEATURES = 1 << 14
OUTSIDE, BEGIN, INSIDE = range(3)
# The bounds of the sample that the weights are fitted on: documents in which the patterns may find something, other
# documents, chains and tokens a document, and characters of a token.
SAMPLE = 600
OTHERS = 400
CHAINS = 4
CHAIN_TOKENS = 256
WORD = 256
EPOCHS = 4
# Chains made from what the patterns find, in all: secrets and rivals of other forms, with other words beside them.
MADE = 3000
BESIDE = 6
LEARNED = r"""[0-9a-f]{32}|AKIA[A-Z0-9]{12}|(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""


@dataclass(frozen=True)
class Model:
    emit: np.ndarray
    move: np.ndarray
    known: frozenset[str] = frozenset()  # words with weights of their own


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """Start, kind and end of what the patterns match, sorted by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    for run in RUN.finditer(text):
        a, b = run.span()
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, b)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b)]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def chains(text: str, base: list[tuple[int, str, int]]) -> Iterator[list[tuple[int, int]]]:
    """Token spans to learn from: around base spans, and some of another place of the text."""
    spots = [(a, b) for a, _, b in base]
    place = zlib.crc32(text.encode("utf-8", "replace")) % (len(text) or 1)
    k = 0
    while k < len(spots):
        first, last = spots[k][0], spots[k][1]
        k += 1
        while k < len(spots) and spots[k][0] - last <= 2 * CONTEXT:
            last = max(last, spots[k][1])
            k += 1
        first, last = max(0, first - CONTEXT), min(len(text), last + CONTEXT)
        if first <= place + 10 * ORDINARY and place <= last:
            place = len(text)
        yield [m.span() for m in TOKEN.finditer(text, first, last)]
    while 0 < place < len(text) and TOKEN_SIGN.match(text[place - 1]):
        place -= 1
    yield [m.span() for m in islice(TOKEN.finditer(text, place), ORDINARY)]


def token_features(words: list[str], about: list[str], known: frozenset[str] = frozenset()) -> list[list[int]]:
    """Hashed features of each token: its shape, the words beside it, and those of the whole file."""
    looks = [_looks(w, known) for w in words]
    own, beside = [_hashed(_own(look)) for look in looks], [_beside(look) for look in looks]
    file, rows = _hashed(about), []
    for i, row in enumerate(own):
        near = [beside[i - step][step - 1] for step in (1, 2, 3) if i >= step]
        near += [beside[i + 1][3]] if i + 1 < len(words) else []
        rows.append([*row, *file, *near])
    return rows


def _looks(word: str, known: frozenset[str]) -> tuple[str, ...]:
    """All that the weights see of a word: itself if known, else what it is made of; then its shape. Few are different."""
    low = word.lower()
    if low in known:
        return (f"={low}", *_shape(word))
    if word.isalpha():
        return ("letters", *_shape(word))
    if not word[0].isalnum() and len(word) == 1:
        return ("sign", *_shape(word))
    kind = "digits" if word.isdigit() else "mixed"
    return (kind if len(word) < 16 else f"long {kind}", *_shape(word))


def _own(look: tuple[str, ...]) -> list[str]:
    return ["bias", f"word{look[0]}", *look[1:]]


def _beside(look: tuple[str, ...]) -> list[int]:
    """What a word says of the tokens one, two and three places after it, and of the one before it."""
    return _hashed([f"-1{look[0]}", f"-2{look[0]}", f"-3{look[0]}", f"+1{look[0]}"])


def _hashed(names: list[str]) -> list[int]:
    return [zlib.crc32(n.encode("utf-8", "replace")) % FEATURES for n in names]


class Weights:
    """Scores of the tokens of a text. What a word adds, to itself and to others, is summed up once for its looks."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.places: dict[str, int] = {}
        self.looks: dict[tuple[str, ...], int] = {}
        self.table = np.zeros((1024, 5, 3))
        self.slack = _slack(model.move)

    def places_of(self, words: list[str]) -> np.ndarray:
        if len(self.places) > REMEMBERED:
            self.places.clear()
        found = list(map(self.places.get, words))
        if None in found:
            for i, place in enumerate(found):
                if place is None:
                    found[i] = self._place(words[i])
        return np.array(found, np.int32)

    def _place(self, word: str) -> int:
        look = _looks(word, self.model.known)
        place = self.looks.get(look)
        if place is None:
            place = self.looks[look] = len(self.looks)
            if place == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            emit = self.model.emit
            self.table[place, 0] = emit[_hashed(_own(look))].sum(axis=0)
            self.table[place, 1:] = emit[_beside(look)]
        if len(word) <= WORD:
            self.places[word] = place
        return place

    def scores(self, places: np.ndarray, about: list[str], first: int, last: int) -> np.ndarray:
        """Scores of the tokens from first to last (exclusive); their neighbours on both sides count."""
        near = places[max(0, first - 3) : last + 1]
        rows, lead, n = self.table[near], first - max(0, first - 3), last - first
        scores = rows[lead : lead + n, 0] + self.model.emit[_hashed(about)].sum(axis=0)
        for step in (1, 2, 3):
            skip = max(0, step - lead)
            if skip < n:
                scores[skip:] += rows[lead + skip - step : lead + n - step, step]
        after = rows[lead + 1 : lead + n + 1, 4]
        scores[: len(after)] += after
        return scores

    def tagged(self, words: list[str], about: list[str]) -> Iterator[tuple[int, list[int]]]:
        """Where a part of the text begins that is not plainly outside, and its best tags: those of the whole text.

        A token is plainly outside if, whatever the tags around it, outside is its best one. On both sides of it the best
        tags do not depend on each other, so only what lies between such tokens is decoded.
        """
        places, move = self.places_of(words), self.model.move
        held: list[np.ndarray] = []
        start = 0
        for first in range(0, len(words), BLOCK):
            last = min(first + BLOCK, len(words))
            # One more token: what the next one gains by being inside and not at a begin.
            scores = self.scores(places, about, first, min(last + 1, len(words)))
            gain = np.full(len(scores), -np.inf)
            gain[:-1] = scores[1:, INSIDE] - scores[1:, BEGIN]
            plain = np.ones(len(scores), bool)
            for tag, (before, free, joined) in self.slack.items():
                plain &= scores[:, OUTSIDE] - scores[:, tag] > before + np.maximum(free, joined + gain) + 1e-6
            plain, scores = plain[: last - first], scores[: last - first]
            at = 0
            for stop in (*np.flatnonzero(plain).tolist(), None):
                part = scores[at : None if stop is None else stop]
                if len(part):
                    if not held:
                        start = first + at
                    held.append(part)
                if stop is not None:
                    if held:
                        yield start, best_tags(np.concatenate(held), move, start > 0, True)
                        held = []
                    at = stop + 1
        if held:
            yield start, best_tags(np.concatenate(held), move, start > 0, False)


def _slack(move: np.ndarray) -> dict[int, tuple[float, float, float]]:
    """What a token can gain at most by the moves around it if it is at a begin or inside, and not outside.

    Before it; after it, if what follows keeps its tag; and if what follows is inside and so would turn to a begin.
    """
    found = {}
    turned = max(0.0, *(move[INSIDE] - move[BEGIN]))
    for tag in (BEGIN, INSIDE):
        into = [move[a, tag] - move[a, OUTSIDE] for a in range(3) if tag == BEGIN or a != OUTSIDE]
        free = max(0.0, *(move[tag, c] - move[OUTSIDE, c] for c in (OUTSIDE, BEGIN)))
        joined = move[tag, INSIDE] - move[OUTSIDE, BEGIN] + turned
        found[tag] = (max([0.0, *into]), free, float(joined))
    return found


def _shape(word: str) -> tuple[str, ...]:
    """Its length, what it is made of and how often that changes: one feature for words of one case, seven for others."""
    n = len(word)
    size = min(n.bit_length(), 8)
    if word.isalpha() and (word.islower() or word[1:].islower() or word.isupper()):
        return (f"plain={size}",)
    digits, upper = sum(map(str.isdigit, word)), sum(map(str.isupper, word))
    lower = sum(map(str.islower, word))
    entropy = -sum(k / n * math.log2(k / n) for k in map(word.count, set(word)))
    mixed = (digits > 0) + (upper > 0) + (lower > 0)
    # Runs of one sort, single characters and capitals before small letters aside, in parts between signs.
    parts = [p for p in PARTS.split(word) if p]
    turns = sum(len(SORTS.findall(p)) - 1 for p in parts)
    longest = max(map(len, parts), default=0)
    return (
        f"size,mixed={size},{mixed}",
        f"digits={min(digits, 2)},{digits * 4 // n}",
        f"upper={upper * 4 // n}",
        f"turns={min(turns, 6)},{mixed}",
        f"size,turns={min(n // 4, 6)},{min(turns // 2, 4)}",
        f"longest,entropy={min(longest // 6, 4)},{int(entropy)}",
        f"parts={min(len(parts), 4)},{min(longest // 6, 4)}",
    )


PARTS = re.compile(r"[^A-Za-z0-9]+")
SORTS = re.compile(r"[0-9]+|[A-Z]?[a-z]+|[A-Z]+")


def file_features(text: str) -> list[str]:
    low = text.lower()
    named = sum(k in low for k in KEYWORDS)
    return [f"named={min(named, 2)}", f"assigns={min(low.count('=').bit_length(), 4)}"]


def find_spans(text: str | None, weights: Weights | None) -> list[tuple[int, str, int]]:
    """Base spans, and what the field marks beside them (kind `secret`). The field tags all tokens of the text."""
    if not text:
        return []
    base = base_spans(text)
    words = TOKEN.findall(text) if weights else []
    if not words:
        return base
    taken = np.array([(a, b) for a, _, b in base]).reshape(-1, 2)
    more, spans, at = [], None, 0
    for first, tags in weights.tagged(words, file_features(text)):
        if not any(tags):
            continue
        spans = spans or (m.span() for m in TOKEN.finditer(text))
        own = list(islice(spans, first - at, first - at + len(tags)))
        at = first + len(tags)
        start = None
        for (a, b), tag, after in zip(own, tags, [*tags[1:], OUTSIDE], strict=True):
            if tag == BEGIN:
                start = a
            if tag != OUTSIDE and after != INSIDE and start is not None:
                if not ((taken[:, 0] < b) & (taken[:, 1] > start)).any():
                    more.append((start, "secret", b))
                start = None
    order = {k: i for i, k in enumerate((*KINDS, "secret"))}
    return sorted(base + more, key=lambda s: (s[0], order[s[1]], s[2]))


def decode(rows: list[list[int]], model: Model) -> list[int]:
    """The best tags of a whole text by Viterbi; inside follows begin or inside only."""
    return best_tags(np.array([model.emit[r].sum(axis=0) for r in rows]), model.move, False, False)


def best_tags(scores: np.ndarray, move: np.ndarray, before: bool, after: bool) -> list[int]:
    """The best tags of a part of a text, with a token that is outside before or after it or without."""
    (m00, m01, m02), (m10, m11, m12), (m20, m21, m22) = move.tolist()
    rows = scores.tolist()
    start = move[OUTSIDE] if before else _START
    x, y, z = (a + float(b) for a, b in zip(rows[0], start, strict=True))
    back = []
    for r in rows[1:]:
        o, b, i = (x + m00, y + m10, z + m20), (x + m01, y + m11, z + m21), (x + m02, y + m12, z + m22)
        p, q, s = max(o), max(b), max(i)
        back.append((o.index(p), b.index(q), i.index(s)))
        x, y, z = p + r[0], q + r[1], s + r[2]
    last = (x + m00, y + m10, z + m20) if after else (x, y, z)
    tags = [last.index(max(last))]
    for prev in reversed(back):
        tags.append(prev[tags[-1]])
    return tags[::-1]


_START = np.array([0.0, 0.0, -1e9])
_BARRED = np.array([[0.0, 0.0, -1e9], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])


def fit(
    docs: DataFrame, *, text: str = "text", sample: int = SAMPLE, others: int = OTHERS, epochs: int = EPOCHS
) -> Model | None:
    """Weights from at most `sample` documents in which the patterns find something and `others` of any kind, the first by a hash.

    The patterns give the tags to learn from. So that the field also marks what they do not name, most chains are made
    anew: other words in place of the names, and in the place of the secret one of another form, or a rival that is none
    (`made_chains`). Bounds for each document are CHAINS, CHAIN_TOKENS and WORD. None if the patterns find nothing.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(text).cast("string").alias("text"))
    total = texts.count()
    found = [
        row
        for rows in (_first_by_hash(texts, sample, total, LEARNED), _first_by_hash(texts, others, total))
        for row in rows.mapInArrow(_training_rows, "words array<string>, tags array<int>, about array<string>").collect()
    ]
    return learned([(r.words, r.tags, r.about) for r in found if r.words], epochs)


def learned(data: list[tuple[list[str], list[int], list[str]]], epochs: int = EPOCHS) -> Model | None:
    """Weights from chains of words, their tags and what is said of their file, and from those made of them."""
    named = [d for d in data if any(d[1])]
    if not named:
        return None
    rng = random.Random(3)
    data = data + made_chains(named, [w for d in data for w in d[0] if w.isalpha()], rng)
    counts = Counter(w for words, _, _ in data for w in {w.lower() for w in words if len(w) < 16})
    ranked = sorted((-n, w) for w, n in counts.items() if n >= KNOWN_FROM and not _drawn_like(w))
    known = frozenset(w for _, w in ranked[:KNOWN])
    rows = [(token_features(words, about, known), tags) for words, tags, about in data]
    emit, move = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    emit_sum, move_sum = np.full((FEATURES, 3), 0.1), np.full((3, 3), 1.0)
    for _ in range(epochs):
        for i in rng.sample(range(len(rows)), len(rows)):
            features, tags = rows[i]
            node, edge = _marginals(np.array([emit[f].sum(axis=0) for f in features]), move + _BARRED)
            node[np.arange(len(tags)), tags] -= 1
            for a, b in zip(tags, tags[1:], strict=False):
                edge[a, b] -= 1
            flat = np.concatenate([np.array(f) for f in features])
            at, place = np.unique(flat, return_inverse=True)
            step = np.zeros((len(at), 3))
            np.add.at(step, place, np.repeat(node, [len(f) for f in features], axis=0))
            step += 1e-4 * emit[at]
            emit_sum[at] += step**2
            emit[at] -= 0.2 * step / np.sqrt(emit_sum[at])
            move_sum += edge**2
            move -= 0.2 * edge / np.sqrt(move_sum)
    return Model(emit, move + _BARRED, known)


def _first_by_hash(texts: DataFrame, most: int, total: int, pattern: str | None = None) -> DataFrame:
    """The first texts by a hash, of those with a pattern: only a part of the hashes is searched, and more if it holds too few."""
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    share = (32 if pattern else 2) * most / max(total, 1)
    while True:
        share = share if share < 0.5 else 1.0
        rows = texts.withColumn("place", place)
        if share < 1:
            rows = rows.where(F.col("place") < int(share * (1 << 30)))
        if pattern:
            rows = rows.where(F.col("text").rlike(pattern))
        if share == 1 or rows.count() >= most:
            # Equal texts are learned from once, however many there are.
            return rows.dropDuplicates(["place"]).orderBy("place").limit(most).select("text")
        share *= 8


def made_chains(
    named: list[tuple], plain: list[str], rng: random.Random, made: int = MADE
) -> list[tuple[list[str], list[int], list[str]]]:
    """Chains around the first secret of each given one, by turns with a secret of another form and with a rival.

    Half of them keep the words before it; in the others a word of the corpus stands for the name.
    """
    found, plain = [], plain or ["a"]
    for i in range(made):
        words, tags, about = named[i % len(named)]
        a = next(k for k, t in enumerate(tags) if t == BEGIN) if BEGIN in tags else 0
        b = a + 1
        while b < len(tags) and tags[b] == INSIDE:
            b += 1
        secret = rng.random() < 0.5
        lead, value, own = words[max(0, a - BESIDE) : a], [], []
        if secret:
            weak = rng.random() < 0.4
            value = _weak(rng) if weak else _strong(rng)
            own = [BEGIN] + [INSIDE] * (len(value) - 1)
        else:
            weak, value = False, TOKEN.findall(_rival(rng, plain))
            own = [OUTSIDE] * len(value)
        if rng.random() < 0.6:
            lead = [*rng.choices(plain, k=BESIDE - 2), *rng.choice(SIGNED if weak else SIGNED + BARE)]
        if BEGIN in tags[:a] or INSIDE in tags[:a]:
            lead = rng.choices(plain, k=3) + [":"]
        after = rng.choices(plain, k=3) if rng.random() < 0.5 else [rng.choice(["\"", ",", ";", "."]), *rng.choices(plain, k=2)]
        about = [f"named={rng.randint(0, 2)}", f"assigns={rng.randint(0, 2)}"] if rng.random() < 0.7 else about
        found.append((lead + value + after, [OUTSIDE] * len(lead) + own + [OUTSIDE] * len(after), about))
    return found


# What may stand between a name and its secret, with and without a sign.
SIGNED = [[":"], ["="], ["=", "\""], [":", "\""], ["-", ">"], ["=", ">"], ["\"", ":", "\""]]
BARE = [[], [], ["is"], ["is", "\""], ["("], ["\""]]
_LOW, _MIXED = string.ascii_lowercase + string.digits, string.ascii_letters + string.digits


def _strong(rng: random.Random) -> list[str]:
    """A secret that its looks give away: random characters of several sorts, or the lines of a key."""
    form = rng.randrange(6)
    if form == 0:
        return ["".join(rng.choices("0123456789abcdef", k=rng.randint(32, 64)))]
    if form == 1:
        lines = ["".join(rng.choices(_MIXED + "+/", k=64)) for _ in range(rng.randint(1, 4))]
        return [*lines, "".join(rng.choices(_MIXED + "+/", k=rng.randint(20, 60))) + rng.choice(["", "=", "=="])]
    signs = ("", "", "-_", "+/")[rng.randrange(4)]
    alphabet = _MIXED + signs if form < 5 else string.ascii_uppercase + string.digits
    return [_random_word(rng, alphabet, rng.randint(12 if form < 5 else 16, 44))]


def _weak(rng: random.Random) -> list[str]:
    """A secret that may be a word but for its place: small letters with digits."""
    if rng.random() < 0.5:
        return [_random_word(rng, _LOW, rng.randint(10, 24))]
    part = "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 7)))
    return [part + rng.choice("0123456789") + "".join(rng.choices(string.ascii_lowercase, k=3)) + str(rng.randint(10, 9999))]


def _random_word(rng: random.Random, alphabet: str, n: int) -> str:
    while True:
        word = "".join(rng.choices(alphabet, k=n))
        if sum(map(str.isdigit, word)) >= 2 and any(map(str.isalpha, word)):
            return word


def _rival(rng: random.Random, plain: list[str]) -> str:
    """What stands in the place of a secret and is none: words, names made of words, numbers, dates, addresses."""
    a, b, c = rng.choices(plain, k=3)
    n, m = rng.randint(0, 9999), rng.randint(1, 28)
    return rng.choice(
        [
            a,
            a,
            f"{a}-{b}",
            f"{a}_{b}_{c}",
            a.lower() + b.title() + c.title(),
            "".join(w[: rng.randint(2, 5)].title() for w in rng.choices(plain, k=rng.randint(2, 6))),
            f"{a}{m}",
            f"{a}.{m}",
            f"{a}-{m}",
            f"{a}{n}.{b}.com",
            f"www.{a}.org/{b}/{n}",
            f"/{a}/{b}/{c}{m}.{a[:3]}",
            str(n),
            str(rng.randint(10**9, 10**19)),
            f"{n}.{m}",
            f"2{n % 1000:03}-{m % 12 + 1:02}-{m:02}",
            f"2{n % 1000:03}-{m % 12 + 1:02}-{m:02}T{m % 24:02}",
            f"v{m}.{n % 10}.{m}-{n}",
            f"{n % 256}.{m}.{n % 200}.{m}",
            f"555-{n:04}",
            f"{n % 1000:03}-{m:03}-{n:04}",
            "-" * rng.randint(1, 40),
            "=" * rng.randint(1, 40),
            f"--{a}={n}",
            f"{a.upper()}-{b.upper()}-----",
            f"-----{a.upper()}",
        ]
    )


def _drawn_like(word: str) -> bool:
    return any(map(str.isdigit, word)) and any(map(str.isalpha, word))


def _marginals(scores: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of tags and summed probabilities of neighbouring tags, by forward and backward sums."""
    n = len(scores)
    ahead, behind = np.zeros((n, 3)), np.zeros((n, 3))
    ahead[0] = scores[0] + _START
    for i in range(1, n):
        ahead[i] = scores[i] + np.logaddexp.reduce(ahead[i - 1][:, None] + move, axis=0)
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp.reduce(move + (scores[i + 1] + behind[i + 1])[None], axis=1)
    total = np.logaddexp.reduce(ahead[-1])
    edges = np.zeros((3, 3))
    for i in range(1, n):
        edges += np.exp(ahead[i - 1][:, None] + move + (scores[i] + behind[i])[None] - total)
    return np.exp(ahead + behind - total), edges


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string())]
    for batch in batches:
        for text in batch.column(0).to_pylist():
            rows = [], [], []
            base, about = base_spans(text or ""), file_features(text or "")
            values = [ASSIGN.match(text, a).span(2) if kind == "assign" else (a, b) for a, kind, b in base]
            *near, ordinary = chains(text or "", base)
            near.sort(key=lambda spans: zlib.crc32(str(spans[0]).encode()))
            for tokens in (*near[:CHAINS], ordinary):
                tokens = tokens[:CHAIN_TOKENS]
                rows[0].append([text[a : min(b, a + WORD)] for a, b in tokens])
                rows[1].append([_tag(t, values) for t in tokens])
                rows[2].append(about)
            columns = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["words", "tags", "about"])


def _tag(token: tuple[int, int], values: list[tuple[int, int]]) -> int:
    for a, b in values:
        if token[0] < b and token[1] > a:
            return BEGIN if token[0] <= a else INSIDE
    return OUTSIDE


def scan(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """All rows and columns with `secrets`: an array of kind, start and end (code points, end exclusive) by start.

    Patterns first (`base`); the field adds spans that overlap none of these, of kind `secret`. Every text is read to
    its end; null and empty texts have no spans. A column named `secrets` is replaced, others are not looked at.
    """
    ship(docs.sparkSession)
    return docs.withColumn("secrets", _finder(model)(F.col(text).cast("string")))


def _finder(model: Model | None) -> Callable:
    held: list[Weights] = []  # a task's own, made when it begins

    @F.pandas_udf("array<struct<start: int, kind: string, end: int>>")
    def spans(texts: pd.Series) -> pd.Series:
        if model and not held:
            held.append(Weights(model))
        weights = held[0] if model else None
        return pd.Series([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in find_spans(t, weights)] for t in texts])

    return spans


