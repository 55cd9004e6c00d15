"""Personal data: patterns, and a semi-Markov conditional random field for forms they do not name."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import fresh, sample_of, ship

# The kinds in their order, and what they match.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser forms that the field judges: an address in words, and groups of digits.
WORDED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]?(?:\bat\b|@)[\])]?\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:\x20?[\[(]?(?:\bdot\b|\.)[\])]?\x20?[A-Za-z0-9-]{1,63}+){1,4}",
    re.IGNORECASE,
)
AT = re.compile(r" at |\(at\)|\[at\]|@", re.IGNORECASE)
DOT = re.compile(r" dot |dot\)|dot\]", re.IGNORECASE)
PIECE = re.compile(r"[^\x20]+")
GROUPS = re.compile(r"[(+]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
DIGITS = re.compile(r"[0-9]+")
# Entities in digits have so many at least, and so many characters at most; patterns find spans of any length.
LEAST_DIGITS = 7
LONGEST = 80
CONTEXT = 24
# Candidates nearer than this are decoded together.
NEAR = 40
FEATURES = 1 << 14
# The bound of the sample that the weights are fitted on, in documents.
SAMPLE = 1500
EPOCHS = 6


@dataclass(frozen=True)
class Model:
    """Weights of span features for each kind, and of kinds that follow each other (the last is "nothing yet")."""

    span: np.ndarray
    move: np.ndarray


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        x = x * 2 - 9 * (x > 4) if i % 2 else x
        total += x
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """Start, kind and end of what the patterns match, by kind as listed, then start."""
    found = [(a, "email", b) for a, b in _emails(text)]
    found += [
        (m.start(), "ip", m.end())
        for m in IP.finditer(text)
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))
    ]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), "card", m.end()))
    found += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses, from the sign outwards: a search from the left is slow on long words."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Spans that may be entities: looser forms that no base span touches, by start; they overlap.

    Boundaries are chosen too: a run of digits or an address in words gives a span from each of its borders to each.
    """
    found = {s for m in GROUPS.finditer(text) for s in _number_spans(text, *m.span())}
    if AT.search(text):
        found |= {s for m in WORDED.finditer(text) if DOT.search(m[0]) for s in _worded_spans(text, *m.span())}
    if not found:
        return []
    taken = sorted((a, b) for a, _, b in base)
    starts, ends = np.array([a for a, _ in taken]), np.maximum.accumulate(np.array([b for _, b in taken] or [0]))
    free = []
    for a, b in sorted(found):
        k = int(np.searchsorted(starts, b)) if taken else 0
        if not k or ends[k - 1] <= a:
            free.append((a, b))
    return free


def _number_spans(text: str, first: int, last: int) -> Iterator[tuple[int, int]]:
    """From each group of digits, with and without a sign before it, to each within reach; linear in the run."""
    groups = [m.span() for m in DIGITS.finditer(text, first, last)]
    for i, (a, _) in enumerate(groups):
        starts = (a - 1, a) if a > first and text[a - 1] in "(+" else (a,)
        digits = 0
        for j in range(i, len(groups)):
            c, b = groups[j]
            digits += b - c
            if b - a > LONGEST:
                break
            if digits >= LEAST_DIGITS:
                yield from ((s, b) for s in starts if b - s <= LONGEST)


def _worded_spans(text: str, first: int, last: int) -> Iterator[tuple[int, int]]:
    """From each word to each, without the full stop that may follow it."""
    pieces = [m.span() for m in PIECE.finditer(text, first, last)]
    for i, (a, _) in enumerate(pieces):
        for _, b in pieces[i:]:
            b -= text[b - 1] == "."
            if b > a and AT.search(text, a, b) and DOT.search(text, a, b):
                yield a, b


def span_features(text: str, a: int, b: int) -> list[int]:
    """Hashed features of a whole span: its form, digits, marks, and the words beside it."""
    word = text[a:b]
    digits = _digits(word)
    groups = [len(g) for g in re.findall(r"[0-9]+", word)]
    before = re.findall(r"\w+", text[max(0, a - CONTEXT) : a].lower())
    after = re.findall(r"\w+", text[b : b + CONTEXT].lower())
    marks = "".join(sorted({c for c in word if not c.isalnum()}))
    names = [
        "bias",
        f"digits={min(len(digits), 20)}",
        f"groups={len(groups)}",
        f"forms={'-'.join(map(str, groups[:8]))}",
        f"marks={marks}",
        f"first={'d' if word[0].isdigit() else word[0] if not word[0].isalpha() else 'a'}",
        f"letters={min(sum(map(str.isalpha, word)).bit_length(), 5)}",
        f"luhn={len(digits) >= 13 and luhn(digits)}",
        f"octets={len(groups) == 4 and all(g <= 3 for g in groups) and '.' in marks}",
        f"edge={_edge(text, a - 1)}{_edge(text, b)}",
        f"at={'@' in word or ' at ' in word.lower()}",
        *(f"before={w}" for w in before[-2:]),
        *(f"after={w}" for w in after[:1]),
    ]
    return [zlib.crc32(n.encode("utf-8", "replace")) % FEATURES for n in names]


def _edge(text: str, i: int) -> str:
    c = text[i] if 0 <= i < len(text) else " "
    return " " if c.isspace() else "w" if c.isalnum() else c


def groups_of(spans: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Candidates that stand near each other."""
    held: list[tuple[int, int]] = []
    end = 0
    for s in spans:
        if held and s[0] - end > NEAR:
            yield held
            held = []
        held.append(s)
        end = max(end, s[1])
    if held:
        yield held


def _prior(spans: list[tuple[int, int]]) -> list[int]:
    """For each candidate, how many candidates (by end) lie wholly before it."""
    ends = np.array(sorted(b for _, b in spans))
    return [int(np.searchsorted(ends, a, "right")) for a, _ in spans]


def decode(spans: list[tuple[int, int]], scores: np.ndarray, move: np.ndarray) -> list[tuple[int, int, int]]:
    """The best set of spans that do not overlap, with their kinds.

    Dynamic programming over candidates by their ends; text between entities scores 0, so only the kind of the last
    entity is kept. Entities are bounded by the candidates, which bounds the work for each.
    """
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], spans[i][0]))
    spans = [spans[i] for i in order]
    prior, kinds = _prior(spans), len(KINDS)
    best = np.full((len(spans) + 1, kinds + 1), -np.inf)
    best[0, kinds] = 0
    back: dict[tuple[int, int], tuple[int, int]] = {}
    for i, p in enumerate(prior):
        best[i + 1] = best[i]
        for k in range(kinds):
            way = best[p] + move[:, k]
            j = int(way.argmax())
            value = way[j] + scores[order[i], k]
            if value > best[i + 1, k]:
                best[i + 1, k] = value
                back[i + 1, k] = (p, j)
    chosen, i, k = [], len(spans), int(best[-1].argmax())
    while k != kinds:
        while (i, k) not in back or best[i, k] == best[i - 1, k]:
            i -= 1
        a, b = spans[i - 1]
        chosen.append((a, b, k))
        i, k = back[i, k]
    return chosen[::-1]


def find_spans(text: str | None, model: Model | None) -> tuple[list, list]:
    """Base spans; and all spans, those of the field among them, by kind as listed, then start."""
    if not text:
        return [], []
    base = base_spans(text)
    if model is None:
        return base, base
    more = []
    for group in groups_of(candidates(text, base)):
        scores = np.array([model.span[span_features(text, a, b)].sum(axis=0) for a, b in group])
        more += [(a, KINDS[k], b) for a, b, k in decode(group, scores, model.move)]
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[1]), s[0], s[2]))


def fit(docs: DataFrame, *, text: str = "text", sample: int = SAMPLE, epochs: int = EPOCHS) -> Model | None:
    """Weights from at most `sample` documents with digits or addresses, the first by a hash of the text.

    Base spans are the entities to learn from, each also in a looser form: a number without its plus, with other
    marks between its groups, an address in words. Other groups of digits are what is no entity. None if the sample
    has no entity.
    """
    ship(docs.sparkSession)
    found = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").rlike("[0-9]{2}|@"))
    rows = (
        sample_of(found, "text", sample)
        .mapInArrow(_training_rows, "features array<array<int>>, starts array<int>, ends array<int>, kinds array<int>")
        .toPandas()
    )
    data = []
    for f, a, b, k in rows.itertuples(index=False, name=None):
        spans = list(zip(map(int, a), map(int, b), strict=True))
        data.append(([list(map(int, x)) for x in f], spans, list(map(int, k))))
    if not any(k >= 0 for *_, kinds in data for k in kinds):
        return None
    n = len(KINDS)
    weights, move = np.zeros((FEATURES, n)), np.zeros((n + 1, n))
    rng, seen = np.random.default_rng(5), 0
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            seen += 1
            rate = 0.3 / (1 + seen / 2000)
            features, spans, gold = data[i]
            scores = np.array([weights[f].sum(axis=0) for f in features])
            node, edge = _marginals(spans, scores, move)
            last = n
            for j in sorted(range(len(spans)), key=lambda j: spans[j][1]):
                if gold[j] >= 0:
                    node[j, gold[j]] -= 1
                    edge[last, gold[j]] -= 1
                    last = gold[j]
            for f, g in zip(features, node, strict=True):
                weights[f] -= rate * (g + 1e-4 * weights[f])
            move -= rate * edge
    return Model(weights, move)


def _marginals(spans: list[tuple[int, int]], scores: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each candidate with each kind, and summed ones of kinds that follow each other.

    Sums over all sets of spans that do not overlap: forward over ends, backward by the derivative of the total.
    """
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], spans[i][0]))
    prior, n = _prior([spans[i] for i in order]), len(KINDS)
    ahead = np.full((len(spans) + 1, n + 1), -np.inf)
    ahead[0, n] = 0
    for i, p in enumerate(prior):
        ahead[i + 1] = ahead[i]
        come = np.logaddexp.reduce(ahead[p][:, None] + move, axis=0) + scores[order[i]]
        ahead[i + 1, :n] = np.logaddexp(ahead[i + 1, :n], come)
    total = np.logaddexp.reduce(ahead[-1])
    weight = np.zeros_like(ahead)
    weight[-1] = np.exp(ahead[-1] - total)
    node, edge = np.zeros_like(scores), np.zeros_like(move)
    for i in range(len(prior) - 1, -1, -1):
        p, here = prior[i], weight[i + 1]
        with np.errstate(invalid="ignore", divide="ignore"):
            steps = ahead[p][:, None] + move + scores[order[i]][None]
            share = np.exp(steps - ahead[i + 1, :n][None]) * here[:n][None]
            kept = np.exp(ahead[i] - ahead[i + 1]) * here
        share, kept = np.nan_to_num(share), np.nan_to_num(kept)
        node[order[i]] = share.sum(axis=0)
        edge += share
        weight[p] += share.sum(axis=1)
        weight[i] += kept
    return node, edge


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = pa.list_(pa.int32())
    for batch in batches:
        rows: list[tuple] = []
        for text in batch.column(0).to_pylist():
            for a, kind, b in base_spans(text):
                if b - a <= LONGEST:
                    around = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
                    for form in _looser(kind, text[a:b]):
                        whole = around[0] + form + around[1]
                        span = (len(around[0]), len(around[0]) + len(form))
                        spans = sorted({span, *candidates(whole, [])})
                        rows.append(_example(whole, spans, span, KINDS.index(kind)))
            for group in groups_of(candidates(text, base_spans(text))):
                rows.append(_example(text, group, None, -1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.list_(numbers)),
                *(pa.array([r[i] for r in rows], numbers) for i in (1, 2, 3)),
            ],
            ["features", "starts", "ends", "kinds"],
        )


def _looser(kind: str, word: str) -> list[str]:
    if kind == "phone":
        return [word.lstrip("+"), re.sub(r"[\x20().-]+", ".", word.lstrip("+"))]
    if kind == "email":
        return [word.replace("@", " at ").replace(".", " dot "), word.replace("@", " (at) ").replace(".", " (dot) ")]
    if kind == "card":
        return [".".join(re.findall(r"[0-9]{1,4}", _digits(word)))]
    return [word.replace(".", ". ")]


def _example(text: str, spans: list, span: tuple | None, kind: int) -> tuple:
    return (
        [span_features(text, a, b) for a, b in spans],
        [a for a, _ in spans],
        [b for _, b in spans],
        [kind if s == span else -1 for s in spans],
    )


def find(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """All rows and columns with `base` and `spans`: arrays of start, kind and end (code points, end exclusive).

    Both are sorted by kind as listed, then start; `base` is what the patterns match, and a part of `spans`. The field
    adds spans that touch no base span. Every text is read to its end; null and empty texts have no spans. Columns
    named `base` or `spans` are replaced, others are not looked at.
    """
    ship(docs.sparkSession)
    (answer,) = fresh(docs, "found")
    found = docs.withColumn(answer, _finder(model)(F.col(text).cast("string")))
    return found.withColumns({"base": F.col(answer)["base"], "spans": F.col(answer)["spans"]}).drop(answer)


def _finder(model: Model | None) -> Callable:
    span = "array<struct<start: int, kind: string, end: int>>"

    @F.pandas_udf(f"base {span}, spans {span}")
    def spans(texts: pd.Series) -> pd.DataFrame:
        rows = [find_spans(t, model) for t in texts]
        named = [[[dict(zip(("start", "kind", "end"), s, strict=True)) for s in x] for x in r] for r in rows]
        return pd.DataFrame({"base": [r[0] for r in named], "spans": [r[1] for r in named]})

    return spans
