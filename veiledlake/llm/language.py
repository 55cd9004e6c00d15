"""Language ID: multinomial logistic regression on TF-IDF weighted character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import fresh, ship

# N-grams of 1 to so many characters are hashed to so many features.
LONGEST = 3
FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS
# The bound of the sample that the weights are fitted on: labelled documents of each language.
SAMPLE = 500
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
# Text that is turned into features at once.
PART = 1 << 20
UNKNOWN = "und"
_STEPS = np.array([0x9E3779B1, 0x85EBCA6B], np.uint32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def fit(
    docs: DataFrame, *, text: str = "text", label: str = "lang", sample: int = SAMPLE, epochs: int = EPOCHS
) -> Model:
    """Learn from documents with a label; those without label or text are not looked at.

    Document frequencies come from all documents. Weights come from a sample of about `sample` documents of each
    language, chosen by a hash of the text, so that a language with few documents gives all it has. Of the sample,
    every fifth document is kept apart and sets the temperature. Without any label the model knows no language.
    """
    ship(docs.sparkSession)
    known = docs.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("lang"))
    known = known.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    frequencies = known.select("text").mapInArrow(_count, "slot int, found long").groupBy("slot")
    frequencies = frequencies.agg(F.sum("found").alias("found")).toPandas()
    found = np.zeros(FEATURES, np.float64)
    found[frequencies["slot"].to_numpy()] = frequencies["found"].to_numpy()
    idf = np.log((1 + sum(sizes.values())) / (1 + found)) + 1
    if not languages:
        return Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, sample / n)])
    order = F.xxhash64("text")
    chosen = known.where(F.pmod(order, F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    # Rows of one text share a hash: the limit holds the bound even if they are many.
    chosen = chosen.withColumn("place", order).orderBy("place", "lang").limit(2 * sample * len(languages))
    rows = chosen.mapInArrow(_sample, "lang string, place long, slots array<int>, counts array<int>").toPandas()
    rows = rows.sort_values(["place", "lang"])
    rng = np.random.default_rng(1)
    data = _one_block(rows["slots"], rows["counts"], idf)
    data = [(v, s, languages.index(k)) for (v, s), k in zip(data, rows["lang"], strict=True)]
    del rows
    apart, learn = data[::5], [x for i, x in enumerate(data) if i % 5]
    weights, bias = _ftrl(learn or data, len(languages), epochs, rng)
    logits = np.array([v @ weights[s] + bias for v, s, _ in apart]).reshape(-1, len(languages))
    temperature = _temperature(logits, np.array([y for *_, y in apart], int))
    return Model(languages, idf, weights, bias, temperature)


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All rows and columns with `lang_pred` and `score`, the calibrated probability (0 to 1).

    A text that is null or has no letter gets `und` with score 0, and so do all if the model knows no language.
    Every text is read to its end. Columns of these names are replaced; no column but the text is looked at.
    """
    ship(docs.sparkSession)
    (answer,) = fresh(docs, "answer")
    marked = docs.withColumn(answer, _predictor(model)(F.col(text).cast("string")))
    found = {"lang_pred": F.col(answer)["lang"], "score": F.col(answer)["score"]}
    return marked.withColumns(found).drop(answer)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are not learned from; a null id is not held out (and not learned from either)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out, then predict all."""
    model = fit(docs.where(F.col(doc_id).isNotNull() & ~held_out(doc_id)), text=text, label=label)
    return predict(docs, model, text=text).withColumn("held_out", held_out(doc_id))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs; runs of anything but letters are one gap."""
    total = np.zeros(FEATURES, np.int64)
    for start in range(0, len(text), PART):
        codes = np.frombuffer(text[start : start + PART].lower().encode("utf-32-le", "replace"), np.uint32)
        codes = codes * _letters()[codes]
        gap = np.zeros(1, np.uint32)
        codes = np.concatenate((gap, codes, gap))
        codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
        hashes, found = np.zeros(len(codes), np.uint32), []
        for n in range(LONGEST):
            hashes = (hashes[: len(codes) - n] + codes[n:] + np.uint32(n + 1)) * _STEPS[0]
            found.append(((hashes ^ (hashes >> np.uint32(15))) * _STEPS[1]) >> np.uint32(32 - FEATURE_BITS))
        total += np.bincount(np.concatenate(found), minlength=FEATURES)
    slots = np.flatnonzero(total)
    return slots, total[slots]


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once a process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint32, 0x110000))
    return _LETTERS[0]


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _weighted(slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[slots]
    return values / max(np.sqrt(values @ values), 1e-12)


def _one_block(slots: pd.Series, counts: pd.Series, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and features of each text, as parts of two arrays: the driver gives back one large block, but not many small ones."""
    ends = np.append(0, np.cumsum([len(s) for s in slots], dtype=np.int64))
    features, values = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.float64)
    for s, c, a, b in zip(slots, counts, ends, ends[1:], strict=False):
        features[a:b] = s
        values[a:b] = _weighted(features[a:b], np.asarray(c, np.float64), idf)
    return [(values[a:b], features[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def _ftrl(data: list, classes: int, epochs: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader, proximal, with L1 and L2 penalties; the last row is the bias, without L1."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        small = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -small / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            values, slots, y = data[i]
            at = np.append(slots, FEATURES)
            x = np.append(values, 0.1)
            w = weights(at)
            p = _softmax((x @ w)[None])[0]
            p[y] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    w = weights(slice(None))
    return w[:FEATURES], 0.1 * w[FEATURES]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, from 1/64 to 8, by golden section."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(logits / 2.0**t)[np.arange(len(y)), y], 1e-12)).mean()

    low, high, cut = -6.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(2.0 ** ((low + high) / 2))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES, np.int64)
    for batch in batches:
        for text in batch.column(0):
            total[grams(text.as_py())[0]] += 1
    slots = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots, pa.int32()), pa.array(total[slots], pa.int64())], ["slot", "found"]
    )


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [grams(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"),
                batch.column("place"),
                pa.array([s for s, _ in found], pa.list_(pa.int32())),
                pa.array([c for _, c in found], pa.list_(pa.int32())),
            ],
            ["lang", "place", "slots", "counts"],
        )


def _predictor(model: Model) -> Callable[[Column], Column]:
    weights, idf, bias = model.weights.astype(np.float32), model.idf, model.bias
    languages, temperature = model.languages, model.temperature

    @F.pandas_udf("lang string, score double")
    def answer(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], []
        for text in texts:
            if not languages or text is None or not _has_letter(text):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            slots, counts = grams(text)
            p = _softmax(((_weighted(slots, counts, idf) @ weights[slots] + bias) / temperature)[None])[0]
            names.append(languages[int(p.argmax())])
            scores.append(float(p.max()))
        return pd.DataFrame({"lang": names, "score": scores})

    return answer
