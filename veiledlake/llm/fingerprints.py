"""Document fingerprints: digests of improbable features in chained Bloom filters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import ship

# Bytes of a feature, how many neighbours it is ranked among, and in how many of their windows it has to win.
WINDOW = 64
RIVALS = 64
WINS = 16
# A filter holds so many features in so many bytes, each by so many bits.
FILTER_FEATURES = 160
FILTER_BYTES = 256
FEATURE_BITS = 5
# Entropies are told apart in so many steps.
STEPS = 1000
# Bytes that are worked on at once.
PART = 1 << 20
# Texts that are worked on together, so that a step is worth its start.
BATCH = 1 << 16
_PLACE_BITS = 21
_PLACES = (1 << _PLACE_BITS) - 1
_TERMS = np.concatenate(([0.0], np.arange(1, WINDOW + 1) * np.log2(np.arange(1, WINDOW + 1))))


def entropies(data: np.ndarray) -> np.ndarray:
    """The entropy of every window of bytes, as a step from 0 to STEPS; none if there are fewer bytes.

    From one window to the next a byte goes and one comes, and the sum changes by what their counts say. How often a
    byte stands in the rest of its window is counted for all places at once, one distance after the other.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for k in range(1, WINDOW):
        same = (data[k:] == data[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    # `before` counts in the 63 bytes before a place, `after` in those behind it.
    gain = _TERMS[1:] - _TERMS[:-1]
    first = _TERMS[np.bincount(data[:WINDOW], minlength=256)].sum()
    change = gain[before[WINDOW:]] - gain[after[: n - 1]]
    sums = np.concatenate(([first], first + np.cumsum(change)))
    return (STEPS + 0.5 - sums * (STEPS / WINDOW / np.log2(WINDOW))).astype(np.int64)


def features(data: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Places of the selected windows: those that are the rarest (leftmost of equals) among enough of their rivals.

    Windows of a single byte value tell nothing and never win. A short text has fewer rivals, and its rarest window
    is always selected.
    """
    steps = entropies(data)
    n = len(steps)
    if not n:
        return np.zeros(0, np.int64)
    best = _rarest(_keys(steps, rarity), min(RIVALS, n))
    wins = np.bincount(best & _PLACES, minlength=n)
    # Fewer windows of rivals than a feature has to win: the best of them is taken.
    places = np.flatnonzero(wins >= min(WINS, len(best)))
    places = places if len(places) else np.flatnonzero(wins == wins.max())[:1]
    return places


def digest(text: bytes, rarity: np.ndarray) -> bytes:
    """Chained filters of the features, each once; a text shorter than a window is one feature, the empty text none."""
    return _filters(_selected(np.frombuffer(text, np.uint8), rarity)[1])


def _selected(data: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the features, in the order of the text."""
    if 0 < len(data) < WINDOW:
        data = np.concatenate((data, np.zeros(WINDOW - len(data), np.uint8)))
    found, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for start in range(0, len(data), PART):
        part = data[start : start + PART + WINDOW - 1 + RIVALS]
        places = features(part, rarity)
        places = places[places < PART]
        found.append(places + start)
        hashes.append(_hash(np.lib.stride_tricks.sliding_window_view(part, WINDOW)[places]) if len(places) else hashes[0])
    return np.concatenate(found), np.concatenate(hashes)


def _selected_many(texts: list[np.ndarray], rarity: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for many texts at once, laid end to end; windows and rivals across their ends do not count."""
    least = WINDOW + RIVALS + WINS
    out: list = [None] * len(texts)
    together = [i for i, t in enumerate(texts) if least <= len(t) <= PART // 2]
    first = 0
    while first < len(together):
        last, size = first, 0
        while last < len(together) and (last == first or size + len(texts[together[last]]) <= BATCH):
            size += len(texts[together[last]])
            last += 1
        chosen = together[first:last]
        first = last
        data = np.concatenate([texts[i] for i in chosen])
        starts = np.cumsum([0, *(len(texts[i]) for i in chosen)])
        best = _rarest(_keys(entropies(data), rarity), RIVALS)
        counted = np.zeros(len(best) + 1, np.int8)
        counted[starts[:-1]] = 1
        counted[starts[1:] - (WINDOW + RIVALS - 2)] -= 1
        wins = np.bincount(best[np.cumsum(counted)[:-1] > 0] & _PLACES, minlength=len(data))
        places = np.flatnonzero(wins >= WINS)
        hashes = _hash(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places])
        cuts = np.searchsorted(places, starts)
        for i, a, b, start in zip(chosen, cuts[:-1], cuts[1:], starts[:-1], strict=True):
            if b > a:
                out[i] = (places[a:b] - start, hashes[a:b])
    return [_selected(t, rarity) if o is None else o for t, o in zip(texts, out, strict=True)]


def _keys(steps: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Rarity and place in one number."""
    keys = rarity[steps]
    keys[steps == 0] = STEPS + 1
    return (keys << _PLACE_BITS) | np.arange(len(steps))


def _rarest(keys: np.ndarray, rivals: int) -> np.ndarray:
    """The smallest key of each run of so many."""
    width = 1
    while width < rivals:
        step = min(width, rivals - width)
        keys = np.minimum(keys[:-step], keys[step:])
        width += step
    return keys


def _filters(hashes: np.ndarray) -> bytes:
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    filters = np.zeros((-(-len(hashes) // FILTER_FEATURES), FILTER_BYTES * 8), np.uint8)
    at = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(FEATURE_BITS):
        filters[at, (hashes >> np.uint64(11 * k)).astype(np.int64) % (FILTER_BYTES * 8)] = 1
    return np.packbits(filters, axis=1).tobytes()


def _hash(windows: np.ndarray) -> np.ndarray:
    if not len(windows):
        return np.zeros(0, np.uint64)
    words = np.ascontiguousarray(windows).view("<u8")
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


_BITS = np.array([bin(i).count("1") for i in range(256)], np.int64)


def likeness(a: bytes, b: bytes) -> float:
    """How far two digests overlap, from 0 to 1.

    Each filter of the digest with fewer features takes its best partner in the other. The common bits count beyond
    what chance gives, and as a share of what they could be; filters weigh by their bits. Equal digests are 1, an
    empty one is like an empty one only.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.frombuffer(f, np.uint8).reshape(-1, FILTER_BYTES) for f in (a, b))
    if (len(x), _BITS[x].sum(), a) > (len(y), _BITS[y].sum(), b):
        x, y = y, x
    nx, ny = _BITS[x].sum(axis=1), _BITS[y].sum(axis=1)
    total = 0.0
    for row, n in zip(x, nx, strict=True):
        common = _BITS[row & y].sum(axis=1)
        chance = n * ny / (FILTER_BYTES * 8)
        most = np.minimum(n, ny)
        total += n * np.clip((common - chance) / np.maximum(most - chance, 1), 0, 1).max()
    return float(min(total / nx.sum(), 1.0))


def rarity_of(docs: DataFrame, *, text: str = "text") -> np.ndarray:
    """For each entropy step how often windows of all documents have it: the rank of a feature."""
    ship(docs.sparkSession)
    counts = (
        docs.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(_count, "step int, found long")
        .groupBy("step")
        .agg(F.sum("found").alias("found"))
        .toPandas()
    )
    found = np.zeros(STEPS + 1, np.int64)
    found[counts["step"].to_numpy()] = counts["found"].to_numpy()
    return np.argsort(np.argsort(found, kind="stable"), kind="stable").astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(STEPS + 1, np.int64)
    for batch in batches:
        # Texts one after the other, so that short ones share a pass; windows across their ends do not count.
        held, size = [], 0
        for text in batch.column(0):
            data = (text.as_py() or "").encode("utf-8", "replace")
            held.append(data)
            size += len(data)
            if size >= PART:
                total += _histogram(held)
                held, size = [], 0
        total += _histogram(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(STEPS + 1), pa.int32()), pa.array(total, pa.int64())], ["step", "found"]
    )


def _histogram(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    total = np.zeros(STEPS + 1, np.int64)
    whole = np.zeros(len(data) + 1, np.int64)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= WINDOW:
            whole[a] += 1
            whole[b - WINDOW + 1] -= 1
    inside = np.cumsum(whole)[:-1] > 0
    for start in range(0, len(data), BATCH):
        steps = entropies(data[start : start + BATCH + WINDOW - 1])[:BATCH]
        total += np.bincount(steps[inside[start : start + len(steps)]], minlength=STEPS + 1)
    return total


def fingerprints(docs: DataFrame, rarity: np.ndarray, *, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """All rows and columns with the digest of the whole text in hexadecimal digits.

    Equal texts have equal digests; null counts as the empty text, whose digest is empty. A column named like `out`
    is replaced.
    """
    ship(docs.sparkSession)

    @F.udf("string", useArrow=True)
    def of(value: str | None) -> str:
        return digest((value or "").encode("utf-8", "replace"), rarity).hex()

    return docs.withColumn(out, of(F.col(text).cast("string")))


# What an edit takes: the last part of a text gives way to the first part of the next document's.
EDIT = 3
COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(
    docs: DataFrame, rarity: np.ndarray, *, doc_id: str = "doc_id", text: str = "text", parts: int | None = None
) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness to it and to the next document.

    The next document is the one before in the order of ids (after the last: the first); equal ids go by their text,
    null ids come last. The last third of the code points gives way to the first as many of the next document.

    Documents are dealt out once, by ranges of ids. The first document of each range also goes to the range before,
    so that no range has to see another; a document alone in the table is its own next. Other columns are not looked
    at; repeated rows are kept.
    """
    ship(docs.sparkSession)
    docs = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    spark = docs.sparkSession
    n = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)
    ranges = F.lit(len(cuts))
    if cuts:
        # How many cuts lie at or above the id: the ranges that come before its own.
        above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c >= F.col("doc_id")))
        ranges = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above)
    else:
        ranges = F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    ranged = docs.withColumn("part", ranges.cast("int"))
    # The first document of a range: its largest id and, of equal ids, its smallest text by hash.
    order = F.struct(F.col("doc_id").alias("id"), (-F.xxhash64("text").cast("decimal(20,0)")).alias("h"))
    firsts = {r["part"]: r["first"] for r in ranged.groupBy("part").agg(F.max(order).alias("first")).collect()}
    present = sorted(firsts)
    before = {p: present[i - 1] for i, p in enumerate(present)}
    peeks = None
    if present:
        rows = [(p, before[p], firsts[p]["id"], firsts[p]["h"]) for p in present]
        marks = spark.createDataFrame(rows, "part int, before int, id long, h decimal(20,0)")
        # One row a range; of repeated rows, one.
        peeks = (
            ranged.join(F.broadcast(marks), "part")
            .where(F.col("doc_id").eqNullSafe(F.col("id")) & (-F.xxhash64("text").cast("decimal(20,0)") == F.col("h")))
            .select("doc_id", "text", F.col("before").alias("part"))
            .dropDuplicates(["part", "doc_id"])
            .withColumn("peek", F.lit(1))
        )
    dealt = ranged.withColumn("peek", F.lit(0))
    dealt = dealt.unionByName(peeks) if peeks is not None else dealt
    dealt = dealt.withColumn("h", F.xxhash64("text"))
    dealt = dealt.repartition(n, "part").sortWithinPartitions(
        "part", "peek", F.col("doc_id").desc_nulls_last(), "h", "text"
    )
    return dealt.select("part", "peek", "doc_id", "text").mapInArrow(_compare(rarity), COMPARED)


def _compare(rarity: np.ndarray):
    """Rows of a range come in order; a document is told of when the next one is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            rows, size = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append(row)
                size += len(row[3])
                if size >= BATCH:
                    last, told = _told(last, rows, rarity)
                    yield told
                    rows, size = [], 0
            if rows:
                last, told = _told(last, rows, rarity)
                yield told

    return run


def _told(last: tuple | None, rows: list[tuple], rarity: np.ndarray) -> tuple[tuple, pa.RecordBatch]:
    """The documents before the last of these rows, and that last one with its features."""
    found = _selected_many([np.frombuffer(r[3].encode("utf-8", "replace"), np.uint8) for r in rows], rarity)
    whole = [(*r, f, _filters(f[1])) for r, f in zip(rows, found, strict=True)]
    whole = [last, *whole] if last is not None else whole
    pairs = [(a, b) for a, b in zip(whole, whole[1:], strict=False) if a[0] == b[0] and not a[1]]
    edits = [_edit(a[3], b[3]) for a, b in pairs]
    # Whether a window is selected depends on the bytes of all windows it is ranked with, and on no others: before the
    # place of the edit the features stay, and only the rest of the text is looked at again.
    reach = WINDOW + RIVALS
    tails, data = [], []
    for edited, same in edits:
        tail = same - 2 * reach if same >= 4 * reach and len(edited) <= PART // 2 else 0
        tails.append(tail)
        data.append(np.frombuffer(edited, np.uint8)[tail:])
    told: list[tuple] = []
    parts = zip(pairs, edits, tails, _selected_many(data, rarity), strict=True)
    for (this, other), (edited, same), tail, (places, hashes) in parts:
        if tail:
            own = this[4]
            hashes = np.concatenate((own[1][own[0] < same - reach], hashes[places + tail >= same - reach]))
        changed = _filters(hashes)
        told.append(
            (
                this[2],
                len(this[3]),
                hashlib.sha256(edited).hexdigest(),
                this[5].hex(),
                changed.hex(),
                likeness(this[5], changed),
                likeness(this[5], other[5]),
            )
        )
    columns = zip(*told, strict=True) if told else [[] for _ in _SCHEMA]
    return whole[-1], pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
    )


def _edit(text: str, other: str) -> tuple[bytes, int]:
    """The edited text, and how many of its bytes are the text's own."""
    gone = len(text) // EDIT
    kept = text[: len(text) - gone].encode("utf-8", "replace")
    return kept + other[:gone].encode("utf-8", "replace"), len(kept)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(c, pa.float64()) for c in ("near_edited", "near_next")]
)
