"""Substring dedup: seeds on winnowed anchors, extended both ways to maximal repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import bit_table, broadcast_if_small, fresh, is_set, join_by_weight, settled, ship
from veiledlake.llm.shingles import LETTERS, hashed_words, parts, rolled

WINDOW = 13
ANCHOR = 7
# Tables of seeds and windows up to this size are broadcast; larger ones grow with the texts, and are shuffled.
SMALL = 4 << 20
# Bits of the table of anchors that stand twice: 16 MB.
BITS = 27
KIND = "struct<n_words: long, n_removed: long, kept: string>"


def drop_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """All rows and columns with `n_words`, `n_removed` and `kept`, the words left, joined by one space.

    A word goes if it lies in `window` consecutive words that also start, unchanged, in a document with a smaller id.
    Words are what white space (space, \\t to \\r) separates. Windows are those of the whole input text.

    Null, empty and blank texts have no words. A document without an id has no place in the order: it keeps all its
    words and takes none from others. Rows with the same id take none from each other, and a repeated row has the result
    of the first. Columns named like the three results are replaced.
    """
    [held, place, copy, spans] = fresh(docs, "found", "doc", "copy", "spans")
    found = repeats(docs, doc_id=doc_id, text=text, window=window, anchor=anchor)
    found = found.toDF(place, copy, spans)
    same = (F.col(doc_id) == F.col(place)) & (F.xxhash64(text) == F.col(copy))

    @F.pandas_udf(KIND)
    def cut(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = [_cut(t, g) for t, g in zip(texts, gone, strict=True)]
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    joined = docs.join(broadcast_if_small(found), same, "left")
    whole = joined.withColumn(held, cut.asNondeterministic()(F.col(text), F.col(spans)))
    whole = whole.withColumns({c: F.col(held)[c] for c in ("n_words", "n_removed", "kept")})
    return whole.drop(held, place, copy, spans)


def repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """Maximal repeats of documents that hold any: doc, copy (a hash of the text) and spans "start:stop,..." of words.

    1. Winnowing: of the runs of `anchor` words in a window the one with the smallest hash is its anchor, so equal
       windows have equal anchors. Anchors are counted, first inside the tasks.
    2. Documents meet in the anchors that stand twice or more; where one does is a seed. Tasks leave out the others by
       a table of bits; an anchor that passes it by chance has one class of one seed, and nothing comes of it.
    3. A seed is extended both ways to all windows it is the anchor of. Seeds whose whole stretch is the same are one
       class: in all documents but the smallest of the class the stretch is repeated.
    4. Where an anchor has stretches that differ, which is at the ends of what is common, windows are compared one by
       one, once for each class. A window is known by its anchor and a hash of its words, 96 bits.
    5. Windows that follow each other join to a maximal repeat; it is no shorter than a window.

    No pairs are made: a passage of a third of all documents costs each of them its own length. Keys that many rows hold
    are not shuffled in the joins.
    """
    if not 0 < anchor <= window or window - anchor >= 63:
        raise ValueError("an anchor is part of a window, and shorter by less than 63 words")
    ship(docs.sparkSession)
    texts = docs.where(F.col(doc_id).isNotNull())
    texts = texts.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("copy"), F.col(text).cast("string").alias("text")
    )
    counted = texts.select("text").mapInArrow(_anchors(window, anchor), "anchor long, n long")
    shared = counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    bits = bit_table(F.col("anchor"), shared, BITS)
    seeds = texts.mapInArrow(
        _seeds(window, anchor, bits), "doc long, copy long, at int, anchor long, windows array<int>"
    )
    seeds = settled(seeds)
    classes = seeds.groupBy("anchor", "windows").agg(F.min("doc").alias("owner"), F.count("*").alias("n"))
    classes = settled(classes.withColumn("stretch", F.xxhash64("windows")))
    early = _owned_windows(classes)
    marked = classes.select("anchor", "stretch", "owner", "n").join(early, ["anchor", "stretch"], "left")
    marked = settled(marked.where("n > 1 or early is not null"))
    stretches = seeds.select(
        "doc", "copy", "at", "anchor", F.xxhash64("windows").alias("stretch"), F.size("windows").alias("size")
    )
    found = join_by_weight(stretches, marked, ["anchor", "stretch"], "n", SMALL).where("doc > owner or early is not null")
    kept = F.filter(
        F.sequence(F.lit(0), F.col("size") - 1),
        lambda i: (F.col("doc") > F.col("owner")) | (F.getbit("early", i) == 1),
    )
    starts = found.select("doc", "copy", F.transform(kept, lambda i: i + F.col("at")).alias("starts"))
    starts = starts.groupBy("doc", "copy").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return settled(starts.select("doc", "copy", _spans(F.array_sort(F.array_distinct("starts")), window).alias("spans")))


def _owned_windows(classes: DataFrame) -> DataFrame:
    """For classes of seeds, the windows that a class with a smaller document has too: anchor, stretch, early (bits)."""
    rivals = settled(classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    contested = join_by_weight(classes.drop("n"), rivals, ["anchor"], "n", SMALL)
    windows = settled(contested.select("anchor", "stretch", "owner", F.posexplode("windows").alias("i", "words")))
    owners = windows.groupBy("anchor", "words").agg(F.min("owner").alias("least"), F.count("*").alias("n"))
    owned = join_by_weight(windows, settled(owners.where("n > 1")), ["anchor", "words"], "n", SMALL).where("least < owner")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i"))
    return settled(owned.groupBy("anchor", "stretch").agg(F.bit_or(bit).alias("early")))


def _spans(starts: Column, window: int) -> Column:
    """Stretches of consecutive windows, in words."""

    def stretches(s: Column) -> Column:
        first = F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1) < x - 1))
        last = F.filter(s, lambda x, i: (i == F.size(s) - 1) | (F.get(s, i + 1) > x + 1))
        return F.array_join(F.zip_with(first, last, lambda a, b: F.concat_ws(":", a, b + window)), ",")

    return F.get(F.transform(F.array(starts), stretches), F.lit(0))


def _cut(text: str | None, spans: str | None) -> tuple[int, int, str]:
    words = (text or "").encode().split()
    if not spans:
        return len(words), 0, b" ".join(words).decode()
    kept, at = [], 0
    for span in spans.split(","):
        start, stop = map(int, span.split(":"))
        kept += words[at:start]
        at = max(at, stop)
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def _anchors(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends in parts(batch.column(0)):
                marks, _, _, _, begins = _winnowed(data, ends, window, anchor)
                found, counts = np.unique(marks[begins], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], ["anchor", "n"])

    return run


def _seeds(window: int, anchor: int, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = 0
            for data, ends in parts(batch.column(2)):
                marks, words, at, row, begins = _winnowed(data, ends, window, anchor)
                sizes = np.diff(begins, append=len(words))
                kept = is_set(bits, marks[begins])
                words, begins = words[np.repeat(kept, sizes)], begins[kept]
                borders = pa.array(np.append(0, np.cumsum(sizes[kept])).astype(np.int32))
                rows = pa.array(row[begins] + before)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(at[begins].astype(np.int32)),
                        pa.array(marks[begins]),
                        pa.ListArray.from_arrays(borders, pa.array(words)),
                    ],
                    ["doc", "copy", "at", "anchor", "windows"],
                )
                before += len(ends) - 1

    return run


def _winnowed(data: np.ndarray, ends: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """All windows of a part: anchors, hashes of words, first words, texts; and where windows of a new seed begin.

    Of equal hashes the leftmost is the anchor. Windows with the same anchor at the same place follow each other.
    """
    hashes, starts, _ = hashed_words(data, ends, LETTERS)
    bounds = np.searchsorted(starts, ends)
    grams = rolled(hashes, hashes, anchor)
    words = rolled(grams, hashes, window, anchor)
    row = np.repeat(np.arange(len(ends) - 1), np.diff(bounds))[: len(words)]
    place = np.arange(len(words))
    pick, marks = place.copy(), grams[: len(words)].copy()
    for j in range(1, window - anchor + 1):
        other = grams[j : j + len(words)]
        lower = other < marks
        marks[lower] = other[lower]
        pick[lower] = place[lower] + j
    whole = np.flatnonzero(place + window <= bounds[row + 1])
    pick, row = pick[whole], row[whole]
    begins = np.flatnonzero((np.diff(pick, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    short = (words[whole] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return marks[whole].view(np.int64), short, whole - bounds[row], row, begins
