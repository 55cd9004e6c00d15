"""Benchmark decontamination by a prefix-filtered set join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import PLAIN_WORDS, broadcast_if_small, settled, small_reads, words

WINDOW = 10
SHINGLE = 5


def item_windows(items: DataFrame, *, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: words, number, and the ids of the items that hold them.

    An item of fewer words than a window is one window; an item without words has none. Equal windows of several
    items are one row. An item without an id still marks words, but is not listed.
    """
    split = items.select(F.col(item_id).cast("string").alias("_item"), words(text, PLAIN_WORDS).alias("_words"))
    starts = F.expr(f"if(size(_words) = 0, array(), sequence(1, greatest(size(_words) - {window - 1}, 1)))")
    return (
        split.select(
            "_item",
            F.explode_outer(F.transform(starts, lambda i: F.slice("_words", i, F.lit(window)))).alias("window"),
        )
        .where(F.col("window").isNotNull())
        .groupBy("window")
        .agg(F.collect_set("_item").alias("items"))
        .withColumn("length", F.size("window"))
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Which documents hold windows of benchmark items: one row per document.

    Windows and documents are sets of word shingles (`shingle` words; a shorter window is one shingle). A window can
    only stand where all its shingles stand, so one of them is enough as its prefix: the rarest, by the number of
    places in the documents. Documents are joined on these only; a place then has to leave room for the whole window
    before and after it (length and position), and the words there have to equal it.

    Documents are read once. What is broadcast is measured first; beyond the bound the joins shuffle.

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A null or empty text has no words. Repeated
    rows give repeated results, also where the id is null; equal ids with different texts are different documents.
    Other columns of either table are not looked at.
    """
    small_reads(docs.sparkSession)
    windows = settled(item_windows(items, item_id=item_id, text=item_text, window=window))
    windows = windows.withColumn("_window", F.xxhash64("window", "length"))
    shingled = settled(
        windows.select(
            "_window",
            "length",
            F.least(F.col("length"), F.lit(shingle)).alias("size"),
            F.posexplode(_shingles("window", shingle)).alias("offset", "mark"),
        )
    )
    sizes = sorted(r[0] for r in shingled.select("size").distinct().collect())  # no more than there are shingle sizes
    wanted = shingled.select("mark").union(docs.sparkSession.range(1).select(F.lit(0).cast("long"))).distinct()

    # Size 0 is a stand-in of every document that always matches: it counts words and rows. Marks are made one at a
    # time, behind the places: arrays of them for whole texts fill the executors' memory.
    spots = (
        docs.select(
            F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_text"), words(text, PLAIN_WORDS).alias("_words")
        )
        .select("_doc", "_text", "_words", F.explode(F.array(*map(F.lit, [0, *sizes]))).alias("_size"))
        .select("_doc", "_text", "_words", "_size", F.explode(_places("_words", "_size")).alias("_pos"))
        .withColumn("mark", _mark("_words", "_size", "_pos", sizes))
        .join(broadcast_if_small(settled(wanted)), "mark")
        .select("_doc", "_text", F.size("_words").alias("_n"), "mark", "_pos", *_around("_words", window, shingle))
    )
    spots = settled(spots)
    seen = spots.where("_pos > 0").groupBy("mark").agg(F.count("*").alias("_places"))
    prefixes = settled(
        shingled.join(seen, "mark", "left")
        .groupBy("_window")
        .agg(
            F.min(F.struct(F.coalesce("_places", F.lit(0)).alias("places"), "mark", "offset")).alias("rarest"),
        )
        .where("rarest.places > 0")
        .join(windows, "_window")
        .select("window", "length", "items", F.col("rarest.mark").alias("mark"), F.col("rarest.offset").alias("offset"))
    )
    hits = (
        spots.where("_pos > 0")
        .join(_broadcast_windows(prefixes), "mark")
        .withColumn("_start", F.col("_pos") - F.col("offset"))
        .where("_start >= 1 and _start + length - 1 <= _n")
        .where(F.expr("slice(_near, _start - _from + 1, length) = window"))
    )
    found = hits.groupBy("_doc", "_text").agg(
        F.collect_set(F.struct("_start", (F.col("_start") + F.col("length")).alias("_end"))).alias("_spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"),
    )
    base = (
        spots.where("_pos = 0").groupBy("_doc", "_text").agg(F.count("*").alias("_rows"), F.max("_n").alias("_n"))
    )
    joined = base.alias("b").join(
        found.alias("f"),
        F.col("b._doc").eqNullSafe(F.col("f._doc")) & (F.col("b._text") == F.col("f._text")),
        "left",
    )
    n_hit = F.expr(
        "aggregate(array_sort(coalesce(_spans, array())), named_struct('to', 0, 'n', 0), (a, s) -> "
        "named_struct('to', greatest(a.to, s._end), 'n', a.n + greatest(s._end - greatest(s._start, a.to), 0)), a -> a.n)"
    )
    listed = F.array_sort(F.coalesce("_items", F.array().cast("array<string>")))
    return joined.withColumn("_n_hit", n_hit).select(
        F.col("b._doc").alias(doc_id),
        F.col("_n").cast("long").alias("n_words"),
        F.col("_n_hit").cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_copy"),
    ).drop("_copy")


def _shingles(column: str, size: int) -> Column:
    """The shingles of a window; one of fewer words is a shingle itself."""
    short = " ".join(f"when {k} then array({_joined(column, '0', k)})" for k in range(1, size))
    many = f"transform(sequence(0, greatest(size({column}) - {size}, 0)), i -> {_joined(column, 'i', size)})"
    return F.expr(f"case size({column}) {short} else {many} end")


def _places(column: str, size: str) -> Column:
    """Where shingles of a size stand in the words, from 1; 0 for the stand-in, none if there are too few words."""
    last = f"size({column}) - {size} + 1"
    many = f"if({last} < 1, cast(array() as array<int>), sequence(1, {last}))"
    return F.expr(f"if({size} = 0, array(0), {many})")


def _mark(column: str, size: str, pos: str, sizes: list[int]) -> Column:
    """The shingle at a place, 0 for the stand-in."""
    found = F.when(F.col(size) == 0, F.lit(0).cast("long"))
    for k in sizes:
        found = found.when(F.col(size) == k, F.expr(_joined(column, f"{pos} - 1", k)))
    return found


def _joined(column: str, at: str, size: int) -> str:
    return f"xxhash64({', '.join(f'get({column}, {at} + {j})' for j in range(size))})"


def _around(column: str, window: int, shingle: int) -> list[Column]:
    """The words around a match, and where they start."""
    start = F.greatest(F.col("_pos") - F.lit(window), F.lit(1))
    near = F.slice(column, start, F.lit(2 * window + shingle))
    return [start.alias("_from"), F.when(F.col("_pos") > 0, near).alias("_near")]


def _broadcast_windows(prefixes: DataFrame) -> DataFrame:
    """Measured with all words and ids, as arrays have no fixed size."""
    flat = prefixes.select(
        F.array_join("window", " ").alias("w"), F.array_join("items", " ").alias("i"), "mark", "offset", "length"
    )
    return F.broadcast(prefixes) if broadcast_if_small(flat) is not flat else prefixes
