"""N-gram Jaccard join that skips by relations between sets."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import bit_table, broadcast_if_small, is_set, settled, ship
from veiledlake.llm.shingles import set_id, sets_of

SHINGLE = 5
PERCENT = 80
# Counters from which the rarity of shingles is read. More of them tell frequencies apart better; results are the same.
COUNTERS = 1 << 20
CHUNK = 1 << 12
# Prefixes are longer by this share of a set, and similar sets then have so many marks more in common.
MORE = 20
# Marks in lists of one entry are told in the tasks by a table of 2 ** BITS bits (8 MB); what passes by chance is counted in full.
BITS = 26
# Rounds with one pivot a list go on, up to so many, while the links of a round are this share of the components
# still open; what is then left is compared completely.
PIVOT_ROUNDS = 6
WORTH = 0.01


def jaccard_components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Components of the documents whose shingle sets have a Jaccard similarity of `percent` or more.

    One row per document: doc_id, n_shingles, component_id (the smallest id that links reach, itself included).
    Equal sets are one class first. Classes meet in index lists of their prefix shingles, rare ones first, which hold
    position and length. Two relations between sets save comparisons, and neither loses a link:

    - A list is cut into blocks by length, and blocks too far apart are skipped without a look at their entries. Within
      blocks the positions bound what two sets can still share. A list whose sets are all connected is skipped whole.
    - Answers of a set follow from those of a similar set: with the overlaps of x and of y with a pivot known, the
      overlap of x and y is bounded, and the pair is looked at only if the bound leaves it open.

    First every list is compared with a pivot of its own, so that groups of copies shrink to one component in a number
    of comparisons in proportion to their size. After a few rounds all that is still open is compared, without limit.

    Words of null or empty texts: none; such documents have 0 shingles, are linked with nothing, and are their own
    component. Repeated rows are kept. A null id never becomes a component's id; if no member has one, it is null.
    Sets and shingles are told apart by 64-bit hashes. Columns other than the two named are not looked at.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    weights = _weights(texts, size)
    prefixes = settled(
        texts.mapInArrow(_each(_prefix_row, size, weights, percent), "doc long, set long, n long, marks array<long>")
    )
    classes = settled(prefixes.where("n > 0").groupBy("set", "n").agg(F.min("doc").alias("doc")))
    entries = settled(_shared_entries(prefixes, classes, percent))
    entries = entries.withColumn("label", F.col("set"))
    labels = settled(entries.select("set", "label").distinct())
    known: DataFrame | None = None
    last = False
    for step in range(PIVOT_ROUNDS + 1):
        last = last or step == PIVOT_ROUNDS
        if step:
            entries = settled(_still_open(entries, labels))
        pairs = _all_pairs(entries, percent) if last else _pivot_pairs(entries, step, percent)
        if known is not None:
            pairs = _skip_known(pairs, known, percent) if last else pairs.join(known, ["set", "other"], "left_anti")
        pairs = settled(_common_marks(settled(pairs), prefixes, classes))
        overlaps = settled(_overlaps(pairs, classes, texts, size))
        linked = overlaps.where(_similar("overlap", "n", "m", percent)).select("set", "other")
        labels, links = _joined(labels, linked)
        if last:
            break
        known = overlaps if known is None else settled(known.union(overlaps))
        last = links < WORTH * entries.select("label").distinct().count()
    smallest = (
        labels.join(classes.select("set", "doc"), "set").groupBy("label").agg(F.min("doc").alias("component"))
    )
    found = labels.join(smallest, "label").select("set", "component")
    own = classes.select("set", F.col("doc").alias("own")).join(found, "set", "left")
    own = own.select("set", F.coalesce("component", "own").alias("component"))
    empty = F.col("n") == 0
    joined = prefixes.select("doc", "n", F.when(~empty, F.col("set")).alias("set")).join(own, "set", "left")
    return joined.select(
        F.col("doc").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc")).otherwise(F.col("component")).alias("component_id"),
    )


def _shared_entries(prefixes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Entries of the index lists that hold more than one: mark, set, length, position, and the mark before it in the set.

    Two linked sets share one of the first marks, which are all that is listed; those behind them serve to count. A set
    comes from one of its documents; the copies to leave out are told by their ids, not by their marks. Lists are
    counted in the tasks first, and entries that surely are alone in theirs are not shuffled.
    """
    own = classes.select(F.col("set").alias("copied"), F.col("doc").alias("first"))
    copies = prefixes.select("set", "doc").join(own, F.col("set") == F.col("copied"))
    copies = copies.where(~F.col("doc").eqNullSafe(F.col("first"))).select("copied", F.col("doc").alias("copy")).distinct()
    same = (F.col("set") == F.col("copied")) & F.col("doc").eqNullSafe(F.col("copy"))
    single = prefixes.where("n > 0").join(broadcast_if_small(settled(copies)), same, "left_anti")
    single = single.select("set", "n", "marks")
    first = F.slice("marks", F.lit(1), _first_marks(percent).cast("int"))
    lists = single.select(F.explode(first).alias("mark")).groupBy("mark").agg(F.count("*").alias("members"))
    shared = settled(lists.where("members > 1").select("mark"))
    table = bit_table(F.col("mark"), shared, BITS)
    listed = "mark long, set long, n int, pos int, before long"
    entries = single.mapInArrow(_entries(table, percent), listed)
    return entries.join(shared, "mark", "left_semi")


def _first_marks(percent: int) -> Column:
    """How many marks of a set of length n hold one that a linked set has among its own."""
    return F.col("n") - F.ceil(F.col("n") * percent / 100) + 1


def _entries(table: np.ndarray, percent: int) -> Callable:
    """The entries of sets whose mark is in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, lengths, lists = batch.columns
            marks = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = lengths.to_numpy(zero_copy_only=False)
            pos = np.arange(len(marks)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = lengths + (-percent * lengths) // 100 + 1
            kept = np.flatnonzero((pos < np.repeat(first, sizes)) & is_set(table, marks))
            before = np.where(pos > 0, np.roll(marks, 1), -1)[kept]
            of = np.repeat(np.arange(len(sizes)), sizes)[kept]
            columns = [
                pa.array(marks[kept]),
                sets.take(pa.array(of)),
                pa.array(lengths[of].astype(np.int32)),
                pa.array(pos[kept].astype(np.int32)),
                pa.array(before),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["mark", "set", "n", "pos", "before"])

    return run


def _joined(labels: DataFrame, linked: DataFrame) -> tuple[DataFrame, int]:
    """Labels after links between sets, and how many links between components there were.

    Components are one node each, so only what changes is followed.
    """
    one = labels.withColumnRenamed("label", "one")
    two = labels.select(F.col("set").alias("other"), F.col("label").alias("two"))
    edges = linked.join(one, "set").join(two, "other").where("one <> two").select("one", "two").distinct()
    edges = settled(edges)
    links = edges.count()
    if not links:
        return labels, 0
    after = connected(edges).select(F.col("node").alias("label"), F.col("label").alias("new"))
    moved = labels.join(after, "label", "left").select("set", F.coalesce("new", "label").alias("label"))
    return settled(moved), links


def connected(edges: DataFrame) -> DataFrame:
    """Nodes of the edges (two columns) with labels that are equal exactly if edges connect them: node, label.

    Each round a node takes the smallest label next to it, and then the label of the node of that name.
    """
    both = settled(edges.toDF("node", "other").union(edges.toDF("other", "node").select("node", "other")).distinct())
    labels = settled(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    while True:
        near = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        near = both.join(near, "other").groupBy("node").agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        after = lower.join(jump, "new").select("node", F.least("new", "far").alias("label"), F.col("label").alias("old"))
        after = settled(after)
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels


def _still_open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of lists that hold more than one component, with their components."""
    entries = entries.select("mark", "set", "n", "pos", "before").join(labels, "set")
    lists = entries.groupBy("mark").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    return entries.join(lists.where("least <> most").select("mark"), "mark")


def _pivot_pairs(entries: DataFrame, step: int, percent: int) -> DataFrame:
    """Every entry with the pivot of its block, another one in each round.

    The first pivot is the set with the fewest marks before this one: of a group of copies the one with the fewest changes of
    its own. It links to copies that differ too much from each other, which any other pivot leaves to be compared in pairs.
    """
    entries = entries.withColumn("block", _block(percent))
    changes = F.lit(0) if step else F.col("pos")
    order = F.struct(changes.alias("c"), F.xxhash64("set", F.lit(step)).alias("o"), "set", "n", "pos", "label")
    pivots = entries.groupBy("mark", "block").agg(F.min(order).alias("p"))
    pivots = pivots.select("mark", "block", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("set", "n", "pos", "label")])
    return _open_pairs(entries.join(pivots, ["mark", "block"]), percent)


def _block(percent: int) -> Column:
    """Steps of the logarithm of the length: similar lengths lie in the same block or in the next."""
    return F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) * 0.999).cast("int")


def _all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list between components; blocks of lengths that are too far apart do not meet.

    Each entry is a candidate in its own block and in the one above it, as the shorter set only if its position leaves
    room for a set of its own length. Sets that also share the mark before this one meet there, and not here again.
    """
    block = _block(percent)
    columns = ("set", "n", "pos", "before", "label")
    ahead = (100 + percent) * (F.col("n") - F.col("pos")) >= 2 * percent * F.col("n")
    left = entries.where(ahead).select("mark", *columns, F.explode(F.array(block, block + 1)).alias("block"))
    right = entries.select("mark", block.alias("block"), *[F.col(c).alias(f"p_{c}") for c in columns])
    # Each pair once: the shorter set, of equal lengths the one with the smaller id, comes from the left.
    once = (F.col("n") < F.col("p_n")) | ((F.col("n") == F.col("p_n")) & (F.col("set") < F.col("p_set")))
    new = (F.col("before") < 0) | (F.col("before") != F.col("p_before"))
    return _open_pairs(left.join(right, ["mark", "block"]).where(once & new), percent)


def _open_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Each pair once, smaller set id first."""
    smaller = F.col("set") < F.col("p_set")
    return (
        pairs.where((F.col("label") != F.col("p_label")) & _room(percent))
        .select(
            F.when(smaller, F.col("set")).otherwise(F.col("p_set")).alias("set"),
            F.when(smaller, F.col("p_set")).otherwise(F.col("set")).alias("other"),
            F.when(smaller, F.col("n")).otherwise(F.col("p_n")).alias("n"),
            F.when(smaller, F.col("p_n")).otherwise(F.col("n")).alias("m"),
        )
        .distinct()
    )


def _room(percent: int) -> Column:
    """Whether lengths and positions leave room for the overlap that a link takes.

    The first shingle that two linked sets share stands in both prefixes, and all others they share stand behind it.
    """
    rest = F.least(F.col("n") - F.col("pos"), F.col("p_n") - F.col("p_pos"))
    near = F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * percent
    return near & ((100 + percent) * rest >= percent * (F.col("n") + F.col("p_n")))


def _similar(overlap: str, n: str, m: str, percent: int) -> Column:
    return F.col(overlap) * (100 + percent) >= (F.col(n) + F.col(m)) * percent


def _skip_known(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs that what is known leaves open.

    Known pairs go. For a third set whose overlaps with both are known, the two share at most the smaller of these
    overlaps inside it, and at most the smaller of their rests outside it.
    """
    both = known.union(known.select("other", "set", F.col("m").alias("n"), F.col("n").alias("m"), "overlap"))
    first = both.select("set", F.col("other").alias("third"), F.col("overlap").alias("a"))
    second = both.select(F.col("set").alias("other"), F.col("other").alias("third"), F.col("overlap").alias("b"))
    bound = F.least("a", "b") + F.least(F.col("n") - F.col("a"), F.col("m") - F.col("b"))
    closed = (
        pairs.join(first, "set")
        .join(second, ["other", "third"])
        .where(bound * (100 + percent) < (F.col("n") + F.col("m")) * percent)
        .select("set", "other")
    )
    closed = closed.union(known.select("set", "other"))
    return pairs.join(closed, ["set", "other"], "left_anti")


def _common_marks(pairs: DataFrame, prefixes: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose prefixes share as many marks as those of similar sets do.

    Two sets that share enough also share 1 + k marks if both prefixes are longer by k than the first shared one
    takes. A common line or passage makes a pair, but rarely so many marks. Marks of a set that are alike in the bits
    kept of them count once, so a set with such marks needs as many less.
    """
    members = pairs.select("set").union(pairs.select("other")).distinct().join(classes.select("set", "doc"), "set")
    ids = settled(members)
    marks = prefixes.select("set", "doc", "marks").join(
        broadcast_if_small(ids).withColumnsRenamed({"set": "wanted", "doc": "from"}),
        (F.col("set") == F.col("wanted")) & F.col("doc").eqNullSafe(F.col("from")),
        "left_semi",
    )
    joined = _with_both(pairs, _once(marks.select("set", "marks"), ids))
    least = 1 + F.floor(F.least("n", "m") / MORE)
    alike = F.size("ones") - F.size(F.array_distinct("ones"))
    joined = joined.where(
        (F.size(F.array_intersect("ones", "others")) >= least)
        | ((alike > 0) & (F.size(F.array_intersect("ones", "others")) + alike >= least))
    )
    return joined.select("set", "other", "n", "m")


def _overlaps(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Pairs with the number of shingles both sets hold; sets are read again for their members only."""
    members = settled(pairs.select("set").union(pairs.select("other")).distinct().join(classes.select("set", "doc"), "set"))
    ids = broadcast_if_small(settled(members.select(F.col("doc").alias("wanted")).distinct()))
    chosen = texts.join(ids, F.col("doc").eqNullSafe(F.col("wanted")), "left_semi")
    sets = chosen.mapInArrow(_each(_set_row, size), "doc long, set long, marks array<long>")
    own = broadcast_if_small(members).select(F.col("set").alias("a"), F.col("doc").alias("b"))
    sets = sets.join(own, (F.col("set") == F.col("a")) & F.col("doc").eqNullSafe(F.col("b")), "left_semi")
    sets = sets.select("set", "marks")
    shared = F.size(F.array_intersect("ones", "others")).cast("long")
    joined = _with_both(pairs, _once(sets, members))
    return joined.select("set", "other", "n", "m", shared.alias("overlap"))


def _once(sets: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each of the members; there are more only where whole rows are repeated."""
    sets = settled(sets)
    return settled(sets.dropDuplicates(["set"])) if sets.count() > members.count() else sets


def _with_both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with the marks of both sets. Both sides rename both columns, so that one shuffle of the sets serves both."""
    one = sets.select(F.col("set").alias("a"), F.col("marks").alias("ones"))
    two = sets.select(F.col("set").alias("b"), F.col("marks").alias("others"))
    return pairs.join(one, F.col("set") == F.col("a")).join(two, F.col("other") == F.col("b"))


def _weights(texts: DataFrame, size: int) -> np.ndarray:
    """How often shingles occur, by the last bits of their hashes: a table of fixed size, summed in packed chunks."""
    chunks = (
        texts.select("text")
        .mapInArrow(_count_rows(size), "chunk int, counts binary")
        .groupBy("chunk")
        .applyInPandas(_add_chunks, "chunk int, counts binary")
        .collect()
    )
    weights = np.zeros((COUNTERS // CHUNK, CHUNK), np.int64)
    for row in chunks:
        weights[row["chunk"]] = _unpacked(row["counts"])
    return weights.ravel()


def _count_rows(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            held, n = [np.zeros(0, np.int64)], 0
            for marks in sets_of(batch.column(0), size):
                held.append(_slots(marks))
                n += len(marks)
                if n > COUNTERS:
                    counts += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, n = [np.zeros(0, np.int64)], 0
            counts += np.bincount(np.concatenate(held), minlength=COUNTERS)
        packed = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(-1, CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(packed)), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "counts"]
        )

    return run


def _add_chunks(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CHUNK, np.int64)
    for counts in rows["counts"]:
        total += _unpacked(counts)
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(bytes(counts)), np.int64)


def _slots(marks: np.ndarray) -> np.ndarray:
    return (marks & np.uint64(COUNTERS - 1)).astype(np.int64)


def _each(row: Callable, size: int, *more) -> Callable:
    """A function for mapInArrow that makes a row of each document from its id and its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_pylist()
            rows, held = [], 0
            for doc, marks in zip(docs, sets_of(batch.column(1), size), strict=True):
                rows.append(row(doc, marks, *more))
                held += len(rows[-1]["marks"])
                if held > 1_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[dict]) -> pa.RecordBatch:
    lists = [r["marks"] for r in rows]
    ends = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    marks = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).view(np.int64)))
    names = [c for c in rows[0] if c != "marks"]
    return pa.RecordBatch.from_arrays(
        [*(pa.array([r[c] for r in rows], pa.int64()) for c in names), marks], [*names, "marks"]
    )


def _prefix_row(doc: int | None, marks: np.ndarray, weights: np.ndarray, percent: int) -> dict:
    """The set's id and size, and its prefix with rare shingles first.

    Of the marks 40 bits go into the lists: sets that share these by chance are told apart when they are compared.
    """
    n = len(marks)
    order = np.lexsort((marks, weights[_slots(marks)]))
    prefix = marks[order[: n - -(-percent * n // 100) + 1 + n // MORE]]
    return {"doc": doc, "set": set_id(marks), "n": n, "marks": prefix >> np.uint64(24)}


def _set_row(doc: int | None, marks: np.ndarray) -> dict:
    return {"doc": doc, "set": set_id(marks), "marks": marks}
