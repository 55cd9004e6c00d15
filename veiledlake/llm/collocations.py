"""Phrase collocation mining by direct-address tiles of frequency-ranked ids."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veiledlake.llm.common import bit_table, broadcast_if_small, is_set, settled, ship
from veiledlake.llm.shingles import ANY_CASE, hashed_words, mix, parts

LONGEST = 3
LEAST = 10
HELD_PERCENT = 50
TOP = 2000
NO_LANG = "und"
# Tables of phrases up to this size are broadcast: several are at once.
SMALL = 8 << 20
# Ids below this have tiles, each of so many ids a side.
RANKED = 4096
TILE = 512
# A part of the text counts a tile densely if it holds one pair for so many cells; else as a sorted list.
DENSE = 16
# Rows of sorted lists that a task holds.
HELD_ROWS = 1 << 19
# Bits of the table that tells which phrases may be frequent: its size is fixed, and what it lets pass is counted.
BITS = 26
_TURN = 21

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    held_percent: int = HELD_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """The best phrases of 2 to `longest` words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, with A-Z in lower case, are cut into pieces at .,;:!? and \\n to \\r, and pieces into words at spaces and tabs.
    A phrase lies inside a piece. It is a candidate if it occurs at least `least` times (a) in its language. Cut into two
    parts that occur l and r times its score is floor(1000000 a a / (l r)); the cut with the lowest score counts, of
    equals the one with the shorter first part. A candidate goes if a longer candidate holds its words and occurs at
    least `held_percent` percent as often. `n` is the number of words of the language. The first `top` come by score,
    then a, both descending, then by the bytes of the phrase.

    Null texts are empty, a null language is `und`. Repeated rows count each time; other columns are not looked at, and
    an empty table gives no rows.

    Words are known by 64-bit keys, made of the language too; the whole vocabulary is checked for equal keys, and
    counted with other keys if there are any. Phrases are counted level by level: only where both shorter phrases in it
    may be frequent does a longer one count. The most frequent phrases of a level get ids by rank, the first word of the
    next level's pairs; pairs of such ids are counted in tiles by `bincount`, others in sorted lists. A task adds up its
    parts of the text and emits sums, so a phrase that fills the corpus is one row per task in the shuffle.
    """
    ship(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).cast("string").alias("text")
    )
    words, totals, seed = _vocabulary(texts, least)
    levels = [words.select(F.col("w1"), "a")]
    for size in range(2, longest + 1):
        count = _counter(size, seed, _ranked(levels[0]), _ranked(levels[-1]), _bits(levels[-1]))
        columns = [f"w{i + 1}" for i in range(size)]
        rows = texts.mapInArrow(count, ", ".join(f"{c} long" for c in [*columns, "a"]))
        sums = rows.groupBy(*columns).agg(F.sum("a").alias("a"))
        levels.append(settled(sums.where(F.col("a") >= least)))
    found = [_scored(levels, size, words, held_percent) for size in range(2, longest + 1)]
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order).cast("long"))
    best = best.where(F.col("rank") <= top).join(F.broadcast(totals), "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _vocabulary(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """Words that occur often enough (lang, word, w1, a), words per language, and the seed that tells all words apart."""
    seed = 0
    while True:
        rows = texts.mapInArrow(_words(seed), "lang string, w1 long, word string, a long")
        found = settled(rows.groupBy("lang", "w1", "word").agg(F.sum("a").alias("a")))
        if found.groupBy("w1").count().where("count > 1").isEmpty():
            break
        seed += 1
    totals = settled(found.groupBy("lang").agg(F.sum("a").alias("n")))
    return settled(found.where(F.col("a") >= least)), totals, seed


def _ranked(level: DataFrame) -> list[np.ndarray]:
    """The most frequent phrases of a level, columns of keys by descending frequency: a list of bounded length."""
    keys = [c for c in level.columns if c != "a"]
    rows = level.orderBy(F.desc("a"), *keys).select(keys).limit(RANKED).toArrow()
    return [rows[c].to_numpy().astype(np.int64) for c in keys]


def _bits(level: DataFrame) -> np.ndarray:
    """Bits that are set where a phrase of the level falls."""
    keys = [c for c in level.columns if c != "a"]
    mixed = reduce(lambda a, b: a.bitwiseXOR(b), [_turned(F.col(c), i) for i, c in enumerate(keys)])
    return bit_table(mixed, level, BITS)


def _turned(key: Column, i: int) -> Column:
    """A key with its bits turned, by another number at each place in a phrase."""
    by = _TURN * i % 64
    return F.shiftleft(key, by).bitwiseOR(F.shiftrightunsigned(key, 64 - by)) if by else key


def _may_be(keys: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
    mixed = np.zeros(len(keys[0]), np.uint64)
    for i, key in enumerate(keys):
        key, by = key.view(np.uint64), _TURN * i % 64
        mixed ^= (key << np.uint64(by)) | (key >> np.uint64(64 - by)) if by else key
    return is_set(bits, mixed)


def _scored(levels: list[DataFrame], size: int, words: DataFrame, held_percent: int) -> DataFrame:
    """Candidates of a size that no longer one holds, with their score: lang, phrase, a, l, r, score."""
    keys = [f"w{i + 1}" for i in range(size)]
    rows = levels[size - 1]
    if size < len(levels):
        longer, more = levels[size], f"w{size + 1}"
        sides = longer.select(*keys, F.col("a").alias("around")).union(
            longer.select(*[F.col(c).alias(k) for k, c in zip(keys, [*keys[1:], more], strict=True)], "a")
        )
        held = settled(sides.groupBy(*keys).agg(F.max("around").alias("around")))
        rows = rows.join(broadcast_if_small(held, SMALL), keys, "left")
        rows = rows.where(F.col("around").isNull() | (100 * F.col("around") < held_percent * F.col("a")))
        rows = rows.drop("around")
    for i, key in enumerate(keys):
        word = words.select(F.col("w1").alias(key), F.col("word").alias(f"word{i}"), *(["lang"] if i == 0 else []))
        rows = rows.join(broadcast_if_small(word, SMALL), key)
    cuts = []
    for k in range(1, size):
        for side, part in ((f"l{k}", keys[:k]), (f"r{k}", keys[k:])):
            level = levels[len(part) - 1]
            known = level.select(*[F.col(f"w{i + 1}").alias(c) for i, c in enumerate(part)], F.col("a").alias(side))
            rows = rows.join(broadcast_if_small(known, SMALL), part)
        wide = "cast({} as decimal(18,0))".format
        score = F.expr(f"(cast(1000000 * {wide('a')} as decimal(25,0)) * cast(a as decimal(13,0))) div ({wide(f'l{k}')} * {wide(f'r{k}')})")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
    phrase = F.concat_ws(" ", *[f"word{i}" for i in range(size)])
    return rows.select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def _keys(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each part of a batch its bytes and borders, and for each word its key, start, stop, text and piece."""
    langs = batch.column(0).dictionary_encode()
    salts = np.array(
        [int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs.dictionary.to_pylist()],
        np.uint64,
    )
    salts, first = salts[langs.indices.to_numpy()], 0
    for data, ends in parts(batch.column(1)):
        hashes, starts, stops = hashed_words(data, ends, _letters(seed), _GAP)
        row = np.searchsorted(ends, starts, "right") - 1 + first
        edges = _BREAK[data].astype(np.int64)
        np.add.at(edges, ends[:-1][ends[:-1] < len(data)], 1)
        yield data, ends, mix(hashes ^ salts[row]).view(np.int64), starts, stops, row, np.cumsum(edges)[starts]
        first += len(ends) - 1


def _letters(seed: int) -> np.ndarray:
    return mix(ANY_CASE + np.uint64(seed)) if seed else ANY_CASE


def _words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends, keys, starts, stops, row, _ in _keys(batch, seed):
                # Words that fall together by this seed's keys hardly do so by the next one's.
                other, _, _ = hashed_words(data, ends, _letters(seed + 1), _GAP)
                order = np.lexsort((other, keys))
                new = (np.diff(keys[order], prepend=0) != 0) | (np.diff(other[order], prepend=0) != 0)
                new[:1] = True
                first = np.flatnonzero(new)
                at, counts = order[first], np.diff(first, append=len(keys))
                words = [data[starts[i] : stops[i]].tobytes().lower().decode() for i in at]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row[at])), pa.array(keys[at]), pa.array(words, pa.string()), pa.array(counts)],
                    ["lang", "w1", "word", "a"],
                )

    return run


def _counter(size: int, seed: int, words: list[np.ndarray], prefixes: list[np.ndarray], bits: np.ndarray):
    """Counts phrases of a size in a task: pairs of a shorter phrase and the word after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Tiles(prefixes, words)
        for batch in batches:
            for _, _, keys, _, _, _, piece in _keys(batch, seed):
                n = len(keys) - size + 1
                if n < 1:
                    continue
                grams = [keys[i : i + n] for i in range(size)]
                good = piece[:n] == piece[size - 1 :]
                good &= _may_be(grams[:-1], bits) & _may_be(grams[1:], bits)
                counts.add([g[good] for g in grams])
                if counts.held > HELD_ROWS:
                    yield counts.listed()
        yield counts.listed()
        yield counts.tiled()

    return run


class Tiles:
    """Counts of phrases: dense tiles where a shorter phrase and the next word have ids by rank, else sorted lists."""

    def __init__(self, prefixes: list[np.ndarray], words: list[np.ndarray]) -> None:
        self.prefixes, self.words = prefixes, words
        self.sides = _Ids(prefixes), _Ids(words)
        self.dense: dict[int, np.ndarray] = {}
        self.lists: list[np.ndarray] = []
        self.held = 0

    def add(self, phrases: list[np.ndarray]) -> None:
        first, last = self.sides[0].of(phrases[:-1]), self.sides[1].of(phrases[-1:])
        across = -(-RANKED // TILE)
        tile = np.where((first >= 0) & (last >= 0), first // TILE * across + last // TILE, -1)
        sizes = np.bincount(tile + 1, minlength=across * across + 1)[1:]
        dense = (sizes * DENSE >= TILE * TILE) | np.isin(np.arange(len(sizes)), list(self.dense))
        for t in np.flatnonzero(dense & (sizes > 0)):
            inside = tile == t
            cells = first[inside] % TILE * TILE + last[inside] % TILE
            counted = np.bincount(cells, minlength=TILE * TILE)
            self.dense[t] = self.dense[t] + counted if t in self.dense else counted
        sparse = (tile < 0) | ~dense[tile]
        self.lists.append(_summed([*(p[sparse] for p in phrases), np.ones(sparse.sum(), np.int64)]))
        self.held += len(self.lists[-1][0])

    def listed(self) -> pa.RecordBatch:
        """The sums of the sorted lists, which are then forgotten."""
        empty = [np.zeros(0, np.int64)] * (len(self.prefixes) + 2)
        rows = _summed([np.concatenate(c) for c in zip(empty, *self.lists, strict=True)])
        self.lists, self.held = [], 0
        return _batch(rows)

    def tiled(self) -> pa.RecordBatch:
        across, rows = -(-RANKED // TILE), [[np.zeros(0, np.int64)] * (len(self.prefixes) + 2)]
        for t, counts in self.dense.items():
            cells = np.flatnonzero(counts)
            first, last = t // across * TILE + cells // TILE, t % across * TILE + cells % TILE
            rows.append([*(p[first] for p in self.prefixes), self.words[0][last], counts[cells]])
        return _batch([np.concatenate(c) for c in zip(*rows, strict=True)])


class _Ids:
    """Ids by rank of the phrases that have one."""

    def __init__(self, ranked: list[np.ndarray]) -> None:
        self.ranked, self.sorted = ranked, np.argsort(_one_key(ranked))
        self.keys = _one_key(ranked)[self.sorted]

    def of(self, phrases: list[np.ndarray]) -> np.ndarray:
        """The id of each phrase, -1 if it has none."""
        if not len(self.keys):
            return np.full(len(phrases[0]), -1)
        at = self.sorted[np.minimum(np.searchsorted(self.keys, _one_key(phrases)), len(self.keys) - 1)]
        same = np.logical_and.reduce([r[at] == p for r, p in zip(self.ranked, phrases, strict=True)])
        return np.where(same, at, -1)


def _one_key(keys: list[np.ndarray]) -> np.ndarray:
    found = keys[0].view(np.uint64)
    for key in keys[1:]:
        found = mix(found) ^ key.view(np.uint64)
    return found


def _summed(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of keys and counts (the last column) in order of their keys, one for each phrase."""
    *keys, counts = rows
    if not len(counts):
        return rows
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    new = np.logical_or.reduce([np.diff(k, prepend=k[0] - 1 if k[0] > 0 else k[0] + 1) != 0 for k in keys])
    at = np.flatnonzero(new)
    return [*(k[at] for k in keys), np.add.reduceat(counts[order], at)]


def _batch(rows: list[np.ndarray]) -> pa.RecordBatch:
    names = [*(f"w{i + 1}" for i in range(len(rows) - 1)), "a"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names)
