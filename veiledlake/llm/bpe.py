"""Byte-level BPE: Spark's higher-order functions fold the merges of distinct words.

Words that are frequent in the corpus are encoded so, once each. Encoding every other word where it stands in the same
way takes too long, as is measured in the README; such words are merged by a small helper on Arrow batches.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterable
from itertools import islice
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import add_columns, settled, ship

# A rank that stands for "no merge".
NONE = 2**31 - 1
# Small maps that a literal is dealt out to: looking up in a map goes through its entries.
RANK_SLOTS = 1 << 14
# The words that are encoded once: at most so many, of at most so many bytes, which bounds the map.
FREQUENT_WORDS = 1 << 15
FREQUENT_BYTES = 48
# Bits of a number that one job looks at to find the bound of the most frequent words.
DIGIT = 12
# Other words that a task remembers until it starts anew, and words of a text that it holds at once.
REMEMBERED = 400_000
HELD = 200_000
PLAN_TEXT = "spark.sql.maxPlanStringLength"
# Longer words are merged by a heap.
LONG = 200
# White space as in Unicode; Java's \s knows ASCII only.
SPACES = r"\t-\r \x85\xA0  -     　"


class Vocabulary:
    """Ranks of a vocabulary file, one line "base64 rank" for each piece, as literal maps."""

    def __init__(self, path: str, pattern: str) -> None:
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.pattern = java_pattern(pattern)
        entries = [(piece.hex().upper(), rank) for piece, rank in self.ranks.items()]
        self._slots = _literal(entries, RANK_SLOTS, "array<map<string,int>>")

    def words(self, text: str) -> Column:
        return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(self.pattern), F.lit(0))

    def encode_word(self, word: Column) -> Column:
        """Ids of one word: a fold over as many merges as there can be, the lowest rank first, the leftmost of equals.

        The ranks stand in the plan once, whatever they are looked up for.
        """
        return _let(self._slots, lambda slots: _Fold(slots).ids(F.hex(word)))

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for: their pieces, joined."""
        pieces = {rank: piece for piece, rank in self.ranks.items()}

        @F.pandas_udf("binary")
        def joined(rows: pd.Series) -> pd.Series:
            return rows.map(lambda r: b"".join(map(pieces.__getitem__, r.tolist())))

        return joined(ids)


class _Fold:
    """The merges of a word by ranks that are a column; the state holds the pieces and the rank of each neighbouring pair."""

    def __init__(self, slots: Column) -> None:
        self.slots = slots

    def rank(self, piece: Column) -> Column:
        """The rank of a piece in hexadecimal digits; null if there is none."""
        return F.element_at(F.get(self.slots, _slot(piece, RANK_SLOTS)), piece)

    def ids(self, digits: Column) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(1), F.length(digits), F.lit(2)), lambda i: F.substring(digits, i, F.lit(2))
        )
        merges = _let(pieces, lambda p: F.aggregate(p, self._start(p), self._step, lambda s: s["p"]))
        folded = F.transform(merges, self.rank)
        return _let(self.rank(digits), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(folded))

    def _start(self, p: Column) -> Column:
        pairs = F.transform(F.slice(p, F.lit(2), F.size(p)), lambda x, i: F.concat(F.get(p, i), x))
        return F.struct(p.alias("p"), self._ranks(pairs).alias("r"))

    def _ranks(self, pairs: Column) -> Column:
        return F.transform(pairs, lambda x: F.coalesce(self.rank(x), F.lit(NONE)))

    def _step(self, s: Column, _: Column) -> Column:
        best = F.array_min(s["r"])
        return F.when(F.coalesce(best, F.lit(NONE)) == NONE, s).otherwise(
            _let(F.array_position(s["r"], best).cast("int"), lambda j: self._merge(s["p"], s["r"], j))
        )

    def _merge(self, p: Column, r: Column, j: Column) -> Column:
        one = F.concat(F.element_at(p, j), F.element_at(p, j + 1))
        none = F.array().cast("array<string>")
        pairs = F.concat(
            F.when(j > 1, F.array(F.concat(F.get(p, j - 2), one))).otherwise(none),
            F.when(j + 2 <= F.size(p), F.array(F.concat(one, F.get(p, j + 1)))).otherwise(none),
        )
        left = F.concat(F.slice(p, F.lit(1), j - 1), F.array(one), F.slice(p, j + 2, F.size(p)))
        ranks = F.concat(
            F.slice(r, F.lit(1), F.greatest(j - 2, F.lit(0))), self._ranks(pairs), F.slice(r, j + 2, F.size(p))
        )
        return F.struct(left.alias("p"), ranks.alias("r"))


def frequent_words(
    docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text", most: int = FREQUENT_WORDS
) -> dict[str, list[int]]:
    """The most frequent words of all documents with their ids, encoded once each.

    Of words of the same frequency those with the greater hash are taken. It only saves work: any other word is encoded
    where it stands.
    """
    counts = (
        docs.select(F.explode_outer(vocabulary.words(text)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("word").isNotNull() & (F.col("n") > 1) & (F.octet_length("word") <= FREQUENT_BYTES))
    )
    counts = settled(counts.withColumn("place", F.pmod(F.xxhash64("word"), F.lit(1 << 3 * DIGIT))))
    highest = counts.agg(F.max("n")).first()[0] or 0
    above, taken = _above(counts, "n", highest, most)
    equal = counts.where(F.col("n") == above)
    place, _ = _above(equal, "place", (1 << 3 * DIGIT) - 1, most - taken)
    chosen = counts.where((F.col("n") > above) | ((F.col("n") == above) & (F.col("place") > place)))
    chosen = chosen.select("word", vocabulary.encode_word(F.col("word")).alias("ids"))
    # The plan holds the rank map: its text would fill the driver.
    spark = docs.sparkSession
    before = spark.conf.get(PLAN_TEXT)
    spark.conf.set(PLAN_TEXT, "20000")
    try:
        return {r["word"]: r["ids"] for r in chosen.collect()}
    finally:
        spark.conf.set(PLAN_TEXT, before)


def _above(counts: DataFrame, key: str, highest: int, most: int) -> tuple[int, int]:
    """The smallest number that at most `most` rows have a key above, and how many rows these are; -1 if all fit.

    It is found digit by digit, so that the driver gets a list of bounded length whatever the counts are.
    """
    bound, taken = 0, 0
    digits = max(1, -(-highest.bit_length() // DIGIT))
    for shift in range((digits - 1) * DIGIT, -1, -DIGIT):
        inside = counts.where(F.shiftright(key, shift + DIGIT) == bound)
        steps = inside.groupBy(F.shiftright(key, shift).alias("step")).agg(F.count("*").alias("words")).collect()
        for step, found in sorted(((r["step"], r["words"]) for r in steps), reverse=True):
            if taken + found > most:
                bound = step
                break
            taken += found
        else:
            return -1, taken
    return bound, taken


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    *,
    text: str = "text",
    ids: str = "ids",
    packed: str | None = None,
    decoded: str | None = None,
    most: int = FREQUENT_WORDS,
) -> DataFrame:
    """All rows and columns with the token ids of the whole text; columns named like the results are replaced.

    Every match of the vocabulary's pattern is a word and is encoded by itself. Null and empty texts have no ids.
    A word of any length is encoded. Names for `packed` and `decoded` ask for more columns: the ids as unsigned 32-bit
    numbers, lowest byte first, and the bytes that they stand for, their pieces joined. A text is encoded once for all.
    """
    ship(docs.sparkSession)
    frequent, ranks, pattern = frequent_words(docs, vocabulary, text=text, most=most), vocabulary.ranks, vocabulary.pattern
    known = {word: _packed(ids) for word, ids in frequent.items()}
    pieces = {rank: piece for piece, rank in ranks.items()} if decoded else {}
    rest: dict = {}  # each task starts with its own, and keeps it for all its batches

    def encoded(texts: pa.Array) -> list[pa.Array]:
        words = regex.compile(pattern)
        rows = [_encode_text(t or "", words, known, rest, ranks) for t in texts.to_pylist()]
        ends = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
        found = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))]
        if packed:
            found.append(pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()))
        if decoded:
            found.append(pa.array([b"".join(map(pieces.__getitem__, r.tolist())) for r in rows], pa.binary()))
        return found

    kinds = {ids: "array<int>", packed: "binary", decoded: "binary"}
    added = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items() if name)
    return add_columns(docs, [F.col(text).cast("string")], added, encoded)


def _encode_text(text: str, words: regex.Pattern, known: dict, rest: dict, ranks: dict[bytes, int]) -> np.ndarray:
    if len(text) <= 4 * HELD:
        return _encode_words(words.findall(text), known, rest, ranks)
    matches, parts = words.finditer(text), []
    while some := [m[0] for m in islice(matches, HELD)]:
        parts.append(_encode_words(some, known, rest, ranks))
    return np.concatenate(parts)


def _encode_words(words: list[str], known: dict, rest: dict, ranks: dict[bytes, int]) -> np.ndarray:
    found = list(map(known.get, words))
    if None in found:
        for i, ids in enumerate(found):
            if ids is None:
                word = words[i]
                ids = rest.get(word)
                if ids is None:
                    if len(rest) >= REMEMBERED:
                        rest.clear()
                    ids = rest[word] = _packed(merged(word.encode(), ranks))
                found[i] = ids
    return np.frombuffer(b"".join(found), np.int32)


def _packed(ids: list[int]) -> bytes:
    """The ids of a word as a task remembers them: a list of numbers takes four times the memory."""
    return np.array(ids, np.int32).tobytes()


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: merges of the lowest rank first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG:
        return _merged_long(word, ranks)
    rank, cuts = ranks.get, list(range(len(word) + 1))
    pairs = [rank(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) != NONE:
        i = pairs.index(best)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank(word[cuts[i] : cuts[i + 2]], NONE)
        if i:
            pairs[i - 1] = rank(word[cuts[i - 1] : cuts[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def _merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, for words of any length."""
    end = list(range(1, len(word) + 1))  # where the piece that starts here ends; 0 once it is part of another
    before = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if start >= 0 and middle < len(word):
            rank = ranks.get(word[start : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[middle]))

    for i in range(len(word) - 1):
        offer(i)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= len(word) or end[middle] != stop:
            continue  # one of the two pieces has been merged since
        end[start], end[middle] = stop, 0
        if stop < len(word):
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    ids, at = [], 0
    while at < len(word):
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def java_pattern(pattern: str) -> str:
    """The pattern with white space spelled out, in and outside of brackets."""
    pattern = pattern.replace(r"[^\s", f"[^{SPACES}")
    return pattern.replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")


def _let(value: Column, use) -> Column:
    """A value that is computed once and used several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(slots)).cast("int")


def _literal(entries: Iterable[tuple], slots: int, kind: str) -> Column:
    maps: list[dict] = [{} for _ in range(slots)]
    for key, value in entries:
        maps[zlib.crc32(key.encode()) % slots][key] = value
    return F.from_json(F.lit(json.dumps(maps, ensure_ascii=False, separators=(",", ":"))), kind)
