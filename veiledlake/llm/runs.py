"""Periodic runs of words by an online sparse diagonal DP."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import add_columns, ship

MIN_WORDS = 24
MIN_REPEATS = 3
COLUMNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
KINDS = (
    pa.int64(),
    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
    pa.string(),
)


class Run(NamedTuple):
    start: int
    length: int
    period: int


def find_runs(
    docs: DataFrame, *, text: str = "text", min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> DataFrame:
    """All rows and columns with `n_words`, the `runs` of the whole text, and `collapsed`, the text without repeats.

    Words are what white space (space, \\t to \\r) separates. A run is a stretch of words with smallest period q, of at
    least max(min_words, min_repeats * q) words, that no neighbouring word extends; runs come by start, then period.
    `collapsed` joins by one space the words that no run holds after its first q words.

    Null, empty and blank texts have 0 words, no runs and an empty `collapsed`. Each row is looked at by itself, so
    repeated rows and null ids make no difference. Columns named like the three results are replaced. A row needs
    memory in proportion to its text, and time in proportion to it times its logarithm; nothing is shuffled.
    """
    if min_repeats < 3:
        raise ValueError("blocks are sure to find runs that hold their period three times or more")
    ship(docs.sparkSession)

    def found(texts: pa.Array) -> list[pa.Array]:
        rows = [_row(t, min_words, min_repeats) for t in texts.cast(pa.large_binary()).to_pylist()]
        return [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), KINDS, strict=True)]

    return add_columns(docs, [text], COLUMNS, found)


def longest_run(runs: str) -> Column:
    """The run with the greatest exponent (length by period); of equals the first, then that of the smallest period.

    Exponents are compared exactly, by cross-multiplication. Null if there is none.
    """

    def better(a: Column, b: Column) -> Column:
        one, two = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
        return F.when((two > one) | ((two == one) & earlier), b).otherwise(a)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def _row(text: bytes | None, min_words: int, min_repeats: int) -> tuple[int, list[dict], str]:
    words = (text or b"").split()
    runs = sorted(runs_of(words, min_words, min_repeats))
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for run in runs:
            gone[run.start + run.period] += 1
            gone[run.start + run.length] -= 1
        kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
        collapsed = b" ".join([words[i] for i in kept])
    else:
        collapsed = b" ".join(words)
    return len(words), [run._asdict() for run in runs], collapsed.decode()


def runs_of(words: list, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> Iterator[Run]:
    """The runs of a list of words, shortest scale first.

    The plain DP holds a match length for each lag at which the present word stood before; a frequent word has a lag for
    each earlier occurrence, which is quadratic. What a run needs is less. At lag q its words match over so long a
    stretch that a block of k >= q words fits in, and inside the run such a block stood last exactly q words before (a
    nearer occurrence would give the run a smaller period). So at each scale k, a power of two, a word has one lag: that
    of the last occurrence of the block of k words that ends with it. While the lag stays, its match length grows with
    each word; where it changes the diagonal ends, and is emitted if long enough. Lags from k/2 to k belong to scale k,
    smaller ones only to the first scale.

    Blocks are named by the names of their halves, so equal names are equal words. Blocks that stand once are left out,
    and after the first scales hardly any are left in texts without repeats.
    """
    names: dict = {}
    name = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    first = _first_scale(min_words, min_repeats)
    at, name = _repeated(np.arange(len(words)), name)
    k = 1
    while len(at) and (k <= first or min_repeats * (k // 2 + 1) <= len(words)):
        if k >= first:
            yield from _diagonals(at, name, k, 0 if k == first else k // 2, min_words, min_repeats)
        at, name = _doubled(at, name, k, len(words))
        k *= 2


def _first_scale(min_words: int, min_repeats: int) -> int:
    """The greatest power of two whose blocks fit into the matches of all runs with a period of up to k.

    A run of length L has blocks of k words with an earlier occurrence at lag q if L >= k + q.
    """
    k = 1
    while all(max(min_words, min_repeats * q) >= 2 * k + q for q in range(1, 2 * k + 1)):
        k *= 2
    return k


def _repeated(at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, name, counts = np.unique(name, return_inverse=True, return_counts=True)
    more = counts[name] > 1
    return at[more], name[more]


def _doubled(at: np.ndarray, name: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of twice the size that stand more than once: where they start, and their names."""
    names = np.full(n + k, -1, np.int64)
    names[at] = name
    second = names[at + k]
    both = second >= 0
    return _repeated(at[both], name[both] * n + second[both])


def _diagonals(
    at: np.ndarray, name: np.ndarray, k: int, above: int, min_words: int, min_repeats: int
) -> Iterator[Run]:
    """Runs whose period is over `above` and up to k, from the last occurrences of blocks of k words."""
    order = np.argsort(name, kind="stable")
    again = np.flatnonzero(name[order][1:] == name[order][:-1]) + 1
    lag = np.zeros(len(at), np.int64)
    lag[order[again]] = at[order[again]] - at[order[again - 1]]
    goes_on = (np.diff(at) == 1) & (np.diff(lag) == 0)
    begins = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    ends = np.append(begins[1:], len(at)) - 1
    length = at[ends] - at[begins] + k + lag[begins]
    enough = np.maximum(min_words, min_repeats * lag[begins])
    for i in np.flatnonzero((lag[begins] > above) & (lag[begins] <= k) & (length >= enough)):
        q = int(lag[begins[i]])
        yield Run(int(at[begins[i]]) - q, int(length[i]), q)

