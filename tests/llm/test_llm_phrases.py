"""Phrases, repeats and runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from veiledlake.llm import collocations, queries, repeats, runs

SPACED = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_collocations(docs, least, top, longest=3):
    counts = {}
    for text, lang in docs:
        found = counts.setdefault("und" if lang is None else lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                found.update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    rows = []
    for lang, f in counts.items():
        candidates = [w for w in f if len(w) > 1 and f[w] >= least]
        inner = Counter()
        for w in candidates:
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    inner[w[i : i + m]] = max(inner[w[i : i + m]], f[w])
        best = []
        for w in candidates:
            if 100 * inner[w] >= 50 * f[w]:
                continue
            cuts = [(10**6 * f[w] ** 2 // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            best.append((-score, -f[w], " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        n = sum(c for w, c in f.items() if len(w) == 1)
        rows += [
            (lang, i, p.decode(), -a, left, right, n, -s)
            for i, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)
        ]
    return sorted(rows)


def phrase_docs():
    rng = random.Random(11)
    some = ["The", "old", "sea", "é", "Émile", " x", "a\x0bb", "c-d", "it's", "end.", "stop, go", "\U0001f600"]
    docs = [(" ".join(rng.choices(some, weights=range(12, 0, -1), k=rng.randint(0, 60))), rng.choice(["en", "fr", None]))
            for _ in range(60)]
    docs += [("New York City " * 30, "en"), (None, "en"), ("", "en"), (" \t ", None), ("so so so so so so", "fr")]
    return docs + [("one two " * 4000, "long"), *[("same row again", "en")] * 20]


@pytest.mark.parametrize("least, top", [(10, 2000), (2, 40)])
def test_collocations(table, least, top):
    docs = phrase_docs()
    found = collocations.collocations(table(docs, "text string, lang string"), least=least, top=top)
    assert sorted(map(tuple, found.collect())) == plain_collocations(docs, least, top)


def test_collocations_of_longer_phrases(table):
    docs = phrase_docs()
    found = collocations.collocations(table(docs, "text string, lang string"), least=3, longest=4)
    assert sorted(map(tuple, found.collect())) == plain_collocations(docs, 3, 2000, 4)


def test_collocations_empty(table):
    assert collocations.collocations(table([], "text string, lang string")).collect() == []


def test_large_scores_are_exact(table, monkeypatch):
    """Counts of which products pass 64 bits."""
    times = 10**9 + 7
    count = collocations._counter

    def many(*args):
        run = count(*args)

        def enlarged(batches):
            for b in run(batches):
                yield b.set_column(len(b.columns) - 1, "a", collocations.pa.array(b.column(len(b.columns) - 1).to_numpy() * times))

        return enlarged

    words = collocations._words
    monkeypatch.setattr(collocations, "_counter", many)
    monkeypatch.setattr(collocations, "_words", lambda seed: many_words(words(seed), times))
    docs = [("a b c a b d a b. b a", "en")] * 5
    found = collocations.collocations(table(docs, "text string, lang string"))
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in found.collect()}
    plain = plain_collocations(docs, 1, 99)
    assert got == {p: (a * times, x * times, y * times, s) for _, _, p, a, x, y, _, s in plain}


def many_words(run, times):
    def enlarged(batches):
        for b in run(batches):
            yield b.set_column(3, "a", collocations.pa.array(b.column(3).to_numpy() * times))

    return enlarged


def test_equal_keys_are_told_apart(table, monkeypatch):
    """With keys of few bits words fall together, until a seed is found that keeps them apart."""
    keys, seeds = collocations._keys, []

    def narrow(batch, seed):
        for data, ends, key, *rest in keys(batch, seed):
            yield (data, ends, key & 0xFF if seed < 2 else key, *rest)

    words = collocations._words
    monkeypatch.setattr(collocations, "_keys", narrow)
    monkeypatch.setattr(collocations, "_words", lambda seed: seeds.append(seed) or words(seed))
    docs = [(" ".join(f"w{i}" for i in range(400)), "en")] * 3
    found = collocations.collocations(table(docs, "text string, lang string"), least=3)
    assert sorted(map(tuple, found.collect())) == plain_collocations(docs, 3, 2000)
    assert seeds == [0, 1, 2]


def test_tiles_count_like_lists(monkeypatch):
    monkeypatch.setattr(collocations, "RANKED", 64)
    monkeypatch.setattr(collocations, "TILE", 16)
    rng = np.random.default_rng(3)
    words = rng.integers(-(2**62), 2**62, 100)
    ranked = [words[:50]]
    tiles, total = collocations.Tiles(ranked, ranked), Counter()
    for _ in range(5):
        drawn = words[np.minimum(rng.geometric(0.05, 4000), 100) - 1]
        tiles.add([drawn[:-1], drawn[1:]])
        total.update(zip(drawn[:-1].tolist(), drawn[1:].tolist(), strict=True))
    assert tiles.dense and tiles.held
    found = Counter()
    for batch in (tiles.listed(), tiles.tiled()):
        for a, b, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found[a, b] += n
    assert found == total


def plain_repeats(docs):
    first = {}
    split = [(d, re.findall(SPACED, t or "")) for d, t in docs]
    for d, ws in split:
        for i in range(len(ws) - 12):
            w = tuple(ws[i : i + 13])
            if d is not None:
                first[w] = min(d, first.get(w, d))
    rows = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - 12):
            if d is not None and first[tuple(ws[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        rows.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(rows, key=str)


def test_repeats(table, monkeypatch):
    rng = random.Random(12)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randint(5, 70))) for _ in range(6)]
    docs = []
    for d in range(60):
        parts = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 30)))]
        parts += rng.sample(passages, rng.randint(0, 3)) + [f"z{rng.randint(0, 10**6)}"]
        docs.append((d * 7 % 60, " ".join(parts)))
    docs += [(100 + d, "same " * 50) for d in range(3)] + [(103, "Same " * 50), (99, passages[0] + " " + passages[0])]
    docs += [(200, None), (201, ""), (202, " \n "), (203, "a b"), (None, passages[1]), (None, None), (-5, passages[2])]
    docs += [(204, passages[3]), (204, passages[3]), (204, passages[4]), (300, "x y " * 20), (301, "x y\n" * 14)]
    docs += [(400, "q " * 20_000), (401, "q " * 20_001 + passages[5])]
    want = plain_repeats(docs)
    for broadcast in (True, False):
        if not broadcast:
            monkeypatch.setattr("veiledlake.llm.common.is_small", lambda df, most: False)
            monkeypatch.setattr(repeats, "BITS", 16)
            monkeypatch.setattr("veiledlake.llm.common.HOT", 50)
        found = repeats.drop_repeats(table(docs)).select("doc_id", "n_words", "n_removed", "kept")
        assert sorted(map(tuple, found.collect()), key=str) == want


def test_repeats_empty(table):
    assert repeats.drop_repeats(table([])).collect() == []


def test_repeats_are_maximal(table):
    long = " ".join(f"p{i}" for i in range(40))
    docs = [(1, long), (2, f"x y {long} z"), (3, " ".join(f"p{i}" for i in range(5, 20)))]
    found = {r.doc: r.spans for r in repeats.repeats(table(docs)).collect()}
    assert found == {2: "2:42", 3: "0:15"}


def plain_runs(ws):
    """Every lag, word by word."""
    found = []
    for q in range(1, len(ws) // 3 + 1):
        i = q
        while i < len(ws):
            start = i
            while i < len(ws) and ws[i] == ws[i - q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(24, 3 * q):
                s = start - q
                inner = any(all(ws[j] == ws[j - d] for j in range(s + d, s + length)) for d in range(1, q))
                found += [] if inner else [(s, length, q)]
            i += 1
    return sorted(found)


def planted(doc_id, text):
    ws = re.findall(SPACED, text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(ws)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    return ws


def runs_row(doc_id, text):
    ws = planted(doc_id, text)
    found = plain_runs(ws)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    milli = 1000 * best[1] // best[2] if best else None
    return (doc_id, len(found), *(best or (None, None, None)), milli, sha(lines), sha(kept))


def run_words(rng):
    ws = (rng.choices("ab", k=rng.randint(1, 12)) * 60)[: rng.randint(0, 160)]
    for _ in range(rng.randint(0, 3) if ws else 0):
        ws[rng.randrange(len(ws))] = rng.choice("abc")
    return ws + rng.choices("ab", k=20) + ws[:50] if rng.random() < 0.3 else ws


def test_runs_of_words():
    rng = random.Random(13)
    for _ in range(600):
        ws = run_words(rng)
        assert sorted(map(tuple, runs.runs_of(ws))) == plain_runs(ws)


def test_runs_of_a_long_text():
    ws = [str(i % 1000) for i in range(100_000)] + ["a"] * 100_000
    assert sorted(runs.runs_of(ws)) == [(0, 100_000, 1000), (100_000, 100_000, 1)]


def test_periodic_runs_query(table, tmp_path):
    rng = random.Random(14)
    docs = [(d, " ".join(run_words(rng))) for d in range(120)]
    docs += [(d, " ".join(f"w{i}" for i in range(rng.randint(1, 300)))) for d in range(200, 320)]
    docs += [(None, "a " * 30), (None, None), (500, None), (501, ""), (502, "\n \t"), (503, "é  " * 30), (7, "again")]
    docs += [(600 + d, None) for d in range(30)] + [docs[3], docs[3]]
    table(docs).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(table(docs).sparkSession, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((runs_row(*d) for d in docs), key=str)
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 and t for d, t in docs)


def test_runs_keep_other_columns(table):
    found = runs.find_runs(table([(1, "a b " * 20)])).drop("_words", "_doc")
    [row] = found.collect()
    assert (row.doc_id, row.label, row.n_words, row.collapsed) == (1, "x", 40, "a b")
    assert [tuple(r) for r in row.runs] == [(0, 40, 2)]
    assert runs.find_runs(table([])).collect() == []


def test_longest_run_compares_exactly(spark):
    def best(*found):
        df = spark.createDataFrame([(list(found),)], "runs array<struct<start:long,length:long,period:long>>")
        return df.select(runs.longest_run("runs").alias("r")).first().r

    assert tuple(best((0, 30, 10), (50, 27, 9), (90, 28, 9))) == (90, 28, 9)
    assert tuple(best((5, 30, 10), (9, 27, 9))) == (5, 30, 10)
    assert tuple(best((0, 3 * 10**8 + 1, 10**8), (1, 3 * 10**8 + 4, 10**8 + 1))) == (0, 300000001, 100000000)
    assert best() is None
