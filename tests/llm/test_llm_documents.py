"""Operators on documents against brute force: decontamination, Jaccard join, line dedup, language ID."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from veiledlake.llm import decontaminate, jaccard, language, lines
from veiledlake.llm.common import READ_ROWS
from veiledlake.llm.shingles import sets_of


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def leaks(text, items):
    ws, hit, found = plain_words(text), set(), set()
    for item, content in items:
        iw = plain_words(content)
        for w in {tuple(iw[i : i + 10]) for i in range(max(len(iw) - 9, 1))} if iw else ():
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found |= {str(item)} if item is not None else set()
    ids = ",".join(sorted(found))
    return len(ws), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_decontaminate(table):
    rng = random.Random(4)
    some = [f"w{i}" for i in range(12)]
    items = [
        (1, " ".join(f"a{i}" for i in range(14))),
        (2, " ".join(f"a{i}" for i in range(3, 18))),
        (10, "Short one"),
        (11, "short, ONE!"),
        (12, "b1 b2 b3 b4 b5 b6 b7"),
        (13, None),
        (14, "!!"),
        (None, "c1 c2 c3"),
        (15, "é"),
        (16, " ".join(["again"] * 25)),
    ]
    items += [(100 + k, " ".join(rng.choices(some, k=rng.randint(1, 13)))) for k in range(15)]
    docs = [
        (1, "x " + " ".join(f"A{i}" for i in range(18)) + " y"),
        (2, " ".join(f"a{i}" for i in range(9))),
        (3, None),
        (4, ""),
        (5, "b1 b2 b3 b4 b5 b6 b7"),
        (5, "b1 b2 b3 b4 b5 b6 b7"),
        (5, "b1 b2 b3 b4 b5 b6"),
        (None, "is short one here"),
        (None, "is short one here"),
        (6, "c1-c2.c3"),
        (7, "É é"),
        (8, "again " * 40),
        (9, "z " * 30_000 + "short one"),
    ]
    docs += [(20 + k, " ".join(rng.choices(some, k=rng.randint(0, 200)))) for k in range(25)]
    found = decontaminate.decontaminate(table(docs), table(items, "item_id long, text string"))
    want = sorted(((d, *leaks(t, items)) for d, t in docs), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == want


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_decontaminate_empty(table, docs, items):
    found = decontaminate.decontaminate(table(docs), table(items, "item_id long, text string")).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in found] == [(1, 2, 0, False)] * len(docs)


def test_decontaminate_memory(table, spark, monkeypatch):
    """No array of marks for a whole text, and few texts at once, or executors run out of memory."""
    plans, rows = [], []

    def settled(df, really=decontaminate.settled):
        if "_near" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            rows.append(int(spark.conf.get(READ_ROWS)))
        return really(df)

    monkeypatch.setattr(decontaminate, "settled", settled)
    before = spark.conf.get(READ_ROWS)
    spark.conf.set(READ_ROWS, "4096")
    try:
        found = decontaminate.decontaminate(
            table([(1, "a b c d e f"), (2, "a b")]), table([(1, "b c d e f"), (2, "a b")], "item_id long, text string")
        ).collect()
    finally:
        spark.conf.set(READ_ROWS, before)
    assert sorted((r.doc_id, r.n_hit, r.n_items) for r in found) == [(1, 6, 2), (2, 2, 1)]
    assert len(plans) == 1 and "lambda" not in plans[0]
    assert rows[0] <= 1000


def shingle_set(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    return {tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))} if ws else set()


def components(docs):
    sets = [shingle_set(t) for _, t in docs]
    group = list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    least = {}
    for (doc, _), g in zip(docs, group, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [
        (d, len(s), least.get(g) if s else d) for (d, _), s, g in zip(docs, sets, group, strict=True)
    ]


def near_copies(rng, n):
    """Groups of edited copies, chains in which each differs a little from the last, and a common passage."""
    docs = []
    passage = " ".join(f"p{i}" for i in range(20))
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 120))]
        now = list(base)
        for _ in range(n):
            copy = list(now if g % 2 else base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10**6)}"
            now = copy
            docs.append(" ".join(copy) + (" " + passage if g > 3 else ""))
    docs += [passage + f" q{i} r{i}" for i in range(12)] + ["A b c", "a b c", "a b", "one", "One"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, rounds", [(1, 0), (2, 3)])
def test_jaccard_components(table, monkeypatch, seed, rounds):
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", rounds)
    docs = near_copies(random.Random(seed), 12)
    docs += [(None, docs[0][1]), (None, "nobody has this text but one"), (3, docs[3][1]), (500, None), (501, " \t\n")]
    nameless = [f"n{i}" for i in range(40)]
    docs += [(None, " ".join(nameless)), (None, " ".join([*nameless[:-1], "other"]))]
    found = jaccard.jaccard_components(table(docs))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(components(docs), key=str)


def test_jaccard_of_near_copies_that_are_no_links(table, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    rng = random.Random(7)
    base = [f"b{i}" for i in range(100)]
    # All share a long passage; tails of 12 to 20 words of their own put pairs on both sides of the threshold.
    docs = [(i, " ".join([*base, *(f"t{i}x{k}" for k in range(rng.randint(12, 20)))])) for i in range(40)]
    docs += [(100 + i, docs[i][1] + f" end{i}") for i in range(0, 40, 4)]
    want = components(docs)
    assert 1 < len({c for *_, c in want}) < len(docs)
    assert sorted(map(tuple, jaccard.jaccard_components(table(docs)).collect())) == sorted(want)


def test_jaccard_compares_copies_with_the_centre_of_their_group_first(table, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    left, settled = [], jaccard._all_pairs
    monkeypatch.setattr(jaccard, "_all_pairs", lambda *a: left.append(settled(*a)) or left[0])
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    docs = [(0, " ".join(base))]
    for i in range(1, 61):
        copy = list(base)
        # Words that lie apart: a link to the base, and mostly none to another copy.
        for at in rng.sample(range(5, 145, 10), 3):
            copy[at] = f"e{i}x{at}"
        docs.append((i, " ".join(copy)))
    want = components(docs)
    assert {c for *_, c in want} == {0}
    assert sorted(map(tuple, jaccard.jaccard_components(table(docs)).collect())) == sorted(want)
    assert left[0].count() <= len(docs)


def test_jaccard_shuffles_the_sets_of_pairs_once(table):
    pairs = table([(1, 2)], "set long, other long", clash=False)
    sets = table([(1, [1, 2]), (2, [2, 3])], "set long, marks array<long>", clash=False)
    joined = jaccard._with_both(pairs.hint("merge"), sets.hint("merge"))
    assert [(r.ones, r.others) for r in joined.collect()] == [([1, 2], [2, 3])]
    assert "ReusedExchange" in joined._jdf.queryExecution().executedPlan().toString()


def test_entries_are_the_first_marks_in_the_table():
    table = np.zeros((1 << 10) // 8, np.uint8)
    for mark in (5, 7, 9):
        table[mark >> 3] |= 1 << (mark & 7)
    lists = pa.array([[], [5, 6, 7, 9], [9, 5]], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([0, 10, 4]), lists], ["set", "n", "marks"])
    (found,) = jaccard._entries(table, 80)([batch])
    # Of 10 marks the first three are listed, of 4 the first.
    assert [tuple(r.values()) for r in found.to_pylist()] == [(5, 2, 10, 0, -1), (7, 2, 10, 2, 6), (9, 3, 4, 0, -1)]


def test_jaccard_of_nothing(table):
    assert jaccard.jaccard_components(table([])).collect() == []
    alone = jaccard.jaccard_components(table([(1, None), (2, "")])).collect()
    assert sorted(map(tuple, alone)) == [(1, 0, 1), (2, 0, 2)]


def test_shingles_do_not_cross_texts_or_parts(monkeypatch):
    import pyarrow as pa

    from veiledlake.llm import shingles

    texts = ["a b c d e f", None, "", "x", "f g h i j k l", "ab c", "a bc", "é à ü ö ä ß", "a  b\tc\nd e f"] * 3
    whole = [tuple(s) for s in sets_of(pa.array(texts), 5)]
    assert [len(s) for s in whole] == [len(shingle_set(t)) for t in texts]
    monkeypatch.setattr(shingles, "PART_BYTES", 7)
    assert [tuple(s) for s in sets_of(pa.array(texts), 5)] == whole
    assert whole[0] == whole[8] and whole[5] != whole[6]
    assert [tuple(s) for s in sets_of(pa.array(["zz", *texts]).slice(1), 5)] == whole


def test_line_dedup(table):
    rows = [(i, f"menu\nown {i}\n\n menu ", "a") for i in range(9)]
    rows += [(20, "menu\nmenu", "a"), (21, None, "a"), (22, "", "a"), (23, "menu", "b"), (24, "menu\nx", None)]
    rows += [(25 + i, f"foot\nbody {i}", None) for i in range(3)] + [(25, "foot\nbody 0", None)]
    docs = table(rows, "doc_id long, text string, source string")
    found = {}
    for r in lines.drop_site_lines(docs, ratio=0.5).collect():
        found.setdefault((r.doc_id, r.source), []).append((r.text, r.n_lines, r.n_dropped))
    assert found[3, "a"] == [("own 3\n", 4, 2)]
    assert found[20, "a"] == [("menu\nmenu", 2, 0)]
    assert found[21, "a"] == [(None, 0, 0)]
    assert found[22, "a"] == [("", 1, 0)]
    assert found[23, "b"] == [("menu", 1, 0)]
    assert found[24, None] == [("menu\nx", 2, 0)]
    assert found[25, None] == [("body 0", 2, 1)] * 2
    assert lines.drop_site_lines(docs.limit(0)).collect() == []


def test_lines_of_small_hosts(table):
    """A line on two pages counts on a host of any size by its share alone; one page repeats nothing."""
    rows = [(i, f"head\nown {i}", f"host {n}") for n in (1, 2, 19, 20) for i in range(n)]
    rows = [(i, text if i < 2 else text.removeprefix("head\n"), host) for i, text, host in rows]
    found = lines.drop_site_lines(table(rows, "doc_id long, text string, source string"))
    cut = {(r.source, r.doc_id): r.text for r in found.collect() if r.doc_id < 2}
    assert cut["host 1", 0] == "head\nown 0"
    for i in range(2):
        assert cut["host 2", i] == cut["host 19", i] == f"own {i}"
        assert cut["host 20", i] == f"head\nown {i}"


WORDS = {
    "aa": "lorna besti quop trelda mossi fenk aru".split(),
    "bb": "xihu zanqo wuyi chenba liqu tongxi".split(),
    "cc": "ñoti ézal çupa órlan ïtel ûmba".split(),
}


def labelled(rng, n):
    langs = sorted(WORDS)
    texts = [(i, langs[i % 3]) for i in range(n)]
    return [(i, " ".join(rng.choices(WORDS[k], k=rng.randint(3, 40))).title(), k) for i, k in texts]


def test_language(table):
    rng = random.Random(3)
    docs = labelled(rng, 300)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? 34", "bb"), (1003, "lorna besti", None), (None, "xihu zanqo wuyi", "bb")]
    odd += [(1004, "zanqo " * 300_000, None)]
    found = language.identify(table(docs + odd, "doc_id long, text string, lang string"))
    rows = {r.doc_id: r for r in found.collect()}
    right = [rows[i].lang_pred == k for i, _, k in docs if rows[i].held_out]
    assert len(right) > 40 and sum(right) >= 0.97 * len(right)
    assert [rows[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert [rows[i].score for i in (1000, 1001, 1002)] == [0.0] * 3
    assert (rows[1003].lang_pred, rows[None].lang_pred, rows[1004].lang_pred) == ("aa", "bb", "bb")
    assert not rows[None].held_out and all(0 <= r.score <= 1 for r in rows.values())


def test_language_looks_at_text_only(table):
    docs = labelled(random.Random(5), 120)
    schema = "doc_id long, text string, lang string"
    train = table(docs, schema).where(~language.held_out())
    model = language.fit(train)
    other = table([(i + 7, t, "aa") for i, t, _ in docs], schema)
    a = language.predict(table(docs, schema), model).select("text", "lang_pred", "score").collect()
    b = language.predict(other, model).select("text", "lang_pred", "score").collect()
    assert sorted(a) == sorted(b)


def test_language_without_labels(table):
    schema = "doc_id long, text string, lang string"
    found = language.identify(table([(1, "some text", None)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert language.identify(table([], schema)).collect() == []
