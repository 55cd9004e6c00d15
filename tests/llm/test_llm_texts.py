"""BPE, fingerprints, chat views, pages, the queries and the pipeline."""

import base64
import hashlib
import importlib.util
import random
import struct
import sys
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from veiledlake import llm
from veiledlake.llm import bpe, chat, decontaminate, fingerprints, jaccard, language, lines, queries, site_trees

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "  \n\t  x", "it's we'll I'd THEY'RE", "über ñandú 漢字 🙂👍🏽", "a" * 700, "0123456789" * 30, "  x　 y",
    "<|endoftext|> <|x|>", "mixed123abc!?;:--", "\r\n\r\n end ", "\x1c\x1d x\x85y", "é́ combining", "\"quoted\" \\ back",
]


@pytest.mark.parametrize("most", [0, 1 << 12])
def test_bpe_equals_library(spark, table, library, most):
    rng = random.Random(1)
    rows = list(enumerate(TEXTS)) + [(None, "null id"), (3, TEXTS[3]), (3, TEXTS[3])]
    rows += [(100 + i, "".join(rng.choices("abé 1\n'ste.", k=rng.randint(0, 60)))) for i in range(40)]
    vocabulary = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    found = bpe.encode(table(rows), vocabulary, packed="raw", decoded="_ids", most=most)
    out = found.select("text", "ids", "raw", "_ids", vocabulary.decode(F.col("ids")).alias("back")).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode_ordinary(r.text or "")
        assert r.ids == want, r.text
        assert bytes(r.back) == bytes(r._ids) == (r.text or "").encode() and bytes(r.raw) == struct.pack(f"<{len(want)}I", *want)


def test_merges_of_short_and_long_words(library):
    rng = random.Random(4)
    vocabulary = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    for n in (1, 2, 7, 60, 190, 300, 3000):
        word = "".join(rng.choices("abcdeé", k=n))
        want = library.encode_ordinary(word)
        assert bpe.merged(word.encode(), vocabulary.ranks) == bpe._merged_long(word.encode(), vocabulary.ranks) == want
    assert len(bpe.merged(b"ab" * 200_000, vocabulary.ranks)) > 1000


def test_frequent_words_whatever_the_counts(table, library):
    vocabulary = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    counts = {" ab": 9000, " cd": 4200, " ef": 1500, " gh": 1500, " ij": 1500, " kl": 1001, " mn": 7, " op": 1}
    docs = table([(i, word * n) for i, (word, n) in enumerate(counts.items())])
    for most in (0, 1, 2, 3, 4, 5, 6, 9):
        found = bpe.frequent_words(docs, vocabulary, most=most)
        assert len(found) == min(most, 7) and all(ids == library.encode_ordinary(w) for w, ids in found.items())
        assert sorted(counts[w] for w in found) == sorted(sorted(counts.values(), reverse=True)[: len(found)])


def test_bpe_encodes_once(spark):
    """Whatever is done with the ids, a text goes through the encoder once."""
    for df in (queries.op8_byte_bpe(spark, SF), corpus_pipeline.encode_tokens(spark, queries.table(spark, SF, "documents"), SF)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan


def test_bpe_ranks_stand_in_the_plan_once(spark, tmp_path):
    """Each copy of them fills the driver, by the plan and its text, and the tasks."""
    pieces = [b"a", b"b", b"c", b"ab", b"abc"]
    file = tmp_path / "ranks"
    file.write_text("".join(f"{base64.b64encode(p).decode()} {i}\n" for i, p in enumerate(pieces)))
    df = spark.createDataFrame([("abcab",)], "word string")
    df = df.select(bpe.Vocabulary(str(file), public_tokenizers.PATTERN).encode_word(F.col("word")).alias("ids"))
    assert df.first().ids == [4, 3]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"keys: [{b'abc'.hex().upper()}]") == 1


def test_bpe_remembers_words_in_little_memory(library):
    ranks, rest = library._mergeable_ranks, {}
    words = [" zxqvkjw" * n for n in (1, 2, 3)]
    found = bpe._encode_words(words, {}, rest, ranks)
    assert found.tolist() == [i for w in words for i in bpe.merged(w.encode(), ranks)]
    for word in words:
        ids = bpe.merged(word.encode(), ranks)
        held = rest[word]
        size = sys.getsizeof(held) + sum(map(sys.getsizeof, held if isinstance(held, list) else ()))
        assert size <= 40 + 4 * len(ids)


def test_pipeline_gives_python_few_rows_at_once(spark, monkeypatch):
    """Whole texts of 10,000 rows, Spark's default, would be held in each task on both sides."""
    rows, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    class Reached(Exception):
        pass

    def reached(*args, **kwargs):
        seen.append(int(spark.conf.get(rows)))
        raise Reached

    for module, name in ((language, "identify"), (jaccard, "jaccard_components"), (bpe, "encode")):
        monkeypatch.setattr(module, name, reached)
    docs, before = queries.table(spark, SF, "documents"), spark.conf.get(rows)
    try:
        for limit in ("10000", "0", "300"):
            for name in ("language_id", "jaccard_join", "byte_bpe"):
                spark.conf.set(rows, limit)
                with pytest.raises(Reached):
                    dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    finally:
        spark.conf.set(rows, before)
    assert seen == [1000] * 6 + [300] * 3


def test_pipeline_decodes_few_rows_at_once(spark, monkeypatch):
    """Texts of 4,096 rows of a file, Spark's default, fill tens of MB in each task."""
    rows, seen = "spark.sql.parquet.columnarReaderBatchSize", []

    class Reached(Exception):
        pass

    def reached(*args, **kwargs):
        seen.append(int(spark.conf.get(rows)))
        raise Reached

    for module, name in ((language, "identify"), (lines, "drop_site_lines"), (jaccard, "jaccard_components")):
        monkeypatch.setattr(module, name, reached)
    monkeypatch.setattr(decontaminate, "item_windows", reached)
    monkeypatch.setattr(bpe, "encode", reached)
    docs, before = queries.table(spark, SF, "documents"), spark.conf.get(rows)
    try:
        for limit in ("4096", "300"):
            for _, stage in corpus_pipeline.STAGES:
                spark.conf.set(rows, limit)
                with pytest.raises(Reached):
                    stage(spark, docs, SF)
    finally:
        spark.conf.set(rows, before)
    assert seen == [1000] * 5 + [300] * 5


def test_language_sample_is_one_block():
    """The driver keeps the memory of thousands of small arrays for later stages, and gives back that of one large array."""
    texts = ["", "one two three", "eins zwei", "a" * 99]
    slots, counts = map(pd.Series, zip(*map(language.grams, texts), strict=True))
    idf = np.linspace(1, 3, language.FEATURES)
    found = language._one_block(slots, counts, idf)
    for (values, features), s, c in zip(found, slots, counts, strict=True):
        assert features.tolist() == s.tolist() and values.tolist() == language._weighted(s, c.astype(float), idf).tolist()
    assert len({id(v.base) for v, _ in found}) == len({id(s.base) for _, s in found}) == 1
    assert language._one_block(slots[:0], counts[:0], idf) == []


def test_bpe_of_nothing(table):
    vocabulary = bpe.Vocabulary(PATH, public_tokenizers.PATTERN)
    assert bpe.encode(table([]), vocabulary).collect() == []


def plain_features(data, rarity):
    steps = []
    for i in range(len(data) - 63):
        p = np.bincount(np.frombuffer(data[i : i + 64], np.uint8))
        p = p[p > 0] / 64
        steps.append(int(1000.5 + 1000 * (p * np.log2(p)).sum() / -6 * 1.0 if False else 1000.5 - 1000 * (1 + (p * np.log2(p)).sum() / 6)))
    keys = [(1001 if s == 0 else rarity[s], i) for i, s in enumerate(steps)]
    wins = [0] * len(keys)
    for i in range(len(keys) - 63):
        wins[min(keys[i : i + 64])[1]] += 1
    return [i for i, w in enumerate(wins) if w >= 16]


def test_features_against_plain_search():
    rng = random.Random(7)
    rarity = np.random.default_rng(7).permutation(1001)
    for n in (200, 1500):
        data = " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(n // 5)).encode()
        array = np.frombuffer(data, np.uint8)
        assert list(fingerprints.features(array, rarity)) == plain_features(data, rarity)
        many = fingerprints._selected_many([array, array[:90], array[:0], array], rarity)
        assert list(many[0][0]) == list(many[3][0]) == plain_features(data, rarity)
        assert [list(m[1]) for m in many[1:3]] == [list(fingerprints._selected(x, rarity)[1]) for x in (array[:90], array[:0])]


def test_likeness():
    rng = random.Random(5)
    rarity = np.arange(1001)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    one = " ".join(rng.choices(words, k=2000)).encode()
    two = " ".join(rng.choices(words, k=2000)).encode()
    a, b, c = (fingerprints.digest(x, rarity) for x in (one, two, one[: len(one) * 2 // 3] + two[:4000]))
    assert fingerprints.likeness(a, a) == 1 and fingerprints.likeness(a, b) < 0.1 < 0.5 < fingerprints.likeness(a, c)
    assert fingerprints.likeness(a, c) == fingerprints.likeness(c, a)
    assert fingerprints.likeness(b"", a) == 0 and fingerprints.likeness(b"", b"") == 1
    assert fingerprints.digest(b"", rarity) == b"" and fingerprints.digest(b"short", rarity) != fingerprints.digest(b"shore", rarity)
    long = np.random.default_rng(1).integers(97, 123, fingerprints.PART + 5000, dtype=np.uint8).tobytes()
    assert len(fingerprints.digest(long, rarity)) > 10_000


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_compare_with_next(table, parts):
    rng = random.Random(2)
    docs = [(i * 3, "".join(rng.choices("abc déf ", k=rng.choice([0, 1, 5, 70, 300, 3000])))) for i in range(60)]
    docs += [(30, docs[10][1]), (31, None)]
    rarity = np.random.default_rng(3).permutation(1001)
    found = {(r.doc_id, r.fingerprint): r for r in fingerprints.compare_with_next(table(docs), rarity, parts=parts).collect()}
    texts = {d: t or "" for d, t in docs}
    order = sorted(texts, reverse=True)
    for doc, other in zip(order, order[1:] + order[:1], strict=True):
        if doc == 30 or other == 30:
            continue
        text, after = texts[doc], texts[other]
        gone = len(text) // 3
        edited = (text[: len(text) - gone] + after[:gone]).encode()
        own, new, far = (fingerprints.digest(x, rarity) for x in (text.encode(), edited, after.encode()))
        r = found[doc, own.hex()]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited).hexdigest())
        assert r.edited_fingerprint == new.hex()
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, new), fingerprints.likeness(own, far))


def test_compare_few(table):
    rarity = np.arange(1001)
    rows = fingerprints.compare_with_next(table([(1, "x" * 9)]), rarity).collect()
    assert [(r.doc_id, r.near_edited, r.near_next) for r in rows] == [(1, 1.0, 1.0)]
    assert fingerprints.compare_with_next(table([]), rarity).collect() == []
    docs = table([(None, "a b"), (None, "a b"), (2, "q")])
    assert sorted(r.n_chars for r in fingerprints.compare_with_next(docs, rarity).collect()) == [1, 3, 3]
    assert fingerprints.rarity_of(table([])).shape == (1001,)


TURNS = "conv_id long, turn long, role string, text string"


def test_chat(table):
    rows = [(1, 0, "system", "be <|im_end|> kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo"), (1, 3, "ann", None), (2, 0, "system", "x")]
    rows += [(None, None, None, "who"), (3, 0, "ann", "a"), (3, 0, "ann", "a")]
    found = {(r.conv_id, r.perspective): r for r in chat.perspectives(table(rows, TURNS)).collect()}
    assert sorted(found, key=str) == sorted([(1, "ann"), (1, "bob"), (None, ""), (3, "ann")], key=str)
    r = found[1, "ann"]
    assert r.text.startswith("<|im_start|>system\nbe < |im_end|> kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n")
    assert [r.text[s.start : s.end] for s in r.spans] == ["hi<|im_end|>\n", "<|im_end|>\n"] and (r.n_turns, r.n_own) == (4, 2)
    assert "<|im_start|>user name=ann\nhi" in found[1, "bob"].text and found[3, "ann"].n_turns == 2
    assert chat.perspectives(table([], TURNS)).collect() == []


def test_long_dialogues_are_dealt_out(table, monkeypatch):
    rows = [(1, i, "abc"[i % 3], f"t{i}") for i in range(1000)] + [(2, 5, "a", f"s{i}") for i in range(900)]
    rows += [(2, 6, "only once", "z")]
    for crowd in (4 * chat.BLOCK, 64):
        monkeypatch.setattr(chat, "CROWD", crowd)
        found = chat.perspectives(table(rows, TURNS)).orderBy("conv_id", "perspective", "block", "slice").collect()
        for view in ("a", "b", "c"):
            parts = [r for r in found if (r.conv_id, r.perspective) == (1, view)]
            text = "".join(r.text for r in parts)
            assert [text.index(f"\nt{i}<") for i in range(1000)] == sorted(text.index(f"\nt{i}<") for i in range(1000))
            assert sum(r.n_own for r in parts) == sum("abc"[i % 3] == view for i in range(1000))
            assert all(r.text[s.start : s.end].startswith("t") for r in parts for s in r.spans)
        parts = [r for r in found if (r.conv_id, r.perspective) == (2, "only once")]
        assert sum(r.n_turns for r in parts) == 901 and sum(r.n_own for r in parts) == 1
        assert max(r.n_turns for r in parts) <= 4 * crowd


PAGES = "page_id long, url string, html string"


def test_pages(table):
    full = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<nav><ul><li><a href='/x'>Menu</a></ul></nav><!-- > note --><div class=\"ad\">Buy</div><div id='cookie-notice'>OK?</div>"
        "<article><h1>Head &amp; all</h1><p>One  <b>bold</b>\n two<p>caf&eacute; &#x41;<br>next</p><table><tr><td>c1<td>c2</table>"
        "<form><input><button>Go</button>Send</form><section class='comments'><p>First!</p></section></article>"
        "<aside>Side</aside><footer>&copy;</footer>"
    )
    rows = [(1, "https://a.example/x", full), (2, None, None), (3, "no url", ""), (4, "http://b.example", "<p>plain < text &lt;b&gt;"), (4, "http://b.example", "<p>plain < text &lt;b&gt;")]
    rows += [(5, "http://c.example", "<div title=\"a>b\">quote' <p>x</div><script>never closed <p>no"), (6, "http://c.example", "word " * 100_000)]
    found = site_trees.extract(table(rows, PAGES)).select("page_id", "text").collect()
    text = {r.page_id: r.text for r in found}
    assert text[1] == "Head & all\nOne bold two\ncafé A next\nc1\nc2"
    assert text[2] == text[3] == "" and text[4] == "plain < text <b>" and len(found) == len(rows)
    assert text[5] == "quote'\nx" and text[6] == " ".join(["word"] * 100_000)
    assert site_trees.extract(table([], PAGES)).collect() == []


def test_style_tree_finds_what_a_site_repeats(table):
    rng = random.Random(3)

    def words(n):
        return " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(n))

    rows = []
    for i in range(40):
        body = "".join(f"<p>{words(12)}</p>" for _ in range(3))
        rows.append((i, f"http://s.example/{i}", f"<div class=top><span>Site of things</span></div><div class=z>{body}</div><div class=end>Since 1999</div>"))
    for r in site_trees.extract(table(rows, PAGES)).collect():
        want = rows[r.page_id][2].split("class=z>")[1].split("</div>")[0]
        assert r.text == want.replace("<p>", "").replace("</p>", "\n").strip()


def test_importance_outweighs_names(table):
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(n))

    rows, want = [], {}
    for i in range(40):
        inside, beside = words(12), words(12)
        want[i] = f"{inside}\n{beside}"
        rows.append((
            i,
            f"http://s.example/{i}",
            f"<article><p>{inside}</p><div class=box>the same on each page</div></article>"
            f"<div class=more>{beside}</div><div class=end>Since 1999</div><nav>{words(3)}</nav>",
        ))
    rows += [(100 + i, "http://copies.example/", "<div>Top</div><main><p>All the same</p></main>") for i in range(5)]
    found = {r.page_id: r.text for r in site_trees.extract(table(rows, PAGES)).collect()}
    assert {i: found[i] for i in want} == want
    assert {found[100 + i] for i in range(5)} == {"All the same"}


needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@needs_data
@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from '{file}'")
    df = llm.QUERIES[name](spark, SF)
    relation = duck.sql(llm.ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    want = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(want, key=str)


@needs_data
def test_bpe_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op8_byte_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        raw = struct.pack(f"<{len(ids)}I", *ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


@needs_data
def test_pipeline(spark, library):
    """The stages against plain decisions on the rows each of them gets."""
    spec = importlib.util.spec_from_file_location("documents_tests", Path(__file__).with_name("test_llm_documents.py"))
    plain = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(plain)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    names, now, seen = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in now.collect()}
        after = stage(spark, now, SF)
        seen[name] = (before, {r.doc_id: r for r in after.collect()})
        if name != "byte_bpe":
            assert after.columns == names
            now = spark.createDataFrame([tuple(r) for r in seen[name][1].values()], docs.schema)
    before, after = seen["language_id"]
    assert all(any(c.isalpha() for c in r.text or "") == (r.doc_id in after) for r in before.values())
    before, after = seen["line_dedup"]
    assert set(before) == set(after) and all(r.n_chars == len(r.text) for r in after.values())
    before, after = seen["jaccard_join"]
    groups = plain.components([(r.doc_id, r.text) for r in before.values()])
    assert set(after) == {d for d, _, c in groups if c == d}
    before, after = seen["decontamination"]
    assert set(after) == {d for d, r in before.items() if not plain.leaks(r.text, items)[-1]}
    before, after = seen["byte_bpe"]
    assert {d: r.ids for d, r in after.items()} == {d: library.encode_ordinary(r.text) for d, r in before.items()}
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in whole} == {d: r.ids for d, r in after.items()}
