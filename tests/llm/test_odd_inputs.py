"""Inputs that once went wrong: zero bytes in words, clashing column names, very many equal vectors, empty tables."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatloom.llm import bpe, chat, divergence, embedding_dedup, language, line_dedup, minhash, neighbours, periodic, secrets, url_filter
from threatloom.llm.common import free_name, prepare
from threatloom.llm.queries import vocabulary


@pytest.fixture(scope="module")
def ready(spark):
    return prepare(spark)


def test_a_zero_byte_is_part_of_a_word(ready):
    sets = minhash.shingle_sets([b"a\0b c", b"a b c", b"\0", None, b"", b"x\0", b"\0x", b"x x"], 2)
    assert [len(s) for s in sets] == [1, 2, 1, 0, 0, 1, 1, 1]
    assert len({s.tobytes() for s in sets if len(s)}) == 6
    docs = ready.createDataFrame([(1, "a\0b c"), (2, "a b c"), (3, "A\0B c")], "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == {1: (1, 1), 2: (2, 2), 3: (1, 1)}


def test_any_column_name_may_be_taken(ready):
    docs = ready.createDataFrame([(i, f"same long line in every one\nown {i}", 7, 8, 9) for i in range(6)], "doc_id long, text string, gone int, GONE_ int, line int")
    found = line_dedup.drop_recurring_lines(docs)
    assert found.columns == ["doc_id", "text", "gone", "GONE_", "line", "lines_dropped"]
    assert sorted((r.doc_id, r.text, r["gone"]) for r in found.collect())[1:] == [(i, f"own {i}", 7) for i in range(1, 6)]
    assert free_name("gone", ["GONE", "gone_"]) == "gone__"


def test_very_many_equal_vectors_are_one(ready):
    draw = np.random.default_rng(3)
    one, near = draw.normal(size=16), None
    near = one + 0.02 * draw.normal(size=16)
    other = draw.normal(size=16)
    data = [(i, [float(x) for x in one], 1) for i in range(20_000)] + [(20_000 + i, [float(x) for x in near], 1) for i in range(3)]
    data += [(30_000, [float(x) for x in other], 1), (30_001, [float(x) for x in one], 2), (30_002, [float(-x) for x in one], 1), (30_003, [float(2 * x) for x in one], 1)]
    df = ready.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(8).cache()
    df.count()
    began = time.perf_counter()
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(df).collect()}
    assert time.perf_counter() - began < 60
    assert found[0] == (20_003, 0) and found[19_999] == (20_003, 0) and found[20_001] == (20_003, 0) and found[30_003] == (20_003, 0)
    assert found[30_000] == (0, 30_000) and found[30_001] == (0, 30_001) and found[30_002] == (0, 30_002)
    twice = embedding_dedup.near_vectors(df.where("vec_id < 2").union(df.where("vec_id < 2")))
    assert sorted((r.vec_id, r.n_links) for r in twice.collect()) == [(0, 1), (1, 1)]


def test_empty_tables_give_no_rows(ready):
    docs = ready.createDataFrame([], "doc_id long, text string, lang string, source string")
    vectors = ready.createDataFrame([], "vec_id long, embedding array<float>, label int")
    pages = ready.createDataFrame([], "page_id long, url string")
    talks = ready.createDataFrame([], "conv_id long, turn int, role string, text string")
    results = [
        bpe.encode(docs, vocabulary("word_bpe_49k.json")), secrets.scan(docs), line_dedup.drop_recurring_lines(docs), minhash.near_duplicates(docs, 2),
        language.identify(docs, language.train(docs)), periodic.detect(docs), divergence.audit(docs), embedding_dedup.near_vectors(vectors),
        neighbours.nearest(vectors, F.lit(True)), url_filter.filter_urls(pages, ready.createDataFrame([], "page_id long, bad long")), chat.link_conversations(talks),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_a_bad_section_is_caught_whatever_its_branches(ready):
    pages, labels = [], []
    for i in range(105):
        pages.append((i, f"https://site.com/spam/{chr(97 + i % 15) * 3}/{'xyzuvwt'[i // 15] * 2}"))
        labels.append((i, 1))
    for i in range(700):
        pages.append((1000 + i, f"https://site.com/{('news', 'shop', 'blog', 'help', 'docs')[i % 5]}/{chr(97 + i % 26) * 2}/{'pqrs'[i % 4]}"))
        labels.append((1000 + i, 0))
    pages += [(5000, "https://site.com/spam/never/seen/before"), (5001, "https://site.com/news/never/seen"), (5002, "https://other.com/spam/aaa/xx"), (5003, "https://site.com/spam/*/x")]
    pages += [(6000 + i, "https://deep.com/" + "/".join("abcdefghijklmnop"[: i + 1])) for i in range(16)] + [(1, "https://site.com/spam/aaa/again"), (7000, None)]
    schema = ("page_id long, url string, template string, purity int, host int", "page_id long, bad long")
    found = url_filter.filter_urls(ready.createDataFrame([(*p, "t", 1, 2) for p in pages], schema[0]), ready.createDataFrame(labels, schema[1])).collect()
    got = {}
    for r in found:
        got.setdefault(r.page_id, set()).add(r.verdict)
    assert len(found) == len(pages)
    assert all(got[i] == {"block"} for i in range(105)), {i: got[i] for i in range(105) if got[i] != {"block"}}
    assert all(got[1000 + i] == {"allow"} for i in range(700))
    assert got[5000] == {"block"} and got[5003] == {"block"} and got[5001] == got[5002] == got[7000] == {"allow"}
    assert all(got[6000 + i] == {"allow"} for i in range(16))
