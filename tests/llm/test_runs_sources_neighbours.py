"""Periodic runs, source divergence and nearest neighbours against brute force, and on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threatloom.llm import divergence, neighbours, periodic
from threatloom.llm.common import prepare
from threatloom.llm.queries import QUERIES

WHITE = b" \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def ready(spark):
    return prepare(spark)


def runs_by_brute_force(w):
    """Every stretch of one period, then those of the smallest."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        same = [a == b for a, b in zip(w, w[q:], strict=False)] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            if not equal and start is not None:
                if i - start + q >= max(6, 4 * q):
                    found.append((start, i - start + q, q))
                start = None
    return sorted(r for r in found if not any(s[2] < r[2] and s[0] <= r[0] and s[0] + s[1] >= r[0] + r[1] for s in found))


def test_runs_equal_brute_force():
    draw = random.Random(3)
    total = 0
    for _ in range(800):
        n, k = draw.randint(0, 150), draw.choice([1, 2, 3, 6, 40])
        w = [draw.randrange(k) for _ in range(n)]
        for _ in range(draw.randint(0, 3)):
            if n > 8:
                a, p = draw.randrange(n), draw.randint(1, n // 4)
                for i in range(a + p, draw.randint(a, n)):
                    w[i] = w[i - p]
        names = {}
        numbers = np.array([names.setdefault(x, len(names)) for x in w], dtype=np.int64)
        expected = runs_by_brute_force(w)
        assert periodic.find_runs(numbers) == expected
        total += len(expected)
    assert total > 300


@pytest.mark.parametrize("block", [1, 2, 8, 64])
@pytest.mark.parametrize("prime", periodic.PRIMES)
def test_block_sums_are_exact(block, prime):
    words = np.random.default_rng(block).integers(0, 9, 400).astype(np.uint64)
    starts = np.arange(0, 400 - 3 * block, 2 * block)
    got = periodic._mismatches(words, starts, block, *prime)
    x = words.astype(np.int64)
    for row, i in enumerate(starts):
        for d in range(block, 2 * block):
            expected = int(((x[i : i + block] - x[i + d : i + d + block]) ** 2).sum())
            assert got[row, d - block] == expected % prime[0]


def test_long_and_repetitive_texts_stay_cheap():
    assert periodic.find_runs(np.zeros(300_000, dtype=np.int64)) == [(0, 300_000, 1)]
    inner = np.tile(np.r_[np.zeros(200, dtype=np.int64), 1], 50)
    found = periodic.find_runs(inner)
    assert (0, len(inner), 201) in found and len(found) == 51
    assert periodic.find_runs(np.tile(np.arange(20_000), 5)) == [(0, 100_000, 20_000)]


def test_a_wrong_hash_is_found_out(monkeypatch):
    monkeypatch.setattr(periodic._Prefixes, "_same", lambda self, a, b, length: np.ones(len(a), dtype=bool))
    w = np.array([5, 1, 2, 1, 2, 1, 2, 1, 2, 3, 4, 5, 6, 7, 8, 9], dtype=np.int64)
    assert periodic.find_runs(w) == [(1, 8, 2)]


def test_detect_on_awkward_rows(ready):
    data = [
        (1, None, "x"), (2, "", "x"), (3, " \t ", "x"), (4, "a a a a a a", "x"), (4, "a a a a a a", "x"), (5, "a a a a a", "x"),
        (None, "é b é b é b é b c", "x"), (6, "A a A a A a A a", "x"), (7, "a a " * 6, "x"), (8, "p q\n" * 40 + "r " * 9, "x"),
        (9, "x\0y " * 7, "x"), (10, "w " * 50_000, "x"),
    ]
    docs = ready.createDataFrame(data, "doc_id long, text string, runs string")
    got = {}
    for r in periodic.detect(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed))
    assert got[1] == got[2] == got[3] == [(0, [], None, "")]
    assert got[4] == [(6, [(0, 6, 1)], (0, 6, 1), "a")] * 2
    assert got[5] == [(5, [], None, "a a a a a")]
    assert got[None] == [(9, [(0, 8, 2)], (0, 8, 2), "é b c")]
    assert got[6] == [(8, [(0, 8, 2)], (0, 8, 2), "A a")]
    assert got[7][0][1] == [(0, 6, 1)] and got[9][0][1] == [(0, 7, 1)]
    assert got[8] == [(89, [(0, 80, 2), (80, 9, 1)], (0, 80, 2), "p q r")]
    assert got[10] == [(50_000, [(0, 50_000, 1)], (0, 50_000, 1), "w")]
    assert periodic.detect(docs.limit(0)).collect() == []


def test_run_query_equals_brute_force(ready, tmp_path):
    draw = random.Random(5)
    data = [(i, " ".join(draw.choice("abcdefgh") for _ in range(draw.randint(0, 60)))) for i in range(300)] + [(301, None), (-7, "z " * 9), (None, "y " * 9)]
    ready.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in data:
        w = (text or "").split()
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g = h // 10
        if h % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        found = runs_by_brute_force(w)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        last = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected.append((doc_id, len(found), *last, *(hashlib.sha256(x.encode()).hexdigest() for x in (told, left))))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert rows(QUERIES["op11_periodic_runs"](ready, str(tmp_path))) == sorted(expected, key=key)
    assert sum(r[1] > 0 for r in expected) > 10


def audit_by_brute_force(data, least, top):
    groups, counts, seen = set(), {}, {}
    for text, lang, source in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = "".join(c if "a" <= c <= "z" or ord(c) > 127 else " " for c in low).split(" ")
        words = [w for w in words if w]
        counts.setdefault((lang, source), Counter()).update(words)
        seen.setdefault(lang, Counter()).update(set(words))
    kept = {lang: sorted(t for t, n in seen.get(lang, {}).items() if n >= least) for lang, _ in groups}

    def shares(count, lang):
        total = sum(count[t] for t in kept[lang])
        return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept[lang])) for t in kept[lang]}

    found = []
    for lang, source in groups:
        own = shares(counts[lang, source], lang)
        usual = shares(sum((c for g, c in counts.items() if g[0] == lang), Counter()), lang)
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                q = shares(counts[lang, other], lang)
                pairs.append((-sum(abs(own[t] - q[t]) for t in kept[lang]), other.encode(), other))
        more = [(usual[t] - own[t], t.encode(), t) for t in kept[lang] if counts[lang, source][t] and own[t] > usual[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
            found += [(lang, source, part, item, -value, i + 1) for i, (value, _, item) in enumerate(items)]
    return found


def test_audit_equals_brute_force(ready):
    draw = random.Random(9)
    vocabulary = ["The", "cat", "été", "日本", "don't", "x1y", "naïve", "Dog", "zebra", "mat", " gap", "𝔘ni", "ﬁn", "a"]
    data = []
    for _ in range(150):
        words = [draw.choice(vocabulary[: draw.randint(2, 14)]) for _ in range(draw.randint(0, 30))]
        data.append((" ".join(words), draw.choice(["en", "fr", None, "", "x/y"]), draw.choice(["s1", "s2", "s3", None, "Ω", ""])))
    data += [(None, "en", "silent"), ("", "de", "a"), ("rare words", "de", "b"), (None, None, None), ("cat " * 20_000, "en", "long"), data[0], data[0]]
    docs = ready.createDataFrame(data, "text string, lang string, source string").withColumns({"term": F.lit(1), "n": F.lit(2), "language": F.lit("q")})
    for least, top in ((2, 3), (10, 50), (30, 2)):
        got = rows(divergence.audit(docs, least, top))
        key = lambda r: tuple((v is None, str(v)) for v in r)
        assert got == sorted(audit_by_brute_force(data, least, top), key=key)
    assert divergence.audit(docs.limit(0)).collect() == []
    assert divergence.audit(docs.where("lang = 'de'")).count() == 2


def near_by_brute_force(data, asked, k):
    items = {}
    for vec_id, v in data:
        if vec_id is not None and v and None not in v and np.isfinite(v).all() and any(v):
            items.setdefault(vec_id, []).append(np.array(v, dtype=np.float32).astype(np.float64))
    found = []
    for q in sorted(i for i in items if asked(i)):
        far = []
        for other, vectors in items.items():
            apart = [np.sqrt(((x - y) ** 2).sum()) for x in items[q] for y in vectors if len(x) == len(y)]
            if other != q and apart:
                far.append((min(apart), other))
        found += [(q, rank + 1, other, score) for rank, (score, other) in enumerate(sorted(far)[:k])]
    return found


def test_neighbours_on_awkward_rows_are_exact(ready):
    data = [
        (0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, -2.0]), (200, None), (300, []), (400, [0.0, 0.0]),
        (500, [1.0, None]), (600, [1.0, float("nan")]), (700, [float("inf"), 1.0]), (None, [1.0, 1.0]), (800, [1.0, 2.0, 3.0]), (5, [5.0, 5.0]),
        (5, [1.0, 0.5]), (900, [9.0, 9.0]), (900, [1.0, 0.4]), (900, [9.0, 9.0]), (801, [1.0, 2.0, 4.0]), (1000, [7.0]),
    ]
    for extra in ([], [(10 + i, [3.0, 3.0]) for i in range(40)]):
        df = ready.createDataFrame(data + extra, "vec_id long, embedding array<float>").withColumns({"query": F.lit(1), "dim": F.lit(1), "name": F.lit(2)})
        got = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0, 4).sort("query_id", "rank").collect()]
        expected = near_by_brute_force(data + extra, lambda i: i % 100 == 0, 4)
        assert [r[:3] for r in got] == [r[:3] for r in expected]
        assert np.allclose([r[3] for r in got], [r[3] for r in expected], atol=1e-12)
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert neighbours.nearest(df, F.lit(None).cast("boolean")).collect() == []


def test_perturbations_come_by_chance_of_success():
    member = neighbours.perturbations(4, 40)
    assert not member[0].any() and member[1].tolist() == [1, 0, 0, 0, 0, 0, 0, 0]
    assert ((member[:, :4] + member[:, :3:-1]) <= 1).all() and len({tuple(m) for m in member.tolist()}) == len(member) == 40
    hashes = neighbours.family(8, 4, 1.0)
    query = np.random.default_rng(1).normal(size=(20, 8))
    visits = neighbours.visited(query, hashes, 30)
    assert (visits[:, :, 0] == neighbours.buckets(query, hashes)).all()
    assert all(len(set(v)) == 30 for q in visits.tolist() for v in q)


def test_neighbours_reach_the_recall(ready, tmp_path):
    draw = np.random.default_rng(2)
    centers = draw.normal(size=(30, 24))
    copies = np.repeat(draw.normal(size=(1, 24)), 700, axis=0) + np.repeat(draw.normal(size=(1, 24)) * 1e-3, 700, axis=0) * draw.random((700, 1))
    data = np.concatenate([centers[draw.integers(0, 30, 3000)] + 0.3 * draw.normal(size=(3000, 24)), copies, np.repeat(draw.normal(size=(1, 24)), 300, axis=0)])
    data = [(int(i), [float(c) for c in v]) for i, v in zip(draw.permutation(4000), data.astype(np.float32), strict=True)]
    ready.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {tuple(r)[:3]: r.score for r in QUERIES["op13_nearest"](ready, str(tmp_path)).collect()}
    expected = near_by_brute_force(data, lambda i: i % 100 == 0, 10)
    assert len(got) == len(expected) == 400
    true = {(q, other): score for q, _, other, score in expected}
    met = [(q, other) for q, _, other in got if (q, other) in true]
    assert len(met) >= 0.93 * len(true)
    by_id = dict(data)
    for (q, _, other), score in got.items():
        assert abs(score - np.sqrt(((np.array(by_id[q]) - np.array(by_id[other])) ** 2).sum())) < 1e-9
