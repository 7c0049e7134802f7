"""The operators against brute force, public tokenizers and small cases with nulls, ties and odd columns."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tests.conftest import SMALL
from threatloom.llm import bpe, chat, decontaminate, embedding_dedup, language, line_dedup, minhash, secrets, token_counts, url_filter
from threatloom.llm.common import prepare
from threatloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, digest string, node long, spans int"


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="module")
def docs(session):
    """Nulls, empty and blank texts, one very long text, ties, repeated rows, and columns named like inner ones."""
    long_text = " ".join(f"w{i}" for i in range(30_000))
    texts = [None, "", "  \n ", "Word", "two words", "two words", long_text, "Été ß 日本 \U0001f600", "a\0b c"]
    rows = [(i, t, "en", "x", 1, 2) for i, t in enumerate(texts)]
    return session.createDataFrame([*rows, rows[4], (None, "no id here", None, None, None, None)], SCHEMA)


def groups(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def test_components_of_paths_stars_and_repeats(session):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (8, 9), (9, 8), (8, 9)]
    random.Random(1).shuffle(links)
    found = {r.node: r.component for r in components(session.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == groups(nodes, [x for x in links if x[0] != x[1]])
    assert components(session.createDataFrame([], "a long, b long")).count() == 0


def test_token_counts_equal_the_tokenizer():
    pieces = token_counts.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    counter = token_counts.UnigramCounter(pieces)
    library = Tokenizer(models.Unigram(pieces, unk_id=0))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    draw = random.Random(2)
    texts = ["", " ", "  a b ", "日本語\U0001f600\U0001f600 x", "▁a", "\n\n", "<s> <unk>"]
    texts += ["".join(draw.choice("aeinrst e▁\U0001f600日th") for _ in range(draw.randint(1, 60))) for _ in range(500)]
    for text in texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_odd_rows(session, docs):
    found = token_counts.count_tokens(docs, [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0)]).collect()
    assert len(found) == 11 and {r.doc_id: r.n_tokens for r in found}[0] == 0


def test_bpe_equals_the_tokenizer(session, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    pairs, library = bpe.WordPairs(path), Tokenizer.from_file(path)
    draw = random.Random(3)
    texts = ["", "It's we'll I'D", "<|startoftext|>hi<|endoftext|>", "ΑΣ ΟΔΟΣ", "\x1c\x85c　d", "a" * 500, "é Å İ"]
    texts += ["".join(draw.choice("abcdehinort") for _ in range(draw.randint(1, 40))) for _ in range(2000)]
    texts += ["".join(draw.choice(["in", "th", "er", "ing", "s", "a", "e", "on"]) for _ in range(draw.randint(1, 20))) for _ in range(2000)]
    texts += [r.text for r in session.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        mine = pairs.encode(text)
        assert mine.tolist() == ids, text[:80]
        assert pairs.decode(mine.astype(np.int64)).decode() == library.decode(ids, skip_special_tokens=False)
    found = bpe.encode(docs, path).collect()
    assert len(found) == 11 and {r.doc_id: (bytes(r.ids), r.decoded) for r in found}[0] == (b"", "")


def test_secrets_equal_the_regexes(session, docs):
    scanner = secrets.Scanner()
    assign = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    rules = [
        (assign, lambda m: len(m[2]) >= 8),
        (re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        (re.compile(rb"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    ]
    draw = random.Random(4)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", " ", ":", "=", '"', "'", "abcdefgh", "ab12", "AKIA", "é"]
    parts += ["AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "-", "==", ".", "tok", "passpassword", "\n"]
    for _ in range(5000):
        data = "".join(draw.choice(parts) for _ in range(draw.randint(1, 12))).encode()
        expected = sorted((m.start(), i, m.end()) for i, (p, ok) in enumerate(rules) for m in p.finditer(data) if ok(m))
        assert [s for s in scanner.spans(data) if s[1] < 3] == expected, data
    found = secrets.scan(session.createDataFrame([(1, "é token=abcdefgh1 -----BEGIN RSA PRIVATE KEY-----")], "doc_id long, text string")).first()
    assert [(s.kind, s.start, s.end, s.base) for s in found.spans] == [("assign", 2, 17, True), ("pem", 18, 49, False)]
    assert secrets.scan(docs).where("size(spans) > 0").count() == 0


def sets_of(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


@pytest.mark.parametrize("k", [2, 5])
def test_minhash_finds_every_pair(session, k):
    draw = random.Random(5)
    vocabulary = [f"t{i}" for i in range(400)]
    base = [draw.choice(vocabulary) for _ in range(150)]
    texts = [" ".join(base)] * 4
    for changed in (1, 2, 3, 4, 6, 8, 12):
        for _ in range(12):
            words = list(base)
            for at in draw.sample(range(150), changed):
                words[at] = draw.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [" ".join(draw.choice(vocabulary) for _ in range(120)) for _ in range(40)] + ["", None, "one", "One"]
    draw.shuffle(texts)
    rows = [(i * 3, t, "x", 9) for i, t in enumerate(texts)]
    found = minhash.near_duplicates(session.createDataFrame(rows, "doc_id long, text string, digest string, component long"), k).collect()
    sets = {i: sets_of(t, k) for i, t, *_ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
    expected = groups(list(sets), links)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (len(s), expected[i], expected[i] == i) for i, s in sets.items()
    }


def test_minhash_of_odd_rows(session, docs):
    found = minhash.near_duplicates(docs, 2).collect()
    assert len(found) == 11
    assert all(r.kept for r in found if r.doc_id != 5) and {r.doc_id: r.component_id for r in found}[5] == 4
    assert minhash.keep_one(docs, 2).count() == 10
    assert minhash.near_duplicates(docs.limit(0), 2).count() == 0


def brute_contamination(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for name, text in items:
        words = word.findall((text or "").translate(LOWER))
        width = min(13, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            windows[tuple(words[i : i + width])].add(name)
    for text in texts:
        words = word.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for width in {len(w) for w in windows}:
            for i in range(len(words) - width + 1):
                if found := windows.get(tuple(words[i : i + width])):
                    hit |= set(range(i, i + width))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        yield len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_contamination_equals_brute_force(session, block_bytes):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(12)] + ["Ä", "9"]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 5, 13, 14, 30])))) for i in range(20)] + [(99, None)]
    texts = [None, ""]
    for _ in range(60):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))
        texts.append(f"{text}, {draw.choice(items)[1] or ''}! {text}".upper() if draw.random() < 0.7 else text)
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = session.createDataFrame(items, "item_id long, text string")
    found = sorted(decontaminate.contamination(docs, benchmark, block_bytes).collect())
    assert [(r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found] == list(brute_contamination(texts, items))


def test_contamination_of_odd_rows(session, docs):
    none = session.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0
    one = session.createDataFrame([(None, "TWO, words"), (2, "")], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.contamination(docs, one).where("contaminated").collect()) == [4, 4, 5]
    assert decontaminate.drop_contaminated(docs, one).count() == 8


def test_matches_of_repeated_words_are_maximal():
    words = ["a"] * 30 + ["b"] + ["a"] * 20
    item = decontaminate.Suffixes([("i", " ".join(words[:45]).encode()), ("j", b"b a")])

    def brute(text):
        found = set()
        for name, own in (("i", words[:45]), ("j", ["b", "a"])):
            for p in range(len(text)):
                for k in range(len(own)):
                    n = 0
                    while p + n < len(text) and k + n < len(own) and text[p + n] == own[k + n]:
                        n += 1
                    if n >= min(13, len(own)) and not (p and k and text[p - 1] == own[k - 1]):
                        found.add((name, p, n))
        return found

    texts = [["a"] * 40, words, [*"ba", "c", *words[10:44], "c"], ["c"] * 3, []]
    got = item.places(decontaminate.Words([" ".join(t).encode() for t in texts], decontaminate.LETTERS_DIGITS))
    assert [set(x) for x in got] == [brute(t) for t in texts]
    # 2,000 equal words in 20,000 are 40 million windows at places, but as many matches as both have words.
    many = decontaminate.Suffixes([("i", b"a " * 2000)]).places(decontaminate.Words([b"a " * 20000], decontaminate.LETTERS_DIGITS))[0]
    assert len(many) == 20000 - 12 + 2000 - 12 - 1 and max(x[2] for x in many) == 2000


@pytest.mark.parametrize("levels", [None, (1, 2, 4)])
def test_vectors_find_every_link(session, monkeypatch, levels):
    if levels:  # lists of four vectors by three levels or more
        monkeypatch.setattr(embedding_dedup, "FIRST_BITS", levels[0])
        monkeypatch.setattr(embedding_dedup, "SPLIT_BITS", levels[1])
        monkeypatch.setattr(embedding_dedup, "VECTORS_PER_LIST", levels[2])
    draw = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        v = draw.normal(size=24)
        rows.append([v, int(draw.integers(3))])
    for i in range(300):
        v = rows[i % 20][0]
        rows.append([v * 3 + draw.normal(size=24) * 0.25 * np.linalg.norm(v) / 5, rows[i % 20][1]])
    table = [(i, [float(x) for x in v], label, "x", 1) for i, (v, label) in enumerate(rows)]
    table += [(9001, None, 1, "x", 1), (9002, [0.0] * 24, 1, "x", 1), (9003, [float("nan")] * 24, 1, "x", 1), (9004, [1.0, None], 1, "x", 1)]
    table += [(9005, table[0][1], None, "x", 1), (9006, [1.0], 1, "x", 1), (9007, [2.0], 1, "x", 1)]
    vectors = session.createDataFrame(table, "vec_id long, embedding array<double>, label int, list string, native int")
    found = embedding_dedup.near_vectors(vectors).collect()
    unit = np.array([v / np.linalg.norm(v) for v, _ in rows])
    labels = np.array([label for _, label in rows])
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    expected = groups(range(len(rows)), zip(*(x.tolist() for x in np.nonzero(np.triu(near))), strict=True))
    assert near.sum() > 500
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert {i: got.pop(i) for i in expected} == {i: (int(near[i].sum()), c, c == i) for i, c in expected.items()}
    assert got.pop(9006) == (1, 9006, True) and got.pop(9007) == (1, 9006, False)
    assert got == {i: (0, i, True) for i in range(9001, 9006)}


def test_network_gradients_and_odd_rows(session, docs):
    network = language.Network(["a", "b"])
    windows, valid, _ = language.windows_of([b"hello", b"worlds away"])
    target = np.array([0, 1])

    def loss():
        likely = network.probabilities(windows)[:, target, [0, 1]]
        return -(np.log(likely) * valid).sum() / valid.sum()

    found = network.gradients(windows, valid.astype(np.float32), target)
    for key, at in [(("ahead", "gates"), (1, 2)), (("back", "candidate"), (0, 3)), (("ahead", "embed"), (ord("o"), 4)), ("out", (1, 2))]:
        kept = network.weights[key][at]
        network.weights[key][at] = kept + 0.01
        above = loss()
        network.weights[key][at] = kept - 0.01
        below = loss()
        network.weights[key][at] = kept
        assert abs((above - below) / 0.02 - found[key][at]) < 2e-3
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, network).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[3][0] in "ab"
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_language_on_held_out_documents(session):
    docs = session.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    found = language.identify(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(language.held_out(found.doc_id)).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_recurring_lines(session, docs):
    shared = "This site uses cookies for {} and more of the same"
    rows = []
    for i in range(26):
        own = " ".join(f"own{chr(97 + i)}{chr(97 + j)}" for j in range(24))
        rows.append((i, f"{own}\n{shared.format('ads' + chr(97 + i))}\nshort one\nplain footer line number {i} here", "keep", 7))
    copies = [(100 + i, "the same whole text in all of these\nand its second line as well", "keep", 7) for i in range(9)]
    table = session.createDataFrame(rows + copies + [(200, None, "keep", 7), (201, "", "keep", 7)], "doc_id long, text string, template string, lines_dropped long")
    found = {r.doc_id: r for r in line_dedup.drop_recurring_lines(table).collect()}
    assert found[0].text == rows[0][1] and found[0].lines_dropped == 0
    for i in range(1, 26):
        assert found[i].text.split("\n") == [rows[i][1].split("\n")[0], "short one"] and found[i].lines_dropped == 2
    assert all(found[100 + i].text == copies[0][1] for i in range(9))
    assert found[200].text is None and found[201].text == "" and found[5].template == "keep"
    assert line_dedup.drop_recurring_lines(docs).where("lines_dropped > 0").count() == 0


def test_a_line_that_is_most_of_its_documents_recurs(session):
    passage = " ".join(f"boiler{chr(97 + j)}" for j in range(40))
    rows = [(i, f"only title{chr(97 + i)} of this page\n{passage}") for i in range(12)]
    copies = [(100 + i, "the same line in copies\nand a second line in copies") for i in range(12)]
    found = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(session.createDataFrame(rows + copies, "doc_id long, text string")).collect()}
    assert found[0] == rows[0][1] and all(found[i] == rows[i][1].split("\n")[0] for i in range(1, 12))
    assert all(found[i] == text for i, text in copies)


def test_short_lines_and_lines_without_spaces_recur(session):
    def dropped(lines, n):
        own = [f"own {' '.join(f'x{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}' for j in range(8))}" for i in range(n)]
        rows = [(i, "\n".join([own[i], "", *(x(i) if callable(x) else x for x in lines)])) for i in range(n)]
        found = line_dedup.drop_recurring_lines(session.createDataFrame(rows, "doc_id long, text string")).collect()
        return {r.lines_dropped for r in found if r.doc_id}, {r.lines_dropped for r in found if r.doc_id == 0}

    for tokens, floor in ((4, 5), (3, 5), (2, 40), (1, 80)):
        line = " ".join(["alpha", "beta", "gamma", "delta"][:tokens])
        assert dropped([line, lambda i: f"v{i}"], floor) == ({1}, {0}) and dropped([line], floor - 1) == ({0}, {0})
    assert dropped([lambda i: ("All\trights \u00a0reserved.", " All rights reserved.\r")[i % 2]], 5) == ({1}, {0})
    tabs, han = "one\ttwo\tthree\u00a0four\u3000five six", "".join(chr(0x4E00 + 7 * i) for i in range(40))
    assert dropped([tabs, han, lambda i: f"{han}{chr(0x5E00 + i)}{han[::-1]}"], 5) == ({3}, {0})


def test_long_lines_recur_from_two_documents(session):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    long, middling = " ".join(words), " ".join(words[:49])
    rows = [(0, f"first own line of text\n{long}\n{middling}"), (1, f"a second own line of text\n{middling}\n{long}"), (2, long), (3, long)]
    found = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(session.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: rows[0][1], 1: f"a second own line of text\n{middling}", 2: "", 3: ""}
    copies = session.createDataFrame([(i, f"{long}\n{middling}") for i in range(3)], "doc_id long, text string")
    assert line_dedup.drop_recurring_lines(copies).where("lines_dropped > 0").count() == 0


def test_url_rules_and_templates(session):
    urls = [None, "no scheme", "http://A.Example.NET/en/x", "http://net?q", "https://b.example.com/de/1#t", "ftp://fr.org/fr/", "http://x.org/fr"]
    pages = [(i, u, "h") for i, u in enumerate(urls)]
    pages += [(1000 + i, f"http://shop.example.org/{'good' if i % 2 else 'bad'}/{i}?a=/b", "h") for i in range(200)]
    labels = [(1000 + i, 0 if i % 2 else 1) for i in range(150)] + [(None, 1), (1001, None)]
    found = url_filter.filter_urls(
        session.createDataFrame(pages, "page_id long, url string, host string"), session.createDataFrame(labels, "page_id long, bad long")
    ).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[3] == ("net", "", None, "allow")
    assert got[4] == ("b.example.com", "/de/1", "example.com/de/", "block")
    assert got[5] == ("fr.org", "/fr/", "org/fr/", "allow") and got[6][2:] == (None, "allow")
    assert all(got[1000 + i][3] == ("allow" if i % 2 else "block") for i in range(200))


def test_chat_links_quotes(session):
    rows = [
        (1, 0, "u", "First point.\nSecond point.\n\nAnother thing"),
        (1, 1, "a", "> second  POINT.\nI agree"),
        (1, 2, "u", ">> Second point.\n> I agree\nGood"),
        (1, 3, "a", "> Another thing\nWhat about it"),
        (1, 4, "u", "no quote"),
        (1, 6, "u", "> never written\nalone"),
        (2, 0, "u", None),
        (2, 1, "a", ""),
        (None, 1, "a", "> x"),
    ]
    table = session.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, root int")
    got = {(r.conv_id, r.turn): (r.text, r.answers, r.root, r.depth, r.n_linked) for r in chat.link_conversations(table).collect()}
    assert got[1, 1] == ("I agree", 0, 0, 1, 1)
    assert got[1, 2] == ("Good", 1, 0, 2, 2)
    assert got[1, 3] == ("What about it", 0, 0, 1, 1)
    assert got[1, 4] == ("no quote", 3, 0, 2, 0)
    assert got[1, 6] == ("alone", None, 6, 0, 0)
    assert got[2, 0] == (None, None, 0, 0, 0) and got[2, 1] == ("", 0, 0, 1, 0)
    assert got[None, 1][:2] == ("", None)
