"""Line templates and quoted conversations against plain versions written from their definitions."""

import random
import re
from collections import defaultdict

import pytest

from tests.conftest import SMALL
from threatloom.llm import chat, line_dedup
from threatloom.llm.common import prepare


@pytest.fixture(scope="module")
def ready(spark):
    return prepare(spark)


WHITE = re.compile("[\t\x0b\f\r\x1c-\x1f\x85\xa0  -     　]")


def tokens_of(line):
    words = [w for w in line.split(" ") if w]
    if len(line.encode()) > 30 * len(words):
        bare = line.replace(" ", "")
        return [bare[i : i + 2] for i in range(0, len(bare), 2)]
    return words


def templates_of(line):
    """(kind, template) of a line, and what stands for the line in its document's content."""
    spaced = WHITE.sub(" ", line)
    tokens, exact = tokens_of(re.sub("[0-9]+", "#", spaced)), tokens_of(spaced)
    n = len(tokens)
    if n == 0:
        return [], None
    if n < 5:
        return [(n, ("short", n, tuple(exact)))], (n, tuple(exact))
    width = -(-(n - 2) // 4)
    fields = [tuple(tokens[2 + width * i : 2 + width * (i + 1)]) for i in range(4)]
    whole = (n, tuple(tokens[:2]), *fields)
    kind = "long" if n >= 50 else "plain"
    wild = [(kind, ("wild", n, tuple(tokens[:2]), i, *fields[:i], *fields[i + 1 :])) for i in range(4)] if n >= 6 else []
    return [(kind, whole), *wild], whole


def drop_by_brute_force(rows):
    contents, first = defaultdict(set), {}
    for doc_id, text in rows:
        if doc_id is None or text is None:
            continue
        found = [templates_of(line) for line in text.split("\n")]
        content = frozenset(c for _, c in found if c is not None)
        for templates, _ in found:
            for t in templates:
                contents[t].add(content)
                first[t] = min(first.get(t, doc_id), doc_id)
    floor = {"long": 2, "plain": 5, 1: 80, 2: 40, 3: 5, 4: 5}
    recurring = {t for t, c in contents.items() if len(c) >= floor[t[0]]}
    gone = defaultdict(dict)
    for doc_id, text in rows:
        for line in (text or "").split("\n") if doc_id is not None else ():
            own = [t for t in templates_of(line)[0] if t in recurring]
            if own:
                gone[doc_id][line] = gone[doc_id].get(line, False) or any(first[t] == doc_id for t in own)
    out = []
    for doc_id, text in rows:
        dropped = {line for line, kept in gone[doc_id].items() if not kept} if doc_id is not None and text is not None else set()
        left = None if text is None else [line for line in text.split("\n") if line not in dropped]
        out.append((doc_id, None if left is None else "\n".join(left), 0 if left is None else len(text.split("\n")) - len(left)))
    return out


def test_line_templates_equal_a_plain_version(ready):
    draw = random.Random(8)
    rows = [tuple(r) for r in ready.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    frames = ["user {} logged in from host {} at gate {}", "read more", "one two three {}", "all rights reserved 2024 by {}", "x {} y", "", "  ", "日本語の長い行です" * 6 + "{}"]
    frames += [" ".join(f"word{i}" for i in range(55)) + " {}", "tab\tcut line with\xa0odd spaces {} end", "single"]
    for i in range(260):
        lines = [draw.choice(frames).format(*[draw.choice(["7", "42", "alpha", "beta", "gamma"]) for _ in range(3)]) for _ in range(draw.randint(1, 4))]
        rows.append((10_000 + i // 2 * 2 + i % 2 * (i % 3 > 0), "\n".join(lines + [f"own {draw.random()}"])))
    rows += [(None, "read more\nread more"), (3, None), (20_000, ""), (rows[0][0], rows[1][1])]
    found = line_dedup.drop_recurring_lines(ready.createDataFrame(rows, "doc_id long, text string"))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted((tuple(r) for r in found.select("doc_id", "text", "lines_dropped").collect()), key=key)
    expected = drop_by_brute_force(rows)
    assert got == sorted(expected, key=key)
    assert sum(r[2] for r in expected) > 200


def plain(text):
    return " ".join(text.lower().split())


def parsed(text):
    """Own text, quoted (level, passage) and written passages of a message, line by line."""
    runs, last = [], None
    for line in text.split("\n"):
        marks = re.match(r"(?:[ \t]*>)*", line).group()
        body = line[len(marks) :]
        level = marks.count(">")
        if not body.strip():
            last = None
            continue
        if last is None or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(body)
        last = level
    spread = [(level, p) for level, lines in runs for p in ([plain("\n".join(lines))] + ([plain(x) for x in lines] if len(lines) > 1 else [])) if p]
    own = "\n".join(x for x in text.split("\n") if not re.match(r"[ \t]*>", x)).strip()
    return own, [x for x in spread if x[0]], {p for level, p in spread if not level}


def link_by_brute_force(messages):
    out = []
    for conv in {m[0] for m in messages}:
        own = sorted((m for m in messages if m[0] == conv), key=lambda m: m[1])
        read = {turn: parsed(text) for _, turn, _, text in own}
        answers = {}
        for turn, (_, quoted, _) in read.items():
            best, linked = None, set()
            for level, passage in quoted:
                earlier = [t for t in read if t < turn and passage in read[t][2]]
                if earlier:
                    linked.add(passage)
                    best = min(best or (10**9, 0), (level, -max(earlier)))
            answers[turn] = (-best[1] if best else turn - 1 if turn - 1 in read else None, len(linked))
        for _, turn, role, _ in own:
            root, depth = turn, 0
            while answers[root][0] is not None:
                root, depth = answers[root][0], depth + 1
            out.append((conv, turn, role, read[turn][0], answers[turn][0], root, depth, len(read[turn][1]), answers[turn][1]))
    return out


def test_quoted_conversations_equal_a_plain_version(ready):
    draw = random.Random(12)
    said = ["yes", "No, not at all.", "The train leaves at nine.", "see below", "What do you mean by that?", "ok", "Thanks for the long and careful answer"]
    messages = []
    for conv in range(40):
        history = []
        for turn in range(draw.randint(1, 25)):
            lines = []
            for _ in range(draw.randint(0, 3)):
                if history and draw.random() < 0.8:
                    level = 1
                    for piece in draw.choice(history[-6:]).split("\n")[: draw.randint(1, 4)]:
                        body = piece.upper() if draw.random() < 0.2 else piece
                        lines.append(draw.choice([">", "> ", " >"]) * level + " " + draw.choice(["", "  "]) + body)
                lines += draw.choices([*said, f"own words {conv} {turn} {draw.random()}", "", "> never written by anyone", ">> ok"], k=draw.randint(0, 3))
            text = "\n".join(lines)
            history.append(text)
            if draw.random() < 0.97:  # some turns are missing
                messages.append((conv, turn, draw.choice(["user", "assistant"]), text))
    table = ready.createDataFrame([(*m, 1, 2) for m in messages], "conv_id long, turn int, role string, text string, root int, level int")
    found = sorted(tuple(r) for r in chat.link_conversations(table).collect())
    expected = sorted(link_by_brute_force(messages))
    assert found == expected
    assert sum(r[8] > 0 for r in expected) > 100 and max(r[6] for r in expected) > 5
