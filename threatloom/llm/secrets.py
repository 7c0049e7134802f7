"""Secret scans by one deterministic automaton over bytes.

The regexes of all rules are compiled to one nondeterministic automaton that may start at every byte, made
deterministic by subset construction, minimised, and written as transition arrays over byte classes. One pass over a
text tells where any rule ends a match. A second automaton, of the reversed rule, finds where that match began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threatloom.llm.common import slices

_SLICE = 4 << 20

# The base rules and their order, as (kind, pattern, least characters, what the characters count).
# (?i: ) takes letters in either case. Runs of 32 hexadecimal digits are maximal runs, so their least length can be
# part of the pattern; the automaton then stays silent in ordinary words.
BASE_RULES = [
    ("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+", 8, "value"),
    ("access", "AKIA[A-Z0-9]+", 16, "match"),
    ("hex", "[0-9a-f]{32,}", 32, "match"),
]
# Rules that the method adds: published formats of tokens and keys.
MORE_RULES = [
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, "match"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 40, "match"),
]
_VALUE = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


class Pattern:
    """A nondeterministic automaton of one regex: literals, escapes, classes, groups, alternatives, ? * +."""

    def __init__(self, source: str, reverse: bool = False):
        self.source, self.at, self.reverse, self.fold = source, 0, reverse, False
        self.moves: list[list[tuple[frozenset[int] | None, int]]] = []
        self.start, self.end = self._either()
        if self.at != len(source):
            raise ValueError(f"unreadable pattern at {self.at}: {source}")

    def _state(self) -> int:
        self.moves.append([])
        return len(self.moves) - 1

    def _either(self) -> tuple[int, int]:
        begin, end = self._state(), self._state()
        while True:
            first, last = self._sequence()
            self.moves[begin].append((None, first))
            self.moves[last].append((None, end))
            if self.source[self.at : self.at + 1] != "|":
                return begin, end
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        parts = []
        while self.at < len(self.source) and self.source[self.at] not in "|)":
            parts.append(self._repeated())
        if self.reverse:
            parts.reverse()
        begin = here = self._state()
        for first, last in parts:
            self.moves[here].append((None, first))
            here = last
        return begin, here

    def _repeated(self) -> tuple[int, int]:
        begun = self.at
        first, last = self._atom()
        sign = self.source[self.at : self.at + 1]
        if sign == "{":
            # {n,}: so many copies in a row, the last of which repeats.
            after = self.source.index("}", self.at) + 1
            least = int(self.source[self.at + 1 : after - 2])
            loop, until = first, last
            for _ in range(least - 1):
                self.at = begun
                loop, end = self._atom()
                self.moves[until].append((None, loop))
                until = end
            self.moves[until].append((None, loop))
            self.at = after
            return first, until
        if sign and sign in "?*+":
            self.at += 1
            begin, end = self._state(), self._state()
            self.moves[begin].append((None, first))
            self.moves[last].append((None, end))
            if sign in "?*":
                self.moves[begin].append((None, end))
            if sign in "*+":
                self.moves[last].append((None, first))
            return begin, end
        return first, last

    def _atom(self) -> tuple[int, int]:
        c = self.source[self.at]
        if c == "(":
            folded = self.fold
            self.at += 1
            if self.source.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            inner = self._either()
            self.at += 1
            self.fold = folded
            return inner
        if c == "[":
            close = self.source.index("]", self.at + 1)
            taken = self._class(self.source[self.at + 1 : close])
            self.at = close + 1
        else:
            taken = {self._byte()}
        if self.fold:
            taken |= {x ^ 32 for x in taken if chr(x).isalpha()}
        begin, end = self._state(), self._state()
        self.moves[begin].append((frozenset(taken), end))
        return begin, end

    def _byte(self) -> int:
        c = self.source[self.at]
        self.at += 1
        if c != "\\":
            return ord(c)
        if self.source[self.at] == "x":
            self.at += 3
            return int(self.source[self.at - 2 : self.at], 16)
        self.at += 1
        return ord(self.source[self.at - 1])

    @staticmethod
    def _class(body: str) -> set[int]:
        taken, i = set(), 0
        while i < len(body):
            if i + 2 < len(body) and body[i + 1] == "-":
                taken |= set(range(ord(body[i]), ord(body[i + 2]) + 1))
                i += 3
            else:
                taken.add(ord(body[i]))
                i += 1
        return taken


class Automaton:
    """The minimal deterministic automaton of several patterns: ``rows[state][class]`` is the next state.

    ``labels[state]`` has the numbers of the patterns that end a match in the state. With ``everywhere`` a match may
    begin at every byte, else only at the first.
    """

    def __init__(self, patterns: list[Pattern], everywhere: bool):
        moves, ends, starts = [], {}, set()
        for number, p in enumerate(patterns):
            shift = len(moves)
            moves += [[(on, to + shift) for on, to in state] for state in p.moves]
            starts.add(p.start + shift)
            ends[p.end + shift] = number
        self.classes, kinds = self._byte_classes(moves)
        first = self._closed(moves, starts)
        numbered, rows, labels = {first: 0}, [], []
        waiting = [first]
        for state in waiting:
            labels.append(frozenset(ends[s] for s in state if s in ends))
            row = []
            for byte in kinds:
                to = {t for s in state for on, t in moves[s] if on is not None and byte in on}
                after = self._closed(moves, to | starts if everywhere else to)
                if after not in numbered:
                    numbered[after] = len(numbered)
                    waiting.append(after)
                row.append(numbered[after])
            rows.append(row)
        self.rows, self.labels = self._minimal(rows, labels)
        self.dead = next((i for i, r in enumerate(self.rows) if not self.labels[i] and set(r) == {i}), None)

    @staticmethod
    def _byte_classes(moves) -> tuple[bytes, list[int]]:
        """Bytes that no move tells apart are one class."""
        tests = {on for state in moves for on, _ in state if on is not None}
        groups: dict[tuple, int] = {}
        table, kinds = bytearray(256), []
        for byte in range(256):
            seen = tuple(byte in on for on in tests)
            if seen not in groups:
                groups[seen] = len(groups)
                kinds.append(byte)
            table[byte] = groups[seen]
        return bytes(table), kinds

    @staticmethod
    def _closed(moves, states: set[int]) -> frozenset[int]:
        seen, waiting = set(states), list(states)
        while waiting:
            for on, to in moves[waiting.pop()]:
                if on is None and to not in seen:
                    seen.add(to)
                    waiting.append(to)
        return frozenset(seen)

    @staticmethod
    def _minimal(rows, labels) -> tuple[list[list[int]], list[frozenset[int]]]:
        """Refine the partition by labels until states of a part agree on the part of every successor."""
        part = np.unique([sum(1 << n for n in x) for x in labels], return_inverse=True)[1]
        table = np.array(rows)
        while True:
            signs = np.column_stack([part, part[table]])
            again = np.unique(signs, axis=0, return_inverse=True)[1].ravel()
            if again.max() == part.max():
                break
            part = again
        # Number the parts in order of their first state, so that the start stays 0.
        names: dict[int, int] = {}
        for x in part:
            names.setdefault(int(x), len(names))
        new_rows, new_labels = [None] * len(names), [None] * len(names)
        for state, x in enumerate(part):
            name = names[int(x)]
            if new_rows[name] is None:
                new_rows[name] = [names[int(part[to])] for to in rows[state]]
                new_labels[name] = labels[state]
        return new_rows, new_labels


class Scanner:
    def __init__(self, rules=None):
        self.rules = rules if rules is not None else BASE_RULES + MORE_RULES
        self.forward = Automaton([Pattern(r[1]) for r in self.rules], everywhere=True)
        self.alone = [Automaton([Pattern(r[1])], everywhere=False) for r in self.rules]
        self.backward = [Automaton([Pattern(r[1], reverse=True)], everywhere=False) for r in self.rules]
        # States as flat offsets; those that end a match come last, so one comparison finds them.
        width = max(self.forward.rows[0].__len__(), 1)
        order = sorted(range(len(self.forward.rows)), key=lambda s: (bool(self._loud(s)), s))
        place = {s: i * width for i, s in enumerate(order)}
        self.flat = [place[to] for s in order for to in self.forward.rows[s]]
        self.loud_from = width * sum(not self._loud(s) for s in order)
        self.begin = place[0]
        self.ending = {place[s]: sorted(self._loud(s)) for s in order if self._loud(s)}

    def _loud(self, state: int) -> frozenset[int]:
        return self.forward.labels[state]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(rule, end) at every byte where a rule ends a match; the one pass over the text."""
        found = []
        flat, loud, state, ending = self.flat, self.loud_from, self.begin, self.ending
        i = 0
        for c in data.translate(self.forward.classes):
            i += 1
            state = flat[state + c]
            if state >= loud:
                for rule in ending[state]:
                    found.append((rule, i))
        return found

    def _reach(self, automaton: Automaton, data: bytes, at: int, step: int, stop: int) -> int:
        """The farthest position at which ``automaton``, started at ``at``, is in an end state."""
        state, best, classes, rows = 0, at, automaton.classes, automaton.rows
        while at != stop:
            byte = data[at] if step > 0 else data[at - 1]
            state = rows[state][classes[byte]]
            at += step
            if automaton.labels[state]:
                best = at
            elif state == automaton.dead:
                break
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes: per rule leftmost, longest and not overlapping; short matches are left out."""
        consumed = [0] * len(self.rules)
        spans = []
        for rule, end in self.ends(data):
            if end <= consumed[rule]:
                continue
            start = self._reach(self.backward[rule], data, end, -1, consumed[rule])
            if start == end:
                continue
            stop = self._reach(self.alone[rule], data, start, 1, len(data))
            consumed[rule] = stop
            _, _, least, counted = self.rules[rule]
            body = data[start:stop]
            if counted == "value":
                size = 0
                while size < len(body) and body[-1 - size] in _VALUE:
                    size += 1
                # The value begins after the sign; a sign that may stand in values is not part of it.
                size = min(size, len(body) - self._sign_end(body))
            else:
                size = len(body)
            if size >= least:
                spans.append((start, rule, stop))
        return sorted(spans)

    @staticmethod
    def _sign_end(body: bytes) -> int:
        """Where the value of an assignment begins: after the first : or =, spaces and a quote."""
        at = min(i for i in (body.find(b":"), body.find(b"=")) if i >= 0) + 1
        while body[at : at + 1] == b" ":
            at += 1
        return at + (body[at : at + 1] in (b'"', b"'"))


def scan(docs: DataFrame, rules=None) -> DataFrame:
    """(doc_id, spans) per row: spans as (kind, start, end, base) in code points, the end exclusive, by start and rule.

    A null or empty text has no spans. Per kind, matches are leftmost, longest and do not overlap; kinds may overlap
    each other. Rows are independent; nothing is shuffled.
    """
    scanner = Scanner(rules)
    base = {r[0] for r in BASE_RULES}
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, texts in slices(batches, "text", _SLICE):
            rows = []
            for data in texts:
                spans = own.spans(data or b"")
                if spans:
                    # Bytes to code points: continuation bytes do not count.
                    points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
                    spans = [(int(points[s]), r, int(points[e])) for s, r, e in spans]
                rows.append([{"kind": own.rules[r][0], "start": s, "end": e, "base": own.rules[r][0] in base} for s, r, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(rows, kind)], names=["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
