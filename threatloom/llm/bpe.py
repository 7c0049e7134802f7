"""Byte-pair encoding by backtracking, and decoding by an offset table.

A word is cut from the left into the longest tokens that are compatible with their neighbours; where none fits, the
last token is taken back and a shorter one tried. Two neighbouring tokens are compatible when the merge order would
never join across their border. The result equals applying the merges one by one.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from threatloom.llm.common import slices

_SLICE = 4 << 20
_CACHED_WORDS, _CACHED_PAIRS = 200_000, 400_000
# Fixed values of the vocabulary: how its files mark the last symbol of a word, and what separates tokens in text.
_WORD_END = "</w>"
_END_SHIFT = 0x10000
_WHITE = "\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value: itself, or the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


def _joined(token: str) -> str:
    """A token with the mark of the word end folded into its last symbol."""
    if not token.endswith(_WORD_END):
        return token
    body = token[: -len(_WORD_END)]
    return body[:-1] + chr(ord(body[-1]) + _END_SHIFT)


class WordPairs:
    """A vocabulary of merges: encoder and decoder. Built once, sent to the executors, used read-only but for a cache."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids = {_joined(t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, bytes] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            one, two = self.ids[_joined(left)], self.ids[_joined(right)]
            whole = self.ids[_joined(left + right)]
            self.rank[one, two] = rank
            # A token is what its first merge makes it: the split that the merge order reaches.
            self.parts.setdefault(whole, (one, two, rank))
        self.automaton = ahocorasick.Automaton()
        reached = self._reached()
        for token, i in self.ids.items():
            if i in reached:
                self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        pieces = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        spelled = [pieces.get(i, "").encode() for i in range(max(pieces) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(p) + 1 for p in spelled])))
        self.spelled = np.frombuffer(b" ".join(spelled) + b" ", dtype=np.uint8)
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")

    def _fits(self, left: int, right: int) -> bool:
        """Whether both tokens survive side by side: no merge across their border comes before what formed them."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= _CACHED_PAIRS:
                self.compatible.clear()
            known = self.compatible[left, right] = self._across(left, right) == (None, True)
        return known

    def _across(self, left: int, right: int) -> tuple[int | None, bool]:
        """The first merge that is due across the border of two tokens, and whether both were complete by then.

        The border sees the right edge of ``left`` and the left edge of ``right`` as they grow, merge by merge. A
        merge across happens when it is due before the next growth on either side; at equal rank the leftmost pair
        is joined first.
        """
        lefts, rights = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            due_left = lefts[i + 1][1] if i + 1 < len(lefts) else None
            due_right = rights[j + 1][1] if j + 1 < len(rights) else None
            nearest = min((x for x in (due_left, due_right) if x is not None), default=None)
            across = self.rank.get((lefts[i][0], rights[j][0]))
            if across is not None and (nearest is None or across < nearest or (across == nearest and due_left != nearest)):
                return across, nearest is None
            if nearest is None:
                return None, True
            if due_left == nearest:
                i += 1
            else:
                j += 1

    def _reached(self) -> set[int]:
        """Tokens that the merges of their own symbols do end in; no text is cut into any other."""
        reached = {i for i in self.ids.values() if i not in self.parts}
        for whole, (one, two, rank) in sorted(self.parts.items(), key=lambda x: x[1][2]):
            if one in reached and two in reached and self._across(one, two) == (rank, True):
                reached.add(whole)
        return reached

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge of ``token`` from the single symbol up, with the rank of the merge that made each."""
        chain = []
        while token in self.parts:
            chain.append((token, self.parts[token][2]))
            token = self.parts[token][side]
        chain.append((token, -1))
        return chain[::-1]

    def word(self, text: str) -> bytes:
        """Ids of one word, packed."""
        found = self.cache.get(text)
        if found is None:
            symbols = "".join(map(self.symbols.__getitem__, text.encode()))
            symbols = symbols[:-1] + chr(ord(symbols[-1]) + _END_SHIFT)
            found = array("I", self._cut(symbols)).tobytes()
            if len(self.cache) >= _CACHED_WORDS:
                self.cache.clear()
            if len(text) <= 64:
                self.cache[text] = found
        return found

    def _cut(self, symbols: str) -> list[int]:
        size = len(symbols)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, (length, token) in self.automaton.iter(symbols):
            starting[end + 1 - length].append((length, token))
        dead = bytearray(size + 1)
        path: list[tuple[int, int, int]] = []
        at, choice = 0, len(starting[0]) - 1
        while at < size:
            options = starting[at]
            while choice >= 0:
                length, token = options[choice]
                if not dead[at + length] and (not path or self._fits(path[-1][2], token)):
                    break
                choice -= 1
            if choice >= 0:
                path.append((at, choice, token))
                at += length
                choice = len(starting[at]) - 1 if at < size else -1
            else:
                dead[at] = 1
                at, choice, _ = path.pop()
                choice -= 1
        return [token for _, _, token in path]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens give their ids wherever they stand."""
        pieces = []
        at = 0
        for found in self.specials.finditer(text):
            pieces += map(self.word, self._words(text[at : found.start()]))
            pieces.append(array("I", [self.special[found.group()]]).tobytes())
            at = found.end()
        pieces += map(self.word, self._words(text[at:]))
        return np.frombuffer(b"".join(pieces), dtype="<u4")

    @staticmethod
    def _words(text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # Lower-cased character by character: the last letter of a word gets no form of its own.
        text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        return regex.findall(_WORD, text)

    def decode(self, ids: np.ndarray) -> bytes:
        """The spelled tokens, one space between them: gathered from the table by their offsets."""
        if not len(ids):
            return b""
        begin = self.offsets[ids]
        length = self.offsets[ids + 1] - begin
        ends = np.cumsum(length)
        source = np.arange(ends[-1]) + np.repeat(begin - (ends - length), length)
        return self.spelled[source[:-1]].tobytes()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) per row: ids of the whole text as little-endian 32-bit integers, and their decoding.

    A null or empty text has no ids and decodes to an empty text. Rows are independent; nothing is shuffled. ``path``
    names the vocabulary file on the driver; its tables (of fixed size) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(WordPairs(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value
        for batch, texts in slices(batches, "text", _SLICE):
            ids = [pairs.encode((t or b"").decode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                    pa.array([pairs.decode(x.astype(np.int64)).decode() for x in ids], pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, decoded string")
