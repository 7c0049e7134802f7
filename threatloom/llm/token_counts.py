"""Token counts of a unigram vocabulary without making the tokens.

An Aho-Corasick automaton enumerates all pieces that end at each character of a word; dynamic programming carries the
best score and the number of pieces that reach it. Ties are resolved as the tokenizers' lattice does: the first that
reached a place stays, and pieces are tried by where they begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from threatloom.llm.common import slices

_SLICE = 4 << 20
_CACHED_WORDS = 300_000
_SPACE = "▁"
# Fixed value of the tokenizers: how far an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min((float(s) for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        found = self.cache.get(word)
        if found is None:
            found = self._pieces(word)
            if len(self.cache) >= _CACHED_WORDS:
                self.cache.clear()
            if len(word) <= 64:
                self.cache[word] = found
        return found

    def _pieces(self, word: str) -> int:
        """The number of pieces on the best path; neighbouring unknown characters are one piece."""
        size = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
        single = bytearray(size)
        for last, (length, score) in self.automaton.iter(word):
            ending[last + 1].append((length, score))
            if length == 1:
                single[last] = 1
        best, count, unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        for end in range(1, size + 1):
            top = None
            # Longest first is earliest start first.
            for length, score in sorted(ending[end], reverse=True):
                reached = best[end - length] + score
                if top is None or reached > top:
                    top, count[end], unknown[end] = reached, count[end - length] + 1, False
            if not single[end - 1]:
                reached = best[end - 1] + self.unknown
                if top is None or reached > top:
                    top, count[end], unknown[end] = reached, count[end - 1] + (not unknown[end - 1]), True
            best[end] = top
        return count[size]

    def count(self, text: str) -> int:
        """Pieces of a whole text: every space starts a word with a mark, and the text gets one in front."""
        if not text:
            return 0
        marked = text.replace(" ", _SPACE)
        parts = marked.split(_SPACE)
        if not marked.startswith(_SPACE):
            return sum(map(self.word, [_SPACE + p for p in parts]))
        return sum(map(self.word, [_SPACE + p for p in parts[1:]]))


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """(doc_id, n_tokens) per row of ``docs`` (doc_id, text).

    A null or empty text has no tokens. Rows are independent; nothing is shuffled. The vocabulary is broadcast; its
    size is that of a tokenizer's file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(UnigramCounter(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value
        for batch, texts in slices(batches, "text", _SLICE):
            counts = [counter.count((t or b"").decode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")
