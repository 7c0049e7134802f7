"""Benchmark decontamination by suffix arrays over the documents.

Documents are cut into shards. In a shard every word that occurs in the benchmark is a number, every other word ends
a run. The suffixes that are long enough to hold a window are sorted by their next 13 words; the suffixes of the
benchmark items are found in that array by binary search, which gives all places where they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import LETTERS_DIGITS, Words, slices

WINDOW = 13
# The benchmark goes to the tasks in blocks of at most so many bytes of text; each block is one pass over a shard.
BLOCK_BYTES = 16 << 20
_SLICE = 8 << 20
# In place of a word before the first or after the last of an item.
_EDGE = 0xFFFFFFFF

_STATE = "n_words long, places array<struct<item:string,at:long,length:long>>"


class Suffixes:
    """The windows of one block of the benchmark, as rows of word numbers."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        words = Words([text for _, text in items], LETTERS_DIGITS)
        self.window = window
        self.vocabulary, number = np.unique(words.hash, return_inverse=True)
        number = number.astype(np.uint32) + 1
        keys, owner, widths, before, after = [], [], [], [], []
        for i in range(len(items)):
            own = number[words.first[i] : words.first[i + 1]]
            width = min(window, len(own))
            if width:
                count = len(own) - width + 1
                rows = np.zeros((count, window), dtype=np.uint32)
                for j in range(width):
                    rows[:, j] = own[j : count + j]
                keys.append(rows)
                owner.append(np.full(count, i))
                widths.append(np.full(count, width))
                before.append(np.concatenate(([_EDGE], own[: count - 1])))
                after.append(np.concatenate((own[width:], [_EDGE])))

        def joined(parts: list[np.ndarray]) -> np.ndarray:
            return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)

        # Per window: its item, its length, and the item's words before and after it.
        self.names = [name for name, _ in items]
        self.owner, self.width, self.before, self.after = joined(owner), joined(widths), joined(before), joined(after)
        self.shortest = int(self.width.min()) if len(self.width) else window + 1
        # Equal windows are searched once: those of window kind j are by[bounds[j]:bounds[j + 1]].
        rows = np.concatenate(keys) if keys else np.empty((0, window), np.uint32)
        packed = self.packed(rows)
        self.by = np.argsort(packed, kind="stable")
        new = np.flatnonzero(np.append(True, packed[self.by][1:] != packed[self.by][:-1])) if len(packed) else np.empty(0, np.int64)
        self.bounds = np.append(new, len(packed))
        rows = rows[self.by[new]]
        self.low = self.packed(rows)
        rows[np.arange(window) >= self.width[self.by[new]][:, None]] = 0xFFFFFFFF
        self.high = self.packed(rows)

    @staticmethod
    def packed(rows: np.ndarray) -> np.ndarray:
        """Rows as byte strings that sort like the rows do."""
        width = rows.shape[1] * 4
        return np.ascontiguousarray(rows.astype(">u4")).view(f"S{width}").ravel()

    def places(self, words: Words) -> list[list[tuple[str, int, int]]]:
        """Per text of the shard: (item, first word, words) of every maximal verbatim match with a window."""
        found: list[list[tuple[str, int, int]]] = [[] for _ in range(len(words.first) - 1)]
        total = len(words.hash)
        if not len(self.by) or not total:
            return found
        at = np.searchsorted(self.vocabulary, words.hash)
        at[at == len(self.vocabulary)] = 0
        number = np.where(self.vocabulary[at] == words.hash, at + 1, 0).astype(np.uint32)
        # Known words from each position on, within its text.
        stop = np.append(number == 0, True)
        stop_at = np.where(stop, np.arange(total + 1), total)
        run_end = np.minimum.accumulate(stop_at[::-1])[::-1][:total]
        run_end = np.minimum(run_end, words.first[words.owner + 1])
        length = run_end - np.arange(total)
        starts = np.flatnonzero(length >= self.shortest)
        if not len(starts):
            return found
        # The suffix array: suffixes cut at the window, shorter ones padded with 0, which no word has.
        padded = np.append(number, np.zeros(self.window, dtype=np.uint32))
        rows = padded[starts[:, None] + np.arange(self.window)]
        rows[np.arange(self.window) >= length[starts][:, None]] = 0
        keys = self.packed(rows)
        order = np.argsort(keys, kind="stable")
        array, starts = keys[order], starts[order]
        low = np.searchsorted(array, self.low, side="left")
        high = np.searchsorted(array, self.high, side="right")
        # A maximal match starts where the words before it differ and ends where those after it differ. Only such
        # ends are listed, so a repeated word costs what the matches are, not every window at every place.
        text = words.owner
        known = number.astype(np.int64)
        head, tail = [], []
        for kind in np.flatnonzero(high > low):
            at = starts[low[kind] : high[kind]]
            windows = self.by[self.bounds[kind] : self.bounds[kind + 1]]
            width = int(self.width[windows[0]])
            head.append(_unlike(at, np.where(at > words.first[text[at]], known[at - 1], 0), windows, self.before[windows]))
            next_at = np.minimum(at + width, total - 1)
            tail.append(_unlike(at, np.where(at + width < words.first[text[at] + 1], known[next_at], 0), windows, self.after[windows]))
        if not head:
            return found
        (p, k), (last, end_k) = (np.concatenate(x, axis=1) for x in (head, tail))
        # On a diagonal matches do not overlap, so the n-th start belongs to the n-th end.
        order, end_order = np.lexsort((p, k - p)), np.lexsort((last, end_k - last))
        p, k, last, end_k = p[order], k[order], last[end_order], end_k[end_order]
        length = last + self.width[end_k] - p
        for t, item, first, n in zip(text[p].tolist(), self.owner[k].tolist(), (p - words.first[text[p]]).tolist(), length.tolist(), strict=True):
            found[t].append((self.names[item], first, n))
        return found


def _unlike(places: np.ndarray, there: np.ndarray, windows: np.ndarray, here: np.ndarray) -> np.ndarray:
    """(place, window) pairs whose neighbouring words differ, as two rows."""
    pairs = []
    for word in np.unique(here):
        own, other = windows[here == word], places[there != word]
        pairs.append(np.stack((np.repeat(other, len(own)), np.tile(own, len(other)))))
    return np.concatenate(pairs, axis=1)


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = shared.value
        for batch, texts in slices(batches, "text", _SLICE):
            words = Words(texts, LETTERS_DIGITS)
            before = batch.column(3).to_pylist()
            places = [
                sorted({*((x["item"], x["at"], x["length"]) for x in old or ()), *new}, key=lambda x: (x[1], x[2], x[0] or ""))
                for old, new in zip(before, suffixes.places(words), strict=True)
            ]
            kind = pa.list_(pa.struct([("item", pa.string()), ("at", pa.int64()), ("length", pa.int64())]))
            rows = [[{"item": i, "at": a, "length": n} for i, a, n in x] for x in places]
            counts = np.diff(words.first)[: len(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(counts, pa.int64()), pa.array(rows, kind)],
                names=["doc_id", "text", "n_words", "places"],
            )

    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes | None]]]:
    """The benchmark in blocks of about ``block_bytes``; only one block at a time is on the driver."""
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    for i in range(count):
        block = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        rows = block.collect()
        yield sorted(((r.item_id, r.text.encode()) for r in rows), key=lambda x: (x[0] or "", x[1]))


def matches(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text, n_words, places) per row of ``docs``; a place is a maximal verbatim match: item, first word, length.

    Words are lower-cased runs of letters, digits and non-ASCII characters. A match holds at least one window: 13
    consecutive words of the item, or the whole of a shorter one. Null texts and texts without words match nothing;
    items without words occur nowhere. Repeated items match alike. Nothing is shuffled.
    """
    context = docs.sparkSession.sparkContext
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.lit(None).cast("long").alias("n_words"),
        F.lit(None).cast("array<struct<item:string,at:bigint,length:bigint>>").alias("places"),
    )
    for items in _blocks(benchmark, block_bytes):
        shared = context.broadcast(Suffixes(items))
        found = found.mapInArrow(_scan(shared), "doc_id long, text string, " + _STATE)
    return found


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit, counts, digests, longest = [], [], [], []
        for places in batch.column(2).to_pylist():
            covered, end = 0, 0
            for x in sorted(places, key=lambda x: x["at"]):
                covered += max(0, x["at"] + x["length"] - max(end, x["at"]))
                end = max(end, x["at"] + x["length"])
            items = sorted({x["item"] for x in places if x["item"] is not None})
            hit.append(covered)
            counts.append(len(items))
            digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            longest.append(max((x["length"] for x in places), default=0))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(longest, pa.int64())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "longest_match"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, longest_match, contaminated) per row of ``docs``.

    ``n_hit`` counts words inside matches; a document is contaminated when they are at least a twentieth of its
    words. Items with a null item_id hit words but are not listed. Other cases: see ``matches``.
    """
    found = matches(docs, benchmark, block_bytes).select("doc_id", "n_words", "places")
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, longest_match long"
    return found.mapInArrow(_judged, schema).withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated; rows that share a doc_id with a contaminated one go too."""
    gone = contamination(docs, benchmark).where("contaminated").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
