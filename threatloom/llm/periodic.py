"""Periodic runs of words by block convolution.

A run with smallest period q is looked for at the scale B with B <= q < 2B (B a power of two). Every such run that is four
periods long holds a block of B words, starting at a multiple of 2B, that occurs again q words later. So at each scale
every such block is compared with the window that follows it at all distances B .. 2B-1 at once: the sum of squared
differences of word numbers is a convolution, taken exactly in integers by number-theoretic transforms, and a distance
of sum zero is an occurrence without mismatch. Each occurrence is a seed: extended to both sides as far as the period
holds, it is a run or too short to be one.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threatloom.llm.common import slices

# Shortest run: so many words, and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
# Primes k * 2**m + 1 below 2**31.1 with a primitive root; as many are used as the largest sum asks for.
PRIMES = ((2281701377, 3), (2013265921, 31), (469762049, 3))
_HASH_PRIME = (1 << 31) - 1
_SLICE = 1 << 20
_CELLS = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_OUT = f"doc_id long, n_words long, runs {RUNS}, best struct<start:bigint,length:bigint,period:bigint>, collapsed string"


def _twiddles(size: int, p: int, root: int) -> np.ndarray:
    """Powers 0 .. size/2-1 of a root of unity of order ``size``."""
    step = pow(root, (p - 1) // size, p)
    powers = np.ones(max(1, size // 2), dtype=np.uint64)
    done = 1
    while done < len(powers):
        powers[done : 2 * done] = powers[: min(done, len(powers) - done)] * np.uint64(pow(step, done, p)) % np.uint64(p)
        done *= 2
    return powers


def _forward(a: np.ndarray, p: int, root: int) -> np.ndarray:
    """Transform of each row; the result is in bit-reversed order, as ``_backward`` takes it."""
    rows, size = a.shape
    prime, half = np.uint64(p), size // 2
    while half:
        w = _twiddles(2 * half, p, root)
        v = a.reshape(rows, -1, 2, half)
        x, y = v[:, :, 0].copy(), v[:, :, 1]
        v[:, :, 0] = (x + y) % prime
        v[:, :, 1] = (x + prime - y) * w % prime
        half //= 2
    return a


def _backward(a: np.ndarray, p: int, root: int) -> np.ndarray:
    rows, size = a.shape
    prime, half = np.uint64(p), 1
    while half < size:
        w = _twiddles(2 * half, p, pow(root, -1, p))
        v = a.reshape(rows, -1, 2, half)
        x, y = v[:, :, 0].copy(), v[:, :, 1] * w % prime
        v[:, :, 0] = (x + y) % prime
        v[:, :, 1] = (x + prime - y) % prime
        half *= 2
    return a * np.uint64(pow(size, -1, p)) % prime


def _mismatches(words: np.ndarray, starts: np.ndarray, block: int, p: int, root: int) -> np.ndarray:
    """(block, distance - B) sums of squared differences modulo p, for whole blocks; distances beyond the text are junk."""
    n, prime = len(words), np.uint64(p)
    reduced = words % prime
    squares = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(reduced * reduced % prime, out=squares[1:])
    left = np.zeros((len(starts), 2 * block), dtype=np.uint64)
    left[:, :block] = reduced[starts[:, None] + np.arange(block - 1, -1, -1)]
    right = np.zeros_like(left)
    right[:, : 2 * block - 1] = reduced[np.minimum(starts[:, None] + block + np.arange(2 * block - 1), n - 1)]
    # A cyclic product of 2B points is enough: what wraps around lands below B-1.
    product = _backward(_forward(left, p, root) * _forward(right, p, root) % prime, p, root)[:, block - 1 : 2 * block - 1]
    own = (squares[starts + block] - squares[starts])[:, None]
    at = starts[:, None] + block + np.arange(block)
    there = squares[np.minimum(at + block, n)] - squares[np.minimum(at, n)]
    return (own % prime + there % prime + 2 * (prime - product)) % prime


def _occurrences(words: np.ndarray, starts: np.ndarray, block: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of each zero-mismatch occurrence at a distance of B .. 2B-1."""
    found_at, found_by = [], []
    largest = block * max(1, distinct - 1) ** 2
    for part in range(0, len(starts), max(1, _CELLS // (2 * block))):
        own = starts[part : part + max(1, _CELLS // (2 * block))]
        equal = own[:, None] + 2 * block + np.arange(block) <= len(words)
        bound = 1
        for p, root in PRIMES:
            some = equal.any(axis=1)
            if not some.any():
                break
            equal[some] &= _mismatches(words, own[some], block, p, root) == 0
            bound *= p
            if bound > largest:
                break
        row, t = np.nonzero(equal)
        found_at.append(own[row])
        found_by.append(t + block)
    return np.concatenate(found_at), np.concatenate(found_by)


class _Prefixes:
    """Hashes of all prefixes, to find by bisection how far two places agree. Their answers are checked afterwards."""

    def __init__(self, words: np.ndarray):
        p = np.uint64(_HASH_PRIME)
        draw = np.random.default_rng(5)
        codes = draw.integers(1, _HASH_PRIME, int(words.max()) + 1).astype(np.uint64)
        base = int(draw.integers(1 << 20, _HASH_PRIME))
        self.power = np.ones(len(words) + 1, dtype=np.uint64)
        done = 1
        while done < len(self.power):
            self.power[done : 2 * done] = self.power[: min(done, len(self.power) - done)] * np.uint64(pow(base, done, _HASH_PRIME)) % p
            done *= 2
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(codes[words.astype(np.int64)] * self.power[:-1] % p, out=self.sums[1:])
        self.sums %= p

    def _same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from a and from b > a agree."""
        p = np.uint64(_HASH_PRIME)
        one = (self.sums[a + length] + p - self.sums[a]) % p
        two = (self.sums[b + length] + p - self.sums[b]) % p
        return one * self.power[b - a] % p == two

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words after (or before) a and b agree, up to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._same(a, b, middle) if ahead else self._same(a - middle, b - middle, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _extent(words: np.ndarray, at: int, by: int) -> tuple[int, int]:
    """The stretch around place ``at`` in which words ``by`` apart are equal, word by word."""
    differ = np.flatnonzero(words[:-by] != words[by:])
    k = int(np.searchsorted(differ, at))
    return (int(differ[k - 1]) + 1 if k else 0), (int(differ[k]) if k < len(differ) else len(words) - by) + by


def find_runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word numbers 0 .. m-1, by start, then period.

    A run is a stretch of at least MIN_WORDS words and MIN_PERIODS smallest periods that no neighbour extends. Blocks
    that cannot recur (a word of theirs does not come again within 2B words) and blocks inside a known run, whose
    distances are all multiples of its period, need no convolution.
    """
    n = len(numbers)
    if n < MIN_WORDS:
        return []
    words = numbers.astype(np.uint64)
    distinct = int(numbers.max()) + 1
    order = np.argsort(numbers, kind="stable")
    gap = np.full(n, 2 * n)
    again = numbers[order[1:]] == numbers[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    prefixes = None
    runs: set[tuple[int, int, int]] = set()
    widest, block = gap, 1
    while MIN_PERIODS * block <= n:
        starts = np.flatnonzero(widest[::2] < 2 * block) * 2 * block
        starts = starts[starts + 2 * block <= n]
        if len(starts):
            # Farthest end of the known runs that start at or before a place.
            known = np.array(sorted(runs), dtype=np.int64).reshape(-1, 3)
            ends = np.maximum.accumulate(np.concatenate(([0], known[:, 0] + known[:, 1])))
            reach = lambda at, first=known[:, 0], ends=ends: ends[np.searchsorted(first, at, side="right")]
            starts = starts[reach(starts) < np.minimum(starts + 3 * block - 1, n)]
            at, by = _occurrences(words, starts, block, distinct) if len(starts) else (starts, starts)
            fresh = reach(at) < at + by + block
            at, by = at[fresh], by[fresh]
            if len(at):
                prefixes = prefixes or _Prefixes(words)
                first = at - prefixes.agree(at, at + by, at, ahead=False)
                end = at + by + block
                end = end + prefixes.agree(at + block, end, n - end, ahead=True)
                long = end - first >= np.maximum(MIN_WORDS, MIN_PERIODS * by)
                at, by, first, end = at[long], by[long], first[long], end[long]
                known_place = {}
                for i, q, s, e in zip(at.tolist(), by.tolist(), first.tolist(), end.tolist(), strict=True):
                    if (s, e, q) not in known_place:
                        true = (numbers[s : e - q] == numbers[s + q : e]).all()
                        known_place[s, e, q] = (s, e) if true else _extent(numbers, i, q)
                    s, e = known_place[s, e, q]
                    if e - s >= max(MIN_WORDS, MIN_PERIODS * q) and reach(s) < e:
                        runs.add((s, e - s, q))
        even = len(widest) // 2 * 2
        widest = np.maximum(widest[0:even:2], widest[1:even:2])
        block *= 2
    return sorted((s, length, q) for s, length, q in runs)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words outside the repetitions: each run is left with its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) for each row of ``docs`` (doc_id, text).

    Words are what white space of ASCII separates, compared byte by byte, numbered from 0. ``runs`` holds every run by
    start, then period; ``best`` the one with the greatest exact length / period (ties: smallest start, then period),
    null without runs; ``collapsed`` the words that are in no run after its first period, joined by single spaces. A
    null, empty or blank text has no words, no runs and an empty ``collapsed``. Rows are independent: nothing is
    shuffled, a row repeats as it came, other columns are ignored, an empty table gives no rows. A very long text costs
    n log n time for its blocks, and one of few distinct words no more, as blocks inside a known run are passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch, texts in slices(batches, "text", _SLICE):
            counts, all_runs, best, collapsed = [], [], [], []
            for text in texts:
                words = (text or b"").split()
                numbers: dict[bytes, int] = {}
                runs = find_runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
                named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                counts.append(len(words))
                all_runs.append(named)
                best.append(max(named, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None))
                collapsed.append(collapse(words, runs))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(all_runs, pa.list_(kinds)),
                    pa.array(best, kinds),
                    pa.array(collapsed, pa.binary()).view(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "best", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _OUT)
