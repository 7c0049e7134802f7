"""Helpers of the operators: session, staging, Arrow batches cut by size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from threatloom.session import shared_root, work_dir

# Rows of one Arrow batch between Spark and a Python worker; documents are long, so batches are kept short.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the operators. How much may be broadcast is left to the session, which knows its driver's memory."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared work folder and read it back: computed once, found again by any executor."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a round of an iteration with a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut batches so that one slice holds about ``max_bytes`` of text (a longer document stands alone)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        start, held = 0, 0
        values = column.to_pylist()
        for i, value in enumerate(values):
            size = len(value or b"")
            if i > start and held + size > max_bytes:
                yield batch.slice(start, i - start), values[start:i]
                start, held = i, 0
            held += size
        if len(values) > start:
            yield batch.slice(start), values[start:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over a 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of many texts at once, found on their bytes.

    ``member`` says for each byte value whether it belongs to a word; A-Z count as a-z. ``start`` and ``end`` are
    byte offsets into ``data`` (the lower-cased texts, each followed by one zero byte that is no part of it, whatever
    zero bytes the texts hold), ``hash`` a 64-bit hash per word, ``owner`` the text that it belongs to.
    """

    LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self, texts: list[bytes | None], member: np.ndarray):
        parts = [t or b"" for t in texts]
        self.data = (b"\0".join(parts) + b"\0").translate(self.LOWER)
        raw = np.frombuffer(self.data, dtype=np.uint8)
        ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
        inside = member[raw]
        inside[ends - 1] = False
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.owner = np.searchsorted(ends, self.start, side="right")
        self.first = np.searchsorted(self.start, np.concatenate(([0], ends)))
        self.hash = self._hashes(raw)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, dtype=np.uint64)
        size = len(raw)
        powers = np.full(size, self.BASE, dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        inverse = np.full(size, self.INVERSE, dtype=np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        return mixed((sums[self.end] - sums[self.start]) * inverse[self.start])


def byte_class(excluded) -> np.ndarray:
    member = np.ones(256, dtype=bool)
    member[list(excluded)] = False
    return member


# Fixed values of the contracts: bytes that separate words.
SPACES = byte_class([0x20, *range(0x09, 0x0E)])
LETTERS_DIGITS = byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def free_name(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
