"""Near-duplicate documents by b-bit MinHash.

Each document is reduced to its set of distinct word shingles, 128 minima of that set, their band keys, and the low
bits of the minima packed in 64 bytes. Equal sets form one class first. Classes that share a band key are candidates;
the packed signatures estimate their similarity, and what may reach the threshold is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import SPACES, Words, mixed, slices, stage
from threatloom.llm.components import components

# 32 bands of 4 minima miss a pair of similarity 0.8 with probability (1 - 0.8^4)^32 = 5e-8.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 4
# The estimate has a standard deviation of 0.037 at similarity 0.8; candidates are kept down to 5.4 of these below.
SLACK = 0.2
BLOCK = 256
_SLICE = 4 << 20

_SIGNED = "doc_id long, n_shingles long, digest binary, signature binary, bands array<long>"


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct shingles of ``k`` words; with fewer words, all words as one."""
    words = Words(texts, SPACES)
    sets = []
    for i in range(len(texts)):
        own = words.hash[words.first[i] : words.first[i + 1]]
        width = min(k, len(own))
        if width == 0:
            sets.append(own)
            continue
        joined = np.zeros(len(own) - width + 1, dtype=np.uint64)
        for j in range(width):
            joined = mixed(joined * np.uint64(0xD6E8FEB86659FD93) + own[j : len(own) - width + 1 + j])
        sets.append(np.unique(mixed(joined + np.uint64(width))))
    return sets


def minima(shingles: np.ndarray) -> np.ndarray:
    """The 32-bit minima of a set under every hash function."""
    factor, offset = _multipliers()
    best = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 2048):
        hashed = shingles[None, at : at + 2048] ^ offset[:, None]
        hashed *= factor[:, None]
        np.minimum(best, hashed.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def packed(values: np.ndarray) -> bytes:
    """Low bits of the minima, two to a byte."""
    low = (values & np.uint32(2**BITS - 1)).astype(np.uint8)
    return (low[0::2] << BITS | low[1::2]).tobytes()


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in values.reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + column)
    return keys.view(np.int64)


_EQUAL = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], dtype=np.uint8)


def estimated(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (rows of bytes), corrected for low bits that agree by chance."""
    equal = _EQUAL[left ^ right].sum(axis=-1, dtype=np.int32) / HASHES
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", _SLICE):
            sets = shingle_sets(texts, k)
            signatures, bands, digests = [], [], []
            for own in sets:
                values = minima(own) if len(own) else None
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signatures.append(packed(values) if len(own) else None)
                bands.append(band_keys(values) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "signature", "bands"],
            )

    return run


def sign(docs: DataFrame, k: int) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_sign(k), _SIGNED)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def _may_reach(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                likely = estimated(_matrix(batch.column(2)), _matrix(batch.column(3))) >= least
                yield batch.select([0, 1]).filter(pa.array(likely))

    return run


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted sets, in whole numbers."""
    few, many = sorted((one, other), key=len)
    if not len(few) or 100 * len(few) < percent * len(many):
        return False
    at = np.searchsorted(many, few)
    at[at == len(many)] = 0
    both = int((many[at] == few).sum())
    return 100 * both >= percent * (len(one) + len(other) - both)


def _confirm(k: int, percent: int):
    """Pairs whose full sets are similar enough: 100 * intersection >= percent * union, in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, right in slices(batches, "right", _SLICE):
            left = batch.column(2).cast(pa.large_binary()).to_pylist()
            keep = []
            for a, b in zip(left, right, strict=True):
                one, other = shingle_sets([a, b], k)
                keep.append(_similar(one, other, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _block_links(k: int, percent: int, least: float):
    """Links between components within one block of members and one block of strays.

    For each stray, members of other components that may reach the threshold are confirmed on the full sets, the
    likeliest first; one link to a component is enough, so links, not pairs, leave the task.
    """

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        part = table.column("component").to_numpy()
        stray = table.column("stray").to_numpy(zero_copy_only=False).astype(bool)
        bits = _matrix(table.column("signature"))
        inner = np.flatnonzero(~stray)
        sets = shingle_sets(table.column("text").cast(pa.large_binary()).to_pylist(), k)
        links = []
        for i in np.flatnonzero(stray):
            likely = estimated(bits[inner], bits[i])
            likely[part[inner] == part[i]] = -1
            found = np.flatnonzero(likely >= least)
            linked = {part[i]}
            for j in inner[found[np.argsort(-likely[found], kind="stable")]]:
                if part[j] not in linked and _similar(sets[i], sets[j], percent):
                    linked.add(part[j])
                    links.append((ids[i], ids[j]))
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text; others are ignored).

    Documents are linked when 100 * intersection >= percent * union of their shingle sets. A null, empty or blank
    text has an empty set and is linked with nothing; rows that share a doc_id are one document; a null doc_id
    stays alone with a null component and is kept. Shingles are compared by 64-bit hashes.

    Large groups: equal sets are one class, compared once. Every class is first compared with the smallest member of
    its buckets; what that links is one component. Only buckets that still hold several components are looked at
    again: their strays (members outside the component of the bucket's smallest member) against the whole bucket, in
    blocks that confirm in place. The cost follows strays times members; no pair inside a component is ever made, and
    a block returns at most one link per stray and component.
    """
    least = percent / 100 - SLACK
    signed = stage(sign(docs, k), "minhash")
    classes = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    classes = stage(classes, "minhash-classes")
    heads = signed.join(classes, [signed.doc_id == classes.first_id, signed.digest == classes.digest], "left_semi")
    heads = stage(heads.select("doc_id", "signature", "bands"), "minhash-heads")
    banded = heads.select(F.explode("bands").alias("band"), "doc_id")
    crowded = banded.groupBy("band").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last")).where("pivot < last")
    shared = stage(banded.join(crowded.select("band", "pivot"), "band"), "minhash-buckets")
    involved = shared.select("doc_id").distinct()
    texts = stage(docs.select("doc_id", "text").join(involved, "doc_id", "left_semi"), "minhash-texts")
    signatures = heads.select("doc_id", "signature")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a")
        both = one.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
        return both.select("a", "b", "left", "right").mapInArrow(_confirm(k, percent), "a long, b long")

    pairs = shared.where("pivot < doc_id").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    pairs = pairs.join(signatures.toDF("a", "one"), "a").join(signatures.toDF("b", "other"), "b")
    likely = pairs.select("a", "b", "one", "other").mapInArrow(_may_reach(least), "a long, b long")
    known = components(confirmed(likely))
    blocks = _open_blocks(shared, signatures, texts, known)
    more = blocks.applyInArrow(_block_links(k, percent, least), "a long, b long")
    known = components(known.toDF("a", "b").union(more))
    part = classes.join(known, classes.first_id == known.node, "left")
    part = part.select("digest", F.coalesce("component", "first_id").alias("component_id"))
    found = signed.select("doc_id", "n_shingles", "digest").join(part, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _open_blocks(shared: DataFrame, signatures: DataFrame, texts: DataFrame, known: DataFrame):
    """Members of the buckets in which several components meet, grouped in blocks.

    Buckets are put together by the component of their smallest member, so that members which share many buckets are
    compared once. Members are dealt over inner blocks, strays over outer ones; a group is one outer and one inner.
    """
    labelled = shared.join(known.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "doc_id"))
    main = F.max(F.when(F.col("doc_id") == F.col("pivot"), F.col("component"))).alias("main")
    counted = labelled.groupBy("band").agg(main, F.min("component").alias("low"), F.max("component").alias("high"))
    rows = labelled.join(counted.where("low < high").select("band", "main"), "band")
    rows = stage(rows.select("main", "doc_id", "component").distinct(), "minhash-open")
    is_stray = F.col("component") != F.col("main")
    sizes = rows.groupBy("main").agg(F.count("*").alias("members"), F.sum(is_stray.cast("long")).alias("strays"))
    rows = rows.join(sizes.where("strays > 0"), "main").join(signatures, "doc_id")
    inner_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    outer_blocks = F.ceil(F.col("strays") / BLOCK).cast("int")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).cast("int")
    narrow = ["main", "doc_id", "component", "signature"]
    inner = rows.select(
        *narrow,
        F.lit(False).alias("stray"),
        F.pmod(spread, inner_blocks).alias("i"),
        F.explode(F.sequence(F.lit(0), outer_blocks - 1)).alias("o"),
    )
    outer = rows.where(is_stray).select(
        *narrow,
        F.lit(True).alias("stray"),
        F.explode(F.sequence(F.lit(0), inner_blocks - 1)).alias("i"),
        F.pmod(spread, outer_blocks).alias("o"),
    )
    return inner.union(outer).join(texts, "doc_id").groupBy("main", "i", "o")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but the first of each group of near duplicates."""
    groups = near_duplicates(docs, k, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(groups, "doc_id", "left_anti")
