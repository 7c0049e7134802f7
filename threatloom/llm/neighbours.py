"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table cuts the line of each of a few Gaussian projections into steps; the steps that a vector falls into name its
bucket. A query visits its own bucket and then perturbed ones, a step up or down in some projections, by falling
estimated chance of success: by the sum of squared distances to the steps' borders. What the visited buckets of all
tables hold is ranked by exact distance on the original vectors.

Numbers of projections, tables and visits and the step are measured, not assumed: the cheapest choice that finds nearly
all true neighbours of a bounded set of sample queries, whose neighbours are known from one pass over all vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatloom.llm.common import stage
from threatloom.operators.shaping import top_per_group

# The fit: so many vectors and queries, in hash order of their ids; every vector is indexed, every query searched.
SAMPLE, SAMPLE_QUERIES = 8192, 64
RECALL = 0.97
TABLES, MOST_VISITS = 4, 64
PROJECTIONS, STEPS = (4, 6, 8, 10, 12, 16, 20, 24), (0.25, 0.5, 1.0, 2.0, 3.0)
# What one visit costs, in distances: a bucket to look up and a query to ship there.
VISIT_COST = 32
# A bucket with more vectors or more visitors is compared in blocks.
VECTOR_BLOCK, QUERY_BLOCK = 4096, 2048

_CELL = ["dim", "place", "bucket", "i", "j"]


def _packed(kind: str):
    """Usable vectors as bytes: not null, not zero, every component finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).cast(pa.int64()).to_pylist(), batch.column(1)
            asked = batch.column(2).to_pylist()
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(kind)
            ends = vectors.offsets.to_numpy()
            here = vectors.is_valid().to_pylist()
            kept = []
            for r in range(len(ids)):
                x = flat[ends[r] : ends[r + 1]]
                if ids[r] is not None and here[r] and x.any() and np.isfinite(x).all():
                    kept.append((ids[r], len(x), x.tobytes(), bool(asked[r])))
            columns = list(zip(*kept, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
            names = ["vec_id", "dim", "vector", "asked"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _matrix(raw: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)


def perturbations(projections: int, most: int) -> np.ndarray:
    """(set, 2 * projections) 0/1 choices among a query's steps up and down, ranked from the closest border on.

    The first ``most`` sets by expected score, the empty set first; a set never moves one projection both ways.
    """
    m, width = projections, 2 * projections
    j = np.arange(1, width + 1)
    back = width + 1 - j
    expected = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - back / (m + 1) + back * (back + 1) / (4 * (m + 1) * (m + 2)))
    chosen, heap = [()], [(expected[0], (0,))]
    while heap and len(chosen) < most:
        score, own = heapq.heappop(heap)
        if len({min(a, width - 1 - a) for a in own}) == len(own):
            chosen.append(own)
        last = own[-1]
        if last + 1 < width:
            heapq.heappush(heap, (score - expected[last] + expected[last + 1], (*own[:-1], last + 1)))
            heapq.heappush(heap, (score + expected[last + 1], (*own, last + 1)))
    member = np.zeros((len(chosen), width), dtype=np.int64)
    for row, own in enumerate(chosen):
        member[row, list(own)] = 1
    return member


def family(dim: int, projections: int, step: float, tables: int = TABLES) -> dict:
    """Tables of hash functions, as plain arrays; without projections a table has one bucket."""
    draw = np.random.default_rng([dim, projections])
    return {
        "lines": draw.normal(size=(TABLES, dim, projections))[:tables],
        "shift": draw.random((TABLES, projections))[:tables],
        "step": step,
        "code": draw.integers(-(1 << 62), 1 << 62, (TABLES, projections))[:tables] | 1,
        "sets": perturbations(projections, 4 * MOST_VISITS) if projections else np.zeros((1, 0), dtype=np.int64),
        "visits": 1,
    }


def buckets(vectors: np.ndarray, hashes: dict) -> np.ndarray:
    """(vector, table) bucket of each vector."""
    out = np.empty((len(vectors), len(hashes["lines"])), dtype=np.int64)
    for t, lines in enumerate(hashes["lines"]):
        steps = np.floor(vectors @ lines / hashes["step"] + hashes["shift"][t]).astype(np.int64)
        out[:, t] = (steps * hashes["code"][t]).sum(axis=1)
    return out


def visited(queries: np.ndarray, hashes: dict, visits: int) -> np.ndarray:
    """(query, table, visit) buckets in the order in which they are visited."""
    member = hashes["sets"]
    visits = min(visits, len(member))
    out = np.empty((len(queries), len(hashes["lines"]), visits), dtype=np.int64)
    for t, lines in enumerate(hashes["lines"]):
        place = queries @ lines / hashes["step"] + hashes["shift"][t]
        steps = np.floor(place).astype(np.int64)
        above = place - steps
        borders = np.concatenate([above, 1 - above], axis=1)
        order = np.argsort(borders, axis=1, kind="stable")
        scores = np.take_along_axis(borders, order, axis=1) ** 2 @ member.T.astype(np.float64)
        moves = np.concatenate([-hashes["code"][t], hashes["code"][t]])[order] @ member.T
        first = np.argsort(scores, axis=1, kind="stable")[:, :visits]
        out[:, t] = (steps * hashes["code"][t]).sum(axis=1)[:, None] + np.take_along_axis(moves, first, axis=1)
    return out


def _closest(queries: np.ndarray, vectors: np.ndarray, owners: np.ndarray, names: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, name, distance): the ``most`` names closest to each query, exactly, by distance, then name.

    ``names`` are the names of all vectors, ``owners`` the row of the vector that each belongs to. Products of matrices
    leave out what cannot be among the closest; distances are then taken component by component.
    """
    own, there = (queries * queries).sum(axis=1), (vectors * vectors).sum(axis=1)
    found: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(queries), 256):
        part = slice(at, at + 256)
        squares = own[part, None] + there[None, :] - 2 * (queries[part] @ vectors.T)
        slack = 1e-9 * (own[part, None] + there[None, :])
        k = min(most, squares.shape[1]) - 1
        bound = np.partition(squares + slack, k, axis=1)[:, k]
        row, column = np.nonzero(squares - slack <= bound[:, None])
        apart = queries[at + row] - vectors[column]
        far = np.sqrt((apart * apart).sum(axis=1))
        first = np.searchsorted(owners, column)
        count = np.searchsorted(owners, column, side="right") - first
        row, far = np.repeat(row, count), np.repeat(far, count)
        each = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        name = names[each]
        order = np.lexsort((name, far, row))
        row, name, far = row[order], name[order], far[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        for out, column in zip(found, (at + row, name, far), strict=True):
            out.append(column[place < most])
    return tuple(np.concatenate(x) for x in found)


def _flat(members: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    owners = np.repeat(np.arange(len(members)), [len(m) for m in members])
    return owners, np.array([i for m in members for i in m], dtype=np.int64)


_FOUND = "query long, vec_id long, score double"


def _found(query: np.ndarray, name: np.ndarray, far: np.ndarray) -> dict:
    return {"query": pa.array(query, pa.int64()), "vec_id": pa.array(name, pa.int64()), "score": pa.array(far, pa.float64())}


def _all_closest(shared, most: int, kind: str):
    """Closest names to the few shared queries among the vectors of a task, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.to_pydict()
            for dim, (ids, raw) in shared.value.items():
                own = [r for r, d in enumerate(data["dim"]) if d == dim]
                if own:
                    owners, names = _flat([data["members"][r] for r in own])
                    q, name, far = _closest(_matrix(raw, kind), _matrix([data["vector"][r] for r in own], kind), owners, names, most)
                    yield pa.RecordBatch.from_pydict(_found(np.array(ids, dtype=np.int64)[q], name, far))

    return run


def _cheapest(queries: np.ndarray, truth: list[np.ndarray], sample: np.ndarray, vectors: int) -> dict:
    """The hash family and number of visits that find enough of ``truth`` (the true neighbours per query) at least cost."""
    dim = queries.shape[1]
    neighbours = np.concatenate(truth)
    asker = np.repeat(np.arange(len(queries)), [len(t) for t in truth])
    # Spread of a Gaussian projection.
    spread = float(np.sqrt(sample.var(axis=0).sum())) or 1.0
    choices = []
    for projections in PROJECTIONS:
        for factor in STEPS:
            hashes = family(dim, projections, factor * spread)
            visits = visited(queries, hashes, MOST_VISITS)
            homes, rest = buckets(neighbours, hashes), buckets(sample, hashes)
            when = np.full(len(neighbours), MOST_VISITS)
            scanned = np.zeros(visits.shape[2])
            for t in range(TABLES):
                hit = visits[asker, t] == homes[:, t, None]
                when = np.where(hit.any(axis=1), np.minimum(when, hit.argmax(axis=1)), when)
                known, times = np.unique(rest[:, t], return_counts=True)
                at = np.minimum(np.searchsorted(known, visits[:, t]), len(known) - 1)
                scanned += np.where(known[at] == visits[:, t], times[at], 0).mean(axis=0).cumsum()
                recall = (when[:, None] <= np.arange(len(scanned))).mean(axis=0)
                n = int(np.argmax(np.minimum(recall, RECALL))) + 1
                cost = float(scanned[n - 1]) / len(sample) * vectors + VISIT_COST * (t + 1) * n
                if t:  # two tables at least
                    choices.append((max(0.0, RECALL - float(recall[n - 1])), cost, projections, factor * spread, t + 1, n))
    _, _, projections, step, tables, visits = min(choices)
    return family(dim, projections, step, tables) | {"visits": visits}


def fit(classes: DataFrame, asked: DataFrame, most: int, kind: str) -> dict[int, dict]:
    """Hash families per vector length. Driver and broadcast hold SAMPLE vectors and SAMPLE_QUERIES queries at most.

    A length that the sample does not hold has one bucket: it is searched exactly, in blocks.
    """
    context = classes.sparkSession.sparkContext
    order = (F.xxhash64("name"), F.col("name"))
    rows = classes.select("name", "dim", "vector").orderBy(*order).limit(SAMPLE).collect()
    tries = asked.select("query", "dim", "vector").orderBy(F.xxhash64("query"), "query").limit(SAMPLE_QUERIES).collect()
    sizes = {r.dim: r["count"] for r in classes.groupBy("dim").count().where(F.col("dim").isin([r.dim for r in tries])).collect()}
    dims = sorted({r.dim for r in tries})
    groups = {d: ([r.query for r in tries if r.dim == d], [bytes(r.vector) for r in tries if r.dim == d]) for d in dims}
    shared = context.broadcast(groups)
    near = classes.select("dim", "members", "vector").mapInArrow(_all_closest(shared, most, kind), _FOUND)
    near = top_per_group(near, ["query"], most, F.col("score"), F.col("vec_id")).select("query", "vec_id")
    held = classes.select(F.explode("members").alias("vec_id"), "dim", "vector")
    true = near.join(held, "vec_id").collect()
    found = {}
    for dim in dims:
        ids, raw = groups[dim]
        truth = [_matrix(v, kind) for v in ([bytes(r.vector) for r in true if r.query == q and r.dim == dim] for q in ids) if v]
        sample = [bytes(r.vector) for r in rows if r.dim == dim]
        if sample and len(truth) == len(ids):
            found[dim] = _cheapest(_matrix(raw, kind), truth, _matrix(sample, kind), sizes[dim])
    return found


def _hashed(shared, kind: str, probing: bool):
    """Adds the buckets of each vector, one per table, or those that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_pylist()
            raw = batch.column(batch.schema.get_field_index("vector")).to_pylist()
            out: list[list[dict]] = [[] for _ in dims]
            for dim in set(dims):
                hashes = shared.value.get(dim) or family(dim, 0, 1.0, 1)
                own = [r for r, d in enumerate(dims) if d == dim]
                vectors = _matrix([raw[r] for r in own], kind)
                keys = visited(vectors, hashes, hashes["visits"]) if probing else buckets(vectors, hashes)[:, :, None]
                for r, tables in zip(own, keys.tolist(), strict=True):
                    out[r] = [{"place": t, "bucket": key} for t, visits in enumerate(tables) for key in visits]
            yield batch.append_column("at", pa.array(out, pa.list_(pa.struct([("place", pa.int32()), ("bucket", pa.int64())]))))

    return run


def _compare(most: int, kind: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table(_found(np.empty(0), np.empty(0), np.empty(0)))
        owners, names = _flat(right.column("members").to_pylist())
        queries, vectors = (_matrix(x.column("vector").to_pylist(), kind) for x in (left, right))
        q, name, far = _closest(queries, vectors, owners, names, most)
        return pa.table(_found(left.column("query").to_numpy()[q], name, far))

    return run


def _matches(probes: DataFrame, index: DataFrame, most: int, kind: str) -> DataFrame:
    """Closest names per query over all buckets that it visits; a crowded bucket is cut into blocks on both sides."""
    bucket = ["dim", "place", "bucket"]
    at = ["at.place", "at.bucket"]
    entries = index.select("dim", F.explode("at").alias("at"), "name", "members", "vector").select("dim", *at, "name", "members", "vector")
    visits = probes.select("dim", F.explode("at").alias("at"), "query", "vector").select("dim", *at, "query", "vector")
    held = entries.groupBy(*bucket).agg(F.ceil(F.count("*") / VECTOR_BLOCK).cast("int").alias("vector_blocks"))
    came = visits.groupBy(*bucket).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    crowded = stage(held.join(came, bucket).where("vector_blocks > 1 OR query_blocks > 1"), "neighbours-crowded")
    blocks = {c: F.coalesce(c, F.lit(1)) for c in ("vector_blocks", "query_blocks")}
    entries = entries.join(crowded, bucket, "left").withColumns(blocks)
    visits = visits.join(crowded, bucket, "left").withColumns(blocks)

    def spread(name: str, count: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(count).cast("long")).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    entries = entries.withColumn("i", spread("name", "vector_blocks")).select(*bucket, "i", every("query_blocks").alias("j"), "members", "vector")
    visits = visits.withColumn("j", spread("query", "query_blocks")).select(*bucket, every("vector_blocks").alias("i"), "j", "query", "vector")
    pairs = visits.groupBy(*_CELL).cogroup(entries.groupBy(*_CELL))
    return pairs.applyInArrow(_compare(most, kind), _FOUND)


def nearest(vectors: DataFrame, asked: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row of ``vectors`` (vec_id, embedding) that is ``asked``.

    Score is the Euclidean distance in double precision; ranks go from 1 by score, then vec_id. A null vec_id, and a
    vector that is null, empty, zero or holds null or non-finite components, takes no part; vectors of different length
    are never compared. Rows with one vec_id are one item: the distance between items is the least between their rows,
    and an item is no candidate of its own. Other columns are ignored; without queries or vectors there are no rows.

    Equal vectors are searched for once and found as one entry with their k + 1 smallest ids, which are all that can be
    among the k nearest of any query, so copies never crowd a bucket. Near copies may: such a bucket is compared in
    blocks. A query that finds less than k candidates in its buckets is compared with all vectors, again in blocks.
    """
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    whole = "float" if kind == "<f4" else "double"
    context = vectors.sparkSession.sparkContext
    most = k + 1
    given = vectors.select("vec_id", F.col("embedding").cast(f"array<{whole}>").alias("embedding"), F.coalesce(asked, F.lit(False)).alias("asked"))
    valid = stage(given.mapInArrow(_packed(kind), "vec_id long, dim int, vector binary, asked boolean"), "neighbours-vectors")
    distinct = valid.groupBy("vec_id", "dim", "vector").agg(F.max("asked").alias("asked"))
    first = top_per_group(distinct, ["dim", "vector"], most, F.col("vec_id"))
    classes = first.groupBy("dim", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    classes = stage(classes.select(F.col("members")[0].alias("name"), "dim", "members", "vector"), "neighbours-classes")
    queries = valid.where("asked").select("vec_id", "dim", "vector")
    searches = stage(queries.groupBy("dim", "vector").agg(F.min("vec_id").alias("query")).select("query", "dim", "vector"), "neighbours-queries")
    shared = context.broadcast(fit(classes, searches, most, kind))
    at = "at array<struct<place:int,bucket:bigint>>"
    index = stage(classes.mapInArrow(_hashed(shared, kind, False), f"name long, dim int, members array<long>, vector binary, {at}"), "neighbours-index")
    probes = stage(searches.mapInArrow(_hashed(shared, kind, True), f"query long, dim int, vector binary, {at}"), "neighbours-probes")

    def ranked(matches: DataFrame) -> DataFrame:
        once = matches.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
        return top_per_group(once, ["query"], most, F.col("score"), F.col("vec_id")).drop("rank")

    found = stage(ranked(_matches(probes, index, most, kind)), "neighbours-found")
    full = found.groupBy("query").count().where(F.col("count") >= most)
    short = stage(searches.join(full, "query", "left_anti"), "neighbours-short")
    if not short.isEmpty():
        one = F.array(F.struct(F.lit(0).alias("place"), F.lit(0).cast("long").alias("bucket"))).alias("at")
        exact = _matches(short.select("*", one), classes.select("*", one), most, kind)
        found = found.join(full, "query", "left_semi").unionByName(ranked(exact))
    answers = found.groupBy("query").agg(F.collect_list(F.struct("vec_id", "score")).alias("near"))
    asking = queries.distinct().join(searches.join(answers, "query"), ["dim", "vector"])
    each = asking.select(F.col("vec_id").alias("query_id"), F.explode("near").alias("n")).select("query_id", "n.vec_id", "n.score")
    each = each.where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranks = top_per_group(each, ["query_id"], k, F.col("score"), F.col("vec_id"))
    return ranks.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
