"""Near-duplicate vectors by product quantisation.

Unit vectors are dealt over coarse lists by their nearest centroid. Where a label has more vectors than the first level
has room for, its lists are split by centroids of the residuals, level by level, so lists stay short at any size. In a
list a vector is held as codes of its last residual in eight subspaces. A vector probes every list whose border it is
close to. In a list, table look-ups give the distance of the probing vector to each coded one; what the coding error
leaves possible is ranked by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatloom.llm.common import stage
from threatloom.llm.components import components

# The codebooks are fitted on about so many vectors, drawn by hash of their ids; every vector is indexed.
SAMPLE = 20_000
VECTORS_PER_LIST = 128
# Lists of the first level, and parts that each further level makes of a list, as powers of two.
FIRST_BITS, SPLIT_BITS = 10, 6
SUBSPACES, CODES = 8, 64
NATIVE_BLOCK, PROBE_BLOCK = 1024, 4096

_ROW = "label long, dim int, list long, vec_id long, copies long, native boolean, home int, mine double, near array<int>, margin array<double>, vector binary, code binary, error double"


def _means(data: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centroids of ``data`` by Lloyd's rounds from distinct random rows."""
    data = np.unique(data, axis=0)
    draw = np.random.default_rng(seed)
    centers = data[np.sort(draw.permutation(len(data))[:k])].copy()
    for _ in range(rounds):
        nearest = _nearest(data, centers)
        counts = np.bincount(nearest, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, data)
        used = counts > 0
        centers[used] = sums[used] / counts[used, None]
    return centers


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0)


def _nearest(data: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(data[i : i + 1024], centers).argmin(axis=1) for i in range(0, len(data), 1024)])


class Codebook:
    """Centroids of each level and residual codewords for vectors of one length.

    The centroids of a level after the first are shared by all lists of the level before. A list's number is made of
    its centroid at each level. ``first`` numbers the centroids of all levels through.
    """

    def __init__(self, dim: int, sample: np.ndarray | None = None, sizes: tuple[int, ...] = (1,)):
        self.parts = [p for p in np.array_split(np.arange(dim), min(SUBSPACES, max(1, dim))) if len(p)]
        if sample is None or not len(sample):
            self.levels = [np.zeros((1, dim))]
            self.words = [np.zeros((1, len(p))) for p in self.parts]
        else:
            self.levels, rest = [], sample
            for size in sizes:
                self.levels.append(_means(rest, size, seed=1))
                rest = rest - self.levels[-1][_nearest(rest, self.levels[-1])]
            self.words = [_means(rest[:, p], CODES, seed=2 + i) for i, p in enumerate(self.parts)]
        self.apart = [np.sqrt(_squares(c, c)) for c in self.levels]
        self.first = np.cumsum([0, *(len(c) for c in self.levels)])

    def center(self, place: int) -> np.ndarray:
        """What is taken off a vector of a list before it is coded."""
        total = np.zeros(self.levels[0].shape[1])
        for centers in reversed(self.levels):
            place, at = divmod(place, len(centers))
            total = total + centers[at]
        return total

    def places(self, unit: np.ndarray, reach: float) -> tuple[np.ndarray, ...]:
        """(row, list, residual, home, mine) of each vector in its own list (home -1) and in those that it probes.

        ``home`` is the own centroid at the level where a probe leaves its own lists, ``mine`` how far it is there from
        the border. Last come, per vector, the centroids of all levels whose border it is close to, and how close.
        A probe may be twice as far from the borders of later levels, since there the other vector does not move.
        """
        row, place, rest = np.arange(len(unit)), np.zeros(len(unit), dtype=np.int64), unit
        home, mine = np.full(len(unit), -1), np.zeros(len(unit))
        near: list[list[int]] = [[] for _ in unit]
        margins: list[list[float]] = [[] for _ in unit]
        for level, (centers, apart) in enumerate(zip(self.levels, self.apart, strict=True)):
            squares = _squares(rest, centers)
            best = squares.argmin(axis=1)
            each = np.arange(len(row))
            # Distance to the border between the nearest centroid and each other one.
            with np.errstate(divide="ignore", invalid="ignore"):
                margin = np.nan_to_num((squares - squares[each, best][:, None]) / (2 * apart[best]), nan=0.0)
            native = home < 0
            take = margin <= np.where(native, reach, 2 * reach)[:, None]
            take[each, best] = True
            e, to = np.nonzero(take)
            leaves = native[e] & (to != best[e])
            for r, j, m in zip(row[e[leaves]].tolist(), to[leaves].tolist(), margin[e, to][leaves].tolist(), strict=True):
                near[r].append(int(self.first[level]) + j)
                margins[r].append(m)
            home = np.where(leaves, self.first[level] + best[e], home[e])
            mine = np.where(leaves, margin[e, to], mine[e])
            row, place, rest = row[e], place[e] * len(centers) + to, rest[e] - centers[to]
        return row, place, rest, home, mine, near, margins

    def coded(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and how far each residual is from its code."""
        codes = np.empty((len(rest), len(self.parts)), dtype=np.uint8)
        error = np.zeros(len(rest))
        for m, p in enumerate(self.parts):
            squares = _squares(rest[:, p], self.words[m])
            codes[:, m] = squares.argmin(axis=1)
            error += squares.min(axis=1)
        return codes, np.sqrt(error)

    def distances(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """(probe, coded) distances: one table of codeword distances per probe and subspace, summed by look-up."""
        total = np.zeros((len(rest), len(codes)))
        for m, p in enumerate(self.parts):
            total += _squares(rest[:, p], self.words[m])[:, codes[:, m]]
        return np.sqrt(total)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that can link at all, as unit-less doubles in bytes."""
    for batch in batches:
        ids, labels, vectors = (batch.column(i).to_pylist() for i in range(3))
        kept = []
        for i, v in enumerate(vectors):
            if ids[i] is not None and labels[i] is not None and v and None not in v:
                x = np.array(v, dtype=np.float64)
                if np.isfinite(x).all() and x.any() and 0 < float(x @ x) < np.inf:
                    kept.append((ids[i], labels[i], len(v), x.tobytes()))
        columns = list(zip(*kept, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["vec_id", "label", "dim", "vector"]
        )


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw)).reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def fit(vectors: DataFrame) -> dict[int, Codebook]:
    """Codebooks per vector length, from a sample of about SAMPLE rows; a length not sampled has one list."""
    sizes = vectors.groupBy("label", "dim").count().agg(F.sum("count"), F.max("count")).first()
    if not sizes[0]:
        return {}
    share = int(min(1.0, SAMPLE / sizes[0]) * (1 << 30))
    drawn = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share).select("vec_id", "dim", "vector")
    rows = sorted(drawn.limit(2 * SAMPLE).collect())
    bits = max(0, round(np.log2(sizes[1] / VECTORS_PER_LIST)))
    levels = [2 ** min(bits, FIRST_BITS)]
    levels += [2 ** min(bits - done, SPLIT_BITS) for done in range(FIRST_BITS, bits, SPLIT_BITS)]
    books = {}
    for dim in sorted({r.dim for r in rows}):
        books[dim] = Codebook(dim, _unit([bytes(r.vector) for r in rows if r.dim == dim]), tuple(levels))
    return books


def _index(shared, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.to_pydict()
            out = []
            for dim in sorted(set(data["dim"])):
                own = [i for i, d in enumerate(data["dim"]) if d == dim]
                book = shared.value.get(dim) or Codebook(dim)
                unit = _unit([data["vector"][i] for i in own])
                row, place, rest, home, mine, near, margins = book.places(unit, reach)
                codes, error = book.coded(rest[home < 0])
                for r, at, left, m in zip(row.tolist(), place.tolist(), home.tolist(), mine.tolist(), strict=True):
                    i = own[r]
                    who = (data["label"][i], dim, at, data["vec_id"][i], data["copies"][i])
                    if left < 0:
                        out.append((*who, True, left, m, near[r], margins[r], data["vector"][i], codes[r].tobytes(), float(error[r])))
                    else:
                        out.append((*who, False, left, m, [], [], data["vector"][i], b"", 0.0))
            columns = list(zip(*out, strict=True)) or [[] for _ in range(13)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.float64(), pa.list_(pa.int32())]
            kinds += [pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.float64()]
            names = [x.split()[0] for x in _ROW.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _roots(left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Smallest name reachable from each node over the given links."""
    root = names.copy()
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        if (root == before).all():
            return root


def _link(shared, least: float):
    far = float(np.sqrt(2 - 2 * least))

    def run(table: pa.Table) -> pa.Table:
        data = table.to_pydict()
        dim, place = data["dim"][0], data["list"][0]
        book = shared.value.get(dim) or Codebook(dim)
        native = np.array(data["native"])
        coded = np.array(data["coded"])
        probing = np.array(data["probing"])
        ids = np.array(data["vec_id"], dtype=np.int64)
        copies = np.array(data["copies"], dtype=np.int64)
        home, mine = np.array(data["home"]), np.array(data["mine"])
        unit = _unit(data["vector"])
        x, y = np.flatnonzero(probing), np.flatnonzero(coded)
        found_x, found_y = [], []
        if len(x) and len(y):
            codes = np.frombuffer(b"".join(data["code"][i] for i in y), dtype=np.uint8).reshape(len(y), -1)
            error = np.array([data["error"][i] for i in y])
            center = book.center(place)
            margin_y = np.full((len(y), int(book.first[-1])), np.inf)
            for r, i in enumerate(y):
                margin_y[r, data["near"][i]] = data["margin"][i]
            for at in range(0, len(x), 512):
                own = x[at : at + 512]
                near = book.distances(unit[own] - center, codes) <= far + error[None, :] + 1e-9
                # A pair of one list counts where the smaller id probes. A pair of two lists counts once: in the list
                # that the closer of both to the border probes.
                other = margin_y[:, home[own]].T
                smaller = ids[own][:, None] < ids[y][None, :]
                closer = mine[own][:, None]
                first = (closer < other) | ((closer == other) & smaller)
                near &= np.where(native[own][:, None], smaller, first & (ids[own][:, None] != ids[y][None, :]))
                a, b = np.nonzero(near)
                for part in range(0, len(a), 50_000):
                    one, two = own[a[part : part + 50_000]], y[b[part : part + 50_000]]
                    good = np.einsum("ij,ij->i", unit[one], unit[two]) >= least
                    found_x.append(one[good])
                    found_y.append(two[good])
        a = np.concatenate(found_x) if found_x else np.empty(0, np.int64)
        b = np.concatenate(found_y) if found_y else np.empty(0, np.int64)
        counts = np.zeros(len(ids), dtype=np.int64)
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        root = _roots(a, b, ids)
        some = counts > 0
        return pa.table({"vec_id": ids[some], "n": counts[some], "root": root[some]})

    return run


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vec_id of ``vectors`` (vec_id, embedding, label).

    Vectors of one label link when their cosine, in double precision, is at least ``least``. A null vector or label,
    one without or with null or non-finite components or with norm 0 links with nothing; so do vectors of different
    length. Rows with one vec_id are one vector: the least of them by label and components. A null vec_id gives one
    row with itself as a null component, kept. An empty table gives no rows.

    Equal vectors are compared once, whatever their number: a class counts its copies in ``n_links``, so a third of all
    rows being one vector costs no more than one row. Nothing is lost to the index: linked unit vectors are at most
    r = sqrt(2 - 2 * least) apart, so if their lists part at some level, one of them is within r / 2 of the border between
    both there and probes the other's list, and at later levels it is within r of every border before the other's; and a
    code that is farther than r plus its own error cannot be within r. Lists grow with the vectors of a label, by a
    level of centroids at a time. A list crowded beyond a block, as one of near copies is, is compared block by block; a
    block pair returns a count and one root per linked vector, never pairs.
    """
    reach = float(np.sqrt(2 - 2 * least)) / 2 * (1 + 1e-9) + 1e-12
    context = vectors.sparkSession.sparkContext
    one = vectors.groupBy("vec_id").agg(F.min(F.struct(F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))).alias("v"))
    one = stage(one.select("vec_id", "v.label", "v.embedding"), "vectors")
    valid = stage(one.select("vec_id", "label", "embedding").mapInArrow(_valid, "vec_id long, label long, dim int, vector binary"), "vectors-valid")
    # Equal vectors of one label are one class under their smallest id; only classes are compared.
    same = ["label", "dim", "vector"]
    classes = stage(valid.groupBy(*same).agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "vectors-classes")
    shared = context.broadcast(fit(classes))
    rows = stage(classes.mapInArrow(_index(shared, reach), _ROW), "vectors-index")
    place = ["label", "dim", "list"]
    sizes = rows.groupBy(*place).agg(F.count("*").alias("all"), F.sum(F.col("native").cast("long")).alias("own"))
    sizes = sizes.where("own > 0 AND all > 1")
    rows = rows.join(sizes, place)
    coded_blocks = F.ceil(F.col("own") / NATIVE_BLOCK).cast("int")
    probe_blocks = F.ceil(F.col("all") / PROBE_BLOCK).cast("int")
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)).cast("int")
    columns = [c for c in rows.columns if c not in ("all", "own")]
    probes = rows.select(*columns, F.lit(True).alias("probing"), F.lit(False).alias("coded"), F.pmod(spread, probe_blocks).alias("p"), F.explode(F.sequence(F.lit(0), coded_blocks - 1)).alias("c"))
    coded = rows.where("native").select(*columns, F.lit(False).alias("probing"), F.lit(True).alias("coded"), F.explode(F.sequence(F.lit(0), probe_blocks - 1)).alias("p"), F.pmod(spread, coded_blocks).alias("c"))
    found = probes.union(coded).groupBy(*place, "p", "c").applyInArrow(_link(shared, least), "vec_id long, n long, root long")
    found = stage(found, "vectors-links")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("others"))
    parts = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    linked = classes.join(counts, "vec_id", "left").join(parts.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    linked = linked.select(
        *same, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    members = valid.join(linked, same).select("vec_id", "n_links", "component_id")
    out = one.select("vec_id").join(members, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
