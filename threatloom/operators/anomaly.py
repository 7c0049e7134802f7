"""Isolation Forest over flow features (Liu, Ting, Zhou 2008): trees in parallel, model as a table of nodes."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatloom.operators.shaping import top_per_group

FEATURES = ["category_code", "severity", "src_port", "dst_port", "event_count"]
TREES = 100
SAMPLE = 256
THRESHOLD = 0.5
# Codes and draws are whole numbers of so many bits of an MD5 digest: exact as doubles, and any engine can repeat them.
BITS = 48
# A tree's candidates are cut to about this many times its sample before they are ranked.
MARGIN = 4
MODEL = "tree_id int, node_id int, feature int, threshold double, left int, right int, path double, sample int"


def _digits(text: Column, part: int = 0) -> Column:
    """A whole number of ``BITS`` bits: the given part of the text's MD5 digest."""
    width = BITS // 4
    return F.conv(F.substring(F.md5(text.cast("binary")), 1 + part * width, width), 16, 10).cast("bigint")


def feature_matrix(flows: DataFrame) -> DataFrame:
    """Flow features as doubles. A category is coded by its digest: no vocabulary is collected and none are merged."""
    coded = flows.withColumn("category_code", _digits(F.coalesce("category", F.lit(""))))
    return coded.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in FEATURES})


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _split(seed: int, tree_id: int, place: int, low: np.ndarray, high: np.ndarray) -> tuple[int, float] | None:
    """Feature and threshold of a node, from the digest of seed, tree and the node's place; None if all rows are equal.

    Only whole numbers of ``BITS`` bits and single double operations are used, so any engine can repeat the draw.
    """
    usable = np.flatnonzero(high > low)
    if not len(usable):
        return None
    digest = hashlib.md5(f"{seed}/{tree_id}/{place}".encode()).hexdigest()
    width = BITS // 4
    choice, share = int(digest[:width], 16), int(digest[width : 2 * width], 16)
    feature = int(usable[choice % len(usable)])
    return feature, float(low[feature] + (high[feature] - low[feature]) * (share / float(1 << BITS)))


def grow_tree(points: np.ndarray, tree_id: int, seed: int) -> pd.DataFrame:
    """Nodes of one isolation tree over at most ``SAMPLE`` points, numbered level by level from the left.

    The root is at place 1, the children of a node at twice its place and one more.
    """
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: dict[int, tuple] = {}
    open_nodes = [(1, points, 0)]
    while open_nodes:
        place, rows, depth = open_nodes.pop()
        ended = depth >= limit or len(rows) <= 1
        split = None if ended else _split(seed, tree_id, place, rows.min(axis=0), rows.max(axis=0))
        if split is None:
            nodes[place] = (-1, 0.0, place, place, depth + average_path(len(rows)))
            continue
        goes_left = rows[:, split[0]] <= split[1]
        nodes[place] = (*split, 2 * place, 2 * place + 1, 0.0)
        open_nodes += [(2 * place, rows[goes_left], depth + 1), (2 * place + 1, rows[~goes_left], depth + 1)]
    number = {place: i for i, place in enumerate(sorted(nodes))}
    table = pd.DataFrame(
        [(tree_id, i, nodes[p][0], nodes[p][1], number[nodes[p][2]], number[nodes[p][3]], nodes[p][4]) for p, i in number.items()],
        columns=["tree_id", "node_id", "feature", "threshold", "left", "right", "path"],
    )
    return table.assign(sample=len(points))


def draws(matrix: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """``(tree_id, k, rank)`` and features of the ``sample`` flows that each tree draws from all flows.

    Every flow has a turn in every tree, ``(a + tree * b) mod 2^48``, with ``a`` and ``b`` from the digest of its
    keys ``k`` and the seed; a tree takes the smallest turns, the same on every run. Turns are uniform, so only those
    under ``MARGIN`` times the expected limit are kept before they are ranked (at 256 of 1,024 expected ones, 24
    standard deviations off): turns are filtered where they are made, and what is ranked is bounded by trees and sample,
    however many flows there are. ``matrix`` is read twice, so pass a stored table.
    """
    total = matrix.count()
    limit = min(1 << BITS, -(-(1 << BITS) * MARGIN * sample // max(total, 1)))
    keys = [F.col(c).cast("string") for c in ("replay_run_id", "flow_id") if c in matrix.columns]
    rows = matrix.select(F.concat_ws("/", *keys).alias("k"), *FEATURES)
    seeded = F.concat(F.col("k"), F.lit(f"#{seed}"))
    rows = rows.withColumns({"a": _digits(seeded), "b": _digits(seeded, 1)})

    def turn(tree: Column) -> Column:
        return F.pmod(F.col("a") + tree * F.col("b"), F.lit(1 << BITS))

    # The trees whose turn is early enough are found inside the row: a flow gives a few rows, not one per tree.
    early = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: turn(tree) < limit)
    dealt = rows.withColumn("tree_id", F.explode(early)).withColumn("turn", turn(F.col("tree_id"))).drop("a", "b")
    return top_per_group(dealt, ["tree_id"], sample, F.col("turn"), F.col("k"), *map(F.col, FEATURES)).drop("turn")


def train(matrix: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """Model nodes, one tree per group; a group is one tree's draw, never more than ``sample`` rows."""

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        points = rows.sort_values("rank")[FEATURES].to_numpy(dtype=float)
        return grow_tree(points, int(rows["tree_id"].iloc[0]), seed)

    return draws(matrix, trees, sample, seed).groupBy("tree_id").applyInPandas(grow, MODEL)


def save_model(model: DataFrame, root: str, training_date: str) -> str:
    path = f"{root}/training_date={training_date}"
    model.coalesce(1).write.mode("overwrite").parquet(path)
    return path


class _Forest:
    """The node table as arrays, to walk many rows down all trees at once."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        start = nodes.groupby("tree_id")["node_id"].transform("size").groupby(nodes["tree_id"]).first()
        offset = start.cumsum().shift(fill_value=0)
        base = nodes["tree_id"].map(offset).to_numpy()
        self.roots = offset.to_numpy()
        self.feature = nodes["feature"].to_numpy()
        self.threshold = nodes["threshold"].to_numpy()
        self.left = nodes["left"].to_numpy() + base
        self.right = nodes["right"].to_numpy() + base
        self.path = nodes["path"].to_numpy()
        self.norm = average_path(float(nodes["sample"].max())) or 1.0

    def score(self, points: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(points), 1))
        rows = np.arange(len(points))[:, None]
        while True:
            feature = self.feature[at]
            if (feature < 0).all():
                break
            value = points[rows, np.maximum(feature, 0)]
            at = np.where(value <= self.threshold[at], self.left[at], self.right[at])
        return np.exp2(-self.path[at].mean(axis=1) / self.norm)


def score(matrix: DataFrame, model: DataFrame) -> DataFrame:
    """All flows with their ``anomaly_score`` in (0, 1].

    The model has at most ``trees × (2 × sample − 1)`` nodes whatever the data size; that bound is checked
    before the nodes are shipped to the tasks.
    """
    found, last, sample = model.agg(F.count("*"), F.max("tree_id"), F.max("sample")).first()
    if found and found > (last + 1) * (2 * sample - 1):
        raise ValueError("model has more nodes than its trees and samples can make")
    nodes = model.toPandas()
    shipped = matrix.sparkSession.sparkContext.broadcast(nodes)

    def add_score(batches):
        forest = _Forest(shipped.value)
        for rows in batches:
            yield rows.assign(anomaly_score=forest.score(rows[FEATURES].to_numpy(dtype=float)))

    schema = T.StructType([*matrix.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
    return matrix.mapInPandas(add_score, schema)


def anomalies(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Flows classed as anomalous, with their score and features."""
    return scored.where(F.col("anomaly_score") > threshold)
