"""Keyed upsert, manifest upsert and the skip-existing split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has_key(keys: list[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def _keyed_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, _new)`` of the source rows that have a key; a repeated key stops the job."""
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    twice = F.raise_error(F.concat(F.lit("duplicate source key: "), F.to_json(F.struct(*keys))))
    return (
        source.where(_has_key(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.any_value(F.struct(*source.columns)).alias("_row"))
        .select(*keys, F.when(F.col("_n") > 1, twice).otherwise(F.col("_row")).alias("_new"))
    )


def _merged_columns(target: DataFrame, source: DataFrame) -> list[Column]:
    """All source columns win where a source row matched; the target's own columns keep their value."""
    added = [c for c in source.columns if c not in target.columns]

    def merged(name: str) -> Column:
        if name not in source.columns:
            return F.col(name)
        old = F.lit(None) if name in added else F.col(name)
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(old).alias(name)

    return [merged(c) for c in [*target.columns, *added]]


def _unmatched_source(target: DataFrame, source: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows to add: those without a partner (found with the target's key columns only) or without a key."""
    matched = target.select(*keys).join(new.select(*keys), keys, "left_semi").distinct()
    inserted = new.join(matched, keys, "left_anti").select("_new.*")
    return inserted.unionByName(source.where(~_has_key(keys)))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after merging the source on ``keys``.

    Matched rows take every source column, nulls included; columns only the target has keep their value;
    unmatched target rows stay; unmatched source rows are added. A null key never matches. Two source rows
    with one key stop the job.

    The target is the large side and only ever the left side of a join: with a small batch it is not
    shuffled at all, with a large one a hot target key is split by skew handling.
    """
    new = _keyed_source(source, keys)
    kept = target.join(new, keys, "left").select(*_merged_columns(target, source))
    return kept.unionByName(_unmatched_source(target, source, new, keys), allowMissingColumns=True)


def upsert_known(target: DataFrame, source: DataFrame, matched: DataFrame, keys: list[str]) -> DataFrame:
    """The same result where the ``matched`` keys are known already: the target is read once."""
    new = _keyed_source(source, keys)
    kept = target.join(new, keys, "left").select(*_merged_columns(target, source))
    added = new.join(matched.select(*keys).distinct(), keys, "left_anti").select("_new.*")
    added = added.unionByName(source.where(~_has_key(keys)))
    return kept.unionByName(added, allowMissingColumns=True)


def merge_manifest(entries: DataFrame) -> DataFrame:
    """Entries ``(identity, seq, …)`` after in-place replacement: the last entry at the first position."""
    rest = [c for c in entries.columns if c != "identity"]
    return (
        entries.groupBy("identity")
        .agg(F.min("seq").alias("pos"), F.max_by(F.struct(*rest), "seq").alias("last"))
        .select("identity", "pos", *[F.col(f"last.{c}").alias(c) for c in rest if c != "seq"])
    )


def split_existing(selected: DataFrame, landed: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Selected artifacts with ``state``: ``skipped`` when already landed, else ``to_land``."""
    if force:
        return selected.withColumn("state", F.lit("to_land"))
    present = landed.select(*keys).distinct().withColumn("_present", F.lit(True))
    state = F.when(F.col("_present"), "skipped").otherwise("to_land")
    return selected.join(present, keys, "left").withColumn("state", state).drop("_present")
