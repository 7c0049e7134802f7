"""Building blocks shared by the operators: stamping, flattening, one row per key, joins with empty keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AS_JSON = (T.VariantType, T.MapType)


def stamp(df: DataFrame, ingest_date: str, retrieved_at_utc: str) -> DataFrame:
    """Add load date and retrieval time to every row; all other columns stay."""
    return df.withColumns({"ingest_date": F.lit(ingest_date), "retrieved_at_utc": F.lit(retrieved_at_utc)})


def flatten(df: DataFrame) -> DataFrame:
    """Nested columns become JSON text with sorted keys, so a table keeps one schema over all loads."""

    def flat(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.VariantType):
            nested = F.schema_of_variant(column).rlike("^(OBJECT|ARRAY)")
            plain = F.try_variant_get(column, "$", "string")
            return F.when(nested, F.to_json(column)).otherwise(plain).alias(field.name)
        if isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
            return F.to_json(F.parse_json(F.to_json(column))).alias(field.name)
        return column

    return df.select(*[flat(f) for f in df.schema.fields])


def told(df: DataFrame, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Records that say anything: a line that could not be read has only nulls."""
    return df.where(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in df.columns if c not in ignored]).isNotNull())


def keep_one(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row per key in the given order.

    Spark limits each group to one row in the map tasks before it shuffles, so a key with a large share of
    the rows reaches its reducer as one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def top_per_group(df: DataFrame, group: list[str], k: int, *order: Column) -> DataFrame:
    """Rows ranked 1..k per group; also limited in the map tasks first."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def row_hash(df: DataFrame) -> Column:
    """Hash over all columns, depending on content only."""
    columns = [(F.col(f"`{f.name}`"), isinstance(f.dataType, _AS_JSON)) for f in df.schema]
    return F.xxhash64(*[F.to_json(c) if as_json else c for c, as_json in columns])


def lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a side that is unique on ``keys``.

    Rows with a null or empty key cannot match. There may be very many of them, so each gets
    a lane of its own by content hash instead of meeting in one shuffle partition; the other side is all in lane 0.
    That 0 is computed from the key: the optimizer would propagate a plain constant into the condition and
    shuffle by the key alone.
    """
    empty = F.lit(False)
    for key in keys:
        empty = empty | F.col(key).isNull() | (F.col(key).cast("string") == "")
    lane = F.when(empty, F.lit(1) + F.pmod(row_hash(left), F.lit(1 << 62))).otherwise(F.lit(0).cast("bigint"))
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))
    return left.withColumn("_lane", lane).join(right.withColumn("_lane", zero), [*keys, "_lane"], "left").drop("_lane")
