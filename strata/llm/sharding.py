"""Sharding by weighted rendezvous hashing, with DataFrame functions only.

Every (key, shard) pair has a pseudo-random u in (0, 1]; a key goes to the shard with the smallest -ln(u) / weight (ties:
the smaller number). A key's draws for the old shards do not change when one is added, so it stays or moves to the new one.

Defined cases: a null key is the text "null"; a null text has no bytes and the crc32 of empty text; repeated rows go to
one shard and get slots of their own; an empty table gives no rows. Columns other than key and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

_DRAWS = 2**52


def draw(key: Column, shard: int) -> Column:
    """The pair's u: 52 bits of an md5."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 1).cast("double") / F.lit(float(_DRAWS))


def cost(key: Column, shard: int, weight: float) -> Column:
    return -F.ln(draw(key, shard)) / F.lit(float(weight))


def place(df: DataFrame, key: str, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """Adds ``shard``, and ``grown_shard``: where the key goes if one more shard joins. Weights must be above zero."""
    if not weights or min(*weights, grown_weight) <= 0:
        raise ValueError("each shard needs a weight above zero")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    offers = F.array(*[F.struct(cost(name, s, w).alias("cost"), F.lit(s).alias("shard")) for s, w in enumerate(weights)])
    best = df.withColumns({"__best": F.array_min(offers), "__new": cost(name, len(weights), grown_weight)})
    return best.withColumns(
        {
            "shard": F.col("__best.shard"),
            "grown_shard": F.when(F.col("__new") < F.col("__best.cost"), F.lit(len(weights))).otherwise(F.col("__best.shard")),
        }
    ).drop("__best", "__new")


def shard_documents(df: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    Slots are numbered without a sort of a whole shard in one task: the narrow rows are written once with the number of
    the task that wrote them, rows are numbered within (shard, task), and each such run starts where the earlier tasks'
    runs of its shard end.
    """
    rows = df.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("run"),
    )
    rows = written(place(rows, key, weights), "shards")
    runs = rows.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "run").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(within)).join(starts, ["shard", "run"])
    return numbered.select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.col("place") - 1).alias("slot"),
        "grown_shard",
    )
