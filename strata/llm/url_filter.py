"""URL filters: host and path rules, and a Bloom filter cascade for exact membership in a list.

Level 1 of a cascade encodes the listed keys, level 2 the unlisted keys that level 1 lets pass, level 3 the listed keys
that level 2 lets pass, and so on until no key passes wrongly. For every key of the universe it was built over, the number
of levels passed tells exactly whether it is listed. Keys are dealt by hash into segments of bounded size with a cascade
each, so that building and reading need neither a join with the list nor a filter that grows without bound.

Defined cases: a null URL, or one without "://", has an empty host and path and no rule; an empty list or table gives an
empty cascade that lists nothing; repeated keys count once.
"""

from __future__ import annotations

import string
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mixed, tasks_need_package, written

Rule = tuple[str, str]  # "allow" or "block", host and path as one text: ("block", "example.com/en/")

SEGMENT_KEYS = 50_000
BROADCAST_BYTES = 64 * 2**20
HASHES = ["h1", "h2", "segment"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and what it says, both null if none fits. Rules are a short list in code."""
    rule = verdict = F.lit(None).cast("string")
    for says, spelled in sorted(rules, key=lambda r: len(r[1])):  # the last condition put in front is asked first
        name, slash, rest = spelled.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(spelled)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def hashed(df: DataFrame, key: Column, segments: int) -> DataFrame:
    """Adds two 64-bit hashes of the key and its segment. The second hash starts from another seed: with the literal after
    the key it would be a function of the first."""
    return df.withColumns({"h1": F.xxhash64(key), "h2": F.xxhash64(F.lit("second"), key)}).withColumn(
        "segment", F.pmod("h1", F.lit(segments))
    )


def build_cascade(keys: DataFrame) -> tuple[DataFrame, int]:
    """Cascades over ``keys`` (key string, listed boolean: the complete universe). Returns (segment, cascade) rows,
    written to the shared folder, and the number of segments. A key listed by any of its rows is listed."""
    tasks_need_package(keys)
    segments = max(1, -(-keys.count() // SEGMENT_KEYS))
    known = hashed(keys.where(F.col("key").isNotNull()), F.col("key"), segments)
    known = known.groupBy("segment", "h1", "h2").agg(F.bool_or("listed").alias("listed"))
    return written(known.groupBy("segment").applyInPandas(_build_segment, "segment long, cascade binary"), "cascade"), segments


def _build_segment(rows: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = rows["h1"].to_numpy(np.int64).view(np.uint64), rows["h2"].to_numpy(np.int64).view(np.uint64)
    listed = rows["listed"].fillna(False).to_numpy(bool)
    return pd.DataFrame({"segment": [rows["segment"].iloc[0]], "cascade": [cascade_of(h1, h2, listed)]})


def cascade_of(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> bytes:
    """Levels, each as (probes, bits, bitmap)."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[bytes] = []
    while len(inside):
        passing = min(0.5, 0.7 * len(inside) / max(1, len(outside))) if not levels else 0.5
        probes = max(1, round(-np.log2(passing)))
        bits = max(64, int(len(inside) * probes / np.log(2)))
        bitmap = np.zeros(bits, np.uint8)
        for p in range(probes):
            bitmap[_probe(h1[inside], h2[inside], len(levels), p, bits)] = 1
        passed = np.ones(len(outside), bool)
        for p in range(probes):
            passed &= bitmap[_probe(h1[outside], h2[outside], len(levels), p, bits)] == 1
        levels.append(struct.pack("<HQ", probes, bits) + np.packbits(bitmap, bitorder="little").tobytes())
        inside, outside = outside[passed], inside
    return struct.pack("<H", len(levels)) + b"".join(levels)


def _probe(h1: np.ndarray, h2: np.ndarray, level: int, probe: int, bits: int) -> np.ndarray:
    salt = np.uint64((level * 1000 + probe + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mixed(mixed(h1 + salt) ^ h2) % np.uint64(bits)).astype(np.int64)


def listed_by(cascade: bytes | None, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe: a key is listed if it passes an odd number of levels."""
    passed, still = np.zeros(len(h1), np.int64), np.arange(len(h1))
    at, level = 2, 0
    while cascade and at < len(cascade) and len(still):
        probes, bits = struct.unpack_from("<HQ", cascade, at)
        at += 10
        bitmap = np.frombuffer(cascade, np.uint8, (bits + 7) // 8, at)
        at += len(bitmap)
        for p in range(probes):
            where = _probe(h1[still], h2[still], level, p, bits)
            still = still[(bitmap[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1]
        passed[still] += 1
        level += 1
    return passed % 2 == 1


def with_membership(df: DataFrame, key: Column, cascade: DataFrame, segments: int, name: str = "listed") -> DataFrame:
    """Adds whether the row's key is listed. Cascades of at most BROADCAST_BYTES go to all tasks; more are dealt by segment."""
    tasks_need_package(df)
    rows = hashed(df, key, segments)
    columns = [F.col(c) for c in df.columns]
    out = rows.select(*columns, F.lit(True).alias(name)).schema
    total = cascade.agg(F.coalesce(F.sum(F.octet_length("cascade")), F.lit(0))).first()[0]
    if total <= BROADCAST_BYTES:
        known = df.sparkSession.sparkContext.broadcast({r.segment: bytes(r.cascade) for r in cascade.collect()})

        def judge(batches):
            for batch in batches:
                yield _judged(batch, known.value, name)

        return rows.mapInArrow(judge, out)
    parts = 16  # a frequent key's rows spread over so many tasks
    salted = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
    copies = cascade.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def judge_segment(key: tuple[pa.Scalar, ...], pages: pa.Table, filters: pa.Table) -> pa.Table:
        known = {key[0].as_py(): filters.column("cascade")[0].as_py()} if filters.num_rows else {}
        whole = pages.drop_columns(["part"]).combine_chunks()
        judged = [_judged(b, known, name) for b in whole.to_batches()]
        empty = whole.drop_columns(HASHES).append_column(name, pa.array([], pa.bool_())) if not judged else None
        return pa.Table.from_batches(judged) if judged else empty

    return salted.groupBy("segment", "part").cogroup(copies.groupBy("segment", "part")).applyInArrow(judge_segment, out)


def _judged(batch: pa.RecordBatch, known: dict[int, bytes], name: str) -> pa.RecordBatch:
    h1 = batch.column("h1").to_numpy(zero_copy_only=False).view(np.uint64)
    h2 = batch.column("h2").to_numpy(zero_copy_only=False).view(np.uint64)
    segment = batch.column("segment").to_numpy(zero_copy_only=False)
    listed = np.zeros(len(h1), bool)
    order = np.argsort(segment, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(segment[order])) + 1) if len(order) else []:
        listed[rows] = listed_by(known.get(int(segment[rows[0]])), h1[rows], h2[rows])
    kept = batch.drop_columns(HASHES)
    return pa.RecordBatch.from_arrays([*kept.columns, pa.array(listed)], names=[*kept.schema.names, name])


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict. The block list holds every host and path of the corpus that a block rule decides;
    the cascade over all hosts and paths answers for each page, and a page that is not listed is allowed."""
    host, path = host_and_path(F.col(url))
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    key = F.concat("host", "path")
    cascade, segments = build_cascade(judged.select(key.alias("key"), (F.coalesce(says, F.lit("allow")) == "block").alias("listed")))
    found = with_membership(judged.withColumn("rule", rule), key, cascade, segments)
    return found.withColumn("verdict", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).drop("listed")
