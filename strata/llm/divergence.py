"""Source divergence audit: how far the word use of each source lies from the other sources and from its language.

Tasks count terms with Arrow's compute functions (``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and hash
``group_by``); what they emit are partial counts (lang, source, term, occurrences, documents). One shuffle by language and
term merges them, and terms of fewer than ``least_docs`` documents of the language go. The rest is dealt into columnar
shards: a share of a language's terms times two blocks of its sources. A shard gives a partial distance for each pair of its
sources, and for each source the terms that may be among its top. A frequent term is a sum of partial counts, never a list.

A term that neither of two sources uses adds the same to their distance; these terms are not dealt but multiplied in.

Defined cases: null text, lang and source are the empty text; a group without terms counts as one whose counts are 0; a
language without kept terms has distance 0 between all its sources and no term rows; a source alone in its language has no
pair row; equal values rank by the bytes of the item; repeated rows are separate documents; whole texts are read, a text of
any length is one document; an empty table gives no rows. Columns other than text, lang and source are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import slices, tasks_need_package, written

LEAST_DOCS = 30
TOP_TERMS = 50
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 10**9
SHARD_TERMS, SHARD_SOURCES = 1024, 128
SLICE_BYTES = 2**24

_PARTIAL = "lang string, source string, term string, n long, docs long"


def counted(text: pa.Array, lang: pa.Array, source: pa.Array) -> pa.RecordBatch:
    """Partial counts of some documents: a row for each group and term, and one without a term for each group."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), NO_TERM)
    encoded = words.flatten().dictionary_encode()
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    pairs = pa.table({"doc": pc.list_parent_indices(words), "term": encoded.indices})
    blank = pc.index(encoded.dictionary, "").as_py()  # what lies before the first and behind the last term
    if blank >= 0:
        pairs = pairs.filter(pc.not_equal(pairs["term"], blank))
    per_doc = pairs.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    per_doc = per_doc.append_column("group", pa.array(group[per_doc["doc"].to_numpy()]))
    terms = per_doc.group_by(["group", "term"], use_threads=False).aggregate([("count_all", "sum"), ([], "count_all")])
    groups = pa.table({"group": pa.array(group)}).group_by("group", use_threads=False).aggregate([([], "count_all")])
    of = np.concatenate([terms["group"].to_numpy(), groups["group"].to_numpy()])
    names = pa.concat_arrays([encoded.dictionary.take(terms["term"].combine_chunks()), pa.nulls(len(groups), encoded.dictionary.type)])
    return pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(of // len(sources.dictionary))),
            sources.dictionary.take(pa.array(of % len(sources.dictionary))),
            names,
            pa.array(np.concatenate([terms["count_all_sum"].to_numpy(), np.zeros(len(groups), np.int64)])),
            pa.array(np.concatenate([terms["count_all"].to_numpy(), groups["count_all"].to_numpy()])),
        ],
        names=["lang", "source", "term", "n", "docs"],
    )


def partial_counts(docs: DataFrame) -> DataFrame:
    tasks_need_package(docs)

    def count(batches):
        for batch in batches:
            text, lang, source = batch.columns
            starts = np.concatenate([[0], np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))])
            for lo, hi in slices(starts, SLICE_BYTES):
                yield counted(text.slice(lo, hi - lo), lang.slice(lo, hi - lo), source.slice(lo, hi - lo))

    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    return docs.select(*columns).mapInArrow(count, _PARTIAL)


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of the kept terms; a row without a term for each group. ``first`` is the first
    source that has the term. Written to the shared folder."""
    merged = partial_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    wide = merged.withColumns({"lang_docs": F.sum("docs").over(over), "lang_n": F.sum("n").over(over), "first": F.min("source").over(over)})
    return written(wide.where((F.col("lang_docs") >= least_docs) | F.isnull("term")).drop("docs", "lang_docs"), "terms")


def groups_of(kept: DataFrame) -> DataFrame:
    """(lang, source, number, total, v, lang_total, sources): each group's place in its language, the sum of its counts and of
    its language's, the kept terms and the sources of its language."""
    new = F.col("term").isNotNull() & (F.col("source") == F.col("first"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.when(new, 1)).alias("new"))
    lang = Window.partitionBy("lang")
    numbered = sums.withColumn("number", F.row_number().over(lang.orderBy("source")).cast("long") - 1)
    wide = numbered.withColumns({"v": F.sum("new").over(lang), "lang_total": F.sum("total").over(lang), "sources": F.count("*").over(lang)})
    return written(wide.drop("new"), "groups")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * counts / totals) in two steps of a long division, so that counts may reach 9 * 10^13."""
    high = counts * 10**5
    low = high % totals * 10**4
    return 1 + high // totals * 10**4 + low // totals


def _base(total: Column, v: Column) -> Column:
    """The share of a term that does not occur; 0 where there are no terms."""
    room = total + 5 * v
    return F.when(v > 0, 1 + F.floor(F.lit(5 * SCALE).cast("decimal(20,0)") / room).cast("long")).otherwise(F.lit(0).cast("long"))


def _dealt(df: DataFrame, of: Column) -> DataFrame:
    """One row for each pair of source blocks that ``of``, the row's own block, is in."""
    last = F.expr(f"(sources - 1) div {SHARD_SOURCES}")
    other = df.withColumns({"own": of, "other": F.explode(F.sequence(F.lit(0).cast("long"), last))})
    return other.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other")


def shard_divergences(cells: pa.Table, groups: pa.Table, top: int, block_sources: int) -> pa.Table:
    """Of one shard: (a, b, value) distances of sources less what the shard's terms would add if neither had them, and
    (a, term, value) candidates for the terms of a."""
    numbers = groups["number"].to_numpy()
    order = np.argsort(numbers)
    numbers, totals = numbers[order], groups["total"].to_numpy()[order]
    v, lang_total = groups["v"][0].as_py(), groups["lang_total"][0].as_py()
    rooms = totals + 5 * v
    terms = cells["term"].combine_chunks().dictionary_encode()
    row, column = np.searchsorted(numbers, cells["number"].to_numpy()), terms.indices.to_numpy()
    n = cells["n"].to_numpy()
    share = np.repeat(shares(np.full(len(rooms), 5), rooms)[:, None], len(terms.dictionary), 1)
    base = share[:, 0].copy()
    share[row, column] = shares(n + 5, rooms[row])
    block = numbers // block_sources
    a, b, values = [], [], []
    for x in np.flatnonzero(block == block.min()):
        partners = np.flatnonzero((block == block.max()) & (numbers > numbers[x]))
        a.append(np.full(len(partners), numbers[x]))
        b.append(numbers[partners])
        values.append(np.abs(share[partners] - share[x]).sum(1) - len(terms.dictionary) * np.abs(base[partners] - base[x]))
    found = pa.table({"a": np.concatenate(a), "b": np.concatenate(b), "value": np.concatenate(values)})
    found = found.append_column("term", pa.nulls(len(found), pa.string())).select(["a", "b", "term", "value"])
    if block.min() < block.max():
        return found
    lead = share[row, column] - shares(cells["lang_n"].to_numpy() + 5, np.array(lang_total + 5 * v))
    own = pa.table({"a": cells["number"], "b": pa.nulls(len(cells), pa.int64()), "term": cells["term"], "value": lead})
    own = own.filter(pa.array(lead > 0)).sort_by([("a", "ascending"), ("value", "descending"), ("term", "ascending")])
    a = own["a"].to_numpy()
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return pa.concat_tables([found, own.filter(pa.array(rank < top))])


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: the distance to each other source of the language. Part ``term``:
    the ``top`` terms that the source uses more than its language."""
    kept = kept_counts(docs, least_docs)
    groups = groups_of(kept)
    last_shard = F.expr(f"greatest(v - 1, 0) div {SHARD_TERMS}")
    block = F.expr(f"number div {SHARD_SOURCES}")
    cells = kept.where(F.col("term").isNotNull()).join(groups.select("lang", "source", "number", "v", "sources"), ["lang", "source"])
    cells = cells.withColumn("shard", F.pmod(F.xxhash64("term"), last_shard + 1))
    cells = _dealt(cells, block).select("lang", "shard", "i", "j", "number", "term", "n", "lang_n")
    sides = groups.where("v > 0").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), last_shard)))
    sides = _dealt(sides, block).select("lang", "shard", "i", "j", "number", "total", "v", "lang_total")
    sides = sides.toDF(*sides.columns)  # columns of its own, as both sides come from groups
    schema = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("term", pa.string()), ("value", pa.int64())])

    def diverge(key: tuple[pa.Scalar, ...], own: pa.Table, all_groups: pa.Table) -> pa.Table:
        if not len(own):
            return schema.empty_table()
        found = shard_divergences(own, all_groups, top, SHARD_SOURCES)
        return found.add_column(0, "lang", pa.repeat(pa.scalar(key[0].as_py(), pa.string()), len(found))).cast(schema)

    keys = ["lang", "shard", "i", "j"]
    found = cells.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(diverge, "lang string, a long, b long, term string, value long")
    found = written(found, "divergences")

    corrections = found.where("term is null").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    corrections = corrections.union(corrections.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    based = groups.withColumn("base", _base(F.col("total"), F.col("v")))
    left = based.select("lang", "source", F.col("number").alias("a"), F.col("base").alias("p"), "v")
    right = based.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("base").alias("q"))
    pairs = left.join(right, "lang").where("a <> b").join(corrections, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", "item", (F.coalesce("value", F.lit(0)) + F.col("v") * F.abs(F.col("p") - F.col("q"))).alias("value"))
    terms = found.where("term is not null").join(groups.select("lang", "source", F.col("number").alias("a")), ["lang", "a"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    best = ranked(terms.select("lang", "source", F.col("term").alias("item"), "value"), "term").where(F.col("rank") <= top)
    return ranked(pairs, "pair").union(best)
