"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

The index is a table of shards (about ``SHARD_BYTES`` of text each): document ids and lengths, the shard's terms, and for
each term its documents and frequencies. Tasks write shards of the documents they read, so indexing shuffles nothing.

A search goes through the shards, each time with all items of a block. In a shard, an item's short lists are summed term at
a time into accumulators. These are from then on one more list, with bounds like the long ones, and all are evaluated
document at a time, window by window in document order: a window whose bounds cannot reach the item's threshold is skipped;
within a window, lists whose bounds together stay below the threshold name no candidates and are only looked up for those
of the others, the largest bounds first, while a candidate can still reach the threshold. Thresholds only rise, and a
document that could tie with the last one kept is evaluated. A task keeps an item's best documents over all its shards.

Items are dealt into blocks of about ``BLOCK_BYTES`` of text; a block, its terms' weights among it, goes to all tasks.

Weights are integers as in the query's contract: w = floor(1000 ln((2N+2)/(2 df+1))), and a document's term adds
w * (10^9 tf div (1000 tf + 12 m)) with m = 75 + 25 n N div L, as often as the item holds the term.

Defined cases: null and empty texts hold no terms and are neither counted nor found; an item without terms, or with terms
that no document holds, has no rows; repeated document rows are separate documents; equal scores rank by ascending doc_id,
null last; each item row is an item of its own, so an item_id on two rows has two lists; whole texts are read, one longer
than a shard is a shard of its own; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import byte_buffer, tasks_need_package, written

SHARD_BYTES, SHARD_DOCS = 2**24, 2**16 - 1
BLOCK_BYTES = 2**23
SHORT_SHARE = 8  # lists are short while all of them together hold at most documents / SHORT_SHARE entries
WINDOW = 1024
MERGE_TASKS = 64

_INDEX = "docs long, terms_of_all long, doc_ids array<long>, lengths binary, terms binary, term_ends binary, list_ends binary, places binary, freqs binary"

_IN_TERM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def _packed(values: np.ndarray) -> bytes:
    """Values in the narrowest width that holds them, which the first byte names."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _unpacked(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, f"<u{stored[0]}", offset=1)


def terms_of(data: np.ndarray, starts: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """All terms in their order, lower-cased, and how many lie before each text's start."""
    inside = _IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    first = np.flatnonzero(begins)
    kept = _LOWER[data[inside]]
    offsets = np.append(np.cumsum(inside)[first] - 1, len(kept)).astype(np.int32)
    terms = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return terms, np.searchsorted(first, starts)


def _shard(doc_ids: pa.Array, data: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    terms, before = terms_of(data, starts)
    lengths = np.diff(before)
    full = np.flatnonzero(lengths)
    encoded = terms.dictionary_encode()
    place = np.repeat(np.arange(len(full)), lengths[full])
    postings, freqs = np.unique(encoded.indices.to_numpy().astype(np.int64) * len(full) + place, return_counts=True)
    sizes = np.bincount(postings // max(1, len(full)), minlength=len(encoded.dictionary))
    spelled, ends = byte_buffer(encoded.dictionary)
    blobs = [spelled.tobytes(), *(_packed(x) for x in (ends[1:], np.cumsum(sizes), postings % max(1, len(full)), freqs))]
    columns = [[len(full)], [int(lengths.sum())], [doc_ids.take(pa.array(full))], [_packed(lengths[full])], *([b] for b in blobs)]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 6]
    names = ["docs", "terms_of_all", "doc_ids", "lengths", "terms", "term_ends", "list_ends", "places", "freqs"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def build_index(docs: DataFrame) -> DataFrame:
    """The shards of all documents (doc_id, text), written to the shared folder."""
    tasks_need_package(docs)

    def shards(batches):
        for batch in batches:
            data, starts = byte_buffer(batch.column("text"))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + SHARD_BYTES, side="right")) - 1)
                hi = min(hi, lo + SHARD_DOCS, batch.num_rows)
                shard = _shard(batch.column("doc_id").slice(lo, hi - lo), data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
                if shard.column("docs")[0].as_py():
                    yield shard
                lo = hi

    rows = docs.where(F.octet_length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(rows.mapInArrow(shards, _INDEX), "index")


def _rows(batches):
    """One shard after the other as a dict; a batch may hold many, so they are not unpacked together."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield from batch.slice(at, 1).to_pylist()


def _found(row: dict, asked: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the asked terms a shard has, and from where to where their lists go."""
    ends = np.concatenate([[0], _unpacked(row["term_ends"])]).astype(np.int32)
    own = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(row["terms"])])
    at = pc.index_in(asked, value_set=own)
    here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    at = at.drop_null().to_numpy()
    list_ends = np.concatenate([[0], _unpacked(row["list_ends"]).astype(np.int64)])
    return here, list_ends[at], list_ends[at + 1]


def document_counts(index: DataFrame, asked: pa.Array) -> np.ndarray:
    """How many documents hold each asked term. ``asked`` is bounded by the block of items it comes from."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def count(batches):
        sums = np.zeros(len(shared.value), np.int64)
        for row in _rows(batches):
            here, lo, hi = _found(row, shared.value)
            sums[here] += hi - lo
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["term", "df"])

    parts = index.select("terms", "term_ends", "list_ends").mapInArrow(count, "term long, df long")
    rows = parts.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(asked), np.int64)
    out[rows.column("term").to_numpy()] = rows.column("df").to_numpy()
    return out


class Best:
    """An item's best documents so far: score descending, doc_id ascending, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def threshold(self) -> int:
        """The least score worth a look: ties are decided by doc_id, so they count."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.append(self.score, score), np.append(self.doc, doc), np.append(self.null, null)
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def split_lists(lists: list[tuple[np.ndarray, np.ndarray]], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The lists (places, scores) of an item; its short ones, which hold at most ``most`` entries together, summed into one."""
    ordered = sorted(lists, key=lambda x: len(x[0]))
    held, short = 0, 0
    while short < len(ordered) and held + len(ordered[short][0]) <= most:
        held += len(ordered[short][0])
        short += 1
    if short < 2:
        return ordered
    places, which = np.unique(np.concatenate([p for p, _ in ordered[:short]]), return_inverse=True)
    sums = np.zeros(len(places), np.int64)
    np.add.at(sums, which, np.concatenate([s for _, s in ordered[:short]]))
    return [(places, sums), *ordered[short:]]


def search_shard(
    lists: list[tuple[np.ndarray, np.ndarray]], docs: int, best: Best, doc_ids: np.ndarray, null: np.ndarray, window: int = WINDOW, short_share: int = SHORT_SHARE
) -> int:
    """Evaluates one item over the documents of a shard; returns in how many windows it looked."""
    lists = split_lists(lists, max(window, docs // short_share))
    edges = np.arange(0, docs + window, window)
    cuts = [np.searchsorted(places, edges) for places, _ in lists]
    bounds = np.zeros((len(lists), len(edges) - 1), np.int64)
    for bound, cut, (_, scores) in zip(bounds, cuts, lists, strict=True):
        some = np.flatnonzero(cut[1:] > cut[:-1])
        if len(some):
            bound[some] = np.maximum.reduceat(scores, cut[some])
    total, looked = bounds.sum(0), 0
    sums = np.zeros(window, np.int64)
    for w in range(len(edges) - 1):
        if total[w] < best.threshold:
            continue
        looked += 1
        order = np.argsort(bounds[:, w], kind="stable")
        below = np.cumsum(bounds[order, w])  # what this list and all of smaller bounds can add
        naming = int(np.searchsorted(below, best.threshold))  # lists before this one name no candidates
        sums[:] = 0
        for x in order[naming:]:
            places, scores = lists[x]
            lo, hi = cuts[x][w], cuts[x][w + 1]
            sums[places[lo:hi] - edges[w]] += scores[lo:hi]
        candidates = np.flatnonzero(sums)
        score = sums[candidates]
        for step in range(naming - 1, -1, -1):
            able = score + below[step] >= best.threshold
            candidates, score = candidates[able], score[able]
            x = order[step]
            lo, hi = cuts[x][w], cuts[x][w + 1]
            if not len(candidates):
                break
            if lo == hi:
                continue
            places, scores = lists[x][0][lo:hi], lists[x][1][lo:hi]
            at = np.minimum(np.searchsorted(places, candidates + edges[w]), hi - lo - 1)
            score = score + np.where(places[at] == candidates + edges[w], scores[at], 0)
        able = score >= best.threshold
        if able.any():
            found = candidates[able] + edges[w]
            best.add(score[able], doc_ids[found], null[found])
    return looked


def _weighted(row: dict, lo: np.ndarray, hi: np.ndarray, weights: np.ndarray, n: int, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each asked list: places, and what the term adds to each document's score."""
    m = 75 + 25 * _unpacked(row["lengths"]).astype(np.int64) * n // length
    places, freqs = _unpacked(row["places"]), _unpacked(row["freqs"])
    out = []
    for a, b, w in zip(lo.tolist(), hi.tolist(), weights.tolist(), strict=True):
        place, tf = places[a:b].astype(np.int64), freqs[a:b].astype(np.int64)
        out.append((place, w * (10**9 * tf // (1000 * tf + 12 * m[place]))))
    return out


def _search_block(index: DataFrame, items: list[tuple[int, bytes]], n: int, length: int, k: int) -> DataFrame:
    """(item, task, doc_id, score): the best documents of each item in each task's shards."""
    data, starts = byte_buffer(pa.array([t for _, t in items], pa.binary()))
    terms, before = terms_of(data, starts)
    encoded = terms.dictionary_encode()
    asked = encoded.dictionary
    df = document_counts(index, asked)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    codes = encoded.indices.to_numpy()
    queries = [np.unique(codes[a:b], return_counts=True) for a, b in zip(before[:-1], before[1:], strict=True)]
    shared = index.sparkSession.sparkContext.broadcast((asked, weights, [i for i, _ in items], queries))

    def search(batches):
        asked, weights, numbers, queries = shared.value
        best = [Best(k) for _ in queries]
        for row in _rows(batches):
            here, lo, hi = _found(row, asked)
            place = np.full(len(asked), -1)
            place[here] = np.arange(len(here))
            lists = _weighted(row, lo, hi, weights[here], n, length)
            ids = np.array([0 if d is None else d for d in row["doc_ids"]], np.int64)
            null = np.array([d is None for d in row["doc_ids"]], bool)
            for (terms, times), top in zip(queries, best, strict=True):
                own = [(place[t], c) for t, c in zip(terms.tolist(), times.tolist(), strict=True) if place[t] >= 0 and weights[t] > 0]
                if own:
                    search_shard([(lists[p][0], lists[p][1] * c) for p, c in own], row["docs"], top, ids, null, WINDOW, SHORT_SHARE)
        for number, top in zip(numbers, best, strict=True):
            if len(top.score):
                columns = [pa.array(np.full(len(top.score), number)), pa.array(top.doc, mask=top.null), pa.array(top.score)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return index.mapInArrow(search, "item long, doc_id long, score long").withColumn("task", F.spark_partition_id() % MERGE_TASKS)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item row (item_id, text)."""
    index = build_index(docs)
    sums = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms_of_all"), F.lit(0))).first()
    n, length = int(sums[0]), int(sums[1])
    numbered = items.where(F.octet_length("text") > 0).select("item_id", "text", F.monotonically_increasing_id().alias("item"))
    numbered = written(numbered, "items")
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for block in range(blocks if n else 0):
        own = numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", F.encode("text", "UTF-8")).collect()
        if own:
            part = _search_block(index, [(r[0], bytes(r[1])) for r in own], n, length, k)
            found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long, task int")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", "task"], ["item"]):  # tasks' lists meet in groups first, so no group grows with the documents
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
