"""Exact n-gram Jaccard join with count-vector bounds.

A document's set holds the hashes of its word shingles (48 bits of a 64-bit hash). Equal sets are one node. Two sets that
reach the threshold share one of their first shingles in any common order (prefix principle), so nodes meet at the
shingles of their prefixes; frequent shingles come last in the order. Within a meeting:

* the node with the fewest shingles is compared with all others. After these links are verified and joined to components,
* nodes of different components are joined by an R-tree: shingles are hashed into ``GROUPS`` groups, a node is the point
  of its group counts, pages are boxes of points, and the sum of the smaller coordinates bounds the overlap from above.
  A pair that meets often is left to its first meeting where the ``FIRST_MEETINGS`` first meetings of both nodes show one;
  it never misses its first.
* This goes in turns, as a group of near copies needs few of its links to be one component. A meeting of many nodes is cut
  into blocks. In the first turns a node is compared with the ``NEAREST`` nodes of its block that have most room, and
  components are joined anew. Each turn cuts blocks anew. What they held back comes last: nodes outside a meeting's largest component meet all
  its nodes, block by block, and all pairs of different components that have room are taken.

All pairs that can join two components are verified on their sets, so no component misses a link. Neither copies nor near
copies that are linked already are expanded into all pairs.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z lower-cased.

Defined cases: null text, empty text and text without words have an empty set and link with nothing; with fewer words than
a shingle takes, the whole sequence is the one shingle; repeated rows and equal sets are linked; a row with a null doc_id
takes part, and its component is the smallest known doc_id or null. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import HASH_BASE, HASH_INVERSE, byte_buffer, give_back, mixed, powers, settled, slices, tasks_need_package, thrifty, written
from strata.llm.links import components

GROUPS, COARSE = 256, 32
FULL = 255  # a count of so many or more
BLOCK = 1024
PAGE = 32
BUCKET_KEYS = 2**20
FREQUENT_SHARE = 2000
FIRST_MEETINGS = 8
NEAREST = (4, 16)  # by turn

_PLACE = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and how many words lie before each document's start."""
    n = len(data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    word = ~blank
    begins = word.copy()
    begins[1:] &= blank[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= blank[1:] | edge[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lower * powers(HASH_BASE, n), dtype=np.uint64)])
    hashes = mixed((sums[last] - sums[first]) * powers(HASH_INVERSE, n + 1)[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct 48-bit shingle hashes of each document."""
    words, before = word_hashes(data, starts)
    windows = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        windows += words[j : j + len(windows)] * np.uint64(_PLACE[j % len(_PLACE)] + 2 * (j // len(_PLACE)))
    windows = mixed(windows) >> np.uint64(16)
    sets = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= k:
            found = np.sort(windows[a : b - k + 1])
            sets.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif b > a:
            short = hashlib.blake2b(words[a:b].tobytes(), digest_size=8, salt=b"short").digest()
            sets.append(np.frombuffer(short, np.uint64) >> np.uint64(16))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _stored(found: np.ndarray) -> bytes:
    """Six bytes an element: the upper 32 bits of all, then the lower 16."""
    return (found >> np.uint64(16)).astype("<u4").tobytes() + (found & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _loaded(stored: bytes) -> np.ndarray:
    n = len(stored) // 6
    return np.frombuffer(stored, "<u4", n).astype(np.uint64) << np.uint64(16) | np.frombuffer(stored, "<u2", n, 4 * n).astype(np.uint64)


def document_sets(docs: DataFrame, k: int, row: str | None = None, slice_bytes: int = 2**20) -> DataFrame:
    """doc_id, n (size of the set), node (number of the set), point (shingles per group), shingles, and the row key if one is
    named; written to the shared folder. Texts are taken ``slice_bytes`` at a time, which takes some 50 times the memory."""
    tasks_need_package(docs)
    own = [row] if row else []

    @thrifty
    def sets(batches):
        for batch in batches:
            data, starts = byte_buffer(batch.column("text"))
            for lo, hi in slices(starts, slice_bytes):
                found = shingle_sets(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], k)
                stored = [_stored(s) for s in found]
                nodes = [int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True) for s in stored]
                points = [np.minimum(np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS), FULL).astype("u1").tobytes() for s in found]
                columns = [pa.array([len(s) for s in found], pa.int64()), pa.array(nodes, pa.int64())]
                columns += [pa.array(points, pa.binary()), pa.array(stored, pa.binary())]
                columns += [batch.column(c).slice(lo, hi - lo) for c in own]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), *columns], names=["doc_id", "n", "node", "point", "shingles", *own]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *own)
    schema = "doc_id long, n long, node long, point binary, shingles binary" + "".join(f", {c} long" for c in own)
    return written(rows.mapInArrow(sets, schema), "sets")


def frequent_shingles(sets: DataFrame, documents: int) -> np.ndarray:
    """Shingles that many documents hold; they come last in the order. At most FREQUENT_SHARE times the mean set size."""

    @thrifty
    def counted(batches):
        for batch in batches:
            parts = [_loaded(s) for s in batch.column("shingles").to_pylist()]
            values, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0))
            often = counts >= 4
            yield pa.RecordBatch.from_arrays([pa.array(values[often].astype(np.int64)), pa.array(counts[often].astype(np.int64))], names=["s", "c"])

    least = max(64, documents // FREQUENT_SHARE)
    counts = sets.select("shingles").mapInArrow(counted, "s long, c long").groupBy("s").agg(F.sum("c").alias("c"))
    return np.sort(np.array([r.s for r in counts.where(F.col("c") >= least).select("s").collect()], np.uint64))


def needed(a, b, num: int, den: int):
    """Smallest overlap of sets of these sizes that reaches num / den: den * i >= num * (a + b - i)."""
    return -(-num * (a + b) // (num + den))


def _meetings(sets: DataFrame, frequent: np.ndarray, buckets: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Star pairs (a, b), and meetings of at least three nodes as (meeting, left, right) blocks of nodes."""
    shared = sets.sparkSession.sparkContext.broadcast(frequent)

    @thrifty
    def keys(batches):
        for batch in batches:
            seen, parts = set(), []
            for node, stored in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                n = len(stored) // 6
                if not n or node in seen:
                    continue
                seen.add(node)
                found = _loaded(stored)
                length = n - -(-num * n // den) + 1
                if len(shared.value):
                    at = np.searchsorted(shared.value, found)
                    often = shared.value[np.minimum(at, len(shared.value) - 1)] == found
                    found = np.concatenate([found[~often], found[often]])
                parts.append((found[:length].copy(), node, n))  # a slice would keep the whole set
            if not parts:
                continue
            key = np.concatenate([p for p, _, _ in parts])
            sizes = [len(p) for p, _, _ in parts]
            node = np.repeat(np.array([x for _, x, _ in parts], np.int64), sizes)
            n = np.repeat(np.array([x for _, _, x in parts], np.uint32), sizes)
            bucket = (mixed(key) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((key, bucket))
            names, at = np.unique(bucket[order], return_index=True)
            cut = [np.split(x[order], at[1:]) for x in (key, node, n)]
            blobs = [_stored(a) + b.astype("<i8").tobytes() + c.astype("<u4").tobytes() for a, b, c in zip(*cut, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(blobs, pa.binary())], names=["bucket", "keys"])

    def meet(table: pa.Table) -> pa.Table:
        parts = [(s, len(s) // 18) for s in table.column("keys").to_pylist()]
        key = np.concatenate([_loaded(s[: 6 * m]) for s, m in parts])
        node = np.concatenate([np.frombuffer(s, "<i8", m, 6 * m) for s, m in parts])
        n = np.concatenate([np.frombuffer(s, "<u4", m, 14 * m) for s, m in parts]).astype(np.int64)
        order = np.lexsort((node, n, key))
        key, node, n = key[order], node[order], n[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])  # copies of a set are one node
        key, node, n = key[new], node[new], n[new]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        lead = np.repeat(begin, size)
        star = (np.arange(len(key)) != lead) & (den * n[lead] >= num * n)
        pairs = np.unique(np.column_stack([node[lead[star]], node[star]]), axis=0) if star.any() else np.zeros((0, 2), np.int64)
        groups = {}
        for b, m in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            members = np.sort(node[b : b + m])
            groups[members.tobytes()] = None
        rows = [(p.tobytes(), None, None) for p in np.array_split(pairs, -(-len(pairs) // 100_000))] if len(pairs) else []
        for members in groups:
            name = int.from_bytes(hashlib.blake2b(members, digest_size=8).digest(), "little", signed=True)
            rows.append((members, name, len(members) // 8))
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        del parts, key, node, n, order, new, lead, star, pairs, groups
        give_back()
        return pa.table([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["nodes", "meeting", "m"])

    blobs = sets.select("node", "shingles").mapInArrow(keys, "bucket long, keys binary")
    met = written(blobs.groupBy("bucket").applyInArrow(meet, "nodes binary, meeting long, m long"), "meetings")

    @thrifty
    def pairs_of(batches):
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("nodes").to_pylist()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    stars = met.where("meeting is null").select("nodes").mapInArrow(pairs_of, "a long, b long").distinct()
    whole = met.where("meeting is not null").dropDuplicates(["meeting"])

    @thrifty
    def members_of(batches):
        for batch in batches:
            for nodes, meeting in zip(batch.column("nodes").to_pylist(), batch.column("meeting").to_pylist(), strict=True):
                node = np.frombuffer(nodes, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), meeting)), pa.array(node.copy()), pa.array(np.arange(len(node)) // BLOCK)], names=["meeting", "node", "block"]
                )

    return stars, whole.select("nodes", "meeting").mapInArrow(members_of, "meeting long, node long, block long")


def _bits(nodes: DataFrame) -> np.ndarray:
    """Which of 2^26 places the nodes hash to. Of fixed size at any number of nodes, so every task may have it."""

    @thrifty
    def places(batches):
        for batch in batches:
            place = mixed(batch.column("node").to_numpy().view(np.uint64)) >> np.uint64(38)
            words, at = np.unique(place >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(bits, at, np.uint64(1) << (place & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    rows = nodes.mapInArrow(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(2**20, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def occurring(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` without most of those whose node is not in ``nodes``, before they are shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(_bits(nodes))

    @thrifty
    def keep(batches):
        for batch in batches:
            place = mixed(batch.column("node").to_numpy().view(np.uint64)) >> np.uint64(38)
            hit = shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)
            yield batch.filter(pa.array(hit == 1))

    return rows.mapInArrow(keep, rows.schema)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets reach the threshold. Only sets that occur in pairs are shuffled."""

    def of(column: str) -> DataFrame:
        kept = occurring(sets.select("node", "shingles"), pairs.select(F.col(column).alias("node")).distinct())
        return kept.dropDuplicates(["node"]).toDF(column, f"{column}_set")

    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "a_set", "b_set")

    @thrifty
    def check(batches):
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist(), strict=True)):
                a, b = _loaded(x), _loaded(y)
                overlap = len(np.intersect1d(a, b, assume_unique=True))
                if den * overlap >= num * (len(a) + len(b) - overlap):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return both.mapInArrow(check, "a long, b long")


def _points(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "u1").reshape(-1, GROUPS)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima, an upper bound of the overlap; without bound where both have a full count."""
    least = np.minimum(a, b)
    return np.where((least == FULL).any(-1), np.iinfo(np.int64).max, least.sum(-1, dtype=np.int64))


def bounded(pairs: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` whose count vectors leave room for the overlap they need."""
    with_a = pairs.join(points.toDF("a", "na", "pa"), "a")
    both = with_a.join(points.toDF("b", "nb", "pb"), "b").select("a", "b", "na", "nb", "pa", "pb")

    @thrifty
    def check(batches):
        for batch in batches:
            room = overlap_bound(_points(batch.column("pa")), _points(batch.column("pb")))
            want = needed(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), num, den)
            yield batch.select(["a", "b"]).filter(pa.array(room >= want))

    return both.mapInArrow(check, "a long, b long")


class CountTree:
    """An R-tree over count vectors: entries sorted by size, pages of PAGE entries, boxes by the pages' maxima.

    Boxes and the first look at an entry use sums over neighbouring groups, the second look all groups.
    """

    def __init__(self, points: np.ndarray, n: np.ndarray):
        coarse = _coarse(points)
        self.order = np.lexsort((coarse.argmax(1), n))
        self.points, self.coarse, self.n = points[self.order], coarse[self.order], n[self.order]
        self.levels = []
        tops, low, high = self.coarse, self.n, self.n
        while len(tops) > 1 or not self.levels:
            at = np.arange(0, len(tops), PAGE)
            tops, low, high = np.maximum.reduceat(tops, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((tops, low, high))

    def search(self, point: np.ndarray, n: int, num: int, den: int) -> np.ndarray:
        """Entries whose overlap with the point may reach the threshold."""
        own = _coarse(point[None])[0]
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            tops, low, high = self.levels[level]
            room = np.minimum(tops[nodes], own).sum(1)
            fits = (room >= needed(low[nodes], n, num, den)) & (den * n >= num * low[nodes]) & (den * high[nodes] >= num * n)
            below = len(self.levels[level - 1][0]) if level else len(self.n)
            nodes = (nodes[fits][:, None] * PAGE + np.arange(PAGE)).ravel()
            nodes = nodes[nodes < below]
        other = self.n[nodes]
        fits = (np.minimum(self.coarse[nodes], own).sum(1) >= needed(other, n, num, den)) & (den * n >= num * other) & (den * other >= num * n)
        nodes = nodes[fits]
        return self.order[nodes[overlap_bound(self.points[nodes], point) >= needed(self.n[nodes], n, num, den)]]


def _coarse(points: np.ndarray) -> np.ndarray:
    """Counts of COARSE groups; a full count makes its sum too large to leave anything out."""
    wide = np.where(points == FULL, 2**30, points.astype(np.int64))
    return wide.reshape(len(points), COARSE, -1).sum(2)


def _before(firsts: pa.ChunkedArray, meeting: int) -> np.ndarray:
    """The first meetings of every node, those from ``meeting`` on replaced by it."""
    lists = firsts.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.full((len(sizes), FIRST_MEETINGS), meeting, np.int64)
    out[np.arange(FIRST_MEETINGS) < sizes[:, None]] = lists.flatten().to_numpy()
    return np.minimum(out, meeting)


def _side(table: pa.Table) -> dict[str, np.ndarray]:
    """The nodes of one group, with the first meetings of each."""
    out = {c: table.column(c).to_numpy() for c in ("node", "label", "n")}
    return out | {"point": _points(table.column("point")), "early": _before(table.column("firsts"), table.column("meeting")[0].as_py())}


def _open_pairs(left: dict[str, np.ndarray], right: dict[str, np.ndarray], meeting: int, num: int, den: int, nearest: int | None = None) -> tuple[np.ndarray, bool]:
    """Pairs (a, b), a < b, of a left and a right node of different labels that may reach the threshold and have not met
    before; of each left node the ``nearest`` with most room, if a number is given, and whether more were left out."""
    tree, out, more = CountTree(right["point"], right["n"]), [np.zeros((0, 2), np.int64)], False
    for node, label, n, point, early in zip(*(left[c] for c in ("node", "label", "n", "point", "early")), strict=True):
        hits = tree.search(point, int(n), num, den)
        hits = hits[right["label"][hits] != label]
        if not len(hits):
            continue
        own = early[early < meeting]
        hits = hits[~np.isin(right["early"][hits], own).any(1)]
        if nearest is not None and len(hits) > nearest:
            room = overlap_bound(right["point"][hits], point) - needed(right["n"][hits], int(n), num, den)
            hits, more = hits[np.lexsort((right["node"][hits], -room))[:nearest]], True
        others = right["node"][hits]
        out.append(np.column_stack([np.minimum(others, node), np.maximum(others, node)]))
    return np.unique(np.concatenate(out), axis=0), more


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    named = members.join(labels.withColumnRenamed("component", "label"), "node", "left")
    return named.withColumn("label", F.coalesce("label", "node"))


def _open_meetings(labelled: DataFrame) -> DataFrame:
    """Meetings of several components: their largest, the number of nodes outside it, and their last block."""
    parts = labelled.groupBy("meeting", "label").agg(F.count("*").alias("c"), F.max("block").alias("last"))
    sums = parts.groupBy("meeting").agg(F.max(F.struct("c", "label")).alias("main"), F.sum("c").alias("m"), F.max("last").alias("last"))
    return sums.select("meeting", F.col("main.label").alias("main"), (F.col("m") - F.col("main.c")).alias("outside"), "last").where("outside > 0")


def _nearest_pairs(met: DataFrame, num: int, den: int, nearest: int) -> DataFrame:
    """(a, b) of different components within the blocks of ``met``, and a row of nulls and the meeting where more are left."""

    def join(table: pa.Table) -> pa.Table:
        nodes, meeting = _side(table), table.column("meeting")[0].as_py()
        labels, counts = np.unique(nodes["label"], return_counts=True)
        outside = nodes["label"] != labels[counts.argmax()]
        pairs, more = _open_pairs({c: x[outside] for c, x in nodes.items()}, nodes, meeting, num, den, nearest)
        a, b, of = pairs[:, 0].tolist(), pairs[:, 1].tolist(), [None] * len(pairs)
        if more:
            a, b, of = [*a, None], [*b, None], [*of, meeting]
        return pa.table([pa.array(x, pa.int64()) for x in (a, b, of)], names=["a", "b", "meeting"])

    rows = met.select("meeting", "block", "node", "label", "n", "point", "firsts")
    return rows.groupBy("meeting", "block").applyInArrow(join, "a long, b long, meeting long").distinct()


def _remaining_pairs(met: DataFrame, num: int, den: int) -> DataFrame:
    """All (a, b) of different components: nodes outside a meeting's largest component and its nodes, in blocks of both."""
    outside = F.col("label") != F.col("main")
    met = met.withColumn("parts", F.expr(f"(outside + {BLOCK} - 1) div {BLOCK}"))
    left = met.where(outside).select("*", F.pmod(F.xxhash64("node"), "parts").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("j"))
    right = met.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("i"), F.col("block").alias("j"))
    columns = ["meeting", "i", "j", "node", "label", "n", "point", "firsts"]
    dealt = left.select(*columns, F.lit(True).alias("is_left")).union(right.select(*columns, F.lit(False).alias("is_left")))

    def join(table: pa.Table) -> pa.Table:
        is_left = table.column("is_left")
        sides = [table.filter(x) for x in (is_left, pc.invert(is_left))]
        pairs = np.zeros((0, 2), np.int64)
        if all(len(x) for x in sides):
            pairs, _ = _open_pairs(*map(_side, sides), table.column("meeting")[0].as_py(), num, den)
        return pa.table([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return dealt.groupBy("meeting", "i", "j").applyInArrow(join, "a long, b long").distinct()


def _joined_components(members: DataFrame, labels: DataFrame, points: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``labels`` (node, component) after all links between nodes of different components that meet."""

    def linked(pairs: DataFrame) -> DataFrame:
        return components(labels.toDF("a", "b").union(verified(pairs, sets, num, den)))

    labelled = written(_labelled(members, labels), "labelled")
    met = written(labelled.join(_open_meetings(labelled).select("meeting", "last"), "meeting"), "open")

    def with_points(rows: DataFrame, at: DataFrame, points: DataFrame) -> DataFrame:
        # two nodes of different components have all their meetings in met, in every turn
        firsts = at.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("meeting")), 1, FIRST_MEETINGS).alias("firsts"))
        return rows.join(points, "node").join(firsts, "node")

    def with_own_points(rows: DataFrame) -> DataFrame:
        own = rows.select("node").distinct()
        return with_points(rows, occurring(met.select("node", "meeting"), own), occurring(points, own))

    several_blocks = met.where("last > 0").select("meeting")
    rows = with_points(met, met, points)
    for turn, nearest in enumerate(NEAREST):
        found = written(_nearest_pairs(rows, num, den, nearest), "pairs")
        labels = linked(found.where("meeting is null").select("a", "b"))
        rest = found.where("meeting is not null").select("meeting").union(several_blocks).distinct()
        labelled = written(_labelled(met.select("meeting", "node", "block").join(rest, "meeting", "left_semi"), labels), "labelled")
        rows = labelled.join(_open_meetings(labelled), "meeting")
        if rows.isEmpty():
            return labels
        drawn = F.pmod(F.xxhash64(F.lit(turn), "node"), F.col("last") + 1)  # components of a block meet those of others
        rows = with_own_points(rows.withColumn("block", drawn))
    return linked(written(_remaining_pairs(rows, num, den), "pairs"))


def _components(sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all linked nodes, and the sets' rows that have shingles."""
    sizes = sets.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    keys = sizes.total * (den - num) // den + sizes.documents
    frequent = frequent_shingles(sets, sizes.documents)
    stars, members = _meetings(sets, frequent, max(1, -(-keys // BUCKET_KEYS)), num, den)
    points = written(sets.where("n > 0").select("node", "n", "point").dropDuplicates(["node"]), "points")
    first = components(verified(written(bounded(stars, points, num, den), "pairs"), sets, num, den))
    return _joined_components(written(members, "members"), first, points, sets, num, den), sets.where("n > 0")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; component_id is the smallest doc_id reachable by links."""
    sets = document_sets(docs, k)
    final, full = _components(sets, num, den)
    one = full.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    named = one.join(final, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "doc_id")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = named.join(smallest, "component").select("node", "component_id")
    linked = sets.where("n > 0").select("doc_id", "n", "node").join(by_node, "node", "left")
    alone = sets.where("n = 0").select("node", "doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.select("node", "doc_id", "n", "component_id").union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def surplus_rows(docs: DataFrame, row: str, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Keys ``row`` of all rows but one of each group that links connect. The row of the smallest doc_id stays, null last; of
    equal doc_ids that of the smallest set number, then of the smallest key. Rows without shingles all stay."""
    return settled(docs.sparkSession, lambda: _surplus_rows(docs, row, k, num, den), "surplus")


def _surplus_rows(docs: DataFrame, row: str, k: int, num: int, den: int) -> DataFrame:
    sets = document_sets(docs, k, row)
    final, full = _components(sets, num, den)
    rank = F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", F.col("node").alias("set"), F.col(row).alias("kept"))
    one = full.groupBy("node").agg(F.min(rank).alias("best"))
    named = one.join(final, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "best")
    smallest = named.groupBy("component").agg(F.min("best").alias("best"))
    by_node = named.select("node", "component").join(smallest, "component").select("node", F.col("best.kept").alias("kept"))
    return full.select(row, "node").join(by_node, "node").where(F.col(row) != F.col("kept")).select(row)
