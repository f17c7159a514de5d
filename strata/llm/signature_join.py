"""MinHash near-duplicates by an inverted join over signature coordinates.

A text's set of word shingles has a signature: for each of ``COORDINATES`` hash functions the least hash (32 bits). Two sets
agree in a coordinate with a probability equal to their similarity, so pairs above the similarity agree in at least
``matches`` coordinates but for a chance of ``MISS`` a pair. Equal sets are one node. Nodes are posted under each pair of
coordinate and value. Coordinates that a node shares with no other go, and with them nodes with fewer than ``matches`` left.
Of the others only the rarest are posted, so many that two nodes with ``matches`` agreements meet in one (the prefix).

* In each list the node with the fewest shingles and one chosen by hash are compared with all others; links join nodes to
  components. In a second turn they are compared with the nodes of other components.
* What remains are lists of several components, of lists with the same nodes one. Nodes outside the component of the list's
  first node meet all nodes of the list, in blocks of ``BLOCK``. Agreements are counted coordinate by coordinate, the prefix
  first, and a candidate that can no longer reach ``matches`` is skipped. A pair is left to its first meeting. The overlap of
  those that reach it is bounded from above on sets shortened to 24 bits a shingle.

Every pair is confirmed on the full sets; copies are never expanded into pairs, and no list goes to one task.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z lower-cased.

Defined cases: null text, empty text and text without words have an empty set and link with nothing; with fewer words than
a shingle takes, the whole sequence is the one shingle; repeated rows and equal sets are linked; a row with a null doc_id
takes part, its component is the smallest known doc_id or null, and it is kept only in the latter case; whole texts of any
length are read; an empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_buffer, slices, tasks_need_package, written
from strata.llm.jaccard_join import needed, shingle_sets, verified
from strata.llm.links import components

COORDINATES = 64
MISS = 1e-9
BLOCK = 2048
CHUNK = 8
TURNS = 2
SLICE_BYTES = 2**22

_ODD = np.random.default_rng(20).integers(0, 2**63, (2, COORDINATES), np.uint64) * np.uint64(2) + np.uint64(1)


def matches_for(num: int, den: int, miss: float = MISS) -> int:
    """The most agreements that a pair of this similarity misses with a chance of at most ``miss``."""
    p, below, least = num / den, 0.0, 0
    while below + (chance := comb(COORDINATES, least) * p**least * (1 - p) ** (COORDINATES - least)) <= miss:
        below, least = below + chance, least + 1
    return least


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDINATES values for each set that is not empty."""
    full = [s for s in sets if len(s)]
    out = np.zeros((len(full), COORDINATES), np.uint32)
    if full:
        shingles, starts = np.concatenate(full), np.cumsum([0, *map(len, full)])[:-1]
        for c in range(COORDINATES):
            x = shingles * _ODD[0, c]
            x ^= x >> np.uint64(32)
            x *= _ODD[1, c]
            out[:, c] = np.minimum.reduceat(x, starts) >> np.uint64(32)
    return out


def stored_set(found: np.ndarray) -> bytes:
    """Six bytes a shingle: the upper 32 bits of all, then the lower 16."""
    return (found >> np.uint64(16)).astype("<u4").tobytes() + (found & np.uint64(0xFFFF)).astype("<u2").tobytes()


def short_set(stored: bytes) -> bytes:
    """Three bytes a shingle: its lower 16 bits, then 8 more. Equal shingles stay equal."""
    n = len(stored) // 6
    return stored[4 * n :] + np.frombuffer(stored, np.uint8, 4 * n)[::4].tobytes()


def _short_values(short: bytes) -> np.ndarray:
    n = len(short) // 3
    return np.frombuffer(short, "<u2", n).astype(np.int32) | np.frombuffer(short, np.uint8, n, 2 * n).astype(np.int32) << 16


def signed_sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (size of the set), node (number of the set), signature and shingles; written to the shared folder."""
    tasks_need_package(docs)

    def signed(batches):
        for batch in batches:
            data, starts = byte_buffer(batch.column("text"))
            for lo, hi in slices(starts, SLICE_BYTES):
                sets = shingle_sets(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], k)
                rows = iter(signatures(sets))
                stored = [stored_set(s) for s in sets]
                nodes = [int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True) for s in stored]
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64())]
                columns += [pa.array([next(rows).tobytes() if len(s) else b"" for s in sets], pa.binary()), pa.array(stored, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "node", "signature", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(rows.mapInArrow(signed, "doc_id long, n long, node long, signature binary, shingles binary"), "signed")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


def prefixes(nodes: DataFrame, matches: int) -> DataFrame:
    """(node, n, key): the rarest shared coordinates of the nodes that can have a partner. Written to the shared folder."""

    def posted(batches):
        coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in batches:
            keys = (_matrix(batch.column("signature")).astype(np.int64) | coordinate).ravel()
            node, n = (np.repeat(batch.column(c).to_numpy(), COORDINATES) for c in ("node", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(keys)], names=["node", "n", "key"])

    postings = nodes.mapInArrow(posted, "node long, n long, key long")
    shared = postings.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    lists = postings.join(shared.hint("shuffle_hash"), "key").groupBy("node", "n").agg(F.collect_list(F.struct("df", "key")).alias("keys"))  # at most COORDINATES
    able = lists.where(F.size("keys") >= matches).select("node", "n", F.slice(F.array_sort("keys"), F.lit(1), F.size("keys") - matches + 1)["key"].alias("keys"))
    return written(able.select("node", "n", F.explode("keys").alias("key")), "prefixes")


def node_bits(nodes: DataFrame) -> np.ndarray:
    """Which of 2^26 places the nodes hash to: 8 MB at any number of nodes, so every task may have it. It only leaves out."""
    place = nodes.select(F.pmod(F.col("node"), F.lit(2**26)).alias("place"))
    words = place.select(F.expr("place div 64").alias("word"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(2**20, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def in_bits(node: pa.Array, bits: np.ndarray) -> np.ndarray:
    place = node.to_numpy() & (2**26 - 1)
    return bits[place >> 6] >> (place & 63) & 1 == 1


def agreeing(pairs: DataFrame, nodes: DataFrame, matches: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose signatures agree in at least ``matches`` coordinates."""
    signed = nodes.select("node", "signature")
    both = pairs.join(signed.toDF("a", "left"), "a").join(signed.toDF("b", "right"), "b").select("a", "b", "left", "right")

    def agree(batches):
        for batch in batches:
            same = (_matrix(batch.column("left")) == _matrix(batch.column("right"))).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= matches))

    return both.mapInArrow(agree, "a long, b long")


def star_pairs(posted: DataFrame, turn: int = 0) -> DataFrame:
    """Pairs of each list's hubs with its nodes of other labels: the node with the fewest shingles, and one by a hash that
    differs by turn."""
    lot = F.xxhash64(F.lit(turn), "node")
    hubs = posted.groupBy("key").agg(
        F.min(F.struct("n", "node", "label")).alias("least"), F.min(F.struct(lot.alias("lot"), "node", "label")).alias("drawn"), F.count("*").alias("m")
    )
    hubs = hubs.where("m > 1").select("key", F.explode(F.array(*(F.struct(f"{h}.node", f"{h}.label") for h in ("least", "drawn")))).alias("hub"))
    met = posted.join(hubs, "key").where(F.col("label") != F.col("hub.label"))
    return met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def open_lists(posted: DataFrame, links: DataFrame) -> DataFrame:
    """(key, node, n, label, mask) of the lists that hold several components; of lists with the same nodes one. Label is the
    node's component, ``mask`` the coordinates of its lists that stay. Written to the shared folder."""
    named = posted.select("key", "node", "n").join(components(links).withColumnRenamed("component", "label"), "node", "left")
    named = written(named.select("key", "node", "n", F.coalesce("label", "node").alias("label")), "labelled")
    sums = [F.sum(F.xxhash64(F.lit(i), "node").cast("decimal(20,0)")).alias(f"h{i}") for i in range(2)]
    lists = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m"), *sums).where("x <> y")
    lists = lists.groupBy("m", "h0", "h1").agg(F.min("key").alias("key")).select("key")
    kept = written(named.join(lists, "key"), "lists")
    masks = kept.groupBy("node").agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftright(key, 32) as int))")).alias("mask"))
    return kept.join(masks, "node")


def first_meetings(left: dict[str, np.ndarray], right: dict[str, np.ndarray], at: int, matches: int) -> np.ndarray:
    """Pairs (place in left, place in right) of different labels with enough agreements that have no common prefix
    coordinate before ``at``. A node of right that is also a left node elsewhere is paired with smaller nodes only."""
    pairs = [np.zeros((0, 2), np.int64)]
    for x in range(len(left["node"])):
        other = np.flatnonzero((right["label"] != left["label"][x]) & (~right["is_left"] | (right["node"] > left["node"][x])))
        own = left["signature"][x]
        in_prefix = (int(left["mask"][x]) >> np.arange(COORDINATES)) & 1 == 1
        order = np.concatenate([np.flatnonzero(in_prefix), np.flatnonzero(~in_prefix)])
        count = np.zeros(len(other), np.int64)
        for step in range(0, COORDINATES, CHUNK):
            if not len(other):
                break
            chunk = order[step : step + CHUNK]
            same = right["signature"][np.ix_(other, chunk)] == own[chunk]
            before = chunk[in_prefix[chunk] & (chunk < at)]
            count += same.sum(1)
            able = count + COORDINATES - step - len(chunk) >= matches
            if len(before):
                met = same[:, np.isin(chunk, before)] & ((right["mask"][other][:, None] >> before) & 1 == 1)
                able &= ~met.any(1)
            other, count = other[able], count[able]
        pairs.append(np.column_stack([np.full(len(other), x), other]))
    return np.concatenate(pairs)


def with_room(left: dict[str, list], right: dict[str, list], pairs: np.ndarray, num: int, den: int) -> np.ndarray:
    """Those of ``pairs`` (in the order of their left places) whose shortened sets leave room for the overlap they need."""
    kept, inside = [pairs[:0]], np.zeros(2**24, bool)
    for some in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1) if len(pairs) else []:
        own = _short_values(left["short"][some[0, 0]])
        others = [_short_values(right["short"][y]) for y in some[:, 1]]
        inside[own] = True
        sizes = np.array([len(o) for o in others])
        most = np.add.reduceat(inside[np.concatenate(others)].astype(np.int64), np.cumsum(sizes) - sizes)
        inside[own] = False
        kept.append(some[most >= needed(len(own), sizes, num, den)])
    return np.concatenate(kept)


def shortened(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, short) of the given nodes. Only their sets are shuffled."""
    shared = sets.sparkSession.sparkContext.broadcast(node_bits(nodes))

    def shorten(batches):
        for batch in batches:
            some = batch.filter(pa.array(in_bits(batch.column("node"), shared.value)))
            short = pa.array([short_set(x) for x in some.column("shingles").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column("node"), short], names=["node", "short"])

    return sets.select("node", "shingles").mapInArrow(shorten, "node long, short binary").dropDuplicates(["node"])


def remaining_pairs(posted: DataFrame, nodes: DataFrame, sets: DataFrame, matches: int, num: int, den: int) -> DataFrame:
    """Pairs of nodes with different labels that meet in a list, agree in ``matches`` coordinates and may reach the threshold,
    each once."""
    parts = posted.groupBy("key", "label").agg(F.count("*").alias("c"), F.min(F.struct("n", "node")).alias("first"))
    lists = parts.groupBy("key").agg(F.sum("c").alias("m"), F.min(F.struct("first", "label", "c")).alias("hub"))
    lists = lists.select("key", "m", F.col("hub.label").alias("hub"), (F.col("m") - F.col("hub.c")).alias("lefts"))
    signed = nodes.select("node", "signature").join(shortened(sets, posted.select("node").distinct()), "node")
    met = posted.join(lists, "key").join(signed, "node").withColumn("is_left", F.col("label") != F.col("hub"))
    met = met.withColumns({"blocks": F.expr(f"(m + {BLOCK} - 1) div {BLOCK}"), "left_blocks": F.expr(f"(lefts + {BLOCK} - 1) div {BLOCK}")})
    place = F.xxhash64("node")
    # a node of either side goes to all blocks of the other; a left node is on both sides
    sides = F.when(F.col("is_left"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    dealt = met.withColumn("side", F.explode(sides))
    others = F.when(F.col("side") == 0, F.col("blocks")).otherwise(F.col("left_blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
    own = F.pmod(place, F.when(F.col("side") == 0, F.col("left_blocks")).otherwise(F.col("blocks")))
    dealt = dealt.withColumns({"i": F.when(F.col("side") == 0, own).otherwise(F.col("other")), "j": F.when(F.col("side") == 0, F.col("other")).otherwise(own)})
    dealt = dealt.select("key", "i", "j", "side", "node", "label", "mask", "signature", "short", "is_left")

    def join(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        both = []
        for s in (0, 1):
            part = table.filter(pa.array(side == s))
            both.append({c: part.column(c).to_numpy() for c in ("node", "label", "mask", "is_left")})
            both[s] |= {"signature": _matrix(part.column("signature")), "short": part.column("short").to_pylist()}
        found = first_meetings(*both, table.column("key")[0].as_py() >> 32, matches)
        found = with_room(*both, found, num, den)
        a, b = both[0]["node"][found[:, 0]], both[1]["node"][found[:, 1]]
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return dealt.groupBy("key", "i", "j").applyInArrow(join, "a long, b long")


def node_components(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of all nodes with a link."""
    matches = matches_for(num, den)
    nodes = written(sets.where("n > 0").select("node", "n", "signature").dropDuplicates(["node"]), "nodes")
    posted = prefixes(nodes, matches).withColumn("label", F.col("node"))
    links = None
    for turn in range(TURNS):
        pairs = written(agreeing(star_pairs(posted, turn), nodes, matches), "pairs")
        found = verified(pairs, sets, num, den)
        links = written(found if links is None else links.union(found), "links")
        posted = open_lists(posted, links)
    rest = written(remaining_pairs(posted, nodes, sets, matches, num, den), "pairs")
    return components(links.union(verified(rest, sets, num, den)))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; component_id is the smallest doc_id reachable by links."""
    sets = signed_sets(docs, k)
    found = node_components(sets, num, den)
    one = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    named = one.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "doc_id")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = named.join(smallest, "component").select("node", "component_id")
    linked = sets.where("n > 0").select("node", "doc_id", "n").join(by_node, "node")
    alone = sets.where("n = 0").select("node", "doc_id", "n", F.col("doc_id").alias("component_id"))
    rows = linked.union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
