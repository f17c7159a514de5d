"""Hierarchical packing of documents into sequences of several lengths.

Each document's ids are cut into full windows of the longest tier; what is left goes to the shortest tier that holds it.
Tier by tier from the longest, a piece opens a window and the gap is filled with the longest pieces of the shorter tiers
that fit, and at last with the head of a shorter piece cut to the gap. So every window of a run is full but the last,
which is dealt out over windows of the lower tiers. Windows are dealt to step groups of about equal numbers of ids.

Packing works on the documents of one task as they come, ``RUN_DOCS`` at a time, so no ids are shuffled; at most one
window of each run has padding.

Defined cases: a null text is empty; each document ends with the end id, so an empty one has one id; a null doc_id and
repeated rows are documents like others; an empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, tasks_need_package, thrifty
from strata.llm.tokens import BYTE_BPE, encoder

TIERS = (128, 256, 512, 1024, 2048)
RUN_DOCS = 4096
RUN_IDS = 2**23
STEP_IDS = 64 * 2048
SLICE_BYTES, FORGETFUL_SLICE_BYTES = 2**22, 2**20  # of text that a worker encodes at a time
FORGETFUL_WORDS = 200_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, step_group long"
)

Piece = tuple[int, int, int]  # document, start, length


def pack(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """Windows as (capacity, pieces) for documents of these many ids."""
    longest = tiers[-1]
    windows: list[tuple[int, list[Piece]]] = []
    tails: list[tuple[int, int, int]] = []  # (length, document, start), ascending
    for doc, size in enumerate(sizes):
        full = size // longest
        windows += [(longest, [(doc, w * longest, longest)]) for w in range(full)]
        if size % longest:
            tails.append((size % longest, doc, full * longest))
    tails.sort()
    while tails:
        length, doc, start = tails.pop()
        tier = next(t for t in tiers if t >= length)
        window, gap = [(doc, start, length)], tier - length
        while gap and tails:
            at = bisect_right(tails, (gap, len(sizes), 0)) - 1
            if at >= 0:
                length, doc, start = tails.pop(at)
                window.append((doc, start, length))
                gap -= length
            else:  # every piece left is longer than the gap
                length, doc, start = tails.pop(0)
                window.append((doc, start, gap))
                insort(tails, (length - gap, doc, start + gap))
                gap = 0
        windows += [(tier, window)] if not gap else _dealt(window, tiers)
    return windows


def _dealt(window: list[Piece], tiers: tuple[int, ...]) -> list[tuple[int, list[Piece]]]:
    """The last window's pieces over full windows of lower tiers; only a rest shorter than the lowest tier needs padding."""
    left, out = sum(p[2] for p in window), []
    queue = window[::-1]
    while left:
        tier = max((t for t in tiers if t <= left), default=0)
        room, pieces = tier or left, []
        left -= room
        while room:
            doc, start, length = queue.pop()
            taken = min(room, length)
            pieces.append((doc, start, taken))
            if taken < length:
                queue.append((doc, start + taken, length - taken))
            room -= taken
        out.append((tier or tiers[-1], pieces))
    return out


def step_groups(used: list[int], step_ids: int = STEP_IDS) -> list[int]:
    """A group for each window: the longest first, each to the group with the fewest ids so far."""
    heap = [(0, g) for g in range(max(1, round(sum(used) / step_ids)))]
    groups = [0] * len(used)
    for w in sorted(range(len(used)), key=lambda w: -used[w]):
        ids, group = heapq.heappop(heap)
        groups[w] = group
        heapq.heappush(heap, (ids + used[w], group))
    return groups


def packed_pieces(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = 1, tiers: tuple[int, ...] = TIERS, forget: bool = False) -> DataFrame:
    """One row per piece. A sequence has sequence_length ids with padding; its number holds the task's in the upper bits. With
    ``forget``, workers keep no words for their next task, fewer within a task, and encode less at a time, which takes less
    memory and more time."""
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers are ascending powers of two")
    tasks_need_package(docs)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().cast("long").alias("task")
    )
    end = struct.pack("<I", end_id)
    most = FORGETFUL_SLICE_BYTES if forget else SLICE_BYTES

    def pieces(batches):
        words = encoder(tokenizer, FORGETFUL_WORDS) if forget else encoder(tokenizer)
        names, held, ids, base = [], [], 0, [None, 0, 0]
        for batch in batches:
            if base[0] is None and batch.num_rows:
                base[0] = batch.column("task")[0].as_py() << 36
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
            for lo, hi in slices(sizes, most):
                for name, raw in zip(doc_ids[lo:hi], words.encode(texts.slice(lo, hi - lo)), strict=True):
                    names.append(name)
                    held.append(raw + end)
                    ids += len(held[-1]) // 4
                    if len(names) >= RUN_DOCS or ids >= RUN_IDS:
                        yield _run(names, held, tiers, base)
                        names, held, ids = [], [], 0
        if names:
            yield _run(names, held, tiers, base)
        if forget:
            words.forget()

    return rows.mapInArrow(thrifty(pieces) if forget else pieces, PIECES)


def _run(names: list, held: list[bytes], tiers: tuple[int, ...], base: list[int]) -> pa.RecordBatch:
    """``base``: the task's number, and how many sequences and groups it has made; both counts go on from here."""
    windows = pack([len(raw) // 4 for raw in held], tiers)
    used = [sum(p[2] for p in w) for _, w in windows]
    groups = step_groups(used)
    columns: list[list] = [[] for _ in range(9)]
    for number, ((capacity, window), group) in enumerate(zip(windows, groups, strict=True)):
        offset = 0
        for doc, start, length in window:
            crc = zlib.crc32(held[doc][4 * start : 4 * (start + length)])
            row = (names[doc], start, length, crc, len(held[doc]) // 4, base[0] + base[1] + number, offset, capacity, base[0] + base[2] + group)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += length
    base[1] += len(windows)
    base[2] += max(groups, default=-1) + 1
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[p.split()[0] for p in PIECES.split(", ")])
