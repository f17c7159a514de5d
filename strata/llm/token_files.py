"""Token-id files of directly addressable codes.

A block holds the ids of about ``BLOCK_IDS`` tokens of whole documents. An id is cut into chunks of 8 bits: level 0 has
the lowest chunk of every id and a bitmap that says whose id goes on, level 1 the next chunk of those, and so on. A
directory holds the number of set bits before every 512th; with it, the place of an id's next chunk is found without
decoding the block, so any id is read in as many steps as it has chunks.

The file format is Parquet with one row per block: run and block (their order is that of the documents), doc_ids,
n_tokens, and codes, which is the block as above. Spark writes and reads it, so it can lie in any store.

Defined cases: a null text is empty; each document ends with the end id, so an empty one has one id; a null doc_id comes
first; repeated rows are separate documents; an empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import slices, tasks_need_package
from strata.llm.tokens import BYTE_BPE, encoder

BLOCK_IDS = 2**20
STEP = 512

BLOCKS = "run long, block long, doc_ids array<long>, n_tokens array<long>, codes binary"


def pack_ids(ids: np.ndarray) -> bytes:
    """Level by level: count, chunks, bitmap, directory."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        directory = np.concatenate([[0], np.cumsum(more)])[: len(rest) + 1 : STEP].astype("<u4")
        out.append(struct.pack("<II", len(rest), len(directory)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + directory.tobytes())
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return struct.pack("<B", len(out)) + b"".join(out)


class Codes:
    """Reads a packed block: all of it, or the id at one place."""

    def __init__(self, packed: bytes):
        self.levels, at = [], 1
        for _ in range(packed[0]):
            n, entries = struct.unpack_from("<II", packed, at)
            chunks = np.frombuffer(packed, np.uint8, n, at + 8)
            bits = np.frombuffer(packed, np.uint8, (n + 7) // 8, at + 8 + n)
            directory = np.frombuffer(packed, "<u4", entries, at + 8 + n + len(bits))
            self.levels.append((chunks, bits, directory))
            at += 8 + n + len(bits) + 4 * entries

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, place: int) -> int:
        value = 0
        for level, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[place]) << (8 * level)
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            first = place // STEP * STEP
            ones = np.unpackbits(bits[first >> 3 : (place >> 3) + 1], bitorder="little")[: place - first]
            place = int(directory[place // STEP]) + int(ones.sum())
        return value

    def all(self) -> np.ndarray:
        above = None
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype("<u4")
            if above is not None:
                value[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= above << np.uint32(8)
            above = value
        return above


def write_tokens(docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = 2) -> None:
    """Writes the ids of all documents in ascending doc_id order. Equal doc_ids may go to several tasks."""
    tasks_need_package(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    end = struct.pack("<I", end_id)

    def blocks(batches):
        encode, run = encoder(tokenizer).encode, None
        ids, sizes, parts, block, held = [], [], [], 0, 0

        def finished():
            codes = pack_ids(np.frombuffer(b"".join(parts), "<u4"))
            columns = [[run], [block], [ids], [sizes], [codes]]
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["run", "block", "doc_ids", "n_tokens", "codes"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            if run is None and batch.num_rows:
                run = batch.column("run")[0].as_py()
            texts, names = batch.column("text"), batch.column("doc_id").to_pylist()
            sizes_of = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
            for lo, hi in slices(sizes_of, 2**22):
                for name, raw in zip(names[lo:hi], encode(texts.slice(lo, hi - lo)), strict=True):
                    ids.append(name)
                    sizes.append(len(raw) // 4 + 1)
                    parts += [raw, end]
                    held += sizes[-1]
                    if held >= BLOCK_IDS or len(ids) >= 4096:
                        yield finished()
                        ids, sizes, parts, block, held = [], [], [], block + 1, 0
        if ids:
            yield finished()

    ranged.drop("row").withColumn("run", F.spark_partition_id().cast("long")).mapInArrow(blocks, BLOCKS).write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the files at ``path``."""
    files = spark.read.schema(BLOCKS).parquet(path)
    tasks_need_package(files)
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = files.select("run", "block", total.alias("ids"))
    inside = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = sizes.groupBy("run").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # one row per writing task
    bases = runs.select("run", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    firsts = sizes.select("run", "block", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("offset")).join(bases, "run")
    documents = files.mapInArrow(_documents, "run long, block long, doc_id long, within long, n_tokens long, ids_crc32 long")
    return documents.join(firsts, ["run", "block"]).select(
        "doc_id", (F.col("base") + F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def _documents(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = Codes(row["codes"]).all()
            sizes = np.array(row["n_tokens"], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["run"], np.int64)),
                    pa.array(np.full(n, row["block"], np.int64)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts[:-1]),
                    pa.array(sizes),
                    pa.array(np.array(crcs, np.int64)),
                ],
                names=["run", "block", "doc_id", "within", "n_tokens", "ids_crc32"],
            )
