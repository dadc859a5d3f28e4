"""Token ids on disk as directly addressable codes.

Each id is split into chunks of eight bits, lowest first.  Level 0 has the first chunk of every id and
a bitmap that says which ids go on; level 1 has the second chunk of just those, with a bitmap of its
own, and so on.  A directory of ones before each block of a bitmap gives the place in the next level,
so any id can be read alone: no block is decoded.

A file is Parquet with one row per run of whole documents: their ids, where each begins, the codes, and how many ids
of the same part come before, so that reading moves no codes.
Rows follow ascending doc_id (nulls first, then text order).  Null texts are empty: one end id.
Repeated rows are written as often as they occur; an empty table gives an empty file.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..settings import new_path
from .shared import batch, table, tidy
from .tokens import encoder, vocabulary

END = 2
BLOCK = 512  # bits between directory entries
_HEAD = b"DAC1"


def encode(ids: np.ndarray) -> bytes:
    """The code of a run of ids."""
    out, rest = [], ids.astype(np.uint64)
    levels = 0
    while len(rest):
        higher = rest >> np.uint64(8)
        more = higher > 0
        blocks = -(-len(more) // BLOCK)
        bits = np.packbits(np.pad(more, (0, blocks * BLOCK - len(more))), bitorder="little")
        ones = np.bitwise_count(bits.reshape(blocks, BLOCK // 8)).sum(1)
        rank = (np.cumsum(ones) - ones).astype("<u4")
        chunk = (rest & np.uint64(255)).astype(np.uint8)
        out += [struct.pack("<I", len(rest)), rank.tobytes(), bits.tobytes(), chunk.tobytes()]
        rest = higher[more]
        levels += 1
    return _HEAD + struct.pack("<I", levels) + b"".join(out)


class Codes:
    """Random access to the ids in one code."""

    def __init__(self, data: bytes):
        if data[:4] != _HEAD:
            raise ValueError("not a code of token ids")
        (levels,), at, self.levels = struct.unpack_from("<I", data, 4), 8, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<I", data, at)
            blocks, at = -(-n // BLOCK), at + 4
            rank = np.frombuffer(data, "<u4", blocks, at)
            at += 4 * blocks
            bits = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
            at += blocks * BLOCK // 8
            self.levels.append((rank, bits, np.frombuffer(data, np.uint8, n, at)))
            at += n

    def __len__(self) -> int:
        return len(self.levels[0][2]) if self.levels else 0

    def take(self, places: np.ndarray) -> np.ndarray:
        """The ids at some places; only those places are looked at."""
        out = np.zeros(len(places), np.uint32)
        who, at = np.arange(len(places)), np.asarray(places, np.int64)
        for level, (rank, bits, chunk) in enumerate(self.levels):
            out[who] |= chunk[at].astype(np.uint32) << np.uint32(8 * level)
            byte = at >> 3
            goes_on = (bits[byte] >> (at & 7).astype(np.uint8)) & 1 == 1
            who, at, byte = who[goes_on], at[goes_on], byte[goes_on]
            if not len(who):
                break
            # ones before a place: directory, whole bytes of its block, bits of its byte
            block = at // BLOCK
            low_block, n_blocks = block.min(), block.max() - block.min() + 1
            if n_blocks <= len(at):  # places close together: all blocks from the first to the last
                blocks, which = np.arange(low_block, low_block + n_blocks), block - low_block
            else:
                blocks, which = np.unique(block, return_inverse=True)
            ones = np.bitwise_count(bits.reshape(-1, BLOCK // 8)[blocks]).astype(np.uint16)
            inside = np.cumsum(ones, 1, dtype=np.uint16) - ones
            low = np.bitwise_count(bits[byte] & ((1 << (at & 7)) - 1).astype(np.uint8))
            at = rank[blocks].astype(np.int64)[which] + inside[which, byte % (BLOCK // 8)] + low
        return out

    def run(self, start: int, end: int) -> np.ndarray:
        """The ids of places that follow one another: they do so on every level, so that only the first is looked up."""
        out, who, low = np.zeros(max(end - start, 0), np.uint32), slice(None), start
        n = len(out)
        for level, (rank, bits, chunk) in enumerate(self.levels):
            if not n:
                break
            out[who] |= chunk[low : low + n].astype(np.uint32) << np.uint32(8 * level)
            byte, within = low >> 3, low & 7
            goes_on = np.flatnonzero(np.unpackbits(bits[byte : (low + n + 7) >> 3], bitorder="little")[within : within + n])
            who = goes_on if level == 0 else who[goes_on]
            block = low // BLOCK
            whole = bits[block * BLOCK // 8 : byte]
            first = int(bits[byte]) & ((1 << within) - 1)
            low, n = int(rank[block]) + int(np.bitwise_count(whole).sum()) + first.bit_count(), len(goes_on)
        return out


def write(docs: DataFrame, path: str, vocab: str, end: int = END, ids_per_row: int = 1 << 18) -> None:
    """Ids of all documents, in ascending doc_id order, as files under ``path``."""

    def work(batches):
        part, row = TaskContext.get().partitionId(), 0
        held, names, sizes, n, before = [], [], [], 0, 0
        for rows in batches:
            doc = rows.column("doc_id").to_pylist()
            for i, ids, begin in encoder(vocab).column(rows.column("text")):
                for k in range(len(begin) - 1):
                    held += [ids[begin[k] : begin[k + 1]], np.array([end], np.uint32)]
                    names.append(doc[i + k])
                    sizes.append(int(begin[k + 1] - begin[k]) + 1)
                    n += sizes[-1]
                    if n >= ids_per_row:
                        yield one(part, row, before, held, names, sizes, n)
                        held, names, sizes, n, row, before = [], [], [], 0, row + 1, before + n
        if n:
            yield one(part, row, before, held, names, sizes, n)

    def one(part, row, before, held, names, sizes, n):
        return batch(
            part=pa.array([part], pa.int32()), row=pa.array([row], pa.int32()), before=pa.array([before], pa.int64()),
            doc_ids=pa.array([names], pa.list_(pa.int64())), lengths=pa.array([sizes], pa.list_(pa.int64())),
            n_ids=pa.array([n], pa.int64()), codes=pa.array([encode(np.concatenate(held))], pa.binary()),
        )

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(tidy(work), "part int, row int, before long, doc_ids array<long>, lengths array<long>, n_ids long, codes binary")
        .write.parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, ids_crc32, each read by its addresses."""
    files = spark.read.parquet(path)
    # a row says how many ids of its part come before it; one row per part, as many as shuffle partitions whatever the
    # data, says how many of other parts do: the codes are read where they lie
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    runs = files.join(F.broadcast(parts), "part").select(
        "doc_ids", "lengths", "codes", (F.col("part_start") + F.col("before")).alias("start"))

    def work(batches):
        for rows in batches:
            for names, sizes, data, start in zip(*(rows.column(c) for c in ("doc_ids", "lengths", "codes", "start"))):
                codes, sizes = Codes(data.as_py()), np.array(sizes.as_py(), np.int64)
                ids, ends = codes.run(0, len(codes)).astype("<u4"), np.cumsum(sizes)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                yield batch(
                    doc_id=pa.array(names.as_py(), pa.int64()), start=start.as_py() + np.cumsum(sizes) - sizes,
                    n_tokens=sizes, ids_crc32=pa.array(crc, pa.int64()),
                )

    return runs.mapInArrow(
        tidy(work), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ids")
    write(table(spark, sf_dir, "documents"), path, vocabulary())
    return read(spark, path)
