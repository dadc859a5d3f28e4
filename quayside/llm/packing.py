"""Packing of documents into training sequences: shortest pack first over the length histogram.

Each document becomes token ids and an end id, cut into full pieces and one remainder.  Only the
histogram of piece lengths (at most ``size`` numbers, whatever the data) comes to the driver; lengths
are placed longest first, each into the packs with most room left, many at a time.  The resulting
patterns are joined back to the pieces by a piece's rank among those of its length.

Null texts count as empty (one end id); repeated rows are packed as often as they occur; documents
without id keep a null id; an empty table gives no pieces.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.numbering import global_row_id
from ..settings import materialize
from .shared import batch, by_batch, table
from .tokens import encoder, vocabulary

SIZE = 1024
END = 0


def pieces(docs: DataFrame, vocab: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids: doc_id, start, length, ids_crc32, doc_tokens (and their ids,
    little-endian, of two bytes each if the vocabulary has no more than 65536, else of four)."""

    def work(rows):
        stored_as = "<u2" if encoder(vocab).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        doc = rows.column("doc_id")
        for i, ids, begin in encoder(vocab).column(rows.column("text")):
            n = len(begin) - 1
            at = begin + np.arange(n + 1)  # one end id after each text
            full = np.full(at[-1], end, "<u4")
            spare = np.ones(at[-1], bool)
            spare[at[1:] - 1] = False
            full[spare] = ids
            total = np.diff(at)
            parts = -(-total // size)
            row = np.repeat(np.arange(n), parts)
            start = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * size
            length = np.minimum(size, total[row] - start)
            begins = at[row] + start
            slices = [full[b : b + m] for b, m in zip(begins.tolist(), length.tolist())]
            found = {
                "doc_id": doc.take(pa.array(row + i)), "start": start, "length": length,
                "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in slices], pa.int64()),
                "doc_tokens": total[row],
            }
            if with_ids:
                found["ids"] = pa.array([x.astype(stored_as).tobytes() for x in slices], pa.binary())
            yield batch(**found)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return by_batch(docs.select("doc_id", "text"), work, schema + (", ids binary" if with_ids else ""))


def place(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Patterns (lengths packed together) and how often each is used.

    Longest length first; all pieces of a length go to the packs that are shortest so far, as many
    as fit there at a time, and open new packs where none has room.
    """
    by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left, rooms = histogram[length], sorted((r for r in by_room if r >= length and by_room[r]), reverse=True)
        for room in rooms:
            while left and by_room[room]:
                count, pattern = by_room[room].pop()
                used = min(count, left)
                by_room[room - length].append((used, [*pattern, length]))
                if count > used:
                    by_room[room].append((count - used, pattern))
                left -= used
        # packs opened for this length may take further pieces of it
        while left:
            fit = min(size // length, left)
            count = left // fit
            by_room[size - fit * length].append((count, [length] * fit))
            left -= fit * count
    return [(pattern, count) for packs in by_room.values() for count, pattern in packs]


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.  ``cut`` must be stored: it is read twice."""
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    first, slots = 0, []  # slots: length, rank from, sequence of that rank, offset
    taken: dict[int, int] = defaultdict(int)
    for pattern, count in place(histogram, size):
        offset = 0
        for length in pattern:
            slots.append((length, taken[length], first, offset))
            taken[length] += count
            offset += length
        first += count
    slots.sort()
    lengths = sorted(histogram)
    before = dict(zip(lengths, np.cumsum([0, *(histogram[n] for n in lengths)]).tolist()))
    # rank among all pieces in order of length; a length's ranks follow one another
    key = np.array([before[n] + rank for n, rank, _, _ in slots], np.int64)
    sequence = np.array([s for _, _, s, _ in slots], np.int64)
    offset = np.array([o for _, _, _, o in slots], np.int64)

    def work(rows):
        number = rows.column("_number").to_numpy() - 1
        at = np.searchsorted(key, number, "right") - 1
        kept = {c: rows.column(c) for c in rows.schema.names if c != "_number"}
        yield batch(**kept, sequence_id=sequence[at] + number - key[at], offset=offset[at])

    ranked = global_row_id(cut, ["length"], "_number", tie_break=["doc_id", "start", "ids_crc32"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return by_batch(ranked, work, f"{fields}, sequence_id long, offset long")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(materialize(pieces(docs, vocabulary()), "pieces"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document as pieces with their ids, sequence and offset."""
    cut = materialize(
        pieces(docs, vocabulary(), with_ids=True).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    # ranks need only the narrow columns; the ids join the result once
    return pack(cut.drop("ids")).join(cut.select("piece", "ids"), "piece").drop("piece")
