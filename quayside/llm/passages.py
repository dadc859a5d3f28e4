"""Repeated passages of words: level-wise doubling.

Which windows of ``width`` words stand in more than one place?  A repeated window holds repeated windows of
half its length, those hold repeated quarters, and so on.  So the shortest length is looked at first, and
only windows repeated there are extended to twice the length, until none is left or ``width`` is reached
(35 words: 9, 18, 35):

1. Of the shortest windows inside a window of full width one speaks for it, the one with the smallest hash:
   its *anchor*.  Neighbouring windows with one anchor form a *run*, so one row in fourteen words is compared.
2. Runs whose anchor occurs twice are extended: to twice the length beyond the anchor where the full window
   reaches that far, else before it.  Runs whose longer key occurs once only end here; this is repeated for
   each doubling.
3. At full width runs are compared by their whole *extent* first: equal extents settle all their windows in one
   row.  Where one key has several extents, one run of each goes on window by window, by 128 bits of hash.

Keys are counted by partial aggregates and looked up by joins that split hot keys: a passage in a third of
all documents is one row a task in the counts, and no list of its places is ever made.  Each level is
stored in the shared folder, so a lost executor costs a re-read.

Every row is a document of its own, also rows without an id, rows that share an id and whole copies of a
row: copies repeat each other.  Null and empty texts have no words and no repeats, texts of fewer than
``width`` words no repeats.  No column but the text is looked at; all are handed on in the struct ``row``, so
no name can clash.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import scratch
from .arrays import BLANKS, CODES_2, Rolling, first_smallest, groups, mix, texts_of, word_bounds, word_hashes
from .filters import looked_up, repeated
from .shared import batch, by_batch, drop_shuffles, in_row, stored, table

WIDTH = 35
SHORTEST = 8  # lengths are halved while they stay above this
PLACE = 14  # bits for the anchor and the number of starts of a run
_HALF = PLACE // 2


def ladder(width: int) -> list[int]:
    """The lengths compared, each at most twice the one before: 35 gives 9, 18, 35."""
    lengths = [width]
    while (half := -(-lengths[0] // 2)) > SHORTEST:
        lengths.insert(0, half)
    return lengths


def _pack(first, anchor, last):
    return (first << PLACE) | ((anchor - first) << _HALF) | (last - first)


def _unpack(place):
    first, mask = place >> PLACE, (1 << _HALF) - 1
    return first, first + ((place >> _HALF) & mask), first + (place & mask)


def _word_groups(column: pa.Array):
    """For groups of texts of a batch: first and last row, the bytes, word starts and ends, first words."""
    data, offsets = texts_of(column)
    for i, j in groups(offsets):
        part = data[offsets[i] : offsets[j]]
        yield i, j, part, *word_bounds(part, offsets[i : j + 1] - offsets[i], BLANKS)


def _anchors(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """Runs of windows with one anchor: the anchor's key, the document, the run's place."""

    def work(rows):
        who = rows.column("who").to_numpy()
        for i, _, data, starts, ends, first in _word_groups(rows.column("text")):
            if len(starts) < width:
                continue
            key = Rolling.over(word_hashes(data, starts, ends)).windows(gram)
            anchor = first_smallest(key, width - gram + 1)
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            inside = np.flatnonzero(text[: len(anchor)] == text[width - 1 :])
            if not len(inside):
                continue
            at, own = anchor[inside], text[inside]
            fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (own[1:] != own[:-1])]))
            last = inside[np.append(fresh[1:], len(inside)) - 1]
            low = first[own[fresh]]
            yield batch(key=key[at[fresh]].view(np.int64), who=who[i + own[fresh]],
                        place=_pack(inside[fresh] - low, at[fresh] - low, last - low))

    return by_batch(docs, work, "key long, who long, place long")


def _with_places(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The documents that hold some runs, with their places (as many as a text's words, at most)."""
    return docs.join(runs.groupBy("who").agg(F.sort_array(F.collect_list("place")).alias("places")), "who")


def _placed_groups(rows):
    """``_word_groups`` with the places asked for: owner (text of the group) and place of each."""
    lists = rows.column("places")
    counts = lists.value_lengths().to_numpy()
    flat, reach = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(counts)])
    for i, j, *found in _word_groups(rows.column("text")):
        yield i, *found, np.repeat(np.arange(j - i), counts[i:j]), flat[reach[i] : reach[j]]


def _extended(docs: DataFrame, runs: DataFrame, width: int, gram: int, size: int) -> DataFrame:
    """Runs cut in two, each with the key of ``size`` words around its anchor and that of its extent."""

    def work(rows):
        who = rows.column("who").to_numpy()
        for i, data, starts, ends, first, own, place in _placed_groups(rows):
            if not len(place):
                continue
            words = word_hashes(data, starts, ends)
            one, two = Rolling.over(words), Rolling.over(mix(words))
            begin, anchor, last = (x + first[own] for x in _unpack(place))
            for beyond in (True, False):
                # windows that reach ``size`` words beyond the anchor's first; the others hold as many before its last
                a = np.maximum(begin, anchor - (width - size)) if beyond else begin
                b = last if beyond else np.minimum(last, anchor - (width - size) - 1)
                some = np.flatnonzero(a <= b)
                if not len(some):
                    continue
                a, b, at = a[some], b[some], anchor[some]
                key = one.spans(at, at + size) if beyond else one.spans(at + gram - size, at + gram)
                extent = two.spans(a, b + width) + mix((at - a).astype(np.uint64))
                low = first[own[some]]
                yield batch(key=mix(key + np.uint64(beyond)).view(np.int64), extent=mix(extent).view(np.int64),
                            who=who[i + own[some]], place=_pack(a - low, at - low, b - low))

    return by_batch(_with_places(docs, runs), work, "key long, extent long, who long, place long")


def _windows(docs: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """Every window of the given runs, with 128 bits of hash."""

    def work(rows):
        who = rows.column("who").to_numpy()
        for i, data, starts, ends, first, own, place in _placed_groups(rows):
            if not len(place):
                continue
            begin, _, last = _unpack(place)
            many = last - begin + 1
            run = np.repeat(np.arange(len(place)), many)
            start = begin[run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            at = start + first[own[run]]
            one, two = (Rolling.over(word_hashes(data, starts, ends, *codes)).spans(at, at + width)
                        for codes in ((), (CODES_2,)))
            yield batch(one=one.view(np.int64), two=two.view(np.int64), who=who[i + own[run]], first=start)

    return by_batch(_with_places(docs, runs), work, "one long, two long, who long, first long")


def _spans(docs: DataFrame, width: int) -> DataFrame:
    """who, spans: for documents with repeats, pairs of first word and first word after; they may overlap."""
    lengths = ladder(width)
    gram = lengths[0]
    if not 0 <= width - gram < 1 << _HALF:
        raise ValueError(f"windows of {width} words: 1 to 140 are supported")
    parts, sizes = stored(_anchors(docs, width, gram), "level"), lengths[1:-1] or [gram]
    for size in sizes:
        parts = stored(_extended(docs, repeated(parts, ["key"]), width, gram, size), "level")
    # full width: copies of an extent are settled, the others meet window by window where their keys agree
    extents = stored(
        parts.groupBy("key", "extent").agg(F.count("*").alias("n"), F.min(F.struct("who", "place")).alias("run")), "level")
    settled = looked_up(parts, extents.filter("n > 1"), ["key", "extent"])
    mixed = repeated(extents, ["key"]).select("run.who", "run.place")
    windows = stored(_windows(docs, mixed, width), "level")
    alone = repeated(windows, ["one", "two"])
    begin = F.shiftright("place", PLACE)
    found = settled.select(
        "who", begin.alias("first"), (begin + F.col("place").bitwiseAND(F.lit((1 << _HALF) - 1)) + width).alias("end")
    ).unionByName(alone.select("who", "first", (F.col("first") + width).alias("end")))
    return found.groupBy("who").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"))


def with_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``repeats``: spans of words, first and end, sorted, covered by windows
    that also stand elsewhere; they may overlap, and there are none (an empty list) where nothing repeats.

    Rows are known by their ids; if ids are missing or shared, rows are stored once with numbers of their own.
    """
    whole = in_row(docs)
    name = F.col(f"row.`{id_col}`").cast("long")
    keyed = whole.withColumn("who", name)
    with scratch(docs.sparkSession) as files:
        if not keyed.groupBy("who").agg(F.count("*").alias("n")).filter("n > 1 or who is null").isEmpty():
            keyed = files.keep(whole.withColumn("who", F.monotonically_increasing_id()), "rows")
        spans = files.keep(_spans(keyed.select("who", F.col(f"row.`{text}`").alias("text")), width), "spans")
    drop_shuffles(docs.sparkSession)
    empty = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return keyed.join(spans, "who", "left").select("row", F.coalesce("spans", empty).alias("repeats"))


def _covered(rows, first: np.ndarray, i: int, j: int) -> np.ndarray:
    """Which words of a group lie in a span."""
    spans = rows.column("repeats").slice(i, j - i)
    counts = spans.value_lengths().to_numpy()
    flat = spans.flatten()
    low = np.repeat(first[:-1], counts)
    depth = np.zeros(first[-1] + 1, np.int64)
    np.add.at(depth, flat.field("first").to_numpy() + low, 1)
    np.add.at(depth, flat.field("end").to_numpy() + low, -1)
    return np.cumsum(depth)[:-1] > 0


def _kept_texts(rows):
    """For each text of a batch: its row, number of words, how many go, and the others joined by one space."""
    for i, j, data, starts, ends, first in _word_groups(rows.column("text")):
        gone = _covered(rows, first, i, j)
        keep = np.flatnonzero(~gone)
        long = ends[keep] - starts[keep] + 1  # a space before each
        total = int(long.sum())
        reach = np.concatenate([[0], np.cumsum(long)])
        out = np.full(total, 0x20, np.uint8)
        if total:
            step = np.ones(total, np.int64)  # where the bytes come from: up by one, and a jump at each word
            step[reach[:-1]] = np.concatenate([[starts[keep[0]] - 1], starts[keep[1:]] - ends[keep[:-1]]])
            source = np.cumsum(step)
            letter = np.ones(total, bool)
            letter[reach[:-1]] = False
            out[letter] = data[source[letter]]
        bound = reach[np.searchsorted(keep, first)]
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
        for k in range(j - i):
            yield i + k, int(first[k + 1] - first[k]), int(removed[k]), out[bound[k] + 1 : bound[k + 1]].tobytes()


def cut_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """All columns, the text replaced by its words without repeats, joined by one space; null stays null.

    Of a passage no copy stays: windows are judged on the input.
    """

    def work(rows):
        texts = [kept.decode("utf-8", "surrogatepass") for _, _, _, kept in _kept_texts(rows)]
        none = rows.column("text").is_null().to_numpy(zero_copy_only=False)
        new = pa.array(texts, pa.string(), mask=none)
        own = rows.column("row")
        fields = [own.field(f.name) if f.name != text else new for f in own.type]
        yield pa.RecordBatch.from_arrays(fields, names=[f.name for f in own.type])

    found = with_repeats(docs, text, id_col, width).select("row", "repeats", F.col(f"row.`{text}`").alias("text"))
    return by_batch(found, work, docs.schema)


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    def work(rows):
        found = list(_kept_texts(rows))
        yield batch(
            doc_id=rows.column("doc_id"), n_words=pa.array([n for _, n, _, _ in found], pa.int64()),
            n_removed=pa.array([n for _, _, n, _ in found], pa.int64()),
            kept_sha256=pa.array([hashlib.sha256(kept).hexdigest() for *_, kept in found], pa.string()))

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return by_batch(with_repeats(docs).select("row.doc_id", "row.text", "repeats"), work,
                    "doc_id long, n_words long, n_removed long, kept_sha256 string")


#: whole windows as text; repeated ones mark the words they cover
OP11_SQL = r"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    win AS MATERIALIZED (
      SELECT doc_id, s, array_to_string(words[s + 1 : s + 35], ' ') AS body
      FROM (SELECT doc_id, words, unnest(range(0, len(words) - 34)) AS s FROM w)),
    twice AS (SELECT body FROM win GROUP BY body HAVING count(*) > 1),
    gone AS MATERIALIZED (
      SELECT DISTINCT doc_id, p FROM (
        SELECT doc_id, unnest(range(s, s + 35)) AS p FROM win WHERE body IN (SELECT body FROM twice))),
    word AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS p FROM w),
    kept AS (
      SELECT e.doc_id, string_agg(word, ' ' ORDER BY p) AS body
      FROM word e WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = e.doc_id AND g.p = e.p) GROUP BY e.doc_id)
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
      sha256(coalesce(k.body, '')) AS kept_sha256
    FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON w.doc_id = g.doc_id"""
