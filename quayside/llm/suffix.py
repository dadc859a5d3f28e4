"""Repeated passages: bucket-pointer refinement over the suffixes of all documents.

A suffix's bucket identifier after the first step is the hash of its first ``GRAM`` bytes.  A suffix is then known more
exactly by its own identifier and that of the suffix ``STEP`` bytes later: together they name its first ``GRAM + STEP``
bytes.  With these new identifiers the same is done again, and so on: each refinement uses the identifiers the one before
has made.  Two refinements name ``LENGTH`` bytes.  Identifiers depend on content alone, so buckets of one name in different
tasks are one bucket, and no task needs the buckets of another.

Buckets are refined only where it matters:

1. Every string of LENGTH bytes is stood for by its anchor, the smallest GRAM-byte identifier in it, so
   about one suffix in twenty-seven enters.  Neighbouring strings with one anchor form a run.  Anchors are counted
   alone first; runs whose anchor occurs once are dropped where they arise, through a filter of fixed size.
2. Buckets of one anchor are cut by the identifier of their run's whole extent.  In such a bucket all but the first run
   are settled: all their strings start earlier elsewhere.
3. The first runs of buckets that fell apart are refined: by the suffix ``STEP`` bytes beyond the anchor or before it, one
   of which each of their strings holds.  Those that are alone in their bucket then are done.
4. The rest is refined string by string.  All but the first string of such a bucket are repeats.

The first of a bucket is a minimum in a partial aggregate, joined back with hot keys split, so a passage in a third of
all documents is in no task a list.  Repeats within one batch are settled before any shuffle.  Identifiers have 128 bits
where equality decides.

Order is by doc_id (null first), then offset.  Null and short texts keep all bytes.  Rows that repeat an
id and text count as one document and get the same result; other columns are ignored and handed on in the struct ``row``,
so no name can clash.  Rows without an id are documents of their own, as are rows of one id with different texts:
``tie`` tells them apart and orders them, at the price of storing all rows once more.  Empty tables work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import scratch
from .arrays import CODES, CODES_2, Rolling, first_smallest, groups, mix, texts_of
from .filters import after_first, make_filter, passes, repeated
from .shared import batch, by_batch, drop_shuffles, in_row, stored, table

LENGTH = 100
GRAM = 48
STEP = (LENGTH - GRAM) // 2
PLACE = 14  # bits for the anchor and the number of starts of a run
SPAN = 1 << 20  # bytes of text that are hashed at a time
_HALF = PLACE // 2
_NULL = -(1 << 63)  # stands for a null doc_id: it sorts first
_SPANS = "array<struct<first:bigint,end:bigint>>"


def _parts_of(place):
    """First start, anchor and last start of a run."""
    first, mask = place >> PLACE, (1 << _HALF) - 1
    return first, first + ((place >> _HALF) & mask), first + (place & mask)


def _refined(ids: np.ndarray) -> np.ndarray:
    """Identifiers ``STEP`` bytes longer, from those of each place and of the place ``STEP`` on."""
    return mix(ids[:-STEP] + mix(ids[STEP:])) if len(ids) > STEP else ids[:0]


def _runs(rows, wanted: np.ndarray | None):
    """Runs of strings with one anchor: row of the batch, anchor identifier and, of those whose anchor passes the filter
    ``wanted``, extent identifier and place."""
    data, offsets = texts_of(rows.column("text"))
    for i, j in groups(offsets):
        whole = data[offsets[i] : offsets[j]]
        begins = offsets[i : j + 1] - offsets[i]
        for low in range(0, max(0, len(whole) - LENGTH + 1), SPAN):
            part = whole[low : low + SPAN + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            one = Rolling(part)
            ids = one.windows(GRAM)
            anchor = first_smallest(ids, LENGTH - GRAM + 1)
            # a string must end in the text it begins in
            text = np.repeat(np.arange(j - i, dtype=np.int32), np.diff(np.clip(begins - low, 0, len(part))))
            inside = np.flatnonzero(text[: len(anchor)] == text[LENGTH - 1 :])
            if not len(inside):
                continue
            at, own = anchor[inside], text[inside]
            fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (own[1:] != own[:-1])]))
            begin, end = inside[fresh], inside[np.append(fresh[1:], len(inside)) - 1]
            at, own = at[fresh], own[fresh]
            key = ids[at]
            if wanted is None:
                yield own + i, key, None, None
                continue
            kept = np.flatnonzero(passes(wanted, key))
            if not len(kept):
                continue
            begin, end, at, own, key = begin[kept], end[kept], at[kept], own[kept], key[kept]
            extent = mix(Rolling(part, CODES_2).spans(begin, end + LENGTH) + mix((at - begin).astype(np.uint64)))
            # first start, anchor after it, and further starts, in one number
            first = begin + low - begins[own]
            yield own + i, key, extent, (first << PLACE) | ((at - begin) << _HALF) | (end - begin)


def _anchors(docs: DataFrame) -> DataFrame:
    """Anchors of a batch, and whether they occur once or more often in it."""

    def work(rows):
        found = [key for _, key, _, _ in _runs(rows, None)]
        if found:
            key, n = np.unique(np.concatenate(found), return_counts=True)
            yield batch(key=key.view(np.int64), n=np.minimum(n, 2))

    return by_batch(docs.select("text"), work, "key long, n long")


def _leading(columns, name, place):
    """Order of rows by the columns (most significant first), name and place; which begin a bucket, and which follow another
    row than its first (a row that is there twice is not its own repeat)."""
    order = np.lexsort((place, name[:, 1], name[:, 0], *columns[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], 0)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    name, place = name[order], place[order]
    return order, new, (name != name[lead]).any(1) | (place != place[lead])


def _names(rows) -> np.ndarray:
    return np.stack([rows.column(c).to_numpy() for c in ("id", "tie")], 1)


def _merged(name: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping spans of each id and tie made one: ids, ties, and a list of spans each."""
    order = np.lexsort((start, name[:, 1], name[:, 0]))
    name, start, end = name[order], start[order], end[order]
    own = np.ones(len(name), bool)  # where another document begins
    own[1:] = (name[1:] != name[:-1]).any(1)
    # ends of earlier documents must not reach into later ones: rank documents above all places
    lift = (np.cumsum(own) - 1) * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + lift)
    fresh = np.ones(len(name), bool)
    fresh[1:] = own[1:] | (start[1:] + lift[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(name)) - 1
    spans = pa.StructArray.from_arrays([pa.array(start[at]), pa.array((reach - lift)[last])], names=["first", "end"])
    bounds = np.append(np.searchsorted(at, np.flatnonzero(own)), len(at)).astype(np.int32)
    return name[own, 0], name[own, 1], pa.ListArray.from_arrays(pa.array(bounds), spans)


def _firsts_and_spans(columns: dict, name, order, new, repeat, start, end):
    """What a batch sends on: the first row of each bucket, and the spans of those that repeat it."""
    kept = order[new]
    none = pa.nulls(len(kept), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
    yield batch(**{c: v[kept].view(np.int64) for c, v in columns.items()}, id=name[kept, 0], tie=name[kept, 1], spans=none)
    some = order[repeat]
    if len(some):
        ids, ties, spans = _merged(name[some], start[some], end[some])
        empty = pa.nulls(len(ids), pa.int64())
        yield batch(**{c: empty for c in columns}, id=ids, tie=ties, spans=spans)


def _suffixes(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Runs whose anchor may occur elsewhere: the first of each bucket of a batch; of those that repeat it their spans."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def work(rows):
        found = list(_runs(rows, sent.value))
        if not found:
            return
        own, key, extent, place = (np.concatenate(c) for c in zip(*found))
        name = _names(rows)[own]
        first, _, last = _parts_of(place)
        yield from _firsts_and_spans(
            {"key": key, "extent": extent, "place": place}, name, *_leading([key, extent], name, place), first, last + LENGTH)

    return by_batch(docs, work, f"key long, extent long, place long, id long, tie long, spans {_SPANS}")


def _halves(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The bytes of the given runs, in buckets one step deeper: strings that go ``STEP`` bytes beyond
    the anchor's gram are known by its identifier refined, the others by that of the suffix ``STEP`` bytes before."""
    wanted = runs.groupBy("id", "tie").agg(F.collect_set("place").alias("places"))

    def work(rows):
        places, names = rows.column("places"), _names(rows)
        data, offsets = texts_of(rows.column("text"))
        subs, owners, starts, counts, raws = [], [], [], [], []
        for k in range(rows.num_rows):
            text = data[offsets[k] : offsets[k + 1]]
            first, anchor, last = _parts_of(np.sort(np.asarray(places[k].values)))
            for low in range(0, len(text), SPAN):
                here = np.flatnonzero((first >= low) & (first < low + SPAN))
                if not len(here):
                    continue
                part = text[low : low + SPAN + 2 * LENGTH]
                hashes, raw = Rolling(part), part.tobytes()
                f, a, b = first[here] - low, anchor[here] - low, last[here] - low
                for beyond in (True, False):
                    s = np.maximum(f, a - STEP) if beyond else f
                    e = b if beyond else np.minimum(b, a - STEP - 1)
                    some = np.flatnonzero(s <= e)
                    if not len(some):
                        continue
                    s, e, at = s[some], e[some], a[some] - (0 if beyond else STEP)
                    sub = mix(hashes.spans(at, at + GRAM) + mix(hashes.spans(at + STEP, at + STEP + GRAM)))
                    subs.append(mix(sub + np.uint64(beyond)))
                    owners.append(np.full(len(s), k))
                    starts.append(s + low)
                    counts.append(e - s + 1)
                    raws += [raw[x:y] for x, y in zip(s.tolist(), (e + LENGTH).tolist())]
        if subs:
            name = names[np.concatenate(owners)]
            yield batch(sub=np.concatenate(subs).view(np.int64), id=name[:, 0], tie=name[:, 1], first=np.concatenate(starts),
                        count=np.concatenate(counts), data=pa.array(raws, pa.binary()))

    return by_batch(docs.join(wanted, ["id", "tie"]), work, "sub long, id long, tie long, first long, count long, data binary")


def _strings(halves: DataFrame) -> DataFrame:
    """Every string of the given halves by 128 bits of identifier, refined twice: the first of each bucket of a batch; of
    those that repeat it their spans."""

    def work(rows):
        first, count = (rows.column(c).to_numpy() for c in ("first", "count"))
        raw = rows.column("data").to_pylist()
        for i in range(0, len(raw), 1 << 13):
            some, many = raw[i : i + (1 << 13)], count[i : i + (1 << 13)]
            sizes = np.array([len(x) for x in some])
            data = np.frombuffer(b"".join(some), np.uint8)
            row = np.repeat(np.arange(len(some)), many)
            step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            at = (np.cumsum(sizes) - sizes)[row] + step
            one, two = (_refined(_refined(Rolling(data, codes).windows(GRAM)))[at] for codes in (CODES, CODES_2))
            name, start = _names(rows)[i + row], first[i + row] + step
            yield from _firsts_and_spans(
                {"one": one, "two": two, "first": start}, name, *_leading([one, two], name, start), start, start + LENGTH)

    return by_batch(halves, work, f"one long, two long, first long, id long, tie long, spans {_SPANS}")


def repeats(docs: DataFrame) -> DataFrame:
    """id, tie, spans: parts of a text's bytes whose strings start earlier elsewhere; they may overlap."""
    anchors = stored(
        _anchors(docs).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"), "anchors")
    runs = stored(_suffixes(docs, make_filter(anchors, anchors.count())), "runs")
    firsts = runs.filter("spans is null").drop("spans")
    spark = docs.sparkSession
    # each level goes from disk as soon as the next one is stored
    with scratch(spark) as strings_level:
        with scratch(spark) as halves_level:
            buckets = stored(
                firsts.groupBy("key", "extent").agg(F.min(F.struct("id", "tie", "place")).alias("first")), "buckets")
            halves = stored(_halves(docs, repeated(buckets, ["key"]).select("first.*")), "halves")
            strings = halves_level.keep(_strings(repeated(halves, ["sub"])), "strings")
        drop_shuffles(spark)
        later = after_first(strings.filter("spans is null").drop("spans"), ["one", "two"], ["id", "tie", "first"])
        alone = strings_level.keep(
            later.select("id", "tie", F.array(F.struct("first", (F.col("first") + LENGTH).alias("end"))).alias("spans"))
            .unionByName(strings.filter("spans is not null").select("id", "tie", "spans")), "alone")
    drop_shuffles(spark)
    begin, more = F.shiftright("place", PLACE), F.col("place").bitwiseAND(F.lit((1 << _HALF) - 1))
    settled = after_first(firsts, ["key", "extent"], ["id", "tie", "place"]).select(
        "id", "tie", F.array(F.struct(begin.alias("first"), (begin + more + LENGTH).alias("end"))).alias("spans"))
    found = settled.unionByName(alone).unionByName(runs.filter("spans is not null").select("id", "tie", "spans"))
    return found.groupBy("id", "tie").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))


def _told_apart(whole: DataFrame, text: str, id_col: str, files) -> DataFrame:
    """``row``, and ``id`` and ``tie``, which name a document and order it among all.

    Mostly an id says all.  If there are rows without an id, or ids with several texts, rows are stored
    once with a number: those without an id are told apart by it, the others by their text.
    """
    own = F.col(f"row.`{id_col}`").cast("long")
    keyed = whole.withColumn("id", F.coalesce(own, F.lit(_NULL)))
    texts = F.xxhash64(F.col(f"row.`{text}`"))
    unclear = keyed.groupBy("id").agg(F.count("*").alias("n"), F.min(texts).alias("low"), F.max(texts).alias("high"))
    if unclear.filter((F.col("low") != F.col("high")) | ((F.col("id") == _NULL) & (F.col("n") > 1))).isEmpty():
        return keyed.withColumn("tie", F.lit(0).cast("long"))
    rows = files.keep(keyed.withColumn("tie", F.monotonically_increasing_id()), "rows")
    return rows.withColumn("tie", F.when(own.isNull(), F.col("tie") + F.lit(_NULL)).otherwise(
        texts.bitwiseAND(F.lit((1 << 63) - 1))))


def with_spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``spans`` of the text's bytes that repeat, sorted; none, an empty list, if
    nothing does."""
    spark = docs.sparkSession
    with scratch(spark) as files:
        keyed = _told_apart(in_row(docs), text, id_col, files)
        found = files.keep(repeats(keyed.select("id", "tie", F.col(f"row.`{text}`").alias("text"))), "repeats")
    drop_shuffles(spark)
    return keyed.join(found, ["id", "tie"], "left").select("row", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def _texts_and_spans(rows):
    """For each text of a batch its bytes and the spans to remove, apart and in order."""
    data, offsets = texts_of(rows.column("text"))
    lists = rows.column("spans")
    reach = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    flat = lists.flatten()
    first, end = flat.field("first").to_numpy(), flat.field("end").to_numpy()
    for k in range(rows.num_rows):
        a, b = reach[k], reach[k + 1]
        text = data[offsets[k] : offsets[k + 1]]
        if a == b:
            yield text, np.zeros((0, 2), np.int64)
            continue
        far = np.maximum.accumulate(end[a:b])
        fresh = np.concatenate([[True], first[a + 1 : b] > far[:-1]])
        yield text, np.stack([first[a:b][fresh], far[np.append(np.flatnonzero(fresh)[1:] - 1, b - a - 1)]], 1)


def _kept(text: np.ndarray, spans: np.ndarray) -> bytes:
    raw, out, at = text.tobytes(), [], 0
    for a, b in spans.tolist():
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def work(rows):
        sizes, removed, n_spans, digests = [], [], [], []
        for text, spans in _texts_and_spans(rows):
            sizes.append(len(text))
            removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
            n_spans.append(len(spans))
            digests.append(hashlib.sha256(_kept(text, spans)).hexdigest())
        yield batch(doc_id=rows.column("doc_id"), n_bytes=pa.array(sizes, pa.int64()), n_removed=pa.array(removed, pa.int64()),
                    n_spans=pa.array(n_spans, pa.int64()), kept_sha256=pa.array(digests, pa.string()))

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return by_batch(with_spans(docs).select("row.doc_id", "row.text", "spans"), work,
                    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what repeats; a character goes only if all its bytes do.  n_chars follows the text.

    A document of which nothing is left goes, unless it was empty before.  All other columns stay as they are.
    """

    def work(rows):
        texts, keep = [], []
        none = rows.column("text").is_null().to_pylist()
        for (data, spans), null in zip(_texts_and_spans(rows), none):
            if null or not len(spans):
                texts.append(None if null else data.tobytes().decode("utf-8", "surrogatepass"))
                keep.append(True)
                continue
            gone = np.zeros(len(data), bool)
            for a, b in spans.tolist():
                gone[a:b] = True
            head = np.flatnonzero((data & 0xC0) != 0x80)
            whole = np.bitwise_and.reduceat(gone, head)
            left = data[~np.repeat(whole, np.diff(np.append(head, len(data))))].tobytes()
            texts.append(left.decode("utf-8", "surrogatepass"))
            keep.append(bool(left))
        own = rows.column("row")
        columns = {f.name: own.field(k) for k, f in enumerate(own.type)}
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            columns["n_chars"] = pa.array(
                [None if old is None else len(t) if t is not None else old
                 for t, old in zip(texts, columns["n_chars"].to_pylist())], columns["n_chars"].type)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(pa.array(keep))

    return by_batch(with_spans(docs).select("row", "row.text", "spans"), work, docs.schema)
