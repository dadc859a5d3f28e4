"""Document fingerprints: digests of improbable byte windows in chained Bloom filters.

The entropy of every window of ``WINDOW`` bytes is taken to one of ``LEVELS`` levels; how often each
level occurs over all documents makes rare levels rank first.  A window that ranks first in at least
``POPULAR`` of the ``SPAN`` spans around it is a feature.  Features go, in order of place, into Bloom
filters of ``BITS`` bits, ``FULL`` features each.  Two digests are as alike as the mean, over the shorter
one's filters, of the best overlap with one of the other's, less what chance gives.

Null texts count as empty: no filters; two empty digests are alike (1), an empty and another are not (0).
A text shorter than a window is a feature as a whole.  Rows are ordered by doc_id (null first), then text;
repeated rows follow each other; the only row of a table is its own next one; empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrays import Rolling, groups, mix, smallest, texts_of
from .shared import batch, table, text_or_empty, tidy

WINDOW = 16
LEVELS = 256
SPAN = 32
POPULAR = 12
BITS = 2048
HASHES = 5
FULL = 128
LEAST = 0.2  # of the highest entropy: windows below are no features
RANGE_ROWS = 2000
MOST_RANGES = 4096

# in whole units of 2**-32, so that sums are exact in any order
_TERMS = np.arange(WINDOW + 1) * np.log2(np.maximum(np.arange(WINDOW + 1), 1)) * 2.0**32
_GAIN = np.diff(np.round(_TERMS))  # what an m-th equal byte adds
_STEP = np.diff(_GAIN)
_SCALE = LEVELS / (WINDOW * np.log2(WINDOW) * 2.0**32)
_UNFIT = np.uint64(LEVELS << 48)  # least number of a window that is no feature


def levels(data: np.ndarray) -> np.ndarray:
    """The entropy level of the window at each offset.

    A byte whose k-th equal predecessor lies in the window with it adds a known amount to the windows
    that hold both: a difference array takes all of them.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    order = np.argsort(data, kind="stable")
    # places by byte value: near in this order means equal and near in the text
    place = order + data[order].astype(np.int64) * (len(data) + WINDOW)
    late = np.flatnonzero(place[1:] - place[:-1] < WINDOW) + 1
    begins, ends, weights = [], [], []
    for k in range(1, WINDOW):
        begins.append(order[late])
        ends.append(order[late - k])
        weights.append(np.full(len(late), _STEP[k - 1]))
        late = late[late > k]
        late = late[place[late] - place[late - k - 1] < WINDOW]
        if not len(late):
            break
    weight = np.concatenate(weights)
    change = np.bincount(np.maximum(np.concatenate(begins) - (WINDOW - 1), 0), weight, len(data) + 1)
    change -= np.bincount(np.concatenate(ends) + 1, weight, len(data) + 1)
    found = (np.cumsum(change[:n]) * -_SCALE + (LEVELS + 1e-6)).astype(np.int64)
    return np.minimum(found, LEVELS - 1)


def level_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all documents have each level: ``LEVELS`` numbers come to the driver."""

    def work(batches):
        total = np.zeros(LEVELS, np.int64)
        for rows in batches:
            data, offsets = texts_of(rows.column("text"))
            for i, j in groups(offsets):
                own = levels(data[offsets[i] : offsets[j]])
                inside = np.ones(len(own), bool)
                for e in (offsets[i + 1 : j] - offsets[i]).tolist():
                    inside[max(0, e - WINDOW + 1) : e] = False  # windows across two texts
                total += np.bincount(own[inside], minlength=LEVELS)
        yield batch(level=np.arange(LEVELS), n=total)

    found = docs.select("text").mapInArrow(tidy(work), "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS, np.int64)
    for r in found.collect():
        counts[r["level"]] = r["n"]
    return counts


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest first; levels of too little entropy come last."""
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), counts))] = np.arange(LEVELS)
    rank[: int(LEVELS * LEAST)] = LEVELS
    return rank


def ordered(data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """One number for the window at each offset: the rarest level first, then by hash."""
    own = levels(data)
    if not len(own):
        return np.zeros(0, np.uint64)
    return (rank[own].astype(np.uint64) << np.uint64(48)) | (Rolling(data).windows(WINDOW) >> np.uint64(16))


def features(order: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the popular windows, and the text of each.

    A window with ``a`` greater ones right before it and ``b`` ones not smaller right after it (up to
    ``SPAN - 1`` each, within its text) ranks first in ``a + b + 2 - SPAN`` spans.  To be popular it must
    win against ``near`` neighbours on both sides, which few windows do.
    """
    near = POPULAR - 1
    n = len(order)
    if n < 2 * near + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = smallest(order, near), smallest(order, near + 1)
    mid = order[near : n - near]
    wins = (mid == after[near : n - near]) & (mid < before[: n - 2 * near]) & (mid < _UNFIT)
    at = np.flatnonzero(wins) + near
    text = np.searchsorted(offsets, at, "right") - 1
    value, spans = order[at], np.full(len(at), 2 - SPAN)
    for step, room in ((-1, at - offsets[text]), (1, offsets[text + 1] - WINDOW - at)):
        alive = room >= near
        spans[alive] += near
        for k in range(near + 1, SPAN):
            alive &= room >= k
            other = order[np.clip(at + step * k, 0, n - 1)]
            alive &= other > value if step < 0 else other >= value
            spans += alive
    popular = spans >= POPULAR
    return at[popular], text[popular]


def digests_of(data: np.ndarray, offsets: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
    """The filters of texts that stand one after another, given ``ordered`` of them.

    Windows across two texts are never looked at.
    """
    sizes = np.diff(offsets)
    at, at_text = features(order, offsets)
    picked, picked_text = [order[at]], [at_text]
    chosen = np.bincount(at_text, minlength=len(sizes))
    for k in np.flatnonzero((chosen == 0) & (sizes >= WINDOW)).tolist():
        picked.append(order[offsets[k] : offsets[k + 1] - WINDOW + 1].min(keepdims=True))
        picked_text.append(np.array([k]))
    for k in np.flatnonzero((sizes > 0) & (sizes < WINDOW)).tolist():
        whole = Rolling(data[offsets[k] : offsets[k + 1]])
        picked.append(whole.spans(np.zeros(1, np.int64), sizes[k : k + 1]))
        picked_text.append(np.array([k]))
    feature, owner = np.concatenate(picked), np.concatenate(picked_text)
    back = np.argsort(owner, kind="stable")
    feature, owner = feature[back], owner[back]
    counts = np.bincount(owner, minlength=len(sizes))
    first = np.cumsum(counts) - counts
    filters = -(-counts // FULL)
    first_filter = np.cumsum(filters) - filters
    row = first_filter[owner] + (np.arange(len(owner)) - first[owner]) // FULL
    bits = np.zeros((int(filters.sum()), BITS), bool)
    spread = mix(feature)
    for k in range(HASHES):
        bits[row, ((spread >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[a : a + n] for a, n in zip(first_filter.tolist(), filters.tolist())]


def digests(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The filters of each text, one row of ``BITS // 8`` bytes each."""
    data, offsets = joined(texts)
    return digests_of(data, offsets, ordered(data, rank))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def spliced(data: np.ndarray, seams: np.ndarray, parts: list[np.ndarray], rank: np.ndarray) -> np.ndarray:
    """``ordered`` of texts put together from pieces whose windows are known.

    ``parts`` holds a number for every byte of the pieces in turn; only windows across a seam inside
    a text are measured anew.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    order = np.concatenate(parts)[:n]
    around = seams[:, None] + np.arange(1 - WINDOW, WINDOW - 1)
    anew = ordered(data[np.clip(around, 0, len(data) - 1)].ravel(), rank)
    anew = np.append(anew, np.zeros(WINDOW - 1, np.uint64)).reshape(around.shape)[:, : WINDOW - 1]
    to = around[:, : WINDOW - 1]
    inside = (to >= 0) & (to < n)
    order[to[inside]] = anew[inside]
    return order


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """0 to 1: how much of the shorter digest the other one covers."""
    if not len(one) or not len(two):
        return 1.0 if len(one) == len(two) else 0.0
    if len(one) > len(two) or (len(one) == len(two) and one.tobytes() > two.tobytes()):
        one, two = two, one
    a, b = one.view(np.uint64), np.ascontiguousarray(two).view(np.uint64)
    ones_a, ones_b = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for k in range(len(a)):
        common = np.bitwise_count(a[k] & b).sum(1, dtype=np.int64)
        least = np.minimum(ones_a[k], ones_b)
        chance = ones_a[k] * ones_b / BITS
        total += float(np.clip((common - chance) / np.maximum(least - chance, 1e-9), 0, 1).max()) * float(ones_a[k])
    return min(1.0, total / float(ones_a.sum()))


def text_form(digest: np.ndarray) -> str:
    return digest.tobytes().hex()


def in_ranges(docs: DataFrame) -> DataFrame:
    """id, text, _range, _copy: rows by ranges of doc_id; each range also has the row that follows it.

    Bounds are quantiles of doc_id, at most ``MOST_RANGES`` of them, and come to the driver with the
    first id of each range; texts are shuffled once.
    """
    keyed = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    total = keyed.select("doc_id").count()
    n = max(1, min(MOST_RANGES, total // RANGE_ROWS))
    steps = [k / n for k in range(1, n)]
    bounds = keyed.agg(F.percentile_approx("doc_id", steps, 100_000)).first()[0] if steps else []
    bounds = sorted(set(bounds or []))
    # two short look-ups in place of one long one
    wide = max(1, round(len(bounds) ** 0.5))
    outer = bounds[::wide]
    inner = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    passed = lambda values, x: F.size(F.filter(values, lambda b: b <= x))
    if bounds:
        block = passed(F.lit(outer), F.col("doc_id"))
        inside = passed(F.element_at(F.array(*[F.lit(x) for x in inner]), F.greatest(F.col("_block"), F.lit(1))), F.col("doc_id"))
        ranged = keyed.withColumn("_block", F.when(F.col("doc_id").isNull(), 0).otherwise(block)).withColumn(
            "_range", F.when(F.col("_block") == 0, 0).otherwise((F.col("_block") - 1) * wide + inside))
    else:
        ranged = keyed.withColumn("_range", F.lit(0))
    least = F.min(F.coalesce("doc_id", F.lit(-(1 << 63))))
    heads = sorted((r[0], r[1]) for r in ranged.groupBy("_range").agg(least).collect())
    size = len(bounds) + 1
    first, previous = [None] * size, [None] * size
    for k, (which, head) in enumerate(heads):
        first[which], previous[which] = head, heads[k - 1][0]  # the first range follows the last
    at = F.col("_range") + 1
    is_head = F.coalesce("doc_id", F.lit(-(1 << 63))) == F.element_at(F.array(*[F.lit(x).cast("long") for x in first]), at)
    there = F.element_at(F.array(*[F.lit(x).cast("int") for x in previous]), at)
    to = F.when(is_head, F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy")),
                                 F.struct(there.alias("r"), F.lit(1).alias("copy")))).otherwise(
        F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy"))))
    return ranged.select("doc_id", "text", F.explode(to).alias("_to")).select(
        "doc_id", "text", F.col("_to.r").alias("_range"), F.col("_to.copy").alias("_copy"))


def with_next(docs: DataFrame, rank: np.ndarray) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = spark.sparkContext.broadcast(rank)

    def work(batches):
        rank = sent.value
        last = None  # the document before: range, then what results() needs of it

        def results(pairs):
            """pairs: two documents, each as (id, text, digest, bytes, numbers of its windows)"""
            raw, parts, seams, size = [], [], [], 0
            for (_, text, _, own, order), (_, following, _, others, next_order) in pairs:
                half = len(text) // 2
                kept = len(text[: len(text) - half].encode())
                added = len(following[:half].encode())
                raw.append(own[:kept] + others[:added])
                parts += [order[:kept], next_order[:added]]
                seams.append(size + kept)
                size += kept + added
            data, offsets = joined(raw)
            found = digests_of(data, offsets, spliced(data, np.array(seams), parts, rank))
            return batch(
                doc_id=pa.array([a[0] for a, _ in pairs], pa.int64()),
                n_chars=pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                edited_sha256=pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                fingerprint=pa.array([text_form(a[2]) for a, _ in pairs], pa.string()),
                edited_fingerprint=pa.array([text_form(d) for d in found], pa.string()),
                near_edited=pa.array([likeness(a[2], d) for (a, _), d in zip(pairs, found)], pa.float64()),
                near_next=pa.array([likeness(a[2], b[2]) for a, b in pairs], pa.float64()),
            )

        for rows in batches:
            data, offsets = texts_of(rows.column("text"))
            names, where, copies = (rows.column(c).to_pylist() for c in ("doc_id", "_range", "_copy"))
            for i, j in groups(offsets):
                texts = [data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace") for k in range(i, j)]
                raw = [t.encode() for t in texts]
                own, starts = joined(raw)
                order = ordered(own, rank)
                found = digests_of(own, starts, order)
                order = np.append(order, np.zeros(min(len(own), WINDOW - 1), np.uint64))
                pairs = []
                for k, a, b in zip(range(i, j), starts[:-1].tolist(), starts[1:].tolist()):
                    document = (names[k], texts[k - i], found[k - i], raw[k - i], order[a:b])
                    if last is not None and last[0] == where[k]:
                        pairs.append((last[1], document))
                    # of copies, which come last in their range, only the first follows a row
                    last = None if copies[k] else (where[k], document)
                if pairs:
                    yield results(pairs)
                if last is not None:  # without the arrays of its whole group
                    last = (last[0], (*last[1][:4], last[1][4].copy()))

    return in_ranges(docs).repartition(n, "_range").sortWithinPartitions("_range", "_copy", "doc_id", "text").mapInArrow(
        tidy(work), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_next(docs, ranks(level_counts(docs)))
