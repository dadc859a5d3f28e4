"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate edges.

Each text's set of word shingles is hashed once; the hash's top bits name a bin, each bin keeps its
smallest hash, and an empty bin borrows from the first full bin of a fixed random order of its own
(optimal densification).  Bands of bins form bucket keys.  Equal sets meet first, as one node.  In a
bucket, all nodes are linked with one centre, so candidates grow with the bucket and not its square;
each candidate is confirmed on the full sets; a node meets one centre at a time.  Buckets that still
hold several components go on, so that no link between different texts is lost: stars around the node
closest to the bucket's consensus sketch until none joins anything more, and then all pairs across
components, compared block by block: those whose sketches look alike first, then all that are left.  Of
the last only pairs that cannot be alike are passed over: a set's parity has one bit for each of
``PARITY`` groups of hashes, odd or even, and two sets differ in at least as many hashes as bits.

A set without shingles is linked with nothing.  Ids mostly name documents; where some are missing or shared, rows
are numbered in id order (those without an id last) and every row is a document of its own: its component is named by
the id of the component's first row, and that row alone is kept.  Empty tables work; only doc_id and text are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import materialize, scratch
from .arrays import BLANKS, groups, mix, shingles, texts_of, words_of
from .graph import components
from .shared import batch, by_batch, numbered, stored, table, tidy

WIDTH = 5
PERCENT = 75
BINS = 256
ROWS = 5  # bins in a band: at a similarity of 0.75 some band agrees but for one pair in a million
PARITY = 2048
ESTIMATE = 0.66  # how much a star's candidates look alike
LIKELY = 0.73  # pairs that look this much alike are confirmed before the others
#: steps after the first star: is it a star, and how alike sketches must look (None: all that can be alike);
#: a star is repeated until it joins nothing more
STEPS = ((True, ESTIMATE), (False, LIKELY), (False, None))
BLOCK = 2048  # nodes of a bucket that are compared with each other in one task
MEMBERS = 512  # candidates of a centre that are confirmed in one task

_order = np.random.Generator(np.random.PCG64(77))
DENSE = np.stack([_order.permutation(BINS) for _ in range(BINS)])
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 8)
_U = np.uint64


def shingle_sets(rows):
    """Row number and sorted distinct shingle hashes of each text of a batch."""
    data, offsets = texts_of(rows.column("text"))
    for i, j in groups(offsets):
        words, first = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], BLANKS)
        whole = shingles(words, WIDTH)
        for k in range(j - i):
            a, b = int(first[k]), int(first[k + 1])
            if b - a >= WIDTH:
                found = np.sort(whole[a : b - WIDTH + 1])
                yield i + k, found[np.concatenate([[True], found[1:] != found[:-1]])]
            else:
                yield i + k, shingles(words[a:b], b - a) if b > a else words[:0]


def sketch(found: np.ndarray) -> np.ndarray:
    """The densified bins of a sorted set."""
    at = np.searchsorted(found, _EDGES)
    value = found[np.minimum(at, len(found) - 1)]
    full = (at < len(found)) & (value >> _U(56) == np.arange(BINS, dtype=np.uint64))
    empty = np.flatnonzero(~full)
    if len(empty):
        source = DENSE[empty, full[DENSE[empty]].argmax(1)]
        value[empty] = value[source]
    return mix(value)


_BAND = mix(np.arange(1, BINS // ROWS + 1, dtype=np.uint64))
_PLACE = mix(np.arange(1001, 1001 + ROWS, dtype=np.uint64)) | _U(1)


def parity(found: np.ndarray) -> np.ndarray:
    """Whether each group of hashes has an odd number of a set's, 8 groups a byte."""
    count = np.bincount((found & _U(PARITY - 1)).astype(np.int64), minlength=PARITY)
    return np.packbits((count & 1).astype(np.uint8))


def band_keys(values: np.ndarray) -> np.ndarray:
    """Bucket keys of a sketch, one of each band."""
    banded = values[: len(_BAND) * ROWS].reshape(-1, ROWS)
    return mix((banded * _PLACE).sum(1, dtype=np.uint64) + _BAND).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two sums that identify the set, bucket keys, one byte of each bin, and parity."""

    def work(rows):
        n = rows.num_rows
        size, one, two = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        keys, bins, odd = [None] * n, [None] * n, [None] * n
        for k, found in shingle_sets(rows):
            if len(found):
                size[k], one[k], two[k] = len(found), mix(found).sum(), mix(found ^ _U(0x5BD1E995)).sum()
                values = sketch(found)
                keys[k] = band_keys(values)
                bins[k] = (values & _U(255)).astype(np.uint8).tobytes()
                odd[k] = parity(found).tobytes()
        yield batch(
            doc_id=rows.column("doc_id"), n_shingles=size, one=one.view(np.int64), two=two.view(np.int64),
            keys=pa.array(keys, pa.list_(pa.int64())), bins=pa.array(bins, pa.binary()), parity=pa.array(odd, pa.binary()))

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), work,
                    "doc_id long, n_shingles long, one long, two long, keys array<long>, bins binary, parity binary")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its shingle hashes in order, 8 bytes each, and their first 4 bytes, for some doc_ids."""

    def work(rows):
        found, heads = [None] * rows.num_rows, [None] * rows.num_rows
        for k, hashes in shingle_sets(rows):
            found[k] = hashes.tobytes()
            heads[k] = (hashes >> _U(32)).astype(np.uint32).tobytes()
        yield batch(node=rows.column("doc_id"), heads=pa.array(heads, pa.binary()), hashes=pa.array(found, pa.binary()))

    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(
        nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    return by_batch(chosen, work, "node long, heads binary, hashes binary")


def _alike(pairs: DataFrame, sets: DataFrame, column: str, kind: type) -> DataFrame:
    """Of pairs (a, b), those whose hashes in a column are alike enough.

    The candidates of a node a come to tasks of about ``MEMBERS`` each, with one copy of its hashes.
    """
    sets = sets.select("node", F.col(column).alias("hashes"))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("_parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("long"))
    members = dealt.join(sets, dealt["b"] == sets["node"]).select("a", "part", F.lit(1).alias("kind"), "b", "hashes")
    centres = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("part")).join(
        sets, F.col("a") == sets["node"]).select("a", "part", F.lit(0).alias("kind"), F.col("node").alias("b"), "hashes")

    def work(batches):
        centre, own = None, None
        for rows in batches:
            a, b = [], []
            for at, part, is_member, other, data in zip(
                *(rows.column(c).to_pylist() for c in ("a", "part", "kind", "b", "hashes"))
            ):
                found = np.frombuffer(data, kind)
                if not is_member:
                    centre, own = (at, part), found
                elif centre == (at, part) and len(own) and len(found):
                    near = np.minimum(np.searchsorted(own, found), len(own) - 1)
                    both = int((own[near] == found).sum())
                    if 100 * both >= PERCENT * (len(own) + len(found) - both):
                        a.append(at)
                        b.append(other)
            if a:
                yield batch(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))

    return members.unionByName(centres).repartition("a", "part").sortWithinPartitions("a", "part", "kind").mapInArrow(
        tidy(work), "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose full sets are alike enough.

    Hashes with equal heads are no fewer than equal hashes, so the heads alone rule out most pairs that
    are not alike, at half the bytes; what they leave is decided by the whole hashes.
    """
    near = stored(_alike(stored(pairs, "pairs"), sets, "heads", np.uint32), "pairs")
    return stored(_alike(near, sets, "hashes", np.uint64), "links")


_COLUMNS = ("node", "component", "n", "sketch", "band", "side", "chosen")


def _pairs_in(found: list, star: bool, least: float | None):
    """Candidates among the rows of one cell: arrays a, b and how alike their sketches look.

    Only nodes of different components and fitting sizes whose sketches agree enough; without ``least``
    the sketch is the parity, and only pairs that differ in too many hashes for their sizes are left out.  In a star the
    centre, closest to what most sketches say in each bin, meets the nodes that chose this bucket;
    otherwise each pair meets once in a cell, and only in the first band whose bucket both are in.
    """
    node, part, n, band, side, chosen = (np.array([r[c] for r in found]) for c in (0, 1, 2, 4, 5, 6))
    sketches = np.frombuffer(b"".join(r[3] for r in found), np.uint8).reshape(len(found), -1)
    words = sketches.view(np.uint64) if least is None else None
    keys = None if star else np.stack([r[7] for r in found])

    def alike(k, there):
        fit = there[(part[there] != part[k]) & (100 * np.minimum(n[there], n[k]) >= PERCENT * np.maximum(n[there], n[k]))]
        if least is None:
            apart, both = np.bitwise_count(words[fit] ^ words[k]).sum(1, dtype=np.int64), n[fit] + n[k]
            like, good = 1 - apart / both, (100 + PERCENT) * apart <= (100 - PERCENT) * both
        else:
            like = ((sketches[fit] == sketches[k]).mean(1) - 1 / 256) / (1 - 1 / 256)
            good = like >= least
        if not star:
            some = np.flatnonzero(good)
            good[some] = (keys[fit[some]] == keys[k]).argmax(1) == band[k]
        return np.full(int(good.sum()), node[k]), node[fit[good]], like[good]

    if star:
        flat = sketches.astype(np.int64) + 256 * np.arange(BINS)
        mode = np.bincount(flat.ravel(), minlength=256 * BINS).reshape(BINS, 256).argmax(1).astype(np.uint8)
        yield alike(int((sketches == mode).sum(1).argmax()), np.flatnonzero(chosen))
        return
    one_block = side.min() == side.max()
    for k in range(len(found) - 1):
        # within a block each pair once; between two blocks only across
        yield alike(k, np.arange(k + 1, len(found)) if one_block else np.flatnonzero(side > side[k]))


def _bucket_pairs(rows: DataFrame, star: bool, least: float | None) -> DataFrame:
    """Candidate pairs (a, b) in the cells of buckets."""

    def work(batches):
        held, at, out = [], None, []

        def flush():
            if len(held) > 1:
                out.extend(p for p in _pairs_in(held, star, least) if len(p[0]))

        def found():
            a, b, like = (np.concatenate([p[c] for p in out]) for c in range(3))
            out.clear()
            return batch(a=a, b=b, like=like)

        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("key", "cell", *_COLUMNS)]
            if not star:
                columns.append(list(rows.column("keys").flatten().to_numpy().reshape(-1, len(_BAND))))
            for key, cell, *row in zip(*columns):
                if (key, cell) != at:
                    flush()
                    held, at = [], (key, cell)
                held.append(row)
            if out:
                yield found()
        flush()
        if out:
            yield found()

    pairs = rows.repartition("key", "cell").sortWithinPartitions("key", "cell", "node").mapInArrow(
        tidy(work), "a long, b long, like double")
    return pairs.select("a", "b") if star else pairs.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _in_cells(rows: DataFrame, star: bool) -> DataFrame:
    """Rows of a bucket in cells of about one block each for stars, else of at most two blocks, so that
    every pair of the bucket meets in a cell."""
    rows = rows.withColumn("_blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn(
        "side", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    if star:
        rows = rows.withColumn("cell", F.col("side").cast("long"))
    else:
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumn(
            "cell", F.least("side", "_other").cast("long") * F.lit(1 << 31) + F.greatest("side", "_other"))
    return rows.select("key", "cell", *_COLUMNS, *(() if star else ("keys",)))


def _mixed(met: DataFrame, found: DataFrame, leaders: DataFrame, star: bool, sketch: str) -> DataFrame:
    """Rows of the buckets that still hold several components, with one of the sketches; for stars, of those that some node chose:
    the largest of its buckets."""
    named = met.select("key", "band", "node").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = named.groupBy("key").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("size")
    ).filter("_low <> _high").select("key", "size")
    rows = named.join(mixed, "key").withColumn("chosen", F.lit(True))
    if star:
        choice = rows.groupBy("node").agg(F.max(F.struct("size", "key"))["key"].alias("_choice"))
        rows = rows.join(choice, "node").withColumn("chosen", F.col("key") == F.col("_choice")).drop("_choice")
        rows = rows.join(choice.select(F.col("_choice").alias("key")).distinct(), "key", "left_semi")
    return _in_cells(
        rows.join(leaders.select("node", F.col("n_shingles").alias("n"), F.col(sketch).alias("sketch"), "keys"), "node"), star)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    with scratch(docs.sparkSession) as files:
        rows, shared = numbered(docs.select("doc_id", "text"), files)
        found = _near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"))
        if shared:
            ids = rows.select("key", F.col("row.doc_id").alias("id"))
            named = found.withColumnsRenamed({"doc_id": "key", "component_id": "first"}).join(ids, "key")
            found = named.join(ids.select(F.col("key").alias("first"), F.col("id").alias("component_id")), "first").select(
                F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
        return files.keep(found, "near-duplicates")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    signed = materialize(signatures(docs), "signatures")
    same = ["n_shingles", "one", "two"]
    # equal sets: one node, named by the smallest id (copies fold before the shuffle)
    leaders = materialize(
        signed.filter("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(
            F.min("doc_id").alias("node"), F.min_by(F.struct("keys", "bins", "parity"), "doc_id").alias("s"))
        .select(*same, "node", "s.keys", "s.bins", "s.parity"), "leaders")
    buckets = leaders.select(F.posexplode("keys").alias("band", "key"), "node")
    centre = F.min(F.struct(F.xxhash64("node").alias("rank"), "node"))
    shared = buckets.groupBy("key").agg(centre.alias("_centre"), F.count("*").alias("_n")).filter("_n > 1")
    met = stored(buckets.join(shared.select("key", "_centre"), "key"), "buckets")
    sets = stored(full_sets(docs, met.select("node").distinct()), "sets")
    # of the centres of its buckets a node meets the one that ranks first
    star = met.groupBy(F.col("node").alias("b")).agg(F.min("_centre").alias("_c")).select(
        F.col("_c.node").alias("a"), "b").filter("a <> b")
    links = confirm(star, sets)
    found = components(links)
    steps = list(STEPS)
    while steps:
        star, least = steps[0]
        rows = _mixed(met, found, leaders, star, "parity" if least is None else "bins")
        more = confirm(_bucket_pairs(rows, star, least), sets)
        joined = not more.isEmpty()
        if joined:
            links = links.unionByName(more)
            found = components(links)
        if not (star and joined):
            steps.pop(0)
    known = leaders.select(*same, "node").join(found, "node", "left").select(
        *same, F.coalesce("component", "node").alias("component_id"))
    return (
        signed.select("doc_id", *same).join(known, same, "left")
        .withColumn("component_id", F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, one with an id before those without.

    Rows go one by one, so a text stays whatever ids other texts share; all columns stay as they are.
    """
    with scratch(spark) as files:
        rows, _ = numbered(docs, files)
        found = near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"))
        gone = files.keep(found.filter("not kept").select(F.col("doc_id").alias("gone")), "gone")
    return rows.join(gone, rows["key"] == gone["gone"], "left_anti").select("row.*")
