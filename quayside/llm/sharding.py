"""Shards by balanced label propagation, in DataFrame operations alone.

Documents with equal texts are linked.  They start in shards by the hash of their id; each round, the
part of a group that lies in one shard looks at the group's larger parts elsewhere and moves towards the
largest whose shard has room.  Moves into a shard are taken in order of a hash until its quota is full,
the last ones in part.  Quotas come from a table of (shard, hash slot) sums, so no group and no list of
moves is ever gathered.  Documents without links fill what room is left.

The law is ``rows``: counts differ by one at most.  At the end all documents are numbered by shard, with
unlinked ones at both ends of each shard, and cut at equal counts: rounding moves unlinked documents, and
splits at most one group per cut where there are none.

Null texts count as empty, and empty texts as equal; null ids are dealt like others; repeated rows are rows; an
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.numbering import global_row_id
from ..settings import materialize, scratch
from .shared import table, text_or_empty

SHARDS = 8
ROUNDS = 6
SLOTS = 1024  # hash slots in which moves into a shard are taken


def _cells(spread: DataFrame) -> DataFrame:
    return spread.groupBy("group", "shard").agg(F.sum("n").alias("n"))


def propagate(cells: DataFrame, quota: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """group, shard, n: how many documents of each group are in a shard after all rounds."""
    with scratch(cells.sparkSession) as files:
        return files.keep(_propagate(cells, quota, shards, rounds), "cells")


def _propagate(cells: DataFrame, quota: int, shards: int, rounds: int) -> DataFrame:
    spark = cells.sparkSession
    cells = materialize(cells, "cells")
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    for _ in range(rounds):
        # one row per shard
        room = every.join(cells.groupBy("shard").agg(F.sum("n").alias("load")), "shard", "left").select(
            F.col("shard").alias("to"), F.greatest(F.lit(quota) - F.coalesce("load", F.lit(0)), F.lit(0)).alias("room"))
        other = cells.select("group", F.col("shard").alias("to"), F.col("n").alias("n_to")).join(
            F.broadcast(room.filter("room > 0").select("to")), "to")
        rank = lambda n, shard: F.struct(F.col(n), F.xxhash64("group", F.col(shard)))
        wish = (
            cells.join(other, "group").filter(rank("n_to", "to") > rank("n", "shard"))
            .groupBy("group", "shard", "n").agg(F.max_by("to", rank("n_to", "to")).alias("to"))
        )
        wish = materialize(wish.withColumn("slot", F.pmod(F.xxhash64("group"), F.lit(SLOTS)).cast("int")), "moves")
        if wish.isEmpty():
            break
        before = Window.partitionBy("to").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        # at most shards * SLOTS rows
        taken = (
            wish.groupBy("to", "slot").agg(F.sum("n").alias("asked"))
            .withColumn("before", F.coalesce(F.sum("asked").over(before), F.lit(0)))
            .join(F.broadcast(room), "to")
            .select("to", "slot", F.least(F.greatest((F.col("room") - F.col("before")) / F.col("asked"), F.lit(0.0)),
                                          F.lit(1.0)).alias("part"))
        )
        moved = wish.join(F.broadcast(taken), ["to", "slot"]).withColumn("m", F.floor(F.col("n") * F.col("part")))
        cells = materialize(
            _cells(
                cells
                .unionByName(moved.select("group", "shard", (-F.col("m")).alias("n")))
                .unionByName(moved.select("group", F.col("to").alias("shard"), F.col("m").alias("n")))
            ).filter("n > 0"), "cells")
    return cells


def _by_share(shares: DataFrame, key: list[str]) -> DataFrame:
    """Lists of (end, shard) that cut [0, 1) in proportion to ``n``."""
    order = Window.partitionBy(*key).orderBy("shard")
    whole = Window.partitionBy(*key)
    return (
        shares.withColumn("end", F.sum("n").over(order) / F.sum("n").over(whole))
        .groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("cuts"))
    )


def shards_of(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, group, shard, slot."""
    text = text_or_empty()
    rows = materialize(
        docs.select(
            "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("group"),
            F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")),
        "rows")
    cells = materialize(rows.groupBy("group", "shard").agg(F.count("*").alias("n")), "cells")
    linked = cells.groupBy("group").agg(F.sum("n").alias("_n")).filter("_n > 1").select("group")
    total = rows.count()
    placed = propagate(cells.join(linked, "group"), -(-total // shards), shards)
    # what room is left for documents without links: one number per shard
    loads = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = [max(0, -(-total // shards) - loads.get(s, 0)) for s in range(shards)]
    ends = [sum(room[: s + 1]) / max(1, sum(room)) for s in range(shards)]
    point = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    free = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        free = F.when(point < ends[s], s).otherwise(free)
    cuts = _by_share(placed, ["group"])
    chosen = F.try_element_at(F.filter("cuts", lambda c: point < c["end"]), F.lit(1))["shard"]
    dealt = rows.drop("shard").join(cuts, "group", "left").select(
        "doc_id", "size", "text_crc32", "group",
        F.when(F.col("cuts").isNull(), free).otherwise(F.coalesce(chosen, F.element_at("cuts", -1)["shard"])).cast("int").alias("_shard"),
        # unlinked documents before and after the groups
        F.when(F.col("cuts").isNotNull(), 1).when(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)) == 0, 0).otherwise(2).alias("_zone"),
    )
    numbered = global_row_id(dealt, ["_shard", "_zone", "group", "doc_id"], "_number", tie_break=["size", "text_crc32"])
    low, more = divmod(total, shards)
    n = F.col("_number") - 1
    edge = more * (low + 1)
    shard = F.when(n < edge, F.floor(n / F.lit(low + 1))).otherwise(more + F.floor((n - edge) / F.lit(max(1, low))))
    return numbered.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "group", "shard",
        (n - F.col("shard") * low - F.least(F.col("shard"), F.lit(more))).cast("long").alias("slot"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_of(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.lower(F.hex("group")).alias("text_md5"))
