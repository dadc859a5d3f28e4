"""Reading a day-sliced table as of an earlier commit.

A table's ``history`` keeps the rows of every commit, tagged ``content_id``.  ``commits`` says
what each commit did to which slice (one row per commit and slice):

    snapshot_id, parent_id, committed_at, operation (append | overwrite), slice, content_id

and ``refs`` names commits: name, kind (branch | tag), snapshot_id, retain_days.  A commit that
re-publishes rows written earlier has the ``content_id`` of that earlier commit.  Rolling back
makes the commits a tree, so what a commit shows is settled by following parents.
"""

from __future__ import annotations

from datetime import datetime
from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F

from ..settings import cut_lineage, materialize

MAIN = "main"


def commits_of(spark, head: int) -> DataFrame:
    return spark.range(1).select(F.lit(head).cast("bigint").alias("head"))


def resolve_ref(refs: DataFrame, name: str, kind: str) -> DataFrame:
    """The commit a branch or tag stands on, as a one-row frame ``head``."""
    named = refs.filter((F.col("name") == name) & (F.col("kind") == kind))
    return named.select(F.col("snapshot_id").alias("head"))


def _last_commit(commits: DataFrame, where: Column) -> DataFrame:
    latest = F.max(F.struct("committed_at", "snapshot_id"))
    return (
        commits.filter(where).agg(latest.alias("_last"))
        .select(F.col("_last.snapshot_id").alias("head"))
        .filter(F.col("head").isNotNull())
    )


def resolve_as_of(commits: DataFrame, at: datetime | str) -> DataFrame:
    """The last commit made up to a moment."""
    return _last_commit(commits, F.col("committed_at") <= F.lit(at).cast("timestamp_ntz"))


def snapshot_id_for_date(commits: DataFrame, day: str) -> DataFrame:
    """The last commit made on a day (``yyyyMMdd``)."""
    on = F.to_date(F.lit(day), "yyyyMMdd")
    return _last_commit(commits, F.col("committed_at").cast("date") == on)


def ancestors(commits: DataFrame, heads: DataFrame) -> DataFrame:
    """(head, snapshot_id, depth) for every commit on the parent chain of each head: the head itself
    at depth 0, its parent at 1 and so on.  Ids say nothing about which commit came later.

    Jump tables double the distance they cover, so a chain of n commits takes log2(n) rounds.
    Each table is used twice by the next; it is checkpointed or plans would double as well.
    """
    links = commits.select("snapshot_id", "parent_id").distinct()
    jump = cut_lineage(links.filter(F.col("parent_id").isNotNull()))
    rounds = ceil(log2(links.count() + 1))
    reached = heads.select("head", F.col("head").alias("snapshot_id"), F.lit(0).alias("depth"))
    for i in range(rounds):
        step = reached.join(jump, "snapshot_id", "left")
        here = F.struct("snapshot_id", "depth")
        there = F.struct(F.col("parent_id").alias("snapshot_id"), (F.col("depth") + 2**i).alias("depth"))
        both = F.array_compact(F.array(here, F.when(F.col("parent_id").isNotNull(), there)))
        reached = step.select("head", F.explode(both).alias("at")).select("head", "at.*")
        if i + 1 < rounds:
            onward = jump.select(F.col("snapshot_id").alias("parent_id"), F.col("parent_id").alias("_far"))
            jump = cut_lineage(
                jump.join(onward, "parent_id").select("snapshot_id", F.col("_far").alias("parent_id"))
            )
    return reached


def visible_commits(commits: DataFrame, heads: DataFrame) -> DataFrame:
    """(head, slice, content_id) of the rows each head shows: per slice, everything from its
    nearest overwrite on."""
    chain = ancestors(commits, heads).join(
        commits.select("snapshot_id", "slice", "operation", "content_id"), "snapshot_id"
    )
    overwritten = F.when(F.col("operation") == "overwrite", F.col("depth"))
    base = chain.groupBy(F.col("head").alias("_head"), F.col("slice").alias("_slice")).agg(F.min(overwritten).alias("_base"))
    own = (chain["head"] == base["_head"]) & chain["slice"].eqNullSafe(base["_slice"])  # NULL is a slice
    return (
        chain.join(base, own)
        .filter(F.col("_base").isNull() | (F.col("depth") <= F.col("_base")))
        .select("head", "slice", "content_id")
    )


def read_version(history: DataFrame, commits: DataFrame, head: DataFrame) -> DataFrame:
    """The table as the commit in the one-row frame ``head`` shows it."""
    shown = visible_commits(commits, head).select(F.col("slice").alias("_slice"), F.col("content_id").alias("_content"))
    same = (history["content_id"] == shown["_content"]) & history["slice"].eqNullSafe(shown["_slice"])
    return history.join(shown, same).select(*[history[c] for c in history.columns])


def content_changes(commits: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """(slice, content_id, change): contents only one of two commits shows, -1 for the first and 1 for the second
    (or how often more or less it shows them).  Both are one-row frames ``head``; neither need build on the other."""
    role = lambda head, n: head.select(F.col("head").cast("bigint").alias("head"), F.lit(n).alias("_role"))
    roles = role(before, -1).unionByName(role(after, 1))
    shown = visible_commits(commits, roles.select("head").distinct()).join(roles, "head")
    return shown.groupBy("slice", "content_id").agg(F.sum("_role").alias("change")).filter("change <> 0")


def snapshot_changes(history: DataFrame, commits: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one of two commits shows and the other does not: their columns without ``content_id``, with ``side``
    (``added`` | ``removed``) and ``copies``.

    The contents both show are ruled out from the commit log, so their rows are never read: the list of the others is
    stored first, and a history laid out by ``content_id`` is read in those folders alone.  A row that was rewritten
    unchanged is no change.
    """
    changed = materialize(content_changes(commits, before, after), "changed-content").filter("change <> 0")
    listed = changed.select(F.col("slice").alias("_slice"), F.col("content_id").alias("_content"), "change")
    same = (history["content_id"] == listed["_content"]) & history["slice"].eqNullSafe(listed["_slice"])
    columns = [c for c in history.columns if c != "content_id"]
    net = history.join(listed, same).groupBy(*columns).agg(F.sum("change").alias("_net")).filter("_net <> 0")
    return net.select(
        *columns, F.when(F.col("_net") > 0, "added").otherwise("removed").alias("side"), F.abs("_net").alias("copies"))


def snapshot_history(commits: DataFrame, refs: DataFrame, branch: str = MAIN) -> DataFrame:
    """Commit log with a mark for what the branch still builds on."""
    log = commits.groupBy("snapshot_id", "parent_id").agg(F.max("committed_at").alias("made_current_at"))
    current = ancestors(commits, resolve_ref(refs, branch, "branch")).select(
        "snapshot_id", F.lit(True).alias("_current")
    )
    return log.join(current, "snapshot_id", "left").select(
        "made_current_at", "snapshot_id", "parent_id",
        F.coalesce("_current", F.lit(False)).alias("is_current_ancestor"),
    )


def describe_refs(commits: DataFrame, refs: DataFrame) -> DataFrame:
    """Branches and tags with the time of the commit they stand on."""
    made = commits.groupBy("snapshot_id").agg(F.max("committed_at").alias("committed_at"))
    return refs.join(made, "snapshot_id", "left").select(*refs.columns, "committed_at")


def set_head(refs: DataFrame, head: DataFrame, branch: str = MAIN) -> DataFrame:
    """Point a branch at the commit in the one-row frame ``head``."""
    is_branch = (F.col("name") == branch) & (F.col("kind") == "branch")
    moved = refs.filter(is_branch).drop("snapshot_id").join(
        head.select(F.lit(branch).alias("name"), F.col("head").alias("snapshot_id")), "name"
    )
    return refs.filter(~is_branch).unionByName(moved)


def rollback(commits: DataFrame, refs: DataFrame, snapshot_id: int, branch: str = MAIN) -> DataFrame:
    """Point a branch back at a commit it builds on; any other commit leaves it where it is."""
    chain = ancestors(commits, resolve_ref(refs, branch, "branch"))
    return _move_if_found(refs, chain.filter(F.col("snapshot_id") == snapshot_id), branch)


def rollback_to_time(commits: DataFrame, refs: DataFrame, at, branch: str = MAIN) -> DataFrame:
    """Point a branch back at the last commit it builds on that was made up to a moment."""
    chain = ancestors(commits, resolve_ref(refs, branch, "branch"))
    own = commits.join(chain, "snapshot_id").filter(F.col("committed_at") <= F.lit(at).cast("timestamp_ntz"))
    last = own.agg(F.max_by("snapshot_id", F.struct("committed_at", -F.col("depth"))).alias("snapshot_id"))
    return _move_if_found(refs, last.filter(F.col("snapshot_id").isNotNull()), branch)


def _move_if_found(refs: DataFrame, target: DataFrame, branch: str) -> DataFrame:
    to = target.select(
        F.lit(branch).alias("name"), F.lit("branch").alias("kind"), F.col("snapshot_id").alias("_to")
    )
    return refs.join(to, ["name", "kind"], "left").select(
        "name", "kind", F.coalesce("_to", "snapshot_id").alias("snapshot_id"), "retain_days"
    )


def create_ref(
    refs: DataFrame, head: DataFrame, name: str, kind: str, retain_days: int | None = None
) -> DataFrame:
    """Name a commit.  An existing branch or tag of that name is replaced."""
    others = refs.filter((F.col("name") != name) | (F.col("kind") != kind))
    return others.unionByName(head.select(
        F.lit(name).alias("name"),
        F.lit(kind).alias("kind"),
        F.col("head").alias("snapshot_id"),
        F.lit(retain_days).cast("int").alias("retain_days"),
    ))


def publish(
    commits: DataFrame, refs: DataFrame, staged_id: int, new_id: int, at, branch: str = MAIN
) -> tuple[DataFrame, DataFrame]:
    """Repeat a commit staged elsewhere on top of a branch, without copying its rows.

    Without such a commit or branch nothing changes.
    """
    onto = resolve_ref(refs, branch, "branch").select(
        F.lit(staged_id).cast("bigint").alias("snapshot_id"), F.col("head").alias("_onto")
    )
    again = commits.join(onto, "snapshot_id").withColumns({
        "snapshot_id": F.lit(new_id).cast("bigint"),
        "parent_id": F.col("_onto").cast("bigint"),
        "committed_at": F.lit(at).cast("timestamp_ntz"),
    })
    moved = _move_if_found(refs, again.select("snapshot_id").distinct(), branch)
    return commits.unionByName(again.select(*commits.columns)), moved


def retained_commits(
    commits: DataFrame, refs: DataFrame, older_than, retain_last: int, now=None
) -> DataFrame:
    """Commits that stay readable: branch heads, tags not past their days (counted up to
    ``now``), the last ``retain_last`` main builds on, and all made at or after ``older_than``."""
    limit = F.lit(older_than).cast("timestamp_ntz")
    today = F.lit(older_than if now is None else now).cast("timestamp_ntz")
    made = commits.groupBy("snapshot_id").agg(F.max("committed_at").alias("committed_at"))
    named = made.join(refs, "snapshot_id").filter(
        (F.col("kind") == "branch")
        | F.col("retain_days").isNull()
        | (F.datediff(today, F.col("committed_at")) <= F.col("retain_days"))
    )
    newest = ancestors(commits, resolve_ref(refs, MAIN, "branch")).filter(F.col("depth") < retain_last)
    recent = made.filter(F.col("committed_at") >= limit)
    kept = [part.select("snapshot_id") for part in (named, newest, recent)]
    return kept[0].union(kept[1]).union(kept[2]).distinct()


def _still_shown(history: DataFrame, commits: DataFrame, retained: DataFrame) -> DataFrame:
    """Rows some retained commit shows: those it wrote itself, and those of given-up commits
    that it builds on.  A row hidden from one commit is hidden from all that build on it, so
    for the latter only retained commits directly on top of a given-up one need a look."""
    own = commits.join(retained, "snapshot_id", "left_semi")
    given_up = commits.select("snapshot_id").distinct().join(retained, "snapshot_id", "left_anti")
    edge = own.join(given_up.withColumnRenamed("snapshot_id", "parent_id"), "parent_id", "left_semi")
    heads = edge.select(F.col("snapshot_id").alias("head")).distinct()
    shown = visible_commits(commits, heads).select("slice", "content_id")
    needed = shown.union(own.select("slice", "content_id")).distinct()
    return history.join(needed, ["slice", "content_id"], "left_semi").select(*history.columns)


def expire(
    history: DataFrame, commits: DataFrame, refs: DataFrame, older_than, retain_last: int, now=None
) -> DataFrame:
    """History without the rows that no retained commit shows.  Reading any retained commit
    gives the same rows as before.  ``commits`` is small and stays whole, as the parent chain."""
    retained = retained_commits(commits, refs, older_than, retain_last, now)
    return _still_shown(history, commits, retained)


def expire_by_id(history: DataFrame, commits: DataFrame, refs: DataFrame, ids: list[int]) -> DataFrame:
    """The same for a list of commits to give up; those a ref names stay all the same."""
    unlisted = commits.select("snapshot_id").filter(~F.col("snapshot_id").isin(*ids))
    retained = unlisted.union(refs.select("snapshot_id")).distinct()
    return _still_shown(history, commits, retained)
