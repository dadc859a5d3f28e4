"""Writing versions of a day-sliced table: stage, audit, publish.

A :class:`VersionedTable` is a folder with three parts, none of which is ever changed in place:

    history/content_id=...   the rows of every commit, a folder each
    commits/                 what each commit did to which slice (see ``versions``)
    refs/v=...               branches and tags; the highest number holds

A writer *stages*: its rows go under a fresh content id, with log rows on top of the head it read.  No branch shows them
yet, but ``read_staged`` does, for an audit.  *Publishing* moves the branch if each slice written still shows what it
showed at that head.  Writers of other slices do not get in each other's way: a commit whose branch went on meanwhile is
repeated on top of it without copying rows.  If a slice has changed, the later writer is refused and told which.

Refs move by renaming a finished folder to the next number, which fails if another writer was first; the loser looks
at the new head and tries again.  The folder's file system must rename without overwriting in one step, as HDFS and
local ones do.  A writer that dies leaves rows and log entries that nothing shows; staging again under the same id
replaces them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..settings import materialize
from . import versions as vs

SHOWN = 20  # slices named in a message


class CommitConflict(RuntimeError):
    """A slice of a staged commit was changed by another commit; ``slices`` names the first of them."""

    def __init__(self, staged_id: int, slices: list):
        super().__init__(f"commit {staged_id} is refused, these slices have changed since: {', '.join(map(str, slices))}")
        self.staged_id, self.slices = staged_id, slices


def log_rows(
    rows: DataFrame, head: DataFrame, snapshot_id: int, at: datetime | str, operation: str,
    slice_col: str = "slice", emptied: Sequence = (),
) -> DataFrame:
    """A commit's log: one row per slice it has rows for, and per slice an overwrite leaves empty.

    ``head`` is the one-row frame of the commit it builds on (no row: the first commit).
    """
    if operation not in ("append", "overwrite"):
        raise ValueError(f"a commit appends or overwrites, not {operation!r}")
    if emptied and operation != "overwrite":
        raise ValueError("only an overwrite empties slices")
    spark = rows.sparkSession
    slices = rows.select(F.col(slice_col).alias("slice"))
    if emptied:
        kind = rows.schema[slice_col].dataType
        gone = spark.createDataFrame([(str(s) if s is not None else None,) for s in emptied], "slice string")
        slices = slices.unionByName(gone.select(F.col("slice").cast(kind).alias("slice")))
    parent = head.first()
    return slices.distinct().select(
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        F.lit(parent["head"] if parent else None).cast("bigint").alias("parent_id"),
        F.lit(at).cast("timestamp_ntz").alias("committed_at"), F.lit(operation).alias("operation"),
        "slice", F.lit(snapshot_id).cast("bigint").alias("content_id"),
    )


def conflicts(commits: DataFrame, refs: DataFrame, log: DataFrame, branch: str = vs.MAIN) -> DataFrame:
    """Slices of a staged commit that a branch no longer shows as the commit's parent did.

    What is compared are the content ids either shows, so appends, overwrites and rollbacks count alike and no row of
    the table is read.
    """
    base = log.filter("parent_id is not null").select(F.col("parent_id").alias("head")).distinct()
    changed = vs.content_changes(commits, base, vs.resolve_ref(refs, branch, "branch"))
    own = log.select(F.col("slice").alias("_slice")).distinct()
    return changed.join(own, changed["slice"].eqNullSafe(own["_slice"]), "left_semi").select("slice").distinct()


class VersionedTable:
    """The parts of a versioned table under ``path``; ``schema`` is that of its rows, slice column included."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, slice_col: str = "slice"):
        self.spark, self.path, self.schema, self.slice_col = spark, path.rstrip("/"), schema, slice_col
        kind = schema[slice_col].dataType.simpleString()
        self._log = T._parse_datatype_string(
            f"snapshot_id long, parent_id long, committed_at timestamp_ntz, operation string, slice {kind}, content_id long")
        self._refs = T._parse_datatype_string("name string, kind string, snapshot_id long, retain_days int")

    # ---- reading ------------------------------------------------------------------------

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    @property
    def history(self) -> DataFrame:
        """All rows with their ``content_id`` and, as ``slice``, the slice they belong to."""
        rows = self._read("history", T.StructType([*self.schema.fields, T.StructField("content_id", T.LongType())]))
        return rows.withColumnRenamed(self.slice_col, "slice")

    @property
    def commits(self) -> DataFrame:
        return self._read("commits", self._log)

    def refs_version(self) -> int:
        """The number of the refs that hold (0: none yet)."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/refs")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return 0
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return max((int(n.removeprefix("v=")) for n in names if n.startswith("v=")), default=0)

    def refs(self, version: int | None = None) -> DataFrame:
        version = self.refs_version() if version is None else version
        return self._read(f"refs/v={version}", self._refs)

    def read(self, head: DataFrame | None = None, branch: str = vs.MAIN, commits: DataFrame | None = None) -> DataFrame:
        """The rows a branch shows, or those of the commit in the one-row frame ``head``."""
        head = vs.resolve_ref(self.refs(), branch, "branch") if head is None else head
        shown = vs.read_version(self.history, self.commits if commits is None else commits, head)
        return shown.drop("content_id").withColumnRenamed("slice", self.slice_col)

    # ---- writing ------------------------------------------------------------------------

    def stage(
        self, rows: DataFrame, snapshot_id: int, at: datetime | str, operation: str = "append",
        branch: str = vs.MAIN, emptied: Sequence = (),
    ) -> DataFrame:
        """Write rows under a fresh content id on top of the branch's head; the commit's log rows, stored.

        Nothing shows the rows yet.  Staging again under an id that was not published replaces them.
        """
        if not self.commits.filter((F.col("snapshot_id") == snapshot_id) | (F.col("content_id") == snapshot_id)).isEmpty():
            raise ValueError(f"commit {snapshot_id} is in the log already")
        head = vs.resolve_ref(self.refs(), branch, "branch")
        self._write_content(rows.select(*self.schema.names), snapshot_id)
        written = self.history.filter(F.col("content_id") == snapshot_id)
        return materialize(log_rows(written, head, snapshot_id, at, operation, emptied=emptied), "staged")

    def _write_content(self, rows: DataFrame, content_id: int) -> None:
        # as they are dealt, without a shuffle
        rows.write.mode("overwrite").parquet(f"{self.path}/history/content_id={content_id}")

    def read_staged(self, log: DataFrame) -> DataFrame:
        """The table as it would be with a staged commit: what an audit looks at."""
        head = log.select(F.col("snapshot_id").alias("head")).distinct()
        return self.read(head, commits=self.commits.unionByName(log))

    def publish(self, log: DataFrame, at: datetime | str, branch: str = vs.MAIN, tries: int = 10) -> int:
        """Make a staged commit the branch's head; the id of the commit the branch stands on then.

        If the branch went on since the commit was staged, it is repeated on top under a new id, unless one of its slices
        has changed: then ``CommitConflict`` names them and the branch stays.  An empty commit changes nothing.
        """
        first = log.select("snapshot_id", "parent_id").first()
        if first is None:
            found = vs.resolve_ref(self.refs(), branch, "branch").first()
            return found["head"] if found else None
        logged = False
        for _ in range(tries):
            version = self.refs_version()
            refs = self.refs(version)
            lost = [r["slice"] for r in conflicts(self.commits, refs, log, branch).limit(SHOWN).collect()]
            if lost:
                raise CommitConflict(first["snapshot_id"], sorted(lost, key=str))
            found = vs.resolve_ref(refs, branch, "branch").first()
            head = found["head"] if found else None
            if head == first["parent_id"]:
                top, entry = first["snapshot_id"], None if logged else log
                logged = True
            else:
                top = uuid.uuid4().int >> 65
                entry = log.withColumns({
                    "snapshot_id": F.lit(top).cast("bigint"), "parent_id": F.lit(head).cast("bigint"),
                    "committed_at": F.lit(at).cast("timestamp_ntz")})
            if entry is not None:
                # entries that no ref reaches are harmless, so the log goes first
                entry.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
            moved = refs.filter((F.col("name") != branch) | (F.col("kind") != "branch")).unionByName(
                vs.create_ref(refs.limit(0), vs.commits_of(self.spark, top), branch, "branch"))
            if self.swap_refs(moved, version):
                return top
        raise RuntimeError(f"the refs of {self.path} kept moving: {tries} tries")

    def swap_refs(self, refs: DataFrame, version: int) -> bool:
        """Make these the refs if number ``version`` still holds; False if another writer was first."""
        jvm, to = self.spark._jvm, f"{self.path}/refs/v={version + 1}"
        waiting = f"{self.path}/refs/.waiting-{uuid.uuid4().hex}"
        refs.coalesce(1).write.parquet(waiting)
        fs = jvm.org.apache.hadoop.fs
        source, target = fs.Path(waiting), fs.Path(to)
        files = source.getFileSystem(self.spark._jsc.hadoopConfiguration())
        context = fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(source), files.makeQualified(target), options)
        except Exception as error:
            files.delete(source, True)
            if files.exists(target):
                return False
            raise error
        return True
