"""Staged commits: audit, publish, conflicts, and refs that only one writer can move."""

import glob

import pytest

from .conftest import bag
from quayside.operators import versions as vs
from quayside.operators.commits import CommitConflict, VersionedTable, conflicts

ROWS = "k int, v string, slice string"


@pytest.fixture
def table(spark, make, tmp_path):
    """A first commit on main, with a NULL slice."""
    table = VersionedTable(spark, str(tmp_path / "t"), make([], ROWS).schema)
    log = table.stage(make([(1, "a", "d1"), (2, "b", "d2"), (3, "c", None)], ROWS), 10, "2024-01-01 00:00:00")
    assert table.read().isEmpty() and log.first()["parent_id"] is None
    assert table.publish(log, "2024-01-01 00:00:00") == 10
    return table


def head(table, branch="main"):
    return vs.resolve_ref(table.refs(), branch, "branch").first()["head"]


def test_stage_is_seen_by_an_audit_only(table, make):
    log = table.stage(make([(4, "d", "d1"), (5, "e", "d9")], ROWS), 11, "2024-01-02 00:00:00")
    assert bag(table.read()) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", None)]
    assert bag(table.read_staged(log)) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", None), (4, "d", "d1"), (5, "e", "d9")]
    assert table.publish(log, "2024-01-02 01:00:00") == 11 == head(table)
    assert len(bag(table.read())) == 5
    assert bag(table.read(vs.commits_of(table.spark, 10))) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", None)]


def test_overwrite_and_emptied_slices(table, make):
    log = table.stage(make([(9, "x", "d1")], ROWS), 11, "2024-01-02 00:00:00", "overwrite", emptied=["d2", None])
    table.publish(log, "2024-01-02 01:00:00")
    assert bag(table.read()) == [(9, "x", "d1")]
    assert {(r["slice"], r["operation"]) for r in table.commits.filter("snapshot_id = 11").collect()} == {
        ("d1", "overwrite"), ("d2", "overwrite"), (None, "overwrite")}


def test_second_writer_of_a_slice_is_refused_and_told(table, make):
    one = table.stage(make([(9, "x", "d1"), (9, "x", None)], ROWS), 11, "2024-01-02 00:00:00", "overwrite")
    two = table.stage(make([(8, "y", "d1"), (8, "y", "d2"), (8, "z", None)], ROWS), 12, "2024-01-02 00:00:01")
    table.publish(one, "2024-01-02 01:00:00")
    before, version = bag(table.read()), table.refs_version()
    with pytest.raises(CommitConflict, match="12 is refused.*None, d1") as error:
        table.publish(two, "2024-01-02 01:00:01")
    assert error.value.slices == [None, "d1"] or set(error.value.slices) == {None, "d1"}
    assert bag(table.read()) == before and table.refs_version() == version
    # staged anew on the new head it goes through
    again = table.stage(make([(8, "y", "d1")], ROWS), 13, "2024-01-02 02:00:00")
    assert table.publish(again, "2024-01-02 03:00:00") == 13
    assert (8, "y", "d1") in bag(table.read())


def test_writers_of_other_slices_pass_without_copying(table, make):
    one = table.stage(make([(9, "x", "d1")], ROWS), 11, "2024-01-02 00:00:00", "overwrite")
    two = table.stage(make([(8, "y", "d2")], ROWS), 12, "2024-01-02 00:00:01")
    table.publish(one, "2024-01-02 01:00:00")
    files = sorted(glob.glob(f"{table.path}/history/**/*.parquet", recursive=True))
    top = table.publish(two, "2024-01-02 01:00:01")
    assert top not in (11, 12) and head(table) == top
    assert sorted(glob.glob(f"{table.path}/history/**/*.parquet", recursive=True)) == files
    assert bag(table.read()) == [(2, "b", "d2"), (3, "c", None), (8, "y", "d2"), (9, "x", "d1")]
    repeated = table.commits.filter(f"snapshot_id = {top}").first()
    assert (repeated["parent_id"], repeated["content_id"]) == (11, 12)


def test_a_rolled_back_base_is_a_conflict_where_it_mattered(table, make):
    log = table.stage(make([(4, "d", "d1")], ROWS), 11, "2024-01-02 00:00:00")
    table.publish(log, "2024-01-02 00:00:00")
    on_eleven = table.stage(make([(5, "e", "d1")], ROWS), 12, "2024-01-03 00:00:00")
    elsewhere = table.stage(make([(6, "f", "d2")], ROWS), 13, "2024-01-03 00:00:00")
    version = table.refs_version()
    assert table.swap_refs(vs.rollback(table.commits, table.refs(), 10), version)
    with pytest.raises(CommitConflict):
        table.publish(on_eleven, "2024-01-03 01:00:00")
    table.publish(elsewhere, "2024-01-03 01:00:00")
    assert bag(table.read()) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", None), (6, "f", "d2")]


def test_refs_move_once_per_number(table):
    version = table.refs_version()
    named = vs.create_ref(table.refs(), vs.commits_of(table.spark, 10), "first", "tag")
    assert table.swap_refs(named, version)
    assert not table.swap_refs(table.refs(), version)
    assert table.refs_version() == version + 1 and table.refs().filter("name = 'first'").count() == 1
    assert not glob.glob(f"{table.path}/refs/.waiting*")


def test_a_lost_race_is_tried_again(table, make, monkeypatch):
    """Another writer of another slice gets its refs in between reading and moving."""
    mine = table.stage(make([(8, "y", "d2")], ROWS), 12, "2024-01-02 00:00:01")
    other = table.stage(make([(9, "x", "d1")], ROWS), 11, "2024-01-02 00:00:00")
    swap, raced = VersionedTable.swap_refs, []

    def racing(self, refs, version):
        if not raced:
            raced.append(True)
            other_table = VersionedTable(self.spark, self.path, self.schema)
            assert other_table.publish(other, "2024-01-02 01:00:00") == 11
        return swap(self, refs, version)

    monkeypatch.setattr(VersionedTable, "swap_refs", racing)
    top = table.publish(mine, "2024-01-02 01:00:01")
    assert top not in (11, 12)
    assert bag(table.read()) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", None), (8, "y", "d2"), (9, "x", "d1")]


def test_branches_are_apart(table, make):
    version = table.refs_version()
    table.swap_refs(vs.create_ref(table.refs(), vs.commits_of(table.spark, 10), "audit", "branch"), version)
    log = table.stage(make([(4, "d", "d1")], ROWS), 11, "2024-01-02 00:00:00", branch="audit")
    table.publish(log, "2024-01-02 00:00:00", "audit")
    assert head(table) == 10 and head(table, "audit") == 11
    assert len(bag(table.read(branch="audit"))) == 4 and len(bag(table.read())) == 3


def test_odd_commits(table, make):
    nothing = table.stage(make([], ROWS), 11, "2024-01-02 00:00:00")
    assert table.publish(nothing, "2024-01-02 00:00:00") == 10
    with pytest.raises(ValueError, match="in the log already"):
        table.stage(make([(1, "a", "d1")], ROWS), 10, "2024-01-02 00:00:00")
    with pytest.raises(ValueError, match="appends or overwrites"):
        table.stage(make([(1, "a", "d1")], ROWS), 14, "2024-01-02 00:00:00", "merge")
    with pytest.raises(ValueError, match="empties"):
        table.stage(make([(1, "a", "d1")], ROWS), 14, "2024-01-02 00:00:00", emptied=["d2"])
    # staging again under an id that was not published replaces its rows
    table.stage(make([(7, "old", "d5")], ROWS), 15, "2024-01-02 00:00:00")
    log = table.stage(make([(7, "new", "d5")], ROWS), 15, "2024-01-02 00:00:00")
    table.publish(log, "2024-01-02 00:00:00")
    assert bag(table.read().filter("k = 7")) == [(7, "new", "d5")]


def test_conflicts_read_the_log_alone(table, make):
    log = table.stage(make([(4, "d", "d1")], ROWS), 11, "2024-01-02 00:00:00")
    plan = conflicts(table.commits, table.refs(), log)._jdf.queryExecution().executedPlan().toString()
    assert "/history" not in plan


# ---- changes between versions -----------------------------------------------------------------------


def changes(table, before, after):
    spark = table.spark
    return vs.snapshot_changes(table.history, table.commits, vs.commits_of(spark, before), vs.commits_of(spark, after))


def test_changes_between_versions_that_do_not_build_on_each_other(table, make):
    left = table.stage(make([(1, "a", "d1"), (1, "new", "d1")], ROWS), 11, "2024-01-02 00:00:00", "overwrite")
    right = table.stage(make([(3, "c", None), (3, "c", None)], ROWS), 12, "2024-01-02 00:00:00")
    for log in (left, right):
        log.write.mode("append").parquet(f"{table.path}/commits")
    # d1 was rewritten: the row written unchanged is no change; copies count
    assert bag(changes(table, 11, 12).select("k", "v", "slice", "side", "copies")) == [
        (1, "new", "d1", "removed", 1), (3, "c", None, "added", 2)]
    assert bag(changes(table, 12, 11).select("k", "v", "slice", "side", "copies")) == [
        (1, "new", "d1", "added", 1), (3, "c", None, "removed", 2)]
    assert changes(table, 11, 11).isEmpty()


def test_shared_content_is_never_read(table, make):
    """Files of what both versions show may be unreadable."""
    log = table.stage(make([(4, "d", "d1")], ROWS), 11, "2024-01-02 00:00:00")
    table.publish(log, "2024-01-02 00:00:00")
    for file in glob.glob(f"{table.path}/history/content_id=10/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"no parquet")
    for crc in glob.glob(f"{table.path}/history/content_id=10/.*.crc"):
        with open(crc, "wb") as out:
            out.write(b"")
    assert bag(changes(table, 10, 11).select("k", "v", "slice", "side")) == [(4, "d", "d1", "added")]
    with pytest.raises(Exception):
        table.read().collect()
