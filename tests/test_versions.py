from datetime import datetime

import pytest

from quayside.operators import versions as vs
from .conftest import bag

COMMITS = ("snapshot_id bigint, parent_id bigint, committed_at timestamp_ntz, operation string, "
           "slice string, content_id bigint")


def at(day):
    return datetime(2024, 1, day)


@pytest.fixture
def commits(make):
    """1 appends, 2 overwrites, 3 appends after rolling back to 1, 4 overwrites another slice."""
    return make([
        (1, None, at(1), "append", "a", 1), (2, 1, at(2), "overwrite", "a", 2),
        (3, 1, at(3), "append", "a", 3), (4, 3, at(4), "overwrite", "b", 4),
        (5, 4, at(5), "append", "b", 5),
    ], COMMITS)


@pytest.fixture
def history(make):
    return make([("a", c, f"r{c}") for c in (1, 2, 3)] + [("b", 4, "r4"), ("b", 5, "r5")],
                "slice string, content_id bigint, v string")


@pytest.fixture
def refs(make):
    return make([("main", "branch", 5, None), ("old", "tag", 2, 31)],
                "name string, kind string, snapshot_id bigint, retain_days int")


def read(spark, history, commits, head):
    frame = vs.commits_of(spark, head) if isinstance(head, int) else head
    return {r.v for r in vs.read_version(history, commits, frame).collect()}


def test_read_at_each_commit(spark, history, commits, refs):
    seen = {h: read(spark, history, commits, h) for h in range(1, 6)}
    assert seen == {1: {"r1"}, 2: {"r2"}, 3: {"r1", "r3"}, 4: {"r1", "r3", "r4"},
                    5: {"r1", "r3", "r4", "r5"}}
    assert read(spark, history, commits, vs.resolve_ref(refs, "old", "tag")) == {"r2"}
    assert read(spark, history, commits, vs.resolve_as_of(commits, "2024-01-03 12:00:00")) == {"r1", "r3"}
    assert read(spark, history, commits, vs.resolve_as_of(commits, "2023-01-01 00:00:00")) == set()
    assert vs.snapshot_id_for_date(commits, "20240102").first().head == 2


@pytest.mark.parametrize("length", [1, 2, 3, 4, 7, 8, 9, 33])
def test_ancestors_of_a_chain(make, spark, length):
    rows = [(i, i - 1 or None, at(1), "append", "a", i) for i in range(1, length + 1)]
    chain = make(rows, COMMITS)
    for head in {1, (length + 1) // 2, length}:
        found = [r.snapshot_id for r in vs.ancestors(chain, vs.commits_of(spark, head)).collect()]
        assert sorted(found) == list(range(1, head + 1))


def test_a_commit_to_several_slices(make, spark):
    commits = make([
        (1, None, at(1), "append", "a", 1), (1, None, at(1), "append", "b", 1),
        (2, 1, at(2), "overwrite", "b", 2),
    ], COMMITS)
    history = make([("a", 1, "a1"), ("b", 1, "b1"), ("b", 2, "b2")], "slice string, content_id bigint, v string")
    assert read(spark, history, commits, 2) == {"a1", "b2"}


def test_history_marks_what_main_builds_on(commits, refs):
    marks = {r.snapshot_id: r.is_current_ancestor for r in vs.snapshot_history(commits, refs).collect()}
    assert marks == {1: True, 2: False, 3: True, 4: True, 5: True}


def head_of(refs, name="main"):
    return vs.resolve_ref(refs, name, "branch").first().head


def test_moving_heads(spark, commits, refs):
    assert head_of(vs.rollback(commits, refs, 3)) == 3
    assert head_of(vs.rollback(commits, refs, 2)) == 5  # not on main's chain
    assert head_of(vs.rollback_to_time(commits, refs, "2024-01-02 12:00:00")) == 1
    assert head_of(vs.set_head(refs, vs.commits_of(spark, 2))) == 2
    assert vs.rollback(commits, refs, 3).count() == 2


def test_naming(spark, commits, refs):
    named = vs.create_ref(refs, vs.commits_of(spark, 3), "old", "tag", 7)
    assert bag(named.filter("name = 'old'")) == [("old", "tag", 3, 7)]
    both = vs.create_ref(named, vs.commits_of(spark, 1), "old", "branch")
    assert both.count() == 3
    assert bag(vs.describe_refs(commits, refs).select("name", "committed_at")) == [
        ("main", at(5)), ("old", at(2))
    ]


def test_publish_staged_commit(spark, history, commits, refs):
    published, moved = vs.publish(commits, refs, 2, 9, "2024-01-09 00:00:00")
    assert head_of(moved) == 9
    assert read(spark, history, published, 9) == {"r2", "r4", "r5"}
    assert read(spark, history, published, 5) == {"r1", "r3", "r4", "r5"}


@pytest.mark.parametrize("older_than, last", [("2024-01-05 00:00:00", 1), ("2024-02-01 00:00:00", 1),
                                              ("2024-02-01 00:00:00", 2), ("2023-01-01 00:00:00", 1)])
def test_expiry_keeps_what_is_readable(spark, history, commits, refs, older_than, last):
    kept = vs.expire(history, commits, refs, older_than, last)
    retained = {r.snapshot_id for r in vs.retained_commits(commits, refs, older_than, last).collect()}
    shown = set()
    for head in retained:
        shown |= read(spark, history, commits, head)
        assert read(spark, kept, commits, head) == read(spark, history, commits, head)
    assert {r.v for r in kept.collect()} == shown


def test_tag_past_its_days_goes(commits, refs, history):
    kept = vs.expire(history, commits, refs, "2024-02-01 00:00:00", 1, now="2024-03-15 00:00:00")
    assert {r.v for r in kept.collect()} == {"r1", "r3", "r4", "r5"}


def test_expire_by_id(commits, refs, history):
    no_tag = refs.filter("kind = 'branch'")
    assert {r.v for r in vs.expire_by_id(history, commits, no_tag, [1, 2, 4]).collect()} == {
        "r1", "r3", "r4", "r5"
    }
    assert vs.expire_by_id(history, commits, refs, [2, 5]).count() == 5


def test_ids_say_nothing_about_order(make, spark):
    commits = make([(900, None, at(1), "append", "a", 1), (5, 900, at(2), "overwrite", "a", 2),
                    (700, 5, at(3), "append", "a", 3)], COMMITS)
    history = make([("a", c, f"r{c}") for c in (1, 2, 3)], "slice string, content_id bigint, v string")
    assert read(spark, history, commits, 700) == {"r2", "r3"}
    assert read(spark, history, commits, 900) == {"r1"}


def test_publish_to_no_branch_or_of_no_commit_changes_nothing(commits, refs):
    for staged, branch in ((2, "none"), (77, "main")):
        published, moved = vs.publish(commits, refs, staged, 9, "2024-01-09 00:00:00", branch)
        assert bag(published) == bag(commits) and bag(moved) == bag(refs)
