"""Reading, naming, moving and expiring versions of a day-sliced table."""

from __future__ import annotations

from quayside.operators import versions as vs

from .registry import check
from .views import scrambled

_CHAIN = """
    SELECT head, head AS snapshot_id, 0 AS depth FROM v_heads
    UNION
    SELECT c.head, s.parent_id, c.depth + 1 FROM v_chain c JOIN v_commits s ON c.snapshot_id = s.snapshot_id
    WHERE s.parent_id IS NOT NULL"""
_SHOWN = """
    SELECT c.head, s.slice, s.content_id FROM v_chain c JOIN v_commits s ON c.snapshot_id = s.snapshot_id
    WHERE NOT EXISTS (
      SELECT 1 FROM v_chain c2 JOIN v_commits s2 ON c2.snapshot_id = s2.snapshot_id
      WHERE c2.head = c.head AND s2.slice = s.slice AND s2.operation = 'overwrite'
        AND c2.depth < c.depth)"""
_READ = """
    SELECT h.slice, h.content_id, h.event_id, h.value
    FROM v_history h JOIN v_shown s ON h.slice = s.slice AND h.content_id = s.content_id"""
CHAINS = {"v_chain": _CHAIN, "v_shown": _SHOWN}


def _rows(v, head, commits=None):
    rows = v.history.drop("ts")
    return vs.read_version(rows, v.commits if commits is None else commits, head)


@check("snapshot_read_branch", _READ,
       v_heads="SELECT snapshot_id AS head FROM v_refs WHERE name = 'main'", **CHAINS)
def _(v):
    return _rows(v, vs.resolve_ref(v.refs, "main", "branch"))


@check("snapshot_read_by_id", _READ, v_heads=f"SELECT {scrambled(59)} AS head", **CHAINS)
def _(v):
    return _rows(v, vs.commits_of(v.spark, scrambled(59)))


@check("snapshot_read_by_tag", _READ,
       v_heads="SELECT snapshot_id AS head FROM v_refs WHERE name = 'mid'", **CHAINS)
def _(v):
    return _rows(v, vs.resolve_ref(v.refs, "mid", "tag"))


@check("snapshot_read_as_of_ts", _READ, v_heads="""
    SELECT snapshot_id AS head FROM v_commits WHERE committed_at <= TIMESTAMP '2024-01-25 00:00:00'
    ORDER BY committed_at DESC, snapshot_id DESC LIMIT 1""", **CHAINS)
def _(v):
    return _rows(v, vs.resolve_as_of(v.commits, "2024-01-25 00:00:00"))


@check("snapshot_id_for_date", """
    SELECT snapshot_id AS head FROM v_commits WHERE CAST(committed_at AS DATE) = DATE '2024-01-18'
    ORDER BY committed_at DESC, snapshot_id DESC LIMIT 1""")
def _(v):
    return vs.snapshot_id_for_date(v.commits, "20240118")


@check("meta_history", """
    SELECT committed_at AS made_current_at, snapshot_id, parent_id,
      snapshot_id IN (SELECT snapshot_id FROM v_chain) AS is_current_ancestor
    FROM v_commits""", v_heads="SELECT snapshot_id AS head FROM v_refs WHERE name = 'main'", **CHAINS)
def _(v):
    return vs.snapshot_history(v.commits, v.refs)


@check("meta_refs", """
    SELECT r.*, c.committed_at FROM v_refs r LEFT JOIN v_commits c ON r.snapshot_id = c.snapshot_id""")
def _(v):
    return vs.describe_refs(v.commits, v.refs)


@check("snapshot_tag_branch", f"""
    SELECT * FROM v_refs WHERE name <> 'mid'
    UNION ALL
    SELECT 'mid', 'tag', arg_max(snapshot_id, content_id), 7 FROM v_commits
    UNION ALL
    SELECT 'repair', 'branch', {scrambled(30)}, NULL""")
def _(v):
    tagged = vs.create_ref(v.refs, vs.resolve_ref(v.refs, "main", "branch"), "mid", "tag", 7)
    return vs.create_ref(tagged, vs.commits_of(v.spark, scrambled(30)), "repair", "branch")


@check("snapshot_rollback", _READ, v_heads=f"SELECT CAST({scrambled(45)} AS BIGINT) AS head", **CHAINS)
def _(v):
    moved = vs.rollback(v.commits, v.refs, scrambled(45))
    return _rows(v, vs.resolve_ref(moved, "main", "branch"))


# commits 58 to 60 are the last of their time, but main does not build on them
@check("snapshot_rollback_to_time", _READ, v_heads="""
    SELECT snapshot_id AS head FROM v_commits
    WHERE committed_at <= TIMESTAMP '2024-01-21 06:30:00' AND content_id NOT IN (58, 59, 60)
    ORDER BY committed_at DESC LIMIT 1""", **CHAINS)
def _(v):
    moved = vs.rollback_to_time(v.commits, v.refs, "2024-01-21 06:30:00")
    return _rows(v, vs.resolve_ref(moved, "main", "branch"))


@check("snapshot_set_current", _READ, v_heads=f"SELECT CAST({scrambled(60)} AS BIGINT) AS head", **CHAINS)
def _(v):
    moved = vs.set_head(v.refs, vs.commits_of(v.spark, scrambled(60)))
    return _rows(v, vs.resolve_ref(moved, "main", "branch"))


# commit 60 was rolled back; publishing it puts its day on top of main
@check("snapshot_publish", """
    SELECT h.slice, h.content_id, h.event_id, h.value
    FROM v_history h JOIN v_shown s ON h.slice = s.slice AND h.content_id = s.content_id
    WHERE h.slice <> DATE '2024-01-20'
    UNION ALL
    SELECT slice, content_id, event_id, value FROM v_history WHERE content_id = 60""",
       v_heads="SELECT snapshot_id AS head FROM v_refs WHERE name = 'main'", **CHAINS)
def _(v):
    commits, refs = vs.publish(v.commits, v.refs, scrambled(60), 7, "2024-02-01 00:00:00")
    return _rows(v, vs.resolve_ref(refs, "main", "branch"), commits)


@check("snapshot_expire", """
    SELECT h.slice, h.content_id, h.event_id, h.value FROM v_history h
    WHERE (h.slice, h.content_id) IN (SELECT (slice, content_id) FROM v_shown)""", v_heads="""
    SELECT snapshot_id AS head FROM v_refs
    UNION
    SELECT snapshot_id FROM v_commits WHERE committed_at >= TIMESTAMP '2024-01-30 00:00:00'
    UNION
    (SELECT snapshot_id FROM v_commits WHERE content_id NOT IN (58, 59, 60)
     ORDER BY committed_at DESC, snapshot_id DESC LIMIT 5)""", **CHAINS)
def _(v):
    return vs.expire(
        v.history.drop("ts"), v.commits, v.refs, "2024-01-30 00:00:00", 5, now="2024-02-01 00:00:00"
    )


@check("snapshot_expire_by_id", """
    SELECT h.slice, h.content_id, h.event_id, h.value FROM v_history h
    WHERE (h.slice, h.content_id) IN (SELECT (slice, content_id) FROM v_shown)""", v_heads="""
    SELECT snapshot_id AS head FROM v_commits WHERE content_id NOT IN (1, 2, 3, 40, 41, 58, 59, 78)
    UNION SELECT snapshot_id FROM v_refs""", **CHAINS)
def _(v):
    given_up = [scrambled(n) for n in (1, 2, 3, 40, 41, 58, 59, 78)]
    return vs.expire_by_id(v.history.drop("ts"), v.commits, v.refs, given_up)
