"""Effective access of all users, blast radius and membership chains against brute force."""

import random

import pytest

from permscope.operators import access as AC
from permscope.operators import identity as ID
from permscope.operators.reports import duplicate_aces, folder_ace_counts

WELL_KNOWN = ["S-1-1-0", "S-1-5-11", "S-1-5-32-545"]
RANK = {"FullControl": 3, "Modify": 2, "Write": 2, "Read": 1, "0": 0, None: 0}
ACE_SCHEMA = ("run_id string, folder_path string, ace_sid string, ace_name string, ace_mask string, ace_type string, "
              "ace_inherited boolean")
USERS = [f"u{k}" for k in range(9)]
GROUPS = [f"g{k}" for k in range(6)]


def estate(seed):
    rng = random.Random(seed)
    edges = [(s, rng.choice(USERS + GROUPS), rng.choice(GROUPS)) for s in ("s1", "s2") for _ in range(14)]
    aces = [(r, f"f{rng.randint(0, 9)}" if rng.random() < 0.9 else None, rng.choice(USERS + 2 * GROUPS + WELL_KNOWN[:2] + ["other", None]),
             "n", rng.choice(list(RANK)), rng.choice(["allow", "allow", "Allow", "deny", None, "", "audit"]), rng.random() < 0.4)
            for r in ("r1", "r2", None) for _ in range(40)]
    aces += [a[:1] + ("copy",) + a[2:] for a in aces if a[1] == "f1"]  # two folders of one ACL
    people = [(s, u, u.upper(), "service" if u == "u8" else "user", u not in ("u6", "u7")) for s in ("s1", "s2") for u in USERS]
    people += [(s, g, g.upper(), "group", True) for s in ("s1", "s2") for g in GROUPS]
    return edges, aces, people


def reach(edges, snapshot):
    out = {}
    for start in USERS + GROUPS:
        seen, todo = set(), [start]
        while todo:
            x = todo.pop()
            for s, m, g in edges:
                if s == snapshot and m == x and g not in seen:
                    seen.add(g)
                    todo.append(g)
        out[start] = seen
    return out


def judge(rows):
    def rk(a):
        return RANK[a[4]]
    deny = [a for a in rows if (a[5] or "allow").lower() == "deny"]
    allow = [a for a in rows if (a[5] or "allow").lower() != "deny"]
    ea = max([rk(a) for a in allow if not a[6]], default=0)
    ia = max([rk(a) for a in allow if a[6]], default=0)
    ed = min([rk(a) for a in deny if not a[6] and rk(a)], default=4)
    idn = min([rk(a) for a in deny if a[6] and rk(a)], default=4)
    return max(min(ea, ed - 1), min(ia, ed - 1, idn - 1))


def expected(edges, aces):
    out = {}
    for s in ("s1", "s2"):
        groups = reach(edges, s)
        for u in USERS:
            context = {u, *groups[u], *WELL_KNOWN}
            for r in ("r1", "r2", None):
                for f in {a[1] for a in aces if a[0] == r}:
                    eff = judge([a for a in aces if a[0] == r and a[1] == f and a[2] in context])
                    if eff:
                        out[r, s, u, f] = eff
    return out


def frames(spark, seed):
    edges, aces, people = estate(seed)
    return (edges, aces, spark.createDataFrame(aces, ACE_SCHEMA).repartition(3),
            spark.createDataFrame(people, "snapshot_id string, sid string, samaccountname string, principal_type string, enabled boolean"),
            ID.membership_closure(spark.createDataFrame(edges, "snapshot_id string, member_sid string, group_sid string")))


@pytest.mark.parametrize("seed", [1, 2])
def test_access_of_all_users(spark, seed):
    edges, aces, df, people, closure = frames(spark, seed)
    want = expected(edges, aces)
    access = AC.access_table(df, people, closure)
    users = people.where("principal_type != 'group'")
    got = {(r.run_id, r.snapshot_id, r.user_sid, r.folder_path): r.rights_rank for r in AC.access_of(access, users).collect()}
    assert got == want
    plain = ID.effective_access(df, users, closure).collect()
    assert {(r.run_id, r.snapshot_id, r.user_sid, r.folder_path): r.rights_rank for r in plain} == want
    summary = {(r.run_id, r.snapshot_id, r.user_sid, r.rights_bucket): r.folders for r in AC.access_summary(access).collect()}
    assert len(summary) == 3 * 2 * len(USERS) * 3
    for (r, s, u, b), n in summary.items():
        k = 1 + AC.BUCKETS.index(b)
        assert n == sum(v == k for key, v in want.items() if key[:3] == (r, s, u))
    assert AC.access_of(access, users.where("sid = 'u3'"), "write").count() == sum(
        v >= 2 for key, v in want.items() if key[2] == "u3")


@pytest.mark.parametrize("seed", [1, 2, 5])
def test_rises_folder_by_folder(spark, seed):
    edges, aces, df, people, closure = frames(spark, seed)
    gone, new = "u2", "u4"  # a user of the first snapshot only, one of the second only
    sides, want = [], []
    for s, r, without in (("s1", "r1", new), ("s2", "r2", gone)):
        sides.append(AC.access_table(df.where(f"run_id = '{r}'"), people.where(f"snapshot_id = '{s}' and sid != '{without}'"),
                                     closure.where(f"snapshot_id = '{s}'")))
        want.append({(k[2], k[3]): v for k, v in expected(edges, aces).items() if k[:2] == (r, s) and k[2] != without})
    names = ["none", *AC.BUCKETS]
    diff = AC.access_diff(*sides)
    got = {(x.user_sid, x.folder_path): (x.bucket_before, x.bucket_after)
           for x in AC.rises_of(diff, *sides, people.where("principal_type != 'group'")).collect()}
    rises = {k: (names[want[0].get(k, 0)], names[v]) for k, v in want[1].items() if v > want[0].get(k, 0)}
    assert got == rises and any(k[0] == new for k in rises) and len({k[1] for k in rises}) > 3
    kinds = {x.holder_kind for x in diff.collect()}
    assert kinds == {"everyone", "class", "user"}
    evidence = {(x.user_sid, x.folder_path): x.matched_sid for x in AC.access_of(sides[1], people.where("principal_type != 'group'")).collect()}
    assert all(evidence[x.user_sid, x.folder_path] == x.matched_sid
               for x in AC.rises_of(diff, *sides, people.where("sid = 'u3'")).collect())


def test_summary_of_no_rows(spark):
    _, _, df, people, closure = frames(spark, 1)
    assert AC.access_summary(AC.access_table(df.limit(0), people, closure)).count() == 0
    assert AC.access_summary(AC.access_table(df, people.limit(0), closure)).count() == 0


@pytest.mark.parametrize("service", [True, False])
def test_blast_radius_of_acls(spark, service):
    edges, aces, df, people, closure = frames(spark, 3)
    groups = reach(edges, "s1")
    counted = [u for u in USERS if u not in ("u6", "u7") and (service or u != "u8")]
    per_acl = AC.acl_blast_radius(df, people, closure, "s1", exclude_service=not service)
    from permscope.operators.fingerprint import object_acl

    acl = {(r.run_id, r.folder_path): r.acl_fingerprint for r in object_acl(df).collect()}
    got = {(r.run_id, r.acl_fingerprint): (r.blast_radius_read, r.blast_radius_write) for r in per_acl.collect()}
    for (run, folder), fp in acl.items():
        want = []
        for k in (1, 2):
            sids = {a[2] for a in aces if a[0] == run and a[1] == folder and RANK[a[4]] >= k and (a[5] or "allow").lower() != "deny"}
            want.append(len([u for u in counted if ({u, *groups[u]} & sids) or set(WELL_KNOWN) & sids]))
        assert got.get((run, fp), (0, 0)) == tuple(want)


def test_two_snapshots_never_mix(spark):
    edges = spark.createDataFrame([("s1", "u", "g1"), ("s2", "u", "g2")], "snapshot_id string, member_sid string, group_sid string")
    aces = spark.createDataFrame([("r", "f", "g1", "n", "Read", "allow", False), ("r", "f", "g2", "n", "Write", "allow", False),
                                  ("q", "f", "g2", "n", "FullControl", "allow", False)], ACE_SCHEMA)
    users = spark.createDataFrame([("s1", "u"), ("s2", "u")], "snapshot_id string, sid string")
    got = {(r.run_id, r.snapshot_id): r.rights_bucket for r in ID.effective_access(aces, users, ID.membership_closure(edges)).collect()}
    assert got == {("r", "s1"): "read", ("r", "s2"): "write", ("q", "s2"): "fullcontrol"}
    people = spark.createDataFrame([("s1", "g1", "G", "group", True), ("s2", "g1", "H", "group", True), ("s2", "g2", "I", "group", True)],
                                   "snapshot_id string, sid string, samaccountname string, principal_type string, enabled boolean")
    found = {(r.snapshot_id, r.ace_sid): r.samaccountname for r in ID.sid_resolution(aces, people).collect()}
    assert found == {("s1", "g1"): "G", ("s1", "g2"): None, ("s2", "g1"): "H", ("s2", "g2"): "I"}
    assert [(r.snapshot_id, r.ace_sid) for r in ID.unresolved_sids(aces, people).collect()] == [("s1", "g2")]


def test_runs_never_mix_in_counts(spark):
    aces = spark.createDataFrame([(r, "f", "s", "n", "Read", "allow", False) for r in ("r1", "r2")], ACE_SCHEMA)
    assert duplicate_aces(aces).count() == 0
    assert sorted((r.run_id, r.ace_count) for r in folder_ace_counts(aces).collect()) == [("r1", 1), ("r2", 1)]


def shortest(edges, nodes):
    """(member, group) -> the smallest of the shortest chains."""
    out = {}
    for start in nodes:
        level, seen = {start: ()}, {start}
        while level:
            found = {}
            for x, chain in level.items():
                for m, g in edges:
                    if m == x and g not in seen:
                        found[g] = min(found.get(g, chain + (g,)), chain + (g,))
            out.update({(start, g): c for g, c in found.items()})
            seen |= set(found)
            level = found
    return out


@pytest.mark.parametrize("seed", range(4))
def test_chains_and_closure_on_random_graphs(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{k:02d}" for k in range(14)]
    edges = sorted({(rng.choice(nodes), rng.choice(nodes[4:])) for _ in range([8, 18, 30, 60][seed])})
    edges += [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(20)] + [("c020", "c017")] if seed % 2 else []
    nodes += [f"c{k:03d}" for k in range(21)]
    df = spark.createDataFrame([("s", m, g) for m, g in edges], "snapshot_id string, member_sid string, group_sid string")
    want = shortest(edges, nodes)
    got = {(r.member_sid, r.group_sid): tuple(r.chain) for r in ID.membership_chains(df).collect()}
    assert got == want
    pairs = {(r.member_sid, r.group_sid) for r in ID.membership_closure(df).collect()}
    assert pairs == set(want)
    with_self = {(r.member_sid, r.group_sid) for r in ID.membership_closure(df, include_self=True).collect()}
    loops = {n for n in nodes if any(m == n and (g == n or (g, n) in want) for m, g in edges)}
    assert with_self == set(want) | {(n, n) for n in loops}
    asked = spark.createDataFrame([(n,) for n in nodes[:5]], "sid string")
    assert {(r.member_sid, r.group_sid) for r in ID.membership_closure(df, members=asked).collect()} == {p for p in want if p[0] in nodes[:5]}
    assert {(r.member_sid, r.group_sid): tuple(r.chain) for r in ID.membership_chains(df, asked).collect()} == {
        p: c for p, c in want.items() if p[0] in nodes[:5]}


@pytest.mark.parametrize("seed", range(3))
def test_closure_follows_edge_changes(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{k:02d}" for k in range(12)]
    schema = "snapshot_id string, member_sid string, group_sid string"

    def frame(edges):
        return spark.createDataFrame([("s", m, g) for m, g in sorted(edges)], schema)

    def pairs(df):
        return {(r.member_sid, r.group_sid) for r in df.collect()}

    edges = {(rng.choice(nodes), rng.choice(nodes[3:])) for _ in range([9, 20, 40][seed])}
    closure = ID.membership_closure(frame(edges), include_self=True)
    for _ in range(2):
        gone = set(rng.sample(sorted(edges), len(edges) // 4))
        after = (edges - gone) | {(rng.choice(nodes), rng.choice(nodes[3:])) for _ in range(rng.randint(0, 4))}
        closure = ID.update_closure(closure, frame(edges), frame(after))
        rows = closure.collect()
        assert len(rows) == len({tuple(r) for r in rows})
        assert pairs(closure) == pairs(ID.membership_closure(frame(after), include_self=True))
        edges = after


def test_access_is_kept_by_acl_number(spark, monkeypatch):
    # fingerprints are 64 characters that no codec shortens: only the table of ACLs keeps them
    kept = []

    def keep(df):
        kept.append(df.localCheckpoint())
        return kept[-1]

    _, _, df, people, closure = frames(spark, 1)
    monkeypatch.setattr(AC, "checkpointed", keep)
    access = AC.access_table(df, people, closure)
    assert sum("acl_fingerprint" in x.columns for x in kept) == 2
    assert set(access.rows.columns) >= {"run_id", "acl_fingerprint", "folders"} and access.rows.count() == kept[-1].count()


def test_findings_with_radius_deal_rows_out_once_a_key(spark):
    from permscope.operators.fingerprint import findings_standard
    from permscope.operators.rules import apply_rules

    _, _, df, people, closure = frames(spark, 3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = findings_standard(apply_rules(df, keep=("run_id",)), df)
        out = AC.findings_with_radius(found, df, people, closure, "s1")
        plan = out._jdf.queryExecution().executedPlan().toString()
        wide = [x for x in plan.split("\n") if "Exchange hashpartitioning(ace_sid" in x]
        rest = plan[:plan.index(wide[0])]
        assert "Exchange hashpartitioning(coalesce(run_id" not in rest  # findings go by folder, then by SID
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert out.columns[-4:] == ["blast_radius_read", "blast_radius_write", "folder_blast_radius_read", "folder_blast_radius_write"]
    assert found.where("run_id is null and object_id is null").count() == 0  # a missing run id is a run of its own
