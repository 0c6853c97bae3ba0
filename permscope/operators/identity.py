"""Identity graph: closure, SID resolution, blast radius, effective access.

Inputs are two snapshot tables:

* principals(snapshot_id, sid, samaccountname, principal_type, enabled)
* membership_edges(snapshot_id, member_sid, group_sid)

``membership_closure`` works on the graph of groups alone, which is far smaller
than the memberships: path doubling (a round joins the pairs found so far with
themselves, so rounds grow with the logarithm of the nesting depth), and nodes
found to reach each other are merged into one, so a cycle is one node in the
later rounds and its pairs are written out once, at the end.  Users and other
members that nobody belongs to join the groups' closure once.  Each round is
``checkpoint()``-ed into the session's checkpoint folder
(``spark.checkpoint.dir``), which cuts lineage and survives executor loss.  A
very large group is a hot join key; AQE's skew join splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import bucket_rank, rights_bucket
from permscope.operators.runs import run_keys
from permscope.session import checkpointed

# Well-known SIDs in every user's security context —
# Everyone, Authenticated Users, BUILTIN\Users.
WELL_KNOWN_CONTEXT_SIDS = ("S-1-1-0", "S-1-5-11", "S-1-5-32-545")

SCOPE_NOTE = "snapshot, folder-level rights only"


def _edges(edges: DataFrame) -> DataFrame:
    return (edges.select("snapshot_id", "member_sid", "group_sid")
            .where("member_sid is not null and group_sid is not null").distinct())


def _reach(pairs: DataFrame) -> DataFrame:
    """All pairs (snapshot_id, a, b) with a path, from the edges ``pairs``."""
    key = "snapshot_id"
    now, merged = checkpointed(pairs), None   # merged: node -> the node that stands for it
    fresh = now                               # pairs that may be half of a cycle not yet seen
    while not fresh.isEmpty():
        back = now.select(key, F.col("a").alias("b"), F.col("b").alias("a"))
        both = fresh.where("a != b").join(back, [key, "a", "b"], "left_semi")
        if not both.isEmpty():
            ends = both.unionByName(both.select(key, F.col("a").alias("b"), F.col("b").alias("a")))
            stands = checkpointed(ends.groupBy(key, "a").agg(F.least("a", F.min("b")).alias("to")).where("a != to"))

            def moved(df: DataFrame, col: str) -> DataFrame:
                to = stands.select(key, F.col("a").alias(col), F.col("to").alias("_to"))
                return df.join(to, [key, col], "left").withColumn(col, F.coalesce("_to", col)).drop("_to")

            fresh = now = checkpointed(moved(moved(now, "a"), "b").select(key, "a", "b").distinct())
            new = stands.select(key, F.col("a").alias("node"), F.col("to").alias("rep"))
            merged = checkpointed(new if merged is None else
                                  moved(merged, "rep").unionByName(new.join(merged.select(key, "node"), [key, "node"], "left_anti")))
            continue
        step = now.select(key, "a", F.col("b").alias("mid")).join(now.select(key, F.col("a").alias("mid"), "b"), [key, "mid"])
        fresh = checkpointed(step.select(key, "a", "b").distinct().join(now, [key, "a", "b"], "left_anti"))
        now = now.unionByName(fresh)
    if merged is None:
        return now

    def spread(df: DataFrame, col: str) -> DataFrame:
        own = merged.select(key, F.col("rep").alias(col)).distinct().withColumn("_x", F.col(col))
        of = merged.select(key, F.col("rep").alias(col), F.col("node").alias("_x")).unionByName(own)
        return df.join(of, [key, col], "left").withColumn(col, F.coalesce("_x", col)).drop("_x")

    return checkpointed(spread(spread(now, "a"), "b").select(key, "a", "b").distinct())


def membership_closure(edges: DataFrame, include_self: bool = False, scope: DataFrame | None = None,
                       members: DataFrame | None = None) -> DataFrame:
    """All (snapshot_id, member_sid, group_sid) pairs with a membership path.

    ``scope`` (a DataFrame with a ``sid`` column) keeps only groups that are
    seen in ACLs; ``members`` (also ``sid``) asks for these members only.  Self
    pairs (from cycles) are dropped unless ``include_self``.
    """
    e = checkpointed(_edges(edges))
    groups = e.select("snapshot_id", F.col("group_sid").alias("member_sid")).distinct()
    nested = e.join(groups, ["snapshot_id", "member_sid"], "left_semi")  # edges between groups
    reach = _reach(nested.select("snapshot_id", F.col("member_sid").alias("a"), F.col("group_sid").alias("b")))
    among = reach.select("snapshot_id", F.col("a").alias("member_sid"), F.col("b").alias("group_sid"))
    plain = e.join(groups, ["snapshot_id", "member_sid"], "left_anti")
    if members is not None:
        asked = members.select(F.col("sid").alias("member_sid")).distinct()
        among, plain = among.join(asked, "member_sid", "left_semi"), plain.join(asked, "member_sid", "left_semi")
    above = plain.join(reach.select("snapshot_id", F.col("a").alias("group_sid"), F.col("b").alias("next")), ["snapshot_id", "group_sid"])
    above = above.select("snapshot_id", "member_sid", F.col("next").alias("group_sid"))
    closure = plain.unionByName(above).distinct().unionByName(among)
    if not include_self:
        closure = closure.where("member_sid != group_sid")
    if scope is not None:
        closure = closure.join(scope.select(F.col("sid").alias("group_sid")).distinct(), "group_sid", "left_semi")
    return checkpointed(closure.select("snapshot_id", "member_sid", "group_sid"))


def update_closure(closure: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The closure of the edges ``after``, from the one of the edges ``before`` (both with self pairs, one snapshot).

    Delete and rederive: pairs that a removed edge may have supported are taken
    out; those that what is left still supports come back, together with what
    added edges bring, by semi-naive rounds that only join new pairs.  The work
    follows the changes, not the size of the closure.  Columns: member_sid, group_sid.
    """
    def pairs(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.select(F.col("member_sid").alias(a), F.col("group_sid").alias(b)).where(
            f"{a} is not null and {b} is not null").distinct()

    old, new = checkpointed(pairs(before, "a", "b")), checkpointed(pairs(after, "a", "b"))
    known = checkpointed(pairs(closure, "a", "b"))
    removed = checkpointed(old.join(new, ["a", "b"], "left_anti").toDF("u", "v"))
    # every pair with a way over a removed edge: what reaches u (and u itself), to what v reaches (and v itself)
    up = removed.select("u", "v", F.col("u").alias("a")).unionByName(
        removed.join(known.select("a", F.col("b").alias("u")), "u").select("u", "v", "a"))
    doubt = up.select("a", F.col("v").alias("b")).unionByName(
        up.join(known.select(F.col("a").alias("v"), "b"), "v").select("a", "b")).distinct()
    doubt = checkpointed(doubt.join(known, ["a", "b"], "left_semi"))
    kept = checkpointed(known.join(doubt, ["a", "b"], "left_anti"))
    # pairs in doubt that two kept pairs still support, and the edges there are now
    two = (doubt.join(kept.select("a", F.col("b").alias("m")), "a")
           .join(kept.select(F.col("a").alias("m"), "b"), ["m", "b"], "left_semi").select("a", "b"))
    fresh = checkpointed(two.unionByName(new).distinct().join(kept, ["a", "b"], "left_anti"))
    parts = [kept]
    while not fresh.isEmpty():
        parts.append(fresh)
        now = parts[0]
        for p in parts[1:]:
            now = now.unionByName(p)
        left, right = fresh.select("a", F.col("b").alias("m")), fresh.select(F.col("a").alias("m"), "b")
        further = left.join(now.select(F.col("a").alias("m"), "b"), "m").select("a", "b").unionByName(
            now.select("a", F.col("b").alias("m")).join(right, "m").select("a", "b"))
        fresh = checkpointed(further.distinct().join(now, ["a", "b"], "left_anti"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.toDF("member_sid", "group_sid")


def membership_chains(edges: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """snapshot_id, member_sid, group_sid, depth, chain: how a member comes to be in a group.

    ``chain`` is the shortest way, from the first group to ``group_sid``; of
    equally short ways the smallest.  Breadth first over the groups, one round
    a level of nesting; members that nobody belongs to join the groups' chains
    once.  A way back to its own start is no membership.
    """
    e = checkpointed(_edges(edges))
    groups = e.select("snapshot_id", F.col("group_sid").alias("member_sid")).distinct()
    step = e.join(groups, ["snapshot_id", "member_sid"], "left_semi").where("member_sid != group_sid")
    pair = ["snapshot_id", "member_sid", "group_sid"]
    parts = [checkpointed(step.withColumn("chain", F.array("group_sid")))]
    while not parts[-1].isEmpty():
        seen = parts[0].select(*pair)
        for p in parts[1:]:
            seen = seen.unionByName(p.select(*pair))
        further = parts[-1].join(step.select("snapshot_id", F.col("member_sid").alias("group_sid"), F.col("group_sid").alias("next")),
                                 ["snapshot_id", "group_sid"]).where("next != member_sid")
        found = (further.select("snapshot_id", "member_sid", F.col("next").alias("group_sid"), F.concat("chain", F.array("next")).alias("chain"))
                 .groupBy(*pair).agg(F.min("chain").alias("chain")).join(seen, pair, "left_anti"))
        parts.append(checkpointed(found))
    among = parts[0]
    for p in parts[1:]:
        among = among.unionByName(p)
    plain = e.join(groups, ["snapshot_id", "member_sid"], "left_anti")
    if members is not None:
        asked = members.select(F.col("sid").alias("member_sid")).distinct()
        plain = plain.join(asked, "member_sid", "left_semi")
    above = plain.join(among.select("snapshot_id", F.col("member_sid").alias("group_sid"), F.col("group_sid").alias("next"), "chain"),
                       ["snapshot_id", "group_sid"])
    ways = plain.withColumn("chain", F.array("group_sid")).unionByName(
        above.select("snapshot_id", "member_sid", F.col("next").alias("group_sid"), F.concat(F.array("group_sid"), "chain").alias("chain")))
    best = ways.groupBy(*pair).agg(F.min(F.struct(F.size("chain").alias("depth"), "chain")).alias("x"))
    if members is not None:
        among = among.join(asked, "member_sid", "left_semi")
    return best.select(*pair, "x.depth", "x.chain").unionByName(among.select(*pair, F.size("chain").alias("depth"), "chain"))


def group_members(closure: DataFrame) -> DataFrame:
    """Inverse view: group -> every transitive member."""
    return closure.select("snapshot_id", "group_sid", "member_sid")


def acl_principal_scope(aces: DataFrame) -> DataFrame:
    """Distinct ACE SIDs (with one observed name) — the set to resolve."""
    return (aces.filter(F.col("ace_sid").isNotNull() & (F.col("ace_sid") != ""))
            .groupBy("ace_sid").agg(F.min("ace_name").alias("ace_name"), F.count(F.lit(1)).alias("ace_count")))


def sid_resolution(aces: DataFrame, principals: DataFrame) -> DataFrame:
    """Each ACE SID with its principal in each identity snapshot (null when unresolved there)."""
    scope = _per_snapshot(acl_principal_scope(aces), principals)
    p = principals.select("snapshot_id", F.col("sid").alias("ace_sid"), "samaccountname", "principal_type", "enabled")
    r = scope.join(p, ["snapshot_id", "ace_sid"], "left")
    return r.withColumn("resolved", F.col("principal_type").isNotNull())


def _per_snapshot(rows: DataFrame, principals: DataFrame) -> DataFrame:
    """``rows`` once for each snapshot of ``principals`` (snapshots are few: their names come to the driver)."""
    names = sorted(r["snapshot_id"] for r in principals.select("snapshot_id").distinct().collect())
    every = F.array(*map(F.lit, names)) if names else F.array(F.lit(None).cast("string"))
    return rows.withColumn("snapshot_id", F.explode(every))


def unresolved_sids(aces: DataFrame, principals: DataFrame) -> DataFrame:
    """ACE SIDs that a snapshot has no principal for, one row per snapshot."""
    scope = _per_snapshot(acl_principal_scope(aces), principals)
    return scope.join(principals.select("snapshot_id", F.col("sid").alias("ace_sid")), ["snapshot_id", "ace_sid"], "left_anti")


def blast_radius(principals: DataFrame, closure: DataFrame, exclude_service: bool = False) -> DataFrame:
    """Enabled users reachable through each principal.

    A user counts 1 when enabled (0 otherwise); a group counts its distinct
    enabled transitive user members (service accounts optional)."""
    users = principals.filter(F.col("principal_type").isin("user", "service") & F.col("enabled"))
    if exclude_service:
        users = users.filter(F.col("principal_type") == "user")
    u = users.select("snapshot_id", F.col("sid").alias("member_sid"))
    members = (closure.join(u, ["snapshot_id", "member_sid"], "left_semi")
               .groupBy("snapshot_id", "group_sid")
               .agg(F.countDistinct("member_sid").alias("members")))
    p = principals.select("snapshot_id", "sid", "principal_type", "enabled")
    out = p.join(members.withColumnRenamed("group_sid", "sid"), ["snapshot_id", "sid"], "left")
    is_user = F.col("principal_type").isin("user", "service")
    counted_user = F.col("enabled") & ((F.col("principal_type") == "user") | F.lit(not exclude_service))
    radius = F.when(is_user, F.when(counted_user, F.lit(1)).otherwise(F.lit(0))) \
        .otherwise(F.coalesce("members", F.lit(0)))
    out = out.select("snapshot_id", "sid", "principal_type", radius.cast("bigint").alias("blast_radius"))
    # well-known broad SIDs (Everyone, ...) reach every counted user
    wk = (u.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("blast_radius"))
          .select("snapshot_id", F.explode(F.array(*[F.lit(x) for x in WELL_KNOWN_CONTEXT_SIDS])).alias("sid"),
                  F.lit("well-known").alias("principal_type"), "blast_radius"))
    return out.unionByName(wk.join(p.select("snapshot_id", "sid"), ["snapshot_id", "sid"], "left_anti"))


def ace_blast_radius(aces: DataFrame, principals: DataFrame, closure: DataFrame,
                     snapshot_id: str, exclude_service: bool = False) -> DataFrame:
    """ACEs with their rights bucket and the blast radius of their principal."""
    br = (blast_radius(principals, closure, exclude_service)
          .filter(F.col("snapshot_id") == snapshot_id)
          .select(F.col("sid").alias("ace_sid"), "principal_type", "blast_radius"))
    a = aces.select("folder_path", "ace_name", "ace_sid", "ace_mask", "ace_type",
                    rights_bucket("ace_mask").alias("rights_bucket"))
    return a.join(br, "ace_sid", "left").withColumn("blast_radius", F.coalesce("blast_radius", F.lit(0)))


def top_blast_radius_writes(aces, principals, closure, snapshot_id: str, k: int = 20) -> DataFrame:
    r = ace_blast_radius(aces, principals, closure, snapshot_id)
    w = r.filter(F.col("rights_bucket").isin("write", "fullcontrol") & (F.lower(F.coalesce("ace_type", F.lit("allow"))) != "deny"))
    return (w.orderBy(F.desc("blast_radius"), F.asc_nulls_last("folder_path"), F.asc_nulls_last("ace_sid"),
                      F.asc_nulls_last("ace_mask"), F.asc_nulls_last("ace_name"))
            .limit(k).select("folder_path", "ace_name", "ace_sid", "ace_mask", "rights_bucket",
                             "principal_type", "blast_radius"))


def finding_principal(findings: DataFrame, principals: DataFrame, snapshot_id: str) -> DataFrame:
    """Findings with principal_type / principal_name of their SID."""
    p = (principals.filter(F.col("snapshot_id") == snapshot_id)
         .select(F.col("sid").alias("ace_sid"), "principal_type", F.col("samaccountname").alias("principal_name")))
    return findings.join(p, "ace_sid", "left")


def security_context(users: DataFrame, closure: DataFrame, well_known=WELL_KNOWN_CONTEXT_SIDS) -> DataFrame:
    """(snapshot_id, user_sid, context_sid, via) for each user: the user, every
    transitive group, and the well-known SIDs."""
    u = users.select("snapshot_id", F.col("sid").alias("user_sid"))
    own = u.select("snapshot_id", "user_sid", F.col("user_sid").alias("context_sid"), F.lit("self").alias("via"))
    groups = (closure.join(u.withColumnRenamed("user_sid", "member_sid"), ["snapshot_id", "member_sid"], "left_semi")
              .select("snapshot_id", F.col("member_sid").alias("user_sid"), F.col("group_sid").alias("context_sid"),
                      F.lit("group").alias("via")))
    wk = u.select("snapshot_id", "user_sid", F.explode(F.array(*[F.lit(s) for s in well_known])).alias("context_sid"),
                  F.lit("well-known").alias("via"))
    ctx = own.unionByName(groups).unionByName(wk)
    return ctx.groupBy("snapshot_id", "user_sid", "context_sid").agg(F.min("via").alias("via"))


def effective_access(aces: DataFrame, users: DataFrame, closure: DataFrame, min_right: str = "read") -> DataFrame:
    """(run, snapshot, user, folder) -> effective rights bucket with one evidence ACE.

    For some users; ``access.access_table`` answers for all of them.

    Canonical-order approximation on the bucket ladder none<read<write<full:
    an explicit deny of bucket b caps everything at b-1; an inherited deny
    caps inherited allows only (an explicit allow beats it).  The evidence is
    an allow ACE whose capped rank equals the effective one.  ACE types
    other than allow/deny count as allow and mark the row 'approximate'.
    """
    ctx = security_context(users, closure)
    runs = run_keys(aces)
    a = aces.select(
        *runs, "folder_path", "ace_sid", "ace_mask",
        F.lower(F.coalesce("ace_type", F.lit("allow"))).alias("t"),
        F.coalesce("ace_inherited", F.lit(False)).alias("inh"),
        bucket_rank(rights_bucket("ace_mask")).alias("rank"))
    j = a.join(ctx.select("snapshot_id", F.col("context_sid").alias("ace_sid"), "user_sid", "via"), "ace_sid")
    is_deny = F.col("t") == "deny"
    allow_explicit = F.when(~is_deny & ~F.col("inh"), F.col("rank"))
    allow_inherited = F.when(~is_deny & F.col("inh"), F.col("rank"))
    deny_explicit = F.when(is_deny & ~F.col("inh") & (F.col("rank") > 0), F.col("rank"))
    deny_inherited = F.when(is_deny & F.col("inh") & (F.col("rank") > 0), F.col("rank"))
    g = j.groupBy(*runs, "snapshot_id", "user_sid", "folder_path").agg(
        F.coalesce(F.max(allow_explicit), F.lit(0)).alias("ea"),
        F.coalesce(F.max(allow_inherited), F.lit(0)).alias("ia"),
        F.coalesce(F.min(deny_explicit), F.lit(4)).alias("ed"),
        F.coalesce(F.min(deny_inherited), F.lit(4)).alias("idn"),
        F.bool_or(~F.col("t").isin("allow", "deny")).alias("approx"),
        # the highest allow of each kind; ties broken on the ACE fields so
        # the pick is deterministic
        F.max(F.when(~is_deny & ~F.col("inh"), F.struct("rank", "ace_sid", "ace_mask", "via"))).alias("best_e"),
        F.max(F.when(~is_deny & F.col("inh"), F.struct("rank", "ace_sid", "ace_mask", "via"))).alias("best_i"))
    from_explicit = F.least("ea", F.col("ed") - 1)
    eff = F.greatest(from_explicit, F.least("ia", F.col("ed") - 1, F.col("idn") - 1))
    # evidence: the allow that survives its denies with the effective rank (explicit first)
    g = g.withColumn("ev", F.when(from_explicit == eff, F.col("best_e")).otherwise(F.col("best_i")))
    names = F.array(F.lit("none"), F.lit("read"), F.lit("write"), F.lit("fullcontrol"))
    out = g.withColumn("eff", eff).filter(F.col("eff") >= bucket_rank(F.lit(min_right)))
    return out.select(
        *runs, "snapshot_id", "user_sid", "folder_path",
        F.try_element_at(names, (F.col("eff") + 1).cast("int")).alias("rights_bucket"),
        F.col("eff").alias("rights_rank"),
        F.col("ev.ace_sid").alias("matched_sid"), F.col("ev.ace_mask").alias("matched_mask"),
        F.col("ev.via").alias("via"),
        F.when(F.col("approx"), F.lit("approximate")).otherwise(F.lit("exact")).alias("semantics"),
        F.lit(SCOPE_NOTE).alias("scope"))


def effective_access_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Folders where a user's effective rights rose between two runs."""
    b = before.select("user_sid", "folder_path", F.col("rights_rank").alias("rank_before"),
                      F.col("rights_bucket").alias("bucket_before"))
    a = after.select("user_sid", "folder_path", F.col("rights_rank").alias("rank_after"),
                     F.col("rights_bucket").alias("bucket_after"), "matched_sid", "matched_mask")
    b = b.withColumnsRenamed({"user_sid": "_u", "folder_path": "_f"})
    j = a.join(b, F.col("user_sid").eqNullSafe(F.col("_u")) & F.col("folder_path").eqNullSafe(F.col("_f")), "left")
    return (j.filter(F.col("rank_after") > F.coalesce("rank_before", F.lit(0)))
            .select("user_sid", "folder_path", F.coalesce("bucket_before", F.lit("none")).alias("bucket_before"),
                    "bucket_after", "matched_sid", "matched_mask"))

