"""Effective access and blast radius of all users, without a user x folder table.

Users that share a context, and folders that share an ACL, need no separate
answers.  Access is evaluated once for each pair of

* an ACL and the well-known SIDs that every user carries (``everyone``),
* an ACL and a *class* of users, one for each distinct set of groups that
  ACLs mention (``class``), where the ACL names one of the class's groups,
* an ACL and a user, where the ACL names the user's own SID (``user``).

Each level contains the ACEs of the one before, so for a user and an ACL the
most specific row there is decides.  Folder counts follow by addition: what
``everyone`` gets, plus what the class's own ACLs change about it, plus what the
user's own ACLs change about that.  The tables grow with the ACL lines and the
distinct group sets, not with users x folders.

A class is named by a hash over its groups that partial aggregation can build,
so no user's groups are collected; its groups are looked up through one member.
``run_id`` and ``snapshot_id`` are part of every key: rights of one run or
identity snapshot never reach another one.

Inside, an ACL is a number (``acl``): its fingerprint is 64 characters that no
codec shortens, and would be most of what the shuffles write.  An ACL's lines
are those of one of its folders.

The rights model is that of ``identity.effective_access``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import bucket_rank, normalize_mask, rights_bucket
from permscope.operators.fingerprint import _col, object_acl
from permscope.operators.identity import SCOPE_NOTE, WELL_KNOWN_CONTEXT_SIDS
from permscope.session import checkpointed

BUCKETS = ("read", "write", "fullcontrol")
NO_GROUPS = "none"  # class of the users without a group that ACLs mention


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null matching null; the keys of ``left`` stay."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = None
    for k in keys:
        one = left[k].eqNullSafe(right[f"_right_{k}"])
        same = one if same is None else same & one
    return left.join(right, same, how).drop(*[f"_right_{k}" for k in keys])


def is_user(principal_type: Column) -> Column:
    return principal_type.isin("user", "service")


@dataclass
class UserClasses:
    """``users``: snapshot_id, user_sid, class_id; ``groups``: snapshot_id, class_id, group_sid."""

    users: DataFrame
    groups: DataFrame


def user_classes(principals: DataFrame, closure: DataFrame, scope: DataFrame) -> UserClasses:
    """Classes of users with equal groups among the SIDs of ``scope`` (column ``sid``)."""
    users = principals.where(is_user(F.col("principal_type"))).select("snapshot_id", F.col("sid").alias("user_sid")).distinct()
    held = (closure.join(scope.select(F.col("sid").alias("group_sid")).distinct(), "group_sid", "left_semi")
            .where("member_sid != group_sid").select("snapshot_id", F.col("member_sid").alias("user_sid"), "group_sid"))
    held = held.join(users, ["snapshot_id", "user_sid"], "left_semi")
    digest = F.md5("group_sid")
    part = [F.sum(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint")).cast("string") for i in range(4)]
    named = held.groupBy("snapshot_id", "user_sid").agg(
        F.sha2(F.concat_ws(":", F.count("*").cast("string"), *part), 256).alias("class_id"))
    users = checkpointed(users.join(named, ["snapshot_id", "user_sid"], "left")
                         .withColumn("class_id", F.coalesce("class_id", F.lit(NO_GROUPS))))
    one = users.where(F.col("class_id") != NO_GROUPS).groupBy("snapshot_id", "class_id").agg(F.min("user_sid").alias("user_sid"))
    groups = held.join(one, ["snapshot_id", "user_sid"]).select("snapshot_id", "class_id", "group_sid")
    return UserClasses(users, checkpointed(groups))


@dataclass
class AclLines:
    """``folders``: run_id, folder_path, acl_fingerprint; ``acls``: acl, run_id, acl_fingerprint, folders (their number);
    ``lines``: acl, run_id, folders, ace_sid, ace_mask, t, inh, rank."""

    folders: DataFrame
    acls: DataFrame
    lines: DataFrame


def acl_lines(aces: DataFrame) -> AclLines:
    """The different ACLs of each run, numbered, with the lines of one folder each."""
    folders = checkpointed(object_acl(aces).select("run_id", "folder_path", "acl_fingerprint"))
    one = folders.groupBy("run_id", "acl_fingerprint").agg(F.min("folder_path").alias("folder_path"), F.count("*").alias("folders"))
    acls = checkpointed(one.withColumn("acl", F.monotonically_increasing_id()))
    kind = F.lower(F.coalesce(_col(aces, "ace_type"), F.lit("")))
    rows = aces.select(_col(aces, "run_id").alias("run_id"), "folder_path", F.coalesce(_col(aces, "ace_sid"), F.lit("")).alias("ace_sid"),
                       normalize_mask(_col(aces, "ace_mask")).alias("ace_mask"), F.when(kind == "", "allow").otherwise(kind).alias("t"),
                       F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False)).alias("inh"))
    rows = null_safe_join(rows, acls.select("run_id", "folder_path", "acl", "folders"), ["run_id", "folder_path"])
    lines = rows.select("acl", "run_id", "folders", "ace_sid", "ace_mask", "t", "inh", bucket_rank(rights_bucket("ace_mask")).alias("rank"))
    return AclLines(folders, acls.select("acl", "run_id", "acl_fingerprint", "folders"), checkpointed(lines))


_STATE = ["ea", "ia", "ed", "idn", "approx", "best_e", "best_i"]
_ACL = ["acl", "run_id", "folders"]  # the number, and what follows from it


def _state(rows: DataFrame, keys: list[str], via: str) -> DataFrame:
    """The extremes that decide access, of each group of ACL lines."""
    deny, inherited = F.col("t") == "deny", F.col("inh")
    evidence = F.struct("rank", "ace_sid", "ace_mask", F.lit(via).alias("via"))
    return rows.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(~deny & ~inherited, F.col("rank"))), F.lit(0)).alias("ea"),
        F.coalesce(F.max(F.when(~deny & inherited, F.col("rank"))), F.lit(0)).alias("ia"),
        F.coalesce(F.min(F.when(deny & ~inherited & (F.col("rank") > 0), F.col("rank"))), F.lit(4)).alias("ed"),
        F.coalesce(F.min(F.when(deny & inherited & (F.col("rank") > 0), F.col("rank"))), F.lit(4)).alias("idn"),
        F.bool_or(~F.col("t").isin("allow", "deny")).alias("approx"),
        F.max(F.when(~deny & ~inherited, evidence)).alias("best_e"),
        F.max(F.when(~deny & inherited, evidence)).alias("best_i"))


def _effective() -> Column:
    return F.greatest(F.least("ea", F.col("ed") - 1), F.least("ia", F.col("ed") - 1, F.col("idn") - 1))


def _below(rows: DataFrame, holders: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """``rows`` with the state (``_below``) of the first of ``holders`` (state, keys) that has one."""
    for k, (df, keys) in enumerate(holders):
        state = df.select(*keys, F.struct(*_STATE, "rank").alias(f"_below{k}"))
        rows = rows.join(state, keys, "left") if keys == ["acl"] else null_safe_join(rows, state, keys, "left")
    names = [f"_below{k}" for k in range(len(holders))]
    return rows.withColumn("_below", F.coalesce(*names)).drop(*names)


def _over(rows: DataFrame, *holders: tuple[DataFrame, list[str]]) -> DataFrame:
    """``rows`` with the state of the less specific holder taken in, and the rank that it alone gives."""
    j = _below(rows, list(holders))
    j = j.withColumns({**{f"_{c}": F.col(f"_below.{c}") for c in _STATE}, "rank_below": F.col("_below.rank")}).drop("_below")
    merged = {c: (F.least if c in ("ed", "idn") else F.greatest)(c, F.coalesce(f"_{c}", c)) for c in _STATE if c not in ("best_e", "best_i")}
    merged |= {c: F.greatest(F.col(c), F.col(f"_{c}")) for c in ("best_e", "best_i")}
    merged["rank_below"] = F.coalesce("rank_below", F.lit(0))
    return j.withColumns(merged).drop(*(f"_{c}" for c in _STATE)).withColumn("rank", _effective())


@dataclass
class AccessTable:
    """``ranked``: one row per holder and ACL; ``users``: the holders of each user; ``acls``: the ACLs and their folders."""

    ranked: DataFrame
    users: DataFrame
    acls: AclLines

    @property
    def rows(self) -> DataFrame:
        """``ranked`` with the ACL's fingerprint in place of its number."""
        named = self.ranked.join(self.acls.acls.select("acl", "acl_fingerprint"), "acl")
        return named.select("run_id", "snapshot_id", "holder_kind", "holder", "acl_fingerprint", *_SHOWN, "folders")

    @property
    def folders(self) -> DataFrame:
        return self.acls.folders.select("run_id", "acl_fingerprint", "folder_path")


_LEVEL = {"everyone": 0, "class": 1, "user": 2}
_SHOWN = ["rights_rank", "rank_below", "rights_bucket", "matched_sid", "matched_mask", "via", "semantics", "scope"]


def access_table(aces: DataFrame, principals: DataFrame, closure: DataFrame) -> AccessTable:
    """Effective access of every user principal, by holder and ACL.

    ``rows``: run_id, snapshot_id (null for ``everyone``), holder_kind, holder,
    acl_fingerprint, rights_rank, rank_below (what the less specific holders give),
    rights_bucket, matched_sid, matched_mask, via, semantics, scope, folders.
    """
    acls = acl_lines(aces)
    lines = acls.lines
    classes = user_classes(principals, closure, lines.select(F.col("ace_sid").alias("sid")))
    base = _state(lines.where(F.col("ace_sid").isin(*WELL_KNOWN_CONTEXT_SIDS)), _ACL, "well-known").withColumn("rank", _effective())
    base = checkpointed(base.withColumn("rank_below", F.lit(0)))

    known = ~F.col("ace_sid").isin(*WELL_KNOWN_CONTEXT_SIDS)
    of_class = lines.where(known).join(classes.groups.withColumnRenamed("group_sid", "ace_sid"), "ace_sid")
    group = checkpointed(_over(_state(of_class, ["snapshot_id", "class_id", *_ACL], "group"), (base, ["acl"])))

    # grouped on the join's key, so a shuffled join needs no second shuffle
    own = lines.where(known).join(classes.users.withColumnRenamed("user_sid", "ace_sid"), "ace_sid")
    own = _state(own.withColumn("_sid", F.col("ace_sid")), ["snapshot_id", "_sid", "class_id", *_ACL], "self")
    # below a user's own lines: the class's row if there is one, else everyone's
    own = _over(own, (group, ["snapshot_id", "class_id", "acl"]), (base, ["acl"]))

    names = F.array(F.lit("none"), *map(F.lit, BUCKETS))
    evidence = F.when(F.least("ea", F.col("ed") - 1) == F.col("rank"), F.col("best_e")).otherwise(F.col("best_i"))

    def shown(df: DataFrame, kind: str, holder: Column, snapshot: Column) -> DataFrame:
        return df.withColumn("ev", evidence).select(
            *_ACL, snapshot.cast("string").alias("snapshot_id"), F.lit(kind).alias("holder_kind"), holder.alias("holder"),
            F.col("rank").alias("rights_rank"), "rank_below",
            F.element_at(names, (F.col("rank") + 1).cast("int")).alias("rights_bucket"),
            F.when(F.col("rank") > 0, F.col("ev.ace_sid")).alias("matched_sid"),
            F.when(F.col("rank") > 0, F.col("ev.ace_mask")).alias("matched_mask"),
            F.when(F.col("rank") > 0, F.col("ev.via")).alias("via"),
            F.when(F.col("approx"), "approximate").otherwise("exact").alias("semantics"), F.lit(SCOPE_NOTE).alias("scope"))

    ranked = (shown(base, "everyone", F.lit("everyone"), F.lit(None))
              .unionByName(shown(group, "class", F.col("class_id"), F.col("snapshot_id")))
              .unionByName(shown(own, "user", F.col("_sid"), F.col("snapshot_id"))))
    return AccessTable(checkpointed(ranked), classes.users, acls)


def access_summary(access: AccessTable) -> DataFrame:
    """run_id, snapshot_id, user_sid, rights_bucket, folders: for every user, one row per run and bucket."""
    def change(name: str, rank: int) -> Column:
        gain = (F.col("rights_rank") == rank).cast("long") - (F.col("rank_below") == rank).cast("long")
        return F.sum(gain * F.col("folders")).alias(name)

    counts = [change(b, k + 1) for k, b in enumerate(BUCKETS)]
    rows = access.ranked
    # one row per run: the driver hands it to every user of that run
    runs = rows.groupBy("run_id").agg(*[F.sum(F.when((F.col("holder_kind") == "everyone") & (F.col("rights_rank") == k + 1), F.col("folders"))
                                              .otherwise(0)).alias(b) for k, b in enumerate(BUCKETS)]).collect()
    if not runs:
        return access.users.limit(0).select(F.lit("").alias("run_id"), "snapshot_id", "user_sid", F.lit("").alias("rights_bucket"),
                                            F.lit(0).cast("long").alias("folders"))
    every = F.array(*(F.struct(F.lit(r["run_id"]).cast("string").alias("run_id"),
                               *(F.lit(r[b]).cast("long").alias(b) for b in BUCKETS)) for r in runs))
    users = access.users.withColumn("x", F.explode(every)).select("snapshot_id", "user_sid", "class_id", "x.*")
    by_class = rows.where("holder_kind = 'class'").groupBy("run_id", "snapshot_id", F.col("holder").alias("class_id")).agg(*counts)
    by_user = rows.where("holder_kind = 'user'").groupBy("run_id", "snapshot_id", F.col("holder").alias("user_sid")).agg(*counts)
    j = users
    for extra, keys, tag in ((by_class, ["run_id", "snapshot_id", "class_id"], "c"), (by_user, ["run_id", "snapshot_id", "user_sid"], "u")):
        j = null_safe_join(j, extra.withColumnsRenamed({b: f"{tag}_{b}" for b in BUCKETS}), keys, "left")
    total = [F.struct(F.lit(b).alias("rights_bucket"), (F.col(b) + F.coalesce(f"c_{b}", F.lit(0)) + F.coalesce(f"u_{b}", F.lit(0)))
                      .alias("folders")) for b in BUCKETS]
    return j.select("run_id", "snapshot_id", "user_sid", F.inline(F.array(*total)))


def access_of(access: AccessTable, users: DataFrame, min_right: str = "read") -> DataFrame:
    """The folders of some ``users`` (snapshot_id, sid), one row per run, user and folder, with the deciding ACE."""
    asked = null_safe_join(access.users, users.select("snapshot_id", F.col("sid").alias("user_sid")).distinct(), ["snapshot_id", "user_sid"], "left_semi")
    holders = asked.select("snapshot_id", "user_sid", F.inline(F.array(*(
        F.struct(F.lit(kind).alias("holder_kind"), F.coalesce(holder, F.lit("")).alias("holder"))
        for kind, holder in (("everyone", F.lit("everyone")), ("class", F.col("class_id")), ("user", F.col("user_sid")))))))
    rows = access.rows.withColumnRenamed("snapshot_id", "row_snapshot")
    found = holders.join(rows, ["holder_kind", "holder"]).where("row_snapshot is null or row_snapshot = snapshot_id")
    level = F.lit(-1)
    for kind, k in _LEVEL.items():
        level = F.when(F.col("holder_kind") == kind, k).otherwise(level)
    fields = ["rights_rank", "rights_bucket", "matched_sid", "matched_mask", "via", "semantics", "scope"]
    best = found.groupBy("run_id", "snapshot_id", "user_sid", "acl_fingerprint").agg(
        F.max_by(F.struct(*fields), level).alias("x")).where(F.col("x.rights_rank") >= bucket_rank(F.lit(min_right)))
    return (null_safe_join(best, access.folders, ["run_id", "acl_fingerprint"])
            .select("run_id", "snapshot_id", "user_sid", "folder_path", "x.*"))


def _who(before: AccessTable, after: AccessTable) -> DataFrame:
    """user_sid, class_before (null: no user then), class_after of the users of ``after``."""
    was = before.users.select("user_sid", F.col("class_id").alias("class_before"))
    return after.users.select("user_sid", F.col("class_id").alias("class_after")).join(was, "user_sid", "left")


def _class_holder() -> Column:
    return F.concat_ws(">", F.coalesce("class_before", F.lit("new")), "class_after")


def access_diff(before: AccessTable, after: AccessTable) -> DataFrame:
    """Where effective access rose between two runs, folder by folder (each table of one run and snapshot).

    The two tables are joined on folder and user, by the holders they are made
    of: ``everyone`` (``new`` for users whom only ``after`` knows), users that
    moved from one class to another (or stayed), single users.  As in a table, the most specific row of a
    user and a folder decides; rows that neither rise nor hide a rise of a less
    specific holder (``rose`` is false there) are left out.  Columns:
    holder_kind, holder, folder_path, bucket_before, bucket_after, rose,
    matched_sid, matched_mask (the ACE that decides now).
    """
    who = _who(before, after)
    moves = checkpointed(who.select("class_before", "class_after").distinct().withColumn("move", F.monotonically_increasing_id()))
    who = checkpointed(null_safe_join(who, moves, ["class_before", "class_after"]).select("user_sid", "move", F.col("class_before").isNull().alias("new")))

    def places(t: AccessTable) -> DataFrame:
        return checkpointed(null_safe_join(t.acls.folders, t.acls.acls.select("acl", "run_id", "acl_fingerprint"), ["run_id", "acl_fingerprint"])
                            .select("acl", "folder_path"))

    sides = [(t.ranked, places(t)) for t in (before, after)]
    evidence = F.struct(F.col("rights_rank").alias("rank"), "matched_sid", "matched_mask")

    def both(kind: str, keys: list[str], of=lambda df, side: df) -> DataFrame:
        """Rank before (``ra``) and what is there after (``b``), null without a row of that kind."""
        parts = []
        for side, (rows, place) in enumerate(sides):
            r = of(rows.where(F.col("holder_kind") == kind), side).join(place, "acl")
            none = F.lit(None)
            parts.append(r.select(*keys, (none.cast("int") if side else F.col("rights_rank")).alias("ra"),
                                  (evidence if side else none.cast("struct<rank:int,matched_sid:string,matched_mask:string>")).alias("b")))
        return parts[0].unionByName(parts[1]).groupBy(*keys).agg(F.max("ra").alias("ra"), F.max("b").alias("b"))

    def moved(df: DataFrame, side: int) -> DataFrame:
        m = moves.select("move", F.col("class_after" if side else "class_before").alias("holder"))
        return df.join(m, "holder")

    every = checkpointed(both("everyone", ["folder_path"]).select("folder_path", F.coalesce("ra", F.lit(0)).alias("_ea"), F.col("b").alias("_eb")))
    at = F.coalesce("_eb.rank", F.lit(0))
    every_rose = at > F.when(F.col("new"), 0).otherwise(F.coalesce("_ea", F.lit(0)))

    group = null_safe_join(both("class", ["folder_path", "move"], moved), every, ["folder_path"], "left")
    group = group.join(moves.select("move", F.col("class_before").isNull().alias("new"), _class_holder().alias("holder")), "move")
    group = checkpointed(group.select(
        "folder_path", "move", "holder", F.when(F.col("new"), 0).otherwise(F.coalesce("ra", "_ea", F.lit(0))).alias("_ca"),
        F.coalesce("b", "_eb").alias("_cb"), F.coalesce(every_rose, F.lit(False)).alias("below")))

    user = both("user", ["folder_path", "user_sid"], lambda df, side: df.withColumnRenamed("holder", "user_sid")).join(who, "user_sid")
    user = null_safe_join(user, group.drop("holder", "below"), ["folder_path", "move"], "left")
    user = null_safe_join(user, every, ["folder_path"], "left")
    group_rose = F.coalesce("_cb.rank", F.lit(0)) > F.col("_ca")
    user = user.select("folder_path", F.col("user_sid").alias("holder"), F.when(F.col("new"), 0).otherwise(F.coalesce("ra", "_ca", "_ea", F.lit(0))).alias("ra"),
                       F.coalesce("b", "_cb", "_eb").alias("b"), F.coalesce(group_rose, every_rose, F.lit(False)).alias("below"))

    # at most two rows: whether there are users of each sort
    sorts = F.array(*(F.lit(r["new"]) for r in who.select("new").distinct().collect())).cast("array<boolean>")
    first = every.withColumn("new", F.explode(sorts)).select(
        "folder_path", F.when(F.col("new"), "new").otherwise("everyone").alias("holder"), F.when(F.col("new"), 0).otherwise(F.col("_ea")).alias("ra"),
        F.col("_eb").alias("b"), F.lit(False).alias("below"))
    group = group.select("folder_path", "holder", F.col("_ca").alias("ra"), F.col("_cb").alias("b"), "below")
    names = F.array(F.lit("none"), *map(F.lit, BUCKETS))
    out = None
    for kind, df in (("everyone", first), ("class", group), ("user", user)):
        df = df.withColumns({"holder_kind": F.lit(kind), "rb": F.coalesce("b.rank", F.lit(0))}).withColumn("rose", F.col("rb") > F.col("ra"))
        df = df.where(F.col("rose") | F.col("below"))
        out = df if out is None else out.unionByName(df)
    return out.select("holder_kind", "holder", "folder_path", F.element_at(names, (F.col("ra") + 1).cast("int")).alias("bucket_before"),
                      F.element_at(names, (F.col("rb") + 1).cast("int")).alias("bucket_after"), "rose", "b.matched_sid", "b.matched_mask")


def rises_of(diff: DataFrame, before: AccessTable, after: AccessTable, users: DataFrame) -> DataFrame:
    """user_sid, folder_path, bucket_before, bucket_after, matched_sid, matched_mask: the rises of some ``users`` (sid)."""
    who = _who(before, after).join(users.select(F.col("sid").alias("user_sid")).distinct(), "user_sid", "left_semi")
    first = F.when(F.col("class_before").isNull(), "new").otherwise("everyone")
    holders = who.select("user_sid", F.inline(F.array(*(F.struct(F.lit(kind).alias("holder_kind"), holder.alias("holder"), F.lit(k).alias("level"))
                                                        for k, (kind, holder) in enumerate((("everyone", first), ("class", _class_holder()), ("user", F.col("user_sid"))))))))
    fields = ["bucket_before", "bucket_after", "rose", "matched_sid", "matched_mask"]
    best = holders.join(diff, ["holder_kind", "holder"]).groupBy("user_sid", "folder_path").agg(F.max_by(F.struct(*fields), "level").alias("x"))
    return best.where("x.rose").select("user_sid", "folder_path", "x.*").drop("rose")


def acl_blast_radius(aces: DataFrame, principals: DataFrame, closure: DataFrame, snapshot_id: str,
                     exclude_service: bool = False) -> DataFrame:
    """run_id, acl_fingerprint, blast_radius_read, blast_radius_write: distinct enabled users that an ACL's
    allow entries reach with at least that right (no row for an ACL without such entries)."""
    acls = acl_lines(aces)
    radius = _acl_radius(acls, principals, closure, snapshot_id, exclude_service)
    return acls.acls.select("acl", "run_id", "acl_fingerprint").join(radius, "acl").drop("acl")


def _acl_radius(acls: AclLines, principals: DataFrame, closure: DataFrame, snapshot_id: str, exclude_service: bool) -> DataFrame:
    """acl, blast_radius_read, blast_radius_write.

    Users are counted by class and weight: an ACL with a well-known SID reaches
    all of them; else the classes its groups reach, plus the users named
    themselves whose class is not reached.
    """
    counted = principals.where((F.col("snapshot_id") == snapshot_id) & is_user(F.col("principal_type")) & F.col("enabled"))
    if exclude_service:
        counted = counted.where("principal_type = 'user'")
    lines = acls.lines.where("t != 'deny' and rank > 0")
    grants = checkpointed(lines.groupBy("acl", "ace_sid").agg(F.max("rank").alias("rank")))
    classes = user_classes(counted, closure.where(F.col("snapshot_id") == snapshot_id), grants.select(F.col("ace_sid").alias("sid")))
    weight = classes.users.groupBy("class_id").agg(F.count("*").alias("weight"))
    whole = classes.users.count()
    known = F.col("ace_sid").isin(*WELL_KNOWN_CONTEXT_SIDS)
    acl = ["acl"]
    everyone = grants.where(known).groupBy(*acl).agg(F.max("rank").alias("every"))
    reached = (grants.where(~known).join(classes.groups.withColumnRenamed("group_sid", "ace_sid"), "ace_sid")
               .groupBy(*acl, "class_id").agg(F.max("rank").alias("rank")))
    by_class = reached.join(weight, "class_id").select(*acl, "rank", "weight")
    own = grants.where(~known).join(classes.users.withColumn("ace_sid", F.col("user_sid")), "ace_sid").select(*acl, "class_id", "rank")
    own = own.join(reached.withColumnRenamed("rank", "class_rank"), [*acl, "class_id"], "left")
    # a named user adds to a right that the user's class does not reach
    single = own.select(*acl, "rank", F.coalesce("class_rank", F.lit(0)).alias("class_rank"))
    groups = by_class.groupBy(*acl).agg(*[F.sum(F.when(F.col("rank") >= k, F.col("weight")).otherwise(0)).alias(f"g_{n}")
                                          for n, k in (("read", 1), ("write", 2))])
    named = single.groupBy(*acl).agg(*[F.sum(((F.col("rank") >= k) & (F.col("class_rank") < k)).cast("long")).alias(f"u_{n}")
                                       for n, k in (("read", 1), ("write", 2))])
    out = grants.select(*acl).distinct()
    for part in (everyone, groups, named):
        out = out.join(part, acl, "left")

    def total(name: str, k: int) -> Column:
        some = F.coalesce(f"g_{name}", F.lit(0)) + F.coalesce(f"u_{name}", F.lit(0))
        return F.when(F.col("every") >= k, F.lit(whole)).otherwise(some).cast("long").alias(f"blast_radius_{name}")

    return out.select(*acl, total("read", 1), total("write", 2))


def findings_with_radius(findings: DataFrame, aces: DataFrame, principals: DataFrame, closure: DataFrame, snapshot_id: str,
                         exclude_service: bool = False) -> DataFrame:
    """Standard findings with their principal, the users that its right reaches, and those of the whole folder.

    ``blast_radius_read`` / ``_write``: enabled users behind the finding's SID if
    its mask grants at least that right (0 otherwise, as for an unknown SID);
    ``folder_blast_radius_*``: distinct enabled users over all allow entries of the folder.
    """
    from permscope.operators.identity import blast_radius

    radius = (blast_radius(principals, closure, exclude_service).where(F.col("snapshot_id") == snapshot_id)
              .select(F.col("sid").alias("ace_sid"), F.col("blast_radius").alias("_radius")))
    who = (principals.where(F.col("snapshot_id") == snapshot_id)
           .select(F.col("sid").alias("ace_sid"), "principal_type", F.col("samaccountname").alias("principal_name")))
    acls = acl_lines(aces)
    per_acl = acls.acls.select("acl", "run_id", "acl_fingerprint").join(_acl_radius(acls, principals, closure, snapshot_id, exclude_service), "acl")
    folder = null_safe_join(acls.folders, per_acl.drop("acl"), ["run_id", "acl_fingerprint"], "left")
    folder = folder.select("run_id", F.coalesce("folder_path", F.lit("")).alias("folder_path"),
                           *(F.coalesce(f"blast_radius_{n}", F.lit(0)).alias(f"folder_blast_radius_{n}") for n in ("read", "write")))
    rank = bucket_rank(rights_bucket("ace_mask"))
    # first the folders: findings_standard joined on the same keys, so its rows need not be dealt out again;
    # written, so that the shuffles of scoring are gone before the rows go by SID
    j = checkpointed(null_safe_join(findings, folder, ["run_id", "folder_path"], "left"))
    j = j.join(radius, "ace_sid", "left").join(who, "ace_sid", "left")
    j = j.withColumns({f"blast_radius_{n}": F.when(rank >= k, F.coalesce("_radius", F.lit(0))).otherwise(0).cast("long")
                       for n, k in (("read", 1), ("write", 2))}).drop("_radius")
    of_folder = [f"folder_blast_radius_{n}" for n in ("read", "write")]
    return j.select(*[c for c in j.columns if c not in of_folder], *of_folder)
