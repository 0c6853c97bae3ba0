"""Finders: targeted ACE searches and per-folder presence checks.

All are filters / aggregations over the ACE table.  Per-folder presence
tests ("no ACE of the folder is an admin with FullControl") are
``groupBy(folder).agg(bool_or(...))`` — partial aggregation keeps a hot
folder cheap; nothing is collected per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import high_perm_bitmask, is_full_control
from permscope.functions.names import resolve_name, resolve_name_or_raw, resolve_name_wide
from permscope.functions.paths import valid_folder
from permscope.functions.patterns import Pattern, any_hits, classify, hits
from permscope.functions.predicates import (ADMIN_PATTERNS_FULL, ADMIN_PATTERNS_SENSITIVE,
                                            is_admin_name, is_broad_identity, is_everyone,
                                            match_keyword_group)
from permscope.operators.runs import run_keys
from permscope.sources.ruleset import Ruleset, load_ruleset

# Fallback targets of the broad-permission finder.
DEFAULT_TARGETS = ("Domain Users", "Everyone", "BUILTIN\\Users")


def _col(df: DataFrame, name: str, typ: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def _with_res_name(aces: DataFrame) -> DataFrame:
    return aces.withColumn("res_name", resolve_name(_col(aces, "ace_name"), _col(aces, "ace_raw")))


def everyone_full_control(aces: DataFrame) -> DataFrame:
    """ACE rows where Everyone (name or S-1-1-0) holds FullControl."""
    a = _with_res_name(aces).filter(valid_folder("folder_path"))
    return (a.filter(is_everyone("res_name") & is_full_control("ace_mask"))
            .select(F.trim("folder_path").alias("folder_path"), F.col("res_name").alias("ace_name"),
                    "ace_mask", "ace_sid"))


def sensitive_shares_broad_perms(aces: DataFrame, word_boundary: bool = False) -> DataFrame:
    """Sensitive-keyword folders where a broad identity (not an admin) holds FullControl."""
    a = _with_res_name(aces).filter(valid_folder("folder_path"))
    # cheap identity / mask tests first; the keyword lookup only on survivors
    a = a.filter(is_broad_identity("res_name") & is_full_control("ace_mask")
                 & ~is_admin_name("res_name", ADMIN_PATTERNS_SENSITIVE))
    a = a.withColumn("folder", F.trim("folder_path"))
    # the lookup is generated once (a filter on a generated column is not
    # pushed below the generator, so the lookup is not evaluated twice)
    a = a.select("*", F.explode(F.array(match_keyword_group(F.col("folder"), word_boundary=word_boundary)))
                 .alias("kw"))
    return a.filter(F.col("kw").isNotNull()).select(
        F.col("folder").alias("folder_path"),
        F.col("kw.keyword_group").alias("keyword_group"),
        F.col("kw.matched_pattern").alias("matched_pattern"),
        F.col("res_name").alias("ace_name"), "ace_mask", "ace_sid", "ace_inherited")


def folders_missing_admin_full(aces: DataFrame) -> DataFrame:
    """Folders with no ACE that is an admin identity with FullControl."""
    a = _with_res_name(aces).filter(valid_folder("folder_path"))
    admin_full = is_admin_name("res_name", ADMIN_PATTERNS_FULL) & is_full_control("ace_mask")
    g = (a.groupBy(*run_keys(a), F.trim("folder_path").alias("folder_path"))
         .agg(F.bool_or(admin_full).alias("has_admin_full"), F.count(F.lit(1)).alias("ace_count")))
    return g.filter(~F.col("has_admin_full")).select(*run_keys(aces), "folder_path", "ace_count")


def _ps_name(aces: DataFrame) -> Column:
    """Name as the legacy finders pick it: name, else SID, else ''."""
    return F.coalesce(F.nullif(F.trim(_col(aces, "ace_name")), F.lit("")),
                      F.nullif(_col(aces, "ace_sid"), F.lit("")), F.lit(""))


def _identity_hit(name: Column, sid: Column, patterns) -> Column:
    return any_hits(name, patterns) | any_hits(sid, patterns)


def _rule_identity_patterns(rs: Ruleset, rule) -> tuple[Pattern, ...]:
    if rule.match_admin_identities and rs.admin_identities:
        return rs.admin_identities
    return rule.identity_patterns


def _like(text: str) -> Pattern:
    """User-given identity -> ``-like "*text*"`` (wildcards kept, case-insensitive)."""
    return Pattern("*" + text + "*", "wildcard")


def missing_required(aces: DataFrame, patterns, perm: Pattern | None = None,
                     rule_id: str = "custom", include_inherited: bool = False) -> DataFrame:
    """ACL lists (source_file, folder_path) with no ACE that matches ``patterns``
    and passes ``perm`` (regex on the mask text) or, without ``perm``, the
    high-permission bitmask test."""
    pats = tuple(classify(p) for p in patterns)
    name, sid = _ps_name(aces), F.coalesce(_col(aces, "ace_sid"), F.lit(""))
    mask = F.coalesce(_col(aces, "ace_mask"), F.lit(""))
    perm_ok = hits(mask, perm) & (mask != "") if perm is not None else high_perm_bitmask(mask)
    inh = F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False))
    counts = F.lit(True) if include_inherited else ~inh
    qualifies = counts & _identity_hit(name, sid, pats) & perm_ok
    g = (aces.groupBy(*run_keys(aces), _col(aces, "source_file").alias("source_file"), F.col("folder_path"))
         .agg(F.bool_or(qualifies).alias("found")))
    return g.filter(~F.col("found")).select(
        "source_file", "folder_path",
        F.lit(rule_id).alias("missing_rule"),
        F.lit(",".join(p.text for p in pats)).alias("expected_identities"),
        F.lit("").alias("found_identities"))


def missing_admins(aces: DataFrame, ruleset=None, rule_id: str = "AdminsMissing",
                   include_inherited: bool = False) -> DataFrame:
    """Per ACL list: no ACE matches the rule's admin patterns with the required rights."""
    rs = load_ruleset(ruleset)
    rule = rs.rule(rule_id)
    return missing_required(aces, _rule_identity_patterns(rs, rule), rule.perm_match, rule.id,
                            include_inherited)


def missing_required_groups(aces: DataFrame, groups, rule_id: str = "RequiredGroups",
                            include_inherited: bool = False) -> DataFrame:
    """Folders lacking a caller-given group (patterns as ``-like *group*``)."""
    return missing_required(aces, [_like(g) for g in groups], None, rule_id, include_inherited)


def accessible_by(aces: DataFrame, identity: str, ruleset=None, include_inherited: bool = False) -> DataFrame:
    """ACEs whose name or SID matches ``identity`` — or, when ``identity`` is a
    rule id, that rule's identity patterns (admin list for admin rules)."""
    rs = load_ruleset(ruleset)
    pats: tuple[Pattern, ...] = ()
    try:
        pats = _rule_identity_patterns(rs, rs.rule(identity))
    except KeyError:
        pass
    if not pats:
        pats = (_like(identity),)
    name, sid = _ps_name(aces), F.coalesce(_col(aces, "ace_sid"), F.lit(""))
    inh = F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False))
    cond = _identity_hit(name, sid, pats)
    if not include_inherited:
        cond = cond & ~inh
    return aces.filter(cond).select(
        _col(aces, "source_file").alias("source_file"), "folder_path",
        name.alias("ace_name"), sid.alias("ace_sid"), inh.alias("ace_inherited"),
        _col(aces, "ace_raw").alias("ace_raw"))


def broad_perms(aces: DataFrame, ruleset=None, include_inherited: bool = False,
                targets=None) -> DataFrame:
    """ACEs matched by the ruleset's identity patterns with high rights.

    Per rule: identity (name or SID) and high-permission bitmask and the
    rule's ``perm_match`` (when present).  Rules without identity patterns
    (and not matching admins) cannot match here.  ``matched_rules`` is the
    comma-joined list of rule ids in ruleset order.  With ``targets`` (or an
    empty ruleset) the fallback applies: name/SID like a target and high
    rights, rule id ``fallback``.
    """
    base = aces.select(
        _col(aces, "source_file").alias("source_file"), "folder_path",
        _ps_name(aces).alias("ace_name"), F.coalesce(_col(aces, "ace_sid"), F.lit("")).alias("ace_sid"),
        F.coalesce(_col(aces, "ace_mask"), F.lit("")).alias("ace_mask"),
        F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False)).alias("ace_inherited"),
        _col(aces, "ace_raw").alias("ace_raw"))
    if not include_inherited:
        base = base.filter(~F.col("ace_inherited"))
    # shared per-row inputs, computed once and referenced by every rule
    base = base.select("*", F.lower("ace_name").alias("_ln"), F.lower("ace_sid").alias("_ls"),
                       F.lower("ace_mask").alias("_lm"), high_perm_bitmask("ace_mask").alias("_high"))
    name, sid, mask, high = F.col("ace_name"), F.col("ace_sid"), F.col("ace_mask"), F.col("_high")
    ln, ls, lm = F.col("_ln"), F.col("_ls"), F.col("_lm")

    def ident(pats):
        return any_hits(name, pats, lowered=ln) | any_hits(sid, pats, lowered=ls)

    ids = []
    if targets is not None:
        ids.append(F.when(ident([_like(t) for t in targets]) & high, F.lit("fallback")))
    else:
        rs = load_ruleset(ruleset)
        for r in rs.rules:
            pats = _rule_identity_patterns(rs, r)
            if not pats:
                continue
            cond = high & ident(pats)
            if r.perm_match is not None:
                cond = cond & hits(mask, r.perm_match, lowered=lm)
            ids.append(F.when(cond, F.lit(r.id)))
    # concat_ws skips the nulls of non-matching rules: codegen'd, no array
    matched = F.concat_ws(",", *ids) if ids else F.lit("")
    # filtering the generated column: Catalyst cannot push this filter below
    # the generator, so the rule expression is not duplicated into a pushed
    # filter (where the shared columns would be inlined and re-evaluated)
    out = base.select("*", F.explode(F.array(matched)).alias("matched_rules")).filter(F.col("matched_rules") != "")
    return out.select("source_file", "folder_path", "ace_name", "ace_sid", "ace_mask", "ace_inherited",
                      "matched_rules", "ace_raw")


def broad_perms_targets(aces: DataFrame, targets=DEFAULT_TARGETS, include_inherited: bool = False) -> DataFrame:
    return broad_perms(aces, targets=targets, include_inherited=include_inherited)


def _ranking_base(rows: DataFrame) -> DataFrame:
    name = resolve_name_wide(_col(rows, "ace_name"), _col(rows, "ace_raw"))
    return rows.select(
        name.alias("identity"),
        F.trim(F.coalesce(_col(rows, "folder_path"), F.lit(""))).alias("folder"),
        F.trim(F.coalesce(_col(rows, "matched_rules"), F.lit(""))).alias("mr"))


def identity_ranking(rows: DataFrame, k: int | None = 20) -> DataFrame:
    """Per identity: distinct folders, occurrences and the sorted set of matched
    rules; ordered by (-folders, -occurrences, lower(name)).  A blank
    identity counts occurrences only."""
    b = _ranking_base(rows)
    rules = F.filter(F.transform(F.split("mr", ","), lambda x: F.trim(x)), lambda x: x != "")
    # one aggregation: the set of rule lists per identity is bounded by the
    # number of rule combinations, not by the number of rows
    g = (b.withColumn("rules", rules)
         .groupBy("identity")
         .agg(F.countDistinct(F.when(F.col("identity") != "", F.col("folder"))).alias("folder_count"),
              F.count(F.lit(1)).alias("occurrences"),
              F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("rules")))), ",")
              .alias("matched_rules")))
    g = g.orderBy(F.desc("folder_count"), F.desc("occurrences"), F.lower("identity"), F.col("identity"))
    if k:
        g = g.limit(k)
    return g.select("identity", "folder_count", "occurrences", "matched_rules")


def folders_multi_identity(rows: DataFrame, k: int | None = 100) -> DataFrame:
    """Folders with more than one distinct identity; ordered (-count, folder)."""
    b = _ranking_base(rows).filter(F.col("folder") != "")
    g = (b.groupBy(F.col("folder").alias("folder_path"))
         .agg(F.countDistinct("identity").alias("identity_count"))
         .filter(F.col("identity_count") > 1)
         .orderBy(F.desc("identity_count"), F.col("folder_path")))
    return g.limit(k) if k else g


def root_name_counts(aces: DataFrame, word: str = "root") -> DataFrame:
    """Count per name of ACEs whose name or raw JSON contains ``word``.

    A name hit and a raw hit of the same ACE both count (UNION ALL)."""
    n = _col(aces, "ace_name")
    r = _col(aces, "ace_raw")
    by_name = aces.filter(n.isNotNull() & F.lower(n).contains(word)).select(n.alias("name"))
    by_raw = aces.filter(r.isNotNull() & F.lower(r).contains(word)).select(resolve_name_or_raw(r).alias("name"))
    return (by_name.unionAll(by_raw).groupBy("name").agg(F.count(F.lit(1)).alias("hits")))


def missing_folder_rows(aces: DataFrame) -> DataFrame:
    """Inverse audit: rows whose folder path is null, blank or 'nan'."""
    wanted = ["source_file", "folder_path", "unc_path", "ace_name", "ace_sid", "ace_mask", "ace_raw"]
    return aces.filter(~valid_folder("folder_path")).select([c for c in wanted if c in aces.columns])


def aces_for_folder(aces: DataFrame, folder: str) -> DataFrame:
    """Point lookup of one folder's ACEs (exact match first, so the filter is
    pushed to the Parquet scan; the trimmed comparison keeps padded paths)."""
    t = folder.strip()
    wanted = [c for c in ["folder_path", "ace_name", "ace_sid", "ace_mask", "ace_inherited", "ace_type", "ace_raw"]
              if c in aces.columns]
    # two disjoint branches: the exact path (an equality pushed to the scan,
    # pruned by row-group statistics) and padded paths (pushed prefix/suffix
    # tests, then the trimmed comparison)
    exact = aces.filter(F.col("folder_path") == t).select(wanted)
    fp = F.col("folder_path")
    padded = aces.filter(fp.startswith(" ") | fp.endswith(" ")).filter(F.trim(fp) == t).select(wanted)
    return exact.unionByName(padded)


def run_summary(aces: DataFrame) -> DataFrame:
    """Per run: files, ACE rows, folders and distinct SIDs (exact)."""
    from permscope.operators.audit import distinct_counts

    run = _col(aces, "run_id")
    a = aces.withColumn("_run", run)
    rows = a.groupBy("_run").agg(F.count(F.lit(1)).alias("ace_rows"))
    dc = distinct_counts(a, "_run", {"files": _col(aces, "source_file"), "folders": F.col("folder_path"),
                                     "distinct_sids": F.nullif(_col(aces, "ace_sid"), F.lit(""))})
    out = rows.join(dc, "_run", "left")
    return out.select(F.col("_run").alias("run_id"),
                      *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("files",)],
                      "ace_rows",
                      *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("folders", "distinct_sids")])


def runtime_filters(aces: DataFrame, identities=None, min_mask: int | None = None, inherited: bool | None = None,
                    appliance: str | None = None, volume: str | None = None, share: str | None = None,
                    ignore_case: bool = False) -> DataFrame:
    """Caller filters chained onto the ACE table: identities (``-like *x*`` on
    name or SID), minimum integer mask, inherited yes/no, appliance / volume /
    share equality.  The inherited and equality filters are written as plain
    comparisons on the stored columns (``=``, ``IS NULL``), so they reach the
    Parquet scan as pushed predicates; ``ignore_case=True`` compares
    lower-cased text instead (not pushable)."""
    from permscope.functions.masks import mask_to_int

    out = aces
    if inherited is not None:
        c = F.col("ace_inherited") == F.lit(bool(inherited))
        out = out.filter(c if inherited else (c | F.col("ace_inherited").isNull()))
    for col, val in (("appliance_hostname", appliance), ("volume_name", volume), ("share_name", share)):
        if val is not None:
            out = out.filter(F.lower(F.col(col)) == F.lit(val.lower()) if ignore_case else F.col(col) == F.lit(val))
    if identities:
        pats = [_like(i) for i in identities]
        out = out.filter(_identity_hit(_ps_name(aces), F.coalesce(F.col("ace_sid"), F.lit("")), pats))
    if min_mask is not None:
        out = out.filter(mask_to_int("ace_mask") >= F.lit(int(min_mask)))
    return out


def baseline_row_counts(aces: DataFrame, top_principals: int = 20) -> DataFrame:
    """Baseline sizes in one long table: ACE rows per appliance and per volume,
    folders per share, the principals with most ACEs, rows without a folder (kind, key, n)."""
    app = aces.groupBy(F.coalesce("appliance_hostname", F.lit("unknown")).alias("key")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("ace_rows_per_appliance"))
    vol = aces.groupBy(F.coalesce("volume_name", F.lit("unknown")).alias("key")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("ace_rows_per_volume"))
    share_key = F.concat_ws("\\", F.coalesce("appliance_hostname", F.lit("unknown")),
                            F.coalesce("share_name", F.lit("unknown")))
    shr = aces.groupBy(share_key.alias("key")).agg(F.countDistinct("folder_path").alias("n")) \
        .withColumn("kind", F.lit("folders_per_share"))
    who = F.coalesce(F.nullif(F.trim("ace_name"), F.lit("")), F.nullif("ace_sid", F.lit("")), F.lit("unknown"))
    top = (aces.groupBy(who.alias("key")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(top_principals)
           .withColumn("kind", F.lit("aces_of_top_principal")))
    none = aces.agg(F.count(F.when(~valid_folder("folder_path"), 1)).alias("n")).select(
        F.lit("all").alias("key"), "n", F.lit("ace_rows_without_folder").alias("kind"))
    out = app.unionByName(vol).unionByName(shr).unionByName(top).unionByName(none)
    return out.select("kind", "key", "n")
