"""Rule engine: every rule of a ruleset against every ACE, in one scan.

Plan shape (no cross join, no per-row Python):

1. ``normalize_aces``: fill nulls, resolve the display name.
2. If any rule needs folder-level counts (``ace_count_gt``,
   ``requires_aggregation``): ``groupBy(folder, name).count()`` and
   ``groupBy(folder).count()`` (map-side partial aggregation, so a hot folder
   is pre-aggregated before the shuffle).  Only counts that a rule can match
   are kept: names that come more than once are joined back on
   ``(folder, name)``, folders above the smallest threshold on ``folder``;
   those are few (fewer than rows / threshold) and written first, so that
   Spark knows their size and can broadcast them.  AQE's skew-join split handles
   a folder that holds a large share of all rows; a window over the folder
   would put that folder in one task, so it is not used.
3. Each rule becomes a boolean Column; the matches are
   ``explode(array(when(cond_i, struct(rule_i))...))`` + a null filter — one
   projection in whole-stage codegen, no join against a rules table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.functions.names import resolve_name
from permscope.functions.patterns import Pattern, any_hits, hits
from permscope.operators.runs import run_keys
from permscope.session import checkpointed
from permscope.sources.ruleset import Rule, Ruleset, load_ruleset, SEVERITY_RANK

MATCH_COLUMNS = ["rule_id", "severity", "folder_path", "ace_name", "ace_sid", "ace_mask", "ace_inherited"]


def normalize_aces(aces: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Null-free rule inputs: folder, res_name, sid, mask, inherited (and ``run``)."""
    cols = set(aces.columns)

    def col_or_null(name, typ="string"):
        return F.col(name) if name in cols else F.lit(None).cast(typ)

    return aces.select(
        *[F.col(k) for k in keep if k in cols],
        F.coalesce(col_or_null("folder_path").cast("string"), F.lit("")).alias("folder"),
        resolve_name(col_or_null("ace_name"), col_or_null("ace_raw")).alias("res_name"),
        F.coalesce(col_or_null("ace_sid").cast("string"), F.lit("")).alias("sid"),
        F.coalesce(col_or_null("ace_mask").cast("string"), F.lit("")).alias("mask"),
        F.coalesce(col_or_null("ace_inherited", "boolean").cast("boolean"), F.lit(False)).alias("inherited"),
        F.struct(*run_keys(aces), F.lit(0).alias("_")).alias("run"),
    )


def with_folder_counts(norm: DataFrame, above: int | None = None, pairs: bool = True, first: bool = True) -> DataFrame:
    """Attach ``dup_count`` (ACEs of the same run, folder and identity) where it is more than
    1 (``pairs``), and ``folder_count`` (ACEs of the folder in its run) where it is more than
    ``above``; null elsewhere, and without the join where not asked for.

    ``first`` writes the large folders before the join, in a pass of its own over the rows.
    """
    out = norm
    # null-safe keys (they are never null): an equi-join would infer an
    # IS NOT NULL filter that re-evaluates the name resolution on every row
    if above is not None:
        large = norm.groupBy("run", "folder").agg(F.count(F.lit(1)).alias("folder_count")).where(F.col("folder_count") > above)
        large = (checkpointed(large) if first else large).withColumnsRenamed({"run": "_cr", "folder": "_cf"})
        same = out["folder"].eqNullSafe(large["_cf"]) & out["run"].eqNullSafe(large["_cr"])
        out = out.join(large, same, "left").drop("_cf", "_cr")
    else:
        out = out.withColumn("folder_count", F.lit(None).cast("long"))
    if not pairs:
        return out.withColumn("dup_count", F.lit(None).cast("long"))
    many = norm.groupBy("run", "folder", "res_name").agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")
    many = many.withColumnsRenamed({"run": "_dr", "folder": "_df", "res_name": "_dn"})
    same = (out["folder"].eqNullSafe(many["_df"]) & out["res_name"].eqNullSafe(many["_dn"])
            & out["run"].eqNullSafe(many["_dr"]))
    return out.join(many, same, "left").drop("_df", "_dn", "_dr")


def _admin_hit(admins: tuple[Pattern, ...], name: Column, sid: Column, sid_for_contains: bool,
               lname=None, lsid=None) -> Column:
    out = None
    for p in admins:
        on_sid = p.kind != "contains" or sid_for_contains
        t = hits(name, p, lowered=lname)
        if on_sid:
            t = t | ((sid != "") & hits(sid, p, lowered=lsid))
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def with_shared_predicates(norm: DataFrame, admins: tuple[Pattern, ...]) -> DataFrame:
    """Lower-cased inputs and the admin tests, computed once per row and
    referenced by every rule (not re-evaluated per rule)."""
    n = norm.select("*", F.lower("res_name").alias("_ln"), F.lower("sid").alias("_ls"),
                    F.lower("mask").alias("_lm"), F.lower("folder").alias("_lf"))
    name, sid = F.col("res_name"), F.col("sid")
    return n.select(
        "*",
        _admin_hit(admins, name, sid, False, F.col("_ln"), F.col("_ls")).alias("_adm_x"),
        _admin_hit(admins, name, sid, True, F.col("_ln"), F.col("_ls")).alias("_adm_m"))


def rule_condition(rule: Rule, admins: tuple[Pattern, ...], compat: bool = False) -> Column:
    """Boolean Column: does the normalized ACE row match ``rule``?

    Expects the columns of ``with_shared_predicates``.  Decisions (README):
    admin exclusion is skipped for rules that *match* admins (``compat=True``
    keeps the original order, where those rules practically never fire);
    identity patterns test the name, the identity regex is case-sensitive
    and also tests the SID.
    """
    name, sid, mask = F.col("res_name"), F.col("sid"), F.col("mask")
    ln, lm = F.col("_ln"), F.col("_lm")
    conds: list[Column] = []
    if rule.path_keywords:
        lf = F.col("_lf")
        kw = None
        for k in rule.path_keywords:
            kw = lf.contains(k) if kw is None else (kw | lf.contains(k))
        conds.append(kw)
    if rule.ace_count_gt is not None:
        conds.append(F.coalesce(F.col("folder_count") > F.lit(rule.ace_count_gt), F.lit(False)))
    if rule.requires_aggregation:
        conds.append(F.coalesce(F.col("dup_count") > 1, F.lit(False)))
    if not rule.match_admin_identities or compat:
        excluded = F.col("_adm_x")
        if rule.identity_exclude_patterns:
            excluded = excluded | any_hits(name, rule.identity_exclude_patterns, lowered=ln)
        conds.append(~excluded)
    if rule.match_admin_identities:
        conds.append(F.col("_adm_m"))
    elif rule.has_identity_constraint:
        idm = any_hits(name, rule.identity_patterns, lowered=ln)
        if rule.identity_regex is not None:
            rx = rule.identity_regex
            if rx.kind == "regex":
                idm = idm | hits(name, rx, ignore_case=False) | ((sid != "") & hits(sid, rx, ignore_case=False))
        conds.append(idm)
    if rule.perm_match is not None:
        conds.append(hits(mask, rule.perm_match, lowered=lm))
    if rule.ace_inherited is not None:
        conds.append(F.col("inherited") == F.lit(rule.ace_inherited))
    out = None
    for c in conds:
        out = c if out is None else (out & c)
    return out if out is not None else F.lit(True)


def _scored_rules(ruleset: Ruleset, include_presence: bool) -> list[Rule]:
    # presence rules (expect_presence) are evaluated by missing_admins, not per ACE
    return [r for r in ruleset.rules if include_presence or not r.expect_presence]


def apply_rules(aces: DataFrame, ruleset: Ruleset | str | dict | None = None,
                min_severity: str | None = None, compat: bool = False,
                keep: tuple[str, ...] = (), counts_first: bool = True) -> DataFrame:
    """All rule matches: rule_id, severity, folder_path, ace_name, ace_sid, ace_mask, ace_inherited.

    ``keep`` carries extra input columns (e.g. ``run_id``, ``source_file``)
    through to the matches.  ``counts_first=False`` reads ``aces`` once less:
    for rows that are costly to derive, not for stored ones.
    """
    rs = load_ruleset(ruleset)
    rules = _scored_rules(rs, include_presence=compat)
    norm = normalize_aces(aces, keep)
    thresholds = [r.ace_count_gt for r in rules if r.ace_count_gt is not None]
    pairs = any(r.requires_aggregation for r in rules)
    if thresholds or pairs:
        norm = with_folder_counts(norm, min(thresholds, default=None), pairs, counts_first)
    norm = with_shared_predicates(norm, rs.admin_identities)
    hits_arr = F.array(*[
        F.when(rule_condition(r, rs.admin_identities, compat),
               F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.severity).alias("severity")))
        for r in rules
    ]) if rules else F.array().cast("array<struct<rule_id:string,severity:string>>")
    # explode + null filter keeps the rule conditions inside whole-stage
    # codegen (a higher-order filter() would evaluate them interpreted)
    matched = norm.select("*", F.explode(hits_arr).alias("m")).filter(F.col("m").isNotNull())
    out = matched.select(
        *[F.col(k) for k in keep if k in aces.columns],
        F.col("m.rule_id").alias("rule_id"),
        F.col("m.severity").alias("severity"),
        F.col("folder").alias("folder_path"),
        F.col("res_name").alias("ace_name"),
        F.col("sid").alias("ace_sid"),
        F.col("mask").alias("ace_mask"),
        F.col("inherited").alias("ace_inherited"),
    )
    if min_severity:
        out = filter_min_severity(out, min_severity)
    return out


def severity_rank_col(sev="severity") -> Column:
    s = F.lower(F.col(sev) if isinstance(sev, str) else sev)
    expr = F.lit(0)
    for name, rank in SEVERITY_RANK.items():
        expr = F.when(s == name, F.lit(rank)).otherwise(expr)
    return expr


def filter_min_severity(matches: DataFrame, min_severity: str) -> DataFrame:
    """Keep rank(severity) >= rank(min); an unknown minimum keeps everything."""
    min_rank = SEVERITY_RANK.get(str(min_severity).lower(), 0)
    return matches.filter(severity_rank_col() >= F.lit(min_rank))


def severity_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy(F.lower("severity").alias("severity")).agg(F.count(F.lit(1)).alias("match_count"))


def filter_matches_by_rule(rows: DataFrame, rule_id: str, col: str = "matched_rules") -> DataFrame:
    """Rows whose comma-joined ``matched_rules`` (or ``rule_id``) contain the id."""
    if col in rows.columns and dict(rows.dtypes)[col].startswith("array"):
        return rows.filter(F.array_contains(col, rule_id))
    if col in rows.columns:
        return rows.filter(F.array_contains(F.transform(F.split(col, ","), lambda x: F.trim(x)), rule_id))
    return rows.filter(F.col("rule_id") == rule_id)


def split_by_severity(matches: DataFrame, out_dir: str, strict: bool = True,
                      fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write matches partitioned by severity (low/medium/high; ``strict=False``
    keeps every severity value).  An empty result still writes a typed,
    header-carrying output."""
    m = matches.withColumn("severity", F.lower("severity"))
    if strict:
        m = m.filter(F.col("severity").isin("low", "medium", "high"))
    w = m.write.mode(mode).partitionBy("severity")
    if fmt == "csv":
        w.option("header", True).csv(out_dir)
    else:
        w.format(fmt).save(out_dir)


def run_checks(aces: DataFrame, checks, ruleset=None) -> dict[str, DataFrame]:
    """Dispatch named checks or rule ids to the matching finder.

    A rule with ``perm_match`` -> broad_perms filtered to that rule; an
    ``expect_presence`` rule -> missing_admins; a known check name -> that
    report; anything else raises ``KeyError`` (the caller sees what was
    not actionable)."""
    from permscope.operators import finders

    rs = load_ruleset(ruleset)
    named = {
        "broad_perms": lambda: finders.broad_perms(aces, rs),
        "missing_admins": lambda: finders.missing_admins(aces, rs),
        "everyone_full_control": lambda: finders.everyone_full_control(aces),
        "sensitive_shares_broad_perms": lambda: finders.sensitive_shares_broad_perms(aces),
        "folders_missing_admin_full": lambda: finders.folders_missing_admin_full(aces),
        "apply_rules": lambda: apply_rules(aces, rs),
    }
    out = {}
    for c in checks:
        if c in named:
            out[c] = named[c]()
            continue
        rule = rs.rule(c)
        if rule.expect_presence:
            out[c] = finders.missing_admins(aces, rs, rule_id=rule.id)
        elif rule.perm_match is not None:
            out[c] = filter_matches_by_rule(finders.broad_perms(aces, rs), rule.id)
        else:
            out[c] = apply_rules(aces, rs.only(rule.id))
    return out
