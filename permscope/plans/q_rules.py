"""Catalogue: the rule engine (all rules, each shipped rule, severity filters).

The oracle is generated from the same compiled ruleset but formulated
independently: one ``SELECT ... WHERE`` per rule, glued with UNION ALL, and
folder counts from a window over the grouped pairs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from permscope.functions.patterns import Pattern, sql_any_hits, sql_contains_any, sql_hits, sql_quote
from permscope.operators import rules as RU
from permscope.plans import sqlparts as S
from permscope.plans.registry import oracle, register
from permscope.session import checkpoint_dir
from permscope.sources import fixtures as fx
from permscope.sources.ruleset import Rule, Ruleset, load_ruleset

DEFAULT = load_ruleset()


def _sql_admin_hit(admins: tuple[Pattern, ...], sid_for_contains: bool) -> str:
    terms = []
    for p in admins:
        t = sql_hits("res_name", p)
        if p.kind != "contains" or sid_for_contains:
            t = f"({t} OR (sid <> '' AND {sql_hits('sid', p)}))"
        terms.append(t)
    return "(" + " OR ".join(terms) + ")" if terms else "false"


def rule_where(rule: Rule, admins, compat: bool = False) -> str:
    conds = []
    if rule.path_keywords:
        conds.append(sql_contains_any("folder", rule.path_keywords))
    if rule.ace_count_gt is not None:
        conds.append(f"folder_count > {int(rule.ace_count_gt)}")
    if rule.requires_aggregation:
        conds.append("dup_count > 1")
    if compat and rule.match_admin_identities:
        # original order: the admin exclusion runs before the admin match
        conds.append(f"NOT {_sql_admin_hit(admins, False)}")
    if not rule.match_admin_identities:
        excl = _sql_admin_hit(admins, False)
        if rule.identity_exclude_patterns:
            excl = f"({excl} OR {sql_any_hits('res_name', rule.identity_exclude_patterns)})"
        conds.append(f"NOT {excl}")
        if rule.has_identity_constraint:
            idm = sql_any_hits("res_name", rule.identity_patterns)
            if rule.identity_regex is not None and rule.identity_regex.kind == "regex":
                rx = rule.identity_regex
                idm = (f"({idm} OR {sql_hits('res_name', rx, False)} OR "
                       f"(sid <> '' AND {sql_hits('sid', rx, False)}))")
            conds.append(idm)
    else:
        conds.append(_sql_admin_hit(admins, True))
    if rule.perm_match is not None:
        conds.append(sql_hits("mask", rule.perm_match))
    if rule.ace_inherited is not None:
        conds.append(f"inherited = {'true' if rule.ace_inherited else 'false'}")
    return " AND ".join(conds) if conds else "true"


def rules_oracle(rs: Ruleset, min_rank: int = 0, src: str = "aces", fixtures=None, compat: bool = False,
                 **ctes: str) -> str:
    """Rule matches as DuckDB SQL over table ``src`` (a fixture name, or a
    CTE given in ``ctes`` built on ``fixtures``)."""
    rules = [r for r in rs.rules if compat or not r.expect_presence]
    rules = [r for r in rules if {"low": 1, "medium": 2, "high": 3}.get(r.severity.lower(), 0) >= min_rank]
    need_counts = any(r.ace_count_gt is not None or r.requires_aggregation for r in rules)
    tbl = "j" if need_counts else "n"
    parts = [f"SELECT {sql_quote(r.id)} AS rule_id, {sql_quote(r.severity)} AS severity, "
             f"folder AS folder_path, res_name AS ace_name, sid AS ace_sid, mask AS ace_mask, "
             f"inherited AS ace_inherited FROM {tbl} WHERE {rule_where(r, rs.admin_identities, compat)}"
             for r in rules]
    body = "\nUNION ALL\n".join(parts) if parts else (
        "SELECT NULL::VARCHAR AS rule_id, NULL::VARCHAR AS severity, NULL::VARCHAR AS folder_path, "
        "NULL::VARCHAR AS ace_name, NULL::VARCHAR AS ace_sid, NULL::VARCHAR AS ace_mask, "
        "NULL::BOOLEAN AS ace_inherited WHERE false")
    extra = dict(ctes)
    extra["n"] = S.normalized(src)
    if need_counts:
        extra["c"] = ("SELECT folder, res_name, COUNT(*) AS dup_count, "
                      "SUM(COUNT(*)) OVER (PARTITION BY folder) AS folder_count FROM n GROUP BY folder, res_name")
        extra["j"] = "SELECT n.*, c.dup_count, c.folder_count FROM n JOIN c USING (folder, res_name)"
    return oracle(body, *(fixtures if fixtures is not None else (src,)), **extra)


@register("apply_rules", "2.11", rules_oracle(DEFAULT))
def q_apply_rules(spark, sf):
    return RU.apply_rules(fx.aces(spark, sf), DEFAULT)


def _two_runs(spark, sf):
    return fx.aces(spark, sf, "a").unionByName(fx.aces(spark, sf, "b"))


@register("apply_rules_two_runs", "2.11", oracle("SELECT * FROM ma UNION ALL SELECT * FROM mb",
                                                 ma=rules_oracle(DEFAULT), mb=rules_oracle(DEFAULT, src="aces_b")))
def q_apply_rules_two_runs(spark, sf):
    # counts never mix runs: both runs at once equal the union of one at a time
    return RU.apply_rules(_two_runs(spark, sf), DEFAULT)


@register("rules_cross_aces", "2.4", rules_oracle(DEFAULT))
def q_rules_cross_aces(spark, sf):
    # the nested loop "every rule x every ACE" is the same single-scan plan
    return RU.apply_rules(fx.aces(spark, sf), DEFAULT)


@register("min_severity", "2.3", rules_oracle(DEFAULT, min_rank=2))
def q_min_severity(spark, sf):
    return RU.apply_rules(fx.aces(spark, sf), DEFAULT, min_severity="medium")


@register("severity_counts", "2.5", oracle(
    "SELECT lower(severity) AS severity, COUNT(*) AS match_count FROM m GROUP BY 1", m=rules_oracle(DEFAULT)))
def q_severity_counts(spark, sf):
    return RU.severity_counts(RU.apply_rules(fx.aces(spark, sf), DEFAULT))


def _one_rule(rule_id: str):
    rs = DEFAULT.only(rule_id)

    def build(spark, sf):
        return RU.apply_rules(fx.aces(spark, sf), rs)
    return build, rules_oracle(rs)


for _r in DEFAULT.rules:
    if _r.expect_presence:
        continue
    _b, _o = _one_rule(_r.id)
    register(f"rule_{_r.id}", "2.11", _o)(_b)


@register("split_by_severity", "2.1", oracle("""
SELECT lower(severity) AS severity, rule_id, COUNT(*) AS match_count
FROM m WHERE lower(severity) IN ('low', 'medium', 'high') GROUP BY 1, 2""", m=rules_oracle(DEFAULT)))
def q_split_by_severity(spark, sf):
    # the severity sink itself, read back from its partitions
    out = f"{checkpoint_dir(spark).rstrip('/')}/severity-{uuid.uuid4().hex}"
    RU.split_by_severity(RU.apply_rules(fx.aces(spark, sf), DEFAULT), out, fmt="parquet")
    m = spark.read.schema("rule_id string, severity string").parquet(out)
    return m.groupBy("severity", "rule_id").agg(F.count(F.lit(1)).alias("match_count"))


@register("apply_rules_compat", "2.11", rules_oracle(DEFAULT, compat=True))
def q_apply_rules_compat(spark, sf):
    # decision D4 in its original form: admin exclusion before the admin
    # match, presence rules scored per ACE (so both practically never fire)
    return RU.apply_rules(fx.aces(spark, sf), DEFAULT, compat=True)
