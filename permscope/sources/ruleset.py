"""Ruleset loading: JSON -> compiled, driver-side rule objects.

The ruleset is configuration (a dozen rules), so it lives on the driver;
each rule later becomes one boolean ``Column``.  Keys understood per rule:
``id, description, severity, identity_patterns, identity_exclude_patterns,
identity_regex, perm_match, path_keywords, ace_count_gt,
requires_aggregation, match_admin_identities, expect_presence,
ace_inherited``.  The global ``admin_identities`` (or ``admin_id_patterns``)
list is attached to every rule.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path

from permscope.functions.patterns import Pattern, classify

DEFAULT_RULESET_PATH = Path(__file__).with_name("default_ruleset.json")

SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3}


@dataclass(frozen=True)
class Rule:
    id: str
    severity: str = "medium"
    description: str = ""
    identity_patterns: tuple[Pattern, ...] = ()
    identity_exclude_patterns: tuple[Pattern, ...] = ()
    identity_regex: Pattern | None = None
    perm_match: Pattern | None = None
    path_keywords: tuple[str, ...] = ()
    ace_count_gt: int | None = None
    requires_aggregation: bool = False
    match_admin_identities: bool = False
    expect_presence: bool = False
    ace_inherited: bool | None = None

    @property
    def needs_folder_count(self) -> bool:
        return self.ace_count_gt is not None

    @property
    def has_identity_constraint(self) -> bool:
        return bool(self.identity_patterns) or self.identity_regex is not None


@dataclass(frozen=True)
class Ruleset:
    rules: tuple[Rule, ...]
    admin_identities: tuple[Pattern, ...] = ()
    version: str = ""
    raw: dict = field(default_factory=dict, compare=False, hash=False)

    def rule(self, rule_id: str) -> Rule:
        for r in self.rules:
            if r.id.lower() == rule_id.lower():
                return r
        raise KeyError(rule_id)

    def only(self, *rule_ids: str) -> "Ruleset":
        keep = tuple(self.rule(i) for i in rule_ids)
        return Ruleset(keep, self.admin_identities, self.version, self.raw)

    def with_threshold(self, ace_count_gt: int) -> "Ruleset":
        """Same rules with every ``ace_count_gt`` replaced (smoke runs on tiny data)."""
        rules = tuple(
            Rule(**{**r.__dict__, "ace_count_gt": ace_count_gt}) if r.ace_count_gt is not None else r
            for r in self.rules)
        return Ruleset(rules, self.admin_identities, self.version, self.raw)


def _as_list(v) -> list:
    if v is None or v == "":
        return []
    if isinstance(v, list):
        return v
    return [v]


def _as_bool(v) -> bool | None:
    """Parse booleans properly (the text 'false' is false)."""
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return v != 0
    s = str(v).strip().lower()
    if s in ("true", "1", "yes", "y", "t"):
        return True
    if s in ("false", "0", "no", "n", "f", ""):
        return False
    return bool(s)


def _as_int(v) -> int | None:
    try:
        return int(v) if v is not None and v != "" else None
    except (TypeError, ValueError):
        return None


def compile_ruleset(doc: dict) -> Ruleset:
    admins = tuple(classify(p) for p in _as_list(doc.get("admin_identities") or doc.get("admin_id_patterns")))
    rules = []
    for r in doc.get("rules", []):
        ir = r.get("identity_regex")
        pm = r.get("perm_match")
        rules.append(Rule(
            id=str(r.get("id", "")),
            severity=str(r.get("severity", "medium")),
            description=str(r.get("description", "")),
            # identity patterns: wildcard / regex / substring (see functions.patterns)
            identity_patterns=tuple(classify(p) for p in _as_list(r.get("identity_patterns"))),
            # exclude patterns and perm_match are regex with substring fallback
            identity_exclude_patterns=tuple(classify(p, "regex") for p in _as_list(r.get("identity_exclude_patterns"))),
            identity_regex=classify(ir, "regex") if ir else None,
            perm_match=classify(str(pm), "regex") if pm is not None and pm != "" else None,
            path_keywords=tuple(str(k).lower() for k in _as_list(r.get("path_keywords"))),
            ace_count_gt=_as_int(r.get("ace_count_gt")),
            requires_aggregation=bool(_as_bool(r.get("requires_aggregation"))),
            match_admin_identities=bool(_as_bool(r.get("match_admin_identities"))),
            expect_presence=bool(_as_bool(r.get("expect_presence"))),
            ace_inherited=_as_bool(r["ace_inherited"]) if "ace_inherited" in r else None,
        ))
    text = json.dumps(doc, sort_keys=True, ensure_ascii=False)
    version = str(doc.get("version") or "") + "#" + hashlib.sha256(text.encode()).hexdigest()[:12]
    return Ruleset(tuple(rules), admins, version, doc)


def load_ruleset(path: str | Path | dict | None = None) -> Ruleset:
    """Load a ruleset from a JSON file path, a dict, or the default ruleset."""
    if isinstance(path, Ruleset):
        return path
    if isinstance(path, dict):
        return compile_ruleset(path)
    p = Path(path) if path else DEFAULT_RULESET_PATH
    with p.open("r", encoding="utf-8-sig") as fh:
        return compile_ruleset(json.load(fh))


def severity_rank(sev: str | None) -> int:
    return SEVERITY_RANK.get(str(sev or "").lower(), 0)
