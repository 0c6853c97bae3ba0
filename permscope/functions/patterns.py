"""Identity / permission patterns of a ruleset, compiled on the driver.

A rule pattern is one of three kinds, decided once per pattern on the
driver (never per row):

* ``wildcard`` — contains ``*`` or ``?``: other characters are escaped,
  ``*`` -> ``.*``, ``?`` -> ``.``; searched unanchored.
* ``regex``    — compiles as a Python regex: searched as is.
* ``contains`` — anything else (e.g. ``DOMAIN\\Global`` where ``\\G`` is not
  a valid escape): plain case-insensitive substring.

A pattern may also carry an explicit kind: ``{"pattern": ..., "match":
"contains"|"regex"|"wildcard"}``.  Raw pattern text is never handed to
``rlike`` without this classification, since Java regex accepts things
Python rejects (``\\G``) and rejects things Python's fallback tolerated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_META = set(r"\.^$|?*+()[]{}")


@dataclass(frozen=True)
class Pattern:
    text: str
    kind: str  # wildcard | regex | contains

    @property
    def regex(self) -> str | None:
        """Regex text valid in both Java and RE2 (None for ``contains``)."""
        if self.kind == "wildcard":
            out, i = [], 0
            while i < len(self.text):
                ch = self.text[i]
                end = self.text.find("]", i + 2) if ch == "[" else -1
                i += 1
                if end > 0:  # a class such as [0-9] or [abc]; an open bracket without its end is literal
                    inside = self.text[i:end]
                    out.append("[" + "".join("\\" + x if x in "\\^[&~" else x for x in inside) + "]")
                    i = end + 1
                elif ch == "*":
                    out.append(".*")
                elif ch == "?":
                    out.append(".")
                elif ch in _REGEX_META:
                    out.append("\\" + ch)
                else:
                    out.append(ch)
            return "".join(out)
        if self.kind == "regex":
            return self.text
        return None


def classify(p, kind: str | None = None) -> Pattern:
    """Classify a pattern string (or ``{"pattern", "match"}`` dict)."""
    if isinstance(p, Pattern):
        return p
    if isinstance(p, dict):
        kind = p.get("match") or kind
        p = p.get("pattern", "")
    text = str(p)
    if kind:
        if kind not in ("wildcard", "regex", "contains"):
            raise ValueError(f"unknown pattern kind {kind!r}")
        if kind == "regex":
            try:
                re.compile(text)
            except re.error:
                kind = "contains"
        return Pattern(text, kind)
    if "*" in text or "?" in text:
        return Pattern(text, "wildcard")
    try:
        re.compile(text)
        return Pattern(text, "regex")
    except re.error:
        return Pattern(text, "contains")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _is_literal(text: str) -> bool:
    return text != "" and not any(ch in _REGEX_META for ch in text)


def _literal_text(body: str) -> str | None:
    """The literal a regex stands for, when it has no operators at all."""
    out, i = [], 0
    while i < len(body):
        ch = body[i]
        if ch == "\\":
            if i + 1 < len(body) and not body[i + 1].isalnum():
                out.append(body[i + 1])
                i += 2
                continue
            return None
        if ch in _REGEX_META:
            return None
        out.append(ch)
        i += 1
    return "".join(out) or None


def _like_escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def fast_form(pattern: Pattern, ignore_case: bool = True):
    """Cheapest equivalent test, decided on the driver:

    ('contains', [words]) — any literal is a substring (regex alternation of
    literals, plain literals, ``contains`` patterns, ``*word*`` wildcards);
    ('prefix', word) — ``^literal``; ('like', pattern) — other wildcards
    without ``?`` become a SQL LIKE; ('regex', text) otherwise.
    Case-insensitive literal tests compare lower-cased text.
    """
    t = pattern.text
    if pattern.kind == "contains":
        return ("contains", [t])
    if pattern.kind == "wildcard":
        if "?" in t or "[" in t:
            return ("regex", pattern.regex)
        pieces = [x for x in t.split("*") if x != ""]
        if len(pieces) == 1:
            return ("contains", pieces)
        if not pieces:
            return ("contains", [""])
        return ("like", "%" + "%".join(_like_escape(x) for x in pieces) + "%")
    body = t
    if body.startswith("(?i)"):
        body, ignore_case = body[4:], True
    # escaped punctuation (a backslash before a non-alphanumeric) is literal
    plain = _literal_text(body)
    if plain:
        return ("contains", [plain])
    if _is_literal(body):
        return ("contains", [body])
    if body.startswith("^") and _is_literal(body[1:]):
        return ("prefix", body[1:])
    alts = [_literal_text(a) for a in body.split("|")]
    if len(alts) > 1 and all(alts):
        return ("contains", alts)
    return ("regex", t)


def hits(col, pattern: Pattern, ignore_case: bool = True, lowered=None) -> Column:
    """Null-safe search of one pattern in a string column (false on null).

    ``lowered`` may pass a precomputed ``lower(col)`` shared by many tests.
    """
    c = F.coalesce(_c(col), F.lit(""))
    kind, arg = fast_form(pattern, ignore_case)
    ci = ignore_case or pattern.text.startswith("(?i)")
    if kind in ("contains", "prefix", "like"):
        target = (lowered if lowered is not None else F.lower(c)) if ci else c
        if kind == "contains":
            out = None
            for w in arg:
                term = target.contains(w.lower() if ci else w)
                out = term if out is None else (out | term)
            return out
        if kind == "prefix":
            return target.startswith(arg.lower() if ci else arg)
        return target.like(arg.lower() if ci else arg)
    prefix = "(?i)" if ignore_case else ""
    return c.rlike(prefix + (pattern.regex if pattern.kind != "regex" else arg))


def any_hits(col, patterns, ignore_case: bool = True, lowered=None) -> Column:
    out = None
    for p in patterns:
        h = hits(col, p, ignore_case, lowered)
        out = h if out is None else (out | h)
    return out if out is not None else F.lit(False)


def contains_any(col, words) -> Column:
    """Case-insensitive substring test against a list of lower-case words."""
    lc = F.lower(F.coalesce(_c(col), F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | lc.contains(w)
    return out


def wildcard_like(col, pattern: str) -> Column:
    """PowerShell ``-like "*pat*"``: case-insensitive, ``*``/``?`` wildcards."""
    return hits(col, Pattern("*" + pattern + "*", "wildcard"))


# --- SQL text for the DuckDB oracle (RE2 syntax) --------------------------

def sql_quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_hits(col_sql: str, pattern: Pattern, ignore_case: bool = True) -> str:
    c = f"COALESCE({col_sql}, '')"
    if pattern.kind == "contains":
        if ignore_case:
            return f"contains(lower({c}), {sql_quote(pattern.text.lower())})"
        return f"contains({c}, {sql_quote(pattern.text)})"
    prefix = "(?i)" if ignore_case else ""
    return f"regexp_matches({c}, {sql_quote(prefix + pattern.regex)})"


def sql_any_hits(col_sql: str, patterns, ignore_case: bool = True) -> str:
    if not patterns:
        return "false"
    return "(" + " OR ".join(sql_hits(col_sql, p, ignore_case) for p in patterns) + ")"


def sql_contains_any(col_sql: str, words) -> str:
    if not words:
        return "false"
    c = f"lower(COALESCE({col_sql}, ''))"
    return "(" + " OR ".join(f"contains({c}, {sql_quote(w)})" for w in words) + ")"
