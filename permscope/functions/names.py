"""Identity-name resolution for ACE rows.

An ACE's display name is ``ace_name`` when present; otherwise it is looked up
in the raw ACE JSON (``ace_raw``).  The raw JSON is parsed once per row into
``map<string,string>`` (duplicate keys: last wins, see ``session``), and the
candidate keys are probed in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys probed in the raw ACE, in order (exact key, then its
# lower-case form).
RAW_NAME_KEYS = ("name", "displayName", "identity", "account", "accountName", "sid")

# Case-insensitive key list of the wide resolver, in order.
RAW_NAME_KEYS_WIDE = ("name", "displayname", "identity", "identityreference", "account",
                      "accountname", "principal", "user", "group", "grantee", "sid")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def raw_map(raw) -> Column:
    """``ace_raw`` parsed as an object (null when it is not a JSON object)."""
    return F.from_json(_c(raw), "map<string,string>")


def _looks_like_json_non_object(raw: Column) -> Column:
    # valid JSON that is not an object resolves to '' (arrays, quoted strings,
    # numbers, literals); anything else that fails to parse is a bare name.
    t = F.trim(raw)
    scalar = t.rlike(r'^("([^"\\]|\\.)*"|-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null)$')
    # from_json tolerates trailing text after an array, so the text must also end with ']'
    return scalar | (t.startswith("[") & t.endswith("]") & F.from_json(t, "array<string>").isNotNull())


def _probe(m: Column, keys, lower_too: bool) -> Column:
    cands = []
    for k in keys:
        cands.append(F.nullif(m.getItem(k), F.lit("")))
        if lower_too and k.lower() != k:
            cands.append(F.nullif(m.getItem(k.lower()), F.lit("")))
    return F.coalesce(*cands)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a one-element
    ``transform``): the parsed map is shared by all key probes instead of
    being re-parsed per reference."""
    return F.element_at(F.transform(F.array(value), body), 1)


def name_from_raw(raw, trim: bool = True) -> Column:
    """Name found in ``ace_raw``; '' when the raw JSON has no name key."""
    r = _c(raw)

    def body(m):
        found = _probe(m, RAW_NAME_KEYS, lower_too=True)
        found = F.trim(found) if trim else found
        bare = F.trim(r) if trim else r
        return (F.when(m.isNotNull(), F.coalesce(found, F.lit("")))
                .when(_looks_like_json_non_object(r), F.lit(""))
                .otherwise(bare))
    return F.when(r.isNull() | (r == ""), F.lit("")).otherwise(_let(raw_map(r), body))


def resolve_name(name="ace_name", raw="ace_raw") -> Column:
    """Trimmed ``ace_name``; else the name inside ``ace_raw``; else ''.

    The raw JSON is parsed only for rows whose name is blank."""
    n = F.trim(_c(name))
    return F.when(F.coalesce(n, F.lit("")) != "", n).otherwise(name_from_raw(raw))


def resolve_name_wide(name="ace_name", raw="ace_raw") -> Column:
    """Case-insensitive, longer key list; a raw value that is not an object gives its text."""
    r = _c(raw)

    def body(m):
        found = F.trim(_probe(m, RAW_NAME_KEYS_WIDE, lower_too=False))
        return (F.when(m.isNotNull(), F.coalesce(found, F.trim(r)))
                .otherwise(F.trim(F.regexp_replace(r, r'^\s*"(.*)"\s*$', "$1"))))
    from_raw = F.when(r.isNull() | (r == ""), F.lit("")).otherwise(
        _let(F.transform_keys(raw_map(r), lambda k, v: F.lower(k)), body))
    n = F.trim(_c(name))
    return F.when(F.coalesce(n, F.lit("")) != "", n).otherwise(from_raw)


def resolve_name_or_raw(raw="ace_raw") -> Column:
    """Name inside ``ace_raw`` (untrimmed), falling back to the raw text itself."""
    r = _c(raw)
    return F.when(r.isNull() | (r == ""), F.lit("")).otherwise(
        _let(raw_map(r), lambda m: F.coalesce(_probe(m, RAW_NAME_KEYS, lower_too=True), r)))
