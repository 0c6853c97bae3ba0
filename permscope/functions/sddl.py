"""Security descriptors in SDDL text as Columns.

``O:<owner>G:<group>D:<flags>(ace)(ace)...S:...``; an ACE is
``type;flags;rights;object;inherited object;account``.  Everything is a built-in
expression; malformed parts give null, and conditional ACEs (text in further
parentheses after the account) keep their first six fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-letter account names and the SIDs they stand for (those without a domain part).
ACCOUNTS = {
    "AN": "S-1-5-7", "AO": "S-1-5-32-548", "AU": "S-1-5-11", "BA": "S-1-5-32-544", "BG": "S-1-5-32-546",
    "BO": "S-1-5-32-551", "BU": "S-1-5-32-545", "CG": "S-1-3-1", "CO": "S-1-3-0", "ED": "S-1-5-9",
    "IU": "S-1-5-4", "LS": "S-1-5-19", "NS": "S-1-5-20", "NU": "S-1-5-2", "PO": "S-1-5-32-550",
    "PS": "S-1-5-10", "PU": "S-1-5-32-547", "RC": "S-1-5-12", "RE": "S-1-5-32-552", "SO": "S-1-5-32-549",
    "SU": "S-1-5-6", "SY": "S-1-5-18", "WD": "S-1-1-0",
}

# Two-letter rights and their access mask bits.
RIGHTS = {
    "GA": 0x10000000, "GR": 0x80000000, "GW": 0x40000000, "GX": 0x20000000,
    "RC": 0x00020000, "SD": 0x00010000, "WD": 0x00040000, "WO": 0x00080000,
    "FA": 0x001F01FF, "FR": 0x00120089, "FW": 0x00120116, "FX": 0x001200A0,
    "CC": 0x1, "DC": 0x2, "LC": 0x4, "SW": 0x8, "RP": 0x10, "WP": 0x20, "DT": 0x40, "LO": 0x80, "CR": 0x100,
}

# ACE types.
TYPES = {"A": "allow", "D": "deny", "XA": "allow", "XD": "deny", "OA": "allow", "OD": "deny", "AU": "audit", "AL": "alarm"}

# ACE flags in the order in which canonical lines list them, and the words of exporters for them.
FLAGS = {
    "OI": ("objectinherit",), "CI": ("containerinherit",), "NP": ("nopropagateinherit",), "IO": ("inheritonly",),
    "ID": (), "SA": ("successfulaccess",), "FA": ("failedaccess",),
}


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def account_sid(account: Column) -> Column:
    """SID of an account field: itself, or the well-known SID of its two letters."""
    a = F.upper(F.trim(account))
    return F.when(a.startswith("S-1-"), a).otherwise(F.try_element_at(_map(ACCOUNTS), a))


def sddl_owner(sddl: Column) -> Column:
    """Owner SID, or null."""
    found = F.regexp_extract(sddl, r"(?i)^\s*O:(S-[0-9-]+|[A-Z]{2})", 1)
    return account_sid(F.nullif(found, F.lit("")))


def _dacl(sddl: Column) -> Column:
    """Flags and ACEs of the discretionary list: from ``D:`` (outside parentheses) to ``S:`` or the end."""
    head = F.regexp_extract(sddl, r"(?is)^[^(]*?D:(.*)$", 1)
    return F.regexp_replace(head, r"(?is)S:[A-Z]*(\(.*)?$", "")


def sddl_protected(sddl: Column) -> Column:
    """Does the list refuse inherited entries?  Null without a discretionary list."""
    # letters up to the first ACE; without one the S of "S:" may follow, which is no flag
    flags = F.upper(F.regexp_extract(sddl, r"(?is)^[^(]*?D:([A-Z_]*)", 1))
    return F.when(sddl.rlike(r"(?is)^[^(]*?D:"), F.regexp_replace(flags, "NO_ACCESS_CONTROL|AR|AI", "").contains("P"))


def rights_mask(rights: Column) -> Column:
    """Access mask (bigint) of a rights field: hex, decimal, or two-letter codes."""
    r = F.upper(F.trim(rights))
    letters = F.regexp_extract_all(r, F.lit("[A-Z]{2}"), F.lit(0))
    # a bit may come with several codes: or, not sum
    bits = F.aggregate(letters, F.lit(0).cast("bigint"),
                       lambda acc, x: acc.bitwiseOR(F.coalesce(F.try_element_at(_map(RIGHTS).cast("map<string,bigint>"), x),
                                                               F.lit(0).cast("bigint"))))
    return (F.when(r.rlike(r"^0X[0-9A-F]{1,8}$"), F.conv(F.substring(r, 3, 8), 16, 10).cast("bigint"))
            .when(r.rlike(r"^[0-9]{1,10}$"), r.try_cast("bigint"))
            .when(r.rlike(r"^([A-Z]{2})+$") & F.forall(letters, lambda x: x.isin(*RIGHTS)), bits))


def flag_codes(words: Column) -> Column:
    """Canonical flag codes (``OICI``, in a fixed order) of SDDL codes or of exporters' words in any order."""
    w = F.lower(F.coalesce(words, F.lit("")))
    upper = F.upper(F.coalesce(words, F.lit("")))
    # codes only, whatever stands between the letters
    codes = upper.rlike(r"^[^A-Z]*+((O[^A-Z]*+I|C[^A-Z]*+I|N[^A-Z]*+P|I[^A-Z]*+[OD]|[SF][^A-Z]*+A)[^A-Z]*+)*$")
    compact = F.regexp_replace(upper, r"[^A-Z]", "")
    pairs = F.when(codes & (upper != ""), F.regexp_extract_all(compact, F.lit("[A-Z]{2}"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    one = []
    for code, names in FLAGS.items():
        hit = F.array_contains(pairs, code)
        for n in names:
            hit = hit | (w.contains(n) & ~codes & w.rlike(rf"(^|[^a-z]){n}"))  # the cheap test first
        one.append(F.when(hit, F.lit(code)).otherwise(F.lit("")))
    return F.concat(*one)


def sddl_aces(sddl: Column) -> Column:
    """Array of (ace_type, ace_flags, ace_mask, ace_sid, inherited) in list order."""
    texts = F.regexp_extract_all(_dacl(sddl), F.lit(r"\(([^()]*)"), F.lit(1))
    fields = F.filter(F.transform(texts, lambda t: F.split(t, ";", -1)), lambda p: F.size(p) >= 6)
    types = _map(TYPES)

    def ace(p: Column) -> Column:
        kind = F.upper(F.trim(F.get(p, F.lit(0))))
        return F.struct(F.coalesce(F.try_element_at(types, kind), F.lower(kind)).alias("ace_type"),
                        flag_codes(F.get(p, F.lit(1))).alias("ace_flags"),
                        rights_mask(F.get(p, F.lit(2))).alias("ace_mask"),
                        F.coalesce(account_sid(F.get(p, F.lit(5))), F.trim(F.get(p, F.lit(5)))).alias("ace_sid"),
                        flag_codes(F.get(p, F.lit(1))).contains("ID").alias("inherited"))

    return F.transform(fields, ace)
