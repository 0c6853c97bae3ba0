"""Access-mask helpers: every function maps Column(s) to a Column.

Masks arrive as text (``FullControl``, ``Modify``, ``0x1F01FF``, ``2032127``)
or as numbers, depending on the exporter.  All helpers accept either; text
is the canonical storage form (``ace_mask STRING``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Windows access-mask bits that make an ACE "high" — GENERIC_ALL
# 0x10000000, GENERIC_WRITE 0x40000000, GENERIC_READ 0x80000000 (kept as in
# the reference heuristics), FILE_WRITE_DATA 0x2, FILE_APPEND_DATA 0x4,
# FILE_WRITE_EA 0x10, FILE_EXECUTE 0x20.
HIGH_PERMISSION_BITS = (0x10000000, 0x40000000, 0x80000000, 0x00000002,
                        0x00000004, 0x00000010, 0x00000020)
HIGH_PERMISSION_MASK = 0
for _b in HIGH_PERMISSION_BITS:
    HIGH_PERMISSION_MASK |= _b

# Text that makes a mask "high" in the text heuristics.
HIGH_PERMISSION_WORDS = ("full", "modify", "write")

# Rights buckets (versioned constant, see README "rights buckets v1").
RIGHTS_BUCKET_VERSION = "rights-v1"
BUCKET_RANK = {"none": 0, "read": 1, "write": 2, "fullcontrol": 3}
GENERIC_ALL = 0x10000000
FILE_ALL_ACCESS = 0x1F01FF
WRITE_BITS = 0x40000000 | 0x2 | 0x4 | 0x10


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mask_text(mask) -> Column:
    """Mask as text (numbers rendered in decimal)."""
    return _c(mask).cast("string")


def _decimal(t: Column) -> Column:
    """BIGINT of decimal text, else null.  The digit test runs first so the
    cast only sees numbers (a failing cast per row is expensive)."""
    return F.when(t.rlike(r"^[+-]?[0-9]{1,19}$"), t.try_cast("bigint"))


def mask_to_int(mask) -> Column:
    """Integer value of a mask: numbers as is, ``0x..`` hex, decimal text, else 0.

    The decimal cast is tried first; hex parsing (``conv`` after cutting the
    ``0x``) runs only for text that starts with ``0x``.
    """
    m = F.trim(mask_text(mask))
    from_dec = _decimal(m)
    is_hex = m.rlike(r"^0[xX][0-9a-fA-F]{1,16}$")
    from_hex = F.conv(F.substring(m, 3, 16), 16, 10).try_cast("bigint")
    return (F.when(from_dec.isNotNull(), from_dec)
            .when(F.lower(F.substring(m, 1, 2)) == "0x", F.when(is_hex, F.coalesce(from_hex, F.lit(0)))
                  .otherwise(F.lit(0)))
            .otherwise(F.lit(0)).cast("bigint"))


def normalize_mask(mask, numeric: bool = False) -> Column:
    """null -> '' ; number -> '0x' + upper hex ; '0x..' text -> lower ; else as is."""
    m = _c(mask)
    if numeric:
        return F.when(m.isNull(), F.lit("")).otherwise(F.concat(F.lit("0x"), F.hex(m.cast("bigint"))))
    t = mask_text(m)
    return (F.when(t.isNull(), F.lit(""))
            .when(t.rlike(r"^0[xX]"), F.lower(t))
            .otherwise(t))


def _has_word(t: Column, words) -> Column:
    lt = F.lower(t)
    out = None
    for w in words:
        term = lt.contains(w)
        out = term if out is None else (out | term)
    return out


def high_perm_sql(mask) -> Column:
    """SQL-report heuristic: text holds full/modify/write, or the integer mask is not zero."""
    return F.coalesce(_has_word(mask_text(mask), HIGH_PERMISSION_WORDS), F.lit(False)) | (mask_to_int(mask) != 0)


def high_perm_bitmask(mask) -> Column:
    """Text full/modify/write, else any of the high bits is set in the integer mask."""
    t = mask_text(mask)
    v = mask_to_int(mask)
    bit_hit = (v.bitwiseAND(F.lit(HIGH_PERMISSION_MASK).cast("bigint")) != 0)
    return F.coalesce(_has_word(t, HIGH_PERMISSION_WORDS), F.lit(False)) | ((v != 0) & bit_hit)


def high_perm_simple(mask) -> Column:
    """Text full/modify/write, or a positive integer mask."""
    t = mask_text(mask)
    return F.coalesce(_has_word(t, HIGH_PERMISSION_WORDS), F.lit(False)) | (mask_to_int(mask) > 0)


def is_full_control(mask) -> Column:
    """Full control: text holding ``full`` (any case), or an integer mask
    (number, decimal or hex text) with GENERIC_ALL or every bit of
    FILE_ALL_ACCESS; null is false."""
    v = mask_to_int(mask)
    return (F.coalesce(F.lower(mask_text(mask)).contains("full"), F.lit(False))
            | (v.bitwiseAND(F.lit(GENERIC_ALL)) != 0)
            | (v.bitwiseAND(F.lit(FILE_ALL_ACCESS)) == F.lit(FILE_ALL_ACCESS)))


def rights_bucket(mask) -> Column:
    """Map a mask to none / read / write / fullcontrol (rights-v1).

    fullcontrol: text full or generic_all, GENERIC_ALL bit, or all bits of
    FILE_ALL_ACCESS; write: text write/modify/take-ownership/change-permission
    or a write bit; read: any other non-zero mask or text ``read``; else none.
    """
    t = F.lower(F.coalesce(mask_text(mask), F.lit("")))
    v = mask_to_int(mask)
    full = (t.contains("full") | t.contains("generic_all")
            | (v.bitwiseAND(F.lit(GENERIC_ALL)) != 0)
            | (v.bitwiseAND(F.lit(FILE_ALL_ACCESS)) == F.lit(FILE_ALL_ACCESS)))
    write = (t.contains("write") | t.contains("modify") | t.rlike("take.?own|change.?perm")
             | (v.bitwiseAND(F.lit(WRITE_BITS).cast("bigint")) != 0))
    read = t.contains("read") | (v != 0)
    return (F.when(full, F.lit("fullcontrol"))
            .when(write, F.lit("write"))
            .when(read, F.lit("read"))
            .otherwise(F.lit("none")))


def bucket_rank(bucket) -> Column:
    b = _c(bucket)
    expr = F.lit(0)
    for name, rank in BUCKET_RANK.items():
        expr = F.when(b == name, F.lit(rank)).otherwise(expr)
    return expr

