"""Folder-path helpers (UNC paths use the backslash, ``chr(92)``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BS = "\\"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def last_path_component(path) -> Column:
    """Last non-empty segment after stripping trailing ``/`` and ``\\``."""
    p = F.coalesce(_c(path).cast("string"), F.lit(""))
    return F.regexp_extract(p, r"([^/\\]+)[/\\]*$", 1)


def _strip_slashes(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^[/\\]+|[/\\]+$", "")


def canonical_folder_path(host, share, unc, source_file) -> Column:
    """``\\\\host\\share\\leaf`` when host, share and leaf are present; else the
    UNC path; else the source file.  Empty strings count as absent."""
    h, s, u = _c(host), _c(share), _c(unc)
    leaf = last_path_component(u)
    ok = (F.coalesce(h, F.lit("")) != "") & (F.coalesce(s, F.lit("")) != "") & (leaf != "")
    built = F.concat(F.lit(BS + BS), h, F.lit(BS), _strip_slashes(s), F.lit(BS), _strip_slashes(leaf))
    return (F.when(ok, built)
            .when(F.coalesce(u, F.lit("")) != "", u)
            .otherwise(_c(source_file)))


def parse_unc(path) -> Column:
    """``\\\\a.b.c\\share\\..`` -> struct(filer='a', share='share'), lower case; null
    when there are fewer than two parts."""
    p = F.regexp_replace(F.trim(F.coalesce(_c(path), F.lit(""))), r"^[\\]+", "")
    parts = F.split(p, r"[\\]")
    ok = (F.size(parts) >= 2) & (F.try_element_at(parts, F.lit(1)) != "")
    filer = F.lower(F.split_part(F.try_element_at(parts, F.lit(1)), F.lit("."), F.lit(1)))
    share = F.lower(F.try_element_at(parts, F.lit(2)))
    return F.when(ok, F.struct(filer.alias("filer"), share.alias("share")))


def valid_folder(path) -> Column:
    """Path is not null, not blank and not the text 'nan'."""
    t = F.lower(F.trim(_c(path)))
    return _c(path).isNotNull() & (t != "") & (t != "nan")


def path_segments(path) -> Column:
    """Non-empty segments of a UNC / posix path."""
    return F.regexp_extract_all(F.coalesce(_c(path), F.lit("")), F.lit(r"([^/\\]+)"), F.lit(1))


def path_depth(path) -> Column:
    return F.regexp_count(F.coalesce(_c(path), F.lit("")), F.lit(r"[^/\\]+"))


def ancestors(path, min_depth: int = 2) -> Column:
    """All proper ancestor paths (as UNC text) of depth >= ``min_depth``.

    ``\\\\h\\s\\a\\b`` -> [``\\\\h\\s``, ``\\\\h\\s\\a``] for min_depth 2.
    """
    segs = path_segments(path)
    n = F.size(segs)
    return F.when(n > min_depth, F.transform(
        F.sequence(F.lit(min_depth), n - 1),
        lambda d: F.concat(F.lit(BS + BS), F.array_join(F.slice(segs, 1, d), BS)),
    )).otherwise(F.array().cast("array<string>"))
