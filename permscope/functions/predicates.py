"""Identity and path predicates of the finders.

The defaults below name well-known SIDs and built-in accounts only; an estate's
own groups are configuration (every predicate takes its patterns).  Every
predicate is a case-insensitive substring test.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from permscope.functions.patterns import contains_any

# Names that mean "Everyone".
EVERYONE_PATTERNS = ("everyone", "s-1-1-0")

# Identities that stand for (nearly) everybody: well-known SIDs and the names Windows gives them.
BROAD_SIDS = {"s-1-1-0": "everyone", "s-1-5-11": "authenticated users", "s-1-5-32-545": "builtin\\users"}
BROAD_IDENTITIES = (*BROAD_SIDS, *BROAD_SIDS.values(), "domain users")

# Administrators: well-known SIDs, what Windows calls them, and any name that says so.
ADMIN_SIDS = ("s-1-5-18", "s-1-5-32-544", "s-1-22-1-0")
ADMIN_PATTERNS_FULL = ("admin", "nt authority\\system", *ADMIN_SIDS)
ADMIN_PATTERNS_SENSITIVE = ADMIN_PATTERNS_FULL

# Sensitive keyword groups (English and Spanish), in order;
# the first group whose pattern is a substring of the lower-case path wins.
KEYWORD_GROUPS = (
    ("HR", ("hr", "human resources", "recursos humanos", "rrhh")),
    ("Payroll", ("payroll", "nomina", "nómina", "salary", "sueldo", "salario")),
    ("Finance", ("finance", "finanzas", "accounting", "contabilidad", "tax", "taxes", "impuestos")),
    ("Legal", ("legal", "contracts", "contratos", "contract", "contrato")),
    ("Confidential", ("confidential", "confidencial", "sensitive", "privado", "private")),
    ("PII", ("pii", "personal data", "personal", "personnel", "identification", "identificacion")),
    ("Security", ("security", "seguridad", "itgc", "sox")),
    ("Health", ("health", "salud", "medical", "medico", "medicina")),
)

# Path words of the pattern reports.
BACKUP_WORDS = ("backup", "respaldo", "archive", "export")
SCRIPT_WORDS = ("scripts", "bin", "deploy", "install")
SERVICE_ACCOUNT_WORDS = ("$", "svc", "service")
GENERIC_LARGE_GROUPS = ("domain users", "authenticated users", "users", "everyone")


def is_everyone(name) -> Column:
    return contains_any(name, EVERYONE_PATTERNS)


def is_broad_identity(name, patterns=BROAD_IDENTITIES) -> Column:
    return contains_any(name, patterns)


def is_admin_name(name, patterns=ADMIN_PATTERNS_SENSITIVE) -> Column:
    return contains_any(name, patterns)


def match_keyword_group(path, groups=KEYWORD_GROUPS, word_boundary: bool = False) -> Column:
    """struct(keyword_group, matched_pattern) of the first hit, in list order; null if none.

    A lookup over a literal pattern array (a 50-branch CASE would exceed
    the codegen method size); ``word_boundary=True`` requires the pattern to stand
    as a word (so ``hr`` no longer hits ``chrome``).
    """
    lp = F.lower(F.coalesce(F.col(path) if isinstance(path, str) else path, F.lit("")))
    flat = [(g, p) for g, pats in groups for p in pats]
    pats = F.array(*[F.lit(p) for _, p in flat])
    names = F.array(*[F.lit(g) for g, _ in flat])
    if word_boundary:
        hit = F.transform(pats, lambda p: F.regexp_like(
            lp, F.concat(F.lit(r"(^|[^\p{L}\p{N}])\Q"), p, F.lit(r"\E([^\p{L}\p{N}]|$)"))))
    else:
        hit = F.transform(pats, lambda p: F.contains(lp, p))
    # first hit in list order (array_position is 1-based, 0 = none)
    idx = F.array_position(hit, True).cast("int")
    return F.when(idx > 0, F.struct(F.try_element_at(names, idx).alias("keyword_group"),
                                    F.try_element_at(pats, idx).alias("matched_pattern")))
