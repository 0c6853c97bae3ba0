"""Catalogue: the SQL reports, aggregations and row-shaping helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from permscope.functions import masks as M
from permscope.functions import paths as P
from permscope.functions.names import resolve_name, resolve_name_or_raw, resolve_name_wide
from permscope.operators import reports as R
from permscope.plans import sqlparts as S
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx

HP = S.high_perm()


@register("top_identities_high_perms", "2.5", oracle(f"""
SELECT ace_name, COUNT(DISTINCT folder_path) AS folders_with_high_perms
FROM aces WHERE {HP}
GROUP BY ace_name
ORDER BY folders_with_high_perms DESC, ace_name ASC NULLS LAST
LIMIT 200""", "aces"))
def q_top_identities(spark, sf):
    return R.top_identities_high_perms(fx.aces(spark, sf))


@register("ace_counts_by_appliance", "2.5", oracle("""
SELECT COALESCE(appliance_hostname, 'unknown') AS appliance_hostname, COUNT(*) AS ace_count
FROM aces GROUP BY COALESCE(appliance_hostname, 'unknown')
ORDER BY ace_count DESC, appliance_hostname ASC NULLS LAST
LIMIT 200""", "aces"))
def q_ace_counts_by_appliance(spark, sf):
    return R.ace_counts_by_appliance(fx.aces(spark, sf))


@register("inherited_exposures", "2.5", oracle(f"""
SELECT folder_path, ace_name, ace_mask, ace_inherited
FROM aces WHERE ace_inherited = TRUE AND {HP}
ORDER BY folder_path ASC NULLS LAST, ace_name ASC NULLS LAST, ace_mask ASC NULLS LAST
LIMIT 1000""", "aces"))
def q_inherited_exposures(spark, sf):
    return R.inherited_exposures(fx.aces(spark, sf))


@register("fingerprint_variants", "2.5", oracle("""
SELECT folder_path, COUNT(DISTINCT fingerprint_sha256) AS fingerprint_variants
FROM aces GROUP BY folder_path
HAVING COUNT(DISTINCT fingerprint_sha256) > 1
ORDER BY fingerprint_variants DESC, folder_path ASC NULLS LAST
LIMIT 200""", "aces"))
def q_fingerprint_variants(spark, sf):
    return R.fingerprint_variants(fx.aces(spark, sf))


@register("owners_without_admin_ace", "2.4", oracle("""
SELECT o.folder_path, o.owner
FROM (SELECT folder_path, owner FROM aces WHERE owner IS NOT NULL GROUP BY folder_path, owner) o
LEFT JOIN (SELECT DISTINCT folder_path FROM aces
           WHERE lower(COALESCE(ace_name, '')) LIKE '%admin%') a
  ON a.folder_path = o.folder_path
WHERE a.folder_path IS NULL
ORDER BY o.folder_path ASC NULLS LAST, o.owner ASC NULLS LAST
LIMIT 200""", "aces"))
def q_owners_without_admin_ace(spark, sf):
    return R.owners_without_admin_ace(fx.aces(spark, sf))


@register("distinct_folders", "2.8", oracle("SELECT DISTINCT folder_path FROM aces", "aces"))
def q_distinct_folders(spark, sf):
    return R.distinct_folders(fx.aces(spark, sf))


@register("distinct_folder_owner", "2.8", oracle(
    "SELECT DISTINCT folder_path, owner FROM aces WHERE owner IS NOT NULL", "aces"))
def q_distinct_folder_owner(spark, sf):
    return fx.aces(spark, sf).filter(F.col("owner").isNotNull()).select("folder_path", "owner").distinct()


@register("sid_set", "2.8", oracle(
    "SELECT DISTINCT ace_sid FROM aces WHERE ace_sid IS NOT NULL AND ace_sid <> ''", "aces"))
def q_sid_set(spark, sf):
    return R.sid_set(fx.aces(spark, sf))


@register("concat_runs", "2.8", oracle("""
SELECT run_id, COUNT(*) AS ace_rows, COUNT(DISTINCT folder_path) AS folders
FROM (SELECT * FROM aces UNION ALL SELECT * FROM aces_b) GROUP BY run_id""", "aces", "aces_b"))
def q_concat_runs(spark, sf):
    both = fx.aces_two_runs(spark, sf)
    return both.groupBy("run_id").agg(F.count(F.lit(1)).alias("ace_rows"),
                                      F.countDistinct("folder_path").alias("folders"))


@register("folder_ace_counts", "2.5", oracle(
    "SELECT run_id, COALESCE(folder_path, '') AS folder_path, COUNT(*) AS ace_count FROM aces "
    "GROUP BY run_id, COALESCE(folder_path, '')", "aces"))
def q_folder_ace_counts(spark, sf):
    return R.folder_ace_counts(fx.aces(spark, sf))


@register("duplicate_aces", "2.5", oracle(f"""
SELECT run_id, COALESCE(folder_path, '') AS folder_path, {S.res_name()} AS ace_name, COUNT(*) AS ace_count
FROM aces GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""", "aces"))
def q_duplicate_aces(spark, sf):
    return R.duplicate_aces(fx.aces(spark, sf))


# --- row-shaping and scalar functions, checked over every distinct value ---

@register("mask_classification", "2.9", oracle(f"""
SELECT ace_mask,
  CASE WHEN regexp_matches(trim(ace_mask), '^[+-]?[0-9]{{1,19}}$') OR regexp_matches(trim(ace_mask), '^0[xX][0-9a-fA-F]{{1,16}}$')
       THEN COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) ELSE 0 END AS mask_int,
  ace_mask AS mask_normalized,
  (contains(lower(ace_mask), 'full') OR contains(lower(ace_mask), 'modify') OR contains(lower(ace_mask), 'write')
     OR COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT) <> 0, false)) AS high_sql,
  (regexp_matches(ace_mask, '(?i)full|fullcontrol|modify|write')
     OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 3489660982) <> 0) AS high_bitmask,
  (regexp_matches(ace_mask, '(?i)full|fullcontrol|modify|write')
     OR COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) > 0) AS high_simple,
  {S.is_full()} AS full_control,
  CASE WHEN regexp_matches(lower(ace_mask), 'full|generic_all')
            OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 268435456) <> 0
            OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 2032127) = 2032127 THEN 'fullcontrol'
       WHEN regexp_matches(lower(ace_mask), 'write|modify|take.?own|change.?perm')
            OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 1073741846) <> 0 THEN 'write'
       WHEN contains(lower(ace_mask), 'read') OR COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) <> 0 THEN 'read'
       ELSE 'none' END AS rights_bucket
FROM (SELECT DISTINCT ace_mask FROM aces)""", "aces"))
def q_mask_classification(spark, sf):
    m = fx.aces(spark, sf).select("ace_mask").distinct()
    return m.select(
        "ace_mask",
        M.mask_to_int("ace_mask").alias("mask_int"),
        M.normalize_mask("ace_mask").alias("mask_normalized"),
        M.high_perm_sql("ace_mask").alias("high_sql"),
        M.high_perm_bitmask("ace_mask").alias("high_bitmask"),
        M.high_perm_simple("ace_mask").alias("high_simple"),
        M.is_full_control("ace_mask").alias("full_control"),
        M.rights_bucket("ace_mask").alias("rights_bucket"),
    )


@register("resolved_names", "2.2", oracle(f"""
SELECT ace_name, ace_raw, {S.res_name()} AS res_name,
       CASE WHEN ace_raw IS NULL OR ace_raw = '' THEN ''
            ELSE COALESCE(json_extract_string(ace_raw, '$.name'), json_extract_string(ace_raw, '$.identity'), ace_raw) END AS raw_or_name,
       COALESCE(NULLIF(TRIM(ace_name), ''),
                CASE WHEN ace_raw IS NULL OR ace_raw = '' THEN ''
                     ELSE TRIM(COALESCE(NULLIF(json_extract_string(ace_raw, '$.name'), ''),
                                        NULLIF(json_extract_string(ace_raw, '$.identity'), ''), ace_raw)) END) AS res_name_wide
FROM (SELECT DISTINCT ace_name, ace_raw FROM aces)""", "aces"))
def q_resolved_names(spark, sf):
    d = fx.aces(spark, sf).select("ace_name", "ace_raw").distinct()
    return d.select("ace_name", "ace_raw",
                    resolve_name("ace_name", "ace_raw").alias("res_name"),
                    resolve_name_or_raw("ace_raw").alias("raw_or_name"),
                    resolve_name_wide("ace_name", "ace_raw").alias("res_name_wide"))


@register("path_parts", "2.2", oracle(r"""
SELECT folder_path,
  COALESCE(list_filter(regexp_split_to_array(COALESCE(folder_path, ''), '[/\\]'), lambda x: x <> '')[-1], '') AS leaf,
  CASE WHEN len(string_split(regexp_replace(trim(COALESCE(folder_path, '')), '^[\\]+', ''), chr(92))) >= 2
        AND string_split(regexp_replace(trim(COALESCE(folder_path, '')), '^[\\]+', ''), chr(92))[1] <> ''
       THEN lower(split_part(string_split(regexp_replace(trim(COALESCE(folder_path, '')), '^[\\]+', ''), chr(92))[1], '.', 1)) END AS filer,
  CASE WHEN len(string_split(regexp_replace(trim(COALESCE(folder_path, '')), '^[\\]+', ''), chr(92))) >= 2
        AND string_split(regexp_replace(trim(COALESCE(folder_path, '')), '^[\\]+', ''), chr(92))[1] <> ''
       THEN lower(string_split(regexp_replace(trim(COALESCE(folder_path, '')), '^[\\]+', ''), chr(92))[2]) END AS share,
  len(list_filter(regexp_split_to_array(COALESCE(folder_path, ''), '[/\\]'), lambda x: x <> ''))::INTEGER AS depth,
  (folder_path IS NOT NULL AND trim(folder_path) <> '' AND lower(trim(folder_path)) <> 'nan') AS is_valid,
  CASE WHEN appliance_hostname <> '' AND share_name <> '' AND
            COALESCE(list_filter(regexp_split_to_array(COALESCE(unc_path, ''), '[/\\]'), lambda x: x <> '')[-1], '') <> ''
       THEN chr(92) || chr(92) || appliance_hostname || chr(92) || share_name || chr(92) ||
            list_filter(regexp_split_to_array(unc_path, '[/\\]'), lambda x: x <> '')[-1]
       WHEN COALESCE(unc_path, '') <> '' THEN unc_path ELSE source_file END AS canonical_path
FROM (SELECT DISTINCT folder_path, unc_path, appliance_hostname, share_name, source_file FROM aces)""", "aces"))
def q_path_parts(spark, sf):
    d = fx.aces(spark, sf).select("folder_path", "unc_path", "appliance_hostname", "share_name",
                                  "source_file").distinct()
    u = P.parse_unc("folder_path")
    return d.select(
        "folder_path",
        P.last_path_component("folder_path").alias("leaf"),
        u.getField("filer").alias("filer"),
        u.getField("share").alias("share"),
        P.path_depth("folder_path").alias("depth"),
        P.valid_folder("folder_path").alias("is_valid"),
        P.canonical_folder_path("appliance_hostname", "share_name", "unc_path", "source_file").alias("canonical_path"),
    )
