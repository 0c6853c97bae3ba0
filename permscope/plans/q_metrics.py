"""Catalogue: scalability metrics and share -> volume matching."""

from __future__ import annotations

from permscope.operators import metrics as MT
from permscope.plans import sqlparts as S
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx

_PARTS = "string_split(regexp_replace(folder_path, '^[\\\\]+|[\\\\]+$', '', 'g'), chr(92))"
_OK = f"(starts_with(folder_path, chr(92) || chr(92)) AND len({_PARTS}) >= 2)"

ENTRIES = f"""
SELECT run_id, source_file, folder_path, aces,
       CASE WHEN {_OK} THEN lower(split_part({_PARTS}[1], '.', 1)) END AS filer,
       CASE WHEN {_OK} THEN lower({_PARTS}[2]) END AS share
FROM (SELECT run_id, source_file, folder_path, COUNT(*) AS aces FROM src
      WHERE {S.valid_folder()} GROUP BY run_id, source_file, folder_path)"""

MATCHED = """
SELECT run_id, source_file, folder_path, filer, share, aces,
       CASE WHEN s_filer IS NULL THEN 'unknown'
            ELSE COALESCE(NULLIF(vn, ''), NULLIF(sn, ''), 'unknown') END AS volume_name,
       CASE WHEN s_filer IS NULL THEN '' ELSE guid END AS volume_guid
FROM (
  SELECT e.*, s.s_filer, s.sn, s.vn, s.guid,
         row_number() OVER (PARTITION BY e.run_id, e.source_file, e.folder_path ORDER BY s.row_no) AS rn
  FROM e LEFT JOIN (SELECT lower(COALESCE(filer_name, '')) AS s_filer, lower(COALESCE(share_name, '')) AS sn,
                           lower(COALESCE(volume_name, '')) AS vn, COALESCE(volume_guid, '') AS guid, row_no
                    FROM shares) s
    ON s.s_filer = e.filer AND e.filer <> '' AND e.share <> ''
       AND (s.sn = e.share OR s.vn = e.share OR contains(s.sn, e.share) OR contains(s.vn, e.share))
) WHERE rn = 1"""

_STATS = """COUNT(*) AS acl_entries, CAST(SUM(aces) AS BIGINT) AS total_aces, round(AVG(aces), 2) AS avg_aces_per_entry,
       MAX(aces) AS max_aces_per_entry, MIN(aces) AS min_aces_per_entry"""


@register("share_volume_match", "2.4", oracle("SELECT * FROM m", "aces", "shares", src="SELECT * FROM aces",
                                              e=ENTRIES, m=MATCHED))
def q_share_volume_match(spark, sf):
    return MT.share_volume_match(fx.aces(spark, sf), fx.shares(spark, sf))


@register("unknown_volume_entries", "2.4", oracle(
    "SELECT run_id AS run, source_file AS file, folder_path, aces AS aces_count FROM m WHERE volume_name = 'unknown'",
    "aces", "shares", src="SELECT * FROM aces", e=ENTRIES, m=MATCHED))
def q_unknown_volume_entries(spark, sf):
    return MT.unknown_volume_entries(fx.aces(spark, sf), fx.shares(spark, sf))


@register("scalability_totals", "2.5", oracle(f"""
SELECT f.run_id AS run, f.folderacl_files,
       COALESCE(t.acl_entries, 0) AS acl_entries, COALESCE(t.total_aces, 0) AS total_aces,
       COALESCE(t.avg_aces_per_entry, 0.0) AS avg_aces_per_entry,
       COALESCE(t.max_aces_per_entry, 0) AS max_aces_per_entry, COALESCE(t.min_aces_per_entry, 0) AS min_aces_per_entry
FROM (SELECT run_id, COUNT(DISTINCT source_file) AS folderacl_files FROM src GROUP BY run_id) f
LEFT JOIN (SELECT run_id, {_STATS} FROM e GROUP BY run_id) t USING (run_id)""",
    "aces", "aces_b", src="SELECT * FROM aces UNION ALL SELECT * FROM aces_b", e=ENTRIES))
def q_scalability_totals(spark, sf):
    return MT.scalability_totals(fx.aces_two_runs(spark, sf))


@register("scalability_per_host", "2.5", oracle(f"""
SELECT run_id AS run, COALESCE(filer, 'unknown') AS host, {_STATS}
FROM e GROUP BY run_id, COALESCE(filer, 'unknown')""", "aces", src="SELECT * FROM aces", e=ENTRIES))
def q_scalability_per_host(spark, sf):
    return MT.scalability_per_host(fx.aces(spark, sf))


@register("scalability_per_volume", "2.5", oracle(f"""
SELECT run_id AS run, volume_name, arg_min(volume_guid, source_file || chr(0) || folder_path) AS volume_guid, {_STATS}
FROM m GROUP BY run_id, volume_name""", "aces", "shares", src="SELECT * FROM aces", e=ENTRIES, m=MATCHED))
def q_scalability_per_volume(spark, sf):
    return MT.scalability_per_volume(fx.aces(spark, sf), fx.shares(spark, sf))
