"""Catalogue: JSON ingest (round trip through exporter-shaped documents),
text-level run summary, manifest and contract audits."""

from __future__ import annotations

from permscope.operators import audit as AU
from permscope.plans.registry import oracle, register
from permscope.sources import acl_json as AJ
from permscope.sources import fixtures as fx

_REC_KEYS = ("run_id, source_file, unc_path, appliance_hostname, share_name, volume_name, volume_guid, owner, "
             "collected_utc, collection_host, fingerprint_sha256")

_RT_COLS = ["run_id", "source_file", "folder_path", "unc_path", "ace_sid", "ace_name", "ace_type", "ace_mask",
            "ace_inherited", "collected_utc", "collection_host", "appliance_hostname", "volume_name",
            "volume_guid", "share_name", "owner", "fingerprint_sha256"]


def _docs(spark, sf):
    return AJ.aces_to_documents(fx.aces(spark, sf))


@register("json_ingest_roundtrip", "2.2", oracle("""
SELECT run_id, source_file, unc_path AS folder_path, unc_path, ace_sid, ace_name, ace_type, ace_mask,
       ace_inherited, collected_utc, collection_host, appliance_hostname, volume_name, volume_guid, share_name,
       owner, fingerprint_sha256
FROM aces""", "aces"))
def q_json_ingest_roundtrip(spark, sf):
    # ACE table -> exporter JSON documents -> generic node search -> ACE rows
    nodes = AJ.acl_nodes(_docs(spark, sf))
    return AJ.nodes_to_aces(nodes).select(*_RT_COLS)


@register("json_ingest_typed", "2.2", oracle("""
SELECT run_id, source_file, unc_path AS folder_path, unc_path, ace_sid, ace_name, ace_type, ace_mask,
       ace_inherited, collected_utc, collection_host, appliance_hostname, volume_name, volume_guid, share_name,
       owner, fingerprint_sha256
FROM aces""", "aces"))
def q_json_ingest_typed(spark, sf):
    # same documents through the fixed-schema fast path (no node search)
    return AJ.typed_aces(_docs(spark, sf)).select(*_RT_COLS)


@register("run_text_summary", "2.5", oracle(f"""
SELECT f.run_id, f.files, a.aces_approx, a.distinct_sids
FROM (SELECT run_id, COUNT(*) AS files FROM (SELECT DISTINCT {_REC_KEYS} FROM aces) GROUP BY run_id) f
JOIN (SELECT run_id, COUNT(*) AS aces_approx, COUNT(DISTINCT ace_sid) AS distinct_sids FROM aces
      GROUP BY run_id) a USING (run_id)""", "aces"))
def q_run_text_summary(spark, sf):
    return AJ.run_text_summary(_docs(spark, sf))


@register("run_manifest", "2.11", oracle("""
SELECT run_id,
       COUNT(DISTINCT appliance_hostname) AS appliances, COUNT(DISTINCT volume_name) AS volumes,
       COUNT(DISTINCT COALESCE(appliance_hostname, '') || chr(92) || COALESCE(share_name, '')) AS shares,
       COUNT(DISTINCT folder_path) AS folders, COUNT(*) AS ace_rows, COUNT(DISTINCT source_file) AS files,
       MIN(collected_utc) AS collected_from, MAX(collected_utc) AS collected_to
FROM (SELECT * FROM aces UNION ALL SELECT * FROM aces_b) GROUP BY run_id""", "aces", "aces_b"))
def q_run_manifest(spark, sf):
    return AU.run_manifest(fx.aces_two_runs(spark, sf))


@register("contract_audit", "2.11", oracle("""
SELECT run_id, COUNT(*) AS ace_rows,
       CAST(SUM(CASE WHEN folder_path IS NULL OR trim(folder_path) = '' OR lower(trim(folder_path)) = 'nan'
                THEN 1 ELSE 0 END) AS BIGINT) AS bad_folder_path,
       CAST(SUM(CASE WHEN ace_sid IS NULL OR ace_sid = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_sid,
       CAST(SUM(CASE WHEN ace_name IS NULL OR trim(ace_name) = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_name,
       CAST(SUM(CASE WHEN ace_mask IS NULL OR ace_mask = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_mask,
       CAST(SUM(CASE WHEN ace_inherited IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_inherited,
       CAST(SUM(CASE WHEN collected_utc IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_collected_utc,
       CAST(SUM(CASE WHEN ace_type IS NULL OR lower(ace_type) NOT IN ('allow', 'deny') THEN 1 ELSE 0 END) AS BIGINT)
         AS unknown_ace_type
FROM (SELECT * FROM aces UNION ALL SELECT * FROM aces_b) GROUP BY run_id""", "aces", "aces_b"))
def q_contract_audit(spark, sf):
    return AU.contract_audit(fx.aces_two_runs(spark, sf))


@register("contract_violations", "2.11", oracle(f"""
SELECT run_id, source_file, field, rule, COUNT(*) AS records FROM (
  SELECT run_id, source_file, unnest(list_filter([
    CASE WHEN unc_path IS NULL THEN 'UncPath required' END,
    CASE WHEN collected_utc IS NULL THEN 'CollectedUtc required' ELSE 'CollectedUtc format' END,
    CASE WHEN collection_host IS NULL THEN 'CollectionHost required' END,
    'Collector required', CASE WHEN owner IS NULL THEN 'Owner required' END, 'Sddl required',
    CASE WHEN fingerprint_sha256 IS NULL THEN 'FingerprintSha256 required' END, 'CollectionSha256 required'], lambda x: x IS NOT NULL)) AS x,
    split_part(x, ' ', 1) AS field, split_part(x, ' ', 2) AS rule
  FROM (SELECT DISTINCT {_REC_KEYS} FROM aces))
GROUP BY ALL""", "aces"))
def q_contract_violations(spark, sf):
    # exporter documents (arrays of one record) against the exporter's own record schema, rule by rule
    from pyspark.sql import functions as F

    from permscope.operators import contract as CT
    records = _docs(spark, sf).withColumn("text", F.explode(F.from_json("text", "array<string>")))
    return CT.violations_per_file(CT.violations(records, CT.exporter_contract()))


@register("ingest_ready_check", "2.11", oracle("""
SELECT m.run_id, m.files AS files_found, (SELECT COUNT(*) FROM nation) AS expected_files,
       m.files = (SELECT COUNT(*) FROM nation) AS ready
FROM (SELECT run_id, COUNT(DISTINCT source_file) AS files FROM aces GROUP BY run_id) m""", "aces"))
def q_ingest_ready_check(spark, sf):
    # expected inputs: one folder-ACL file per filer (one filer per nation);
    # the inventory count is one number, read from the (tiny) inventory table
    from permscope.sources.tables import table
    expected = table(spark, sf, "nation").count()
    return AU.ingest_ready_check(fx.aces(spark, sf), expected)


_STREAM_COLS = [c for c in _RT_COLS if c != "source_file"]


@register("incremental_ingest", "2.10", oracle("""
SELECT run_id, unc_path AS folder_path, unc_path, ace_sid, ace_name, ace_type, ace_mask,
       ace_inherited, collected_utc, collection_host, appliance_hostname, volume_name, volume_guid, share_name,
       owner, fingerprint_sha256
FROM aces""", "aces"))
def q_incremental_ingest(spark, sf):
    # exporter documents derived from the tables are dropped as JSON Lines
    # files into a landing folder under the shared checkpoint folder; an
    # availableNow stream ingests them into Parquet; the result must equal
    # the batch ingest
    import uuid

    from permscope.session import checkpoint_dir
    from permscope.streaming.ingest import incremental_ingest, read_ingested

    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    _docs(spark, sf).select("text").write.text(f"{base}/landing/run-a/folderacls")
    incremental_ingest(spark, f"{base}/landing", f"{base}/aces", f"{base}/progress", json_lines=True, glob="*.txt")
    return read_ingested(spark, f"{base}/aces").select(*_STREAM_COLS)
