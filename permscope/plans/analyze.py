"""End-to-end run analysis as one Spark job chain.

    folder-ACL JSON of a run -> ACE Parquet (partitioned by run)
    -> rule matches -> findings CSV -> findings split by severity
    -> the SQL reports

Each step reads the previous step's written output, so a failed step is
re-run from its input and every write is an idempotent overwrite (dynamic
partition overwrite for the ACE store).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from permscope.operators import reports as R
from permscope.operators.rules import apply_rules, split_by_severity
from permscope.session import apply_engine_conf
from permscope.sources.acl_json import ingest_acl_json, malformed_files, read_folderacl_files
from permscope.sources.parquet import read_aces, write_aces, write_findings_csv
from permscope.sources.ruleset import load_ruleset

REPORTS = {
    "top_identities_high_perms": R.top_identities_high_perms,
    "ace_counts_by_appliance": R.ace_counts_by_appliance,
    "inherited_exposures": R.inherited_exposures,
    "fingerprint_variants": R.fingerprint_variants,
    "owners_without_admin_ace": R.owners_without_admin_ace,
}


def analyze_run(spark: SparkSession, runs_root: str, out_dir: str, ruleset=None,
                min_severity: str | None = None, json_lines: bool = False,
                reports: bool = True) -> dict[str, DataFrame]:
    """Ingest every run below ``runs_root`` and write ACEs, findings, the
    severity split and the SQL reports under ``out_dir``.  Returns the
    written tables (read back) by name; a run with malformed files goes on,
    the files are listed in ``quarantine``."""
    apply_engine_conf(spark)
    out = out_dir.rstrip("/")
    rs = load_ruleset(ruleset)

    files = read_folderacl_files(spark, runs_root, json_lines=json_lines)
    malformed_files(files).write.mode("overwrite").parquet(f"{out}/quarantine")
    write_aces(ingest_acl_json(spark, runs_root, json_lines=json_lines), f"{out}/aces")

    aces = read_aces(spark, f"{out}/aces")
    matches = apply_rules(aces, rs, min_severity=min_severity, keep=("run_id",))
    matches.write.mode("overwrite").partitionBy("run_id").parquet(f"{out}/findings")
    findings = spark.read.parquet(f"{out}/findings")
    write_findings_csv(findings.drop("run_id"), f"{out}/findings_csv")
    split_by_severity(findings, f"{out}/findings_by_severity")

    result = {"aces": aces, "findings": findings, "quarantine": spark.read.parquet(f"{out}/quarantine")}
    if reports:
        for name, fn in REPORTS.items():
            fn(aces).write.mode("overwrite").option("header", True).csv(f"{out}/reports/{name}")
            result[name] = spark.read.option("header", True).csv(f"{out}/reports/{name}")
    return result
