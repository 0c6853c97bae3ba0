"""Folder-ACL JSON ingest: heterogeneous exporter files -> the ACE table.

Files are read whole (one folder-ACL export per file, as the collector
writes them) with ``spark.read.text(wholetext=True)``; every later step is a
Column expression, so parsing runs in parallel over files and nothing
passes through the driver.

Shape-agnostic node search, level by level: each level maps a row to an
array of rows and explodes it.  A JSON array becomes its elements; a JSON
object whose key (any case) is one of ``ACL_KEYS`` with a list value is an
*ACL node* (emitted once); the object's other object/array values become
the next level's items.  Each level is checkpointed (shared folder), so it is
parsed once and no executor holds it; the search goes on until no item is left,
however deep the document.  Files that are no single JSON value (unparsable,
or with text after the value) are quarantined as a whole.

Each node then yields one row per ACE of its first ACL list (document
order).  Field names are matched case-insensitively through a lower-cased
``map<string,string>`` (duplicate keys: last wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permscope.functions.paths import canonical_folder_path
from permscope.session import apply_engine_conf, checkpoint_dir

# Keys that hold an ACL list.
ACL_KEYS = ("acl", "acls", "aces", "acllist", "access", "accesslist", "rights", "permissions")

# Case-insensitive ACE field picks, first present wins.
SID_KEYS = ("sid", "principalid", "accountid")
NAME_KEYS = ("name", "displayname", "identity", "identityreference", "account", "accountname",
             "principal", "user", "group", "grantee")
TYPE_KEYS = ("type", "ace_type", "acetype")
MASK_KEYS = ("mask", "rights", "permissions", "access", "accessmask")
INHERITED_KEYS = ("inherited", "isinherited")

# Record metadata (output column -> lower-case source keys).
META_KEYS = {
    "collected_utc": ("collectedutc",),
    "collection_host": ("collectionhost", "host"),
    "collector": ("collector",),
    "appliance_hostname": ("appliancehostname",),
    "appliance_description": ("appliancedescription",),
    "appliance_serial": ("applianceserialnumber",),
    "volume_name": ("volumename",),
    "volume_guid": ("volumeguid",),
    "share_name": ("sharename",),
    "owner": ("owner",),
    "sddl": ("sddl",),
    "fingerprint_sha256": ("fingerprintsha256",),
    "collection_sha256": ("collectionsha256",),
}

ACE_SCHEMA_COLUMNS = [
    "run_id", "source_file", "folder_path", "unc_path", "ace_sid", "ace_name", "ace_type", "ace_mask",
    "ace_inherited", "ace_raw", "collected_utc", "collection_host", "collector", "appliance_hostname",
    "appliance_description", "appliance_serial", "volume_name", "volume_guid", "share_name", "attributes",
    "owner", "sddl", "fingerprint_sha256", "collection_sha256",
]

_ITEM = "struct<kind:string,text:string>"


def read_folderacl_files(spark: SparkSession, root: str, schema_name_pattern: str = "(?i)schema",
                         json_lines: bool = False) -> DataFrame:
    """(source_file, file_name, run_id, text) of every ``*.json`` under a
    ``folderacls`` directory below ``root``; schema files are skipped.

    By default a file is one JSON document (read whole: one task per file,
    at most 2 GB per document).  ``json_lines=True`` reads one document per
    line, so a large export is split across tasks."""
    reader = spark.read.format("text").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    if not json_lines:
        reader = reader.option("wholetext", True)
    df = (reader.load(root)
          .select(F.col("_metadata.file_path").alias("source_file"),
                  F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")))
    df = df.filter(F.col("source_file").contains("folderacls/") & ~F.col("file_name").rlike(schema_name_pattern))
    return df.withColumn("run_id", F.regexp_extract("source_file", r"([^/]+)/folderacls/[^/]*$", 1))


def folderacl_file_audit(spark: SparkSession, root: str, schema_name_pattern: str = "(?i)schema") -> DataFrame:
    """Per run: JSON files found under ``folderacls``, skipped as schema
    artifacts, malformed, holding at least one ACL node, and without one —
    reported apart instead of folded into one file count."""
    raw = (spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.json")
           .option("recursiveFileLookup", True).load(root)
           .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("file_name"),
                   F.col("value").alias("text"))
           .filter(F.col("source_file").contains("folderacls/"))
           .withColumn("run_id", F.regexp_extract("source_file", r"([^/]+)/folderacls/[^/]*$", 1)))
    skipped = F.col("file_name").rlike(schema_name_pattern)
    files = raw.filter(~skipped)
    bad = malformed_files(files).select("source_file").withColumn("_bad", F.lit(True))
    with_acl = acl_nodes(files).select("source_file").distinct().withColumn("_acl", F.lit(True))
    per_file = (raw.select("run_id", "source_file", skipped.alias("_skip"))
                .join(bad, "source_file", "left").join(with_acl, "source_file", "left"))
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    ok = ~F.col("_skip") & F.col("_bad").isNull()
    return per_file.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("files_found"),
        flag(F.col("_skip")).alias("files_skipped"),
        flag(F.col("_bad").isNotNull()).alias("files_malformed"),
        flag(ok & F.col("_acl").isNotNull()).alias("files_with_acl"),
        flag(ok & F.col("_acl").isNull()).alias("files_without_acl"))


def _strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^\\uFEFF", "")


def _starts(c: Column, ch: str) -> Column:
    return F.ltrim(c, F.lit(" \t\r\n")).startswith(ch)  # JSON white space


def _lower_map(text: Column) -> Column:
    return F.transform_keys(F.from_json(text, "map<string,string>"), lambda k, v: F.lower(k))


def _is_acl_key(k: Column, m: Column) -> Column:
    return F.lower(k).isin(*ACL_KEYS) & F.coalesce(_starts(m[k], "["), F.lit(False))


def _expand(item: Column, as_arr: Column, m: Column) -> Column:
    """One level: item (with its text parsed once as an array ``as_arr`` or an
    object ``m``) -> array of next-level rows."""
    kind, text = item.getField("kind"), item.getField("text")
    keys = F.map_keys(m)
    is_node = F.exists(keys, lambda k: _is_acl_key(k, m))
    children = F.transform(
        F.filter(keys, lambda k: ~_is_acl_key(k, m) & (F.coalesce(_starts(m[k], "{"), F.lit(False))
                                                      | F.coalesce(_starts(m[k], "["), F.lit(False)))),
        lambda k: F.struct(F.lit("item").alias("kind"), m[k].alias("text")))
    node = F.array(F.struct(F.lit("node").alias("kind"), text.alias("text")))
    empty = F.array().cast(f"array<{_ITEM}>")
    from_obj = F.concat(F.when(is_node, node).otherwise(empty), F.coalesce(children, empty))
    from_arr = F.transform(F.filter(as_arr, lambda x: _starts(x, "{") | _starts(x, "[")),
                           lambda x: F.struct(F.lit("item").alias("kind"), x.alias("text")))
    return (F.when(kind == "node", F.array(item))
            .when(as_arr.isNotNull(), F.coalesce(from_arr, empty))
            .when(m.isNotNull(), F.coalesce(from_obj, empty))
            .otherwise(empty))


def _parsed(cur: DataFrame) -> DataFrame:
    """Parse each item once, in its own projection (the expansion refers to
    the parsed value many times)."""
    text = F.col("it.text")
    item = F.col("it.kind") == "item"
    return cur.select("run_id", "source_file", "it",
                      F.when(item & _starts(text, "["), F.from_json(text, "array<string>")).alias("_arr"),
                      F.when(item & _starts(text, "{"), F.from_json(text, "map<string,string>")).alias("_m"))


def well_formed(text: Column) -> Column:
    """Is the text exactly one JSON value (an object or an array)?

    ``from_json`` stops after the first value, so the text is also parsed
    inside an array and inside an object: whatever follows the value breaks
    one of the two.
    """
    t = _strip_bom(text)
    in_array = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>")
    in_object = F.from_json(F.concat(F.lit('{"v":'), t, F.lit("}")), "map<string,string>")
    container = _starts(t, "{") | _starts(t, "[")
    return F.coalesce(container & (F.size(in_array) == 1) & (F.size(in_object) == 1), F.lit(False))


def acl_nodes(files: DataFrame) -> DataFrame:
    """(run_id, source_file, node) — every ACL node of every well-formed file.

    Level by level: each level is expanded once and checkpointed, its nodes
    are set aside and only its remaining items go on; the loop ends when no
    item is left (two or three levels for exporter files).
    """
    checkpoint_dir(files.sparkSession)
    cur = files.filter(well_formed(F.col("text"))).select(
        "run_id", "source_file",
        F.struct(F.lit("item").alias("kind"), _strip_bom(F.col("text")).alias("text")).alias("it"))
    found = []
    while True:
        nxt = _parsed(cur).select("run_id", "source_file",
                                  F.explode(_expand(F.col("it"), F.col("_arr"), F.col("_m"))).alias("it"))
        nxt = nxt.checkpoint()
        found.append(nxt.filter(F.col("it.kind") == "node"))
        cur = nxt.filter(F.col("it.kind") == "item")
        if cur.isEmpty():
            break
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("run_id", "source_file", F.col("it.text").alias("node"))


def malformed_files(files: DataFrame) -> DataFrame:
    """Files that are not exactly one JSON object or array (quarantine)."""
    return files.filter(~well_formed(F.col("text"))).select("run_id", "source_file", F.lit("unparsable JSON").alias("reason"))


def _pick(m: Column, keys) -> Column:
    return F.coalesce(*[m[k] for k in keys])


def _or_pick(m: Column, keys) -> Column:
    """Python ``a or b``: empty strings fall through."""
    return F.coalesce(*[F.nullif(m[k], F.lit("")) for k in keys])


# Folder-path candidates of the legacy finders, in order.
LEGACY_PATH_KEYS = ("uncpath", "sharepath", "sharename", "volumename", "path", "folder", "name", "folderpath",
                    "folder_path")


def _each(df: DataFrame, items: str, names: list[str]) -> DataFrame:
    """One row per element of the computed array ``items`` (position and element, or the element alone).

    An outer explode and a test of its output: from a plain one Spark infers a
    filter on ``items`` that, pushed down, computes the array a second time.
    """
    explode = F.posexplode_outer if len(names) == 2 else F.explode_outer
    # the arrays' elements are never null where the position is left out
    out = df.select(*[c for c in df.columns if c != items], explode(items).alias(*names))
    return out.where(F.col(names[0]).isNotNull())


def legacy_folder_path(node: Column, source_file: Column) -> Column:
    """Folder path as the legacy finders pick it: the first present candidate
    key of the node, else the file path."""
    m = _lower_map(node)
    return F.coalesce(_or_pick(m, LEGACY_PATH_KEYS), source_file)


def _parse_bool(c: Column) -> Column:
    lc = F.lower(F.trim(c))
    return (F.when(lc.isin("true", "1", "yes"), F.lit(True))
            .when(lc.isin("false", "0", "no", ""), F.lit(False)))


def nodes_to_aces(nodes: DataFrame, compat_any_list: bool = False) -> DataFrame:
    """One row per ACE of each node's first ACL list.  Each node and each ACE
    is parsed once (separate projections), then fields are picked from the
    lower-cased maps."""
    parsed = nodes.select("run_id", "source_file",
                          F.from_json(F.col("node"), "map<string,string>").alias("raw_m"))
    parsed = parsed.select("*", F.transform_keys("raw_m", lambda k, v: F.lower(k)).alias("m"))
    m, raw_m = F.col("m"), F.col("raw_m")
    acl_key = F.try_element_at(F.filter(F.map_keys(raw_m), lambda k: _is_acl_key(k, raw_m)), F.lit(1))
    acl = F.from_json(raw_m[acl_key], "array<string>")
    if compat_any_list:  # empty ACL list -> first list-valued field of any name
        any_key = F.try_element_at(F.filter(F.map_keys(raw_m), lambda k: _starts(raw_m[k], "[")), F.lit(1))
        acl = F.when(F.size(acl) > 0, acl).otherwise(F.from_json(raw_m[any_key], "array<string>"))
    unc = _or_pick(m, ("uncpath", "path"))
    share_path = _or_pick(m, ("sharepath", "sharename"))
    host = _or_pick(m, ("appliancehostname",))
    # the record's own columns before the explode: once a record, not once an ACE
    base = parsed.select(
        "run_id", "source_file", unc.alias("unc_path"),
        canonical_folder_path(host, share_path, unc, F.col("source_file")).alias("folder_path"),
        *[_or_pick(m, keys).alias(col) for col, keys in META_KEYS.items()],
        F.from_json(m["attributes"], "array<string>").alias("attributes"), acl.alias("_acl"))
    base = _each(base, "_acl", ["ace_pos", "ace_text"])
    base = base.select("*", F.when(_starts(F.col("ace_text"), "{"), _lower_map(F.col("ace_text"))).alias("_a"))
    a = F.col("_a")
    out = base.select(
        "run_id", "source_file", "folder_path", "unc_path",
        _pick(a, SID_KEYS).alias("ace_sid"),
        _pick(a, NAME_KEYS).alias("ace_name"),
        _pick(a, TYPE_KEYS).alias("ace_type"),
        _pick(a, MASK_KEYS).alias("ace_mask"),
        _parse_bool(_pick(a, INHERITED_KEYS)).alias("ace_inherited"),
        F.col("ace_text").alias("ace_raw"),
        *META_KEYS.keys(), "attributes", "ace_pos")
    return out.select(*ACE_SCHEMA_COLUMNS, "ace_pos")


def ingest_acl_json(spark: SparkSession, root: str, compat_any_list: bool = False,
                    json_lines: bool = False) -> DataFrame:
    """Folder-ACL JSON files below ``root`` -> ACE rows (canonical columns)."""
    apply_engine_conf(spark)
    files = read_folderacl_files(spark, root, json_lines=json_lines)
    return nodes_to_aces(acl_nodes(files), compat_any_list).drop("ace_pos")


def ingest_candidates(spark: SparkSession, root: str, out_dir: str, n: int = 20) -> DataFrame:
    """Dry run: the first ``n`` files holding an ACL node and the Parquet target
    each would get (``<out>/<run>/<stem>.parquet``)."""
    files = read_folderacl_files(spark, root)
    with_nodes = acl_nodes(files).select("source_file").distinct()
    f = files.join(with_nodes, "source_file", "left_semi")
    stem = F.regexp_replace("file_name", r"\.json$", "")
    return (f.select("source_file", F.concat_ws("/", F.lit(out_dir.rstrip("/")), "run_id",
                                                F.concat(stem, F.lit(".parquet"))).alias("target"))
            .orderBy("source_file").limit(n))


def run_text_summary(files: DataFrame) -> DataFrame:
    """Text-level approximations per run: files, '"sid"' occurrences, distinct SID values."""
    sid_count = F.regexp_count(F.col("text"), F.lit('(?i)"sid"'))
    sids = F.regexp_extract_all(F.col("text"), F.lit(r'(?i)"sid"\s*:\s*"([^"]+)"'), F.lit(1))
    per_file = files.select("run_id", sid_count.alias("n"), sids.alias("sids"))
    counts = per_file.groupBy("run_id").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("aces_approx"))
    distinct = (per_file.select("run_id", F.explode("sids").alias("sid")).groupBy("run_id")
                .agg(F.countDistinct("sid").alias("distinct_sids")))
    return counts.join(distinct, "run_id", "left").fillna(0, ["distinct_sids"])


# ---------------------------------------------------------------------------
# JSON documents derived from an ACE table (round trip of the ingest)
# ---------------------------------------------------------------------------

def aces_to_documents(aces: DataFrame) -> DataFrame:
    """Render ACE rows back into exporter-shaped JSON documents (schema 1.0.1
    style: an array of one record with an ``Access`` list).  One document per
    (source_file, folder_path, fingerprint) record, so a document is as large
    as one ACL record, never a whole folder."""
    ace = F.struct(F.col("ace_name").alias("Identity"), F.col("ace_sid").alias("Sid"),
                   F.col("ace_mask").alias("Rights"), F.col("ace_type").alias("Type"),
                   F.col("ace_inherited").alias("IsInherited"))
    keys = ["run_id", "source_file", "unc_path", "appliance_hostname", "share_name", "volume_name",
            "volume_guid", "owner", "collected_utc", "collection_host", "fingerprint_sha256"]
    rec = aces.groupBy(*keys).agg(F.collect_list(ace).alias("Access"))
    doc = F.to_json(F.array(F.struct(
        F.col("unc_path").alias("UncPath"), F.col("collected_utc").alias("CollectedUtc"),
        F.col("collection_host").alias("CollectionHost"), F.col("appliance_hostname").alias("ApplianceHostname"),
        F.col("share_name").alias("ShareName"), F.col("volume_name").alias("VolumeName"),
        F.col("volume_guid").alias("VolumeGuid"), F.col("owner").alias("Owner"),
        F.col("fingerprint_sha256").alias("FingerprintSha256"), F.col("Access"))))
    return rec.select("run_id", "source_file", doc.alias("text"))


# ---------------------------------------------------------------------------
# Fixed-schema fast path for the two exporter schema versions
# ---------------------------------------------------------------------------

# Record fields of the exporter schemas 1.0.0 / 1.0.1.
TYPED_RECORD_FIELDS = ("UncPath", "Path", "CollectedUtc", "CollectionHost", "Host", "ApplianceHostname",
                       "ApplianceDescription", "ApplianceSerialNumber", "VolumeName", "VolumeGuid", "ShareName",
                       "SharePath", "Collector", "Owner", "Sddl", "FingerprintSha256", "CollectionSha256")


def _typed_record_schema() -> str:
    rec = ",".join(f"{f}:string" for f in TYPED_RECORD_FIELDS)
    return f"struct<{rec},Attributes:array<string>,Access:string>"


def _typed_records(files: DataFrame) -> DataFrame:
    """(run_id, source_file, text, recs): ``recs`` is null unless every record
    has an ``Access`` list and no field that another ACL list could hide in."""
    rec_t = _typed_record_schema()
    text = _strip_bom(F.col("text"))
    one = F.when(_starts(text, "{"), F.array(text)).otherwise(F.from_json(text, "array<string>"))
    known = [F.lit(k) for k in (*TYPED_RECORD_FIELDS, "Attributes", "Access")]
    # array_except of a record's keys and the known ones: an unknown key that holds a container
    def fits(m):
        other = F.exists(F.array_except(F.map_keys(m), F.array(*known)),
                         lambda k: F.coalesce(_starts(m[k], "{") | _starts(m[k], "["), F.lit(False)))
        return F.coalesce(F.from_json(m["Access"], "array<string>").isNotNull() & ~other, F.lit(False))
    parsed = files.filter(well_formed(F.col("text"))).select("run_id", "source_file", "text", one.alias("_one"))
    maps = F.transform("_one", lambda r: F.from_json(r, "map<string,string>"))  # each record parsed once
    return parsed.select("run_id", "source_file", "text", F.when(
        F.col("_one").isNotNull() & F.forall(maps, fits),
        F.transform("_one", lambda r: F.from_json(r, rec_t))).alias("recs"))


def typed_aces(files: DataFrame) -> DataFrame:
    """Fast path for exporter files of the known schemas (an array of records
    or one record, each with an ``Access`` list): one ``from_json`` with a
    fixed record schema, no node search.  ACEs of any form (objects with any
    of the known keys, bare strings) are read as the generic path reads them.
    Files of other shapes yield nothing here; ``untyped_files`` names them."""
    r = _each(_typed_records(files).drop("text"), "recs", ["r"])
    g = lambda f: F.nullif(F.col(f"r.{f}"), F.lit(""))  # noqa: E731 - Python ``or`` semantics
    unc = F.coalesce(g("UncPath"), g("Path"))
    base = r.select(
        "run_id", "source_file", unc.alias("unc_path"),
        canonical_folder_path(g("ApplianceHostname"), F.coalesce(g("SharePath"), g("ShareName")), unc,
                              F.col("source_file")).alias("folder_path"),
        g("CollectedUtc").alias("collected_utc"), F.coalesce(g("CollectionHost"), g("Host")).alias("collection_host"),
        g("Collector").alias("collector"), g("ApplianceHostname").alias("appliance_hostname"),
        g("ApplianceDescription").alias("appliance_description"),
        g("ApplianceSerialNumber").alias("appliance_serial"), g("VolumeName").alias("volume_name"),
        g("VolumeGuid").alias("volume_guid"), g("ShareName").alias("share_name"), g("Owner").alias("owner"),
        g("Sddl").alias("sddl"), g("FingerprintSha256").alias("fingerprint_sha256"),
        g("CollectionSha256").alias("collection_sha256"), F.col("r.Attributes").alias("attributes"),
        F.from_json("r.Access", "array<string>").alias("_acl"))
    base = _each(base, "_acl", ["ace_pos", "ace_text"])
    base = base.select("*", F.when(_starts(F.col("ace_text"), "{"), _lower_map(F.col("ace_text"))).alias("_a"))
    a = F.col("_a")
    return base.select(
        "run_id", "source_file", "folder_path", "unc_path",
        _pick(a, SID_KEYS).alias("ace_sid"), _pick(a, NAME_KEYS).alias("ace_name"), _pick(a, TYPE_KEYS).alias("ace_type"),
        _pick(a, MASK_KEYS).alias("ace_mask"), _parse_bool(_pick(a, INHERITED_KEYS)).alias("ace_inherited"),
        F.col("ace_text").alias("ace_raw"),
        *META_KEYS.keys(), "attributes", "ace_pos").select(*ACE_SCHEMA_COLUMNS, "ace_pos")


def untyped_files(files: DataFrame) -> DataFrame:
    """Well-formed files whose shape the typed path does not read."""
    return _typed_records(files).filter(F.col("recs").isNull()).select("run_id", "source_file", "text")


def all_aces(files: DataFrame) -> DataFrame:
    """Typed path where the shape is known, generic node search for the rest."""
    return typed_aces(files).unionByName(nodes_to_aces(acl_nodes(untyped_files(files))))
