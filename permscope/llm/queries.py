"""Registered queries of the training-data operators: thin digests of the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permscope.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_substring_dedup", oracle=r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
first_doc AS (SELECT k, min(doc_id) AS lo FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT win.doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN first_doc USING (k) WHERE win.doc_id > lo),
word AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.substring_dedup import dedup_substrings

    out = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.suffix_dedup import dedup_bytes

    out = dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_jaccard_join", oracle=r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION SELECT reach.doc_id, e.b FROM reach JOIN both_ways e ON e.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(reach.r) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
""")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.tables import scratch_path
    from permscope.llm.token_files import read_token_files, write_token_files
    from permscope.llm.tokens import tokenizer_path

    path = scratch_path(spark, "tokens")
    made = write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, made).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.packing import pack_best_fit
    from permscope.llm.tokens import tokenizer_path

    return pack_best_fit(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.quality_rules import judge
    from permscope.llm.stats import BASE

    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *BASE, "base_failed", "kept")


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.quality_classifier import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_warc", oracle=r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, coalesce(html, '') AS h FROM pages),
first_page AS (SELECT h, min(page_id) AS lo FROM p GROUP BY h),
x AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, upper(sha1(b)) AS d, lo
      FROM p JOIN first_page USING (h))
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
         (('0x' || substr(d, 1 + 5 * (k // 4), 5))::INT >> (15 - 5 * (k % 4))) % 32, 1)), '') AS payload_digest,
       CASE WHEN page_id = lo THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = lo THEN NULL ELSE lo END AS refers_to
FROM x
""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.tables import scratch_path
    from permscope.llm.warc import read_pages, write_warc

    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_pages(spark, path).drop("url", "payload").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.decontaminate import find_overlaps

    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.lit(True).alias("contaminated"), "item_id", "n_items", "first_word", "n_words", "n_equal")


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.licenses import scan_licenses

    # a document's place: one tree per source, a directory per language
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    return scan_licenses(table(spark, sf_dir, "documents"), path)


# of seven documents one is tampered with: its count of characters grows by one (nulls stay)
_CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS t),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                 lambda x, c: xor(x // 256, t[(xor(x, c) % 256) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table)"""


def _leaf_sql(n_chars: str) -> str:
    parts = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


@query("op13_merkle_manifest", oracle=f"""
WITH RECURSIVE {_CRC32},
d AS (
  SELECT documents.doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN crc % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS claimed
  FROM documents LEFT JOIN crc USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY lang) AS n FROM d),
node AS (
  SELECT lang, 0 AS level, rank AS pos, leaf AS digest, n FROM ranked
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM node WHERE n > 1 GROUP BY lang, level, pos // 2),
sub AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n
        FROM node WHERE n = 1),
upper AS (
  SELECT 0 AS level, rank AS pos, subroot AS digest, n FROM sub
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM upper WHERE n > 1 GROUP BY level, pos // 2),
walk AS (
  SELECT r.doc_id, r.leaf, r.claimed, s.subroot, r.lang, r.rank AS low, s.rank AS high, u.digest AS root
  FROM ranked r JOIN sub s ON s.lang IS NOT DISTINCT FROM r.lang, upper u WHERE u.n = 1),
height AS (SELECT lang, max(level) AS h FROM node GROUP BY lang),
step AS (
  SELECT w.lang, w.low, x.level, x.digest AS sibling, (w.low >> x.level) % 2 = 1 AS lefty
  FROM walk w JOIN node x ON x.lang IS NOT DISTINCT FROM w.lang AND x.pos = xor(w.low >> x.level, 1) AND x.n > 1
  UNION ALL
  SELECT w.lang, w.low, h.h + x.level, x.digest, (w.high >> x.level) % 2 = 1
  FROM walk w JOIN height h ON h.lang IS NOT DISTINCT FROM w.lang JOIN upper x ON x.pos = xor(w.high >> x.level, 1) AND x.n > 1),
proof AS (SELECT lang, low, string_agg(sibling, '' ORDER BY level) AS p FROM step GROUP BY lang, low),
fold AS (
  SELECT w.lang, w.low, 0 AS level, w.claimed AS digest, h.h + (SELECT max(level) FROM upper) AS last
  FROM walk w JOIN height h ON h.lang IS NOT DISTINCT FROM w.lang
  UNION ALL
  SELECT f.lang, f.low, f.level + 1, sha256(CASE WHEN s.lefty THEN s.sibling || f.digest ELSE f.digest || coalesce(s.sibling, '') END), f.last
  FROM fold f LEFT JOIN step s ON s.lang IS NOT DISTINCT FROM f.lang AND s.low = f.low AND s.level = f.level
  WHERE f.level < f.last)
SELECT w.doc_id, w.leaf, w.subroot, w.root, sha256(coalesce(p.p, '')) AS proof_sha256, f.digest AS folded_root,
       f.digest = w.root AS verified
FROM walk w LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM w.lang AND p.low = w.low
JOIN fold f ON f.lang IS NOT DISTINCT FROM w.lang AND f.low = w.low AND f.level = f.last
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.merkle import folded, prove, siblings, write_manifest

    moved = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    docs = table(spark, sf_dir, "documents")
    made = write_manifest(docs, claim={"n_chars": F.when(moved, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    out = prove(made).withColumn("folded_root", folded(F.col("claimed"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                      F.sha2(F.array_join(siblings(F.col("path")), ""), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _cluster_sql(rounds: int) -> str:
    nearest = """
SELECT v.vec_id, v.nth, arg_min(c.c, (d, c.c)) AS cluster, min(d) AS distance
FROM (SELECT vec_id, nth, {c}.c, list_sum(list_transform(list_zip(x, {c}.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
      FROM v, {c}) AS q JOIN v USING (vec_id, nth) JOIN {c} AS c ON c.c = q.c GROUP BY v.vec_id, v.nth"""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS ({nearest.format(c=f'c{r}')})")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT cluster, i, sum(x[i]::HUGEINT) AS s, count(*) AS n
         FROM a{r} JOIN v USING (vec_id, nth), range(1, 65) AS t(i) GROUP BY cluster, i),
c{r + 1} AS (
  SELECT c, coalesce(p2, p) AS p FROM c{r} LEFT JOIN (
    SELECT cluster, list((s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY i) AS p2 FROM m{r} GROUP BY cluster) ON cluster = c)""")
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x,
         row_number() OVER (PARTITION BY vec_id ORDER BY embedding) AS nth
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS p
  FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '-')) AS h, x FROM v ORDER BY h, x LIMIT 16)),
{", ".join(steps)}
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = cluster
"""


@query("op12_centroid_clustering", oracle=_cluster_sql(3))
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.centroids import cluster_vectors

    out = cluster_vectors(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


@query("op11_word_bpe")
def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from permscope.llm.tokens import tokenizer_path, vocabularies
    from permscope.llm.word_bpe import round_trip

    out = round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), vocabularies().PATTERN)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
