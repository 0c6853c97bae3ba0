"""The corpus pipeline: documents -> packed training sequences, five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``:

1. quality rules: documents that the rules or the isolation forest reject go;
2. n-gram Jaccard join (five words, similarity 0.8): of each group of near
   copies the row with the smallest doc_id stays, documents without words too;
3. substring deduplication: words covered by a 13-word window that starts in a
   document with a smaller doc_id go; a text that loses words is the rest joined
   by single spaces, other texts are not touched; documents left without a word go;
4. benchmark decontamination: documents that hold a benchmark item go;
5. best-fit packing into sequences of at most 1024 tokens.

Nulls, empty and repeated rows and empty tables: as each operator's docstring
says.  Columns beside doc_id and text are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permscope.llm.decontaminate import remove_contaminated
from permscope.llm.jaccard_join import keep_one_of_each
from permscope.llm.packing import pack_best_fit
from permscope.llm.quality_rules import keep_good
from permscope.llm.substring_dedup import dedup_substrings
from permscope.llm.tables import stored
from permscope.llm.tokens import tokenizer_path
from permscope.session import let_workers_import
from permscope.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return keep_one_of_each(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    out = dedup_substrings(docs).where("n_removed = 0 or kept_text != ''")
    cut = F.col("n_removed") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*(F.when(cut, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(f"row.`{c}`")).alias(c)
                        if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return pack_best_fit(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("best_fit_packing", packed_sequences),
]

# an isolation forest and a tokenizer are beyond SQL; tests compare each stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the last one's pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
