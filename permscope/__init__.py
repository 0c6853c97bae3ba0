"""permscope — ACL / permission analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` expressions, so Catalyst plans, prunes and
pushes down the whole pipeline.  Sub-packages:

* ``sources``   — readers (folder-ACL JSON, ACE Parquet, shares CSV,
                  ruleset JSON) and sinks, plus the derived ACE fixture.
* ``functions`` — Column helpers (masks, names, paths, patterns).
* ``operators`` — reports, rule engine, finders, fingerprints, identity
                  graph, effective access, drift, vulnerability patterns.
* ``plans``     — the query catalog used by ``__spark_entry__`` and the
                  DuckDB oracle SQL for every catalogued query.
* ``streaming`` — incremental ingest with Structured Streaming.
"""

from permscope.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
