"""Column helpers: masks, names, paths, keyword groups."""

from pyspark.sql import functions as F

from permscope.functions import masks as M
from permscope.functions.names import resolve_name
from permscope.functions.paths import ancestors, canonical_folder_path, last_path_component, parse_unc
from permscope.functions.predicates import match_keyword_group


def _one(spark, col, schema="m string", rows=None):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_high_permission_table(spark):
    rows = [("FullControl",), ("modify",), ("read",), ("0x10000000",), ("0x2",), ("0",), ("2147483648",), ("1",)]
    got = _one(spark, M.high_perm_bitmask("m"), rows=rows)
    assert got == [True, True, False, True, True, False, True, False]


def test_mask_to_int_and_normalize(spark):
    rows = [("0x80000000",), ("0X1F01FF",), ("2032127",), ("junk",), (None,)]
    assert _one(spark, M.mask_to_int("m"), rows=rows) == [2147483648, 2032127, 2032127, 0, 0]
    assert _one(spark, M.normalize_mask("m"), rows=rows) == ["0x80000000", "0x1f01ff", "2032127", "junk", ""]
    assert _one(spark, M.normalize_mask("n", numeric=True), "n bigint", [(255,), (None,)]) == ["0xFF", ""]


def test_rights_bucket(spark):
    rows = [("FullControl",), ("2032127",), ("Modify",), ("0x2",), ("Read",), ("0x80000000",), ("0",)]
    assert _one(spark, M.rights_bucket("m"), rows=rows) == [
        "fullcontrol", "fullcontrol", "write", "write", "read", "read", "none"]


def test_resolve_name(spark):
    rows = [(" Alice ", None), ("", '{"displayName": " Bob "}'), (None, '{"Name": "x", "sid": "S-1"}'),
            (None, "BareName"), (None, "[1,2]"), (None, None), (None, '{"name": "", "identity": "Id"}')]
    got = _one(spark, resolve_name("n", "r"), "n string, r string", rows)
    assert got == ["Alice", "Bob", "S-1", "BareName", "", "", "Id"]


def test_paths(spark):
    rows = [("\\\\Host.dom.com\\Share\\a\\b\\",), ("nan",), ("",)]
    assert _one(spark, last_path_component("p"), "p string", rows) == ["b", "nan", ""]
    got = _one(spark, parse_unc("p"), "p string", rows)
    assert (got[0].filer, got[0].share) == ("host", "share")
    assert got[1] is None and got[2] is None
    anc = _one(spark, ancestors("p"), "p string", [("\\\\h\\s\\a\\b",)])[0]
    assert anc == ["\\\\h\\s", "\\\\h\\s\\a"]


def test_canonical_folder_path(spark):
    df = spark.createDataFrame([("app1", "/Share1/", "\\\\x\\y\\Leaf\\", "f.json"), (None, "s", "\\\\u\\v", "f.json"),
                                (None, None, None, "f.json")], "h string, s string, u string, f string")
    got = [r[0] for r in df.select(canonical_folder_path("h", "s", "u", "f")).collect()]
    assert got == ["\\\\app1\\Share1\\Leaf", "\\\\u\\v", "f.json"]


def test_keyword_group_first_match(spark):
    rows = [("\\\\f\\s\\Payroll-HR",), ("\\\\f\\s\\chrome",), ("\\\\f\\s\\nothing",)]
    got = _one(spark, match_keyword_group("p"), "p string", rows)
    assert (got[0].keyword_group, got[0].matched_pattern) == ("HR", "hr")   # order of groups wins
    assert got[1].keyword_group == "HR"                                       # bare substring
    assert got[2] is None
    strict = _one(spark, match_keyword_group("p", word_boundary=True), "p string", rows)
    assert strict[0].keyword_group == "HR" and strict[1] is None


def test_no_python_udf_in_rule_plan(spark):
    from helpers import ace_df
    from permscope.operators.rules import apply_rules

    df = apply_rules(ace_df(spark, [("\\\\f\\s\\x", "A", "S-1", "Read")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
