import pytest
from pyspark.sql import functions as F

from yieldlens.operators import proportion as pt

SCHEMA = "site string, Parameter string, tool_id string, chmb string, NG_num long, Total_num long"
LEVELS = ["Parameter", "tool_id", "chmb"]


def test_worked_values(spark):
    rows = [("A", "p", f"t{i}", "c", ng, 100) for i, ng in enumerate([10, 30, 12])] + [("A", "q", f"t{i}", "c", ng, 100) for i, ng in enumerate([10, 25])]
    tested = pt.level_tests(spark.createDataFrame(rows, SCHEMA), LEVELS).where("flag = 'tool_id'").orderBy("Parameter", "tool_id").collect()
    assert [r.chi2 for r in tested] == pytest.approx([16.9354838710] * 3 + [6.7878787879] * 2)
    assert [r.dof for r in tested] == [2, 2, 2, 1, 1]
    assert [r.p_value for r in tested] == pytest.approx([2.1013887518e-4] * 3 + [9.1778900254e-3] * 2)
    assert [r.pooled for r in tested] == pytest.approx([0.1733333333] * 3 + [0.175] * 2)
    assert [r.sig_flag for r in tested] == ["", "Y", "", "", "Y"]


def test_join_path_equals_window_path(spark):
    df = spark.range(5000).select(
        F.lit("A").alias("site"), F.lit("p").alias("Parameter"), F.concat(F.lit("t"), F.col("id") % 9).alias("tool_id"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("chmb"), F.when(F.pmod(F.xxhash64("id"), F.lit(10)) < 3, 1).otherwise(0).alias("NG_num"), F.lit(1).alias("Total_num"),
    )
    key = ["flag", "Parameter", "tool_id", "chmb"]
    a = pt.level_tests(df, LEVELS).orderBy(*key).collect()
    b = pt.level_tests(df, LEVELS, max_group_rows=1).orderBy(*key).collect()
    assert [r.p_value for r in a] == pytest.approx([r.p_value for r in b])
    assert [(r.flag, r.tool_id, r.NG_num, r.sig_flag) for r in a] == [(r.flag, r.tool_id, r.NG_num, r.sig_flag) for r in b]


def test_zero_cells_single_children_and_missing_levels(spark):
    rows = [
        ("A", "zero", "t1", "c", 0, 100), ("A", "zero", "t2", "c", 50, 100),
        ("A", "full", "t1", "c", 100, 100), ("A", "full", "t2", "c", 50, 100),
        ("A", "single", "t1", "c", 50, 100),
        ("A", "none", "t1", "None", 10, 100), ("A", "none", "t1", None, 10, 100), ("A", "none", "t2", "c1", 40, 100),
        (None, "p", "t1", "c", 1, 2),
    ]
    out = pt.proportion_test(spark.createDataFrame(rows, SCHEMA), LEVELS).collect()
    assert all(r["p-value"] is None for r in out if r.Parameter != "none")
    deep = [r for r in out if r.Parameter == "none" and r.flag == "chmb"]
    assert [(r.tool_id, r.chmb) for r in deep] == [("t2", "c1")]
    tools = {r.tool_id: (r.NG_num, r.Total_num, r.NG_Ratio) for r in out if r.Parameter == "none" and r.flag == "tool_id"}
    assert tools == {"t1": (20, 200, 10.0), "t2": (40, 100, 40.0)}
    assert all(r.site == "A" for r in out)


def test_adjacent_grouping_tests_fragments(spark):
    """Chambers of two tools interleave by ratio, so only neighbours of one tool are compared."""
    rows = [("A", "p", t, c, ng, 100) for t, c, ng in [("t1", "c1", 60), ("t1", "c2", 30), ("t2", "c1", 28), ("t1", "c3", 10), ("t2", "c2", 8), ("t2", "c3", 5)]]
    df = spark.createDataFrame(rows, SCHEMA)
    for limits in ({}, {"max_group_rows": 1, "block_rows": 2}):
        out = pt.level_tests(df, LEVELS, grouping="adjacent", **limits).where("flag = 'chmb'").orderBy(F.desc("NG_Ratio")).collect()
        assert [r.children for r in out] == [2, 2, 1, 1, 2, 2]
        assert [r.sig_flag for r in out] == ["Y", "", "", "", "", ""]
    whole = pt.level_tests(df, LEVELS).where("flag = 'chmb'").collect()
    assert all(r.children == 3 for r in whole)


def test_sites_use_their_own_levels(spark):
    schema = "site string, Parameter string, line_id string, tool_id string, unit_name string, chmb string, NG_num long, Total_num long"
    rows = [(s, "p", f"l{i % 2}", f"t{i % 3}", f"u{i % 2}", f"c{i % 2}", 10 + i, 100) for s in ("ARRAY", "CF", "CELL", "OTHER") for i in range(6)]
    df = spark.createDataFrame(rows, schema)
    out = pt.proportion_test_sites(df)
    flags = {(r.site, r.flag) for r in out.collect()}
    assert flags == {("ARRAY", "tool_id"), ("ARRAY", "chmb"), ("CF", "line_id"), ("CF", "tool_id"), ("CELL", "tool_id"), ("CELL", "unit_name"), ("CELL", "chmb")}
    alone = pt.proportion_test(df.where("site = 'CF'"), pt.SITE_LEVELS["CF"])
    pick = lambda d: sorted((r.Parameter, r.line_id, r.tool_id or "", r.flag, r.NG_num, r.sig_flag) for r in d.collect())
    assert pick(out.where("site = 'CF'")) == pick(alone)


def test_empty_input(spark):
    out = pt.proportion_test(spark.createDataFrame([], SCHEMA), LEVELS)
    assert out.count() == 0 and out.columns == [*LEVELS, "flag", "site", "NG_num", "Total_num", "NG_Ratio", "p-value", "sig_flag"]
