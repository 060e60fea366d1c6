"""Results that must not depend on caps, prefixes, layout or one hot value."""

import pytest
from pyspark.sql import functions as F

from yieldlens.operators import compare, proportion, rows as ro, rules as ru
from yieldlens.sources import headers


def test_all_classes_come_back(spark):
    df = spark.range(12_000).select((F.col("id") % 2000).alias("Y"))
    sizes = ro.check_labels(df, "Y")
    assert sizes.count() == 2000 and sizes.agg(F.min("n")).first()[0] == 6
    with pytest.raises(ValueError, match="class 7 has only 5"):
        ro.check_labels(spark.range(12_000).where("id <> 7").select((F.col("id") % 2000).alias("Y")), "Y", 6)


def test_split_does_not_depend_on_layout(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("Y"))
    picked = [
        {r.id for r in compare.split_rows(df.repartition(n), y).where("_test").collect()} for y in ("Y", None) for n in (2, 5)
    ]
    assert picked[0] == picked[1] and picked[2] == picked[3]
    assert abs(len(picked[0]) - 600) <= 3 and 500 < len(picked[2]) < 700


def test_data_row_equal_to_the_header_stays(spark, tmp_path):
    raw = spark.createDataFrame([(0, "a", "b"), (1, "1", "2"), (2, "a", "b"), (3, "a", "b")], "n int, x string, y string")
    made = headers.promote_header(raw, [F.col("n")])
    assert made.columns == ["0", "a", "b"]
    same = spark.createDataFrame([("a", "b"), ("1", "2"), ("a", "b"), ("a", "b")], "x string, y string")
    left = headers._without(same, ["a", "b"])
    assert sorted(tuple(r) for r in left.collect()) == [("1", "2"), ("a", "b"), ("a", "b")]


def test_long_group_has_the_same_tails(spark):
    df = spark.range(3000).select(
        F.lit("p").alias("parent"), (F.col("id") % 97).alias("NG_num"), (F.lit(200) + F.col("id") % 31).alias("Total_num")
    ).where("NG_num > 0")
    whole = proportion.chi2_by_group(df, ["parent"])
    joined = proportion.chi2_by_group(df, ["parent"], max_group_rows=10)
    for found in (whole, joined):
        assert found.count() == df.count() and found.select("p_value").distinct().count() == 1
    a, b = whole.first(), joined.first()
    assert a.dof == b.dof == df.count() - 1
    assert a.p_value == pytest.approx(b.p_value, abs=1e-9)


def test_item_in_all_rows_draws_no_candidates(spark):
    transactions = spark.range(3000).select(
        F.array(F.lit("a=all"), F.concat(F.lit("z="), F.col("id") % 300)).alias("items"), (F.col("id") % 2).alias("Y")
    )
    rules = spark.range(300).select(F.col("id").alias("rule_id"), F.array(F.lit("a=all"), F.concat(F.lit("z="), "id")).alias("items"))
    found = ru.match_rules(rules, transactions, "items", "Y").collect()
    assert len(found) == 300 and all(r.all_count == 10 for r in found)
