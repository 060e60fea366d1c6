import pytest
from pyspark.sql import functions as F

from yieldlens.operators import reshape as rs
from yieldlens.operators.guards import InputError, check_bounds, check_xy_inputs
from yieldlens.sources import headers, tables


def test_type_header(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("categorical,categorical.1,continuous\nY,tool,m\n1,A,2.5\n0,,\n")
    df = headers.read_type_header(spark, str(path))
    assert df.dtypes == [("Y", "string"), ("tool", "string"), ("m", "double")]
    assert sorted(map(tuple, df.collect()), key=repr) == [("0", None, None), ("1", "A", 2.5)]
    headers.write_type_header(df, str(tmp_path / "back"), y_type="continuous")
    back = headers.read_type_header(spark, str(tmp_path / "back"))
    assert back.dtypes == [("Y", "double"), ("tool", "string"), ("m", "string")]
    assert back.count() == 2
    words, rows = headers.add_type_header(df, "continuous")
    assert words == ["continuous", "categorical", "categorical"] and tuple(rows.first()) == ("Y", "tool", "m")


def test_promoted_header(spark, tmp_path):
    raw = spark.createDataFrame([(0, "name", "size"), (1, "a", "1"), (2, "b", "2")], "o int, x string, y string")
    out = headers.promote_header(raw.select("x", "y", "o"), [F.col("o").asc()])
    assert out.columns == ["name", "size", "0"] and out.count() == 2
    path = tmp_path / "export.csv"
    path.write_text('outer,Unnamed: 1\nid,"a, b"\n1,x\n2,y\n')
    assert headers.read_promoted_header(spark, str(path)).columns == ["id", "a, b"]


def test_read_dir_keeps_files_apart(spark, tmp_path):
    for name, v in (("one.csv", "1\n2"), ("two.csv", "5")):
        (tmp_path / name).write_text(f"v\n{v}\n")
    found = {r.file: r.s for r in tables.read_dir(spark, str(tmp_path)).groupBy("file").agg(F.sum("v").alias("s")).collect()}
    assert found == {"one.csv": 3, "two.csv": 5}


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc", "json"])
def test_write_and_read(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, float("nan"))], "k int, t string, x double")
    tables.write_table(df, str(tmp_path / fmt), fmt)
    back = tables.read_table(spark, str(tmp_path / fmt), fmt, schema=df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a", 2.5), (2, None, None)]


NAMES = ["２次元CODE", "檢查日時", "品名", "缺陷種類", "SUB POINT NO.", "判定", "測定結果"]


def inspection(spark):
    rows = [
        ("s1", "d1", "m", "HI", 1, "L", "1.0"), ("s1", "d1", "m", "HI", 1, "L", "3.0"), ("s1", "d2", "m", "HI", 1, "L", "10.0"),
        ("s1", "d1", "m", "HI", 1, "O", "7.0"), ("s1", "d1", "m", "HI", 2, "O", "99.0"), ("s2", "d1", "m", "HI", 1, "L", "5.0"),
        ("s3", "d1", "m", "HI", 1, "L", "2.0"), ("s3", "d1", "m", "HI", 1, "O", "4.0"),
        ("s1", "d1", "m", "LN", 1, "L", "0.5"), ("s1", "d1", "m", "LN", 2, "L", "0.7"), ("s1", "d1", "m", "LN", 2, "O", "9.0"),
        ("s4", "d1", "m", "HI", 1, "L", "8.0"), ("s4", "d1", "m", "HI", 1, "O", "1.0"),
    ]
    return spark.createDataFrame(rows, rs_schema())


def rs_schema():
    from pyspark.sql import types as T

    kinds = [T.StringType()] * 4 + [T.IntegerType()] + [T.StringType()] * 2
    return T.StructType([T.StructField(n, k) for n, k in zip(NAMES, kinds)])


def test_targets(spark):
    psh = {r.sheet_id: (r.Main_PSH, r.Sub_PSH) for r in rs.measure_targets(inspection(spark), "PSH").collect()}
    assert psh == {"s1": (6.0, 7.0), "s3": (2.0, 4.0), "s4": (8.0, 1.0)}  # mean of means; s2 has no O
    cd = rs.measure_targets(inspection(spark), "CD").collect()
    assert [(r.sheet_id, r.CDx, r.CDy) for r in cd] == [("s1", 0.5, 0.7)]
    only = rs.measure_targets(inspection(spark).where(F.col("判定") == "L"), "PSH")
    assert only.columns == ["sheet_id", "Main_PSH"]
    with pytest.raises(InputError):
        rs.measure_targets(inspection(spark), "XYZ")
    with pytest.raises(InputError):
        rs.measure_targets(inspection(spark).drop("判定"), "PSH")


def process(spark):
    return spark.createDataFrame(
        [("s1", 1.0, 5, "t", None), ("s3", None, 5, "t", None), ("s4", 3.0, 5, "u", None), ("s9", 4.0, 5, "t", 1.0)],
        "sheet_id string, `tool temp` double, same int, text string, rare double",
    )


def test_prepare_xy(spark):
    x, y = rs.prepare_xy(process(spark), inspection(spark), "PSH", low=0.0, high=1.0)
    assert x.columns == ["tool_temp"] and y.columns == ["Main_PSH", "Sub_PSH"]
    assert sorted(r.tool_temp for r in x.collect()) == [1.0, 2.0, 3.0]
    with pytest.raises(InputError, match="no sheet"):
        rs.prepare_xy(process(spark).where("sheet_id = 's9'"), inspection(spark), "PSH")


def test_input_errors(spark):
    x, y = process(spark), inspection(spark)
    with pytest.raises(InputError, match="swapped"):
        check_xy_inputs(y, x)
    with pytest.raises(InputError, match="process tables"):
        check_xy_inputs(x, x, compare_rows=True)
    with pytest.raises(InputError, match="inspection tables"):
        check_xy_inputs(y, y)
    check_xy_inputs(x, y)
    good = (["a", "b"], ["a"], [[0, 0], [1, 1]])
    check_bounds(*good)
    for bad, error in [
        ((["a"], "a", [[0], [1]]), TypeError), ((["a"], ["a"], ([0], [1])), TypeError), ((["a"], ["a"], [[0]]), ValueError),
        ((["a"], ["a"], [[0, 1], [1]]), ValueError), ((["a"], ["a"], [[0, 0], [1, 1]]), ValueError),
        ((["a"], ["z"], [[0], [1]]), ValueError), ((["a"], ["a"], [[2], [1]]), ValueError),
    ]:
        with pytest.raises(error):
            check_bounds(*bad)
    with pytest.raises(TypeError):
        check_bounds(*good, restarts=1.5)
    with pytest.raises(ValueError):
        check_bounds(*good, candidates=0)
