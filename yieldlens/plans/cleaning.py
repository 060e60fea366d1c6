"""Registered queries on sources, columns, rows and values."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldlens.operators import guards as gu
from yieldlens.operators import columns as co, reshape as re_, rows as ro, statistics as st, values as va
from yieldlens.operators.clean import clean
from yieldlens.plans.shared import (
    INSPECTION_SQL, PROCESS_SQL, SHEETS_SQL, inspection, process, r6, rounded, scratch_folder, sheets, table,
)
from yieldlens.sources import headers, tables

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


CUSTOMER = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]


@query("read_table", "SELECT * FROM customer")
def _(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/customer.parquet", "parquet")


@query("write_table", f"SELECT {', '.join(CUSTOMER)} FROM customer")
def _(spark, sf_dir):
    folder = scratch_folder(spark)
    df = table(spark, sf_dir, "customer").select(*CUSTOMER)
    tables.write_table(df, folder, "csv")
    return tables.read_table(spark, folder, "csv", schema=df.schema)


@query(
    "read_dir",
    "SELECT concat('third=', CAST(l_orderkey % 3 AS STRING)) AS file, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem GROUP BY l_orderkey % 3",
)
def _(spark, sf_dir):
    """A folder of three CSV tables of several files, each counted by its name."""
    folder = scratch_folder(spark)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 3).alias("third"))
    tables.write_table(lines, folder, "csv", partition_by="third")
    files = tables.read_dir(spark, folder, "csv", folders=True)
    return files.groupBy("file").agg(F.count("*").alias("n"), F.sum("l_linenumber").cast("long").alias("numbers"))


@query("promote_header", "SELECT CAST(p_partkey AS STRING) AS p_partkey, p_name, p_brand FROM part")
def _(spark, sf_dir):
    folder = scratch_folder(spark)
    headers.write_type_header(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), folder)
    return headers.read_promoted_header(spark, folder)


@query("type_header", 'SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name, c_mktsegment, c_acctbal AS "Y" FROM customer')
def _(spark, sf_dir):
    folder = scratch_folder(spark)
    df = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "c_mktsegment", "c_acctbal AS Y")
    headers.write_type_header(df, folder, y_type="continuous")
    return headers.read_type_header(spark, folder)


@query("cast_all_string", "SELECT CAST(p_partkey AS STRING) AS p_partkey, p_brand, CAST(p_size AS STRING) AS p_size, CAST(p_retailprice AS STRING) AS p_retailprice FROM part")
def _(spark, sf_dir):
    return co.cast_all_string(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice"))


@query("drop_columns_like", f"SELECT * EXCLUDE (station1_rework_flag) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_columns_like(process(spark, sf_dir))


@query("rename", 'SELECT p_partkey AS "Parameter", p_name AS p-name, p_brand AS p-brand FROM part'.replace("p-name", '"p-name"').replace("p-brand", '"p-brand"'))
def _(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return co.rename(df, {"p_partkey": "Parameter"}, replace=("_", "-"))


@query("select_numeric", f"SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, some_holes, many_holes, fixed_number, holed_constant, empty_number, station1_rework_flag FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.select_by_type(process(spark, sf_dir), "numerical")


@query("select_categorical", f"SELECT l_returnflag, l_linestatus, grade, fixed_text FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.select_by_type(process(spark, sf_dir), "categorical")


@query("drop_null_columns", f"SELECT * EXCLUDE (many_holes, empty_number) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_null_columns(process(spark, sf_dir))


@query("drop_null_columns_loose", f"SELECT * EXCLUDE (empty_number) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_null_columns(process(spark, sf_dir), 0.75)


@query("drop_constant", f"SELECT * EXCLUDE (fixed_number, fixed_text, holed_constant) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_constant(process(spark, sf_dir))


@query("drop_constant_numeric", f"SELECT * EXCLUDE (fixed_number, holed_constant) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_constant(process(spark, sf_dir), kind="numerical")


@query("drop_constant_category", f"SELECT * EXCLUDE (fixed_text) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_constant(process(spark, sf_dir), kind="categorical")


@query("drop_constant_null_value", f"SELECT * EXCLUDE (fixed_number, fixed_text, empty_number) FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return co.drop_constant(process(spark, sf_dir), nulls="value")


@query("dedupe_columns", "SELECT p_partkey, p_size, p_brand FROM part")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return co.dedupe_columns(part.select("p_partkey", "p_size", F.col("p_brand"), F.col("p_name").alias("p_size")))


@query("split_xy_features", f"SELECT l_quantity, l_extendedprice, l_discount FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    df = process(spark, sf_dir).select("l_quantity", "l_tax", "l_extendedprice", "l_discount")
    return co.split_xy(df, "l_tax")[0]


@query("split_xy_targets", f'SELECT l_tax AS "Ylabel_tax", l_discount AS "Ylabel_discount" FROM {PROCESS_SQL}')
def _(spark, sf_dir):
    df = process(spark, sf_dir).selectExpr("l_quantity", "l_tax AS Ylabel_tax", "l_discount AS Ylabel_discount")
    return co.split_xy(df, lambda c: "Ylabel_" in c)[1]


EVENT_COLUMNS = [
    "event_id", "user_id", "value", "event_type",
    "CASE WHEN value > 150 THEN NULL ELSE value END AS holes", "CASE WHEN value > 2 THEN NULL ELSE 1.5 END AS mostly_empty", "4 AS fixed",
]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EVENTS_SQL = f"(SELECT {', '.join(EVENT_COLUMNS)} FROM events)"


def event_table(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*EVENT_COLUMNS)


def _fences(source: str, columns: list[str]) -> str:
    parts = ", ".join(
        f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in columns
    )
    outside = " OR ".join(
        f"coalesce({c} < a_{c} - 1.5 * (b_{c} - a_{c}) OR {c} > b_{c} + 1.5 * (b_{c} - a_{c}), false)" for c in columns
    )
    return f"SELECT t.* FROM {source} t, (SELECT {parts} FROM {source}) q WHERE NOT ({outside})"


@query(
    "clean_table",
    f"WITH kept AS ({_fences('(SELECT event_id, user_id, value, event_type, holes FROM ' + EVENTS_SQL + ')', ['event_id', 'user_id', 'value', 'holes'])}), "
    "s AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in ("event_id", "user_id", "value", "holes")) + " FROM kept) "
    "SELECT " + ", ".join(f"{r6(f'({c} - m_{c}) / d_{c}')} AS {c}" for c in ("event_id", "user_id", "value", "holes"))
    + ", " + ", ".join(f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS event_type_{v}" for v in EVENT_TYPES)
    + " FROM kept, s",
)
def _(spark, sf_dir):
    return rounded(clean(event_table(spark, sf_dir)))


@query("filter", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1 AND l_linestatus <> 'F'")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    kept = ro.keep_where(df, equal={"l_returnflag": "R", "l_linenumber": 1}, not_equal={"l_linestatus": "F"})
    return kept.select("l_orderkey", "l_quantity")


@query("drop_null_rows", f"SELECT l_orderkey, some_holes, many_holes FROM {PROCESS_SQL} WHERE some_holes IS NOT NULL AND many_holes IS NOT NULL")
def _(spark, sf_dir):
    return ro.drop_null_rows(process(spark, sf_dir).select("l_orderkey", "some_holes", "many_holes"))


@query("drop_iqr_outliers", f"WITH kept AS ({_fences(EVENTS_SQL, ['event_id', 'user_id', 'value', 'holes'])}) SELECT event_id, value, holes FROM kept")
def _(spark, sf_dir):
    df = event_table(spark, sf_dir)
    return ro.drop_iqr_outliers(df, ["event_id", "user_id", "value", "holes"]).select("event_id", "value", "holes")


@query("drop_duplicate_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    return ro.drop_duplicate_rows(df)


@query("keep_first_row", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return ro.drop_duplicate_rows(df, ["user_id", "event_type"], [F.col("event_id")])


@query("class_counts", "SELECT quality, count(*) AS n FROM labels GROUP BY quality")
def _(spark, sf_dir):
    return ro.class_counts(table(spark, sf_dir, "labels"), "quality")


@query("check_labels", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def _(spark, sf_dir):
    return ro.check_labels(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query(
    "input_guards",
    "SELECT 'same process tables' AS case_name, count(*) > 0 AS raised FROM orders UNION ALL SELECT 'different tables', count(*) < 0 FROM orders UNION ALL "
    "SELECT 'limits in order', min(l_quantity) > max(l_quantity) FROM lineitem UNION ALL SELECT 'limits reversed', max(l_quantity) > min(l_quantity) FROM lineitem UNION ALL "
    "SELECT 'unknown control', count(*) > 0 FROM lineitem",
)
def _(spark, sf_dir):
    """Which inputs the guards refuse: tables of the same rows, and limits taken from the data."""
    x = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sheet_id"), "o_totalprice")
    y = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sheet_id"), F.col("o_orderstatus").alias("judgement"))
    low, high = table(spark, sf_dir, "lineitem").agg(F.min("l_quantity"), F.max("l_quantity")).first()
    cases = {
        "same process tables": lambda: gu.check_xy_inputs(x, x, compare_rows=True),
        "different tables": lambda: gu.check_xy_inputs(x, y, compare_rows=True),
        "limits in order": lambda: gu.check_bounds(["l_quantity"], ["l_quantity"], [[low], [high]]),
        "limits reversed": lambda: gu.check_bounds(["l_quantity"], ["l_quantity"], [[high], [low]]),
        "unknown control": lambda: gu.check_bounds(["l_quantity"], ["l_tax"], [[low], [high]]),
    }
    found = []
    for name, check in cases.items():
        try:
            check()
            found.append((name, False))
        except ValueError:
            found.append((name, True))
    return spark.createDataFrame(found, "case_name string, raised boolean")


@query(
    "winsorize",
    "WITH q AS (SELECT quantile_cont(value, 0.025) AS a, quantile_cont(value, 0.975) AS b FROM events) "
    f"SELECT event_id, {r6('CASE WHEN value < a THEN a WHEN value > b THEN b ELSE value END')} AS value FROM events, q",
)
def _(spark, sf_dir):
    return rounded(va.winsorize(table(spark, sf_dir, "events").select("event_id", "value"), ["value"]))


@query(
    "impute_mean",
    f"SELECT l_orderkey, l_quantity, {r6('coalesce(some_holes, (SELECT avg(some_holes) FROM ' + PROCESS_SQL + '))')} AS some_holes, "
    f"{r6('coalesce(many_holes, (SELECT avg(many_holes) FROM ' + PROCESS_SQL + '))')} AS many_holes FROM {PROCESS_SQL}",
)
def _(spark, sf_dir):
    return rounded(va.impute_mean(process(spark, sf_dir).select("l_orderkey", "l_quantity", "some_holes", "many_holes")))


def _mode(column: str) -> str:
    return f"(SELECT {column} FROM {PROCESS_SQL} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"


@query(
    "impute_mode",
    f"SELECT l_orderkey, l_returnflag, CASE WHEN grade IS NULL OR grade = '' THEN {_mode('grade')} ELSE grade END AS grade, "
    f"coalesce(some_holes, {_mode('some_holes')}) AS some_holes, coalesce(many_holes, {_mode('many_holes')}) AS many_holes FROM {PROCESS_SQL}",
)
def _(spark, sf_dir):
    return va.impute_mode(process(spark, sf_dir).select("l_orderkey", "l_returnflag", "grade", "some_holes", "many_holes"))


@query("impute_zero", f"SELECT l_orderkey, coalesce(some_holes, 0) AS some_holes, coalesce(grade, '0') AS grade FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    return va.impute_zero(process(spark, sf_dir).select("l_orderkey", "some_holes", "grade"))


Z = ["l_quantity", "l_extendedprice", "some_holes", "fixed_number"]


@query(
    "zscore",
    "WITH s AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in Z) + f" FROM {PROCESS_SQL}) "
    "SELECT l_orderkey, " + ", ".join(f"{r6(f'({c} - m_{c}) / CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END')} AS {c}" for c in Z)
    + f" FROM {PROCESS_SQL}, s",
)
def _(spark, sf_dir):
    return rounded(va.zscore(process(spark, sf_dir).select("l_orderkey", *Z), Z))


@query(
    "one_hot",
    "SELECT event_id, " + ", ".join(f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS event_type_{v}" for v in EVENT_TYPES) + " FROM events",
)
def _(spark, sf_dir):
    return va.one_hot(table(spark, sf_dir, "events").select("event_id", "event_type"))


@query(
    "one_hot_drop_first",
    "SELECT l_orderkey, " + ", ".join(f"CASE WHEN l_linenumber = {v} THEN 1 ELSE 0 END AS l_linenumber_{v}" for v in range(2, 8))
    + ", " + ", ".join(f"CASE WHEN l_returnflag = '{v}' THEN 1 ELSE 0 END AS l_returnflag_{v}" for v in "NR") + " FROM lineitem",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return va.one_hot(df, ["l_linenumber", "l_returnflag"], drop_first=True)


@query(
    "sparse_one_hot",
    "SELECT l_suppkey, count(*) AS n, CAST(0 AS BIGINT) AS misses FROM lineitem GROUP BY l_suppkey",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_suppkey").cast("string").alias("supplier"))
    encoded, _model = va.sparse_one_hot(df, ["supplier"])
    # of the values that are stored: as an array a vector is as long as there are suppliers
    ones = F.udf(lambda v: float(v.values.sum()), "double")("features")
    return encoded.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(ones != 1.0).alias("misses"))


@query("encode_items", f"SELECT l_orderkey, concat('grade=', coalesce(grade, 'nan')) AS grade, concat('station1_rework_flag=', CAST(station1_rework_flag AS STRING)) AS station1_rework_flag FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    df = process(spark, sf_dir).select("l_orderkey", "grade", "station1_rework_flag")
    return va.encode_items(df, ["grade", "station1_rework_flag"])


@query("array_to_string", f"SELECT l_orderkey, array_to_string(list_sort([concat('l_returnflag=', l_returnflag), concat('grade=', coalesce(grade, 'nan'))]), ',') AS items FROM {PROCESS_SQL}")
def _(spark, sf_dir):
    df = va.encode_items(process(spark, sf_dir), ["l_returnflag", "grade"], "items")
    return df.select("l_orderkey", va.items_to_string(F.col("items")).alias("items"))


@query("round_half_even", "SELECT p_partkey, round_even(p_size / 8.0, 2) AS eighth FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", va.round_half_even(F.col("p_size") / 8.0, 2).alias("eighth"))


def _profile_sql() -> str:
    numbers = ["l_quantity", "some_holes", "many_holes", "holed_constant", "empty_number"]
    texts = ["grade", "fixed_text"]
    parts = []
    for c in numbers + texts:
        n = c in numbers
        mode = f"(SELECT CAST({c} AS {'DOUBLE' if n else 'STRING'}) FROM {PROCESS_SQL} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        figure = lambda f: f"CAST({f} AS DOUBLE)" if n else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, {r6(f'1 - count({c}) / count(*)')} AS null_ratio, count(DISTINCT {c}) AS n_distinct, "
            f"CAST({mode} AS STRING) AS mode, "
            + ", ".join(
                f"{r6(figure(f))} AS {name}"
                for name, f in [
                    ("min", f"min({c})"), ("max", f"max({c})"), ("mean", f"avg({c})"), ("std", f"stddev_pop({c})"),
                    ("q1", f"quantile_cont(CAST({c} AS DOUBLE), 0.25)"), ("q3", f"quantile_cont(CAST({c} AS DOUBLE), 0.75)"),
                ]
            )
            + f" FROM {PROCESS_SQL}"
        )
    return " UNION ALL ".join(parts)


@query("profile", _profile_sql())
def _(spark, sf_dir):
    columns = ["l_quantity", "some_holes", "many_holes", "holed_constant", "empty_number", "grade", "fixed_text"]
    return rounded(st.profile(process(spark, sf_dir), columns))


@query("join_xy", "SELECT o_orderkey AS sheet_id, o_totalprice, l_quantity, l_tax FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def _(spark, sf_dir):
    y = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS sheet_id", "o_totalprice")
    x = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS sheet_id", "l_quantity", "l_tax")
    return re_.join_xy(y, x)


@query("group_mean", f"SELECT l_orderkey, l_returnflag, {r6('avg(l_quantity)')} AS l_quantity FROM lineitem GROUP BY ALL")
def _(spark, sf_dir):
    return rounded(re_.group_mean(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], "l_quantity"))


@query("pivot_mean", "SELECT l_orderkey, " + ", ".join(f"""{r6(f"avg(l_quantity) FILTER (WHERE l_returnflag = '{v}')")} AS "{v}" """ for v in "ANR") + "FROM lineitem GROUP BY l_orderkey")
def _(spark, sf_dir):
    return rounded(re_.pivot_mean(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", "l_quantity", list("ANR")))


def _targets_sql(keep: str, pivot: str, names: dict) -> str:
    picks = ", ".join(f"avg(m) FILTER (WHERE category = '{v}') AS \"{n}\"" for v, n in names.items())
    known = " AND ".join(f'"{n}" IS NOT NULL' for n in names.values())
    return (
        f"(SELECT * FROM (SELECT sheet AS sheet_id, {picks} FROM (SELECT sheet, taken, model, CAST({pivot} AS STRING) AS category, "
        f"avg(CAST(result AS DOUBLE)) AS m FROM {INSPECTION_SQL} WHERE {keep} GROUP BY ALL) GROUP BY sheet) WHERE {known})"
    )


PSH_SQL = _targets_sql("defect = 'HI' AND point = 1", "judge", {"L": "Main_PSH", "O": "Sub_PSH"})
CD_SQL = _targets_sql("defect = 'LN' AND judge = 'L'", "point", {"1": "CDx", "2": "CDy"})


@query("measure_targets_psh", f'SELECT sheet_id, {r6(chr(34) + "Main_PSH" + chr(34))} AS "Main_PSH", {r6(chr(34) + "Sub_PSH" + chr(34))} AS "Sub_PSH" FROM {PSH_SQL}')
def _(spark, sf_dir):
    return rounded(re_.measure_targets(inspection(spark, sf_dir), "PSH"))


@query("measure_targets_cd", f'SELECT sheet_id, {r6(chr(34) + "CDx" + chr(34))} AS "CDx", {r6(chr(34) + "CDy" + chr(34))} AS "CDy" FROM {CD_SQL}')
def _(spark, sf_dir):
    return rounded(re_.measure_targets(inspection(spark, sf_dir), "CD"))


def _prepare_sql(columns: list[str], output: list[str]) -> str:
    filled = ", ".join(f"CAST(coalesce({c}, avg({c}) OVER ()) AS DOUBLE) AS {c}" for c in columns)
    limits = ", ".join(f"quantile_cont({c}, 0.025) AS a_{c}, quantile_cont({c}, 0.975) AS b_{c}" for c in columns)
    cut = ", ".join(f'{r6(f"CASE WHEN {c} < a_{c} THEN a_{c} WHEN {c} > b_{c} THEN b_{c} ELSE {c} END")} AS "{c}"' for c in output)
    return (
        f"WITH j AS (SELECT * FROM {PSH_SQL} JOIN {SHEETS_SQL} USING (sheet_id)), f AS (SELECT {filled} FROM j), "
        f"q AS (SELECT {limits} FROM f) SELECT {cut} FROM f, q"
    )


PREPARED = ["Main_PSH", "Sub_PSH", "o_totalprice", "customer_no", "pressure"]


@query("prepare_xy_features", _prepare_sql(PREPARED, PREPARED[2:]))
def _(spark, sf_dir):
    return rounded(re_.prepare_xy(sheets(spark, sf_dir), inspection(spark, sf_dir), "PSH")[0])


@query("prepare_xy_targets", _prepare_sql(PREPARED, PREPARED[:2]))
def _(spark, sf_dir):
    return rounded(re_.prepare_xy(sheets(spark, sf_dir), inspection(spark, sf_dir), "PSH")[1])
