"""Registered queries on proportion tests, control charts, rules and rank lists."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from yieldlens.operators import ordered, proportion as pt, ranks as rk, rules as ru, spc, values as va
from yieldlens.plans.shared import (
    ITEMS, RANKS_SQL, TRANSACTIONS_SQL, UNITS_SQL, market_ranks, r6, rounded, scratch_folder, sql_chi2_upper_tail,
    sql_t5_upper_tail, sql_upper_quantile, table, transactions, units,
)
from yieldlens.sources import tables

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


# ---- proportion tests

LEVELS = ["Parameter", "tool_id", "chmb"]


def _levels_sql(source: str, levels: list[str], every: list[str]) -> str:
    parts = []
    for i in range(1, len(levels)):
        shown = ", ".join(
            (f'{c} AS "{c}"' if c in levels[: i + 1] else f'CAST(NULL AS STRING) AS "{c}"') for c in every
        )
        keys = ", ".join(levels[: i + 1])
        parts.append(
            f"SELECT {i} AS depth, '{levels[i]}' AS flag, site, {shown}, CAST(sum(NG_num) AS BIGINT) AS \"NG_num\", "
            f"CAST(sum(Total_num) AS BIGINT) AS \"Total_num\", round_even(100.0 * sum(NG_num) / sum(Total_num), 2) AS \"NG_Ratio\" "
            f"FROM {source} WHERE {levels[i]} <> 'None' GROUP BY site, {keys}"
        )
    return " UNION ALL BY NAME ".join(parts)


def _test_sql(source: str, levels: list[str], every: list[str], grouping: str = "parent", every_p: bool = False) -> str:
    parents = ", ".join(f"CASE WHEN depth > {j} THEN {c} END AS parent_{j}" for j, c in enumerate(levels[:-1]))
    keys = ", ".join(f"parent_{j}" for j in range(len(levels) - 1))
    group = f"depth, site, {keys}"
    runs = "SELECT *, 0 AS run FROM p"
    if grouping == "adjacent":
        line = f"(PARTITION BY depth, site, {levels[0]} ORDER BY NG_Ratio DESC NULLS LAST, {', '.join(levels)})"
        same = " AND ".join(
            f"lag(parent_{j}) OVER w IS NOT DISTINCT FROM parent_{j}" for j in range(len(levels) - 1)
        )
        runs = (
            f"SELECT * EXCLUDE (turn), sum(turn) OVER w AS run FROM (SELECT *, CASE WHEN {same} "
            f"AND lag(1) OVER w IS NOT NULL THEN 0 ELSE 1 END AS turn FROM p WINDOW w AS {line}) WINDOW w AS {line}"
        )
        group = f"depth, site, {levels[0]}, run"
    gap = "abs(NG_num - Total_num * pooled)"
    chi = sql_chi2_upper_tail("chi2", "(children - 1)")
    p = "p_value" if every_p else "CASE WHEN p_value < 0.05 THEN p_value END"
    shown = ", ".join(f'"{c}"' for c in every)
    return (
        f"WITH l AS ({_levels_sql(source, levels, every)}), p AS (SELECT *, {parents} FROM l), r AS ({runs}), "
        f"g AS (SELECT *, count(*) OVER w AS children, sum(NG_num) OVER w / sum(Total_num) OVER w AS pooled, "
        f"min(least(NG_num, Total_num - NG_num)) OVER w AS smallest FROM r WINDOW w AS (PARTITION BY {group})), "
        f"c AS (SELECT *, CASE WHEN children > 1 AND smallest > 0 THEN sum(power(CASE WHEN children = 2 THEN {gap} - least(0.5, {gap}) "
        f"ELSE {gap} END, 2) / (Total_num * nullif(pooled * (1 - pooled), 0))) OVER (PARTITION BY {group}) END AS chi2 FROM g), "
        f"t AS (SELECT *, CASE WHEN chi2 IS NOT NULL THEN {chi} END AS p_value FROM c) "
        f'SELECT {shown}, flag, site, "NG_num", "Total_num", "NG_Ratio", {r6(p)} AS "p-value", '
        f"CASE WHEN p_value < 0.05 AND NG_num / Total_num > pooled THEN 'Y' ELSE '' END AS sig_flag FROM t"
    )


@query(
    "ng_ratio_levels",
    f'SELECT "Parameter", tool_id, chmb, flag, site, "NG_num", "Total_num", "NG_Ratio" FROM ({_levels_sql(UNITS_SQL, LEVELS, LEVELS)})',
)
def _(spark, sf_dir):
    return pt.ng_ratio_levels(units(spark, sf_dir), LEVELS)


@query("chi2_by_group", _test_sql(UNITS_SQL, LEVELS, LEVELS, every_p=True))
def _(spark, sf_dir):
    tested = pt.level_tests(units(spark, sf_dir), LEVELS)
    return rounded(
        tested.select(*LEVELS, "flag", "site", "NG_num", "Total_num", "NG_Ratio", F.col("p_value").alias("p-value"), "sig_flag")
    )


@query("proportion_test", _test_sql(UNITS_SQL, LEVELS, LEVELS))
def proportion_test(spark, sf_dir):
    return rounded(pt.proportion_test(units(spark, sf_dir), LEVELS))


@query("proportion_test_adjacent", _test_sql(UNITS_SQL, LEVELS, LEVELS, "adjacent"))
def _(spark, sf_dir):
    return rounded(pt.proportion_test(units(spark, sf_dir), LEVELS, grouping="adjacent"))


EVERY_LEVEL = ["Parameter", "tool_id", "chmb", "line_id", "unit_name"]


@query(
    "proportion_test_sites",
    " UNION ALL BY NAME ".join(
        f"SELECT * FROM ({_test_sql(f'(SELECT * FROM {UNITS_SQL} WHERE site = {chr(39)}{site}{chr(39)})', levels, EVERY_LEVEL)})"
        for site, levels in pt.SITE_LEVELS.items()
    ),
)
def _(spark, sf_dir):
    return rounded(pt.proportion_test_sites(units(spark, sf_dir)))


@query(
    "run_ids",
    "SELECT user_id, CAST(run_id AS BIGINT) AS run_id, min(event_id) AS first_event, count(*) AS n FROM (SELECT *, sum(turn) OVER w AS run_id FROM "
    "(SELECT user_id, event_id, ts, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND lag(1) OVER w IS NOT NULL "
    "THEN 0 ELSE 1 END AS turn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) "
    "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY user_id, run_id",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    runs = ordered.run_ids(df, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()], ["event_type"])
    return runs.groupBy("user_id", F.col("run_id").cast("long").alias("run_id")).agg(
        F.min("event_id").alias("first_event"), F.count("*").alias("n")
    )


@query(
    "drop_adjacent_repeats",
    "SELECT user_id, event_id, event_type FROM events QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    kept = ordered.drop_adjacent_repeats(df, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()], ["event_type"])
    return kept.select("user_id", "event_id", "event_type")


# ---- control charts

def _time_order():
    return [F.col("ts").asc(), F.col("event_id").asc()]


def _rolling_sql(key: str) -> str:
    line = f"PARTITION BY {key} ORDER BY ts, event_id"
    return (
        f"(SELECT *, avg(s) OVER five AS s_bar FROM (SELECT {key} AS series, event_id, ts, {key}, value, "
        "row_number() OVER line - 1 AS ordinal, "
        "avg(value) OVER five AS x_bar, stddev_pop(value) OVER five AS s, abs(value - lag(value) OVER line) AS moving_range "
        f"FROM events WINDOW line AS ({line}), five AS ({line} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) "
        f"WINDOW five AS ({line} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"
    )


def _spc_sql(key: str, usl: float) -> str:
    line = f"(PARTITION BY {key} ORDER BY ts, event_id)"
    return (
        f"(SELECT *, coalesce(sign(t) * z, 0) AS q, value > mr + 3 * mr / {spc.D2} AS above FROM (SELECT *, CASE WHEN tail > 0 THEN "
        f"{sql_upper_quantile('tail')} END AS z FROM (SELECT *, {sql_t5_upper_tail('nullif(t, 0)')} AS tail FROM "
        f"(SELECT *, CASE WHEN ordinal >= 2 THEN sqrt(ordinal / (ordinal + 1)) * (value - lag(x_bar) OVER {line}) / nullif(s_bar, 0) END AS t, "
        f"avg(moving_range) OVER (PARTITION BY {key}) AS mr, avg(value) OVER (PARTITION BY {key}) AS cl, "
        f"value > {usl} AS over_spec FROM {_rolling_sql(key)}))))"
    )


@query(
    "rolling_statistics",
    f"SELECT event_id, ordinal, {r6('x_bar')} AS x_bar, {r6('s')} AS s, {r6('s_bar')} AS s_bar, {r6('moving_range')} AS moving_range FROM {_rolling_sql('user_id')}",
)
def _(spark, sf_dir):
    rolled = spc.rolling_statistics(table(spark, sf_dir, "events"), ["user_id"], _time_order(), "value")
    return rounded(rolled.select("event_id", "ordinal", "x_bar", "s", "s_bar", "moving_range"))


@query("q_statistic", f"SELECT event_id, ordinal, {r6('q', 5)} AS q_value FROM {_spc_sql('event_type', 400)}")
def _(spark, sf_dir):
    q = spc.q_statistic(table(spark, sf_dir, "events"), ["event_type"], _time_order(), "value")
    return rounded(q.select("event_id", "ordinal", "q_value"), 5)


@query(
    "xmr_limits",
    f"SELECT event_type, {r6('avg(moving_range)')} AS mr_bar, {r6(f'avg(moving_range) / {spc.D2}')} AS sigma, "
    f"{r6(f'avg(moving_range) + 3 * avg(moving_range) / {spc.D2}')} AS ucl, {r6('avg(value)')} AS cl FROM {_rolling_sql('event_type')} GROUP BY event_type",
)
def _(spark, sf_dir):
    return rounded(spc.xmr_limits(table(spark, sf_dir, "events"), ["event_type"], _time_order(), "value"))


@query(
    "xmr_limits_from_mean",
    f"SELECT event_type, {r6('avg(moving_range)')} AS mr_bar, {r6(f'avg(moving_range) / {spc.D2}')} AS sigma, "
    f"{r6(f'avg(value) + 3 * avg(moving_range) / {spc.D2}')} AS ucl, {r6('avg(value)')} AS cl FROM {_rolling_sql('event_type')} GROUP BY event_type",
)
def _(spark, sf_dir):
    """The upper limit lies above the mean of the values."""
    return rounded(spc.xmr_limits(table(spark, sf_dir, "events"), ["event_type"], _time_order(), "value", center="mean"))


SPC_LIMIT = spc.q_limits()["UCL"]


@query(
    "spc_table",
    f'SELECT user_id, ordinal, event_id AS sheet_id, {r6("q", 5)} AS "Q-value", value AS "x-value", q > {SPC_LIMIT!r} AS "Out of Q control limit", '
    f'above AS "Out of X-MR control limit", over_spec AS "Out of X-MR spec line" FROM {_spc_sql("user_id", 200)}',
)
def _(spark, sf_dir):
    out = spc.spc_table(table(spark, sf_dir, "events"), ["user_id"], _time_order(), "event_id", "value", usl=200.0)
    return rounded(out, 5)


@query(
    "spc_single_series",
    f'SELECT ordinal, sheet_id, {r6("q", 5)} AS "Q-value", value AS "x-value", q > {SPC_LIMIT!r} AS "Out of Q control limit", '
    f'above AS "Out of X-MR control limit", CAST(NULL AS BOOLEAN) AS "Out of X-MR spec line" FROM (SELECT event_id AS sheet_id, * FROM {_spc_sql("one", 200)})'.replace(
        "FROM events WINDOW", "FROM (SELECT *, 1 AS one FROM events) WINDOW"
    ),
)
def _(spark, sf_dir):
    """One series over the whole table, always in blocks: no task sorts it alone."""
    df = table(spark, sf_dir, "events")
    out = spc.spc_table(df, [], _time_order(), "event_id", "value", max_group_rows=1000, block_rows=2000)
    return rounded(out, 5)


@query(
    "chart_points",
    f"SELECT event_type, ordinal, event_id AS sheet_id, {r6('q', 5)} AS q_value, CASE WHEN q > {SPC_LIMIT!r} THEN 'red' ELSE 'black' END AS q_color, "
    f"value AS x_value, CASE WHEN above THEN 'red' ELSE 'black' END AS x_color FROM {_spc_sql('event_type', 400)}",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return rounded(spc.chart_tables(df, ["event_type"], _time_order(), "event_id", "value")[0], 5)


@query(
    "chart_limits",
    f"SELECT event_type, {r6(f'CAST({SPC_LIMIT!r} AS DOUBLE)')} AS q_ucl, CAST(0 AS DOUBLE) AS q_cl, {r6(f'CAST({-SPC_LIMIT!r} AS DOUBLE)')} AS q_lcl, "
    f"{r6(f'avg(moving_range) + 3 * avg(moving_range) / {spc.D2}')} AS x_ucl, {r6('avg(value)')} AS x_cl, CAST(400 AS DOUBLE) AS x_usl "
    f"FROM {_rolling_sql('event_type')} GROUP BY event_type",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return rounded(spc.chart_tables(df, ["event_type"], _time_order(), "event_id", "value", usl=400.0)[1])


# ---- association rules

SUPPORT, CONFIDENCE, LIFT = 0.02, 0.05, 1.000001


def _sets_sql(source: str = TRANSACTIONS_SQL, by: str | None = None) -> str:
    """Item sets of up to three columns with counts per class (and group), from one pass over the transactions."""
    words = ", ".join(f"concat('{c}=', coalesce(CAST({c} AS STRING), 'nan')) AS w{i}" for i, c in enumerate(ITEMS))
    names = [f"w{i}" for i in range(len(ITEMS))]
    keys = [by] if by else []
    sets = ", ".join(f"({', '.join([*keys, *combo])})" for size in (1, 2, 3) for combo in itertools.combinations(names, size))
    group = "".join(f"{k}, " for k in keys)
    both = f"c JOIN w USING ({by})" if by else "c, w"
    return (
        f"t AS MATERIALIZED (SELECT {group}Y, {words} FROM {source}), "
        f"c AS MATERIALIZED (SELECT {group}list_sort(list_filter([{', '.join(names)}], lambda x: x IS NOT NULL)) AS items, count(*) AS n_all, "
        "count(*) FILTER (WHERE Y = 0) AS n_0, count(*) FILTER (WHERE Y = 1) AS n_1 "
        f"FROM t GROUP BY GROUPING SETS ({sets})), "
        f"w AS MATERIALIZED (SELECT {group}count(*) FILTER (WHERE Y = 0) AS rows_0, count(*) FILTER (WHERE Y = 1) AS rows_1 FROM t{' GROUP BY ' + by if by else ''}), "
        "s AS MATERIALIZED (SELECT *, CAST(len(items) AS INTEGER) AS size, array_to_string(items, ',') AS name FROM "
        f"(SELECT {group}items, n_all, n_1, 0 AS \"Y\", n_0 AS n, n_0 / rows_0 AS support FROM {both} UNION ALL "
        f"SELECT {group}items, n_all, n_1, 1, n_1, n_1 / rows_1 FROM {both}) WHERE support >= {SUPPORT})"
    )


@query("frequent_itemsets", f"WITH {_sets_sql()} SELECT \"Y\", array_to_string(items, ',') AS items, size, n, {r6('support')} AS support, {r6('n_1 / n_all')} AS \"NG_Ratio\" FROM s")
def _(spark, sf_dir):
    sets = ru.frequent_itemsets(transactions(spark, sf_dir), ITEMS, "Y", min_support=SUPPORT)
    return rounded(sets.withColumn("items", F.array_join("items", ",")))


WIDE = [f"x{i:02}" for i in range(64)]
WIDE_SUPPORT = 0.4


def _wide_sql() -> str:
    """Sets of up to three of 64 columns by joining every row's items with themselves."""
    sizes = {
        1: "SELECT vec_id, y, [w] AS s FROM long",
        2: "SELECT a.vec_id, a.y, [a.w, b.w] AS s FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.w < b.w",
        3: "SELECT a.vec_id, a.y, [a.w, b.w, c.w] AS s FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.w < b.w JOIN long c ON a.vec_id = c.vec_id AND b.w < c.w",
    }
    sets = " UNION ALL ".join(
        f"SELECT array_to_string(s, ',') AS items, {size} AS size, count(*) AS n_all, count(*) FILTER (WHERE y = 0) AS n_0, "
        f"count(*) FILTER (WHERE y = 1) AS n_1 FROM ({source}) GROUP BY s" for size, source in sizes.items()
    )
    sides = " UNION ALL ".join(
        f"SELECT {y} AS \"Y\", items, CAST(size AS INTEGER) AS size, n_{y} AS n, {r6(f'n_{y} / rows_{y}')} AS support, {r6('n_1 / n_all')} AS \"NG_Ratio\" "
        f"FROM sets, (SELECT count(*) AS rows_{y} FROM embeddings WHERE label % 2 = {y}) WHERE n_{y} / rows_{y} >= {WIDE_SUPPORT}" for y in (0, 1)
    )
    return (
        "WITH long AS MATERIALIZED (SELECT vec_id, label % 2 AS y, concat('x', lpad(CAST(i AS STRING), 2, '0'), '=', CASE WHEN embedding[i + 1] > -0.05 THEN '1' ELSE '0' END) AS w "
        f"FROM embeddings, range(64) r(i)), sets AS MATERIALIZED ({sets}) {sides}"
    )


@query("frequent_itemsets_wide", _wide_sql())
def _(spark, sf_dir):
    """Many columns: counted on bitmaps of blocks of rows."""
    cells = [(F.col("embedding")[i] > -0.05).cast("int").alias(c) for i, c in enumerate(WIDE)]
    rows = table(spark, sf_dir, "embeddings").select((F.col("label") % 2).alias("Y"), *cells)
    sets = ru.frequent_itemsets(rows, WIDE, "Y", min_support=WIDE_SUPPORT)
    return rounded(sets.withColumn("items", F.array_join("items", ",")))


def _rules_sql(largest_addition: int = 2, source: str = TRANSACTIONS_SQL, by: str | None = None, zero: str = "ends_with(x, '=0')") -> str:
    same = [f"{{side}}.{by} = p.{by} AND " if by else "", "{side}.\"Y\" = p.\"Y\""]
    b, a = ("".join(same).format(side=side) for side in "ba")
    return (
        f"{_sets_sql(source, by)}, splits AS MATERIALIZED (SELECT *, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS base, "
        "list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS addition FROM (SELECT *, unnest(range(1, CAST(power(2, size) AS INT) - 1)) AS mask "
        f"FROM s WHERE size > 1 AND len(list_filter(items, lambda x: {zero})) = 0)), "
        "rules AS (SELECT p.*, p.support / b.support AS confidence, p.support / b.support / a.support AS lift FROM splits p "
        f"JOIN s b ON {b} AND b.name = array_to_string(p.base, ',') "
        f"JOIN s a ON {a} AND a.name = array_to_string(p.addition, ',') "
        f"WHERE len(addition) <= {largest_addition} AND p.support / b.support >= {CONFIDENCE} AND p.support / b.support / a.support >= {LIFT})"
    )


THRESHOLDS = {"min_support": SUPPORT, "min_confidence": CONFIDENCE, "min_lift": LIFT}


@query(
    "association_rules",
    f"WITH {_rules_sql()} SELECT array_to_string(base, ',') AS item_base, array_to_string(addition, ',') AS item_add, {r6('support')} AS \"Support\", "
    f"{r6('confidence')} AS \"Confidence\", {r6('lift')} AS \"Lift\", {r6('n_1 / n_all')} AS \"NG_Ratio\", \"Y\" FROM rules",
)
def _(spark, sf_dir):
    found = ru.association_rules(transactions(spark, sf_dir), ITEMS, "Y", **THRESHOLDS)
    return rounded(
        found.withColumn("item_base", va.items_to_string(F.col("item_base"))).withColumn("item_add", va.items_to_string(F.col("item_add")))
    )


@query(
    "mine_rules",
    f"WITH {_rules_sql()} SELECT array_to_string(base, ',') AS item_base, array_to_string(addition, ',') AS item_add, "
    f"round_even(lift, 4) AS \"Lift\", {r6('n_1 / n_all')} AS \"NG_Ratio\", \"Y\" FROM rules",
)
def _(spark, sf_dir):
    return rounded(ru.mine_rules(transactions(spark, sf_dir), "Y", **THRESHOLDS))


PADDED = "CASE WHEN station = 2 THEN '02' ELSE CAST(station AS STRING) END"
PADDED_SQL = f"(SELECT * REPLACE ({PADDED} AS station) FROM {TRANSACTIONS_SQL})"
SUBSTRING = "contains(x, '=0')"


@query(
    "association_rules_substring",
    f"WITH {_rules_sql(source=PADDED_SQL, zero=SUBSTRING)} "
    "SELECT array_to_string(base, ',') AS item_base, array_to_string(addition, ',') AS item_add, "
    f"{r6('confidence')} AS \"Confidence\", {r6('lift')} AS \"Lift\", \"Y\" FROM rules",
)
def _(spark, sf_dir):
    """Values that begin with 0 count as operations not passed."""
    rows = transactions(spark, sf_dir).withColumn("station", F.expr(PADDED))
    found = ru.association_rules(rows, ITEMS, "Y", zero_match="substring", **THRESHOLDS)
    named = found.withColumn("item_base", va.items_to_string(F.col("item_base"))).withColumn("item_add", va.items_to_string(F.col("item_add")))
    return rounded(named.select("item_base", "item_add", "Confidence", "Lift", "Y"))


FILES_SQL = f"(SELECT concat('batch=', CAST(l_orderkey % 3 AS STRING)) AS file, {TRANSACTIONS_SQL.removeprefix('(SELECT ')}"


@query(
    "mine_rules_folder",
    f"WITH {_rules_sql(source=FILES_SQL, by='file')} SELECT file, array_to_string(base, ',') AS item_base, array_to_string(addition, ',') AS item_add, "
    f"round_even(lift, 4) AS \"Lift\", {r6('n_1 / n_all')} AS \"NG_Ratio\", \"Y\" FROM rules",
)
def _(spark, sf_dir):
    """A folder of tables, each mined for itself in the same jobs; the result names the table."""
    folder = scratch_folder(spark)
    df = transactions(spark, sf_dir, "l_orderkey % 3 AS batch")
    tables.write_table(df, folder, "csv", partition_by="batch")
    files = tables.read_dir(spark, folder, "csv", schema=df.drop("batch").schema, folders=True).drop("batch")
    return rounded(ru.mine_rules(files, "Y", by="file", **THRESHOLDS))


@query(
    "mine_rules_flat",
    f"WITH {_rules_sql(1)}, flat AS (SELECT DISTINCT base[1] AS \"X1\", coalesce(base[2], '') AS \"X2\", addition[1] AS \"X3\", round_even(lift, 4) AS \"Lift\", "
    "round_even(confidence, 4) AS confidence, n_1 / n_all AS ratio, \"Y\" FROM rules) "
    f"SELECT \"X1\", \"X2\", \"X3\", \"Lift\", {r6('ratio')} AS \"NG_Ratio\", \"Y\" FROM (SELECT * FROM flat QUALIFY lag(ratio) OVER "
    "(PARTITION BY \"Y\" ORDER BY \"X2\" = '', ratio, \"Lift\" DESC, confidence DESC, \"X1\", \"X2\", \"X3\") IS DISTINCT FROM ratio)",
)
def _(spark, sf_dir):
    return rounded(ru.mine_rules_flat(transactions(spark, sf_dir), "Y", **THRESHOLDS))


@query(
    "match_rules",
    f"WITH r AS (SELECT DISTINCT concat('o_orderpriority=', o_orderpriority) AS a, concat('l_linestatus=', l_linestatus) AS b FROM {TRANSACTIONS_SQL}) "
    f"SELECT concat(a, '&', b) AS rule_id, count(*) AS all_count, count(*) FILTER (WHERE Y = 1) AS ng_count, "
    f"{r6('count(*) FILTER (WHERE Y = 1) / count(*)')} AS \"NG_Ratio\" FROM r JOIN {TRANSACTIONS_SQL} t ON a = concat('o_orderpriority=', o_orderpriority) "
    "AND b = concat('l_linestatus=', l_linestatus) GROUP BY ALL",
)
def _(spark, sf_dir):
    rows = va.encode_items(transactions(spark, sf_dir), ITEMS, "items")
    pairs = rows.select(
        F.concat(F.lit("o_orderpriority="), "o_orderpriority").alias("a"), F.concat(F.lit("l_linestatus="), "l_linestatus").alias("b")
    ).distinct()
    rules = pairs.select(F.concat_ws("&", "a", "b").alias("rule_id"), F.array("a", "b").alias("items"))
    return rounded(ru.match_rules(rules, rows, "items", "Y"))


# ---- rank lists

LINE = '(PARTITION BY "Method" ORDER BY "IndexValue" DESC, "OPID_TOOLID")'


def _order():
    return rk.ranking(rk.VALUE, rk.LABEL)



def _knee_sql(source: str) -> str:
    return (
        "(WITH o AS (SELECT *, row_number() OVER " + LINE + " AS rank, count(*) OVER (PARTITION BY \"Method\") AS n, "
        "min(\"IndexValue\") OVER (PARTITION BY \"Method\") AS lo, max(\"IndexValue\") OVER (PARTITION BY \"Method\") AS hi FROM " + source + "), "
        "d AS (SELECT *, 1.0 - (\"IndexValue\" - lo) / nullif(hi - lo, 0) - (rank - 1) / nullif(n - 1, 0) AS curve FROM o), "
        "e AS (SELECT *, lead(curve) OVER " + LINE + " AS after, curve >= coalesce(lag(curve) OVER " + LINE + ", curve) AND curve >= coalesce(lead(curve) OVER " + LINE + ", curve) AS top, "
        "curve <= coalesce(lag(curve) OVER " + LINE + ", curve) AND curve <= coalesce(lead(curve) OVER " + LINE + ", curve) AS bottom FROM d), "
        "t AS (SELECT *, last_value(CASE WHEN bottom THEN 0.0 WHEN top THEN curve - 1.0 / nullif(n - 1, 0) END IGNORE NULLS) OVER " + LINE + " AS threshold, "
        "last_value(CASE WHEN top THEN rank END IGNORE NULLS) OVER " + LINE + " AS top_rank FROM e) "
        "SELECT * EXCLUDE (n, lo, hi, curve, after, top, bottom, threshold, top_rank), "
        "arg_min(top_rank, rank) FILTER (WHERE rank < n AND top_rank IS NOT NULL AND after < threshold) OVER (PARTITION BY \"Method\") AS knee FROM t)"
    )


COLUMNS = '"Method", "OPID_TOOLID", "IndexValue"'


@query("scale_importance", f'SELECT {COLUMNS}, "IndexValue" * 100 AS percent, {r6(chr(34) + "IndexValue" + chr(34) + " / avg(abs(" + chr(34) + "IndexValue" + chr(34) + ")) OVER (PARTITION BY " + chr(34) + "Method" + chr(34) + ")")} AS weight FROM {RANKS_SQL}')
def _(spark, sf_dir):
    return rounded(va.scale_importance(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE))


@query("top_fraction", f'SELECT {COLUMNS} FROM {RANKS_SQL} QUALIFY row_number() OVER {LINE} <= floor(0.25 * count(*) OVER (PARTITION BY "Method"))')
def _(spark, sf_dir):
    return rk.top_fraction(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE, rk.LABEL, 0.25)


@query("top_fraction_tail", f'SELECT {COLUMNS} FROM {RANKS_SQL} QUALIFY row_number() OVER {LINE} > count(*) OVER (PARTITION BY "Method") - floor(0.75 * count(*) OVER (PARTITION BY "Method"))')
def _(spark, sf_dir):
    return rk.top_fraction(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE, rk.LABEL, 0.75, end="tail")


@query("sort_ranks", f'SELECT {COLUMNS} FROM {RANKS_SQL} ORDER BY "IndexValue" DESC, "OPID_TOOLID"')
def _(spark, sf_dir):
    return rk.sort_ranks(market_ranks(spark, sf_dir), rk.VALUE, rk.LABEL)


@query("top_k", f'SELECT {COLUMNS} FROM {RANKS_SQL} QUALIFY row_number() OVER {LINE} <= 20')
def _(spark, sf_dir):
    return rk.top_k(market_ranks(spark, sf_dir), [rk.METHOD], _order(), 20)


@query("kneedle", f'SELECT {COLUMNS}, CAST(rank AS INT) AS rank, CAST(knee AS INT) AS knee FROM {_knee_sql(RANKS_SQL)}')
def _(spark, sf_dir):
    return rk.kneedle(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE, _order())


@query("cut_inclusive", f'SELECT {COLUMNS} FROM {_knee_sql(RANKS_SQL)} WHERE knee IS NULL OR rank <= knee')
def _(spark, sf_dir):
    return rk.cut_inclusive(rk.kneedle(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE, _order())).drop("rank", "knee")


@query("cut_exclusive", f'SELECT {COLUMNS} FROM {_knee_sql(RANKS_SQL)} WHERE rank <= CASE WHEN knee IS NULL OR knee = 1 THEN 5 ELSE knee - 1 END')
def _(spark, sf_dir):
    return rk.cut_exclusive(rk.kneedle(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE, _order())).drop("rank", "knee")


@query("label_frequency", f'SELECT \'Kneedle\' AS "Method", "OPID_TOOLID", count(*) AS "IndexValue" FROM {_knee_sql(RANKS_SQL)} WHERE knee IS NULL OR rank <= knee GROUP BY "OPID_TOOLID"')
def _(spark, sf_dir):
    return rk.label_frequency([rk.cut_inclusive(rk.kneedle(market_ranks(spark, sf_dir), [rk.METHOD], rk.VALUE, _order()))])


@query(
    "combine_methods",
    f'SELECT \'Kneedle\' AS "Method", "OPID_TOOLID", count(*) AS "Inter_count", {r6("max(weight)")} AS "weight_IndexValue" FROM '
    + _knee_sql('(SELECT *, "IndexValue" / avg(abs("IndexValue")) OVER (PARTITION BY "Method") AS weight FROM ' + RANKS_SQL + f" QUALIFY row_number() OVER {LINE} <= 20)")
    + ' WHERE knee IS NULL OR rank <= knee GROUP BY "OPID_TOOLID"',
)
def _(spark, sf_dir):
    return rounded(rk.combine_methods(market_ranks(spark, sf_dir)))
