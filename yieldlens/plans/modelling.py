"""Registered queries on metrics, neighbours, factor ranking, model choice and recommendations.

Fitted models have no SQL twin; the tests check them on planted signals and against brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldlens.operators import (
    compare as cm, importance as im, knn, metrics as me, recommend as rc, tuning as tu, values as va,
)
from yieldlens.plans.shared import r6, rounded, table

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


SCORED = ["l_returnflag", "l_discount AS y1", "l_tax AS p1", "l_extendedprice AS y2", "l_quantity * 1500 AS p2"]
SCORED_SQL = f"(SELECT {', '.join(SCORED)} FROM lineitem)"


@query(
    "mape",
    f"SELECT l_returnflag, {r6('100 * (sum(abs(y1 - p1) / nullif(y1, 0)) + sum(abs(y2 - p2) / nullif(y2, 0))) / (count(nullif(y1, 0)) + count(nullif(y2, 0)))')} AS mape, "
    f"count(*) FILTER (WHERE y1 = 0) + count(*) FILTER (WHERE y2 = 0) AS zero_targets FROM {SCORED_SQL} GROUP BY l_returnflag",
)
def _(spark, sf_dir):
    return rounded(me.mape(table(spark, sf_dir, "lineitem").selectExpr(*SCORED), [("y1", "p1"), ("y2", "p2")], ["l_returnflag"]))


@query("mean_squared_error", f"SELECT l_returnflag, {r6('(avg((y1 - p1) * (y1 - p1)) + avg((y2 - p2) * (y2 - p2))) / 2', 2)} AS mse FROM {SCORED_SQL} GROUP BY l_returnflag")
def _(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").selectExpr(*SCORED)
    return rounded(me.mean_error(scored, [("y1", "p1"), ("y2", "p2")], True, ["l_returnflag"]), 2)


@query(
    "f1_score",
    f"SELECT l_linestatus, {r6('2.0 * count(*) FILTER (WHERE a AND b) / (2.0 * count(*) FILTER (WHERE a AND b) + count(*) FILTER (WHERE a <> b))')} AS f1 "
    "FROM (SELECT l_linestatus, l_returnflag = 'R' AS a, l_quantity > 30 AS b FROM lineitem) GROUP BY l_linestatus",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus", "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y", "CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END AS p"
    )
    return rounded(me.f1(rows, "y", "p", 1, ["l_linestatus"]))


# ---- neighbours: every vector against all others

KNN_SQL = (
    f"SELECT id, {r6('avg(y)')} AS prediction FROM (SELECT a.vec_id AS id, b.label AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id "
    "QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) <= 5) GROUP BY id"
)


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "embedding AS features", "CAST(label AS DOUBLE) AS y")


@query("knn_regress", KNN_SQL)
def _(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    return rounded(knn.knn_regress(rows, rows, leave_out=True))


@query("knn_regress_cells", KNN_SQL)
def _(spark, sf_dir):
    """The plan for two large sides: pivot cells in bounded blocks."""
    rows = _vectors(spark, sf_dir)
    return rounded(knn.knn_regress(rows, rows, leave_out=True, broadcast_cells=1, block_rows=128, pivots=16))


# ---- factor ranking

FACTOR_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _factors(spark, sf_dir, target: str):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            *FACTOR_KEY, "p_type", "l_linestatus", "concat('T', CAST(l_suppkey % 8 AS STRING)) AS tool", "l_linenumber AS station",
            target,
        )
    )


NG = "CASE WHEN (l_suppkey % 8 = 3 AND l_quantity > 20) OR (p_type = 'SMALL' AND l_quantity > 35) OR l_discount > 0.09 THEN 1 ELSE 0 END AS Y"
LOSS = "l_quantity + CASE WHEN l_suppkey % 8 = 3 THEN 40 ELSE 0 END + CASE WHEN p_type = 'SMALL' THEN 25 ELSE 0 END AS Ylabel_loss"


@query("rank_features_rf")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice", "l_quantity * 2 + l_discount AS energy"
    )
    return im.rank_features_rf(df, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], ["l_extendedprice", "energy"])


@query("rank_features_lasso")
def _(spark, sf_dir):
    df = _factors(spark, sf_dir, LOSS)
    return im.rank_features_lasso(df, ["p_type", "l_linestatus", "tool", "station"], "Ylabel_loss", key=FACTOR_KEY)


@query("rank_features_lasso_ordered")
def _(spark, sf_dir):
    df = _factors(spark, sf_dir, NG)
    order = [F.col(c).asc() for c in FACTOR_KEY]
    return im.rank_features_lasso(df, ["p_type", "l_linestatus", "tool", "station"], "Y", order=order)


@query("rank_features_forest")
def _(spark, sf_dir):
    df = _factors(spark, sf_dir, NG)
    return im.rank_features_forest(df, ["p_type", "l_linestatus", "tool", "station"], "Y")


@query("select_factors")
def _(spark, sf_dir):
    df = _factors(spark, sf_dir, NG)
    return im.select_factors(df, "Y", key=FACTOR_KEY)[1]


@query("select_factors_targets")
def _(spark, sf_dir):
    """Two targets, as a regression; no target is a factor of another."""
    df = _factors(spark, sf_dir, LOSS).withColumn("Ylabel_tool", F.when(F.col("tool") == "T3", 1.0).otherwise(0.0))
    return im.select_factors_each(df, key=FACTOR_KEY, task="regression")[1]


# ---- model comparison and choice

def _measures(spark, sf_dir, *targets: str):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity / 50 AS quantity", "l_discount * 10 AS discount", "l_tax * 10 AS tax", "l_linenumber / 7 AS station",
        "CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS status", "l_extendedprice / 100000 AS price", *targets,
    )


@query("compare_classifiers")
def _(spark, sf_dir):
    df = _measures(spark, sf_dir, "CASE WHEN l_quantity + 100 * l_discount > 40 THEN 1 ELSE 0 END AS Y")
    return cm.compare_classifiers(df).table


@query("compare_classifiers_unstratified")
def _(spark, sf_dir):
    df = _measures(spark, sf_dir, "CASE WHEN l_quantity + 100 * l_discount > 40 THEN 1 ELSE 0 END AS Y")
    return cm.compare_classifiers(df, stratify=False).best


@query("compare_regressors")
def _(spark, sf_dir):
    df = _measures(spark, sf_dir, "l_quantity + 10 * l_tax AS Ylabel_a", "l_discount * 50 - l_quantity AS Ylabel_b")
    return cm.compare_regressors(df).table


EMBEDDED = [f"x{i}" for i in range(64)]


def _embedded(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(EMBEDDED)],
        (F.col("label") + 1.0).alias("level"), (F.col("embedding")[0] * 3 + 10).cast("double").alias("weight"),
    )


@query("pick_regressor")
def _(spark, sf_dir):
    rows, _scaler = tu.modelling_rows(_embedded(spark, sf_dir), EMBEDDED, ["level", "weight"])
    _name, _best, scores = tu.pick_regressor(rows, ["level", "weight"])
    return spark.createDataFrame([(n, float(v)) for n, v in scores.items()], "model string, mape double")


@query("tune_regressor")
def _(spark, sf_dir):
    """Each family: its error as it is and after the search."""
    rows, _scaler = tu.modelling_rows(_embedded(spark, sf_dir), EMBEDDED, ["weight"])
    data, search = tu.prepare(rows, ["weight"]), tu.prepare(rows, ["weight"], tu.TUNE_FOLDS, 1)
    _name, _best, untuned = tu.pick_regressor(rows, ["weight"], prepared=data)
    found = []
    for name, error in untuned.items():
        params, mape = tu.tune_regressor(rows, name, error, ["weight"], base=tu.DEFAULTS[name], prepared=data, tune_prepared=search)
        found.append((name, {k: float(v) for k, v in params.items()}, error, mape))
    return spark.createDataFrame(found, "model string, params map<string,double>, untuned_mape double, mape double")


@query("generate_model")
def _(spark, sf_dir):
    df = _embedded(spark, sf_dir)
    made = tu.generate_model(df, EMBEDDED, ["level", "weight"])
    predicted = made.predict(df)
    return predicted.select("level", "weight", "prediction_level", "prediction_weight")


# ---- recommendations: one target per part

CONTROLS = ["l_quantity"]
INPUTS = ["l_quantity", "l_discount", "p_retailprice"]
LIMITS = [[1.0, 0.0, 900.0], [50.0, 0.1, 1100.0]]


def _price_model(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    rows = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_partkey", *INPUTS, (F.col("l_extendedprice") + F.col("l_quantity") * F.col("p_retailprice")).alias("price")
    )
    scaler = va.fit_scaler(rows, INPUTS)
    vectors = im.assemble(rows, INPUTS, scaler=scaler).select("features", "price")
    goals = rows.groupBy(F.col("l_partkey").alias("target_id")).agg(F.avg("price").alias("price"))
    return tu.fit("Lasso Regression", {"alpha": 0.1}, vectors, ["price"]), scaler, rows, goals


@query("recommend_values")
def _(spark, sf_dir):
    model, scaler, rows, goals = _price_model(spark, sf_dir)
    return rc.recommend_values(model, scaler, INPUTS, CONTROLS, LIMITS, goals, ["price"], rows, all_parameters=True)


@query("recommend_ranges")
def _(spark, sf_dir):
    model, scaler, rows, goals = _price_model(spark, sf_dir)
    return rc.recommend_ranges(model, scaler, INPUTS, CONTROLS, LIMITS, goals, ["price"], rows)


@query(
    "interval_of_restarts",
    f"SELECT target_id, feature, {r6(f'least(m + {rc.INTERVAL!r} * s, hi)')} AS \"Upper_bound\", {r6(f'greatest(m - {rc.INTERVAL!r} * s, lo)')} AS \"Lower_bound\", best_cost FROM "
    "(SELECT l_partkey AS target_id, 'quantity' AS feature, avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, 5 AS lo, 45 AS hi, min(l_tax) AS best_cost FROM lineitem GROUP BY l_partkey UNION ALL "
    "SELECT l_partkey, 'discount', avg(l_discount), stddev_pop(l_discount), 0.01, 0.08, min(l_tax) FROM lineitem GROUP BY l_partkey)",
)
def _(spark, sf_dir):
    cells = F.array(
        F.struct(F.lit("quantity").alias("feature"), F.col("l_quantity").alias("value")),
        F.struct(F.lit("discount").alias("feature"), F.col("l_discount").alias("value")),
    )
    restarts = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("target_id"), F.col("l_tax").alias("cost"), F.explode(cells).alias("cell")
    ).select("target_id", "cost", "cell.*")
    return rounded(rc.ranges(restarts, ["quantity", "discount"], [[5, 0.01], [45, 0.08]]))
