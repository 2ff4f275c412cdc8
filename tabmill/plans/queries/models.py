"""Models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import evaluate, knn, knn_hashed
from ...operators.clean import typed
from ...operators.models import Candidate, fit_one, train_grid
from ...operators.split import hash_stage, split
from ...operators.transform import apply_steps, fit, invert_target, transformed_features
from ...schema import COMMODITY_FLOW as SCHEMA
from ...sources.tables import stored_splits
from ..derived import shipments, table
from . import sql

ID, VALUE, WEIGHT = "SHIPMENT_ID", "SHIPMENT_VALUE", "SHIPMENT_WEIGHT"
ROUTE = "SHIPMENT_DISTANCE_ROUTE"


def rows_for(spark, sf_dir, *columns):
    """Split shipments with these columns, written once as every model reads them several times."""
    return stored_splits(split(typed(shipments(spark, sf_dir, ID, VALUE, *columns), SCHEMA), SCHEMA))


def _train(df):
    return df.where(F.col("stage") == "train")


def _fit(df, features, kind, **hyperparameters):
    return fit_one(Candidate("m", kind, hyperparameters), _train(df), features, VALUE, ID)


def _errors(df, model, digits=3):
    out = evaluate.metrics_by_stage(model.transform(df), VALUE, {model.candidate.model_type: model.prediction}, ("rmse", "mae"))
    return out.withColumn("value", F.round("value", digits))


def m_mean_baseline_metrics(spark, sf_dir):
    rows = rows_for(spark, sf_dir)
    scored = rows.withColumn("prediction", F.lit(evaluate.mean_baseline(rows, VALUE)))
    out = evaluate.metrics_by_stage(scored, VALUE, {"mean": "prediction"})
    return out.withColumn("value", F.round("value", F.lit(2)))


def _linear_report(spark, model, **hp):
    inner = model.model
    return spark.createDataFrame(
        [(float(inner.coefficients[0]), float(inner.intercept))], "slope double, intercept double"
    ).select(F.round("slope", 6).alias("slope"), F.round("intercept", 3).alias("intercept"))


def m_linear_one_feature(spark, sf_dir):
    rows = rows_for(spark, sf_dir, WEIGHT)
    return _errors(rows, _fit(rows, [WEIGHT], "linear_regression"))


def m_linear_coefficients(spark, sf_dir):
    rows = rows_for(spark, sf_dir, WEIGHT)
    return _linear_report(spark, _fit(rows, [WEIGHT], "linear_regression"))


def m_elastic_net(spark, sf_dir):
    rows = rows_for(spark, sf_dir, WEIGHT)
    return _linear_report(spark, _fit(rows, [WEIGHT], "elastic_net", alpha=2_000.0, l1_ratio=0.3))


def m_lasso(spark, sf_dir):
    rows = rows_for(spark, sf_dir, WEIGHT)
    return _linear_report(spark, _fit(rows, [WEIGHT], "lasso", alpha=500.0))


def _tree_rows(spark, sf_dir):
    rows = rows_for(spark, sf_dir, WEIGHT, "NAICS", "HAZMAT", "WEIGHT_FACTOR")
    steps = fit(rows, [{"type": "one_hot_encoding", "columns": ["naics", "hazmat"]}], SCHEMA)
    return apply_steps(rows, steps), transformed_features(SCHEMA, rows.columns, steps)


def m_tree(spark, sf_dir):
    rows, features = _tree_rows(spark, sf_dir)
    return _errors(rows, _fit(rows, features, "decision_tree_regressor", max_depth=5, min_samples_leaf=2, random_state=42))


def m_forest(spark, sf_dir):
    rows, features = _tree_rows(spark, sf_dir)
    return _errors(rows, _fit(rows, features, "random_forest_regressor", n_estimators=10, max_depth=5, random_state=42))


def m_gbt(spark, sf_dir):
    rows, features = _tree_rows(spark, sf_dir)
    return _errors(rows, _fit(rows, features, "gradient_boosting_regressor", n_estimators=5, learning_rate=0.1, max_depth=3, random_state=42))


def _quarter_means(spark, sf_dir, kind, **hyperparameters):
    """Trees deep enough to tell the four quarters apart predict the train mean of each."""
    rows = rows_for(spark, sf_dir, "QUARTER")
    steps = fit(rows, [{"type": "one_hot_encoding", "columns": ["quarter"]}], SCHEMA)
    prepared = apply_steps(rows, steps)
    model = _fit(prepared, transformed_features(SCHEMA, rows.columns, steps), kind, random_state=42, **hyperparameters)
    return model.transform(prepared).select(ID, F.round(model.prediction, 3).alias("prediction"))


def m_tree_quarters(spark, sf_dir):
    return _quarter_means(spark, sf_dir, "decision_tree_regressor", max_depth=4)


def m_tree_min_split(spark, sf_dir):
    """One quarter apart from the rest: only the root has the nine tenths of the train rows that a split takes."""
    n = _train(rows_for(spark, sf_dir)).count()
    return _quarter_means(spark, sf_dir, "decision_tree_regressor", max_depth=4, min_samples_split=n * 9 // 10)


def m_forest_quarters(spark, sf_dir):
    """Without resampling every tree of the forest is the same."""
    return _quarter_means(spark, sf_dir, "random_forest_regressor", n_estimators=3, max_depth=4, bootstrap=False)


def m_gbt_quarters(spark, sf_dir):
    """Every round moves the prediction a tenth of the way from the mean of all to the mean of the quarter."""
    return _quarter_means(spark, sf_dir, "gradient_boosting_regressor", n_estimators=3, learning_rate=0.1, max_depth=4)


def m_knn_uniform(spark, sf_dir):
    """Five nearest by weight, as in the baseline job; held-out rows are predicted."""
    rows = rows_for(spark, sf_dir, WEIGHT)
    index = knn.build_index(_train(rows), [WEIGHT], VALUE, ID, k=5)
    out = index.predict(rows.where(F.col("stage") != "train"), {"prediction": (5, "uniform")})
    return out.select(ID, WEIGHT, F.round("prediction", 4).alias("prediction"))


def _parts(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return part.withColumn("stage", hash_stage(F.col("p_partkey")))


_SIZE, _PRICE = "p_size", "p_retailprice"


def _part_neighbours(spark, sf_dir, weights, p):
    """Two-dimensional search over all parts: the key is the learned value."""
    rows = _parts(spark, sf_dir).withColumn("learned", F.col("p_partkey").cast("double"))
    train = rows.where(F.col("stage") == "train")
    index = knn.build_index(train, ["p_size", "p_retailprice"], "learned", "p_partkey", k=7, p=p, leaf_rows=256)
    out = index.predict(rows.where(F.col("stage") != "train"), {"prediction": (7, weights)})
    return out.select("p_partkey", F.round("prediction", 4).alias("prediction"))


def m_knn_distance(spark, sf_dir):
    return _part_neighbours(spark, sf_dir, "distance", 2)


def m_knn_manhattan(spark, sf_dir):
    return _part_neighbours(spark, sf_dir, "uniform", 1)


def m_knn_hashed(spark, sf_dir):
    """Approximate search over all parts next to the exact one: how many neighbours, and whether enough of them are true."""
    rows = _parts(spark, sf_dir).withColumn("learned", F.col("p_partkey").cast("double"))
    train, asked = (rows.where(F.col("stage") == s) for s in ("train", "valid"))
    shared = ([_SIZE, _PRICE], "learned", "p_partkey", 7)
    found = knn_hashed.build_hashed_index(train, *shared).neighbours(asked)
    true = knn.build_index(train, *shared, leaf_rows=256).neighbours(asked)
    hits = true.join(found.select("q", "key", F.lit(1).alias("hit")), ["q", "key"], "left")
    return hits.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits")).agg(
        F.count(F.lit(1)).alias("queries"), F.sum("n").alias("neighbours"), (F.sum("hits") >= 0.9 * F.sum("n")).alias("enough_found")
    )


def m_grid_best(spark, sf_dir):
    """Linear, tree and neighbour candidates of a small grid; every metric, and which one wins."""
    rows = rows_for(spark, sf_dir, WEIGHT)
    calls = [
        {"model_type": "linear_regression", "hyperparameters": {}},
        {"model_type": "decision_tree_regressor", "hyperparameters": {"max_depth": [2, 4], "random_state": [42]}},
        {
            "model_type": "k_nearest_neighbors_regressor",
            "hyperparameters": {"n_neighbors": [3, 5], "weights": ["uniform", "distance"], "algorithm": ["auto"], "p": [2]},
        },
    ]
    result = train_grid(rows, [WEIGHT], VALUE, ID, calls, ("mae", "rmse"), "rmse")
    best = result.best.candidate.model_id
    return result.metrics.select("model_id", "stage", "metric", F.round("value", 3).alias("value"), (F.col("model_id") == best).alias("is_best"))


def m_linear_grid(spark, sf_dir):
    """Five linear candidates from the same statistics: their metrics, and which one wins."""
    rows = rows_for(spark, sf_dir, WEIGHT)
    calls = [
        {"model_type": "linear_regression"},
        {"model_type": "lasso", "hyperparameters": {"alpha": [500.0, 50_000.0]}},
        {"model_type": "elastic_net", "hyperparameters": {"alpha": [2_000.0], "l1_ratio": [0.3, 0.7]}},
    ]
    result = train_grid(rows, [WEIGHT], VALUE, ID, calls, ("mae", "rmse"), "rmse")
    best = result.best.candidate.model_id
    return result.metrics.select("model_id", "stage", "metric", F.round("value", 3).alias("value"), (F.col("model_id") == best).alias("is_best"))


def log_model(spark, sf_dir):
    """Weight and value on logarithms, one-feature least squares: (rows, steps, model)."""
    rows = rows_for(spark, sf_dir, WEIGHT)
    steps = fit(rows, [{"type": "log_transformation", "columns": ["shipment_weight", "shipment_value"], "condition": "replace"}], SCHEMA)
    prepared = apply_steps(rows, steps)
    return rows, steps, _fit(prepared, [WEIGHT], "linear_regression")


def m_metrics_original_scale(spark, sf_dir):
    rows, steps, model = log_model(spark, sf_dir)
    kept = rows.withColumn("raw_value", F.col(VALUE))
    scored = model.transform(apply_steps(kept, steps))
    scored = scored.withColumn("restored", invert_target(F.col(model.prediction), steps))
    out = evaluate.metrics_by_stage(scored, "raw_value", {"log_line": "restored"}, ("rmse", "mae"))
    return out.withColumn("value", F.round("value", 3))


def m_best_model(spark, sf_dir):
    """Mean and line compared on the valid rows."""
    rows = rows_for(spark, sf_dir, WEIGHT)
    model = _fit(rows, [WEIGHT], "linear_regression")
    scored = model.transform(rows).withColumn("mean", F.lit(evaluate.mean_baseline(rows, VALUE)))
    metrics = evaluate.metrics_by_stage(scored, VALUE, {"mean": "mean", "line": model.prediction})
    return evaluate.best_model(metrics, "mae").select("model_id", F.round("value", 3).alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        m_mean_baseline_metrics, m_linear_one_feature, m_linear_coefficients, m_elastic_net, m_lasso, m_tree, m_forest,
        m_gbt, m_tree_quarters, m_tree_min_split, m_forest_quarters, m_gbt_quarters, m_knn_uniform, m_knn_distance, m_knn_manhattan, m_knn_hashed, m_grid_best, m_linear_grid, m_metrics_original_scale, m_best_model,
    )
}


def _stage_errors(model_id, predicted, source="staged, line", label="SHIPMENT_VALUE"):
    return f"""select '{model_id}' as model_id, stage, 'rmse' as metric, round(sqrt(avg(({label} - {predicted}) * ({label} - {predicted}))), 3) as value
        from {source} group by stage
        union all select '{model_id}', stage, 'mae', round(avg(abs({label} - {predicted})), 3) from {source} group by stage"""


def _penalised(l1, l2):
    """Closed form with one feature: soft-thresholded covariance over variance plus ridge."""
    return f"""with {sql.STAGED}, s as (select covar_pop(SHIPMENT_VALUE, SHIPMENT_WEIGHT) as c, var_pop(SHIPMENT_WEIGHT) as v,
          avg(SHIPMENT_WEIGHT) as mx, avg(SHIPMENT_VALUE) as my from staged where stage = 'train'),
        w as (select sign(c) * greatest(abs(c) - {l1}, 0) / (v + {l2}) as b, mx, my from s)
        select round(b, 6) as slope, round(my - b * mx, 3) as intercept from w"""


def _knn_parts(k, distance, answer):
    return f"""with keyed as (select p_partkey, p_size, p_retailprice,
          ('0x' || substr(md5(concat(p_partkey, '-42')), 1, 8))::bigint % 10 as b from part),
        pairs as (select q.p_partkey as q, t.p_partkey as t, {distance} as d from keyed q, keyed t where q.b >= 8 and t.b < 8),
        near as (select *, row_number() over (partition by q order by d, t) as r from pairs qualify r <= {k})
        select q as p_partkey, round({answer}, 4) as prediction from near group by q"""


_QUARTER_MEANS = f"""with {sql.STAGED}, m as (select QUARTER as q, avg(SHIPMENT_VALUE) as p from staged where stage = 'train' group by 1)
        select SHIPMENT_ID, round(p, 3) as prediction from staged join m on q = QUARTER"""

ORACLE = {
    "m_tree_min_split": f"""with {sql.STAGED}, q as (select QUARTER as q, count(*) as n, sum(SHIPMENT_VALUE) as total
          from staged where stage = 'train' group by 1), whole as (select sum(n) as all_n, sum(total) as all_total from q),
        g as (select q, n, total / n as own, (all_total - total) / (all_n - n) as rest, all_n from q, whole),
        best as (select * from g order by n * (all_n - n) * (own - rest) * (own - rest) desc limit 1)
        select SHIPMENT_ID, round(case when QUARTER = q then own else rest end, 3) as prediction from staged, best""",
    "m_tree_quarters": _QUARTER_MEANS,
    "m_forest_quarters": _QUARTER_MEANS,
    "m_gbt_quarters": f"""with {sql.STAGED}, m as (select QUARTER as q, avg(SHIPMENT_VALUE) as p from staged where stage = 'train' group by 1),
        a as (select avg(SHIPMENT_VALUE) as p from staged where stage = 'train')
        select SHIPMENT_ID, round(a.p + (1 - power(1 - 0.1, 3)) * (m.p - a.p), 3) as prediction from staged join m on q = QUARTER, a""",
    "m_mean_baseline_metrics": f"""with {sql.STAGED}, m as (select avg(SHIPMENT_VALUE) as p from staged where stage = 'train'),
        e as (select stage, avg((SHIPMENT_VALUE - p) * (SHIPMENT_VALUE - p)) as mse, avg(abs(SHIPMENT_VALUE - p)) as mae from staged, m group by stage)
        select 'mean' as model_id, stage, 'mse' as metric, round(mse, 2) as value from e
        union all select 'mean', stage, 'rmse', round(sqrt(mse), 2) from e union all select 'mean', stage, 'mae', round(mae, 2) from e""",
    "m_linear_one_feature": f"with {sql.STAGED}, {sql.LINE} " + _stage_errors("linear_regression", "(a + b * SHIPMENT_WEIGHT)"),
    "m_linear_coefficients": f"with {sql.STAGED}, {sql.LINE} select round(b, 6) as slope, round(a, 3) as intercept from line",
    "m_elastic_net": _penalised(2000 * 0.3, 2000 * 0.7),
    "m_lasso": _penalised(500, 0),
    "m_knn_uniform": f"""with {sql.STAGED},
        learned as (select SHIPMENT_WEIGHT as x, SHIPMENT_VALUE as y, SHIPMENT_ID as id,
          row_number() over (partition by SHIPMENT_WEIGHT order by SHIPMENT_ID) as copy from staged where stage = 'train' qualify copy <= 5),
        asked as (select distinct SHIPMENT_WEIGHT as q from staged where stage <> 'train'),
        near as (select q, y, row_number() over (partition by q order by abs(q - x), id) as place from asked, learned qualify place <= 5),
        answers as (select q, avg(y) as prediction from near group by q)
        select SHIPMENT_ID, SHIPMENT_WEIGHT, round(prediction, 4) as prediction
        from staged join answers on q = SHIPMENT_WEIGHT where stage <> 'train'""",
    "m_knn_distance": _knn_parts(
        7,
        "sqrt((q.p_size - t.p_size) * (q.p_size - t.p_size) + (q.p_retailprice - t.p_retailprice) * (q.p_retailprice - t.p_retailprice))",
        "case when min(d) = 0 then avg(case when d = 0 then cast(t as double) end) else sum(t / nullif(d, 0)) / sum(1 / nullif(d, 0)) end",
    ),
    "m_linear_grid": f"""with {sql.STAGED}, s as (select covar_pop(SHIPMENT_VALUE, SHIPMENT_WEIGHT) as c, var_pop(SHIPMENT_WEIGHT) as v,
          avg(SHIPMENT_WEIGHT) as mx, avg(SHIPMENT_VALUE) as my from staged where stage = 'train'),
        hp(model_id, l1, l2) as (values ('m000-linear_regression', 0, 0), ('m001-lasso', 500, 0), ('m002-lasso', 50000, 0),
          ('m003-elastic_net', 600, 1400), ('m004-elastic_net', 1400, 600)),
        w as (select model_id, sign(c) * greatest(abs(c) - l1, 0) / (v + l2) as b, mx, my from s, hp),
        d as (select model_id, stage, SHIPMENT_VALUE - my - b * (SHIPMENT_WEIGHT - mx) as d from staged, w),
        e as (select model_id, stage, sqrt(avg(d * d)) as rmse, avg(abs(d)) as mae from d group by all),
        best as (select model_id as won from e where stage = 'valid' order by rmse, model_id limit 1),
        m as (select model_id, stage, 'rmse' as metric, rmse as value from e union all select model_id, stage, 'mae', mae from e)
        select model_id, stage, metric, round(value, 3) as value, model_id = won as is_best from m, best where stage <> 'test' or model_id = won""",
    "m_knn_hashed": """select count(*) as queries, cast(7 * count(*) as bigint) as neighbours, true as enough_found
        from (select distinct p_size, p_retailprice from part where ('0x' || substr(md5(concat(p_partkey, '-42')), 1, 8))::bigint % 10 = 8)""",
    "m_knn_manhattan": _knn_parts(7, "abs(q.p_size - t.p_size) + abs(q.p_retailprice - t.p_retailprice)", "avg(cast(t as double))"),
    "m_metrics_original_scale": f"with {sql.STAGED}, {sql.LOG_LINE} " + _stage_errors("log_line", "exp(a + b * ln(SHIPMENT_WEIGHT))"),
    "m_best_model": f"""with {sql.STAGED}, {sql.LINE}, m as (select avg(SHIPMENT_VALUE) as p from staged where stage = 'train'),
        e as (select 'mean' as model_id, avg(abs(SHIPMENT_VALUE - p)) as v from staged, m where stage = 'valid'
          union all select 'line', avg(abs(SHIPMENT_VALUE - (a + b * SHIPMENT_WEIGHT))) from staged, line where stage = 'valid')
        select model_id, round(v, 3) as value from e order by v, model_id limit 1""",
}
