"""Queries that train models. Their numbers vary with the engine, so SQL checks what must hold of them.

The trees here are smaller than the library's defaults, which take minutes on
one machine; the data is the whole feature table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from zoneflow.ml import forecast, models
from zoneflow.ml.boosting import fit_boosted_l2
from zoneflow.operators.grid import FEATURES, TARGET
from zoneflow.plans import frames
from zoneflow.plans.frames import FEATURES_SQL
from zoneflow.plans.registry import query, sql
from zoneflow.session import write_table

SMALL_FOREST = {"numTrees": 20, "maxDepth": 8}
SMALL_BOOSTED = {"maxIter": 10, "maxDepth": 5, "stepSize": 0.3}


def _split(spark, d):
    """Training passes over its input many times: the features are stored first."""
    return forecast.split(write_table(frames.features(spark, d), "features"))


def _held_out(model, held, prediction=None):
    """Held-out rows, and whether the model errs less than the mean of the held-out rows would."""
    scored = model.transform(models.complete(held))
    error = F.col(TARGET) - F.col(prediction or model.stages[-1].getPredictionCol())
    return scored.agg(
        F.count("*").alias("n"), (F.sum(error * error) < F.var_pop(TARGET) * F.count("*")).alias("beats_mean"))


_SPLIT_SQL = """
marked as (
  select *, ('0x' || substr(md5(zone_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')), 1, 8))::bigint % 5 = 0 held from features)
"""
_HELD_OUT_SQL = sql("select count(*) n, true beats_mean from marked where held", FEATURES_SQL, _SPLIT_SQL)


@query("ml3_forest", _HELD_OUT_SQL)
def _(spark, d):
    train, held = _split(spark, d)
    return _held_out(models.fit_forest(train, **SMALL_FOREST), held)


@query("ml4_boosted", _HELD_OUT_SQL)
def _(spark, d):
    train, held = _split(spark, d)
    return _held_out(models.fit_boosted(train, **SMALL_BOOSTED), held)


@query("ml4_boosted_l2", _HELD_OUT_SQL)
def _(spark, d):
    """Second-order boosting with an L2 term, columns drawn per tree."""
    train, held = _split(spark, d)
    model = fit_boosted_l2(train, FEATURES, TARGET, rounds=SMALL_BOOSTED["maxIter"], depth=SMALL_BOOSTED["maxDepth"],
                           step=SMALL_BOOSTED["stepSize"])
    return _held_out(model, held, "xgboost_prediction")


# Features with few values, whose bounds are all of them.
_DOMAINS = {"hour": 24, "day_of_week": 7, "current_occupancy": 6, "capacity": 6}


@query("ml4_first_split", sql("""
    select feature, x as bound, round(gain, 3) gain, round(-lg / (ln + 1), 6) left_value, round(-(ag - lg) / (an - ln + 1), 6) right_value
    from (select *, (lg * lg / (ln + 1) + (ag - lg) * (ag - lg) / (an - ln + 1) - ag * ag / (an + 1)) / 2 gain from sides)
    where ln < an order by gain desc, place, x limit 1""", FEATURES_SQL, _SPLIT_SQL, f"""
long as (
  select unnest(range({len(_DOMAINS)})) place, unnest([{", ".join(f"'{c}'" for c in _DOMAINS)}]) feature,
         unnest([{", ".join(f'"{c}"::double' for c in _DOMAINS)}]) x, avg(future_occupancy) over () - future_occupancy g
  from marked where not held),
cells as (select place, feature, x, sum(g) g, count(*) n from long group by all),
sides as (
  select *, sum(g) over w lg, sum(n) over w ln, sum(g) over (partition by place) ag, sum(n) over (partition by place) an
  from cells window w as (partition by place order by x))
"""))
def _(spark, d):
    """The best split of all rows by gain with L2 term 1, and the values of its two leaves."""
    train, _held = _split(spark, d)
    model = fit_boosted_l2(train, list(_DOMAINS), TARGET, rounds=1, depth=1, step=1.0, row_share=1.0, column_share=1.0,
                           edges=[list(range(n)) for n in _DOMAINS.values()])
    rows = [(model.features[t.feature[0]], float(model.edges[t.feature[0]][t.cut[0]]), *map(float, (t.gain[0], *t.value[1:])))
            for t in model.trees if t.feature[0] >= 0]
    found = spark.createDataFrame(rows, "feature string, bound double, gain double, left_value double, right_value double")
    return found.select("feature", "bound", F.round("gain", 3).alias("gain"), F.round("left_value", 6).alias("left_value"),
                        F.round("right_value", 6).alias("right_value"))


@query("ml5_linear", "select unnest([" + ", ".join(f"'{c}'" for c in FEATURES) + "]) feature, 0.0::double gradient")
def _(spark, d):
    """Least squares leave no feature correlated with the residual: X'r / n is zero to six places."""
    train, _held = _split(spark, d)
    scored = models.fit_linear(train).transform(models.complete(train))
    residual = F.col(TARGET) - F.col("linear_prediction")
    sums = scored.agg(*[(F.round(F.avg(F.col(c) * residual), 6) + 0.0).alias(c) for c in FEATURES])
    return sums.unpivot([], list(FEATURES), "feature", "gradient")


@query("ml6_trained_importance", "select unnest(['linear', 'random_forest']) model, "
       f"{len(FEATURES)}::bigint features, 1.0::double total, true non_negative")
def _(spark, d):
    """Weights of a model cover all features, sum to one and are never negative."""
    train, _held = _split(spark, d)
    forest = models.importance(models.fit_forest(train, **SMALL_FOREST), train, "random_forest")
    both = forest.unionByName(models.importance(models.fit_linear(train), train, "linear"))
    return both.groupBy("model").agg(
        F.count_distinct("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        (F.min("importance") >= 0).alias("non_negative"))


@query("ml8_score_recent_models", sql("""
    select "timestamp", zone_id, round(future_occupancy, 9) actual_occupancy, held::int is_validation, true in_bounds
    from marked where "timestamp" >= (select max("timestamp") - interval 7 day from features)""", FEATURES_SQL, _SPLIT_SQL))
def _(spark, d):
    """Keys, target and split of the recent rows; every model's prediction lies between zero and the capacity."""
    features = write_table(frames.features(spark, d), "features")
    train, _held = forecast.split(features)
    fitted = {
        "random_forest": models.fit_forest(train, **SMALL_FOREST),
        "xgboost": models.fit_boosted(train, **SMALL_BOOSTED),
        "linear": models.fit_linear(train),
    }
    scored = models.score_recent(fitted, features)
    columns = ["predicted_occupancy", *[m.stages[-1].getPredictionCol() for m in fitted.values()]]
    inside = reduce(lambda a, b: a & b, [F.col(c).between(0, F.col("capacity")) for c in columns])
    return scored.select(
        "timestamp", "zone_id", F.round("actual_occupancy", 9).alias("actual_occupancy"), "is_validation", inside.alias("in_bounds"))
