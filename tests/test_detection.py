import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tidewatch.operators import anomaly as A
from tidewatch.operators import classify as K
from tidewatch.operators import forest as X
from tidewatch.operators import fraud
from tidewatch.operators import intrusion as N
from tidewatch.operators import prepare as P
from tidewatch.operators.density import density_noise

T0 = dt.datetime(2024, 1, 1)


def metric(spark, values, name="m"):
    return spark.createDataFrame([(T0 + dt.timedelta(hours=i), name, float(v)) for i, v in enumerate(values)], "timestamp timestamp, metric_name string, value double")


def test_threshold_needs_thirty_points(spark):
    new = metric(spark, [1000.0])
    assert A.dynamic_threshold(metric(spark, range(29)), new).first()["is_anomaly"] is False
    row = A.dynamic_threshold(metric(spark, range(30)), new).first()
    assert row["is_anomaly"] and row["anomaly_probability"] == 1.0


def test_threshold_on_a_constant_history(spark):
    history = metric(spark, [5.0] * 40)
    out = A.dynamic_threshold(history, metric(spark, [5.0, 5.5])).orderBy("value").collect()
    assert [(r["is_anomaly"], r["anomaly_probability"]) for r in out] == [(False, 0.0), (True, 1.0)]


def test_history_is_cut(spark):
    out = A.extend_history(metric(spark, range(40)), metric(spark, range(100, 110)).withColumn("timestamp", F.expr("timestamp + INTERVAL 100 HOURS")), keep=15)
    assert out.count() == 15 and out.agg(F.min("value")).first()[0] == 35.0


def test_forecast_covers_a_seasonal_series(spark):
    rng = np.random.default_rng(0)
    hours = np.arange(24 * 60)
    y = (100 + 0.02 * hours) * (1 + 0.3 * np.sin(2 * np.pi * hours / 24)) + rng.normal(0, 2, len(hours))
    series = metric(spark, y)
    params = A.fit_forecast(series)
    scored = A.forecast_anomaly(series, params)
    inside = scored.agg(F.avg((~F.col("is_anomaly")).cast("double"))).first()[0]
    assert 0.92 <= inside <= 0.98
    ahead = A.predict_forecast(params, A.future_grid(params, "1h", 24)).orderBy("timestamp").collect()
    truth = [(100 + 0.02 * h) * (1 + 0.3 * np.sin(2 * np.pi * h / 24)) for h in range(1440, 1464)]
    assert len(ahead) == 24 and np.mean([abs(r["yhat"] - t) for r, t in zip(ahead, truth)]) < 3


def test_severity_and_issue_rules(spark):
    s = lambda c, i, h: A.issue_severity(F.lit(c), F.lit(i), F.lit(h))
    row = spark.range(1).select(s(1.0, 0.81, 0.0), s(1.0, 0.8, 0.0), s(1.0, 1.0, 24.0), s(0.8, 0.5, 0.0)).first()
    assert tuple(row) == ("critical", "high", "medium", "low")
    d = spark.createDataFrame([(T0, -0.5), (T0 + dt.timedelta(hours=1), -0.4)], "timestamp timestamp, decision double")
    assert A.multivariate_issue(d).count() == 0
    low = A.multivariate_issue(d.withColumn("decision", F.col("decision") - 0.1)).first()
    assert (low["confidence"], low["severity"], low["timestamp"]) == (1.0, "critical", T0)


def test_scores_of_equal_decisions_are_zero(spark):
    d = spark.createDataFrame([(0.1,), (0.1,)], "decision double")
    assert {r["anomaly_score"] for r in A.normalise_score(d).collect()} == {0.0}


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, rng.normal(size=3))) for i in range(2000)] + [(5000 + i, 9.0 + i, -9.0, 9.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(4)
    nodes = X.fit_nodes(df, ["a", "b", "c"], "id", trees=40)
    shape = nodes.agg(F.count("*"), F.max("depth"), F.min("rows"), F.max("rows")).first()
    assert shape[0] == 40 and shape[1] <= 8 and shape[2] == shape[3] == 256
    model = X.fit(df, ["a", "b", "c"], "id", trees=40, contamination=0.01)
    scored = X.score(df, model)
    first = [r["id"] for r in scored.orderBy("decision").limit(5).collect()]
    assert sorted(first) == [5000, 5001, 5002, 5003, 5004]
    marked = scored.where("label = -1").count()
    assert 10 <= marked <= 30
    again = X.fit(df.repartition(7), ["a", "b", "c"], "id", trees=40, contamination=0.01)
    assert np.array_equal(model.threshold, again.threshold) and model.offset == pytest.approx(again.offset)


def test_endpoint_vector_outlier(spark):
    rows = [(i, v) for i, v in enumerate([0.1, 0.2, 0.3, 5.0, 0.2, 0.1])]
    df = spark.createDataFrame(rows, "id long, v double")
    scored = X.score(df, X.fit(df, ["v"], "id", trees=50, contamination=0.1))
    assert scored.orderBy("decision").first()["id"] == 3


def test_history_adjustments(spark):
    history = spark.createDataFrame([("u2", 2, 10.0), ("u3", 3, 10.0), ("u10", 10, 10.0), ("u11", 11, 10.0)], "user_id string, transaction_count long, max_amount double")
    rows = [("u2", 5.0), ("u3", 5.0), ("u10", 20.0), ("u10", 20.01), ("u11", 5.0), ("new", 5.0)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "user_id string, amount double, risk_score double")
    out = sorted((r["user_id"], r["amount"], round(r["risk_score"], 6), r["user_risk_level"], r["risk_factors"]) for r in fraud.adjust_risk(df, history).collect())
    assert out == sorted([
        ("u2", 5.0, 0.6, "medium", []), ("u3", 5.0, 0.5, "low", []), ("u10", 20.0, 0.5, "low", []),
        ("u10", 20.01, 0.65, "low", ["unusual_amount"]), ("u11", 5.0, 0.4, "low", []), ("new", 5.0, 0.75, "high", ["unknown_user"]),
    ])


def test_risk_levels_and_ensemble(spark):
    levels = [fraud.risk_level(F.lit(x)) for x in (0.6999, 0.7, 0.8999, 0.9)]
    assert tuple(spark.range(1).select(*levels).first()) == ("low", "medium", "medium", "high")
    none = F.lit(None).cast("double")
    pick = lambda a, b, c: fraud.ensemble_score({"random_forest": a, "boosting": b, "isolation_forest": c})
    row = spark.range(1).select(pick(F.lit(1.0), F.lit(0.5), F.lit(0.0)), pick(none, F.lit(0.5), none), pick(none, none, none)).first()
    assert [round(x, 9) for x in row] == [0.6, 0.5, 0.0]
    assert len(fraud.FEATURES) == 37 and len(fraud.FLAGS) == 11


def test_trailing_stats_of_a_busy_user(spark):
    rng = random.Random(9)
    rows = [(i, "u", T0 + dt.timedelta(hours=rng.randrange(5000)), float(rng.randrange(100))) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, user_id string, timestamp timestamp, amount double")
    got = {r["id"]: (r["purchase_count_30d"], r["max_purchase_value_30d"], r["std_purchase_value_30d"]) for r in fraud.trailing_user_stats(df).collect()}
    for i, _, t, _ in rows:
        before = [a for _, _, s, a in rows if dt.timedelta(0) < t - s <= dt.timedelta(days=30)]
        n, high, std = got[i]
        assert n == len(before) and high == (max(before) if before else None)
        assert std is None if n < 2 else std == pytest.approx(np.std(before, ddof=1), abs=1e-6)


def test_a_fit_uses_all_cores(spark):
    """Training rows from one small file are dealt over the cores."""
    df = spark.range(2000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("label")).coalesce(1)
    assert K._written(df, ["a"], "label").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_classifiers_learn_planted_rules(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(1500, 3))
    rows = [(float(a), float(b), float(c), int(a > 0.7 and b > 0.4)) for a, b, c in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    forest = K.fit_random_forest(df, ["a", "b", "c"], "label", trees=30)
    scored = K.positive_probability(forest, df)
    assert P.auc(scored, score="probability").first()["auc"] > 0.92
    ranked = [r["feature"] for r in K.feature_importance(spark, forest, ["a", "b", "c"]).orderBy("rank").collect()]
    assert ranked[-1] == "c"
    boosted = K.positive_probability(K.fit_boosting(df, ["a", "b", "c"], "label", rounds=5), df)
    assert P.auc(boosted, score="probability").first()["auc"] > 0.92


def in_bins(spark, n=6000):
    """Few bins, however many rows: 8 ages, 2 flags and an amount that no two rows share."""
    amount = (F.col("id") * 7919 % n).cast("double")
    df = spark.range(n).select(amount.alias("amount"), (F.col("id") % 8).cast("double").alias("age"), (F.col("id") % 3 == 0).cast("int").alias("flag"))
    return df.withColumn("label", ((F.col("flag") == 1) & (F.col("amount") >= n // 2) | (F.col("age") == 5)).cast("int"))


@pytest.mark.parametrize("fit", [lambda df, f: K.fit_random_forest(df, f, "label", trees=10), lambda df, f: K.fit_boosting(df, f, "label", rounds=3)])
def test_many_rows_are_fitted_by_their_bins(spark, monkeypatch, fit):
    """What a fit reads at every level does not grow with the rows once all bins are met; all rows are in the weights."""
    df, features, written = in_bins(spark), ["amount", "age", "flag"], {}
    real = K.materialise
    monkeypatch.setattr(K, "SINGLE_ROWS", 500)
    monkeypatch.setattr(K, "materialise", lambda rows, name: written.setdefault(name, real(rows, name)))
    model = fit(df, features)
    read = written["training-groups"]
    assert read.count() < 2000 and read.agg(F.sum("_weight")).first()[0] == 6000
    scored = K.positive_probability(model, df)
    assert scored.columns == [*df.columns, "probability"] and P.auc(scored, score="probability").first()["auc"] > 0.97
    assert len(model.stages[-1].featureImportances) == 3


def test_groups_are_boosted_like_their_rows(spark, monkeypatch):
    df = in_bins(spark).withColumn("amount", F.floor(F.col("amount") / 300))
    found = []
    for limit in (1 << 20, 500):
        monkeypatch.setattr(K, "SINGLE_ROWS", limit)
        scored = K.positive_probability(K.fit_boosting(df, ["amount", "age", "flag"], "label", rounds=4), df)
        found.append([r["probability"] for r in scored.groupBy("amount", "age", "flag").agg(F.first("probability").alias("probability")).orderBy("amount", "age", "flag").collect()])
    assert np.allclose(found[0], found[1], atol=1e-6)


def test_no_group_of_a_bootstrap_outweighs_its_part(spark):
    df = spark.range(1000).select(F.lit(1.0).alias("a"), F.when(F.col("id") < 3, 1).otherwise(0).alias("label"))
    parts = [r["_weight"] for r in K._grouped(df, ["a"], "label", 10).collect()]
    assert max(parts) <= 10 and len(parts) == 101 and abs(sum(parts) - 1000) < 1e-6


def test_groups_with_their_mean_give_the_tree_of_their_rows(spark):
    days = F.col("amount") * (1 + F.col("label")) + F.xxhash64("amount") % 2000
    df = in_bins(spark).select(F.floor(F.col("amount") / 300).cast("double").alias("amount"), "age", days.alias("days"))
    found = []
    for rows in (df.withColumn("_weight", F.lit(1.0)), K._mean_groups(df, ["amount", "age"], "days", 7)):
        tree = DecisionTreeRegressor(featuresCol="_features", labelCol="days", weightCol="_weight", maxDepth=6)
        model = K.Pipeline(stages=[K._assembler(["amount", "age"]), tree]).fit(rows)
        found.append([r["prediction"] for r in model.transform(df.select("amount", "age").distinct()).orderBy("amount", "age").collect()])
    assert len(set(found[0])) > 20 and np.allclose(found[0], found[1])


def test_a_value_of_many_rows_gets_its_own_bin():
    edges = K._edges([0.0, 0.0, 0.0, 1.0, 2.0, float("inf")])
    assert edges == sorted(set(edges)) and [np.searchsorted(edges, x, "right") for x in (-1.0, 0.0, 0.5, 1.5, 9.0)] == [1, 2, 3, 4, 5]


def test_noise_literal_frame(spark):
    rows = [(i, 0.0, 0.0) for i in range(5)] + [(5, 0.5, 0.0), (6, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    assert [r["id"] for r in density_noise(df, "id", ["x", "y"]).collect()] == [6]


@pytest.mark.parametrize("dims,seed", [(1, 1), (2, 2), (3, 3), (4, 4)])
def test_noise_equals_brute_force_with_a_hot_cell(spark, dims, seed):
    rng = np.random.default_rng(seed)
    spread = rng.uniform(-3, 3, size=(250, dims))
    hot = rng.normal(scale=0.03, size=(150, dims)) + 0.2
    points = np.round(np.concatenate([spread, hot]), 2)
    near = ((points[:, None, :] - points[None, :, :]) ** 2).sum(-1) <= 0.25
    core = near.sum(1) >= 5
    want = {i for i in range(len(points)) if not core[i] and not (near[i] & core).any()}
    names = [f"x{i}" for i in range(dims)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, " + ", ".join(f"{n} double" for n in names))
    assert {r["id"] for r in density_noise(df, "id", names, salt=3).collect()} == want


def test_signature_edge_cases(spark):
    df = spark.createDataFrame([(1, "/a/login", "POST", 4), (2, "/login", "POST", 5), (3, None, "POST", 9), (4, "/login", "GET", 9)], "id int, endpoint string, method string, failed_attempts int")
    hit = lambda s: sorted(r["id"] for r in N.match_signatures(df, s).collect())
    assert hit({"b": N.SIGNATURES["brute_force"]}) == [2]
    assert hit({"flat": {"method": "GET", "severity": "low"}}) == [4]
    assert hit({"x": {"pattern": {"method": ["GET", "PUT"]}}}) == [4]
    assert hit({"x": {"pattern": {"failed_attempts": {"min": 5, "max": 8}}}}) == [2]
    assert hit({"x": {"pattern": {"no_such_field": 60}}}) == []


@pytest.mark.parametrize("ticks", [N.CHUNK_TICKS, 7])
def test_leaky_bucket_walk(spark, ticks):
    rng = random.Random(3)
    seconds = sorted(rng.choices(range(400), k=1500))
    rows = [(i, "hot" if i % 5 else "cool", T0 + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    df = spark.createDataFrame(rows, "request_id int, ip_address string, timestamp timestamp")
    got = {(r["ip_address"], (r["window_start"] - T0).seconds): (r["refused"], r["level"]) for r in N.ip_rate_limit(df, rate=3, burst=5, chunk_ticks=ticks).collect()}
    for ip in ("hot", "cool"):
        level = 0.0
        for s in range(400):
            n = sum(1 for _, k, t in rows if k == ip and (t - T0).seconds == s)
            full = level + n - 3
            level = min(5.0, max(0.0, full))
            if n:
                assert got[(ip, s)] == (max(0.0, full - 5), level)
