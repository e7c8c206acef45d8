import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import prepare as P
from tidewatch.operators import sequence as Q
from tidewatch.operators.ordered import whole_groups
from tidewatch.operators.quantiles import _bin_of, exact_quantiles

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """One series holds most rows; chunks of a minute cut it into many pieces."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        key = "hot" if i % 4 else f"k{i % 5}"
        rows.append((i, key, T0 + dt.timedelta(seconds=rng.randrange(20000), microseconds=i), rng.choice([None, 1.0, 2.5, 4.0, 9.0])))
    pdf = pd.DataFrame(rows, columns=["id", "k", "timestamp", "value"]).sort_values(["k", "timestamp"])
    return spark.createDataFrame(rows, "id int, k string, timestamp timestamp, value double"), pdf


def by_id(df, column):
    return {r["id"]: r[column] for r in df.select("id", column).collect()}


def expect(pdf, series):
    return {i: (None if pd.isna(v) else v) for i, v in zip(pdf["id"], series)}


def test_previous_across_chunks(hot):
    df, pdf = hot
    got = by_id(Q.with_previous(df, ["k"], {"before": "id"}, chunk="1m"), "before")
    assert got == expect(pdf, pdf.groupby("k")["id"].shift(1))


def test_last_and_next_known_across_chunks(hot):
    df, pdf = hot
    got = by_id(Q.with_last_known(df, ["k"], {"known": "value"}, chunk="1m"), "known")
    assert got == expect(pdf, pdf.groupby("k")["value"].ffill())
    got = by_id(Q.with_last_known(df, ["k"], {"known": "value"}, chunk="1m", ahead=True), "known")
    assert got == expect(pdf, pdf.groupby("k")["value"].bfill())


def test_running_total_across_chunks(hot):
    df, pdf = hot
    got = by_id(Q.running_total(df.na.fill(0.0), ["k"], {"total": "value"}, chunk="1m"), "total")
    want = expect(pdf, pdf.assign(value=pdf["value"].fillna(0.0)).groupby("k")["value"].cumsum())
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_sessions_do_not_depend_on_the_chunk(hot):
    df, _ = hot
    runs = lambda c: sorted(map(tuple, Q.sessions(df, ["k"], "40s", {"n": F.lit(1)}, chunk=c).collect()))
    assert runs("1m") == runs("1d") and sum(r[-1] for r in runs("1m")) == 1500


def test_suggested_chunk_bounds_the_rows(hot):
    df, _ = hot
    assert Q.suggest_chunk(df, ["k"], rows_per_task=10**6) == "1d"
    assert Q.suggest_chunk(df, ["k"], rows_per_task=300) == "1h"


@pytest.mark.parametrize("fits", [10**6, 50, 3])
def test_quantiles_of_large_groups(spark, fits):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(size=900), np.full(600, 2.0)])
    df = spark.createDataFrame([("hot", float(v)) for v in values] + [("one", 5.0), ("two", 1.0), ("two", 2.0)], "k string, v double")
    probs = {"p0": 0.0, "p01": 0.01, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    rows = exact_quantiles(df, ["k"], "v", probs, cuts=16, fits=fits).collect()
    got = {r["k"]: r.asDict() for r in rows}
    for name, p in probs.items():
        assert got["hot"][name] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)
        assert got["one"][name] == 5.0
    assert got["two"]["p50"] == 1.5 and got["hot"]["n"] == 1500


def test_exclusive_quantiles(spark):
    import statistics

    data = [float(x * x % 101) for x in range(250)]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    want = statistics.quantiles(data, n=100)
    for fits in (5, 1000):
        row = exact_quantiles(df, [], "v", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, method="exclusive", fits=fits, cuts=8).first()
        assert [row["p50"], row["p95"], row["p99"]] == pytest.approx([want[49], want[94], want[98]])


def test_interpolation_edges(spark):
    rows = [(0, None), (10, 1.0), (20, None), (40, 4.0), (50, None)]
    df = spark.createDataFrame([("m", T0 + dt.timedelta(seconds=s), v) for s, v in rows], "metric_name string, timestamp timestamp, value double")
    out = {(r["timestamp"] - T0).seconds: r["value"] for r in P.interpolate_time(df, chunk="1s").collect()}
    assert out == {10: 1.0, 20: 2.0, 40: 4.0, 50: 4.0}


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, b double")
    out = P.apply_scaler(df, ["a", "b"], P.fit_scaler(df, ["a", "b"])).collect()
    assert sorted(tuple(r) for r in out) == [(-1.0, 0.0), (1.0, 0.0)]


def test_correlation_over_rows_where_both_are_present(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4)) @ rng.normal(size=(4, 4)) + 1e6
    rows = [(*(None if rng.random() < 0.1 else float(v) for v in r), 7.0) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, still double").repartition(3)
    want = df.toPandas().corr()
    got = {(r["a"], r["b"]): r["corr"] for r in P.corr_matrix(df, ["a", "b", "c", "d", "still"]).collect()}
    assert len(got) == 12 and all(abs(want.loc[a, b] - v) < 1e-6 for (a, b), v in got.items())


def test_auc_with_ties(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.randint(0, 20) / 20) for _ in range(300)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = P.auc(spark.createDataFrame(rows, "label int, score double")).first()["auc"]
    assert got == pytest.approx(want)


def test_recent_is_limited_on_both_sides(spark, hot):
    df, _ = hot
    plan = P.recent(df, 100, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_whole_groups_never_split():
    rng = random.Random(2)
    keys = sorted(rng.choices(range(12), k=200))
    pdf = pd.DataFrame({"g": keys, "v": range(200)})
    cuts = sorted(rng.sample(range(1, 200), 30))
    batches = [pdf.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, 200])]
    seen = []
    for part, offsets in whole_groups(iter(batches), ["g"]):
        for a, b in zip(offsets[:-1], offsets[1:]):
            assert part["g"].iloc[a:b].nunique() == 1
            seen.append((part["g"].iloc[a], part["v"].iloc[a:b].tolist()))
    assert [k for k, _ in seen] == sorted(set(keys)) and sum((v for _, v in seen), []) == list(range(200))


def test_next_known_value_by_running_frames(spark, hot):
    """Ahead equals a loop, and no frame reaches to the end of its partition: Spark works such a one out anew for every row."""
    df, pdf = hot
    out = Q.with_last_known(df, ["k"], {"next": "value"}, chunk="10m", ahead=True)
    want = pdf.groupby("k")["value"].bfill()
    got = by_id(out, "next")
    assert all(got[i] == v if v == v else got[i] is None for i, v in zip(pdf["id"], want, strict=True))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "currentrow$()" in plan and "unboundedfollowing$()" not in plan


def test_a_gap_between_samples_of_its_own_time(spark):
    rows = spark.createDataFrame([(T0, "m", 4.0), (T0, "m", None), (T0 + dt.timedelta(hours=1), "m", 8.0)], "timestamp timestamp, metric_name string, value double")
    assert sorted(r["value"] for r in P.interpolate_time(rows, chunk="1d").collect()) == [4.0, 4.0, 8.0]


def test_chunks_are_counted_without_copies_of_the_rows(spark, hot, monkeypatch):
    """A table that fits the widest chunk is counted by it alone, and narrower ones are found where it does not fit."""
    df, pdf = hot
    written = []
    real = Q.materialise
    monkeypatch.setattr(Q, "materialise", lambda d, name: written.append(name) or real(d, name))
    assert Q.suggest_chunk(df, ["k"]) == "1d" and not written
    assert Q.suggest_chunk(df.limit(0), ["k"]) == "1d"
    for most in (400, 100, 8, 1):
        for chunk in ("6h", "1h", "10m", "1m", "10s", "1s"):
            at = pdf["timestamp"].dt.floor(chunk.replace("m", "min"))
            if pdf.groupby(["k", at]).size().max() <= most or chunk == "1s":
                break
        assert Q.suggest_chunk(df, ["k"], rows_per_task=most) == chunk


@pytest.mark.parametrize("cuts", [2, 7, 16, 128])
def test_bins_are_found_by_halving(spark, cuts):
    """The same bin as by comparing with every bound, also where bounds are equal, in a few steps."""
    bounds = sorted(i // 2 * 1.0 for i in range(cuts - 1))
    df = spark.range(-2, cuts + 2).select((F.col("id") / 2).alias("v"), F.array(*[F.lit(b) for b in bounds]).alias("bounds"))
    found = df.select("v", _bin_of(F.col("bounds"), F.col("v"), cuts).alias("bin")).collect()
    assert [r["bin"] for r in found] == [sum(b < r["v"] for b in bounds) for r in found]


def test_few_groups_keep_all_tasks_busy(spark, monkeypatch):
    """Values of two groups are not dealt by group over two tasks; many groups are."""
    df = spark.range(2000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    plan = lambda: exact_quantiles(df, ["k"], "v", {"p": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr("tidewatch.operators.quantiles.FEW_GROUPS", 1)
    assert "strategy=broadcast" not in plan()
