"""Budget and duplicates together: only accepted alerts count."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import alerting as L
from tidewatch.operators.density import density_noise
from tidewatch.streaming import ordered as O

T0 = dt.datetime(2024, 1, 1)


def walk(rows, limit, slot, window):
    taken, held, out = {}, {}, []
    for i, key, s in sorted(rows, key=lambda r: (r[2], r[0])):
        if taken.get(s // slot, 0) < limit and s - held.get(key, -window) >= window:
            taken[s // slot] = taken.get(s // slot, 0) + 1
            held[key] = s
            out.append(i)
    return sorted(out)


def test_admit_equals_a_walk(spark):
    rows = [(i, f"k{(i * i) % 23 % 9}", (i * 37) % 2400) for i in range(600)]
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, k, s in rows], "id long, dedupe_key string, timestamp timestamp")
    got = sorted(r["id"] for r in L.admit(df.withColumn("q", F.lit(1)), "id", ["q"], limit=3).collect())
    assert got == walk(rows, 3, 60, 300) and got


def test_a_duplicate_uses_no_budget_and_a_limited_alert_is_not_remembered(spark):
    rows = [(i, "same", 1) for i in range(10)] + [(20, "new", 30), (21, "late", 31), (22, "late", 70)]
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, k, s in rows], "id long, dedupe_key string, timestamp timestamp")
    assert sorted(r["id"] for r in L.admit(df.withColumn("q", F.lit(1)), "id", ["q"], limit=2).collect()) == [0, 20, 22]


def test_queues_do_not_share_a_budget(spark):
    df = spark.createDataFrame([(i, f"k{i}", f"t{i % 2}", T0) for i in range(6)], "id long, dedupe_key string, tenant string, timestamp timestamp")
    assert sorted(r["id"] for r in L.admit(df, "id", ["tenant"], limit=1).collect()) == [0, 1]
    assert L.admit(df.limit(0), "id", ["tenant"]).count() == 0


@pytest.mark.parametrize("dims", [1, 3, 5])
def test_density_in_more_dimensions(spark, dims):
    import numpy as np

    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.normal(size=(60, dims)) * 0.1, rng.normal(size=(40, dims)) * 2])
    x[:, 0] *= 1e-3  # the first dimension hardly spreads
    names = [f"d{i}" for i in range(dims)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["id", *names])
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= 0.5
    core = near.sum(1) >= 5
    want = {i for i in range(100) if not core[i] and not (near[i] & core).any()}
    assert {r["id"] for r in density_noise(df, "id", names).collect()} == want


def test_waiting_rows_share_entries_of_the_state():
    rows = pd.DataFrame({O.AT: np.arange(70_000), "ident": np.arange(70_000) % 7, "key": [None, "a", "é"] * 23_333 + ["b"]})
    entries = O._entries(rows)
    assert len(entries) == 3 and not O._entries(rows.iloc[:0])
    back = O._rows(iter(entries), list(rows.columns))
    assert back.equals(rows) and back["key"].iloc[0] is None
    assert list(O._rows(iter(()), list(rows.columns)).columns) == list(rows.columns)
