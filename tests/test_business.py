import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import classify as K
from tidewatch.operators import cost as C
from tidewatch.operators import fleet as E
from tidewatch.operators import inventory as I
from tidewatch.operators import loadtest as B
from tidewatch.operators import policy as O
from tidewatch.operators import rootcause as G
from tidewatch.operators import tracing as X

T0 = dt.datetime(2024, 1, 1)


def test_half_even_rounding_and_limits(spark):
    f = F.lit
    row = spark.range(1).select(
        I.reorder_point(f(0.5), f(1.0), f(0.0)), I.reorder_point(f(1.5), f(1.0), f(0.0)), I.reorder_point(f(2.5), f(1.0), f(0.0)),
        I.safety_stock(f(10.0), f(0.0), f(4.0)), I.safety_stock(f(10.0), f(1000.0), f(4.0)), I.eoq(f(0.0), f(5.0)),
        I.eoq(f(10.0), f(10.0)),
    ).first()
    assert tuple(row) == (0.0, 2.0, 2.0, 70.0, 300.0, 1.0, 540.0)


def test_recommendation_errors_and_supply(spark):
    products = spark.createDataFrame(
        [("a", 10.0, 5.0, "s"), ("b", 10.0, 5.0, None), ("c", 10.0, 5.0, "s"), ("d", 10.0, 700.0, "s")],
        "product_id string, cost double, current_stock double, supplier_id string",
    ).withColumns({"order_cost": F.lit(None).cast("double"), "holding_cost_pct": F.lit(None).cast("double"), "min_order_quantity": F.lit(None).cast("double")})
    stats = spark.createDataFrame([("a", 10.0, 1.0), ("b", 10.0, 1.0), ("d", 10.0, 1.0)], "product_id string, avg_daily_demand double, demand_std double")
    leads = spark.createDataFrame([("a", 4.0), ("d", 4.0)], "product_id string, lead_time_days double")
    asked = spark.createDataFrame([(x,) for x in "abcdz"], "product_id string")
    out = {r["product_id"]: r for r in I.recommendations(products, stats, leads, asked).collect()}
    assert out["a"]["reorder_needed"] and out["a"]["order_quantity"] == 540.0 and out["a"]["days_of_supply"] == 0.5
    assert not out["d"]["reorder_needed"] and out["d"]["order_quantity"] == 0.0
    assert out["b"]["error"] == "No supplier ID available" and out["z"]["error"] == "No product data available"
    assert out["c"]["error"].startswith("No demand model") and out["c"]["eoq"] is None


def test_lead_time_names_are_joined(spark):
    """Smoothed means per name, one for missing names and for those not met; the plan is no longer with many names."""
    def leads(names):
        rows = [(T0.date(), T0.date() + dt.timedelta(days=1 + i % 9), f"p{i % names}" if i % 10 else None, i % 3, float(i % 7)) for i in range(900)]
        return I.lead_times(spark.createDataFrame(rows, "order_date date, delivery_date date, product_id string, supplier_id long, quantity double"))

    few, many = (I.fit_lead_time(leads(n), trees=2, depth=2) for n in (5, 500))
    rows = [(r["product_id"], r["lead_time_days"]) for r in leads(5).collect()]
    overall = sum(d for _, d in rows) / len(rows)
    days = {k: [d for p, d in rows if p == k] for k in ("p1", None)}
    mean = {k: (sum(d) + overall) / (len(d) + 1) for k, d in days.items()}
    asked = spark.createDataFrame([("p1", 0), (None, 0), ("new", 0)], "product_id string, supplier_id long")
    got = {r["product_id"]: r["_f_product_id"] for r in few.encode(asked).collect()}
    assert got == pytest.approx({"p1": mean["p1"], None: mean[None], "new": mean[None]})
    wanted = I.lead_time_features(leads(500)).drop("lead_time_days")
    told = [I.predict_lead_time(m, wanted) for m in (few, many)]
    sizes = [len(t._jdf.queryExecution().optimizedPlan().toString()) for t in told]
    assert sizes[1] < 1.2 * sizes[0] and told[1].count() == wanted.count()


def test_many_lead_times_are_fitted_and_asked_by_their_bins(spark, monkeypatch):
    """What a fit reads and what is asked of the trees does not grow with the rows; all rows count and all are told."""
    rows = spark.range(6000).select(
        F.lit(T0.date()).alias("order_date"), F.date_add(F.lit(T0.date()), (F.col("id") % 4 * 20 + F.col("id") % 3 + 1).cast("int")).alias("delivery_date"),
        F.when(F.col("id") % 50 != 7, F.concat(F.lit("p"), F.col("id") % 4)).alias("product_id"), (F.col("id") % 3).alias("supplier_id"), (F.col("id") * 7919 % 6000).alias("quantity"),
    )
    leads, written, real = I.lead_times(rows), {}, K.materialise
    monkeypatch.setattr(K, "SINGLE_ROWS", 500)
    monkeypatch.setattr(K, "materialise", lambda df, name: written.setdefault(name, real(df, name)))
    model = I.fit_lead_time(leads, trees=5, depth=6)
    read = written["training-groups"]
    total, days, most = read.agg(F.sum("_weight"), F.sum(F.col("_weight") * F.col("lead_time_days")), F.max("_weight")).first()
    assert read.count() < 1500 and total == pytest.approx(6000) and most <= 12
    assert days == pytest.approx(leads.agg(F.sum("lead_time_days")).first()[0])

    asked = I.lead_time_features(leads).drop("lead_time_days").withColumn("id", F.monotonically_increasing_id())
    asked = asked.withColumn("quantity", F.when(F.col("id") % 40 != 3, F.col("quantity")))
    told = I.predict_lead_time(model, asked)
    assert told.columns == [*asked.columns, "lead_time_days"] and written["told-bins"].count() < 1500
    single = model.forest.transform(model.encode(asked)).select("id", F.greatest(F.lit(1.0), F.bround("_days", 0)).alias("d"))
    assert sorted((r["id"], r["lead_time_days"]) for r in told.collect()) == sorted((r["id"], r["d"]) for r in single.collect())
    assert told.agg(F.avg("lead_time_days")).first()[0] == pytest.approx(days / 6000, rel=0.05)


def test_lead_times_drop_invalid(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 1, 5), d(2024, 1, 5)), (d(2024, 1, 5), d(2024, 1, 6)), (d(2024, 1, 5), d(2024, 1, 1))], "order_date date, delivery_date date")
    df = df.withColumns({"product_id": F.lit(1), "supplier_id": F.lit(1), "quantity": F.lit(1.0)})
    assert [r["lead_time_days"] for r in I.lead_times(df).collect()] == [1]


def test_empty_demand_gives_no_rows(spark):
    empty = spark.createDataFrame([], "product_id string, date date, quantity double")
    assert I.forecast_demand(I.daily_demand(empty)).count() == 0


def test_cohort_boundary(spark):
    devices = spark.createDataFrame([(f"d{i}", "g", "v1") for i in range(300)], "device_id string, device_group string, current_version string")

    def plan(pct, **kw):
        phase = {"id": "p", "percentage": float(pct), "duration": "1h", "require_approval": False, "approved": False, "metrics": [], "thresholds": {}, **kw}
        return spark.createDataFrame([("r1", "v2", "in-progress", ["all"], 0, [phase], "h")], E.ROLLOUT_SCHEMA)

    chosen = lambda p, **kw: E.eligible_devices(E.active_rollout(devices, p), **kw)
    at_ten = chosen(plan(10)).agg(F.max("cohort")).first()[0]
    assert at_ten == 10 and chosen(plan(10), strict=True).agg(F.max("cohort")).first()[0] == 9
    assert chosen(plan(100, require_approval=True)).count() == 0 and chosen(plan(100, require_approval=True, approved=True)).count() == 300
    done = plan(100).withColumn("current_phase", F.lit(1))
    assert chosen(done).count() == 0


def test_rollout_choice_is_the_lowest_id(spark):
    devices = spark.createDataFrame([("a", "g", "v0"), ("b", "h", "v0"), ("c", "x", "v0")], "device_id string, device_group string, current_version string")
    rows = [("r1", "v", "pending", ["g"], 0, [], ""), ("r2", "v", "in-progress", ["h"], 0, [], ""), ("r3", "v", "in-progress", ["all"], 0, [], ""), ("r4", "v", "in-progress", ["g"], 0, [], "")]
    out = {r["device_id"]: r["rollout"]["id"] for r in E.active_rollout(devices, spark.createDataFrame(rows, E.ROLLOUT_SCHEMA)).collect()}
    assert out == {"a": "r3", "b": "r2", "c": "r3"}
    none = E.active_rollout(devices, spark.createDataFrame(rows[:1], E.ROLLOUT_SCHEMA))
    assert none.count() == 0


def test_phase_gate_needs_measurements(spark):
    phases = spark.createDataFrame([("r", "p", T0, "1h", {"error_rate": 0.01, "cpu": 80.0})], "rollout_id string, phase_id string, start timestamp, duration string, thresholds map<string,double>")
    rows = [("r", "error_rate", T0, 0.01), ("r", "cpu", T0 + dt.timedelta(hours=2), 10.0)]
    gate = lambda r: E.phase_gate(phases, spark.createDataFrame(r, "rollout_id string, metric string, timestamp timestamp, value double")).first()
    assert gate(rows)["failing"] == ["cpu"]
    assert gate([*rows, ("r", "cpu", T0, 80.0)])["may_advance"] is True
    assert gate([*rows, ("r", "cpu", T0, 80.1)])["may_advance"] is False


def test_incremental_updates_are_strictly_newer(spark):
    m = spark.createDataFrame([("d", [("a", T0, "x"), ("b", T0 + dt.timedelta(seconds=1), "x")]), ("n", [("c", T0, "x")])], "device_id string, updates array<struct<key:string,timestamp:timestamp,data_type:string>>")
    last = spark.createDataFrame([("d", T0)], "device_id string, last_sync timestamp")
    taken = E.incremental_updates(m, last)
    assert sorted(r["key"] for r in taken.collect()) == ["b", "c"]
    moved = {r["device_id"]: r["last_sync"] for r in E.advance_watermark(last, taken).collect()}
    assert moved == {"d": T0 + dt.timedelta(seconds=1), "n": T0}


def test_conflict_policies(spark):
    side = "device_id string, key string, data_type string, value string, timestamp timestamp"
    local = spark.createDataFrame([("d", "k", "a", "L", T0), ("d", "only", "a", "L2", T0)], side)
    remote = spark.createDataFrame([("d", "k", "a", "R", T0 + dt.timedelta(seconds=1))], side)
    value = lambda **kw: {r["key"]: r["value"] for r in E.resolve_conflicts(local, remote, **kw).collect()}
    assert value() == {"k": "R", "only": "L2"} and value(policy="local")["k"] == "L"
    assert value(policy={"default": "newest", "a": "local"})["k"] == "L"
    assert value(custom=F.concat("local_value", "remote_value"))["k"] == "LR"


def test_access_needs_everything(spark):
    schema = "user struct<id:string,authenticated:boolean,mfa_verified:boolean,roles:array<string>>, request struct<encryption:string,data_classification:string,contains_pii:boolean,action:string,resource:string>"
    ok = (("u", True, True, ["r"]), ("TLS1.3", "public", None, "get", "x"))
    rows = [ok, (("u", True, None, ["r"]), ok[1]), (("u", True, True, None), ok[1]), (ok[0], ("TLS1.2", "public", None, "get", "x")), (ok[0], ("TLS1.3", "PCI", None, "get", "x")), (ok[0], ("TLS1.3", None, None, "get", "x")), (ok[0], ("TLS1.3", "public", True, "get", "x"))]
    assert [r["allowed"] for r in O.authorise(spark.createDataFrame(rows, schema), "r").collect()] == [True] + [False] * 6


def test_plan_without_resources_complies(spark):
    schema = "type string, encrypted boolean, mfa_enabled boolean, enable_flow_logs boolean, endpoint string"
    assert O.plan_compliance(spark.createDataFrame([], schema)).first()["main"] is True
    bad = O.plan_compliance(spark.createDataFrame([("aws_iam_user", None, None, None, None)], schema)).first()
    assert not bad["enforce_mfa"] and bad["enforce_flow_logs"] and not bad["main"]


def test_shared_cost_is_conserved(spark):
    rows = [("m", "monitoring", "x", 100.0, 0.0), ("m", "team-a", "a", 10.0, 1.0), ("m", "team-b", "b", 20.0, 3.0)]
    df = spark.createDataFrame(rows, "period string, namespace string, team string, cost double, cpu double")
    out = {r["team"]: (r["shared_cost"], r["total_cost"]) for r in C.share_costs(df, "team", ["period"]).collect()}
    assert out == {"a": (25.0, 35.0), "b": (75.0, 95.0)}


def test_budgets_in_configuration(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "team1-x", {"department": "engineering"}, 4000.0), (dt.date(2024, 1, 3), "team1-x", {}, 1500.0)], "day date, namespace string, labels map<string,string>, cost double")
    out = sorted((r["budget"], r["day"].day, r["spent"], r["status"]) for r in C.budget_status(df).collect())
    assert out == [("engineering-budget", 2, 4000.0, "ok"), ("team1-budget", 2, 4000.0, "alert"), ("team1-budget", 3, 5500.0, "exceeded")]
    tenants = spark.createDataFrame([(t["name"], t["namespaces"], t["cost_center"]) for t in C.TENANTS], "name string, namespaces array<string>, cost_center string")
    assert C.tenant_dim(tenants).count() == 3


def test_load_checks(spark):
    df = spark.createDataFrame([("dashboard_load", 3000.0, False)] * 9 + [("dashboard_load", 3000.0, True)], "scenario string, latency_ms double, failed boolean")
    row = B.check_thresholds(B.summarise_load(df)).first()
    assert (row["p95"], row["latency_ok"], row["errors_ok"]) == (3000.0, False, False)


def test_sampling_is_by_trace_and_default(spark):
    df = spark.createDataFrame([(f"t{i}", s) for i in range(400) for s in ("checkout-service", "other")], "trace_id string, service string")
    n = {r["service"]: r["count"] for r in X.sample_traces(df).groupBy("service").count().collect()}
    assert n["checkout-service"] == 400 and 15 <= n["other"] <= 70


def test_causes_are_ranked(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "b"), ("b", "d")], "source string, target string")
    nodes, distinct = G.service_graph(edges)
    related = G.neighbours(spark.createDataFrame([("b",)], "service string"), distinct)
    assert nodes.count() == 4 and distinct.count() == 3 and related.where("potential_cause").count() == 2
    scored = spark.createDataFrame([("b", "db", 0.9)], "affected_service string, predicted_cause string, confidence double")
    row = G.rank_causes(G.dependency_causes(related).unionByName(G.model_causes(scored)), limit=2).first()
    assert [c["cause"] for c in row["root_causes"]] == ["db", "a"] and row["confidence"] == 0.9


def test_replica_diff_sees_nulls(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", "y")], "k int, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", "y")], "k int, p string, q string")
    assert [tuple(r) for r in O.replica_diff(a, b, "k").collect()] == [(1, "changed")]
    assert O.replication_lag(a.withColumn("t", F.lit(T0)), b.withColumn("t", F.lit(T0)), "t").first()["within_limit"]


def test_version_to_go_back_to(spark):
    rows = [("e", "v1", "succeeded", 1), ("e", "v2", "failed", 2), ("e", "v3", "succeeded", 3), ("f", "v1", "succeeded", 1)]
    df = spark.createDataFrame([(a, b, c, T0 + dt.timedelta(hours=h)) for a, b, c, h in rows], "environment string, version string, result string, timestamp timestamp")
    assert [(r["environment"], r["version"]) for r in E.last_good_version(df).collect()] == [("e", "v1")]


@pytest.mark.parametrize("hash_case", [str.lower, str.upper])
def test_package_hash(spark, hash_case):
    import hashlib

    df = spark.createDataFrame([(b"abc", hash_case(hashlib.sha256(b"abc").hexdigest())), (b"abd", "0" * 64)], "content binary, package_hash string")
    assert [r["accepted"] for r in E.verify_packages(df).collect()] == [True, False]


def test_packages_are_many_bounded_files(spark, tmp_path):
    import hashlib

    lines = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("package"), F.concat(F.repeat(F.lit("\r é"), 30), F.col("id").cast("string")).alias("line"))
    root = tmp_path / "packages"
    E.write_packages(lines, str(root), "id", lines_per_file=150)
    sizes = [len(f.read_bytes().split(b"\n")) - 1 for f in root.glob("package=a/*.txt")]
    assert len(sizes) >= 14 and max(sizes) <= 150 and sum(sizes) == 2000
    whole = {p: "".join("\r é" * 30 + f"{i}\n" for i in range(3000) if (i % 3 == 0) == (p == "b")).encode() for p in "ab"}
    want = {p: hashlib.sha256(c).hexdigest() for p, c in whole.items()}
    for chunk in (100, 8192):
        assert {r["package"]: r["hash"] for r in E.package_hashes(E.read_packages(spark, str(root), chunk), "place").collect()} == want
    told = lines.withColumn("content", F.encode(F.concat("line", F.lit("\n")), "UTF-8"))
    assert {r["package"]: r["hash"] for r in E.package_hashes(told, "id").collect()} == want
