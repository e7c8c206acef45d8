"""Cost, tenants and compliance over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import cost as C
from tidewatch.operators import policy as P
from tidewatch.plans.catalog import plain, query

COSTS = """(SELECT o_orderdate::DATE AS day, 'team-' || lower(c_mktsegment) AS namespace, c_mktsegment AS team, n_name AS department, r_name AS cost_center, l_extendedprice * (1 - l_discount) AS cost, l_quantity AS cpu
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("C01_attribute_team", plain(f"SELECT namespace, team, sum(cost) AS cost, sum(cpu) AS cpu FROM {COSTS} GROUP BY 1, 2", "cost cpu", digits=2), digits=2)
def attribute_team(t):
    return C.attribute(t.costs(), "team")


@query("C01_attribute_label", plain(f"""SELECT cost_center AS "cost-center", sum(cost) AS cost, sum(cpu) AS cpu FROM {COSTS} GROUP BY 1""", "cost cpu", digits=2), digits=2)
def attribute_label(t):
    return C.attribute(t.costs(), "cost-center")


SHARED = f"(SELECT *, CASE department WHEN 'NATION_0' THEN 'monitoring' WHEN 'NATION_1' THEN 'logging' WHEN 'NATION_2' THEN 'ingress-nginx' WHEN 'NATION_3' THEN 'cert-manager' ELSE namespace END AS ns, strftime(day, '%Y-%m') AS period FROM {COSTS})"


def with_shared(t):
    dept = F.col("labels")["department"]
    names = F.when(dept == "NATION_0", "monitoring").when(dept == "NATION_1", "logging").when(dept == "NATION_2", "ingress-nginx").when(dept == "NATION_3", "cert-manager").otherwise(F.col("namespace"))
    return t.costs().withColumns({"namespace": names, "period": F.date_format("day", "yyyy-MM"), "team": F.col("labels")["team"]})


@query("C02_share_costs", plain(f"""WITH o AS (SELECT period, team, sum(cost) AS cost, sum(cpu) AS w FROM {SHARED} WHERE ns LIKE 'team%' GROUP BY 1, 2), p AS (SELECT period, sum(cost) AS pool FROM {SHARED} WHERE ns NOT LIKE 'team%' GROUP BY 1)
   SELECT period, team, cost, coalesce(pool, 0) * w / sum(w) OVER (PARTITION BY period) AS shared_cost, cost + coalesce(pool, 0) * w / sum(w) OVER (PARTITION BY period) AS total_cost FROM o LEFT JOIN p USING (period)""", "cost shared_cost total_cost", digits=2), digits=2)
def share_costs(t):
    return C.share_costs(with_shared(t), "team", ["period"])


@query("C03_share_idle", plain(f"""WITH o AS (SELECT period, team, sum(cost) AS cost, sum(cpu) AS w FROM {SHARED} GROUP BY 1, 2), p AS (SELECT period, sum(cpu) * 0.5 AS pool FROM {SHARED} WHERE cost_center = 'ASIA' GROUP BY 1)
   SELECT period, team, cost, coalesce(pool, 0) * w / sum(w) OVER (PARTITION BY period) AS idle_cost, cost + coalesce(pool, 0) * w / sum(w) OVER (PARTITION BY period) AS total_cost FROM o LEFT JOIN p USING (period)""", "cost idle_cost total_cost", digits=2), digits=2)
def share_idle(t):
    rows = with_shared(t)
    idle = rows.where(F.col("labels")["cost-center"] == "ASIA").select("period", (F.col("cpu") * 0.5).alias("idle_cost"))
    return C.share_idle(rows, idle, "team", ["period"])


BUDGETS = [
    {"name": "auto", "namespace": "^team-auto.*", "amount": 3000000.0}, {"name": "house", "namespace": "^team-house.*", "amount": 2500000.0},
    {"name": "nation-5", "label": ("department", "NATION_5"), "amount": 800000.0}, {"name": "nation-6", "label": ("department", "NATION_6"), "amount": 5000000.0},
]


@query("C04_budget_status", plain(f"""SELECT budget, strftime(day, '%Y-%m-%d') AS day, amount, spent, spent / amount AS used, CASE WHEN spent / amount > 1 THEN 'exceeded' WHEN spent / amount >= 0.8 THEN 'alert' ELSE 'ok' END AS status FROM (
   SELECT *, sum(c) OVER (PARTITION BY budget, date_trunc('month', day) ORDER BY day) AS spent FROM (SELECT budget, amount, day, sum(cost) AS c FROM {COSTS} JOIN (VALUES ('auto', 'team-auto', NULL, 3000000.0::DOUBLE), ('house', 'team-house', NULL, 2500000.0), ('nation-5', NULL, 'NATION_5', 800000.0), ('nation-6', NULL, 'NATION_6', 5000000.0)) b(budget, ns, dep, amount)
     ON starts_with(namespace, ns) OR department = dep GROUP BY 1, 2, 3))""", "amount spent used", digits=3), digits=3)
def budget_status(t):
    return C.budget_status(t.costs(), BUDGETS)


@query("C05_chargeback", plain(f"""SELECT strftime(month, '%Y-%m-%d') AS month, team, department, cost_center, sum(cost) AS cost, count(DISTINCT day)::BIGINT AS days, grouping_id(month, team, department, cost_center)::BIGINT AS level
   FROM (SELECT *, date_trunc('month', day) AS month FROM {COSTS}) GROUP BY ROLLUP (month, team, department, cost_center) HAVING grouping_id(month) = 0""", "cost", digits=2), digits=2)
def chargeback(t):
    labels = F.col("labels")
    rows = t.costs().select("day", "cost", labels["team"].alias("team"), labels["department"].alias("department"), labels["cost-center"].alias("cost_center"))
    return C.chargeback(rows)


DAILY = f"(SELECT namespace, day, sum(cost) AS cost FROM {COSTS} GROUP BY 1, 2)"


@query("C06_cost_spike", plain(f"""SELECT 'week' AS kind, a.namespace, strftime(a.day, '%Y-%m-%d') AS day, a.cost, b.cost AS cost_before FROM {DAILY} a JOIN {DAILY} b ON a.namespace = b.namespace AND a.day = b.day + 7 WHERE a.cost > b.cost * 1.5
   UNION ALL SELECT 'day', '', strftime(a.day, '%Y-%m-%d'), a.cost, b.cost FROM (SELECT day, sum(cost) AS cost FROM {DAILY} GROUP BY 1) a JOIN (SELECT day, sum(cost) AS cost FROM {DAILY} GROUP BY 1) b ON a.day = b.day + 1 WHERE a.cost > b.cost * 1.2""", "cost cost_before", digits=2), digits=2)
def cost_spike(t):
    daily = t.costs().groupBy("namespace", "day").agg(F.sum("cost").alias("cost"))
    week = C.cost_spike(daily, ["namespace"], 7, 1.5).select(F.lit("week").alias("kind"), "namespace", "day", "cost", "cost_before")
    whole = daily.groupBy("day").agg(F.sum("cost").alias("cost"))
    day = C.cost_spike(whole, [], 1, 1.2).select(F.lit("day").alias("kind"), F.lit("").alias("namespace"), "day", "cost", "cost_before")
    return week.unionByName(day)


@query("C07_quota_breach", plain(f"""SELECT namespace, resource, used, quota FROM (SELECT namespace, 'requests.cpu' AS resource, max(cpu) AS used, CASE WHEN namespace = 'team-building' THEN 60.0 ELSE 20.0 END AS quota FROM {COSTS} GROUP BY 1
   UNION ALL SELECT namespace, 'pods', count(DISTINCT department)::DOUBLE, 100.0 FROM {COSTS} GROUP BY 1) WHERE used > quota""", "used quota"))
def quota_breach(t):
    rows = t.costs().groupBy("namespace").agg(F.max("cpu").alias("cpu"), F.count_distinct(F.col("labels")["department"]).cast("double").alias("pods"))
    usage = rows.select("namespace", F.inline(F.array(F.struct(F.lit("requests.cpu").alias("resource"), F.col("cpu").alias("used")), F.struct(F.lit("pods").alias("resource"), F.col("pods").alias("used")))))
    own = rows.where("namespace = 'team-building'").select("namespace", F.lit("requests.cpu").alias("resource"), F.lit(60.0).alias("quota"))
    return C.quota_breach(usage, own)


@query("C08_tenant_dim", "SELECT DISTINCT n_name AS name, 'team-' || lower(c_mktsegment) AS namespace, r_name AS department, 'CC' || n_nationkey AS cost_center FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def tenant_dim(t):
    rows = t.customer.join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tenants = rows.groupBy(F.col("n_name").alias("name"), F.col("r_name").alias("department"), F.concat(F.lit("CC"), F.col("n_nationkey").cast("string")).alias("cost_center")).agg(
        F.collect_set(F.concat(F.lit("team-"), F.lower("c_mktsegment"))).alias("namespaces"))
    return C.tenant_dim(tenants)


@query("C09_authorise", """SELECT event_id, user_id::VARCHAR AS user_id, event_type AS action, '/r' || (user_id % 9) AS resource, event_id % 7 != 0 AND event_id % 11 != 0 AS authenticated, user_id % 4 != 0 AS authorized,
   event_id % 6 NOT IN (0, 1) AND event_id % 5 != 0 AND event_id % 9 != 0 AS compliant, authenticated AND authorized AND compliant AS allowed FROM events""")
def authorise(t):
    e, u = F.col("event_id"), F.col("user_id")
    user = F.struct(u.cast("string").alias("id"), (e % 7 != 0).alias("authenticated"), F.when(e % 11 != 0, True).alias("mfa_verified"), F.when(u % 4 == 1, F.array(F.lit("analyst"), F.lit("viewer"))).when(u % 4 == 0, F.array(F.lit("viewer"))).otherwise(F.array(F.lit("analyst"))).alias("roles"))
    request = F.struct(F.when(e % 6 == 0, "TLS1.2").when(e % 6 != 1, "TLS1.3").alias("encryption"), F.when(e % 5 == 0, "PCI").otherwise("internal").alias("data_classification"),
        F.when(e % 9 == 0, True).alias("contains_pii"), F.col("event_type").alias("action"), F.concat(F.lit("/r"), (u % 9).cast("string")).alias("resource"))
    return P.authorise(t.events.select("event_id", user.alias("user"), request.alias("request")), "analyst")


@query("C10_plan_compliance", """SELECT user_id, bool_and(event_type != 'view' OR event_id % 9 != 0) AS enforce_encryption, coalesce(bool_and(event_id % 5 != 0) FILTER (event_type = 'error'), true) AS enforce_mfa,
   coalesce(bool_and(event_id % 4 != 0) FILTER (event_type = 'click'), true) AS enforce_flow_logs, bool_and(CASE WHEN event_type = 'purchase' THEN event_id % 8 != 0 WHEN event_type = 'view' THEN event_id % 11 != 0 ELSE true END) AS enforce_fips_endpoints,
   enforce_encryption AND enforce_mfa AND enforce_flow_logs AND enforce_fips_endpoints AS main FROM events GROUP BY 1""")
def plan_compliance(t):
    e, kind = F.col("event_id"), F.col("event_type")
    rows = t.events.select("user_id", F.when(kind == "error", "aws_iam_user").when(kind == "click", "aws_vpc").otherwise("aws_thing").alias("type"),
        F.when(kind == "view", e % 9 != 0).alias("encrypted"), F.when(e % 5 != 0, True).alias("mfa_enabled"), (e % 4 != 0).alias("enable_flow_logs"),
        F.when(kind == "purchase", F.when(e % 8 != 0, "s3-fips.host").otherwise("s3.host")).when((kind == "view") & (e % 11 == 0), None).otherwise("kms-fips.host").alias("endpoint"))
    return P.plan_compliance(rows, ["user_id"])


@query("C11_replica_diff", "SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 3 THEN 'missing_right' ELSE 'changed' END AS status FROM supplier WHERE s_suppkey % 10 = 3 OR s_suppkey % 7 = 2 UNION ALL SELECT -1 - s_suppkey, 'missing_left' FROM supplier WHERE s_suppkey % 20 = 1")
def replica_diff(t):
    left = t.supplier
    right = left.where("s_suppkey % 10 != 3").withColumn("s_acctbal", F.when(F.col("s_suppkey") % 7 == 2, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")))
    right = right.unionByName(left.where("s_suppkey % 20 = 1").withColumn("s_suppkey", -1 - F.col("s_suppkey")))
    return P.replica_diff(left, right, "s_suppkey")


@query("C11_replication_lag", plain("SELECT max(ts) AS primary_ts, max(ts) FILTER (event_type != 'view') AS replica_ts, (epoch_us(max(ts)) - epoch_us(max(ts) FILTER (event_type != 'view'))) / 1e6 AS lag_s, lag_s <= 30 AS within_limit FROM events", "lag_s", "primary_ts replica_ts"))
def replication_lag(t):
    return P.replication_lag(t.events, t.events.where("event_type != 'view'"), "ts")
