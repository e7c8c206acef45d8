"""Root causes over the given tables."""

from pyspark.sql import functions as F

from tidewatch.operators import rootcause as G
from tidewatch.plans.catalog import plain, query
from tidewatch.plans.preparation import SERIES_CORR, series_corr
from tidewatch.plans.selectors import SVC

# Who supplies whom: supplier nation -> customer nation of every order line.
EDGES = """(SELECT DISTINCT s.n_name AS source, c.n_name AS target FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
   JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c_nationkey = c.n_nationkey)"""


def dependencies(t):
    nation = t.read("nation").select("n_nationkey", "n_name")
    lines = t.lineitem.select("l_orderkey", "l_suppkey")
    buyers = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.groupBy("s_nationkey", "c_nationkey").count()
    rows = rows.join(nation.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_name": "source"}), "s_nationkey")
    return rows.join(nation.withColumnsRenamed({"n_nationkey": "c_nationkey", "n_name": "target"}), "c_nationkey").select("source", "target")


@query("G01_service_graph", f"SELECT source, target, true AS known FROM {EDGES}")
def service_graph(t):
    nodes, edges = G.service_graph(dependencies(t))
    return edges.join(nodes.withColumnRenamed("service", "source").withColumn("known", F.lit(True)), "source", "left")


RELATED = f"""(SELECT target AS service, source AS related, 'upstream' AS relationship, true AS potential_cause, 0.6 AS confidence FROM {EDGES}
   UNION ALL SELECT source, target, 'downstream', false, NULL FROM {EDGES})"""


def related(t):
    nodes, edges = G.service_graph(dependencies(t))
    return G.neighbours(nodes, edges)


@query("G02_neighbours", plain(f"SELECT * FROM {RELATED}", "confidence"))
def neighbours(t):
    return related(t)


@query("G03_correlated_contributors", plain(f"SELECT a AS metric, b AS contributor, abs(corr) AS correlation FROM {SERIES_CORR} WHERE NOT isnan(corr) AND abs(corr) > 0.3 AND a LIKE '%/error'", "correlation"))
def correlated_contributors(t):
    anomalous = t.metrics().where("metric_name = 'error'").select(F.concat_ws("/", "service", "metric_name").alias("metric"))
    return G.correlated_contributors(anomalous, series_corr(t), 0.3)


@query("G05_rank_causes", plain(f"""SELECT service, string_agg(cause, ',' ORDER BY r) AS causes, max(confidence) AS confidence FROM (
   SELECT *, row_number() OVER (PARTITION BY service ORDER BY confidence DESC, type, cause) AS r FROM (
     SELECT service, related AS cause, 'dependency' AS type, confidence FROM {RELATED} WHERE potential_cause
     UNION ALL SELECT n_name, 'cause-' || (n_nationkey % 4), 'ml_prediction', 0.5 + (n_nationkey % 10) / 20 FROM nation)) WHERE r <= 5 GROUP BY 1""", "confidence"))
def rank_causes(t):
    scored = t.read("nation").select(F.col("n_name").alias("affected_service"), F.concat(F.lit("cause-"), (F.col("n_nationkey") % 4).cast("string")).alias("predicted_cause"),
        (0.5 + (F.col("n_nationkey") % 10) / 20).alias("confidence"))
    ranked = G.rank_causes(G.dependency_causes(related(t)).unionByName(G.model_causes(scored)))
    return ranked.select("service", F.array_join(F.transform("root_causes", lambda x: x["cause"]), ",").alias("causes"), "confidence")


@query("G06_top_metrics", plain(f"""SELECT incident, metric, value, importance, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY incident ORDER BY importance DESC, metric)::BIGINT AS r FROM (
   SELECT service || '/' || day AS incident, metric, value, importance FROM (SELECT {SVC} AS service, strftime(ts, '%Y-%m-%d') AS day, event_type AS metric, avg(value) AS value FROM events GROUP BY 1, 2, 3)
   JOIN (SELECT event_type AS metric, stddev_samp(value) AS importance FROM events GROUP BY 1) USING (metric))) WHERE r <= 3""", "value importance"))
def top_metrics(t):
    per = t.events.groupBy(F.concat(F.lit("svc-"), (F.col("user_id") % 10).cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")).alias("incident"), "event_type").agg(F.avg("value").alias("v"))
    incidents = per.groupBy("incident").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("metrics"))
    importance = t.events.groupBy(F.col("event_type").alias("metric")).agg(F.stddev_samp("value").alias("importance"))
    return G.top_metrics(incidents, importance, "incident", k=3)
