"""Every family's queries against SQL at the smallest scale; ``tools/check.py`` runs them all at any scale."""

import os
import re
import sys

import pytest

import __spark_entry__ as entry
from tidewatch.plans import catalog

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SAMPLED = [
    "R01_match_labels", "R17_render_template", "T01_rate", "T16_alert_state", "P02_interpolate_time", "P13_evaluate", "A01_dynamic_threshold",
    "F08_adjust_risk", "N08_match_signatures", "N11_ip_rate_limit", "G05_rank_causes", "I09_recommendations", "K09_session_duration",
    "L03_suppress_duplicates", "L10_inhibit", "X06_broken_traces", "C05_chargeback", "E03_eligible_devices", "B01_summarise_load",
]
# Inventory ids and where they are covered if not by a query of their own name.
COVERED = {"R10": "tests/test_functions.py"}
INVENTORY = (
    [f"S{i:02}" for i in range(1, 14)] + [f"R{i:02}" for i in range(1, 21)] + [f"T{i:02}" for i in range(1, 25)]
    + [f"P{i:02}" for i in range(1, 16)] + [f"A{i:02}" for i in range(1, 18)] + [f"F{i:02}" for i in range(1, 12)]
    + [f"N{i:02}" for i in range(1, 13)] + [f"G{i:02}" for i in range(1, 7)] + [f"I{i:02}" for i in range(1, 11)]
    + [f"K{i:02}" for i in range(1, 12)] + [f"L{i:02}" for i in range(1, 18)] + [f"X{i:02}" for i in range(1, 7)]
    + [f"C{i:02}" for i in range(1, 12)] + [f"E{i:02}" for i in range(1, 13)] + [f"B{i:02}" for i in range(1, 4)]
)


def test_every_inventory_line_has_a_query():
    names = set(entry.queries())
    found = {i for n in names for i in re.findall(r"[A-Z]\d\d(?=_)", n)} | set(COVERED)
    assert [i for i in INVENTORY if i not in found] == []
    assert set(entry.oracle_sql()) <= names


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["event_id", "metric_name", "timestamp", "value", "lower_threshold", "upper_threshold", "anomaly_probability"]


@pytest.fixture(scope="module")
def sql(tiny):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLED)
def test_against_sql(spark, sql, tiny, name):
    from check import rows_of

    df = catalog.QUERIES[name](spark, tiny)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = sql.execute(catalog.ORACLES[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
