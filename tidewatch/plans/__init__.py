"""Queries over the given tables, one module per operator family."""

import importlib

from tidewatch.plans.catalog import ORACLES, QUERIES

for _family in (
    "selectors", "timeseries", "preparation", "anomaly", "commerce", "inventory", "fraud", "intrusion", "rootcause",
    "alerting", "tracing", "cost", "fleet", "sources", "models", "streams",
):
    importlib.import_module(f"tidewatch.plans.{_family}")

__all__ = ["ORACLES", "QUERIES"]
