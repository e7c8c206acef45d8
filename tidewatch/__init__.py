"""Observability, commerce, fraud, cost and fleet analytics as DataFrame operators for Apache Spark."""
