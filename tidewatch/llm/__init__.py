"""Training-data operators and their registered queries (``tidewatch.llm.plans``)."""
