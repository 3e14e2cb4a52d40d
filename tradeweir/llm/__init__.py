"""Operators for training-data pipelines; queries and their SQL are in :mod:`tradeweir.llm.queries`."""
