"""Market-trade lakehouse pipelines as Spark DataFrame transformations.

Raw message -> audited Bronze -> clean Silver -> verified serving copy -> dashboard metrics.
Every transformation takes and returns a DataFrame and works on batch and stream alike.
"""
