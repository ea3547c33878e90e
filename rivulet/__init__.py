"""rivulet: keep a multi-tenant lakehouse in step with its source databases, on Spark.

Every operator takes DataFrames and returns DataFrames, so Catalyst sees the whole plan.
Writing a result down is a separate step (``rivulet.sources.sinks``).
"""
