"""Land delimited batch extracts in raw tables with Spark.

The package reads an entity's extract under a declared contract, adds a payload
hash and run metadata, measures data quality in one aggregation, appends only the
rows whose key the target does not hold yet, and keeps an audit row per run.
"""
