"""starmart: a Spark-native star-schema commerce warehouse toolkit.

Layers
------
sources/    readers, the fixture adapter and table/snapshot sinks
functions/  column expressions (title case, floored day deltas, bands, keys)
operators/  DataFrame -> DataFrame operators (quality, routing, staging,
            dimensions incl. SCD2, fact load, global ranking)
plans/      composed plans: the star schema build and the analytics marts
streaming/  incremental fact load as a Structured Streaming query
"""

__version__ = "0.1.0"
