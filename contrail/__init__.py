"""contrail — layered analytics on aircraft state vectors, on Spark.

Bronze (landed JSON snapshots) -> Silver (typed, checked, classified, upserted
by aircraft) -> Gold (filtered, projected) -> read-only SQL, in batch or
incrementally with Structured Streaming.
"""

__version__ = "0.1.0"
