"""vigil: visit surveillance on Spark.

Raw visits (CSV, JSON lines, a topic) are cleansed by a fixed set of rules,
kept as date-partitioned Parquet behind an external table, and scanned by an
outbreak report. Batch and streaming share the same DataFrame transforms.
"""

__version__ = "0.1.0"
