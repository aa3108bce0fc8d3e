"""tidemark: metadata-driven incremental ingest and upsert on Spark.

Operators are plain functions from DataFrame to DataFrame; only ``sources``,
``plans`` and ``streaming`` read or write storage.
"""

from tidemark.spec import LoadSpec

__all__ = ["LoadSpec"]
