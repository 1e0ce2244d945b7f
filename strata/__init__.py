"""strata: medallion (bronze, silver, gold) data operators on Spark DataFrames.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; Catalyst plans the joins, aggregations and scans.
"""

from strata.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
