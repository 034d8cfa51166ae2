"""stratus: hourly observations from many sites, on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions``; I/O lives in :mod:`stratus.sources`, stream wiring in
:mod:`stratus.streaming`.
"""

from stratus.session import get_session

__all__ = ["get_session"]
