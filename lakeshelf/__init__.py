"""lakeshelf: a layered (bronze / silver / gold) analytics library on Apache Spark.

Every transform is ``f(DataFrame, ...) -> DataFrame`` and runs no job; only the
sinks, the audit writers and the streams start work on the cluster.
"""

__version__ = "0.1.0"
