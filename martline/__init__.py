"""martline — a Spark-native marketing-warehouse analytics library.

Subpackages: ``sources`` (readers, domain views, sinks), ``functions``
(column expressions), ``operators`` (generic DataFrame operators),
``plans`` (fact, dimension, mart, quality, profiling and exploration jobs),
``streaming`` (incremental source-grain ingestion).
"""

__version__ = "0.1.0"
