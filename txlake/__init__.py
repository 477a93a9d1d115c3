"""txlake: a Spark-native property-transaction lake and star schema.

Layers: ``sources`` (CSV, Parquet raw zone, JDBC, stream sources, derived
inputs), ``functions`` (column rules), ``operators`` (DataFrame -> DataFrame
transforms), ``plans`` (the batch pipeline and registered queries) and
``streaming`` (the Structured Streaming landing job).
"""

__version__ = "0.1.0"
