"""carbonledger: carbon-footprint analytics (travel and IT equipment) on Spark.

Layers: ``functions`` (column expressions), ``operators`` (DataFrame
compositions), ``sources`` (readers and writers), ``plans`` (the model over the
driver tables, the questions and the query catalog), ``streaming``
(incremental ingest of daily drops).
"""

__version__ = "0.1.0"
