"""riskflow: transaction-risk analytics as Spark DataFrame and Structured Streaming jobs.

Layers:
  sources/    raw event readers, table readers, transactions derived from the `events` table
  functions/  column-expression building blocks (features, scalar helpers)
  operators/  DataFrame -> DataFrame operators (silver, contract, metrics, drift, registry, ...)
  streaming/  bronze / silver / gold / scoring streaming queries and their batch writers
  plans/      the named, verifiable queries exposed through __spark_entry__.py
"""

__version__ = "0.1.0"
