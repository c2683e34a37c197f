"""contractlake: contract-document ingestion as Spark DataFrame / SQL / Structured Streaming jobs.

Sub-packages:
  functions  Column -> Column building blocks (scalars, JSON shape tests, key aliases)
  sources    table loaders, derived fixtures, event/document sources, sinks
  operators  DataFrame -> DataFrame operators (gate, payload, star, pages, quality, ...)
  plans      composed flows and the registered query catalogue (Spark + oracle SQL)
  streaming  Structured Streaming wrappers over the batch operators
"""

__version__ = "0.1.0"
