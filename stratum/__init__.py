"""stratum: layered (bronze / silver / gold / marts) batch analytics on Spark.

Subpackages:
  sources    page files, the append-only raw table, catalog and export helpers
  functions  column expressions: page JSON, link arrays, duration text, formats
  operators  reusable DataFrame operators: dense ids, keep-last, upsert, checks,
             shares, top-k
  plans      the stage builders: silver, gold, marts, the end-to-end pipeline
             and the adapter that maps the provided tables onto the title model
  streaming  incremental loading of new page files with Structured Streaming
"""

__version__ = "0.1.0"
