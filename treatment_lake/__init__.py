"""treatment_lake: a Spark-native treatment-records lake.

Tagged document items -> bronze Parquet -> typed silver -> star schema
(eight dimensions, one fact) -> seven summary marts, with row-count
reconciliation, a step tracker, quality checks, and a Structured
Streaming variant of the gold build.

Sub-packages:
  sources    - item JSON, Parquet layers, file metadata, the driver-table adapter
  functions  - column expressions (tag unwrap, calendar, safe casts)
  operators  - silver transforms, upserts, dimensions, fact, marts, quality, tracker, sinks
  plans      - whole pipelines (source -> silver, silver -> gold)
  streaming  - file-arrival ingestion with foreachBatch
"""

__version__ = "0.1.0"
