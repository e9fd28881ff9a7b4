"""quillfeed: feed and article analytics expressed as Spark DataFrame plans.

Sub-packages:

* ``functions`` - column expressions (text, URL, time, image, score helpers)
* ``operators`` - DataFrame -> DataFrame steps (clean, dedup, rank, enrich, store, quality, icons)
* ``sources``   - readers for publisher CSVs, feed documents, JSON lookups, tables
* ``sinks``     - JSON / parquet writers with snapshot publishing
* ``plans``     - composed pipelines (locale feed build, source build, icons, health)
* ``streaming`` - Structured Streaming forms of the incremental steps
"""


