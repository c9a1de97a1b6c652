"""hammerline: marketplace sale records on Spark DataFrames.

Layers, each a set of pure ``DataFrame -> DataFrame`` functions:

``functions``  column expressions (no Python UDF anywhere)
``operators``  relational building blocks: dedup, validation, outliers, rolling
               benchmarks, entity resolution, snapshots, data checks
``sources``    scans and sinks
``plans``      compositions: ingest stages, star schema, serving, monitoring
``streaming``  the Structured Streaming form of ingest and dedup
"""
