"""soukline: a retail order lakehouse written as plain PySpark DataFrame functions.

Layers
------
* ``sources``    scans (CSV, Parquet tables, landed JSON payloads) and table writes
* ``functions``  Column-level helpers (masking, time keys, lineage, calendar)
* ``operators``  DataFrame -> DataFrame building blocks (clean, merge, enrich, star)
* ``plans``      composed jobs: fixtures, reports, batch layer flows, query registry
* ``streaming``  Structured Streaming ingestion, foreachBatch upserts, live KPIs
"""

__version__ = "0.1.0"
