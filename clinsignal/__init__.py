"""Spark-native drug-safety signal analytics.

Sub-packages:

* ``functions``  column expressions (coding rules, masking, coercion, formatting)
* ``sources``    scans and sinks (topic / table readers, snapshot writers, fixtures)
* ``operators``  DataFrame -> DataFrame steps (ingest, enrich, features, scoring, audit, monitor)
* ``streaming``  Structured Streaming jobs built from the same operators
* ``plans``      named end-to-end queries and their SQL oracles
"""

__version__ = "0.1.0"
