"""tidewatch: Spark-native flood-risk analytics.

Subpackages:
  functions   Column / SQL-expression helpers (rounding, bands, text formats)
  sources     district dimension, readers, sinks, bindings to test tables
  operators   hydrology, scoring, joins, ingest, KPIs, ranking, report, feed,
              daily history, evaluation
  plans       end-to-end plans (batch job, dashboard, training) and the
              registered query catalogue
  streaming   Structured Streaming ingest, snapshot, de-duplication, scoring
"""

__version__ = "0.1.0"
