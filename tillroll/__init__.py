"""tillroll — retail star-schema analytics on Spark DataFrames.

Layers (every function takes and returns DataFrames; nothing is collected):

* ``sources``   – raw extracts: read, union, route, the driver-table mapping, sinks.
* ``functions`` – scalar Column helpers (text, dates, ratios/rounding).
* ``operators`` – cleaning, dimension/fact builders, audits, business queries,
  measures, time intelligence, dashboard datasets, report analyses, forecasting.
* ``plans``     – the warehouse build (raw → clean → star, materialised once)
  and the query registry used by ``__spark_entry__``.
* ``streaming`` – incremental ingestion of new regional extracts with the same
  cleaning code.
"""

__all__ = ["session"]
