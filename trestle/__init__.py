"""trestle: construction-analytics marts as Spark DataFrame pipelines.

Layout
------
- ``functions``  Column-level helpers (accounting text, dates, booleans, safe division).
- ``operators``  DataFrame-level operators (latest row per key, month spines, running totals, unpivot ...).
- ``sources``    Table loading, control-table driven unions and the test-data analogs.
- ``plans``      The data products (staging -> intermediate -> marts) and the named query registry.
- ``oracle``     Independent DuckDB SQL for every registered query.
"""

from datetime import date

#: Fixed evaluation date used by tests and the query registry (newest order date in the test data).
DEFAULT_AS_OF = date(2001, 8, 1)

__all__ = ["DEFAULT_AS_OF"]
