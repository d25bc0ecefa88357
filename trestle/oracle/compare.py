"""Order-insensitive comparison of a Spark result with its DuckDB oracle (columns matched by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def duckdb_views(con, sf_dir: str) -> None:
    from trestle.sources.tables import BASE_TABLES

    for t in BASE_TABLES:
        con.execute(f"create or replace view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")


def compare(sdf, con, sql):
    """(same_columns, same_row_count, same_values, spark_rows, oracle_rows)."""
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    same_cols = sorted(scols) == sorted(ocols)
    same_vals = same_cols and canon(scols, srows) == canon(ocols, orows)
    return same_cols, len(srows) == len(orows), same_vals, len(srows), len(orows)


_SPARK_TYPES = {"int": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8", "double": "float64",
                "float": "float32", "string": "string", "date": "date", "boolean": "bool", "timestamp": "timestamp",
                "timestamp_ntz": "timestamp"}
_DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
               "FLOAT": "float32", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "bool", "TIMESTAMP": "timestamp",
               "HUGEINT": "int128"}


def type_diffs(sdf, rel) -> list[tuple[str, str, str]]:
    """Columns whose Spark and DuckDB types differ (by class and width)."""
    def s_cls(t):
        name = t.simpleString()
        return _SPARK_TYPES.get(name, name.replace(" ", ""))

    def d_cls(t):
        name = str(t).upper()
        return _DUCK_TYPES.get(name, name.lower().replace(" ", ""))

    spark_types = {f.name: s_cls(f.dataType) for f in sdf.schema.fields}
    duck_types = {n: d_cls(t) for n, t in zip(rel.columns, rel.types)}
    return [(c, spark_types[c], duck_types.get(c)) for c in spark_types if spark_types[c] != duck_types.get(c)]
