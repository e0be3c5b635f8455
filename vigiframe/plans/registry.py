"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, and key -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its oracle SQL (None = no SQL form)."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


# Date-valued output columns of the registered queries. The driver-facing
# wrappers (``__spark_entry__``) emit them as timestamp_ntz at midnight, the
# representation the driver's own tables use for dates, so the Spark and DuckDB
# results compare the same way whether they are read as Python objects or
# pandas frames. The library itself returns DateType.
DATE_COLUMNS: dict[str, list[str]] = {
    "dt_epi_week": ["data"], "dt_epi_year_start": ["inicio"], "dt_parse_br": ["data"], "jn_calendar": ["data"],
    "man_missing_files": ["data"], "pipe_calendar": ["data"], "pipe_establishments": ["dt_atualizacao"],
    "prj_type_by_prefix": ["dt_pedido", "dt_registro"], "snk_conform": ["l_shipdate"], "src_date_spine": ["data"],
    "top_latest": ["o_orderdate"],
}


# Integer output columns that hold nulls. Read into pandas, Spark gives them as
# float64 and DuckDB as nullable Int64; the driver-facing wrappers deliver them
# as double on both sides so every way of reading compares equal. The library
# itself returns bigint.
NULLABLE_INT_COLUMNS: dict[str, list[str]] = {
    "fn_try_int": ["valor"], "pipe_neighbourhoods": ["v0001"],
}


def for_driver(key: str, fn: QueryFn) -> QueryFn:
    """Wrap a query with the driver-facing representation: dates as timestamp_ntz,
    nullable integer columns (``NULLABLE_INT_COLUMNS``) as double."""
    from pyspark.sql import functions as F
    as_double = set(NULLABLE_INT_COLUMNS.get(key, []))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        if not as_double and not any(t == "date" for _, t in df.dtypes):
            return df
        cols = []
        for c, t in df.dtypes:
            col = F.col(f"`{c}`")
            if t == "date":
                col = col.cast("timestamp_ntz")
            elif c in as_double:
                col = col.cast("double")
            cols.append(col.alias(c))
        return df.select(*cols)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def sql_for_driver(key: str, sql: str) -> str:
    repl = [f"CAST({c} AS TIMESTAMP) AS {c}" for c in DATE_COLUMNS.get(key, [])]
    repl += [f"CAST({c} AS DOUBLE) AS {c}" for c in NULLABLE_INT_COLUMNS.get(key, [])]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql}) AS q"
