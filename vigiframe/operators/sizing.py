"""Size checks that guard broadcasts and driver-side values."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.session import ensure_checkpoint_dir

# Planned bytes up to which a dimension is hinted for broadcast. For a scan these are its files' bytes, which Parquet
# keeps compressed, so in memory it may be several times as many.
BROADCAST_BYTES = 16 << 20


def planned_bytes(df: DataFrame) -> int | None:
    """Bytes that the planner takes the frame to have, an upper bound for plain scans and in-memory data (filters only
    make it less); None on sessions without JVM plan access, e.g. Spark Connect."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001
        return None


def code_table(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed code table as an in-memory relation (SQL ``VALUES``): its exact
    size is known to the planner, so broadcasting it needs no job."""
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


_PLAIN_NODES = ("Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "LogicalRDD", "LocalRelation", "ResolvedHint")


def _is_derived(df: DataFrame) -> bool:
    """True when the plan computes its rows (aggregate, join, window, explode ...).
    Without JVM plan access (Spark Connect) every plan counts as derived: no hint, AQE decides."""
    try:
        nodes = [df._jdf.queryExecution().optimizedPlan()]
        while nodes:
            node = nodes.pop()
            if node.nodeName().split(" ")[0] not in _PLAIN_NODES:
                return True
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
        return False
    except Exception:  # noqa: BLE001
        return True


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back: computed once, safe when executors are
    lost, and of a size that the planner knows from its files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a check of the planned bytes, which runs no job.

    A derived dimension (aggregate, join, ...) gets no hint: its planned size is a guess, and AQE turns the join into a
    broadcast join at run time when the dimension's measured shuffle output is small. Beyond the bound the join stays a
    shuffle join, never forced into memory.
    """
    if _is_derived(df):
        return df
    size = planned_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df
