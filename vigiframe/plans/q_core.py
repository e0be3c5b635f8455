"""Queries: weights, group totals, epidemiological dates and calendars.

Each ``@query`` pairs the Spark plan with an independent DuckDB statement over
the same parquet tables (DuckDB: dayofweek Sunday=0, ``//`` integer division,
double->bigint casts round, so ``trunc`` first).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigiframe.functions import dates as D
from vigiframe.operators.sizing import sized_broadcast
from vigiframe.operators.weights import (HOT_GROUP_ROWS, group_sum, join_group_total, race_weights, share_of_total,
                                         weight_sum_report, with_group_total)
from vigiframe.plans import pipelines as P
from vigiframe.plans.registry import query
from vigiframe.tables import Tables


def zf(x: str, n: int) -> str:
    """DuckDB zero-fill that never cuts."""
    v = f"CAST({x} AS VARCHAR)"
    return f"lpad({v}, CAST(greatest({n}, length({v})) AS INTEGER), '0')"


def census_cells(t: Tables, zero_age: int | None = None):
    """Census stand-in: lineitem (supplier, line status, line number, return flag) -> pop."""
    li = t.lineitem
    qty = F.col("l_quantity").cast("long")
    if zero_age is not None:
        qty = F.when(F.col("l_linenumber") == zero_age, F.lit(0).cast("long")).otherwise(qty)
    cells = (li.groupBy("l_suppkey", "l_linestatus", "l_linenumber", "l_returnflag")
               .agg(F.sum(qty).cast("long").alias("pop")))
    c = cells.select(F.lit(2022).cast("short").alias("ano_censo"),
                     F.col("l_suppkey"),
                     F.col("l_linestatus").alias("sexo"),
                     F.col("l_linenumber").cast("short").alias("idade"),
                     F.col("l_returnflag").alias("co_raca_cor"), "pop")
    return P.municipality_codes(c, "l_suppkey").drop("l_suppkey")


CENSUS_CELLS_SQL = f"""
cells AS (
  SELECT l_suppkey, l_linestatus, l_linenumber, l_returnflag,
         CAST(SUM(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS pop
  FROM lineitem GROUP BY l_suppkey, l_linestatus, l_linenumber, l_returnflag),
census AS (
  SELECT CAST(2022 AS SMALLINT) AS ano_censo, {zf('l_suppkey', 7)} AS co_municipio_ibge,
         substr({zf('l_suppkey', 7)}, 1, 6) AS co_municipio, substr({zf('l_suppkey', 7)}, 1, 2) AS co_uf,
         l_linestatus AS sexo, CAST(l_linenumber AS SMALLINT) AS idade, l_returnflag AS co_raca_cor, pop
  FROM cells)"""

W4 = "PARTITION BY ano_censo, co_municipio_ibge, sexo, idade"


@query("pipe_weights", f"""
WITH {CENSUS_CELLS_SQL}
SELECT ano_censo, co_municipio_ibge, co_municipio, co_uf, sexo, idade, co_raca_cor,
       pop AS pop_raca,
       CAST(coalesce(sum(pop) OVER ({W4}), 0) AS BIGINT) AS pop_total_grupo,
       CASE WHEN sum(pop) OVER ({W4}) > 0 THEN pop / sum(pop) OVER ({W4}) ELSE 0.0 END AS peso_raca
FROM census""")
def pipe_weights(spark, sf_dir):
    return P.weights(census_cells(Tables(spark, sf_dir)))


@query("agg_group_sum", """
SELECT l_suppkey, l_linestatus, l_linenumber, nullif(l_returnflag, 'N') AS flag,
       CAST(coalesce(sum(CASE WHEN l_discount <> 0 THEN CAST(trunc(l_quantity) AS BIGINT) END), 0) AS BIGINT) AS pop
FROM lineitem GROUP BY 1, 2, 3, 4""")
def agg_group_sum(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    df = li.select("l_suppkey", "l_linestatus", "l_linenumber",
                   F.nullif("l_returnflag", F.lit("N")).alias("flag"),
                   F.when(F.col("l_discount") != 0, F.col("l_quantity").cast("long")).alias("qty"))
    return group_sum(df, ["l_suppkey", "l_linestatus", "l_linenumber", "flag"], "qty", "pop")


@query("agg_share_of_total", """
WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, l_returnflag, n,
       CAST(sum(n) OVER (PARTITION BY l_suppkey) AS BIGINT) AS total,
       CASE WHEN sum(n) OVER (PARTITION BY l_suppkey) > 0 THEN n / sum(n) OVER (PARTITION BY l_suppkey)
            ELSE 0.0 END AS share
FROM c""")
def agg_share_of_total(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    c = li.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(c, ["l_suppkey"], "n", "total", "share")


@query("win_group_total", """
SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS prioridade,
       CAST(floor(o_totalprice) AS BIGINT) AS valor,
       CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (PARTITION BY o_custkey, nullif(o_orderpriority, '5-LOW')) AS BIGINT)
         AS total_grupo
FROM orders""")
def win_group_total(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    df = o.select("o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prioridade"),
                  F.floor("o_totalprice").cast("long").alias("valor"))
    # Raw order rows: a customer may hold a large share of them, so the skew-safe form.
    return with_group_total(df, ["o_custkey", "prioridade"], "valor", "total_grupo", skew_safe=True)


@query("jn_left_nullsafe", """
WITH d AS (
  SELECT l_orderkey, l_linenumber, l_linestatus AS k1, nullif(l_returnflag, 'N') AS k2,
         CAST(trunc(l_quantity) AS BIGINT) AS qty FROM lineitem),
tot AS (SELECT k1, k2, CAST(coalesce(sum(qty), 0) AS BIGINT) AS total FROM d GROUP BY k1, k2)
SELECT d.*, tot.total FROM d LEFT JOIN tot ON d.k1 IS NOT DISTINCT FROM tot.k1 AND d.k2 IS NOT DISTINCT FROM tot.k2""")
def jn_left_nullsafe(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    d = li.select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("k1"),
                  F.nullif("l_returnflag", F.lit("N")).alias("k2"), F.col("l_quantity").cast("long").alias("qty"))
    # Few, very large groups: hot keys are salted (see join_group_total).
    return join_group_total(d, ["k1", "k2"], "qty", "total", hot_rows=HOT_GROUP_ROWS)


@query("dq_weight_sums", f"""
WITH {CENSUS_CELLS_SQL.replace('CAST(trunc(l_quantity) AS BIGINT)', 'CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(trunc(l_quantity) AS BIGINT) END')},
w AS (SELECT *, CASE WHEN sum(pop) OVER ({W4}) > 0 THEN pop / sum(pop) OVER ({W4}) ELSE 0.0 END AS peso_raca FROM census),
g AS (SELECT ano_censo, co_municipio_ibge, sexo, idade, sum(peso_raca) AS s FROM w GROUP BY ALL)
SELECT CAST(count(*) AS BIGINT) AS grupos,
       CAST(count(*) FILTER (WHERE s = 0) AS BIGINT) AS grupos_zero,
       CAST(count(*) FILTER (WHERE s > 0 AND abs(s - 1.0) > 1e-9) AS BIGINT) AS falhas
FROM g""")
def dq_weight_sums(spark, sf_dir):
    return weight_sum_report(race_weights(census_cells(Tables(spark, sf_dir), zero_age=7)))


@query("prj_conditional", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_tax / l_discount ELSE 0.0 END AS razao
FROM lineitem""")
def prj_conditional(spark, sf_dir):
    from vigiframe.functions.scalars import ratio_or_zero
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", ratio_or_zero("l_tax", "l_discount").alias("razao"))


# ---------------------------------------------------------------- dates

WED = "(CAST(o_orderdate AS DATE) + CAST(3 - dayofweek(CAST(o_orderdate AS DATE)) AS INTEGER))"


@query("dt_epi_year_start", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders)
SELECT ano, CAST(make_date(ano, 1, 4) - CAST(dayofweek(make_date(ano, 1, 4)) AS INTEGER) AS DATE) AS inicio FROM y""")
def dt_epi_year_start(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    y = o.select(F.year("o_orderdate").alias("ano")).distinct()
    return y.select("ano", D.epi_year_start("ano").alias("inicio"))


@query("dt_epi_week", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data,
       CAST(year({WED}) AS BIGINT) AS ano_epi,
       CAST((dayofyear({WED}) - 1) // 7 + 1 AS BIGINT) AS semana_epi
FROM orders""")
def dt_epi_week(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", d.alias("data"), D.epi_year(d).alias("ano_epi"), D.epi_week(d).alias("semana_epi"))


@query("dt_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS ano, CAST(month(o_orderdate) AS BIGINT) AS mes,
       CAST(day(o_orderdate) AS BIGINT) AS dia FROM orders""")
def dt_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", F.year(d).cast("long").alias("ano"), F.month(d).cast("long").alias("mes"),
                    F.dayofmonth(d).cast("long").alias("dia"))


@query("dt_week_label", f"""
WITH w AS (SELECT o_orderkey, CAST(year({WED}) AS BIGINT) AS a, CAST((dayofyear({WED}) - 1) // 7 + 1 AS BIGINT) AS s
           FROM orders)
SELECT o_orderkey, CAST(a AS VARCHAR) || lpad(CAST(s AS VARCHAR), 2, '0') AS ano_semana_epi,
       a * 100 + s AS ano_semana_epi_num FROM w""")
def dt_week_label(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    a, s = D.epi_year(d), D.epi_week(d)
    return o.select("o_orderkey", D.epi_week_label(a, s).alias("ano_semana_epi"),
                    D.epi_week_number(a, s).alias("ano_semana_epi_num"))


BR_TEXT_SQL = ("CASE WHEN o_orderkey % 7 = 0 THEN '30/02/2024' WHEN o_orderkey % 11 = 0 THEN '' "
               "ELSE strftime(o_orderdate, '%d/%m/%Y') END")


def br_text():
    return (F.when(F.col("o_orderkey") % 7 == 0, F.lit("30/02/2024"))
             .when(F.col("o_orderkey") % 11 == 0, F.lit(""))
             .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))


@query("dt_parse_br", f"""
WITH t AS (SELECT o_orderkey, {BR_TEXT_SQL} AS texto FROM orders)
SELECT o_orderkey, texto, CAST(try_strptime(nullif(texto, ''), '%d/%m/%Y') AS DATE) AS data FROM t""")
def dt_parse_br(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    t = o.select("o_orderkey", br_text().alias("texto"))
    return t.select("o_orderkey", "texto", D.parse_br_date("texto").alias("data"))


EVW = "(CAST(ts AS DATE) + CAST(3 - dayofweek(CAST(ts AS DATE)) AS INTEGER))"


@query("dt_weekly_counts", f"""
SELECT CAST(year({EVW}) AS BIGINT) AS ano_epi, CAST((dayofyear({EVW}) - 1) // 7 + 1 AS BIGINT) AS semana_epi,
       count(*) AS casos
FROM events GROUP BY 1, 2""")
def dt_weekly_counts(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    d = F.col("ts").cast("date")
    return (e.select(D.epi_year(d).alias("ano_epi"), D.epi_week(d).alias("semana_epi"))
             .groupBy("ano_epi", "semana_epi").agg(F.count(F.lit(1)).alias("casos")))


SPINE_SQL = """
spine AS (
  SELECT CAST(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS DATE) AS data
  FROM (SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS lo, CAST(max(year(o_orderdate)) AS INTEGER) AS hi FROM orders))"""


def order_year_spine(t: Tables):
    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return D.date_spine_between(bounds)


@query("src_date_spine", f"WITH {SPINE_SQL} SELECT data FROM spine")
def src_date_spine(spark, sf_dir):
    return order_year_spine(Tables(spark, sf_dir))


CAL_SQL = """
SELECT data, CAST(year(data) AS BIGINT) AS ano, CAST(month(data) AS BIGINT) AS mes, CAST(day(data) AS BIGINT) AS dia,
       CAST(year(w) AS BIGINT) AS ano_epi, CAST((dayofyear(w) - 1) // 7 + 1 AS BIGINT) AS semana_epi,
       CAST(year(w) AS VARCHAR) || lpad(CAST((dayofyear(w) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS ano_semana_epi,
       CAST(year(w) * 100 + (dayofyear(w) - 1) // 7 + 1 AS BIGINT) AS ano_semana_epi_num
FROM (SELECT data, data + CAST(3 - dayofweek(data) AS INTEGER) AS w FROM spine)"""


@query("pipe_calendar", f"WITH {SPINE_SQL} {CAL_SQL}")
def pipe_calendar(spark, sf_dir):
    return P.calendar(order_year_spine(Tables(spark, sf_dir)))


@query("jn_calendar", f"""
WITH spine AS (
  SELECT CAST(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS DATE) AS data
  FROM (SELECT CAST(min(year(ts)) AS INTEGER) AS lo, CAST(max(year(ts)) AS INTEGER) AS hi FROM events)),
cal AS ({CAL_SQL})
SELECT e.event_id, c.data, c.ano_epi, c.semana_epi, c.ano_semana_epi
FROM events e LEFT JOIN cal c ON CAST(e.ts AS DATE) = c.data""")
def jn_calendar(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e = t.events
    bounds = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    cal = P.calendar(D.date_spine_between(bounds)).select("data", "ano_epi", "semana_epi", "ano_semana_epi")
    ev = e.select("event_id", F.col("ts").cast("date").alias("_d"))
    j = ev.join(sized_broadcast(cal), ev["_d"] == cal["data"], "left")
    return j.select("event_id", "data", "ano_epi", "semana_epi", "ano_semana_epi")
