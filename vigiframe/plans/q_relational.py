"""Queries: lookups and joins, aggregates, windows, sorts, top-N and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigiframe.functions.scalars import zfill
from vigiframe.operators import aggregates as A
from vigiframe.operators import lookups as L
from vigiframe.operators.weights import apply_weights
from vigiframe.plans.q_core import census_cells, zf
from vigiframe.plans.registry import query
from vigiframe.tables import Tables

# ---------------------------------------------------------------- lookups


@query("jn_code_lookup", """
SELECT c_custkey, n_name, r_name FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def jn_code_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_nationkey")
    j = L.strict_lookup(c, t.nation, "c_nationkey", "n_nationkey", "nation code")
    j = L.strict_lookup(j, t.region, "n_regionkey", "r_regionkey", "region code")
    return j.select("c_custkey", "n_name", "r_name")


@query("jn_unknown_codes", """
SELECT DISTINCT c_nationkey FROM customer
WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)""")
def jn_unknown_codes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = t.nation.filter(F.col("n_nationkey") < 20)
    return L.unknown_codes(t.customer, dim, "c_nationkey", "n_nationkey")


PREFIX_DIM_SQL = "SELECT substr(p_type, 1, 3) AS cat, min(p_type) AS descricao FROM part GROUP BY 1"


@query("jn_prefix_lookup", f"""
SELECT p_partkey, p_type, d.cat, d.descricao FROM part LEFT JOIN ({PREFIX_DIM_SQL}) d ON substr(p_type, 1, 3) = d.cat""")
def jn_prefix_lookup(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    dim = p.groupBy(F.substring("p_type", 1, 3).alias("cat")).agg(F.min("p_type").alias("descricao"))
    j = L.prefix_lookup(p.select("p_partkey", "p_type"), "p_type", dim, "cat", 3)
    return j.select("p_partkey", "p_type", "cat", "descricao")


NODOT_SQL = "'B' || substr(p_brand, 7, 1) || '.' || substr(p_brand, 8)"


@query("jn_code_nodot", f"""
WITH dim AS (SELECT 'B' || substr(p_brand, 7) AS subcat, min(p_brand) AS descricao FROM part GROUP BY 1)
SELECT p_partkey, {NODOT_SQL} AS codigo, dim.subcat, dim.descricao
FROM part LEFT JOIN dim ON replace({NODOT_SQL}, '.', '') = dim.subcat""")
def jn_code_nodot(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    dim = p.groupBy(F.concat(F.lit("B"), F.expr("substring(p_brand, 7)")).alias("subcat")) \
           .agg(F.min("p_brand").alias("descricao"))
    codes = p.select("p_partkey", F.concat(F.lit("B"), F.substring("p_brand", 7, 1), F.lit("."),
                                           F.expr("substring(p_brand, 8)")).alias("codigo"))
    return L.nodot_lookup(codes, "codigo", dim, "subcat").select("p_partkey", "codigo", "subcat", "descricao")


@query("jn_geo_chain", f"""
SELECT c_custkey, {zf('c_nationkey', 2)} AS co_uf, n_name AS no_uf, CAST(r_regionkey AS INTEGER) AS co_regiao,
       r_name AS no_regiao
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def jn_geo_chain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = L.chain(t.customer.select("c_custkey", "c_nationkey"),
                (t.nation, F.col("c_nationkey") == F.col("n_nationkey")),
                (t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select("c_custkey", zfill("c_nationkey", 2).alias("co_uf"), F.col("n_name").alias("no_uf"),
                    F.col("r_regionkey").alias("co_regiao"), F.col("r_name").alias("no_regiao"))


@query("jn_semi_required", """
SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey)""")
def jn_semi_required(spark, sf_dir):
    t = Tables(spark, sf_dir)
    keys = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"))
    return L.semi_join(t.supplier.select("s_suppkey", "s_name"), keys, "s_suppkey")


@query("jn_grid_missing", """
WITH c AS (SELECT DISTINCT o_custkey FROM orders),
p AS (SELECT DISTINCT o_orderpriority FROM orders),
s AS (SELECT DISTINCT o_orderstatus FROM orders)
SELECT o_custkey, o_orderpriority, o_orderstatus FROM c, p, s
EXCEPT SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders""")
def jn_grid_missing(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderpriority", "o_orderstatus")
    return L.missing_cells(o, "o_custkey", ["o_orderpriority", "o_orderstatus"])


TOP_AGE = 5


def population_cells(t: Tables):
    """Projected-population stand-in: lineitem (supplier, ship year, status, line number) -> pop."""
    li = t.lineitem
    cells = (li.groupBy("l_suppkey", F.year("l_shipdate").alias("ano"), "l_linestatus", "l_linenumber")
               .agg(F.sum(F.col("l_quantity").cast("long")).cast("long").alias("pop")))
    return cells.select(zfill("l_suppkey", 7).alias("co_municipio_ibge"), F.col("ano").cast("short").alias("ano"),
                        F.col("l_linestatus").alias("sexo"), F.col("l_linenumber").alias("idade"), "pop")


POP_CELLS_SQL = f"""
pop AS (
  SELECT {zf('l_suppkey', 7)} AS co_municipio_ibge, CAST(year(l_shipdate) AS SMALLINT) AS ano, l_linestatus AS sexo,
         l_linenumber AS idade, CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS pop
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate), l_linestatus, l_linenumber)"""

WEIGHTS_SQL = f"""
wcells AS (
  SELECT {zf('l_suppkey', 7)} AS mun, l_linestatus AS sx, least(l_linenumber, {TOP_AGE}) AS ag, l_returnflag AS co_raca_cor,
         CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS p
  FROM lineitem GROUP BY 1, 2, 3, 4),
w AS (
  SELECT mun, sx, ag, co_raca_cor,
         CASE WHEN sum(p) OVER (PARTITION BY mun, sx, ag) > 0 THEN p / sum(p) OVER (PARTITION BY mun, sx, ag)
              ELSE 0.0 END AS peso
  FROM wcells)"""


@query("jn_apply_weights", f"""
WITH {POP_CELLS_SQL}, {WEIGHTS_SQL}
SELECT pop.co_municipio_ibge, pop.ano, pop.sexo, pop.idade, pop.pop, w.co_raca_cor, w.peso,
       CAST(pop.pop AS DOUBLE) * w.peso AS pop_estimada
FROM pop LEFT JOIN w ON pop.co_municipio_ibge = w.mun AND pop.sexo = w.sx AND least(pop.idade, {TOP_AGE}) = w.ag""")
def jn_apply_weights(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pop = population_cells(t)
    out = apply_weights(pop, census_cells(t), TOP_AGE, sex_type=None)
    return out.select("co_municipio_ibge", "ano", "sexo", "idade", "pop", "co_raca_cor", "peso", "pop_estimada")


# ---------------------------------------------------------------- aggregates


@query("agg_counts_rollup", f"""
SELECT CASE WHEN grouping(co_uf) = 1 THEN 'total' ELSE 'parte' END AS nivel, co_uf, count(*) AS rows
FROM (SELECT {zf('c_nationkey', 2)} AS co_uf FROM customer) GROUP BY ROLLUP (co_uf)""")
def agg_counts_rollup(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(zfill("c_nationkey", 2).alias("co_uf"))
    return A.counts_rollup(c, "co_uf")


@query("agg_version_label", """
SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS ano_min, CAST(max(year(o_orderdate)) AS INTEGER) AS ano_max,
       CAST(min(year(o_orderdate)) AS VARCHAR) || '-' || CAST(max(year(o_orderdate)) AS VARCHAR) AS versao FROM orders""")
def agg_version_label(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("ano"))
    return A.version_label(o, "ano")


@query("agg_distinct_sorted", "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders")
def agg_distinct_sorted(spark, sf_dir):
    return A.distinct_sorted(Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("ano")), "ano")


@query("agg_last_wins", "SELECT user_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id")
def agg_last_wins(spark, sf_dir):
    return A.last_wins(Tables(spark, sf_dir).events, "user_id", "event_type", "ts")


@query("agg_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def agg_duplicates(spark, sf_dir):
    return A.duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- sorts, top-N, blocks


@query("srt_single", "SELECT s_suppkey, s_name, s_nationkey FROM supplier ORDER BY s_name NULLS LAST")
def srt_single(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier.select("s_suppkey", "s_name", "s_nationkey")
    return s.orderBy(F.col("s_name").asc_nulls_last())


@query("srt_multi", f"""
SELECT substr({zf('l_suppkey', 7)}, 1, 2) AS co_uf, {zf('l_suppkey', 7)} AS co_municipio_ibge, l_linestatus AS sexo,
       l_linenumber AS idade, l_returnflag AS co_raca_cor, l_orderkey
FROM lineitem""")
def srt_multi(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    df = li.select(zfill("l_suppkey", 7).alias("co_municipio_ibge"), F.col("l_linestatus").alias("sexo"),
                   F.col("l_linenumber").alias("idade"), F.col("l_returnflag").alias("co_raca_cor"), "l_orderkey")
    df = df.withColumn("co_uf", F.substring("co_municipio_ibge", 1, 2))
    keys = ["co_municipio_ibge", "sexo", "idade", "co_raca_cor"]
    # Publication layout: range partitions on (state, keys) spread a hot state over
    # several tasks; rows are sorted inside each task, no global sort.
    return df.repartitionByRange("co_uf", *keys).sortWithinPartitions("co_uf", *keys) \
             .select("co_uf", *keys, "l_orderkey")


@query("top_n_years", """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders ORDER BY ano DESC LIMIT 3""")
def top_n_years(spark, sf_dir):
    return A.top_n_values(Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("ano")), "ano", 3)


@query("top_latest", """
SELECT arg_max(o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) * 100000000000 + o_orderkey) AS o_orderkey,
       CAST(max(o_orderdate) AS DATE) AS o_orderdate FROM orders""")
def top_latest(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    v = o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return A.latest(v, "o_orderkey", "o_orderdate")


@query("win_blocks", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       CAST((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1) // 3
            AS INTEGER) AS bloco
FROM lineitem""")
def win_blocks(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    b = A.block_ids(li, ["l_orderkey"], order, 3)
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "bloco")


# ---------------------------------------------------------------- set operations


@query("set_union_all", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders WHERE year(o_orderdate) < 1998
UNION ALL
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders WHERE year(o_orderdate) >= 1998""")
def set_union_all(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.year("o_orderdate").alias("ano"))
    return A.union_all([o.filter(F.col("ano") < 1998), o.filter(F.col("ano") >= 1998)])


@query("set_union_distinct", """
SELECT c_nationkey AS co_uf FROM customer UNION SELECT s_nationkey FROM supplier""")
def set_union_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return A.union_distinct([t.customer.select(F.col("c_nationkey").alias("co_uf")),
                             t.supplier.select(F.col("s_nationkey").alias("co_uf"))])


@query("set_except", """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def set_except(spark, sf_dir):
    t = Tables(spark, sf_dir)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return A.except_distinct(t.customer.select("c_custkey"), urgent)
