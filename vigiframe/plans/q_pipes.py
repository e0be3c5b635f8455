"""Queries: whole reference pipelines re-aimed at the driver tables.

Each pipeline first renders the raw source shape the reference reads (text
cells, fixed-width records, tabular or nested JSON) from a driver table with
column expressions, then runs the library pipeline on it, so the whole
scan -> repair -> type -> lookup -> publish-shape plan is exercised at scale.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vigiframe.functions import scalars as S
from vigiframe.operators import lookups as L
from vigiframe.operators.sizing import code_table, sized_broadcast
from vigiframe.operators.versions import retain_latest_years
from vigiframe.plans import pipelines as P
from vigiframe.plans.q_core import zf
from vigiframe.plans.q_scalars import DEC_SQL, dec_text
from vigiframe.plans.registry import query
from vigiframe.session import ensure_checkpoint_dir
from vigiframe.sources import files as SRC
from vigiframe.tables import Tables

# ---------------------------------------------------------------- R1 establishments


@query("pipe_establishments", """
WITH e AS (
  SELECT CAST(c_custkey AS VARCHAR) AS co_unidade,
         CASE WHEN c_nationkey = 24 THEN '' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS co_estado_gestor,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS co_municipio_gestor,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) END
           AS dt_atualizacao,
         c_name AS no_fantasia
  FROM customer)
SELECT *, coalesce(nullif(co_estado_gestor, ''), 'sem_estado') AS particao FROM e""")
def pipe_establishments(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    nat = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    raw = c.select(
        F.col("c_custkey").cast("string").alias("CO_UNIDADE"),
        F.when(F.col("c_nationkey") == 24, F.lit("")).otherwise(nat).alias("CO_ESTADO_GESTOR"),
        F.concat(nat, F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("CO_MUNICIPIO_GESTOR"),
        F.when(F.col("c_acctbal") < 0, F.lit("31/02/2021")).otherwise(F.date_format(day, "dd/MM/yyyy"))
         .alias("TO_CHAR(DT_ATUALIZACAO,'DD/MM/YYYY')"),
        F.col("c_name").alias("NO_FANTASIA"))
    est = P.establishments(raw)
    return est.withColumn("particao", S.state_bucket("co_estado_gestor"))


# ---------------------------------------------------------------- R2 population

POP_FIELDS = [SRC.Field("cod_mun", 7, "N"), SRC.Field("ano", 4, "N"), SRC.Field("sexo", 1, "N"),
              SRC.Field("idade", 3, "C"), SRC.Field("pop", 9, "N")]


def population_records(li):
    """Projected population of lineitem rows as fixed-width records (line 7 rows flagged deleted)."""
    cells = (li.groupBy("l_suppkey", F.year("l_shipdate").alias("ano"), "l_linestatus", "l_linenumber")
               .agg(F.sum(F.col("l_quantity").cast("long")).alias("pop")))
    rec = F.concat(
        F.when(F.col("l_linenumber") == 7, F.lit("*")).otherwise(F.lit(" ")),
        F.lpad(F.col("l_suppkey").cast("string"), 7, " "),
        F.col("ano").cast("string"),
        F.when(F.col("l_linestatus") == "F", F.lit("1")).otherwise(F.lit("2")),
        F.lpad(F.col("l_linenumber").cast("string"), 3, " "),
        F.lpad(F.col("pop").cast("string"), 9, " "))
    return cells.select(F.encode(rec, "ISO-8859-1").alias("rec"))


def population_published(t: Tables, recent_years: int = 3):
    """Only the newest years are decoded: a year stands for a file, and the source's file catalogue lists the years
    that hold live records. The cut is on the raw date, so the scan skips older years."""
    live = t.lineitem.filter(F.col("l_linenumber") != 7)
    li = retain_latest_years(t.lineitem, "l_shipdate", recent_years, among=live)
    return P.population(SRC.decode_records(population_records(li), "rec", POP_FIELDS))


POP_SQL = f"""
pcells AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS ano, l_linestatus, l_linenumber,
         CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS pop
  FROM lineitem GROUP BY 1, 2, 3, 4),
pkept AS (SELECT * FROM pcells WHERE l_linenumber <> 7),
popu AS (
  SELECT {zf('l_suppkey', 7)} AS co_municipio_ibge, substr({zf('l_suppkey', 7)}, 1, 6) AS co_municipio,
         substr({zf('l_suppkey', 7)}, 1, 2) AS co_uf, CAST(ano AS SMALLINT) AS ano,
         CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS TINYINT) AS sexo,
         lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS idade, pop
  FROM pkept WHERE ano >= (SELECT min(a) FROM (SELECT DISTINCT ano AS a FROM pkept ORDER BY a DESC LIMIT 3)))"""


@query("pipe_population", f"WITH {POP_SQL} SELECT * FROM popu")
def pipe_population(spark, sf_dir):
    return population_published(Tables(spark, sf_dir))


# ---------------------------------------------------------------- R3 census

def census_payloads(t: Tables):
    """Census cells as tabular JSON payloads: [header, row] per cell."""
    li = t.lineitem
    cells = (li.groupBy("l_suppkey", "l_linestatus", "l_linenumber", "l_returnflag")
               .agg(F.sum(F.col("l_quantity").cast("long")).alias("pop")))
    race = F.when(F.col("l_returnflag") == "A", F.lit("2776")).when(F.col("l_returnflag") == "N", F.lit("2777")) \
            .otherwise(F.lit("2779"))
    sex = F.when(F.col("l_linestatus") == "F", F.lit("4")).otherwise(F.lit("5"))
    n = F.col("l_linenumber")
    label = F.when(n == 1, F.lit("Menos de 1 ano")).when(n == 7, F.lit("100 anos ou mais")) \
             .otherwise(F.concat((n - 1).cast("string"), F.lit(" anos")))
    value = F.when(F.col("pop") % 13 == 0, F.lit("-")).otherwise(F.col("pop").cast("string"))
    header = F.struct(F.lit("Municipio (Codigo)").alias("D1C"), F.lit("Cor ou raca (Codigo)").alias("D4C"),
                      F.lit("Sexo (Codigo)").alias("D5C"), F.lit("Idade").alias("D6N"), F.lit("Valor").alias("V"))
    row = F.struct(F.col("l_suppkey").cast("string").alias("D1C"), race.alias("D4C"), sex.alias("D5C"),
                   label.alias("D6N"), value.alias("V"))
    return cells.select(F.to_json(F.array(header, row)).alias("payload"))


def census_published(spark, t: Tables):
    payloads = census_payloads(t)
    rows = payloads.select(F.explode(SRC.rows_after_header(
        "payload", "struct<D1C: string, D4C: string, D5C: string, D6N: string, V: string>")).alias("r")).select("r.*")
    races = code_table(spark, P.RACES, ["race_id", "co_raca_cor", "no_raca_cor"])
    sexes = code_table(spark, P.SEXES, ["sex_id", "sexo", "no_sexo"])
    return P.census(rows, races, sexes, 2022)


CENSUS_SQL = f"""
ccells AS (
  SELECT l_suppkey, l_linestatus, l_linenumber, l_returnflag, CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS pop
  FROM lineitem GROUP BY 1, 2, 3, 4),
cens AS (
  SELECT CAST(2022 AS SMALLINT) AS ano_censo, {zf('l_suppkey', 7)} AS co_municipio_ibge,
         substr({zf('l_suppkey', 7)}, 1, 6) AS co_municipio, substr({zf('l_suppkey', 7)}, 1, 2) AS co_uf,
         CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END AS sexo,
         CASE WHEN l_linestatus = 'F' THEN 'masculino' ELSE 'feminino' END AS no_sexo,
         CAST(CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber = 7 THEN 100 ELSE l_linenumber - 1 END AS SMALLINT) AS idade,
         CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '4' END AS co_raca_cor,
         CASE l_returnflag WHEN 'A' THEN '2776' WHEN 'N' THEN '2777' ELSE '2779' END AS co_raca_cor_sidra,
         CASE l_returnflag WHEN 'A' THEN 'branca' WHEN 'N' THEN 'preta' ELSE 'parda' END AS no_raca_cor,
         CAST(CASE WHEN pop % 13 = 0 THEN 0 ELSE pop END AS BIGINT) AS pop
  FROM ccells)"""


@query("pipe_census", f"WITH {CENSUS_SQL} SELECT * FROM cens")
def pipe_census(spark, sf_dir):
    return census_published(spark, Tables(spark, sf_dir))


# ---------------------------------------------------------------- R10 estimate

TOP_AGE = 5


ESTIMATE_SQL = f"""
WITH {POP_SQL}, {CENSUS_SQL},
wc AS (SELECT co_municipio_ibge AS mun, CAST(sexo AS INTEGER) AS sx, least(CAST(idade AS INTEGER), {TOP_AGE}) AS ag,
              co_raca_cor, CAST(sum(pop) AS BIGINT) AS p FROM cens GROUP BY 1, 2, 3, 4),
w AS (SELECT mun, sx, ag, co_raca_cor,
             CASE WHEN sum(p) OVER (PARTITION BY mun, sx, ag) > 0 THEN p / sum(p) OVER (PARTITION BY mun, sx, ag)
                  ELSE 0.0 END AS peso FROM wc)
SELECT popu.co_municipio_ibge, popu.ano, popu.sexo, popu.idade, popu.pop, w.co_raca_cor, w.peso,
       CAST(popu.pop AS DOUBLE) * w.peso AS pop_estimada
FROM popu LEFT JOIN w ON popu.co_municipio_ibge = w.mun AND CAST(popu.sexo AS INTEGER) = w.sx
                      AND least(CAST(popu.idade AS INTEGER), {TOP_AGE}) = w.ag"""


@query("pipe_estimate", ESTIMATE_SQL)
def pipe_estimate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pop = population_published(t)
    cens = census_published(spark, t)
    out = P.estimate(pop, cens, TOP_AGE)
    return out.select("co_municipio_ibge", "ano", "sexo", "idade", "pop", "co_raca_cor", "peso", "pop_estimada")


@query("pipe_estimate_bucketed", ESTIMATE_SQL)
def pipe_estimate_bucketed(spark, sf_dir):
    """R10 on published tables in buckets of the join keys: the join shuffles neither side."""
    t = Tables(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/estimate-{uuid.uuid4().hex}"
    out = P.estimate_bucketed(population_published(t), census_published(spark, t), TOP_AGE, root, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return out.select("co_municipio_ibge", "ano", "sexo", "idade", "pop", "co_raca_cor", "peso", "pop_estimada")


# ---------------------------------------------------------------- R5 neighbourhoods

NB_TEXT = ["cd_bairro", "nm_bairro", "cd_uf"]
NB_INT = ["v0001"]
NB_FLOAT = ["area_km2", "v0005"]
NB_ORDER = ["cd_bairro", "nm_bairro", "cd_uf", "area_km2", "v0001", "v0005"]


@query("pipe_neighbourhoods", f"""
SELECT {zf('s_suppkey', 10)} AS cd_bairro,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS nm_bairro,
       lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS cd_uf,
       try_cast({DEC_SQL.format(c='abs(s_acctbal)')} AS DOUBLE) AS area_km2,
       CASE WHEN s_nationkey = 0 THEN NULL ELSE s_suppkey * 3 END AS v0001,
       try_cast({DEC_SQL.format(c='s_acctbal')} AS DOUBLE) AS v0005
FROM supplier""")
def pipe_neighbourhoods(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    raw = s.select(
        S.zfill("s_suppkey", 10).alias("CD_BAIRRO"),
        F.when(F.col("s_acctbal") < 0, F.lit(" . ")).otherwise(F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")))
         .alias("NM_BAIRRO"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("CD_UF"),
        F.replace(F.abs("s_acctbal").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias("AREA_KM2"),
        F.when(F.col("s_nationkey") == 0, F.lit("")).otherwise((F.col("s_suppkey") * 3).cast("string")).alias("V0001"),
        dec_text("s_acctbal").alias("V0005"))
    return P.neighbourhoods(raw, NB_TEXT, NB_INT, NB_FLOAT, NB_ORDER)


# ---------------------------------------------------------------- R6 ICD-style classification

CODE_SQL = "substr(p_type, 1, 3) || '.' || substr(p_brand, 7)"


@query("pipe_classify", f"""
WITH cat AS (SELECT substr(p_type, 1, 3) AS cat, min(p_type) AS descricao_cat FROM part GROUP BY 1),
sub AS (SELECT substr(p_type, 1, 3) || substr(p_brand, 7) AS subcat, min(p_name) AS descricao_subcat FROM part GROUP BY 1)
SELECT p_partkey, {CODE_SQL} AS codigo, cat.cat, cat.descricao_cat, sub.subcat, sub.descricao_subcat
FROM part LEFT JOIN cat ON substr({CODE_SQL}, 1, 3) = cat.cat
          LEFT JOIN sub ON replace({CODE_SQL}, '.', '') = sub.subcat""")
def pipe_classify(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    cat = p.groupBy(F.substring("p_type", 1, 3).alias("cat")).agg(F.min("p_type").alias("descricao_cat"))
    sub = p.groupBy(F.concat(F.substring("p_type", 1, 3), F.expr("substring(p_brand, 7)")).alias("subcat")) \
           .agg(F.min("p_name").alias("descricao_subcat"))
    codes = p.select("p_partkey", F.concat(F.substring("p_type", 1, 3), F.lit("."),
                                           F.expr("substring(p_brand, 7)")).alias("codigo"))
    j = L.prefix_lookup(codes, "codigo", cat, "cat", 3)
    j = L.nodot_lookup(j, "codigo", sub, "subcat")
    return j.select("p_partkey", "codigo", "cat", "descricao_cat", "subcat", "descricao_subcat")


# ---------------------------------------------------------------- R7 states

STATE_SCHEMA = ("id int, sigla string, nome string, "
                "regiao struct<id: int, sigla: string, nome: string>")


@query("pipe_states", """
SELECT DISTINCT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS co_uf, 'N' || CAST(n_nationkey AS VARCHAR) AS sg_uf,
       n_name AS no_uf,
       CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE CAST(r_regionkey AS VARCHAR) END AS co_regiao,
       CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE substr(r_name, 1, 2) END AS sg_regiao,
       CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE r_name END AS no_regiao
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def pipe_states(spark, sf_dir):
    """State documents as carried by every customer record (JSON text), made
    distinct (partial aggregation) and flattened."""
    t = Tables(spark, sf_dir)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.customer.select("c_nationkey").join(sized_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    reg = F.struct(F.col("r_regionkey").alias("id"), F.substring("r_name", 1, 2).alias("sigla"),
                   F.col("r_name").alias("nome"))
    doc = F.to_json(F.struct(F.col("n_nationkey").alias("id"),
                             F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("sigla"),
                             F.col("n_name").alias("nome"),
                             F.when(F.col("n_nationkey") % 5 == 0, F.lit(None)).otherwise(reg).alias("regiao")))
    docs = c.select(doc.alias("doc")).distinct()
    return P.states(docs.select(SRC.parse_json("doc", STATE_SCHEMA).alias("s")), "s")


# ---------------------------------------------------------------- R8 municipalities

@query("pipe_municipalities", f"""
SELECT printf('%07d', c_custkey) AS co_municipio_ibge, substr(printf('%07d', c_custkey), 1, 6) AS co_municipio,
       c_name AS no_municipio, printf('%02d', n_nationkey) AS co_uf, 'N' || CAST(n_nationkey AS VARCHAR) AS sg_uf,
       n_name AS no_uf, CAST(r_regionkey AS VARCHAR) AS co_regiao, substr(r_name, 1, 2) AS sg_regiao, r_name AS no_regiao,
       CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE CAST(c_nationkey * 1000 + c_custkey % 100 AS VARCHAR) END AS co_microrregiao,
       CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE 'MICRO_' || n_name END AS no_microrregiao,
       CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE CAST(c_nationkey * 10 AS VARCHAR) END AS co_mesorregiao,
       CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE 'MESO_' || n_name END AS no_mesorregiao,
       CAST(c_nationkey * 1000 + c_custkey % 50 AS VARCHAR) AS co_regiao_imediata, 'IMED_' || n_name AS no_regiao_imediata,
       CAST(c_nationkey * 100 AS VARCHAR) AS co_regiao_intermediaria, 'INTER_' || n_name AS no_regiao_intermediaria
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def pipe_municipalities(spark, sf_dir):
    t = Tables(spark, sf_dir)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.customer.join(sized_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    reg = F.struct(F.col("r_regionkey").alias("id"), F.substring("r_name", 1, 2).alias("sigla"),
                   F.col("r_name").alias("nome"))
    uf = F.struct(F.col("n_nationkey").alias("id"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("sigla"),
                  F.col("n_name").alias("nome"), reg.alias("regiao"))
    micro = F.struct((F.col("c_nationkey") * 1000 + F.col("c_custkey") % 100).alias("id"),
                     F.concat(F.lit("MICRO_"), F.col("n_name")).alias("nome"),
                     F.struct((F.col("c_nationkey") * 10).alias("id"), F.concat(F.lit("MESO_"), F.col("n_name")).alias("nome"),
                              uf.alias("UF")).alias("mesorregiao"))
    imed = F.struct((F.col("c_nationkey") * 1000 + F.col("c_custkey") % 50).alias("id"),
                    F.concat(F.lit("IMED_"), F.col("n_name")).alias("nome"),
                    F.struct((F.col("c_nationkey") * 100).alias("id"), F.concat(F.lit("INTER_"), F.col("n_name")).alias("nome"),
                             uf.alias("UF")).alias("regiao-intermediaria"))
    doc = c.select(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
                            F.when(F.col("c_nationkey") % 5 == 0, F.lit(None)).otherwise(micro).alias("microrregiao"),
                            imed.alias("regiao-imediata")).alias("m"))
    # Round trip through JSON text, the form the source publishes.
    schema = doc.schema["m"].dataType
    return P.municipalities(doc.select(SRC.parse_json(F.to_json("m"), schema).alias("m")), "m")
