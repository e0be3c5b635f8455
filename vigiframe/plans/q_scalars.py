"""Queries: scalar text/number/code functions, projections and filters.

Driver columns hold no nulls or dirty text, so each query first derives the
dirty inputs the reference meets (blank cells, decimal commas, symbols, quoted
fields) from the table with plain expressions, then applies the operator.
DuckDB notes: string->bigint casts round, so integer text is matched by regex.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigiframe.functions import scalars as S
from vigiframe.operators import columns as C
from vigiframe.plans.q_core import BR_TEXT_SQL, br_text, zf
from vigiframe.plans.registry import query
from vigiframe.tables import Tables


def dec_text(c):
    """Decimal text with two places, identical in Spark and DuckDB."""
    return F.col(c).cast("decimal(12,2)").cast("string")


DEC_SQL = "CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"


@query("fn_zfill", f"""
SELECT c_custkey, {zf('c_custkey', 7)} AS cod7, {zf('c_custkey * 100000', 7)} AS cod_longo FROM customer""")
def fn_zfill(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", S.zfill("c_custkey", 7).alias("cod7"),
                    S.zfill(F.col("c_custkey") * 100000, 7).alias("cod_longo"))


@query("fn_int_pad", """
SELECT c_custkey, printf('%07d', c_custkey) AS co_municipio, printf('%02d', c_nationkey) AS co_uf FROM customer""")
def fn_int_pad(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", S.int_pad("c_custkey", 7).alias("co_municipio"),
                    S.int_pad("c_nationkey", 2).alias("co_uf"))


@query("fn_code_prefix", f"""
WITH m AS (SELECT c_custkey, {zf('c_nationkey * 100000 + c_custkey', 7)} AS co_municipio_ibge FROM customer)
SELECT c_custkey, co_municipio_ibge, substr(co_municipio_ibge, 1, 6) AS co_municipio,
       substr(co_municipio_ibge, 1, 2) AS co_uf FROM m""")
def fn_code_prefix(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    m = c.select("c_custkey", S.zfill(F.col("c_nationkey") * 100000 + F.col("c_custkey"), 7)
                 .alias("co_municipio_ibge"))
    return m.select("c_custkey", "co_municipio_ibge", S.code_prefix("co_municipio_ibge", 6).alias("co_municipio"),
                    S.code_prefix("co_municipio_ibge", 2).alias("co_uf"))


DIRTY_NAME_SQL = ("CASE WHEN p_size <= 10 THEN ' . ' WHEN p_size <= 20 THEN '' "
                  "WHEN p_size <= 30 THEN '  ' || p_name || chr(9) WHEN p_size <= 40 THEN ' ' "
                  "ELSE p_name END")


def dirty_name():
    s = F.col("p_size")
    return (F.when(s <= 10, F.lit(" . ")).when(s <= 20, F.lit(""))
             .when(s <= 30, F.concat(F.lit("  "), F.col("p_name"), F.lit("\t")))
             .when(s <= 40, F.lit(" ")).otherwise(F.col("p_name")))


@query("fn_clean_text", f"""
WITH t AS (SELECT p_partkey, {DIRTY_NAME_SQL} AS bruto FROM part),
c AS (SELECT p_partkey, bruto, regexp_replace(bruto, '^\\s+|\\s+$', '', 'g') AS x FROM t)
SELECT p_partkey, bruto, CASE WHEN x IN ('', '.') THEN NULL ELSE x END AS limpo FROM c""")
def fn_clean_text(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    t = p.select("p_partkey", dirty_name().alias("bruto"))
    return t.select("p_partkey", "bruto", S.clean_text("bruto").alias("limpo"))


NUM_TEXT_SQL = f"""CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 2000 THEN {DEC_SQL.format(c='c_acctbal')}
  WHEN c_acctbal < 4000 THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)
  WHEN c_acctbal < 6000 THEN 'x' ELSE replace({DEC_SQL.format(c='c_acctbal')}, '.', ',') END"""


def num_text():
    b = F.col("c_acctbal")
    return (F.when(b < 0, F.lit("")).when(b < 2000, dec_text("c_acctbal"))
             .when(b < 4000, F.floor(b).cast("long").cast("string"))
             .when(b < 6000, F.lit("x")).otherwise(F.replace(dec_text("c_acctbal"), F.lit("."), F.lit(","))))


@query("fn_try_int", f"""
WITH t AS (SELECT c_custkey, {NUM_TEXT_SQL} AS texto FROM customer)
SELECT c_custkey, texto,
       CASE WHEN regexp_full_match(texto, '[+-]?[0-9]+') THEN try_cast(texto AS BIGINT)
            ELSE CAST(trunc(try_cast(texto AS DOUBLE)) AS BIGINT) END AS valor
FROM t""")
def fn_try_int(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    t = c.select("c_custkey", num_text().alias("texto"))
    return t.select("c_custkey", "texto", S.try_int("texto").alias("valor"))


BAL_TEXT_SQL = f"""CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '-' WHEN 3 THEN '...'
  ELSE replace({DEC_SQL.format(c='c_acctbal')}, '.', ',') END"""


def bal_text():
    k = F.col("c_custkey") % 10
    return (F.when(k == 0, F.lit("")).when(k == 1, F.lit("x")).when(k == 2, F.lit("-"))
             .when(k == 3, F.lit("...")).otherwise(F.replace(dec_text("c_acctbal"), F.lit("."), F.lit(","))))


@query("fn_decimal_comma", f"""
WITH t AS (SELECT c_custkey, {BAL_TEXT_SQL} AS texto FROM customer)
SELECT c_custkey, texto, try_cast(replace(nullif(texto, ''), ',', '.') AS DOUBLE) AS valor FROM t""")
def fn_decimal_comma(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    t = c.select("c_custkey", bal_text().alias("texto"))
    return t.select("c_custkey", "texto", S.decimal_comma(S.empty_null("texto")).alias("valor"))


@query("fn_empty_null", f"""
SELECT p_partkey, nullif({DIRTY_NAME_SQL}, '') AS nome FROM part""")
def fn_empty_null(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", S.empty_null(dirty_name()).alias("nome"))


SYM_TEXT_SQL = f"""CASE o_orderkey % 5 WHEN 0 THEN '-' WHEN 1 THEN 'X' WHEN 2 THEN '...' WHEN 3 THEN ''
  ELSE replace({DEC_SQL.format(c='o_totalprice')}, '.', ',') END"""


def sym_text():
    k = F.col("o_orderkey") % 5
    return (F.when(k == 0, F.lit("-")).when(k == 1, F.lit("X")).when(k == 2, F.lit("..."))
             .when(k == 3, F.lit("")).otherwise(F.replace(dec_text("o_totalprice"), F.lit("."), F.lit(","))))


@query("fn_symbol_count", f"""
WITH t AS (SELECT o_orderkey, {SYM_TEXT_SQL} AS v FROM orders)
SELECT o_orderkey, v, CASE WHEN v IN ('-', 'X', '...', '') THEN CAST(0 AS BIGINT)
                           ELSE CAST(trunc(CAST(replace(v, ',', '.') AS DOUBLE)) AS BIGINT) END AS pop
FROM t""")
def fn_symbol_count(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    t = o.select("o_orderkey", sym_text().alias("v"))
    return t.select("o_orderkey", "v", S.symbol_count("v").alias("pop"))


AGE_LABEL_SQL = ("CASE WHEN p_size = 1 THEN 'Menos de 1 ano' WHEN p_size = 50 THEN '100 anos ou mais' "
                 "WHEN p_size = 2 THEN 'Total' ELSE CAST(p_size AS VARCHAR) || ' anos' END")


def age_text():
    s = F.col("p_size")
    return (F.when(s == 1, F.lit("Menos de 1 ano")).when(s == 50, F.lit("100 anos ou mais"))
             .when(s == 2, F.lit("Total")).otherwise(F.concat(s.cast("string"), F.lit(" anos"))))


@query("fn_age_label", f"""
WITH t AS (SELECT p_partkey, {AGE_LABEL_SQL} AS rotulo FROM part)
SELECT p_partkey, rotulo,
       CAST(CASE WHEN contains(rotulo, 'Menos de 1') THEN 0 WHEN contains(rotulo, '100 anos') THEN 100
            ELSE coalesce(try_cast(nullif(regexp_extract(rotulo, '(\\d+)', 1), '') AS INTEGER), 0) END AS SMALLINT) AS idade
FROM t""")
def fn_age_label(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    t = p.select("p_partkey", age_text().alias("rotulo"))
    return t.select("p_partkey", "rotulo", S.age_label("rotulo").alias("idade"))


PROPS_SQL = """CASE WHEN event_type = 'error' THEN '{"k": null}' ELSE props END"""


@query("fn_nested_default", f"""
WITH t AS (SELECT event_id, {PROPS_SQL} AS p FROM events)
SELECT event_id, coalesce(json_extract_string(p, '$.k'), '') AS k,
       coalesce(json_extract_string(p, '$.m.a'), '') AS m_a FROM t""")
def fn_nested_default(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    p = F.when(F.col("event_type") == "error", F.lit('{"k": null}')).otherwise(F.col("props"))
    t = e.select("event_id", F.from_json(p, "k int, m struct<a: string>").alias("j"))
    return t.select("event_id", S.nested_default("j.k").alias("k"), S.nested_default("j.m.a").alias("m_a"))


@query("fn_coalesce_path", f"""
SELECT c_custkey,
       {zf('coalesce(CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END, n_nationkey + 50)', 2)} AS co_uf,
       coalesce(CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE n_name END, 'IMEDIATA_' || n_name) AS no_uf
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def fn_coalesce_path(spark, sf_dir):
    from vigiframe.operators.sizing import sized_broadcast
    t = Tables(spark, sf_dir)
    c = t.customer.join(sized_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    uf_a = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nome"))
    uf_b = F.struct((F.col("n_nationkey") + 50).alias("id"), F.concat(F.lit("IMEDIATA_"), F.col("n_name")).alias("nome"))
    nested = c.select("c_custkey",
                      F.when(F.col("c_nationkey") % 5 == 0, F.lit(None))
                       .otherwise(F.struct(uf_a.alias("UF"))).alias("microrregiao"),
                      F.struct(F.struct(uf_b.alias("UF")).alias("regiao_intermediaria")).alias("regiao_imediata"))
    return nested.select(
        "c_custkey",
        S.zfill(S.coalesce_path("microrregiao.UF.id", "regiao_imediata.regiao_intermediaria.UF.id"), 2).alias("co_uf"),
        S.coalesce_path("microrregiao.UF.nome", "regiao_imediata.regiao_intermediaria.UF.nome").alias("no_uf"))


@query("dq_required", """
SELECT CAST(count(*) AS BIGINT) AS linhas,
       CAST(count(*) FILTER (WHERE nullif(o_orderpriority, '5-LOW') IS NULL) AS BIGINT) AS falhas FROM orders""")
def dq_required(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    v = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return o.agg(F.count(F.lit(1)).alias("linhas"), F.count_if(v.isNull() | (v == "")).alias("falhas"))


@query("fn_version_extract", """
WITH t AS (SELECT o_orderkey, 'BASE_DE_DADOS_CNES_' || strftime(o_orderdate, '%Y%m') || '.ZIP' AS nome FROM orders)
SELECT o_orderkey, nome, regexp_extract(nome, '^BASE_DE_DADOS_CNES_([0-9]{6})\\.ZIP$', 1) AS versao FROM t""")
def fn_version_extract(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    t = o.select("o_orderkey", F.concat(F.lit("BASE_DE_DADOS_CNES_"), F.date_format("o_orderdate", "yyyyMM"),
                                        F.lit(".ZIP")).alias("nome"))
    return t.select("o_orderkey", "nome",
                    S.version_extract("nome", r"(?i)^BASE_DE_DADOS_CNES_(\d{6})\.ZIP$").alias("versao"))


@query("fn_two_digit_year", """
WITH t AS (SELECT o_orderkey, 'POPSBR' || strftime(o_orderdate + INTERVAL 30 YEAR, '%y') || '.zip' AS nome FROM orders)
SELECT o_orderkey, nome, CAST(2000 + CAST(regexp_extract(nome, '^POPSBR([0-9]{2})\\.zip$', 1) AS INTEGER) AS INTEGER) AS ano
FROM t""")
def fn_two_digit_year(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.add_months(F.col("o_orderdate").cast("date"), 360)
    t = o.select("o_orderkey", F.concat(F.lit("POPSBR"), F.date_format(d, "yy"), F.lit(".zip")).alias("nome"))
    yy = S.version_extract("nome", r"(?i)^POPSBR(\d{2})\.zip$")
    return t.select("o_orderkey", "nome", S.two_digit_year(yy).alias("ano"))


@query("fn_latin1", """
SELECT c_custkey, nullif(trim(CASE WHEN c_acctbal < 0 THEN '   ' ELSE '  ' || c_name || ' ção ' END), '') AS texto
FROM customer""")
def fn_latin1(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    raw = F.when(F.col("c_acctbal") < 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" ção ")))
    b = c.select("c_custkey", F.encode(raw, "ISO-8859-1").alias("bytes"))
    return b.select("c_custkey", S.latin1_text("bytes").alias("texto"))


PAYLOAD_SQL = """CASE WHEN event_type = 'click'
    THEN '{"periodos":[{"id":"' || k || '"},' || (k + 1) || '],"periodicidade":{"fim":' || (k + 2) || '}}'
  WHEN event_type = 'view' THEN '[{"id":"' || k || '"},"x' || k || '"]'
  ELSE '["' || k || '"]' END"""


def payload():
    k = F.get_json_object("props", "$.k").cast("int").cast("string")
    k1 = (F.get_json_object("props", "$.k").cast("int") + 1).cast("string")
    k2 = (F.get_json_object("props", "$.k").cast("int") + 2).cast("string")
    return (F.when(F.col("event_type") == "click",
                   F.concat(F.lit('{"periodos":[{"id":"'), k, F.lit('"},'), k1, F.lit('],"periodicidade":{"fim":'),
                            k2, F.lit("}}")))
             .when(F.col("event_type") == "view", F.concat(F.lit('[{"id":"'), k, F.lit('"},"x'), k, F.lit('"]')))
             .otherwise(F.concat(F.lit('["'), k, F.lit('"]'))))


@query("fn_json_variants", f"""
WITH src AS (SELECT event_id, {PAYLOAD_SQL} AS p
             FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
arr AS (SELECT event_id, p, CASE WHEN starts_with(trim(p), '[') THEN p ELSE json_extract(p, '$.periodos') END AS a FROM src),
el AS (SELECT event_id, unnest(json_extract(a, '$[*]')) AS e FROM arr),
ids AS (SELECT event_id, coalesce(json_extract_string(e, '$.id'), json_extract_string(e, '$')) AS periodo FROM el
        UNION ALL SELECT event_id, json_extract_string(p, '$.periodicidade.fim') FROM arr)
SELECT DISTINCT event_id, periodo FROM ids WHERE regexp_full_match(periodo, '[0-9]+')""")
def fn_json_variants(spark, sf_dir):
    from vigiframe.sources.files import period_ids
    e = Tables(spark, sf_dir).events
    src = e.select("event_id", payload().alias("p"))
    return src.select("event_id", F.explode(period_ids("p")).alias("periodo")).distinct()


@query("fn_split_list", """
WITH t AS (SELECT p_partkey, CAST(p_size AS VARCHAR) || ', ,' || CAST(p_size % 7 AS VARCHAR) || ' ,' AS lista FROM part),
l AS (SELECT p_partkey, list_transform(list_filter(list_transform(string_split(lista, ','), lambda x: trim(x)),
                                                  lambda x: x <> ''),
                                      lambda x: lpad(x, CAST(greatest(2, length(x)) AS INTEGER), '0')) AS itens FROM t)
SELECT p_partkey, CAST(generate_subscripts(itens, 1) AS INTEGER) AS posicao, unnest(itens) AS item FROM l""")
def fn_split_list(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    t = p.select("p_partkey", F.concat(F.col("p_size").cast("string"), F.lit(", ,"),
                                       (F.col("p_size") % 7).cast("string"), F.lit(" ,")).alias("lista"))
    x = t.select("p_partkey", F.posexplode(S.split_list("lista", pad=2)).alias("pos", "item"))
    return x.select("p_partkey", (F.col("pos") + 1).cast("int").alias("posicao"), "item")


@query("fn_sha256", "SELECT doc_id, sha256(text) AS hash FROM documents")
def fn_sha256(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", S.sha256("text").alias("hash"))


# ---------------------------------------------------------------- projections


@query("prj_normalize_names", "SELECT * FROM part")
def prj_normalize_names(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    raw = p.toDF(*[f"  {c.upper()} " for c in p.columns])
    return C.normalize_names(raw)


@query("prj_repair_header", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS CO_PEDIDO, {BR_TEXT_SQL} AS DT_PEDIDO, o_orderstatus AS st_pedido,
       strftime(o_orderdate, '%d/%m/%Y') AS "TO_CHAR(A,'YYYY')" FROM orders""")
def prj_repair_header(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = o.select(F.col("o_orderkey").cast("string").alias("CO_PEDIDO"),
                   br_text().alias("to_char(DT_PEDIDO,'DD/MM/YYYY')"),
                   F.col("o_orderstatus").alias("st_pedido"),
                   F.date_format("o_orderdate", "dd/MM/yyyy").alias("TO_CHAR(A,'YYYY')"))
    return C.repair_headers(raw)


@query("prj_drop_blank", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def prj_drop_blank(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    raw = c.select("c_custkey", F.lit("").alias(" "), "c_name", F.lit("").alias("_c3"), "c_nationkey",
                   F.lit("").alias("Unnamed: 5"))
    return C.drop_blank_names(raw)


@query("prj_select", "SELECT s_nationkey, s_name, s_suppkey FROM supplier")
def prj_select(spark, sf_dir):
    return C.select_columns(Tables(spark, sf_dir).supplier, ["s_nationkey", "s_name", "s_suppkey"])


@query("prj_rename", """
SELECT s_suppkey AS co_fornecedor, s_name AS no_fornecedor, s_nationkey AS co_uf, s_acctbal FROM supplier""")
def prj_rename(spark, sf_dir):
    return C.rename(Tables(spark, sf_dir).supplier,
                    {"s_suppkey": "co_fornecedor", "s_name": "no_fornecedor", "s_nationkey": "co_uf"})


@query("prj_type_by_prefix", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS co_pedido, CAST(try_strptime(nullif({BR_TEXT_SQL}, ''), '%d/%m/%Y') AS DATE) AS dt_pedido,
       CAST(try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS dt_registro,
       CAST(o_custkey AS VARCHAR) AS co_cliente FROM orders""")
def prj_type_by_prefix(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = o.select(F.col("o_orderkey").cast("string").alias("co_pedido"), br_text().alias("dt_pedido"),
                   F.date_format("o_orderdate", "dd/MM/yyyy").alias("dt_registro"),
                   F.col("o_custkey").alias("co_cliente"))
    return C.type_by_prefix(raw)


# ---------------------------------------------------------------- filters


@query("flt_regex", "SELECT p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '(?i)(small|RED) .*')")
def flt_regex(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    return C.regex_filter(p, "p_name", "(small|RED) .*")


@query("flt_min_year", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders WHERE year(o_orderdate) >= 1998""")
def flt_min_year(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    # Range on the raw column (not year(col)) so the bound reaches the parquet scan.
    since = F.make_timestamp_ntz(F.lit(1998), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return o.filter(F.col("o_orderdate") >= since).select("o_orderkey", F.year("o_orderdate").alias("ano"))


@query("flt_in_list", """
SELECT c_custkey, c_nationkey FROM customer WHERE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') IN ('01', '03', '07', '24')""")
def flt_in_list(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey")
    return c.filter(C.in_text_list("c_nationkey", "1, 3,,07 ,24", 2))


@query("flt_not_deleted", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE (CASE o_orderstatus WHEN 'P' THEN '*' ELSE ' ' END) <> '*'""")
def flt_not_deleted(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    flag = F.when(F.col("o_orderstatus") == "P", F.lit("*")).otherwise(F.lit(" "))
    return o.select("o_orderkey", "o_orderstatus").filter(C.not_deleted(flag))


@query("flt_digits", """
WITH t AS (SELECT doc_id, CASE lang WHEN 'en' THEN substr(source, 4) ELSE source END AS stem FROM documents)
SELECT doc_id, stem FROM t WHERE regexp_full_match(stem, '[0-9]+')""")
def flt_digits(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    t = d.select("doc_id", F.when(F.col("lang") == "en", F.expr("substring(source, 4)"))
                 .otherwise(F.col("source")).alias("stem"))
    return t.filter(S.is_digits("stem"))
