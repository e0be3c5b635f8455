"""Edge rows of FIXTURES.md §2 for the scalar and date functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigiframe.functions import dates as D
from vigiframe.functions import scalars as S
from vigiframe.operators import columns as C


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def apply(spark, fn, values, typ="string"):
    return [r[0] for r in one_col(spark, values, typ).select(fn(F.col("x"))).collect()]


def test_zfill_never_cuts(spark):
    assert apply(spark, lambda c: S.zfill(c, 7), ["330455", "12345678"]) == ["0330455", "12345678"]


def test_code_prefixes(spark):
    assert apply(spark, lambda c: S.code_prefix(c, 6), ["3304557"]) == ["330455"]
    assert apply(spark, lambda c: S.code_prefix(c, 2), ["3304557"]) == ["33"]


def test_clean_text(spark):
    got = apply(spark, S.clean_text, [None, "", " ", " . ", " Centro\t"])
    assert got == [None, None, None, None, "Centro"]


def test_try_int(spark):
    assert apply(spark, S.try_int, ["12", "2.5", "x", ""]) == [12, 2, None, None]


def test_decimal_comma(spark):
    assert apply(spark, lambda c: S.decimal_comma(S.empty_null(c)), ["1,25", "1.25", "1.234,5", ""]) == \
        [1.25, 1.25, None, None]


def test_symbol_count(spark):
    assert apply(spark, S.symbol_count, ["-", "X", "...", "", "12", "3,9"]) == [0, 0, 0, 0, 12, 3]
    with pytest.raises(Exception):
        one_col(spark, [".."]).select(S.symbol_count("x")).collect()


def test_age_label(spark):
    got = apply(spark, S.age_label, ["Menos de 1 ano", "1 ano", "100 anos ou mais", "Total"])
    assert got == [0, 1, 100, 0]


def test_version_extract_and_two_digit_year(spark):
    v = apply(spark, lambda c: S.version_extract(c, r"(?i)^BASE_DE_DADOS_CNES_(\d{6})\.ZIP$"),
              ["BASE_DE_DADOS_CNES_202604.ZIP"])
    assert v == ["202604"]
    y = apply(spark, lambda c: S.two_digit_year(S.version_extract(c, r"(?i)^POPSBR(\d{2})\.zip$")), ["popsbr25.zip"])
    assert y == [2025]
    with pytest.raises(Exception):
        one_col(spark, ["POPSBR2025.zip"]).select(S.version_extract("x", r"(?i)^POPSBR(\d{2})\.zip$")).collect()


def test_nested_default_and_coalesce_path(spark):
    df = spark.createDataFrame(
        [('{"micro": null, "imed": {"UF": {"id": 33}}}',), ('{"micro": {"UF": {"id": 35}}, "imed": null}',)], "j string")
    s = df.select(F.from_json("j", "micro struct<UF: struct<id: int>>, imed struct<UF: struct<id: int>>").alias("m"))
    got = [r[0] for r in s.select(S.coalesce_path("m.micro.UF.id", "m.imed.UF.id")).collect()]
    assert got == [33, 35]
    assert [r[0] for r in s.select(S.nested_default("m.micro.UF.id")).collect()] == ["", "35"]


def test_json_period_variants(spark):
    from vigiframe.plans.q_scalars import fn_json_variants  # noqa: F401 - shape is checked by the oracle
    df = spark.createDataFrame([('{"periodos":[{"id":"2022"},2010],"periodicidade":{"fim":2022}}',),
                                ('[{"id":"x"},"2022"]',)], "p string")
    arr = F.when(F.trim("p").startswith("["), F.col("p")).otherwise(F.get_json_object("p", "$.periodos"))
    el = df.select(F.explode(F.from_json(arr, "array<string>")).alias("e"))
    ids = el.select(F.coalesce(F.get_json_object("e", "$.id"), F.col("e")).alias("v"))
    fim = df.select(F.get_json_object("p", "$.periodicidade.fim").alias("v"))
    got = sorted(r[0] for r in ids.unionByName(fim).filter(S.is_digits("v")).distinct().collect())
    assert got == ["2010", "2022"]


def test_repair_header(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["TO_CHAR(DT_ATUALIZACAO,'DD/MM/YYYY')", "to_char(a,'DD/MM/YYYY')",
                                                   "TO_CHAR(A,'YYYY')"])
    assert C.repair_headers(df).columns == ["DT_ATUALIZACAO", "a", "TO_CHAR(A,'YYYY')"]


def test_parse_br_date(spark):
    got = apply(spark, D.parse_br_date, ["01/02/2024", "1/2/2024", "30/02/2024", "2024-01-01", ""])
    assert got == [dt.date(2024, 2, 1), dt.date(2024, 2, 1), None, None, None]


@pytest.mark.parametrize("day,year,week", [
    ("2020-12-31", 2020, 53), ("2021-01-02", 2020, 53), ("2021-01-03", 2021, 1),
    ("2022-01-01", 2021, 52), ("1900-01-01", 1900, 1), ("2100-12-31", 2100, 52)])
def test_epi_week_golden(spark, day, year, week):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(D.epi_year("d").alias("y"), D.epi_week("d").alias("w")).collect()[0]
    assert (r.y, r.w) == (year, week)


def test_epi_year_start_is_sunday_on_or_before_jan4(spark):
    df = spark.range(1900, 2101).select(F.col("id").cast("int").alias("y"))
    out = df.select("y", D.epi_year_start("y").alias("s")).collect()
    for r in out:
        jan4 = dt.date(r.y, 1, 4)
        assert r.s.weekday() == 6 and 0 <= (jan4 - r.s).days <= 6


def test_calendar_golden_row_count_and_weeks(spark):
    cal = D.date_spine(spark, 1900, 2100).select(*D.calendar_columns("data"))
    assert cal.count() == 73414
    weeks = cal.groupBy("ano_epi", "semana_epi").count()
    assert weeks.filter("count <> 7 AND ano_epi BETWEEN 1901 AND 2099").count() == 0
    assert weeks.agg(F.min("semana_epi"), F.max("semana_epi")).collect()[0][:] == (1, 53)


def test_calendar_week_number_non_decreasing(spark):
    from pyspark.sql import Window
    cal = D.date_spine(spark, 1990, 2030).select(*D.calendar_columns("data"))
    w = Window.orderBy("data")
    bad = cal.withColumn("prev", F.lag("ano_semana_epi_num").over(w)).filter("ano_semana_epi_num < prev")
    assert bad.count() == 0


def test_split_list_and_membership(spark):
    got = one_col(spark, ["1, 3,,07 ,24"]).select(S.split_list("x", pad=2)).collect()[0][0]
    assert got == ["01", "03", "07", "24"]
    df = spark.createDataFrame([(1,), (2,), (24,)], "k int")
    assert [r.k for r in df.filter(C.in_text_list("k", "1, 3,,07 ,24", 2)).collect()] == [1, 24]


def test_strip_space_matches_python_strip(spark):
    values = ["\xa0Centro\t", "\x1c x \x1f", " . ", " a b　", "plain"]
    got = apply(spark, S.strip_space, values)
    assert got == [v.strip() for v in values]


def test_strict_long_fails_on_text(spark):
    assert apply(spark, lambda c: S.strict_long(c, "pop"), ["12", None]) == [12, None]
    with pytest.raises(Exception):
        one_col(spark, ["12a"]).select(S.strict_long("x", "pop")).collect()


MUN_SCHEMA = ("id int, nome string, microrregiao struct<id: int, nome: string, mesorregiao: struct<id: int, "
              "nome: string, UF: struct<id: int, sigla: string, nome: string, regiao: struct<id: int, sigla: string, "
              "nome: string>>>>, `regiao-imediata` struct<id: int, nome: string, `regiao-intermediaria`: "
              "struct<id: int, nome: string, UF: struct<id: int, sigla: string, nome: string, "
              "regiao: struct<id: int, sigla: string, nome: string>>>>")


def test_municipalities_pick_state_object(spark):
    from vigiframe.plans.pipelines import municipalities
    docs = [
        # meso UF is an empty object -> the intermediate path's UF is taken whole
        '{"id": 3304557, "nome": "Rio", "microrregiao": {"id": 33018, "nome": "M", "mesorregiao": {"id": 3306, '
        '"nome": "Meso", "UF": {}}}, "regiao-imediata": {"id": 330001, "nome": "I", "regiao-intermediaria": '
        '{"id": 3301, "nome": "In", "UF": {"id": 33, "sigla": "RJ", "nome": "Rio de Janeiro", '
        '"regiao": {"id": 3, "sigla": "SE", "nome": "Sudeste"}}}}}',
        # no microrregiao at all, region null -> ''
        '{"id": 1100015, "nome": "Alta", "microrregiao": null, "regiao-imediata": {"id": 110005, "nome": "J", '
        '"regiao-intermediaria": {"id": 1102, "nome": "K", "UF": {"id": 11, "sigla": "RO", "nome": "Rondonia", '
        '"regiao": null}}}}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "j string").select(F.from_json("j", MUN_SCHEMA).alias("m"))
    got = {r.co_municipio_ibge: r for r in municipalities(df).collect()}
    rio = got["3304557"]
    assert (rio.co_uf, rio.sg_uf, rio.no_regiao, rio.co_mesorregiao) == ("33", "RJ", "Sudeste", "3306")
    alta = got["1100015"]
    assert (alta.co_uf, alta.co_regiao, alta.co_microrregiao, alta.co_municipio) == ("11", "", "", "110001")
    bad = spark.createDataFrame([('{"id": 1, "nome": "x", "microrregiao": null, "regiao-imediata": null}',)], "j string")
    with pytest.raises(Exception):
        municipalities(bad.select(F.from_json("j", MUN_SCHEMA).alias("m"))).collect()


def test_scale_conf_partitions():
    from vigiframe.session import scale_conf
    big = scale_conf(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    small = scale_conf(10 * 2**20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
