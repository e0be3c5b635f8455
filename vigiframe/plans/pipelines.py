"""Whole reference pipelines (R1-R10), each a lazy DataFrame plan over
domain-shaped inputs. The query layer adapts the driver tables to these shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiframe.functions import dates as D
from vigiframe.functions.scalars import (age_label, clean_text, code_prefix, decimal_comma, int_pad,
                                         nested_default, required, symbol_count, try_int, zfill)
from vigiframe.operators.columns import normalize_names, repair_headers, type_by_prefix
from vigiframe.operators.lookups import strict_lookup
from vigiframe.operators.weights import CELL_KEYS, apply_weights, join_weights, population_cells, race_weights, weight_cells
from vigiframe.sinks.publish import publish_bucketed

# Codes of the census race and sex classifications
# (source id -> published code, name).
RACES = [("2776", "1", "branca"), ("2777", "2", "preta"), ("2778", "3", "amarela"),
         ("2779", "4", "parda"), ("2780", "5", "indigena")]
SEXES = [("4", "1", "masculino"), ("5", "2", "feminino")]
CENSUS_COLUMNS = ["ano_censo", "co_municipio_ibge", "co_municipio", "co_uf", "sexo", "no_sexo", "idade",
                  "co_raca_cor", "co_raca_cor_sidra", "no_raca_cor", "pop"]
POPULATION_COLUMNS = ["co_municipio_ibge", "co_municipio", "co_uf", "ano", "sexo", "idade", "pop"]


def municipality_codes(df: DataFrame, raw: str, out: str = "co_municipio_ibge", strict: bool = True) -> DataFrame:
    """7-digit municipality code plus its 6-digit and state prefixes; a missing code
    fails the job (the reference turned it into the text "000None"), or stays null unless ``strict``."""
    code = zfill(required(raw, f"missing municipality code in {raw}") if strict else F.col(raw), 7)
    return (df.withColumn(out, code)
              .withColumn("co_municipio", code_prefix(out, 6))
              .withColumn("co_uf", code_prefix(out, 2)))


def weights(census: DataFrame) -> DataFrame:
    """Census cells -> race-weight matrix."""
    return race_weights(census)


def census(rows: DataFrame, races: DataFrame, sexes: DataFrame, year: int) -> DataFrame:
    """Tabular statistical rows (D1C municipality, D4C race id, D5C sex id,
    D6N age label, V value) -> typed census cells, with strict code lookups."""
    df = rows.select(F.lit(year).cast("short").alias("ano_censo"),
                     F.col("D1C"), F.col("D4C"), F.col("D5C"),
                     age_label("D6N").alias("idade"), symbol_count("V").alias("pop"))
    df = municipality_codes(df, "D1C")
    df = strict_lookup(df, races, "D4C", "race_id", "race code")
    df = strict_lookup(df, sexes, "D5C", "sex_id", "sex code")
    return df.select(*[F.col("D4C").alias("co_raca_cor_sidra") if c == "co_raca_cor_sidra" else F.col(c)
                       for c in CENSUS_COLUMNS])


def population(decoded: DataFrame, strict: bool = True) -> DataFrame:
    """R2: decoded fixed-width population rows (cod_mun, ano, sexo, idade, pop) -> published shape.

    A missing or unfitting value fails at once; unless ``strict`` it stays as it is, for ``sinks.publish.fit`` to judge."""
    missing = sorted({"cod_mun", "ano", "sexo", "idade", "pop"} - set(decoded.columns))
    if missing:
        raise ValueError(f"missing fields: {missing}")
    df = municipality_codes(decoded, "cod_mun", strict=strict)
    if not strict:
        return df.select("co_municipio_ibge", "co_municipio", "co_uf", "ano", "sexo", zfill(F.col("idade").cast("string"), 3).alias("idade"), "pop")
    return df.select("co_municipio_ibge", "co_municipio", "co_uf",
                     required("ano", "missing ano").cast("short").alias("ano"),
                     required("sexo", "missing sexo").cast("byte").alias("sexo"),
                     zfill(required(F.col("idade").cast("string"), "missing idade"), 3).alias("idade"),
                     required("pop", "missing pop").cast("long").alias("pop"))


def _present(path: str, fields: list[str]) -> Column:
    """A nested object counts as present when it is non-null and has any field set
    (an empty JSON object is 'absent', as it is falsy in the source rules)."""
    c = F.col(path)
    any_set = None
    for f in fields:
        x = F.col(f"{path}.{f}").isNotNull()
        any_set = x if any_set is None else any_set | x
    return c.isNotNull() & any_set


def states(doc: DataFrame, col: str = "s") -> DataFrame:
    """State documents {id, sigla, nome, regiao{id, sigla, nome}} -> flat rows.
    A missing region object gives '' in its three columns."""
    s = col
    return doc.select(int_pad(required(f"{s}.id", "state without id"), 2).alias("co_uf"),
                      nested_default(f"{s}.sigla").alias("sg_uf"), nested_default(f"{s}.nome").alias("no_uf"),
                      nested_default(f"{s}.regiao.id").alias("co_regiao"),
                      nested_default(f"{s}.regiao.sigla").alias("sg_regiao"),
                      nested_default(f"{s}.regiao.nome").alias("no_regiao"))


MUNICIPALITY_COLUMNS = [
    "co_municipio_ibge", "co_municipio", "no_municipio", "co_uf", "sg_uf", "no_uf", "co_regiao", "sg_regiao",
    "no_regiao", "co_microrregiao", "no_microrregiao", "co_mesorregiao", "no_mesorregiao", "co_regiao_imediata",
    "no_regiao_imediata", "co_regiao_intermediaria", "no_regiao_intermediaria"]


def municipalities(doc: DataFrame, col: str = "m") -> DataFrame:
    """Municipality documents -> 17 flat text columns.

    The state object is the first *present* of microrregiao.mesorregiao.UF and
    regiao-imediata.regiao-intermediaria.UF, taken whole; a municipality without a
    state id fails the job. Absent objects or keys (and JSON nulls) give ''.
    """
    m = col
    meso_uf = f"{m}.microrregiao.mesorregiao.UF"
    inter_uf = f"{m}.`regiao-imediata`.`regiao-intermediaria`.UF"
    uf_fields = ["id", "sigla", "nome", "regiao"]
    picked = doc.withColumn("_uf", F.when(_present(meso_uf, uf_fields), F.col(meso_uf)).otherwise(F.col(inter_uf)))
    code = int_pad(required(f"{m}.id", "municipality without id"), 7)
    return picked.select(
        code.alias("co_municipio_ibge"), code_prefix(code, 6).alias("co_municipio"),
        nested_default(f"{m}.nome").alias("no_municipio"),
        int_pad(required("_uf.id", "municipality without state"), 2).alias("co_uf"),
        nested_default("_uf.sigla").alias("sg_uf"), nested_default("_uf.nome").alias("no_uf"),
        nested_default("_uf.regiao.id").alias("co_regiao"), nested_default("_uf.regiao.sigla").alias("sg_regiao"),
        nested_default("_uf.regiao.nome").alias("no_regiao"),
        nested_default(f"{m}.microrregiao.id").alias("co_microrregiao"),
        nested_default(f"{m}.microrregiao.nome").alias("no_microrregiao"),
        nested_default(f"{m}.microrregiao.mesorregiao.id").alias("co_mesorregiao"),
        nested_default(f"{m}.microrregiao.mesorregiao.nome").alias("no_mesorregiao"),
        nested_default(f"{m}.`regiao-imediata`.id").alias("co_regiao_imediata"),
        nested_default(f"{m}.`regiao-imediata`.nome").alias("no_regiao_imediata"),
        nested_default(f"{m}.`regiao-imediata`.`regiao-intermediaria`.id").alias("co_regiao_intermediaria"),
        nested_default(f"{m}.`regiao-imediata`.`regiao-intermediaria`.nome").alias("no_regiao_intermediaria"))


def establishments(raw: DataFrame) -> DataFrame:
    """Header repair -> lowercase names -> dd/mm/yyyy dates typed, others text."""
    return type_by_prefix(normalize_names(repair_headers(raw)))


def neighbourhoods(raw: DataFrame, text_cols: list[str], int_cols: list[str], float_cols: list[str],
                   order: list[str]) -> DataFrame:
    """Text cleaned, integers and decimal-comma numbers typed, declared column order."""
    df = normalize_names(raw)
    sel = []
    for c in order:
        if c in text_cols:
            sel.append(clean_text(c).alias(c))
        elif c in int_cols:
            sel.append(try_int(F.nullif(F.col(c), F.lit(""))).alias(c))
        elif c in float_cols:
            sel.append(decimal_comma(F.nullif(F.col(c), F.lit(""))).alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


def calendar(days: DataFrame, col: str = "data") -> DataFrame:
    """Calendar rows for a column of days."""
    return days.select(*D.calendar_columns(col))


def estimate(population_df: DataFrame, census_df: DataFrame, top_age: int) -> DataFrame:
    """Projected totals x census race weights."""
    return apply_weights(population_df, census_df, top_age)


def estimate_bucketed(population_df: DataFrame, census_df: DataFrame, top_age: int, root: str, buckets: int) -> DataFrame:
    """R10 on published tables: population and weights stored in buckets of the join keys below ``root``, then joined
    where they lie."""
    population = publish_bucketed(population_cells(population_df, top_age), f"{root}/population_cells", CELL_KEYS, buckets)
    weights = publish_bucketed(weight_cells(census_df, top_age), f"{root}/weight_cells", CELL_KEYS, buckets)
    return join_weights(population, weights)
