"""Publication jobs: landed source files -> pipeline -> checks -> published reference.

One function per reference (the nine publishing scripts). Downloads are not
part of this package: a job starts from files already landed in a folder.

    python -m vigiframe.plans.jobs calendar --out /shared/referencias
    python -m vigiframe.plans.jobs population --source /landing/pop --out /shared/referencias
"""

from __future__ import annotations

import argparse
import os
import posixpath
import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.functions import dates as D
from vigiframe.functions.scalars import NO_STATE_BUCKET_POPULATION
from vigiframe.operators import quality as Q
from vigiframe.operators.sizing import code_table
from vigiframe.operators.versions import retain_latest
from vigiframe.operators.weights import GROUP_KEYS, race_weights, weight_sum_report
from vigiframe.plans import pipelines as P
from vigiframe.sinks.publish import Run, ValidationError, fingerprint, fit, live_listing, publish_if_changed, read_run, write_manifest
from vigiframe.sinks.reference import (already_published, files_there, manifest_document, open_published, publish_reference, publish_tables,
                                       register, require_clean)
from vigiframe.session import apply_job_conf, ensure_checkpoint_dir
from vigiframe.sources import files as SRC
from vigiframe.sources.fixed_width_source import header_counts, list_files, read_dbf_fields, read_fixed_width_split

# Published column layout of the census neighbourhood table.
NB_TEXT = ["cd_bairro", "nm_bairro", "cd_regiao", "nm_regiao", "cd_uf", "nm_uf", "cd_mun", "nm_mun", "cd_dist",
           "nm_dist", "cd_subdist", "nm_subdist", "cd_nu", "nm_nu", "cd_aglom", "nm_aglom", "cd_rgint", "nm_rgint",
           "cd_rgi", "nm_rgi", "cd_concurb", "nm_concurb"]
NB_INT = ["v0001", "v0002", "v0003", "v0004", "v0007"]
NB_FLOAT = ["area_km2", "v0005", "v0006"]
NB_ORDER = NB_TEXT + ["area_km2", "v0001", "v0002", "v0003", "v0004", "v0005", "v0006", "v0007"]
STATE_DOC = "id int, sigla string, nome string, regiao struct<id: int, sigla: string, nome: string>"
_REGION = "struct<id: int, sigla: string, nome: string>"
_UF = f"struct<id: int, sigla: string, nome: string, regiao: {_REGION}>"
MUNICIPALITY_DOC = (f"id int, nome string, microrregiao struct<id: int, nome: string, mesorregiao: struct<id: int, "
                    f"nome: string, UF: {_UF}>>, `regiao-imediata` struct<id: int, nome: string, "
                    f"`regiao-intermediaria`: struct<id: int, nome: string, UF: {_UF}>>")
CENSUS_ROW = "struct<D1C: string, D4C: string, D5C: string, D6N: string, V: string>"


def _schema(text: str, required: tuple[str, ...] = ()) -> T.StructType:
    """A declared schema (``name type, ...``); the required columns allow no null."""
    kinds = {"string": T.StringType, "date": T.DateType, "tinyint": T.ByteType, "smallint": T.ShortType, "bigint": T.LongType,
             "double": T.DoubleType}
    fields = [f.split() for f in text.split(", ")]
    return T.StructType([T.StructField(name, kinds[kind](), name not in required) for name, kind in fields])


# Published columns and types.
POPULATION_SCHEMA = _schema("co_municipio_ibge string, co_municipio string, co_uf string, ano smallint, sexo tinyint, idade string, pop bigint",
                            ("co_municipio_ibge", "ano", "sexo", "idade", "pop"))
CENSUS_SCHEMA = _schema("ano_censo smallint, co_municipio_ibge string, co_municipio string, co_uf string, sexo string, no_sexo string, "
                        "idade smallint, co_raca_cor string, co_raca_cor_sidra string, no_raca_cor string, pop bigint",
                        ("ano_censo", "co_municipio_ibge", "sexo", "idade", "co_raca_cor", "pop"))
MATRIX_SCHEMA = _schema("ano_censo smallint, co_municipio_ibge string, co_municipio string, co_uf string, sexo string, no_sexo string, "
                        "idade smallint, co_raca_cor string, co_raca_cor_sidra string, no_raca_cor string, pop_raca bigint, "
                        "pop_total_grupo bigint, peso_raca double")
NB_SCHEMA = _schema(", ".join(f"{c} {'string' if c in NB_TEXT else 'bigint' if c in NB_INT else 'double'}" for c in NB_ORDER))
CALENDAR_SCHEMA = _schema("data date, ano bigint, mes bigint, dia bigint, ano_epi bigint, semana_epi bigint, ano_semana_epi string, "
                          "ano_semana_epi_num bigint", ("data",))
# What the manifests say of each reference.
META = {
    "cnes_estabelecimentos": {"title": "CNES - Estabelecimentos", "municipality_filter_column": "co_municipio_gestor"},
    "uf": {"title": "IBGE - Unidades da Federacao", "source": "https://servicodados.ibge.gov.br/api/v1/localidades/estados?orderBy=nome"},
    "municipios": {"title": "IBGE - Municipios", "source": "https://servicodados.ibge.gov.br/api/v1/localidades/municipios?orderBy=nome"},
    "populacao": {"title": "IBGE/DATASUS POPSVS - Populacao", "source": "ftp://ftp.datasus.gov.br/dissemin/publicos/IBGE/POPSVS/",
                  "municipality_filter_column": "co_municipio_ibge"},
    "populacao_raca_censo": {"title": "IBGE Censo 2022 - Populacao por Raca/Cor", "source": "SIDRA IBGE v1", "source_table": "9606",
                             "source_variable": "93", "source_url": "https://apisidra.ibge.gov.br/values",
                             "municipality_filter_column": "co_municipio_ibge"},
    "matriz_pesos_raca": {"title": "IBGE Censo 2022 - Matriz de Pesos por Raca/Cor", "method": "peso_raca = pop_raca / pop_total_grupo",
                          "formula": "PopEstimada(ano,mun,sexo,idade,raca) = TotalProjetadoDATASUS(ano,mun,sexo,idade) * PesoRacaCenso2022",
                          "municipality_filter_column": "co_municipio_ibge"},
    "populacao_estimada_raca": {"title": "Populacao estimada por Raca/Cor", "formula": "total(ano,mun,sexo,idade) * peso(mun,sexo,idade,raca)",
                                "municipality_filter_column": "co_municipio_ibge"},
    "bairros_censo": {"title": "IBGE Censo 2022 - Agregados por Bairros", "main_fields": {"neighborhood_name": "nm_bairro"},
                      "update_policy": "Referencia estatica sem cron; copia mantida no repositorio."},
    "cid10": {"title": "CID-10", "update_policy": "Referencia estatica sem cron; copia mantida no repositorio."},
    "calendario_epidemiologico": {"title": "Calendario Epidemiologico",
                                  "rule": "Semanas epidemiologicas de domingo a sabado; a semana 1 e a semana que contem a maioria dos dias em janeiro."},
}


# Id and folder of each published reference (consumers find a
# reference through the registry by id, then its manifest in this folder).
LAYOUT = {
    "cnes_estabelecimentos": "cnes/estabelecimentos",
    "uf": "ibge/uf",
    "municipios": "ibge/municipios",
    "populacao": "ibge/populacao",
    "populacao_raca_censo": "ibge/populacao_raca_censo",
    "matriz_pesos_raca": "ibge/matriz_pesos_raca",
    "populacao_estimada_raca": "ibge/populacao_estimada_raca",
    "bairros_censo": "ibge/bairros_censo",
    "cid10": "saude/cid10",
    "calendario_epidemiologico": "vigilancia/calendario_epidemiologico",
}


def _ref(out: str, reference_id: str) -> str:
    return os.path.join(out, LAYOUT[reference_id])


def _registry(out: str) -> str:
    return os.path.join(out, "manifest.json")


# Fixed value: name of an establishments extract; the six digits are the version (YYYYMM).
ESTABLISHMENTS_FILE = r"(?i)^tbEstabelecimento(\d{6})\.csv$"


def latest_by_version(files: list[str], pattern: str) -> tuple[str, str] | None:
    """The one file holding the highest version in its name (versions compared as
    integers), from a listing; None when no name carries a version, an error when two files carry it."""
    found = []
    for f in files:
        m = re.search(pattern, posixpath.basename(f))
        if m:
            found.append((int(m.group(1)), m.group(1), f))
    if not found:
        return None
    highest = max(number for number, _, _ in found)
    newest = [(version, path) for number, version, path in found if number == highest]
    if len(newest) != 1:
        raise ValidationError(f"version {highest} is in {len(newest)} files: {sorted(path for _, path in newest)}")
    version, path = newest[0]
    return path, version


def parse_states(ufs: str | None) -> list[str] | None:
    """State codes of a comma list, zero-padded; None for all states."""
    if ufs is None:
        return None
    states = sorted({u.strip().zfill(2) for u in ufs.split(",") if u.strip()})
    if not states:
        raise ValidationError("empty list of states")
    return states


def establishments(spark: SparkSession, source: str, out: str, version: str | None = None,
                   name_pattern: str = ESTABLISHMENTS_FILE, force: bool = False) -> dict:
    """Semicolon latin-1 text -> repaired, typed rows -> one folder per managing state.
    Without ``version`` the newest file of ``source`` (a path or glob) is taken, its
    version read from the name."""
    if version is None:
        picked = latest_by_version(list_files(source), name_pattern)
        if picked is None:
            raise ValidationError(f"no versioned file at {source}")
        source, version = picked
    root = _ref(out, "cnes_estabelecimentos")
    if not force and already_published(os.path.join(root, "manifest.json"), version):
        return {"skipped": True, "version": version}
    rows = P.establishments(SRC.read_delimited_strict(spark, source))
    missing = {"co_estado_gestor", "co_municipio_gestor"} - set(rows.columns)
    if missing:
        raise ValidationError(f"missing columns {sorted(missing)}")
    return publish_reference(rows, root, "cnes_estabelecimentos", version, "co_estado_gestor", ["co_municipio_gestor"],
                             extra=META["cnes_estabelecimentos"], registry_path=_registry(out), schema=rows.schema)


# Fixed value: name of a yearly population file; the two digits are the year - 2000.
POPULATION_FILE = r"(?i)^POPSBR(\d{2})\.DBF$"


def population(spark: SparkSession, source_glob: str, out: str, recent_years: int = 3,
               name_pattern: str = POPULATION_FILE, start_year: int | None = None, force: bool = False) -> dict:
    """R2: fixed-width yearly files -> last ``recent_years`` years -> one folder per state.

    The years come from the file listing (catalogue): the newest ``recent_years``
    years are chosen from the names (the last listed file wins for a year) and only
    those files are decoded; when that year list is already published the run is
    skipped. Files whose names carry no year fall back to retention on the decoded
    ``ano``."""
    if recent_years < 1:
        raise ValidationError("recent_years must be >= 1")
    files = list_files(source_glob)
    if not files:
        raise ValidationError(f"no files at {source_glob}")
    by_year = {}
    for f in files:                                   # listing order: last one wins
        m = re.search(name_pattern, posixpath.basename(f))
        if m:
            by_year[2000 + int(m.group(1))] = f
    root = _ref(out, "populacao")
    if by_year:
        chosen_years = sorted(y for y in by_year if start_year is None or y >= start_year)[-recent_years:]
        if not chosen_years:
            raise ValidationError(f"no file of {start_year} or later at {source_glob}")
        chosen = [by_year[y] for y in chosen_years]
        old = manifest_document(spark, posixpath.join(root, "manifest.json")).read()
        if not force and old and sorted(old.get("years") or []) == chosen_years and files_there(spark, old):
            return {"skipped": True, "years": chosen_years}
    else:
        chosen = files
    fields = read_dbf_fields(chosen[0])
    # Declared vs whole records per file (12 header bytes each): a short tail record
    # ends a file in the source rules; the rows before it are kept and the gap reported.
    records = {}
    for f in chosen:
        declared, _, _, whole = header_counts(f)
        records[posixpath.basename(f)] = {"declared": declared, "whole": whole}
    decoded = read_fixed_width_split(spark, chosen, fields)
    if by_year:
        years = chosen_years
    else:
        decoded = retain_latest(decoded, "ano", recent_years)
        years = sorted(int(r.ano) for r in decoded.select("ano").where(F.col("ano").isNotNull()).distinct().collect())   # a handful of years
    version = f"{years[0]}-{years[-1]}" if years else ""

    def written_years(rows: DataFrame) -> dict:
        return {"years": sorted(r.ano for r in rows.select("ano").distinct().collect())}

    source_files = {str(y): posixpath.basename(by_year[y]) for y in years} if by_year else {}
    return publish_reference(P.population(decoded, strict=False), root, "populacao", version, "co_uf",
                             ["co_municipio_ibge", "ano", "sexo", "idade"],
                             extra={**META["populacao"], "records": records, "source_files": source_files}, registry_path=_registry(out),
                             schema=POPULATION_SCHEMA, blank=NO_STATE_BUCKET_POPULATION, inspect=written_years)


def latest_period(spark: SparkSession, metadata_glob: str) -> int | None:
    """Latest period id found in period metadata files (any of the three shapes)."""
    meta = spark.read.option("wholetext", True).text(metadata_glob)
    ids = meta.select(F.explode(SRC.period_ids("value")).alias("p"))
    row = ids.agg(F.max(F.col("p").cast("int"))).collect()[0]
    return row[0]


def census(spark: SparkSession, source_glob: str, out: str, year: int | None = None,
           periods_glob: str | None = None, force: bool = False, ufs: str | None = None) -> dict:
    """Tabular JSON payloads (header element first) -> typed census cells by state.
    Without ``year`` the latest period of the metadata at ``periods_glob`` is used,
    and a period already published (for the states asked for) is skipped. ``ufs`` publishes those states only."""
    states = parse_states(ufs)
    root = _ref(out, "populacao_raca_censo")
    if year is None:
        if not periods_glob:
            raise ValidationError("give year or periods_glob")
        year = latest_period(spark, periods_glob)
        if year is None:
            raise ValidationError(f"no period ids at {periods_glob}")
        if not force and already_published(posixpath.join(root, "manifest.json"), str(year), states):
            return {"skipped": True, "version": str(year)}
    payloads = spark.read.option("wholetext", True).text(source_glob).withColumnRenamed("value", "payload")
    rows = payloads.select(F.explode(SRC.rows_after_header("payload", CENSUS_ROW)).alias("r")).select("r.*")
    if states is not None:
        rows = rows.where(F.substring(F.lpad(F.col("D1C"), 7, "0"), 1, 2).isin(states))
    # Parsed once: the warnings and the write read the parsed rows again from the shared checkpoint folder.
    ensure_checkpoint_dir(spark)
    rows = rows.checkpoint()
    # Kept as the source rules do, but reported: labels with no number become age 0,
    # and "Menos de 1" also matches labels such as "Menos de 10".
    warnings = {r["check"]: int(r["failures"]) for r in Q.report(rows, {
        "age_label_has_number": F.col("D6N").rlike(r"\d") | F.col("D6N").contains("Menos de 1"),
        "age_label_not_menos_de_1x": ~F.col("D6N").rlike(r"Menos de 1\d"),
    }).collect()}
    races = code_table(spark, P.RACES, ["race_id", "co_raca_cor", "no_raca_cor"])
    sexes = code_table(spark, P.SEXES, ["sex_id", "sexo", "no_sexo"])
    return publish_reference(P.census(rows, races, sexes, year), root, "populacao_raca_censo", str(year), "co_uf",
                             ["co_municipio_ibge", "sexo", "idade", "co_raca_cor"],
                             extra={**META["populacao_raca_censo"], "warnings": warnings, "states": states}, registry_path=_registry(out),
                             schema=CENSUS_SCHEMA)


def _part_inputs(spark: SparkSession, rows: DataFrame, manifest: dict | None, key: str, parts: list[str] | None) -> dict[str, list[str]]:
    """Rows and content fingerprint of every part of an input: from its listing if it has a manifest, else from a pass
    over its rows. One entry per state."""
    if manifest is not None:
        listed = live_listing(spark, manifest["runs"])
        found = listed.groupBy("part").agg(F.sum("rows").alias("rows"), F.sum(F.col("fingerprint").cast("decimal(38,0)")).alias("fingerprint"))
    else:
        found = fingerprint(rows, sorted(rows.columns), [key]).withColumnRenamed(key, "part")
    return {r["part"]: [str(r["rows"]), str(Decimal(r["fingerprint"]).to_integral_value())] for r in found.collect() if parts is None or r["part"] in parts}


def weights(spark: SparkSession, census_dir: str, out: str, version: str | None = None, ufs: str | None = None, force: bool = False) -> dict:
    """Published census -> race-weight matrix, checked (weights of a group sum to 1).

    ``census_dir`` is the census reference (its folder, version folder or manifest, whose version is then the matrix's
    own), or a folder of files named after state codes. The manifest keeps each state's input fingerprint: only states
    whose input differs from what their published weights were made of are computed, written as a run of their own, and
    put in place of the earlier ones; a run with nothing to do is skipped. ``force`` makes all (or all ``ufs``) anew.
    """
    states = parse_states(ufs)
    apply_job_conf(spark)                       # state folders stay text ('01', not 1)
    cells, source = open_published(spark, census_dir, states)
    version = version or (source or {}).get("version")
    if not version:
        raise ValidationError(f"{census_dir} has no manifest: give the version")
    inputs = _part_inputs(spark, cells, source, "co_uf", states)
    if states is not None and set(states) - set(inputs):
        raise ValidationError(f"no census cells of states {sorted(set(states) - set(inputs))}")
    if not inputs:
        raise ValidationError(f"no census cells at {census_dir}")
    root = _ref(out, "matriz_pesos_raca")
    old = manifest_document(spark, posixpath.join(root, "manifest.json")).read() or {}
    kept = old.get("inputs") or {} if old.get("version") == version and files_there(spark, old) else {}
    changed = sorted(p for p in inputs if force or kept.get(p) != inputs[p])
    gone = sorted(set(kept) - set(inputs)) if states is None else []
    if not changed and not gone:
        return {"skipped": True, "version": version}
    left = {p: v for p, v in kept.items() if p not in changed and p not in gone}
    replaced = sorted(set(kept) - set(left))
    if not changed:                             # states were only taken away
        m = write_manifest(spark, posixpath.join(root, "manifest.json"), "matriz_pesos_raca", version, _carried(spark, old, replaced),
                           {**{k: old[k] for k in old if k not in ("files", "rows", "runs", "generated_at_utc")}, "inputs": left, "rebuilt": []})
        return m
    missing = sorted({"co_uf", "pop", *GROUP_KEYS} - set(cells.columns))
    if missing:
        raise ValidationError(f"missing columns {missing}")
    matrix = race_weights(cells.where(F.col("co_uf").isin(changed)), GROUP_KEYS)

    def sums_to_one(rows: DataFrame) -> dict:
        require_clean(weight_sum_report(rows).select(F.lit("weights_sum_to_one").alias("check"), F.col("falhas").alias("failures")))
        return {}

    return publish_reference(matrix, root, "matriz_pesos_raca", version, "co_uf", ["co_municipio_ibge", "sexo", "idade", "co_raca_cor"],
                             extra={**META["matriz_pesos_raca"], "source_reference": _source_reference(out, census_dir), "rebuilt": changed,
                                    "inputs": {**left, **{p: inputs[p] for p in changed}}},
                             registry_path=_registry(out), schema=MATRIX_SCHEMA, inspect=sums_to_one,
                             carry=lambda _: _carried(spark, old, replaced) if left else [])


def _carried(spark: SparkSession, manifest: dict, replaced: list[str]) -> list[dict]:
    """A manifest's runs without the replaced parts; runs of which nothing is left are dropped."""
    runs = [{**r, "without": sorted({*r.get("without", []), *replaced})} for r in manifest["runs"]]
    return [r for r in runs if not live_listing(spark, [r]).isEmpty()]


def _source_reference(out: str, census_dir: str) -> str:
    root = _ref(out, "populacao_raca_censo")
    return posixpath.join(root, "manifest.json") if census_dir.startswith(root) else census_dir


def estimate(spark: SparkSession, population_dir: str, census_dir: str, out: str, version: str,
             top_age: int = 80, buckets: int | None = None) -> dict:
    """Projected totals x census race weights. Census ages at or above ``top_age``
    are pooled before the weights are formed; population cells without a weight are
    kept (null estimate) and counted in the manifest, never dropped.

    With ``buckets`` both sides are published beside the estimate as tables in that many
    buckets of (municipality, sex, pooled age), and joined without a shuffle; they serve
    later joins as well."""
    apply_job_conf(spark)
    pop, _ = open_published(spark, population_dir)
    cens, _ = open_published(spark, census_dir)
    root = _ref(out, "populacao_estimada_raca")
    est = P.estimate_bucketed(pop, cens, top_age, root, buckets) if buckets else P.estimate(pop, cens, top_age)

    def unmatched(rows: DataFrame) -> dict:
        return {"unmatched_cells": rows.where(F.col("peso").isNull()).count()}

    return publish_reference(est, root, "populacao_estimada_raca", version, "co_uf",
                             ["co_municipio_ibge", "ano", "sexo", "idade"],
                             extra={**META["populacao_estimada_raca"], "top_age": top_age}, registry_path=_registry(out), schema=est.schema,
                             inspect=unmatched)


def neighbourhoods(spark: SparkSession, source: str, out: str, version: str,
                   required_key: str | None = None) -> dict:
    """Latin-1 text with decimal commas -> typed table, with a sentinel-row check."""
    nb = P.neighbourhoods(SRC.read_delimited_strict(spark, source), NB_TEXT, NB_INT, NB_FLOAT, NB_ORDER)

    def sentinel(run: Run) -> None:
        if run.rows == 0:
            raise ValidationError("no neighbourhoods")
        if required_key and read_run(spark, run.entry()).where(F.col("cd_bairro") == required_key).isEmpty():
            raise ValidationError(f"required neighbourhood {required_key} not found")

    return _single_table(nb.orderBy(F.col("cd_bairro").asc_nulls_last()), out, "bairros_censo", version, NB_SCHEMA, sentinel)


def icd10(spark: SparkSession, sources: dict[str, str], out: str, version: str = "static", columns: dict[str, list[str]] | None = None) -> dict:
    """The ICD-10 tables (chapters, groups, categories, subcategories) as text tables, each checked (rows, lower-case
    names, the ``columns`` given for it) and hashed; the manifest switches when all are written."""
    tables = {}
    for name, path in sources.items():
        table = SRC.read_csv_clean(spark, path)
        tables[name] = fit(table, T.StructType([T.StructField(c, T.StringType()) for c in table.columns]))
    files = publish_tables(tables, _ref(out, "cid10"), version, columns=columns)
    man = posixpath.join(_ref(out, "cid10"), "manifest.json")
    for name, f in files.items():
        f.update(csv_path=sources[name], parquet_path=f["path"])
    m = write_manifest(spark, man, "cid10", version, [], {**META["cid10"], "files": files, "rows": sum(f["rows"] for f in files.values())})
    register(_registry(out), "cid10", man)
    return m


def _single_table(df: DataFrame, out: str, rid: str, version: str, schema: T.StructType, check) -> dict:
    """A reference of one table: published as a new run when its content changed, and registered."""
    root = _ref(out, rid)
    man = posixpath.join(root, "manifest.json")
    m = publish_if_changed(fit(df, schema), root, rid, version, [f.name for f in schema.fields], man, META[rid], check)
    register(_registry(out), rid, man)
    return m


def states(spark: SparkSession, source: str, out: str, expected_rows: int = 27) -> dict:
    """JSON array of states -> flat table; exact row count checked."""
    df = P.states(SRC.read_json_array(spark, source, STATE_DOC).select(F.struct("*").alias("s")), "s")

    def exact(run: Run) -> None:
        if run.rows != expected_rows:
            raise ValidationError(f"expected {expected_rows} states, got {run.rows}")

    return _single_table(df.orderBy("co_uf"), out, "uf", "current", _text_schema(df), exact)


def _text_schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), False) for c in df.columns])


def municipalities(spark: SparkSession, source: str, out: str, minimum_rows: int = 5570) -> dict:
    """JSON array of municipalities -> 17 flat columns; unique codes and a minimum count."""
    df = P.municipalities(SRC.read_json_array(spark, source, MUNICIPALITY_DOC).select(F.struct("*").alias("m")), "m")

    def unique(run: Run) -> None:
        dup = Q.unique_key_failures(read_run(spark, run.entry()), ["co_municipio_ibge"]).collect()[0]
        if dup.duplicated_keys or run.rows < minimum_rows:
            raise ValidationError(f"municipalities: {dup.duplicated_keys} duplicated codes, {run.rows} rows")

    return _single_table(df.orderBy("co_municipio_ibge"), out, "municipios", "current", _text_schema(df), unique)


def calendar(spark: SparkSession, out: str, start_year: int = 1900, end_year: int = 2100) -> dict:
    """Epidemiological calendar, one row per day."""
    cal = P.calendar(D.date_spine(spark, start_year, end_year))

    def whole(run: Run) -> None:
        if run.rows == 0:
            raise ValidationError("empty calendar")

    return _single_table(cal, out, "calendario_epidemiologico", f"{start_year}-{end_year}", CALENDAR_SCHEMA, whole)


def main(argv: list[str] | None = None) -> None:
    from vigiframe.session import build_session
    ap = argparse.ArgumentParser(prog="vigiframe.plans.jobs")
    ap.add_argument("job", choices=["establishments", "population", "census", "weights", "estimate",
                                    "neighbourhoods", "icd10", "states", "municipalities", "calendar"])
    ap.add_argument("--source", help="input path or glob; icd10: name=path,name=path,...")
    ap.add_argument("--out", required=True)
    ap.add_argument("--version", default="current")
    ap.add_argument("--year", type=int, default=None)
    ap.add_argument("--periods", help="census: period metadata files (latest period is used)")
    ap.add_argument("--ufs")
    ap.add_argument("--census", help="published census folder (estimate job)")
    ap.add_argument("--top-age", type=int, default=80)
    ap.add_argument("--buckets", type=int, default=None, help="estimate: publish both sides in so many buckets and join without a shuffle")
    ap.add_argument("--recent-years", type=int, default=3, help="population: newest years to publish")
    ap.add_argument("--start-year", type=int, default=None, help="population: first year; calendar: first year (1900)")
    ap.add_argument("--end-year", type=int, default=2100, help="calendar: last year")
    ap.add_argument("--force", action="store_true", help="publish again what is published already")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    apply_job_conf(spark)
    job = a.job
    if job == "calendar":
        print(calendar(spark, a.out, a.start_year or 1900, a.end_year))
    elif job == "establishments":
        print(establishments(spark, a.source, a.out, None if a.version == "current" else a.version, force=a.force))
    elif job == "population":
        print(population(spark, a.source, a.out, a.recent_years, start_year=a.start_year, force=a.force))
    elif job == "census":
        print(census(spark, a.source, a.out, a.year, a.periods, a.force, a.ufs))
    elif job == "weights":
        print(weights(spark, a.source, a.out, None if a.version == "current" else a.version, a.ufs, a.force))
    elif job == "estimate":
        print(estimate(spark, a.source, a.census, a.out, a.version, a.top_age, a.buckets))
    elif job == "neighbourhoods":
        print(neighbourhoods(spark, a.source, a.out, a.version))
    elif job == "icd10":
        sources = dict(item.split("=", 1) for item in a.source.split(","))
        print(icd10(spark, sources, a.out))
    elif job == "states":
        print(states(spark, a.source, a.out))
    elif job == "municipalities":
        print(municipalities(spark, a.source, a.out))


if __name__ == "__main__":
    main()
