"""End-to-end publication jobs on small landed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from test_sources import FIELDS, _dbf
from vigiframe.plans import jobs
from vigiframe.sinks.reference import open_published, verify_published


def load(path):
    return json.load(open(path))


def test_calendar_job(spark, tmp_path):
    out = str(tmp_path / "ref")
    m = jobs.calendar(spark, out, 2020, 2021)
    assert m["rows"] == 731 and m["changed"]
    again = jobs.calendar(spark, out, 2020, 2021)
    assert again["changed"] is False
    assert "calendario_epidemiologico" in load(os.path.join(out, "manifest.json"))["references"]


def test_establishments_job(spark, tmp_path):
    src = tmp_path / "estab.csv"
    src.write_bytes(('CO_UNIDADE;"TO_CHAR(DT_ATUALIZACAO,\'DD/MM/YYYY\')";CO_ESTADO_GESTOR;CO_MUNICIPIO_GESTOR\n'
                     '1;01/02/2024;33;330455\n2;;;\n3;05/03/2024;35;355030\n').encode("latin-1"))
    out = str(tmp_path / "ref")
    m = jobs.establishments(spark, str(src), out, "202604")
    assert set(m["files"]) == {"33", "35", "sem_estado"} and m["rows"] == 3
    assert jobs.establishments(spark, str(src), out, "202604") == {"skipped": True, "version": "202604"}
    pub, _ = open_published(spark, os.path.join(out, "cnes", "estabelecimentos"))
    assert dict(pub.dtypes)["dt_atualizacao"] == "date"


def test_population_census_weights_jobs(spark, tmp_path):
    d = tmp_path / "pop"
    d.mkdir()
    for yy in (22, 23, 24, 25):
        tail = [" 33"] if yy == 25 else []
        _dbf(d / f"POPSBR{yy}.DBF", [f" 3304557{2000 + yy}1  5      120", f" 3550308{2000 + yy}2  7       80"] + tail,
             3 if yy == 25 else 2)
    out = str(tmp_path / "ref")
    m = jobs.population(spark, str(d / "*.DBF"), out)
    assert m["version"] == "2023-2025" and m["years"] == [2023, 2024, 2025] and m["rows"] == 6
    assert m["records"]["POPSBR25.DBF"] == {"declared": 3, "whole": 2}
    assert "POPSBR22.DBF" not in m["records"]                  # the oldest year is not even decoded
    assert jobs.population(spark, str(d / "*.DBF"), out) == {"skipped": True, "years": [2023, 2024, 2025]}
    c = tmp_path / "census"
    c.mkdir()
    head = '{"D1C":"Municipio (Codigo)","D4C":"Cor","D5C":"Sexo","D6N":"Idade","V":"Valor"}'
    rows = [('3304557', '2776', '4', '5 anos', '30'), ('3304557', '2779', '4', '5 anos', '10'),
            ('3304557', '2777', '4', '5 anos', '-'), ('3550308', '2776', '5', 'Menos de 1 ano', '7')]
    body = ",".join('{"D1C":"%s","D4C":"%s","D5C":"%s","D6N":"%s","V":"%s"}' % r for r in rows)
    (c / "rj.json").write_text(f"[{head},{body}]")
    (c / "empty.json").write_text(f"[{head}]")
    meta = tmp_path / "meta"
    meta.mkdir()
    (meta / "p.json").write_text('{"periodos":[{"id":"2010"},{"id":"2022"}],"periodicidade":{"fim":2022}}')
    cm = jobs.census(spark, str(c / "*.json"), out, periods_glob=str(meta / "*.json"))
    assert cm["rows"] == 4 and set(cm["files"]) == {"33", "35"}
    assert cm["warnings"]["age_label_has_number"] == 0 and cm["warnings"]["not_empty"] == 0
    assert cm["version"] == "2022"
    assert jobs.census(spark, str(c / "*.json"), out, periods_glob=str(meta / "*.json")) == \
        {"skipped": True, "version": "2022"}
    wm = jobs.weights(spark, os.path.join(out, "ibge", "populacao_raca_censo", "version=2022"), out, "2022")
    w, _ = open_published(spark, os.path.join(out, "ibge", "matriz_pesos_raca", "version=2022"))
    got = {(r.co_municipio_ibge, r.co_raca_cor): r.peso_raca for r in w.collect()}
    assert got[("3304557", "1")] == 0.75 and got[("3304557", "4")] == 0.25 and got[("3550308", "1")] == 1.0
    assert wm["rows"] == 4
    em = jobs.estimate(spark, os.path.join(out, "ibge", "populacao", "version=2023-2025"),
                       os.path.join(out, "ibge", "populacao_raca_censo", "version=2022"), out, "2025", top_age=5)
    # 3304557 sex 1 age 5 has weights (0.75/0.25 + 0 for the '-' cell); 3550308 sex 2 age 7 has none
    assert em["unmatched_cells"] == 3 and em["rows"] == 3 * 3 + 3
    est, _ = open_published(spark, os.path.join(out, "ibge", "populacao_estimada_raca"))
    got = {(r.co_municipio_ibge, r.ano, r.co_raca_cor): r.pop_estimada for r in est.collect()}
    assert got[("3304557", 2025, "1")] == 90.0 and got[("3550308", 2025, None)] is None
    reg = load(os.path.join(out, "manifest.json"))["references"]
    assert {"populacao", "populacao_raca_censo", "matriz_pesos_raca", "populacao_estimada_raca"} <= set(reg)


def test_neighbourhoods_icd_states_municipalities_jobs(spark, tmp_path):
    out = str(tmp_path / "ref")
    header = ";".join(c.upper() for c in jobs.NB_ORDER)
    vals = ["3304557001", " Centro ", "3", "Sudeste", "33", "RJ"] + ["."] * 16 + ["1,5", "10", "", "x", "2.5",
                                                                                  "0,25", "", "7"]
    (tmp_path / "nb.csv").write_bytes((header + "\n" + ";".join(vals) + "\n").encode("latin-1"))
    m = jobs.neighbourhoods(spark, str(tmp_path / "nb.csv"), out, "2022", required_key="3304557001")
    nb = spark.read.parquet(m["files"]["all"]["path"]).collect()[0]
    assert (nb.nm_bairro, nb.nm_dist, nb.area_km2, nb.v0001, nb.v0002, nb.v0003, nb.v0004, nb.v0005) == \
        ("Centro", None, 1.5, 10, None, None, 2, 0.25)
    (tmp_path / "cat.csv").write_bytes("﻿CAT;DESCRICAO;\r\nA00;Colera;\r\n".encode("utf-8"))
    icd = jobs.icd10(spark, {"categorias": str(tmp_path / "cat.csv")}, out)
    assert icd["files"]["categorias"]["columns"] == ["cat", "descricao"]
    states = [{"id": 33, "sigla": "RJ", "nome": "Rio de Janeiro", "regiao": {"id": 3, "sigla": "SE", "nome": "Sudeste"}},
              {"id": 11, "sigla": "RO", "nome": "Rondonia", "regiao": None}]
    (tmp_path / "uf.json").write_text(json.dumps(states))
    sm = jobs.states(spark, str(tmp_path / "uf.json"), out, expected_rows=2)
    uf = {r.co_uf: r for r in spark.read.parquet(sm["files"]["all"]["path"]).collect()}
    assert uf["11"].co_regiao == "" and uf["33"].sg_regiao == "SE"
    muns = [{"id": 3304557, "nome": "Rio", "microrregiao": None,
             "regiao-imediata": {"id": 330001, "nome": "I", "regiao-intermediaria": {"id": 3301, "nome": "In",
                                                                                     "UF": states[0]}}}]
    (tmp_path / "mun.json").write_text(json.dumps(muns))
    mm = jobs.municipalities(spark, str(tmp_path / "mun.json"), out, minimum_rows=1)
    row = spark.read.parquet(mm["files"]["all"]["path"]).filter(F.col("co_uf") == "33").collect()[0]
    assert (row.co_municipio, row.no_regiao, row.co_microrregiao) == ("330455", "Sudeste", "")


def test_consumer_lookup_reads_one_state(spark, tmp_path):
    from vigiframe.sinks.reference import read_reference
    src = tmp_path / "estab.csv"
    src.write_bytes(('CO_UNIDADE;CO_ESTADO_GESTOR;CO_MUNICIPIO_GESTOR\n'
                     '1;33;330455\n2;33;330010\n3;35;355030\n').encode("latin-1"))
    out = str(tmp_path / "ref")
    jobs.establishments(spark, str(src), out, "202604")
    reg = os.path.join(out, "manifest.json")
    one = read_reference(spark, reg, "cnes_estabelecimentos", part="33", municipality="330455")
    assert [r.co_unidade for r in one.collect()] == ["1"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(co_municipio_gestor,330455)" in plan
    assert read_reference(spark, reg, "cnes_estabelecimentos").count() == 3
    assert read_reference(spark, reg, "cnes_estabelecimentos", part="99").count() == 0


def test_cli_runs_a_job(spark, tmp_path, capsys):
    out = str(tmp_path / "ref")
    jobs.main(["calendar", "--out", out])          # reuses the running session
    assert "calendario_epidemiologico" in capsys.readouterr().out
    assert "calendario_epidemiologico" in load(os.path.join(out, "manifest.json"))["references"]


def test_establishments_picks_newest_version(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    body = "CO_UNIDADE;CO_ESTADO_GESTOR;CO_MUNICIPIO_GESTOR\n1;33;330455\n"
    for v in ("202512", "202604", "202603"):
        (land / f"tbEstabelecimento{v}.csv").write_bytes(body.encode("latin-1"))
    (land / "leiame.txt").write_bytes(b"x")
    out = str(tmp_path / "ref")
    m = jobs.establishments(spark, str(land / "*"), out)
    assert m["version"] == "202604"
    assert jobs.establishments(spark, str(land / "*"), out) == {"skipped": True, "version": "202604"}


CENSUS_CELLS = ("ano_censo short, co_municipio_ibge string, co_municipio string, co_uf string, sexo string, no_sexo string, idade short, "
                "co_raca_cor string, co_raca_cor_sidra string, no_raca_cor string, pop long")


def cells(spark, pops):
    rows = [(2022, f"{uf}00001", f"{uf}0000", uf, "1", "masculino", 5, str(i + 1), str(2776 + i), "r", p) for uf, ps in pops.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, CENSUS_CELLS)


def publish_census(spark, out, pops):
    from vigiframe.sinks.reference import publish_reference
    return publish_reference(cells(spark, pops), os.path.join(out, "ibge", "populacao_raca_censo"), "populacao_raca_censo", "2022", "co_uf",
                             ["co_municipio_ibge"])


def matrix(spark, out):
    rows, m = open_published(spark, os.path.join(out, "ibge", "matriz_pesos_raca"))
    return {(r.co_uf, r.co_raca_cor): r.peso_raca for r in rows.collect()}, m


def test_weights_are_rebuilt_by_state(spark, tmp_path):
    out = str(tmp_path / "ref")
    census = os.path.join(out, "ibge", "populacao_raca_censo")
    publish_census(spark, out, {"11": [3, 1], "33": [1, 1], "35": [2, 6]})
    first = jobs.weights(spark, census, out)
    assert first["version"] == "2022" and first["rebuilt"] == ["11", "33", "35"] and first["rows"] == 6
    assert first["source_reference"].endswith("populacao_raca_censo/manifest.json") and first["title"] and first["formula"]
    assert jobs.weights(spark, census, out) == {"skipped": True, "version": "2022"}
    publish_census(spark, out, {"11": [3, 1], "33": [1, 9], "35": [2, 6]})
    second = jobs.weights(spark, census, out)
    assert second["rebuilt"] == ["33"] and second["rows"] == 6 and len(second["runs"]) == 2
    assert {p: f["path"] for p, f in first["files"].items() if p != "33"} == {p: f["path"] for p, f in second["files"].items() if p != "33"}
    got, _ = matrix(spark, out)
    assert got == {("11", "1"): 0.75, ("11", "2"): 0.25, ("33", "1"): 0.1, ("33", "2"): 0.9, ("35", "1"): 0.25, ("35", "2"): 0.75}
    assert {r.status for r in verify_published(spark, os.path.join(out, "ibge", "matriz_pesos_raca", "manifest.json")).collect()} == {"ok"}
    forced = jobs.weights(spark, census, out, force=True)
    assert forced["rebuilt"] == ["11", "33", "35"] and len(forced["runs"]) == 1 and matrix(spark, out)[0] == got
    publish_census(spark, out, {"11": [3, 1], "35": [2, 6]})             # a state went
    assert jobs.weights(spark, census, out)["rebuilt"] == [] and set(k[0] for k in matrix(spark, out)[0]) == {"11", "35"}


def test_weights_of_some_states_leave_the_rest_to_do(spark, tmp_path):
    out = str(tmp_path / "ref")
    census = os.path.join(out, "ibge", "populacao_raca_censo")
    publish_census(spark, out, {"11": [3, 1], "33": [1, 1], "35": [2, 6]})
    assert jobs.weights(spark, census, out, ufs="33, 11")["rebuilt"] == ["11", "33"]
    assert jobs.weights(spark, census, out, ufs="33") == {"skipped": True, "version": "2022"}
    assert jobs.weights(spark, census, out)["rebuilt"] == ["35"] and len(matrix(spark, out)[0]) == 6
    with pytest.raises(jobs.ValidationError, match="99"):
        jobs.weights(spark, census, out, ufs="99")


def test_weights_from_state_files(spark, tmp_path):
    """The input is a folder of files named after digit-only state codes; other files are not opened."""
    land, out = tmp_path / "current", str(tmp_path / "ref")
    land.mkdir()
    for uf, pops in {"11": [3, 1], "33": [1, 1]}.items():
        cells(spark, {uf: pops}).toPandas().to_parquet(land / f"{uf}.parquet")
    (land / "resumo.parquet").write_bytes(b"not parquet")
    with pytest.raises(jobs.ValidationError, match="give the version"):
        jobs.weights(spark, str(land), out)
    assert jobs.weights(spark, str(land), out, "2022", ufs="33")["rebuilt"] == ["33"]
    assert jobs.weights(spark, str(land), out, "2022")["rebuilt"] == ["11"]
    assert jobs.weights(spark, str(land), out, "2022") == {"skipped": True, "version": "2022"}
    cells(spark, {"11": [1, 0]}).toPandas().to_parquet(land / "11.parquet")
    assert jobs.weights(spark, str(land), out, "2022")["rebuilt"] == ["11"] and matrix(spark, out)[0][("11", "1")] == 1.0


def test_weights_refuse_empty_and_unfit_input(spark, tmp_path):
    out, land = str(tmp_path / "ref"), tmp_path / "current"
    land.mkdir()
    cells(spark, {"11": [1, 1]}).drop("sexo").toPandas().to_parquet(land / "11.parquet")
    with pytest.raises(jobs.ValidationError, match="missing columns"):
        jobs.weights(spark, str(land), out, "2022")
    cells(spark, {"11": []}).toPandas().to_parquet(land / "11.parquet")
    with pytest.raises(jobs.ValidationError, match="no census cells"):
        jobs.weights(spark, str(land), out, "2022")


def test_census_of_some_states(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"D1C":"h"},{"D1C":"3304557","D4C":"2776","D5C":"4","D6N":"5 anos","V":"30"},'
                                     '{"D1C":"1100015","D4C":"2776","D5C":"4","D6N":"5 anos","V":"3"}]')
    out = str(tmp_path / "ref")
    m = jobs.census(spark, str(tmp_path / "c.json"), out, 2022, ufs="33")
    assert set(m["files"]) == {"33"} and m["rows"] == 1 and m["source_table"] == "9606"
    assert set(jobs.census(spark, str(tmp_path / "c.json"), out, 2022)["files"]) == {"11", "33"}


def test_broken_payload_fails_the_census(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"D1C":"h"},{"D1C":"33')
    with pytest.raises(Exception, match="broken JSON payload"):
        jobs.census(spark, str(tmp_path / "c.json"), str(tmp_path / "ref"), 2022)


def test_establishments_with_surplus_fields_fail(spark, tmp_path):
    src = tmp_path / "estab.csv"
    src.write_bytes(b"CO_UNIDADE;CO_ESTADO_GESTOR;CO_MUNICIPIO_GESTOR\n1;33;330455\n2;33;330455;9\n")
    with pytest.raises(Exception, match="not 3 fields"):
        jobs.establishments(spark, str(src), str(tmp_path / "ref"), "202604")
    assert not os.path.exists(tmp_path / "ref" / "cnes" / "estabelecimentos" / "manifest.json")


def test_newest_version_in_two_files_fails(spark, tmp_path):
    for name in ("tbEstabelecimento202604.csv", "TBESTABELECIMENTO202604.CSV"):
        (tmp_path / name).write_bytes(b"CO_UNIDADE;CO_ESTADO_GESTOR;CO_MUNICIPIO_GESTOR\n1;33;330455\n")
    with pytest.raises(jobs.ValidationError, match="in 2 files"):
        jobs.establishments(spark, str(tmp_path / "*"), str(tmp_path / "ref"))


def test_population_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    _dbf(tmp_path / "POPSBR25.DBF", [" 3304557 20251  5      120", " 355030820259999  7       80"], 2)
    out = str(tmp_path / "ref")
    with pytest.raises(Exception):
        jobs.population(spark, str(tmp_path / "*.DBF"), out)
    assert not os.path.exists(os.path.join(out, "ibge", "populacao", "manifest.json"))


def test_icd10_checks(spark, tmp_path):
    (tmp_path / "cat.csv").write_bytes("CAT;DESCRICAO;\r\nA00;Colera;\r\n".encode())
    (tmp_path / "none.csv").write_bytes(b"CAT;DESCRICAO;\n")
    out = str(tmp_path / "ref")
    m = jobs.icd10(spark, {"categorias": str(tmp_path / "cat.csv")}, out, columns={"categorias": ["cat", "descricao"]})
    assert len(m["files"]["categorias"]["sha256"]) == 1 and m["files"]["categorias"]["rows"] == 1 and m["title"] == "CID-10"
    with pytest.raises(jobs.ValidationError, match="columns"):
        jobs.icd10(spark, {"categorias": str(tmp_path / "cat.csv")}, out, columns={"categorias": ["cat"]})
    with pytest.raises(jobs.ValidationError, match="no rows"):
        jobs.icd10(spark, {"categorias": str(tmp_path / "none.csv")}, out)


def test_estimate_on_bucketed_tables_equals_the_plain_one(spark, tmp_path):
    from vigiframe.sinks.publish import read_table, table_document
    census = cells(spark, {"11": [3, 1], "33": [1, 1]})
    pop = spark.createDataFrame([(f"{uf}00001", f"{uf}0000", uf, 2024, 1, a, 100) for uf in ("11", "33", "35") for a in ("005", "090")],
                                "co_municipio_ibge string, co_municipio string, co_uf string, ano short, sexo byte, idade string, pop long")
    census.write.parquet(str(tmp_path / "census"))
    pop.write.parquet(str(tmp_path / "pop"))
    rows = {}
    for name, buckets in (("plain", None), ("bucketed", 4)):
        out = str(tmp_path / name)
        m = jobs.estimate(spark, str(tmp_path / "pop"), str(tmp_path / "census"), out, "2025", top_age=5, buckets=buckets)
        assert m["unmatched_cells"] == 2 and m["rows"] == 10
        published, _ = open_published(spark, os.path.join(out, "ibge", "populacao_estimada_raca"))
        rows[name] = sorted(map(str, published.collect()))
    assert rows["plain"] == rows["bucketed"]
    # Another session knows the buckets from the pointer alone.
    target = os.path.join(str(tmp_path / "bucketed"), "ibge", "populacao_estimada_raca", "weight_cells")
    entry = table_document(spark, target).read()
    assert entry["buckets"] == 4
    other = spark.newSession()
    other.sql(f"DROP TABLE vigiframe_{entry['path'].rsplit('/', 1)[1].replace('-', '_').lower()}")
    again = read_table(other, target)
    assert again.count() == 4 and "Bucketed" in again._jdf.queryExecution().executedPlan().toString()
