"""Golden facts from published manifests.

Point ``GOLDEN_DIR`` at a folder of published references (one ``manifest.json``
per reference, two levels down, with the source files they list); the tests
skip without it. Files are found through the manifests' own entries.
"""

import glob
import hashlib
import json
import os

import pytest

from vigiframe.sources.files import read_csv_clean

GOLDEN_DIR = os.environ.get("GOLDEN_DIR", "")

pytestmark = pytest.mark.skipif(not GOLDEN_DIR or not os.path.isdir(GOLDEN_DIR),
                                reason="set GOLDEN_DIR to a folder of published references")


def manifests():
    out = {}
    for path in glob.glob(os.path.join(GOLDEN_DIR, "*", "*", "manifest.json")):
        m = json.load(open(path))
        out[m.get("reference_id")] = m
    return out


def test_disease_code_categories_match_published_manifest(spark, tmp_path):
    entry = manifests()["cid10"]["files"]["categorias"]
    # manifest paths are relative to the folder that holds GOLDEN_DIR
    source = os.path.join(os.path.dirname(os.path.normpath(GOLDEN_DIR)), entry["csv_path"])
    if not os.path.exists(source):
        pytest.skip("source file not present")
    raw = open(source, "rb").read()
    crlf = raw.replace(b"\r\n", b"\n").replace(b"\n", b"\r\n")
    # the published hash is of the CRLF original
    assert hashlib.sha256(crlf).hexdigest() == entry["csv_sha256"]
    (tmp_path / "lf.csv").write_bytes(crlf.replace(b"\r\n", b"\n"))
    (tmp_path / "crlf.csv").write_bytes(crlf)
    results = []
    for name in ("lf.csv", "crlf.csv"):
        df = read_csv_clean(spark, str(tmp_path / name))
        assert df.columns == entry["columns"]
        assert df.count() == entry["rows"]
        results.append(sorted(tuple(r) for r in df.collect()))
    assert results[0] == results[1]
    rows = {r[0]: r for r in results[0]}
    assert rows["I48"][2] == "Flutter e fibrilação atrial"                 # leading quoted run unquoted
    assert rows["D82"][2].endswith('"major"')                              # mid-field quotes kept
    assert all("\r" not in v for r in results[0] for v in r)


def test_published_manifests_rows_add_up(spark):
    from pyspark.sql import functions as F

    from vigiframe.sources.files import manifest_files, read_manifests
    ms = read_manifests(spark, os.path.join(GOLDEN_DIR, "*", "*", "manifest.json"))
    files = manifest_files(ms)
    sums = {r.reference_id: (r.n_files, r.rows) for r in
            files.groupBy("reference_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("rows").alias("rows")).collect()}
    declared = {r.reference_id: r.rows for r in ms.select("reference_id", "rows").collect()}
    assert sums["cnes_estabelecimentos"] == (27, 615401)
    assert sums["populacao"] == (27, 2707182) and declared["populacao"] == 2707182
    assert sums["populacao_raca_censo"][1] == declared["populacao_raca_censo"] == 5625700
    assert sums["matriz_pesos_raca"][1] == declared["matriz_pesos_raca"] == 5625700
    cid = {r.part: r.rows for r in files.filter("reference_id = 'cid10'").collect()}
    assert cid == {"capitulos": 2560, "grupos": 2997, "categorias": 2045, "subcategorias": 12451}
