"""Sources on small files written in a temporary folder (FIXTURES.md §2 S1-S3, S8, S10, S11)."""

import json
import os
import struct

from pyspark.sql import functions as F

from vigiframe.sources import files as SRC


def test_delimited_latin1_quotes_and_empties(spark, tmp_path):
    p = tmp_path / "estab.csv"
    text = ('CO_UNIDADE;NO_FANTASIA;"TO_CHAR(DT_ATUALIZACAO,\'DD/MM/YYYY\')";CO_ESTADO_GESTOR\n'
            '1;"Posto; Saúde";01/02/2024;33\n'
            '2;"Linha\nquebrada";;\n'
            '3;Clínica "Boa" Vida;31/02/2024;35\n')
    p.write_bytes(text.encode("latin-1"))
    df = SRC.read_delimited(spark, str(p))
    got = {r.CO_UNIDADE: r for r in df.collect()}
    assert got["1"]["NO_FANTASIA"] == "Posto; Saúde"
    assert got["2"]["NO_FANTASIA"] == "Linha\nquebrada"
    assert got["2"]["CO_ESTADO_GESTOR"] == ""          # empty kept as '', not null
    from vigiframe.plans.pipelines import establishments
    est = {r.co_unidade: r for r in establishments(df).collect()}
    assert str(est["1"].dt_atualizacao) == "2024-02-01"
    assert est["3"].dt_atualizacao is None and est["2"].dt_atualizacao is None


def _icd_bytes(eol: str) -> bytes:
    lines = ["CAT;CLASSIF;DESCRICAO;DESCRABREV;REFER;EXCLUIDOS;",
             'I48;;"Flutter" e fib;Flutter;;;',
             'A00;;Colera;Colera;;;']
    return ("﻿" + eol.join(lines) + eol).encode("utf-8")


def test_csv_clean_same_from_lf_and_crlf(spark, tmp_path):
    outs = []
    for eol, name in (("\n", "lf.csv"), ("\r\n", "crlf.csv")):
        p = tmp_path / name
        p.write_bytes(_icd_bytes(eol))
        df = SRC.read_csv_clean(spark, str(p))
        assert df.columns == ["cat", "classif", "descricao", "descrabrev", "refer", "excluidos"]
        outs.append(sorted(tuple(r) for r in df.collect()))
    assert outs[0] == outs[1]
    row = [r for r in outs[0] if r[0] == "I48"][0]
    assert row[2] == "Flutter e fib" and row[1] == ""


FIELDS = [SRC.Field("cod_mun", 7, "N"), SRC.Field("ano", 4, "N"), SRC.Field("sexo", 1, "N"),
          SRC.Field("idade", 3, "C"), SRC.Field("pop", 9, "N")]


def _dbf(path, records, declared):
    rec_len = 1 + sum(f.length for f in FIELDS)
    hdr_len = 32 + 32 * len(FIELDS) + 1
    head = bytearray(32)
    head[0] = 3
    head[4:8] = struct.pack("<I", declared)
    head[8:10] = struct.pack("<H", hdr_len)
    head[10:12] = struct.pack("<H", rec_len)
    desc = b""
    for f in FIELDS:
        d = bytearray(32)
        d[0:len(f.name)] = f.name.upper().encode()
        d[11] = ord(f.kind)
        d[16] = f.length
        desc += bytes(d)
    body = b"".join(r.encode("latin-1") for r in records)
    path.write_bytes(bytes(head) + desc + b"\r" + body)


def test_fixed_width_deleted_blank_and_short_tail(spark, tmp_path):
    d = tmp_path / "pop"
    d.mkdir()
    recs = [" 3304557" + "2024" + "1" + "  5" + "      120",
            "*3304557" + "2024" + "2" + "  5" + "       99",      # deleted
            " 3304557" + "2024" + "2" + "   " + "       80",      # blank text -> null
            " 33045"]                                             # short tail record
    _dbf(d / "POPSBR24.DBF", recs, declared=4)
    df = SRC.read_fixed_width(spark, str(d), FIELDS)
    got = sorted((r.cod_mun, r.ano, r.sexo, r.idade, r.pop) for r in df.collect())
    assert got == [(3304557, 2024, 1, "5", 120), (3304557, 2024, 2, None, 80)]
    c = SRC.fixed_width_counts(spark, str(d)).collect()[0]
    assert (c.n_header, c.n_whole) == (4, 3)


def test_state_files_digit_stems(spark, tmp_path):
    d = tmp_path / "current"
    for stem in ("33", "35", "manifest"):
        spark.createDataFrame([(stem, 1)], "v string, n int").coalesce(1).write.parquet(str(tmp_path / f"tmp_{stem}"))
        part = [f for f in os.listdir(tmp_path / f"tmp_{stem}") if f.endswith(".parquet")][0]
        d.mkdir(exist_ok=True)
        os.replace(tmp_path / f"tmp_{stem}" / part, d / f"{stem}.parquet")
    df = SRC.read_state_files(spark, str(d))
    assert sorted(r.co_uf for r in df.select("co_uf").collect()) == ["33", "35"]


def test_manifests_with_both_file_shapes(spark, tmp_path):
    m1 = {"reference_id": "populacao", "version": "2023-2025", "years": [2023, 2024, 2025], "rows": 5,
          "files": {"33": {"path": "a/33.parquet", "sha256": "ab", "rows": 3},
                    "35": {"path": "a/35.parquet", "sha256": "cd", "rows": 2}}}
    m2 = {"reference_id": "cid10", "files": {"categorias": {"csv_path": "x.csv", "parquet_path": "x.parquet",
                                                            "columns": ["cat"]}}}
    (tmp_path / "m1.json").write_text(json.dumps(m1, indent=2))
    (tmp_path / "m2.json").write_text(json.dumps(m2, indent=2))
    ms = SRC.read_manifests(spark, str(tmp_path / "*.json"))
    files = SRC.manifest_files(ms)
    got = sorted((r.reference_id, r.part, r.rows) for r in files.collect())
    assert got == [("cid10", "categorias", None), ("populacao", "33", 3), ("populacao", "35", 2)]


def test_catalog_versions(spark, tmp_path):
    for name in ("POPSBR23.zip", "popsbr24.ZIP", "POPSBR2025.zip", "LEIAME.txt"):
        (tmp_path / name).write_bytes(b"x")
    listing = SRC.list_files(spark, str(tmp_path))
    cat = SRC.catalog_versions(listing, "name", r"POPSBR(\d{2})\.zip")
    assert sorted((r.name, r.version) for r in cat.collect()) == [("POPSBR23.zip", "23"), ("popsbr24.ZIP", "24")]


def test_tabular_json_skips_header(spark):
    df = spark.createDataFrame([('[{"V":"Valor"},{"V":"12"},{"V":"-"}]',), ('[{"V":"Valor"}]',)], "p string")
    got = [r.v for r in df.select(F.explode(SRC.rows_after_header("p", "struct<V: string>")).alias("r"))
           .select(F.col("r.V").alias("v")).collect()]
    assert got == ["12", "-"]


def test_split_fixed_width_reader_matches(spark, tmp_path):
    from vigiframe.sources.fixed_width_source import read_fixed_width_split
    d = tmp_path / "pop2"
    d.mkdir()
    recs = []
    for i in range(1000):
        flag = "*" if i % 97 == 0 else " "
        recs.append(flag + f"{3300000 + i % 13:7d}" + "2024" + str(1 + i % 2) + f"{i % 90:3d}" + f"{i:9d}")
    _dbf(d / "A.DBF", recs + [" 33"], declared=1001)
    a = SRC.read_fixed_width(spark, str(d), FIELDS)
    b = read_fixed_width_split(spark, str(d), FIELDS, records_per_partition=128)
    assert b.rdd.getNumPartitions() >= 7
    assert a.count() == b.count() == 1000 - len([i for i in range(1000) if i % 97 == 0])
    assert a.drop("path").exceptAll(b.drop("path")).count() == 0


def test_dbf_field_list_from_header(tmp_path):
    from vigiframe.sources.fixed_width_source import read_dbf_fields
    _dbf(tmp_path / "X.DBF", [" 3304557" + "2024" + "1" + "  5" + "      120"], declared=1)
    assert read_dbf_fields(str(tmp_path / "X.DBF")) == FIELDS


def test_fixed_width_file_without_records(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    _dbf(d / "E.DBF", [], declared=0)
    assert SRC.read_fixed_width(spark, str(d), FIELDS).count() == 0


def test_uri_round_trip():
    from vigiframe.sources.fixed_width_source import _uri
    assert _uri("/data/pop/*.DBF", "/data/pop/A.DBF") == "/data/pop/A.DBF"
    assert _uri("file:///data/pop", "/data/pop/A.DBF") == "file:///data/pop/A.DBF"
    assert _uri("s3://bucket/pop/*.DBF", "bucket/pop/A.DBF") == "s3://bucket/pop/A.DBF"
    assert _uri("hdfs://nn:8020/pop", "/pop/A.DBF") == "hdfs://nn:8020/pop/A.DBF"


def test_split_reader_accepts_file_uri(spark, tmp_path):
    from vigiframe.sources.fixed_width_source import read_fixed_width_split
    d = tmp_path / "uri"
    d.mkdir()
    _dbf(d / "U.DBF", [" 3304557" + "2024" + "1" + "  5" + "      120"], declared=1)
    got = read_fixed_width_split(spark, f"file://{d}/*.DBF", FIELDS).collect()
    assert [(r.cod_mun, r.pop) for r in got] == [(3304557, 120)]


def test_fixed_width_non_integer_number_fails(spark, tmp_path):
    import pytest
    d = tmp_path / "bad"
    d.mkdir()
    _dbf(d / "B.DBF", [" 33045572024x  5      120"], declared=1)     # sexo field holds 'x'
    with pytest.raises(Exception):
        SRC.read_fixed_width(spark, str(d), FIELDS).collect()
