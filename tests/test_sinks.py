"""Sinks and publication (FIXTURES K1, K2, K3, K5, M1, M2, Q7)."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.sinks.publish import (QuarantineError, ValidationError, conform, expire_runs, file_hashes, fingerprint, fit, live_listing,
                                     publish_if_changed, publish_nonempty, publish_partitioned, read_listing, read_table, table_document,
                                     write_run)
from vigiframe.sinks.store import ConflictError, Document, write_new


def test_conform_types_and_overflow(spark):
    schema = T.StructType([T.StructField("idade", T.ShortType()), T.StructField("sexo", T.ByteType())])
    ok = conform(spark.createDataFrame([(5, 1)], "idade int, sexo int"), schema)
    assert ok.schema == schema and ok.collect()[0][:] == (5, 1)
    with pytest.raises(Exception):
        conform(spark.createDataFrame([(5, 300)], "idade int, sexo int"), schema).collect()


def test_publish_partitioned_blank_bucket_and_text_keys(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("11", 2), ("", 3), (None, 4)], "co_uf string, v int")
    out = str(tmp_path / "pub")
    counts = {r.co_uf: r.rows for r in publish_partitioned(df, out, "co_uf", ["v"]).collect()}
    assert counts == {"01": 1, "11": 1, "sem_estado": 2}
    back = read_table(spark, out)
    assert dict(back.dtypes)["co_uf"] == "string"
    assert sorted(r.co_uf for r in back.select("co_uf").distinct().collect()) == ["01", "11", "sem_estado"]


def test_publish_nonempty_refuses_empty(spark, tmp_path):
    with pytest.raises(ValueError):
        publish_nonempty(spark.createDataFrame([], "a int"), str(tmp_path / "e"))
    assert publish_nonempty(spark.range(5), str(tmp_path / "f")) == 5


def test_file_hashes_match_hashlib(spark, tmp_path):
    p = tmp_path / "a.parquet"
    p.write_bytes(b"hello parquet")
    got = file_hashes(spark, str(tmp_path)).collect()[0]
    assert got.sha256 == hashlib.sha256(b"hello parquet").hexdigest()


def test_fingerprint_order_and_partition_free(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v"))
    a = fingerprint(df, ["k", "v"], ["k"]).collect()
    b = fingerprint(df.repartition(13).orderBy(F.rand(1)), ["k", "v"], ["k"]).collect()
    assert sorted(a) == sorted(b)
    c = fingerprint(df.union(df.limit(1)), ["k", "v"]).collect()[0]   # a duplicate changes it
    assert c.rows == 1001 and c.fingerprint != fingerprint(df, ["k", "v"]).collect()[0].fingerprint


def test_publish_if_changed_swaps_only_on_change(spark, tmp_path):
    root, man = str(tmp_path / "ref"), str(tmp_path / "ref" / "manifest.json")
    df = spark.range(10).select(F.col("id").alias("x"))
    first = publish_if_changed(df, root, "demo", "v1", ["x"], man)
    again = publish_if_changed(df.orderBy(F.desc("x")), root, "demo", "v1", ["x"], man)
    assert first["changed"] and not again["changed"]
    third = publish_if_changed(df.filter("x > 0"), root, "demo", "v2", ["x"], man)
    assert third["changed"] and json.load(open(man))["rows"] == 9
    # every published file is readable and its rows add up to the manifest (Q7)
    path = third["files"]["all"]["path"]
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r["count"] for r in per_file) == 9 and os.path.exists(path.removeprefix("file:"))


def test_publish_reference_validates_hashes_and_registers(spark, tmp_path):
    from vigiframe.operators.quality import report
    from vigiframe.sinks.reference import ValidationError, publish_reference, publish_tables, validate_published
    df = spark.createDataFrame([("33", "3304557", 10), ("35", "3550308", 20), ("", "0000000", 1)],
                               "co_uf string, co_municipio_ibge string, pop long")
    root, reg = str(tmp_path / "populacao"), str(tmp_path / "manifest.json")
    bad = report(df, {"pop_positive": F.col("pop") > 5})
    with pytest.raises(ValidationError):
        publish_reference(df, root, "populacao", "2025", "co_uf", ["co_municipio_ibge"], report=bad)
    assert not os.path.exists(root)                       # nothing written on failed checks
    ok = report(df, {"pop_positive": F.col("pop") > 0})
    m = publish_reference(df, root, "populacao", "2025", "co_uf", ["co_municipio_ibge"], report=ok, registry_path=reg)
    assert m["rows"] == 3 and set(m["files"]) == {"33", "35", "sem_estado"}
    assert all(len(f["sha256"]) >= 1 for f in m["files"].values())
    assert json.load(open(reg))["references"]["populacao"].endswith("manifest.json")
    v = validate_published(spark, m["runs"][0]["path"], {"33": 1, "35": 1, "sem_estado": 1}, "co_uf")
    assert v.filter(~F.col("ok")).count() == 0
    tabs = publish_tables({"capitulos": df.select("co_uf"), "grupos": df.select("pop")}, str(tmp_path / "cid"), "1")
    assert tabs["capitulos"]["rows"] == 3 and tabs["grupos"]["columns"] == ["pop"]


def test_missing_files_and_partial_run_gate(spark, tmp_path):
    from vigiframe.sinks.reference import already_published, missing_published_files, publish_reference
    df = spark.createDataFrame([("33", 1), ("35", 2)], "co_uf string, v long")
    root = str(tmp_path / "ref")
    m = publish_reference(df.filter("co_uf = '33'"), root, "r", "202604", "co_uf", ["v"])
    man = os.path.join(root, "manifest.json")
    assert already_published(man, "202604", ["33"])
    assert not already_published(man, "202604", ["33", "35"])    # partial run does not block the rest
    assert not already_published(man, "202605", ["33"])
    folder = m["files"]["33"]["path"].removeprefix("file:")
    files = [p for p in os.listdir(folder) if p.endswith(".parquet")]
    paths = spark.createDataFrame([(os.path.join(folder, f),) for f in files] +
                                  [(os.path.join(root, "gone.parquet"),)], "path string")
    missing = [r.path for r in missing_published_files(spark, paths, root).collect()]
    assert missing == [os.path.join(root, "gone.parquet")]
    folders = spark.createDataFrame([(folder,), (folder + "/",), ("file:" + folder,), (folder.replace("co_uf=33", "co_uf=35"),), (folder[:-1],)], "path string")
    assert {r.path for r in missing_published_files(spark, folders, root).collect()} == {folder.replace("co_uf=33", "co_uf=35"), folder[:-1]}


STATES = "co_uf string, v long"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_reader_of_a_table_sees_one_run_during_a_rewrite(spark, tmp_path):
    out = str(tmp_path / "t")
    publish_partitioned(spark.createDataFrame([("01", 1), ("02", 2)], STATES), out, "co_uf", ["v"])
    before = read_table(spark, out)                 # planned, not yet run
    publish_partitioned(spark.createDataFrame([("01", 10)], STATES), out, "co_uf", ["v"])
    assert rows_of(before.select("co_uf", "v")) == [("01", 1), ("02", 2)]
    assert rows_of(read_table(spark, out).select("co_uf", "v")) == [("01", 10)]       # states that went are gone
    old = expire_runs(spark, out, keep=1)
    assert len(old) == 1 and rows_of(read_table(spark, out).select("co_uf", "v")) == [("01", 10)]


def test_a_killed_run_leaves_the_table(spark, tmp_path):
    out = str(tmp_path / "t")
    publish_partitioned(spark.createDataFrame([("01", 1)], STATES), out, "co_uf", ["v"])
    broken = spark.createDataFrame([("01", 2), ("02", 3)], STATES).withColumn(
        "v", F.when(F.col("co_uf") == "02", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        publish_partitioned(broken, out, "co_uf", ["v"])
    write_run(spark.createDataFrame([("09", 9)], STATES), out, "co_uf")              # complete, but the driver dies before the switch
    assert rows_of(read_table(spark, out).select("co_uf", "v")) == [("01", 1)]
    assert table_document(spark, out).revision() == 1


def test_types_come_back_whatever_the_session_infers(spark, tmp_path):
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    try:
        for setting in ("true", "false"):
            spark.conf.set(key, setting)
            out = str(tmp_path / f"t{setting}")
            counts = publish_partitioned(spark.createDataFrame([("01", 1), ("a/b c+%", 2)], STATES), out, "co_uf", [])
            assert rows_of(counts) == [("01", 1), ("a/b c+%", 1)]
            assert rows_of(read_table(spark, out).select("co_uf", "v")) == [("01", 1), ("a/b c+%", 2)]
    finally:
        spark.conf.set(key, before)


def test_run_that_lost_rows_is_refused(spark, tmp_path, monkeypatch):
    """What is read back must be what was observed in the write."""
    from vigiframe.sinks import publish
    real = publish._written
    monkeypatch.setattr(publish, "_written", lambda *a: real(*a).where("v <> 2"))
    with pytest.raises(ValidationError, match="does not hold what was written"):
        publish_partitioned(spark.createDataFrame([("01", 1), ("01", 2)], STATES), str(tmp_path / "t"), "co_uf", [])
    monkeypatch.setattr(publish, "_written", lambda *a: real(*a).withColumn("v", F.col("v") * 2))
    with pytest.raises(ValidationError, match="does not hold what was written"):
        publish_partitioned(spark.createDataFrame([("01", 1), ("01", 2)], STATES), str(tmp_path / "t"), "co_uf", [])


def published(spark, tmp_path):
    from vigiframe.sinks.reference import publish_reference
    root = str(tmp_path / "ref")
    m = publish_reference(spark.createDataFrame([("33", i) for i in range(50)] + [("35", i) for i in range(7)], STATES), root, "r", "1", "co_uf", ["v"])
    return os.path.join(root, "manifest.json"), m


def statuses(spark, manifest):
    from vigiframe.sinks.reference import verify_published
    return sorted((str(r.part), r.status) for r in verify_published(spark, manifest).select("part", "status").distinct().collect())


def part_files(m, part):
    folder = m["files"][part]["path"].removeprefix("file:")
    return sorted(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))


def drop_checksum(file):
    """Hadoop's own checksum file would notice the change before the library does."""
    crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_verify_finds_a_removed_file(spark, tmp_path):
    manifest, m = published(spark, tmp_path)
    assert statuses(spark, manifest) == [("33", "ok"), ("35", "ok")] and m["rows"] == 57
    os.remove(part_files(m, "35")[0])
    assert statuses(spark, manifest) == [("33", "ok"), ("35", "missing")]


def test_verify_finds_a_flipped_byte_and_a_removed_row(spark, tmp_path):
    import pyarrow.parquet as pq
    manifest, m = published(spark, tmp_path)
    first, second = part_files(m, "33")[0], part_files(m, "35")[0]
    data = bytearray(open(first, "rb").read())
    data[len(data) // 2] ^= 1
    drop_checksum(first)
    open(first, "wb").write(data)
    table = pq.read_table(second)
    drop_checksum(second)
    pq.write_table(table.slice(1), second)
    assert statuses(spark, manifest) == [("33", "changed"), ("35", "changed")]


def test_verify_finds_an_added_file(spark, tmp_path):
    import shutil
    manifest, m = published(spark, tmp_path)
    file = part_files(m, "35")[0]
    shutil.copy(file, file.replace("part-", "part-9"))
    assert ("None", "unlisted") in statuses(spark, manifest)


def test_two_writers_of_a_document_lose_nothing(spark, tmp_path):
    import threading
    path, failed = str(tmp_path / "a" / "registry.json"), []

    def write(name):
        try:
            for i in range(6):
                Document(spark, path).update(lambda old: {**(old or {}), f"{name}{i}": i})
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=write, args=(n,)) for n in "abcd"]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not failed and len(Document(spark, path).read()) == 24 and Document(spark, path).revision() == 24


def test_document_rules(spark, tmp_path):
    path = str(tmp_path / "d.json")
    doc = Document(spark, path)
    assert doc.read() is None and doc.update(lambda old: None) is None and doc.revision() == 0
    open(path, "w").write('{"by": "another program"}')
    assert doc.read() == {"by": "another program"}
    assert doc.update(lambda old: {**old, "n": "é"}) == {"by": "another program", "n": "é"}
    assert json.load(open(path))["n"] == "é" and doc.read(1)["n"] == "é"
    assert not write_new(spark, doc._file(1), "{}")                      # a revision is written once

    def always_late(old):
        write_new(spark, doc._file(doc.revision() + 1), "{}")
        return {"late": True}
    with pytest.raises(ConflictError):
        doc.update(always_late)
    assert doc.read() == {}


def test_registers_at_once_keep_both_entries(spark, tmp_path):
    import threading
    from vigiframe.sinks.reference import register
    reg = str(tmp_path / "manifest.json")
    both = [threading.Thread(target=register, args=(reg, f"r{i}", f"/x/{i}/manifest.json")) for i in range(5)]
    for b in both:
        b.start()
    for b in both:
        b.join()
    assert len(Document(spark, reg).read()["references"]) == 5
    at = Document(spark, reg).revision()
    register(reg, "r1", "/x/1/manifest.json")                            # nothing new: no revision
    assert Document(spark, reg).revision() == at


def test_store_works_on_a_path_of_another_scheme(spark, tmp_path):
    """Renames take the place of hard links where the file system isn't a plain local folder."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.docs.link./data", f"file://{tmp_path}")
    spark.conf.set("spark.hadoop.fs.viewfs.mounttable.docs.link./data", f"file://{tmp_path}")
    out = "viewfs://docs/data/t"
    publish_partitioned(spark.createDataFrame([("01", 1)], STATES), out, "co_uf", [])
    publish_partitioned(spark.createDataFrame([("01", 1), ("02", 1)], STATES), out, "co_uf", [])
    assert rows_of(read_table(spark, out).select("co_uf", "v")) == [("01", 1), ("02", 1)] and table_document(spark, out).revision() == 2


def test_rows_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    schema = T.StructType([T.StructField("co_uf", T.StringType()), T.StructField("idade", T.ByteType(), False)])
    rows = spark.createDataFrame([("01", "5"), ("01", "300"), ("02", None), ("02", "x"), ("03", "7")], "co_uf string, idade string")
    out = str(tmp_path / "t")
    publish_partitioned(fit(rows.where("idade in ('5', '7')"), schema), out, "co_uf", [])
    with pytest.raises(QuarantineError) as caught:
        publish_partitioned(fit(rows, schema), out, "co_uf", [])
    assert caught.value.rows == 3
    aside = sorted((r["row"], r.reasons) for r in spark.read.json(caught.value.path).collect())
    assert aside == [('{"co_uf":"01","idade":"300"}', ["idade: does not fit tinyint"]), ('{"co_uf":"02","idade":"x"}', ["idade: does not fit tinyint"]),
                     ('{"co_uf":"02"}', ["idade: missing"])]
    assert rows_of(read_table(spark, out).select("co_uf", "idade")) == [("01", 5), ("03", 7)]     # the earlier table stands
    with pytest.raises(ValidationError, match="missing columns"):
        fit(rows.drop("idade"), schema)
    with pytest.raises(ValidationError, match="unknown columns"):
        fit(rows.withColumn("z", F.lit(1)), schema)


def test_listing_is_read_by_part(spark, tmp_path):
    rows = spark.range(300).select(F.format_string("%03d", F.col("id")).alias("co_uf"), F.col("id").alias("v"))
    run = write_run(rows, str(tmp_path / "t"), "co_uf")
    one = read_listing(spark, run.listing, "007")
    assert one.count() == 1 and one.first().rows == 1
    assert "shard" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:120]
    assert live_listing(spark, [{**run.entry(), "without": ["007"]}]).count() == 299


def test_file_hashes_in_blocks(spark, tmp_path):
    import io
    from vigiframe.sinks.hash_source import digest_blocks
    data = os.urandom(1_000_003)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.parquet").write_bytes(data)
    (tmp_path / "d" / "empty.parquet").write_bytes(b"")
    (tmp_path / "d" / "_hidden.parquet").write_bytes(b"x")
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.sha256) for r in file_hashes(spark, str(tmp_path / "d")).collect()}
    assert got == {"a.parquet": (len(data), hashlib.sha256(data).hexdigest()), "empty.parquet": (0, hashlib.sha256(b"").hexdigest())}
    asked = []

    class Stream(io.BytesIO):
        def read(self, n=-1):
            asked.append(n)
            return super().read(n)
    assert digest_blocks(Stream(data), 4096) == (len(data), hashlib.sha256(data).hexdigest()) and set(asked) == {4096}


def test_missing_municipality_code_fails(spark):
    from vigiframe.plans.pipelines import municipality_codes
    ok = municipality_codes(spark.createDataFrame([("330455",)], "c string"), "c").collect()[0]
    assert (ok.co_municipio_ibge, ok.co_municipio, ok.co_uf) == ("0330455", "033045", "03")
    with pytest.raises(Exception):
        municipality_codes(spark.createDataFrame([(None,)], "c string"), "c").collect()
