"""Incremental publication of landed files: a second run picks up only new files."""

import datetime as dt

from vigiframe.streaming.incremental import publish_establishments_stream, weekly_counts_stream

HEADER = "CO_UNIDADE;TO_CHAR(DT_ATUALIZACAO,'DD/MM/YYYY');CO_ESTADO_GESTOR\n"


def test_available_now_runs_are_incremental(spark, tmp_path):
    src, out, ckpt = tmp_path / "landing", tmp_path / "pub", tmp_path / "ckpt"
    src.mkdir()
    (src / "a.csv").write_bytes((HEADER + "1;01/02/2024;33\n2;;\n").encode("latin-1"))
    q = publish_establishments_stream(spark, str(src), str(src / "a.csv"), str(out), checkpoint=str(ckpt))
    q.awaitTermination()
    assert spark.read.parquet(str(out)).count() == 2
    (src / "b.csv").write_bytes((HEADER + "3;05/03/2024;35\n").encode("latin-1"))
    q = publish_establishments_stream(spark, str(src), str(src / "a.csv"), str(out), checkpoint=str(ckpt))
    q.awaitTermination()
    pub = spark.read.parquet(str(out))
    assert pub.count() == 3
    assert sorted(r.particao for r in pub.select("particao").distinct().collect()) == ["33", "35", "sem_estado"]
    assert {r.co_unidade: r.dt_atualizacao for r in pub.collect()}["1"] == dt.date(2024, 2, 1)


def test_weekly_windows_start_on_sunday(spark, tmp_path):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 7, 10),), (dt.datetime(2024, 1, 13, 23),),
                                (dt.datetime(2024, 1, 14, 0),)], "ts timestamp")
    path = str(tmp_path / "ev")
    ev.write.parquet(path)
    stream = spark.readStream.schema("ts timestamp").parquet(path)
    q = (weekly_counts_stream(spark, stream).writeStream.format("memory").queryName("weekly_test")
         .outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    got = {r.inicio: r.casos for r in spark.sql("SELECT * FROM weekly_test").collect()}
    assert got == {dt.date(2024, 1, 7): 2, dt.date(2024, 1, 14): 1}
