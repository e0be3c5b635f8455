"""Bad input fails instead of being published."""

import pytest
from pyspark.sql import functions as F

from vigiframe.functions import scalars as S
from vigiframe.operators.aggregates import block_ids
from vigiframe.operators.lookups import missing_cells, strict_lookup
from vigiframe.sources import files as SRC


def test_strict_lookup_fails_on_an_unknown_code_whatever_is_read(spark):
    df = spark.createDataFrame([("a", 1), ("z", 2)], "k string, v int")
    dim = spark.createDataFrame([("a", "A")], "code string, name string")
    for column in ("k", "name"):
        with pytest.raises(Exception, match="unknown"):
            strict_lookup(df, dim, "k", "code").select(column).collect()
    assert strict_lookup(df.where("k = 'a'"), dim, "k", "code").collect() == [("a", 1, "A")]


def test_broken_payload_fails(spark):
    df = spark.createDataFrame([('[{"V":"h"},{"V":"1"}]',), ('[{"V":"h"},{"V":',)], "p string")
    with pytest.raises(Exception, match="broken JSON"):
        df.select(F.explode(SRC.rows_after_header("p", "struct<V: string>"))).collect()


def test_age_beyond_the_column_fails_and_lists_trim_all_white_space(spark):
    with pytest.raises(Exception, match="age out of range"):
        spark.createDataFrame([("99999999999 anos",)], "a string").select(S.age_label("a")).collect()
    got = spark.createDataFrame([("1,\t2\t, 3",)], "a string").select(S.split_list("a", 2)).first()[0]
    assert got == ["01", "02", "03"]


def test_row_text_is_unambiguous(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("<null>", "x"), ("-", "x")]
    df = spark.createDataFrame(rows, "a string, b string").select(S.row_fingerprint("a", "b").alias("f"))
    assert df.distinct().count() == len(rows)


def test_missing_cells_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "e int, d1 string, d2 string")
    assert missing_cells(df, "e", ["d1", "d2"]).count() == 6


def test_hot_null_group_is_split(spark):
    df = spark.createDataFrame([(None, i) for i in range(40)], "g string, o int")
    got = block_ids(df, ["g"], ["o"], 10, hot_rows=5).collect()
    assert sorted((r.o, r.bloco) for r in got) == [(i, i // 10) for i in range(40)]
