"""Weights, shares and the invariant (FIXTURES A2/Q6), estimates and block numbering."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigiframe.operators.aggregates import block_ids
from vigiframe.operators.weights import (apply_weights, join_group_total, race_weights, stable_salt, weight_sum_failures,
                                         weight_sum_report, with_group_total)

KEYS = ["ano_censo", "co_municipio_ibge", "sexo", "idade"]


def census(spark, rows):
    return spark.createDataFrame(rows, "ano_censo short, co_municipio_ibge string, sexo string, idade short, "
                                       "co_raca_cor string, pop long")


def test_shares_and_zero_groups(spark):
    c = census(spark, [(2022, "3304557", "1", 5, "1", 3), (2022, "3304557", "1", 5, "2", 1),
                       (2022, "3304557", "1", 5, "3", 0), (2022, "3304557", "2", 5, "1", 0),
                       (2022, "3304557", "2", 5, "2", 0), (2022, None, "1", 5, "1", 4),
                       (2022, None, "1", 5, "2", None)])
    m = race_weights(c)
    got = {(r.co_municipio_ibge, r.sexo, r.co_raca_cor): (r.pop_total_grupo, r.peso_raca) for r in m.collect()}
    assert got[("3304557", "1", "1")] == (4, 0.75)
    assert got[("3304557", "1", "2")] == (4, 0.25)
    assert got[("3304557", "1", "3")] == (4, 0.0)
    assert got[("3304557", "2", "1")] == (0, 0.0)
    # the null-key group is kept and totals itself (null values skipped)
    assert got[(None, "1", "1")] == (4, 1.0)
    assert weight_sum_failures(m).count() == 0
    r = weight_sum_report(m).collect()[0]
    assert (r.grupos, r.grupos_zero, r.falhas) == (3, 1, 0)


def test_window_and_join_totals_agree(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 5), (None, None, 7)], "k1 string, k2 string, v long")
    a = with_group_total(df, ["k1", "k2"], "v", "t")
    b = with_group_total(df, ["k1", "k2"], "v", "t", skew_safe=True)
    c = join_group_total(df, ["k1", "k2"], "v", "t")
    def key(rows):
        return sorted(tuple(str(x) for x in r) for r in rows)
    assert key(a.collect()) == key(b.collect()) == key(c.collect())
    assert sorted(r.t for r in a.collect()) == [3, 3, 5, 7]


def test_apply_weights_pools_top_age(spark):
    c = census(spark, [(2022, "0000001", "1", 4, "1", 10), (2022, "0000001", "1", 4, "2", 30),
                       (2022, "0000001", "1", 9, "1", 60), (2022, "0000001", "1", 9, "2", 0)])
    pop = spark.createDataFrame([("0000001", 2024, 1, "004", 100), ("0000001", 2024, 1, "007", 50),
                                 ("0000002", 2024, 1, "004", 5)],
                                "co_municipio_ibge string, ano int, sexo int, idade string, pop long")
    out = {(r.co_municipio_ibge, r.idade, r.co_raca_cor): r.pop_estimada
           for r in apply_weights(pop, c, top_age=4).collect()}
    # ages >= 4 pool into one class: race 1 = 70/100, race 2 = 30/100
    assert abs(out[("0000001", "004", "1")] - 70.0) < 1e-9
    assert abs(out[("0000001", "007", "2")] - 15.0) < 1e-9
    assert out[("0000002", "004", None)] is None          # no weight: kept, visible


def test_block_ids_hot_group_matches_window(spark):
    df = spark.range(0, 5000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)).alias("g"),
                                     F.col("id").alias("o"))
    a = block_ids(df, ["g"], ["o"], 7, hot_rows=500)
    w = Window.partitionBy("g").orderBy("o")
    b = df.withColumn("bloco", F.floor((F.row_number().over(w) - 1) / 7).cast("int"))
    assert a.count() == b.count() == 5000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salted_totals_match_window_on_hot_key(spark):
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 40)
        .alias("k"), (F.col("id") % 11).alias("v"))
    a = with_group_total(df, ["k"], "v", "t")
    b = join_group_total(df, ["k"], "v", "t", hot_rows=300)      # null and 7 are hot: fan 7
    assert a.count() == b.count() == 6000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def salted(df):
    return sorted(map(str, stable_salt(df, ["k"], "f", "s").collect()))


def test_salt_is_the_same_when_a_task_gets_its_rows_in_another_order(spark):
    """What a lost executor's map task gets again is the same rows in another order."""
    rows = [(i % 2, i % 7, None if i % 5 == 0 else f"v{i % 3}", 6 if i % 2 else 1) for i in range(2000)]
    kinds = "k int, v int, t string, f int"
    first = salted(spark.createDataFrame(rows, kinds).coalesce(1))
    again = salted(spark.createDataFrame(rows[::-1], kinds).coalesce(1))
    third = salted(spark.createDataFrame(sorted(rows, key=lambda r: (r[1], str(r[2]))), kinds).coalesce(1))
    assert first == again == third


def test_equal_rows_of_a_hot_key_are_spread(spark):
    rows = spark.createDataFrame([(1, 5, 6)] * 3000 + [(2, 5, 1)] * 50, "k int, v int, f int").coalesce(1)
    counts = {(r.k, r.s): r["count"] for r in stable_salt(rows, ["k"], "f", "s").groupBy("k", "s").count().collect()}
    assert counts == {**{(1, s): 500 for s in range(6)}, (2, 0): 50}


def test_salt_of_rows_with_maps(spark):
    rows = spark.sql("SELECT 1 AS k, map('a', id % 3) AS m, 4 AS f FROM range(40)").coalesce(1)
    assert sorted(r["count"] for r in stable_salt(rows, ["k"], "f", "s").groupBy("s").count().collect()) == [10] * 4
