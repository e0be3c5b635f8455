"""Group totals, shares of a group total, the weight invariant and weighted estimates.

Spark plan of ``race_weights`` on census cells: the cells arrive hash-partitioned
by their own aggregation; the group total is one window ``sum`` over the group
keys (one shuffle of the already aggregated cells, no self-join), and the
weight is a codegen'd ``CASE`` on the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigiframe.functions.scalars import ratio_or_zero

# Key and column names of the published race-weight matrix.
GROUP_KEYS = ["ano_censo", "co_municipio_ibge", "sexo", "idade"]
CATEGORY = "co_raca_cor"
MATRIX_COLUMNS = [
    "ano_censo", "co_municipio_ibge", "co_municipio", "co_uf", "sexo", "no_sexo", "idade",
    "co_raca_cor", "co_raca_cor_sidra", "no_raca_cor", "pop_raca", "pop_total_grupo", "peso_raca",
]
# Groups above this many rows are salted over several tasks in skew-safe totals.
HOT_GROUP_ROWS = 1_000_000
# Tolerance of the "weights of a group sum to one" invariant.
WEIGHT_TOLERANCE = 1e-9


def group_sum(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Sum per group; null keys form their own group; null values are skipped and an
    all-null group sums to 0. Partial aggregation runs map-side before the shuffle."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(alias))


def with_group_total(df: DataFrame, keys: list[str], value: str, total: str, skew_safe: bool = False) -> DataFrame:
    """Add the total of ``value`` over ``keys`` to every row (null keys match each other).

    Window form (default): one shuffle, for frames whose groups are bounded (e.g.
    aggregated cells). ``skew_safe=True`` for raw detail rows: the totals are a
    map-side partially aggregated ``groupBy`` joined back with hot keys salted
    (see ``join_group_total``), so a hot key is never gathered into one task.
    """
    if skew_safe:
        return join_group_total(df, keys, value, total, hot_rows=HOT_GROUP_ROWS)
    w = Window.partitionBy(*keys)
    return df.withColumn(total, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def share_of_total(df: DataFrame, keys: list[str], value: str, total: str, share: str) -> DataFrame:
    """Group total plus ``share = value / total`` when total > 0, else 0.0."""
    return with_group_total(df, keys, value, total).withColumn(share, ratio_or_zero(value, total))


def race_weights(census: DataFrame, keys: list[str] = GROUP_KEYS, columns: list[str] | None = None) -> DataFrame:
    """Census cells (with ``pop``) -> weight matrix (pop_raca, pop_total_grupo, peso_raca)."""
    m = census.withColumnRenamed("pop", "pop_raca")
    m = share_of_total(m, keys, "pop_raca", "pop_total_grupo", "peso_raca")
    cols = columns or [c for c in MATRIX_COLUMNS if c in m.columns]
    return m.select(*cols)


def join_group_total(df: DataFrame, keys: list[str], value: str, total: str,
                     hot_rows: int | None = None) -> DataFrame:
    """Join form of ``with_group_total``: detail left-joined to its group sums with a
    null-safe key match (a null key meets the null-key group, as in pandas).

    With ``hot_rows`` the join is salted so no group's rows meet in one task: keys
    with more than ``hot_rows`` rows (at most rows/hot_rows of them) get
    ``fan = ceil(n / hot_rows)``; each of their detail rows takes a salt in [0, fan)
    (``stable_salt``), their total is replicated once per salt, and the join runs on
    (keys, salt).
    """
    totals = df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(total),
                                   F.count(F.lit(1)).alias("_n"))

    def on(a: str, b: str, extra: list[str] = ()):
        cond = None
        for k in keys:
            c = F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
            cond = c if cond is None else cond & c
        for k in extra:
            cond = cond & (F.col(f"{a}.{k}") == F.col(f"{b}.{k}"))
        return cond

    if hot_rows is None:
        t = totals.drop("_n").alias("t")
        return df.alias("d").join(t, on("d", "t"), "left").select("d.*", F.col(f"t.{total}"))

    hot = totals.filter(F.col("_n") > hot_rows).select(
        *keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_fan"))
    # No hint: the list grows with the input; adaptive execution broadcasts it where it is measured small.
    hot_b = hot.alias("h")
    d = (df.alias("d").join(hot_b, on("d", "h"), "left")
         .select("d.*", F.coalesce(F.col("h._fan"), F.lit(1)).alias("_fan")))
    d = stable_salt(d, keys, "_fan", "_salt").drop("_fan")
    t = (totals.drop("_n").alias("t").join(hot_b, on("t", "h"), "left")
         .select("t.*", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("h._fan"), F.lit(1)) - 1)).alias("_salt")))
    j = d.alias("d").join(t.alias("t"), on("d", "t", ["_salt"]), "left")
    return j.select(*[F.col(f"d.`{c}`") for c in df.columns], F.col(f"t.{total}"))


# Low bits of ``monotonically_increasing_id``: a row's place in its partition.
_PLACE_BITS = (1 << 33) - 1


def stable_salt(df: DataFrame, keys: list[str], fan: str, salt: str) -> DataFrame:
    """Deal the rows of each key over ``fan`` salts, evenly, equal rows too, and alike whenever a task is run again.

    Rows with a fan above 1 are sorted by key and content inside their partition, and the place decides the salt. A
    task that is run again gets the same rows, perhaps in another order; sorted, they stand in the same places, but for
    equal rows, which may change places with each other: which rows go where stays the same.
    """
    def orderable(f) -> Column:
        c = F.col(f"`{f.name}`")
        return F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else c

    fields = {f.name: f for f in df.schema.fields}
    order = [orderable(fields[k]) for k in keys] + [orderable(f) for n, f in fields.items() if n not in keys]
    hot = F.col(fan) > 1
    # Rows of other keys all compare equal and are not looked at further.
    placed = df.sortWithinPartitions(F.when(hot, F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])))
    place = F.monotonically_increasing_id().bitwiseAND(_PLACE_BITS)
    return placed.withColumn(salt, F.when(hot, F.pmod(place, F.col(fan).cast("long"))).otherwise(F.lit(0)).cast("int"))


def weight_sum_failures(matrix: DataFrame, keys: list[str] = GROUP_KEYS, weight: str = "peso_raca",
                        tol: float = WEIGHT_TOLERANCE) -> DataFrame:
    """Groups whose weights do not sum to 1 (groups summing to 0 pass).
    Null keys are left out, as the reference's check does."""
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else not_null & c
    sums = matrix.filter(not_null).groupBy(*keys).agg(F.sum(weight).alias("soma_pesos"))
    return sums.filter((F.col("soma_pesos") > 0) & (F.abs(F.col("soma_pesos") - 1.0) > tol))


def weight_sum_report(matrix: DataFrame, keys: list[str] = GROUP_KEYS, weight: str = "peso_raca",
                      tol: float = WEIGHT_TOLERANCE) -> DataFrame:
    """One-row invariant report in a single pass over the group sums:
    groups, groups summing to 0, and failing groups (null-key groups are not judged)."""
    keys_ok = None
    for k in keys:
        c = F.col(k).isNotNull()
        keys_ok = c if keys_ok is None else keys_ok & c
    sums = matrix.groupBy(*keys).agg(F.sum(weight).alias("_s")).withColumn("_k", keys_ok)
    bad = F.col("_k") & (F.col("_s") > 0) & (F.abs(F.col("_s") - 1.0) > tol)
    return sums.agg(F.count(F.lit(1)).alias("grupos"), F.count_if(F.col("_s") == 0).alias("grupos_zero"),
                    F.count_if(bad).alias("falhas"))


def pooled_age(age, top_age: int) -> Column:
    """Ages at or above ``top_age`` share one open-ended class."""
    a = F.col(age) if isinstance(age, str) else age
    return F.least(a.cast("int"), F.lit(top_age))


def apply_weights(population: DataFrame, census: DataFrame, top_age: int,
                  pop_keys: tuple[str, str, str] = ("co_municipio_ibge", "sexo", "idade"),
                  census_keys: tuple[str, str, str] = ("co_municipio_ibge", "sexo", "idade"),
                  category: str = CATEGORY, sex_type: str | None = "int") -> DataFrame:
    """Estimated population by category:

        estimate(year, mun, sex, age, cat) = total(year, mun, sex, age) * weight(mun, sex, age, cat)

    Census counts are pooled to ``least(age, top_age)`` *before* the weights are
    computed, so open-ended top classes get a proper weight (weights are never
    averaged). Keys are cast to int on both sides; population cells without a
    weight are kept with null weight and estimate, so gaps are visible.
    ``sex_type=None`` keeps sex codes as they are (e.g. letter codes).

    Plan: the census cells are shuffled once by (mun, sex, age), which serves the
    pooling, the window and the join; the population side is shuffled once on the
    same keys; sort-merge join, no broadcast of data that grows with the input.
    Where both sides are published in buckets of the keys, ``join_weights`` shuffles
    neither.
    """
    weights = weight_cells(census, top_age, census_keys, category, sex_type)
    return join_weights(population_cells(population, top_age, pop_keys, sex_type), weights)


# Join keys of the estimate, alike in type on both sides.
CELL_KEYS = ["_mun", "_sex", "_age"]


def _sex_key(c: str, sex_type: str | None) -> Column:
    return F.col(c).cast(sex_type) if sex_type else F.col(c)


def weight_cells(census: DataFrame, top_age: int, keys: tuple[str, str, str] = ("co_municipio_ibge", "sexo", "idade"),
                 category: str = CATEGORY, sex_type: str | None = "int") -> DataFrame:
    """Census cells -> weight of each category per (mun, sex, pooled age), partitioned by these keys."""
    mun, sex, age = keys
    cells = (census
             .withColumn("_mun", F.col(mun).cast("string"))
             .withColumn("_sex", _sex_key(sex, sex_type))
             .withColumn("_age", pooled_age(age, top_age))
             .select(*CELL_KEYS, category, "pop")
             .repartition(*CELL_KEYS)
             .groupBy(*CELL_KEYS, category)
             .agg(F.sum("pop").cast("long").alias("_pop")))
    return share_of_total(cells, CELL_KEYS, "_pop", "_tot", "peso").drop("_pop", "_tot")


def population_cells(population: DataFrame, top_age: int, keys: tuple[str, str, str] = ("co_municipio_ibge", "sexo", "idade"),
                     sex_type: str | None = "int") -> DataFrame:
    """Population rows with the estimate's join keys."""
    mun, sex, age = keys
    return (population
            .withColumn("_mun", F.col(mun).cast("string"))
            .withColumn("_sex", _sex_key(sex, sex_type))
            .withColumn("_age", pooled_age(age, top_age)))


def join_weights(population: DataFrame, weights: DataFrame) -> DataFrame:
    """``population_cells`` x ``weight_cells``; neither side is shuffled where it is stored in buckets of the keys."""
    out = population.join(weights, CELL_KEYS, "left")
    return out.withColumn("pop_estimada", F.col("pop").cast("double") * F.col("peso")).drop(*CELL_KEYS)
