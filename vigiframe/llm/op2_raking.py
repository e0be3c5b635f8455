"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, language, topic) with their token counts. Raking finds one factor per source,
language and topic so that the factors' products, as weights of the tokens, meet the target share of every source,
language and topic at once. Documents are then kept with probability min(1, lambda * factor product), lambda chosen
so that the expected tokens meet the budget, by a hash of the document.

The number of languages and topics is fixed by the targets (others pool); sources may be many. So a source's cells
are one row with a short array of tokens per (language, topic), the source factors follow in closed form from the
others, and a round is one sum of those arrays over all sources: the driver only sees languages x topics numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import id_hash, safe_names, staged

# Target shares of the registered query. Languages and topics that are not named pool under OTHER.
OTHER = "other"
LANGUAGES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.13, OTHER: 0.02}
# A document's topic is the first whose cue its text has; cues are fixed values, matched without regard to case.
TOPICS = {"licence": ("licensed under|released under|all rights reserved|copyright", 0.10), "contact": ("@[a-z0-9-]+[.]|[+][0-9]", 0.10),
          "data": ("[0-9]{3}| [|] ", 0.10), OTHER: ("", 0.70)}
SOURCE_POWER = 0.5          # a source's target share is its share of the tokens to this power, scaled to sum to one
BUDGET = 0.5                # share of all tokens that the sample should have
TOLERANCE = 1e-6
# Raking that has not come nearer by this factor in so many rounds is at its end: empty cells keep it from its targets.
STALLED, STALL_ROUNDS = 0.99, 10
SEED = 2


def token_count(text: Column) -> Column:
    """Words of a text: runs without ASCII white space (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER)
    for name, (cue, _) in reversed([t for t in TOPICS.items() if t[1][0]]):
        out = F.when(text.rlike("(?i)" + cue), F.lit(name)).otherwise(out)
    return F.when(text.isNull(), F.lit(OTHER)).otherwise(out)


def with_cells(docs: DataFrame, source: str = "source", lang: str = "lang", text: str = "text") -> DataFrame:
    """``docs`` plus ``cell_source`` (null: empty text), ``cell_lang``, ``cell_topic`` and ``tokens``."""
    named = [c for c in LANGUAGES if c != OTHER]
    return docs.select("*", F.coalesce(F.col(source).cast("string"), F.lit("")).alias("cell_source"),
                       F.when(F.col(lang).isin(named), F.col(lang)).otherwise(F.lit(OTHER)).alias("cell_lang"),
                       topic_of(F.col(text)).alias("cell_topic"), token_count(F.col(text)).alias("tokens"))


def source_arrays(cells: DataFrame) -> DataFrame:
    """``(cell_source, n)``: tokens per (language, topic) in the order of the targets, one row per source."""
    sums = [F.sum(F.when((F.col("cell_lang") == lang) & (F.col("cell_topic") == topic), F.col("tokens")).otherwise(0)).cast("double")
            for lang in LANGUAGES for topic in TOPICS]
    return cells.groupBy("cell_source").agg(F.array(*sums).alias("n")).where(F.aggregate("n", F.lit(0.0), lambda a, x: a + x) > 0)


def _dot(n: Column, factors: np.ndarray) -> Column:
    weights = F.array(*[F.lit(float(x)) for x in factors])
    return F.aggregate(F.zip_with(n, weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)


def rake(sources: DataFrame) -> dict:
    """Raking factors: ``lang`` and ``topic`` arrays; a source's factor is ``share / (n . (lang x topic))``.

    Targets of languages or topics without tokens drop out and the rest is scaled up. The rounds go on until every
    marginal is met to ``TOLERANCE``, or until they no longer come nearer (targets that the empty cells make
    impossible); ``error`` is the largest miss that is left, ``met`` whether it is within the tolerance.
    """
    shape = (len(LANGUAGES), len(TOPICS))
    size = shape[0] * shape[1]
    total = sources.agg(F.sum(F.pow("mass", F.lit(SOURCE_POWER))).alias("power"), *[F.sum(F.element_at("n", k + 1)).alias(f"t{k}") for k in range(size)]).first()
    tokens = np.array([total[f"t{k}"] or 0.0 for k in range(size)]).reshape(shape)
    out = {"power": total["power"] or 1.0, "lang": np.ones(shape[0]), "topic": np.ones(shape[1]), "rounds": 0, "error": 0.0, "met": True, "tokens": float(tokens.sum())}
    if not tokens.sum():
        return out
    targets = []
    for axis, shares in ((1, list(LANGUAGES.values())), (0, [s for _, s in TOPICS.values()])):
        t = np.where(tokens.sum(axis=axis) > 0, shares, 0.0)
        targets.append(t / t.sum() if t.sum() else np.where(tokens.sum(axis=axis) > 0, 1.0, 0.0) / (tokens.sum(axis=axis) > 0).sum())
    lang, topic = out["lang"], out["topic"]
    errors: list[float] = []
    while True:
        share = F.pow("mass", F.lit(SOURCE_POWER)) / F.lit(out["power"])
        factor = share / _dot(F.col("n"), np.outer(lang, topic).ravel())
        got = sources.select("n", factor.alias("a")).agg(*[F.sum(F.element_at("n", k + 1) * F.col("a")).alias(f"g{k}") for k in range(size)]).first()
        g = np.array([got[f"g{k}"] or 0.0 for k in range(size)]).reshape(shape)
        m = g * np.outer(lang, topic)
        out["error"] = float(max(np.abs(m.sum(axis=1) - targets[0]).max(), np.abs(m.sum(axis=0) - targets[1]).max()))
        errors.append(out["error"])
        out["rounds"], out["met"] = len(errors), out["error"] < TOLERANCE
        if out["met"] or len(errors) > STALL_ROUNDS and not errors[-1] < STALLED * errors[-1 - STALL_ROUNDS]:
            break
        # With the source factors held, language and topic are raked in turn on the summed table.
        for _ in range(100):
            rows = (g * np.outer(lang, topic)).sum(axis=1)
            lang = lang * np.divide(targets[0], rows, out=np.ones(shape[0]), where=rows > 0)
            cols = (g * np.outer(lang, topic)).sum(axis=0)
            topic = topic * np.divide(targets[1], cols, out=np.ones(shape[1]), where=cols > 0)
    out["lang"], out["topic"] = lang, topic
    return out


def scale_to_budget(sources: DataFrame, fit: dict, budget: float = BUDGET) -> float:
    """The lambda with which min(1, lambda * weight) keeps ``budget`` of the tokens in expectation.

    Starts at the lambda of weights that are never cut off at 1; each round takes the cells that are cut off as
    kept whole and solves for the others, which ends because cells only ever join the first.
    """
    goal = budget * fit["tokens"]
    factors = np.outer(fit["lang"], fit["topic"]).ravel()
    share = F.pow("mass", F.lit(SOURCE_POWER)) / F.lit(fit["power"])
    base = sources.select("n", (share / _dot(F.col("n"), factors)).alias("a"))
    scale = goal
    while fit["tokens"]:
        weights = [(F.element_at("n", k + 1), F.col("a") * F.lit(float(w))) for k, w in enumerate(factors)]
        cut = sum((F.when(w * F.lit(scale) >= 1, n).otherwise(0.0) for n, w in weights), F.lit(0.0))
        free = sum((F.when(w * F.lit(scale) >= 1, 0.0).otherwise(n * w) for n, w in weights), F.lit(0.0))
        got = base.agg(F.sum(cut).alias("cut"), F.sum(free).alias("free")).first()
        if not got["free"] or got["cut"] >= goal:
            break
        after = (goal - got["cut"]) / got["free"]
        if after <= scale * (1 + 1e-12):
            break
        scale = after
    return float(scale)


def calibrate(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``docs(doc_id, text, lang, source)`` without the text, plus ``topic``, ``tokens``, ``weight``, ``probability``,
    ``kept`` and ``raking_error`` (the largest miss of a target share that raking left), per row.

    A null source is a source of its own (shown as an empty text), a language or topic without a target pools under
    ``other``. Documents without a token (null and empty texts) have weight and probability 0 and are not drawn.
    The draw hashes the id and the text, so repeated rows share their fate; a table without tokens draws nothing.
    """
    return calibrated(docs.select("doc_id", "text", "lang", "source"), budget).select(
        "doc_id", F.col("cell_source").alias("source"), F.col("cell_lang").alias("lang"), F.col("cell_topic").alias("topic"), "tokens",
        "weight", "probability", "kept", "raking_error")


def calibrated(docs: DataFrame, budget: float = BUDGET, names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` plus its cell columns, ``weight``, ``probability``, ``kept`` and ``raking_error``."""
    names = names or {c: c for c in docs.columns}
    cells = with_cells(docs, names["source"], names["lang"], names["text"])
    arrays = source_arrays(cells)
    sources = staged(arrays.withColumn("mass", F.aggregate("n", F.lit(0.0), lambda a, x: a + x)))
    fit = rake(sources)
    scale = scale_to_budget(sources, fit, budget)
    factors = np.outer(fit["lang"], fit["topic"])
    share = F.pow("mass", F.lit(SOURCE_POWER)) / F.lit(fit["power"])
    factor = sources.select("cell_source", (share / _dot(F.col("n"), factors.ravel())).alias("factor"))
    pair = F.lit(0.0)
    for i, lang in enumerate(LANGUAGES):
        for j, topic in enumerate(TOPICS):
            pair = F.when((F.col("cell_lang") == lang) & (F.col("cell_topic") == topic), F.lit(float(factors[i, j]))).otherwise(pair)
    draw = id_hash(SEED, F.col(names["doc_id"]), F.col(names["text"]))
    out = cells.withColumn("draw", draw).join(factor, "cell_source", "left")
    weight = F.when(F.col("tokens") > 0, F.coalesce(F.col("factor") * pair, F.lit(0.0))).otherwise(F.lit(0.0))
    out = out.withColumn("weight", weight).withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))
    return out.withColumn("kept", F.col("draw") < F.col("probability")).withColumn("raking_error", F.lit(fit["error"]))


def sample(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The drawn rows of ``docs``, with its columns."""
    safe, names = safe_names(docs)
    return calibrated(safe, budget, names).where("kept").select(*safe.columns).toDF(*docs.columns)
