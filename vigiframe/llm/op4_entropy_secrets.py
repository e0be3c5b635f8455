"""Secret scan in DataFrame expressions only: fixed patterns plus sliding-window entropy of candidate strings.

The patterns give the base spans. Base spans, UUIDs, dates and path segments with a placeholder word (the allow list)
are blanked out; candidate strings are the runs of 20 or more characters of keys and hashes in what is left, so the
rest of a run that they cover in part is still scanned. Over each candidate a window of 20 characters slides, one
character in and one out, with the counts of the window's characters and the sum of c * log2(c) over them updated in
place of a recount. A window's characters give its class (hexadecimal, single case, mixed case, with marks), and it
is hot if it has a digit and three letters and its Shannon entropy reaches the class's bits; lower-case windows with
marks are paths and slugs and never hot. The span from the first to the last hot window of a candidate is added.

A class's bits are set so that at most 5 in 100 uniformly random keys of 20 characters are missed (hexadecimal 3.5,
base32 3.5, lower case with digits 1.1, letters and digits 4.2, base64 4.6 in 100, digits and letters required); longer
keys have more windows and are missed less.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import safe_names

# The key words and shapes of the base kinds.
KEY_WORDS = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_LEAD = "(?:" + "|".join(map(_either_case, KEY_WORDS)) + r""")["']?\x20*[:=]\x20*["']?"""
ASSIGN = _LEAD + "[A-Za-z0-9+/_.=-]+"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
MIN_VALUE = 6               # characters of an assigned value
SCALE = 1 << 20
# Bits of entropy that a window of each class must reach: one alphabet's limit serves the larger ones of its class.
BITS = {"hex": 3.0, "single": 3.4, "mixed": 3.65, "marks": 3.65}
MIN_LETTERS = 3
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
BLANK = "="                 # stands for characters that are not scanned; no candidate has it
# Allow list: UUIDs and dates, and path segments that hold a placeholder.
UUID_OR_DATE = "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}"
COVERED = "AKIA[A-Z0-9]{16,}|" + HEX + "|" + UUID_OR_DATE
SEGMENT = "[A-Za-z0-9+_-]{4,}"
PLACEHOLDER = "(?i)(example|placeholder|changeme|dummy|sample|xxxx|0123456789|abcdefgh)"
# A window's counts are kept as digits to the base 32 of a few numbers, and so are its characters by kind.
SLOTS = 12
KINDS_OF_CHARACTER = ("digit", "upper", "lower", "mark", "not_hex")
WEIGHTED = [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WINDOW + 1)]


def hot_limit(bits: float) -> int:
    """Largest scaled sum of c * log2(c) that a window of at least ``bits`` of entropy can have."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * SCALE)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _with_prefix_sums(df: DataFrame, name: str, numbers: str, block: int = 256) -> DataFrame:
    """Add the sums of the numbers before each place: block sums first, so long arrays don't cost a square."""
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(numbers) - 1) / block)).cast("int")),
                         lambda b: _sum(F.slice(F.col(numbers), b * block + 1, F.lit(block))))
    df = df.withColumn(f"{name}_blocks", blocks)
    so_far = F.aggregate(f"{name}_blocks", F.array(F.lit(0).cast("bigint")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    df = df.withColumn(f"{name}_base", so_far)
    sums = F.transform(F.col(numbers), lambda x, i: F.element_at(f"{name}_base", (F.floor(i / block) + 1).cast("int"))
                       + _sum(F.slice(F.col(numbers), F.floor(i / block).cast("int") * block + 1, i % block)))
    return df.withColumn(name, sums).drop(f"{name}_blocks", f"{name}_base")


def _with_matches(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Add ``name``: an array of (start, end, hit) of the leftmost non-overlapping matches, in code points."""
    hits, gaps, steps, sums = (f"{name}_{x}" for x in ("hits", "gaps", "steps", "sums"))
    none = F.array().cast("array<string>")
    df = df.withColumn(hits, F.when(F.col(text).rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(text, pattern, -1)).otherwise(none))
    df = df.withColumn(steps, F.transform(hits, lambda h, i: (F.length(h) + F.length(F.col(gaps)[i])).cast("bigint")))
    df = _with_prefix_sums(df, sums, steps)
    spans = F.transform(hits, lambda h, i: F.struct((F.col(sums)[i] + F.length(F.col(gaps)[i])).alias("start"),
                                                     (F.col(sums)[i] + F.col(steps)[i]).alias("end"), h.alias("hit")))
    return df.withColumn(name, spans).drop(hits, gaps, steps, sums)


def _blanked(df: DataFrame, name: str, pattern: str, covers=None) -> DataFrame:
    """Column ``name`` with the matches of a pattern (those that ``covers`` says) blanked out, places unchanged."""
    hits, gaps = f"{name}_hits", f"{name}_gaps"
    found = F.col(name).rlike(pattern)
    df = df.withColumn(hits, F.when(found, F.regexp_extract_all(name, F.lit(pattern), 0))).withColumn(gaps, F.when(found, F.split(name, pattern, -1)))
    blank = lambda h: F.repeat(F.lit(BLANK), F.length(h))
    fill = (lambda h: F.when(covers(h), blank(h)).otherwise(h)) if covers else blank
    parts = F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(fill(F.get(F.col(hits), i)), F.lit(""))))
    return df.withColumn(name, F.when(F.col(hits).isNotNull(), F.array_join(parts, "")).otherwise(F.col(name))).drop(hits, gaps)


def _kind_weight(c: str) -> int:
    kinds = ("digit" if c.isdigit() else "upper" if c.isupper() else "lower" if c.islower() else "mark", "" if c in "0123456789abcdefABCDEF" else "not_hex")
    return sum(32 ** KINDS_OF_CHARACTER.index(k) for k in kinds if k)


def _hot_range(hit: Column) -> Column:
    """First and last hot place of a candidate's windows: struct(first, last), -1 if there is none."""
    numbers = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    weighted, slots, kinds = numbers(WEIGHTED), numbers(32 ** i for i in range(SLOTS)), numbers(map(_kind_weight, ALPHABET))
    zero = F.lit(0).cast("bigint")
    codes = F.transform(F.filter(F.split(hit, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    # Per place the character that comes in and the one that goes out (-1: none), with their digit and kind.
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), F.slice(codes, F.lit(1), F.size(codes) - WINDOW))
    described = F.zip_with(codes, leaving, lambda c, d: F.struct(
        c.alias("into"), d.alias("out"), F.get(slots, c % SLOTS).alias("into_slot"), F.when(d >= 0, F.get(slots, d % SLOTS)).otherwise(zero).alias("out_slot"),
        (F.get(kinds, c) - F.when(d >= 0, F.get(kinds, d)).otherwise(zero)).alias("kinds")))
    words = -(-len(ALPHABET) // SLOTS)
    start = F.struct(F.array_repeat(zero, words).alias("counts"), zero.alias("sum"), zero.alias("kinds"), F.lit(0).alias("place"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def digit(number: Column, slot: Column) -> Column:
        return F.call_function("div", number, slot).bitwiseAND(F.lit(31).cast("bigint")).cast("int")

    def step(state: Column, x: Column) -> Column:
        counts, place = state["counts"], state["place"]
        into_word, out_word = F.floor(x["into"] / SLOTS).cast("int"), F.floor(x["out"] / SLOTS).cast("int")
        old_in, old_out = digit(F.get(counts, into_word), x["into_slot"]), digit(F.get(counts, out_word), x["out_slot"])
        change = (F.get(weighted, old_in + 1) - F.get(weighted, old_in)
                  + F.when(x["out"] >= 0, F.get(weighted, old_out - 1) - F.get(weighted, old_out)).otherwise(zero))
        total = state["sum"] + F.when(x["into"] == x["out"], zero).otherwise(change)
        counts = F.transform(counts, lambda c, j: c + F.when(j == into_word, x["into_slot"]).otherwise(zero) - F.when(j == out_word, x["out_slot"]).otherwise(zero))
        return F.struct(counts.alias("counts"), total.alias("sum"), (state["kinds"] + x["kinds"]).alias("kinds"), (place + 1).alias("place"), state["first"].alias("first"),
                        state["last"].alias("last"))

    def judged(state: Column) -> Column:
        n = {k: F.shiftright(state["kinds"], 5 * i).bitwiseAND(F.lit(31).cast("bigint")) for i, k in enumerate(KINDS_OF_CHARACTER)}
        limit = (F.when(n["mark"] > 0, F.when(n["upper"] > 0, F.lit(hot_limit(BITS["marks"]))).otherwise(F.lit(-1)))
                 .when(n["not_hex"] == 0, F.lit(hot_limit(BITS["hex"])))
                 .when((n["upper"] > 0) & (n["lower"] > 0), F.lit(hot_limit(BITS["mixed"]))).otherwise(F.lit(hot_limit(BITS["single"]))))
        hot = (state["place"] >= WINDOW) & (state["sum"] <= limit) & (n["digit"] > 0) & (n["upper"] + n["lower"] >= MIN_LETTERS)
        first = F.when(hot & (state["first"] < 0), state["place"] - WINDOW).otherwise(state["first"])
        return F.struct(*[state[k].alias(k) for k in ("counts", "sum", "kinds", "place")], first.alias("first"), F.when(hot, state["place"]).otherwise(state["last"]).alias("last"))

    # The state after a step is bound to a name, so that the judgement doesn't work it out once per use.
    return F.aggregate(described, start, lambda s, x: F.get(F.transform(F.array(step(s, x)), judged), F.lit(0)),
                       lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``secrets``: an array of (start, kind, end), kind as a place in ``KINDS``, sorted by start, kind.

    Code points, ends exclusive. A null or empty text has none; every row is scanned for itself and whole. Other
    columns may have any name but ``secrets``.
    """
    safe, names = safe_names(docs)
    df = safe.withColumn("scan_text", F.coalesce(names[text], F.lit("")))
    for name, pattern in (("scan_assign", ASSIGN), ("scan_access", "AKIA[A-Z0-9]{16,}"), ("scan_hex", HEX)):
        df = _with_matches(df, "scan_text", name, pattern)
    long_enough = lambda hit: F.length(F.regexp_replace(hit, "^" + _LEAD, "")) >= MIN_VALUE
    assign = F.transform(F.filter("scan_assign", lambda m: long_enough(m["hit"])), lambda m: _span("assign", m["start"], m["end"]))
    access = F.transform("scan_access", lambda m: _span("access", m["start"], m["end"]))
    hexes = F.transform("scan_hex", lambda m: _span("hex", m["start"], m["end"]))
    df = df.withColumn("scan_base", F.array_sort(F.concat(assign, access, hexes)))

    # Only texts with a run of a candidate's length are blanked and scanned.
    df = df.withColumn("scan_rest", F.when(F.col("scan_text").rlike(CANDIDATE), F.col("scan_text")).otherwise(F.lit("")))
    for pattern, covers in ((ASSIGN, long_enough), (COVERED, None), (SEGMENT, lambda hit: hit.rlike(PLACEHOLDER))):
        df = _blanked(df, "scan_rest", pattern, covers)
    df = _with_matches(df, "scan_rest", "scan_run", CANDIDATE)
    df = df.withColumn("scan_open", F.filter("scan_run", lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]")))
    df = df.withColumn("scan_hot", F.transform("scan_open", lambda m: F.struct(m["start"].alias("start"), _hot_range(m["hit"]).alias("hot"))))
    hot = F.transform(F.filter("scan_hot", lambda m: m["hot"]["first"] >= 0),
                      lambda m: _span("entropy", m["start"] + m["hot"]["first"], m["start"] + m["hot"]["last"]))
    df = df.withColumn("secrets", F.array_sort(F.concat("scan_base", hot)))
    return df.select(*safe.columns, "secrets").toDF(*docs.columns, "secrets")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy)`` per row of ``docs(doc_id, text)``."""
    found = find_secrets(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    base = F.filter("secrets", lambda s: s["kind"] < KINDS.index("entropy"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
                        _written(F.col("secrets")).alias("spans"), count("entropy"))


def redact(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` (overlapping spans by one) and ``n_chars``, if
    there is one, counted anew; texts without a secret, nulls and all other columns stay as they are."""
    safe, names = safe_names(docs)
    text = names["text"]
    found = find_secrets(safe, text)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, x: Column) -> Column:
        gap = F.concat(F.substring(F.col(text), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark))
        fresh = (x["start"] >= s["at"]) & ((F.size(s["parts"]) == 0) | (x["start"] > s["at"]))
        parts = F.when(fresh, F.concat(s["parts"], F.array(gap))).otherwise(s["parts"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), parts.alias("parts"))

    tail = lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(F.col(text), (s["at"] + 1).cast("int"), F.lit((1 << 31) - 1)))
    clean = F.when(F.size("secrets") > 0, F.aggregate("secrets", start, step, tail)).otherwise(F.col(text))
    out = found.withColumn("clean", clean)
    columns = {text: F.col("clean")}
    if "n_chars" in names:
        columns[names["n_chars"]] = F.when(F.size("secrets") > 0, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(names["n_chars"]))
    return out.select(*[columns.get(c, F.col(c)).alias(c) for c in safe.columns]).toDF(*docs.columns)


def oracle_sql(table: str = "documents") -> str:
    """DuckDB SQL for ``scan``; it counts every window's characters anew."""
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def matches(kind: int, pattern: str, table: str = "d") -> str:
        p = quoted(pattern)
        return f"""SELECT rid, {kind} AS kind, m[i] AS hit,
  coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT rid, m, g, unnest(range(1, len(m) + 1)) AS i FROM
    (SELECT rid, regexp_extract_all(t, {p}) AS m, string_split_regex(t, {p}) AS g FROM {table} WHERE regexp_matches(t, {p})))"""

    def blanked(table: str, pattern: str, covers: str = "true") -> str:
        p = quoted(pattern)
        return f"""SELECT rid, CASE WHEN regexp_matches(t, {p}) THEN array_to_string(list_transform(range(1, len(g) + 1), lambda i: g[i] || CASE WHEN i > len(m) THEN ''
  WHEN {covers} THEN repeat('{BLANK}', length(m[i])) ELSE m[i] END), '') ELSE t END AS t
  FROM (SELECT rid, t, regexp_extract_all(t, {p}) AS m, string_split_regex(t, {p}) AS g FROM {table})"""

    long_enough = f"length(regexp_replace(m[i], {quoted('^' + _LEAD)}, '')) >= {MIN_VALUE}"
    limit = f"""CASE WHEN regexp_matches(w, '[+/_-]') THEN CASE WHEN regexp_matches(w, '[A-Z]') THEN {hot_limit(BITS["marks"])} ELSE -1 END
    WHEN regexp_matches(w, '^[0-9a-fA-F]*$') THEN {hot_limit(BITS["hex"])}
    WHEN regexp_matches(w, '[A-Z]') AND regexp_matches(w, '[a-z]') THEN {hot_limit(BITS["mixed"])} ELSE {hot_limit(BITS["single"])} END"""
    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
    one = f"{names} || ':' || a || ':' || b"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {table}),
base AS (SELECT rid, kind, CAST(a AS BIGINT) AS a, CAST(a + length(hit) AS BIGINT) AS b FROM (
  SELECT * FROM ({matches(0, ASSIGN)}) WHERE length(regexp_replace(hit, {quoted("^" + _LEAD)}, '')) >= {MIN_VALUE}
  UNION ALL {matches(1, "AKIA[A-Z0-9]{16,}")}
  UNION ALL {matches(2, HEX)})),
rest1 AS ({blanked("d", ASSIGN, long_enough)}),
rest2 AS ({blanked("rest1", COVERED)}),
rest3 AS ({blanked("rest2", SEGMENT, f"regexp_matches(m[i], {quoted(PLACEHOLDER)})")}),
runs AS (SELECT rid, hit, CAST(a AS BIGINT) AS a, row_number() OVER () AS run FROM ({matches(3, CANDIDATE, "rest3")})
  WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')),
windows AS (SELECT rid, run, a, i, substr(hit, i + 1, {WINDOW}) AS w FROM (SELECT *, unnest(range(0, length(hit) - {WINDOW - 1})) AS i FROM runs)),
hot AS (SELECT rid, run, a, i FROM windows WHERE regexp_matches(w, '[0-9]') AND length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= {MIN_LETTERS}
  AND list_sum(list_transform(map_values(list_histogram(string_split(w, ''))), lambda x: {WEIGHTED}[CAST(x AS BIGINT) + 1])) <= {limit}),
spans AS (SELECT rid, kind, a, b FROM base
  UNION ALL SELECT rid, 3, any_value(a) + min(i), any_value(a) + max(i) + {WINDOW} FROM hot GROUP BY rid, run),
found AS (SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2, count(*) FILTER (kind = 3) AS n3,
  string_agg({one}, ',' ORDER BY a, kind) FILTER (kind < 3) AS base, string_agg({one}, ',' ORDER BY a, kind) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n3, 0) AS n_entropy
FROM d LEFT JOIN found USING (rid)"""
