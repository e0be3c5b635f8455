"""Sources: delimited text, fixed-width records, nested/tabular JSON, Parquet,
manifests and version catalogues.

All readers return lazy DataFrames with declared schemas (nothing is inferred
from data), so a scan costs one pass and Catalyst can prune and push filters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.functions.scalars import remove_cr, strict_long, strip_space, unquote_leading
from vigiframe.operators.columns import drop_blank_names, normalize_names

# ---------------------------------------------------------------- delimited


def read_delimited(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1",
                   multi_line: bool = True, header: bool = True, partitions: int | None = None) -> DataFrame:
    """Semicolon text, quote '"', every column text, empty fields kept as ''.

    ``multi_line=True`` reads quoted line breaks (the file is then one task per
    file); pass False for large clean files so Spark splits them. ``partitions``
    spreads the rows round-robin right after the scan, so the per-row cleaning
    that follows does not run in the single task that read a multi-line file.
    """
    df = (spark.read.option("sep", sep).option("quote", '"').option("escape", '"')
          .option("header", header).option("encoding", encoding)
          .option("multiLine", multi_line).option("inferSchema", False)
          .option("mode", "PERMISSIVE").csv(path))
    if partitions:
        df = df.repartition(partitions)
    return df.na.fill("")


def read_delimited_strict(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Like ``read_delimited``, but a file with quoted line breaks is read by many tasks, and a record with surplus or
    missing fields fails the job. Blank lines are skipped. The first record of a file is its header; files of one path
    must have the same. ``encoding`` must write quotes, separators and line ends as ASCII does.

    One pass counts the lines with an odd number of quotes. Where there is none no field holds a line break, and the
    plain splitting reader serves. Otherwise ``quoted_records`` puts lines together.
    """
    names = (spark.read.option("sep", sep).option("quote", '"').option("escape", '"').option("header", True)
             .option("encoding", encoding).option("inferSchema", False).csv(path).columns)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BROKEN]])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    lines = _lines(spark, path, encoding)
    if lines.where(F.regexp_count("line", F.lit('"')) % 2 == 1).isEmpty():
        rows = spark.read.schema(schema).options(**options).option("header", True).option("encoding", encoding).csv(path)
    else:
        records = quoted_records(lines)
        heads = records.where("is_first").select("record").distinct().limit(2).collect()
        if len(heads) > 1:
            raise ValueError(f"files at {path} have different headers")
        parsed = records.where(~F.col("is_first")).select(F.from_csv("record", _ddl(schema), options).alias("r"))
        rows = parsed.select("r.*")
    wrong = F.col(_BROKEN).isNotNull()
    fail = F.raise_error(F.concat(F.lit(f"not {len(names)} fields: "), F.substring(F.col(_BROKEN), 1, 200)))
    # The test sits in every column, so that reading any of them runs it.
    rows = rows.withColumn("_sound", F.when(wrong, fail.cast("boolean")).otherwise(F.lit(True)))
    return rows.select(*[F.when(F.col("_sound"), F.coalesce(F.col(f"`{n}`"), F.lit(""))).alias(n) for n in names])


_BROKEN = "_broken"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with their place: file, block of the file (as Spark splits it), and order in the block."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("place"), F.decode(F.col("value").cast("binary"), encoding).alias("line"))


def quoted_records(lines: DataFrame) -> DataFrame:
    """Lines (file, block, place, line) -> records: ``record``, and ``is_first`` of its file.

    A line end inside quotes belongs to the record, and whether a block starts inside quotes depends on all before it. A
    block has an even or an odd number of quotes, and that alone decides how it changes either state; so the blocks'
    parities are computed side by side, a running sum over the few blocks of a file gives each one's start state, and
    every block is then cut by itself. A record that runs over blocks carries the place where it starts.
    """
    counted = lines.withColumn("quotes", F.regexp_count("line", F.lit('"')) % 2)
    blocks = counted.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    within = Window.partitionBy("file", "block").orderBy("place")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.join(blocks.select("file", "block", "start"), ["file", "block"])
    # 0: the line begins outside quotes, so it begins a record.
    placed = placed.withColumn("inside", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) + F.col("start")) % 2)
    placed = placed.withColumn("is_first", (F.col("block") == 0) & (F.row_number().over(within) == 1))
    placed = placed.withColumn("own", F.max(F.when(F.col("inside") == 0, F.col("place"))).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    whole = placed.where((F.col("inside") == 0) & (F.col("quotes") == 0)).select(F.col("line").alias("record"), "is_first")
    pieces = placed.where((F.col("inside") == 1) | (F.col("quotes") == 1))
    # Lines of a block before its first record start belong to the last record that started in an earlier block.
    starts = pieces.where("inside = 0").groupBy("file", "block").agg(F.max("place").alias("last"))
    heads = pieces.where(F.col("own").isNull()).select("file", "block").distinct()
    tail = starts.select("file", F.col("block").alias("from_block"), F.col("last").alias("from_place"))
    owners = (heads.join(tail, "file").where(F.col("from_block") < F.col("block"))
              .groupBy("file", "block").agg(F.max(F.struct("from_block", "from_place")).alias("owner")))
    joined = pieces.join(owners, ["file", "block"], "left").select(
        "file", "block", "place", "line", "is_first", F.coalesce(F.when(F.col("own").isNotNull(), F.struct(F.col("block").alias("from_block"), F.col("own").alias("from_place"))),
        F.col("owner")).alias("key"))
    # A record's own lines, in file order.
    long = joined.groupBy("file", "key").agg(F.array_sort(F.collect_list(F.struct("block", "place", "line", "is_first"))).alias("parts"))
    long = long.select(F.array_join(F.col("parts.line"), "\n").alias("record"), F.element_at("parts", 1)["is_first"].alias("is_first"))
    text = F.regexp_replace(F.regexp_replace("record", "\r$", ""), "\r\n", "\n")
    return whole.unionByName(long).select(text.alias("record"), "is_first").where(F.trim("record") != "")


def parse_delimited(line, schema: str, sep: str = ";") -> Column:
    """Column form of the delimited reader: one text line -> struct of text fields."""
    line = F.col(line) if isinstance(line, str) else line
    return F.from_csv(line, schema, {"sep": sep, "quote": '"', "escape": '"'})


def read_csv_clean(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """UTF-8 (optional BOM) text with LF or CRLF ends and a trailing separator.

    Names: BOM and CR removed, stripped, lowercased, blank/generated ones
    dropped. Values: CR removed, a leading quoted run unquoted, '' kept.
    """
    df = (spark.read.option("sep", sep).option("quote", '"').option("escape", '"')
          .option("header", True).option("encoding", "UTF-8").option("inferSchema", False)
          .csv(path))
    names = [c.replace("﻿", "").replace("\r", "") for c in df.columns]
    df = df.toDF(*names)
    df = drop_blank_names(normalize_names(df))
    return df.select(*[clean_csv_value(F.col(f"`{c}`")).alias(c) for c in df.columns])


def clean_csv_value(c: Column) -> Column:
    return unquote_leading(remove_cr(F.coalesce(c, F.lit(""))))


# ---------------------------------------------------------------- fixed width


@dataclass(frozen=True)
class Field:
    """A fixed-width field: name, byte length, kind ('C' text, 'N' number) and decimals."""
    name: str
    length: int
    kind: str = "C"
    decimals: int = 0


def decode_fixed_width(record, fields: list[Field], deleted_flag: bool = True) -> list[Column]:
    """Cut a fixed-width record (binary or latin-1 text) into text columns.

    Byte 1 is the deletion flag when ``deleted_flag``; every field is decoded
    from latin-1 and trimmed the way Python's ``str.strip`` does, blank -> null.
    Type the result with ``type_fields`` in a *separate* projection, so the typing
    expressions reference plain columns instead of repeating the decode.
    """
    rec = F.col(record) if isinstance(record, str) else record
    pos = 2 if deleted_flag else 1
    out = []
    if deleted_flag:
        out.append(F.decode(F.substring(rec.cast("binary"), 1, 1), "ISO-8859-1").alias("_flag"))
    for f in fields:
        raw = F.decode(F.substring(rec.cast("binary"), pos, f.length), "ISO-8859-1")
        out.append(F.nullif(strip_space(raw), F.lit("")).alias(f.name))
        pos += f.length
    return out


def type_fields(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Numeric fields with no decimals -> bigint (non-integer text fails the job);
    all other fields stay text, as the reference keeps them."""
    kinds = {f.name: f for f in fields}
    return df.select(*[strict_long(F.col(c), c).alias(c)
                       if c in kinds and kinds[c].kind in ("N", "F") and kinds[c].decimals == 0 else F.col(c)
                       for c in df.columns])


def decode_records(df: DataFrame, record: str, fields: list[Field], keep: list[str] | None = None,
                   deleted_flag: bool = True) -> DataFrame:
    """Records -> live (not deleted) rows with typed fields, in staged projections."""
    cut = df.select(*(keep or []), *decode_fixed_width(record, fields, deleted_flag))
    if deleted_flag:
        cut = cut.filter(F.coalesce(F.col("_flag"), F.lit(" ")) != "*").drop("_flag")
    return type_fields(cut, fields)


def read_fixed_width(spark: SparkSession, path: str, fields: list[Field]) -> DataFrame:
    """Distributed decode of fixed-width binary files with a DBF-style header, one task per range of records.

    Header: record count (uint32 at byte 4), header length (uint16 at 8), record length (uint16 at 10). Records
    start after the header; byte 1 of a record is '*' when it is deleted. A short last record ends the read.
    """
    from vigiframe.sources.fixed_width_source import read_fixed_width_split
    return read_fixed_width_split(spark, path, fields)


def fixed_width_counts(spark: SparkSession, path: str) -> DataFrame:
    """Header record count versus whole records present, per file (short tail report); reads the headers only."""
    from vigiframe.sources.fixed_width_source import header_size_counts, list_files
    rows = [(f, *header_size_counts(f)) for f in list_files(path)]
    return spark.createDataFrame(rows, "path string, n_header bigint, n_whole bigint")


# ---------------------------------------------------------------- JSON


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file holding one JSON array of objects, read with a declared schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_json(col, schema: T.DataType | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def rows_after_header(payload, element_schema: T.DataType | str) -> Column:
    """Tabular JSON (array whose element 0 is a header row): the data elements.
    Use with ``posexplode`` semantics via ``F.explode``; an array holding only the
    header yields nothing, a payload that isn't such an array fails the job."""
    c = F.col(payload) if isinstance(payload, str) else payload
    schema = f"array<{element_schema}>" if isinstance(element_schema, str) else T.ArrayType(element_schema)
    broken = F.raise_error(F.concat(F.lit("broken JSON payload: "), F.substring(c, 1, 80)))
    # Every expression stands once, so a payload is parsed once.
    return F.filter(F.coalesce(F.from_json(c, schema), F.when(c.isNotNull(), broken)), lambda _, place: place > 0)


def period_ids(payload) -> Column:
    """Period ids from period metadata in any of three shapes: a list of objects
    ``[{"id": ..}]``, a list of scalars, or ``{"periodos": [...], "periodicidade":
    {"fim": ..}}``; digits-only ids, distinct and sorted (as text)."""
    c = F.col(payload) if isinstance(payload, str) else payload
    arr = F.when(F.trim(c).startswith("["), c).otherwise(F.get_json_object(c, "$.periodos"))
    ids = F.transform(F.from_json(arr, "array<string>"), lambda e: F.coalesce(F.get_json_object(e, "$.id"), e))
    ids = F.concat(F.coalesce(ids, F.array().cast("array<string>")),
                   F.array(F.get_json_object(c, "$.periodicidade.fim")))
    return F.array_sort(F.array_distinct(F.filter(ids, lambda x: x.rlike("^[0-9]+$"))))


# ---------------------------------------------------------------- Parquet


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


STATE_FILE = r"[0-9]+\.parquet"


def has_state_files(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds files named after digit-only state codes."""
    from vigiframe.sinks.store import names
    return any(re.fullmatch(STATE_FILE, n) for n in names(spark, folder))


def read_state_files(spark: SparkSession, folder: str, states: list[str] | None = None) -> DataFrame:
    """``folder/*.parquet`` whose stem is all digits, with the stem (the state's code) as column ``co_uf``.

    The listing decides which files are read: other stems, and with ``states`` other states, are never opened. A file's
    own ``co_uf`` column gives way to its name.
    """
    from vigiframe.sinks.store import names
    stems = [n.removesuffix(".parquet") for n in names(spark, folder) if re.fullmatch(STATE_FILE, n)]
    missing = sorted(set(states or []) - set(stems))
    if missing:
        raise ValueError(f"no state files {missing} in {folder}")
    wanted = [s for s in stems if states is None or s in states]
    if not wanted:
        raise ValueError(f"no state files in {folder}")
    df = spark.read.parquet(*[f"{folder.rstrip('/')}/{s}.parquet" for s in wanted])
    return df.withColumn("co_uf", F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9]+)\.parquet$", 1))


# ---------------------------------------------------------------- manifests

FILE_ENTRY = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("sha256", T.StringType()),
    T.StructField("rows", T.LongType()),
    # ICD-style entries carry these instead
    T.StructField("csv_path", T.StringType()), T.StructField("parquet_path", T.StringType()),
    T.StructField("source_url", T.StringType()), T.StructField("csv_sha256", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("reference_id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("partition", T.StringType()),
    T.StructField("municipality_filter_column", T.StringType()),
    T.StructField("generated_at_utc", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("years", T.ArrayType(T.IntegerType())), T.StructField("rows", T.LongType()),
    T.StructField("files", T.MapType(T.StringType(), FILE_ENTRY)),
    T.StructField("file", FILE_ENTRY), T.StructField("columns", T.ArrayType(T.StringType())),
])


def read_manifests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest JSON documents (all fields optional)."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)


def manifest_files(manifests: DataFrame) -> DataFrame:
    """One row per published file of each manifest (``explode`` of the files map)."""
    return manifests.select("reference_id", "version",
                            F.explode("files").alias("part", "entry")).select(
        "reference_id", "version", "part", "entry.path", "entry.sha256", "entry.rows")


# ---------------------------------------------------------------- catalogues


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """File listing (name, size, time) of one or more folders without reading contents."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).load(path))
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                     "length", "modificationTime")


def catalog_versions(listing: DataFrame, name: str, pattern: str, group: int = 1) -> DataFrame:
    """Names matching ``pattern`` (case-insensitive, whole name) with the version cut out."""
    rx = f"(?i)^{pattern}$"
    return (listing.filter(F.col(name).rlike(rx))
            .withColumn("version", F.regexp_extract(F.col(name), rx, group)))
