"""Sinks: schema conformance, committed state-partitioned publication, change-gated swaps, file hashes, content
fingerprints and manifests.

A run writes into a folder of its own and is complete before anything points to it: the rows are counted and
fingerprinted while they are written, read back whole and compared, and every file is hashed and listed. Then one
document (``sinks.store``) switches to the new run. Readers follow the document, so they see the old run or the new
one, never a mixture; a run that fails or is killed leaves the document, and the old run's files, as they were.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.functions.scalars import NO_STATE_BUCKET, row_fingerprint, state_bucket
from vigiframe.sinks.hash_source import FileHashDataSource
from vigiframe.sinks.store import Document, qualified, remove

MISFIT, RAW = "_misfit", "_raw"


class ValidationError(ValueError):
    pass


class QuarantineError(ValidationError):
    """Rows that don't fit the schema; they are in the folder ``path``, with the reasons."""

    def __init__(self, rows: int, path: str):
        super().__init__(f"{rows} rows do not fit the schema, see {path}")
        self.rows, self.path = rows, path

# ---------------------------------------------------------------- K1 conform


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` in its column order; a value that does not fit its
    type fails the job (under ANSI on or off), never turns silently into null."""
    cols = []
    for f in schema.fields:
        src = F.col(f"`{f.name}`")
        cast = src.try_cast(f.dataType)
        cols.append(F.when(src.isNotNull() & cast.isNull(), F.raise_error(
            F.concat(F.lit(f"value does not fit {f.name} {f.dataType.simpleString()}: "),
                     src.cast("string")))).otherwise(cast).alias(f.name))
    return df.select(*cols)


def fit(df: DataFrame, schema: T.StructType, exact: bool = True) -> DataFrame:
    """Cast every column to ``schema`` and say of each row what does not fit, in one projection.

    Adds ``_misfit`` (one text per column that does not fit: a value that its type can't hold, or a null where the
    schema allows none) and ``_raw`` (the row as JSON, only where something does not fit). ``write_run`` keeps these
    rows out of the table. A missing column, or with ``exact`` an extra one, fails at once.
    """
    names = [f.name for f in schema.fields]
    missing, extra = sorted(set(names) - set(df.columns)), sorted(set(df.columns) - set(names))
    if missing or (exact and extra):
        raise ValidationError(f"missing columns {missing}, unknown columns {extra if exact else []}")
    cast, reasons = [], []
    for f in schema.fields:
        src = F.col(f"`{f.name}`")
        value = src if df.schema[f.name].dataType == f.dataType else src.try_cast(f.dataType)
        cast.append(value.alias(f.name))
        if value is not src:
            reasons.append(F.when(src.isNotNull() & value.isNull(), F.lit(f"{f.name}: does not fit {f.dataType.simpleString()}")))
        if not f.nullable:
            reasons.append(F.when(src.isNull(), F.lit(f"{f.name}: missing")))
    misfit = F.filter(F.array(*reasons), lambda r: r.isNotNull()) if reasons else F.array().cast("array<string>")
    raw = F.when(F.size(misfit) > 0, F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])))
    return df.select(*cast, misfit.alias(MISFIT), raw.alias(RAW))


# ---------------------------------------------------------------- K2 committed runs


@dataclass(frozen=True)
class Run:
    """A complete, verified folder of Parquet files that nothing points to yet."""
    path: str
    key: str | None
    schema: T.StructType
    rows: int
    fingerprint: str
    listing: str
    buckets: int = 0
    bucket_keys: tuple[str, ...] = ()

    def entry(self) -> dict:
        """How documents describe the run."""
        bucketed = {"buckets": self.buckets, "bucket_keys": list(self.bucket_keys)} if self.buckets else {}
        return {"path": self.path, "key": self.key, "schema": self.schema.json(), "rows": self.rows, "fingerprint": self.fingerprint,
                "listing": self.listing, **bucketed}


def partition_layout(df: DataFrame, key: str, sort_keys: list[str], blank: str = NO_STATE_BUCKET) -> DataFrame:
    """Layout for a partitioned write: blank keys bucketed, rows range-partitioned on
    (key, sort keys) so a hot key is spread over several tasks, and sorted inside
    each task (tight row-group statistics for pushed-down filters)."""
    out = df.withColumn(key, state_bucket(key, blank))
    order = [key] + sort_keys
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def new_run_id() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


# Folders that the entries of a run's listing are dealt over, so that a reader of one part opens one of them.
LISTING_SHARDS = 64
LISTING_SCHEMA = "part string, path string, file string, rows bigint, fingerprint string, length bigint, sha256 string, shard int"


def listing_shard(part: Column) -> Column:
    return F.pmod(F.xxhash64(part), F.lit(LISTING_SHARDS)).cast("int")


def read_listing(spark: SparkSession, path: str, part: str | None = None) -> DataFrame:
    """One row per published file: its part, path, rows, content fingerprint, length and SHA-256."""
    rows = spark.read.schema(LISTING_SCHEMA).json(path)
    return rows if part is None else rows.where((F.col("shard") == listing_shard(F.lit(part))) & (F.col("part") == part))


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A run's rows, with the types they were written with whatever the session infers from folder names."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_run(spark: SparkSession, entry: dict) -> DataFrame:
    """The rows of a run as a document describes it; parts that a later run has replaced are pruned."""
    if entry.get("buckets"):
        return spark.table(_bucket_table(spark, entry))
    rows = _written(spark, entry["path"], T.StructType.fromJson(json.loads(entry["schema"])))
    return rows.where(~F.col(f"`{entry['key']}`").isin(entry["without"])) if entry.get("without") else rows


def _bucket_name(path: str) -> str:
    return f"vigiframe_{posixpath.basename(path).replace('-', '_').lower()}"


def _bucket_table(spark: SparkSession, entry: dict) -> str:
    """The session's name for a bucketed run. Only tables carry buckets, so a session that doesn't know the run yet
    enters it, as an external table over the run's files."""
    name = _bucket_name(entry["path"])
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(entry["schema"])).fields)
        keys = ", ".join(f"`{k}`" for k in entry["bucket_keys"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {int(entry['buckets'])} BUCKETS LOCATION '{entry['path']}'")
    return name


def publish_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Publish ``df`` as the new table at ``path``, in ``buckets`` files by hash of ``keys``, sorted by them, and return
    it as read back. Tables with the same keys (and types) and number of buckets join and group by the keys without a
    shuffle."""
    run = write_run(df, path, buckets=buckets, bucket_keys=keys)
    return read_run(df.sparkSession, commit_run(df.sparkSession, path, run))


def write_run(df: DataFrame, target: str, key: str | None = None, sort_keys: list[str] | None = None, blank: str = NO_STATE_BUCKET,
              max_records_per_file: int = 5_000_000, allow_empty: bool = True, buckets: int = 0, bucket_keys: list[str] | None = None) -> Run:
    """Write rows to a new folder below ``target`` and prove that what can be read there is what was written.

    Count and content fingerprint are observed in the writing stage itself (after the last shuffle, so that a task that
    is run again counts once). The files are then decoded whole, one row per file goes to the listing together with the
    file's SHA-256, and the listing must add up to what was observed. Rows that ``fit`` marked go to a quarantine folder
    and fail the run.
    """
    spark = df.sparkSession
    run_id = new_run_id()
    path = qualified(spark, posixpath.join(target, "_runs", run_id))
    laid = partition_layout(df, key, sort_keys or [], blank) if key else df
    if buckets:                                     # one task a bucket, so one file a bucket
        laid = df.repartition(buckets, *bucket_keys)
    columns = [c for c in laid.columns if c not in (MISFIT, RAW)]
    fits = F.size(MISFIT) == 0 if MISFIT in laid.columns else F.lit(True)
    hashed = row_fingerprint(*columns)
    seen = Observation()
    observed = laid.observe(seen, F.count_if(fits).alias("rows"), F.count_if(~fits).alias("misfits"),
                            *[F.sum(F.when(fits, limb)).alias(name) for name, limb in _limbs(hashed)])
    kept = observed.where(fits).select(*[F.col(f"`{c}`") for c in columns])
    if buckets:
        kept.write.bucketBy(buckets, *bucket_keys).sortBy(*bucket_keys).format("parquet").option("path", path).saveAsTable(_bucket_name(path))
    else:
        writer = kept.write.option("maxRecordsPerFile", max_records_per_file)
        (writer.partitionBy(key) if key else writer).parquet(path)
    counts = seen.get
    if counts["misfits"]:
        aside = qualified(spark, posixpath.join(target, "_quarantine", run_id))
        df.where(F.size(MISFIT) > 0).select(F.col(MISFIT).alias("reasons"), F.col(RAW).alias("row")).write.json(aside)
        raise QuarantineError(counts["misfits"], aside)
    if not counts["rows"] and not allow_empty:
        raise ValidationError(f"no rows to publish below {target}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept.schema.fields])
    listing = _list_run(spark, path, run_id, key, schema, posixpath.join(target, "_listings", run_id))
    total = _as_number(counts["hi"], counts["mid"], counts["lo"])
    found = read_listing(spark, listing).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                                             F.coalesce(F.sum(F.col("fingerprint").cast("decimal(38,0)")), F.lit(0)).alias("fp"),
                                             F.count_if(F.col("sha256").isNull()).alias("unhashed")).first()
    if found["rows"] != counts["rows"] or int(found["fp"]) != total or found["unhashed"]:
        raise ValidationError(f"{path} does not hold what was written: {found['rows']} of {counts['rows']} rows read back")
    return Run(path, key, schema, counts["rows"], str(total), listing, buckets, tuple(bucket_keys or ()))


def _list_run(spark: SparkSession, path: str, run_id: str, key: str | None, schema: T.StructType, listing: str) -> str:
    """Decode every file of a run and write its listing; the listing's place is returned."""
    back = _written(spark, path, schema)
    # file_path is a URI: what it escapes is written plainly again, as the hashes' listing has it.
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    part = F.col(f"`{key}`") if key else F.lit("all")
    rows = back.select("*", part.alias("_part"), F.regexp_extract(place, f"{run_id}/(.*)$", 1).alias("_file"))
    files = fingerprint(rows, [f.name for f in schema.fields], ["_part", "_file"])
    hashes = file_hashes(spark, path).select(F.regexp_extract("path", f"{run_id}/(.*)$", 1).alias("_file"), "length", "sha256")
    folder = F.when(F.instr("_file", "/") > 0, F.concat(F.lit("/"), F.substring_index("_file", "/", 1))).otherwise(F.lit(""))
    listed = files.join(hashes, "_file", "left").select(
        F.col("_part").alias("part"), F.concat(F.lit(path), folder).alias("path"), F.concat(F.lit(path + "/"), F.col("_file")).alias("file"),
        "rows", "fingerprint", "length", "sha256", listing_shard(F.col("_part")).alias("shard"))
    listed.repartition("shard").write.partitionBy("shard").json(listing)
    return qualified(spark, listing)


def table_document(spark: SparkSession, target: str) -> Document:
    """The document that says which run is the table at ``target`` (its name is hidden from Spark's readers)."""
    return Document(spark, posixpath.join(target, "_table.json"))


def commit_run(spark: SparkSession, target: str, run: Run) -> dict:
    """Make a run the table; earlier runs stay where they are for those who read them."""
    return table_document(spark, target).update(lambda old: {**run.entry(), "committed_at_utc": utc_now()})


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the table at ``target``, as of now: a later commit does not touch what this plan reads."""
    entry = table_document(spark, target).read()
    if entry is None:
        raise ValidationError(f"nothing is published at {target}")
    return read_run(spark, entry)


def expire_runs(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Remove the files of all committed runs but the newest ``keep`` of the table at ``target``.

    Maintenance, never done by a writer: whoever still reads an older run loses it. Runs that were never committed are
    left alone, as they may be on their way.
    """
    document = table_document(spark, target)
    last = document.revision()
    entries = [e for e in (document.read(r) for r in range(1, last + 1)) if e]
    kept = {e["path"] for e in entries[-keep:]}
    old = sorted({e["path"] for e in entries} - kept)
    for e in entries:
        if e["path"] not in kept:
            remove(spark, e["path"])
            remove(spark, e["listing"])
    return old


def publish_partitioned(df: DataFrame, path: str, key: str, sort_keys: list[str],
                        max_records_per_file: int = 5_000_000, blank: str = NO_STATE_BUCKET) -> DataFrame:
    """Publish one folder per key value as the new table at ``path`` and return rows per key, as the files read back."""
    run = write_run(df, path, key, sort_keys, blank, max_records_per_file)
    commit_run(df.sparkSession, path, run)
    return rows_per_part(df.sparkSession, run).withColumnRenamed("part", key)


def rows_per_part(spark: SparkSession, run: Run) -> DataFrame:
    return read_listing(spark, run.listing).groupBy("part").agg(F.sum("rows").cast("long").alias("rows"))


def publish_nonempty(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> int:
    """Write rows (in as many files as needed) and return how many; an empty result fails before anything is replaced.

    The emptiness check reads one row; the plan runs once for the write, whose rows are counted as they pass.
    """
    if df.isEmpty():
        raise ValueError(f"no rows to publish at {path}")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
        .option("maxRecordsPerFile", max_records_per_file).parquet(path)
    return seen.get["rows"]


# ---------------------------------------------------------------- M1 / M2 hashes


def file_hashes(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """SHA-256 of each file under ``path``: one task per file, which reads it in blocks, so files may have any size.

    A path that only Spark has a file system for is read as ``binaryFile`` values instead (2 GB a file).
    """
    if _python_opens(path):
        spark.dataSource.register(FileHashDataSource)
        return spark.read.format("filehashes").option("path", path).option("glob", glob).load()
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", True).load(path))
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def _python_opens(path: str) -> bool:
    from vigiframe.sources.fixed_width_source import _filesystem
    try:
        _filesystem(path)
        return True
    except Exception:  # noqa: BLE001 - pyarrow's errors for unknown schemes and missing libraries differ
        return False


_LIMB = (1 << 20) - 1


def _limbs(h: Column) -> list[tuple[str, Column]]:
    """A 60-bit hash in three limbs of 20 bits, whose sums stay exact longs."""
    return [("lo", h.bitwiseAND(_LIMB)), ("mid", F.shiftright(h, 20).bitwiseAND(_LIMB)), ("hi", F.shiftright(h, 40))]


def _as_number(hi: int | None, mid: int | None, lo: int | None) -> int:
    return ((hi or 0) << 40) + ((mid or 0) << 20) + (lo or 0)


def fingerprint(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Content fingerprint per group: row count and the exact sum of 60-bit row hashes.

    Order-free, partitioning-free and duplicate-sensitive, so it can decide
    "changed or not" for Spark outputs whose part files are not byte-stable.
    The sum is kept exact as three bigint sums of 20-bit limbs (primitive,
    codegen'd partial aggregation; exact up to 2^43 rows per group), combined
    into a decimal only on the final, one-row-per-group result.
    """
    h = row_fingerprint(*columns)
    hashed = df.select(*(by or []), h.alias("_h"))
    sums = hashed.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(limb).alias(f"_{name}") for name, limb in _limbs(F.col("_h"))])
    total = (F.coalesce(F.col("_hi"), F.lit(0)).cast("decimal(38,0)") * F.lit(1 << 40)
             + F.coalesce(F.col("_mid"), F.lit(0)).cast("decimal(38,0)") * F.lit(1 << 20)
             + F.coalesce(F.col("_lo"), F.lit(0)).cast("decimal(38,0)"))
    return sums.select(*(by or []), "rows", total.cast("decimal(38,0)").cast("string").alias("fingerprint"))


def changed_parts(new: DataFrame, old: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Parts whose fingerprint or row count differ between two snapshots
    (also parts present on one side only)."""
    a = fingerprint(new, columns, by).withColumnsRenamed({"rows": "rows_new", "fingerprint": "fp_new"})
    b = fingerprint(old, columns, by).withColumnsRenamed({"rows": "rows_old", "fingerprint": "fp_old"})
    j = a.join(b, by, "full_outer")
    status = (F.when(F.col("fp_old").isNull(), F.lit("added"))
              .when(F.col("fp_new").isNull(), F.lit("removed"))
              .when((F.col("fp_new") != F.col("fp_old")) | (F.col("rows_new") != F.col("rows_old")),
                    F.lit("changed"))
              .otherwise(F.lit("unchanged")))
    return j.withColumn("status", status)


# ---------------------------------------------------------------- M3 / M4 manifests


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def files_map(counts: DataFrame, key: str, prefix: str) -> DataFrame:
    """One-row frame with the manifest ``files`` map: part -> {path, rows}
    (one entry per partition value, a small bounded list)."""
    entry = F.struct(F.concat(F.lit(prefix), F.lit(f"{key}="), F.col(key)).alias("path"),
                     F.col("rows").cast("long").alias("rows"))
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"),
                                                                                entry.alias("v"))))).alias("files"),
                      F.sum("rows").cast("long").alias("rows"))


# Parts up to which a manifest also holds its ``files`` map. The listing has every part whatever their number.
INLINE_PARTS = 1000


def inline_files(spark: SparkSession, runs: list[dict]) -> dict[str, dict] | None:
    """The ``files`` map of a manifest: part -> path, rows, SHA-256 of its files; None beyond ``INLINE_PARTS`` parts."""
    listed = live_listing(spark, runs)
    parts = listed.groupBy("part").agg(F.min("path").alias("path"), F.sum("rows").cast("long").alias("rows")).limit(INLINE_PARTS + 1).collect()
    if len(parts) > INLINE_PARTS:
        return None
    files = {r["part"]: {"path": r["path"], "rows": r["rows"], "sha256": []} for r in parts}
    # A hash per file: a run's files hold up to millions of rows each.
    for r in listed.select("part", "sha256").orderBy("part", "sha256").toLocalIterator():
        files[r["part"]]["sha256"].append(r["sha256"])
    return dict(sorted(files.items()))


def live_listing(spark: SparkSession, runs: list[dict], part: str | None = None) -> DataFrame:
    """The listing of a manifest's runs without the parts that later runs replaced."""
    out = spark.createDataFrame([], LISTING_SCHEMA)
    for run in runs:
        rows = read_listing(spark, run["listing"], part)
        out = out.unionByName(rows.where(~F.col("part").isin(run["without"])) if run.get("without") else rows)
    return out


def write_manifest(spark: SparkSession, path: str, reference_id: str, version: str, runs: list[dict], extra: dict | None = None) -> dict:
    """Switch a reference to its runs: the next revision of its manifest document, in one step."""
    rows = live_listing(spark, runs).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long")).first()[0]
    manifest = {"reference_id": reference_id, "version": version, "runs": runs, "rows": rows, "generated_at_utc": utc_now(), "quarantined_rows": 0}
    files = inline_files(spark, runs)
    if files is not None:
        manifest["files"] = files
    manifest.update(extra or {})
    return Document(spark, path).update(lambda old: manifest)


def publish_if_changed(df: DataFrame, root: str, reference_id: str, version: str, columns: list[str], manifest_path: str,
                       extra: dict | None = None, check: Callable[[Run], None] | None = None) -> dict:
    """Publish a new run only when the content fingerprint or row count changed; ``changed`` tells in the manifest returned.

    The plan runs once: for the run, whose fingerprint is observed in the write. ``check`` may refuse it. A run that
    says nothing new, or is refused, is removed again; nothing ever pointed to it.
    """
    spark = df.sparkSession
    run = write_run(df.select(*columns, *[c for c in (MISFIT, RAW) if c in df.columns]), posixpath.join(root, f"version={version}"))
    try:
        if check is not None:
            check(run)
    except ValidationError:
        _discard(spark, run)
        raise
    old = Document(spark, manifest_path).read()
    if old and old.get("fingerprint") == run.fingerprint and old.get("rows") == run.rows:
        _discard(spark, run)
        return {**old, "changed": False}
    m = write_manifest(spark, manifest_path, reference_id, version, [run.entry()],
                       {"fingerprint": run.fingerprint, "columns": list(columns), **(extra or {})})
    return {**m, "changed": True}


def _discard(spark: SparkSession, run: Run) -> None:
    remove(spark, run.path)
    remove(spark, run.listing)
