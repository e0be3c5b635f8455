"""Publishing a reference: check, write a run, prove it, switch the manifest, register.

Order matters (the reference published first and validated afterwards, and removed the old folder before the new one
existed): here the checks run first, the data goes to a run folder of its own, and the manifest document switches to it
in one step; only then the registry entry changes.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiframe.functions.scalars import NO_STATE_BUCKET
from vigiframe.sinks import store
from vigiframe.sinks.publish import (MISFIT, RAW, Run, ValidationError, commit_run, file_hashes, fit, live_listing, publish_partitioned, read_listing, read_run,
                                     read_table, table_document, utc_now, write_manifest, write_run)

__all__ = ["ValidationError", "already_published", "copy_publish", "manifest_document", "missing_published_files", "open_published", "path_exists",
           "publish_reference", "publish_tables", "read_reference", "register", "require_clean", "run_part", "validate_published", "verify_published"]


def require_clean(report: DataFrame) -> None:
    """Fail when any check of a ``(check, failures)`` report has failures (one small collect)."""
    bad = [(r["check"], r["failures"]) for r in report.filter(F.col("failures") > 0).collect()]
    if bad:
        raise ValidationError(f"quality checks failed: {bad}")


def publish_tables(tables: dict[str, DataFrame], root: str, version: str, key: str | None = None,
                   sort_keys: dict[str, list[str]] | None = None, columns: dict[str, list[str]] | None = None) -> dict[str, dict]:
    """Several tables of one reference (e.g. the four ICD tables), each a verified run below ``root/version=<v>/<name>``.

    A table without rows, with names that aren't lower case, or with other ``columns`` than given fails, and none of
    them is published. Each table's pointer is switched only after all are written. A driver loop over a handful of
    independent DataFrames; each write is a distributed job.
    """
    runs: dict[str, Run] = {}
    for name, df in tables.items():
        wanted = (columns or {}).get(name)
        have = _names(df)
        if wanted is not None and have != wanted:
            raise ValidationError(f"{name}: columns {have}, expected {wanted}")
        if any(c != c.lower() for c in have):
            raise ValidationError(f"{name}: column names must be lower case: {have}")
        runs[name] = write_run(df, posixpath.join(root, f"version={version}", name), key, (sort_keys or {}).get(name, []), allow_empty=False)
    out = {}
    for name, df in tables.items():
        run, spark = runs[name], df.sparkSession
        commit_run(spark, posixpath.join(root, f"version={version}", name), run)
        hashes = read_listing(spark, run.listing).select("sha256").orderBy("sha256").toLocalIterator()
        out[name] = {"path": run.path, "rows": run.rows, "columns": _names(df), "sha256": [r["sha256"] for r in hashes], "run": run.entry()}
    return out


def _names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (MISFIT, RAW)]


def copy_publish(spark: SparkSession, source: str, target: str, key: str) -> DataFrame:
    """Publish an unchanged copy of processed Parquet, partitioned by ``key``; returns rows per part."""
    return publish_partitioned(spark.read.parquet(source), target, key, [])


def validate_published(spark: SparkSession, path: str, expected_rows: dict[str, int] | None = None,
                       key: str | None = None) -> DataFrame:
    """Rows per file below ``path``; with ``expected_rows`` the parts' declared rows against those there."""
    df = spark.read.option("basePath", path).parquet(path)
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file"), *([key] if key else [])) \
                 .agg(F.count(F.lit(1)).alias("rows"))
    if not expected_rows:
        return per_file
    actual = per_file.groupBy(key).agg(F.sum("rows").alias("actual_rows")) if key else \
        per_file.agg(F.sum("rows").alias("actual_rows")).withColumn("part", F.lit("all"))
    k = key or "part"
    declared = spark.createDataFrame([(p, int(n)) for p, n in expected_rows.items()], f"{k} string, declared_rows long")
    j = declared.join(actual.withColumn(k, F.col(k).cast("string")), k, "full_outer")
    return j.withColumn("ok", F.coalesce(F.col("declared_rows") == F.col("actual_rows"), F.lit(False)))


def _place(path: Column) -> Column:
    """A file's place without the scheme, however it is written."""
    return F.regexp_replace(path, "^[a-z][a-z0-9+.-]*:/+", "/")


def verify_published(spark: SparkSession, manifest_path: str) -> DataFrame:
    """What became of each published file: ``part``, ``file``, ``status`` (ok, missing, changed or unlisted).

    The listing says what the files' bytes were when they had been read back and found to hold what was written; a
    file whose SHA-256 is still the same still holds it. Files of parts that later runs replaced are not asked for.
    """
    manifest = manifest_document(spark, manifest_path).read() or {}
    runs = manifest.get("runs") or []
    listed = live_listing(spark, runs).select("part", _place(F.col("file")).alias("file"), F.col("sha256").alias("_then"))
    found = spark.createDataFrame([], "file string, _now string")
    for run in runs:
        if not store.exists(spark, run["path"]):
            continue
        there = file_hashes(spark, run["path"]).select(_place(F.col("path")).alias("file"), F.col("sha256").alias("_now"))
        if run.get("without"):
            replaced = read_listing(spark, run["listing"]).where(F.col("part").isin(run["without"])).select(_place(F.col("file")).alias("file"))
            there = there.join(replaced, "file", "left_anti")
        found = found.unionByName(there)
    status = (F.when(F.col("_now").isNull(), F.lit("missing")).when(F.col("_then").isNull(), F.lit("unlisted"))
              .when(F.col("_now") != F.col("_then"), F.lit("changed")).otherwise(F.lit("ok")))
    return listed.join(found, "file", "full_outer").select("part", "file", status.alias("status"))


def publish_reference(df: DataFrame, root: str, reference_id: str, version: str, key: str,
                      sort_keys: list[str], report: DataFrame | None = None,
                      extra: dict | None = None, registry_path: str | None = None, schema: T.StructType | None = None,
                      blank: str = NO_STATE_BUCKET, inspect: Callable[[DataFrame], dict] | None = None,
                      carry: Callable[[dict], list[dict]] | None = None) -> dict:
    """Check -> write and prove a run below ``root/version=<v>`` -> switch ``root/manifest.json`` -> update the registry.

    With ``schema`` rows that don't fit it go to quarantine and nothing is published. An empty result fails.
    ``inspect`` gets the rows as written, before anything points to them: it may raise, and returns manifest fields.
    ``carry`` gives the entries of earlier runs that the manifest keeps beside the new one.
    """
    spark = df.sparkSession
    if report is not None:
        require_clean(report)
    columns = [f.name for f in schema.fields] if schema else list(df.columns)
    run = write_run(fit(df, schema) if schema else df, posixpath.join(root, f"version={version}"), key, sort_keys, blank, allow_empty=False)
    found = inspect(read_run(spark, run.entry())) if inspect else {}
    manifest = write_manifest(spark, posixpath.join(root, "manifest.json"), reference_id, version, [*(carry(run.entry()) if carry else []), run.entry()],
                              {"partition": key, "columns": columns, **(extra or {}), **found})
    if registry_path:
        register(registry_path, reference_id, posixpath.join(root, "manifest.json"))
    return manifest


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def manifest_document(spark: SparkSession, path: str) -> store.Document:
    return store.Document(spark, path)


def register(registry_path: str, reference_id: str, manifest_path: str) -> dict:
    """Global registry id -> manifest path; concurrent jobs each keep their entry."""
    def enter(old: dict | None) -> dict | None:
        references = dict((old or {}).get("references") or {})
        if references.get(reference_id) == manifest_path and "generated_at_utc" in old:
            return None                             # nothing to write
        return {**(old or {}), "references": {**references, reference_id: manifest_path}, "generated_at_utc": utc_now()}
    return store.Document(_session(), registry_path).update(enter)


def missing_published_files(spark: SparkSession, manifest_paths: DataFrame, root: str) -> DataFrame:
    """Manifest paths with no file under ``root`` (anti join with a listing that reads no file
    contents). A path may name a file, or a part's folder, which is there if it holds a file itself.
    Empty result = everything is there."""
    from vigiframe.sources.files import list_files
    wanted = manifest_paths.select(F.rtrim(_place(F.col("path")), F.lit("/")).alias("_p"), "path").distinct()
    if not store.exists(spark, root):
        return wanted.select("path")
    # Run folders are hidden from a listing of what lies above them.
    runs = [posixpath.join(root, *above, "_runs") for above in [(), *((n,) for n in store.names(spark, root) if n.startswith("version="))]]
    files = list_files(spark, [root, *(r for r in runs if store.exists(spark, r))]).select(_place(F.col("path")).alias("_p"))
    listing = files.unionByName(files.select(F.regexp_replace("_p", "/[^/]*$", "").alias("_p")).distinct())
    return wanted.join(listing, "_p", "left_anti").select("path")


def already_published(manifest_path: str, version: str, parts: list[str] | None = None) -> bool:
    """Version gate on the stored manifest: same version (compared as integers when
    both are numeric) *and* every requested part published, its files still there. A run that published
    only some states therefore does not block a later run for the others."""
    spark = _session()
    m = manifest_document(spark, manifest_path).read()
    if m is None:
        return False
    old = str(m.get("version", ""))
    same = int(old) >= int(version) if old.isdigit() and str(version).isdigit() else old == str(version)
    return same and files_there(spark, m, parts)


def files_there(spark: SparkSession, manifest: dict, parts: list[str] | None = None) -> bool:
    """Whether a manifest's files (of the given parts, each of which must be published) are all there, and any at all."""
    runs = manifest.get("runs")
    if runs is None:                                # a manifest of another program: a path per part
        files = manifest.get("files") or {}
        wanted = list(parts or files)
        return bool(files) and all(p in files and store.exists(spark, files[p]["path"]) for p in wanted)
    found = False
    for run in runs:
        listed = live_listing(spark, [run])
        if parts is not None:
            listed = listed.where(F.col("part").isin(parts))
        if not missing_published_files(spark, listed.select(F.col("file").alias("path")), run["path"]).isEmpty():
            return False
        found = found or not listed.isEmpty()
    if parts is not None:
        have = {r["part"] for r in live_listing(spark, runs).where(F.col("part").isin(parts)).select("part").distinct().collect()}
        return set(parts) <= have
    return found


def path_exists(path: str) -> bool:
    """Whether a file or folder is there, asked of the file system that Spark would read it from."""
    return store.exists(_session(), path)


def run_part(spark: SparkSession, manifest: dict, part: str | None = None) -> DataFrame:
    """The rows of a manifest's runs, of one part if given (its folder alone is read)."""
    out = None
    for run in manifest["runs"]:
        rows = read_run(spark, run)
        if part is not None:
            rows = rows.where(F.col(f"`{run['key']}`") == F.lit(part)) if run["key"] else rows.limit(0)
        out = rows if out is None else out.unionByName(rows)
    return out


def open_published(spark: SparkSession, path: str, parts: list[str] | None = None) -> tuple[DataFrame, dict | None]:
    """Rows of a published reference, and its manifest if it has one.

    ``path`` is a reference's folder, its ``version=<v>`` folder or its manifest; a table with a pointer; a folder of
    files named after digit-only state codes; or plain Parquet. ``parts`` reads only those states.
    """
    from vigiframe.sources.files import has_state_files, read_state_files
    base = posixpath.dirname(path) if path.endswith("/manifest.json") else path.rstrip("/")
    for root in (base, posixpath.dirname(base)):
        manifest = manifest_document(spark, posixpath.join(root, "manifest.json")).read()
        if manifest and manifest.get("runs") and (root == base or posixpath.basename(base) == f"version={manifest.get('version')}"):
            rows = run_part(spark, manifest)
            key = manifest["runs"][0]["key"]
            return (rows.where(F.col(f"`{key}`").isin(parts)) if parts is not None and key else rows), manifest
    if table_document(spark, base).revision():
        rows = read_table(spark, base)
    elif has_state_files(spark, base):
        return read_state_files(spark, base, parts), None
    else:
        rows = spark.read.option("basePath", base).parquet(base)
        if "co_uf" in rows.columns and dict(rows.dtypes)["co_uf"] != "string":
            raise ValidationError(f"state codes at {path} are read as numbers; set {'spark.sql.sources.partitionColumnTypeInference.enabled'} to false")
    return (rows.where(F.col("co_uf").isin(parts)) if parts is not None and "co_uf" in rows.columns else rows), None


def read_reference(spark: SparkSession, registry_path: str, reference_id: str, part: str | None = None,
                   municipality=None) -> DataFrame:
    """Consumer lookup: registry -> manifest -> (one part's folder) -> rows, with the
    manifest's municipality filter column applied. Reading one part prunes every
    other partition folder; the municipality predicate is pushed into the scan."""
    registry = store.Document(spark, registry_path).read()
    if registry is None or reference_id not in (registry.get("references") or {}):
        raise ValidationError(f"{reference_id} is not registered at {registry_path}")
    m = store.Document(spark, registry["references"][reference_id]).read()
    if m is None:
        raise ValidationError(f"{reference_id} has no manifest")
    if "runs" in m:
        df = run_part(spark, m, part)
    else:                                           # a manifest of another program: a path per part, or a single file
        files = m.get("files") or {"all": m["file"]}
        paths = sorted(f.get("path") or f["parquet_path"] for f in files.values())
        df = spark.read.parquet(files[part]["path"]) if part in files else spark.read.parquet(*paths)
        df = df.limit(0) if part is not None and part not in files else df
    col = m.get("municipality_filter_column")
    if municipality is not None and col:
        df = df.filter(F.col(col) == F.lit(municipality))
    return df
