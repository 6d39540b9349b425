"""Files in and out: JSON lines, review sheets, registries, raw responses."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from gleanery.operators.open_records import open_lines, open_records
from gleanery.sources.results import ResultTable
from gleanery.schema import LICENSE_STATUSES, RECORD, SOURCE_STATUSES, SOURCE_TYPES


SMALL = 256 << 20  # bytes of a table whose rows are worth dealing out


class BadInput(ValueError):
    """Data or configuration that an operation may not go on with."""


def table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; one of at most SMALL bytes in fewer splits than there are cores is dealt out over all of them. Filters and
    column selections still reach the scan. Any larger table is read as it lies, without a shuffle."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= SMALL and df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or, where all is one process, a temporary one."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise BadInput("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read again, so that what was decided once, such as ranges, stays when executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = RECORD, bom: bool = False) -> DataFrame:
    """Records of JSON lines; blank lines are skipped, a malformed or non-object line is an error that names file and text.

    _ord grows with the place in a file. It is unique over all files, but says nothing of the order of files.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_ord"))
    lines = lines.withColumn("value", F.regexp_replace("value", "^\\uFEFF", "")) if bom else lines
    lines = lines.filter(F.col("value").rlike(r"\S"))
    full = S.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = lines.withColumn("_r", F.from_json("value", S.StructType([*full.fields, S.StructField("_corrupt", S.StringType())]), {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}))
    wrong = F.col("_r._corrupt").isNotNull() | ~F.col("value").rlike(r"^\s*\{")
    checked = F.when(F.col("value").rlike(r"\S") & wrong, F.raise_error(F.concat(F.lit("malformed line in "), F.col("_file"), F.lit(": "), F.substring("value", 1, 80)))).otherwise(F.col("_r"))
    return parsed.withColumn("_r", checked).select(*(F.col(f"_r.{f.name}").alias(f.name) for f in full.fields), "_ord")


def read_open_jsonl(spark: SparkSession, path: str, bom: bool = False) -> DataFrame:
    """Records of JSON lines as open records: `_open` holds all that a line says. Blank lines are skipped; a malformed or
    non-object line, or one with a key twice, is an error that names file and text."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_ord"))
    lines = lines.withColumn("value", F.regexp_replace("value", "^\\uFEFF", "")) if bom else lines
    lines = lines.filter(F.col("value").rlike(r"\S"))
    whole = F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")
    wrong = F.raise_error(F.concat(F.lit("malformed line in "), F.col("_file"), F.lit(": "), F.substring("value", 1, 80)))
    return open_records(lines.withColumn("value", F.when(whole.isNull(), wrong).otherwise(F.col("value"))).drop("_file"))


def write_open_jsonl(records: DataFrame, path: str) -> int:
    """Open records as JSON lines, unknown fields included; the number of lines, counted while they are written."""
    return _counted(open_lines(records), lambda df: df.write.mode("overwrite").text(path))


def _counted(df: DataFrame, write) -> int:
    """Runs a write and returns how many rows it wrote, without running the plan for them again."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def write_jsonl(df: DataFrame, path: str, single: bool = False) -> int:
    """JSON lines with nulls, through Spark's committer; one file if asked (for small results). Returns the number of lines."""
    out = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    return _counted(out.coalesce(1) if single else out, lambda x: x.write.mode("overwrite").text(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = True) -> int:
    """CSV with a header, quotes doubled; cells keep their newlines. With bom, the first column's name begins with the mark that
    tells spreadsheets of UTF-8, which heads every part file; without a header line there is no mark. Returns the number of rows."""
    first = df.columns[0]
    out = df.select(F.col(f"`{first}`").alias("\ufeff" + first), *(F.col(f"`{c}`") for c in df.columns[1:])) if bom else df
    return _counted(out, lambda x: x.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path))


def write_once(df: DataFrame, path: str, form: str = "parquet") -> None:
    """A result that must not be there yet: a folder of this name is an error, and stays as it is."""
    if form == "csv":
        write_csv(df, path, mode="errorifexists")
    elif form == "jsonl":
        df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("errorifexists").text(path)
    else:
        df.write.mode("errorifexists").format(form).save(path)


def write_json_report(report: dict, path: str) -> None:
    """A small report as one file with sorted keys, moved into place when it is whole."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_suffix(target.suffix + ".tmp")
    part.write_text(json.dumps(report, ensure_ascii=False, sort_keys=True, indent=2) + "\n", encoding="utf-8")
    os.replace(part, target)


def write_dedup_reports(result, folder: str, records: int | None = None) -> dict:
    """The pairs of a DeduplicationResult as three CSV tables with nested cells as JSON, and its four counts as JSON; returns these.
    Pairs are counted while they are written, records unless their number is known."""
    counts = {"records": result.records.count() if records is None else records}
    for name in ("exact", "reordered", "suspected"):
        pairs = getattr(result, name)
        flat = [F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if t.startswith(("struct", "array", "map")) else F.col(c) for c, t in pairs.dtypes]
        counts[f"{name}_duplicate_pairs"] = write_csv(pairs.select(*flat), f"{folder}/{name}_duplicates")
    write_json_report(counts, f"{folder}/summary.json")
    return counts


def replace_results(spark: SparkSession, fresh: DataFrame, folder: str, keys: list[str], order: str = "finished_at") -> None:
    """Adds results to a table that holds one row for each key, the last by `order` (`sources.results.ResultTable`)."""
    ResultTable(spark, folder, keys, order).add(fresh)


def current_results(spark: SparkSession, folder: str, keys: list[str], order: str = "finished_at") -> DataFrame:
    """The last row of each key of such a table."""
    return ResultTable(spark, folder, keys, order).current()


def unread_files(files: DataFrame, cache: DataFrame, force: bool = False) -> DataFrame:
    """Files (path, sha256) that have yet to be read: those whose name without ending is not in the cache (stem, sha256) with
    the same fingerprint, or all."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    named = files.withColumn("stem", stem)
    return named if force else named.join(cache.select("stem", "sha256"), ["stem", "sha256"], "left_anti")


def read_sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Sheets as text columns with `sheet`, the file, and `line`, the number of the row in it, the header being the first; a
    missing column is an error. A file is read in one piece, and its first row tells where its numbers begin."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    names = {c.lstrip("﻿"): c for c in df.columns}
    missing = sorted(set(columns) - set(names))
    if missing:
        raise BadInput("Review sheet is missing columns: " + ", ".join(missing))
    rows = staged(df.select(*(F.col(f"`{names[c]}`").alias(c) for c in columns), F.col("_metadata.file_path").alias("sheet"), F.monotonically_increasing_id().alias("line")), "sheet")
    first = rows.groupBy("sheet").agg(F.min("line").alias("_first"))
    return rows.join(first, "sheet").withColumn("line", F.col("line") - F.col("_first") + 2).select(*columns, "sheet", "line")


REQUIRED = (
    "source_id", "site_name", "base_url", "source_type", "exam_type", "has_answer", "year_range", "estimated_questions", "login_required", "robots_checked",
    "terms_checked", "license_status", "redistribution_allowed", "collector", "status", "notes",
)


def load_registry(path: str) -> dict[str, dict]:
    """Sources of a YAML registry by id, checked. Registries are files of a few entries, read by the driver."""
    import yaml

    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if raw.get("version") != 1:
        raise BadInput("a registry must have version 1")
    d = {"request_interval_min_seconds": 2.0, "request_interval_max_seconds": 5.0, "concurrency": 1, "max_retries": 3, "user_agent": "gleanery"} | (raw.get("defaults") or {})
    if d["request_interval_min_seconds"] < 2 or d["request_interval_max_seconds"] < d["request_interval_min_seconds"] or not 1 <= d["concurrency"] <= 2 or d["max_retries"] < 0 or not d["user_agent"].strip():
        raise BadInput("defaults out of range")
    out: dict[str, dict] = {}
    for entry in raw.get("sources") or []:
        lacking = sorted(set(REQUIRED) - set(entry))
        if lacking:
            raise BadInput("a source lacks " + ", ".join(lacking))
        sid = entry["source_id"]
        if not sid or not sid.replace("_", "").replace("-", "").isalnum():
            raise BadInput(f"bad source_id {sid!r}")
        if entry["source_type"] not in SOURCE_TYPES or entry["license_status"] not in LICENSE_STATUSES or entry["status"] not in SOURCE_STATUSES:
            raise BadInput(f"{sid}: unknown type, licence or status")
        if not str(entry["base_url"]).startswith(("http://", "https://")):
            raise BadInput(f"{sid}: bad base_url")
        if sid in out:
            raise BadInput(f"{sid} is there twice")
        out[sid] = entry
    return out


def save_raw(folder: str, url: str, body: bytes, content_type: str = "", **about) -> dict:
    """Writes a response and its metadata, named after the URL's hash; returns the metadata."""
    kind, path = content_type.lower(), url.split("?")[0].split("#")[0]
    ending = next((s for s in (".html", ".htm", ".pdf", ".txt", ".json") if path.lower().endswith(s)), ".bin")
    suffix = ".pdf" if "pdf" in kind else ".html" if "html" in kind else ending
    name = hashlib.sha256(url.encode()).hexdigest()[:20]
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    meta = {"url": url, "raw_file": str(target / (name + suffix)), "content_hash": hashlib.sha256(body).hexdigest(), "content_type": content_type, **about}
    for file, data in ((target / (name + suffix), body), (target / (name + ".meta.json"), json.dumps(meta, ensure_ascii=False).encode())):
        part = file.with_suffix(file.suffix + ".tmp")
        part.write_bytes(data)
        os.replace(part, file)
    return meta


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size) of the files under a folder."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
