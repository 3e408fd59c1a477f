"""Readers and writers of instruction records (JSON lines), archives and reports."""

from __future__ import annotations

import io
import json
import re
import shutil
import tempfile
import urllib.request
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.functions.text import strip

REQUIRED = ("system", "input", "output")
_FIELDS = ("system", "input", "output", "cwe", "vulnerable_code", "source_id", "kind")
_WANTED = re.compile(r"(?:CWE89_|CWE78_|CWE23_|CWE36_).*\.java$")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).withColumn("row", F.monotonically_increasing_id())
    schema = ", ".join(f"{f} string" for f in _FIELDS)
    rows = rows.where(strip(F.col("value")) != "")
    return rows.select("row", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("row", "r.*")


def _checked(rows: DataFrame, path: str, keys: tuple[str, ...]) -> DataFrame:
    """rows, after one pass that fails on missing keys and on an empty file."""
    lacking = F.array_compact(F.array(*(F.when(F.coalesce(k, F.lit("")) == "", k) for k in keys))) if keys else F.array().cast("array<string>")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.size(lacking) > 0, F.struct("row", lacking.alias("keys")))).alias("bad")).first()
    if seen["bad"] is not None:
        raise ValueError(f"{path}:{seen['bad']['row'] + 1}: record missing keys {list(seen['bad']['keys'])}")
    if not seen["n"]:
        raise ValueError(f"{path} is empty")
    return rows


def _limited(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows; a limit of 0 gives one, since the check comes after the first row."""
    return rows if limit is None else rows.orderBy("row").limit(max(limit, 1))


def training_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Records of a training file; fails on missing system, input or output and on an empty file."""
    return _checked(_limited(_lines(spark, path), limit), path, REQUIRED).withColumnRenamed("row", "ord")


def test_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Records of a test file, keys unchecked; source_id defaults to the row's number from 1."""
    rows = _checked(_limited(_lines(spark, path), limit), path, ())
    return rows.withColumn("source_id", F.coalesce("source_id", (F.col("row") + 1).cast("string"))).withColumnRenamed("row", "ord")


def replay_records(spark: SparkSession, path: str) -> DataFrame:
    """General instruction data; blank lines count in the numbering and are skipped."""
    name = path.rsplit("/", 1)[-1]
    rows = _checked(_lines(spark, path), path, REQUIRED)
    return rows.select(*REQUIRED, F.lit("general").alias("cwe"), F.lit("").alias("vulnerable_code"), F.concat(F.lit(f"{name}:"), F.col("row").cast("string")).alias("source_id"), F.lit("replay").alias("kind"))


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """cwe, vulnerable_code, source_id of the fix records in scope."""
    rows = _lines(spark, path).where((F.coalesce("kind", F.lit("fix")) == "fix") & F.col("cwe").isin(*c.TARGET_CWES))
    return rows.select("cwe", "vulnerable_code", F.coalesce("source_id", F.col("row").cast("string")).alias("source_id"))


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """name, content of the wanted test cases in zip archives, folders left out; of equal names the last stays."""

    def run(frames):
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    found = [(i.filename.rsplit("/", 1)[-1], archive.read(i)) for i in archive.infolist() if _WANTED.search(i.filename)]
                yield pd.DataFrame(list(dict(found).items()), columns=["name", "content"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "name string, content binary")


def fetched(spark: SparkSession, url: str, folder: str) -> int:
    """Downloads a zip archive and writes its wanted test cases as files into folder, which all machines share.

    One task streams the archive through a file of its own; returns the number of files, which must not be 0.
    """

    def run(frames):
        from pyarrow import fs

        for frame in frames:
            for address in frame["url"]:
                store, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
                store.create_dir(base, recursive=True)
                # Fixed value: some hosts refuse the library's own agent.
                request = urllib.request.Request(address, headers={"User-Agent": "Mozilla/5.0"})
                with tempfile.TemporaryFile() as held:
                    with urllib.request.urlopen(request, timeout=120) as answer:
                        shutil.copyfileobj(answer, held, 1 << 20)
                    with zipfile.ZipFile(held) as archive:
                        names = {i.filename.rsplit("/", 1)[-1]: i for i in archive.infolist() if _WANTED.search(i.filename)}
                        for name, member in names.items():
                            with archive.open(member) as content, store.open_output_stream(f"{base}/{name}") as out:
                                shutil.copyfileobj(content, out, 1 << 20)
                if names:
                    yield pd.DataFrame({"name": list(names)})

    n = spark.createDataFrame([(url,)], "url string").coalesce(1).mapInPandas(run, "name string").count()
    if not n:
        raise ValueError(f"{url}: no test cases of the target categories in it")
    return n


def write_splits(records: DataFrame, folder: str) -> dict:
    """One folder of JSON lines per split, nulls written, and stats.json beside them; returns the stats."""
    from curaloom.operators.splitting import split_stats

    records.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("split").json(f"{folder}/splits")
    rows = {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"} for r in split_stats(records).collect()}  # one row a split
    stats = {"splits": {s: rows[s] for s in c.SPLITS if s in rows}}
    write_json(records.sparkSession, stats, f"{folder}/stats.json")
    return stats


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    """A small report as one JSON text."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def run_report(settings: dict, train_loss: float | None = None, history: list | None = None, versions: dict | None = None, samples: DataFrame | None = None) -> dict:
    """The report of an external trainer's run, for write_json: its settings, loss, last 50 log entries, versions, and the summary of its GPU samples."""
    from curaloom.operators.score import gpu_summary

    report = dict(settings)
    used = gpu_summary(samples).first() if samples is not None else None
    # Names of the report's parts.
    parts = {"gpu_utilization": used.asDict() if used else None, "train_loss": train_loss, "log_history": (history or [])[-50:] or None, "versions": versions}
    return report | {k: v for k, v in parts.items() if v is not None}


def write_results(results: DataFrame, path: str) -> None:
    """Evaluation rows as JSON lines with explicit nulls."""
    results.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_pairs(rows: DataFrame, path: str) -> None:
    """Generated pairs as CSV that the pair reader takes; white space at the edges of a text, which Spark's writer drops by default, stays."""
    kept = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.select("vulnerable_code", "fixed_code", "cwe").write.mode("overwrite").option("header", "true").options(**kept).csv(path)


def stats_table(stats: dict, drops: dict[str, int] | None = None) -> str:
    """The stats as a fixed-width table, absent categories 0."""
    rows = stats["splits"]
    names = [*sorted({k for r in rows.values() for k in r} - {"total", "no_change", "replay"}), "no_change", "replay", "total"]
    lines = ["== dataset stats ==", f"{'split':<8}" + "".join(f"{n:>11}" for n in names)]
    lines += [f"{s:<8}" + "".join(f"{r.get(n, 0):>11}" for n in names) for s, r in rows.items()]
    return "\n".join([*lines, *([f"dropped during cleaning: {json.dumps(drops)}"] if drops is not None else [])])
