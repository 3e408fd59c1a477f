"""Readers of raw pairs: CSV files, Java test-case trees and CVE collections.

Every reader gives vulnerable_code, fixed_code, cwe, source_id, kind and ord; ord follows adapter, path
and row, so that the order of the input is data.
"""

from __future__ import annotations

import csv
import io
import logging
import os
import re
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.functions import java, text
from curaloom.storage import written

log = logging.getLogger(__name__)

SCHEMA = "vulnerable_code string, fixed_code string, cwe string, source_id string, kind string, ord long"
_BLOCK = 65_536
_ADAPTER_BITS, _FILE_BITS = 58, 36

# Of CSV files: the columns that must be there, the bytes that are parsed at once, and those of an Arrow batch.
_NEED = ("vulnerable_code", "fixed_code", "cwe")
_CHUNK, _BATCH_BYTES = 1 << 20, "4m"
# The records of a line as the csv module takes them, up to a carriage return or a quoted field that the line doesn't close.
_FIELD = rb'(?:"(?:[^"]++|"")*+"|(?!"))[^,\r]*+'
_RECORD = re.compile(_FIELD + rb"(?:," + _FIELD + rb")*+")
_CSV_ROWS = "file long, row long, vulnerable_code string, fixed_code string, cwe string, short boolean"
_ROW_ARROW = pa.schema([("file", pa.int64()), ("row", pa.int64()), *((k, pa.string()) for k in _NEED), ("short", pa.bool_())])
_PART_ARROW = pa.schema([("file", pa.int64()), ("unit", pa.int64()), ("start", pa.int64()), ("base", pa.int64()), ("part", pa.binary())])
_BLOCK_ROWS = "key long, start long, bytes long, end0 boolean, end1 boolean, n0 long, n1 long, closes boolean, lacking string, places array<long>, cut boolean"
_BLOCK_ARROW = pa.schema([*((k, pa.int64()) for k in ("key", "start", "bytes")), ("end0", pa.bool_()), ("end1", pa.bool_()), ("n0", pa.int64()), ("n1", pa.int64()), ("closes", pa.bool_()), ("lacking", pa.string()), ("places", pa.list_(pa.int64())), ("cut", pa.bool_())])

# The names that CVE collections give a field, the preferred ones first.
LANGUAGE = ("programming_language", "lang", "language", "file_language")
BEFORE = ("func_before", "code_before", "before", "vulnerable_code", "source_before", "before_change", "vul_func")
AFTER = ("func_after", "code_after", "after", "fixed_code", "source_after", "after_change", "fix_func")
CATEGORY = ("cwe_id", "cwe", "cwe_ids", "cwes", "cwe_name")
IDENTITY = ("cve_id", "cve", "commit_id", "hash", "id")


def _files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, content, file (its place in path order) of the matching files below folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path", "content")
    places = found.select("path").withColumn("file", (F.row_number().over(Window.orderBy("path")) - 1).cast("long"))  # names only
    return found.join(places, "path")


def _order(adapter: int, file: Column, row: Column) -> Column:
    return (F.lit(adapter << _ADAPTER_BITS) + F.shiftleft(file, _FILE_BITS) + row).cast("long").alias("ord")


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """rows with seq, their place from 1 by a long column: prefix sums over blocks of it, no global sort in one task."""
    rows = rows.withColumn("_block", F.floor(F.col(order) / _BLOCK))
    sizes = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.select("_block", (F.sum("_n").over(ahead) - F.col("_n")).alias("_before"))
    return rows.join(sizes, "_block").withColumn("seq", F.col("_before") + F.row_number().over(Window.partitionBy("_block").orderBy(order))).drop("_block", "_before")


def _literal(path: str) -> str:
    """A path whose characters stand for themselves."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _scanned(line: bytes, opened: bool) -> tuple[bool, int]:
    """Whether a line that begins within quotes, or doesn't, ends within quotes; and how many records that aren't blank begin in it."""
    if b'"' not in line:
        if opened:
            return True, 0
        return False, sum(x != b"" for x in line.split(b"\r")) if b"\r" in line else int(line != b"")
    n, at = 0, 0
    if opened:
        n, line = -1, b'"' + line
    while (m := _RECORD.match(line, at)) is not None:
        end = m.end()
        if end == len(line):
            return False, n + (end > at)
        if line[end] != 13:  # a comma before a field that stays open
            return True, n + 1
        n, at = n + (end > at), end + 1
    return True, n + 1


def _segments(batch):
    """(first row, row after the last) of the blocks in a batch of lines; their key columns come first."""
    key, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    cuts = (np.flatnonzero((key[1:] != key[:-1]) | (start[1:] != start[:-1])) + 1).tolist()
    return zip([0, *cuts], [*cuts, batch.num_rows], strict=True) if batch.num_rows else ()


def _parsed(content: bytes) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(io.StringIO(content.decode("utf-8"), newline=""))


def _block_rows(batches):
    """A row per block of a file: what it makes of either state at its start, as only the blocks before tell which one holds."""
    out = []

    def begun(key, start):
        return {"key": key, "start": start, "bytes": 0, "end0": False, "end1": True, "n0": 0, "n1": 0, "closes": False, "head": [], "lacking": None, "places": None, "cut": False}

    def ended(block):
        if block["start"] == 0:
            names = next(_parsed(b"\n".join(block["head"]) + b"\n"), [])
            lacking = sorted(set(_NEED) - set(names))
            block["lacking"] = str(lacking) if lacking else None
            block["places"] = None if lacking else [len(names) - 1 - names[::-1].index(k) for k in _NEED]
        out.append({k: v for k, v in block.items() if k != "head"})

    block = None
    for batch in batches:
        for i, j in _segments(batch):
            key, start = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if block is None or (block["key"], block["start"]) != (key, start):
                if block is not None:
                    ended(block)
                block, heading = begun(key, start), start == 0
            for line in batch.column(2).slice(i, j - i).to_pylist():
                both = block["end0"] == block["end1"]
                end0, n0 = _scanned(line, block["end0"])
                end1, n1 = (end0, n0) if both else _scanned(line, block["end1"])
                if heading:
                    block["head"].append(line)
                    heading = block["cut"] = end0
                block.update(bytes=block["bytes"] + len(line) + 1, end0=end0, end1=end1, n0=block["n0"] + n0, n1=block["n1"] + n1, closes=block["closes"] or not end1)
    if block is not None:
        ended(block)
    yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_ARROW)


def _as_batch(content: bytes, file: int, base: int, places: list[int]):
    """The rows of whole records; base is the place of the first in the file, where the header has place 0."""
    rows = []
    for row in _parsed(content):
        if row:
            if base:
                short = len(row) <= max(places)
                rows.append((file, base - 1, *((None,) * 3 if short else (row[k] for k in places)), short))
            base += 1
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [()] * 6, _ROW_ARROW, strict=True)], schema=_ROW_ARROW)


def _record_rows(batches):
    """The rows of all records that lie, with those on the same lines, in one block."""
    at, held, part, size = None, [], [], 0

    for batch in batches:
        for i, j in _segments(batch):
            file, start, opened, before, places = (batch.column(k)[i].as_py() for k in range(5))
            if at != (file, start):
                if held:
                    yield _as_batch(b"\n".join(held) + b"\n", *of)
                at, held, part, size, of = (file, start), [], [], 0, (file, before, places)
                now, lead, seen = opened, opened, before
            for line in batch.column(5).slice(i, j - i).to_pylist():
                now, n = _scanned(line, now)
                seen += n
                if lead:
                    lead, of = now, (file, seen, places)
                    continue
                part.append(line)
                size += len(line) + 1
                if not now:
                    held += part
                    part = []
                    if size >= _CHUNK:
                        yield _as_batch(b"\n".join(held) + b"\n", *of)
                        held, size, of = [], 0, (file, seen, places)
    if held:
        yield _as_batch(b"\n".join(held) + b"\n", *of)


def _part_rows(batches):
    """The parts of the records that lie in several blocks, or run to the file's end: the block where each begins, and the place there."""
    at = None

    def parts(tail):
        if first:
            yield owner, None, b"\n".join(first)
        if tail:
            yield at[1], base, b"\n".join(tail)

    def batch_of(found):
        rows = [(at[0], unit, at[1], place, content) for unit, place, content in found]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [()] * 5, _PART_ARROW, strict=True)], schema=_PART_ARROW)

    for batch in batches:
        for i, j in _segments(batch):
            file, start, opened, before, _, owner_here = (batch.column(k)[i].as_py() for k in (0, 1, 2, 3, 4, 6))
            if at != (file, start):
                if at is not None:
                    yield batch_of(parts(tail))
                at, first, tail, now, lead, seen, base, owner = (file, start), [], [], opened, opened, before, before, owner_here
            for line in batch.column(5).slice(i, j - i).to_pylist():
                now, n = _scanned(line, now)
                if lead:
                    first.append(line)
                    lead = now
                elif now:
                    base = base if tail else seen
                    tail.append(line)
                else:
                    tail = []
                seen += n
    if at is not None:
        yield batch_of(parts(tail))


def _joined_rows(batches):
    for batch in batches:
        for file, base, places, ended, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield _as_batch(b"\n".join(parts) + (b"\n" if ended else b""), file, base, places)


def _planned(rows: DataFrame) -> DataFrame:
    """rows of files, split as now: else each later plan splits anew, by the session's settings and executors of that time."""
    spark = rows.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows._jdf.queryExecution().toRdd(), rows._jdf.schema(), False), spark)


def _csv_states(spark: SparkSession, lines: DataFrame, files: DataFrame) -> DataFrame:
    """What is known of each block once those before it are: (key, start, file, name, opened, before, owner, last, ended, places, lacking, cut).

    A block maps either state at its start to one at its end: the last that maps both to the same one, and the number of
    those since that swap them, tell the state at any block. A window holds the blocks of one file, a row each.
    """
    blocks = lines.mapInArrow(_block_rows, _BLOCK_ROWS).join(files, "key")
    ahead = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    same, swaps = F.col("end0") == F.col("end1"), (F.col("end0") & ~F.col("end1")).cast("int")
    blocks = blocks.withColumn("swaps", F.sum(swaps).over(upto))
    fixed = F.last(F.when(same, F.struct(F.col("end0").cast("int").alias("v"), "swaps")), ignorenulls=True).over(ahead)
    blocks = blocks.withColumn("fixed", fixed).withColumn("swapped", F.coalesce(F.max("swaps").over(ahead), F.lit(0)))
    state = F.coalesce("fixed.v", F.lit(0)) + F.col("swapped") - F.coalesce("fixed.swaps", F.lit(0))
    blocks = blocks.withColumn("opened", state % 2 == 1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum(F.when(F.col("opened"), F.col("n1")).otherwise(F.col("n0"))).over(ahead), F.lit(0)))
    blocks = blocks.withColumn("owner", F.last(F.when(~F.col("opened") | F.col("closes"), F.col("start")), ignorenulls=True).over(ahead))
    blocks = blocks.withColumn("last", F.when(F.col("opened"), F.col("end1")).otherwise(F.col("end0")))
    every = Window.partitionBy("file")
    blocks = blocks.withColumn("missing", F.col("length") - F.sum("bytes").over(every)).withColumn("cut", F.max("cut").over(every) & (F.count(F.lit(1)).over(every) > 1))
    # the reader takes away a byte order mark, of three bytes, which is part of the first column's name
    marked = (F.col("missing") >= 2) & F.array_contains("places", 0)
    blocks = blocks.withColumn("lacking", F.when(marked, "['the first one, for a byte order mark']").otherwise(F.col("lacking"))).withColumn("places", F.when(~marked, F.col("places")))
    head = [F.first(k).over(upto).alias(k) for k in ("places", "lacking")]
    return written(blocks.select("key", "start", "file", "name", "opened", "before", "owner", "last", F.col("missing").isin(0, 3).alias("ended"), "cut", *head), "blocks")


def csv_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of all *.csv below folder; files without the three columns are skipped with a warning, short rows fail.

    Files of any size are read by many tasks, in blocks of lines. A first scan finds which line breaks are quoted and how
    many records lie before each block; a second one parses chunks of records, and another joins those that lie in several
    blocks, where there are any. A task holds a chunk, or the longest record. What is known of a block is broadcast: a
    row for each 128 MB or file. Blocks go by 64-bit hashes of file names.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)  # for the session: plans run long after they are built
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
    files = spark.read.format("binaryFile").options(**options).load(folder).select("path", "length", F.xxhash64(F.col("_metadata.file_path")).alias("key"))
    names = F.element_at(F.split("path", "/"), -1).alias("name")
    files = files.select("key", "length", names, (F.row_number().over(Window.orderBy("path")) - 1).cast("long").alias("file"))  # names only
    files = written(files, "files")
    read = spark.read.options(**options).option("lineSep", "\n").text(folder)
    lines = read.select(F.xxhash64(F.col("_metadata.file_path")).alias("key"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    lines = _planned(lines)  # both scans must find the same blocks
    states = _csv_states(spark, lines, files)
    for bad in states.where("cut").select("name").limit(1).collect():
        raise ValueError(f"{bad['name']}: the header doesn't end in the file's first block")
    lacking = files.join(states.where("start = 0").select("file", "lacking", "places"), "file", "left").where("places is null")
    for bad in lacking.select("name", F.coalesce("lacking", F.lit(str(sorted(_NEED)))).alias("lacking")).limit(20).collect():
        log.warning("%s: missing columns %s - file skipped", bad["name"], bad["lacking"])
    good = states.where("places is not null")
    known = F.broadcast(good.select("key", "start", "file", "opened", "before", "places", "owner"))
    lines = lines.join(known, ["key", "start"]).select("file", "start", "opened", "before", "places", "line", "owner")
    rows = lines.mapInArrow(_record_rows, _CSV_ROWS)
    if not good.where("opened or last").isEmpty():
        parts = lines.mapInArrow(_part_rows, "file long, unit long, start long, base long, part binary")
        whole = parts.groupBy("file", "unit").agg(F.max("base").alias("base"), F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
        head = good.where("start = 0").select("file", "places", "ended")
        rows = rows.unionByName(whole.join(head, "file").select("file", "base", "places", "ended", "parts.part").mapInArrow(_joined_rows, _CSV_ROWS))
    rows = rows.join(files.select("file", "name"), "file").withColumn("source_id", F.concat("name", F.lit(":"), F.col("row").cast("string")))
    rows = rows.where(F.when(F.col("short"), F.raise_error(F.concat("source_id", F.lit(": short row"))).cast("boolean")).otherwise(F.lit(True)))
    return rows.select(*_NEED, "source_id", F.lit("fix").alias("kind"), _order(0, F.col("file"), F.col("row")))


def java_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a test-case tree: bad methods with their good variants, or with a repaired sink where the suite has none."""
    root = folder.rstrip("/").rsplit(":", 1)[-1].lstrip("/") + "/"
    number = F.regexp_extract("name", r"(?i)CWE([0-9]+)_[\p{L}\p{N}_]*?\.java$", 1)
    rows = _files(spark, folder, "*.java").withColumn("name", F.element_at(F.split("path", "/"), -1))
    rows = rows.where(number != "").withColumn("cwe", text._folded(number)).where("cwe is not null")
    rows = rows.withColumn("source", java.stripped(F.make_valid_utf8(F.col("content").cast("string")))).where(java.usable(F.col("source")))
    rows = rows.select("path", "file", "name", "cwe", "source", java.jdk_imports(F.col("source")).alias("imports"), java.method(F.col("source"), "bad").alias("bad")).where("bad is not null")
    stem = F.regexp_replace(F.regexp_replace("name", r"(?i)\.java$", ""), r"[^\p{L}\p{N}_]", "_")
    rows = rows.withColumn("class", F.concat(stem, F.lit("_case")))
    rows = rows.withColumn("vulnerable_code", java.wrapped(F.col("bad"), F.col("imports"), F.col("class")))
    goods = F.array(*(F.struct(java.method(F.col("source"), pattern).alias("body"), F.lit(label).alias("variant")) for pattern, label in java.GOOD))
    rows = rows.withColumn("good", F.try_element_at(F.filter(goods, lambda x: x["body"].isNotNull()), F.lit(1)))
    repaired = java.synthesized(F.col("cwe"), F.col("vulnerable_code"))
    own = java.wrapped(java.renamed_bad(F.col("good.body")), F.col("imports"), F.col("class"))
    made = F.col("cwe").isin(*java.SINKS)
    rows = rows.withColumn("fixed_code", F.when(made, repaired).otherwise(own)).where("fixed_code is not null")
    relative = F.element_at(F.split(F.col("path"), F.lit(root)), -1) if root != "/" else F.col("path")
    variant = F.when(made, "synth").otherwise(F.col("good.variant"))
    return rows.select("vulnerable_code", "fixed_code", "cwe", F.concat(relative, F.lit(":"), variant).alias("source_id"), F.lit("fix").alias("kind"), _order(1, F.col("file"), F.lit(0)))


def _field(value: Column, names: tuple[str, ...]) -> Column:
    """The first of the names whose value isn't null or empty, as a string; lists are joined by spaces."""

    def one(name: str) -> Column:
        at = f"$.{name}"
        listed = F.array_join(F.try_variant_get(value, at, "array<string>"), " ")
        return F.nullif(F.coalesce(listed, F.try_variant_get(value, at, "string")), F.lit(""))

    return F.coalesce(*(one(n) for n in names))


def _placed(rows: DataFrame, *columns: Column) -> DataFrame:
    """path, start (of the block that was read), line (in order within the block) and columns of rows of files."""
    at = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    return rows.select(*at, F.monotonically_increasing_id().alias("line"), *columns)


def _numbered_lines(rows: DataFrame) -> DataFrame:
    """path, row, value of _placed rows before each file's first null value; row grows with the place in the file.

    One aggregate finds every block's first line and first null, whatever the number of files.
    """
    blocks = rows.groupBy("path", "start").agg(F.min("line").alias("first"), F.min(F.when(F.col("value").isNull(), F.col("line"))).alias("bad"))
    place = F.col("start") + F.col("bad") - F.col("first")  # a block has fewer lines than bytes
    cut = blocks.groupBy(F.col("path").alias("p")).agg(F.min(place).alias("cut"))
    blocks = written(blocks.join(cut, F.col("path") == F.col("p")).select(F.col("path").alias("p"), F.col("start").alias("s"), "first", "cut"), "blocks")
    for bad in blocks.where("cut is not null").select("p").distinct().limit(20).collect():
        log.warning("%s: unreadable line - the rest of the file is skipped", bad["p"])
    joined = rows.join(blocks, (F.col("path") == F.col("p")) & (F.col("start") == F.col("s")))
    joined = joined.withColumn("row", F.col("start") + F.col("line") - F.col("first"))
    return joined.where(F.col("cut").isNull() | (F.col("row") < F.col("cut"))).select("path", "row", "value")


def cve_rows(spark: SparkSession, folder: str) -> DataFrame:
    """file, row, value (variant) of all *cvefixes* .jsonl, .json and .parquet files below folder, or folders of parts so named.

    Of a JSON-lines file the rows before the first bad line stay; other JSON files that can't be read are skipped.
    Files of a kind are read by one scan. Parquet files share one schema, merged.
    """
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"(cvefixes[^/]*?)(/part-[^/]*)?$", 1)
    listed = every.select("path", F.col("_metadata.file_path").alias("url")).withColumn("name", name).where("name <> ''")
    part = F.col("path").rlike("/part-[^/]*$")
    ending = F.lower(F.element_at(F.split(F.element_at(F.split("path", "/"), -1), r"\."), -1))
    listed = listed.withColumn("kind", F.when(part & (ending == "json"), "jsonl").otherwise(ending)).where(F.col("kind").isin("jsonl", "json", "parquet"))
    listed = written(listed.withColumn("file", (F.row_number().over(Window.orderBy("path")) - 1).cast("long")), "listed")  # names only
    paths: dict[str, list[str]] = {}
    for r in listed.select("kind", "path").collect():  # file names
        paths.setdefault(r["kind"], []).append(r["path"])
    parts = []
    if "jsonl" in paths:
        lines = _placed(spark.read.text([_literal(p) for p in paths["jsonl"]]).where(text.strip(F.col("value")) != ""), F.try_parse_json("value").alias("value"))
        parts.append(_numbered_lines(lines))
    if "json" in paths:
        whole = spark.read.text([_literal(p) for p in paths["json"]], wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("value"))
        items = F.coalesce(F.try_variant_get("value", "$", "array<variant>"), F.array("value"))
        parts.append(whole.where("value is not null").select("path", F.posexplode(items).alias("row", "value")).withColumn("row", F.col("row").cast("long")))
    if "parquet" in paths:
        table = spark.read.option("mergeSchema", "true").parquet(*(_literal(p) for p in paths["parquet"]))
        parts.append(_numbered_lines(_placed(table, _as_values(table))))
    if not parts:
        return spark.createDataFrame([], "file long, row long, doc string").select("file", "row", F.try_parse_json("doc").alias("value"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.join(listed.select("url", "file"), F.col("path") == F.col("url")).select("file", "row", "value")


def _as_values(rows: DataFrame) -> Column:
    return F.try_parse_json(F.to_json(F.struct(*(F.col(f"`{x}`") for x in rows.columns)))).alias("value")


def hub_rows(spark: SparkSession, source: str | None = None) -> DataFrame | None:
    """file, row, value of a collection that Spark can load: `format:path`, by default what CVEFIXES_SOURCE names.

    CVEFIXES_HF and CVEFIXES_SPLIT name a dataset of the hub, for the optional data source huggingface. One that can't
    be loaded is left out with a warning. Its rows come before those of files.
    """
    source = source or os.environ.get("CVEFIXES_SOURCE", "").strip()
    hub = os.environ.get("CVEFIXES_HF", "").strip()
    if not source and not hub:
        return None
    kind, _, path = source.partition(":") if source else ("huggingface", "", hub)
    try:
        reader = spark.read.format(kind)
        rows = (reader if source else reader.option("split", os.environ.get("CVEFIXES_SPLIT", "train"))).load(path)
        rows.schema  # noqa: B018  fails here if the source isn't there
    except Exception as e:  # noqa: BLE001  an optional source must not end the run
        log.warning("%s:%s can't be loaded, left out: %s", kind, path, str(e).split("\n")[0])
        return None
    return written(rows.select(F.lit(-1).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"), _as_values(rows).alias("value")), "hub")


def cve_pairs(spark: SparkSession, folder: str, source: str | None = None) -> DataFrame:
    """Java pairs of CVE collections: in scope, both sides there and different; numbered in input order, those of hub_rows first."""
    value = F.col("value")
    language = F.lower(_field(value, LANGUAGE))
    every, hub = cve_rows(spark, folder), hub_rows(spark, source)
    if hub is not None:  # its numbers hold the partition in their high bits: fold them to places first
        hub = numbered(hub, "row").select("file", (F.col("seq") - 1).alias("row"), "value")
        every = hub.unionByName(every)
    rows = every.where(language.isNull() | (language.contains("java") & ~language.contains("javascript")))
    rows = rows.select(_order(2, F.col("file") + 1, F.col("row")), text.cwe_mentioned(_field(value, CATEGORY)).alias("cwe"), _field(value, BEFORE).alias("b"), _field(value, AFTER).alias("a"), _field(value, IDENTITY).alias("ident"))
    rows = rows.where(F.col("cwe").isNotNull() & F.col("b").isNotNull() & F.col("a").isNotNull()).where(text.strip(F.col("b")) != text.strip(F.col("a")))
    rows = numbered(rows, "ord")
    ident = F.coalesce("ident", (F.col("seq") - 1).cast("string"))
    return rows.select(F.col("b").alias("vulnerable_code"), F.col("a").alias("fixed_code"), "cwe", F.concat(F.lit("cvefixes:"), ident, F.lit(":"), F.col("seq").cast("string")).alias("source_id"), F.lit("fix").alias("kind"), "ord")


READERS = {"csv": csv_pairs, "juliet": java_pairs, "cvefixes": cve_pairs}


def read_pairs(spark: SparkSession, folder: str, reader: str = "auto") -> DataFrame:
    """Pairs of one reader, or of all that find files, in order."""
    if reader != "auto":
        return READERS[reader](spark, folder)
    return reduce(DataFrame.unionByName, (read(spark, folder) for read in READERS.values()))
