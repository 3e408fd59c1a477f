"""Token counts: the exact histogram of encoded lengths, with suffix sums.

Documents are aggregated by their number of tokens; from the sums over all lengths at or above one follow
totals, quantiles and truncated totals for every context limit. The sums go over bands of lengths first,
then within each band, so no task holds more than a band or one row a band.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curaloom.llm import runtime

VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are split before merging; fixed by the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BAND = 1024

#: White space as the pattern takes it, in runs that its engine can't backtrack over.
_BLANK = re.compile("[\t-\r \x85\xa0  -     　]{1000,}")


class Counter:
    """Counts the tokens of texts with a byte-level vocabulary given as the content of its rank file."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
        self._coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> int:
        total, at = 0, 0
        for m in _BLANK.finditer(text):  # of a run before a word, all but the last blank are one piece
            end = m.end() if m.end() == len(text) else m.end() - 1
            total += len(self._coder.encode_ordinary(text[at : m.start()])) + len(self._coder._encode_single_piece(text[m.start() : end].encode()))
            at = end
        return total + len(self._coder.encode_ordinary(text[at:] if at else text))


def lengths(docs: DataFrame, vocabulary_file: str = VOCABULARY_FILE) -> DataFrame:
    """doc_id, tokens for every row of docs; null text counts as empty. The driver reads the vocabulary and ships it (1 MB)."""
    spark = docs.sparkSession
    runtime.bound_batches(spark)
    with open(vocabulary_file, "rb") as f:
        shipped = spark.sparkContext.broadcast(f.read())

    def run(batches):
        count = Counter(shipped.value)
        for batch in batches:
            n = [count((t or b"").decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """One row for each length that occurs: tokens (the length), n_docs, docs_from and tokens_from (at or above it),
    truncated_tokens (the total if every document is cut to this length) and share_upto (of documents no longer).
    """
    rows = counted.groupBy("tokens").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("band", F.floor(F.col("tokens") / BAND))
    rows = runtime.written(rows, "lengths")
    upward = Window.orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, 0)
    bands = rows.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum(F.col("tokens") * F.col("n_docs")).alias("t"))
    every = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bands = bands.select("band", F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"), (F.sum("d").over(upward) - F.col("d")).alias("d_above"), (F.sum("t").over(upward) - F.col("t")).alias("t_above"))
    inside = Window.partitionBy("band").orderBy(F.col("tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(bands, "band").select(
        "tokens",
        "n_docs",
        "all_docs",
        "all_tokens",
        (F.col("d_above") + F.sum("n_docs").over(inside)).alias("docs_from"),
        (F.col("t_above") + F.sum(F.col("tokens") * F.col("n_docs")).over(inside)).alias("tokens_from"),
    )
    return out.select(
        "tokens", "n_docs", "docs_from", "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("tokens") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs")).alias("share_upto"),
    )


def truncated_total(hist: DataFrame, limit: int) -> Column:
    """An aggregate over a histogram: all tokens if every document is cut to limit."""
    return F.coalesce(F.sum(F.least("tokens", F.lit(limit)) * F.col("n_docs")), F.lit(0))


def quantile(hist: DataFrame, q: float) -> Column:
    """An aggregate over a histogram: the least length that a share q of the documents doesn't exceed."""
    return F.min(F.when(F.col("share_upto") >= q, F.col("tokens")))
