"""From raw documents to a training mix: quality, near-duplicates, benchmark leaks, personal data, mixing.

Every stage is a function of (spark, docs, sf_dir) and works on all that the one before kept. Between
stages the documents are written as Parquet and read again, so each stage starts from a table.
"""

from curaloom import storage
from curaloom.llm import decontam, mixing, neardup, pii, quality, runtime


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, runtime.table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark, docs, sf_dir):
    """Of each group of near-duplicates the document of the smallest id stays."""
    return neardup.deduplicated(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontam.decontaminated(docs, runtime.table(spark, sf_dir, "benchmark"))


def pii_redaction(spark, docs, sf_dir):
    """Personal data in the texts is replaced by its kind."""
    return pii.redacted(docs)


def source_mixing(spark, docs, sf_dir):
    """Every source gives its target of words; documents taken twice appear in two epochs."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_redaction", pii_redaction),
    ("source_mixing", source_mixing),
]

#: The first stage is a trained network, which SQL can't express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of sf_dir; what a stage wrote for itself goes once its result is written."""
    docs = runtime.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = set(storage.given())
        kept = stage(spark, docs, sf_dir)
        own = [p for p in storage.given() if p not in before]
        docs = runtime.written(kept, name)
        storage.release(spark, own)
    return docs
