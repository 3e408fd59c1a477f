"""Samples of this machine's GPUs while an external trainer runs, as rows for `score.gpu_summary`."""

from __future__ import annotations

import json
import shutil
import subprocess
import time
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession

# The tool, its options and the names in its answer.
TOOL, OPTIONS = "rocm-smi", ["--showuse", "--showmeminfo", "vram", "--json"]
USED_BYTES, BUSY_PERCENT = "VRAM Total Used Memory (B)", "GPU use (%)"

Sample = tuple[float, float, float]


def samples(tool: str) -> list[Sample]:
    """(time, gigabytes used, percent busy) of every card that the tool tells of now; none if it fails."""
    try:
        answer = json.loads(subprocess.run([tool, *OPTIONS], capture_output=True, text=True, timeout=15).stdout)
        now = round(time.time(), 1)
        return [(now, round(float(card[USED_BYTES]) / 2**30, 1), float(card[BUSY_PERCENT])) for card in answer.values() if USED_BYTES in card and BUSY_PERCENT in card]
    except (OSError, ValueError, TypeError, AttributeError, subprocess.SubprocessError):
        return []


@contextmanager
def watched(every: float = 30.0, tool: str = TOOL) -> Iterator[list[Sample]]:
    """A list that grows by samples while the block runs, one at its start and one at its end; it stays empty without the tool."""
    rows: list[Sample] = []
    found, over = shutil.which(tool), Event()

    def watch():
        rows.extend(samples(found))
        while not over.wait(every):
            rows.extend(samples(found))
        rows.extend(samples(found))

    thread = Thread(target=watch, daemon=True) if found else None
    if thread:
        thread.start()
    try:
        yield rows
    finally:
        over.set()
        if thread:
            thread.join(40)


def frame(spark: SparkSession, rows: list[Sample]) -> DataFrame:
    return spark.createDataFrame(rows, "t double, vram_used_gb double, gpu_busy_pct double")
