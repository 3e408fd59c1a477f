"""Scores, rates and before/after comparison. A null check didn't run and counts nowhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.functions import text as t

CHECKS = {"format": "format_ok", "compile": "compiles", "vuln_fixed": "vuln_fixed"}


def score(format_ok: Column, compiles: Column, vuln_fixed: Column, config: c.HarnessConfig = c.HarnessConfig()) -> Column:
    """The weighted share of passed checks among those that ran, rounded to four places."""
    weights = ((format_ok, config.weight_format), (compiles, config.weight_compile), (vuln_fixed, config.weight_vuln))
    passed = sum((F.when(F.coalesce(ok, F.lit(False)), F.lit(w)).otherwise(F.lit(0.0)) for ok, w in weights), F.lit(0.0))
    ran = sum((F.when(ok.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for ok, w in weights), F.lit(0.0))
    return F.bround(F.when(ran > 0, passed / ran).otherwise(0.0), 4)


def scored(rows: DataFrame, config: c.HarnessConfig = c.HarnessConfig()) -> DataFrame:
    """rows (response, cwe, compiles, vuln_fixed) with code, format_ok and score; without code all checks fail, whatever the tools say."""
    rows = rows.withColumn("code", t.java_code(F.col("response")))
    rows = rows.withColumn("format_ok", F.col("code").isNotNull())
    for name in ("compiles", "vuln_fixed"):
        rows = rows.withColumn(name, F.when(F.col("format_ok"), F.col(name)).otherwise(F.lit(False)))
    return rows.withColumn("score", score(F.col("format_ok"), F.col("compiles"), F.col("vuln_fixed"), config))


def rate(check: str) -> Column:
    """struct(passed, evaluated) as an aggregate; null if the check never ran."""
    return F.when(F.count(check) > 0, F.struct(F.count_if(F.col(check)).alias("passed"), F.count(check).alias("evaluated")))


def rates(results: DataFrame, *keys: str) -> DataFrame:
    """n, the passed and evaluated counts of every check, and mean_score, by keys or overall."""
    out = [F.count(F.lit(1)).alias("n")]
    for name, check in CHECKS.items():
        out += [F.when(F.count(check) > 0, F.count_if(F.col(check))).alias(f"{name}_passed"), F.when(F.count(check) > 0, F.count(check)).alias(f"{name}_evaluated")]
    return results.groupBy(*keys).agg(*out, F.avg("score").alias("mean_score"))


def before_after(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """cwe and the cells of both sides' vuln-fixed rates, over the categories of either."""

    def side(results: DataFrame, name: str) -> DataFrame:
        by = results.groupBy("cwe").agg(F.count_if(F.col("vuln_fixed")).alias("p"), F.count("vuln_fixed").alias("e"))
        return by.select("cwe", F.col("p").alias(f"{name}_p"), F.col("e").alias(f"{name}_e"))

    both = side(base, "base").join(side(tuned, "tuned"), "cwe", "full")
    return both.select("cwe", *(t.rate_cell(F.col(f"{n}_p"), F.col(f"{n}_e")).alias(n) for n in ("base", "tuned")))


def wins(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Rows of tuned that fixed what base (its last row of the source, by ord) did not."""
    last = base.groupBy("source_id").agg(F.max_by("vuln_fixed", "ord").alias("_base"))
    joined = tuned.join(last, "source_id", "left").where(F.col("vuln_fixed") & ~F.coalesce("_base", F.lit(False)))
    return joined.drop("_base")


def markdown(base: DataFrame, tuned: DataFrame, base_name: str, tuned_name: str) -> str:
    """The report: overall rates and the table by category, from two single rows and one row a category."""
    sides = [rates(x).first() for x in (base, tuned)]

    def cell(row, name: str) -> str:
        passed, total = row[f"{name}_passed"], row[f"{name}_evaluated"]
        return f"{100 * passed / total:.0f}% ({passed}/{total})" if total else "n/a (tool missing)"

    lines = ["# Before/after evaluation", "", f"- base:  `{base_name}`", f"- tuned: `{tuned_name}`", f"- test items: {sides[0]['n']}", "", "| metric | base | tuned |", "|---|---|---|"]
    for title, name in (("format rate", "format"), ("compile rate", "compile"), ("vuln-fixed rate", "vuln_fixed")):
        lines.append(f"| {title} | {cell(sides[0], name)} | {cell(sides[1], name)} |")
    lines.append("| mean score | " + " | ".join(f"{s['mean_score'] or 0:.3f}" for s in sides) + " |")
    lines += ["", "## Vuln-fixed rate per CWE", "", "| CWE | base | tuned |", "|---|---|---|"]
    lines += [f"| {r['cwe']} | {r['base']} | {r['tuned']} |" for r in before_after(base, tuned).orderBy("cwe").collect()]
    return "\n".join(lines) + "\n"


def gpu_summary(samples: DataFrame) -> DataFrame:
    """One row of samples (vram_used_gb, gpu_busy_pct); none for no samples."""
    out = samples.agg(
        F.count(F.lit(1)).alias("samples"),
        F.max("vram_used_gb").alias("vram_used_gb_max"),
        F.bround(F.avg("vram_used_gb"), 1).alias("vram_used_gb_mean"),
        F.bround(F.avg("gpu_busy_pct"), 1).alias("gpu_busy_pct_mean"),
    )
    return out.where("samples > 0")
