"""Command line: fetch, prepare, evaluate, augment."""

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from curaloom import config as c
from curaloom.operators import demo, generate, score
from curaloom.plans.prepare import prepare
from curaloom.sources import records


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="curaloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("prepare")
    one.add_argument("--raw-dir", required=True)
    one.add_argument("--out-dir", required=True)
    one.add_argument("--parser", default="auto", choices=["auto", "csv", "juliet", "cvefixes"])
    one.add_argument("--seed", type=int)
    one.add_argument("--max-chars", type=int)
    one.add_argument("--negatives-frac", type=float)
    one.add_argument("--no-compile-filter", dest="compile_filter", action="store_false", default=None)
    one.add_argument("--semgrep-filter", action="store_true", default=None)
    one.add_argument("--replay-file")
    one.add_argument("--make-demo-data", action="store_true", help="write demo pairs as CSV into the raw folder and exit")
    two = commands.add_parser("evaluate")
    two.add_argument("--test-file", required=True)
    two.add_argument("--out-dir", required=True)
    two.add_argument("--base-spec", default="mock:echo")
    two.add_argument("--tuned-spec", default="mock:gold")
    two.add_argument("--limit", type=int)
    three = commands.add_parser("augment")
    three.add_argument("--seed-file", required=True)
    three.add_argument("--out", required=True)
    three.add_argument("--spec", required=True)
    three.add_argument("--per-cwe", type=int, default=50)
    three.add_argument("--seed", type=int, default=42)
    four = commands.add_parser("fetch")
    four.add_argument("--url", required=True, help="zip archive of the test suite")
    four.add_argument("--out-dir", required=True)
    for sub in (one, two, three):
        sub.add_argument("--rules", help="folder of cwe_<n>.yml for the scanner")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("curaloom").getOrCreate()
    if a.command == "fetch":
        print(f"{records.fetched(spark, a.url, a.out_dir)} files in {a.out_dir}")
    elif a.command == "prepare" and a.make_demo_data:
        records.write_pairs(demo.pairs(spark).orderBy("ord").coalesce(1), f"{a.raw_dir}/demo_pairs")
    elif a.command == "prepare":
        given = {k: v for k in ("seed", "max_chars", "negatives_frac", "compile_filter", "semgrep_filter") if (v := getattr(a, k)) is not None}
        stats = prepare(spark, a.raw_dir, a.out_dir, a.parser, a.replay_file, dataclasses.replace(c.PrepConfig.from_env(), **given), rules=a.rules)
        print(records.stats_table(stats, stats["drops"]))
    elif a.command == "evaluate":
        rows = records.test_records(spark, a.test_file, a.limit)
        sides = {}
        for side, spec in (("base", a.base_spec), ("tuned", a.tuned_spec)):
            records.write_results(generate.evaluated(rows, generate.client(spec), c.HarnessConfig.from_env(), a.rules), f"{a.out_dir}/{side}_results")
            sides[side] = spark.read.schema("source_id string, cwe string, format_ok boolean, compiles boolean, vuln_fixed boolean, score double").json(f"{a.out_dir}/{side}_results")
        report = score.markdown(sides["base"], sides["tuned"], generate.client(a.base_spec).name, generate.client(a.tuned_spec).name)
        spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.out_dir}/results_md")
        print(report)
    else:
        from curaloom.storage import written

        rows = written(generate.augmented(records.seeds(spark, a.seed_file), generate.client(a.spec), a.per_cwe, a.seed, c.HarnessConfig.from_env(), a.rules is not None, a.rules), "augmented")
        records.write_pairs(rows.where("status = 'admitted'"), a.out)
        print(json.dumps(generate.augment_stats(rows).first().asDict()))


if __name__ == "__main__":
    main()
