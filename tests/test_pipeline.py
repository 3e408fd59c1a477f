"""Cleaning, splitting, mixing and the whole build."""

import csv
import hashlib
import json
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.operators import clean, generate, score, similar, splitting, verify
from curaloom.plans import prepare
from curaloom.sources import pairs, records

PAIR = "vulnerable_code string, fixed_code string, cwe string, source_id string, kind string, ord long"


def frame(spark, rows):
    return spark.createDataFrame([(v, f, k, f"t:{i}", "fix", i) for i, (v, f, k) in enumerate(rows)], PAIR)


def sequential(rows, cap):
    """The funnel row by row."""
    seen, out = set(), []
    for v, f, k in rows:
        m = re.search(r"\d+", k or "")
        label = c.CWE_FOLD.get(m[0]) if m else None
        if label is None:
            out.append("cwe_out_of_scope")
            continue
        if not v.strip() or not f.strip():
            out.append("empty")
            continue
        key = tuple(re.sub(r"\s+", " ", x).strip() for x in (v, f))
        if key in seen:
            out.append("duplicate")
            continue
        a, b, d, e = c.PROMPT_PARTS
        if len(c.SYSTEM_PROMPT) + len(a + label + b + c.CWE_DESCRIPTIONS[label] + d + v.rstrip() + e) + len(f) > cap:
            out.append("too_long")
            continue
        seen.add(key)
        out.append(None)
    return out


def test_funnel_equals_the_sequential_model(spark):
    r = random.Random(4)
    rows = [("".join(r.choice("ab \n ") for _ in range(r.choice([0, 1, 3, 40]))), r.choice(["x", " ", "y y", "y  y"]), r.choice(["89", "CWE-22", "36", "79", "", None])) for _ in range(600)]
    cap = len(c.SYSTEM_PROMPT) + 250
    judged = clean.judged(frame(spark, rows), cap)
    got = [x.drop_reason for x in sorted(judged.collect(), key=lambda x: x.ord)]
    want = sequential(rows, cap)
    assert got == want and {"duplicate", "too_long", None} <= set(want)
    counts = {x.drop_reason: x.n for x in clean.drop_counts(judged).collect()}
    assert counts == {k: want.count(k) for k in c.DROP_REASONS}
    assert clean.kept(judged).count() + sum(counts.values()) == len(rows)


def test_clusters_are_exact_and_transitive(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdef") for _ in range(4))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(80)]
        for step in range(5):
            texts.append(" ".join(base[2 * step :] + [word() for _ in range(2 * step)]))
    texts += ["", " ", "a b", "a b", None, "one two three four five"]
    sets = []
    for x in texts:
        w = re.findall(r"\w+", (x or "").lower())
        sets.append({tuple(w)} if len(w) < 4 else {tuple(w[i : i + 4]) for i in range(len(w) - 3)})
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.85:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    assert {x.id: x.cluster_id for x in similar.clusters(rows).collect()} == {i: find(i) for i in range(len(texts))}


@pytest.mark.parametrize("seed", range(4))
def test_plan_equals_the_greedy_walk(seed):
    r = random.Random(seed)
    sizes = {s: r.randrange(1, 30) for s in r.sample(range(1, 12), 5)}
    total = sum(s * n for s, n in sizes.items())
    counts = {}
    for size, low, high, split in splitting.plan(sizes):
        counts[size, split] = counts.get((size, split), 0) + high - low + 1
    order = sorted(s for s, n in sizes.items() for _ in range(n))
    left = {"train": 8 * total, "val": total, "test": total}
    want = {}
    for split in ("test", "val"):
        s = order.pop(0)
        left[split] -= 10 * s
        want[s, split] = want.get((s, split), 0) + 1
    for s in sorted(order, reverse=True):
        split = max(c.SPLITS, key=lambda n: left[n])
        left[split] -= 10 * s
        want[s, split] = want.get((s, split), 0) + 1
    assert counts == want


def test_split_keeps_clusters_together(spark):
    rows = spark.createDataFrame([(i, i // 3 if i < 60 else i) for i in range(200)], "id long, cluster_id long")
    one, two = ({x.id: x.split for x in splitting.split(rows.repartition(n)).collect()} for n in (2, 5))
    assert one == two and len(one) == 200
    assert all(one[i] == one[i // 3 * 3] for i in range(60))
    n = {s: list(one.values()).count(s) for s in c.SPLITS}
    assert n["train"] >= 150 and n["val"] >= 1 and n["test"] >= 1
    assert splitting.split(rows.limit(0)).count() == 0


def test_negatives_and_replay(spark):
    rows = spark.createDataFrame([(f"v{i}", f"f{i}", "CWE-89", f"s{i}", "fix", i, "train" if i < 45 else "val" if i < 50 else "test") for i in range(51)], PAIR + ", split string")
    more = splitting.negatives(rows)
    n = {x["split"]: x["count"] for x in more.where("kind = 'no_change'").groupBy("split").count().collect()}
    assert n == {"train": 4, "val": 1, "test": 1}  # halves go to the even number
    assert all(x.vulnerable_code == x.fixed_code for x in more.where("kind = 'no_change'").collect())
    assert splitting.leaks(more).count() == 0 and splitting.negatives(rows, 0).count() == 51
    moved = more.withColumn("split", F.when(F.col("kind") == "no_change", "val").otherwise(F.col("split")))
    assert splitting.leaks(moved).count() > 0
    pool = spark.createDataFrame([("s", "i", "o", "general", "", f"r{i}", "replay") for i in range(100)], "system string, input string, output string, cwe string, vulnerable_code string, source_id string, kind string")
    mixed = splitting.with_replay(splitting.triplets(more), pool, 0.2)
    assert {(x.split, x.kind) for x in mixed.where("kind = 'replay'").collect()} == {("train", "replay")}
    assert mixed.where("kind = 'replay'").count() == int(49 * 0.2)


@pytest.mark.parametrize("ids", [["r"] * 10, ["a", "b"] * 5, [None] * 6 + ["c"] * 4])
def test_replay_cap_holds_for_repeated_ids(spark, ids):
    kind = "system string, input string, output string, cwe string, vulnerable_code string, source_id string, kind string"
    task = spark.createDataFrame([("s", "i", "o", "CWE-89", "", f"t{i}", "fix", "train") for i in range(20)], kind + ", split string")
    for inputs in ([f"i{k}" for k in range(10)], ["same"] * 10):
        rows = [("s", i, "o", "general", "", x, "replay") for x, i in zip(ids, inputs, strict=True)]
        pool = spark.createDataFrame(rows, kind)
        one, two = (sorted(map(str, splitting.with_replay(task, p, 0.15).where("kind = 'replay'").collect())) for p in (pool, pool.repartition(3)))
        assert len(one) == 3 and one == two
        assert splitting.with_replay(task, pool, 0.9).where("kind = 'replay'").count() == 10
        assert splitting.with_replay(task, pool, 0).where("kind = 'replay'").count() == 0


def test_scores(spark):
    rows = [("```java\nclass A {}\n```", "CWE-89", True, True), ("class A {}", "CWE-89", True, None), ("class A {}", "CWE-89", False, None), ("prose", "CWE-78", None, None), ("class A {}", "CWE-78", None, None), ("class A {}", "CWE-22", True, False)]
    got = score.scored(spark.createDataFrame(rows, "response string, cwe string, compiles boolean, vuln_fixed boolean"))
    assert [(x.format_ok, x.compiles, x.vuln_fixed, x.score) for x in got.collect()] == [(True, True, True, 1.0), (True, True, None, 1.0), (True, False, None, 0.3333), (False, False, False, 0.0), (True, None, None, 1.0), (True, True, False, 0.6)]
    r = score.rates(got).first()
    assert (r.n, r.format_passed, r.format_evaluated, r.compile_passed, r.compile_evaluated, r.vuln_fixed_passed, r.vuln_fixed_evaluated) == (6, 5, 6, 3, 5, 1, 3)
    unrun = score.rates(got.where("response = 'class A {}' and cwe = 'CWE-78'")).first()
    assert unrun.compile_passed is None and unrun.compile_evaluated is None
    text = score.markdown(got, got, "b", "t")
    assert "| compile rate | 60% (3/5) | 60% (3/5) |" in text and "| CWE-78 | 0% (0/1) | 0% (0/1) |" in text


def test_wins_take_the_last_row_of_a_source(spark):
    kind = "source_id string, vuln_fixed boolean, ord long"
    base = spark.createDataFrame([("a", True, 0), ("a", False, 1), ("b", True, 2), ("c", None, 3)], kind)
    tuned = spark.createDataFrame([("a", True, 0), ("b", True, 1), ("c", True, 2), ("d", True, 3), ("e", None, 4)], kind)
    assert sorted(x.source_id for x in score.wins(base, tuned).collect()) == ["a", "c", "d"]


def test_tools(spark, tmp_path):
    fake = tmp_path / "semgrep"
    fake.write_text('#!/bin/sh\nfor f in "$@"; do :; done\nif grep -q VULN "$f"; then echo \'{"results": [{"check_id": "r"}]}\'; else echo \'{"results": []}\'; fi\n')
    fake.chmod(0o755)
    (tmp_path / "cwe_89.yml").write_text("rules: []")
    config = c.HarnessConfig(javac_bin="no-such-javac", semgrep_bin=str(fake))
    own = verify.rule_texts(str(tmp_path))
    assert verify.compiles("class A {}", config)[0] is None and "javac" in verify.compiles("class A {}", config)[1]
    assert verify.clean("class A { /* VULN */ }", "CWE-89", config, own) == (False, "r") and verify.clean("class A {}", "CWE-89", config, own) == (True, "")
    missing = verify.clean("x", "CWE-89", c.HarnessConfig(semgrep_bin="no-such-semgrep"), own)
    assert missing[0] is None and "semgrep" in missing[1]
    assert verify.clean("x", "CWE-22", config, own)[0] is None  # no rules, no verdict
    rows = frame(spark, [("class A { /* VULN */ }", "class A {}", "CWE-89"), ("class B {}", "class B { }", "CWE-89"), ("class C { /* VULN */ }", "class C { /* VULN */ int x; }", "CWE-89")])
    got = verify.verified(rows, c.PrepConfig(semgrep_filter=True, workers=2), config, str(tmp_path))
    assert [x.drop_reason for x in sorted(got.collect(), key=lambda x: x.ord)] == [None, "vuln_not_flagged", "fixed_still_flagged"]


def test_a_scanner_without_an_answer_is_left_out(spark, tmp_path, caplog):
    slow, mute = tmp_path / "slow", tmp_path / "mute"
    slow.write_text("#!/bin/sh\nexec sleep 30\n")
    mute.write_text("#!/bin/sh\necho nothing to read\n")
    rows = frame(spark, [("class A {}", "class A { int x; }", "CWE-89")])
    for program in (slow, mute):
        program.chmod(0o755)
        config = c.HarnessConfig(javac_bin="no-such-javac", semgrep_bin=str(program), semgrep_timeout_s=1)
        assert verify.probed(config) == (False, False) and "left out" in caplog.text
        assert [x.drop_reason for x in verify.verified(rows, c.PrepConfig(semgrep_filter=True), config).collect()] == [None]
        record = spark.createDataFrame([("s", "i", "```java\nclass A {}\n```", "CWE-89", "a")], "system string, input string, output string, cwe string, source_id string")
        assert generate.evaluated(record, generate.client("mock:gold"), config).first().vuln_fixed is None
        caplog.clear()


def test_rules_are_shipped_for_every_category():
    texts = verify.rule_texts()
    assert set(texts) == set(c.TARGET_CWES)
    for cwe, text in texts.items():
        rules = text.split("\n  - id: ")[1:]
        assert rules and all("languages: [java]" in r and re.search("severity: (ERROR|WARNING)", r) and "message: " in r and f"metadata: {{cwe: {cwe}}}" in r and re.search(r"\n    patterns?:|\n    pattern-either:", r) for r in rules)


@pytest.mark.skipif(not verify.probed(c.HarnessConfig())[0], reason="no compiler")
def test_compiler():
    config = c.HarnessConfig()
    assert verify.compiles("public class A { int x; }", config)[0] is True
    assert verify.compiles("public class A { int x }", config)[0] is False


def test_clients():
    assert generate.client("mock:gold").name == "mock:gold" and generate.client("openai:http://h/v1#m").name == "openai:m"
    assert generate.client("hf:x/y#adapter=/p").name == "hf:x/y+/p"
    for bad in ("mock:what", "openai:http://h", "hf:x#y", "zzz"):
        with pytest.raises(ValueError):
            generate.client(bad)


class Canned:
    def __init__(self, response):
        self.response = response

    def responses(self, rows):
        return rows.withColumn("response", self.response)


def test_augmentation(spark):
    seeds = spark.createDataFrame([(k, f"class S{i} {{}}", f"s{i}") for i in range(3) for k in (*c.TARGET_CWES, "CWE-1")], "cwe string, vulnerable_code string, source_id string")
    config = c.HarnessConfig(javac_bin="no-such-javac")
    pair = F.to_json(F.struct(F.concat(F.lit("class V"), F.col("attempt").cast("string"), F.lit(" {}")).alias("vulnerable_code"), F.lit("class F {}").alias("fixed_code")))
    counts = lambda response, n: generate.augment_stats(generate.augmented(seeds, Canned(response), n, config=config)).first().asDict()
    assert counts(pair, 2) == {"generated": 6, "unparseable": 0, "rejected": 0, "admitted": 6}
    assert counts(F.lit("garbage"), 2) == {"generated": 18, "unparseable": 18, "rejected": 0, "admitted": 0}
    same = F.lit('{"vulnerable_code": "a", "fixed_code": " a"}')
    assert counts(same, 1) == {"generated": 9, "unparseable": 0, "rejected": 9, "admitted": 0}
    assert "CWE-89 (SQL Injection" in generate.attempts(seeds, 1).where("cwe = 'CWE-89'").first().input


def test_demo_pairs_compile_and_differ_in_findings(spark):
    from curaloom.operators import approximate, demo

    rows = demo.pairs(spark)
    assert rows.count() == 19
    seen = rows.select("cwe", approximate.clean(F.col("vulnerable_code"), F.col("cwe")).alias("v"), approximate.clean(F.col("fixed_code"), F.col("cwe")).alias("f")).distinct().collect()
    assert {(x.cwe, x.v) for x in seen} == {(k, False) for k in c.TARGET_CWES} and all(x.f for x in seen)
    if verify.probed(c.HarnessConfig())[0]:
        for r in rows.dropDuplicates(["cwe"]).collect():
            assert verify.compiles(r.vulnerable_code, c.HarnessConfig())[0] and verify.compiles(r.fixed_code, c.HarnessConfig())[0]


def test_command_line(spark, tmp_path, capsys):
    from curaloom.__main__ import main

    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    main(["prepare", "--raw-dir", raw, "--out-dir", out, "--make-demo-data"])
    main(["prepare", "--raw-dir", raw, "--out-dir", out, "--no-compile-filter"])
    assert '"duplicate": 1' in capsys.readouterr().out
    main(["augment", "--seed-file", f"{out}/splits/split=train", "--out", f"{out}/more", "--spec", "mock", "--per-cwe", "2"])
    assert '"admitted": 6' in capsys.readouterr().out
    main(["evaluate", "--test-file", f"{out}/splits/split=test", "--out-dir", f"{out}/eval", "--limit", "2"])
    assert "| format rate | 100%" in capsys.readouterr().out


SUITE = """package testcases.x;
import testcasesupport.*;
import java.io.*;
import javax.servlet.http.*;
public class {name} extends AbstractTestCase {{
    public void bad() throws Throwable {{
        String data = "x";
        {sink}
        IO.writeLine("{{" + data + "}}");
    }}
    private void goodG2B() throws Throwable {{ IO.writeLine("g2b"); }}
    {extra}
}}
"""


def test_readers(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "sub").mkdir(parents=True)
    with open(raw / "b.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerows([["cwe", "extra", "vulnerable_code", "fixed_code"], ["89", "z", 'a "q"\r\n\\n é', "b"], ["22", "z", "", "c"]])
    (raw / "sub" / "a.csv").write_text("a,b\n1,2\n")
    rows = sorted(pairs.csv_pairs(spark, str(raw)).collect(), key=lambda x: x.ord)
    assert [(x.vulnerable_code, x.fixed_code, x.cwe, x.source_id) for x in rows] == [('a "q"\r\n\\n é', "b", "89", "b.csv:0"), ("", "c", "22", "b.csv:1")]
    odd = tmp_path / "odd"
    odd.mkdir()
    texts = [["x\ny,z", ' "lead" ', "78"], ["'", "\\", ""], ['"', "a\r\nb", "CWE-22, 89"], ["é" * 50, "   ", "#"]]
    for name, order in (("one [1].csv", (0, 1, 2)), ("two.csv", (2, 0, 1)), ("three.csv", (0, 1, 2))):
        with open(odd / name, "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow([("vulnerable_code", "fixed_code", "cwe")[k] for k in order])
            w.writerows([t[k] for k in order] for t in texts)
    (odd / "empty.csv").write_text("")
    (odd / "only_head.csv").write_text("vulnerable_code,fixed_code,cwe\n")
    rows = sorted(pairs.csv_pairs(spark, str(odd)).collect(), key=lambda x: x.ord)
    assert [(x.vulnerable_code, x.fixed_code, x.cwe) for x in rows] == [tuple(t) for t in texts] * 3
    assert [x.source_id for x in rows] == [f"{n}:{i}" for n in ("one [1].csv", "three.csv", "two.csv") for i in range(4)]
    (odd / "short.csv").write_text("vulnerable_code,fixed_code,cwe\na,b,89\na\n")
    with pytest.raises(Exception, match="short.csv:1: short row"):
        pairs.csv_pairs(spark, str(odd)).collect()

    java = {
        "CWE89_SQL_01.java": SUITE.format(name="CWE89_SQL_01", sink="run(data);", extra='private void goodB2G1() throws Throwable { goodB2G1(); IO.logger.log("b2g"); }'),
        "CWE89_SQL_02.java": SUITE.format(name="CWE89_SQL_02", sink="run(data);", extra=""),
        "CWE23_Path_01.java": SUITE.format(name="CWE23_Path_01", sink="File file = new File(root + data);", extra=""),
        "CWE78_OS_01.java": SUITE.format(name="CWE78_OS_01", sink="Process process = Runtime.getRuntime().exec(osCommand + data);", extra=""),
        "CWE78_OS_02.java": SUITE.format(name="CWE78_OS_02", sink="unknown(data);", extra=""),
        "CWE79_XSS_01.java": SUITE.format(name="CWE79_XSS_01", sink="", extra=""),
        "CWE89_Helper_03.java": SUITE.format(name="H", sink="IO.unknown();", extra=""),
        "Other.java": "class X {}",
    }
    for name, text in java.items():
        (raw / "sub" / name).write_text(text)
    got = {x.source_id: x for x in pairs.java_pairs(spark, str(raw)).collect()}
    assert set(got) == {"sub/CWE89_SQL_01.java:B2G", "sub/CWE89_SQL_02.java:G2B", "sub/CWE23_Path_01.java:synth", "sub/CWE78_OS_01.java:synth"}
    one = got["sub/CWE89_SQL_01.java:B2G"]
    assert one.vulnerable_code.startswith("import java.io.*;\n\npublic class CWE89_SQL_01_case {\n\npublic void bad()") and "javax" not in one.vulnerable_code and "IO." not in one.vulnerable_code.replace("java.io", "")
    assert "private void bad() throws Throwable { bad(); java.util.logging.Logger.getGlobal()" in one.fixed_code
    assert got["sub/CWE23_Path_01.java:synth"].cwe == "CWE-22" and "allowedDir" in got["sub/CWE23_Path_01.java:synth"].fixed_code
    assert "ProcessBuilder" in got["sub/CWE78_OS_01.java:synth"].fixed_code

    lines = [{"lang": "Java", "before": "a", "fixed_code": "b", "cwe_ids": ["CWE-1", "CWE-89"], "cve": "C1"}, {"language": "JavaScript", "before": "a", "after": "b", "cwe": "89"}, {"func_before": "", "code_before": "x", "func_after": "y", "cwe": "CWE-23"}, {"before": "a ", "after": "a", "cwe": "89"}, {"before": "a", "after": "b", "cwe": "79"}]
    (raw / "x_cvefixes.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\n{broken\n" + json.dumps(lines[0]) + "\n")
    (raw / "y_cvefixes.json").write_text(json.dumps([lines[0], lines[2]]))
    (raw / "z_cvefixes.json").write_text("nonsense")
    rows = sorted(pairs.cve_pairs(spark, str(raw)).collect(), key=lambda x: x.ord)
    assert [(x.vulnerable_code, x.fixed_code, x.cwe, x.source_id) for x in rows] == [("a", "b", "CWE-89", "cvefixes:C1:1"), ("x", "y", "CWE-22", "cvefixes:1:2"), ("a", "b", "CWE-89", "cvefixes:C1:3"), ("x", "y", "CWE-22", "cvefixes:3:4")]
    every = pairs.read_pairs(spark, str(raw)).collect()
    assert len(every) == 2 + 4 + 4 and len({x.ord for x in every}) == 10

    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        for name in java:
            z.writestr(f"suite/{name}", java[name])
    assert {x.name for x in records.archive_members(spark, str(tmp_path / "s.zip")).collect()} == {n for n in java if re.match("CWE(89|78|23|36)_", n)}


def test_fetched_archives_and_other_sources(spark, tmp_path, monkeypatch, caplog):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("suite-main/src/CWE89_A_01.java", SUITE.format(name="CWE89_A_01", sink="run(data);", extra=""))
        z.writestr("suite-main/src/CWE79_B_01.java", "class B {}")
    out = str(tmp_path / "raw")
    assert records.fetched(spark, f"file://{tmp_path}/s.zip", out) == 1
    assert [x.source_id for x in pairs.java_pairs(spark, out).collect()] == ["CWE89_A_01.java:G2B"]
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("x.txt", "")
    with pytest.raises(Exception, match="no test cases"):
        records.fetched(spark, f"file://{tmp_path}/none.zip", out)
    spark.createDataFrame([("a", "b", "89", "C1"), ("x", "y", "78", None)], "func_before string, func_after string, cwe string, cve string").coalesce(1).write.orc(str(tmp_path / "table"))
    (tmp_path / "raw" / "z_cvefixes.jsonl").write_text(json.dumps({"before": "p", "after": "q", "cwe": "22"}) + "\n")
    monkeypatch.setenv("CVEFIXES_SOURCE", f"orc:{tmp_path}/table")
    rows = sorted(pairs.cve_pairs(spark, out).collect(), key=lambda x: x.ord)
    assert [(x.vulnerable_code, x.cwe, x.source_id) for x in rows] == [("a", "CWE-89", "cvefixes:C1:1"), ("x", "CWE-78", "cvefixes:1:2"), ("p", "CWE-22", "cvefixes:2:3")]
    monkeypatch.delenv("CVEFIXES_SOURCE")
    monkeypatch.setenv("CVEFIXES_HF", "some/dataset")
    assert pairs.cve_pairs(spark, out).count() == 1 and "left out" in caplog.text


def test_many_part_files_keep_their_order(spark, tmp_path):
    folder = tmp_path / "x_cvefixes.jsonl"
    rows = spark.range(500).selectExpr("concat('b', id) as before", "concat('a', id) as after", "'89' as cwe", "id as cve").repartitionByRange(12, "cve")
    rows.write.json(str(folder))
    got = sorted(pairs.cve_pairs(spark, str(tmp_path)).collect(), key=lambda x: x.ord)
    assert [x.source_id for x in got] == [f"cvefixes:{i}:{i + 1}" for i in range(500)]


def test_local_model(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("s", "i one"), ("s", "i two")], "system string, input string")
    client = generate.client("hf:some/model#adapter=/a")
    monkeypatch.setattr(generate, "find_spec", lambda name: None)
    with pytest.raises(ModuleNotFoundError, match="openai"):
        client.responses(rows)
    (tmp_path / "transformers.py").write_text(
        "class _G:\n    def __init__(self, model): self.model, self.name, self.adapter = self, model, None\n    def load_adapter(self, a): self.adapter = a\n"
        "    def __call__(self, chats, max_new_tokens, do_sample, return_full_text):\n        assert not do_sample and not return_full_text\n"
        "        return [[{'generated_text': self.name + self.adapter + c[0]['content'] + c[1]['content']}] for c in chats]\n"
        "def pipeline(task, model, **options): return _G(model)\n"
    )
    spark.sparkContext.addPyFile(str(tmp_path / "transformers.py"))
    monkeypatch.setattr(generate, "find_spec", lambda name: True)
    assert [x.response for x in client.responses(rows).collect()] == ["some/model/asi one", "some/model/asi two"]


def test_endpoint(spark):
    """Against a server of our own: answers keep their rows, failed calls are empty."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            user = asked["messages"][1]["content"]
            self.send_response(500 if user == "i7" else 200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": f"{asked['model']}:{user}"}}]}).encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = spark.createDataFrame([("s", f"i{k}") for k in range(30)], "system string, input string")
    got = generate.client(f"openai:http://127.0.0.1:{server.server_port}/v1#m").responses(rows).collect()
    server.shutdown()
    assert {x.input: x.response for x in got} == {f"i{k}": "" if k == 7 else f"m:i{k}" for k in range(30)}


def test_repaired_code_of_a_client(spark):
    tools = c.HarnessConfig(javac_bin="no-such-javac", semgrep_bin="no-such-semgrep")
    rows = spark.createDataFrame([("class A {}", "CWE 89", "a"), ("no type", "78", "b")], "vulnerable_code string, cwe string, source_id string")
    got = {x.source_id: (x.cwe, x.code, x.format_ok) for x in generate.repaired(rows, generate.client("mock:echo"), tools).collect()}
    assert got == {"a": ("CWE-89", "class A {}", True), "b": ("CWE-78", "```java\nno type\n\n```", False)}


def test_gpu_samples(spark, tmp_path):
    from curaloom.operators import monitor

    with monitor.watched(0.01, "no-such-tool") as rows:
        pass
    assert rows == [] and score.gpu_summary(monitor.frame(spark, rows)).count() == 0
    tool = tmp_path / "smi"
    card = {monitor.USED_BYTES: str(140 * 2**30), monitor.BUSY_PERCENT: "80"}
    tool.write_text(f"#!/bin/sh\necho '{json.dumps({'card0': card, 'system': {'x': '1'}})}'\n")
    tool.chmod(0o755)
    with monitor.watched(60, str(tool)) as rows:
        pass
    assert [x[1:] for x in rows] == [(140.0, 80.0)] * 2
    assert score.gpu_summary(monitor.frame(spark, rows)).first().vram_used_gb_max == 140
    tool.write_text("#!/bin/sh\necho broken\n")
    assert monitor.samples(str(tool)) == []


def test_run_report(spark, tmp_path):
    samples = spark.createDataFrame([(0.0, 100.0, 70.0), (1.0, 140.0, 90.0)], "t double, vram_used_gb double, gpu_busy_pct double")
    report = records.run_report({"epochs": 3}, 0.5, list(range(60)), {"t": "1"}, samples)
    assert report["gpu_utilization"]["vram_used_gb_max"] == 140 and len(report["log_history"]) == 50 and report["epochs"] == 3 and report["train_loss"] == 0.5
    records.write_json(spark, report, str(tmp_path / "run_metadata.json"))
    assert json.loads(spark.read.text(str(tmp_path / "run_metadata.json")).first().value) == report
    assert records.run_report({}, samples=samples.limit(0)) == {}


def test_record_files(spark, tmp_path):
    good = {"system": "s", "input": "i", "output": "o"}
    path = tmp_path / "r.jsonl"
    path.write_text(json.dumps(good) + "\n\n" + json.dumps(good) + "\n")
    assert [x.source_id for x in records.replay_records(spark, str(path)).collect()] == ["r.jsonl:0", "r.jsonl:2"]
    assert records.training_records(spark, str(path), 1).count() == 1 and records.training_records(spark, str(path), 0).count() == 1
    path.write_text(json.dumps({"system": "s", "input": "i", "output": ""}) + "\n")
    with pytest.raises(ValueError, match="output"):
        records.replay_records(spark, str(path))
    assert records.test_records(spark, str(path)).first().source_id == "1"
    path.write_text("\n")
    with pytest.raises(ValueError, match="empty"):
        records.test_records(spark, str(path))
    path.write_text("".join(json.dumps({"vulnerable_code": v, "cwe": k, **x}) + "\n" for v, k, x in [("a", "CWE-89", {}), ("b", "CWE-89", {"kind": "no_change"}), ("c", "CWE-1", {})]))
    assert [x.vulnerable_code for x in records.seeds(spark, str(path)).collect()] == ["a"]


def test_csv_files_are_read_in_blocks(spark, tmp_path):
    """Records over line breaks and blocks, odd quotes, fields beyond the csv module's default limit; many tasks read one file."""
    long, odd = "x\r\n\"y\", " * 20_000, ['a"b,"c ""d"" e"z,f\r\n', "\n\r\n", "g,\"h\n\n\",i\rj,k,l\n"]
    for n, last in enumerate(["", "m,n,o", 'm,n,"o', 'm,n,"o\n']):
        with open(tmp_path / f"{n}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow([("vulnerable_code", "fixed_code", "cwe")[(n + k) % 3] for k in range(3)])
            for i in range(300):
                w.writerow([f"é{i}\n" * (i % 40), f'"{i}', long if i == 150 else ","])
                f.write(odd[i % 3])
            f.write(last)
    limit = csv.field_size_limit(10**9)
    want = []
    for n in range(4):
        with open(tmp_path / f"{n}.csv", newline="", encoding="utf-8") as f:
            want += [(x["vulnerable_code"], x["fixed_code"], x["cwe"], f"{n}.csv:{i}") for i, x in enumerate(csv.DictReader(f))]
    csv.field_size_limit(limit)
    (tmp_path / "marked.csv").write_bytes(b"\xef\xbb\xbfcwe,vulnerable_code,fixed_code\na,b,c\n")
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = pairs.csv_pairs(spark, str(tmp_path))
        got = sorted(rows.withColumn("task", F.spark_partition_id()).collect(), key=lambda x: x.ord)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    assert [(x.vulnerable_code, x.fixed_code, x.cwe, x.source_id) for x in got] == want
    assert len({x.task for x in got if x.source_id.startswith("0.csv")}) > 2


def test_written_pairs_come_back_whole(spark, tmp_path):
    """White space at the edges of a text, an empty text and odd quotes survive the CSV file."""
    texts = ["", " ", "  a", "a \n", "\r\n\ta\r", "\x00a\x1f", "\n\n", ' "x"', '"', '\\" ', "\ufeffa", "b\n"]
    rows = [(t, f'{t} "x"', " 89") for t in texts]
    records.write_pairs(frame(spark, rows), str(tmp_path / "pairs"))
    got = pairs.csv_pairs(spark, str(tmp_path / "pairs")).collect()
    assert sorted((x.vulnerable_code, x.fixed_code, x.cwe) for x in got) == sorted(rows)


def test_csv_blocks_stay_when_splits_change(spark, tmp_path):
    """Blocks are those of the first scan, whatever the session's split size is when the rows are read."""
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([pairs._NEED, *((f"a\n{i}", "b" * 100, "89") for i in range(4000))])
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        rows = pairs.csv_pairs(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
        got = sorted(x.vulnerable_code for x in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    assert got == sorted(f"a\n{i}" for i in range(4000))


def test_build_end_to_end(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    rows = [(f"class A{i} {{ String s = \"{hashlib.sha256(str(i).encode()).hexdigest()}\"; int a{i}, b{i}, c{i}; }}", f"class A{i} {{ int {chr(97 + i)}; }}", c.TARGET_CWES[i % 3]) for i in range(18)]
    with open(raw / "p.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([("vulnerable_code", "fixed_code", "cwe"), *rows, rows[0]])
    (tmp_path / "replay.jsonl").write_text("".join(json.dumps({"system": "s", "input": f"i{i}", "output": "o"}) + "\n" for i in range(50)))
    stats = prepare.prepare(spark, str(raw), str(out), replay_file=str(tmp_path / "replay.jsonl"), prep=c.PrepConfig(workers=2))
    splits = stats["splits"]
    assert stats["drops"]["duplicate"] == 1 and stats["negatives_added"] >= 3
    assert sum(s["total"] for s in splits.values()) == 18 + stats["negatives_added"] + stats["replay_added"]
    task = splits["train"]["total"] - splits["train"]["replay"]
    assert stats["replay_added"] == splits["train"]["replay"] == int(task * 0.15) and splits["test"]["replay"] == 0
    assert "split" in records.stats_table(stats, stats["drops"])
    test = records.test_records(spark, f"{out}/splits/split=test")
    tools = c.HarnessConfig(javac_bin="no-such-javac")
    assert score.rates(generate.evaluated(test, generate.client("mock:gold"), tools)).first().mean_score == 1.0
    assert score.rates(generate.evaluated(test, generate.client("mock:refuse"), tools)).first().mean_score == 0.0
