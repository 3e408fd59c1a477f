"""Text expressions against Python's own semantics."""

import hashlib
import re
import shutil
import subprocess

import pytest
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.functions import java
from curaloom.functions import text as t

ODD = ["", " ", "a  b\t\nc", "\x1c x  y ", "Ünï_9 ÀB", "　", "a\x85b", "x" * 50]


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string").select("i", expression(F.col("v")).alias("o"))
    return [r.o for r in sorted(rows.collect())]


def test_strip_and_fingerprint(spark):
    assert column(spark, ODD, t.strip) == [v.strip() for v in ODD]
    assert column(spark, ODD, t.rstrip) == [v.rstrip() for v in ODD]
    want = [hashlib.sha256("\0".join([re.sub(r"\s+", " ", x).strip() for x in (v, "q  r")]).encode()).hexdigest() for v in ODD]
    assert column(spark, ODD, lambda v: t.fingerprint(v, F.lit("q  r"))) == want


def test_shingles(spark):
    values = ["", "a b", "A b c d e", "a b c d a b c d", "x-y.z w"]
    want = []
    for v in values:
        w = re.findall(r"\w+", v.lower())
        want.append({" ".join(w)} if len(w) < 4 else {" ".join(w[i : i + 4]) for i in range(len(w) - 3)})
    got = column(spark, values, t.shingles)
    assert [set(x) for x in got] == want and all(len(x) == len(set(x)) for x in got)


def test_shingles_are_tokenised_once(spark):
    rows = spark.createDataFrame([("a b c d e",)], "v string").select(F.explode_outer(t.shingles(F.col("v"))))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_labels(spark):
    values = ["CWE-89", "89", "cwe89", "23", "CWE-36 x", "79", "", None, "foo", "79 or 22"]
    assert column(spark, values, t.cwe_label) == ["CWE-89", "CWE-89", "CWE-89", "CWE-22", "CWE-22", None, None, None, None, None]
    assert column(spark, values, t.cwe_mentioned)[-1] == "CWE-22"
    assert column(spark, ["cwe-78", "CWE22"], t.cwe_strict) == ["CWE-78", "CWE-22"]
    for bad in ("CWE-23", "none", None):
        with pytest.raises(Exception, match="unsupported CWE"):
            column(spark, [bad], t.cwe_strict)


GOOD = "public class Good {\n  int x;\n}\n"


def test_java_code(spark):
    values = [f"Sure:\n```java\n{GOOD}```\nbye", f"```\n{GOOD}```", GOOD, "", "   ", "no code here", "```\njust prose\n```", f"```\nshell\n```\n```java\n{GOOD}```", f"{GOOD}```x", None]
    want = [GOOD.strip()] * 3 + [None] * 4 + [GOOD.strip(), None, None]
    assert column(spark, values, t.java_code) == want
    assert column(spark, ["interface A {} public final class B {}", "enum E$1 {}", "x"], t.main_type) == ["B", "E$1", "Snippet"]


def test_json_pair(spark):
    values = ['{"vulnerable_code": "a", "fixed_code": "b"}', 'x ```json\n{"fixed_code": "b", "vulnerable_code": "a"}\n``` y', '{"vulnerable_code": 1, "fixed_code": "b"}', '{"vulnerable_code": "a"}', "nope", "} {", "[1]", '{"vulnerable_code": "", "fixed_code": "b"}', None]
    got = [tuple(x) if x else None for x in column(spark, values, t.json_pair)]
    assert got == [("a", "b"), ("a", "b")] + [None] * 7


def test_cells(spark):
    rows = spark.createDataFrame([(1, 8), (3, 8), (96, 100), (0, 0), (None, None)], "p long, e long")
    got = [tuple(r) for r in rows.select(t.rate_cell(F.col("p"), F.col("e")), t.floor_percent(F.col("p"), F.col("e"))).collect()]
    assert got == [("12% (1/8)", "12%"), ("38% (3/8)", "37%"), ("96% (96/100)", "96%"), ("n/a (tool missing)", None), ("n/a (tool missing)", None)]


def test_settings():
    assert c.PrepConfig.from_env({}) == c.PrepConfig()
    p = c.PrepConfig.from_env({"PREP_MAX_CHARS": "9", "PREP_SEMGREP_FILTER": "1", "PREP_NEGATIVES_FRAC": "0.2"})
    assert (p.max_chars, p.semgrep_filter, p.negatives_frac) == (9, True, 0.2)
    assert c.HarnessConfig.from_env({"HARNESS_W_COMPILE": "0.5"}).weight_compile == 0.5
    assert c.ChatConfig.from_env({"FT_TRAIN_FILE": "x.jsonl", "FT_SMOKE_EXAMPLES": "5"}) == c.ChatConfig(train_file="x.jsonl", smoke_examples=5)
    assert c.split_list(" a ,, b ") == ("a", "b")


def _method(source, name):
    """The method by a walk over the characters."""
    head = re.search(rf"(?:public|private|protected)\s+(?:static\s+)?void\s+{name}\s*\([^)]*\)(?:\s*throws\s+[\w.,\s]+)?\s*\{{", source or "")
    depth = 1
    for i in range(head.end() if head else 0, len(source or "") if head else 0):
        depth += {"{": 1, "}": -1}.get(source[i], 0)
        if not depth:
            return source[head.start() : i + 1]
    return None


def test_method_text(spark):
    source = "class A {\n  public static void bad ( int a ) throws X, Y {\n if (x) { y(); }\n }\n void good() {} }"
    values = [source, "public void bad() { {", "", None, "void bad() {}", "é public void bad(){}public void bad(){ int x; }", "private\tvoid bad()throws a.B,\nC{ { } } }", "public void bad() {" + "{ x }" * 3000 + "}}"]
    assert column(spark, values, lambda s: java.method(s, "bad")) == [_method(v, "bad") for v in values]
    assert _method(values[0], "bad") == "public static void bad ( int a ) throws X, Y {\n if (x) { y(); }\n }"
    assert column(spark, ["public void goodB2G12() { a }"], lambda s: java.method(s, java.GOOD[0][0])) == ["public void goodB2G12() { a }"]


def test_synthesis(spark):
    exec_ = "a\n  Process p = Runtime.getRuntime().exec(cmd + data);\n  Process p = Runtime.getRuntime().exec(cmd + data);\n"
    rows = spark.createDataFrame([("CWE-78", exec_), ("CWE-22", "\tFile f = new File(root + data);  \nx"), ("CWE-22", "File f = new File(data);"), ("CWE-22", "File f = new File(other);"), ("CWE-89", exec_)], "k string, v string")
    got = [r[0] for r in rows.select(java.synthesized(F.col("k"), F.col("v"))).collect()]
    assert got[0].count("Process p = new ProcessBuilder(commandTokens)") == 1 and got[0].count("Runtime.getRuntime") == 1 and "  if (data == null || !data.matches(" in got[0] and "StringTokenizer(cmd)" in got[0]
    assert got[1].startswith("\tfinal File allowedDir = new File(root);\n") and got[1].endswith("\tFile f = new File(allowedDir, data);\nx") and ".normalize()" in got[1]
    assert 'new File(System.getProperty("user.dir"))' in got[2] and "new File(data)" not in got[2] and got[3] is None and got[4] is None


@pytest.mark.skipif(shutil.which("javac") is None, reason="no compiler")
def test_repaired_code_compiles_and_guards(spark, tmp_path):
    """The repaired methods run: they refuse what leads astray and pass what doesn't."""
    head = "import java.io.*;\n\npublic class %s {\n  static void bad(String root, String data) throws Exception {\n"
    tail = "    System.out.println(%s);\n  }\n  public static void main(String[] a) throws Exception {\n    try { bad(a[0], a[1]); } catch (SecurityException e) { System.out.println(\"refused\"); }\n  }\n}\n"
    path = head % "P" + "    File f = new File(root + data);\n" + tail % "f.getName()"
    command = head % "C" + "    Process p = Runtime.getRuntime().exec(root + data);\n" + tail % "new String(p.getInputStream().readAllBytes()).trim()"
    rows = spark.createDataFrame([("CWE-22", path), ("CWE-78", command)], "k string, v string")
    for name, (text,) in zip("PC", rows.select(java.synthesized(F.col("k"), F.col("v"))).collect(), strict=True):
        (tmp_path / f"{name}.java").write_text(text)
        subprocess.run(["javac", "-d", str(tmp_path), str(tmp_path / f"{name}.java")], check=True, timeout=120)

    def ran(name, *given):
        return subprocess.run(["java", "-cp", str(tmp_path), name, *given], capture_output=True, text=True, timeout=60).stdout.strip()

    assert ran("P", "/srv/files", "a.txt") == "a.txt" and ran("P", "/srv/files", "sub/../b.txt") == "b.txt"
    assert ran("P", "/srv/files", "../x") == ran("P", "/srv/files", "/etc/passwd") == "refused"
    assert ran("C", "echo one ", "two") == "one two" and ran("C", "echo one ", "two; ls") == "refused"
