"""The stages of the pipeline against brute force on a small corpus."""

import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from curaloom.llm import mixing, pii, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in cp.STAGES:
        docs = cp.runtime.written(stage(spark, docs, SF), name)
        out.append(docs.collect())
    return out


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_run_gives_the_last_stage_and_cleans_up(spark, stages):
    before = set(cp.storage.given())
    rows = cp.run(spark, SF).collect()
    assert sorted(map(str, rows)) == sorted(map(str, stages[5]))
    assert len(set(cp.storage.given()) - before) == len(cp.STAGES)


def test_columns(stages):
    assert all(r.__fields__ == stages[0][0].__fields__ for s in stages[1:5] for r in s)


def test_quality_keeps_the_model_s_choice(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model([r.text.encode() for r in stages[0]])
    assert sorted(r.doc_id for r in stages[1]) == sorted(r.doc_id for r, s in zip(stages[0], scores, strict=True) if s >= 0.7)


def test_near_dedup(stages):
    sets = {r.doc_id: shingles(r.text) for r in stages[1]}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in stages[2]) == [k for k in ids if find(k) == k]


def test_decontamination(spark, stages):
    items = [re.findall(r"\S+", r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    bags = [(len(w), grams(w)) for w in items if len(w) >= 5]
    clean = []
    for r in stages[2]:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
        seen = set(grams(w))
        hit = False
        for n, bag in bags:
            if seen & set(bag):
                for s in range(max(1, len(w) - n + 1)):
                    win = grams(w[s : s + n])
                    both = sum((win & bag).values())
                    hit |= 4 * both >= 3 * (sum(win.values()) + sum(bag.values()) - both)
        if not hit:
            clean.append(r.doc_id)
    assert sorted(r.doc_id for r in stages[3]) == sorted(clean)


def test_redaction(stages):
    after = {r.doc_id: r for r in stages[4]}
    assert len(after) == len(stages[3])
    for r in stages[3]:
        assert after[r.doc_id].text == pii.redact(r.text) and after[r.doc_id].n_chars == len(pii.redact(r.text))
        assert not pii.base_spans(after[r.doc_id].text)


def test_mixing(spark, stages):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    frame = spark.createDataFrame(stages[4])
    plan = {r.doc_id: r for r in mixing.mix(frame).collect()}
    got = Counter()
    for r in stages[5]:
        got[r.doc_id] += r.taken
        assert size(r.text) == r.taken and r.n_chars == len(r.text)
    assert {k: v for k, v in got.items()} == {k: r.taken for k, r in plan.items() if r.taken}
    by_source = Counter()
    for r in stages[5]:
        by_source[r.source] += r.taken
    want = {r.source: plan[r.doc_id].target for r in stages[4]}
    assert by_source == {k: int(v) for k, v in want.items()}


def test_stages_keep_columns_of_any_name(spark, stages):
    """Names that the operators use themselves, and ones with dots, come out of every stage as they went in."""
    names = ["utf8", "_utf8", "quality", "_quality", "sig", "_sig", "root", "k", "row", "h", "hits", "fp", "id", "node", "component", "kept", "n", "mine", "mine_part", "part", "cut", "_cut", "size", "_size", "last", "rest", "take", "turn", "epochs", "ordinal", "stay_id", "a.b", "y"]
    docs = spark.createDataFrame(stages[0]).drop("n_chars")
    docs = docs.unionByName(docs.where("doc_id < 5")).unionByName(docs.where("doc_id = 7").selectExpr("doc_id", "concat(text, ' and more') as text", "lang", "source"))
    for x in names:
        docs = docs.withColumn(x, cp.quality.F.lit(x))
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        rows = out.collect()
        assert rows and all([r[x] for x in names] == names for r in rows), name
