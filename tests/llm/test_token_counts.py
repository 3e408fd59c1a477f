import random

from curaloom.llm import token_counts as tc


def coder():
    return tc.Counter(open(tc.VOCABULARY_FILE, "rb").read())


def test_long_blank_runs_count_like_the_pattern():
    count, r = coder(), random.Random(3)
    for _ in range(300):  # the same texts with the long-run rule forced for short runs
        t = "".join(r.choice(["a", "be", " ", "  ", "\n", "\t ", "\xa0", "7", "!"]) for _ in range(r.randrange(30)))
        whole = count(t)
        old, tc._BLANK = tc._BLANK, tc.re.compile(tc._BLANK.pattern.replace("1000", "2"))
        try:
            assert count(t) == whole, t
        finally:
            tc._BLANK = old
    assert count("x" + " " * 1_000_000 + "y") > 2
    assert count("") == 0


def test_same_counts_as_the_other_library():
    from tokenizers import Tokenizer

    other, count, r = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json"), coder(), random.Random(4)
    other.encode_special_tokens = True
    for _ in range(200):
        t = "".join(r.choice("ab cde'sll 12\n.éß<|endoftext|>") for _ in range(80))
        assert len(other.encode(t, add_special_tokens=False).ids) == count(t)


def test_histogram_against_brute_force(spark):
    r = random.Random(6)
    n = [r.choice([0, 1, 5, 1023, 1024, 1025, 5000, r.randrange(9000)]) for _ in range(400)]
    hist = tc.histogram(spark.createDataFrame([(i, x) for i, x in enumerate(n)], "doc_id long, tokens long"))
    rows = {x.tokens: x for x in hist.collect()}
    assert set(rows) == set(n)
    for k, x in rows.items():
        assert x.n_docs == n.count(k)
        assert x.docs_from == sum(v >= k for v in n) and x.tokens_from == sum(v for v in n if v >= k)
        assert x.truncated_tokens == sum(min(v, k) for v in n)
        assert x.share_upto == sum(v <= k for v in n) / len(n)
    got = hist.agg(tc.truncated_total(hist, 2000).alias("t"), tc.quantile(hist, 0.5).alias("q")).first()
    assert got.t == sum(min(v, 2000) for v in n) and got.q == sorted(n)[199]


def test_rows_with_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "hello world", 1), (2, None, 2), (None, "", 3)], "doc_id long, text string, tokens long")
    assert sorted((r.doc_id or 0, r.tokens) for r in tc.lengths(docs).collect()) == [(0, 0), (1, 2), (2, 0)]
    assert tc.histogram(tc.lengths(docs.limit(0))).count() == 0
