import random
import re

import pytest

from curaloom.llm import neardup, words
from curaloom.operators.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)], least[find(i)] == d) for i, (d, _) in enumerate(rows))


def test_word_hashes_follow_the_pattern():
    r = random.Random(2)
    texts = ["".join(r.choice("aAb É\t\n\x0b.") for _ in range(r.randrange(40))) for _ in range(300)] + ["", " ", "x" * 3_000_000 + " y"]
    h, bounds = words.word_hashes([t.encode() for t in texts])
    seen = {}
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
        assert len(found) == b - a
        for w, x in zip(found, h[a:b], strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_clusters_chains_copies_and_edges(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0
    for size in (1, 2, 3, 5, 9, 40):
        base = [word() for _ in range(120)]
        for k in range(size):
            text = list(base)
            for _ in range(k % 3):
                text[r.randrange(120)] = word()
            rows.append((n, " ".join(text)))
            n += 1
        for step in range(4):  # a chain that drifts away from the base
            base = base[6:] + [word() for _ in range(6)]
            rows.append((n, " ".join(base).upper() if step % 2 else " ".join(base)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "two words"), (n + 4, "Two\twords"), (n + 5, "a b c d e"), (n + 6, "a b c d e")]
    r.shuffle(rows)
    frame = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], "doc_id long, text string, component_id string, kept int")
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_duplicates(frame).collect())
    assert got == brute(rows)


def test_links_in_crowded_buckets_of_a_template(spark):
    word = random.Random(4).getrandbits
    template = [f"t{word(40)}" for _ in range(86)]
    # any two share 82 of 110 shingles (0.745); partners, far apart in order, 83 of 109 (0.761)
    rows = [[*template, *(f"u{word(40)}" for _ in range(14))] for _ in range(600)]
    for k in range(0, 300, 20):
        rows[k + 300][86] = rows[k][86]
    assert len(shingles(" ".join(rows[0])) & shingles(" ".join(rows[1]))) == 82 and len(shingles(" ".join(rows[0])) & shingles(" ".join(rows[300]))) == 83
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(rows)], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(frame).collect()}
    assert got == {d: d - 300 if d >= 300 and d % 20 == 0 else d for d in range(600)}


def test_nulls_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, "a b c d e f", None), (None, "a b c d e f", "s"), (3, None, "s")], "doc_id long, text string, source string")
    got = sorted((x.doc_id or 0, x.n_shingles, x.component_id or 0, x.kept) for x in neardup.near_duplicates(frame).collect())
    assert got == [(0, 2, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert sorted(x.doc_id or 0 for x in neardup.deduplicated(frame).collect()) == [0, 1, 3]
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


def test_rows_that_share_an_id_but_not_a_text(spark):
    word = random.Random(6).getrandbits
    a, b, c = ([f"w{word(40)}" for _ in range(80)] for _ in range(3))
    near = lambda w: " ".join([f"w{word(40)}", *w[1:]])
    rows = [(3, " ".join(a)), (5, near(a)), (5, near(b)), (9, " ".join(b)), (9, " ".join(b)), (7, " ".join(c)), (7, near(c)), (8, near(c)), (5, ""), (5, "")]
    frame = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, sig string")
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_duplicates(frame).collect())
    want = brute(rows)
    assert got == want and (9, 76, 5, False) in want
    kept = sorted((x.doc_id, x.text, x.sig) for x in neardup.deduplicated(frame).collect())
    texts = [(3, rows[0][1]), (5, ""), (5, rows[2][1])]
    assert [k for k in kept if k[0] != 7] == [(d, t, "k") for d, t in sorted(texts)] and [k[1] in (rows[5][1], rows[6][1]) for k in kept if k[0] == 7] == [True]
    assert len(kept) == 4


def test_a_family_larger_than_a_group_and_a_hot_id(spark):
    """One family of near copies in every bucket, one text that half the rows repeat, some of them under one id."""
    r = random.Random(3)
    base = [f"w{r.getrandbits(40)}" for _ in range(90)]
    rows = []
    for d in range(500):
        w = list(base)
        for _ in range(r.randrange(1, 3)):
            w[r.randrange(90)] = f"x{r.getrandbits(40)}"
        rows.append((d, " ".join(w)))
    rows += [(600 + d % 200, "the same text in very many rows of the table") for d in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_duplicates(frame).collect())
    assert got == brute(rows)
    assert sorted(x.doc_id for x in neardup.deduplicated(frame).collect()) == sorted({d for d, _, _, k in got if k})


def test_small_buckets_give_all_their_pairs(spark):
    rows = [(1, 2, [5, -9]), (2, 3, [4, 7, -(2**62)]), (3, 4, [1, 2, 3, 4])]
    frame = spark.createDataFrame([(k, i) for k, _, ids in rows for i in ids], "key long, id long").groupBy("key").agg(
        neardup.F.count(neardup.F.lit(1)).alias("size"), neardup.F.min("id").alias("low"), neardup.F.max("id").alias("high"), neardup.F.bit_xor("id").alias("every")
    )
    assert {(x.a, x.b) for x in neardup._small(frame).collect()} == {(-9, 5), (-(2**62), 4), (-(2**62), 7), (4, 7)}


@pytest.mark.parametrize("salts", [1, 3, 40])
def test_pairs_of_a_bucket_connect_it(spark, salts):
    frame = spark.createDataFrame([(k, i * (k + 1)) for k in range(3) for i in range(30 * k + 4)], "key long, id long")
    for turn in (0, 2):
        pairs = {(x.a, x.b) for x in neardup._paired(frame, salts, turn).collect()}
        for k in range(3):
            ids = {i * (k + 1) for i in range(30 * k + 4)}
            seen, todo = set(), [0]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += [b if a == x else a for a, b in pairs if x in (a, b)]
            assert ids <= seen


def test_tables_with_the_same_members_make_their_pairs_once(spark):
    frame = spark.createDataFrame([(k, i) for k in range(40) for i in range(30)], "key long, id long")
    for turn in (0, 2):
        pairs = sorted(map(tuple, neardup._paired(frame.where("key < 1"), 6, turn).collect()))
        assert sorted(map(tuple, neardup._paired(frame, 6, turn).collect())) == pairs


def test_partners_of_a_class_are_bounded_whatever_its_family(spark, monkeypatch):
    """A family larger than a group in all tables: no class gets more than 2 * SIDE rows of partners a turn, and all are linked."""
    r = random.Random(8)
    base = [f"w{r.getrandbits(40)}" for _ in range(100)]
    rows = []
    for d in range(900):
        w = list(base)
        for _ in range(r.randrange(1, 4)):
            w[r.randrange(100)] = f"x{r.getrandbits(40)}"
        rows.append((d, " ".join(w)))
    made, paired = [], neardup._paired
    monkeypatch.setattr(neardup, "_paired", lambda *x: made.append(paired(*x)) or made[-1])
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)
    assert max(x.count() for x in made) <= 2 * neardup.SIDE * 900


def test_a_late_member_meets_some_of_a_component_before_it_meets_all(spark):
    prefix = spark.createDataFrame([(d, 100, 7, 120) for d in range(1000)], "id long, n long, gram long, reach long")
    roots = spark.createDataFrame([(d, 0) for d in range(1, 999)], "node long, root long")
    some = {(x.a, x.b) for x in neardup._across(prefix, roots, 1).collect()}
    assert {(x.a, x.b) for x in neardup._across(prefix, roots).collect()} == {(d, 999) for d in range(999)} > some
    assert 0 < len(some) <= neardup.DRAWN


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(70)] + [(300 + i, 301 + i) for i in range(20)] + [(500, 501 + i) for i in range(50)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root if find(k) != k}
