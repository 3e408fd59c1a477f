"""Registered queries of the core engine over the driver's tables, with their SQL oracles.

Documents stand for pairs (text on both sides, doc_id for the order, lang for the category), labels for
tool verdicts (unlabelled: tool missing), the benchmark for the replay pool.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.functions import java
from curaloom.functions import text as t
from curaloom.operators import approximate, clean, demo, generate, score, similar, splitting, verify
from curaloom.sources import pairs as pair_sources
from curaloom.sources import records
from curaloom.storage import fresh_path, written

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LANG = {"en": "cwe-89", "fr": "CWE 78", "de": "23", "es": "79"}


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents")
    cwe = F.element_at(F.create_map(*(F.lit(x) for kv in _LANG.items() for x in kv)), F.col("lang"))
    text = F.coalesce("text", F.lit(""))
    return d.select(text.alias("vulnerable_code"), text.alias("fixed_code"), cwe.alias("cwe"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("source_id"), F.lit("fix").alias("kind"), F.col("doc_id").alias("ord"))


# --- SQL building blocks -------------------------------------------------------------------------

_S = c.SPACE_CLASS
_COLLAPSED = f"trim(regexp_replace(coalesce(text, ''), '{_S}+', ' ', 'g'))"
_RSTRIP = f"regexp_replace(coalesce(text, ''), '{_S}+$', '')"
_SCOPE = "CASE lang WHEN 'en' THEN 'CWE-89' WHEN 'fr' THEN 'CWE-78' WHEN 'de' THEN 'CWE-22' END"
_DESCRIBED = "CASE cwe " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in c.CWE_DESCRIPTIONS.items()) + " END"
_PROMPT = " || ".join([_q(c.PROMPT_PARTS[0]).replace("\n", "' || chr(10) || '"), "cwe", _q(c.PROMPT_PARTS[1]), _DESCRIBED, _q(c.PROMPT_PARTS[2]).replace("\n", "' || chr(10) || '"), _RSTRIP, _q(c.PROMPT_PARTS[3]).replace("\n", "' || chr(10) || '")])
_DOCS = f"d AS (SELECT doc_id, text, lang, {_SCOPE} AS cwe FROM documents)"
_PROMPTED = f"{_DOCS}, u AS (SELECT *, {_PROMPT} AS prompt, sha256(concat({_COLLAPSED}, chr(0), {_COLLAPSED})) AS fp FROM d)"
_JUDGED = f"""{_PROMPTED},
l AS (SELECT *, {len(c.SYSTEM_PROMPT)} + length(prompt) + length(coalesce(text, '')) > 6000 AS too_long,
  CASE WHEN cwe IS NULL THEN 'cwe_out_of_scope' WHEN {_COLLAPSED} = '' THEN 'empty' END AS early FROM u),
j AS (SELECT *, coalesce(early, CASE WHEN min(CASE WHEN early IS NULL AND NOT too_long THEN doc_id END) OVER (PARTITION BY fp, early IS NULL) < doc_id THEN 'duplicate' WHEN too_long THEN 'too_long' END) AS drop_reason FROM l)"""
_SHINGLED = r"""k AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
g AS (SELECT id, len(w) AS n_tokens, list_sort(list_distinct(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s FROM k)"""
_SIMILAR = f"""{_SHINGLED},
cl AS (SELECT s, min(id) AS rep, len(s) AS n FROM g GROUP BY s),
x AS (SELECT rep, n, unnest(s) AS gram FROM cl),
pr AS (SELECT a.rep AS a, b.rep AS b, count(*)::DOUBLE / (a.n + b.n - count(*))::DOUBLE AS similarity FROM x a JOIN x b ON a.gram = b.gram AND a.rep < b.rep AND least(a.n, b.n) >= 0.84 * greatest(a.n, b.n) GROUP BY a.rep, b.rep, a.n, b.n),
sim AS (SELECT * FROM pr WHERE similarity >= 0.85)"""
_CLUSTERED = f"""{_SIMILAR},
ed AS (SELECT a, b FROM sim UNION ALL SELECT b, a FROM sim),
rc AS (SELECT rep AS node, rep AS root FROM cl UNION SELECT ed.b, rc.root FROM rc JOIN ed ON ed.a = rc.node WHERE rc.root < ed.b),
rt AS (SELECT node, min(root) AS root FROM rc GROUP BY node),
cm AS (SELECT g.id, rt.root AS cluster_id FROM g JOIN cl ON cl.s = g.s JOIN rt ON rt.node = cl.rep)"""
_PLACED = f"""{_CLUSTERED},
gs AS (SELECT cluster_id, count(*) AS size, md5(concat('42:', cluster_id)) AS key FROM cm GROUP BY cluster_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY size ORDER BY key, cluster_id) AS rank, row_number() OVER (ORDER BY size, key, cluster_id) AS low, sum(size) OVER () AS total, count(*) OVER () AS n FROM gs),
gr AS (SELECT size, row_number() OVER (ORDER BY size DESC, rank) AS step, total FROM rk WHERE n < 3 OR low > 2),
pre AS (SELECT coalesce(sum(size) FILTER (low = 1 AND n >= 3), 0) AS t1, coalesce(sum(size) FILTER (low = 2 AND n >= 3), 0) AS v1, max(total) AS total FROM rk),
wk AS (SELECT 0::BIGINT AS step, NULL::VARCHAR AS split, 0::BIGINT AS size, (8 * total)::BIGINT AS a, (total - 10 * v1)::BIGINT AS b, (total - 10 * t1)::BIGINT AS c FROM pre
  UNION ALL SELECT gr.step, CASE WHEN a >= b AND a >= c THEN 'train' WHEN b >= c THEN 'val' ELSE 'test' END, gr.size,
    CASE WHEN a >= b AND a >= c THEN a - 10 * gr.size ELSE a END, CASE WHEN NOT (a >= b AND a >= c) AND b >= c THEN b - 10 * gr.size ELSE b END, CASE WHEN NOT (a >= b AND a >= c) AND NOT b >= c THEN c - 10 * gr.size ELSE c END
  FROM wk JOIN gr ON gr.step = wk.step + 1),
ct AS (SELECT size, count(*) FILTER (split = 'train') AS nt, count(*) FILTER (split = 'val') AS nv FROM wk WHERE split IS NOT NULL GROUP BY size),
rr AS (SELECT cluster_id, size, low, n, rank - count(*) FILTER (low <= 2 AND n >= 3) OVER (PARTITION BY size) AS place FROM rk),
sp AS (SELECT cluster_id, CASE WHEN n >= 3 AND low = 1 THEN 'test' WHEN n >= 3 AND low = 2 THEN 'val' WHEN place <= nt THEN 'train' WHEN place <= nt + nv THEN 'val' ELSE 'test' END AS split FROM rr LEFT JOIN ct USING (size))"""


# --- text kernel ---------------------------------------------------------------------------------


@_query(f"SELECT doc_id, sha256(concat({_COLLAPSED}, chr(0), {_COLLAPSED})) AS fingerprint FROM documents")
def text_fingerprint(spark, sf):
    p = _pairs(spark, sf)
    return p.select(F.col("ord").alias("doc_id"), t.fingerprint(F.col("vulnerable_code"), F.col("fixed_code")).alias("fingerprint"))


_RAW_LABEL = "concat('see CWE ', doc_id % 100, ' or ', doc_id * 7 % 100)"
_FOLD = lambda x: f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in c.CWE_FOLD.items()) + " END"


@_query(f"SELECT doc_id, {_FOLD(f"regexp_extract({_RAW_LABEL}, '([0-9]+)', 1)")} AS label, coalesce({_FOLD('(doc_id % 100)::VARCHAR')}, {_FOLD('(doc_id * 7 % 100)::VARCHAR')}) AS mentioned FROM documents")
def cwe_labels(spark, sf):
    d = _table(spark, sf, "documents")
    raw = F.concat(F.lit("see CWE "), (F.col("doc_id") % 100).cast("string"), F.lit(" or "), (F.col("doc_id") * 7 % 100).cast("string"))
    return d.select("doc_id", t.cwe_label(raw).alias("label"), t.cwe_mentioned(raw).alias("mentioned"))


@_query(f"WITH {_PROMPTED} SELECT doc_id, sha256(prompt) AS prompt_sha, length(prompt) AS prompt_chars FROM u")
def user_prompts(spark, sf):
    p = _pairs(spark, sf)
    prompt = t.user_prompt(F.col("vulnerable_code"), t.cwe_label(F.col("cwe")))
    return p.select(F.col("ord").alias("doc_id"), F.sha2(prompt, 256).alias("prompt_sha"), F.length(prompt).cast("long").alias("prompt_chars"))


@_query(f"WITH {_SHINGLED} SELECT id AS doc_id, n_tokens, len(s) AS n_shingles, sha256(array_to_string(s, chr(10))) AS shingles_sha FROM g")
def shingle_stats(spark, sf):
    d = _table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    s = F.col("s")
    rows = d.select("doc_id", F.size(t.tokens(F.col("text"))).cast("long").alias("n_tokens"), F.sort_array(t.shingles(F.col("text"))).alias("s"))
    return rows.select("doc_id", "n_tokens", F.size(s).cast("long").alias("n_shingles"), F.sha2(F.array_join(s, "\n"), 256).alias("shingles_sha"))


# --- cleaning ------------------------------------------------------------------------------------


@_query(f"WITH {_JUDGED}, r AS (SELECT unnest([{', '.join(_q(x) for x in c.DROP_REASONS)}]) AS drop_reason) SELECT r.drop_reason, count(j.doc_id) AS n FROM r LEFT JOIN j ON j.drop_reason = r.drop_reason GROUP BY r.drop_reason")
def clean_funnel(spark, sf):
    return clean.drop_counts(clean.judged(_pairs(spark, sf)))


@_query(f"WITH {_JUDGED} SELECT 'doc:' || doc_id AS source_id, cwe, sha256(text) AS code_sha FROM j WHERE drop_reason IS NULL")
def clean_kept(spark, sf):
    return clean.kept(clean.judged(_pairs(spark, sf))).select("source_id", "cwe", F.sha2("vulnerable_code", 256).alias("code_sha"))


_VERDICTS = "v AS (SELECT d.doc_id, quality = 1 AS q, toxic = 0 AS nt FROM documents d LEFT JOIN labels USING (doc_id))"


def _verdicts(spark, sf):
    return _table(spark, sf, "documents").join(_table(spark, sf, "labels"), "doc_id", "left").select("doc_id", (F.col("quality") == 1).alias("q"), (F.col("toxic") == 0).alias("nt"))


@_query(f"WITH {_VERDICTS} SELECT doc_id, CASE WHEN q = false THEN 'fixed_fails_javac' WHEN NOT nt THEN 'vuln_not_flagged' WHEN nt = false THEN 'fixed_still_flagged' END AS drop_reason, q IS DISTINCT FROM false AND nt IS NULL OR coalesce(q AND nt AND doc_id % 2 = 0, false) AS admitted FROM v")
def tool_verdicts(spark, sf):
    v = _verdicts(spark, sf)
    vuln_clean = F.when(F.col("nt").isNotNull(), ~F.col("nt"))
    ok, _ = verify.admitted(F.lit("a"), F.lit("b"), F.col("q"), vuln_clean, F.when(F.col("nt").isNotNull(), F.col("doc_id") % 2 == 0))
    return v.select("doc_id", verify.tool_reason(F.col("q"), vuln_clean, F.col("nt")).alias("drop_reason"), ok.alias("admitted"))


# --- near-duplicates, splits, mixing -------------------------------------------------------------


def _texts(spark, sf):
    return _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")


@_query(f"WITH {_SIMILAR} SELECT a, b, similarity FROM sim")
def near_dup_pairs(spark, sf):
    return similar.similar_classes(similar.shingled(_texts(spark, sf))[0], 0.85)


@_query(f"WITH RECURSIVE {_CLUSTERED} SELECT id, cluster_id FROM cm")
def near_dup_clusters(spark, sf):
    return similar.clusters(_texts(spark, sf))


@_query(f"WITH RECURSIVE {_PLACED} SELECT cm.id, cm.cluster_id, sp.split FROM cm JOIN sp USING (cluster_id)")
def cluster_split(spark, sf):
    return splitting.split(similar.clusters(_texts(spark, sf)))


_HASHED = "h AS (SELECT 'doc:' || doc_id AS source_id, doc_id AS ord, CASE WHEN doc_id % 10 = 8 THEN 'val' WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split, cwe FROM d)"
_NEGATED = f"{_DOCS}, {_HASHED}, ng AS (SELECT source_id, split, cwe FROM (SELECT *, count(*) OVER (PARTITION BY split) AS n, row_number() OVER (PARTITION BY split ORDER BY md5('43:' || source_id), source_id) AS k FROM h) WHERE k <= least(n, greatest(1, round_even(n * 0.1, 0))))"


def _split_pairs(spark, sf):
    d = F.col("ord") % 10
    return _pairs(spark, sf).withColumn("cwe", t.cwe_label(F.col("cwe"))).withColumn("split", F.when(d == 8, "val").when(d == 9, "test").otherwise("train"))


@_query(f"WITH {_NEGATED} SELECT source_id || '#neg' AS source_id, split FROM ng")
def negatives_drawn(spark, sf):
    return splitting.negatives(_split_pairs(spark, sf)).where("kind = 'no_change'").select("source_id", "split")


_REPLAYED = f"{_NEGATED}, cap AS (SELECT floor((SELECT count(*) FROM h WHERE split = 'train') * 0.15 + (SELECT count(*) FROM ng WHERE split = 'train') * 0.15) AS cap), rp AS (SELECT 'bench:' || item_id AS source_id FROM (SELECT item_id, row_number() OVER (ORDER BY md5('43:bench:' || item_id), 'bench:' || item_id) AS k FROM benchmark), cap WHERE k <= cap)"


def _replayed(spark, sf):
    pool = _table(spark, sf, "benchmark").select(F.lit("s").alias("system"), F.col("text").alias("input"), F.col("text").alias("output"), F.lit("general").alias("cwe"), F.lit("").alias("vulnerable_code"), F.concat(F.lit("bench:"), F.col("item_id").cast("string")).alias("source_id"), F.lit("replay").alias("kind"))
    return splitting.with_replay(splitting.triplets(splitting.negatives(_split_pairs(spark, sf))), pool)


@_query(f"WITH {_REPLAYED} SELECT source_id, 'train' AS split FROM rp")
def replay_mix(spark, sf):
    return _replayed(spark, sf).where("kind = 'replay'").select("source_id", "split")


@_query(f"WITH {_NEGATED}, cap AS (SELECT floor((SELECT count(*) FROM h WHERE split = 'train') * 0.15 + (SELECT count(*) FROM ng WHERE split = 'train') * 0.15) AS cap), pool AS (SELECT 'pool:' || doc_id % 7 AS source_id FROM documents), rp AS (SELECT source_id, row_number() OVER (ORDER BY md5('43:' || source_id), source_id) AS k FROM pool), kept AS (SELECT source_id FROM rp, cap WHERE k <= cap) SELECT source_id, count(*) AS n FROM kept GROUP BY source_id")
def replay_mix_repeated_ids(spark, sf):
    """A pool as large as the documents whose rows share seven ids: the cap holds, whatever the ids."""
    d, text = _table(spark, sf, "documents"), F.coalesce("text", F.lit(""))
    pool = d.select(F.lit("s").alias("system"), text.alias("input"), text.alias("output"), F.lit("general").alias("cwe"), F.lit("").alias("vulnerable_code"), F.concat(F.lit("pool:"), (F.col("doc_id") % 7).cast("string")).alias("source_id"), F.lit("replay").alias("kind"))
    mixed = splitting.with_replay(splitting.triplets(splitting.negatives(_split_pairs(spark, sf))), pool)
    return mixed.where("kind = 'replay'").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


@_query(f"""WITH {_REPLAYED}, r AS (SELECT split, cwe, 'fix' AS kind FROM h UNION ALL SELECT split, cwe, 'no_change' FROM ng UNION ALL SELECT 'train', 'general', 'replay' FROM rp)
SELECT split, count(*) AS total, count(*) FILTER (kind = 'no_change') AS no_change, count(*) FILTER (kind = 'replay') AS replay, count(*) FILTER (cwe = 'CWE-89') AS "CWE-89", count(*) FILTER (cwe = 'CWE-22') AS "CWE-22", count(*) FILTER (cwe = 'CWE-78') AS "CWE-78", count(*) FILTER (cwe = 'general') AS general FROM r GROUP BY split""")
def split_report(spark, sf):
    return splitting.split_stats(_replayed(spark, sf)).select("split", "total", "no_change", "replay", "CWE-89", "CWE-22", "CWE-78", "general")


@_query("SELECT 0 AS n_leaks")
def split_leaks(spark, sf):
    return splitting.leaks(splitting.negatives(_split_pairs(spark, sf))).agg(F.count(F.lit(1)).alias("n_leaks"))


@_query(f"WITH {_NEGATED}, moved AS (SELECT source_id, CASE WHEN split = 'test' THEN 'train' ELSE split END AS split FROM ng) SELECT moved.source_id || '#neg' AS source_id, moved.split FROM moved ANTI JOIN h ON h.source_id = moved.source_id AND h.split = moved.split")
def split_leaks_planted(spark, sf):
    """Leaks where all negatives of the test split went to train."""
    rows = splitting.negatives(_split_pairs(spark, sf))
    moved = F.when((F.col("kind") == "no_change") & (F.col("split") == "test"), "train").otherwise(F.col("split"))
    return splitting.leaks(rows.withColumn("split", moved)).select("source_id", "split")


# --- scoring -------------------------------------------------------------------------------------

_RESPONSE = "CASE doc_id % 4 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN 'Sure:' || chr(10) || '```java' || chr(10) || 'public final class A' || doc_id || ' { ' || text || ' }' || chr(10) || '```' || chr(10) || text WHEN 2 THEN 'class B' || doc_id || ' { }  ' ELSE '```' || chr(10) || text || chr(10) || '```' END"
_DECLARES = r"\b(?:class|interface|enum|record)" + _S + r"+[A-Za-z_$](?:[\p{L}\p{N}_]|\$)*"
_BLOCK = "list_filter(regexp_extract_all(response, '(?s)```(?:[Jj]ava)?[ \\t]*\\n(.*?)```', 1), lambda x: regexp_matches(x, '" + _DECLARES + "'))[1]"
_CODE = f"trim(coalesce({_BLOCK}, CASE WHEN regexp_matches(response, '{_DECLARES}') AND NOT contains(response, '```') THEN response END), ' ' || chr(10))"
_ANSWERS = f"rs AS (SELECT doc_id, lang, {_RESPONSE} AS response FROM documents), co AS (SELECT doc_id, lang, {_CODE} AS code FROM rs)"


def _responses(spark, sf):
    d = _table(spark, sf, "documents")
    x, n = F.coalesce("text", F.lit("")), F.col("doc_id").cast("string")
    k = F.col("doc_id") % 4
    response = (
        F.when(k == 0, x)
        .when(k == 1, F.concat(F.lit("Sure:\n```java\npublic final class A"), n, F.lit(" { "), x, F.lit(" }\n```\n"), x))
        .when(k == 2, F.concat(F.lit("class B"), n, F.lit(" { }  ")))
        .otherwise(F.concat(F.lit("```\n"), x, F.lit("\n```")))
    )
    return d.select("doc_id", "lang", response.alias("response"))


@_query(f"WITH {_ANSWERS} SELECT doc_id, sha256(code) AS code_sha, coalesce(nullif(regexp_extract(code, '\\b(?:class|interface|enum|record) +([A-Za-z_$][A-Za-z0-9_$]*)', 1), ''), 'Snippet') AS main_type FROM co")
def java_extraction(spark, sf):
    code = t.java_code(F.col("response"))
    return _responses(spark, sf).select("doc_id", F.sha2(code, 256).alias("code_sha"), t.main_type(F.coalesce(code, F.lit(""))).alias("main_type"))


_SCORED = f"""{_VERDICTS}, {_ANSWERS}, o AS (SELECT doc_id, lang AS cwe, code IS NOT NULL AS format_ok, v.q, v.nt FROM co JOIN v USING (doc_id)),
e AS (SELECT doc_id, cwe, format_ok, CASE WHEN format_ok THEN q ELSE false END AS compiles, CASE WHEN format_ok THEN nt ELSE false END AS vuln_fixed FROM o),
s AS (SELECT *, round_even(((CASE WHEN format_ok THEN 0.2 ELSE 0 END) + (CASE WHEN compiles THEN 0.4 ELSE 0 END) + (CASE WHEN vuln_fixed THEN 0.4 ELSE 0 END))::DOUBLE / (0.2 + (CASE WHEN compiles IS NULL THEN 0 ELSE 0.4 END) + (CASE WHEN vuln_fixed IS NULL THEN 0 ELSE 0.4 END))::DOUBLE, 4)::DOUBLE AS score FROM e)"""
_RATES = ", ".join(f"CASE WHEN count({k}) > 0 THEN count(*) FILTER ({k}) END AS {n}_passed, CASE WHEN count({k}) > 0 THEN count({k}) END AS {n}_evaluated" for n, k in score.CHECKS.items())


def _scored(spark, sf):
    v = _verdicts(spark, sf).select("doc_id", F.col("q").alias("compiles"), F.col("nt").alias("vuln_fixed"))
    return score.scored(_responses(spark, sf).withColumnRenamed("lang", "cwe").join(v, "doc_id"))


@_query(f"WITH {_SCORED} SELECT doc_id, cwe, format_ok, compiles, vuln_fixed, score FROM s")
def score_rows(spark, sf):
    return _scored(spark, sf).select("doc_id", "cwe", "format_ok", "compiles", "vuln_fixed", "score")


@_query(f"WITH {_SCORED} SELECT cwe, count(*) AS n, {_RATES}, round(avg(score), 6) AS mean_score FROM s GROUP BY cwe")
def rates_by_category(spark, sf):
    return score.rates(_scored(spark, sf), "cwe").withColumn("mean_score", F.round("mean_score", 6))


@_query(f"WITH {_SCORED} SELECT count(*) AS n, {_RATES}, round(avg(score), 6) AS mean_score FROM s")
def rates_overall(spark, sf):
    return score.rates(_scored(spark, sf)).withColumn("mean_score", F.round("mean_score", 6))


def _sides(spark, sf):
    v = _verdicts(spark, sf).join(_table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    common = (F.col("lang").alias("cwe"), F.concat(F.lit("s"), (F.col("doc_id") % 500).cast("string")).alias("source_id"), F.col("doc_id").alias("ord"))
    return v.where("lang <> 'fr'").select(*common, F.col("nt").alias("vuln_fixed")), v.where("lang <> 'es'").select(*common, F.col("q").alias("vuln_fixed"))


_SIDES = f"{_VERDICTS}, a AS (SELECT lang AS cwe, 's' || doc_id % 500 AS source_id, doc_id AS ord, q, nt FROM documents JOIN v USING (doc_id)), ba AS (SELECT cwe, source_id, ord, nt AS vuln_fixed FROM a WHERE cwe <> 'fr'), tu AS (SELECT cwe, source_id, ord, q AS vuln_fixed FROM a WHERE cwe <> 'es')"
_CELL = lambda p, e: f"CASE WHEN coalesce({e}, 0) > 0 THEN printf('%.0f', 100.0 * {p} / {e}) || '% (' || {p} || '/' || {e} || ')' ELSE 'n/a (tool missing)' END"


@_query(f"WITH {_SIDES}, b AS (SELECT cwe, count(*) FILTER (vuln_fixed) AS p, count(vuln_fixed) AS e FROM ba GROUP BY cwe), u AS (SELECT cwe, count(*) FILTER (vuln_fixed) AS p, count(vuln_fixed) AS e FROM tu GROUP BY cwe) SELECT coalesce(b.cwe, u.cwe) AS cwe, {_CELL('b.p', 'b.e')} AS base, {_CELL('u.p', 'u.e')} AS tuned FROM b FULL JOIN u ON b.cwe = u.cwe")
def before_after(spark, sf):
    return score.before_after(*_sides(spark, sf))


@_query(f"WITH {_SIDES}, l AS (SELECT source_id, arg_max(vuln_fixed, ord) FILTER (vuln_fixed IS NOT NULL OR true) AS v FROM (SELECT * FROM ba QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY ord DESC) = 1) GROUP BY source_id) SELECT tu.source_id, tu.ord FROM tu LEFT JOIN l USING (source_id) WHERE tu.vuln_fixed AND NOT coalesce(l.v, false)")
def wins(spark, sf):
    base, tuned = _sides(spark, sf)
    return score.wins(base, tuned).select("source_id", "ord")


@_query(f"SELECT doc_id, {_CELL('(doc_id % 17)', '(doc_id % 17 + doc_id % 9)')} AS cell, CASE WHEN doc_id % 17 + doc_id % 9 > 0 THEN (100 * (doc_id % 17) // (doc_id % 17 + doc_id % 9)) || '%' END AS floor_cell FROM documents")
def rate_cells(spark, sf):
    p, e = F.col("doc_id") % 17, F.col("doc_id") % 17 + F.col("doc_id") % 9
    return _table(spark, sf, "documents").select("doc_id", t.rate_cell(p, e).alias("cell"), t.floor_percent(p, e).alias("floor_cell"))


@_query("SELECT 5::BIGINT AS samples, 140.0::DOUBLE AS vram_used_gb_max, 121.4::DOUBLE AS vram_used_gb_mean, 80.0::DOUBLE AS gpu_busy_pct_mean")
def gpu_summary(spark, sf):
    rows = [(0.0, 100.0, 70.0), (1.0, 140.0, 90.0), (2.0, 120.0, 80.0), (3.0, 127.0, 75.0), (4.0, 120.0, 85.0)]
    return score.gpu_summary(spark.createDataFrame(rows, "t double, vram_used_gb double, gpu_busy_pct double"))


# --- records and responses -----------------------------------------------------------------------


@_query(f"WITH {_PROMPTED} SELECT 'doc:' || doc_id AS source_id, 'system,user,assistant' AS roles, sha256({_q(c.SYSTEM_PROMPT)} || prompt || '```java' || chr(10) || {_RSTRIP} || chr(10) || '```') AS content_sha FROM u WHERE cwe IS NOT NULL")
def chat_examples(spark, sf):
    rows = splitting.triplets(_pairs(spark, sf).withColumn("cwe", t.cwe_label(F.col("cwe"))).where("cwe is not null"))
    rows = rows.select("source_id", *t.chat_example(F.col("system"), F.col("input"), F.col("output")))
    turns = F.concat("prompt", "completion")
    return rows.select("source_id", F.array_join(F.transform(turns, lambda x: x["role"]), ",").alias("roles"), F.sha2(F.array_join(F.transform(turns, lambda x: x["content"]), ""), 256).alias("content_sha"))


@_query(f"WITH {_PROMPTED} SELECT 'doc:' || doc_id AS source_id, sha256('```java' || chr(10) || {_RSTRIP} || chr(10) || '```') AS gold_sha, sha256('```java' || chr(10) || {_RSTRIP} || chr(10) || chr(10) || '```') AS echo_sha FROM u WHERE cwe IS NOT NULL")
def mock_responses(spark, sf):
    rows = splitting.triplets(_pairs(spark, sf).withColumn("cwe", t.cwe_label(F.col("cwe"))).where("cwe is not null"))
    gold = generate.Mock("gold").responses(rows).withColumnRenamed("response", "gold")
    both = generate.Mock("echo").responses(gold)
    return both.select("source_id", F.sha2("gold", 256).alias("gold_sha"), F.sha2("response", 256).alias("echo_sha"))


_PAIR_TEXT = """CASE doc_id % 6 WHEN 0 THEN '{"vulnerable_code": "v' || doc_id || '", "fixed_code": "f"}' WHEN 1 THEN 'Here: ```json' || chr(10) || '{"fixed_code": "f' || doc_id || '", "vulnerable_code": "a\\nb"}' || chr(10) || '``` done'
 WHEN 2 THEN '{"vulnerable_code": 1, "fixed_code": "f"}' WHEN 3 THEN '{"vulnerable_code": "", "fixed_code": "f"}' WHEN 4 THEN 'no json } here {' ELSE '{"vulnerable_code": "v", "fixed_code": ' END"""


@_query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'v' || doc_id WHEN 1 THEN 'a' || chr(10) || 'b' END AS vulnerable_code, CASE doc_id % 6 WHEN 0 THEN 'f' WHEN 1 THEN 'f' || doc_id END AS fixed_code FROM documents")
def json_pairs(spark, sf):
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 6
    response = (
        F.when(k == 0, F.concat(F.lit('{"vulnerable_code": "v'), n, F.lit('", "fixed_code": "f"}')))
        .when(k == 1, F.concat(F.lit('Here: ```json\n{"fixed_code": "f'), n, F.lit('", "vulnerable_code": "a\\nb"}\n``` done')))
        .when(k == 2, '{"vulnerable_code": 1, "fixed_code": "f"}')
        .when(k == 3, '{"vulnerable_code": "", "fixed_code": "f"}')
        .when(k == 4, "no json } here {")
        .otherwise('{"vulnerable_code": "v", "fixed_code": ')
    )
    return _table(spark, sf, "documents").select("doc_id", t.json_pair(response).alias("p")).select("doc_id", "p.vulnerable_code", "p.fixed_code")


# --- Java rewriting ------------------------------------------------------------------------------

_JAVA = ("package testcases.a;\nimport testcasesupport.*;\nimport java.io.*;\npublic class C", " extends AbstractTestCase {\n    public void bad() throws Throwable {\n        if (IO.staticReturnsTrueOrFalse()) { IO.writeLine(\"", "\"); }\n        Process p = Runtime.getRuntime().exec(cmd + data);\n        File f = new File(root + data);\n    }\n}\n")


def _java(spark, sf):
    """Java sources that hold the whole text of a document, its lines joined by spaces."""
    text = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), "\n", " "), r"[^\p{L} ]", "")
    return _table(spark, sf, "documents").select("doc_id", F.concat(F.lit(_JAVA[0]), F.col("doc_id").cast("string"), F.lit(_JAVA[1]), text, F.lit(_JAVA[2])).alias("source"))


_WHOLE = r"regexp_replace(translate(coalesce(text, ''), chr(10), ' '), '[^\p{L} ]', '', 'g')"
_SOURCE = " || ".join([_q(_JAVA[0]).replace("\n", "' || chr(10) || '"), "doc_id", _q(_JAVA[1]).replace("\n", "' || chr(10) || '"), _WHOLE, _q(_JAVA[2]).replace("\n", "' || chr(10) || '")])
_STRIPPED = "source"
for _p in (rf"(?m)^{_S}*package{_S}+[A-Za-z0-9_.]+{_S}*;{_S}*$", rf"(?m)^{_S}*import{_S}+testcasesupport\.[A-Za-z0-9_.*]+{_S}*;{_S}*$", rf"\bextends{_S}+AbstractTestCase(?:Base)?\b"):
    _STRIPPED = f"regexp_replace({_STRIPPED}, '{_p}', '', 'g')"
for _a, _b in java.HELPERS:
    _STRIPPED = f"replace({_STRIPPED}, {_q(_a)}, {_q(_b)})"


@_query(f"WITH j AS (SELECT doc_id, {_SOURCE} AS source FROM documents) SELECT doc_id, sha256({_STRIPPED}) AS stripped_sha FROM j")
def java_stripped(spark, sf):
    return _java(spark, sf).select("doc_id", F.sha2(java.stripped(F.col("source")), 256).alias("stripped_sha"))


def _rewrite_sql(kind: str, which: int) -> str:
    sink = java.SINKS[kind][which]
    new = _q(sink.replacement("\\")).replace("\n", "' || chr(10) || '")
    return f"regexp_replace(source, '(?sm)\\A(.*?)^{sink.pattern}$', {new})"


@_query(f"WITH j AS (SELECT doc_id, {_SOURCE} AS source FROM documents) SELECT doc_id, sha256({_rewrite_sql('CWE-78', 0)}) AS process_sha, sha256({_rewrite_sql('CWE-22', 0)}) AS file_sha FROM j")
def sink_synthesis(spark, sf):
    j, s = _java(spark, sf), F.col("source")
    return j.select("doc_id", F.sha2(java.synthesized(F.lit("CWE-78"), s), 256).alias("process_sha"), F.sha2(java.synthesized(F.lit("CWE-22"), s), 256).alias("file_sha"))


@_query(f"WITH j AS (SELECT doc_id, {_SOURCE} AS source FROM documents) SELECT doc_id, sha256(source[instr(source, 'public void'):length(source) - 3]) AS method_sha FROM j")
def method_extraction(spark, sf):
    return _java(spark, sf).select("doc_id", F.sha2(java.method(F.col("source"), "bad"), 256).alias("method_sha"))


# --- augmentation --------------------------------------------------------------------------------

_ATTEMPTED = f"{_DOCS}, tries AS (SELECT cwe, doc_id AS attempt, CASE doc_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'unparseable' WHEN 2 THEN 'rejected' ELSE 'admitted' END AS status FROM d WHERE cwe IS NOT NULL), ad AS (SELECT * FROM (SELECT *, coalesce(sum(CASE WHEN status = 'admitted' THEN 1 ELSE 0 END) OVER (PARTITION BY cwe ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM tries) WHERE b < 20)"


def _attempted(spark, sf):
    k = F.col("ord") % 5
    status = F.when(k == 0, "failed").when(k == 1, "unparseable").when(k == 2, "rejected").otherwise("admitted")
    rows = _pairs(spark, sf).select(t.cwe_label(F.col("cwe")).alias("cwe"), F.col("ord").alias("attempt"), status.alias("status")).where("cwe is not null")
    return generate.admitted_rows(rows, 20)


@_query(f"WITH {_ATTEMPTED} SELECT cwe, attempt, status FROM ad")
def augment_quota(spark, sf):
    return _attempted(spark, sf)


@_query(f"WITH {_ATTEMPTED} SELECT count(*) AS generated, count(*) FILTER (status = 'unparseable') AS unparseable, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'admitted') AS admitted FROM ad")
def augment_counts(spark, sf):
    return generate.augment_stats(_attempted(spark, sf))


_GEN = _q(generate.GEN_TEMPLATE).replace("\n", "' || chr(10) || '")


@_query(f"WITH {_DOCS}, k AS (SELECT cwe, text, row_number() OVER (PARTITION BY cwe ORDER BY md5('42:doc:' || doc_id), 'doc:' || doc_id) AS attempt FROM d WHERE cwe IS NOT NULL) SELECT cwe, attempt, sha256(replace(replace(replace({_GEN}, '{{cwe}}', cwe), '{{description}}', {_DESCRIBED}), '{{seed}}', text)) AS input_sha FROM k WHERE attempt <= 6")
def augment_prompts(spark, sf):
    seeds = _pairs(spark, sf).withColumn("cwe", t.cwe_label(F.col("cwe")))
    return generate.attempts(seeds, 2).select("cwe", "attempt", F.sha2("input", 256).alias("input_sha"))


@_query("SELECT cwe, n::BIGINT AS attempt, 'admitted' AS status, sha256('Generated' || n) AS name_sha FROM (SELECT unnest(['CWE-89', 'CWE-22', 'CWE-78']) AS cwe), (SELECT unnest(range(1, 5)) AS n)")
def augment_demo(spark, sf):
    tools = c.HarnessConfig(javac_bin="no-compiler-asked-for")
    rows = generate.augmented(demo.pairs(spark), demo.DemoClient(), 4, config=tools)
    return rows.select("cwe", "attempt", "status", F.sha2(t.main_type(F.col("fixed_code")), 256).alias("name_sha"))


@_query("SELECT cwe, 'kept' AS outcome, 6 AS n FROM (SELECT unnest(['CWE-89', 'CWE-22', 'CWE-78']) AS cwe) UNION ALL SELECT 'CWE-89', 'duplicate', 1")
def demo_funnel(spark, sf):
    return clean.judged(demo.pairs(spark)).groupBy("cwe", F.coalesce("drop_reason", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).cast("int").alias("n"))


_CALLS = ('db.executeQuery("a" + b);', "db.executeQuery(sql);", 'db.executeQuery("a");', 'new File("a", name);', 'new File("a" + name);', 'new File("a");', "rt.exec(cmd);", 'rt.exec(new String[] {"sh", "-c", cmd});', 'new ProcessBuilder("/bin/bash", "-c", cmd);', 'pb.command("ls" + x);', "q = file.getCanonicalPath();", "f();")
_CALLED = "CASE doc_id % 12 " + " ".join(f"WHEN {i} THEN {_q(x)}" for i, x in enumerate(_CALLS)) + " END || chr(10) || CASE doc_id // 12 % 12 " + " ".join(f"WHEN {i} THEN {_q(x)}" for i, x in enumerate(_CALLS)) + " END"


@_query(f"WITH e AS (SELECT doc_id, {_CALLED} AS code FROM documents) SELECT doc_id, " + ", ".join("concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(code, {_q(p)})" + (f" AND NOT regexp_matches(code, {_q(m)})" if m else "") + f" THEN '{n}' END" for n, (k, p, m) in approximate.RULES.items() if k == cwe) + f") AS found_{cwe[4:]}" for cwe in c.TARGET_CWES) + " FROM e")
def approximate_findings(spark, sf):
    calls = F.array(*(F.lit(x) for x in _CALLS))
    code = F.concat(calls[(F.col("doc_id") % 12).cast("int")], F.lit("\n"), calls[(F.floor(F.col("doc_id") / 12) % 12).cast("int")])
    return _table(spark, sf, "documents").select("doc_id", *(F.array_join(approximate.findings(code, F.lit(k)), ",").alias(f"found_{k[4:]}") for k in c.TARGET_CWES))


# --- sources and sinks ---------------------------------------------------------------------------


@_query("SELECT sha256(coalesce(text, '')) AS vulnerable_sha, sha256(coalesce(text, '') || ' \"x\"') AS fixed_sha FROM documents")
def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    records.write_pairs(_pairs(spark, sf).withColumn("cwe", F.lit("89")).withColumn("fixed_code", F.concat("fixed_code", F.lit(' "x"'))), path)
    return pair_sources.csv_pairs(spark, path).select(F.sha2("vulnerable_code", 256).alias("vulnerable_sha"), F.sha2("fixed_code", 256).alias("fixed_sha"))


@_query(f"WITH {_PROMPTED} SELECT 'doc:' || doc_id AS source_id, sha256(prompt) AS input_sha, cwe, CASE doc_id % 10 WHEN 8 THEN 'val' WHEN 9 THEN 'test' ELSE 'train' END AS split FROM u WHERE cwe IS NOT NULL")
def records_round_trip(spark, sf):
    path = fresh_path(spark, "records")
    records.write_splits(splitting.triplets(_split_pairs(spark, sf).where("cwe is not null")), path)
    read = [records.training_records(spark, f"{path}/splits/split={s}").withColumn("split", F.lit(s)) for s in c.SPLITS]
    return reduce(DataFrame.unionByName, read).select("source_id", F.sha2("input", 256).alias("input_sha"), "cwe", "split")


@_query(f"SELECT 'CVE-' || doc_id AS ident, {_SCOPE} AS cwe, sha256(text) AS before_sha FROM documents WHERE lang IN ('en', 'fr', 'de') AND doc_id % 3 < 2 AND coalesce(text, '') <> '' AND doc_id % 7 <> 0")
def cve_round_trip(spark, sf):
    path = fresh_path(spark, "cve")
    p = _pairs(spark, sf)
    language = F.when(F.col("ord") % 3 == 0, "Java").when(F.col("ord") % 3 == 2, "JavaScript")
    rows = p.select(language.alias("lang"), F.col("vulnerable_code").alias("func_before"), F.when(F.col("ord") % 7 == 0, F.concat("vulnerable_code", F.lit(" \n"))).otherwise(F.concat("vulnerable_code", F.lit(" x"))).alias("func_after"), F.array("cwe").alias("cwe_ids"), F.concat(F.lit("CVE-"), F.col("ord").cast("string")).alias("cve_id"))
    rows.write.parquet(f"{path}/cvefixes-all.parquet")
    ident = F.element_at(F.split("source_id", ":"), 2)
    return pair_sources.cve_pairs(spark, path).select(ident.alias("ident"), "cwe", F.sha2("vulnerable_code", 256).alias("before_sha"))
