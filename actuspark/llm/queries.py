"""Registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, decontam, divergence, edit_counts, exact, jaccard, maxent, paragraphs, pieces, quality, search, suffix, urls
from .shared import table

#: The URL rules of the contract (fixed values): host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model learns from the conversations that are not held out; roles of all rows are recovered from the raw text alone."""
    raw = chat.transcripts(table(spark, sf_dir, "conversations"))
    model = chat.fit(raw.where(F.pmod(F.xxhash64("conv_id"), F.lit(5)) != 1))
    return chat.parse(raw.drop("role"), model)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.verdicts(found).select(F.col("k").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a word is a paragraph; one of fewer words than a shingle has is one shingle. Passages of over 50 words are found within lines, too."""
    return paragraphs.dedup(table(spark, sf_dir, "documents"), min_words=1, passage_words=51)


def op4_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_corpus(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.classify(table(spark, sf_dir, "pages"), rules)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.coalesce(F.length("text"), F.lit(0))
    start = lambda x: F.floor(x).cast("int").alias("start")
    edits = F.array(
        F.struct(start(n / 2), F.lit(24).alias("deleted"), F.lit("").alias("inserted")),
        F.struct(start(n / 4), F.lit(0).alias("deleted"), F.concat(F.lit(" ["), F.coalesce("lang", F.lit("")), F.lit("]")).alias("inserted")),
        F.struct(start(3 * n / 4), F.lit(5).alias("deleted"), F.coalesce("source", F.lit("")).alias("inserted")),
    )
    return edit_counts.count_edits(table(spark, sf_dir, "documents"), edits)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"), keep_text="")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col("quality")
    failed = quality.BASE_RULES[0].rejects(lambda k: q[k]) | quality.BASE_RULES[1].rejects(lambda k: q[k])
    return judged.select("doc_id", q["n_words"].alias("n_words"), *[q[k].alias(k) for k in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], failed.alias("base_failed"), "kept")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract keeps the largest id; the operator keeps the smallest one unless told so."""
    return exact.dedup(table(spark, sf_dir, "documents"), keep="largest").withColumnRenamed("k", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_decontaminate": op2_decontaminate,
    "op3_paragraph_dedup": op3_paragraph_dedup,
    "op4_maxent_scores": op4_maxent_scores,
    "op5_url_filter": op5_url_filter,
    "op6_pieces": op6_pieces,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality": op9_quality,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_lexical_search": op11_lexical_search,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_exact_dedup": op13_exact_dedup,
    "pipeline": corpus_pipeline.run,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SEARCH_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_AUDIT_TERMS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": f"""
WITH i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ITEM_WORDS}) w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(13, len(w)) n, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ITEM_WORDS}) w FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) p FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, n, p FROM dw JOIN wins USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT q) n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) q FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) n_items, string_agg(k, ',' ORDER BY k) ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) k FROM m) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ks, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op5_url_filter": f"""
WITH r(rhost, rpath, rverdict) AS (VALUES {", ".join(str(x) for x in URL_RULES)}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') raw FROM u),
p AS (SELECT page_id, {_LOWER.format("raw")} host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') path FROM h),
m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) rule, arg_max(rverdict, length(rhost || rpath)) v
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op9_quality": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), {_WORDS}) w FROM documents),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_WORDS})) ls FROM d),
g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) n FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) p FROM d)),
rep AS (SELECT doc_id, count(DISTINCT q) n_rep FROM (SELECT doc_id, unnest(range(p, p + 3)) q FROM g WHERE n > 1) GROUP BY doc_id),
f AS (
  SELECT doc_id, len(w) n_words, length(array_to_string(w, '')) word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) n_symbols,
    len(ls) n_lines, len(ls) - len(list_distinct(ls)) n_dup_lines, coalesce(n_rep, 0) n_repeat_words,
    len(regexp_extract_all(t, '\\p{{L}}[^\\x20\\x09-\\x0D]*')) n_alpha_words
  FROM l LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > 3 * n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_alpha_words < 6 * n_words) AS kept
FROM b""",
    "op8_substring_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) s FROM d)),
c AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) i FROM w) WHERE i > 1),
g AS (SELECT doc_id, s, sum(j) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END j FROM c)),
spans AS (SELECT doc_id, min(s) a, max(s) + 100 b FROM g GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) p FROM (SELECT * FROM spans UNION ALL SELECT doc_id, length(h) // 2, length(h) // 2 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a, b) t FROM edges JOIN d USING (doc_id) GROUP BY doc_id),
tot AS (SELECT doc_id, sum(b - a) r, count(*) n FROM spans GROUP BY 1)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(t)) AS kept_sha256 FROM d LEFT JOIN tot USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_jaccard_join": f"""
WITH RECURSIVE ws AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORDS}) w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) p FROM ws WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM sh GROUP BY 1),
i AS (SELECT a.doc_id a, b.doc_id b, count(*) i FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 75 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id c FROM ws UNION SELECT b, c FROM r JOIN both_ways ON a = doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM (SELECT doc_id, min(c) component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)""",
    "op11_lexical_search": f"""
WITH d AS (SELECT doc_id, {_LOWER.format(f"unnest(regexp_extract_all(coalesce(text, ''), {_SEARCH_TERMS}))")} t FROM documents),
n AS (SELECT doc_id, count(*) n FROM d GROUP BY 1),
c AS (SELECT count(*) docs, CAST(sum(n) AS BIGINT) l FROM n),
tf AS (SELECT doc_id, t, count(*) tf FROM d GROUP BY 1, 2),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) w FROM tf, c GROUP BY t, docs),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // l) m FROM n, c),
i AS (SELECT item_id, {_LOWER.format(f"unnest(regexp_extract_all(coalesce(text, ''), {_SEARCH_TERMS}))")} t FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) score
  FROM i JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) k FROM s WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM r WHERE k <= 10""",
    "op12_divergence_audit": f"""
WITH d AS (SELECT row_number() OVER () i, coalesce(lang, '') lang, coalesce(source, '') source, regexp_extract_all(coalesce(text, ''), {_AUDIT_TERMS}) ws FROM documents),
o AS (SELECT i, lang, source, {_LOWER.format("unnest(ws)")} t FROM d),
c AS (SELECT lang, source, t, count(*) n FROM o GROUP BY ALL),
kept AS (SELECT lang, t, count(*) n FROM o GROUP BY ALL HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) v, sum(n) total FROM kept GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT lang, source, t, coalesce(c.n, 0) n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, t)),
gn AS (SELECT lang, source, sum(n) total FROM gt GROUP BY ALL),
p AS (SELECT lang, source, t, gt.n, 1 + (1000000000 * (gt.n + 2)::HUGEINT) // (gn.total + 2 * v) p FROM gt JOIN gn USING (lang, source) JOIN v USING (lang)),
q AS (SELECT lang, t, 1 + (1000000000 * (n + 2)::HUGEINT) // (total + 2 * v) q FROM kept JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' part, b.source item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) f
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.t = x.t GROUP BY ALL),
terms AS (SELECT lang, source, 'term' part, t item, (p - q) * (p - q) // (p + q) f FROM p JOIN q USING (lang, t) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, encode(item)) k FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(k AS INTEGER) AS rank FROM r WHERE part = 'pair' OR k <= 10""",
    "op13_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)""",
}
