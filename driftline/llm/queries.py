"""Registered queries of the training-data operators: one ``opN_<name>`` per operator, over its
whole table, plus DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.decontamination import contamination
from driftline.llm.hosts import TWO_PART_SUFFIXES
from driftline.llm.jaccard_join import jaccard_groups
from driftline.llm.kd_search import MAX_COMPONENT, top_k
from driftline.llm.language_id import identify
from driftline.llm.license_scan import scan_licenses
from driftline.llm.mixing import mix_plan
from driftline.llm.passage_dedup import dedup_passages
from driftline.llm.prefix_trie import conversation_trie
from driftline.llm.quality_model import score_quality
from driftline.llm.quality_rules import (CLASSES, CODES, COMMON_WORDS, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE,
                                         MIN_JUDGED_CHARS, MIN_JUDGED_WORDS, MIN_REFERENCE_DOCS, SHARE, judge)
from driftline.llm.token_alignment import align_corpus
from driftline.llm.url_filter import LIMIT, RULES, STRENGTH, Z, judge_urls
from driftline.llm.warc import roundtrip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_register
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


@_register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_passages(_table(spark, sf_dir, "documents"))
    return out.select("_row.doc_id", "lines_deleted", "words_deleted", F.length("new_text").cast("bigint").alias("n_chars"),
                      F.sha2(F.coalesce("new_text", F.lit("")), 256).alias("text_sha256"))


@_register
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


@_register
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids, "contaminated")


ORACLE["op5_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM bi),
dn AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
hit AS (SELECT rid, i, dw.n, item_id FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM dn) dw
        JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, list_sort(coalesce(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL), [])) AS items,
        CAST(bool_or(item_id IS NULL) AS INTEGER) AS nameless FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items) + nameless, 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN its USING (rid)
"""


@_register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(_table(spark, sf_dir, "documents"))
    return out.select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


def _quality_sql() -> str:
    """The rules as SQL; lists, classes and limits come from the operator's parameters."""
    steps, prev = [], "t"
    for i, (_, pattern) in enumerate(CLASSES):
        p = pattern.replace("'", "''")
        src = "text" if i == 0 else f"r{i - 1}"
        steps.append(f"x{i} AS (SELECT *, regexp_replace({src}, '{p}', '', 'g') AS r{i}, "
                     f"length({src}) - length(regexp_replace({src}, '{p}', '', 'g')) AS k{i} FROM {prev})")
        prev = f"x{i}"
    n = len(CLASSES)
    chars = ", ".join([f"k{i}" for i in range(n)] + [f"length(r{n - 1})"])
    code = "CASE lang " + " ".join(
        f"WHEN '{lang}' THEN list_transform(words, lambda w: list_position([{', '.join(repr(x) for x in ws)}], lower(w)))"
        for lang, ws in COMMON_WORDS.items()) + " ELSE [] END"
    common = ", ".join([f"len(list_filter(codes, lambda c: c = {i + 1}))" for i in range(len(CODES))]
                       + ["len(words) - len(list_filter(codes, lambda c: c > 0))"])
    known = ", ".join(repr(x) for x in COMMON_WORDS)
    sums = lambda col, k: ", ".join(
        f"sum(CAST(floor({col}[{i + 1}] * {SHARE} / greatest(list_sum({col}), 1)) AS BIGINT))" for i in range(k))

    def js(p: str, q: str) -> str:
        pn, qn = f"list_transform({p}, lambda x: x / list_sum({p}))", f"list_transform({q}, lambda x: x / list_sum({q}))"
        term = "CASE WHEN z[1] > 0 THEN z[1] * ln(z[1] / ((z[1] + z[2]) / 2)) ELSE 0.0 END + CASE WHEN z[2] > 0 THEN z[2] * ln(z[2] / ((z[1] + z[2]) / 2)) ELSE 0.0 END"
        return (f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(list_sum(list_transform("
                f"list_zip({pn}, {qn}), lambda z: {term})) / (2 * ln(2)), 0.0)) END")

    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, CASE WHEN lang IN ({known}) THEN lang ELSE '*' END AS lang
    FROM documents),
{", ".join(steps)},
c AS (SELECT rid, doc_id, text, lang, [{chars}] AS chars, regexp_extract_all(text, '[^ 	-
]+') AS words FROM {prev}),
cc AS (SELECT *, {code} AS codes FROM c),
h AS (SELECT *, CASE WHEN lang = '*' THEN list_transform(range({len(CODES)}), lambda x: 0) || [len(words)] ELSE [{common}] END AS common FROM cc),
refs AS (SELECT lang, count(*) FILTER (len(words) > 0) AS docs, [{sums('chars', n + 1)}] AS ref_chars, [{sums('common', len(CODES) + 1)}] AS ref_common FROM h WHERE lang <> '*' GROUP BY lang),
every AS (SELECT [{sums('chars', n + 1)}] AS all_chars FROM h),
tri AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM h WHERE len(words) >= 3),
tg AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM tri),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM
        (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS k FROM tg) WHERE k > 1) GROUP BY rid),
b AS (SELECT h.*, len(words) AS n_words, list_sum(chars) - chars[2] AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]'))) AS n_lines,
        len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')))) AS n_own,
        coalesce(rep.n, 0) AS n_repeat_words, ref_common,
        coalesce(docs >= {MIN_REFERENCE_DOCS}, false) AS thick,
        CASE WHEN docs >= {MIN_REFERENCE_DOCS} THEN ref_chars ELSE all_chars END AS ref
    FROM h LEFT JOIN rep USING (rid) LEFT JOIN refs USING (lang) CROSS JOIN every),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN word_chars >= {MIN_JUDGED_CHARS} THEN {js('chars', 'ref')} END AS cd,
        CASE WHEN n_words >= {MIN_JUDGED_WORDS} AND thick THEN {js('common', 'ref_common')} END AS wd FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_lines - n_own AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(cd > {MAX_CHAR_DISTANCE}, false) AND NOT coalesce(wd > {MAX_WORD_DISTANCE}, false) AS kept,
       round(cd, 6) AS char_distance, round(wd, 6) AS word_distance
FROM j
"""


ORACLE["op10_quality_rules"] = _quality_sql()


@_register
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_urls(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("rate", 6).alias("rate"), F.round("low", 6).alias("low"))


def _url_sql() -> str:
    fits, words = [], []
    for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0])):
        cond = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        fits.append(f"WHEN {cond} THEN '{h}{p}'")
        words.append(f"WHEN {cond} THEN '{v}'")
    low, high = STRENGTH

    def strength(table: str) -> str:
        return f"""(SELECT CASE WHEN p > 0 AND p < 1 AND free > 0 THEN CASE WHEN rho <= 0 THEN {high} ELSE least(greatest(1 / rho - 1, {low}), {high}) END
            ELSE {high} END FROM (SELECT *, (spread / (p * (1 - p)) - (g - 1)) / free AS rho FROM (SELECT sum(k) / sum(n) AS p,
            sum(k * k / n) - sum(k) / sum(n) * sum(k) AS spread, count(*) AS g, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS free
            FROM {table} WHERE n > 0)))"""

    two = ", ".join(f"'{x}'" for x in TWO_PART_SUFFIXES)
    last = lambda n: "array_to_string(string_split(host, '.')[-%d:], '.')" % n
    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE {' '.join(fits)} END AS rule, CASE {' '.join(words)} END AS ruled FROM u),
h AS (SELECT host, count(ruled) AS n, count(*) FILTER (ruled = 'block') AS k,
        CASE WHEN {last(2)} IN ({two}) THEN {last(2)} ELSE {last(1)} END AS suffix,
        CASE WHEN {last(2)} IN ({two}) THEN {last(3)} ELSE {last(2)} END AS domain
        FROM r GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
m AS (SELECT (sum(k) + 0.5) / (sum(n) + 1) AS p0, {strength('s')} AS ms, {strength('d')} AS md, {strength('h')} AS mh FROM s),
sp AS (SELECT suffix, (k + ms * p0) / (n + ms) AS ps, md, mh FROM s, m),
dp AS (SELECT domain, (n * 0 + k + md * ps) / (n + md) AS pd, mh FROM d JOIN sp USING (suffix)),
hp AS (SELECT host, n, (k + mh * pd) / (n + mh) AS rate, mh FROM h JOIN dp USING (domain))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN rate - {Z} * sqrt(rate * (1 - rate) / (n + mh + 1)) > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       round(rate, 6) AS rate, round(rate - {Z} * sqrt(rate * (1 - rate) / (n + mh + 1)), 6) AS low
FROM r JOIN hp USING (host)
"""


ORACLE["op9_url_filter"] = _url_sql()


@_register
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


@_register
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roundtrip(_table(spark, sf_dir, "pages"))


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, min(page_id) AS origin FROM p WHERE payload_bytes >= 100 GROUP BY ALL)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN origin IS NOT NULL AND coalesce(page_id > origin, true) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN coalesce(page_id > origin, true) THEN origin END AS refers_to, true AS complete
FROM p LEFT JOIN o USING (payload_digest)
"""


@_register
def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))
    return out.withColumn("posterior", F.round("posterior", 6))


@_register
def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE["op11_topk_search"] = f"""
WITH x AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda v: floor(64 * CAST(v AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
w AS (SELECT * FROM x WHERE len(list_filter(v, lambda c: abs(c) > {MAX_COMPONENT})) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM w q JOIN w c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@_register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


ORACLE["op12_prefix_trie"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS seq FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, seq, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
        lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
    FROM own),
seqs AS (SELECT c.conv_id, list_concat(coalesce(b.seq, [])[1:c.h], c.seq[c.h + 1:]) AS seq FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
member AS (SELECT conv_id, seq[1:d] AS path, d, len(seq) AS n FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM seqs)),
node AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
        FILTER (n = d), '') AS ends FROM member GROUP BY path, d),
kids AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM node LEFT JOIN kids USING (path, d)),
below AS (SELECT path[1:k] AS path, k AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_) GROUP BY ALL)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN below b ON f.path = b.path AND f.d = b.d LEFT JOIN node p ON p.d = f.d - 1 AND p.path = f.path[1:f.d - 1]
"""


@_register
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_corpus(_table(spark, sf_dir, "documents")).measures
