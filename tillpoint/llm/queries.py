"""The operators' queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.common import table
from tillpoint.llm.chat import digest, format_chats
from tillpoint.llm.divergence import audit
from tillpoint.llm.exact_dedup import exact_groups
from tillpoint.llm.fertility import judge
from tillpoint.llm.licenses import scan_licenses
from tillpoint.llm.mixing import mix
from tillpoint.llm.packing import pack
from tillpoint.llm.pii import pseudonymise
from tillpoint.llm.quality import score_documents
from tillpoint.llm.secrets import find_secrets
from tillpoint.llm.simhash import near_duplicates
from tillpoint.llm.topk import top_k
from tillpoint.llm.trie import prefix_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op3_simhash")
def _simhash(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


@register("op8_exact_dedup")
def _exact_dedup(spark, sf):
    return exact_groups(table(spark, sf, "documents")).drop("bucket", "chain")


ORACLE_SQL["op8_exact_dedup"] = r"""
WITH bare AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
              FROM documents)
SELECT doc_id, MIN(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
       doc_id = MIN(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM bare WINDOW same AS (PARTITION BY body)"""


@register("op5_best_fit_packing")
def _packing(spark, sf):
    return pack(table(spark, sf, "documents"))


@register("op10_mixing")
def _mixing(spark, sf):
    return mix(table(spark, sf, "documents")).drop("source_key")


@register("op2_quality_classifier")
def _quality(spark, sf):
    return score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op6_exact_topk")
def _topk(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0)


ORACLE_SQL["op6_exact_topk"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON c.vec_id IS DISTINCT FROM q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(ROW_NUMBER() OVER best AS INTEGER) AS rank, vec_id, score
FROM pairs WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY ROW_NUMBER() OVER best <= 5"""


@register("op7_pii_pseudonyms")
def _pii(spark, sf):
    # The key of a real run is a secret of the session; this one only makes the query repeatable.
    return pseudonymise(table(spark, sf, "documents"),
                        spark.conf.get("spark.tillpoint.pii.key", "for trials only"))


@register("op9_chat_formatting")
def _chat(spark, sf):
    control = F.lit("</s>[INST] ok [/INST]")  # fixed value: the conversation the contract adds
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        control.alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return digest(format_chats(turns.unionByName(extra)))


# Marks around a text are 15 characters for a system turn, 13 for a user, 7 for an assistant, 21
# beside the role for any other.  In a text, or the name of another role, each backslash and each control
# string, opening or closing, is a character longer.
ORACLE_SQL["op9_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, CASE WHEN role IN ('system', 'user', 'assistant') THEN text ELSE text || chr(0) || role END AS said,
           CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 20 END AS marks
    FROM turns),
grown AS (
    SELECT *, len(regexp_extract_all(said, '\\|<</?SYS>>|\[/?INST\]|</?s>|<</?ROLE>>')) AS more
    FROM sized)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(length(said) + marks + more) AS BIGINT) AS formatted_chars
FROM grown GROUP BY conv_id"""


@register("op1_license_scan")
def _licenses(spark, sf):
    return scan_licenses(table(spark, sf, "documents"))


@register("op4_secret_scan")
def _secrets(spark, sf):
    return find_secrets(table(spark, sf, "documents"))


@register("op11_fertility_rules")
def _fertility(spark, sf):
    return judge(table(spark, sf, "documents")).withColumn("outside", F.array_join("outside", ","))


@register("op12_source_divergence")
def _divergence(spark, sf):
    return audit(table(spark, sf, "documents"))


ORACLE_SQL["op12_source_divergence"] = r"""
WITH docs AS (
    SELECT ROW_NUMBER() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
           translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(
              text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, COUNT(*) AS total FROM words GROUP BY lang, term
         HAVING COUNT(DISTINCT r) >= 30),
langs AS (SELECT lang, COUNT(*) AS v, SUM(total) AS n FROM kept GROUP BY lang),
spoken AS (SELECT lang, source, term, COUNT(*) AS n FROM words JOIN kept USING (lang, term)
           GROUP BY lang, source, term),
sizes AS (SELECT lang, source, SUM(n) AS n FROM spoken GROUP BY lang, source),
parts AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
    SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n,
           1 + (CAST(1000000000 AS HUGEINT) * (COALESCE(c.n, 0) + 5)) // (COALESCE(s.n, 0) + 5 * l.v) AS p,
           1 + (CAST(1000000000 AS HUGEINT) * (k.total + 5)) // (l.n + 5 * l.v) AS q
    FROM parts g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN spoken c USING (lang, source, term) LEFT JOIN sizes s USING (lang, source)),
apart AS (
    SELECT x.lang, x.source, y.source AS item, SUM(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source),
items AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(f.value, 0) AS value
    FROM parts a JOIN parts b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(ROW_NUMBER() OVER best AS INTEGER) AS rank
FROM items WINDOW best AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR ROW_NUMBER() OVER best <= 50"""


@register("op13_prefix_trie")
def _trie(spark, sf):
    return prefix_trie(table(spark, sf, "conversations"))


# The checksum of an id is folded bit by bit: a digit is followed by eight shifts (-1).
ORACLE_SQL["op13_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
           ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''),
                              COALESCE(text, '')) AS pos
    FROM conversations),
ids AS (
    SELECT conv_id, conv_id - conv_id % 20 AS leader, xor(list_reduce(
               flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                   lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                                 ELSE xor(a >> 1, 3988292384 * (a & 1)) END,
               CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations)),
rebuilt AS (
    SELECT i.conv_id, 0 AS own, t.pos, t.role, t.text
    FROM ids i JOIN turns t ON t.conv_id = i.leader AND t.pos <= i.h
    UNION ALL
    SELECT i.conv_id, 1, t.pos, t.role, t.text
    FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h),
steps AS (SELECT conv_id, role, text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth
          FROM rebuilt),
prefixes AS (
    SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
               OVER (PARTITION BY conv_id ORDER BY depth) AS path
    FROM steps
    UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
nodes AS (SELECT depth, path, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MIN(words) AS words
          FROM prefixes GROUP BY depth, path),
above AS (SELECT n.depth, n.path, a.depth AS over_depth, a.path AS over
          FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth),
children AS (SELECT over_depth AS depth, over AS path, COUNT(*) AS n_children FROM above
             WHERE over_depth = depth - 1 GROUP BY over_depth, over),
whole AS (
    SELECT n.*, COALESCE(c.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path),
sums AS (
    SELECT a.over_depth AS depth, a.over AS path, COUNT(*) FILTER (w.n_children = 0) AS n_leaves,
           SUM((w.n_convs - 1) * w.words) AS saved_tokens
    FROM above a JOIN whole w ON w.depth = a.depth AND w.path = a.path GROUP BY a.over_depth, a.over),
ends AS (
    SELECT depth, path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT * FROM prefixes QUALIFY depth = MAX(depth) OVER (PARTITION BY conv_id))
    GROUP BY depth, path)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(COALESCE(e.ids, '')) AS ends_sha256
FROM whole w JOIN sums s ON s.depth = w.depth AND s.path = w.path
LEFT JOIN ends e ON e.depth = w.depth AND e.path = w.path
LEFT JOIN above a ON a.depth = w.depth AND a.path = w.path AND a.over_depth = w.depth - 1
LEFT JOIN nodes p ON p.depth = a.over_depth AND p.path = a.over"""
