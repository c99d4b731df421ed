"""The thin queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (
    bpe_codec, conversation_repair, embedding_dedup, exact_dedup, hard_negatives, katz, language_id, license_scan,
    minhash_dedup, packing, token_counts, transcripts, url_filter)
from gleaner.llm.common import Work, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    """Register a function of (table reader, work folder) under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return fn(lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"), Work(spark, fn.__name__))

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_embedding_dedup(table, work) -> DataFrame:
    return embedding_dedup.near_duplicates(table("embeddings"), work)


def _remainder(n: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n))


@query
def op2_token_counts(table, work) -> DataFrame:
    counted = token_counts.count_tokens(
        table("documents"), work, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op3_language_id(table, work) -> DataFrame:
    docs = table("documents")
    held_out = _remainder(4) == 2
    model = language_id.learn(docs.where(~held_out))
    return language_id.identify(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


@query
def op4_bpe_codec(table, work) -> DataFrame:
    coded = bpe_codec.encode_and_decode(
        table("documents"), work, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op5_chat_transcripts(table, work) -> DataFrame:
    rows = table("conversations")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    return transcripts.parse(rows, transcripts.learn(rows.where(~held_out)))


@query
def op6_best_fit_packing(table, work) -> DataFrame:
    return packing.pack(table("documents"), work, public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_exact_dedup(table, work) -> DataFrame:
    found = exact_dedup.exact_duplicates(table("documents"), work, keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))



@query
def op8_katz_backoff(table, work) -> DataFrame:
    return katz.score(table("documents"), work, _remainder(7) == 2)


@query
def op9_minhash_dedup(table, work) -> DataFrame:
    found = minhash_dedup.near_duplicates(table("documents"), work, width=2)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# Fixed values of the query: verdict, host, path prefix.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query
def op10_url_filter(table, work) -> DataFrame:
    return url_filter.judge(table("pages"), URL_RULES)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted damage: conv_id, turn, role, text, present; crc32(conv_id:turn) mod 20 says which.

    0 drops the row (present is false), 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    dealt = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                        F.pmod(F.crc32(key), F.lit(20)).alias("damage"))
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return dealt.select(
        "conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("damage") != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("damage") == 3, 2).otherwise(1))).alias("time")).drop("time")


@query
def op11_conversation_repair(table, work) -> DataFrame:
    lines, talks = conversation_repair.repair(
        damaged(table("conversations")), work, F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"), F.col("present"))
    return conversation_repair.digests(lines, talks).drop("rows")


# Fixed values of the query: phrase and label.
LICENSE_PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]


@query
def op12_license_scan(table, work) -> DataFrame:
    starts = F.transform(F.filter("spans", lambda s: s["phrase"]), lambda s: s["start"])
    return license_scan.scan(table("documents"), LICENSE_PHRASES).select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), license_scan.labels_of(F.col("spans"), lambda s: s["phrase"]).alias("base_labels"),
        license_scan.labels_of(F.col("spans"), lambda s: s["phrase"] | s["kept"]).alias("labels"), "score")


@query
def op13_hard_negatives(table, work) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        table("embeddings"), work, F.col("vec_id") % 100 == 0, F.col("vec_id"), label, F.col("embedding"))


ORACLES["op13_hard_negatives"] = """
WITH r AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS arid, a.vec_id AS anchor_id, a.label AS own, b.rid AS brid, b.vec_id, b.label,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.rid <> b.rid AND len(a.v) = len(b.v)),
p AS (SELECT * FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id NULLS LAST, brid) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.arid = p.arid AND s.label <> p.own AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.arid, p.brid ORDER BY s.score DESC, s.vec_id NULLS LAST, s.brid)
QUALIFY rank <= 5
"""

ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
dealt AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d FROM keyed, crc_table),
after AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM dealt, unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) WHERE d <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS tail FROM after),
marked AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?')
    THEN 'truncated' ELSE '' END AS fault, role[1] AS c, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS c0 FROM numbered),
totals AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (c0 IS NOT NULL AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
-- best (cost, audit, text) by grammar state: nothing yet, after s, after u, after a; 999999999 means out of reach
best(conv_id, i, z, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, {'k': 0, 'e': '', 't': ''}, {'k': 999999999, 'e': '', 't': ''},
    {'k': 999999999, 'e': '', 't': ''}, {'k': 999999999, 'e': '', 't': ''} FROM totals
  UNION ALL
  SELECT conv_id, i,
    {'k': z.k + 2, 'e': z.e || 'D', 't': z.t},
    least({'k': s.k + 2, 'e': s.e || 'D', 't': s.t},
          {'k': CASE WHEN c = 's' THEN z.k + keep ELSE 999999999 END, 'e': z.e || 'K', 't': line}),
    least({'k': u2.k + 2, 'e': u2.e || 'D', 't': u2.t},
          {'k': CASE WHEN c = 'u' THEN z.k + keep ELSE 999999999 END, 'e': z.e || 'K', 't': line},
          {'k': z.k + keep + 1, 'e': z.e || 'R', 't': 'user:' || body},
          {'k': CASE WHEN c = 'u' THEN s.k + keep ELSE 999999999 END, 'e': s.e || 'K', 't': s.t || chr(10) || line},
          {'k': s.k + keep + 1, 'e': s.e || 'R', 't': s.t || chr(10) || 'user:' || body},
          {'k': CASE WHEN c = 'u' THEN a2.k + keep ELSE 999999999 END, 'e': a2.e || 'K', 't': a2.t || chr(10) || line},
          {'k': a2.k + keep + 1, 'e': a2.e || 'R', 't': a2.t || chr(10) || 'user:' || body}),
    least({'k': a2.k + 2, 'e': a2.e || 'D', 't': a2.t},
          {'k': CASE WHEN c = 'a' THEN u2.k + keep ELSE 999999999 END, 'e': u2.e || 'K', 't': u2.t || chr(10) || line},
          {'k': u2.k + keep + 1, 'e': u2.e || 'R', 't': u2.t || chr(10) || 'assistant:' || body})
  FROM (SELECT b.conv_id, m.i, m.c, m.text AS body, m.role || ':' || m.text AS line, b.z, b.s,
      CASE WHEN m.fault IN ('blank', 'duplicate') THEN 999999999 WHEN m.fault = 'truncated' THEN 5 ELSE 0 END AS keep,
      least(b.u, {'k': b.z.k + 5, 'e': b.z.e || 'I', 't': 'user:'}, {'k': b.s.k + 5, 'e': b.s.e || 'I', 't': b.s.t || chr(10) || 'user:'},
        {'k': b.a.k + 5, 'e': b.a.e || 'I', 't': b.a.t || chr(10) || 'user:'}) AS u2,
      least(b.a, {'k': b.u.k + 5, 'e': b.u.e || 'I', 't': b.u.t || chr(10) || 'assistant:'},
        {'k': b.z.k + 10, 'e': b.z.e || 'II', 't': 'user:' || chr(10) || 'assistant:'},
        {'k': b.s.k + 10, 'e': b.s.e || 'II', 't': b.s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}) AS a2
    FROM best b JOIN marked m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i + 1)),
done AS (SELECT t.conv_id, n, gaps, blank, duplicate, truncated, illegal, least(z, a,
    {'k': u.k + 5, 'e': u.e || 'I', 't': u.t || chr(10) || 'assistant:'},
    {'k': s.k + 10, 'e': s.e || 'II', 't': s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}) AS w
  FROM totals t JOIN best b ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND b.i = t.n)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.k, 0) AS cost, coalesce(w.e, '') AS audit,
  sha256(coalesce(w.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""

ORACLES["op1_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, least(a, min(b)) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""

ORACLES["op9_minhash_dedup"] = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
  ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
meets AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM meets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  coalesce(component_id, doc_id) = doc_id AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
