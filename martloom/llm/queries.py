"""One query per operator, over whole tables, with comparison SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import fresh_dir
from . import bpe, chat, html_text, language, lexical, ngram_join, packing, quality_rules, repair, sharding, topk, toxicity, warc
from .common import table, text_crc

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return register


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), h AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, html, sha1(html) AS hex FROM p
), m AS (
  SELECT html, max(page_id) AS winner FROM h GROUP BY html
), b AS (
  SELECT i, '0123456789abcdef' AS x FROM range(32) t(i)
), d AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((instr(x, substr(hex, (5 * i // 4 + 1)::INT, 1)) - 1) * 16
       + CASE WHEN 5 * i // 4 + 2 <= 40 THEN instr(x, substr(hex, (5 * i // 4 + 2)::INT, 1)) - 1 ELSE 0 END)
      // CASE (i % 4) WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END % 32)::INT + 1, 1), '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT hex FROM h), b GROUP BY hex
)
SELECT page_id, payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM h JOIN m USING (html) JOIN d USING (hex)
"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write(warc.captures(table(spark, sf_dir, "pages")), path)
    found = warc.assemble(warc.read_records(spark, path, with_payload=False))
    return found.select(
        warc.page_of(F.col("capture")).alias("page_id"),
        F.coalesce(F.col("main.payload_bytes"), F.col("metadata.fields")["payloadBytes"].cast("long")).alias("payload_bytes"),
        F.coalesce(F.col("main.payload_digest"), F.col("main.digest")).alias("payload_digest"),
        F.col("main.record_type").alias("record_type"),
        warc.page_of(F.col("main.refers_to")).alias("refers_to"),
    )


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length('<turn>' || role || chr(10) || '</turn>' || chr(10)) + length(replace(replace(replace(replace(replace(replace(
    replace(text, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'), '<image:', '\<image:'), '<audio:', '\<audio:'),
    '<document:', '\<document:'), '### ', '\### ')) AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars, 0::BIGINT AS attachment_tokens
FROM sized GROUP BY conv_id
"""


@query("op9_chat_format", OP9_SQL)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.read_back(chat.format_turns(rows.unionByName(own)), ordered=True)


@query("op10_main_text")
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), text_crc("doc_id") % 5 != 0)
    return toxicity.score(docs, model).withColumn("held_out", text_crc("doc_id") % 5 == 0)


OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, 'null') AS stratum, coalesce(text, '') AS body,
    [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), c AS (
  SELECT doc_id, count(DISTINCT p) AS covered FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g JOIN (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1)
    USING (doc_id, g)) GROUP BY 1
), f AS (
  SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(covered, 0) AS n_repeat_words,
    length(regexp_replace(body, '[^\p{{Lu}}]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN c USING (doc_id)
), r AS (
  SELECT doc_id, stratum, unnest(['symbol', 'line', 'repeat', 'capital']) AS rule, unnest([
    coalesce(n_symbols::DOUBLE / nullif(word_chars, 0), 0), coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0),
    coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0), coalesce(n_capitals::DOUBLE / nullif(word_chars, 0), 0)]) AS rate
  FROM f
), m AS (
  SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1
), k AS (
  SELECT stratum, rule, i, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND rate > cutoff) AS k,
    count(*) FILTER (NOT good AND rate > cutoff) AS caught
  FROM r JOIN m USING (doc_id), (SELECT unnest(range({len(quality_rules.GRID)})) AS i,
    unnest({list(quality_rules.GRID)}::DOUBLE[]) AS cutoff) GROUP BY ALL
), s AS (
  SELECT count(DISTINCT stratum) AS s FROM k
), h AS (
  SELECT *, coalesce(list_max([j FOR j IN range(1, 5) IF n * ln(1 - 0.04::DOUBLE / j) <= ln(0.05::DOUBLE / (j * s))]), 0) AS m
  FROM k, s
), t AS (
  SELECT *, CASE WHEN k >= n * p THEN false ELSE list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
    + j * ln(p) + (n - j) * ln(1 - p)) FOR j IN range(0, k + 1)]) <= 0.05::DOUBLE / (m * s) END AS refuted
  FROM (SELECT *, 0.04::DOUBLE / m AS p FROM h WHERE list_position(['symbol', 'capital', 'line', 'repeat'], rule) <= m)
), b AS (
  SELECT stratum, rule, cutoff FROM t
  WHERE i < coalesce((SELECT min(i) FROM t u WHERE u.stratum = t.stratum AND u.rule = t.rule AND NOT u.refuted), 99)
    AND caught > k
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY caught - k DESC, i) = 1
), x AS (
  SELECT DISTINCT doc_id FROM r JOIN b USING (stratum, rule) WHERE rate > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND x.doc_id IS NULL AS kept
FROM f LEFT JOIN x USING (doc_id)
"""


@query("op5_quality_rules", OP5_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, text_crc("doc_id") % 4 != 2, explain=False)
    return language.label(docs, model).select("doc_id", (text_crc("doc_id") % 4 == 2).alias("held_out"), "lang_pred", "score")


OP8_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END)) AS g FROM t
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), l AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
    WHERE x.doc_id < y.doc_id GROUP BY 1, 2)
  JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 90 * (p.n + q.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id, doc_id AS m FROM t UNION SELECT e.b, r.m FROM r JOIN e ON r.doc_id = e.a WHERE r.m < e.b
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(m) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


@query("op8_ngram_join", OP8_SQL)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.link(table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 256) FOR x IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.x) = 0 THEN 0 ELSE list_dot_product(q.x, c.x) END::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query("op4_top_k", OP4_SQL)
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.near_clusters(table(spark, sf_dir, "documents"))
    return packing.pack(found, cluster=F.col("cluster"), size=F.col("words"), key=F.col("same"))


# crc32 over the bytes of a text, from the 256 remainders of single bytes.
CRC_SQL = """
remainders AS (
  SELECT list(t ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i::UBIGINT, [k::UBIGINT FOR k IN range(8)]),
    lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)) AS t FROM range(256) r(i))
)"""


def crc_sql(text: str) -> str:
    """SQL for the crc32 of a text; ``remainders`` of ``CRC_SQL`` must be joined."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || h)::UBIGINT FOR h IN regexp_extract_all(hex(encode({text})), '..')]), "
        "lambda a, c: xor(a >> 8, tab[(xor(a, c) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT"
    )


SHARDS = 40

OP13_SQL = f"""
WITH {CRC_SQL}, d AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size, {crc_sql("coalesce(text, '')")} AS text_crc32
  FROM documents, remainders
), o AS (
  SELECT *, row_number() OVER w AS r, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total
  FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)
), s AS (
  SELECT *, least({SHARDS - 1}, (2 * before + size) * {SHARDS} // (2 * total))::INT AS shard FROM o
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY r) - 1 AS slot,
  NULL::INT AS grown_shard
FROM s
"""


@query("op13_sharding", OP13_SQL)
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.assign(rows, SHARDS, ["doc_id", "size", "text_crc32"], "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


OP12_SQL = rf"""
WITH RECURSIVE {CRC_SQL}, b AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, '') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f
  FROM conversations, remainders
), m AS (
  SELECT c, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM b WHERE f <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ending
  FROM m
), k AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated'
    ELSE 'sound' END AS kind, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS previous
  FROM o
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (kind = 'blank') AS blank,
    count(*) FILTER (kind = 'duplicate') AS duplicate, count(*) FILTER (kind = 'truncated') AS truncated,
    count(*) FILTER (previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM k GROUP BY c
), ins(state, n, here, made) AS (
  VALUES (0, 0, 0, ''), (0, 1, 2, chr(10) || 'user:'), (0, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 0, 1, ''), (1, 1, 2, chr(10) || 'user:'), (1, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (2, 0, 2, ''), (2, 1, 3, chr(10) || 'assistant:'), (2, 2, 2, chr(10) || 'assistant:' || chr(10) || 'user:'),
    (3, 0, 3, ''), (3, 1, 2, chr(10) || 'user:'), (3, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:')
), nxt(here, initial, name, into_state) AS (
  VALUES (0, 's', NULL, 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)
), acts AS (
  SELECT c, i, state, n, made, into_state, 2 * n + 3 AS paid, repeat('I', n) || 'D' AS edits, '' AS line
  FROM k, ins, (SELECT DISTINCT here AS a, here AS into_state FROM ins) WHERE a = here
  UNION ALL
  SELECT c, i, state, n, made, into_state, 2 * n + (kind = 'truncated')::INT, repeat('I', n) || 'K', chr(10) || role || ':' || text
  FROM k, ins JOIN nxt USING (here) WHERE nxt.initial = k.initial AND kind IN ('sound', 'truncated')
  UNION ALL
  SELECT c, i, state, n, made, into_state, 2 * n + 2 + (kind = 'truncated')::INT, repeat('I', n) || 'R', chr(10) || name || ':' || text
  FROM k, ins JOIN nxt USING (here) WHERE name IS NOT NULL AND kind IN ('sound', 'truncated')
), dp AS (
  SELECT DISTINCT c, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS body FROM b
  UNION ALL
  SELECT * FROM (
    SELECT c, acts.i, into_state AS state, (cost + paid)::BIGINT AS cost, audit || edits AS audit, body || made || line AS body
    FROM dp JOIN acts USING (c, state) WHERE acts.i = dp.i + 1
    QUALIFY row_number() OVER (PARTITION BY c, into_state ORDER BY cost + paid, audit || edits) = 1)
), ended AS (
  SELECT c, (cost + 2 * ins.n)::BIGINT AS cost, audit || repeat('I', ins.n) AS audit, body || made AS body
  FROM dp LEFT JOIN counts USING (c) JOIN ins USING (state) WHERE i = coalesce(counts.n, 0) AND here IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost + 2 * ins.n, audit || repeat('I', ins.n)) = 1
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(body, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM b) JOIN ended USING (c) LEFT JOIN counts USING (c)
"""


@query("op12_repair", OP12_SQL)
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), F.col("dropped"))


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, rid, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS rid FROM documents WHERE text IS NOT NULL)
), d AS (
  SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY rid
), s AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), f AS (
  SELECT rid, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term
), p AS (
  SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (rid), s GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM p JOIN d USING (rid) WHERE score > 0 QUALIFY rank <= 10
"""


@query("op11_lexical_search", OP11_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
