"""Registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, hard_negatives, html_extract, katz, mixing, near_dedup, prefix_trie, quality_pu, quality_rules,
               sharding, token_codes, token_counts, toxicity)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws}))

RULES_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c >= 2),
v AS (SELECT doc_id, count(*) AS n_repeat_words
      FROM (SELECT DISTINCT doc_id, i + k AS p FROM r, range(0, 5) AS s(k)) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(v.n_repeat_words, 0) AS n_repeat_words,
             length(t) - length(replace(t, '!', '')) AS n_bangs, len(l) AS n_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_adjacent,
             len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words
      FROM w LEFT JOIN v USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words >= 10 AND n_words <= 1000000
       AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words
       AND n_symbols / n_words <= 0.1 AND n_bangs / n_words <= 0.3
       AND (n_lines = 0 OR n_bullet_lines / n_lines <= 0.9)
       AND (n_lines = 0 OR n_ellipsis_lines / n_lines <= 0.3)
       AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5)
       AND n_adjacent / n_words <= 0.2 AND (n_stop_words + 1) / n_words >= 0.02 AS kept
FROM b"""


@query("op3_quality_rules", RULES_SQL)
def op3_quality_rules(spark, sf_dir):
    out = quality_rules.apply_rules(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


#: Targets by water level: in the order in which sources reach twice their
#: size, the first level that stops no further source.
MIX_CTES = rf"""
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 8))::BIGINT AS draw
      FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3
                WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s),
q AS (SELECT *, 2.0::DOUBLE * source_size / w AS stop,
             (1.5::DOUBLE * sum(source_size) OVER ()
              - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
             sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM o),
lv AS (SELECT coalesce(min_by(lvl, stop) FILTER (WHERE lvl <= stop), 'inf'::DOUBLE) AS lvl FROM q),
t AS (SELECT q.source, source_size, CASE WHEN source_size = 0 THEN 0.0
             ELSE least(2.0::DOUBLE * source_size, lv.lvl * w) END AS target FROM q, lv),
u AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate FROM t),
c AS (SELECT *, floor((rate - floor(rate)) * 4294967296)::BIGINT AS cut FROM u),
k AS (SELECT d.source, k, sum(CASE WHEN (draw + (k * 2654435769) % 4294967296) % 4294967296 < cut
                              THEN size ELSE 0 END) AS got
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source, range(0, {mixing.N_ROTATIONS}) AS r(k) GROUP BY ALL),
b AS (SELECT k.source, arg_min(k, (abs(got - (target - floor(rate) * source_size)), k)) AS k
      FROM k JOIN c ON k.source IS NOT DISTINCT FROM c.source GROUP BY k.source),
x AS (SELECT d.doc_id, d.size, c.source_size, c.target,
             floor(rate)::BIGINT + CASE WHEN (draw + (b.k * 2654435769) % 4294967296) % 4294967296 < cut
                                   THEN 1 ELSE 0 END AS copies
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source JOIN b ON d.source IS NOT DISTINCT FROM b.source)"""


@query("op4_mix_sources", f"WITH {MIX_CTES} SELECT doc_id, size, source_size, target, size * copies AS taken FROM x")
def op4_mix_sources(spark, sf_dir):
    return mixing.mixture_table(read(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken")


@query("op7_hilbert_shards")
def op7_hilbert_shards(spark, sf_dir):
    return sharding.shard(read(spark, sf_dir, "documents"), carry=False) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op2_token_codes")
def op2_token_codes(spark, sf_dir):
    return token_codes.encode_roundtrip(read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=2)


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


@query("op6_html_main_text")
def op6_html_main_text(spark, sf_dir):
    return html_extract.extract_main_text(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op1_quality_pu")
def op1_quality_pu(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality_pu.score(docs, quality_pu.fit(docs, read(spark, sf_dir, "labels")))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


@query("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark, sf_dir):
    return near_dedup.components(read(spark, sf_dir, "documents"))


@query("op8_benchmark_leaks")
def op8_benchmark_leaks(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op11_katz_backoff")
def op11_katz_backoff(spark, sf_dir):
    return katz.fit_and_score(read(spark, sf_dir, "documents"))


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS al, b.vec_id, b.label, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM v AS a, v AS b WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = al AND vec_id <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.al
     AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


#: crc32 bit by bit, since DuckDB has no such function.
TRIE_SQL = """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  coalesce(text, '')) AS pos, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(x ORDER BY pos) AS x FROM t GROUP BY c),
h AS (SELECT c, x, xor(list_reduce(list_concat([4294967295::UBIGINT],
        list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)),
        lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
          lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 6 AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(l.x[1:h.h], []), h.x[h.h + 1:]) AS x
      FROM h LEFT JOIN o AS l ON l.c = h.c - h.c % 100),
m AS (SELECT c, unnest(range(0, len(x) + 1)) AS d, x FROM r),
k AS (SELECT c, d, len(x) AS n, x[1:d] AS p, CASE WHEN d = 0 THEN 0 ELSE length(x[d].t) END AS len FROM m),
node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(len) AS saved,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
         FROM k GROUP BY p, d),
up AS (SELECT node.*, par.conv_id AS parent_conv_id FROM node LEFT JOIN node AS par
       ON par.d = node.d - 1 AND par.p = node.p[1:node.d - 1]),
kid AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM up WHERE d > 0 GROUP BY ALL),
f AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kid USING (conv_id, d)),
sub AS (SELECT a.conv_id, a.d, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens
        FROM f AS a JOIN f AS b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY ALL)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM f JOIN sub USING (conv_id, d)"""


@query("op13_prefix_trie", TRIE_SQL)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))
