"""The queries of the dealt operators over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (bpe, fingerprints, html, jaccard, lines, packing, phrases, quality, rules, samples,
                          sharding, tokencounts, toxicity, trie)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SQL_LINES = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(k.doc_id < f.last, false) AS gone FROM k LEFT JOIN f USING (key))"""


@query("op3_line_dedup", SQL_LINES + """
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# The stop words as the SQL has them, by language.
STOPS = ", ".join(f"'{w}'" for w in """a an and are as at be by for from in is it of on or that the this to was with
au aux avec dans de des du elle en est et la le les mais ne pas par pour que qui sur un une
als auf das dem den der des die ein eine für ist mit nicht sich und von zu
al como con del el en es las lo los más no para por que se su un una y""".split())

SQL_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(len(ws) - 2)) AS i, ws FROM d WHERE len(ws) >= 3),
g AS (SELECT doc_id, i, concat_ws(' ', ws[i + 1], ws[i + 2], ws[i + 3]) AS g FROM w),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^!]+', '', 'g')) AS bangs,
    len(list_filter(ws, lambda x: lower(x) IN ({STOPS}))) AS stops,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS capitals,
    length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters, greatest(len(ls), 1) AS n_lines,
    len(list_filter(ls, lambda x: length(x) - length(replace(x, ' | ', '')) > 0.05 * 3 * length(x))) AS tables
    FROM d LEFT JOIN r USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    greatest(n_words, 1) AS n FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n BETWEEN 2 AND 15 AND n_symbols / n <= 0.1 AND bangs / n <= 0.3
    AND stops / n >= 0.02 AND capitals / greatest(letters, 1) <= 0.4 AND tables / n_lines <= 0.5
    AND n_dup_lines / n_lines <= 0.6 AS kept
FROM j"""


@query("op6_quality_rules", SQL_RULES)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept")


@query("op8_sharding")
def shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_packing")
def packing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_bpe")
def bpe_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def _fitted(spark: SparkSession, sf_dir: str, label: str, folds: int, held_out: int, fit):
    """The model of the labelled sample outside the fold `held_out`."""
    train = samples.fold(F.col("doc_id"), folds) != held_out
    return fit(samples.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                       label, train))


def fitted_quality(spark: SparkSession, sf_dir: str) -> quality.Trees:
    return _fitted(spark, sf_dir, "quality", 5, 0, quality.fit_quality)


def fitted_toxicity(spark: SparkSession, sf_dir: str) -> toxicity.Linear:
    return _fitted(spark, sf_dir, "toxic", 3, 1, toxicity.fit_toxicity)


def _held_out(folds: int, fold: int) -> Column:
    return F.coalesce(samples.fold(F.col("doc_id"), folds) == fold, F.lit(False)).alias("held_out")


@query("op1_quality_classifier")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _held_out(5, 0), "text")
    return quality.score_quality(docs, fitted_quality(spark, sf_dir)).drop("text")


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _held_out(3, 1), "text")
    return toxicity.score_toxicity(docs, fitted_toxicity(spark, sf_dir)).drop("text")


@query("op7_html_extraction")
def html_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_text(pages, html.fit_weights(pages))


@query("op5_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                              pieces=fingerprints.content_digests)


@query("op4_jaccard_join")
def near_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_shingles", "component_id")


@query("op11_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencounts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


SQL_TRIE = """
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, xor(list_reduce([4294967295::BIGINT]
      || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda a, b: list_reduce([xor(a, b)] || list_transform(range(8), lambda i: 0::BIGINT),
        lambda v, w: xor(v >> 1, (v & 1) * 3988292384))), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM o)),
b AS (SELECT cs.c, o.pos AS i, r, t FROM cs JOIN o ON o.c = cs.c - cs.c % 5 AND o.pos < cs.h),
k AS (SELECT cs.c, cs.h, count(b.i) AS k FROM cs LEFT JOIN b ON b.c = cs.c GROUP BY ALL),
u AS (SELECT * FROM b UNION ALL
  SELECT c, k + pos - h, r, t FROM o JOIN k USING (c) WHERE pos >= h),
m AS (SELECT c, i + 1 AS d, strlen(t) AS size, md5(string_agg(md5(r) || md5(t), '') OVER w) AS key,
    coalesce(md5(string_agg(md5(r) || md5(t), '') OVER (PARTITION BY c ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), '') AS up,
    count(*) OVER (PARTITION BY c) AS turns
  FROM u WINDOW w AS (PARTITION BY c ORDER BY i)
  UNION ALL SELECT c, 0, 0, '', NULL, (SELECT count(*) FROM u WHERE u.c = cs.c) FROM cs),
n AS (SELECT d, key, min(c) AS conv_id, min(up) AS up, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = turns), '')) AS ends_sha256
  FROM m GROUP BY d, key),
j AS (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(x.n, 0) AS n_children FROM n
  LEFT JOIN n p ON p.d = n.d - 1 AND p.key = n.up
  LEFT JOIN (SELECT d - 1 AS d, up AS key, count(*) AS n FROM n GROUP BY ALL) x ON x.d = n.d AND x.key = n.key),
s AS (SELECT m.d, m.key, count(*) FILTER (WHERE j.n_children = 0) AS n_leaves, sum(j.saved) AS saved_tokens
  FROM j JOIN m ON m.c = j.conv_id AND m.d <= j.d GROUP BY ALL)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, ends_sha256 FROM j JOIN s USING (d, key)"""


@query("op12_conversation_trie", SQL_TRIE)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


SQL_PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, ws, unnest(range(len(ws) - k + 1)) AS i FROM w, range(1, 4) x(k) WHERE len(ws) >= k),
f AS (SELECT lang, k AS words, array_to_string(ws[i + 1:i + k], ' ') AS phrase, count(*) AS n
  FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS s FROM f WHERE words >= 2 AND n >= 10),
q AS (SELECT lang, unnest([s[1] || ' ' || s[2], s[2] || ' ' || s[3]]) AS phrase, a FROM c WHERE words = 3),
m AS (SELECT lang, phrase, max(a) AS longest FROM q GROUP BY ALL),
j AS (SELECT c.* FROM c LEFT JOIN m USING (lang, phrase)
  WHERE words = 3 OR coalesce(100 * longest < 50 * a, true)),
u AS (SELECT j.*, k, array_to_string(s[:k], ' ') AS x, array_to_string(s[k + 1:], ' ') AS y
  FROM j, range(1, 3) z(k) WHERE k < words),
v AS (SELECT u.lang, u.phrase, a, k, fl.n AS l, fr.n AS r,
    1000000::HUGEINT * a * a // (fl.n::HUGEINT * fr.n) AS score
  FROM u JOIN f fl ON fl.lang = u.lang AND fl.phrase = x AND fl.words = k
  JOIN f fr ON fr.lang = u.lang AND fr.phrase = y AND fr.words = u.words - k),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN t USING (lang) WHERE rank <= 2000"""


@query("op13_phrases", SQL_PHRASES)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
