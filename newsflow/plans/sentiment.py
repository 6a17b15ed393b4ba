"""Queries of chunking, scoring and the flagship: raw news to lagged daily sentiment."""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates, scores, symbols, text
from newsflow.operators import news, scoring, series
from newsflow.operators.filters import usable_text
from newsflow.plans.cleansing import sql_day, sql_keyword, sql_scrub
from newsflow.plans.features import _AVG, _DAYS, rounded, sql_round
from newsflow.plans.registry import query
from newsflow.plans.views import table, view

# Word lists that occur in the given texts, which are not English news.
LEXICON = scores.Lexicon(
    positive=("the", "of", "les", "der", "los", "with", "est"),
    negative=("and", "to", "un", "die", "que", "was", "pas"),
)
LENGTH, STEP = 128, 64

# As the SQL writes it: . , ; : ! ? " ' ( )
_PUNCT = """.,;:!?"''()"""


def _in(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def sql_words(column: str) -> str:
    return rf"list_filter(string_split_regex({column}, '[ \t\n\r\f]+'), lambda x: x <> '')"


def sql_probabilities(words: str, key: str, source: str, length: int, step: int,
                      only_long: bool = False) -> str:
    """CTEs down to `probs`: positive, neutral and negative of every window of `source`.`words`."""
    starts = f"range(0, len({words}), {step})"
    if only_long:
        starts = f"CASE WHEN len({words}) > {length} THEN {starts} ELSE [0] END"
    def hits(listed):
        return (f"len(list_filter(c, lambda x: trim(lower(x), '{_PUNCT}') IN ({_in(listed)})))"
                f" * {LEXICON.scale} / greatest(len(c), 1)")
    return f"""
starts AS (SELECT {key}, {words} AS w, unnest({starts}) AS s FROM {source} WHERE len({words}) > 0),
cuts AS (SELECT {key}, s, w[s + 1:s + {length}] AS c FROM starts),
logits AS (SELECT {key}, s, {hits(LEXICON.positive)} AS lp, 1.0::DOUBLE AS lu,
  {hits(LEXICON.negative)} AS ln FROM cuts),
powers AS (SELECT {key}, s, exp(lp - greatest(lp, lu, ln)) AS ep, exp(lu - greatest(lp, lu, ln)) AS eu,
  exp(ln - greatest(lp, lu, ln)) AS en FROM logits),
probs AS (SELECT {key}, s, ep / (ep + eu + en) AS positive, eu / (ep + eu + en) AS neutral,
  en / (ep + eu + en) AS negative FROM powers)"""


def documents(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


_DOCS = f"docs AS (SELECT doc_id, {sql_words('text')} AS words FROM documents)"
_PROBS = f"WITH {_DOCS},{sql_probabilities('words', 'doc_id', 'docs', LENGTH, STEP)}"


@query("chunk_sliding", f"""
WITH {_DOCS}, starts AS (SELECT doc_id, words, unnest(range(0, len(words), {STEP})) AS s FROM docs)
SELECT doc_id, CAST(s // {STEP} AS INTEGER) AS chunk_no,
  array_to_string(words[s + 1:s + {LENGTH}], ' ') AS chunk FROM starts""")
def chunk_sliding(spark, d) -> DataFrame:
    return scoring.chunk_sliding(documents(spark, d), "text", LENGTH, STEP)


@query("chunk_special_tokens", f"""
WITH {_DOCS}, starts AS (SELECT doc_id, words, unnest(range(0, len(words) + 2, {STEP})) AS s FROM docs)
SELECT doc_id, CAST(s // {STEP} AS INTEGER) AS chunk_no, array_to_string(
  words[greatest(s - 1, 0) + 1:least(s - 1 + {LENGTH - 2}, len(words))], ' ') AS chunk FROM starts""")
def chunk_special_tokens(spark, d) -> DataFrame:
    return scoring.chunk_sliding(documents(spark, d), "text", LENGTH - 2, STEP, lead=1, trail=1)


@query("chunk_if_long", f"""
WITH {_DOCS.replace('SELECT doc_id', 'SELECT doc_id, text')}, starts AS (SELECT doc_id, text, words,
  unnest(CASE WHEN len(words) > {LENGTH} THEN range(0, len(words), {STEP}) ELSE [0] END) AS s FROM docs)
SELECT doc_id, CAST(s // {STEP} AS INTEGER) AS chunk_no, CASE WHEN len(words) > {LENGTH}
  THEN array_to_string(words[s + 1:s + {LENGTH}], ' ') ELSE text END AS chunk FROM starts""")
def chunk_if_long(spark, d) -> DataFrame:
    return scoring.chunk_if_long(documents(spark, d), "text", LENGTH, STEP)


@query("chunk_head", f"""
WITH {_DOCS} SELECT doc_id, array_to_string(words[1:{LENGTH}], ' ') AS chunk FROM docs""")
def chunk_head(spark, d) -> DataFrame:
    return scoring.chunk_head(documents(spark, d), "text", LENGTH).drop("text")


@query("softmax", f"""
{_PROBS} SELECT doc_id, CAST(s // {STEP} AS INTEGER) AS chunk_no,
  {', '.join(sql_round(c, c) for c in scores.LABELS)} FROM probs""")
def softmax(spark, d) -> DataFrame:
    return rounded(chunk_probabilities(spark, d), list(scores.LABELS))


def chunk_probabilities(spark, d) -> DataFrame:
    """One row of probabilities per window of a document."""
    p = scores.lexicon_scores(F.col("text"), LEXICON, LENGTH, STEP)
    rows = documents(spark, d).select("doc_id", F.posexplode(p).alias("chunk_no", "p"))
    return rows.select("doc_id", "chunk_no",
                       *[F.col("p")[i].alias(label) for i, label in enumerate(scores.LABELS)])


@query("chunk_mean", f"""
{_PROBS} SELECT doc_id, {', '.join(sql_round(f'avg({c})', c) for c in scores.LABELS)}
FROM probs GROUP BY doc_id""")
def chunk_mean(spark, d) -> DataFrame:
    labels = list(scores.LABELS)
    return rounded(scoring.chunk_means(chunk_probabilities(spark, d), ["doc_id"], labels), labels)


@query("document_mean", f"""
{_PROBS} SELECT doc_id, {', '.join(sql_round(f'avg({c})', c) for c in scores.LABELS)}
FROM probs GROUP BY doc_id""")
def document_mean(spark, d) -> DataFrame:
    """The same means without chunk rows: windows stay in the row, so nothing is shuffled."""
    means = scores.mean_scores(scores.lexicon_scores(F.col("text"), LEXICON, LENGTH, STEP))
    found = usable_text(documents(spark, d), "text").select("doc_id", means.alias("m"))
    return rounded(scoring.expand_struct(found, "m"), list(scores.LABELS))


_TOP = """top AS (SELECT doc_id, greatest(positive, neutral, negative) AS score,
  CASE WHEN positive >= neutral AND positive >= negative THEN 'positive'
    WHEN neutral >= negative THEN 'neutral' ELSE 'negative' END AS label FROM probs)"""
_TOP_MEANS = ", ".join(
    sql_round(f"coalesce(avg(CASE WHEN label = '{c}' THEN score END), 0)", c) for c in scores.LABELS)


@query("chunk_top1_mean", f"{_PROBS}, {_TOP} SELECT doc_id, {_TOP_MEANS} FROM top GROUP BY doc_id")
def chunk_top1_mean(spark, d) -> DataFrame:
    p = F.array(*scores.LABELS)
    tops = chunk_probabilities(spark, d).select(
        "doc_id", F.initcap(scores.top_label(p)).alias("label"), F.array_max(p).alias("score"))
    return rounded(scoring.chunk_top1_means(tops, ["doc_id"]), list(scores.LABELS))


_WEIGHTED = """CASE WHEN negative * 1.5 >= neutral AND negative * 1.5 >= positive THEN 'negative'
  WHEN neutral >= positive THEN 'neutral' ELSE 'positive' END"""


@query("weighted_label", f"""
{_PROBS} SELECT doc_id, CAST(s // {STEP} AS INTEGER) AS chunk_no, {_WEIGHTED} AS label FROM probs""")
def weighted_label(spark, d) -> DataFrame:
    label = scores.weighted_label(F.col("negative"), F.col("neutral"), F.col("positive"))
    return chunk_probabilities(spark, d).select("doc_id", "chunk_no", label.alias("label"))


# Plugged-in scorers: the same probabilities by way of Python -------------------------------------

load_scorer = partial(scoring.LexiconScorer, LEXICON)


def _parsed(df: DataFrame) -> DataFrame:
    """JSON scores back to rounded columns."""
    parsed = F.from_json("finbert_sentiment", "positive double, neutral double, negative double")
    out = scoring.expand_struct(df.withColumn("s", parsed), "s").drop("finbert_sentiment")
    return rounded(out, list(scores.LABELS))


@query("scores_json", f"""
{_PROBS} SELECT doc_id, {', '.join(sql_round(f'avg({c})', c) for c in scores.LABELS)}
FROM probs GROUP BY doc_id""")
def scores_json(spark, d) -> DataFrame:
    means = scores.mean_scores(scores.lexicon_scores(F.col("text"), LEXICON, LENGTH, STEP))
    stored = usable_text(documents(spark, d), "text").select(
        "doc_id", scores.scores_json(means).alias("finbert_sentiment"))
    return _parsed(stored)


_ALL_MEANS = f"""
{_PROBS}, means AS (SELECT doc_id, {', '.join(f'avg({c}) AS {c}' for c in scores.LABELS)}
  FROM probs GROUP BY doc_id)
SELECT doc_id, lang, {', '.join(sql_round(c, c) for c in scores.LABELS)}, CAST(NULL AS VARCHAR) AS error
FROM documents LEFT JOIN means USING (doc_id)"""


@query("score_map_partitions", _ALL_MEANS)
def score_map_partitions(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return _parsed(scoring.score_map(docs, "text", load_scorer, LENGTH, STEP)).drop("text")


class WordPieces(scoring.LexiconScorer):
    """A sub-word tokeniser: pieces of five characters, those within a word marked by `##`."""

    def tokenise(self, text: str) -> list[str]:
        words = [w for w in re.split("[ \\t\\n\\r\\f]+", text) if w]
        return [w[i:i + 5] if not i else f"##{w[i:i + 5]}" for w in words for i in range(0, len(w), 5)]

    def decode(self, ids: list[str]) -> str:
        return " ".join(ids).replace(" ##", "")


_PIECES = f"""
WITH docs AS (SELECT doc_id, {sql_words('text')} AS words FROM documents),
pieces AS (SELECT doc_id, flatten(list_transform(words, lambda w: list_transform(range(0, len(w), 5),
  lambda i: CASE WHEN i = 0 THEN '' ELSE '##' END || substring(w, i + 1, 5)))) AS p FROM docs),
wins AS (SELECT doc_id, win, string_split(replace(array_to_string(p[win + 1:win + {LENGTH}], ' '), ' ##', ''), ' ') AS words
  FROM (SELECT *, unnest(range(0, greatest(len(p) - {LENGTH}, 0) + {STEP}, {STEP})) AS win FROM pieces)
  WHERE win < len(p)),{sql_probabilities('words', 'doc_id, win', 'wins', 1 << 30, 1 << 30)},
means AS (SELECT doc_id, {', '.join(f'avg({c}) AS {c}' for c in scores.LABELS)} FROM probs GROUP BY doc_id)
SELECT doc_id, {', '.join(sql_round(c, c) for c in scores.LABELS)}, CAST(NULL AS VARCHAR) AS error
FROM documents LEFT JOIN means USING (doc_id)"""


@query("score_tokens", _PIECES)
def score_tokens(spark, d) -> DataFrame:
    load = partial(WordPieces, LEXICON)
    return _parsed(scoring.score_tokens(documents(spark, d), "text", load, LENGTH, STEP)).drop("text")


class FailingScorer(scoring.LexiconScorer):
    """Cannot score windows with the word `stupid`, to show what becomes of their texts."""

    def __call__(self, texts: list[str]):
        if any("stupid" in t.split() for t in texts):
            raise ValueError("cannot score this")
        return super().__call__(texts)


@query("score_errors", """
SELECT doc_id, CASE WHEN list_contains(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '),
  'stupid') THEN 'ValueError: cannot score this' END AS error,
  NOT list_contains(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), 'stupid') AS scored
FROM documents""")
def score_errors(spark, d) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text")
    found = scoring.score_map(docs, "text", partial(FailingScorer, LEXICON), LENGTH, STEP)
    return found.select("doc_id", "error", F.col("finbert_sentiment").isNotNull().alias("scored"))


@query("score_map_top1", f"""
{_PROBS}, {_TOP} SELECT doc_id, {_TOP_MEANS}, CAST(NULL AS VARCHAR) AS error FROM top GROUP BY doc_id""")
def score_map_top1(spark, d) -> DataFrame:
    docs = usable_text(documents(spark, d), "text")
    return _parsed(scoring.score_map(docs, "text", load_scorer, LENGTH, STEP, top1=True)).drop("text")


@query("score_pandas_udf", _ALL_MEANS)
def score_pandas_udf(spark, d) -> DataFrame:
    chunks = scoring.document_chunks(F.col("text"), LENGTH, STEP)
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    found = scoring.add_scores(docs, chunks, load_scorer, "s").drop("text")
    return rounded(scoring.expand_struct(found, "s"), list(scores.LABELS))


_STRUCT_PROBS = f"WITH {_DOCS},{sql_probabilities('words', 'doc_id', 'docs', LENGTH, STEP, True)}"


@query("score_struct", f"""
{_STRUCT_PROBS}, means AS (SELECT doc_id, {', '.join(f'avg({c}) AS {c}' for c in scores.LABELS)}
  FROM probs GROUP BY doc_id)
SELECT doc_id, {_WEIGHTED} AS sentiment_label,
  {', '.join(sql_round(c, f'{c}_prob') for c in scores.LABELS)} FROM means""")
def score_struct(spark, d) -> DataFrame:
    found = scoring.score_label(usable_text(documents(spark, d), "text"), "text", load_scorer, LENGTH, STEP)
    return rounded(found.drop("text", "error"), [f"{c}_prob" for c in scores.LABELS])


# Flagship --------------------------------------------------------------------------------------

def scored_news(spark, d) -> DataFrame:
    """News per symbol with dates, scrubbed text and native scores; undated rows are left out."""
    raw = view(spark, d, "news_v").select(
        symbols.keyword_ticker(F.col("keyword")).alias("symbol"),
        "source", "datetime", "headline", "summary")
    stories = news.dedup_news(raw)
    dated = stories.withColumn("date", dates.normalize_date(F.col("datetime"))).filter("date IS NOT NULL")
    clean = dated.select("symbol", "date", text.pick_text(
        text.scrub(F.col("summary")), text.scrub(F.col("headline"))).alias("text"))
    return scoring.score_lexicon(clean, "text", LEXICON)


_FLAGSHIP = f"""
WITH stories AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, datetime, headline
      ORDER BY source NULLS FIRST, summary NULLS FIRST) AS r
    FROM (SELECT {sql_keyword('keyword')} AS symbol, source, datetime, headline, summary FROM news_v))
  WHERE r = 1),
clean AS (SELECT symbol, date, CASE WHEN regexp_matches(summary, '\\S') THEN summary
    ELSE coalesce(headline, '') END AS text, row_number() OVER () AS id FROM (
  SELECT symbol, {sql_day('datetime')} AS date, {sql_scrub('headline')} AS headline,
    {sql_scrub('summary')} AS summary FROM stories) WHERE date IS NOT NULL),
words AS (SELECT *, {sql_words('text')} AS w0 FROM clean),
{sql_probabilities('w0', 'id', 'words', 512, 256).strip()},
means AS (SELECT id, {', '.join(f'avg({c}) AS {c}' for c in scores.LABELS)} FROM probs GROUP BY id),
daily AS (SELECT symbol, date, avg(positive) AS avg_positive, avg(neutral) AS avg_neutral,
    avg(negative) AS avg_negative, count(*) AS news_count
  FROM clean LEFT JOIN means USING (id) GROUP BY symbol, date)
SELECT symbol, date, {', '.join(sql_round(c, c) for c in _AVG)}, news_count,
  {', '.join(sql_round(f'lag({c}) {_DAYS})', f'lag_{c}') for c in _AVG)},
  lag(news_count) {_DAYS}) AS lag_news_count FROM daily"""


@query("news_to_features", _FLAGSHIP, "news_v")
def news_to_features(spark, d) -> DataFrame:
    lagged = series.add_lags(series.daily_sentiment(scored_news(spark, d)))
    return rounded(lagged, _AVG + [f"lag_{c}" for c in _AVG])
