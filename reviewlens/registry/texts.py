"""Tokens, keywords, weights and sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import numbers
from ..functions import patterns as P
from ..operators import sentiment, words
from ..session import spread
from .base import ORACLE, query, sql_clean, sql_list, sql_runs, table

STOP = [
    "the", "and", "of", "to", "in", "on", "is", "by", "for", "that", "with",
    "de", "la", "le", "les", "des", "et", "un", "une", "que", "du", "der", "die", "und", "el", "los",
]

CLEAN = sql_clean("text", P.KEEP_LATIN)
WORDS = f"list_filter({sql_runs(CLEAN)}, lambda w: length(w) >= 2 AND w NOT IN ({sql_list(STOP)}))"
TOKENS = f"(SELECT doc_id, unnest({WORDS}) AS token FROM documents)"
OPTIONS = {"keep": P.KEEP_LATIN, "stop": STOP}


def _docs(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


@query(
    f"""
SELECT token, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, token) AS INTEGER) AS rank
FROM {TOKENS} GROUP BY token ORDER BY n DESC, token LIMIT 20
"""
)
def keywords_top(spark, sf):
    return words.keywords(_docs(spark, sf), "text", 20, **OPTIONS)


@query(
    f"""
SELECT token, count(*) AS n FROM {TOKENS} WHERE token NOT IN (SELECT lang FROM documents) GROUP BY token
"""
)
def keywords_without(spark, sf):
    """Stop words from a table: counted first, then anti-joined."""
    stop = table(spark, sf, "documents").select(F.col("lang").alias("token")).distinct()
    counts = words.value_counts(words.tokens(_docs(spark, sf), "text", **OPTIONS), "token")
    return words.without(counts, stop)


@query(
    f"""
WITH c AS (SELECT token, count(*) AS n FROM {TOKENS} GROUP BY token ORDER BY n DESC, token LIMIT 300)
SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS rank,
  round(n / CAST(max(n) OVER () AS DOUBLE), 6) AS weight FROM c
"""
)
def term_weights(spark, sf):
    return words.term_weights(_docs(spark, sf), "text", 300, **OPTIONS).withColumn("weight", F.round("weight", 6))


PAIRS = f"""(SELECT w[i] AS first, w[i + 1] AS second FROM (
  SELECT w, unnest(generate_series(1, len(w) - 1)) AS i FROM (SELECT {WORDS} AS w FROM documents)))"""


@query(
    f"""
WITH c AS (SELECT first, second, count(*) AS n FROM {PAIRS} GROUP BY ALL ORDER BY n DESC, first, second LIMIT 300)
SELECT first, second, n, CAST(row_number() OVER (ORDER BY n DESC, first, second) AS INTEGER) AS rank,
  round(n / CAST(max(n) OVER () AS DOUBLE), 6) AS weight FROM c
"""
)
def term_bigrams(spark, sf):
    return words.term_bigrams(_docs(spark, sf), "text", 300, **OPTIONS).withColumn("weight", F.round("weight", 6))


COLLOCATIONS = f"""
u AS (SELECT token, count(*) AS c FROM {TOKENS} GROUP BY token),
t AS (SELECT CAST(sum(c) AS DOUBLE) AS t FROM u),
p AS (SELECT first, second, count(*) AS n FROM {PAIRS} GROUP BY ALL),
j AS (SELECT first, second, n, CAST(n AS DOUBLE) AS k, CAST(a.c AS DOUBLE) AS c1, CAST(b.c AS DOUBLE) AS c2, t.t AS t
  FROM p JOIN u a ON a.token = first JOIN u b ON b.token = second CROSS JOIN t),
x AS (SELECT *, c2 / t AS p0, k / c1 AS p1, (c2 - k) / (t - c1) AS p2 FROM j),
s AS (SELECT first, second, n, -2 * (
  ln(greatest(p0, 1e-10)) * k + ln(greatest(1 - p0, 1e-10)) * (c1 - k)
  + ln(greatest(p0, 1e-10)) * (c2 - k) + ln(greatest(1 - p0, 1e-10)) * (t - c1 - (c2 - k))
  - ln(greatest(p1, 1e-10)) * k - ln(greatest(1 - p1, 1e-10)) * (c1 - k)
  - ln(greatest(p2, 1e-10)) * (c2 - k) - ln(greatest(1 - p2, 1e-10)) * (t - c1 - (c2 - k))) AS score FROM x),
found AS (SELECT * FROM s WHERE score > 30)
"""


@query(f"WITH {COLLOCATIONS} SELECT first, second, n, round(score, 4) AS score FROM found")
def collocations(spark, sf):
    counts = words.term_counts(_docs(spark, sf), "text", **OPTIONS)
    return words.collocations(counts, 30).withColumn("score", F.round("score", 4))


@query(
    f"""
WITH {COLLOCATIONS},
terms AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT token AS term, c AS n FROM u UNION ALL SELECT first, -n FROM found UNION ALL SELECT second, -n FROM found
    UNION ALL SELECT concat(first, ' ', second), n FROM found) GROUP BY term HAVING sum(n) > 0),
c AS (SELECT * FROM terms ORDER BY n DESC, term LIMIT 300)
SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) AS INTEGER) AS rank,
  round(n / CAST(max(n) OVER () AS DOUBLE), 6) AS weight FROM c
"""
)
def cloud_terms(spark, sf):
    return words.cloud_terms(_docs(spark, sf), "text", 300, 30, **OPTIONS).withColumn("weight", F.round("weight", 6))


# Word parts as a dictionary: runs of letters are cut into the longest of them from the left.
DICTIONARY = ["ing", "tion", "able", "the", "and", "ment", "eau", "eaux", "elle", "that", "th", "er", "on", "re"]
_LONGEST_FIRST = "|".join([*sorted(DICTIONARY, key=len, reverse=True), f"[{P.KEEP_LATIN}]"])


@query(
    f"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all({CLEAN}, '{_LONGEST_FIRST}')) AS token FROM documents)
WHERE length(token) >= 2 GROUP BY token
"""
)
def dict_tokens(spark, sf):
    docs = _docs(spark, sf)
    splitter = words.dictionary_splitter(docs, DICTIONARY)
    return words.value_counts(words.tokens(docs, "text", keep=P.KEEP_LATIN, splitter=splitter), "token")


@query()
def dict_best_path(spark, sf):
    """Words cut along the best route through the frequent short words of the same texts, a dictionary that grows with them."""
    docs = _docs(spark, sf)
    counts = words.value_counts(words.tokens(docs, "text", keep=P.KEEP_LATIN), "token")
    dictionary = counts.where(F.length("token").between(2, 6) & (F.col("n") >= 20)).select(F.col("token").alias("word"), "n")
    return words.value_counts(words.dictionary_tokens(docs, "text", dictionary, keep=P.KEEP_LATIN), "token")


CJK_DIGITS = "零一二三四五六七八九"


@query(
    f"""
WITH r AS (SELECT unnest(regexp_extract_all(translate(CAST(o_orderkey * 7919 AS VARCHAR), '0123456789', '{CJK_DIGITS}'),
  '[{P.CJK}]+')) AS run FROM orders),
g AS (SELECT unnest(CASE WHEN length(run) >= 3
  THEN list_transform(generate_series(1, length(run) - 1), lambda i: substr(run, i, 2)) ELSE [run] END) AS token FROM r)
SELECT token, count(*) AS n FROM g WHERE length(token) >= 2 GROUP BY token
"""
)
def pair_tokens(spark, sf):
    """Chinese runs as overlapping character pairs."""
    digits = (F.col("o_orderkey") * 7919).cast("string")
    texts = table(spark, sf, "orders").select(F.translate(digits, "0123456789", CJK_DIGITS).alias("text"))
    return words.value_counts(words.tokens(texts, "text", splitter=words.split_pairs), "token")


# Naive Bayes in its direct form: log-probabilities per class, one term per token.
ALL_WORDS = sql_runs(CLEAN)
MODEL = f"""
labelled AS (SELECT quality, unnest({ALL_WORDS}) AS token FROM documents JOIN labels USING (doc_id)),
model AS (SELECT token, count(*) FILTER (quality = 1) AS n_pos, count(*) FILTER (quality = 0) AS n_neg
  FROM labelled GROUP BY token)
"""
SCORED = f"""
{MODEL},
mass AS (SELECT CAST(sum(n_pos) + count(*) FILTER (n_pos > 0) AS DOUBLE) AS tp,
  CAST(sum(n_neg) + count(*) FILTER (n_neg > 0) AS DOUBLE) AS tn FROM model),
tok AS (SELECT doc_id, unnest({ALL_WORDS}) AS token FROM documents),
sums AS (SELECT doc_id, sum(ln((coalesce(n_pos, 0) + 1) / tp)) AS lp, sum(ln((coalesce(n_neg, 0) + 1) / tn)) AS ln
  FROM tok LEFT JOIN model USING (token) CROSS JOIN mass GROUP BY doc_id),
prob AS (SELECT d.doc_id, CASE WHEN s.doc_id IS NULL THEN 0.5
    ELSE 1 / (1 + exp((ln(tn) + s.ln) - (ln(tp) + s.lp))) END AS probability
  FROM documents d LEFT JOIN sums s USING (doc_id) CROSS JOIN mass WHERE length(d.text) > 0),
scored AS (SELECT doc_id, probability, CASE WHEN probability > 0.7 THEN '{S.POSITIVE}'
    WHEN probability < 0.3 THEN '{S.NEGATIVE}' ELSE '{S.NEUTRAL}' END AS sentiment,
  round_even(probability, 3) AS score FROM prob)
"""


def _labelled(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return _docs(spark, sf).join(labels, "doc_id")


def _scored(spark, sf, **how):
    model = sentiment.fit_nb(_labelled(spark, sf), "text", "label", keep=P.KEEP_LATIN)
    found = sentiment.score(_docs(spark, sf), model, "doc_id", "text", keep=P.KEEP_LATIN, **how)
    return sentiment.with_sentiment(found)


@query(f"WITH {MODEL} SELECT token, n_pos, n_neg FROM model")
def nb_model(spark, sf):
    return sentiment.fit_nb(_labelled(spark, sf), "text", "label", keep=P.KEEP_LATIN)


@query(f"WITH {SCORED} SELECT doc_id, sentiment, score FROM scored")
def sentiment_score(spark, sf):
    return _scored(spark, sf).drop("probability")


@query(f"WITH {SCORED} SELECT doc_id, sentiment, score FROM scored")
def sentiment_score_split(spark, sf):
    """With few hot tokens, so that most weights are met by the shuffle."""
    return _scored(spark, sf, hot_tokens=1000).drop("probability")


@query(
    f"""
WITH {SCORED}, c AS (SELECT unnest(['{S.POSITIVE}', '{S.NEUTRAL}', '{S.NEGATIVE}']) AS sentiment)
SELECT c.sentiment, count(s.doc_id) AS n,
  round_even(count(s.doc_id) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 1) AS percent
FROM c LEFT JOIN scored s USING (sentiment) GROUP BY c.sentiment
"""
)
def sentiment_summary(spark, sf):
    return sentiment.summary(_scored(spark, sf))


@query(f"SELECT sentiment, n, printf('%.1f%%', percent) AS share FROM ({ORACLE['sentiment_summary']})")
def sentiment_report(spark, sf):
    """The classes as a report prints them: shares as texts with one place."""
    summary = sentiment.summary(_scored(spark, sf))
    return summary.select("sentiment", "n", numbers.fixed_text(F.col("percent"), 1, "%").alias("share"))


@query(f"WITH {SCORED} SELECT count(score) AS n, coalesce(round_even(avg(score), 3), 0.5) AS average FROM scored")
def sentiment_avg(spark, sf):
    return sentiment.average(_scored(spark, sf))


TURN = sql_clean("text", P.KEEP_LATIN)


@query(
    f"""
WITH {MODEL},
mass AS (SELECT CAST(sum(n_pos) + count(*) FILTER (n_pos > 0) AS DOUBLE) AS tp,
  CAST(sum(n_neg) + count(*) FILTER (n_neg > 0) AS DOUBLE) AS tn FROM model),
r AS (SELECT row_number() OVER () AS r, CASE WHEN turn % 3 <> 0 THEN CAST(conv_id % 7 AS VARCHAR) END AS review, text
  FROM conversations WHERE length(text) > 0),
tok AS (SELECT r, unnest({sql_runs(TURN)}) AS token FROM r),
sums AS (SELECT r, sum(ln((coalesce(n_pos, 0) + 1) / tp)) AS lp, sum(ln((coalesce(n_neg, 0) + 1) / tn)) AS ln
  FROM tok LEFT JOIN model USING (token) CROSS JOIN mass GROUP BY r)
SELECT review, round_even(CASE WHEN s.r IS NULL THEN 0.5 ELSE 1 / (1 + exp((ln(tn) + s.ln) - (ln(tp) + s.lp))) END, 3) AS score
FROM r LEFT JOIN sums s USING (r) CROSS JOIN mass
"""
)
def review_scores(spark, sf):
    """One score per row, whatever its id: here ids repeat and every third is NULL."""
    model = sentiment.fit_nb(_labelled(spark, sf), "text", "label", keep=P.KEEP_LATIN)
    review = F.when(F.col("turn") % 3 != 0, (F.col("conv_id") % 7).cast("string")).alias("review")
    turns = table(spark, sf, "conversations").select(review, "text")
    scored = sentiment.with_sentiment(sentiment.score(turns, model, "review", "text", keep=P.KEEP_LATIN))
    return scored.select("review", "score")
