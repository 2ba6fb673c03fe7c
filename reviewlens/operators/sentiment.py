"""Sentiment by naive Bayes, trained and applied with joins and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import patterns as P
from ..functions.texts import delete_other
from ..session import freeze
from .words import Splitter, split_runs

# At most this many weights are broadcast, of tokens up to this many bytes: some 100 MB in memory.
HOT_TOKENS = 500_000
HOT_TOKEN_BYTES = 64
SALTS = 16


def fit_nb(
    labelled: DataFrame, text: str, label: str, keep: str = P.KEEP_MIXED, splitter: Splitter = split_runs
) -> DataFrame:
    """(token, n_pos, n_neg): how often a token occurs in texts labelled 1 and in texts labelled 0. Frozen: scoring reads it often."""
    words = labelled.where(F.col(label).isin(0, 1)).select(
        F.col(label).alias("label"), F.explode(splitter(delete_other(F.col(text), keep))).alias("token")
    )
    counts = words.groupBy("token").agg(
        F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg")
    )
    return freeze(counts)


def _mass(model: DataFrame) -> Column:
    """Logarithm of the class masses' ratio. A class has one unit per token and one per distinct token."""
    positive = F.sum("n_pos") + F.count_if(F.col("n_pos") > 0)
    negative = F.sum("n_neg") + F.count_if(F.col("n_neg") > 0)
    return model.agg((F.log(positive) - F.log(negative)).alias("mass")).scalar()


def score(
    df: DataFrame,
    model: DataFrame,
    id_col: str,
    text: str,
    keep: str = P.KEEP_MIXED,
    splitter: Splitter = split_runs,
    hot_tokens: int = HOT_TOKENS,
) -> DataFrame:
    """(id_col, probability), one row per text: chance that it is positive, 0.5 for one that is empty once cleaned.

    NULL and '' are left out. Every row is a text of its own, whatever its id. A token seen in neither class
    weighs like one occurrence in both.

    The weights of the ``hot_tokens`` most frequent tokens are broadcast, which their number and length
    bound, and summed where the texts are read. A text's other tokens are shuffled to their weights, each
    token spread over ``SALTS`` keys in case a text table is full of one of them. The plan is the same for any model.
    """
    weights = model.where(F.col("n_pos") != F.col("n_neg")).select(
        "token", (F.log(F.col("n_pos") + 1) - F.log(F.col("n_neg") + 1)).alias("weight"),
        (F.col("n_pos") + F.col("n_neg")).alias("n"),
    )
    short = F.octet_length("token") <= HOT_TOKEN_BYTES
    frequent = weights.where(short).orderBy(F.desc("n"), "token").limit(hot_tokens)
    hot = frequent.select("token", F.col("weight").alias("hot_weight"))
    words = df.where(F.length(text) > 0).select(
        id_col, F.monotonically_increasing_id().alias("__row"), F.col(text).alias("__text")
    ).select(id_col, "__row", F.explode_outer(splitter(delete_other(F.col("__text"), keep))).alias("token"))
    met = words.join(F.broadcast(hot), "token", "left")
    # A text's hot tokens become one row in its task; the others stay apart until they have met their weights.
    parts = met.groupBy(
        "__row", F.when(F.col("hot_weight").isNull(), F.col("token")).alias("token")
    ).agg(F.first(id_col).alias(id_col), F.count("token").alias("n_tokens"), F.sum("hot_weight").alias("hot_weight"))
    cold = weights.join(F.broadcast(hot), "token", "left_anti").select(
        F.col("token").alias("looked_up"), F.col("weight").alias("cold_weight"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    # one branch for all: a row without a token to look up meets nothing, under a key of its own (no token holds a blank)
    keyed = parts.withColumn("salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int")).withColumn(
        "looked_up", F.coalesce("token", F.concat(F.lit(" "), F.col("__row")))
    )
    weighed = keyed.join(cold, ["looked_up", "salt"], "left").select(
        "__row", id_col, "n_tokens", F.coalesce("hot_weight", F.col("cold_weight") * F.col("n_tokens")).alias("weight")
    )
    totals = weighed.groupBy("__row").agg(
        F.first(id_col).alias(id_col), F.sum("n_tokens").alias("n_tokens"), F.sum("weight").alias("weight")
    )
    log_odds = (1 - F.col("n_tokens")) * _mass(model) + F.coalesce("weight", F.lit(0.0))
    return totals.select(
        id_col,
        F.when(F.col("n_tokens") == 0, F.lit(S.NEUTRAL_SCORE))
        .otherwise(1 / (1 + F.exp(-log_odds)))
        .alias("probability"),
    )


def bucket(probability: Column, above: float = S.POSITIVE_ABOVE, below: float = S.NEGATIVE_BELOW) -> Column:
    """Class of an unrounded score; the bounds themselves are neutral."""
    return (
        F.when(probability > above, F.lit(S.POSITIVE))
        .when(probability < below, F.lit(S.NEGATIVE))
        .otherwise(F.lit(S.NEUTRAL))
    )


def with_sentiment(scored: DataFrame) -> DataFrame:
    """Adds ``sentiment`` and ``score``, rounded to 3 places after the class is chosen."""
    return scored.withColumn("sentiment", bucket(F.col("probability"))).withColumn(
        "score", F.bround("probability", 3)
    )


def summary(scored: DataFrame) -> DataFrame:
    """(sentiment, n, percent) with all three classes; percent is NULL when there is nothing."""
    classes = [S.POSITIVE, S.NEUTRAL, S.NEGATIVE]
    counts = scored.agg(*[F.count_if(F.col("sentiment") == c).alias(c) for c in classes])
    total = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    rows = [
        F.struct(
            F.lit(c).alias("sentiment"),
            F.col(c).alias("n"),
            F.bround(F.try_divide(F.col(c) * 100.0, total), 1).alias("percent"),
        )
        for c in classes
    ]
    return counts.select(F.inline(F.array(*rows)))


def average(scored: DataFrame) -> DataFrame:
    """(n, average) of the rounded scores; 0.5 when there are none."""
    return scored.agg(
        F.count("score").alias("n"),
        F.coalesce(F.bround(F.avg("score"), 3), F.lit(S.NEUTRAL_SCORE)).alias("average"),
    )
