"""Text similarity of product descriptions."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.ids import with_integer_ids
from tillroll.functions.skew import join_counted
from tillroll.functions.text import words
from tillroll.operators.pairs import BLOCK_ROWS, nearest_rows
from tillroll.session import durable


def english_stop_words() -> list[str]:
    """Spark's own English list; every operator takes another as an argument."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tfidf(
    texts: DataFrame, key: str, text: str, stop_words: list[str] | None = None, numbered: bool = False
) -> DataFrame:
    """TF-IDF weights of unit length per text: ``(key, token, tf, df, weight)``.

    ``idf = ln((1 + texts) / (1 + df)) + 1``.  ``key`` must be unique.  Texts are exchanged whole, which takes less than
    their words, and cut into words once, where they lie; the counts are stored.  Words that many texts share get their
    figures by broadcast.

    With ``numbered``, for comparing texts, words travel by a number ``token_id`` that stands for ``token``, frequent words first, and
    words of a single text only count for the length. ``raw`` and ``length``, whose quotient ``weight`` is, come along: raw weights
    are alike in many texts, so they take few bytes where texts are sent.
    """
    stop = english_stop_words() if stop_words is None else stop_words
    total = texts.filter(F.col(text).isNotNull()).agg(F.count(F.lit(1)).cast("double")).scalar()
    tf = durable(
        texts.select(F.col(key), F.col(text))
        .repartition(F.col(key))
        .select(F.col(key), F.explode(words(F.col(text))).alias("token"))
        .filter(~F.col("token").isin(stop))
        .groupBy(key, "token")
        .agg(F.count(F.lit(1)).alias("tf")),
        "tf",
    )
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    word = "token_id" if numbered else "token"
    df = durable(with_integer_ids(df, "token", word, first=F.desc("df")) if numbered else df, "df")
    known = join_counted(tf, df, "token", "df", df.agg(F.sum("df")).scalar())
    raw = F.col("tf") * (F.ln((total + 1) / (F.col("df") + 1)) + 1)
    # a text's words travel once, with the counts that weights are made of: weights wouldn't compress, and are made again
    packed = known.groupBy(key).agg(
        F.collect_list(F.struct(word, "tf", "df")).alias("w"), F.sqrt(F.sum(raw * raw)).alias("length")
    )
    parts = [raw.alias("raw"), "length"] if numbered else []
    weights = packed.select(key, "length", F.inline("w")).select(
        key, word, "tf", "df", (raw / F.col("length")).alias("weight"), *parts
    )
    return weights.filter("df > 1") if numbered else weights


def description_tfidf(lines: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """TF-IDF of the distinct descriptions."""
    texts = lines.select("description").filter(F.col("description").isNotNull()).distinct()
    return tfidf(texts.withColumn("text", F.col("description")), "description", "text", stop_words)


def similar_texts(
    weights: DataFrame, key: str, n: int = 5, targets: DataFrame | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The ``n`` texts nearest to each target: ``(key, rank, item, score)``, score in percent.

    A target that is no known text gets no rows.
    """
    if "token_id" in weights.columns:
        near = nearest_rows(weights, key, "token_id", "raw", n, targets, block_rows, numbered_length="length")
    else:
        near = nearest_rows(weights, key, "token", "weight", n, targets, block_rows)
    return near.select(
        key,
        "rank",
        F.col("neighbor").alias("item"),
        F.round(F.round("similarity", 9) * 100, 1).alias("score"),
    )
