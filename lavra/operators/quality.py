"""Quality of texts: length, repetition, junk characters and language, and the verdict that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import clean_whitespace, let, shingles, words

MIN_CHARS, MIN_CONFIDENCE, MAX_REPETITION, MAX_JUNK = 500, 0.5, 0.7, 0.15
NO_JUNK = r"[^\p{So}\p{Cf}\x{FFFD}\x{FDD0}-\x{FDEF}\x{F0000}-\x{FFFFD}]"
# Frequent words of each language that the others do not have.
PROFILES = {
    "pt": ("uma", "um", "não", "os", "da", "do", "dos", "das", "em", "com", "ao", "pela", "pelo", "nossa", "nosso", "outra", "outro", "cada", "este", "esta", "e", "o", "na", "no"),
    "en": ("the", "of", "and", "our", "another", "each", "this", "with", "an", "by", "under", "while", "for", "to", "is", "are", "in", "from"),
    "es": ("el", "los", "las", "del", "una", "un", "y", "nuestro", "nuestra", "otro", "otra", "este", "esta", "con", "por", "la", "en", "al", "cada"),
    "fr": ("le", "les", "des", "du", "une", "un", "et", "notre", "chaque", "avec", "dans", "ce", "cette", "est", "au", "la", "en", "tout", "par"),
}
BUCKETS = ((500, "<500"), (5000, "500-5000"), (20000, "5000-20000"), (None, ">20000"))


def language_scores(word_list: Column) -> Column:
    """Array of ``(hits, code)`` for each language, the best first; ties go to the code that is last in order."""

    def hits(profile: tuple[str, ...]) -> Column:
        return F.size(F.filter(word_list, lambda w: w.isin(*profile))).alias("hits")

    return F.sort_array(F.array(*[F.struct(hits(p), F.lit(code).alias("code")) for code, p in PROFILES.items()]), asc=False)


def dominant_language(word_list: Column, target: str | None = None, least_share: float = 0.1) -> Column:
    """``struct(lang, confidence)``: the best profile and its share of all hits; null without hits.

    With ``target`` that language is given, with its own share, wherever it has at least ``least_share`` of the hits.
    """

    def found(scores: Column) -> Column:
        total = F.aggregate(scores, F.lit(0), lambda a, s: a + s["hits"])
        best = F.when(total > 0, F.struct(scores[0]["code"].alias("lang"), (scores[0]["hits"] / total).alias("confidence")))
        if target is None:
            return best
        own = F.filter(scores, lambda s: s["code"] == target)[0]["hits"] / total
        return F.when((total > 0) & (own >= least_share), F.struct(F.lit(target).alias("lang"), own.alias("confidence"))).otherwise(best)

    return let(language_scores(word_list), found)


def repetition_ratio(word_list: Column, width: int = 5) -> Column:
    return F.when(F.size(word_list) <= width, 0.0).otherwise(let(shingles(word_list, width), lambda runs: 1 - F.size(F.array_distinct(runs)) / F.size(runs)))


def junk_ratio(text: Column) -> Column:
    return F.when(F.length(text) == 0, 1.0).otherwise(F.length(F.regexp_replace(text, NO_JUNK + "+", "")) / F.length(text))


def quality_verdicts(texts: DataFrame, key: str, text: str, target: str = "pt") -> DataFrame:
    """``key, lang, confidence, char_count, repetition_ratio, junk_ratio, reason`` of every row of ``texts``.

    A null text counts as empty, and texts are measured with their whitespace cleaned; a text without any profile word has neither language
    nor confidence. ``reason`` is null for texts that are kept; the rules are tried in order and all metrics are given in any
    case. Repeated rows stay repeated; no other column is read. One narrow pass of native expressions.
    """
    body = clean_whitespace(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    measured = texts.select(F.col(f"`{key}`").alias("key"), body.alias("body")).withColumn("words", words(F.col("body")))
    measured = measured.select(
        "key",
        F.length("body").alias("char_count"),
        repetition_ratio(F.col("words")).alias("repetition_ratio"),
        junk_ratio(F.col("body")).alias("junk_ratio"),
        dominant_language(F.col("words"), target).alias("found"),
    )
    reason = (
        F.when(F.col("char_count") < MIN_CHARS, "too_short")
        .when(~F.col("found.lang").eqNullSafe(target) | (F.coalesce("found.confidence", F.lit(0.0)) < MIN_CONFIDENCE), "not_portuguese" if target == "pt" else "other_language")
        .when(F.col("repetition_ratio") > MAX_REPETITION, "too_repetitive")
        .when(F.col("junk_ratio") > MAX_JUNK, "too_junky")
    )
    return measured.select(
        F.col("key").alias(key), "found.lang", "found.confidence", "char_count", "repetition_ratio", "junk_ratio", reason.alias("reason")
    )


def length_bucket(count: Column) -> Column:
    """Label of the bucket of a number of characters; buckets hold their lower end."""
    return F.coalesce(*[F.when(count < most, label) if most else F.when(count.isNotNull(), label) for most, label in BUCKETS])


def length_histogram(df: DataFrame, count: str) -> DataFrame:
    """``bucket, texts`` for every bucket, empty ones included; null counts are in none."""
    found = df.select(length_bucket(F.col(count)).alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame([(label,) for _, label in BUCKETS], "bucket string")
    return every.join(found, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("texts"))
