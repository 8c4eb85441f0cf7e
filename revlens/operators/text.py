"""Review-text mining: tokens, stop words, word counts, repetition, word-rating links.

Tokenising is SQL (``regexp_extract_all``), so it runs inside whole-stage
codegen and the same expression can be written for DuckDB.  Counting is
``explode`` + a map-side-combined aggregate, so a very frequent word never
concentrates raw rows in one task.  Whole texts are processed; nothing is
truncated.
"""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .aggregate import order_desc_limit

# Word characters of Java's default (ASCII) \W class: splitting on \W and
# keeping non-empty pieces equals extracting maximal runs of this class.
WORD_RUN = "[A-Za-z0-9_]+"


@lru_cache(maxsize=None)
def default_stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list (the list StopWordsRemover uses).  Without a session, as when
    only the SQL of a query is asked for, it is read from the Spark ML jar."""
    if SparkSession.getActiveSession() is not None:
        return tuple(StopWordsRemover.loadDefaultStopWords(language))
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if not jars:
        raise RuntimeError("no Spark session and no Spark ML jar to read the stop words from")
    with zipfile.ZipFile(jars[0]) as z:
        raw = z.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt").decode("utf-8")
    return tuple(w for w in raw.split("\n") if w)


def tokens(text: str | Column) -> Column:
    """Lower-cased word tokens (RegexTokenizer with pattern \\W, gaps, lower case)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(WORD_RUN), F.lit(0))


def tokenize(df: DataFrame, text_col: str, out: str = "words") -> DataFrame:
    return df.withColumn(out, tokens(text_col))


def without_stop_words(words: str | Column, stop_words=None, lowercase: bool = True) -> Column:
    """Drop stop words, keep order and repeats (case-insensitive like
    StopWordsRemover; ``lowercase=False`` skips the case fold for tokens that
    are lower-cased already)."""
    w = F.col(words) if isinstance(words, str) else words
    stop = list(stop_words) if stop_words is not None else list(default_stop_words())
    return F.filter(w, (lambda x: ~F.lower(x).isin(stop)) if lowercase else (lambda x: ~x.isin(stop)))


def remove_stopwords(df: DataFrame, words_col: str = "words", out: str = "filtered_words",
                     stop_words=None) -> DataFrame:
    return df.withColumn(out, without_stop_words(words_col, stop_words))


def keywords(df: DataFrame, text_col: str, *carry: str, stop_words=None, out: str = "word") -> DataFrame:
    """One row per non-stop-word token of the text, with the ``carry`` columns.

    Tokens are exploded first and then filtered, so the stop-word test is compiled (a lambda over the
    array is not) and no filtered array is built.
    """
    stop = list(stop_words) if stop_words is not None else list(default_stop_words())
    return df.select(*carry, F.explode(tokens(text_col)).alias(out)).filter(~F.col(out).isin(stop))


def word_freq(df: DataFrame, text_col: str, k: int | None = 100, stop_words=None) -> DataFrame:
    """Most frequent non-stop-word tokens, ties by word."""
    agg = keywords(df, text_col, stop_words=stop_words).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return order_desc_limit(agg, "count", "word", k)


def cloud_words(df: DataFrame, text_col: str, k: int = 100, stop_words=None) -> DataFrame:
    """Word-cloud weights, count relative to the most frequent word."""
    top = word_freq(df, text_col, k, stop_words)
    peak = top.agg(F.max("count")).scalar()
    return top.select("word", "count", (F.col("count") / peak).alias("weight"))


#: Words that a task's summary follows; counts are off by less than SUMMARY_ERROR * all words / followed words.
FOLLOWED_WORDS, SUMMARY_ERROR = 65_536, 3.5


def heavy_words(df: DataFrame, text_col: str, k: int = 100, stop_words=None, followed: int = FOLLOWED_WORDS) -> DataFrame:
    """N3/T3 without shuffling the vocabulary: exactly ``word_freq``.

    A first pass keeps a summary of bounded size for each task (frequent items, merged) whose words are the candidates; a second one
    counts the candidates exactly, so a task sends ``followed`` rows at most, whatever the vocabulary.  A word that is no candidate
    occurs less often than the summary's error; where the k-th candidate does not pass that (flat counts, few words), all
    words are counted as ``word_freq`` does.  Runs both passes' jobs to decide.
    """
    words = keywords(df, text_col, stop_words=stop_words)
    # the summary can list 100,000 words at most
    found = words.agg(F.expr(f"approx_top_k(word, {min(followed, 100_000)}, {followed})").alias("top"), F.count("*").alias("n"))
    head = found.select("n", F.transform("top", lambda x: x["item"]).alias("words")).first()
    if not head["n"]:
        return word_freq(df, text_col, k, stop_words)
    candidates = df.sparkSession.createDataFrame([(w,) for w in head["words"]], "word string")
    counted = words.join(candidates, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    top = order_desc_limit(counted, "count", "word", k)
    last = top.collect()
    least = last[-1]["count"] if len(last) == k else 0
    if least <= SUMMARY_ERROR * head["n"] / followed:
        return word_freq(df, text_col, k, stop_words)
    return top


def _stem(word: Column) -> Column:
    """A word without its plural s: what ends in one s (not two) loses it."""
    plural = word.endswith("s") & ~word.endswith("ss") & (F.length(word) > 1)
    return F.when(plural, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def _folded(counts: DataFrame, out: str, *first: Column) -> DataFrame:
    """(stem, ``out``, count) from (word, count): a plural is counted with its singular where that occurs too.  A stem
    has two words at most, so one aggregate folds them, without matching words with each other."""
    stem = _stem(F.col("word"))
    return (counts.groupBy(stem.alias("stem"), *first)
            .agg(F.sum("count").alias("count"), F.max(F.col("word") == stem).alias("_single"))
            .select("stem", *first, "count", F.when(F.col("_single"), F.col("stem")).otherwise(F.concat("stem", F.lit("s"))).alias(out)))


def _unlikely(k: Column, n: Column, x: Column) -> Column:
    """Log-likelihood of k hits in n tries at the rate x."""
    low = F.lit(1e-10)
    return F.log(F.greatest(x, low)) * k + F.log(F.greatest(1 - x, low)) * (n - k)


def collocations(df: DataFrame, text_col: str, stop_words=None, min_score: float = 30.0) -> DataFrame:
    """Neighbouring words that stand together more often than their counts explain, with Dunning's log-likelihood ratio.

    (word1, word2, count, score) for pairs of neighbouring tokens, neither a stop word, with a score above ``min_score``; plurals are
    counted with their singulars, of the words and of the second word of a pair.  Pairs come from the token array
    of a text, so no text is joined with itself; what is shuffled are counts of words and of pairs.
    """
    words, pairs = _words_and_pairs(df, text_col, stop_words)
    return _scored(words, pairs, min_score).select("word1", "word2", "count", "score")


def _words_and_pairs(df: DataFrame, text_col: str, stop_words) -> tuple[DataFrame, DataFrame]:
    stop = list(stop_words) if stop_words is not None else list(default_stop_words())
    words = _folded(word_freq(df, text_col, None, stop), "word")
    t = F.col("_t")
    both = (df.select(tokens(text_col).alias("_t")).filter(F.size(t) > 1)
            .select(F.explode(F.arrays_zip(F.slice(t, 1, F.size(t) - 1).alias("a"), F.slice(t, 2, F.size(t) - 1).alias("b"))).alias("p"))
            .select(F.col("p.a").alias("word1"), F.col("p.b").alias("word")).filter(~F.col("word1").isin(stop) & ~F.col("word").isin(stop))
            .groupBy("word1", "word").agg(F.count(F.lit(1)).alias("count")))
    return words, _folded(both, "word2", F.col("word1"))


def _scored(words: DataFrame, pairs: DataFrame, min_score: float) -> DataFrame:
    total = words.agg(F.sum("count")).scalar().cast("double")
    own = lambda n: words.select(F.col("stem").alias(f"stem{n}"), F.col("count").cast("double").alias(f"c{n}"))
    known = (pairs.withColumn("stem1", _stem(F.col("word1"))).withColumnRenamed("stem", "stem2")
             .join(own(1), "stem1").join(own(2), "stem2"))
    k, c1, c2 = F.col("count").cast("double"), F.col("c1"), F.col("c2")
    p, p1, p2 = c2 / total, k / c1, F.coalesce(F.try_divide(c2 - k, total - c1), F.lit(0.0))
    score = -2 * (_unlikely(k, c1, p) + _unlikely(c2 - k, total - c1, p) - _unlikely(k, c1, p1) - _unlikely(c2 - k, total - c1, p2))
    return known.withColumn("score", score).filter(F.col("score") > min_score)


def cloud_terms(df: DataFrame, text_col: str, k: int = 100, stop_words=None, min_score: float = 30.0) -> DataFrame:
    """N6 with collocations: the ``k`` most frequent words and pairs, weights relative to the most frequent one.

    A pair that is a collocation is a term of its own, and its occurrences are taken off both of its words.
    """
    words, pairs = _words_and_pairs(df, text_col, stop_words)
    found = _scored(words, pairs, min_score)
    taken = (found.select(F.explode(F.array("stem1", "stem2")).alias("stem"), "count").groupBy("stem").agg(F.sum("count").alias("_taken")))
    left = words.join(taken, "stem", "left").select(F.col("word").alias("term"), (F.col("count") - F.coalesce("_taken", F.lit(0))).alias("count"))
    terms = left.filter("count > 0").unionByName(found.select(F.concat_ws(" ", "word1", "word2").alias("term"), "count"))
    top = order_desc_limit(terms, "count", "term", k)
    peak = top.agg(F.max("count")).scalar()
    return top.select("term", "count", (F.col("count") / peak).alias("weight"))


def word_repetition(df: DataFrame, text_col: str, key: str, k: int | None = 5) -> DataFrame:
    """Words / distinct words per text (space split), highest first."""
    parts = F.split(F.col(text_col), " ")
    out = (df.filter(F.col(text_col).isNotNull())
             .select(key, F.size(parts).alias("word_count"),
                     F.size(F.array_distinct(parts)).alias("unique_word_count")))
    out = out.withColumn("word_repetition_ratio", F.col("word_count") / F.col("unique_word_count"))
    return order_desc_limit(out, "word_repetition_ratio", key, k)


def word_sentiment(df: DataFrame, text_col: str, rating: str, min_count: int = 50) -> DataFrame:
    """Average rating and occurrences per space-split word (case kept,
    empty string counts), words seen more than ``min_count`` times."""
    w = df.select(F.col(rating), F.explode(F.split(F.col(text_col), " ")).alias("word"))
    agg = w.groupBy("word").agg(F.avg(rating).alias("avg_rating"), F.count("word").alias("word_count"))
    return agg.filter(F.col("word_count") > min_count).orderBy(F.col("avg_rating").desc(), "word")
