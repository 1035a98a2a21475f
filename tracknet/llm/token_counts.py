"""Exact token counts from a length histogram.

Documents are counted by their encoded length: one pre-aggregated ``groupBy``,
after which nothing depends on the number of documents. Suffix sums over the
histogram then answer every question about lengths: how many documents and
tokens there are, any quantile, and for every context limit how many tokens
remain when documents are cut at it. Between two lengths of the histogram the
truncated total is linear, so the rows hold the answer for all limits.

The suffix sums run in two levels: sums of blocks of 1024 lengths, then a
window inside each block, so no window holds all lengths.

Defined results: a null text is empty and counts with length 0; repeated rows
count each; an empty table has an empty histogram, totals 0 and null quantiles.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracknet.llm import bpe
from tracknet.plans.iterate import cut

BLOCK = 1024


def length_histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    """``(n_tokens, n_docs)`` from one row per document."""
    return lengths.groupBy(F.col(col).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length: ``n_docs`` of it, ``docs_from``/``tokens_from`` of documents
    at least so long, ``docs_below``/``tokens_below`` of shorter ones, and
    ``tokens_at_limit``, the total if every document is cut at this length."""
    h = histogram.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("_tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_bd"), F.sum("_tokens").alias("_bt"))
    # one row per 1024 lengths: bounded by the longest document, not by their number
    over = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = blocks.select("_block", F.coalesce(F.sum("_bd").over(over), F.lit(0)).alias("_ld"), F.coalesce(F.sum("_bt").over(over), F.lit(0)).alias("_lt"),
                          F.sum("_bd").over(whole).alias("_ad"), F.sum("_bt").over(whole).alias("_at"))
    inside = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    s = h.join(later, "_block")
    docs_from, tokens_from = F.sum("n_docs").over(inside) + F.col("_ld"), F.sum("_tokens").over(inside) + F.col("_lt")
    s = s.select("n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "_ad", "_at")
    return s.select("n_tokens", "n_docs", "docs_from", "tokens_from", (F.col("_ad") - F.col("docs_from")).alias("docs_below"),
                    (F.col("_at") - F.col("tokens_from")).alias("tokens_below"),
                    (F.col("_at") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("tokens_at_limit"))


def truncated_totals(sums: DataFrame, limits: DataFrame, col: str = "limit") -> DataFrame:
    """``(limit, total)``: tokens left when every document is cut at the limit.
    The first length at or above a limit decides: all shorter documents whole,
    the others ``limit`` tokens each."""
    total = sums.agg(F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0)).alias("t")).scalar()
    most = sums.agg(F.coalesce(F.max("n_tokens"), F.lit(-1)).cast("bigint").alias("m")).scalar()
    # no more places than lengths up to the longest: a block has at most BLOCK of them, however many limits there are
    asked = limits.select(F.col(col).cast("bigint").alias("limit")).filter("limit IS NOT NULL") \
        .withColumn("_at", F.least(F.greatest("limit", F.lit(0).cast("bigint")), most + 1))
    none = F.lit(None).cast("bigint")
    marks = sums.select(F.col("n_tokens").cast("bigint").alias("_at"), F.lit(False).alias("_asked"), F.struct(F.col("docs_from").alias("d"), F.col("tokens_below").alias("b")).alias("_l")) \
        .unionByName(asked.select("_at").distinct().select("_at", F.lit(True).alias("_asked"), F.when(F.lit(False), F.struct(none.alias("d"), none.alias("b"))).alias("_l")))
    marks = marks.withColumn("_block", F.floor(F.col("_at") / BLOCK))
    inside = Window.partitionBy("_block").orderBy("_at", F.desc("_asked")).rowsBetween(0, Window.unboundedFollowing)
    after = Window.orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    blocks = marks.groupBy("_block").agg(F.min_by("_l", F.when(~F.col("_asked"), F.col("_at"))).alias("_f"))
    later = blocks.select("_block", F.first("_f", ignorenulls=True).over(after).alias("_later"))
    found = marks.select("_block", "_at", "_asked", F.first("_l", ignorenulls=True).over(inside).alias("_here")).filter("_asked") \
        .join(later, "_block").select("_at", F.coalesce("_here", "_later").alias("_l"))
    return asked.join(found, "_at").select("limit", F.coalesce(F.col("_l.b") + F.col("limit") * F.col("_l.d"), total).alias("total"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """``(n_tokens)``: the smallest length that at least the share ``q`` of the documents does not exceed."""
    share = (F.col("docs_below") + F.col("n_docs")) / (F.col("docs_below") + F.col("docs_from"))
    return sums.filter(share >= q).agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text") -> DataFrame:
    """The suffix sums of the documents' encoded lengths. The histogram is
    written once, as both levels of sums read it: every text is encoded once."""
    return suffix_sums(cut(length_histogram(bpe.count_tokens(docs, path, pattern, text_col=text_col))))
