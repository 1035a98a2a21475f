"""URL filters: a blocked Bloom filter in front of an exact hash join.

``judge_urls`` gives each url the verdict of the longest rule that fits it;
where no rule fits, a url is blocked if its canonical form is listed. The
listed canonical urls are packed into a blocked Bloom filter: a table with one
row per 256-bit block, built with ``bit_or`` aggregates, so it is made and
probed in the JVM. A page probes exactly one block. Pages without a hit are
done; possible hits go on to an equi-join with the list itself, which removes
the false positives, so the verdict is exact whatever the filter's error.

Scale: the filter is broadcast while it is under ``broadcast_mb`` (its size is
known from the counted list); beyond that the same probe is a shuffle join on
the block number. The exact join moves only the possible hits.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is never listed (allow). Null or repeated rows of the
list are ignored or count once. Repeated pages are judged one by one. Extra
columns of either table are not read. An empty list blocks nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracknet.plans.iterate import cut, rows

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that only track a visit (fixed values).
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "fbclid", "gclid")
WORDS = 4            # 64-bit words in a block
MAX_RULES = 1000     # rules are compiled into one expression


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, such as ``example.org/es/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, trailing slashes
    and fragment, and the query's parameters sorted without tracking ones;
    null where there is no ``://`` or no host."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule whose host is the url's or a parent domain of it and
    whose path begins the url's path; null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules; list single urls instead")
    fits = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.lit(r.text))
            for r in sorted(rules, key=lambda r: (-len(r.text), r.text))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def _bits(h: Column, word: int) -> Column:
    """Two bits of one 64-bit word of the block, from 12 bits of the key's hash."""
    one = F.lit(1).cast("long")
    a = F.shiftrightunsigned(h, 12 * word).bitwiseAND(F.lit(63)).cast("int")
    b = F.shiftrightunsigned(h, 12 * word + 6).bitwiseAND(F.lit(63)).cast("int")
    shift = lambda n: F.call_function("shiftleft", one, n)
    return shift(a).bitwiseOR(shift(b))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks).cast("long"))


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """``(block, w0..w3)``: the blocks of the filter that hold a key."""
    h = F.xxhash64(F.col(key))
    return (listed.select(_block(F.col(key), blocks).alias("block"), *[_bits(h, w).alias(f"b{w}") for w in range(WORDS)])
            .groupBy("block").agg(*[F.bit_or(f"b{w}").alias(f"w{w}") for w in range(WORDS)]))


def possible_hits(pages: DataFrame, key: str, filter_blocks: DataFrame, blocks: int, small: bool) -> DataFrame:
    """``pages`` rows whose key may be listed (null keys never are)."""
    probe = pages.filter(F.col(key).isNotNull()).withColumn("_block", _block(F.col(key), blocks))
    side = F.broadcast(filter_blocks) if small else filter_blocks
    h = F.xxhash64(F.col(key))
    hit = F.lit(True)
    for w in range(WORDS):
        bits = _bits(h, w)
        hit = hit & (F.col(f"w{w}").bitwiseAND(bits) == bits)
    return probe.join(side, F.col("_block") == F.col("block")).filter(hit).select(*pages.columns)


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url",
               listed_col: str = "url", bits_per_key: int = 16, broadcast_mb: int = 32) -> DataFrame:
    """``(page_id, host, path, rule, verdict, canonical)`` for every page;
    ``listed`` has the blocked urls in any spelling."""
    keys, n = cut(listed.select(canonical_url(F.col(listed_col)).alias("canonical")).filter("canonical IS NOT NULL").distinct(), n=rows())
    url = F.col(url_col)
    host, path = url_host(url), url_path(url)
    judged = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), canonical_url(url).alias("canonical"))
    judged = judged.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    ruled = F.lit(None).cast("string")
    for r in rules:
        ruled = F.when(F.col("rule") == r.text, F.lit(r.verdict)).otherwise(ruled)
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n["n"] * bits_per_key / (64 * WORDS)))))
    small = blocks * 80 <= broadcast_mb << 20
    asked = judged.filter("rule IS NULL AND canonical IS NOT NULL")
    maybe = possible_hits(asked.select("canonical"), "canonical", bloom_blocks(keys, "canonical", blocks), blocks, small)
    # possible hits are folded to distinct urls before they meet the list, so a hot url is one row
    hits = maybe.distinct().join(keys, "canonical", "left_semi").withColumn("listed", F.lit(True))
    open_key = F.when(F.col("rule").isNull(), F.col("canonical"))
    # rows that ask nothing carry a key of their own, so that they do not meet in one task
    spread = F.coalesce(open_key, F.concat(F.lit("://"), F.xxhash64("page_id", "host", "path").cast("string")))
    return (judged.withColumn("_key", spread).join(hits.withColumnRenamed("canonical", "_key"), "_key", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(ruled, F.when(F.col("listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"), "canonical"))
