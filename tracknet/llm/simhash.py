"""Near-duplicate classes by SimHash with multi-index hashing.

A document's fingerprint has 64 bits: each 3-word shingle (A-Z taken as a-z,
repeats included) is hashed with XXH64, and a bit is 1 where more than half of
the hashes have it. Documents link where fingerprints differ in 3 bits or fewer.

Equal fingerprints are folded first. The index cuts a fingerprint into two
segments of 32 bits. Of 3 differing bits at most one lies in one of the two, so
every link is found by looking up, for each segment, the 33 values within one
bit of the own (the Hamming ball) in the table of segment values. A match is
verified on the complete fingerprints.

A segment value that more than ``DENSE`` fingerprints share would give pairs in
the square of their number. Such a value is searched a second time by balls of
its other segment, without pairs: a fingerprint writes its name on every value
within 2 bits of its other segment (529 of them). Two that differ in 3 bits at
most meet at a value which is within 1 bit of one of them. There everything is
linked to the smallest fingerprint within 1 bit, at 3 bits or fewer; so all
classes stay whole and the rows grow with the fingerprints. No value gathers
more than some 1,600 names, whatever the corpus.

Defined results: a null, empty or wordless text has fingerprint 0 and is linked
like any other. One or two words are one shingle. Repeated rows are equal
documents. A null id names a class only where all its ids are null. An empty
table gives no rows. Other columns are not read, whatever their names. A
text's words are held in memory, its hashes in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracknet.llm import words as W
from tracknet.llm.components import components
from tracknet.plans.iterate import cut, rows

SHINGLE = 3
SEED = 42
DISTANCE = 3
HALF = 32
#: A segment value with more fingerprints is searched without pairs.
DENSE = 256
#: Shingles whose hashes are held at a time.
HELD = 1 << 16


def fingerprint(raw: bytes) -> int:
    """The SimHash of a text's UTF-8 bytes."""
    words = raw.lower().split()      # bytes: only A-Z change, and only space and \\t to \\r separate
    n = max(1, len(words) - SHINGLE + 1)
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    grams = map(b" ".join, zip(*(islice(words, k, None) for k in range(SHINGLE)))) if len(words) >= SHINGLE else iter([b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    while block := [digest(g, SEED) for g in islice(grams, HELD)]:
        ones += np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.array([fingerprint(raw.tobytes()) for raw in W.text_bytes(batch.column(1))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)``; the fingerprint's 64 bits as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_fingerprints, f"id {kind}, fp bigint")


def ball(radius: int) -> list[tuple[int, int]]:
    """``(mask, bits)`` of all masks of a segment with at most ``radius`` bits."""
    return [(sum(1 << b for b in bits), r) for r in range(radius + 1) for bits in combinations(range(HALF), r)]


def _half(fp: Column, segment: int) -> Column:
    return F.shiftrightunsigned(fp, HALF * (1 - segment)).bitwiseAND(F.lit((1 << HALF) - 1))


def _within(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _around(value: Column, radius: int) -> Column:
    """All ``(value, bits)`` within ``radius`` bits of a segment's value."""
    masks = F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(r).alias("r")) for m, r in ball(radius)])
    return F.transform(masks, lambda x: F.struct(value.bitwiseXOR(x["m"]).alias("value"), x["r"].alias("bits")))


def link_fingerprints(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``(fp)``, a < b, whose
    components are those of all links; outside dense values all links."""
    segments = F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), _half(F.col("fp"), s).alias("value")) for s in (0, 1)]))
    table = fps.select("fp", segments.alias("s")).select("s.segment", "s.value", "fp")
    probes = table.select("segment", "fp", F.explode(_around(F.col("value"), 1)).alias("p")).select("segment", "p.value", "p.bits", "fp")
    crowded, n = cut(table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > dense).drop("n"), n=rows())
    near, asked = table, probes
    if n["n"]:
        near, asked = (x.join(crowded, ["segment", "value"], "left_anti") for x in (table, probes))
    found = asked.select("segment", "value", F.col("fp").alias("a")).join(near.withColumnRenamed("fp", "b"), ["segment", "value"])
    links = found.filter((F.col("a") < F.col("b")) & _within("a", "b")).select("a", "b")
    if n["n"]:
        links = links.unionByName(_dense_links(table, probes, crowded))
    return links.distinct()


def _dense_links(table: DataFrame, probes: DataFrame, crowded: DataFrame) -> DataFrame:
    """Links of the fingerprints that have a crowded segment value, or are one bit from it."""
    at = ["segment", "value", "far"]
    other = F.when(F.col("segment") == 0, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))
    spread = lambda x, radius: x.join(crowded, ["segment", "value"], "left_semi").select(
        "segment", "value", "fp", F.explode(_around(other, radius)).alias("f")).select("segment", "value", "fp", F.col("f.value").alias("far"), F.col("f.bits").alias("bits"))
    names = spread(table, 2).unionByName(spread(probes.filter("bits = 1").drop("bits"), 1).withColumn("bits", F.lit(DISTANCE)))
    named = cut(names)
    centres = named.filter("bits <= 1").groupBy(*at).agg(F.min("fp").alias("centre"))
    pairs = named.join(centres, at).filter((F.col("fp") != F.col("centre")) & _within("fp", "centre"))
    return pairs.select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))


def simhash_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", dense: int = DENSE) -> DataFrame:
    """``(id, fp, component_id)`` per row of ``docs``; the class of linked
    documents is named by its smallest id."""
    made, seen = cut(fingerprint_documents(docs, id_col, text_col), n=rows())
    fps = cut(made.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    roots = components(cut(link_fingerprints(fps.select("fp"), dense)))
    placed = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "n", "low", "root")
    lowest = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("least"))
    named = cut(placed.join(lowest, "root", "left").select("fp", "n", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("least")).alias("component_id")))
    # a fingerprint of more than rows / partitions documents: no more of them than partitions, so the list is small
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(named.filter(F.col("n") * parts > seen["n"]).drop("n"))
    often = made.join(hot, "fp")
    rest = made.join(hot.select("fp"), "fp", "left_anti").join(named.drop("n"), "fp")
    return often.unionByName(rest).select("id", "fp", "component_id")
