"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets share all words of the corpus among the sources by weight; no source
gets more than ``cap`` times what it has, and what is cut off goes to the
others by weight (``targets``).

Document rates (expected copies) are those closest to one copy each, in
bounded relative entropy per word, that meet every source's target:
``rate = cap / (1 + (cap - 1) * exp(-lambda[source] * tilt))``, an exponential
tilt that stays between 0 and ``cap``. The dual is convex with one variable
per source; Newton's method solves it (``solve``). Its sums run over
``(source, tilt)`` groups, so a step costs a small aggregate, not a pass over
the documents. ``tilt`` is 1 unless a column is named, which tilts documents
of a source unequally (by a quality score, say).

Rates become copies by systematic sampling along the sizes: in fixed-point
arithmetic, so that engines and reruns agree, the running sum of the rates'
fractions, from a start drawn from the source's name, gives a copy each time
it passes an integer. Neighbours in size replace each other, so the words taken
stay within about one document of the target. A few repair steps then change
the copies of the one document per source whose size is nearest to what is
missing or over.

Skew: no step gathers a source. Sums are pre-aggregated; the sampling windows
hold about ``GROUP`` documents each, as a source is split by a hash of its ids.

Defined results: a null text has size 0; a null source is a source of its own,
last in order. Repeated rows are documents of their own, but repair moves rows
equal in id and text together. Without words all targets are 0 and nothing is taken.
An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracknet.llm.quality import split_words
from tracknet.plans.iterate import cut

WEIGHTS = (1, 2, 3)
CAP = 3
GROUP = 10_000
UNIT = 1 << 30
REPAIRS = 4
TOLERANCE = 1e-12


def _hash32(text: Column) -> Column:
    """A number below 2**32 from a text, the same in any engine with md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, n_docs, weight, target)`` from ``(source,
    source_size, n_docs)``: one row per source, nulls last in order."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = cut(sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))))
    most = cap * F.col("source_size")
    level, held = None, -1
    while True:
        over = (F.lit(level) * F.col("weight") > most) if level is not None else F.lit(False)
        got = s.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, most).otherwise(0)).alias("full"),
                    F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight"), F.count(F.when(over, 1)).alias("n")).first()
        if got["n"] == held or not got["weight"]:
            break
        held, level = got["n"], (got["all"] - got["full"]) / got["weight"]
    share = F.lit(float(level or 0)) * F.col("weight")
    return s.withColumn("target", F.least(share, most.cast("double")))


def rate(dual: Column, tilt: Column, cap: int = CAP) -> Column:
    """Copies expected of a document; a null dual stands for plus infinity."""
    return F.when(dual.isNull(), F.lit(float(cap))).otherwise(cap / (1 + (cap - 1) * F.exp(-dual * tilt)))


def solve(groups: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """Newton's method for all sources at once: ``goals`` with ``dual`` and ``full``.

    ``groups`` has ``(source, tilt, words)``. A source whose target is all that
    its cap allows needs no dual (null, full rate). The driver sees only how far the worst
    source is from its target."""
    state = goals.withColumn("full", F.col("target") >= cap * F.col("source_size")).withColumn("dual", F.lit(0.0))
    left, rounds = float("inf"), 0
    while left > TOLERANCE and rounds < 60:
        r = rate(F.col("dual"), F.col("tilt"), cap)
        step = groups.join(state.filter("NOT full"), groups["source"].eqNullSafe(state["source"])).select(
            state["source"].alias("_of"), (r * F.col("words")).alias("_got"), (r * (1 - r / cap) * F.col("tilt") * F.col("words")).alias("_slope"))
        sums = step.groupBy("_of").agg(F.sum("_got").alias("_got"), F.sum("_slope").alias("_slope"))
        move = F.when(F.col("_slope") > 0, (F.col("target") - F.col("_got")) / F.col("_slope")).otherwise(0.0)
        off = F.when(F.col("target") > 0, F.abs(F.col("target") - F.col("_got")) / F.col("target")).otherwise(0.0)
        near = state.join(sums, F.col("source").eqNullSafe(F.col("_of")), "left")
        # steps are held to a length that the dual's curvature allows
        state, worst = cut(near.select(*goals.columns, "full", (F.col("dual") + F.coalesce(F.greatest(F.lit(-2.0), F.least(F.lit(2.0), move)), F.lit(0.0))).alias("dual"),
                                       F.when(F.col("full"), 0.0).otherwise(F.coalesce(off, F.lit(0.0))).alias("_off")), off=F.max("_off"))
        state, left, rounds = state.drop("_off"), worst["off"], rounds + 1
    return state.withColumn("dual", F.when(~F.col("full"), F.col("dual")))


def _round(docs: DataFrame) -> DataFrame:
    """``copies`` from ``rate``: its whole part, and one more where the running sum of the parts passes an integer."""
    parts = F.round(F.col("rate") * UNIT).cast("long")
    cell = [F.col("source"), F.col("salt")]
    order = Window.partitionBy(*cell).orderBy(F.col("size").desc(), "key", F.col("id").asc_nulls_last(), "tag")
    start = F.floor(_hash32(F.concat_ws("|", F.lit("start"), F.coalesce(F.col("source"), F.lit("")), F.col("salt").cast("string"))) / 4)
    upto = F.sum("_part").over(order.rowsBetween(Window.unboundedPreceding, 0)) + start
    return (docs.withColumn("_part", parts).withColumn("_upto", upto)
            .withColumn("copies", F.floor(F.col("_upto") / UNIT) - F.floor((F.col("_upto") - F.col("_part")) / UNIT)).drop("_part", "_upto"))


def _repair(docs: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """One copy more or less of the document whose size is nearest to a source's gap, if that narrows it."""
    got = docs.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("_got"))
    gaps = goals.join(got, goals["source"].eqNullSafe(got["source"])).select(goals["source"].alias("_of"), (F.col("target") - F.col("_got")).alias("gap"))
    gap = F.col("gap")
    near = F.struct(F.abs(F.col("size") - F.abs(gap)).alias("d"), F.col("key").alias("key"), F.col("id").alias("id"), F.col("tag").alias("tag"))
    may = ((gap > 0) & (F.col("copies") < cap)) | ((gap < 0) & (F.col("copies") > 0))
    best = (docs.join(gaps, F.col("source").eqNullSafe(F.col("_of"))).filter(may & (F.abs(F.col("size") - F.abs(gap)) < F.abs(gap)))
            .groupBy("_of", "gap").agg(F.min(near).alias("_b")).select("_of", F.signum("gap").cast("long").alias("_sign"), F.col("_b.id").alias("_id"), F.col("_b.tag").alias("_tag")))
    moved = docs.join(best, F.col("source").eqNullSafe(F.col("_of")), "left")
    return cut(moved.withColumn("copies", F.when(F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")),
                                                 F.least(F.lit(cap), F.greatest(F.lit(0), F.col("copies") + F.col("_sign")))).otherwise(F.col("copies")).cast("long"))
               .select(*docs.columns))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tilt_col: str | None = None,
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(id, tag, source, size, source_size, target, rate, copies, taken)`` per document; ``tag`` is a hash of the text."""
    tilt = F.col(tilt_col).cast("double") if tilt_col else F.lit(1.0)
    size = F.size(split_words(F.coalesce(F.col(text_col), F.lit("")))).cast("long")
    narrow = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), tilt.alias("tilt"), size.alias("size"),
                             F.xxhash64(text_col).alias("tag")))
    groups = cut(narrow.groupBy("source", "tilt").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
    goals = cut(targets(groups.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n_docs")), weights, cap))
    solved = solve(groups, goals, cap).select(F.col("source").alias("_of"), "source_size", "n_docs", "target", "dual")
    key = _hash32(F.coalesce(F.col("id").cast("string"), F.lit("")))
    rated = narrow.join(solved, F.col("source").eqNullSafe(F.col("_of"))).select(
        "id", "tag", "source", "size", "source_size", "target", rate(F.col("dual"), F.col("tilt"), cap).alias("rate"), key.alias("key"),
        F.pmod(key, F.ceil(F.col("n_docs") / GROUP)).alias("salt"))
    mixed = cut(_round(rated))
    for _ in range(REPAIRS):
        mixed = _repair(mixed, goals, cap)
    return mixed.select("id", "tag", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; rows equal
    in id and text are taken equally often, their mean rounded."""
    copies = mix_sources(docs, id_col=id_col, text_col=text_col, **options).groupBy("id", "tag").agg(F.round(F.avg("copies")).cast("int").alias("copies"))
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.xxhash64(text_col).alias("_text"))
    found = packed.join(copies.filter("copies > 0"), F.col("_doc").eqNullSafe(F.col("id")) & (F.col("_text") == F.col("tag")))
    return found.select(F.explode(F.array_repeat("_row", F.col("copies"))).alias("_row")).select("_row.*")
