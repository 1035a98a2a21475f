"""Near-duplicate classes with HyperMinHash sketches.

A document is the set of the 64-bit hashes of its 5-word shingles. The hashes
are dealt into 128 buckets by their top bits; of the smallest hash of each
bucket the sketch keeps only the number of leading zeros and the 10 bits that
follow, 16 bits a bucket. Bands of 6 registers, taken from 4 arrangements of
the registers (84 bands), are the candidate keys, after empty registers have
borrowed from others; a candidate pair is weighed by the collision-corrected Jaccard estimate of its sketches, and what the
estimate leaves is confirmed on the full shingle sets of both texts.

At the threshold of 0.75 a pair misses all bands with a chance of about 3e-5
(69 of 2,400,000 simulated pairs; the bands share 128 registers), which falls
fast above it, and falls under the estimate's margin (5 standard errors) with
about 3e-7.

Not all pairs of a band are made. Equal sets are folded first, so a class of
exact copies is one set. In a band, every set is paired with the smallest one;
links join sets to components, and a band whose sets are all in one component
is done. In the bands that remain, the sets outside the largest component are
compared with all others of the band, block by block, bands with the same
largest component together. So no link between
components is lost, and groups of near copies cost in proportion to their size.

Defined results: an empty or null text has no shingles and is linked with
nothing; a text of 1 to 4 words has its whole word sequence as only shingle.
Repeated rows are equal documents of one class. A null id never is a class's
id unless all ids of the class are null. Extra columns are not read.
Sets are named by a 64-bit hash (XXH3) of their content; links are confirmed on
the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.llm import words as W
from tracknet.llm.components import components, join_classes
from tracknet.plans.iterate import cut, rows

SHINGLE = 5
THRESHOLD = (75, 100)   # intersection / union as a fraction
BUCKETS = 128
MANTISSA = 10
BAND = 6
ARRANGEMENTS = 4
MARGIN = 5.0
#: Sets in a block that is compared with another one in a task.
BLOCK = 256
#: With more likely pairs for each set of two blocks, all intersections are counted at once.
FEW_PAIRS = 8
SHINGLES_AT_ONCE = 8192


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct hashes: per bucket leading zeros and mantissa plus 1; 0 is an empty bucket."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(shingles):
        return out
    bucket = (shingles >> np.uint64(57)).astype(np.int64)
    first = np.concatenate(([True], bucket[1:] != bucket[:-1]))
    # 53 bits below the bucket's: exact as a double, whose exponent is the place of the leading one
    value = (shingles[first] >> np.uint64(4)) & np.uint64((1 << 53) - 1)
    zeros = 53 - np.frexp(value.astype(np.float64))[1].astype(np.int64)
    zeros[value == 0] = 53
    after = (value << np.minimum(zeros + 1, 63).astype(np.uint64)) & np.uint64((1 << 53) - 1)
    out[bucket[first]] = (zeros << MANTISSA) + (after >> np.uint64(53 - MANTISSA)).astype(np.int64) + 1
    return out


def arrange(width: int, times: int) -> np.ndarray:
    """The registers of each band: ``times`` shuffles of all registers, cut into bands."""
    rng = np.random.default_rng(6)
    bands = BUCKETS // width
    return np.concatenate([rng.permutation(BUCKETS)[:bands * width].reshape(bands, width) for _ in range(times)])


BANDS = arrange(BAND, ARRANGEMENTS)
#: For each bucket, the order in which buckets are asked for a value, itself first.
PROBES = np.stack([np.append(i, np.random.default_rng([61, i]).permutation(BUCKETS)) for i in range(BUCKETS)])


def densify(regs: np.ndarray) -> np.ndarray:
    """Rows of registers whose empty buckets take the value of the first
    bucket with one in their own probe order. So small sets fill all registers,
    and any register of two sets agrees with the chance of their similarity."""
    first = (regs > 0)[:, PROBES].argmax(axis=2)
    return np.take_along_axis(regs, PROBES[np.arange(BUCKETS), first], axis=1)


def band_keys(regs: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """A key per row of registers and band."""
    odd = np.random.default_rng(66).integers(1, 1 << 62, bands.shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    taken = densify(regs).astype(np.uint64)[:, bands]
    return W.mix((W.mix(taken + np.uint64(1)) * odd).sum(axis=2, dtype=np.uint64)).view(np.int64)


def collision_rate(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Chance that the registers of two unlike sets of these sizes agree: the
    sum over leading-zero counts of both sets having their smallest value
    there, over the number of mantissas."""
    edge = 2.0 ** -np.arange(0, 40)
    def at(n: np.ndarray) -> np.ndarray:
        load = np.maximum(n / BUCKETS, 1.0)[:, None]
        above = (1 - edge) ** load      # no value under the edge
        return above[:, 1:] - above[:, :-1]
    return (at(n_a) * at(n_b)).sum(axis=1) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate per pair of sketches and the number of registers it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    rate = collision_rate(n_a, n_b)
    got = (same / np.maximum(used, 1) - rate) / (1 - rate)
    return np.clip(got, 0, 1), used


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            sid, n, regs = [], [], []
            for raw in W.text_bytes(batch.column(1)):
                s = W.shingles(raw, SHINGLE)
                sid.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                n.append(len(s))
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sid, pa.int64()), pa.array(n, pa.int64()), pa.array(regs, pa.binary())],
                                             ["id", "tag", "sid", "n_shingles", "regs"])


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, tag, sid, n_shingles, regs)``; ``sid`` names the shingle set, null without one, ``tag`` the text."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("tag")).mapInArrow(
        _sketches, f"id {kind}, tag bigint, sid bigint, n_shingles bigint, regs binary")


def _bands(bands: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                # some hundred sets at a time: each gives a row per band
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    regs = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                    sid = np.repeat(part.column(0).to_numpy(zero_copy_only=False), len(bands))
                    yield pa.RecordBatch.from_arrays([pa.array(band_keys(regs, bands).reshape(-1)), pa.array(sid, pa.int64())], ["band", "sid"])

    return run


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    want = THRESHOLD[0] / THRESHOLD[1]
    for batch in batches:
        if not len(batch):
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("regs_a", "regs_b"))
        n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
        got, used = estimate(a, b, n_a, n_b)
        margin = MARGIN * np.sqrt(want * (1 - want) / np.maximum(used, 1))
        # sizes too far apart rule a pair out exactly
        sizes = np.minimum(n_a, n_b) * THRESHOLD[1] >= np.maximum(n_a, n_b) * THRESHOLD[0]
        yield batch.select(["a", "b"]).filter(pa.array((got + margin >= want) & sizes))


def shingle_words(raw: np.ndarray) -> frozenset:
    """The shingles of a text as words, not as hashes."""
    words = W.lower_ascii(raw).tobytes().split()
    return frozenset(zip(*(words[k:] for k in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else frozenset([tuple(words)] if words else [])


def alike(s: frozenset, t: frozenset) -> bool:
    common = len(s & t)
    return common > 0 and common * THRESHOLD[1] >= (len(s) + len(t) - common) * THRESHOLD[0]


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            ok = []
            for x, y in zip(W.text_bytes(batch.column("text_a")), W.text_bytes(batch.column("text_b")), strict=True):
                ok.append(alike(shingle_words(x), shingle_words(y)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs ``(a, b)`` of sets that the estimate and then the full sets confirm."""
    side = lambda x: texts.select(F.col("sid").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
    likely = cut(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_weigh, "a bigint, b bigint"))
    text = lambda x: texts.select(F.col("sid").alias(x), F.col("text").alias(f"text_{x}"))
    return cut(likely.join(text("a"), "a").join(text("b"), "b").mapInArrow(_confirm, "a bigint, b bigint"))


def link_sets(sets: DataFrame, text_of, bands: np.ndarray = BANDS) -> DataFrame:
    """``(node, root)`` of all linked sets; ``sets`` has ``(sid, n_shingles,
    regs)``, ``text_of(sids)`` gives ``(sid, text)`` of the asked sets."""
    members = sets.select("sid", "regs").mapInArrow(_bands(bands), "band bigint, sid bigint")
    leaders = members.groupBy("band").agg(F.min("sid").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    shared = cut(members.join(leaders, "band"))
    texts = cut(text_of(shared.select("sid").distinct()).join(sets.select("sid", "n_shingles", "regs"), "sid"))
    links = _links(shared.filter("sid <> first").select(F.col("first").alias("a"), F.col("sid").alias("b")).distinct(), texts)
    roots = components(links)
    fresh, found = cut(_compare_apart(shared, roots, texts), n=rows())
    return join_classes(roots, fresh) if found["n"] else roots


def _compare_apart(shared: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """The links between sets of different components that share a band.

    In each band that holds several components, the sets outside its largest
    one are to be compared with all of its sets. Bands with the same largest
    component are worked off together, so that sets which share many bands are
    dealt and compared once. Both sides are cut into blocks of ``BLOCK`` sets; a
    task holds two blocks and makes no rows for pairs. Sets of one component are
    not compared again."""
    inside = shared.join(roots, F.col("sid") == F.col("node"), "left").select("band", "sid", F.coalesce("root", "sid").alias("root"))
    parts = inside.groupBy("band", "root").agg(F.count(F.lit(1)).alias("m"))
    # a band of two sets has been compared with its leader
    open_bands = (parts.groupBy("band").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("k"))
                  .filter("k > 1 AND all > 2").select("band", F.col("top.root").alias("top")))
    members = cut(inside.join(open_bands, "band").select("top", "sid", "root").distinct().withColumn("main", F.col("root") == F.col("top")))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    sizes = members.groupBy("top").agg(blocks(F.count(F.when(~F.col("main"), 1))).alias("ns"), blocks(F.count(F.when(F.col("main"), 1))).alias("ng"))
    own = F.pmod(F.xxhash64("sid"), F.when(F.col("main"), F.col("ng")).otherwise(F.col("ns"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    group = lambda main, i, j, left: F.struct(main.alias("main"), i.alias("i"), j.alias("j"), left.alias("left"))
    k = F.col("own")
    to_main = F.transform(upto(F.col("ng")), lambda j: group(F.lit(True), k, j, F.lit(True)))
    to_rest = F.transform(upto(F.col("ns")), lambda j: group(F.lit(False), F.least(k, j), F.greatest(k, j), k <= j))
    from_main = F.transform(upto(F.col("ns")), lambda i: group(F.lit(True), i, k, F.lit(False)))
    dealt = members.join(sizes, "top").withColumn("own", own).select(
        "top", "sid", "root", F.explode(F.when(F.col("main"), from_main).otherwise(F.concat(to_main, to_rest))).alias("g"))
    keys = ["top", "main", "i", "j"]
    rows_of = dealt.join(texts, "sid").select("top", "g.main", "g.i", "g.j", "g.left", "sid", "root", "n_shingles", "regs", "text")
    return rows_of.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compare_blocks, "a bigint, b bigint").distinct()


def _links_between(key: tuple, group: list[dict]) -> list[tuple[int, int]]:
    """Confirmed links between the two blocks of a group (or within its one)."""
    want = THRESHOLD[0] / THRESHOLD[1]
    _, main, i, j = key
    left = [x for x in group if x["left"]]
    right = left if not main and i == j else [x for x in group if not x["left"]]
    if not left or not right:
        return []
    regs = [np.frombuffer(b"".join(x["regs"] for x in side), np.uint16).reshape(-1, BUCKETS) for side in (left, right)]
    size = [np.array([x["n_shingles"] for x in side], float) for side in (left, right)]
    root = [np.array([x["root"] for x in side]) for side in (left, right)]
    known: dict[int, frozenset] = {}

    def full(x: dict) -> frozenset:
        if x["sid"] not in known:
            known[x["sid"]] = shingle_words(np.frombuffer(x["text"].encode(), np.uint8))
        return known[x["sid"]]

    likely = []
    for p in range(len(left)):
        n = size[0][p]
        # sizes and components first: they are cheap and exact
        at = np.flatnonzero((np.minimum(n, size[1]) * THRESHOLD[1] >= np.maximum(n, size[1]) * THRESHOLD[0]) & (root[0][p] != root[1]))
        if right is left:
            at = at[at > p]
        if at.size:
            got, used = estimate(np.broadcast_to(regs[0][p], (len(at), BUCKETS)), regs[1][at], np.full(len(at), n), size[1][at])
            at = at[got + MARGIN * np.sqrt(want * (1 - want) / np.maximum(used, 1)) >= want]
            likely.append(np.stack([np.full(len(at), p), at]))
    pairs = np.concatenate(likely, axis=1) if likely else np.zeros((2, 0), np.int64)
    if pairs.shape[1] <= FEW_PAIRS * (len(left) + len(right)):
        linked = [k for k, (p, q) in enumerate(pairs.T.tolist()) if alike(full(left[p]), full(right[q]))]
    else:
        # many like texts: the sizes of all intersections at once
        rows_l, at_l = np.unique(pairs[0], return_inverse=True)
        rows_r, at_r = np.unique(pairs[1], return_inverse=True)
        sets_l, sets_r = [full(left[p]) for p in rows_l.tolist()], [full(right[q]) for q in rows_r.tolist()]
        common = common_counts(sets_l, sets_r)[at_l, at_r]
        union = np.array([len(x) for x in sets_l])[at_l] + np.array([len(x) for x in sets_r])[at_r] - common
        linked = np.flatnonzero((common > 0) & (common * THRESHOLD[1] >= union * THRESHOLD[0])).tolist()
    ends = [(left[p]["sid"], right[q]["sid"]) for p, q in pairs[:, linked].T.tolist()]
    return [(min(a, b), max(a, b)) for a, b in ends]


def common_counts(left: list[frozenset], right: list[frozenset]) -> np.ndarray:
    """The size of every intersection of a left and a right set: products of
    their incidence matrices, some thousand shingles at a time."""
    number: dict[tuple, int] = {}
    cols = [np.sort(np.fromiter((number.setdefault(x, len(number)) for x in s), np.int64, len(s))) for s in left]
    also = [np.sort(np.array([number[x] for x in s if x in number], np.int64)) for s in right]
    out = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, len(number), SHINGLES_AT_ONCE):
        sides = []
        for held in (cols, also):
            block = np.zeros((len(held), SHINGLES_AT_ONCE), np.float32)
            for k, c in enumerate(held):
                block[k, c[np.searchsorted(c, low):np.searchsorted(c, low + SHINGLES_AT_ONCE)] - low] = 1
            sides.append(block)
        out += np.rint(sides[0] @ sides[1].T).astype(np.int64)
    return out


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, group = None, []

    def done() -> Iterator[pa.RecordBatch]:
        found = _links_between(held, group) if group else []
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, len(batch), 512):
                for row in batch.slice(at, 512).to_pylist():
                    key = (row["top"], row["main"], row["i"], row["j"])
                    if key != held:
                        yield from done()
                        held, group = key, []
                    group.append(row)
        yield from done()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bands: np.ndarray = BANDS) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row of ``docs``: the class
    of near duplicates named by its smallest id, whose row is kept."""
    found = _classes(docs, id_col, text_col, bands)
    return found.select("id", "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _classes(docs: DataFrame, id_col: str, text_col: str, bands: np.ndarray) -> DataFrame:
    """``(id, tag, n_shingles, component_id, chosen)`` per row: ``chosen`` marks
    the one row (and its exact copies, equal in id and text) that stands for a
    class, by id with null ids last, then by text; and all rows without a set."""
    kind = docs.schema[id_col].dataType.simpleString()
    sketched = cut(sketch_documents(docs, id_col, text_col))
    named = sketched.filter("sid IS NOT NULL")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "tag")
    sets = cut(named.groupBy("sid").agg(F.min("id").alias("low"), F.min(place).alias("place"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs")))

    def text_of(sids: DataFrame) -> DataFrame:
        # one document of each asked set, by its smallest id; a set whose ids are all null is found by them
        asked = sets.join(sids, "sid", "left_semi").select("sid", F.col("low").alias("id"))
        rows_of = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        found = rows_of.join(asked, rows_of["id"].eqNullSafe(asked["id"])).select(asked["sid"], "text")
        # rows that share an id: the text must be that of the set
        return found.mapInArrow(_of_set, "sid bigint, text string").groupBy("sid").agg(F.min("text").alias("text"))

    roots = link_sets(sets.drop("place"), text_of, bands)
    low = sets.select("sid", "low", "place").join(roots, F.col("sid") == F.col("node"), "left").select("sid", F.coalesce("root", "sid").alias("root"), "low", "place")
    named_low = low.groupBy("root").agg(F.min("low").alias("component"), F.min("place").alias("first"))
    of_set = cut(low.join(named_low, "root").select(F.col("sid").alias("_sid"), "component", "first"))
    # rows without a set carry a key of their own, so that they do not meet in one task
    spread = F.coalesce(F.col("sid"), F.xxhash64("id", F.lit("empty")))
    out = sketched.withColumn("_key", spread).join(of_set, (F.col("_key") == F.col("_sid")) & F.col("sid").isNotNull(), "left")
    component = F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("component")).cast(kind)
    chosen = F.col("sid").isNull() | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tag") == F.col("first.tag")))
    return out.select("id", "tag", "n_shingles", component.alias("component_id"), chosen.alias("chosen"))


def keep_representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their classes, with their columns;
    of rows equal in id and text one. Of a class of null ids only, one text stays."""
    kept = _classes(docs, id_col, text_col, BANDS).filter("chosen").select(F.col("id").alias("_kept"), F.col("tag").alias("_tag")).distinct()
    tag = F.xxhash64(docs[text_col].cast("string"))
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept"]) & (tag == kept["_tag"]), "left_semi").dropDuplicates([id_col, text_col])


def _of_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            sid = batch.column(0).to_pylist()
            ok = []
            for want, raw in zip(sid, W.text_bytes(batch.column(1)), strict=True):
                s = W.shingles(raw, SHINGLE)
                ok.append(len(s) > 0 and xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) == want)
            yield batch.filter(pa.array(ok, pa.bool_()))
