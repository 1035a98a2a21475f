"""Document fingerprints: a digest of quartiles of hashed byte triplets.

Every window of five bytes gives six triplets (the window's first byte with
each pair of the other four); each is hashed into one of 128 buckets. The
digest holds, per bucket, in which quarter of all bucket counts its count lies
(2 bits), the logarithm of the text's length, how the quartiles stand to each
other, and a checksum. Two digests are compared by a difference score: the sum
of the buckets' distances (a jump over three quarters counts 6), of the length
classes' and of the quartile ratios' distances, each bounded. The likeness is
1 minus the score over the largest score, between 0 and 1.

Texts shorter than five bytes are padded to five, so that each has a window;
an empty or null text has no counts and the all-zero digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.llm import words as W

BUCKETS = 128
#: Places of the other two bytes of a triplet in the window, after the first.
PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Odd multipliers of the triplet hash, one per pair of places.
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)
CHUNK = 1 << 20
HEADER = 4           # checksum, length class, two ratios
LENGTH_WEIGHT, LENGTH_MOST = 8, 64
RATIO_WEIGHT, RATIO_MOST = 4, 32
DISTANCE = np.array([0, 1, 2, 6])
RANGES_PER_TASK = 4
WORST = 6 * BUCKETS + LENGTH_MOST + 2 * RATIO_MOST


def triplet_counts(raw: np.ndarray) -> np.ndarray:
    """Counts of the hashed triplets per bucket, over all of a text's bytes."""
    counts = np.zeros(BUCKETS, np.int64)
    if not raw.size:
        return counts
    if raw.size < 5:
        raw = np.concatenate((raw, np.zeros(5 - raw.size, np.uint8)))
    for at in range(0, raw.size - 4, CHUNK):
        part = raw[at:at + CHUNK + 4].astype(np.uint32)
        n = part.size - 4
        first = part[:n] << np.uint32(16)
        for (i, j), factor in zip(PAIRS, FACTORS, strict=True):
            h = (first | (part[i:i + n] << np.uint32(8)) | part[j:j + n]) * np.uint32(factor)
            counts += np.bincount(h >> np.uint32(25), minlength=BUCKETS)
    return counts


def digest(raw: np.ndarray) -> bytes:
    counts = triplet_counts(raw)
    if not counts.any():
        return bytes(HEADER + BUCKETS // 4)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    quarter = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = quarter.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(255, int(np.log(raw.size) / np.log(1.25)) + 1)
    ratio = [15 * q // max(1, q3) for q in (q1, q2)]
    check = hashlib.blake2b(raw.tobytes(), digest_size=1).digest()
    return check + bytes([length, *ratio]) + body.astype(np.uint8).tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row of two arrays of digests, 1 for equal digests down to 0; the checksum counts nothing."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    score = np.minimum(LENGTH_MOST, LENGTH_WEIGHT * np.abs(a[:, 1] - b[:, 1]))
    for k in (2, 3):
        score = score + np.minimum(RATIO_MOST, RATIO_WEIGHT * np.abs(a[:, k] - b[:, k]))
    for shift in (0, 2, 4, 6):
        apart = np.abs(((a[:, HEADER:] >> shift) & 3) - ((b[:, HEADER:] >> shift) & 3))
        score = score + DISTANCE[apart].sum(axis=1)
    return 1.0 - score / WORST


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` of every row; hex."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(r).hex() for r in W.text_bytes(batch.column(1))], pa.string())],
                                                 ["id", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fingerprint string")


def _char_starts(raw: np.ndarray) -> np.ndarray:
    return np.flatnonzero((raw & 0xC0) != 0x80)


def edited(raw: np.ndarray, following: np.ndarray) -> tuple[bytes, int]:
    """The text with its last floor(n/2) code points replaced by the first as
    many (or all) of the following text, and n."""
    chars = _char_starts(raw)
    n = len(chars)
    half = n // 2
    head = raw[:chars[n - half]] if half else raw
    other = _char_starts(following)
    tail = following[:other[half]] if half < len(other) else following
    return head.tobytes() + (tail.tobytes() if half else b""), n


def compare_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text and their
    likenesses; the next document is the one that follows by id (rows of one
    id by their text, null ids first; after the last comes the first).

    Documents are dealt once, by ranges of ids: a text crosses the network
    once. Each range also gets the first document of the following range. The
    bounds are ids of the table, one per range, and are all the driver sees."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    slices = slices or max(2, 4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # several ranges a task, as ranges are dealt by hash: so tasks come out even
    ranges = RANGES_PER_TASK * slices
    shares = F.lit([k / ranges for k in range(1, ranges)])
    got = rows.agg(F.percentile_approx("id", shares, F.lit(100 * ranges)).alias("cuts"), F.min("id").alias("low"),
                   F.count(F.when(F.col("id").isNull(), 1)).alias("nulls")).first()
    low = got["low"]
    # range k holds the ids from bounds[k-1] up to bounds[k]; range 0 starts with the nulls
    bounds = np.array(sorted({c for c in got["cuts"] or [] if c != low or got["nulls"]}), np.int64)
    last = len(bounds)
    first_null = bool(got["nulls"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            part = np.where(missing, 0, np.searchsorted(bounds, ids, "right"))
            own = pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.zeros(len(ids), bool)), *batch.columns], ["part", "ahead", "id", "text"])
            yield own
            # the rows that may be the first of a range go to the range before as well
            begins = np.zeros(len(ids), bool)
            if len(bounds):
                at = np.searchsorted(bounds, ids, "left")
                begins = ~missing & (at < len(bounds)) & (bounds[np.minimum(at, len(bounds) - 1)] == ids)
            opens = missing if first_null else ids == low
            for mask, to in ((begins, part - 1), (opens, np.full(len(ids), last))):
                if mask.any():
                    some = own.filter(pa.array(mask))
                    yield pa.RecordBatch.from_arrays([pa.array(to[mask], pa.int32()), pa.array(np.ones(int(mask.sum()), bool)), some.column(2), some.column(3)],
                                                     ["part", "ahead", "id", "text"])

    dealt = rows.mapInArrow(deal, "part int, ahead boolean, id bigint, text string")
    # rows ahead stand behind their range's own; of several with the first id, the smallest text counts
    sorted_parts = dealt.repartition(slices, "part").sortWithinPartitions("part", "ahead", F.col("id").asc_nulls_first(), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            held = None       # part, id, bytes and digest of the row whose next row is still to come
            out: list[tuple] = []
            for batch in batches:
                parts, ahead, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
                for part, tail, i, raw in zip(parts, ahead, ids, W.text_bytes(batch.column(3)), strict=True):
                    if tail and (held is None or held[0] != part):
                        continue        # the range has been closed by an earlier row ahead
                    mark = digest(raw)
                    if held is not None and held[0] == part:
                        text, n = edited(held[2], raw)
                        out.append((held[1], n, hashlib.sha256(text).hexdigest(), held[3], digest(np.frombuffer(text, np.uint8)), mark))
                    held = None if tail else (part, i, raw.copy(), mark)
                    if len(out) >= 1024:
                        yield _rows(out, names)
                        out = []
            if out:
                yield _rows(out, names)

    return sorted_parts.mapInArrow(walk, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _rows(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    ids, n, sha, own, edit, following = zip(*out, strict=True)
    table = lambda x: np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
    a, b, c = table(own), table(edit), table(following)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sha), pa.array([x.hex() for x in own]), pa.array([x.hex() for x in edit]),
         pa.array(likeness(a, b)), pa.array(likeness(a, c))], names)
