"""Substring dedup: words covered by a repeated 20-word window are removed.

A window (20 consecutive words of one document) is removed wherever its word
sequence also starts earlier: in a document with a smaller id, or earlier in
the same one. The repeats are found with suffix automata of reference shards:
reference segments are put into an automaton in document order, every state of
which knows where its words first ended; streaming a segment through it gives,
for each word, the longest match that ends there and whether the last 20 words
of it had ended earlier.

An automaton of the whole corpus would neither fit one task nor be small
enough to broadcast, and streaming every document through every shard is
quadratic. So shards are routed by content instead of being broadcast whole:

1. Each window has an anchor, the smallest hash among its 8-word runs. Equal
   windows have equal anchors, so windows are only compared under one anchor.
   Consecutive windows of one anchor are a segment.
2. Anchors that stand in one place only are dropped (a pre-aggregated count).
3. Segments of equal words are folded: all but the first are removed whole.
4. Where an anchor has segments of different words, the first ones are routed
   to the anchor's shard. Shards hold about ``SHARD_WORDS`` words. The automata
   find the windows that different segments share.
5. An anchor with very many different segments, or very long ones, goes to no
   shard: a passage that stands in N documents gives about N of them, since the
   words around it differ, and all share its windows. Each of their windows
   becomes a row; the first place of a window is a pre-aggregated minimum, and
   of these segments only the windows at a first place stay. So no task holds
   the segments of one anchor or the places of one window.

Every window of every text takes part; nothing is sampled or capped. Rows
travel as hashes; texts cross the network twice (to cut out the segments and
to remove the spans).

Defined results: a null text is an empty one. Null ids come first in order.
Rows of one id are ordered by a hash of their texts; rows equal in id and text
are one document, and each gets its result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracknet.llm import words as W
from tracknet.plans.iterate import cut

WINDOW = 20
ANCHOR = 8
SHARD_WORDS = 200_000
#: 8-word runs in a window.
SPAN = WINDOW - ANCHOR + 1
#: Bytes of text that are hashed at a time (a longer text alone).
SLICE = 1 << 20
#: Words of which a segment's hash takes the first and the last; half the words of most segments or more.
BLOCK = 16
#: Segments of different words, or that many times the words of a longest usual
#: one, that an anchor may have in a shard; with more, its windows are taken one by one.
CROWD = 256


class SuffixAutomaton:
    """Automaton of several sequences of symbols; ``first[state]`` is where the
    words of a state first ended. Every sequence starts at the root, so no
    match crosses two of them, and a sequence that is there already adds no state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [-1]
        self.last = 0

    def begin(self) -> None:
        self.last = 0

    def _state(self, moves: dict, link: int, length: int, first: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _reached(self, p: int, symbol) -> int:
        """The state of ``p``'s longest word with ``symbol`` added, split off from longer words if need be."""
        nxt, link, length = self.next, self.link, self.length
        q = nxt[p][symbol]
        if length[p] + 1 == length[q]:
            return q
        copy = self._state(dict(nxt[q]), link[q], length[p] + 1, self.first[q])
        while p != -1 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = copy
            p = link[p]
        link[q] = copy
        return copy

    def extend(self, symbol, at: int) -> None:
        p = self.last
        if symbol in self.next[p]:
            self.last = self._reached(p, symbol)
            return
        new = self._state({}, 0, self.length[p] + 1, at)
        while p != -1 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p != -1:
            self.link[new] = self._reached(p, symbol)
        self.last = new

    def earlier_ends(self, symbols, start: int, least: int) -> list[bool]:
        """For each symbol of a streamed text whose own place begins at
        ``start``: whether the last ``least`` symbols up to it match and had
        ended before this place."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state, matched, out = 0, 0, []
        for k, symbol in enumerate(symbols):
            while state and symbol not in nxt[state]:
                state = link[state]
                matched = length[state]
            if symbol in nxt[state]:
                state = nxt[state][symbol]
                matched += 1
            while length[link[state]] >= least if state else False:
                state = link[state]
                matched = length[state]
            out.append(matched >= least and first[state] < start + k)
        return out


def repeated_windows(segments: Iterable[tuple], least: int = WINDOW) -> Iterator[list[bool]]:
    """Per segment ``(any key, symbols)`` in document order: for each window,
    whether its symbols also stand earlier among the segments. Where words
    first ended does not change as later segments come, so each segment is
    answered as soon as it is in the automaton and none is held."""
    automaton, at = SuffixAutomaton(), 0
    for _, symbols in segments:
        start = at
        automaton.begin()
        for s in symbols:
            automaton.extend(s, at)
            at += 1
        yield automaton.earlier_ends(symbols, start, least)[least - 1:]


def segments_of(h: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor, first window, number of windows, content hash of each
    segment of several texts' word hashes, and whether the text repeats one of
    its windows. A text's words stand from its edge to the next."""
    size = np.diff(edges)
    text = np.repeat(np.arange(len(size)), np.maximum(size - (WINDOW - 1), 0))
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none.astype(bool)
    # a window ends in its text: the last places of each text are no windows
    place = np.arange(len(h) - WINDOW + 1)
    inside = np.repeat(np.arange(len(size)), size)
    place = place[inside[:len(place)] == inside[WINDOW - 1:]]
    anchor = W.sliding_min(W.windows(h, ANCHOR), SPAN)[place]
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    start, n = place[first], np.diff(np.append(first, len(place)))
    content = run_hashes(h, start, n + WINDOW - 1)
    # windows are told apart by text here; a chance equality only marks a segment in vain
    whole = W.mix(W.windows(h, WINDOW)[place] + W.mix(text.astype(np.uint64)))
    ordered = np.sort(whole)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    again = np.logical_or.reduceat(np.isin(whole, twice), first) if twice.size else np.zeros(len(first), bool)
    text = text[first]
    return text, anchor[first].view(np.int64), start - edges[text], n, content.view(np.int64), again


def run_hashes(h: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash for each run of ``size`` words, all of ``WINDOW`` words or more:
    up to twice ``BLOCK`` words from its first and last ``BLOCK``, which hold
    all of it, and its size; longer ones from the bytes of their word hashes."""
    block = W.windows(h, BLOCK)
    out = W.mix(block[start] + W.mix(block[start + size - BLOCK] + size.astype(np.uint64)))
    words = memoryview(np.ascontiguousarray(h))
    for k in np.flatnonzero(size > 2 * BLOCK).tolist():
        out[k] = xxhash.xxh3_64_intdigest(words[start[k]:start[k] + size[k]])
    return out


def _hashes(raw: np.ndarray) -> np.ndarray:
    return W.word_hashes(raw, *W.word_spans(raw))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for at, upto in W.slices(batch.column(2), SLICE, 512):
                _, anchor, _, _, _, again = segments_of(*W.slice_hashes(batch.column(2).slice(at, upto - at)))
                # a segment may repeat a window within itself
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(anchor, np.where(again, 2, 1)))], ["anchor"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for at, upto in W.slices(batch.column(2), SLICE, 512):
                part = batch.slice(at, upto - at)
                text, anchor, start, n, content, again = segments_of(*W.slice_hashes(part.column(2)))
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(content), part.column(0).take(row), part.column(1).take(row),
                                                  pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(again)],
                                                 ["anchor", "content", "id", "tag", "start", "n", "again"])


def _pieces(shards: int):
    """Cuts the asked segments out of their texts; those of crowded anchors become a row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                out: list[tuple] = []
                ids, tags, asked = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
                for i, tag, segs, raw in zip(ids, tags, asked, W.text_bytes(batch.column(2)), strict=True):
                    h = _hashes(raw)
                    for s in segs:
                        anchor, start, n = s["anchor"], s["start"], s["n"]
                        words = h[start:start + n + WINDOW - 1]
                        if not s["crowded"]:
                            out.append((hash(anchor) % shards, i, tag, start, words.tobytes(), None, None))
                            continue
                        whole = W.windows(words, WINDOW).view(np.int64)
                        for a in range(0, n, 4096):
                            out += [(None, i, tag, start + a + k, None, anchor, w) for k, w in enumerate(whole[a:a + 4096].tolist())]
                            if len(out) >= 4096:
                                yield _piece_rows(out)
                                out = []
                    if len(out) >= 4096:
                        yield _piece_rows(out)
                        out = []
                if out:
                    yield _piece_rows(out)

    return run


def _piece_rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["shard", "id", "tag", "start", "words", "anchor", "window"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple, bytes]]:
    """Shard, place and words of each piece; rows equal in id and text have one place, which comes once."""
    last = None
    for batch in batches:
        for at in range(0, len(batch), 512):
            for row in batch.slice(at, 512).to_pylist():
                place = (row["id"], row["tag"], row["start"])
                if (row["shard"], place) != last:
                    yield row["shard"], place, row["words"]
                last = (row["shard"], place)


def _stream_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the pieces of each shard into its automaton and streams each through it at once."""

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["id", "tag", "start", "n"])

    out: list[tuple] = []
    for _, pieces in groupby(_placed(batches), lambda piece: piece[0]):
        place: list = [None]

        def segments(pieces=pieces, place=place) -> Iterator[tuple]:
            for _, place[0], words in pieces:
                yield place[0], np.frombuffer(words, np.uint64).tolist()

        for again in repeated_windows(segments()):
            i, tag, start = place[0]
            step = np.diff(np.concatenate(([0], np.array(again, np.int8), [0])))
            out += [(i, tag, start + int(a), int(b - a)) for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
            if len(out) >= 4096:
                yield rows(out)
                out = []
    if out:
        yield rows(out)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``(id, tag, spans)``: the repeated windows of each document of ``(id, tag, text)`` as runs
    ``(start, n, first)``; the runs marked ``first`` are exceptions from the others and stay."""
    spark = rows.sparkSession
    often = rows.mapInArrow(_anchors, "anchor bigint").groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor")
    schema = "anchor bigint, content bigint, id bigint, tag bigint, start int, n int, again boolean"
    shared = cut(rows.mapInArrow(_segments, schema).join(often, "anchor", "left_semi"))
    # equal segments: the first stays, the others go whole
    place = F.struct("id", "tag", "start")
    folded = cut(shared.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.min("n").alias("n"), F.max("again").alias("again"), F.count(F.lit(1)).alias("c")))
    several = folded.filter("c > 1").select("anchor", "content", "first")
    copies = shared.join(several, ["anchor", "content"]).filter(~place.eqNullSafe(F.col("first"))).select("id", "tag", "start", "n")
    # anchors with segments of different words, or with one that may repeat itself
    words = F.col("n").cast("bigint") + (WINDOW - 1)
    crowd = folded.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.sum(words).alias("held"), F.max("again").alias("again")) \
        .filter("m > 1 OR again").select("anchor", ((F.col("m") > CROWD) | (F.col("held") > CROWD * (SPAN + WINDOW - 1))).alias("crowded"))
    asked, size = cut(folded.join(crowd, "anchor").select(
        "first.id", "first.tag", F.struct("anchor", "first.start", "n", "crowded").alias("seg"), "n", "crowded"),
        words=F.sum(F.when(~F.col("crowded"), words)))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size["words"] / SHARD_WORDS))
    by_doc = asked.groupBy("id", "tag").agg(F.collect_list("seg").alias("segs"))
    cuts = rows.join(by_doc, rows["id"].eqNullSafe(by_doc["id"]) & (rows["tag"] == by_doc["tag"])).select(rows["id"], rows["tag"], "text", "segs")
    pieces = cut(cuts.mapInArrow(_pieces(shards), "shard int, id bigint, tag bigint, start int, words binary, anchor bigint, window bigint"))
    routed = pieces.filter("shard IS NOT NULL").select("shard", "id", "tag", "start", "words") \
        .repartition(shards, "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "tag", "start")
    found = routed.mapInArrow(_stream_shards, "id bigint, tag bigint, start int, n int")
    # crowded anchors: the segments go, but for the windows that stand here first
    crowded = asked.filter("crowded").select("id", "tag", "seg.start", "n")
    firsts = pieces.filter("window IS NOT NULL").groupBy("anchor", "window").agg(F.min(place).alias("at")).select("at.*", F.lit(1).alias("n"), F.lit(True).alias("first"))
    gone = found.unionByName(copies).unionByName(crowded).withColumn("first", F.lit(False))
    return gone.unionByName(firsts).groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n", "first")).alias("spans"))


def keep_first(raw: np.ndarray, spans: list[dict] | None) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Words and removed words of a text, first byte and end of each word, and which words are kept."""
    starts, ends = W.word_spans(raw)
    again = np.zeros(len(starts) + 1, np.int8)
    for s in sorted(spans or (), key=lambda s: s["first"]):
        again[s["start"]:s["start"] + s["n"]] = not s["first"]
    edge = np.diff(again, prepend=np.int8(0))
    step = np.zeros(len(starts) + 1, np.int64)
    step[np.flatnonzero(edge == 1)] += 1
    step[np.flatnonzero(edge == -1) + WINDOW - 1] -= 1
    kept = np.cumsum(step[:-1]) == 0
    return len(starts), int((~kept).sum()), starts, ends, kept


def joined_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> bytes:
    """The kept words joined by one space."""
    text = raw.tobytes()
    return b" ".join([text[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist(), strict=True)])


def remaining_text(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> bytes:
    """The text without the removed words, white space between kept words as it was; each cut becomes one space."""
    text, out = raw.tobytes(), []
    edge = np.flatnonzero(np.diff(np.concatenate(([0], kept.astype(np.int8), [0]))))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        out.append(text[starts[a]:ends[b - 1]])
    return b" ".join(out)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(id, text, spans)`` of every row of ``docs``, and ``row``, a struct of the columns ``carry``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"),
                       *([F.struct(*[F.col(_quoted(c)) for c in carry]).alias("row")] if carry else []))
    spans = cut(repeated_spans(rows.select("id", "tag", "text")))
    spans = spans.select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), "spans")
    return rows.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left").drop("tag", "_id", "_tag")


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text, kept_sha256)`` per document;
    ``kept_text`` is the text that stays, ``kept_sha256`` is of its words
    joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                out = []
                for raw, spans in zip(W.text_bytes(part.column("text")), part.column("spans").to_pylist(), strict=True):
                    n, gone, starts, ends, kept = keep_first(raw, spans)
                    whole = raw.tobytes() if not gone else remaining_text(raw, starts, ends, kept)
                    out.append((n, gone, whole.decode(), hashlib.sha256(joined_words(raw, starts, ends, kept)).hexdigest()))
                n, gone, text, sha = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(text), pa.array(sha)],
                                                 ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])

    return with_spans(docs, id_col=id_col, text_col=text_col).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated spans cut out of the texts (a null text becomes an empty one), ``length_col`` counted anew."""
    carry = [c for c in docs.columns if c != text_col]
    spanned = with_spans(docs.withColumn(text_col, F.col(text_col).cast("string")), id_col=id_col, text_col=text_col, carry=carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = []
                for raw, spans in zip(W.text_bytes(part.column("text")), part.column("spans").to_pylist(), strict=True):
                    gone, *cut_out = keep_first(raw, spans)[1:] if spans else (0,)
                    texts.append((remaining_text(raw, *cut_out) if gone else raw.tobytes()).decode())
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    out = spanned.mapInArrow(run, T.StructType([spanned.schema["row"], T.StructField("text", T.StringType())]))
    new = {text_col: F.col("text")}
    if length_col in carry:
        new[length_col] = F.length("text").cast(docs.schema[length_col].dataType)
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
