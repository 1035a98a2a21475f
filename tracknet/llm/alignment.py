"""Alignment of two tokenizers on the same texts, by composing fragments.

A text, with a space before it, is tokenized by A (byte-level BPE, tokenizers
library) and by B (sentencepiece, which adds that space). Where a token of each
ends at the same byte, the text is cut into groups; tokens of A and B in one
group are linked.

The unit of work is the fragment of a byte range: the tokens that end in it,
as an open prefix (up to the first common end), closed groups, and an open
suffix (after the last common end); without a common end everything is open.
Fragments of neighbouring ranges compose, and composing is associative: the
left one's suffix and the right one's prefix close one more group. So a range
can be worked out anywhere and composed in any grouping:

* Words stand between spaces that have no white space beside them. Both
  tokenizers end a token there, so a word's tokens do not depend on its
  neighbours. Its fragment is worked out once and kept in a bounded table.
* A document of at most ``CHUNK`` bytes is one range. A longer one is cut into
  ranges of that many bytes, inside words too, which are dealt over all tasks;
  their fragments are reduced in a tree of ``FAN`` at a time. Only open ends
  travel up the tree: closed groups are counted where they close. (A word
  longer than ``CHUNK`` stays in one range: both tokenizers need it whole.)

The counts of linked id pairs: a block of documents (``BLOCK`` bytes of text)
gives each of its id pairs once with the number of documents that hold it.
These are summed over the corpus, and a block gets back one row for each pair,
with which its documents are scored. So nothing has a row per link or per
document and pair, and a common pair has one row per block. Long documents give
their pairs one by one, so that a pair in several ranges counts once. The
highest count of each A id is broadcast: at most one row per id of A.

Defined results: null or empty texts, and texts that either tokenizer does not
give back byte by byte, have no tokens: zeros and no groups. Special tokens'
strings are plain text. Repeated rows are documents of their own. Null ids are
kept, extra columns are not read, an empty table gives no rows. A document's
words are held in memory while it is cut; everything else is bounded by ``SLICE``,
``CHUNK``, ``BLOCK`` and ``KEEP_WORDS``, and by the longest group.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tracknet.llm import words as W
from tracknet.llm.bpe import byte_characters
from tracknet.plans.iterate import cut, rows

CHUNK = 1 << 16
FAN = 64
BLOCK = 4 << 20
BLOCKS_A_TASK = 4
#: Bytes of text and documents whose words are looked up at a time.
SLICE = 1 << 20
SLICE_DOCUMENTS = 256
#: Words, and id pairs of words, that a worker keeps; beyond it starts a new table before the next slice.
KEEP_WORDS = 100_000
KEEP_PAIRS = 2_000_000
#: New words tokenized in one call; longer ones than that many characters are taken one by one.
JOINED = 2_000
LONGEST_JOINED = 1_000

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def split_words(text: str) -> list[str]:
    """The parts of a text between single spaces without white space beside
    them. Each stands after a space of its own (the first after the added one)."""
    parts = text.split(" ")
    for p in parts:
        if not p or p[0].isspace() or p[-1].isspace():
            return _BETWEEN.split(text)
    return parts


class Tokens(NamedTuple):
    """Ids of a stretch and the byte at which each token ends."""

    a: list[int]
    a_ends: list[int]
    b: list[int]
    b_ends: list[int]


class Fragment(NamedTuple):
    """Open prefix, closed groups, open suffix; without a common end (``cut``
    false) all tokens are in the prefix. Groups are pairs of id tuples."""

    cut: bool
    head: tuple[tuple[int, ...], tuple[int, ...]]
    closed: tuple[tuple[tuple[int, ...], tuple[int, ...]], ...] = ()
    tail: tuple[tuple[int, ...], tuple[int, ...]] = ((), ())


NONE: tuple[tuple[int, ...], tuple[int, ...]] = ((), ())
#: A place where both tokenizers end a token, as between two words.
BOUNDARY = Fragment(True, NONE)


def _join(x, y):
    return x[0] + y[0], x[1] + y[1]


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not x.cut:
        return y._replace(head=_join(x.head, y.head))
    if not y.cut:
        return x._replace(tail=_join(x.tail, y.head))
    seam = _join(x.tail, y.head)
    return Fragment(True, x.head, (*x.closed, *([seam] if seam != NONE else []), *y.closed), y.tail)


def fragment(t: Tokens, low: int = 0, high: int | None = None) -> Fragment:
    """The fragment of the tokens that end behind byte ``low`` and not behind ``high``."""
    common = set(t.a_ends) & set(t.b_ends)
    inside = [e for e in sorted(common) if e > low and (high is None or e <= high)]
    sides = []
    for ids, ends in ((t.a, t.a_ends), (t.b, t.b_ends)):
        groups: list[list[int]] = [[] for _ in range(len(inside) + 1)]
        k = 0
        for i, e in zip(ids, ends, strict=True):
            if e <= low or (high is not None and e > high):
                continue
            while k < len(inside) and e > inside[k]:
                k += 1
            groups[k].append(i)
        sides.append([tuple(g) for g in groups])
    groups = tuple(zip(*sides, strict=True))
    return Fragment(True, groups[0], groups[1:-1], groups[-1]) if inside else Fragment(False, groups[0])


def shown(groups) -> str:
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def group_pairs(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of a group, as ``a << 32 | b``, and how many links each has."""
    x, n = np.unique(np.asarray(a, np.int64), return_counts=True)
    y, m = np.unique(np.asarray(b, np.int64), return_counts=True)
    return ((x[:, None] << 32) | y).reshape(-1), np.multiply.outer(n, m).reshape(-1)


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct code with the sum of its times."""
    if not len(codes):
        return codes, times
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(times[order], first)


def pairs_of(groups) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of several groups and their links."""
    got = [group_pairs(a, b) for a, b in groups]
    return summed(np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]))


class Words:
    """What each known word adds to its document. Numbers are rows of the
    columns; a word's id pairs are a stretch of ``codes`` and ``times``."""

    COLUMNS = ("ok", "n_a", "n_b", "n_groups", "n_links", "first", "held")

    def __init__(self):
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.rows = {c: np.zeros(1 << 12, np.int64) for c in self.COLUMNS}
        self.codes, self.times, self.used = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, words: list[str], groups: list[str], codes: np.ndarray, times: np.ndarray, **columns: np.ndarray) -> None:
        n, more = len(self.groups), len(words)
        while n + more > len(self.rows["ok"]):
            self.rows = {c: np.concatenate((x, np.zeros_like(x))) for c, x in self.rows.items()}
        while self.used + len(codes) > len(self.codes):
            self.codes, self.times = (np.concatenate((x, np.zeros_like(x))) for x in (self.codes, self.times))
        columns["first"] = self.used + np.cumsum(columns["held"]) - columns["held"]
        for c in self.COLUMNS:
            self.rows[c][n:n + more] = columns[c]
        self.codes[self.used:self.used + len(codes)] = codes
        self.times[self.used:self.used + len(codes)] = times
        self.used += len(codes)
        self.number.update(zip(words, range(n, n + more), strict=True))
        self.groups += groups


class Aligner:
    """Both tokenizers and the table of words."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab()
        self.size_a = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.size_a[i] = len(piece) if all(c in byte for c in piece) else 0     # a character for each byte
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            raw = _BYTE.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode())
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.names = [str(i) for i in range(max(len(self.size_a), len(self.size_b)))]
        self.words = Words()

    def tokens(self, words: list[str]) -> list[tuple[bool, Tokens]]:
        """Ids and byte ends of each word after its space, and whether B gives the bytes back."""
        out = []
        coded = self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)
        for w, e, b in zip(words, coded, self.b.encode(words, num_threads=1), strict=True):
            spelled = b"".join([self.bytes_b[i] for i in b])
            out.append((spelled == b" " + w.encode(), Tokens(e.ids, np.cumsum(self.size_a[e.ids]).tolist(), b, np.cumsum(self.size_b[b]).tolist())))
        return out

    def learn(self, texts: list[list[str]]) -> Words:
        """The table, with every word of the texts in it."""
        known = self.words.number
        new = {w for words in texts for w in words if w not in known}
        plain = [w for w in new if w and len(w) <= LONGEST_JOINED and not w[0].isspace() and not w[-1].isspace()]
        # new words are tokenized many at a time, as one text of words
        for k in range(0, len(plain), JOINED):
            if not self._learn_joined(plain[k:k + JOINED]):
                self._learn_each(plain[k:k + JOINED])
        self._learn_each(list(new.difference(plain)))
        return self.words

    def _learn_each(self, words: list[str]) -> None:
        for w, (ok, t) in zip(words, self.tokens(words) if words else (), strict=True):
            f = fragment(t)
            groups = (f.head, *f.closed) if ok else ()
            codes, times = pairs_of(groups) if ok else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            self.words.add([w], [shown(groups)], codes, times, ok=ok, n_a=len(t.a) * ok, n_b=len(t.b) * ok, n_groups=len(groups),
                           n_links=sum(len(a) * len(b) for a, b in groups), held=np.array([len(codes)]))

    def _learn_joined(self, words: list[str]) -> bool:
        """The same for words that can stand side by side; False if B does not give them back."""
        text = " ".join(words)
        a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
        listed = self.b.encode(text, num_threads=1)
        b = np.array(listed, np.int64)
        if b"".join([self.bytes_b[i] for i in listed]) != b" " + text.encode():
            return False
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        in_a, in_b, word = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b), np.searchsorted(ends, common)
        n_a, n_b = np.bincount(in_a, minlength=len(common)), np.bincount(in_b, minlength=len(common))
        # every token of A with every token of B of its group
        times = n_b[in_a]
        x = np.repeat(np.arange(len(a)), times)
        y = np.repeat((np.cumsum(n_b) - n_b)[in_a] - (np.cumsum(times) - times), times) + np.arange(len(x))
        distinct, code = np.unique((a[x] << 32) | b[y], return_inverse=True)
        key, links = np.unique(word[in_a[x]] * len(distinct) + code, return_counts=True)
        of, code = np.divmod(key, len(distinct))
        per_word = lambda at, n=None: np.bincount(at, n, minlength=len(words)).astype(np.int64)
        names = self.names
        texts, i, j = [], 0, 0
        left, right = [names[k] for k in a.tolist()], [names[k] for k in listed]
        for p, q in zip(n_a.tolist(), n_b.tolist(), strict=True):
            texts.append(f"{left[i]}|{right[j]}" if p == 1 == q else f"{','.join(left[i:i + p])}|{','.join(right[j:j + q])}")
            i, j = i + p, j + q
        edge = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        self.words.add(words, [";".join(texts[p:q]) for p, q in zip(edge, edge[1:])], distinct[code], links, ok=np.ones(len(words), np.int64),
                       n_a=per_word(word, n_a), n_b=per_word(word, n_b), n_groups=per_word(word), n_links=per_word(word, n_a * n_b), held=per_word(of))
        return True

    def forget(self) -> None:
        """Starts a new table where the old one has grown."""
        if len(self.words.groups) > KEEP_WORDS or self.words.used > KEEP_PAIRS:
            self.words = Words()


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def document_pairs(words: Words, numbers: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs and their links of several texts, and where each
    text's begin; a text's words are the numbers from its edge to the next."""
    n = len(edges) - 1
    doc = np.repeat(np.arange(n), np.diff(edges))
    used, num = np.unique(numbers, return_inverse=True)
    held = words.rows["held"][used]
    upto = np.cumsum(held)
    stretch = np.repeat(words.rows["first"][used] - (upto - held), held) + np.arange(int(held.sum()))
    codes, times = words.codes[stretch], words.times[stretch]
    # each distinct word of a text once, with how often it stands there; then its pairs
    at, count = np.unique(doc * max(1, len(used)) + num, return_counts=True)
    doc, num = np.divmod(at, max(1, len(used)))
    more = held[num]
    take = np.repeat((upto - held)[num] - (np.cumsum(more) - more), more) + np.arange(int(more.sum()))
    distinct, code = np.unique(codes, return_inverse=True)
    key, total = summed(np.repeat(doc, more) * max(1, len(distinct)) + code[take], times[take] * np.repeat(count, more))
    doc, code = np.divmod(key, max(1, len(distinct)))
    return distinct[code], total, np.searchsorted(doc, np.arange(n + 1))


#: What a worker gives: ``whole`` documents, ``part`` ranges of long ones, and each ``block``'s id pairs.
_MADE = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("id", T.StringType()), T.StructField("key", T.LongType()), T.StructField("at", T.LongType()),
    T.StructField("ok", T.BooleanType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("sha", T.StringType()), T.StructField("groups", T.StringType()),
    T.StructField("cut", T.BooleanType()), T.StructField("head", T.BinaryType()), T.StructField("tail", T.BinaryType()),
    T.StructField("block", T.LongType()), T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType()),
    T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("docs", T.ArrayType(T.LongType())),
])


def _arrow(schema: T.StructType, id_type: pa.DataType) -> pa.Schema:
    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(),
             T.ArrayType(T.LongType()): pa.list_(pa.int64())}
    return pa.schema([(f.name, id_type if f.name == "id" else kinds[f.dataType]) for f in schema])


def _pack(open_end: tuple[tuple[int, ...], tuple[int, ...]]) -> bytes:
    a, b = open_end
    return np.array([len(a), *a, *b], "<u4").tobytes()


def _unpack(raw: bytes) -> tuple[tuple[int, ...], tuple[int, ...]]:
    x = np.frombuffer(raw, "<u4").tolist()
    return tuple(x[1:1 + x[0]]), tuple(x[1 + x[0]:])


def _ranges(chunk: int):
    """Rows ``(id, key, text)`` of long documents as ranges ``(id, key, at,
    text, low, high)``: the words that reach into a range, and the bytes of
    them, spaces counted, between which its tokens end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                words = split_words(batch.column(2)[row].as_py())
                ends = np.cumsum([len(w.encode()) + 1 for w in words])
                edges = np.append(np.arange(chunk, ends[-1], chunk), ends[-1])
                # no edge inside a word longer than a range
                first = np.searchsorted(ends, edges)
                size = np.diff(ends, prepend=0)[first]
                edges = np.unique(np.where(size > chunk, ends[first], edges))
                low = 0
                for at, high in enumerate(edges.tolist()):
                    i, j = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high)) + 1
                    start = int(ends[i - 1]) if i else 0
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(row, 1), batch.column(1).slice(row, 1), pa.array([at], pa.int64()), pa.array([" ".join(words[i:j])]),
                         pa.array([low - start], pa.int64()), pa.array([high - start], pa.int64())], ["id", "key", "at", "text", "low", "high"])
                    low = high

    return run


def cut_words(aligner: Aligner, words: list[str], low: int, high: int) -> tuple[bool, Fragment, list[str], Fragment]:
    """Of a range: whether B gives the words at its edges back, the fragment of
    the word that its lower edge cuts, the whole words, and the fragment of the
    word that its upper edge cuts."""
    size = lambda w: len(w.encode()) + 1
    total = sum(map(size, words))
    first, last = low > 0, high < total
    tokens = aligner.tokens([words[0]] * first + [words[-1]] * last)
    before = fragment(tokens[0][1], low) if first else BOUNDARY
    after = compose(BOUNDARY, fragment(tokens[-1][1], 0, high - total + size(words[-1]))) if last else BOUNDARY
    return all(ok for ok, _ in tokens), before, words[int(first):len(words) - int(last)], after


def _align(path_a: str, path_b: str, keep_groups: bool, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        aligner = load(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        held: list[dict] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, number
            codes, at = np.unique(_flat([r["pairs"] for r in held]), return_inverse=True)
            docs = np.zeros(len(codes), np.int64)
            edge = 0
            for r in held:
                upto = edge + len(r["pairs"])
                where = at[edge:upto]
                if r["kind"] == "whole":
                    docs[where] += 1
                else:
                    r["codes"] = r["pairs"].tolist()
                r["pairs"], r["times"], r["block"] = where.astype("<u4").tobytes(), r["times"].astype("<u8" if r["times"].max(initial=0) >> 32 else "<u4").tobytes(), number
                edge = upto
            held.append({"kind": "block", "block": number, "codes": codes, "docs": docs})
            for k in range(0, len(held), 512):
                yield pa.RecordBatch.from_pylist(held[k:k + 512], schema=names)
            number += 1
            held, size = [], 0

        for batch in batches:
            names = _arrow(_MADE, batch.schema.field("id").type)
            for start, upto in W.slices(batch.column("text"), SLICE, SLICE_DOCUMENTS):
                aligner.forget()
                part = batch.slice(start, upto - start).to_pylist()
                made, texts = [], []
                for r in part:
                    words = split_words(r["text"]) if r["text"] else []
                    row = {"kind": "whole" if r["at"] is None else "part", "id": r["id"], "key": r["key"], "at": r["at"], "ok": bool(words)}
                    if r["at"] is not None:
                        ok, before, words, after = cut_words(aligner, words, r["low"], r["high"])
                        row |= {"ok": ok, "ends": (before, after)}
                    made.append(row)
                    texts.append(words)
                    size += len(r["text"] or "")
                table = aligner.learn(texts)
                known, rows_of = table.number, table.rows
                numbers = [[known[w] for w in words] for words in texts]
                for row, nums in zip(made, numbers, strict=True):
                    row["ok"] = row["ok"] and bool(rows_of["ok"][nums].all())
                    if not row["ok"]:
                        nums.clear()
                edges = np.cumsum([0, *map(len, numbers)])
                flat = np.array([k for nums in numbers for k in nums], np.int64)
                codes, times, places = document_pairs(table, flat, edges)
                sums = {c: np.diff(np.concatenate(([0], np.cumsum(rows_of[c][flat])))[edges]).tolist() for c in ("n_a", "n_b", "n_groups", "n_links")}
                for k, (row, nums) in enumerate(zip(made, numbers, strict=True)):
                    text = ";".join([table.groups[x] for x in nums])
                    pairs = slice(places[k], places[k + 1])
                    row |= {c: sums[c][k] for c in sums} | {"pairs": codes[pairs], "times": times[pairs]}
                    if row["kind"] == "whole":
                        row["sha"] = hashlib.sha256(text.encode()).hexdigest() if row["ok"] else ""
                        row["groups"] = text if keep_groups else None
                    else:
                        _close(row, text)
                    held.append(row)
                if size >= block_bytes:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _close(row: dict, middle: str) -> None:
    """Puts a range together: the closed groups of its cut words around those
    of its whole ones, and the open ends."""
    before, after = row.pop("ends")
    if not row["ok"]:
        row |= {"cut": True, "head": _pack(NONE), "tail": _pack(NONE), "groups": ""}
        return
    extra = (*before.closed, *after.closed)
    if extra:
        codes, times = pairs_of(extra)
        row["pairs"], row["times"] = summed(np.concatenate([row["pairs"], codes]), np.concatenate([row["times"], times]))
        row |= {"n_a": row["n_a"] + sum(len(a) for a, _ in extra), "n_b": row["n_b"] + sum(len(b) for _, b in extra),
                "n_groups": row["n_groups"] + len(extra), "n_links": row["n_links"] + sum(len(a) * len(b) for a, b in extra)}
    row |= {"cut": True, "head": _pack(before.head), "tail": _pack(after.tail), "groups": ";".join(filter(None, (shown(before.closed), middle, shown(after.closed))))}


_STATE = ("seam boolean, key bigint, at bigint, ok boolean, cut boolean, cut_at bigint, head binary, tail binary, "
          "groups string, codes array<bigint>, times array<bigint>, n_a bigint, n_b bigint, n_links bigint")
_STATE_ARROW = pa.schema([("seam", pa.bool_()), ("key", pa.int64()), ("at", pa.int64()), ("ok", pa.bool_()), ("cut", pa.bool_()), ("cut_at", pa.int64()),
                          ("head", pa.binary()), ("tail", pa.binary()), ("groups", pa.string()), ("codes", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
                          ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_links", pa.int64())])


def _compose_rows(fan: int):
    """One level of the tree: rows by key and place; each ``fan`` neighbours
    become one fragment, and every group that closes between them a row. A
    group's place is that of the range in which it closes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        out: list[dict] = []

        def closed(x: dict) -> dict:
            return {"seam": False, "key": x["key"], "at": x["at"], "ok": x["ok"], "cut": x["f"].cut, "cut_at": x["cut_at"],
                    "head": _pack(x["f"].head), "tail": _pack(x["f"].tail)}

        for batch in batches:
            for r in batch.to_pylist():
                f = Fragment(r["cut"], _unpack(r["head"]), (), _unpack(r["tail"]))
                slot = r["at"] // fan
                if held is None or (held["key"], held["at"]) != (r["key"], slot):
                    if held:
                        out.append(closed(held))
                    held = {"key": r["key"], "at": slot, "ok": r["ok"], "cut_at": r["cut_at"], "f": f}
                    continue
                joined = compose(held["f"], f)
                for a, b in joined.closed:
                    codes, times = group_pairs(a, b)
                    out.append({"seam": True, "key": r["key"], "at": r["cut_at"], "groups": shown([(a, b)]), "codes": codes, "times": times,
                                "n_a": len(a), "n_b": len(b), "n_links": len(a) * len(b)})
                held["cut_at"] = held["cut_at"] if held["f"].cut else r["cut_at"]
                held["f"], held["ok"] = joined._replace(closed=()), held["ok"] and r["ok"]
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pylist(out, schema=_STATE_ARROW)
                    out = []
        if held:
            out.append(closed(held))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_STATE_ARROW)

    return run


def reduce_fragments(parts: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """``(roots, seams)``: one fragment per long document and the groups that
    closed between ranges. ``parts`` has ``(key, at, ok, cut, head, tail)``."""
    state, top = cut(parts.select("key", "at", "ok", "cut", F.col("at").alias("cut_at"), "head", "tail"), most=F.max("at"))
    seams = []
    while not seams or top["most"] > 0:
        slot = F.floor(F.col("at") / fan)
        dealt = state.withColumn("slot", slot).repartition("key", "slot").sortWithinPartitions("key", "slot", "at").drop("slot")
        level, top = cut(dealt.mapInArrow(_compose_rows(fan), _STATE), most=F.max(F.when(~F.col("seam"), F.col("at"))))
        seams.append(level.filter("seam"))
        state = level.filter("NOT seam").select("key", "at", "ok", "cut", "cut_at", "head", "tail")
    closed = seams[0]
    for s in seams[1:]:
        closed = closed.unionByName(s)
    return state, closed


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block in order: first its pairs' counts, then its documents."""
    block, count, best = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        answer = batch.column("pos").is_valid().to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(blocks)) + 1
        n_best, total = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True):
            if high <= low:
                continue
            if blocks[low] != block:
                block, count, best = blocks[low], np.zeros(0, np.int64), np.zeros(0, np.int64)
            # within a block the counts come first, by their places
            upto = low + int(answer[low:high].sum())
            if upto > low:
                count = np.append(count, batch.column("n").slice(low, upto - low).to_numpy())
                best = np.append(best, batch.column("best").slice(low, upto - low).to_numpy(zero_copy_only=False).astype(np.int64))
            for k in range(upto, high):
                at = np.frombuffer(batch.column("pairs")[k].as_py(), "<u4")
                times = batch.column("times")[k].as_py()
                times = np.frombuffer(times, "<u8" if len(times) > 4 * len(at) else "<u4").astype(np.int64)
                n_best[k], total[k] = int((times * best[at]).sum()), int((times * count[at]).sum())
        keep = pa.array(~answer)
        cols = [batch.column(c) for c in ("kind", "id", "key", "at", "n_a", "n_b", "n_groups", "n_links", "sha", "groups")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(n_best), pa.array(total)],
                                         ["kind", "id", "key", "at", "n_a", "n_b", "n_groups", "n_links", "sha", "groups", "n_best", "count_sum"]).filter(keep)


def _digest(keep_groups: bool):
    """Strings of groups by document and place, as one digest (and string) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, held, begun = None, None, [], False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([sha.hexdigest()]), pa.array([";".join(held) if keep_groups else None], pa.string())],
                                              ["key", "sha", "groups"])

        for batch in batches:
            for k, text in zip(batch.column("key").to_pylist(), batch.column("groups").to_pylist(), strict=True):
                if sha is None or k != key:
                    if sha is not None:
                        yield done()
                    key, sha, held, begun = k, hashlib.sha256(), [], False
                if text:
                    sha.update((";" + text if begun else text).encode())
                    begun = True
                    if keep_groups:
                        held.append(text)
        if sha is not None:
            yield done()

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, fan: int = FAN,
                    block: int = BLOCK, keep_groups: bool = False) -> DataFrame:
    """Per row of ``docs``: ``(id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256)``, with ``keep_groups`` also ``groups``, the text
    ``a1,a2|b1;a3|b2,b3`` of its groups. ``path_a`` and ``path_b`` are files
    that every executor has."""
    kind = docs.schema[id_col].dataType
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > chunk
    none = F.lit(None).cast("bigint")
    short = text.filter(~is_long).select("id", none.alias("key"), none.alias("at"), "text", none.alias("low"), none.alias("high"))
    simple = kind.simpleString()
    ranges = text.filter(is_long).select("id", F.monotonically_increasing_id().alias("key"), "text") \
        .mapInArrow(_ranges(chunk), f"id {simple}, key bigint, at bigint, text string, low bigint, high bigint").repartition("key", "at")
    schema = T.StructType([T.StructField("id", kind) if f.name == "id" else f for f in _MADE])
    made, n = cut(short.unionByName(ranges).mapInArrow(_align(path_a, path_b, keep_groups, block), schema), parts=F.count(F.when(F.col("kind") == "part", 1)),
                  blocks=F.count(F.when(F.col("kind") == "block", 1)))
    # a task scores a few blocks, however many there are
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n["blocks"] // BLOCKS_A_TASK))

    zipped = F.posexplode(F.arrays_zip("codes", "docs")).alias("pos", "x")
    listed = made.filter("kind = 'block'").select("block", zipped).select("block", "pos", F.col("x.codes").alias("code"), F.col("x.docs").alias("docs"))
    holders = listed.groupBy("code").agg(F.sum("docs").alias("n"))
    if n["parts"]:
        parts = made.filter("kind = 'part'")
        roots, seams = reduce_fragments(parts, fan)
        right = cut(roots.filter("ok").select("key"))
        held = parts.select("key", "codes").unionByName(seams.select("key", "codes")).join(right, "key", "left_semi")
        holders = holders.unionByName(held.select("key", F.explode("codes").alias("code")).distinct().groupBy("code").agg(F.count(F.lit(1)).alias("n"))) \
            .groupBy("code").agg(F.sum("n").alias("n"))
    counts = cut(holders.filter("n > 0"))
    a_id = F.shiftright("code", 32)
    # one row per id of A: no more than its vocabulary
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    ranked = cut(counts.withColumn("a", a_id).join(F.broadcast(most), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")))

    of_docs = ["kind", "id", "key", "at", "n_a", "n_b", "n_groups", "n_links", "sha", "groups", "pairs", "times"]
    answers = listed.join(ranked, "code", "left").select("block", F.col("pos").cast("bigint").alias("pos"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
                                                        F.coalesce("best", F.lit(False)).alias("best"), *[F.lit(None).cast(schema[c].dataType).alias(c) for c in of_docs])
    asked = made.filter("kind <> 'block'").select("block", none.alias("pos"), none.alias("n"), F.lit(None).cast("boolean").alias("best"), *of_docs)
    ordered = answers.unionByName(asked).repartition(tasks, "block").sortWithinPartitions("block", F.col("pos").asc_nulls_last())
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    scored = ordered.mapInArrow(_score, f"kind string, id {simple}, key bigint, at bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                        "sha string, groups string, n_best bigint, count_sum bigint")
    final = ["id", *sums, F.col("sha").alias("groups_sha256")] + (["groups"] if keep_groups else [])
    if not n["parts"]:
        return scored.select(*final)
    scored = cut(scored)
    whole = scored.filter("kind = 'whole'").select(*final)
    between = seams.select("key", "n_a", "n_b", "n_links", F.posexplode(F.arrays_zip("codes", "times")).alias("pos", "x")) \
        .select("key", F.col("x.codes").alias("code"), F.col("x.times").alias("times"), *[F.when(F.col("pos") == 0, F.col(c)).otherwise(0).alias(c) for c in ("n_a", "n_b", "n_links")],
                (F.col("pos") == 0).cast("bigint").alias("n_groups")) \
        .join(ranked, "code").select("key", "n_a", "n_b", "n_groups", "n_links", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                                     (F.col("times") * F.col("n")).alias("count_sum"))
    of_long = scored.filter("kind = 'part'").select("key", *sums).unionByName(between).groupBy("key").agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])
    strings = parts.select("key", "at", F.lit(1).alias("sub"), "groups").unionByName(seams.select("key", "at", F.lit(0).alias("sub"), "groups"))
    digests = strings.join(right, "key", "left_semi").repartition("key").sortWithinPartitions("key", "at", "sub") \
        .mapInArrow(_digest(keep_groups), "key bigint, sha string, groups string")
    named = parts.filter("at = 0").select("id", "key")
    zero = [F.coalesce(F.when(F.col("sha").isNotNull(), F.col(c)), F.lit(0).cast("bigint")).alias(c) for c in sums]
    gathered = named.join(of_long, "key", "left").join(digests, "key", "left").select(
        "id", *zero, F.coalesce("sha", F.lit("")).alias("groups_sha256"), *([F.coalesce("groups", F.lit("")).alias("groups")] if keep_groups else []))
    return whole.unionByName(gathered)
