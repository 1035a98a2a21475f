"""Byte-level BPE encoding and decoding with the tokenizers library.

The vocabulary is a file of ranked byte sequences (``base64 rank`` per line).
It becomes a BPE model of the tokenizers library: every byte stands for one
printable character (``byte_characters``), and each way in which two tokens
make a third is a merge, in order of the third's rank. Each match of the
split pattern is encoded separately, as the ranks alone would have it.

Texts are encoded an Arrow batch at a time. Words repeat, so the pieces of a
batch of 256 texts are looked up in a bounded table of encoded pieces, and only
the new ones go through the library, in one call without offsets. Whole texts are encoded;
memory grows with the longest text, not with the batch count.

Decoding reverses the byte table. A character whose bytes are split between
tokens comes back whole, as bytes are joined before they are read as UTF-8;
``token_offsets`` places every token by bytes and by the characters it touches.

Defined results: a null text is an empty one, with no ids. Repeated rows are
encoded one by one. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

#: Encoded pieces that a worker keeps; beyond it starts a new table.
KEEP_PIECES = 400_000
LONGEST_KEPT = 64


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: its own where it has
    one in Latin-1, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.chars = byte_characters()
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.kept: dict[str, bytes] = {}
        spell = self._spell
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            cuts = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            merges += [(spell(a), spell(b)) for a, b in sorted(cuts, key=lambda c: (ranks[c[0]], ranks[c[1]]))]
        # a piece that is a token itself is not merged up from bytes
        self.model = Tokenizer(models.BPE({spell(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _spell(self, raw: bytes) -> str:
        return "".join(map(self.chars.__getitem__, raw))

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; the
        pieces that are new to the table go through the library in one call."""
        if len(self.kept) > KEEP_PIECES:
            self.kept = {}
        split = [self.pieces(text) for text in texts]
        new = list({p for pieces in split for p in pieces if p not in self.kept})
        if new:
            coded = self.model.encode_batch_fast(new, add_special_tokens=False)
            self.kept.update((p, np.asarray(e.ids, "<u4").tobytes()) for p, e in zip(new, coded, strict=True))
        known = self.kept
        out = [b"".join([known[p] for p in pieces]) for pieces in split]
        for p in new:
            if len(p) > LONGEST_KEPT:
                del known[p]
        return out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def token_offsets(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Per token: first byte, end byte, first character, end character;
        the characters are those of which the token has any byte."""
        raw = self.decode_bytes(ids)
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        char = np.cumsum(lead) - 1          # character of each byte
        out, at = [], 0
        for i in ids.tolist():
            end = at + len(self.tokens[i])
            out.append((at, end, int(char[at]), int(char[end - 1]) + 1))
            at = end
        return out


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    """The encoder of a vocabulary file that every executor has; one per worker."""
    return ByteBpe(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                     offsets: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: the ids packed as little-endian
    unsigned 32-bit integers and the bytes decoded from them; with ``offsets``
    also ``spans``, four unsigned 32-bit integers per token."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids = bpe.encode_batch([t or "" for t in part.column(1).to_pylist()])
                arrays = [np.frombuffer(i, "<u4") for i in ids]
                cols = [part.column(0), pa.array([len(a) for a in arrays], pa.int64()), pa.array(ids, pa.binary()),
                        pa.array([bpe.decode_bytes(a) for a in arrays], pa.binary())]
                if offsets:
                    cols.append(pa.array([np.asarray(bpe.token_offsets(a), "<u4").tobytes() for a in arrays], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids", "decoded", "spans"][:len(cols)])

    schema = f"id {kind}, n_tokens bigint, ids binary, decoded binary" + (", spans binary" if offsets else "")
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
            .withColumnRenamed("id", "doc_id"))


def digest_documents(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: digests of what
    ``encode_documents`` gives, taken where the ids are made; with ``keep_ids``
    also ``ids``."""
    kind = docs.schema[id_col].dataType.simpleString()
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids = bpe.encode_batch([t or "" for t in part.column(1).to_pylist()])
                cols = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha(i) for i in ids], pa.string()),
                        pa.array([sha(bpe.decode_bytes(np.frombuffer(i, "<u4"))) for i in ids], pa.string())]
                if keep_ids:
                    cols.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])

    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids binary" if keep_ids else "")
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
            .withColumnRenamed("id", "doc_id"))


def count_tokens(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text") -> DataFrame:
    """``(n_tokens)`` of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 256):
                texts = batch.slice(at, 256).column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([len(i) // 4 for i in bpe.encode_batch([t or "" for t in texts])], pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n_tokens bigint")
