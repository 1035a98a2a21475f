import hashlib
import random
from collections import Counter
from functools import lru_cache
from types import SimpleNamespace

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracknet.llm import alignment as A
from tracknet.llm import queries as Q

PATHS = [P.path(f) for f in Q.TOKENIZERS]


@lru_cache
def both():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


@pytest.fixture(scope="module")
def coders():
    return both()


def shown_bytes():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in own}
    chars |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    return chars


def brute_groups(coders, text):
    """The groups of a whole text, tokenized in one piece; None without tokens."""
    if not text:
        return None
    a, b = coders
    byte = shown_bytes()
    e = a.encode(" " + text, add_special_tokens=False)
    spelled_a = [bytes(byte[c] for c in t) for t in e.tokens]
    ids = b.encode(text)
    spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, b.id_to_piece(ids), strict=True)]
    if not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode():
        return None
    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out
    ea, eb = ends(spelled_a), ends(spelled_b)
    common = set(ea) & set(eb)
    groups = []
    for ids_of, ends_of, side in ((e.ids, ea, 0), (ids, eb, 1)):
        held, k = [], 0
        for i, x in zip(ids_of, ends_of, strict=True):
            held.append(i)
            if x in common:
                if side == 0:
                    groups.append((held, None))
                else:
                    groups[k] = (groups[k][0], held)
                held, k = [], k + 1
    return groups


def contract(coders, rows):
    groups = [brute_groups(coders, t) for _, t in rows]
    links = [Counter((a, b) for x, y in g or [] for a in x for b in y) for g in groups]
    count = Counter(p for n in links for p in n)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), g, n in zip(rows, groups, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g or [])
        out.append((i, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), n.total(),
                    sum(k for p, k in n.items() if count[p] == most[p[0]]), sum(k * count[p] for p, k in n.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


ODD = ["", " ", "  ", " a", "a ", "a  b", "\n", "a\n\nb c", "x\t y", "tab\tx", "▁", "a ▁b", "a▁", "<s> </s> <unk>", "<0x41>", "<|endoftext|> x<|endoftext|>",
       "\x00 a\x00", "é é ﬁ ① 日本語 テスト", "don't we'll 's", "a\xa0b \xa0 c", "​   z\x1c y", "😀 😀😀👩‍👩‍👧", "1234 5 678,9", "﻿a ﻿", "a\r\nb\r {\r",
       "ااا العربية", "()[]{}  ;;\r ;\r"]


def corpus(seed=2, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Ünïcode", "supercalifragilistic", "don't", "x,y", "\n", "日本", "a.b;c", "42", "", "  ", "teh\nend", "ZZZ", "é"] + [
        "".join(rng.choice("aeioustrnlé") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_words_are_tokenized_as_in_the_whole_text(coders):
    aligner = A.load(*PATHS)
    for text in ODD + corpus(5, 60):
        if not text:
            continue
        words = A.split_words(text)
        assert " ".join(words) == text
        tokens = aligner.tokens(words)
        assert sum((t.a for _, t in tokens), []) == coders[0].encode(" " + text, add_special_tokens=False).ids, text
        if all(ok for ok, _ in tokens):
            assert sum((t.b for _, t in tokens), []) == coders[1].encode(text), text
        assert all(ok for ok, _ in tokens) == (brute_groups(coders, text) is not None), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é \n\t'▁日<0x1>.,3 \xa0 \x1c")), min_size=1, max_size=30))
def test_words_cut_any_text_where_both_end(text):
    aligner = A.load(*PATHS)
    a, b = both()
    tokens = aligner.tokens(A.split_words(text))
    assert sum((t.a for _, t in tokens), []) == a.encode(" " + text, add_special_tokens=False).ids
    if "▁" not in text:
        assert sum((t.b for _, t in tokens), []) == b.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=30), st.randoms())
def test_composition_is_associative(sizes, rng):
    """Any cuts of any token ends, composed in any grouping, give the whole."""
    n = sum(sizes)
    ends_a = sorted(rng.sample(range(1, n + 1), rng.randint(1, n)) + [n])
    ends_b = sorted(rng.sample(range(1, n + 1), rng.randint(1, n)) + [n])
    ends_a, ends_b = sorted(set(ends_a)), sorted(set(ends_b))
    t = A.Tokens([100 + e for e in ends_a], ends_a, [500 + e for e in ends_b], ends_b)
    edges = [0, *sorted(rng.sample(range(1, n), rng.randint(0, n - 1))), n] if n > 1 else [0, n]
    parts = [A.fragment(t, x, y) for x, y in zip(edges, edges[1:])]
    while len(parts) > 1:
        k = rng.randrange(len(parts) - 1)
        parts[k:k + 2] = [A.compose(parts[k], parts[k + 1])]
    assert parts[0] == A.fragment(t)
    assert A.compose(A.BOUNDARY, parts[0]).head == A.NONE


@pytest.mark.parametrize("chunk,fan,block", [(1 << 16, 64, 8 << 20), (64, 2, 700), (9, 3, 5000)])
def test_documents_are_those_of_brute_force(spark, coders, chunk, fan, block):
    texts = ODD + corpus()
    rows = [(k, t) for k, t in enumerate(texts)] + [(900, None), (None, "a null id"), (None, None), (3, texts[3]), (40, texts[40]), (40, texts[40])]
    rows += [(1000, "x" * 500), (1001, "word " * 300), (1002, "fine words " * 20 + "▁ then not"), (1003, "日本語" * 100 + " end")]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id bigint, text string, key int, groups string, kind string").repartition(3)
    got = A.align_documents(docs, *PATHS, chunk=chunk, fan=fan, block=block, keep_groups=True)
    out = [tuple(r) for r in got.collect()]
    order = lambda r: str(r)
    assert sorted((r[:8] for r in out), key=order) == sorted(contract(coders, rows), key=order)
    assert all(hashlib.sha256(r[8].encode()).hexdigest() == r[7] if r[7] else r[8] == "" for r in out)


def test_query_and_empty_table(spark, coders, tmp_path):
    rows = [(k, t) for k, t in enumerate(corpus(8, 40))] + [(99, " ".join(corpus(9, 400)))]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in Q.op11_alignment(spark, str(tmp_path)).collect()) == sorted(contract(coders, rows))
    assert A.align_documents(spark.createDataFrame([], "doc_id string, text string"), *PATHS).collect() == []


def test_table_of_words_stays_small_within_a_block(monkeypatch):
    texts = [" ".join(f"q{i}w{k}" for k in range(10)) for i in range(900)] + [None, "q1w1 q2w2"]
    none = pa.nulls(len(texts), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), none, none, pa.array(texts, pa.string()), none, none],
                                       ["id", "key", "at", "text", "low", "high"])
    monkeypatch.setattr(A, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def made(keep):
        monkeypatch.setattr(A, "KEEP_WORDS", keep)
        A.load(*PATHS).words = A.Words()
        largest, add = [0], A.Words.add

        def counted(self, *a, **k):
            add(self, *a, **k)
            largest[0] = max(largest[0], len(self.groups))

        with monkeypatch.context() as m:
            m.setattr(A.Words, "add", counted)
            got = [r for b in A._align(*PATHS, False, A.BLOCK)(iter([batch])) for r in b.to_pylist()]
        assert sum(r["kind"] == "block" for r in got) == 1
        return got, largest[0]

    got, largest = made(500)
    assert largest <= 500 + A.SLICE_DOCUMENTS * 10
    assert made(10**6) == (got, 9000)
