import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracknet.llm import substring as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """rows: (id, text) in document order, ids distinct."""
    seen, out = {}, {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - S.WINDOW + 1):
            seen.setdefault(tuple(words[k:k + S.WINDOW]), (i, k))
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - S.WINDOW + 1):
            if seen[tuple(words[k:k + S.WINDOW])] != (i, k):
                gone.update(range(k, k + S.WINDOW))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out[i] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    return out


def corpus(seed, n, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.choice([15, 19, 20, 21, 35, 60]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.1:
            unit = [word() for _ in range(rng.randint(1, 25))]
            words += unit * rng.randint(2, 9)
        if rows and rng.random() < 0.15:
            words = WORD.findall(rng.choice(rows)[1])
        rows.append((i * 3 - 20, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@given(st.lists(st.lists(st.integers(0, 2), max_size=18), max_size=6), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_automaton_against_brute_force(texts, least):
    got = S.repeated_windows([(None, t) for t in texts], least)
    seen = set()
    for t, flags in zip(texts, got):
        want = []
        for k in range(len(t) - least + 1):
            window = tuple(t[k:k + least])
            want.append(window in seen)
            seen.add(window)
        assert flags == want


@pytest.mark.parametrize("seed,crowd,shard", [(1, 256, 200_000), (2, 1, 50), (3, 2, 400)])
def test_matches_brute_force(spark, monkeypatch, seed, crowd, shard):
    monkeypatch.setattr(S, "CROWD", crowd)
    monkeypatch.setattr(S, "SHARD_WORDS", shard)
    rows = corpus(seed, 150) + [(5000, None), (5001, ""), (5002, "  \n")]
    shuffled = rows[:]
    random.Random(9).shuffle(shuffled)
    docs = spark.createDataFrame([(t, i, "s", 1) for i, t in shuffled], "text string, doc_id long, start string, n int").repartition(5)
    got = {r.doc_id: r for r in S.dedup_substrings(docs).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    for i, (n, gone, sha, kept) in want.items():
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, gone, sha), i
        assert WORD.findall(got[i].kept_text) == kept
    assert sum(w[1] for w in want.values()) > 500


def test_many_contexts_of_one_passage(spark, monkeypatch):
    monkeypatch.setattr(S, "CROWD", 8)
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(30)]
    rows = [(i, " ".join([f"a{rng.randrange(10**6)}" for _ in range(9)] + passage + [f"b{rng.randrange(10**6)}" for _ in range(9)])) for i in range(120)]
    got = {r.doc_id: r for r in S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed == 30 for i in range(1, 120))


def test_no_shard_holds_all_copies_of_a_passage(spark, monkeypatch):
    monkeypatch.setattr(S, "CROWD", 16)
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(50)]
    rows = [(i, " ".join([f"a{rng.randrange(10**6)}" for _ in range(9)] + passage + [f"b{rng.randrange(10**6)}" for _ in range(9)])) for i in range(400)]
    stream = S._stream_shards

    def guarded(batches):
        def counted():
            held = {}
            for batch in batches:
                for shard in batch.column(0).to_pylist():
                    held[shard] = held.get(shard, 0) + 1
                    if held[shard] > 200:
                        raise ValueError("a shard holds half of the copies")
                yield batch
        yield from stream(counted())

    monkeypatch.setattr(S, "_stream_shards", guarded)
    got = {r.doc_id: r for r in S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert all((got[i].n_words, got[i].n_removed, got[i].kept_sha256) == w[:3] for i, w in want.items())


@pytest.mark.parametrize("crowd", [256, 1])
def test_repeated_rows_beside_other_contexts(spark, monkeypatch, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(None, "n " + passage + " m"), (1, "a " + passage + " b"), (1, "a " + passage + " b"), (2, "c " + passage + " d")]
    got = sorted(((r.doc_id, r.n_removed) for r in S.dedup_substrings(spark.createDataFrame(rows[1:], "doc_id long, text string")).collect()), key=str)
    assert got == [(1, 0), (1, 0), (2, 40)]
    got = sorted(((r.doc_id, r.n_removed) for r in S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == [(1, 40), (1, 40), (2, 40), (None, 0)]


def test_segments_are_answered_one_by_one():
    drawn = []

    def segments():
        for k in range(3):
            drawn.append(k)
            yield k, [0, 1, 2]

    answers = iter(S.repeated_windows(segments(), 3))
    assert next(answers) == [False] and drawn == [0]
    assert list(answers) == [[True], [True]]


def test_long_text_repeated_rows_null_ids_and_empty_table(spark):
    long = " ".join(f"x{k % 5000}" for k in range(30_000))
    same = " ".join(f"y{k}" for k in range(25))
    docs = spark.createDataFrame([(1, long), (2, same), (2, same), (None, same)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in S.dedup_substrings(docs).collect()), key=str)
    # the null id comes first, so the others repeat it; both rows of id 2 are one document
    assert got == [(1, 30_000, 25_000), (2, 25, 25), (2, 25, 25), (None, 25, 0)]
    assert S.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_first_text_of_a_crowded_anchor_stays_as_it_is(spark, monkeypatch):
    monkeypatch.setattr(S, "CROWD", 1)
    passage = " ".join(f"p{k}" for k in range(25))
    docs = spark.createDataFrame([(1, " a\n " + passage + "  b "), (2, " c " + passage + " d ")], "doc_id long, text string")
    assert sorted(r.text for r in S.remove_repeats(docs).collect()) == [" a\n " + passage + "  b ", "c d"]


def test_stage_keeps_the_table_shape(spark):
    passage = " ".join(f"p{k}" for k in range(25))
    docs = spark.createDataFrame([(1, "start\n " + passage, "en", 0, "x"), (2, "a  b\n" + passage + "\n c", "en", 0, "y"), (3, None, None, None, None)],
                                 "doc_id long, text string, lang string, n_chars long, spans string")
    out = S.remove_repeats(docs)
    assert out.dtypes == docs.dtypes
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "start\n " + passage and rows[1].n_chars == len(rows[1].text) and rows[1].spans == "x"
    assert rows[2].text == "a  b c" and rows[2].n_chars == 6
    assert rows[3].text == "" and rows[3].lang is None
    renamed = docs.withColumn("row", F.lit(7)).withColumn("id", F.lit(8)).withColumn("tag", F.lit("t"))
    assert S.remove_repeats(renamed).filter("row = 7 AND id = 8 AND tag = 't'").count() == 3


def test_words_and_passages_in_thue_morse_order_are_told_apart(spark):
    order = [k.bit_count() & 1 for k in range(1024)]
    x, y = ("".join(s[k] for k in order) for s in ("ab", "ba"))
    rest = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, " ".join(("p", "q")[k] for k in order)), (4, " ".join(("q", "p")[k] for k in order))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in S.dedup_substrings(docs).collect()}
    seen, want = set(), {}
    for i, t in rows:
        words, gone = t.split(), set()
        for k in range(len(words) - 19):
            w = tuple(words[k:k + 20])
            if w in seen:
                gone.update(range(k, k + 20))
            seen.add(w)
        want[i] = len(gone)
    assert got == want and got[2] == 0


def segments(texts, size, monkeypatch):
    monkeypatch.setattr(S, "SLICE", size)
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts, pa.string())], ["id", "tag", "text"])
    return [tuple(r.values()) for b in S._segments(iter([batch])) for r in b.to_pylist()], [a for b in S._anchors(iter([batch])) for a in b.column(0).to_pylist()]


def test_segments_of_a_slice_are_those_of_each_text(monkeypatch):
    texts = [None, "", *[t for _, t in corpus(7, 60)], "a b " * 300, " ".join(f"v{k}" for k in range(20)), "x " * 19]
    rows, anchors = segments(texts, 1 << 20, monkeypatch)
    assert (rows, anchors) == segments(texts, 1, monkeypatch)
    # the windows of each text in order, each in one segment
    seen = {}
    for _, _, i, _, start, n, _ in rows:
        assert start == seen.get(i, 0)
        seen[i] = start + n
    assert seen == {i: len(WORD.findall(t or "")) - S.WINDOW + 1 for i, t in enumerate(texts) if len(WORD.findall(t or "")) >= S.WINDOW}
    # equal contents, equal words
    words = lambda r: tuple(WORD.findall(texts[r[2]])[r[4]:r[4] + r[5] + S.WINDOW - 1])
    assert len({(r[1], words(r)) for r in rows}) == len({r[1] for r in rows}) == len({words(r) for r in rows})
    assert len(anchors) == sum(1 + r[6] for r in rows)


def test_usual_words_and_segments_are_not_hashed_one_by_one(monkeypatch):
    calls = []
    digest = S.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(S.xxhash, "xxh3_64_intdigest", lambda x: calls.append(1) or digest(x))
    rows, _ = segments([" ".join(f"w{i}x{k}" for k in range(400)) for i in range(20)], 1 << 20, monkeypatch)
    assert len(rows) > 20 and len(calls) == 0
