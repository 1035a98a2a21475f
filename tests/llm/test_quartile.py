import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracknet.llm import quartile as Q


def brute(rows):
    """rows in document order."""
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        out.append((i, len(text), edited, text, following))
    return out


def mark(text):
    with np.errstate(over="ignore"):
        return Q.digest(np.frombuffer(text.encode(), np.uint8))


def near(a, b):
    return float(Q.likeness(np.frombuffer(mark(a), np.uint8)[None], np.frombuffer(mark(b), np.uint8)[None])[0])


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéß日😀") for _ in range(rng.randint(1, 9))) for _ in range(n))


@pytest.mark.parametrize("n,slices,nulls", [(1, 4, 0), (2, 3, 0), (60, 2, 0), (61, 7, 0), (40, 300, 0), (30, 5, 1)])
def test_matches_brute_force(spark, n, slices, nulls):
    rng = random.Random(n)
    ids = sorted(rng.sample(range(-500, 5000), n))
    rows = [(i, rng.choice([None, "", "x", prose(rng, rng.randint(1, 300))])) for i in ids]
    rows = [(None, "nulls come first")] * nulls + rows
    shuffled = rows[:]
    rng.shuffle(shuffled)
    docs = spark.createDataFrame([(t, i, "p", 3) for i, t in shuffled], "text string, doc_id long, part string, n_chars int").repartition(5)
    got = {r.doc_id: r for r in Q.compare_with_next(docs, slices=slices).collect()}
    assert len(got) == len(rows)
    for i, n_chars, edited, text, following in brute(rows):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n_chars, hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (mark(text).hex(), mark(edited).hex())
        assert abs(r.near_edited - near(text, edited)) < 1e-12 and abs(r.near_next - near(text, following)) < 1e-12


def test_rows_of_one_id_follow_each_other_by_text(spark):
    docs = spark.createDataFrame([(1, "bb"), (1, "aa"), (2, "cccc"), (2, "cccc")], "doc_id long, text string")
    for slices in (2, 8):
        got = sorted((r.doc_id, r.edited_sha256) for r in Q.compare_with_next(docs, slices=slices).collect())
        want = sorted((i, hashlib.sha256(e.encode()).hexdigest()) for i, _, e, _, _ in brute([(1, "aa"), (1, "bb"), (2, "cccc"), (2, "cccc")]))
        assert got == want
    assert Q.compare_with_next(docs.limit(0)).collect() == []


@given(st.text(max_size=40), st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_likeness_is_bounded_symmetric_and_one_for_equals(a, b):
    assert near(a, a) == 1.0 and 0.0 <= near(a, b) <= 1.0 and near(a, b) == near(b, a)


def test_counts_do_not_depend_on_chunks(monkeypatch):
    raw = np.frombuffer(prose(random.Random(3), 2000).encode(), np.uint8)
    with np.errstate(over="ignore"):
        whole = Q.triplet_counts(raw)
        monkeypatch.setattr(Q, "CHUNK", 97)
        assert (Q.triplet_counts(raw) == whole).all()
    assert whole.sum() == 6 * (raw.size - 4)


def test_half_edited_texts_are_nearer_than_other_texts():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice(random.Random(k).sample("abcdefghijklmnop", 9)) for _ in range(rng.randint(2, 7))) for _ in range(150)) for k in range(60)]
    closer = sum(near(a, a[:len(a) // 2] + b[:len(a) // 2]) > near(a, b) for a, b in zip(texts, texts[1:]))
    assert closer >= 57


def test_plain_fingerprints(spark):
    docs = spark.createDataFrame([(1, "same text here"), (2, "same text here"), (3, None), (None, "")], "doc_id long, text string")
    got = {r.id: r.fingerprint for r in Q.fingerprints(docs).collect()}
    assert got[1] == got[2] == mark("same text here").hex() and got[3] == got[None] == "00" * 36
