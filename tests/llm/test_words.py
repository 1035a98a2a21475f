import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tracknet.llm import words as W

TEXT = st.text(alphabet="ab \t\n\x0b\x0c\ré\u3000\x1f\x85x", max_size=60)


def hashes(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    with np.errstate(over="ignore"):
        return W.word_hashes(raw, *W.word_spans(raw))


@given(TEXT)
@settings(max_examples=200, deadline=None)
def test_words_are_runs_of_other_than_six_separators(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends = W.word_spans(raw)
    got = [raw[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert got == re.findall(r"[^\x20\x09-\x0D]+", text)


@given(st.lists(st.sampled_from(["a", "b", "ab", "ba", "aa", "é", "aaaa"]), max_size=30))
@settings(max_examples=100, deadline=None)
def test_equal_words_and_only_they_hash_alike(words):
    h = hashes("  ".join(words))
    assert len(h) == len(words)
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            assert (h[i] == h[j]) == (x == y)


def test_long_words_and_many_chunks_hash_like_short_texts():
    long = "q" * 16_389
    text = ("ab cd " * 120_000) + long + " ab " + long + " cd"
    h = hashes(text)
    ab, cd = hashes("ab cd")
    assert set(h[:240_000:2]) == {ab} and set(h[1:240_000:2]) == {cd}
    assert h[240_000] == h[240_002] and h[240_001] == ab and h[240_003] == cd


def test_windows_depend_on_the_words_alone():
    a, b = hashes("x y z u v w x y z u v"), hashes("p x y z u v")
    with np.errstate(over="ignore"):
        for k in (1, 2, 3, 5):
            wa, wb = W.windows(a, k), W.windows(b, k)
            assert len(wa) == 12 - k and wa[0] == wb[1] and wa[0] == W.windows(a, k)[0]
            assert (wa[0] == wa[6]) == (k <= 5)
        assert len(W.windows(a, 12)) == 0


@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.integers(1, 15))
@settings(max_examples=100, deadline=None)
def test_sliding_min(values, w):
    x = np.array(values)
    if w <= len(x):
        assert W.sliding_min(x, w).tolist() == [min(values[i:i + w]) for i in range(len(x) - w + 1)]


def test_text_bytes_of_sliced_and_null_columns():
    col = pa.array(["a", None, "", "éx", "tail"]).slice(1, 3)
    assert [r.tobytes().decode() for r in W.text_bytes(col)] == ["", "", "éx"]
    assert [r.tobytes() for r in W.text_bytes(pa.nulls(2))] == [b"", b""]
    assert [r.tobytes().decode() for r in W.text_bytes(col.cast(pa.large_string()))] == ["", "", "éx"]


def thue_morse(n, symbols):
    return [symbols[k.bit_count() & 1] for k in range(n)]


def test_thue_morse_words_and_sequences_hash_apart():
    for n in (1024, 2048, 4096, 8192):
        x, y = ("".join(thue_morse(n, s)) for s in ("ab", "ba"))
        assert len(set(hashes(f"{x} {y}").tolist())) == 2


@given(st.lists(st.one_of(st.none(), TEXT, st.lists(st.sampled_from(["a", "a\0", "\0", "abcdefgh", "abcdefgh\0", "abcdefghijklmnop", "abcdefghijklmnopq", "é" * 9, "x\0y"]),
                                                    max_size=9).map(" ".join)), max_size=8))
@settings(max_examples=200, deadline=None)
def test_words_of_a_slice_are_those_of_its_texts(texts):
    with np.errstate(over="ignore"):
        h, edges = W.slice_hashes(pa.array(texts, pa.string()))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert edges.tolist() == np.cumsum([0, *map(len, words)]).tolist()
    flat = [w for ws in words for w in ws]
    assert len(h) == len(flat)
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_slices_end_by_bytes_and_by_number():
    texts = pa.array(["abcd", None, "", "abcdef", "ab", "ab", "ab", "ab"])
    assert list(W.slices(texts, 6, 3)) == [(0, 3), (3, 4), (4, 7), (7, 8)]
    assert list(W.slices(texts.slice(3), 1, 9)) == [(k, k + 1) for k in range(5)]
    assert list(W.slices(texts.slice(0, 0), 1, 9)) == []
