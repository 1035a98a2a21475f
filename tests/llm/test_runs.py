import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tracknet.llm import queries as Q
from tracknet.llm import runs as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=R.LEAST, power=R.POWER):
    """Every maximal stretch of every period, smallest periods first."""
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            # a stretch of a smaller period has been found with it already
            if length >= max(least, power * q) and not any(q % p == 0 and (i, length, p) in found for p in range(1, q)):
                found[i, length, q] = True
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice("ab") for _ in range(rng.randint(1, 12))]
            words += (unit * rng.randint(1, 12))[:rng.randint(1, 90)] + [rng.choice("abcd") for _ in range(rng.randint(0, 8))]
        out.append(words)
    return out


@pytest.mark.parametrize("least,power", [(24, 3), (6, 2), (9, 3)])
def test_runs_are_those_of_brute_force(least, power):
    for words in texts(least, 300):
        raw = [w.encode() for w in words]
        assert R.find_runs(R.word_numbers(raw), least, power) == brute(words, least, power), words


def test_long_and_uniform_texts():
    assert R.find_runs(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    ids = np.arange(40_000)
    ids[5_000:35_000] = 50_000 + np.arange(30_000) % 7_000
    assert R.find_runs(ids) == [(5_000, 30_000, 7_000)]
    assert R.find_runs(np.arange(40_000)) == []


def test_positions_stay_in_order():
    rng = random.Random(1)
    numbers = rng.sample(range(10**6), 20_000)
    held = R.Positions(numbers[0])
    for x in numbers[1:]:
        held.add(x)
    ordered = sorted(numbers)
    assert list(held) == ordered and len(held.blocks) > 5
    for k in (0, 1, 999, 12_345, 19_999):
        assert held.around(ordered[k]) == (ordered[k - 1] if k else None, ordered[k + 1] if k + 1 < len(ordered) else None)


def contract(doc_id, text):
    """The row that the query's contract asks for, by brute force."""
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    best = min(runs, key=lambda r: (-r[1] * 10**12 // r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{ln},{q}\n" for s, ln, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_is_the_contract(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts(9, 250))]
    rows += [(1000 + i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 300)))) for i in range(150)]
    rows += [(2000, None), (2001, ""), (2002, " \n "), (None, "a b " * 30), (None, None), (3, rows[3][1]), (3, rows[3][1]),
             (2003, "x y　z " * 30), (2004, "A\tB\x0bc\x0c\x0d" * 12)]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, period int, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in Q.op12_periodic_runs(spark, str(tmp_path)).collect()]
    order = lambda r: (str(r[0]), r[-1])
    assert sorted(got, key=order) == sorted([contract(*r) for r in rows], key=order)
    assert sum(r[1] > 0 for r in got) > 50


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert R.periodic_runs(docs).collect() == []
    with pytest.raises(ValueError):
        R.periodic_runs(docs, power=1)
