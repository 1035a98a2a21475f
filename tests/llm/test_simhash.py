import random
import re

import numpy as np
import pytest
import xxhash

from tracknet.llm import queries as Q
from tracknet.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(AZ))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """Component number per fingerprint, by comparing all pairs."""
    low = list(range(len(fps)))
    def find(k):
        while low[k] != k:
            k = low[k]
        return k
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                low[find(a)] = find(b)
    return [find(k) for k in range(len(fps))]


def test_fingerprint_is_the_counted_one():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, 4, 5, 40, 300]:
        text = "\t".join(rng.choice(["Ab", "é", "ÄB", "x y", "the", "ZZ"]) for _ in range(n))
        assert S.fingerprint(text.encode()) == brute_fingerprint(text)
    held, S.HELD = S.HELD, 7
    try:
        assert S.fingerprint(text.encode()) == brute_fingerprint(text)
    finally:
        S.HELD = held


def flipped(rng, x, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


def cluster(seed):
    """Groups around centres, chains of three bits, unlike ones, and pairs that are four bits apart."""
    rng = random.Random(seed)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(6):
        c = rng.getrandbits(64)
        fps |= {c, flipped(rng, c, 4)} | {flipped(rng, c, rng.randint(0, 3)) for _ in range(25)}
    c = rng.getrandbits(64)
    half = rng.choice([0xFFFFFFFF, 0xFFFFFFFF << 32])
    for _ in range(80):      # many with one segment in common
        x = c
        for b in rng.sample([k for k in range(64) if half >> k & 1], rng.randint(0, 6)):
            x ^= 1 << b
        fps.add(x)
    x = rng.getrandbits(64)
    for _ in range(15):
        fps.add(x)
        x = flipped(rng, x, 3)
    fps |= {rng.getrandbits(64) for _ in range(60)}
    return sorted(fps)


@pytest.mark.parametrize("dense", [0, 3, 256])
def test_links_join_the_classes_of_all_pairs(spark, dense):
    fps = cluster(dense + 2)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    at = {s: k for k, s in enumerate(signed)}
    links = [(at[r.a], at[r.b]) for r in S.link_fingerprints(spark.createDataFrame([(s,) for s in signed], "fp bigint"), dense).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 3 for a, b in links)
    assert len(links) == len(set(links))
    low = list(range(len(fps)))
    for _ in fps:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    want = classes(fps)
    same = lambda c: {k: min(j for j in range(len(c)) if c[j] == c[k]) for k in range(len(c))}
    assert same(low) == same(want)
    if dense == 256:      # all links, not only enough of them
        assert {frozenset(x) for x in links} == {frozenset((a, b)) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3}


def test_dense_values_give_no_pairs(spark):
    """Links of a crowded value grow with its fingerprints, not with their square."""
    rng = random.Random(3)
    count = {}
    for n in (200, 400):
        fps = {0xABCD}
        while len(fps) < n:
            fps.add(flipped(rng, 0xABCD, 1) if rng.random() < .2 else 0xABCD ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)))
        signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
        count[n] = S.link_fingerprints(spark.createDataFrame([(s,) for s in signed], "fp bigint"), 8).count()
    assert count[400] < 2.6 * count[200]


def test_query_is_the_contract(spark, tmp_path):
    rng = random.Random(11)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = []
    for k in range(60):
        words = base[:]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(400)] = f"e{rng.randrange(99)}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 50)))) for k in range(60)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "ONE"), (305, "one two"), (0, rows[0][1]), (7, "quite other words here"),
             (None, rows[1][1]), (None, "only null ids here"), (306, "long " * 50_000)]
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, fp string, component_id int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in Q.op13_simhash(spark, str(tmp_path)).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t in rows]
    of = classes(fps)
    least = {c: min((rows[k][0] for k in range(len(rows)) if of[k] == c and rows[k][0] is not None), default=None) for c in of}
    assert got == sorted(((i, f"{fp:016x}", least[c]) for (i, _), fp, c in zip(rows, fps, of, strict=True)), key=str)
    assert len({r[2] for r in got}) < len(rows) - 40


def test_empty_table(spark):
    assert S.simhash_classes(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
