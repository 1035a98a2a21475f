import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracknet.llm import hyperminhash as H
from tracknet.llm import words as W
from tracknet.llm.components import components, join_classes
from tracknet.plans.iterate import cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(AZ))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    low = {k: k for k in range(len(sets))}
    def find(k):
        while low[k] != k:
            k = low[k]
        return k
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low[find(a)] = find(b)
    classes = {}
    for k, (i, _) in enumerate(sets):
        classes.setdefault(find(k), []).append(i)
    return {i: (len(s), min(classes[find(k)])) for k, (i, s) in enumerate(sets)}


def edit(rng, words, n):
    words = words[:]
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def corpus(seed=3):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows = [fresh(rng.randint(1, 120)) for _ in range(120)]
    base = fresh(100)
    rows += [edit(rng, base, rng.randint(0, 3)) for _ in range(40)]        # one large class around a base
    chain = fresh(200)
    for _ in range(12):                                                    # a chain whose ends are unlike
        rows.append(chain)
        chain = edit(rng, chain, 4)
    shared = fresh(60)
    rows += [shared + fresh(30) for _ in range(40)]                        # much in common, but not enough
    rows += [w[:] for w in rows[:15]] + [["a"], ["A"], ["a", "b"], fresh(5), fresh(6)]
    rng.shuffle(rows)
    data = [(i * 2, " ".join(w)) for i, w in enumerate(rows)] + [(9001, None), (9002, ""), (9003, " \n")]
    return data


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(t, i, "c", -5) for i, t in rows], "text string, doc_id long, component_id string, n int").repartition(4)
    got = {r.id: r for r in H.near_duplicates(docs).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    for i, (n, low) in want.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, low, i == low), i


def test_bands_whose_sets_are_not_linked_are_worked_off(spark):
    """With bands of one register very many unlike sets meet; links must still be exact."""
    rows = corpus(11)[:170]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in H.near_duplicates(docs, bands=H.arrange(1, 1)[:24]).collect()}
    assert got == {i: low for i, (_, low) in brute(rows).items()}


def test_small_sets_fill_all_registers_and_agree_by_similarity():
    rng = np.random.default_rng(2)
    same = []
    for _ in range(400):
        both = W.mix(rng.integers(0, 1 << 63, 12, dtype=np.uint64))
        a, b = np.sort(both[:11]), np.sort(both[1:])        # 10 of 12 in common
        x, y = H.densify(np.stack([H.registers(a), H.registers(b)]))
        assert x.all() and y.all()
        same.append((x == y).mean())
    assert abs(np.mean(same) - 10 / 12) < 0.02


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (5, "A b c d e f"), (5, "a b c d e f"), (None, "only here"), (None, None)], "doc_id long, text string")
    got = sorted(((r.id, r.n_shingles, r.component_id, r.kept) for r in H.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 1, None, True), (None, 0, None, True)], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert H.near_duplicates(empty).collect() == [] and H.keep_representatives(empty).collect() == []


def test_stage_keeps_one_row_of_each_class(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "y"), (2, "other words", "z"), (7, "", "q")],
                                 "doc_id long, text string, kept string")
    out = H.keep_representatives(docs)
    assert out.dtypes == docs.dtypes
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 7]


def test_stage_decides_null_ids_by_row(spark):
    """A null id that is kept for one text does not keep all rows without id; a class of null ids keeps one text."""
    like = " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([(5, "A b c d e f"), (None, "a b c d e f"), (None, "quite another text here"), (None, None), (None, ""),
                                  (None, like), (None, like + " x"), (None, like.upper()), (8, like.replace("w5 ", "v5 ") + " y z"), (8, "w q")],
                                 "doc_id long, text string")
    out = sorted(((r.doc_id, r.text) for r in H.keep_representatives(docs).collect()), key=str)
    assert set(out) == {(5, "A b c d e f"), (8, like.replace("w5 ", "v5 ") + " y z"), (8, "w q"), (None, ""), (None, None), (None, "quite another text here")}
    assert len(out) == 6
    nulls = docs.filter("doc_id IS NULL AND lower(text) LIKE 'w0%'")
    assert nulls.count() == 3 and H.keep_representatives(nulls).count() == 1


def test_words_in_thue_morse_order_are_told_apart(spark):
    x, y = ("".join(s[k.bit_count() & 1] for k in range(1024)) for s in ("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{x} b c d e f"), (2, f"{y} b c d e f"), (3, f"{x} b c d e f")], "doc_id long, text string")
    assert sorted((r.id, r.component_id) for r in H.near_duplicates(docs, bands=H.arrange(1, 1)[:8]).collect()) == [(1, 1), (2, 2), (3, 1)]


def test_very_long_text_and_clashing_names(spark):
    long = " ".join(f"w{k % 7919}" for k in range(200_000))
    docs = spark.createDataFrame([(1, long, 3, 4, "r"), (2, long + " end", 3, 4, "r"), (3, "short", 3, 4, "r")], "doc_id long, text string, sid int, tag int, regs string")
    assert sorted((r.id, r.component_id) for r in H.near_duplicates(docs).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_intersections_at_once_are_those_one_by_one(monkeypatch):
    rng = random.Random(8)
    sets = [frozenset((rng.randrange(40), 1) for _ in range(rng.randint(0, 30))) for _ in range(30)]
    monkeypatch.setattr(H, "SHINGLES_AT_ONCE", 7)
    assert H.common_counts(sets[:12], sets[12:]).tolist() == [[len(a & b) for b in sets[12:]] for a in sets[:12]]
    # both ways of a block give the same links
    base = [f"w{k}" for k in range(60)]
    group = []
    for k in range(60):
        text = " ".join(edit(rng, base, rng.randint(0, 9)))
        with np.errstate(over="ignore"):
            s = W.shingles(np.frombuffer(text.encode(), np.uint8), H.SHINGLE)
        group.append({"sid": k, "n_shingles": len(s), "regs": H.registers(s).tobytes(), "root": k, "text": text, "left": k < 30})
    got = []
    for few in (0, 10**6):
        monkeypatch.setattr(H, "FEW_PAIRS", few)
        got.append(sorted(H._links_between((0, True, 0, 0), group)))
    assert got[0] == got[1] and got[0]


def test_estimate_is_close_to_the_true_similarity():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.3, 0.75, 0.95):
        off = []
        for _ in range(60):
            common = rng.integers(0, 1 << 63, int(2000 * share), dtype=np.uint64) * np.uint64(2)
            a, b = (np.unique(np.concatenate((common, rng.integers(0, 1 << 63, 2000 - len(common), dtype=np.uint64) * np.uint64(2)))) for _ in range(2))
            a, b = W.mix(a), W.mix(b)
            a.sort()
            b.sort()
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            got, used = H.estimate(H.registers(a)[None], H.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
            assert used[0] == H.BUCKETS
            off.append(got[0] - true)
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_registers_hold_zeros_and_mantissa():
    # bucket 1; 57 lower bits start with two zeros, a one and ten bits of mantissa
    value = (1 << 57) | (0b001 << 54) | (0b1010101010 << 44) | 12345
    regs = H.registers(np.array([value], np.uint64))
    assert regs[1] == (2 << H.MANTISSA) + 0b1010101010 + 1 and regs.sum() == regs[1]
    assert not H.registers(np.zeros(0, np.uint64)).any()


def lowest(edges):
    low = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    return low


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == lowest(edges)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert components(spark.createDataFrame([(5, 5)], "a long, b long")).collect() == []


@pytest.mark.parametrize("seed", [3, 4])
def test_classes_joined_by_later_links(spark, seed):
    rng = random.Random(seed)
    some = lambda n: [(a, b) for a, b in ((rng.randrange(-30, 60), rng.randrange(-30, 60)) for _ in range(n)) if a != b]
    first, later = some(25), some(20) + [(-100, 200), (200, 3)]
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    found = components(frame(first))
    assert {r.node: r.root for r in join_classes(found, frame(later)).collect()} == lowest(first + later)
    assert {r.node: r.root for r in join_classes(found, frame([])).collect()} == lowest(first)


def test_dense_class_is_read_once(spark, monkeypatch):
    """All links of a dense class go after the first round, and a long chain takes few steps."""
    from tracknet.llm import components as C

    written = []
    monkeypatch.setattr(C, "cut", lambda df, **m: written.append(1) or cut(df, **m))
    dense = [(a, b) for a in range(60) for b in range(a + 1, 60)]
    assert {r.root for r in components(spark.createDataFrame(dense, "a long, b long")).collect()} == {0}
    assert len(written) <= 4
    written.clear()
    chain = spark.range(3000).selectExpr("id AS a", "id + 1 AS b")
    assert components(chain).agg({"root": "max"}).first()[0] == 0
    assert len(written) <= 18
