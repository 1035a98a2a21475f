import random
import re

import pytest

from tracknet.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(sizes, weights=(1, 2, 3), cap=3):
    """Targets by the stated rule, from source -> size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            return {s: cap * sizes[s] for s in order}
        level = (total - sum(cap * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def corpus(seed, sources, n):
    rng = random.Random(seed)
    share = {s: rng.random() ** 2 for s in sources}
    rows = []
    for i in range(n):
        s = rng.choices(list(share), list(share.values()))[0]
        rows.append((i, s, rng.choice([None, "", "w " * rng.randint(1, 40), " ".join(["x"] * min(400, int(rng.paretovariate(1) * 20)))])))
    return rows


@pytest.mark.parametrize("seed,sources", [(1, ["b", "a", "Z", "é", "😀", None]), (2, ["one"]), (3, [f"s{k}" for k in range(25)] + [None])])
def test_targets_and_taken_words(spark, seed, sources):
    rows = corpus(seed, sources, 900)
    docs = spark.createDataFrame([(t, s, i, "k", 9) for i, s, t in rows], "text string, source string, doc_id long, key string, size int").repartition(4)
    got = M.mix_sources(docs).collect()
    again = M.mix_sources(docs.repartition(7)).collect()
    assert {(r.id, r.taken) for r in got} == {(r.id, r.taken) for r in again}
    sizes, taken, most = {}, {}, {}
    for i, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = goals(sizes)
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.id][2]
        assert r.size == len(WORD.findall(text or "")) and r.source == rows[r.id][1] and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        most[r.source] = max(most.get(r.source, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(1, 0.02 * want[s]) or abs(taken[s] - want[s]) <= most[s] / 2, s


def test_tilted_rates_meet_the_targets(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("ab"), "w " * rng.randint(1, 30), rng.choice([0.2, 1.0, 2.0, 5.0])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, quality double")
    got = M.mix_sources(docs, tilt_col="quality").collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.rate * r.size for r in mine) - mine[0].target) < 1e-6 * mine[0].target
        assert len({round(r.rate, 9) for r in mine}) == 4


def test_wordless_null_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert sorted((r.id, r.target, r.taken) for r in M.mix_sources(docs).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
    assert M.mix_sources(docs.limit(0)).collect() == [] and M.take_mix(docs.limit(0)).collect() == []


def test_stage_repeats_rows(spark):
    rows = corpus(4, ["a", "b", "c", None], 300)
    docs = spark.createDataFrame([(i, t, s, "x") for i, s, t in rows] + [(None, "null id text", "a", "x")], "doc_id long, text string, source string, _copies string")
    out = M.take_mix(docs)
    assert out.dtypes == docs.dtypes
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    want = {r.id: r.copies for r in M.mix_sources(docs).collect() if r.copies}
    assert times == want


def test_no_python_in_the_plans(spark):
    docs = spark.createDataFrame([(1, "a", "b c")], "doc_id long, source string, text string")
    for df in (M.mix_sources(docs), M.take_mix(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian", plan)
