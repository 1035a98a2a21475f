import random
import zlib

from pyspark.sql import functions as F

from tracknet.llm import toxicity as T

BAD = ["grumsel", "grumselt", "grumsex", "vokkar", "vokkarin", "plimto"]       # words of no seed list
SYLLABLES = ["ba", "de", "lo", "mi", "ran", "tel", "sor", "un"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words[rng.randrange(len(words))] = rng.choice(BAD if i % 2 else ["idiot", "Moron,", "STUPID"])
        docs.append((i, " ".join(words), "en", "src"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents_are_judged_right(spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in T.score_documents(*frames(spark, docs, labels)).collect()}
    assert len(got) == len(docs)
    truth = {i: t for i, _, t in labels}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(out)
    right = sum(got[i].predicted == truth[i] for i in out) / len(out)
    assert right >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_and_other_columns_are_never_read(spark):
    docs, labels = corpus(400, 2)
    d, lab = frames(spark, docs, labels)
    base = {r.doc_id: r.score for r in T.score_documents(d, lab).collect()}
    flipped = lab.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    changed = d.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("score", F.lit("own")).withColumn("_id", F.lit(1))
    other = {r.doc_id: r.score for r in T.score_documents(changed, flipped).collect()}
    assert base.keys() == other.keys() and all(abs(base[i] - other[i]) < 1e-9 for i in base)


def test_nulls_repeats_and_missing_labels(spark):
    docs = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "you idiot and moron", "en", "s"), (3, "you idiot and moron", "en", "s"), (None, "plain words here", None, None)]
    d, lab = frames(spark, docs, [(3, None, None), (None, 1, 1)])
    got = T.score_documents(d, lab).collect()
    assert len(got) == 5
    by = {(r.doc_id, r.score) for r in got}
    assert len({s for i, s in by if i == 3}) == 1 and {s for i, s in by if i == 1} == {s for i, s in by if i == 2}
    assert not [r for r in got if r.doc_id is None][0].held_out
    assert T.score_documents(d.limit(0), lab.limit(0)).collect() == []


def test_the_sample_is_bounded_and_weighted(spark):
    lab = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(3000)], "doc_id long, quality int, toxic int")
    sample = T.labelled_sample(lab, most=100).collect()
    assert len(sample) == 200 and not any(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in sample)
    kept = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5]
    assert abs(sum(r.weight for r in sample) - len(kept)) < 1e-6


def test_correlated_voters_lose_weight(spark):
    # two voters that always agree, and one of its own
    rng = random.Random(3)
    k = len(T.VOTERS)
    rows = []
    for _ in range(600):
        toxic = rng.random() < 0.3
        a, b = (int(rng.random() < (0.8 if toxic else 0.1)) for _ in range(2))
        votes = [1 if a else 2, 1 if a else 2, 1 if b else 2] + [2] * (k - 3)
        rows.append(([3 * v + x for v, x in enumerate(votes)], int(toxic), 1))
    model = T.fit_label_model(spark.createDataFrame(rows, "cells array<int>, gold int, n long"))
    assert model.share[0] < 0.7 and model.share[1] < 0.7 and model.share[2] > 0.8
