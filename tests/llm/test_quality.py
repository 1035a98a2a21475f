import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tracknet.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t", "one", "a b c", "a b c a", "a a a a a", "x\n\nx\n x\ny|y\n", "é ü\u3000z\x0bw\x0cv\rq", "a b c d a b c", "😀 😀 😀 😀"]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "cc", "D#", "|"]) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randint(1, 80))))
    out.append("w " * 70_000 + "end")
    return out


def test_base_statistics_match_brute_force(spark):
    data = texts()
    docs = spark.createDataFrame([(i, t, "n", -1) for i, t in enumerate(data)], "doc_id long, text string, n_words string, kept int")
    got = {r.doc_id: r for r in Q.judge_quality(docs.drop("n_words", "kept").withColumn("_row", F.lit(1)).withColumn("pattern", F.lit("x"))).collect()}
    assert len(got) == len(data)
    for i, t in enumerate(data):
        r, want = got[i], brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t and t[:80]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_clean_text_stays_and_junk_goes(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "to", *["".join(rng.choice("bdlmnrst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(200)]]
    def prose(n):
        return " ".join(" ".join(rng.choice(vocabulary) for _ in range(9)).capitalize() + "." for _ in range(n))
    rows = [(i, prose(14)) for i in range(160)]
    rows += [(1000 + i, " ".join(w.upper() + "!!" for w in prose(12).split())) for i in range(12)]
    rows += [(2000 + i, " ".join(w + "%%%" for w in prose(12).split())) for i in range(12)]
    rows += [(3000 + i, " | ".join(prose(12).split())) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in Q.judge_quality(docs).filter("kept").collect()}
    assert kept == set(range(160))
    extra = docs.withColumn("n_words", F.lit("own")).withColumn("_text", F.lit(1))
    stage = Q.keep_good(extra)
    assert stage.columns == extra.columns
    rows = stage.collect()
    assert {r.doc_id for r in rows} == kept and {r.n_words for r in rows} == {"own"}


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert Q.judge_quality(empty).collect() == [] and Q.keep_good(empty).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert len(Q.judge_quality(docs).collect()) == 3


def test_em_finds_the_good_rules(spark):
    # three voters of which the last votes at random; EM must not trust it
    rng = random.Random(8)
    rules = tuple(Q.Rule(n, "true", "true") for n in "abc")
    counts = Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        v = [int(good) if rng.random() < 0.9 else int(not good) for _ in range(2)] + [rng.randint(0, 1)]
        counts[sum(x * 3**k for k, x in enumerate(v))] += 1
    model = Q.fit(spark.createDataFrame(list(counts.items()), "pattern long, n long"), rules, rounds=30)
    trust = [g[1] / (g[0] + g[1]) - b[1] / (b[0] + b[1]) for g, b in zip(model.good_rates, model.bad_rates)]
    assert trust[0] > 0.6 and trust[1] > 0.6 and abs(trust[2]) < 0.2
    assert abs(model.good - 0.7) < 0.15


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = Q.text_statistics(docs, keep=["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
