"""Toxicity scores from weak supervision.

1. Lexicons. A seed list of everyday insults is fixed. More words, and word
   beginnings of 4 and 5 letters, are learned: those that stand in labelled
   toxic documents significantly more often than in labelled clean ones. The
   labelled sample is bounded (``MOST_PER_CLASS`` rows of each class, those
   with the smallest hash of their id), so it may be broadcast.
2. Votes. Lexicon and pattern voters look at every whole text: each votes
   toxic, clean or abstains.
3. Label model. A generative model of the votes is fitted by expectation
   maximisation over the vote patterns of all training documents: how often
   each voter votes which way on toxic and on clean documents. Voters that
   share lexicons agree more than the model allows; their correlations within
   the classes are estimated, and a voter's evidence is divided by one plus the
   sum of its positive correlations. A known label is one more, nearly certain voter.
4. Classifier. A logistic regression on lexicon features is trained on the
   sample's posterior labels; it scores every document.

Labels of documents in the held-out fold (crc32 of the id modulo 5 is 0) are
never read; labels, lang, source and doc_id are no input of a score.

Defined results: a null or empty text has no hits and gets the score of such
texts. Repeated rows get equal scores; of several labels of one id the highest
counts; null ids and null labels are unlabelled, and a null id is not held
out. Extra columns are not read. Without labels of both classes the score is
the label model's posterior.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracknet.plans.iterate import cut, rows

FOLDS = 5
MOST_PER_CLASS = 10_000
MOST_TERMS = 4096
LEAST_SCORE, LEAST_ODDS, LEAST_DOCS = 2.5, 3.5, 3
GROUPS = 4              # voters per learned lexicon
EM_ROUNDS = 12
PRIOR_VOTES = 1.0
GOLD_RIGHT = 0.98
#: Everyday insults (fixed values).
SEEDS = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "fool", "loser", "losers", "pathetic", "worthless", "scum", "trash", "garbage",
         "clown", "disgusting", "vile", "filthy", "imbecile", "jerk", "creep", "freak", "coward", "liar", "ugly")
YOU = ("you", "your", "you're", "du", "dich", "ihr", "tu", "toi", "vous", "eres", "usted", "this", "that")
VOTERS = ("seed", "two_seeds", *(f"words{g}" for g in range(GROUPS)), *(f"starts{g}" for g in range(GROUPS)), "density", "addressed", "silence")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def text_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(words: list[str]) -> set[str]:
    """Words, and beginnings marked with ``*``."""
    own = set(words)
    return own | {w[:k] + "*" for w in own for k in (4, 5) if len(w) > k}


def labelled_sample(labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "toxic", most: int = MOST_PER_CLASS) -> DataFrame:
    """``(doc_id, toxic, weight)``: up to ``most`` training ids of each class, chosen by hash; ``weight`` restores the classes' shares."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = cut(known)
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("weight", F.lit(max(1.0, total.get(c, 0) / most)))
             for c in (0, 1)]
    return cut(parts[0].unionByName(parts[1]))


def learn_lexicon(sample: DataFrame) -> list[str]:
    """Terms of ``(text, toxic)`` that speak for toxic, the most significant first; at most ``MOST_TERMS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted(terms_of(text_words(text)))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["term", "toxic"])

    counts = sample.select("text", "toxic").mapInArrow(run, "term string, toxic int").groupBy("term").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1)) - F.log((F.col("good") + 0.5) / (sizes[0] + 1))
    score = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = counts.filter((F.col("bad") >= LEAST_DOCS) & (odds >= LEAST_ODDS) & (score >= LEAST_SCORE)).orderBy(score.desc(), "term").limit(MOST_TERMS)
    return [r["term"] for r in best.select("term").collect()]


def cast_votes(docs: DataFrame, lexicon: list[str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, pattern, terms)`` of every row: base-3 digits of the votes (0
    clean, 1 toxic, 2 abstains) and the places of its terms in the lexicon;
    after these, places for one and for two and more seeds."""
    kind = docs.schema[id_col].dataType.simpleString()
    place = {t: k for k, t in enumerate(lexicon)}
    seeds, you = frozenset(SEEDS), frozenset(YOU)

    def judge(text: str | None) -> tuple[int, list[int]]:
        words = text_words(text)
        hits = sorted(place[t] for t in terms_of(words) if t in place)
        sown = {w for w in set(words) if w in seeds}
        votes = [1 if sown else 2, 1 if len(sown) > 1 else 2]
        starts = [lexicon[k].endswith("*") for k in hits]
        for lexicon_part in (False, True):
            for g in range(GROUPS):
                votes.append(1 if any(k % GROUPS == g and s == lexicon_part for k, s in zip(hits, starts, strict=True)) else 2)
        n = len(hits) + len(sown)
        votes.append(1 if 20 * n >= len(words) > 0 else 0 if 200 * n <= len(words) else 2)
        votes.append(1 if sown and any(w in seeds and not you.isdisjoint(words[max(0, i - 3):i]) for i, w in enumerate(words)) else 2)
        votes.append(2 if n else 0)
        if sown:
            hits.append(len(lexicon))
        if len(sown) > 1:
            hits.append(len(lexicon) + 1)
        return sum(v * 3**k for k, v in enumerate(votes)), hits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                found = [judge(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32()))],
                                                 ["doc_id", "pattern", "terms"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, pattern bigint, terms array<int>")


def vote_cells(pattern: Column) -> Column:
    """Places 3k + vote of a pattern's votes."""
    return F.array(*[F.pmod(F.call_function("div", pattern, F.lit(3**k)), F.lit(3)).cast("int") + 3 * k for k in range(len(VOTERS))])


@dataclass
class LabelModel:
    """``toxic``: share of toxic documents; ``rates[c][k]``: chances of the
    three votes of voter k in class c; ``share[k]``: weight left to a voter by
    its correlations."""

    toxic: float
    rates: list[list[list[float]]]
    share: list[float]

    def weights(self) -> list[float]:
        out = [s * math.log(b / g) for bad, good, s in zip(self.rates[1], self.rates[0], self.share, strict=True) for b, g in zip(bad, good, strict=True)]
        return [*out, math.log(self.toxic / (1 - self.toxic))]

    def posterior(self, cells: Column, gold: Column) -> Column:
        """P(toxic) from votes and, where known, the label."""
        w = F.lit(self.weights())
        known = math.log(GOLD_RIGHT / (1 - GOLD_RIGHT))
        odds = F.get(w, F.lit(3 * len(VOTERS))) + F.when(gold == 1, known).when(gold == 0, -known).otherwise(0.0)
        return 1 / (1 + F.exp(-F.aggregate(cells, odds, lambda acc, c: acc + F.get(w, c))))


def fit_label_model(patterns: DataFrame, rounds: int = EM_ROUNDS) -> LabelModel:
    """EM over ``(cells, gold, n)``. Each round is one aggregate by vote, 3 rows
    per voter; the correlations are one aggregate by pairs of voters."""
    k = len(VOTERS)
    # at first a vote for a class is taken to be right four times out of five
    model = LabelModel(0.1, [[[0.4, 0.1, 0.5]] * k, [[0.1, 0.4, 0.5]] * k], [1.0] * k)
    for turn in range(rounds + 1):
        p = model.posterior(F.col("cells"), F.col("gold"))
        weighed = patterns.select("cells", "n", (F.col("n") * p).alias("t"))
        if turn == rounds:
            return _discount(weighed, model)
        got = {r["cell"]: (r["n"] - r["t"], r["t"]) for r in weighed.select(F.explode("cells").alias("cell"), "n", "t").groupBy("cell").agg(
            F.sum("n").alias("n"), F.sum("t").alias("t")).collect()}
        if not got:
            return model
        sums = [[[got.get(3 * v + x, (0.0, 0.0))[c] for x in range(3)] for v in range(k)] for c in (0, 1)]
        total = [sum(sums[c][0]) for c in (0, 1)]
        rates = [[[(x + PRIOR_VOTES) / (total[c] + 3 * PRIOR_VOTES) for x in votes] for votes in sums[c]] for c in (0, 1)]
        model = LabelModel((total[1] + PRIOR_VOTES) / (sum(total) + 2 * PRIOR_VOTES), rates, model.share)
    return model


def _discount(weighed: DataFrame, model: LabelModel) -> LabelModel:
    """Voters' shares from their correlations within the classes."""
    k = len(VOTERS)
    # 1 where a voter does not abstain
    on = F.transform(F.filter("cells", lambda c: c % 3 != 2), lambda c: F.floor(c / 3).cast("int"))
    pairs = weighed.select(on.alias("on"), "n", "t").select(F.explode("on").alias("a"), "on", "n", "t").select("a", F.explode("on").alias("b"), "n", "t").filter("a < b")
    both = {(r["a"], r["b"]): (r["n"] - r["t"], r["t"]) for r in pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect()}
    total = weighed.agg(F.sum("n").alias("n"), F.sum("t").alias("t")).first()
    extra = [0.0] * k
    for (a, b), together in both.items():
        found = 0.0
        for c, size in ((0, total["n"] - total["t"]), (1, total["t"])):
            if size <= 0:
                continue
            x, y = (1 - model.rates[c][v][2] for v in (a, b))
            spread = math.sqrt(max(1e-12, x * (1 - x) * y * (1 - y)))
            found += max(0.0, min(1.0, (together[c] / size - x * y) / spread)) / 2
        extra[a] += found
        extra[b] += found
    return LabelModel(model.toxic, model.rates, [1 / (1 + e) for e in extra])


def train_classifier(sample: DataFrame, size: int) -> tuple[list[float], float] | None:
    """Coefficients and intercept from ``(terms, p, weight)``: each row counts as toxic with weight p and as clean with the rest."""
    both = sample.select("terms", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("p") * F.col("weight")).alias("w")),
                                                    F.struct(F.lit(0.0).alias("label"), ((1 - F.col("p")) * F.col("weight")).alias("w")))).alias("x"))
    table, seen = cut(both.select("terms", F.col("x.label").alias("label"), F.col("x.w").alias("w")), n=rows())
    if not seen["n"]:
        return None

    make = F.udf(lambda terms: Vectors.sparse(size, [int(t) for t in terms], [1.0] * len(terms)), VectorUDT())
    lr = LogisticRegression(featuresCol="x", labelCol="label", weightCol="w", regParam=1e-4, maxIter=40, standardization=False)
    model = lr.fit(table.select(make("terms").alias("x"), "label", "w").coalesce(4))
    return [float(c) for c in model.coefficients], float(model.intercept)


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted, posterior)`` per document."""
    sample = labelled_sample(labels)
    # a bounded table: at most 2 * MOST_PER_CLASS rows
    small = F.broadcast(sample.select(F.col("doc_id").alias("_id"), "toxic", "weight"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lexicon = learn_lexicon(texts.join(small, F.col("doc_id") == F.col("_id")).select("text", "toxic"))
    voted = cut(cast_votes(docs, lexicon, id_col=id_col, text_col=text_col))
    with_gold = voted.join(small, F.col("doc_id") == F.col("_id"), "left")
    seen = cut(with_gold.filter(~held_out(F.col("doc_id"))).groupBy("pattern", F.col("toxic").alias("gold")).agg(F.count(F.lit(1)).alias("n")))
    model = fit_label_model(seen.select(vote_cells(F.col("pattern")).alias("cells"), "gold", "n"))
    cells = vote_cells(F.col("pattern"))
    labelled = with_gold.filter("toxic IS NOT NULL").select("terms", "toxic", "weight", model.posterior(cells, F.col("toxic")).alias("p"))
    by_votes = model.posterior(cells, F.lit(None).cast("int"))
    fitted = train_classifier(labelled, len(lexicon) + 2) if lexicon else None
    if fitted is None:
        score = by_votes
    else:
        w = F.lit([*fitted[0], 0.0])
        score = 1 / (1 + F.exp(-F.aggregate("terms", F.lit(fitted[1]), lambda acc, t: acc + F.get(w, t))))
    out = voted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), by_votes.alias("posterior"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "posterior")
