"""Quality rules as weak supervision, in DataFrame operations only.

Each rule looks at one statistic of a document and votes good (1), bad (0) or
abstains (null). How far a rule can be trusted is not set by hand: expectation
maximisation estimates the share of good documents and, for each rule, how
often it votes which way on good and on bad documents. A document is kept if
its posterior probability of being good is at least ``min_posterior``; no
single rule can throw a document out.

Documents with equal votes are alike for the model, so EM runs on the table of
vote patterns with their counts: at most ``3 ** len(RULES)`` rows, whatever
the size of the corpus. Each round is one aggregate over that table. The
statistics are row-wise expressions without a shuffle; the only shuffle is the
pattern count, pre-aggregated in each task.

Defined results: a null text is an empty one (all counts 0, ``base_failed``).
Repeated rows are documents of their own. Extra columns are not read. On an
empty table EM keeps its start values and the result is empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracknet.plans.iterate import cut

#: Everyday short words of four languages (fixed values).
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "for", "der", "die", "und", "das", "den", "von", "zu", "mit",
              "le", "la", "les", "de", "et", "des", "un", "que", "el", "los", "en", "del", "se", "con", "por", "su")
MIN_WORDS = 50
EM_ROUNDS = 12
MIN_POSTERIOR = 0.5
#: Chances of a bad and of a good vote on bad and on good documents from which EM starts.
START_BAD, START_GOOD = (0.3, 0.5), (0.02, 0.8)
#: Pseudo-counts that keep rates off 0 and 1.
PRIOR_VOTES = 1.0


@dataclass(frozen=True)
class Rule:
    """Votes 0 where ``bad`` holds, else 1 where ``good`` holds, else abstains.
    The conditions are SQL over the statistics, valid in Spark and DuckDB."""

    name: str
    bad: str
    good: str


#: Statistics are counts; thresholds are kept as integer products, so no rounding matters.
RULES = (
    Rule("symbols", "20 * n_symbols > word_chars", "100 * n_symbols <= word_chars"),
    Rule("shouting", "3 * n_shouts > n_words", "10 * n_shouts <= n_words"),
    Rule("exclaiming", "5 * n_marks > n_words", "50 * n_marks <= n_words"),
    Rule("stop_words", "50 * n_stop < n_words", "12 * n_stop >= n_words"),
    Rule("columns", "5 * n_bars > n_words", "100 * n_bars <= n_words"),
    Rule("repeats", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    Rule("lines", "4 * n_dup_lines > n_lines AND n_dup_lines > 2", "n_dup_lines = 0"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars >= 3 * n_words AND word_chars <= 9 * n_words"),
    Rule("sentences", "n_stops * 60 < n_words", "n_stops * 25 >= n_words"),
)


SEPARATOR = "[ \\t-\\r]"


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(text, SEPARATOR), "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _dup_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line; only looked at where any line repeats."""
    worded = F.filter(lines, lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))
    repeats = _let(worded, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return F.when(F.size(F.array_distinct(lines)) == F.size(lines), F.lit(0).cast("long")).otherwise(repeats)


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash per 3-word window."""
    n = F.size(words)
    return F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def _repeat_words(grams: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in the text.

    Only a text in which a window repeats is looked at further: sorting its
    (hash, position) pairs brings equal windows together, equal neighbours
    give the repeated positions, and the gaps between these count the words
    they cover."""

    def covered(p: Column) -> Column:
        found = F.transform(p, lambda x, i: F.when((x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"]), x["i"]))
        at = F.sort_array(F.filter(found, lambda x: x.isNotNull()))
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                           lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")),
                           lambda acc: acc["n"].cast("long"))

    pairs = F.sort_array(F.transform(grams, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    once = grams.isNull() | (F.size(F.array_distinct(grams)) == F.size(grams))
    return F.when(once, F.lit(0).cast("long")).otherwise(_let(pairs, covered))


def text_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` followed by the statistics of each text."""
    keep = keep or []
    text = F.col("_text")
    count = lambda what: F.regexp_count(text, F.lit(what)).cast("long")
    either = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    d = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = d.withColumn("_parts", F.split(text, SEPARATOR)).withColumn("_words", F.array_remove("_parts", ""))
    d = d.withColumn("_grams", _window_hashes(F.col("_words"))).withColumn("_lines", F.split(text, "\n"))
    return d.select(
        *keep, F.size("_words").cast("long").alias("n_words"),
        (F.length(text) - F.size("_parts") + 1).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"), _dup_lines(F.col("_lines")).alias("n_dup_lines"),
        _repeat_words(F.col("_grams")).alias("n_repeat_words"), count("[A-Z]{2,}").alias("n_shouts"),
        count("!").alias("n_marks"), count("[|]").alias("n_bars"), count("[.?!]").alias("n_stops"),
        F.size(F.filter("_words", lambda w: w.isin(*either))).cast("long").alias("n_stop"),
        F.size("_lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One number per vote pattern: a base-3 digit per rule, 0 bad, 1 good, 2 abstains."""
    total = F.lit(0).cast("long")
    for k, r in enumerate(rules):
        total = total + F.expr(f"CASE WHEN {r.bad} THEN 0 WHEN {r.good} THEN 1 ELSE 2 END").cast("long") * F.lit(3**k)
    return total


@dataclass
class LabelModel:
    """``good``: share of good documents; ``rates[k]``: P(vote 0), P(vote 1) of
    rule k on bad and on good documents (the rest abstain)."""

    good: float
    bad_rates: list[tuple[float, float]]
    good_rates: list[tuple[float, float]]

    def weights(self) -> list[float]:
        """Log odds for good of each rule's votes 0, 1 and 2 (abstains), rule by rule, then those of no vote at all."""
        out = []
        for b, g in zip(self.bad_rates, self.good_rates, strict=True):
            out += [math.log(g[0] / b[0]), math.log(g[1] / b[1]), math.log((1 - g[0] - g[1]) / (1 - b[0] - b[1]))]
        return [*out, math.log(self.good / (1 - self.good))]

    def posterior(self, cells: Column) -> Column:
        """P(good) from a document's cells (``vote_cells``). The weights are one
        array, so that all rounds of EM share a small plan and its code."""
        w = F.lit(self.weights())
        return 1 / (1 + F.exp(-F.aggregate(cells, F.lit(0.0), lambda acc, c: acc + F.get(w, c))))


def vote_cells(pattern: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Places of a pattern's votes among the weights, and the place of the prior."""
    votes = [F.pmod(F.call_function("div", pattern, F.lit(3**k)), F.lit(3)).cast("int") + 3 * k for k in range(len(rules))]
    return F.array(*votes, F.lit(3 * len(rules)))


def start_model(rules: tuple[Rule, ...] = RULES) -> LabelModel:
    """Junk is of one kind or another, so at first a bad vote weighs much and a good vote little."""
    return LabelModel(0.8, [START_BAD] * len(rules), [START_GOOD] * len(rules))


def fit(patterns: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = EM_ROUNDS) -> LabelModel:
    """EM over ``(pattern, n)``: one aggregate of a bounded table per round."""
    model, k = start_model(rules), len(rules)
    table = patterns.select("n", vote_cells(F.col("pattern"), rules).alias("cells"))
    for _ in range(rounds):
        seen = table.select(F.explode("cells").alias("cell"), "n", (F.col("n") * model.posterior(F.col("cells"))).alias("g"))
        got = {r["cell"]: (r["n"], r["g"]) for r in seen.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect()}
        if not got:
            return model
        total, good = got[3 * k]
        rate = lambda hit, of: (hit + PRIOR_VOTES) / (of + 3 * PRIOR_VOTES)
        cells = [[got.get(3 * r + v, (0, 0.0)) for v in (0, 1)] for r in range(k)]
        model = LabelModel((good + PRIOR_VOTES) / (total + 2 * PRIOR_VOTES),
                           [tuple(rate(n - g, total - good) for n, g in c) for c in cells],
                           [tuple(rate(g, good) for _, g in c) for c in cells])
    return model


def judge_quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                  min_posterior: float = MIN_POSTERIOR, keep: list[str] | None = None) -> DataFrame:
    """Statistics, ``base_failed``, ``pattern``, ``posterior`` and ``kept`` per
    document, after the columns ``keep`` (default: the id). The model is fitted
    on the documents that pass the base rules."""
    keep = [id_col] if keep is None else keep
    stats = text_statistics(docs, text_col, keep).withColumn("base_failed", base_failed()).withColumn("pattern", votes(rules))
    # the statistics are written once: the model is fitted on them, then applied to them
    table = cut(stats)
    patterns = cut(table.filter("NOT base_failed").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).coalesce(1))
    model = fit(patterns, rules)
    return (table.withColumn("posterior", model.posterior(vote_cells(F.col("pattern"), rules)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior)))


def keep_good(docs: DataFrame, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, with their columns.

    Texts are not written or moved: the first pass only counts vote patterns,
    the second works out each row's verdict where it is read. The verdict picks
    rows through ``inline``, as a filter would be pushed below the statistics
    and repeat them for each place they are used in."""
    packed = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_in"))
    stats = text_statistics(packed, "_in", ["_row"]).withColumn("_failed", base_failed()).withColumn("_pattern", votes(rules))
    counted = cut(stats.select(F.when(~F.col("_failed"), F.col("_pattern")).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).coalesce(1))
    model = fit(counted.filter("pattern IS NOT NULL"), rules)
    good = ~F.col("_failed") & (model.posterior(vote_cells(F.col("_pattern"), rules)) >= min_posterior)
    return stats.select(F.inline(F.when(good, F.array("_row")))).toDF(*docs.columns)
