"""Quality rules by weak supervision, with DataFrame functions only.

Base measures are counted in each row with array functions. Rules read them
and vote good, bad or abstain. The votes are grouped into patterns (at most
3 ** rules of them, however many documents), and expectation-maximisation over
the pattern counts estimates each rule's chances of either vote on good and on
bad documents, and with them its accuracy. A document's posterior probability of being good
replaces the conjunction of all rules: ``kept`` is posterior >= ``KEEP``, unless
the base limits fail it.

Defined results
  null, empty or wordless text   all counts 0, base_failed (fewer than 50 words)
  very long text                 counted whole
  repeated lines and windows     all of them, first included for windows, not for lines
  ties                           a posterior of exactly KEEP keeps
  repeated rows                  each row on its own (and each counts in the estimate)
  empty table                    no rows; the estimate stays at its start
  extra columns                  ignored
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP = 0.5
ROUNDS = 25
# Where the estimate starts: share of good documents, and chances of a good and
# a bad vote on good and on bad documents. A bad vote is rare on good text; bad
# text seldom fails many rules at once.
START_GOOD, START_ON_GOOD, START_ON_BAD = 0.8, (0.85, 0.01), (0.75, 0.2)
# Bounds without which two hidden classes need not be good and bad: a rule calls
# a good document bad this often at most, and a bad document, which seldom fails
# more than a rule or two, gets this share of a good document's good votes.
FALSE_ALARM, LEAST_GOOD_ON_BAD = 0.001, 0.9
PSEUDO = 2.0    # documents' worth of the start that stays in every round
GOOD, BAD, ABSTAIN = 1, 0, -1

# Rules: a measure, and the limits of its bad and good votes. "over" rules call
# large values bad, "under" rules small ones; between the limits they abstain.
RULES = (
    ("words", "under", 40, 90),
    ("mean_word_chars_low", "under", 2.2, 3.2),
    ("mean_word_chars_high", "over", 16.0, 9.5),
    ("symbols_per_word", "over", 0.15, 0.03),
    ("repeat_share", "over", 0.30, 0.12),
    ("dup_line_share", "over", 0.50, 0.05),
    ("distinct_share", "under", 0.20, 0.35),
    ("adjacent_share", "over", 0.15, 0.03),
    ("capital_share", "over", 0.40, 0.15),
    ("mark_share", "over", 0.20, 0.05),
    ("unended_line_share", "over", 0.95, 0.60),
    ("bar_share", "over", 0.10, 0.02),
)


def without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and what the rules read, one row a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", text.alias("text"), words.alias("words"),
                      F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    # hashes of all 3-word windows, in order
    window = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))) \
        .otherwise(F.array().cast("array<bigint>"))
    hashed = cut.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), without(F.col("text"), SPACE).cast("long").alias("word_chars"),
        (F.length("text") - without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"), F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size(F.filter(F.col("words"), lambda w, i: (i > 0) & (w == F.get("words", i - 1)))).alias("n_adjacent"),
        (F.length("text") - without(F.col("text"), CAPITALS)).alias("n_capitals"),
        (F.length("text") - without(F.col("text"), "!")).alias("n_marks"),
        (F.length("text") - without(F.col("text"), "|")).alias("n_bars"),
        F.size(F.filter("lines", lambda x: ~x.rlike(r"[.!?:;\"'\)\]][\x20\x09-\x0D]*$"))).alias("n_unended"),
        window.alias("windows"))
    # windows found twice or more: sort (hash, place) and look at both neighbours
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = hashed.withColumn("placed", F.when(twice, F.sort_array(
        F.transform(F.col("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    again = F.sort_array(F.transform(
        F.filter(F.col("placed"), lambda x, j: (x["h"] == F.get("placed", j - 1)["h"]) | (x["h"] == F.get("placed", j + 1)["h"])),
        lambda x: x["i"]))
    # the union of the places' three words each
    covered = F.aggregate(again, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
                          lambda a: a["n"])
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("placed")


def rule_measures() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b))    # null: the rule abstains
    return {
        "words": F.col("n_words").cast("double"), "mean_word_chars_low": share("word_chars", "n_words"),
        "mean_word_chars_high": share("word_chars", "n_words"), "symbols_per_word": share("n_symbols", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "distinct_share": F.when(F.col("n_words") <= 2000, share("n_distinct", "n_words")),
        "adjacent_share": share("n_adjacent", "n_words"), "capital_share": share("n_capitals", "word_chars"),
        "mark_share": share("n_marks", "n_words"), "unended_line_share": F.when(F.col("n_lines") >= 3, share("n_unended", "n_lines")),
        "bar_share": share("n_bars", "n_words"),
    }


def votes(measures: DataFrame) -> DataFrame:
    """``measures`` with a vote column v<j> for each rule."""
    of = rule_measures()
    cols = []
    for j, (name, kind, bad, good) in enumerate(RULES):
        x = of[name]
        is_bad, is_good = (x > bad, x <= good) if kind == "over" else (x < bad, x >= good)
        cols.append(F.when(is_bad, BAD).when(is_good, GOOD).otherwise(ABSTAIN).alias(f"v{j}"))
    return measures.select("*", *cols)


class Estimate:
    """Share of good documents and, for each rule, the chances of a good and
    of a bad vote on good documents and on bad ones; the rest abstains."""

    def __init__(self) -> None:
        self.good = START_GOOD
        self.on_good = [START_ON_GOOD] * len(RULES)
        self.on_bad = [START_ON_BAD] * len(RULES)

    def posterior(self) -> Column:
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for j, (g, b) in enumerate(zip(self.on_good, self.on_bad)):
            odds = odds + F.when(F.col(f"v{j}") == GOOD, math.log(g[0] / b[0])) \
                .when(F.col(f"v{j}") == BAD, math.log(g[1] / b[1])) \
                .otherwise(math.log((1 - sum(g)) / (1 - sum(b))))
        return 1 / (1 + F.exp(-odds))

    def numbers(self) -> list[float]:
        return [self.good, *(x for pair in (*self.on_good, *self.on_bad) for x in pair)]

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """How often a rule's vote is right on good and on bad documents."""
        return {r[0]: (g[0] / sum(g), b[1] / sum(b)) for r, g, b in zip(RULES, self.on_good, self.on_bad)}


def _chances(good: float, bad: float, n: float, start: tuple[float, float]) -> tuple[float, float]:
    return ((good + PSEUDO * start[0]) / (n + PSEUDO), (bad + PSEUDO * start[1]) / (n + PSEUDO))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Estimate:
    """Expectation-maximisation over ``patterns`` (v0.., n): each round is one
    global sum. ``PSEUDO`` documents that vote as at the start keep every
    chance inside (0, 1)."""
    e = Estimate()
    for _ in range(rounds):
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n).alias("n"), F.sum(p * n).alias("good")]
        for j in range(len(RULES)):
            for vote, name in ((GOOD, "g"), (BAD, "b")):
                cast = F.col(f"v{j}") == vote
                sums += [F.coalesce(F.sum(F.when(cast, p * n)), F.lit(0.0)).alias(f"{name}_good{j}"),
                         F.coalesce(F.sum(F.when(cast, (1 - p) * n)), F.lit(0.0)).alias(f"{name}_bad{j}")]
        r = patterns.withColumn("p", e.posterior()).agg(*sums).first()
        if not r["n"]:
            return e
        was, bad = e.numbers(), r["n"] - r["good"]
        e.good = (r["good"] + PSEUDO * START_GOOD) / (r["n"] + PSEUDO)
        e.on_good = [_chances(r[f"g_good{j}"], r[f"b_good{j}"], r["good"], START_ON_GOOD) for j in range(len(RULES))]
        e.on_bad = [_chances(r[f"g_bad{j}"], r[f"b_bad{j}"], bad, START_ON_BAD) for j in range(len(RULES))]
        for j, (g, b) in enumerate(zip(e.on_good, e.on_bad)):       # what is known of the rules beforehand
            e.on_good[j] = g = (g[0], min(g[1], FALSE_ALARM))
            alarm = max(b[1], 2 * g[1])
            e.on_bad[j] = (min(max(b[0], LEAST_GOOD_ON_BAD * g[0]), 1 - alarm - 1e-3), alarm)
        if max(abs(x - y) for x, y in zip(was, e.numbers())) < 1e-6:
            break
    return e


def judge(docs: DataFrame) -> DataFrame:
    """The base counts, base_failed, posterior and kept of every row."""
    measured = stored(base_measures(docs), "quality-measures")
    voted = votes(measured)
    names = [f"v{j}" for j in range(len(RULES))]
    patterns = stored(voted.groupBy(*names).agg(F.count("*").alias("n")), "quality-patterns")
    posterior = estimate(patterns.coalesce(1)).posterior()      # at most 3 ** rules rows
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return voted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & (posterior >= KEEP)).alias("kept"), posterior.alias("posterior"))


def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
