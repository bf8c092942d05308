"""Quality of texts by weak supervision, in DataFrame functions only.

Rules look at counted features and vote good or bad, or abstain.  How far each
rule is to be trusted is estimated by expectation-maximisation from how the
votes of all documents agree that pass the base rule; a document is kept by the
posterior probability that it is good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import stored

WINDOW = 8
BLANKS = " \t\n\x0b\x0c\r"
_SEPARATOR = r"[ \x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"


def features(docs: DataFrame) -> DataFrame:
    """Counted features of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and a few more.

    The arrays of a text stay within its row; nothing is shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("trimmed", F.btrim("text", F.lit(BLANKS)))
    rows = rows.withColumn(
        "words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", _SEPARATOR))
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", _SEPARATOR, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^0-9]+", "")).cast("long").alias("n_digits"),
        F.regexp_count("text", F.lit(_SYMBOLS + "+")).cast("long").alias("n_symbol_runs"),
        F.regexp_count("text", F.lit(r"[.!?]([ \x09-\x0D]|$)")).cast("long").alias("n_stops"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        lines.alias("lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("prints"),
    )
    rows = rows.select(
        *(c for c in rows.columns if c not in ("lines", "prints")),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("prints") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("prints") - WINDOW),
                lambda i: F.xxhash64(*(F.get("prints", i + k) for k in range(WINDOW))),
            ),
        ).alias("windows"),
    )
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda value, at: F.struct(value.alias("print"), at.alias("at"))))
    rows = rows.withColumn("placed", F.when(again, placed)).drop("windows")
    repeated = F.filter(
        "placed",
        lambda own, at: own["print"].eqNullSafe(F.get("placed", at - 1)["print"])
        | own["print"].eqNullSafe(F.get("placed", at + 1)["print"]),
    )
    rows = rows.withColumn("starts", F.array_sort(F.transform(repeated, lambda own: own["at"]))).drop("placed")
    # each start covers the words up to the next start, at most a window
    reach = F.transform(
        "starts", lambda start, at: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", at + 1) - start, F.lit(WINDOW)))
    )
    covered = F.aggregate(reach, F.lit(0), lambda total, size: total + size)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1))


def votes() -> dict[str, Column]:
    """What each rule says of a text: 1 good, 0 bad, null if it abstains."""
    n, lines = F.col("n_words"), F.col("n_lines")
    size, per_line = F.col("word_chars"), F.try_divide("n_words", "n_lines")
    never = F.lit(False)
    return {
        "length": _vote(n < 20, never),
        "word_size": _vote((size < 2.5 * n) | (size > 11 * n), never),
        "digits": _vote(F.col("n_digits") > 0.1 * size, never),
        "line_size": _vote((per_line < 3) & (lines >= 5), never),
        "symbols": _vote(F.col("n_symbols") > 0.1 * n, F.col("n_symbols") <= 0.02 * n),
        "marked_words": _vote(F.col("n_symbol_runs") > 0.15 * n, F.col("n_symbol_runs") <= 0.03 * n),
        "sentences": _vote(
            (n >= 20) & (n > 80 * F.col("n_stops")), (n >= 20) & (n <= 30 * F.col("n_stops")) & (n >= 2 * F.col("n_stops"))
        ),
        "duplicate_lines": _vote(F.col("n_dup_lines") > 0.2 * lines, (F.col("n_dup_lines") == 0) & (lines >= 3)),
        "repeats": _vote(F.col("n_repeat_words") > 0.15 * n, (F.col("n_repeat_words") <= 0.02 * n) & (n >= 40)),
        "variety": _vote(
            (n >= 20) & (F.col("n_distinct_words") < 0.25 * F.least(n, F.lit(400))),
            (n >= 20) & (F.col("n_distinct_words") >= 0.4 * F.least(n, F.lit(400))),
        ),
    }


@dataclass
class Trust:
    """Share of good texts, and per rule how often it votes good on good texts and bad on bad ones."""

    prior: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def log_odds(self) -> Column:
        """Log odds that a text is good, given the votes in its columns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, good in self.on_good.items():
            bad = self.on_bad[rule]
            total = total + F.when(F.col(rule) == 1, F.lit(math.log(good / (1 - bad)))).when(
                F.col(rule) == 0, F.lit(math.log((1 - good) / bad))
            ).otherwise(F.lit(0.0))
        return total


def posterior(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _within(value: float, low: float, high: float) -> float:
    return min(max(value, low), high)


def estimate(voted: DataFrame, rules: list[str], rounds: int = 15) -> Trust:
    """Expectation-maximisation over the counts of equal vote patterns.

    All documents take part; there are at most 3 ** rules patterns.  Rates are
    smoothed, kept between 0.02 and 0.98, and add up to 1 at least, so that a
    rule never counts against its own vote; one that nobody uses keeps its start.
    """
    patterns = stored(voted.groupBy(*rules).agg(F.count(F.lit(1)).cast("double").alias("n")), "patterns")
    trust = Trust(0.8, dict.fromkeys(rules, 0.8), dict.fromkeys(rules, 0.8))
    for _ in range(rounds):
        weighed = patterns.withColumn("good", F.col("n") * posterior(trust.log_odds())).withColumn(
            "bad", F.col("n") - F.col("good")
        )
        sums = weighed.agg(
            F.sum("good").alias("good"),
            F.sum("n").alias("n"),
            *(
                F.sum(F.when(F.col(rule).isNotNull() if side else F.col(rule) == vote, F.col(kind))).alias(
                    f"{rule}_{kind}_{side}"
                )
                for rule in rules
                for kind, vote in (("good", 1), ("bad", 0))
                for side in (0, 1)
            ),
        ).first()
        if not sums["n"]:
            return trust
        rates = {
            kind: {
                rule: _within(
                    ((sums[f"{rule}_{kind}_0"] or 0) + 0.8) / ((sums[f"{rule}_{kind}_1"] or 0) + 1), 0.02, 0.98
                )
                for rule in rules
            }
            for kind in ("good", "bad")
        }
        rates["bad"] = {rule: max(rate, 1 - rates["good"][rule]) for rule, rate in rates["bad"].items()}
        trust = Trust(_within(sums["good"] / sums["n"], 0.05, 0.95), rates["good"], rates["bad"])
    return trust


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Features, votes, posterior and verdict of each row of ``docs`` (doc_id, text; other columns are not read).

    ``base_failed`` rows are not kept; the others are if their posterior
    probability reaches ``least``.  A null or empty text has no words and fails
    the base rule.  Repeated rows are judged alike and count as often as they
    occur; an empty table gives an empty result.

    The features are stored once, because the votes are read twice: to estimate
    the rules, from all documents that pass the base rule, and to judge the texts.
    """
    held = stored(features(docs).withColumns(votes()).withColumn("base_failed", base_failed()), "features")
    rules = list(votes())
    trust = estimate(held.filter(~F.col("base_failed")), rules)
    return held.withColumn("posterior", posterior(trust.log_odds())).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= least)
    )
