"""Quality rules with risk-controlled thresholds (operator 13), in DataFrame operations only.

A text's counts give five rates, each the worse the higher: symbols, long words, short
words, repeated lines and repeated words. From one third of the labelled documents come the
usual value and spread of each rate among good ones; the excess of a document is how many
spreads its worst rate lies above the usual value. A rejection cutoff on the excess is then
chosen per stratum (a band of lengths) from a fixed row of cutoffs, lax to strict:

- that third proposes the cutoff that best tells its good documents from its bad ones;
- the others, the holdouts, certify cutoffs. For each one the exact binomial bound
  tests the hypothesis that more than ``MAX_FALSE_REJECTION`` of the good documents are
  rejected. Cutoffs are tested in the fixed order and testing ends with the first that
  isn't certified, so a row of tests needs no further correction; the error allowed is
  divided by the number of strata, as each has its own row (Bonferroni).

The strictest certified cutoff, but none beyond the proposed one, is used. So with
probability ``1 - ERROR`` no stratum loses more than that share of its good documents to
the cutoffs, the base rules aside. A stratum with too few good holdouts has no cutoff.

Defined results: a null text has no words and fails the base rules, as does any with too
few. Labels other than 0 and 1, and rows without an id, are ignored; equal labels count
once, and a document labelled both ways counts as good, which can only loosen a cutoff. A
label counts for each row of its id. Without labels only the base rules reject. An empty
table gives no rows. One row per row of the table; other columns are not read. A text's
words are arrays inside one row, so a text is bounded by what an executor can hold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.common import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW_WORDS = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The most of a stratum's good documents that cutoffs may reject, and the chance that one does reject more.
MAX_FALSE_REJECTION = 0.05
ERROR = 0.05
# Strata: bands of lengths from so many words.
BANDS = (50, 250)
# Of every three labelled documents, by a hash of the id, one proposes and two are held out.
PROPOSING = 3
# Cutoffs on the excess, in the order of the tests.
CUTOFFS = (40.0, 30.0, 24.0, 20.0, 16.0, 13.0, 10.0, 8.0, 6.5, 5.0, 4.0, 3.0)
# Rates, and the least spread that each is taken to have.
RATES = {"symbols": 0.02, "long_words": 0.25, "short_words": 0.25, "dup_lines": 0.01, "repeat_words": 0.05}
# Accuracy of the percentiles that give usual value and spread.
ACCURACY = 10_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _windows(each) -> Column:
    """An array of ``each(first, second, third)`` over the windows of ``words``."""
    last = F.size("words") - WINDOW_WORDS
    window = lambda at: each(*[F.get("words", at + k) for k in range(WINDOW_WORDS)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda at: window(at)))


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and the columns of ``COUNTS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    hashed = cut.withColumn("hashes", _windows(F.xxhash64))
    # Hashes only rule out texts without any repeated window; the others' windows are compared themselves.
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    places = F.transform(
        _windows(lambda *words: F.concat_ws(" ", *words)), lambda one, at: F.struct(one.alias("window"), at.alias("at"))
    )
    ordered = hashed.withColumn("ordered", F.when(repeats, F.sort_array(places)))
    equal = lambda one, at: F.coalesce(one["window"] == F.get("ordered", at)["window"], F.lit(False))
    met_again = F.filter(
        "ordered", lambda one, at: equal(one, at + 1) | F.when(at > 0, equal(one, at - 1)).otherwise(F.lit(False))
    )
    starts = ordered.withColumn("starts", F.sort_array(F.transform(met_again, lambda one: one["at"])))
    # A window covers its words up to the next one's first.
    covered = F.transform(
        "starts",
        lambda start, at: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("starts", at + 1) - start, F.lit(WINDOW_WORDS))),
    )
    return starts.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda total, one: total + one), F.lit(0).cast("long")).alias(
            "n_repeat_words"
        ),
    )


def with_strata(counts: DataFrame) -> DataFrame:
    """Adds ``base_failed``, ``stratum`` (null below the first band) and ``rates``, an array in the order of ``RATES``."""
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)
    band = F.lit(None).cast("int")
    for at, least in enumerate(BANDS):
        band = F.when(words >= least, at).otherwise(band)
    mean = F.col("word_chars") / F.greatest(words, F.lit(1))
    share = lambda name: F.col(name) / F.greatest(words, F.lit(1))
    rates = F.array(share("n_symbols"), mean, -mean, share("n_dup_lines"), share("n_repeat_words"))
    return counts.withColumns({"base_failed": failed, "stratum": band, "rates": rates})


def _draw(doc_id: Column) -> Column:
    """A number from the id's MD5 (its first seven hex digits)."""
    return F.conv(F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 7), 16, 10).cast("long")


def labelled_counts(counts: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """The rows of ``counts`` that pass the base rules and have a label: ``label`` and ``holdout`` are added."""
    wanted = (
        labels.select(F.col(id_col).cast("long").alias("labelled"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("labelled").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("labelled")
        .agg(F.max("label").alias("label"))
    )
    # One way at every size; a hot id is a large partition of an ordinary join, which adaptive execution splits.
    return (
        counts.where("not base_failed and stratum is not null")
        .join(wanted.hint("merge"), F.col("doc_id") == F.col("labelled"))
        .select("stratum", "rates", "label", (_draw(F.col("doc_id")) % PROPOSING != 0).alias("holdout"))
    )


def excess(usual: list[tuple[float, float]]) -> Column:
    """How many spreads the worst of ``rates`` lies above its usual value."""
    return F.greatest(*[(F.get("rates", F.lit(at)) - middle) / spread for at, (middle, spread) in enumerate(usual)])


def usual_rates(labelled: DataFrame) -> list[tuple[float, float]]:
    """Median and interquartile range of each rate among the good documents that aren't held out."""
    quartiles = [
        F.percentile_approx(F.get("rates", F.lit(at)), [0.25, 0.5, 0.75], ACCURACY).alias(name)
        for at, name in enumerate(RATES)
    ]
    row = labelled.where("label = 1 and not holdout").agg(*quartiles).first()  # three numbers per rate
    found = [(row[name] or [0.0, 0.0, 0.0], least) for name, least in RATES.items()]
    return [(middle, max(least, high - low)) for (low, middle, high), least in found]


def binomial_tail(trials: Column, hits: Column, chance: float) -> Column:
    """The probability of at most ``hits`` of ``trials`` at ``chance``: its terms are added up as logarithms."""
    odds, rest = math.log(chance / (1 - chance)), math.log1p(-chance)
    first = trials * F.lit(rest)
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(acc: Column, hit: Column) -> Column:
        term = acc["term"] + F.log((trials - hit + 1) / hit) + F.lit(odds)
        above, below = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (above + F.log1p(F.exp(below - above))).alias("total"))

    steps = F.when(hits >= 1, F.sequence(F.lit(1).cast("long"), hits)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(steps, start, add, lambda acc: F.least(F.lit(1.0), F.exp(acc["total"])))
    # Above the mean the tail is about a half or more: no bound is met there, so nothing is added up.
    return F.when(hits > trials * chance, F.lit(1.0)).otherwise(tail)


def choose_cutoffs(
    labelled: DataFrame,
    usual: list[tuple[float, float]],
    max_false_rejection: float = MAX_FALSE_REJECTION,
    error: float = ERROR,
) -> DataFrame:
    """Per stratum with a certified cutoff: stratum, cutoff, n_holdouts, n_rejected (of them) and tail (its probability)."""
    good, held = F.col("label") == 1, F.col("holdout")
    groups = {"tuned_good": good & ~held, "tuned_bad": ~good & ~held, "held_good": good & held}
    counted = labelled.select("stratum", "label", "holdout", excess(usual).alias("excess"))
    totals = [F.count(F.when(group, 1)).alias(name) for name, group in groups.items()]
    rejected = [
        F.array(*[F.count(F.when(group & (F.col("excess") > cutoff), 1)) for cutoff in CUTOFFS]).alias(f"{name}_out")
        for name, group in groups.items()
    ]
    cutoffs = F.array(*[F.lit(cutoff) for cutoff in CUTOFFS])
    # One row per stratum and cutoff: a few dozen, whatever the input.
    rows = (
        counted.groupBy("stratum")
        .agg(*totals, *rejected)
        .select("*", F.posexplode(cutoffs).alias("turn", "cutoff"))
        .select(
            "stratum",
            "turn",
            "cutoff",
            F.col("held_good").alias("n_holdouts"),
            F.get("held_good_out", F.col("turn")).alias("n_rejected"),
            (
                F.coalesce(F.get("tuned_bad_out", F.col("turn")) / F.nullif("tuned_bad", F.lit(0)), F.lit(0.0))
                - F.coalesce(F.get("tuned_good_out", F.col("turn")) / F.nullif("tuned_good", F.lit(0)), F.lit(0.0))
            ).alias("gain"),
        )
        .withColumn("tail", binomial_tail(F.col("n_holdouts"), F.col("n_rejected"), max_false_rejection))
    )
    in_order = Window.partitionBy("stratum").orderBy("turn")
    # Of equal gains the laxest cutoff is proposed.
    best = F.max(F.struct("gain", (-F.col("turn")).alias("turn"))).over(Window.partitionBy("stratum"))
    tested = rows.withColumns(
        {
            "certified": F.min(F.col("tail") <= error / len(BANDS)).over(in_order),
            "proposed": -best["turn"],
        }
    )
    last = F.max_by(F.struct("cutoff", "n_holdouts", "n_rejected", "tail"), "turn").alias("last")
    return tested.where("certified and turn <= proposed").groupBy("stratum").agg(last).select("stratum", "last.*")


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """Per row of ``docs``: doc_id, the columns of ``COUNTS``, base_failed, stratum, excess, cutoff and kept."""
    counts = with_strata(written(text_counts(docs, id_col, text_col), "counts"))
    labelled = written(labelled_counts(counts, labels, label_id_col, label_col), "labelled")
    usual = usual_rates(labelled)
    cutoffs = choose_cutoffs(labelled, usual).select(F.col("stratum").alias("band"), "cutoff")
    # At most one row per band is broadcast.
    judged = counts.withColumn("excess", excess(usual)).join(
        F.broadcast(cutoffs), F.col("stratum") == F.col("band"), "left"
    )
    passes = F.coalesce(F.col("excess") <= F.col("cutoff"), F.lit(True))
    return judged.select(
        "doc_id", *COUNTS, "base_failed", "stratum", "excess", "cutoff", (~F.col("base_failed") & passes).alias("kept")
    )
