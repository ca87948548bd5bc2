"""Quality rules with risk-controlled thresholds.

Counts per text feed a few rules, each of which rejects a text whose measure exceeds a cutoff. The
cutoffs are chosen on labelled holdout documents: for each stratum of text length and each rule,
the exact binomial test of the false rejections among good documents must refute, at a level
divided by the number of all tests, that the rule rejects more than its share of the allowed rate.
Of the cutoffs that pass, the lowest is taken; where none passes, the rule rejects nothing there.
So with the given confidence no stratum loses more than the allowed part of its good documents.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import held_out
from tallyloom.session import stored

#: Good documents that a stratum may lose, and the chance that the promise fails.
RATE, LEVEL = 0.05, 0.05
#: Lower word counts of the strata.
STRATA = (0, 50, 200, 1000)
#: Measures (per thousand, but for the mean word length in tenths) and their candidate cutoffs.
RULES = {
    "symbols": (20, 50, 100, 150, 200, 300, 400),
    "dup_lines": (50, 100, 200, 300, 400, 500),
    "repeats": (20, 50, 100, 150, 200),
    "word_length": (70, 80, 90, 100, 120, 150),
    "capitals": (100, 200, 300, 400, 600, 800),
}

_BLANK = r"[ \t-\r]+"


def _when_any(n: Column, part: Column, scale: int) -> Column:
    return F.when(n > 0, F.floor(part * scale / n)).otherwise(F.lit(0)).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """Counts per document from its text alone; null is an empty text. Nothing is shuffled."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    split = base.select(
        "doc_id",
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[A-Z]", ""))).cast("long").alias("n_capitals"),
        F.filter(F.split("text", r"\n"), lambda line: line.rlike(r"[^ \t-\r]")).alias("lines"),
        F.filter(F.split("text", _BLANK), lambda w: w != "").alias("words"),
    )
    counted = split.select(
        "doc_id",
        "n_symbols",
        "n_capitals",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= 5,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 5),
                lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(5)]),
            ),
        ).alias("windows"),
    )
    # most texts repeat nothing, which a set of hashes tells; only the others are sorted
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(
        some, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )
    sorted_ = counted.withColumn("placed", placed).drop("windows")
    last = F.size("placed") - 1
    same = lambda i, j: F.get("placed", i)["h"] == F.get("placed", j)["h"]
    repeated = F.when(
        F.col("placed").isNotNull(),
        F.array_sort(
            F.transform(
                F.filter(
                    F.sequence(F.lit(0), last),
                    lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)),
                ),
                lambda i: F.get("placed", i)["i"],
            )
        ),
    )
    starts = sorted_.withColumn("starts", repeated).drop("placed")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("n"), F.lit(-5).alias("at")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(5), i - acc["at"])).alias("n"), i.alias("at")),
        lambda acc: acc["n"],
    )
    return starts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_capitals",
        "n_lines",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def with_measures(counts: DataFrame) -> DataFrame:
    """Adds the base verdict, the stratum and the rules' measures as whole numbers."""
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    stratum = F.lit(0)
    for k, low in enumerate(STRATA):
        stratum = F.when(n >= low, F.lit(k)).otherwise(stratum)
    return counts.withColumns(
        {
            "base_failed": (n < 10) | (100 * repeats > 20 * n),
            "stratum": stratum,
            "symbols": _when_any(F.col("word_chars"), F.col("n_symbols"), 1000),
            "dup_lines": _when_any(F.col("n_lines"), F.col("n_dup_lines"), 1000),
            "repeats": _when_any(n, repeats, 1000),
            "word_length": _when_any(n, F.col("word_chars"), 10),
            "capitals": _when_any(F.col("word_chars"), F.col("n_capitals"), 1000),
        }
    )


def at_most(k: Column, n: Column, rate: float) -> Column:
    """The chance that a binomial count of ``n`` trials at ``rate`` is ``k`` or less, exactly.

    Each term follows from the one before, in logarithms. Above the mean the chance is no longer
    small and 1 stands for it, so the sum has no more terms than expected rejections.
    """
    step = math.log(rate) - math.log1p(-rate)
    first = n * math.log1p(-rate)
    total = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
        F.struct(first.alias("term"), F.exp(first).alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] + F.ln((n - i + 1) / i) + step).alias("term"),
            (acc["sum"] + F.exp(acc["term"] + F.ln((n - i + 1) / i) + step)).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(k >= n * rate, 1.0).when(k == 0, F.exp(first)).otherwise(total)


def safe_cutoffs(measured: DataFrame, labels: DataFrame, rate: float = RATE, level: float = LEVEL) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected): the lowest cutoff of each rule that passes its test.

    Labelled rows kept out of every fit are not used. Base failures are left out: the rules only
    judge what passes the base.
    """
    good = (
        labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .select("doc_id")
    )
    holdout = measured.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    counts = [F.count("*").alias("n")]
    for rule, cutoffs in RULES.items():
        counts += [F.sum((F.col(rule) > c).cast("long")).alias(f"{rule}_{c}") for c in cutoffs]
    # one row for each stratum, one test for each cutoff
    tests = holdout.groupBy("stratum").agg(*counts)
    cells = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{rule}_{c}").alias("rejected"))
            for rule, cutoffs in RULES.items()
            for c in cutoffs
        ]
    )
    number = len(STRATA) * sum(map(len, RULES.values()))
    tests = tests.select("stratum", "n", F.explode(cells).alias("cell")).select("stratum", "n", "cell.*")
    passed = tests.filter(at_most(F.col("rejected"), F.col("n"), rate / len(RULES)) <= level / number)
    return passed.groupBy("stratum", "rule").agg(
        F.min("cutoff").alias("cutoff"), F.first("n").alias("n"), F.min_by("rejected", "cutoff").alias("rejected")
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, rate: float = RATE, level: float = LEVEL) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document.

    Null and empty texts have no words and fail the base. Repeated documents are judged alike; an
    id with several labels is good only if all say so; a null id is kept as it is. Without labels
    no rule has a cutoff and the base alone decides. Other columns are ignored.
    """
    measured = stored(with_measures(text_counts(docs)), "quality-counts")
    # one row for each stratum and rule at most
    cutoffs = safe_cutoffs(measured, labels, rate, level).collect()
    rejected = F.lit(False)
    for c in sorted(cutoffs, key=lambda r: (r["stratum"], r["rule"])):
        rejected = rejected | ((F.col("stratum") == c["stratum"]) & (F.col(c["rule"]) > c["cutoff"]))
    return measured.withColumn("kept", ~F.col("base_failed") & ~rejected)
