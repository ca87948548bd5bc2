"""URL filter: host and path rules, and for other URLs a ratio of character language models.

Two smoothed variable-order Markov models are counted, one over URLs that the rules accept and one
over those they reject. The chance of a character is taken from its longest context and smoothed
towards that of the next shorter one, so contexts that were never seen fall back by themselves.
The score of a URL is the difference of its log-likelihoods per character; the cut is where a part
of the decided URLs, kept out of the counts, is told apart best.

The models see the whole text of a URL as it stands, with its scheme, query and fragment. Equal
URLs are worked on once but count as often as pages have them. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored

#: Rules as (host, path, verdict); fixed values.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
ORDER = 3
#: Weight of the next shorter context, in characters seen.
SMOOTHING = 2.0
#: Equal chance of a character before anything is counted.
UNIFORM = 1.0 / 128
#: Scores are compared in steps of 1/100, from -10 to 10.
STEPS, SPAN = 100, 10

_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, *_LETTERS), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)


def rule_column(host: Column, path: Column, rules: tuple, what: str) -> Column:
    """The ``rule`` text or its ``verdict``: of the rules that fit, the longest; else null."""
    chosen = F.lit(None).cast("string")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        value = rule_host + rule_path if what == "rule" else verdict
        chosen = F.when(_fits(host, path, rule_host, rule_path), F.lit(value)).otherwise(chosen)
    return chosen


def parsed_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, decided, shape) of each page; the shape is the whole URL."""
    host, path = F.col("host"), F.col("path")
    return (
        pages.select(
            F.col("page_id"),
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
            F.coalesce(F.col("url"), F.lit("")).alias("shape"),
        )
        .withColumn("rule", rule_column(host, path, rules, "rule"))
        .withColumn("decided", rule_column(host, path, rules, "verdict"))
    )


def _pages_of(verdict: str) -> Column:
    return F.sum(F.when(F.col("decided") == verdict, F.col("n")).otherwise(0))


def _kept_out(shape: Column) -> Column:
    return F.crc32(shape) % 5 == 0


def _gram_rows(shapes: DataFrame) -> DataFrame:
    """One row for each character of a shape (and its end mark) with the context before it."""
    text = F.concat(F.lit("^"), F.col("shape"), F.lit("$"))
    at = F.col("at")
    return (
        shapes.withColumn("marked", text)
        .withColumn("at", F.explode(F.sequence(F.lit(2), F.length("marked"))))
        .withColumn("gram", F.substring(F.col("marked"), F.greatest(F.lit(1), at - ORDER), F.least(at, F.lit(ORDER + 1))))
        .drop("marked", "at")
    )


def gram_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio): log ratio of the accepted and the rejected model for each distinct gram.

    ``grams`` has ``gram``, ``decided`` (null where a row only needs a ratio) and ``n``, the pages
    that a row stands for.
    """
    counted = stored(
        grams.groupBy("gram").agg(
            _pages_of("allow").alias("good"), _pages_of("block").alias("bad")
        ),
        "url-grams",
    )
    totals = counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    known = counted.select("gram")
    for side in ("good", "bad"):
        known = known.withColumn(f"p_{side}", F.lit(UNIFORM))
    for k in range(ORDER + 1):
        own, before = F.right("gram", F.lit(k + 1)), F.right("gram", F.lit(k + 1)).substr(F.lit(1), F.lit(k))
        long_enough = counted.filter(F.length("gram") > k)
        sums = [F.sum("good").alias("good"), F.sum("bad").alias("bad")]
        hits = long_enough.groupBy(own.alias("own")).agg(*sums)
        known = known.withColumn("own", F.when(F.length("gram") > k, own)).join(hits, "own", "left")
        if k:
            around = long_enough.groupBy(before.alias("before")).agg(
                F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad")
            )
            known = known.withColumn("before", F.when(F.length("gram") > k, before)).join(around, "before", "left")
        else:
            known = known.withColumns(
                {"before": F.lit(""), "all_good": F.lit(totals["good"] or 0), "all_bad": F.lit(totals["bad"] or 0)}
            )
        columns = ["gram"]
        for side in ("good", "bad"):
            smooth = (F.col(side) + SMOOTHING * F.col(f"p_{side}")) / (F.col(f"all_{side}") + SMOOTHING)
            columns.append(F.when(F.length("gram") > k, smooth).otherwise(F.col(f"p_{side}")).alias(f"p_{side}"))
        known = known.select(*columns)
    return known.select("gram", (F.ln("p_good") - F.ln("p_bad")).alias("ratio"))


def _best_cut(scored: DataFrame) -> float:
    """The score that tells kept-out accepted and rejected pages apart best; 0 without both."""
    step = F.least(F.greatest(F.round(F.col("score") * STEPS), F.lit(-SPAN * STEPS)), F.lit(SPAN * STEPS))
    # at most one row for each step of the score
    rows = (
        scored.filter(F.col("decided").isNotNull() & _kept_out(F.col("shape")))
        .groupBy(step.cast("long").alias("step"))
        .agg(_pages_of("allow").alias("good"), _pages_of("block").alias("bad"))
        .orderBy("step")
        .collect()
    )
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return 0.0
    lost = spared = 0
    best, cut = 1.0, rows[0]["step"]  # everything accepted
    for r in rows:
        lost, spared = lost + r["good"], spared + r["bad"]
        gain = spared / bad + 1 - lost / good
        if gain > best + 1e-9:
            best, cut = gain, r["step"] + 1
    return (cut - 0.5) / STEPS


def url_verdicts(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page.

    A null URL, or one without ``://``, has an empty host and path and is judged by the models
    like any other, by its own text (a null one by the empty text). ``score`` is null where a rule decides. Without decided URLs of both kinds
    every other URL is allowed when its score is 0 or more. Repeated rows are judged alike, ids
    are only passed on, and other columns are ignored. An empty table gives no rows.
    """
    parsed = parsed_urls(pages, rules)
    shapes = stored(parsed.groupBy("shape", "decided").agg(F.count(F.lit(1)).alias("n")), "url-shapes")
    grams = _gram_rows(shapes)
    counts = F.when(_kept_out(F.col("shape")), F.lit(None)).otherwise(F.col("decided"))
    ratios = gram_ratios(grams.withColumn("decided", counts))
    needed = grams.filter(F.col("decided").isNull() | _kept_out(F.col("shape")))
    scored = stored(
        needed.join(ratios, "gram").groupBy("shape", "decided", "n").agg(F.avg("ratio").alias("score")), "url-scores"
    )
    cut = _best_cut(scored)
    judged = scored.filter("decided IS NULL").select("shape", "score")
    verdict = F.coalesce("decided", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    # a URL that a rule decides finds no score; with its URL as key it is not one of many NULL keys
    return parsed.join(judged, "shape", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
