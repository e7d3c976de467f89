"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every rule is a share that is high in bad documents. Labelled documents are counted by rule,
stratum and the level of a fixed ladder of cutoffs that they reach. A cutoff may be used if the
hypothesis "it rejects more than ``RISK`` of the good documents of the stratum" is refuted by the
exact binomial test. Cutoffs are tested from the loosest to the strictest and the first failure
ends a ladder (fixed-sequence testing, so that a ladder needs no correction of its own); the level
of a test is ``ERROR`` divided by the number of ladders (rules by strata, Bonferroni). With
probability 1 - ``ERROR``, no rule in use rejects more than its ``RISK`` of any stratum's good
documents, and all rules together no more than the sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.llm.common import materialise

RISK, ERROR = 0.01, 0.05
LEVELS = 40
#: A cutoff is taken where it pays most: a bad document found counts 1, a good one lost as much as this.
LOSS = 5
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
_SPACE = r"[\x20\x09-\x0D]+"

#: Rule -> (share, least cutoff); a share without a denominator is null. The cutoffs are least * (1 / least) ** (level / LEVELS), level 0 to LEVELS.
RULES = {
    "symbols": ("try_divide(n_symbols, word_chars)", 0.002),
    "repeats": ("try_divide(n_repeat_words, n_words)", 0.01),
    "dup_lines": ("try_divide(n_dup_lines, n_lines)", 0.01),
    "capitals": ("try_divide(n_capitals, word_chars)", 0.02),
    "short_words": ("try_divide(n_words, word_chars)", 0.05),
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _deleted(text: Column, characters: str) -> Column:
    """How many of the characters a text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _joined(hashes: Column, by: int) -> Column:
    """Hashes of runs twice as long: element i with element i + ``by``."""
    size = F.size(hashes) - by
    return F.zip_with(F.slice(hashes, F.lit(1), size), F.slice(hashes, F.lit(by + 1), size), lambda a, b: F.xxhash64(a, b))


def _covered(positions: Column) -> Column:
    """Words in the windows that start at the sorted positions."""
    size = F.size(positions) - 1
    steps = F.zip_with(
        F.slice(positions, F.lit(1), size), F.slice(positions, F.lit(2), size),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    return F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x).cast("long")


def _repeated(windows: Column) -> Column:
    """Words in windows whose hash is there twice, by one sort of (hash, position)."""
    def count(pairs):
        size = F.size(pairs) - 1
        twins = F.zip_with(
            F.slice(pairs, F.lit(1), size), F.slice(pairs, F.lit(2), size),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>")),
        )
        return _let(F.sort_array(F.array_distinct(F.flatten(twins))), _covered)

    found = _let(F.sort_array(F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p")))), count)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(found)


def _repeat_words(words: Column) -> Column:
    def windows(hashes):
        return _let(_joined(hashes, 1), lambda two: _let(_joined(two, 2), lambda four: _let(_joined(four, 4), _repeated)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(_let(hashes, windows))


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, base_failed``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
    ))
    of_lines = _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    found = docs.select(
        *keep, _deleted(text, SYMBOLS).alias("n_symbols"), _deleted(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        of_words.alias("_w"), of_lines.alias("_l"),
    )
    flat = found.select(
        *keep, "_w.n_words", "_w.word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words", "_l.n_lines", "n_capitals"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return flat.withColumn("base_failed", failed)


def _levels() -> Column:
    """Highest rung of each rule's ladder that a document's share exceeds, -1 for none."""
    def level(share, least):
        value = F.coalesce(F.expr(f"CAST({share} AS DOUBLE)"), F.lit(0.0))
        # the small term keeps equal shares on one side of a rung
        rung = F.ceil(F.log(value / least) / F.log(F.lit(1 / least)) * LEVELS - 1e-9) - 1
        return F.when(value > least, F.least(rung, F.lit(LEVELS))).otherwise(F.lit(-1)).cast("int")

    return F.array(*[
        F.struct(F.lit(name).alias("rule"), level(share, least).alias("level")) for name, (share, least) in RULES.items()
    ])


def _log_gamma(x: Column) -> Column:
    """Stirling's series after ten steps of the recurrence; exact to about 1e-13."""
    z = x + 10
    product = F.lit(1.0)
    for i in range(10):
        product = product * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - F.log(product)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial count, for k below the mean; 1 from the mean on.

    Summed downwards from the largest term; beyond 20 * sqrt(n) steps terms are under e**-200.
    """
    k, n = k.cast("double"), n.cast("double")
    log_top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    steps = F.sequence(F.lit(0), F.least(k, F.ceil(F.sqrt(n)) * 20 + 50).cast("int"))
    terms = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct(
            (a["term"] * (k - i) / (n - k + i + 1) * ((1 - p) / p)).alias("term"), (a["sum"] + a["term"]).alias("sum")
        ),
        lambda a: a["sum"],
    )
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(log_top) * terms)


def cutoffs(labelled: DataFrame) -> DataFrame:
    """``stratum, rule, level``: documents of the stratum whose rung is ``level`` or higher are rejected.

    ``labelled`` has ``stratum``, ``good`` (boolean) and the features. Documents that fail the base
    rules are rejected anyway and calibrate nothing. Rules without a safe and useful cutoff are absent.
    """
    rows = labelled.filter(~F.col("base_failed") & F.col("good").isNotNull())
    rungs = rows.select("stratum", "good", F.explode(_levels()).alias("r")).groupBy("stratum", "r.rule", "r.level").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    ladder = Window.partitionBy("stratum", "rule")
    down = ladder.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    counted = rungs.select(
        "stratum", "rule", "level",
        F.sum("good").over(down).alias("lost"), F.sum("bad").over(down).alias("found"), F.sum("good").over(ladder).alias("n"),
    ).filter("level >= 0")
    ladders = rungs.agg((F.count_distinct("stratum") * len(RULES)).alias("ladders"))
    tested = counted.crossJoin(F.broadcast(ladders))  # a single number
    tested = tested.withColumn("safe", binomial_cdf(F.col("lost"), F.col("n"), RISK) <= F.lit(ERROR) / F.col("ladders"))
    open_ = tested.withColumn("safe", F.min("safe").over(down))
    gain = F.col("found") - LOSS * F.col("lost")
    best = open_.filter(F.col("safe") & (gain > 0)).groupBy("stratum", "rule").agg(
        F.max_by("level", F.struct(gain, F.col("level"))).alias("level")
    )
    return best


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id``, the base columns, ``base_failed``, ``kept`` and ``failed_rules``, one row per document.

    ``labels`` has ``doc_id, quality`` (1 good, 0 bad; others and nulls teach nothing). A null stratum is
    a stratum of its own. Null and empty texts have no words and fail the base rules. Repeated rows are
    judged alike; with repeated labels of a document, every one counts. A null ``doc_id`` is kept and
    unlabelled. A share without a denominator is 0. Without labels no rule is in use. Further columns
    are not read. Empty table: no rows.
    """
    base = docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "text")
    rated = materialise(features(base, "doc_id", "stratum"), "features")
    marks = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good")
    )
    chosen = cutoffs(rated.join(marks, F.col("doc_id") == F.col("_id")))
    ladder = F.map_from_entries(F.collect_list(F.struct("rule", "level")))
    by_stratum = materialise(chosen.groupBy("stratum").agg(ladder.alias("limits")), "cutoffs")
    judged = rated.join(by_stratum, "stratum", "left")
    failed = F.filter(_levels(), lambda r: r["level"] >= F.element_at("limits", r["rule"]))
    failed = F.coalesce(F.array_join(F.transform(failed, lambda r: r["rule"]), ","), F.lit(""))
    judged = judged.withColumn("failed_rules", F.when(F.col("limits").isNull(), F.lit("")).otherwise(failed))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules",
    )
