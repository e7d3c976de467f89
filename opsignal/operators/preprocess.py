"""Normalised and preprocessed signal frames, lemma tables and token statistics."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions import text as T
from opsignal.functions.clock import with_source_weight, with_time_features
from opsignal.functions.rounding import round_half_up
from opsignal.operators.validate import require_valid
from opsignal.session import materialise

# Noun endings and what they turn into.
NOUN_ENDINGS = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


#: Rows of a lemma table that may be put into an expression.
LEMMAS_IN_PLACE = 20_000


def normalise_signals(
    df: DataFrame, cfg: Config = DEFAULT, exception_before_lower: bool = False
) -> DataFrame:
    """Validate, add time features and source weight, and append ``normalised_text``."""
    ready = with_source_weight(with_time_features(require_valid(df, cfg), cfg), cfg)
    return ready.withColumn(
        "normalised_text", T.normalise_text(F.col("text"), exception_before_lower)
    )


def with_tokens(
    df: DataFrame, text_column: str = "normalised_text", stop_words: list[str] | None = None
) -> DataFrame:
    """Append ``tokens``, the kept words of ``text_column`` before lemmas."""
    if text_column not in df.columns:
        raise KeyError(text_column)
    return df.withColumn("tokens", T.tokenise(F.col(text_column), stop_words))


def vocabulary(df: DataFrame) -> DataFrame:
    """``(form, n)`` over the ``tokens`` of all rows."""
    return df.select(F.explode("tokens").alias("form")).groupBy("form").agg(F.count("*").alias("n"))


def lemma_table(vocab: DataFrame) -> DataFrame:
    """``(form, lemma)`` for forms whose noun ending can be undone into another form in use.

    The shortest candidate wins, then the alphabetically first. A row whose lemma
    would change again is left out, so applying the table twice changes nothing.
    """
    # Written, as three joins read them, and each would tokenise all texts again.
    forms = materialise(vocab.select("form").distinct(), "forms")

    def undone(form: Column) -> Column:
        options = [
            F.when(
                form.endswith(old),
                F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)),
            )
            for old, new in NOUN_ENDINGS
        ]
        return F.array_compact(F.array(*options))

    options = forms.filter(~F.col("form").isin(*T.MARKERS)).select(
        "form", F.explode(undone(F.col("form"))).alias("lemma")
    )
    real = options.join(forms.select(F.col("form").alias("lemma")), "lemma", "left_semi")
    shortest = F.min_by("lemma", F.struct(F.length("lemma"), "lemma"))
    step = materialise(real.groupBy("form").agg(shortest.alias("lemma")), "lemma_steps")
    return step.join(step.select(F.col("form").alias("lemma")), "lemma", "left_anti").select(
        "form", "lemma"
    )


def with_lemmas(df: DataFrame, lemma: DataFrame, key: str = "signal_id") -> DataFrame:
    """Replace ``tokens`` by their lemmas from ``lemma(form, lemma)``; ``key`` is unique.

    Only distinct tokens with a noun ending travel to the lemma table, and only
    those that change come back, as one small map per row.
    """
    inflected = F.filter("tokens", lambda w: w.endswith("s") | w.endswith("men"))
    asked = df.select(key, F.explode(F.array_distinct(inflected)).alias("form"))
    changes = (
        asked.join(lemma.select("form", "lemma"), "form")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("form", "lemma"))).alias("_map"))
    )
    spelt = F.transform("tokens", lambda w: F.coalesce(F.try_element_at("_map", w), w))
    return (
        df.join(changes, key, "left")
        .withColumn("tokens", F.when(F.col("_map").isNull(), F.col("tokens")).otherwise(spelt))
        .drop("_map")
    )


@dataclass(frozen=True)
class Lemmas:
    """A lemma table as a literal: an array of small maps, a form's map being found by its hash."""

    maps: Column
    parts: int

    def spell(self, tokens: Column) -> Column:
        """Tokens by their lemmas: an expression over the row alone, in batch and stream."""

        def one(w: Column) -> Column:
            part = F.element_at(self.maps, (F.pmod(F.xxhash64(w), F.lit(self.parts)) + 1).cast("int"))
            return F.when(w.endswith("s") | w.endswith("men"), F.coalesce(F.try_element_at(part, w), w)).otherwise(w)

        return F.transform(tokens, one)


def lemma_lookup(lemma: DataFrame, most: int = LEMMAS_IN_PLACE) -> Lemmas:
    """``lemma(form, lemma)`` for use inside expressions; at most ``most`` rows, else ``ValueError``.

    A larger table stays a table: give it to ``preprocess_signals`` as it is, which joins it (in a
    stream, within a micro-batch).
    """
    part = F.xxhash64("form").alias("h")
    rows = lemma.select("form", "lemma", part).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} lemmas: join them as a table")
    parts = max(1, len(rows) // 4)
    maps: list[dict] = [{} for _ in range(parts)]
    for r in rows:
        maps[r["h"] % parts][r["form"]] = r["lemma"]
    return Lemmas(F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>"), parts)


def lemmas_in_place(table: DataFrame) -> DataFrame | Lemmas:
    """A written lemma table for use inside expressions if it is short enough, else as it is."""
    return lemma_lookup(table) if table.count() <= LEMMAS_IN_PLACE else table


def with_corpus_lemmas(df: DataFrame, lemma: DataFrame | Lemmas, key: str = "signal_id") -> DataFrame:
    """Replace ``tokens`` by their lemmas, where the row is or by a join with a table."""
    if isinstance(lemma, Lemmas):
        return df.withColumn("tokens", lemma.spell(F.col("tokens")))
    return with_lemmas(df, lemma, key)


def preprocess_signals(
    df: DataFrame,
    text_column: str = "normalised_text",
    lemma: DataFrame | Lemmas | None = None,
    stop_words: list[str] | None = None,
    key: str = "signal_id",
) -> DataFrame:
    """Append ``tokens`` and ``preprocessed_text``; a projection unless a lemma table is to be joined by ``key``.

    Texts from outside a corpus are to be given the corpus' lemmas, or their inflected words
    meet none of its terms.
    """
    out = with_tokens(df, text_column, stop_words)
    if lemma is not None:
        out = with_corpus_lemmas(out, lemma, key)
    return out.withColumn("preprocessed_text", F.array_join("tokens", " "))


def _token_array(text_column: str) -> Column:
    return F.filter(F.split(text_column, T.SPACES), lambda w: w != "")


def token_stats(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """One row: signals, mean / least / most tokens per signal, distinct tokens."""
    per_signal = df.select(F.size(_token_array(text_column)).cast("bigint").alias("k")).agg(
        F.count("*").alias("signals"),
        F.coalesce(F.sum("k"), F.lit(0)).alias("total"),
        F.coalesce(F.min("k"), F.lit(0)).alias("min_tokens"),
        F.coalesce(F.max("k"), F.lit(0)).alias("max_tokens"),
    )
    unique = df.select(F.explode(_token_array(text_column)).alias("t")).agg(
        F.count_distinct("t").alias("unique_tokens")
    )
    mean = F.when(
        F.col("signals") > 0, round_half_up(F.col("total") / F.col("signals"), 2)
    ).otherwise(F.lit(0.0))
    # Both sides are one row by construction.
    return per_signal.join(F.broadcast(unique), F.lit(True)).select(
        "signals", mean.alias("avg_tokens"), "min_tokens", "max_tokens", "unique_tokens"
    )


def token_counts(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    return (
        df.select(F.explode(_token_array(text_column)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


def top_tokens(df: DataFrame, k: int = 10, text_column: str = "preprocessed_text") -> DataFrame:
    return token_counts(df, text_column).orderBy(F.desc("n"), "token").limit(k)


def marker_counts(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """Occurrences of every marker, 0 included."""
    spine = df.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(m) for m in sorted(T.MARKERS)))).alias("token")
    )
    found = (
        df.select(F.explode(_token_array(text_column)).alias("token"))
        .filter(F.col("token").isin(*T.MARKERS))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    return spine.join(found, "token", "left").select(
        "token", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def before_after_sample(df: DataFrame) -> DataFrame:
    """First signal of each source with its raw and normalised text."""
    from opsignal.operators.ranking import first_per_group

    narrow = df.select("source_type", "timestamp", "signal_id", "text", "normalised_text")
    return first_per_group(narrow, ["source_type"], ["timestamp", "signal_id"])
