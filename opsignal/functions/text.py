"""Text normalisation and tokenisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from opsignal.functions.stopwords import domain_stop_words

# Markers that stand for volatile text, and the patterns they replace.
MARKERS = ("PCTVAL", "TIMEVAL", "NUMVAL", "VERVAL", "IPADDR", "EXCEPTION")
LOG_LEVEL = r"(?i)(?:^|(?<=\n))(?:critical|error|warn(?:ing)?|alert|fatal|info):?\s*"
PERCENT = r"\d+\.?\d*%"
CLOCK = r"(?U)\b\d{2}:\d{2}(?::\d{2})?\b"
VERSION = r"(?U)\bv\d+[\d.]*\b"
IPV4 = r"(?U)\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"
LONG_INT = r"(?U)\b\d{3,}\b"
EXCEPTION = r"\b[A-Z][a-zA-Z]+(?:Exception|Error)\b"
SPECIAL = r"(?U)[^\p{L}\p{N}_\s\-/]"
SPACES = r"(?U)\s+"
# Contractions the word tokenizer cuts in two.
CONTRACTIONS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))


def as_text(col: Column) -> Column:
    """Any value as text; a missing one reads ``None``."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def strip_log_level(col: Column) -> Column:
    return F.regexp_replace(col, LOG_LEVEL, "")


def mask_percent(col: Column) -> Column:
    return F.regexp_replace(col, PERCENT, "PCTVAL")


def mask_clock(col: Column) -> Column:
    return F.regexp_replace(col, CLOCK, "TIMEVAL")


def mask_version(col: Column) -> Column:
    return F.regexp_replace(col, VERSION, "VERVAL")


def mask_ip(col: Column) -> Column:
    return F.regexp_replace(col, IPV4, "IPADDR")


def mask_long_int(col: Column) -> Column:
    return F.regexp_replace(col, LONG_INT, "NUMVAL")


def mask_exception(col: Column) -> Column:
    return F.regexp_replace(col, EXCEPTION, "EXCEPTION")


def drop_special(col: Column) -> Column:
    return F.regexp_replace(col, SPECIAL, " ")


def squeeze(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, SPACES, " "))


def normalise_text(col: Column, exception_before_lower: bool = False) -> Column:
    """The whole chain. Lower case comes first, so the exception rule needs its option to fire."""
    out = as_text(col)
    if exception_before_lower:
        # Marked before the text loses its capitals, spelt back after.
        out = F.regexp_replace(out, EXCEPTION, "exceptionmarkerx")
    out = F.lower(out)
    for step in (strip_log_level, mask_percent, mask_clock, mask_version, mask_ip, mask_long_int):
        out = step(out)
    if exception_before_lower:
        out = F.regexp_replace(out, "exceptionmarkerx", "EXCEPTION")
    out = mask_exception(out)
    return squeeze(drop_special(out))


def words(col: Column) -> Column:
    """Words of a normalised text: blanks separate, a few contractions and ``--`` split."""
    pairs = "|".join(f"({head})({tail})" for head, tail in CONTRACTIONS)
    heads = "".join(f"${2 * i + 1}" for i in range(len(CONTRACTIONS)))
    tails = "".join(f"${2 * i + 2}" for i in range(len(CONTRACTIONS)))
    # One pass: groups of the other contractions are empty.
    out = F.regexp_replace(col, rf"(?U)\b(?:{pairs})\b", f" {heads} {tails} ")
    out = F.replace(out, F.lit("--"), F.lit(" -- "))
    return F.filter(F.split(out, " "), lambda w: w != "")


def keep_words(tokens: Column, stop_words: list[str] | None = None) -> Column:
    """Markers as they are; other words in lower case unless short or a stop word."""
    stops = domain_stop_words() if stop_words is None else list(stop_words)

    def wanted(w: Column) -> Column:
        useful = F.length(w) > 1
        if stops:
            useful = useful & ~F.lower(w).isin(*stops)
        return w.isin(*MARKERS) | useful

    def spelt(w: Column) -> Column:
        return F.when(w.isin(*MARKERS), w).otherwise(F.lower(w))

    return F.transform(F.filter(tokens, wanted), spelt)


def tokenise(col: Column, stop_words: list[str] | None = None) -> Column:
    """Kept tokens of a normalised text, in order, before lemmas."""
    return keep_words(words(col), stop_words)


def feature_terms(col: Column) -> Column:
    """Vectoriser terms: lower case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def ngrams(tokens: Column, longest: int = 2) -> Column:
    """The tokens followed by their runs of 2..``longest`` neighbours joined by a blank."""
    out = runs = tokens
    for n in range(2, longest + 1):
        left = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        # A run of n is a run of n - 1 and the token n - 1 places on.
        runs = F.zip_with(
            F.slice(runs, F.lit(1), left), F.slice(tokens, F.lit(n), left), lambda a, b: F.concat_ws(" ", a, b)
        )
        out = F.concat(out, runs)
    return out


def snippet(col: Column, length: int = 80) -> Column:
    return F.substring(col, 1, length)
