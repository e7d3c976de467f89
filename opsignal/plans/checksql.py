"""Building blocks of the check SQL: the derived views as common table expressions."""

from __future__ import annotations

from opsignal.config import DEFAULT
from opsignal.functions import text
from opsignal.functions.stopwords import domain_stop_words
from opsignal.operators.preprocess import NOUN_ENDINGS
from opsignal.sources import views

EVENT = f"event_signals AS ({views.EVENT_SIGNALS})"
DOC = f"doc_signals AS ({views.DOC_SIGNALS})"
VEC = f"vector_signals AS ({views.VECTOR_SIGNALS})"

SOURCE_WEIGHT = (
    "CASE {c} WHEN 'alert' THEN 1.0::DOUBLE WHEN 'ticket' THEN 0.8::DOUBLE "
    "WHEN 'log' THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END"
)
CATEGORY_LIST = ", ".join(f"'{c}'" for c in DEFAULT.categories)


def predictions(source: str) -> str:
    return f"predictions AS ({views.PREDICTIONS.format(signals=source)})"


def rnd(expr: str, digits: int = 4) -> str:
    """The library's half-up rounding on the decimal value."""
    return f"CAST(round(CAST({expr} AS DECIMAL(18,9)), {digits}) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return (
        f"CASE WHEN {den} > 0 THEN {rnd(f'CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)')} "
        "ELSE 0.0::DOUBLE END"
    )


def units(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,9)) * 10000, 0) AS BIGINT)"


def mean_units(total: str, count: str) -> str:
    """Half-up mean of integer units, integer arithmetic only."""
    return (
        f"CASE WHEN {count} > 0 THEN "
        f"CAST(({total} * 2 + {count}) // ({count} * 2) AS DOUBLE) / 10000 ELSE 0.0::DOUBLE END"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"

# Text rules in the checker's regex dialect: no lookbehind, ASCII word class.
LEVEL = r"(?:critical|error|warn(?:ing)?|alert|fatal|info):?\s*"
LEVEL_CHAIN = rf"(?:{LEVEL}\n)*{LEVEL}"


def strip_level(t: str) -> str:
    first = rf"regexp_replace({t}, '^{LEVEL_CHAIN}', '')"
    return rf"regexp_replace({first}, '(\n){LEVEL_CHAIN}', '\1', 'g')"


def mask(t: str, pattern: str, marker: str) -> str:
    return f"regexp_replace({t}, '{pattern}', '{marker}', 'g')"


def mask_percent(t: str) -> str:
    return mask(t, r"\d+\.?\d*%", "PCTVAL")


def mask_clock(t: str) -> str:
    return mask(t, r"\b\d{2}:\d{2}(?::\d{2})?\b", "TIMEVAL")


def mask_version(t: str) -> str:
    return mask(t, r"\bv\d+[\d.]*\b", "VERVAL")


def mask_ip(t: str) -> str:
    return mask(t, r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "IPADDR")


def mask_long_int(t: str) -> str:
    return mask(t, r"\b\d{3,}\b", "NUMVAL")


def drop_special(t: str) -> str:
    return mask(t, r"[^\p{L}\p{N}_\s\-/]", " ")


def squeeze(t: str) -> str:
    return rf"trim(regexp_replace({t}, '\s+', ' ', 'g'))"


def normalise(t: str) -> str:
    out = f"lower(coalesce(CAST({t} AS STRING), 'None'))"
    for step in (strip_level, mask_percent, mask_clock, mask_version, mask_ip, mask_long_int):
        out = step(out)
    return squeeze(drop_special(out))


def word_list(t: str) -> str:
    out = t
    for head, tail in text.CONTRACTIONS:
        out = rf"regexp_replace({out}, '\b({head})({tail})\b', ' \1 \2 ', 'gi')"
    out = f"replace({out}, '--', ' -- ')"
    return rf"list_filter(regexp_split_to_array({out}, '\s+'), lambda w: w <> '')"


_MARKS = ", ".join(f"'{m}'" for m in text.MARKERS)
_STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in domain_stop_words())


def kept_tokens(words: str) -> str:
    kept = (
        f"list_filter({words}, lambda w: w IN ({_MARKS}) OR (length(w) > 1 AND lower(w) NOT IN ({_STOPS})))"
    )
    return f"list_transform({kept}, lambda w: CASE WHEN w IN ({_MARKS}) THEN w ELSE lower(w) END)"


def feature_terms(t: str) -> str:
    return rf"regexp_extract_all(lower({t}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def normalised(source: str) -> str:
    return f"normalised AS (SELECT *, {normalise('text')} AS normalised_text FROM {source})"


def tokenised(source: str = "normalised") -> str:
    return f"tokenised AS (SELECT *, {kept_tokens(word_list('normalised_text'))} AS tokens FROM {source})"


def lemma_ctes(vocab: str) -> tuple[str, ...]:
    """``vocab(form)`` to ``lemmas(form, lemma)``."""
    options = " UNION ALL ".join(
        f"SELECT form, concat(left(form, length(form) - {len(old)}), '{new}') AS lemma FROM vocab "
        f"WHERE ends_with(form, '{old}') AND form NOT IN ({_MARKS})"
        for old, new in NOUN_ENDINGS
    )
    return (
        f"vocab AS ({vocab})",
        f"undone AS ({options})",
        """steps AS (SELECT form, lemma FROM (SELECT form, lemma, row_number() OVER
 (PARTITION BY form ORDER BY length(lemma), lemma) AS r FROM undone
 WHERE lemma IN (SELECT form FROM vocab)) WHERE r = 1)""",
        "lemmas AS (SELECT form, lemma FROM steps WHERE lemma NOT IN (SELECT form FROM steps))",
    )


PREPROCESSED = (
    *lemma_ctes("SELECT DISTINCT unnest(tokens) AS form FROM tokenised"),
    """lemma_map AS (SELECT map(list(form), list(lemma)) AS m FROM lemmas)""",
    """preprocessed AS (SELECT t.*, array_to_string(list_transform(t.tokens,
 lambda w: coalesce(m[w], w)), ' ') AS preprocessed_text FROM tokenised t, lemma_map)""",
)
