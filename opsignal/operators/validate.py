"""Schema and value checks on raw signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsignal.config import Config, DEFAULT, REQUIRED_COLUMNS

CHECKS = (
    "Required columns present",
    "source_type values valid",
    "category values valid",
    "No nulls in required columns",
)


def _not_in(col: str, allowed) -> Column:
    """True for values outside ``allowed``; null counts as outside."""
    return ~F.coalesce(F.col(col).isin(*allowed), F.lit(False))


def validation_report(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows ``(check_name, passed)`` for the four checks, from one pass over ``df``."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    never = F.lit(1)
    bad_source = _not_in("source_type", cfg.source_weights) if "source_type" in df.columns else None
    bad_category = _not_in("category", cfg.categories) if "category" in df.columns else None
    nulls = None
    if not missing:
        nulls = F.lit(False)
        for c in REQUIRED_COLUMNS:
            nulls = nulls | F.col(c).isNull()

    def worst(flag: Column | None) -> Column:
        if flag is None:
            return F.max(never)
        return F.coalesce(F.max(flag.cast("int")), F.lit(0))

    worsts = df.agg(
        worst(bad_source).alias("s"), worst(bad_category).alias("c"), worst(nulls).alias("n")
    )
    passed = (F.lit(not missing), F.col("s") == 0, F.col("c") == 0, F.col("n") == 0)
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("check_name"), ok.alias("passed"))
            for name, ok in zip(CHECKS, passed)
        )
    )
    return worsts.select(F.inline(rows))


def row_is_valid(cfg: Config = DEFAULT) -> Column:
    """Per-row form of the value checks, for gates and quarantine streams."""
    ok = ~_not_in("source_type", cfg.source_weights) & ~_not_in("category", cfg.categories)
    for c in REQUIRED_COLUMNS:
        ok = ok & F.col(c).isNotNull()
    return ok


def require_valid(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """``df`` itself, failing while it is read if a column or a value is wrong.

    No extra pass: the check is part of the plan and stops the job on the first
    bad row.
    """
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"schema validation failed, missing columns: {missing}")
    message = F.concat(
        F.lit("schema validation failed for signal "),
        F.coalesce(F.col("signal_id").cast("string"), F.lit("(no id)")),
    )
    # A filter stays in the plan whatever is selected later; a column would be pruned with its check.
    checked = F.when(row_is_valid(cfg), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(checked)


def split_valid(df: DataFrame, cfg: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows."""
    flag = row_is_valid(cfg)
    return df.filter(flag), df.filter(~flag)


def bad_values(df: DataFrame, column: str, allowed) -> DataFrame:
    """Distinct values of ``column`` outside ``allowed`` and how often they occur."""
    return (
        df.filter(_not_in(column, allowed))
        .groupBy(F.col(column).alias("bad_value"))
        .agg(F.count("*").alias("n"))
    )


def null_census(df: DataFrame, columns=REQUIRED_COLUMNS) -> DataFrame:
    """Nulls per column, one row each, from one pass."""
    counts = df.agg(*(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns))
    rows = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns)
    )
    return counts.select(F.inline(rows))
