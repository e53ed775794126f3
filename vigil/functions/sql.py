"""Building blocks for SQL expressions, and the one way columns are added.

Formulas are kept as SQL text: a layer of columns is then a single
``selectExpr``, read and optimised by Spark in one go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def num(value: float) -> str:
    """A DOUBLE literal (0.2 alone would be a DECIMAL)."""
    return f"{float(value)!r}D"


def text(value: str) -> str:
    """A string literal, taken as it stands."""
    return "r'" + value + "'" if "'" not in value else '"' + value + '"'


def flag(condition: str) -> str:
    """1.0 when the condition holds, else 0.0 (also for NULL)."""
    return f"CASE WHEN {condition} THEN 1.0D ELSE 0.0D END"


def capped(value: str, full: float = 1.0) -> str:
    """Share of ``full`` that ``value`` reaches, at most 1."""
    return f"least(({value}) / {num(full)}, 1.0D)"


def at_most_one(value: str) -> str:
    return f"least(1.0D, {value})"


def clip01(value: str) -> str:
    return f"greatest(0.0D, least(1.0D, {value}))"


def at_least_one(value: str) -> str:
    return f"greatest({value}, 1.0D)"


def weighted_sum(weights, terms: dict[str, str] | None = None) -> str:
    """Sum of weight * term, in the order given; a term not in ``terms`` is a column name."""
    terms = terms or {}
    return " + ".join(f"{num(w)} * ({terms.get(name, name)})" for name, w in weights)


def zero_if_missing(column: str) -> str:
    return f"coalesce(nanvl({column}, NULL), 0.0D)"


def hash_uniform(seed: int, tag: str, *columns: str) -> str:
    """Uniform number in [0, 1) that depends only on the values of ``columns``.

    The first 32 bits of an md5: the same for any partitioning and in any SQL engine.
    """
    parts = ", ".join(f"CAST({c} AS STRING)" for c in columns)
    return (f"CAST(conv(substring(md5(concat_ws(':', '{seed}', '{tag}', {parts})), 1, 8), 16, 10) AS DOUBLE)"
            " / 4294967296.0D")


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add (or replace) columns given as SQL; they see the frame as it was, not one another."""
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    return df.selectExpr(*kept, *[f"{e} AS `{name}`" for name, e in columns.items()])
