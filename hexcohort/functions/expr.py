"""Column expressions shared by every operator.

All of them compile to built-in Catalyst expressions, so a chain of derived
columns stays inside one whole-stage-codegen span.  The null rules follow the
data model: missing is NULL, a clip keeps NULL, a flag of NULL is 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rnd(c: Column, digits: int) -> Column:
    """Round half to even on the scaled double (Spark's ``round`` is half-up)."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def out(c: Column, digits: int = 6) -> Column:
    """Round a reported float and turn ``-0.0`` into ``0.0``."""
    return rnd(c, digits) + F.lit(0.0)


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to ``[lo, hi]``; NULL stays NULL (``least``/``greatest`` would skip it)."""
    x = c
    if lo is not None:
        x = F.greatest(x, F.lit(float(lo)))
    if hi is not None:
        x = F.least(x, F.lit(float(hi)))
    return F.when(c.isNotNull(), x)


def flag(cond: Column) -> Column:
    """0/1 integer; an undecidable condition counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def opt_col(df: DataFrame, name: str, default: float) -> Column:
    """The column, or a constant when the column is absent (present NULLs stay)."""
    return F.col(name) if name in df.columns else F.lit(default)


def argmax_label(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Label of the largest value; the first declared label wins a tie."""
    top = F.greatest(*[c for _, c in pairs])
    first, *rest = pairs
    chain = F.when(first[1] == top, F.lit(first[0]))
    for label, c in rest:
        chain = chain.when(c == top, F.lit(label))
    return chain


def cut(c: Column, bins: Sequence[tuple[float, str]], low: float = 0.0) -> Column:
    """Right-closed bins ``(lo, hi] -> label``; everything else is the text ``nan``."""
    lo, chain = low, None
    for hi, label in bins:
        cond = (c > F.lit(float(lo))) & (c <= F.lit(float(hi)))
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
        lo = hi
    return chain.otherwise(F.lit("nan"))


def shannon(values: Sequence[Column]) -> Column:
    """Entropy (natural log) of values normalised by their sum; zeros drop out.

    Any NULL among the values empties the sum, which gives 0.
    """
    total = reduce(lambda a, b: a + b, values) + F.lit(1e-10)

    def term(v: Column) -> Column:
        p = v / total
        return F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0))

    return F.coalesce(-reduce(lambda a, b: a + b, [term(v) for v in values]), F.lit(0.0)) + F.lit(0.0)


def literal_map(mapping: Mapping) -> Column:
    """A constant ``MAP`` column: lookups in fixed small tables need no join."""
    parts: list[Column] = []
    for k, v in mapping.items():
        parts += [F.lit(k), F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)]
    return F.create_map(*parts)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Scan-boundary rule: NaN means missing."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if c in floats else F.col(c)
                       for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("double", "float", "integer", "long", "short", "byte", "decimal")
    return [f.name for f in df.schema.fields if f.dataType.typeName().split("(")[0] in kinds]
