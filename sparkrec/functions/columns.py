"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF. Spark 4 runs with ANSI mode on,
so every division below is guarded explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles leave every query rounded to this many places, which hides all but rare
# differences of the order in which a shuffle summed them; pair sums are exact.
OUT_DECIMALS = 6
# Weights are ordered on this many places before any top-k or argmin; the
# tie is then broken by the declared id order.
ORDER_DECIMALS = 12


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(x, lo: float | None, hi: float | None) -> Column:
    """Clamp into [lo, hi]; null stays null (``greatest`` would skip it)."""
    x = _c(x)
    out = x
    if hi is not None:
        out = F.when(x > F.lit(float(hi)), F.lit(float(hi))).otherwise(out)
    if lo is not None:
        out = F.when(x < F.lit(float(lo)), F.lit(float(lo))).otherwise(out)
    return out


def amplify(w, p: float) -> Column:
    """Case amplification ``w * |w|^(p-1)``; keeps the sign of ``w``."""
    w = _c(w)
    return w * F.pow(F.abs(w), F.lit(float(p) - 1.0))


def guarded_div(num, den, otherwise) -> Column:
    """``num/den`` when ``den > 0`` else ``otherwise`` (ANSI-safe)."""
    num, den = _c(num), _c(den)
    other = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(den > 0, num / den).otherwise(other)


def key_hash(*cols, seed: int | str = 0, width: int = 4) -> Column:
    """Portable key hash: the first ``width`` hex digits of
    ``md5(c1 || ':' || c2 ... || ':' || seed)`` read as an integer.

    The same value is computable in any SQL engine with md5, so splits and
    folds agree with the DuckDB oracle and do not depend on partitioning.
    """
    parts = []
    for c in cols:
        parts += [_c(c).cast("string"), F.lit(":")]
    parts.append(F.lit(str(seed)))
    hexed = F.substring(F.md5(F.concat(*parts)), 1, width)
    return F.conv(hexed, 16, 10).cast("int")


def pair_key(user, item) -> Column:
    """The reference's composite text key ``"user,item"`` (output only)."""
    return F.concat_ws(",", _c(user).cast("string"), _c(item).cast("string"))


def attach_row(df, one_row):
    """Attach the columns of a one-row aggregate (a global mean, an offset,
    fitted coefficients) to every row of ``df``.

    The row is a scalar subquery: computed once, inlined as a value, no join.
    Spark raises if the subquery ever returns more than one row, so the
    one-row bound is enforced, not assumed.
    """
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_row")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in cols])
