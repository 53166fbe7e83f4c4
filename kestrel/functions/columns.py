"""Column expressions. All are built-in Spark functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
EPSILON = 1e-6  # guard added to ratio denominators
POSITIVE_SHARES = 1400  # y = shares > 1400
TWO_POW_32 = 4294967296.0


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def md5_key(id_col: str | Column, seed: str | int) -> Column:
    """Hex md5 of ``"<id>:<seed>"``: a deterministic, retry-safe random order key."""
    return F.md5(F.concat(_c(id_col).cast("string"), F.lit(f":{seed}")))


def md5_uniform(id_col: str | Column, seed: str | int) -> Column:
    """Uniform draw in [0, 1) from the first 32 bits of ``md5_key``."""
    head = F.substring(md5_key(id_col, seed), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def md5_bucket(key: str | Column, digits: int) -> Column:
    """Leading ``digits`` hex digits of an md5 key as an int; monotone in the key's string order."""
    return F.conv(F.substring(_c(key), 1, digits), 16, 10).cast("bigint")


def nan_to_null(col: str | Column) -> Column:
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def guarded_ratio(num: str | Column, den: str | Column, eps: float = EPSILON) -> Column:
    """``num / (den + eps)``; NULL in, NULL out. ``try_divide``: a denominator that still lands on 0 gives NULL
    (imputed later) instead of failing the job under ANSI mode."""
    return F.try_divide(_c(num), _c(den) + F.lit(eps))


def spread(hi: str | Column, lo: str | Column) -> Column:
    return _c(hi) - _c(lo)


def product(a: str | Column, b: str | Column) -> Column:
    return _c(a) * _c(b)


def row_max(cols: Sequence[str | Column]) -> Column:
    """Row-wise max that skips NULL; all NULL gives NULL. Inputs must be NaN-free (see nan_to_null)."""
    cs = [_c(c) for c in cols]
    return cs[0] if len(cs) == 1 else F.greatest(*cs)


def row_std(cols: Sequence[str | Column]) -> Column:
    """Row-wise sample standard deviation (ddof = 1) over the present values; fewer than 2 gives NULL.

    Two passes written as plain arithmetic over the fixed column list (no array lambdas), so the expression stays
    inside whole-stage codegen: mean of the present values, then the sum of squared deviations.
    """
    xs = [_c(c).cast("double") for c in cols]
    n = None
    total = None
    for x in xs:
        n = x.isNotNull().cast("int") if n is None else n + x.isNotNull().cast("int")
        total = F.coalesce(x, F.lit(0.0)) if total is None else total + F.coalesce(x, F.lit(0.0))
    mean = F.try_divide(total, n)
    ss = None
    for x in xs:
        term = F.when(x.isNotNull(), (x - mean) * (x - mean)).otherwise(F.lit(0.0))
        ss = term if ss is None else ss + term
    return F.when(n >= 2, F.sqrt(F.try_divide(ss, n - 1)))


def threshold_label(col: str | Column, threshold: float = POSITIVE_SHARES) -> Column:
    return (_c(col) > F.lit(threshold)).cast("int")


def positive_probability(prob_col: str = "probability") -> Column:
    """P(y = 1) from a pyspark.ml probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(prob_col))[1]


def hard_class(prob: str | Column) -> Column:
    """Class from P(y = 1): argmax with ties to class 0, i.e. ``p > 0.5``."""
    return (_c(prob) > F.lit(0.5)).cast("int")


def r6(col: str | Column) -> Column:
    """Round half up to 6 decimals as ``floor(x * 1e6 + 0.5) / 1e6``: plain IEEE steps, so any engine that evaluates
    the same formula on the same double gets the same bits (engine ``round`` functions differ on near-halves)."""
    return F.floor(_c(col) * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)
