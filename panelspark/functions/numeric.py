"""Number helpers. Division never raises: a zero divisor gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """NaN and both infinities become NULL."""
    c = as_col(c)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def nullify_non_finite(df: DataFrame) -> DataFrame:
    """Apply :func:`finite` to every floating column in one projection."""
    return df.select(
        *[
            finite(f.name).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL where den is 0."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def guarded_ratio(num: Column | str, den: Column | str, threshold: float) -> Column:
    """num / den only where |den| is above the threshold."""
    den = as_col(den)
    return F.when(F.abs(den) > F.lit(threshold), ratio(num, den))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation as an aggregate, NULL when one side is constant."""
    x, y = as_col(x), as_col(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def compound(r: Column | str) -> Column:
    """Aggregate: prod(1 + r) - 1."""
    return F.exp(F.sum(F.log1p(as_col(r)))) - F.lit(1.0)


def to_number(c: Column | str) -> Column:
    """Text or number to double, NULL where it does not parse."""
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")


def clip(c: Column | str, lower: Column, upper: Column) -> Column:
    c = as_col(c)
    return F.when(c < lower, lower).when(c > upper, upper).otherwise(c)


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(as_col(c), digits)
