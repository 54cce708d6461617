"""Column expressions shared by the operators.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen.  Arithmetic that the SQL marts perform on NUMERIC goes through
``decimal(38,10)`` so rounding is half away from zero on the decimal value,
then leaves as double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import params as P

NUMERIC = "decimal(38,10)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_itself(rounded: Column, x: Column, limit: float) -> Column:
    """A finite double too large for the decimal type has no digits behind
    the point, so rounding leaves it as it is; what is not finite gives NULL."""
    size = F.abs(x)
    return F.coalesce(rounded.cast("double"), F.when((size >= limit) & (size < float("inf")), x))


def dec_round(c, digits: int) -> Column:
    """round(x::numeric, digits) as double."""
    return _or_itself(F.round(col(c).try_cast(NUMERIC), digits), col(c).cast("double"), 1e27)


def edge_round(c, digits: int = 6) -> Column:
    """Output rounding of a floating aggregate, engine independent.

    The value first goes to 9 decimals: for |x| < 4e6 a double is within
    half a unit of the 9th decimal of the decimal number it stands for, so
    an exact tie (an average of cents ending in ...5 at the 7th decimal)
    is recovered the same way whether an engine converts through the
    shortest decimal string or through the binary value; then it is
    rounded half away from zero."""
    return _or_itself(F.round(F.round(col(c).try_cast("decimal(38,12)"), 9), digits), col(c).cast("double"), 1e25)


def gap_expr(value, bench) -> Column:
    """value as percent of the benchmark, 2 decimals; NULL when the
    benchmark is NULL or 0 (divide first, then times 100)."""
    v, b = col(value), col(bench)
    return (F.when(b.isNull() | (b == 0), F.lit(None).cast("double"))
            .otherwise(dec_round(v / b * 100, 2)))


def status_expr(slope, bucket, labels: dict, bands: P.Bands = P.Bands(),
                context_branch: bool = True, num=None, den=None,
                num_scale: int = 1) -> Column:
    """Dead-band classification of a slope.

    NULL slope first, then (optionally) the never-classified ``context``
    bucket, then the two directed buckets with strict bands; anything else
    is ``not_classified``.

    With ``num`` / ``den`` (exact integer numerator, in units of
    1/``num_scale``, and positive denominator of the slope, see ``trend``)
    the band tests are exact: ``slope > band`` becomes
    ``num > band * num_scale * den``, so a slope lying exactly on a band is
    ``flat`` whatever the floating-point rounding of the regression.  A
    series without exact terms (see ``trend``) is judged by its float slope.
    """
    from decimal import Decimal
    s, b = col(slope), col(bucket)
    if num is None:
        def gt(v):
            return s > v

        def lt(v):
            return s < v
    else:
        # Both sides get one explicit type: Spark coerces a comparison of
        # decimal(38,2) with decimal(38,1) to scale 1 and drops a digit.
        cmp_type = "decimal(38,4)"
        n_, d_ = col(num).try_cast(cmp_type), col(den).cast("decimal(38,0)")

        def bound(v):
            return (F.lit(Decimal(repr(v)) * num_scale) * d_).cast(cmp_type)

        def gt(v):
            return F.coalesce(n_ > bound(v), s > v)

        def lt(v):
            return F.coalesce(n_ < bound(v), s < v)
    conv = (F.when(gt(bands.convergence), labels["up"])
            .when(lt(-bands.convergence), labels["down"])
            .otherwise(labels["flat"]))
    inv = (F.when(lt(-bands.context_inverted), labels["up"])
           .when(gt(bands.context_inverted), labels["down"])
           .otherwise(labels["flat"]))
    e = F.when(s.isNull(), labels["no_data"])
    if context_branch:
        e = e.when(b == P.CONTEXT, labels["not_classified"])
    return (e.when(b == P.CONTEXT_INVERTED, inv)
            .when(b == P.CONVERGENCE, conv)
            .otherwise(labels["not_classified"]))


def closed_expr(bucket, gap_ref) -> Column:
    b, g = col(bucket), col(gap_ref)
    return (((b == P.CONVERGENCE) & (g >= P.PARITY))
            | ((b == P.CONTEXT_INVERTED) & (g <= P.PARITY)))


def closure_status_expr(bucket, gap_ref, status) -> Column:
    return F.when(F.coalesce(closed_expr(bucket, gap_ref), F.lit(False)),
                  P.ALREADY_CLOSED).otherwise(col(status))


def years_to_close_expr(bucket, gap_ref, slope, status) -> Column:
    """Constant-rate closing time, 1 decimal, in the fixed branch order."""
    b, g, s, st = col(bucket), col(gap_ref), col(slope), col(status)
    lab = P.TRAJECTORY_LABELS
    conv_years = dec_round(F.try_divide(F.lit(P.PARITY) - g, s), 1)
    inv_years = dec_round(F.try_divide(g - F.lit(P.PARITY), F.abs(s)), 1)
    return (F.when(st == lab["no_data"], F.lit(None).cast("double"))
            .when(g.isNull(), F.lit(None).cast("double"))
            .when((b == P.CONVERGENCE) & (g >= P.PARITY), F.lit(0.0))
            .when((b == P.CONTEXT_INVERTED) & (g <= P.PARITY), F.lit(0.0))
            .when(st != lab["up"], F.lit(None).cast("double"))
            .when(b == P.CONVERGENCE, conv_years)
            .when(b == P.CONTEXT_INVERTED, inv_years))


def pretty_label(c) -> Column:
    """``catching_up`` -> ``catching up``."""
    return F.translate(col(c), "_", " ")


def years_bucket_expr(status, years) -> Column:
    """Display bucket of a closing time.  Non-closing statuses are echoed
    first (so a stalled row that is already closed shows its status)."""
    st, y = col(status), col(years)
    lab, (b1, b2, b3) = P.YEARS_BUCKET_LABELS, P.YEARS_BUCKET_BOUNDS
    echo = st.isin(P.TRAJECTORY_LABELS["no_data"], P.TRAJECTORY_LABELS["down"],
                   P.TRAJECTORY_LABELS["flat"])
    return (F.when(echo, pretty_label(st))
            .when(y.isNull(), lab["unknown"])
            .when(y == 0, lab["closed"])
            .when(y < b1, lab["lt20"])
            .when(y <= b2, lab["le50"])
            .when(y <= b3, lab["le100"])
            .otherwise(lab["over"]))


def status_code_expr(status) -> Column:
    """Status -> numeric grid code; unmapped labels give NULL."""
    st = col(status)
    e = None
    for label, code in P.STATUS_CODES.items():
        e = (F.when(st == label, F.lit(code)) if e is None
             else e.when(st == label, F.lit(code)))
    return e.cast("int")


def parse_period(c) -> Column:
    """'YR2008' or '2008' -> 2008; anything else -> NULL (quarantined by
    the caller).  ``try_cast`` keeps ANSI mode from raising."""
    s = F.trim(col(c))
    digits = F.when(s.startswith("YR"), F.substring(s, 3, 100)).otherwise(s)
    return digits.try_cast("int")


def nan_to_null(c) -> Column:
    v = col(c)
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def strip_prefix(c, prefix: str) -> Column:
    """Remove a literal code prefix ('IDX_RL.SC' -> 'RL.SC')."""
    import re
    return F.regexp_replace(col(c), "^" + re.escape(prefix), "")


def joined(sep: str, *cols) -> Column:
    """Join values with a separator, skipping NULLs."""
    return F.concat_ws(sep, *[col(c) for c in cols])
