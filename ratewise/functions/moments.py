"""Sample moments from power sums, as Spark column expressions.

A rating list is summarised by its count ``n`` and power sums
``s1 = sum(v)``, ``s2 = sum(v^2)``, ``s3``, ``s4``.  Power sums are plain
partial aggregates (map-side combinable, mergeable, and subtractable for
leave-one-out), so no list is ever collected.  From them:

* mean  = s1 / n
* std   = sqrt(M2 / (n-1))                                   NULL for n < 2
* skew  = n*sqrt(n-1)/(n-2) * M3 / M2^1.5                    NULL for n < 3
* kurt  = n(n+1)(n-1) M4 / ((n-2)(n-3) M2^2) - 3(n-1)^2/((n-2)(n-3))
                                                             NULL for n < 4
with central sums M2, M3, M4; skew and kurt are 0 when the variance is 0.
These are the bias-corrected sample statistics (pandas ``std/skew/kurt``),
not Spark's population ``skewness``/``kurtosis``.

The zero-variance test uses ``n*s2 - s1^2`` without an epsilon.  For values in
whole or half units (ratings) that is exact at any size: double precision
holds it while ``n*s2`` stays under 2^53 (about 19 M ratings of one key on a 1-5
scale), beyond that ``scatter`` takes integers of 38 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATS = ("avg", "std", "kurt", "skew", "max", "min")


EXACT = float(1 << 53)


def scatter(n: Column, s1: Column, s2: Column) -> Column:
    """``n * s2 - s1^2``, n squared times the variance, of ``n`` values (a double
    or NULL) with sums ``s1`` and ``s2`` of themselves and their squares.  Sums of
    half units whose product double precision cannot hold are multiplied as
    integers, so the result is rounded once, and is 0 for equal values."""
    twice, four = s1 * 2, s2 * 4
    halves = (twice == F.floor(twice)) & (four == F.floor(four)) & (four < F.lit(EXACT))

    def whole(c):
        return c.try_cast("decimal(17,0)")

    exact = (whole(n) * whole(four) - whole(twice) * whole(twice)).cast("double") / 4
    return F.when((n * s2 >= F.lit(EXACT)) & halves, exact).otherwise(n * s2 - s1 * s1)


def power_sum_aggs(value: Column | str, prefix: str = "") -> list[Column]:
    """Aggregates ``n, s1..s4`` of ``value`` (NULLs ignored)."""
    v = F.col(value) if isinstance(value, str) else value
    v = v.cast("double")
    return [
        F.count(v).cast("long").alias(f"{prefix}n"),
        F.sum(v).alias(f"{prefix}s1"),
        F.sum(v * v).alias(f"{prefix}s2"),
        F.sum(v * v * v).alias(f"{prefix}s3"),
        F.sum(v * v * v * v).alias(f"{prefix}s4"),
    ]


def _central(n: Column, s1: Column, s2: Column, s3: Column, s4: Column):
    # NULL instead of 0 so that no division can raise under ANSI mode, even
    # if the optimizer hoists a guarded sub-expression out of its CASE.
    n = F.when(n > 0, n.cast("double"))
    nm2 = scatter(n, s1, s2)  # n * M2
    m2 = nm2 / n
    m3 = s3 - F.lit(3.0) * s1 * s2 / n + F.lit(2.0) * s1 * s1 * s1 / (n * n)
    m4 = (s4 - F.lit(4.0) * s1 * s3 / n + F.lit(6.0) * s1 * s1 * s2 / (n * n)
          - F.lit(3.0) * s1 * s1 * s1 * s1 / (n * n * n))
    return n, nm2, m2, m3, m4


def moments(n: Column, s1: Column, s2: Column, s3: Column, s4: Column) -> dict[str, Column]:
    """``{"avg", "std", "skew", "kurt"}`` from count and power sums (unaliased).

    Rows with ``n = 0`` give NULL everywhere (callers substitute fallbacks).
    """
    nd, nm2, m2, m3, m4 = _central(n, s1, s2, s3, s4)
    return _finish(nd, s1, nm2, m2, m3, m4)


def _finish(nd: Column, s1: Column, nm2: Column, m2: Column, m3: Column, m4: Column) -> dict[str, Column]:
    zero_var = nm2 <= F.lit(0.0)
    safe_m2 = F.when(zero_var, F.lit(1.0)).otherwise(m2)
    mean = s1 / nd
    std = F.when(nd >= 2, F.sqrt(F.greatest(m2, F.lit(0.0)) / F.when(nd >= 2, nd - 1)))
    skew_val = (nd * F.sqrt(nd - 1) / F.when(nd >= 3, nd - 2)) * (m3 / (safe_m2 * F.sqrt(safe_m2)))
    skew = F.when(nd < 3, F.lit(None).cast("double")).when(zero_var, F.lit(0.0)).otherwise(skew_val)
    den = F.when(nd >= 4, (nd - 2) * (nd - 3))
    kurt_val = (nd * (nd + 1) * (nd - 1) * m4 / (den * safe_m2 * safe_m2)
                - F.lit(3.0) * (nd - 1) * (nd - 1) / den)
    kurt = F.when(nd < 4, F.lit(None).cast("double")).when(zero_var, F.lit(0.0)).otherwise(kurt_val)
    return {"avg": mean.cast("double"), "std": std.cast("double"),
            "skew": skew.cast("double"), "kurt": kurt.cast("double")}


def central_columns(n: Column, s1: Column, s2: Column, s3: Column, s4: Column,
                    tag: str) -> list[Column]:
    """Step 1 of the staged form: ``<tag>_nd, _s1, _nm2, _m2, _m3, _m4``
    as plain columns, so the statistics of step 2 reference them instead of
    re-expanding the sums (keeps each projection small enough for
    whole-stage code generation)."""
    nd, nm2, m2, m3, m4 = _central(n, s1, s2, s3, s4)
    return [nd.alias(f"{tag}_nd"), s1.alias(f"{tag}_s1"), nm2.alias(f"{tag}_nm2"),
            m2.alias(f"{tag}_m2"), m3.alias(f"{tag}_m3"), m4.alias(f"{tag}_m4")]


def stats_from_central(tag: str) -> dict[str, Column]:
    """Step 2: ``avg/std/skew/kurt`` from the columns of ``central_columns``."""
    c = lambda name: F.col(f"{tag}_{name}")
    return _finish(c("nd"), c("s1"), c("nm2"), c("m2"), c("m3"), c("m4"))


def moment_columns(n: Column, s1: Column, s2: Column, s3: Column, s4: Column,
                   names: dict[str, str]) -> list[Column]:
    """The moments of ``moments`` aliased by ``names`` (``avg -> usr_avg`` ...)."""
    m = moments(n, s1, s2, s3, s4)
    return [m[k].alias(v) for k, v in names.items() if k in m]


def prefixed(prefix: str) -> dict[str, str]:
    return {k: f"{prefix}_{k}" for k in ("avg", "std", "kurt", "skew")}
