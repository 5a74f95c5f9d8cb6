"""Money functions: amount parsing, tolerance equality, variance, ratios.

Tolerances are DECIMAL literals so the comparison is exact at the boundary
(``0.005`` as a double is not ``0.005``) and agrees with any SQL engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_RECON, ReconConfig

AMOUNT_TYPE = "decimal(12,2)"
# Smallest magnitude the relative test divides by.
REL_FLOOR = Decimal("0.01")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec_lit(v: Decimal) -> Column:
    v = Decimal(v)
    scale = max(0, -v.as_tuple().exponent)
    digits = max(len(v.as_tuple().digits), scale + 1)
    return F.lit(v).cast(f"decimal({digits},{scale})")


def cast_amount(raw) -> Column:
    """Text or number -> DECIMAL(12,2), half-up; NULL if it does not parse."""
    return _c(raw).try_cast(AMOUNT_TYPE)


def zero_amount() -> Column:
    return F.lit(0).cast(AMOUNT_TYPE)


def amounts_match(p, i, cfg: ReconConfig = DEFAULT_RECON) -> Column:
    """``|p-i| <= abs_tol  OR  |p-i| / greatest(|p|, 0.01) <= rel_tol``.

    The relative test is evaluated as ``|p-i| <= rel_tol * greatest(|p|, 0.01)``
    (the divisor is positive), which is exact in decimal arithmetic. NULL when
    either amount is NULL (three-valued, like the SQL it states).
    """
    p, i = _c(p), _c(i)
    diff = F.abs(p - i)
    rel_bound = dec_lit(cfg.amount_rel_tolerance) * F.greatest(F.abs(p), dec_lit(REL_FLOOR))
    return (diff <= dec_lit(cfg.amount_abs_tolerance)) | (diff <= rel_bound)


def amount_variance(p, i) -> Column:
    """``coalesce(p,0) - coalesce(i,0)`` as DECIMAL(12,2)."""
    return (F.coalesce(_c(p), zero_amount()) - F.coalesce(_c(i), zero_amount())).cast(AMOUNT_TYPE)


def late_flag(arrival, bdate, cfg: ReconConfig = DEFAULT_RECON) -> Column:
    """Arrived more than ``late_arrival_threshold_days`` after the business date."""
    a, b = _c(arrival), _c(bdate)
    return F.coalesce(
        a.isNotNull() & (F.datediff(a, b) > F.lit(cfg.late_arrival_threshold_days)),
        F.lit(False),
    )


def signed_amount(amount, txn_type) -> Column:
    """Refunds reduce revenue."""
    a = _c(amount)
    return F.when(_c(txn_type) == "refund", -a).otherwise(a)
