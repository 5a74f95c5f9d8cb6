"""Feed and matching configuration.

A feed is described by data (``FeedSpec``), never by code branches: adding an
operator is one more entry in ``FEEDS``. ``ReconConfig`` holds the matching
knobs; everything that reads them takes a config argument so runs with other
tolerances or windows are plain parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's contract for results to
# agree: canonical vocabularies, per-feed raw column names, raw type codes,
# time encodings, zones and default currencies.
# ---------------------------------------------------------------------------

CANONICAL_TXN_TYPES = (
    "subscription_success",
    "recursion_success",
    "recursion_failure",
    "refund",
    "cancel",
    "unknown",
)

# Partner-side types that move money and therefore must reconcile.
MONEY_TYPES = ("subscription_success", "recursion_success", "refund")
# Platform-side types that move money (no refund kind exists internally).
PLATFORM_MONEY_TYPES = ("subscription_success", "recursion_success")
# Types whose successful charge for a churned user is an orphan.
CHURN_SENSITIVE_TYPES = ("subscription_success", "recursion_success")

RECON_STATUSES = (
    "MATCHED",
    "AMOUNT_MISMATCH",
    "MISSING_ON_PLATFORM",
    "MISSING_AT_PARTNER",
    "ORPHAN_CHURN",
    "LATE_ARRIVAL",
)
# Statuses booked as revenue in the monthly close.
RECOGNISED_STATUSES = ("MATCHED", "LATE_ARRIVAL", "AMOUNT_MISMATCH", "MISSING_ON_PLATFORM")

MATCH_KEY_STRONG = "partner_txn_id"
MATCH_KEY_FALLBACK = "operator+user+type+amount+date"
MATCH_KEY_UNMATCHED_PARTNER = "unmatched_partner"
MATCH_KEY_UNMATCHED_PLATFORM = "unmatched_platform"

# Canonical column order of the partner columns each feed maps onto.
CANONICAL_FEED_COLUMNS = (
    "partner_txn_id",
    "msisdn_or_account",
    "txn_type",
    "plan_code",
    "amount",
    "currency",
    "txn_ts_local",
)


@dataclass(frozen=True)
class FeedSpec:
    operator_code: str
    file_format: str            # "csv" or "json"
    file_glob: str
    timezone: str
    default_currency: str
    csv_options: dict
    # raw column -> canonical column, in canonical order
    column_map: dict
    # raw type code -> canonical type (anything else -> "unknown")
    txn_type_map: dict
    # Spark datetime pattern, or "epoch_millis"
    ts_format: str

    @property
    def raw_columns(self) -> list[str]:
        return list(self.column_map.keys())

    def raw_for(self, canonical: str) -> str:
        for raw, canon in self.column_map.items():
            if canon == canonical:
                return raw
        raise KeyError(canonical)

    @property
    def ts_is_instant(self) -> bool:
        """True when the raw text names an absolute instant (epoch, offset or Z)."""
        f = self.ts_format
        return f == "epoch_millis" or f.endswith("XXX") or f.endswith("'Z'")

    @property
    def parse_pattern(self) -> str | None:
        """Pattern actually used for parsing.

        A quoted ``'Z'`` is a literal in Spark patterns, so text would be read
        in the session zone; ``XXX`` reads ``Z`` as UTC regardless of zone.
        """
        f = self.ts_format
        if f == "epoch_millis":
            return None
        if f.endswith("'Z'"):
            return f[: -len("'Z'")] + "XXX"
        return f


def _feed(op, fmt, tz, ccy, sep, names, codes, ts_format):
    return FeedSpec(
        operator_code=op,
        file_format=fmt,
        file_glob=f"{op}_*.{fmt}",
        timezone=tz,
        default_currency=ccy,
        csv_options=({"header": "true", "sep": sep} if fmt == "csv" else {}),
        column_map=dict(zip(names, CANONICAL_FEED_COLUMNS)),
        txn_type_map=dict(zip(codes, CANONICAL_TXN_TYPES[:5])),
        ts_format=ts_format,
    )


# Per-feed layout. Raw names are listed in canonical order
# (id, account, type, plan, amount, currency, time); raw type codes in the
# order subscription_success, recursion_success, recursion_failure, refund,
# cancel.
FEEDS: dict[str, FeedSpec] = {
    f.operator_code: f
    for f in (
        _feed("telco_a", "csv", "Asia/Karachi", "PKR", ",",
              ["transaction_id", "phone_number", "event_type", "plan", "value", "ccy", "created_at"],
              ["SUB", "RENEW_OK", "RENEW_FAIL", "REFUND", "CANCEL"],
              "yyyy-MM-dd HH:mm:ss"),
        _feed("telco_b", "csv", "Asia/Karachi", "PKR", ";",
              ["txn_ref", "subscriber_id", "transaction_type", "product_code", "charged_amount",
               "currency_code", "event_time"],
              ["initial", "renewal_success", "renewal_failure", "chargeback", "termination"],
              "yyyy-MM-dd'T'HH:mm:ss"),
        _feed("telco_c", "json", "Asia/Dubai", "AED", None,
              ["id", "account", "type", "tariff", "amt", "cur", "ts"],
              ["new_sub", "recur_ok", "recur_ko", "refund", "cancel"],
              "yyyy-MM-dd'T'HH:mm:ssXXX"),
        _feed("telco_d", "csv", "Asia/Karachi", "PKR", ",",
              ["trx_id", "msisdn", "kind", "bundle", "price", "currency", "epoch_ms"],
              ["S", "R", "F", "B", "C"],
              "epoch_millis"),
        _feed("wallet_x", "json", "UTC", "USD", None,
              ["payment_id", "wallet_account", "category", "plan_ref", "gross_amount",
               "iso_currency", "processed_at"],
              ["purchase", "rebill_success", "rebill_declined", "reversal", "cancellation"],
              "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        _feed("wallet_y", "csv", "Asia/Karachi", "PKR", ",",
              ["reference", "customer_ref", "movement", "package", "total", "curr", "timestamp"],
              ["signup_charge", "auto_renew_ok", "auto_renew_fail", "refund", "cancel"],
              "yyyy-MM-dd HH:mm:ss"),
    )
}

OPERATORS = tuple(FEEDS)


@dataclass(frozen=True)
class CdcTable:
    name: str
    keys: tuple
    per_operator: bool
    event_ts: str


# Internal change tables, their merge keys and event times.
CDC_TABLES = {
    "sub_initial": CdcTable("sub_initial", ("sub_id", "operator_code"), True, "created_ts"),
    "sub_recursion_success": CdcTable("sub_recursion_success", ("recursion_id", "operator_code"), True,
                                      "recurrence_ts"),
    "sub_recursion_failure": CdcTable("sub_recursion_failure", ("failure_id", "operator_code"), True,
                                      "attempt_ts"),
    "user_churn_events": CdcTable("user_churn_events", ("user_id", "operator_code", "churn_ts"), False,
                                  "churn_ts"),
}

# sub_initial statuses that represent a real charge attempt.
CHARGING_SUB_STATUSES = ("active", "pending")


@dataclass(frozen=True)
class ReconConfig:
    # Default matching knobs.
    amount_abs_tolerance: Decimal = Decimal("0.01")
    amount_rel_tolerance: Decimal = Decimal("0.005")
    late_arrival_threshold_days: int = 2
    # 0 reproduces the one-day-at-a-time output (both sides pre-filtered to
    # one date); 1 is the documented +-1 day intent.
    fallback_window_days: int = 0
    # "best_per_partner" (a platform row may serve several partners) or
    # "one_to_one" (each platform row used at most once).
    pairing: str = "best_per_partner"
    # Rank the latest arrival before restricting to business dates, so a
    # correction that moves a row to another date removes the stale copy.
    rank_before_date_filter: bool = False
    # Cache the tier-1 join that every later step reads (memory, spilling to
    # disk). Off: each consumer re-reads and re-shuffles both inputs.
    cache_tier1: bool = True

    def __post_init__(self):
        if self.pairing not in ("best_per_partner", "one_to_one"):
            raise ValueError(f"unknown pairing {self.pairing!r}")
        if self.fallback_window_days < 0:
            raise ValueError("fallback_window_days must be >= 0")
        if not (Decimal(0) <= self.amount_rel_tolerance < Decimal(1)):
            raise ValueError("amount_rel_tolerance must be in [0, 1)")
        if self.amount_abs_tolerance < 0:
            raise ValueError("amount_abs_tolerance must be >= 0")


DEFAULT_RECON = ReconConfig()
