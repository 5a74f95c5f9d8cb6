"""Small typed frames for hand-made edge cases."""

import datetime as dt
from decimal import Decimal

PARTNER_DDL = ("operator_code string, partner_txn_id string, msisdn_or_account string, txn_type string, "
               "plan_code string, amount decimal(12,2), currency string, txn_ts_utc timestamp, "
               "txn_ts_local timestamp, business_date date, file_arrival_date date")
PLATFORM_DDL = ("operator_code string, platform_event_id string, event_type string, sub_id string, "
                "user_id string, partner_txn_id string, plan_id string, amount decimal(12,2), "
                "event_ts_utc timestamp, business_date date")
CHURN_DDL = "user_id string, operator_code string, churn_ts timestamp, churn_reason string, last_known_sub_id string"

D0 = dt.date(2024, 1, 15)


def dec(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def p_row(pid, amount, op="telco_a", ty="subscription_success", bd=D0, arrival=None, acct="acct-1"):
    ts = dt.datetime.combine(bd, dt.time(12, 0))
    return (op, pid, acct, ty, "P_STD", dec(amount), "PKR", ts, ts, bd, arrival or bd)


def i_row(eid, amount, key=None, op="telco_a", ty="subscription_success", bd=D0, user="u-1"):
    ts = dt.datetime.combine(bd, dt.time(12, 0))
    return (op, eid, ty, "sub-" + eid, user, key, None, dec(amount), ts, bd)


def frames(spark, partner_rows, platform_rows, churn_rows=()):
    return (spark.createDataFrame(partner_rows, PARTNER_DDL),
            spark.createDataFrame(platform_rows, PLATFORM_DDL),
            spark.createDataFrame(list(churn_rows), CHURN_DDL))
