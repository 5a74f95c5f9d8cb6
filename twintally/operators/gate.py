"""Checks that decide whether a run may publish.

A ``Constraint`` is data: a table, a severity, and either a row predicate that
is true on an offending row or a key of which at most one row may exist. The
constraints of a table compile into one aggregate over one scan (``findings``);
row predicates can also be counted inside the job that writes the table
(``row_metrics``), which needs no scan at all.

``decide`` turns counts into results. A violated ``error`` stops publication, a
violated ``warn`` is reported. A predicate that is NULL on a row is not a violation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RECON, ReconConfig
from ..functions.money import amounts_match
from .quality import DAILY_NOT_NULL, MONTHLY_NOT_NULL

FACT, DAILY, MONTHLY, PARTNER = ("fact_reconciliation_break", "reconciliation_daily", "revenue_monthly_close",
                                 "partner_events")
RESULT_SCHEMA = "table_name string, constraint_name string, severity string, violations bigint, passed boolean"


@dataclass(frozen=True)
class Constraint:
    name: str
    table: str
    violation: Callable[[], Column] | None = None
    unique: tuple[str, ...] = ()
    among: Callable[[], Column] | None = None      # which rows a key constraint looks at (all when None)
    severity: str = "error"

    def __post_init__(self):
        if (self.violation is None) == (not self.unique):
            raise ValueError(f"constraint {self.name!r} needs either a row predicate or a key")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")


def not_null(table: str, columns: Iterable[str], severity: str = "error") -> list[Constraint]:
    return [Constraint(f"not_null_{c}", table, violation=lambda c=c: F.col(c).isNull(), severity=severity) for c in columns]


def default_constraints(cfg: ReconConfig = DEFAULT_RECON) -> list[Constraint]:
    """What the marts promise, the fact's invariants, and the reported (not refused) conditions.

    The balance test is an error by the matcher's own predicate; by the absolute
    tolerance alone it only warns, since rows matched by the relative rule exceed it.
    """
    matched = lambda: F.col("recon_status") == "MATCHED"
    agree = lambda: F.coalesce(amounts_match(F.col("partner_amount"), F.col("internal_amount"), cfg), F.lit(False))
    beyond = lambda: F.abs(F.col("amount_variance")) > F.lit(Decimal(cfg.amount_abs_tolerance))
    return [
        Constraint("matched_rows_agree", FACT, violation=lambda: matched() & ~agree()),
        Constraint("matched_rows_balanced", FACT, violation=lambda: matched() & beyond(), severity="warn"),
        Constraint("partner_counted_once", FACT, unique=("operator_code", "partner_txn_id"),
                   among=lambda: F.col("partner_txn_id").isNotNull() & (F.col("partner_amount") > 0)),
        *not_null(DAILY, DAILY_NOT_NULL),
        Constraint("one_row_a_day_and_operator", DAILY, unique=("business_date", "operator_code")),
        *not_null(MONTHLY, MONTHLY_NOT_NULL),
        Constraint("unknown_txn_type", PARTNER, violation=lambda: F.col("txn_type") == "unknown", severity="warn"),
    ]


def of_table(constraints: Iterable[Constraint], table: str) -> list[Constraint]:
    return [c for c in constraints if c.table == table]


def _violates(c: Constraint) -> Column:
    return F.coalesce(c.violation(), F.lit(False))


def row_metrics(constraints: Iterable[Constraint]) -> list[Column]:
    """One counter per row constraint, for ``DataFrame.observe`` on a write."""
    return [F.count_if(_violates(c)).alias(c.name) for c in constraints if c.violation is not None]


def findings(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """(constraint_name, violations) of the violated constraints, from one scan and one shuffle.

    Every row emits an entry per row predicate it offends and per key constraint it belongs to. Entries
    are counted by (constraint, key); a row entry counts in full, a key when it occurs more than once.
    """
    out = []
    for c in constraints:
        name = F.lit(c.name).alias("constraint_name")
        if c.violation is not None:
            out.append(F.when(_violates(c), F.struct(name, F.lit(None).cast("string").alias("key"))))
        else:
            key = F.struct(name, F.to_json(F.struct(*c.unique)).alias("key"))
            out.append(F.when(F.coalesce(c.among(), F.lit(False)), key) if c.among else key)
    if not out:
        return df.sparkSession.createDataFrame([], "constraint_name string, violations bigint")
    rows = df.select(F.explode(F.filter(F.array(*out), lambda e: e.isNotNull())).alias("e"))
    counted = rows.groupBy("e.constraint_name", "e.key").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("key").isNull(), F.col("n")).when(F.col("n") > 1, F.lit(1)).otherwise(F.lit(0))
    return counted.groupBy("constraint_name").agg(F.sum(hit).cast("bigint").alias("violations"))


def report(tables: dict[str, DataFrame], constraints: list[Constraint]) -> DataFrame:
    """Every constraint of the given tables with its count: one scan per table, one row per constraint."""
    spark = next(iter(tables.values())).sparkSession
    listed = [c for c in constraints if c.table in tables]
    rules = spark.createDataFrame([(c.table, c.name, c.severity) for c in listed],
                                  "table_name string, constraint_name string, severity string")
    found = None
    for name, df in tables.items():
        of = of_table(listed, name)
        if of:
            one = findings(df, of).withColumn("table_name", F.lit(name))
            found = one if found is None else found.unionByName(one)
    violations = F.coalesce("violations", F.lit(0)).cast("bigint")
    return rules.join(found, ["table_name", "constraint_name"], "left").select(
        "table_name", "constraint_name", "severity", violations.alias("violations"), (violations == 0).alias("passed"))


def decide(constraints: Iterable[Constraint], counts: dict[tuple[str, str], int]) -> list[dict]:
    """Results in the order of the constraints; ``counts`` has the violated ones at least."""
    return [{"table_name": c.table, "constraint_name": c.name, "severity": c.severity,
             "violations": int(counts.get((c.table, c.name), 0) or 0), "passed": not counts.get((c.table, c.name), 0)}
            for c in constraints]


def refused(results: Iterable[dict]) -> list[dict]:
    """The results that forbid publication."""
    return [r for r in results if r["severity"] == "error" and not r["passed"]]


class QualityGateError(RuntimeError):
    """A run was stopped before it replaced anything; ``results`` has every check's outcome."""

    def __init__(self, results: list[dict]):
        self.results = results
        broken = ", ".join(f"{r['table_name']}.{r['constraint_name']} ({r['violations']})" for r in refused(results))
        super().__init__(f"not published, violated: {broken}")
