"""Gold: the whole reconciliation fact for a set of business dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RECON, ReconConfig
from .matching import Match
from .overlays import finish_fact


def matcher(partner: DataFrame, platform: DataFrame, cfg: ReconConfig = DEFAULT_RECON,
            dates=None, slim: bool = False) -> Match:
    if cfg.pairing == "one_to_one":
        from .pairing import OneToOneMatch
        return OneToOneMatch(partner, platform, cfg, dates, slim=slim)
    return Match(partner, platform, cfg, dates, slim=slim)


def fact_breaks(partner: DataFrame, platform: DataFrame, churn: DataFrame | None = None,
                cfg: ReconConfig = DEFAULT_RECON, dates=None, run_ts=None) -> DataFrame:
    """One row per matched pair, unmatched partner row, or unmatched platform row."""
    m = matcher(partner, platform, cfg, dates, slim=True)
    return m.release_with(finish_fact(m.classified, churn, cfg, run_ts))


def status_summary(fact: DataFrame) -> DataFrame:
    """Row count per status, largest first (ties by status)."""
    return (fact.groupBy("recon_status").agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), F.asc("recon_status")))
