"""The day pipeline as one set-based job chain: landing -> bronze -> silver
-> gold -> marts, for any set of arrival dates.

Each layer is written with the partition sinks, which also cuts the plan
lineage between layers (every layer reads the previous one from storage).
A run derives every business date whose result the arrivals can change and
restates exactly those dates in silver, gold and the marts: dates of the
rows that arrived, dates that a re-delivered file no longer holds, dates that
held an older version of a changed event, and dates with events of users whose
churn became known. So arrivals taken one by one, in any order, or all at once
give the same tables.

Gold and marts are built beside the published tables, checked, and published
only if no check of severity ``error`` is violated. Dates are noted as pending
before anything that they depend on changes, and cleared when they are
published: a run that is stopped by a check, or dies, leaves them to the next one.
"""

from __future__ import annotations

import datetime as _dt
import re
import threading
import time
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import CDC_TABLES, DEFAULT_RECON, FEEDS, OPERATORS, RECON_STATUSES, ReconConfig
from ..operators import gate as G
from ..operators import marts as M
from ..operators import normalize as N
from ..operators import platform as PL
from ..operators.matching import filter_dates
from ..operators.overlays import finish_fact
from ..operators.reconcile import matcher
from ..session import configure, scratch_path, together
from ..sinks.directory import DirectoryStale, KeyDirectory, key_hash
from ..sinks.partitions import (NULL_PARTITION, export_snapshot, full_overwrite, in_partitions, merge_upsert, observed,
                                read_table, register_external_table, replace_partitions)
from ..sources.landing import landing_paths
from ..sources.tables import delete_path, list_dirs, list_names, read_optional_table, table_exists, write_text


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def bronze_feeds(self):
        return self.path("bronze", "operator_feeds")

    def bronze_cdc(self, table: str):
        return self.path("bronze", table)

    @property
    def arrival_index(self):
        """(operator_code, file_arrival_date) -> business dates held."""
        return self.path("bronze", "operator_feeds_arrival_index")

    @property
    def quarantine_partner(self):
        """Partner rows that did not parse, by arrival date."""
        return self.path("silver", "quarantine_partner")

    def quarantine_cdc(self, table: str):
        """Change rows that did not parse, by operator and event date."""
        return self.path("silver", f"quarantine_{table}")

    @property
    def silver_partner(self):
        return self.path("silver", "partner_events")

    @property
    def silver_platform(self):
        return self.path("silver", "platform_events")

    @property
    def fact(self):
        return self.path("gold", "fact_reconciliation_break")

    @property
    def daily(self):
        return self.path("marts", "reconciliation_daily")

    @property
    def monthly(self):
        return self.path("marts", "revenue_monthly_close")

    @property
    def close_days(self):
        """Per-day sums of the monthly close."""
        return self.path("marts", "revenue_close_by_day")

    @property
    def transaction_directory(self):
        """Current (arrival, business date) of each partner transaction."""
        return self.path("silver", "partner_transaction_directory")

    @property
    def pending(self):
        """Business dates whose published results may be out of date."""
        return self.path("gold", "pending_dates")

    @property
    def check_results(self):
        """Outcome of every check of every run."""
        return self.path("marts", "check_results")

    def tables(self) -> dict[tuple[str, str], str]:
        """(layer, table) -> path of the tables that users read."""
        named = {("bronze", "operator_feeds"): self.bronze_feeds}
        named |= {("bronze", t): self.bronze_cdc(t) for t in CDC_TABLES}
        return named | {("silver", "partner_events"): self.silver_partner, ("silver", "platform_events"): self.silver_platform,
                        ("gold", "fact_reconciliation_break"): self.fact, ("marts", "reconciliation_daily"): self.daily,
                        ("marts", "revenue_monthly_close"): self.monthly}


_TOKEN = re.compile(r"^(\d{4})-?(\d{2})-?(\d{2})")


def _batch_dates(names, prefix: str) -> set:
    out = set()
    for n in names:
        n = n.rsplit("/", 1)[-1]
        i = n.find(prefix + "_")
        if i < 0:
            continue
        m = _TOKEN.search(n[i + len(prefix) + 1:])
        if m:
            out.add(_dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3))))
    return out


def landed_arrival_dates(spark: SparkSession, landing: dict) -> list:
    """Every arrival date present in the landing zone (from folder names)."""
    dates = set()
    for op in FEEDS:
        dates |= _batch_dates(list_names(spark, f"{landing['operator_feeds']}/{op}"), op)
    for t, spec in CDC_TABLES.items():
        for folder in ([f"{t}_{op}" for op in OPERATORS] if spec.per_operator else [t]):
            dates |= _batch_dates(list_names(spark, f"{landing['internal']}/{folder}"), folder)
    return sorted(dates)


# ---------------------------------------------------------------------------
# Dates owed to the published tables
# ---------------------------------------------------------------------------

_NOTING = threading.Lock()      # steps of a run that go side by side note dates one after the other


def note_pending(spark: SparkSession, lake: Lake, dates) -> None:
    """Remember dates before something they depend on changes: an empty file named after each."""
    with _NOTING:
        for d in sorted({d for d in dates if d is not None} - pending_dates(spark, lake)):
            write_text(spark, f"{lake.pending}/{d.isoformat()}")


def pending_dates(spark: SparkSession, lake: Lake) -> set:
    """Dates noted since the last publication."""
    return {_dt.date.fromisoformat(n) for n in list_names(spark, lake.pending) if not n.startswith((".", "_"))}


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------

INDEX_SCHEMA = ("operator_code string, file_arrival_date date, business_date date, ingest_seq bigint, "
                "complete boolean")


def read_arrival_index(spark: SparkSession, lake: Lake) -> DataFrame:
    """The latest index entry set per (operator, arrival date): the log is
    append-only, a re-ingested arrival partition supersedes older entries. An
    entry that is not ``complete`` was left by a run that ended between bronze
    and index: what its partition holds is unknown."""
    log = read_table(spark, lake.arrival_index, INDEX_SCHEMA)
    latest = log.groupBy("operator_code", "file_arrival_date").agg(F.max("ingest_seq").alias("ingest_seq"))
    return log.join(latest, ["operator_code", "file_arrival_date", "ingest_seq"], "left_semi")


def _append_index(spark: SparkSession, lake: Lake, entries: list[tuple]) -> None:
    spark.createDataFrame(entries, INDEX_SCHEMA).coalesce(1).write.mode("append").parquet(lake.arrival_index)


def bronze_partitions(spark: SparkSession, lake: Lake) -> set[tuple]:
    """(operator, arrival date) partitions of bronze, from the folder names."""
    out = set()
    for op in list_dirs(spark, lake.bronze_feeds):
        if op.startswith("operator_code="):
            for d in list_dirs(spark, f"{lake.bronze_feeds}/{op}"):
                value = d.split("=", 1)[1]
                out.add((op.split("=", 1)[1], None if value == NULL_PARTITION else _dt.date.fromisoformat(value)))
    return out


def ingest_operator_feeds(spark: SparkSession, feeds_root: str, lake: Lake, arrival_dates,
                          ingested_at=None, cfg: ReconConfig = DEFAULT_RECON) -> dict:
    """Replace the (operator, arrival date) partitions that received files.

    The business dates each arrival partition holds are observed inside the
    same write job (no second pass over the data) and kept in a small index
    table, so a later restatement of a date reads only the arrival
    partitions that contain it. When versions are ranked across dates, the
    transaction directory follows the same partitions, and the dates that a
    moved correction leaves behind count as touched.
    """
    declared = []
    for op, feed in FEEDS.items():
        for d in _batch_dates(landing_paths(spark, f"{feeds_root}/{op}", op, arrival_dates, feed.file_glob), op):
            declared.append((op, d))
    if not declared:
        return {"rows": 0, "business_dates": []}
    bronze = N.bronze_operator_feeds(spark, feeds_root, dates=arrival_dates, ingested_at=ingested_at)
    obs = Observation("arrival_index")
    tagged = (bronze.withColumn("_bd", N.business_date_of_raw(bronze.columns))
              .observe(obs, F.collect_set(F.struct("operator_code", "file_arrival_date", "_bd")).alias("idx"))
              .drop("_bd"))
    superseded = []
    if table_exists(spark, lake.arrival_index):
        held = read_arrival_index(spark, lake).where(in_partitions(["operator_code", "file_arrival_date"], declared))
        superseded = [r[0] for r in held.select("business_date").distinct().collect()]
    note_pending(spark, lake, superseded)
    moves = _track_versions(spark, lake, declared) if cfg.rank_before_date_filter else None
    if moves is None:
        delete_path(spark, lake.transaction_directory)     # it would miss this arrival
    # the index says "unknown" until bronze is in place and its content known
    seq = time.time_ns()
    _append_index(spark, lake, [(op, d, None, seq, False) for op, d in declared])
    log = replace_partitions(tagged, lake.bronze_feeds, ["operator_code", "file_arrival_date"], declared)
    found = {tuple(r) for r in (observed(obs).get("idx") or []) if r[2] is not None}
    # declared partitions that ended up empty still get an entry (no dates)
    found |= {(op, d, None) for op, d in declared if (op, d) not in {r[:2] for r in found}}
    _append_index(spark, lake, [(*r, seq + 1, True) for r in found])
    # a re-delivered partition may have lost rows: the dates it held count too
    log["business_dates"] = sorted({r[2] for r in found if r[2] is not None} | {d for d in superseded if d is not None}
                                   | (moves() if moves else set()))
    note_pending(spark, lake, log["business_dates"])
    log["arrivals"] = declared
    return log


# ---------------------------------------------------------------------------
# Which version of a partner transaction is current
# ---------------------------------------------------------------------------

TRANSACTION_KEYS = ("operator_code", "partner_txn_id")
_PLACE = ["file_arrival_date", "business_date"]


def transaction_directory(spark: SparkSession, lake: Lake) -> KeyDirectory:
    return KeyDirectory(spark, lake.transaction_directory, "file_arrival_date date, business_date date")


def _versions(spark: SparkSession, lake: Lake, arrivals=None) -> DataFrame:
    """Key hashes and place of every well-formed version in bronze (of some arrival partitions)."""
    bronze = read_table(spark, lake.bronze_feeds)
    if arrivals is not None:
        bronze = bronze.where(in_partitions(["operator_code", "file_arrival_date"], arrivals))
    good = N.normalize_partner(bronze).where(F.col("_quarantine_reason").isNull() & F.col("partner_txn_id").isNotNull())
    return good.select(*key_hash(TRANSACTION_KEYS), *_PLACE)


def _current(versions: DataFrame) -> DataFrame:
    """The latest arrival of each key (one version per key and arrival, NULL arrivals first)."""
    best = F.max(F.struct(F.col("file_arrival_date").isNotNull().alias("dated"), *_PLACE)).alias("v")
    return versions.groupBy("k1", "k2", "bucket").agg(best).select("k1", "k2", "bucket", *[f"v.{c}" for c in _PLACE])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _track_versions(spark: SparkSession, lake: Lake, arrivals: list):
    """Call before bronze changes. Returns a function to call after it: it brings the
    directory up to date and returns the business dates at which transactions were or are current.

    Keys of the arrivals, now or before, are looked up; all others keep their place. Bronze is read
    beyond the arrivals only for transactions whose current version was withdrawn, and in whole
    when there is no directory that can be trusted.
    """
    directory = transaction_directory(spark, lake)
    nothing = spark.createDataFrame([], f"k1 bigint, k2 bigint, bucket int, {', '.join(c + ' date' for c in _PLACE)}")
    known = table_exists(spark, lake.bronze_feeds)
    before = _stored(_versions(spark, lake, arrivals), "versions-before") if known else nothing
    run = directory.open() if directory.usable() else None

    def after() -> set:
        now = _stored(_versions(spark, lake, arrivals), "versions-now")
        keys = before.select("k1", "k2", "bucket").union(now.select("k1", "k2", "bucket")).distinct()
        try:
            if run is None:
                raise DirectoryStale("no directory before this arrival")
            was = directory.lookup(keys, run)
        except DirectoryStale:
            held = silver_partner(spark, lake).select(*key_hash(TRANSACTION_KEYS), "business_date")
            left = {r[0] for r in held.join(keys, ["k1", "k2"], "left_semi").select("business_date").distinct().collect()}
            directory.rebuild(_current(_versions(spark, lake)))
            return left | _dates(directory.lookup(keys))
        old = was.select("k1", "k2", F.col("file_arrival_date").alias("a0"), F.col("business_date").alias("d0"), F.lit(True).alias("had"))
        at = lambda versions: versions.select("k1", "k2", F.col("file_arrival_date").alias("a0"))
        replaced = _stored(old.join(at(before), ["k1", "k2", "a0"], "left_semi").select("k1", "k2", "a0"), "versions-replaced")
        withdrawn = replaced.join(at(now), ["k1", "k2", "a0"], "left_anti")
        elsewhere = nothing
        if not withdrawn.isEmpty():
            elsewhere = _versions(spark, lake).join(withdrawn, ["k1", "k2"], "left_semi")
        stay = was.join(replaced, ["k1", "k2"], "left_anti").join(keys, ["k1", "k2"]).select(*nothing.columns)
        new = _current(now.unionByName(stay).unionByName(elsewhere))
        both = keys.join(new.drop("bucket"), ["k1", "k2"], "left").join(old, ["k1", "k2"], "left")
        same = F.col("file_arrival_date").eqNullSafe(F.col("a0")) & F.col("business_date").eqNullSafe(F.col("d0"))
        moved = _stored(both.where(~same | F.col("had").isNull()), "versions-moved")
        dates = {d for r in moved.select("business_date", "d0").distinct().collect() for d in r}
        directory.close(run, moved.select("k1", "k2", "bucket", *_PLACE))
        return {d for d in dates if d is not None}

    return after


def _dates(places: DataFrame) -> set:
    return {r[0] for r in places.select("business_date").distinct().collect() if r[0] is not None}


def only_current(spark: SparkSession, lake: Lake, partner: DataFrame) -> DataFrame:
    """Partner rows that are the current version of their transaction; rows without an id have no versions."""
    keyed = partner.select("*", *key_hash(TRANSACTION_KEYS))
    ids = keyed.where(F.col("partner_txn_id").isNotNull())
    directory = transaction_directory(spark, lake)
    try:
        places = directory.lookup(ids.select("k1", "k2", "bucket"))
    except DirectoryStale:
        directory.rebuild(_current(_versions(spark, lake)))
        places = directory.lookup(ids.select("k1", "k2", "bucket"))
    places = places.select("k1", "k2", *[F.col(c).alias(f"_cur_{c}") for c in _PLACE])
    at = F.col("file_arrival_date").eqNullSafe(F.col("_cur_file_arrival_date")) & F.col("business_date").eqNullSafe(F.col("_cur_business_date"))
    current = ids.join(places, ["k1", "k2"]).where(at).select(*partner.columns)
    return current.unionByName(partner.where(F.col("partner_txn_id").isNull()))


CDC_PARTITIONS = ["operator_code", "event_date"]


def ingest_cdc(spark: SparkSession, internal_root: str, lake: Lake, arrival_dates, ingested_at=None) -> dict:
    """Upsert each change table on its key. Images are partitioned by
    operator and event date (the UTC date of the event time, i.e. the
    business date of the event), so a merge rewrites only the days its
    changes touch and a restatement reads only the days it needs. Older
    versions are found through the image's key directory."""
    def merge(t: str, spec) -> dict:
        folders = [f"{t}_{op}" for op in OPERATORS] if spec.per_operator else [t]
        if not any(landing_paths(spark, f"{internal_root}/{f}", f, arrival_dates) for f in folders):
            return {"rows": 0, "partitions": []}            # nothing landed: the image stays as it is
        changes = PL.read_cdc(spark, internal_root, t, dates=arrival_dates, ingested_at=ingested_at)
        changes = changes.withColumn("event_date", F.to_date(F.try_to_timestamp(F.col(spec.event_ts))))
        day = CDC_PARTITIONS.index("event_date")
        noted = (lambda parts: note_pending(spark, lake, [p[day] for p in parts])) if t in EVENT_TABLES else None
        return merge_upsert(changes, lake.bronze_cdc(t), spec.keys, CDC_PARTITIONS,
                            ["file_arrival_date", spec.event_ts], use_directory=True, before_replace=noted)

    return dict(zip(CDC_TABLES, together(spark, [partial(merge, t, spec) for t, spec in CDC_TABLES.items()])))


def cdc_image_schema(table: str):
    """Contract of a stored change-table image."""
    fields = PL.CDC_SCHEMAS[table].fields + PL.schema_of(
        "file_arrival_date date, _ingested_at timestamp, event_date date").fields
    return type(PL.CDC_SCHEMAS[table])(fields)


def cdc_image(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The image of a change table; typed and empty when none has arrived."""
    return read_optional_table(spark, lake.bronze_cdc(table), cdc_image_schema(table))


EVENT_TABLES = ("sub_initial", "sub_recursion_success", "sub_recursion_failure")


def touched_business_dates(spark: SparkSession, landing: dict, arrival_dates, bronze_log: dict, cdc_log: dict,
                           lake: Lake) -> list:
    """Business dates whose results the arrivals can change; restated in full.

    * partner: dates held by the arrived partitions, now or before (the log);
    * platform: event dates of the rewritten image partitions, which are those
      of new versions and of the older versions they replace;
    * churn: dates on which a user whose churn arrived has platform events.

    One row per date, so collecting it is bounded."""
    dates = set(bronze_log.get("business_dates", []))
    for t in EVENT_TABLES:
        dates |= {p[CDC_PARTITIONS.index("event_date")] for p in cdc_log[t].get("partitions", [])}
    churned = PL.read_cdc(spark, landing["internal"], "user_churn_events", dates=arrival_dates)
    users = churned.select("user_id", "operator_code").distinct()
    events = [cdc_image(spark, lake, t).select("user_id", "operator_code", "event_date") for t in EVENT_TABLES]
    hit = reduce(DataFrame.unionByName, events).join(users, ["user_id", "operator_code"], "left_semi")
    dates |= {r[0] for r in hit.select("event_date").distinct().collect()}
    return sorted(d for d in dates if d is not None)


# ---------------------------------------------------------------------------
# Silver, gold, marts for a set of business dates
# ---------------------------------------------------------------------------

def partner_contract(spark: SparkSession):
    """Schema of the silver partner stream (from the operator itself)."""
    raw = sorted({c for f in FEEDS.values() for c in f.raw_columns} - {"operator_code", "file_arrival_date"})
    empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in raw) + ", operator_code string, file_arrival_date date")
    return N.silver_partner_events(empty).schema


def platform_contract(spark: SparkSession):
    """Schema of the silver platform stream."""
    return PL.silver_platform_events(*[spark.createDataFrame([], cdc_image_schema(t)) for t in EVENT_TABLES]).schema


def build_silver_partner(spark: SparkSession, lake: Lake, dates, cfg: ReconConfig = DEFAULT_RECON, metrics=()) -> dict:
    """Restate silver partner dates from the bronze partitions that hold rows
    of them, by the arrival index; partitions the index knows nothing certain
    about are read too. Ranking across dates then keeps the rows that the
    transaction directory calls current, so it reads no more of bronze."""
    if not table_exists(spark, lake.bronze_feeds):
        return {"rows": 0, "partitions_written": 0, "partitions_cleared": 0}
    bronze = read_table(spark, lake.bronze_feeds)
    if table_exists(spark, lake.arrival_index):
        index = read_arrival_index(spark, lake)
        sure = {tuple(r) for r in index.where("complete").select("operator_code", "file_arrival_date").distinct().collect()}
        hold = {tuple(r) for r in filter_dates(index.where("complete"), dates)
                .select("operator_code", "file_arrival_date").distinct().collect()}
        parts = sorted(hold | (bronze_partitions(spark, lake) - sure), key=str)
        bronze = bronze.where(in_partitions(["operator_code", "file_arrival_date"], parts))
    silver = N.silver_partner_events(bronze, dates=dates)
    if cfg.rank_before_date_filter:
        silver = only_current(spark, lake, silver)
    return replace_partitions(silver, lake.silver_partner, ["business_date"], [(d,) for d in dates], metrics)


def build_quarantine(spark: SparkSession, lake: Lake, arrivals, cdc_log: dict) -> dict:
    """Rows of the arrivals that no silver table can hold, with the reason and
    the raw text: partner rows by arrival partition, change rows by image
    partition (rows without a readable event time lie in the NULL date)."""
    def partner() -> dict:
        keys = ["operator_code", "file_arrival_date"]
        bronze = read_table(spark, lake.bronze_feeds).where(in_partitions(keys, arrivals))
        return replace_partitions(N.quarantined(N.normalize_partner(bronze)), lake.quarantine_partner, keys, arrivals)

    def changes(t: str, spec, parts: list) -> dict:
        image = cdc_image(spark, lake, t).where(in_partitions(CDC_PARTITIONS, parts))
        return replace_partitions(PL.quarantined_changes(image, spec), lake.quarantine_cdc(t), CDC_PARTITIONS, parts)

    steps = {"partner": partner} if arrivals else {}
    steps |= {t: partial(changes, t, spec, cdc_log[t]["partitions"]) for t, spec in CDC_TABLES.items() if cdc_log[t].get("partitions")}
    return dict(zip(steps, together(spark, list(steps.values()))))


def _images(spark: SparkSession, lake: Lake, dates=None):
    """Change-table images, pruned to the event dates when given."""
    return tuple(filter_dates(cdc_image(spark, lake, t), dates, "event_date") for t in EVENT_TABLES)


def build_silver_platform(spark: SparkSession, lake: Lake, dates) -> dict:
    si, rs, rf = _images(spark, lake, dates)
    ev = PL.silver_platform_events(si, rs, rf, dates=dates)
    return replace_partitions(ev, lake.silver_platform, ["business_date"], [(d,) for d in dates])


def silver_partner(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_optional_table(spark, lake.silver_partner, partner_contract(spark))


def silver_platform(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_optional_table(spark, lake.silver_platform, platform_contract(spark))


def _staged(df: DataFrame, name: str, metrics=()) -> tuple[DataFrame, dict]:
    """Write a table beside the published ones; returns it and the metrics of that write job."""
    path = scratch_path(df.sparkSession, name)
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed(obs)


def gold_fact(spark: SparkSession, lake: Lake, dates, cfg: ReconConfig = DEFAULT_RECON, run_ts=None, metrics=()) -> tuple[DataFrame, dict]:
    """The fact of the dates, built but not published, and the metrics of its write."""
    churn = PL.churn_events(cdc_image(spark, lake, "user_churn_events"))
    m = matcher(silver_partner(spark, lake), silver_platform(spark, lake), cfg, dates, slim=True)
    try:
        return _staged(finish_fact(m.classified, churn, cfg, run_ts), "gold", metrics)
    finally:
        m.release()  # the cached tier-1 table is only needed while the fact is written


def daily_mart_for(spark: SparkSession, lake: Lake, dates, fact: DataFrame, built_at=None) -> DataFrame:
    """The daily mart restricted to the touched dates (incremental build)."""
    p = M.stg_partner_events(filter_dates(silver_partner(spark, lake), dates))
    i = M.stg_platform_events(filter_dates(silver_platform(spark, lake), dates))
    return M.mart_daily(p, i, M.stg_reconciliation_break(fact), built_at=built_at)


def published_except(spark: SparkSession, path: str, dates, schema) -> DataFrame | None:
    """Rows of a published date-partitioned table on other dates; None when there is none."""
    if not table_exists(spark, path):
        return None
    return read_table(spark, path, schema).where(~F.col("business_date").isin([F.lit(d).cast("date") for d in dates]))


def close_days_after(spark: SparkSession, lake: Lake, dates, days: DataFrame, fact_schema) -> DataFrame:
    """Per-day sums of the close as they will be once ``days`` replaces its dates.

    The fact of other dates is read only when there are no sums yet although there is a fact."""
    others = published_except(spark, lake.close_days, dates, days.schema)
    if others is None and table_exists(spark, lake.fact):
        others = M.close_by_day(M.stg_reconciliation_break(published_except(spark, lake.fact, dates, fact_schema)))
    return days if others is None else others.select(*days.columns).unionByName(days)


def run_checks(spark: SparkSession, lake: Lake, dates, fact: DataFrame, daily: DataFrame, monthly: DataFrame,
               counted: dict[tuple[str, str], int], constraints: list) -> list[dict]:
    """Outcome of every constraint over the tables about to be published.

    Row predicates of the fact and of silver were counted while these were written
    (``counted``). A key constraint of the fact also looks at published rows of other
    dates that carry a key of the new ones: one scan of the key columns. The marts are small.
    """
    keyed = [c for c in G.of_table(constraints, G.FACT) if c.unique]
    scope = fact
    others = published_except(spark, lake.fact, dates, fact.schema)
    if keyed and others is not None and not others.isEmpty():      # as when a run restates every date
        names = sorted({k for c in keyed for k in c.unique})
        new = fact.select(*[F.col(k).alias(f"_k_{k}") for k in names]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in names]
        cond = same[0]
        for s in same[1:]:
            cond = cond & s
        scope = fact.unionByName(others.select(*fact.columns).join(new, cond, "left_semi"))
    found = dict(counted)
    scans = [(G.FACT, scope, keyed), (G.DAILY, daily, G.of_table(constraints, G.DAILY)),
             (G.MONTHLY, monthly, G.of_table(constraints, G.MONTHLY))]
    scans = [s for s in scans if s[2]]
    violated = together(spark, [lambda df=df, some=some: G.findings(df, some).collect() for _, df, some in scans])
    for (table, _, _), rows in zip(scans, violated):                   # one row per violated constraint
        found |= {(table, r["constraint_name"]): r["violations"] for r in rows}
    return G.decide(constraints, found)


def _keep_results(spark: SparkSession, lake: Lake, results: list[dict], run_ts, published: bool) -> None:
    rows = [(str(run_ts) if run_ts is not None else _dt.datetime.now(_dt.timezone.utc).isoformat(), *r.values(), published) for r in results]
    spark.createDataFrame(rows, f"run_ts string, {G.RESULT_SCHEMA}, published boolean").coalesce(1).write.mode("append").parquet(lake.check_results)


def build_and_publish(spark: SparkSession, lake: Lake, dates, cfg: ReconConfig = DEFAULT_RECON, run_ts=None,
                      counted: dict | None = None, constraints: list | None = None, stop: bool = True) -> dict:
    """Build gold and marts of the dates, check them, and replace the published partitions.

    With ``stop``, a violated ``error`` constraint raises ``QualityGateError`` and every published
    table stays as it was; otherwise the results are only reported.
    """
    constraints = G.default_constraints(cfg) if constraints is None else constraints
    parts = [(d,) for d in dates]
    row_checks = G.row_metrics(G.of_table(constraints, G.FACT))
    summary = [F.count_if(F.col("recon_status") == s).alias(f"status_{s}") for s in RECON_STATUSES]
    fact, seen = gold_fact(spark, lake, dates, cfg, run_ts, [*row_checks, *summary])
    (daily, _), (days, _) = together(spark, [
        lambda: _staged(daily_mart_for(spark, lake, dates, fact, run_ts), "daily"),
        lambda: _staged(M.close_by_day(M.stg_reconciliation_break(fact)), "close-days")])
    after = close_days_after(spark, lake, dates, days, fact.schema)
    if not table_exists(spark, lake.close_days):
        after = _stored(after, "close-days-all")
    monthly, _ = _staged(M.close_from_days(after, run_ts), "monthly")
    counted = {**(counted or {}), **{(G.FACT, c.name): seen.get(c.name, 0) for c in G.of_table(constraints, G.FACT) if c.violation}}
    log: dict = {"checks": run_checks(spark, lake, dates, fact, daily, monthly, counted, constraints)}
    status = {s: int(seen.get(f"status_{s}") or 0) for s in RECON_STATUSES}
    log["status_summary"] = sorted(((s, n) for s, n in status.items() if n), key=lambda x: (-x[1], x[0]))
    refused = G.refused(log["checks"])
    _keep_results(spark, lake, log["checks"], run_ts, not (refused and stop))
    if refused and stop:
        raise G.QualityGateError(log["checks"])
    def close_days() -> None:
        if table_exists(spark, lake.close_days):
            replace_partitions(days, lake.close_days, ["business_date"], parts)
        else:
            full_overwrite(after, lake.close_days, ["business_date"])

    log["gold"], in_daily, *_ = together(spark, [
        lambda: replace_partitions(fact, lake.fact, ["business_date"], parts),
        lambda: replace_partitions(daily, lake.daily, ["business_date"], parts),
        close_days, lambda: full_overwrite(monthly, lake.monthly)])
    log["marts"] = {"daily": in_daily}
    return log


def register_tables(spark: SparkSession, lake: Lake, prefix: str = "", touched: dict | None = None) -> list[str]:
    """Catalog entries of all the lake's tables, in databases named ``prefix`` + layer; absent tables are skipped.

    ``touched`` maps (layer, table) to the partitions that a run changed; tables without an entry are left alone
    once registered."""
    out = []
    for (layer, table), path in lake.tables().items():
        parts = None if touched is None else touched.get((layer, table), [])
        if register_external_table(spark, prefix + layer, table, path, parts):
            out.append(f"{prefix}{layer}.{table}")
    return out


def export_tables(spark: SparkSession, lake: Lake, root: str, files: int | None = None) -> list[str]:
    """Plain Parquet copies of all the lake's tables under ``root``/layer/table; absent tables are skipped."""
    out = []
    for (layer, table), path in lake.tables().items():
        if table_exists(spark, path):
            out.append(f"{root.rstrip('/')}/{layer}/{table}")
            export_snapshot(read_table(spark, path), out[-1], files)
    return out


def restate(spark: SparkSession, landing: dict, lake: Lake, arrival_dates=None,
            cfg: ReconConfig = DEFAULT_RECON, run_ts=None, constraints: list | None = None, stop: bool = True,
            register_as: str | None = None, export_to: str | None = None) -> dict:
    """Ingest the arrival dates, then restate every business date they touch.

    Also restated: dates that an earlier run left pending. The log holds row counts, the
    results of the checks and the number of rows per status. ``register_as`` brings the catalog up
    to date (a prefix of the databases' names), ``export_to`` writes snapshots of all tables.
    """
    configure(spark)
    if arrival_dates is None:
        arrival_dates = landed_arrival_dates(spark, landing)
    constraints = G.default_constraints(cfg) if constraints is None else constraints
    log = {"arrival_dates": len(arrival_dates)}
    log["bronze_feeds"], log["bronze_cdc"] = together(spark, [
        lambda: ingest_operator_feeds(spark, landing["operator_feeds"], lake, arrival_dates, run_ts, cfg),
        lambda: ingest_cdc(spark, landing["internal"], lake, arrival_dates, run_ts)])
    touched = touched_business_dates(spark, landing, arrival_dates, log["bronze_feeds"], log["bronze_cdc"], lake)
    note_pending(spark, lake, touched)
    dates = sorted(set(touched) | pending_dates(spark, lake))
    log["business_dates"] = len(dates)
    on_silver = G.of_table(constraints, G.PARTNER)
    steps = {"quarantine": lambda: build_quarantine(spark, lake, log["bronze_feeds"].get("arrivals"), log["bronze_cdc"])}
    if dates:
        steps["silver_partner"] = lambda: build_silver_partner(spark, lake, dates, cfg, G.row_metrics(on_silver))
        steps["silver_platform"] = lambda: build_silver_platform(spark, lake, dates)
    log |= zip(steps, together(spark, list(steps.values())))
    if dates:
        counted = {(G.PARTNER, c.name): log["silver_partner"].get("metrics", {}).get(c.name, 0) for c in on_silver}
        log |= build_and_publish(spark, lake, dates, cfg, run_ts, counted, constraints, stop)
        delete_path(spark, lake.pending)
    if register_as is not None:
        by_date = [(d,) for d in dates]
        changed = {("bronze", "operator_feeds"): log["bronze_feeds"].get("arrivals", []),
                   **{("bronze", t): log["bronze_cdc"][t].get("partitions", []) for t in CDC_TABLES},
                   ("silver", "partner_events"): by_date, ("silver", "platform_events"): by_date,
                   ("gold", "fact_reconciliation_break"): by_date, ("marts", "reconciliation_daily"): by_date}
        log["registered"] = register_tables(spark, lake, register_as, changed)
    if export_to is not None:
        log["exported"] = export_tables(spark, lake, export_to)
    return log
