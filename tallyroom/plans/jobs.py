"""Batch jobs between stored layers: ingest, clean, star load, activity, marts.

Each job builds lazy frames and starts work only at its sinks.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom import rules as R
from tallyroom.plans import activity, marts, star
from tallyroom.plans.clean import Cleaning
from tallyroom.schemas import STAMP, message_schema
from tallyroom.sources import (
    ContentIndex,
    Versions,
    Workspace,
    align_for_union,
    conform_schema,
    read_entity,
    read_table,
    stamp,
    stored_files,
    table_exists,
    union_aligned,
    write_entity,
    write_if_any,
    write_table,
)
from tallyroom.sources.versions import LEDGER

FACT_USER_ACTIVITY = "FACT_USER_ACTIVITY"
ACTIVITY_DAY = "ActivityDate"
#: Which loads a job has taken in, beside the ledger of all loads.
LEDGER_DONE = "LOAD_LEDGER_DONE"


@dataclass(frozen=True)
class Warehouse:
    """Where star tables live: a catalog schema, or a connector with its options.

    In the catalog, facts are partitioned by the day of their stamp and every
    overwrite is all or nothing (``sources.versions``).  Behind a connector an
    overwrite is what the connector makes of it.
    """

    spark: SparkSession
    schema: str = "default"
    fmt: str | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def _name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def versions(self, table: str) -> Versions:
        return Versions(self.spark, self._name(table))

    def exists(self, table: str) -> bool:
        return table_exists(self.spark, self._name(table), self.fmt, **self.options)

    def read(self, table: str, *columns: str) -> DataFrame:
        return read_table(self.spark, self._name(table), columns, self.fmt, **self.options).drop(star.STAMP_DAY)

    def stored(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        write_table(df, self._name(table), mode, self.fmt, **self.options)

    def by_day(self, table: str, stamped: str, days: Iterable[dt.date] | None, since: dt.date | None = None) -> DataFrame:
        """A fact's rows of some days; of a fact partitioned by day, no other is read."""
        rows = read_table(self.spark, self._name(table), (), self.fmt, **self.options)
        day = F.col(star.STAMP_DAY) if star.STAMP_DAY in rows.columns else star.stamp_day(F.col(stamped))
        if days is not None:
            rows = rows.where(day.isin(list(days)))
        if since is not None:
            rows = rows.where(day >= F.lit(since))
        return rows

    def upsert(self, df: DataFrame, table: str, row_id: str, stamped: str) -> None:
        """Rows take the place of stored ones with the same id; only their days are rewritten.

        An id holds its stamp, so it can only repeat within its day.
        """
        day, load = star.STAMP_DAY, uuid.uuid4().hex
        versions, name = self.versions(table), self._name(table)
        versions.recover()
        if not versions.exists():
            versions.replace(df.hint("rebalance", day), day, load)
        elif versions.partitioned_by(day):
            stored = self.by_day(table, stamped, _days_of(df, day))
            kept = op.anti_ingest_stored(stored, df, [day, row_id]).select(*stored.columns)
            versions.replace_days(kept.unionByName(df).hint("rebalance", day), day, load=load)
        else:  # stored before facts had days
            stored = self.spark.read.table(name)
            kept = op.anti_append(stored, df, row_id).select(*stored.columns)
            dated = kept.withColumn(day, star.stamp_day(F.col(stamped)))
            versions.replace(dated.unionByName(df).hint("rebalance", day), day, load)

    def append(self, df: DataFrame, table: str) -> None:
        """Rows are added to their days."""
        versions = self.versions(table)
        if versions.exists() and not versions.partitioned_by(star.STAMP_DAY):
            self.write(df.drop(star.STAMP_DAY), table, "append")
        else:
            versions.append_days(df.hint("rebalance", star.STAMP_DAY), star.STAMP_DAY, uuid.uuid4().hex)

    def replace_days(self, df: DataFrame, table: str, day: str, days: Iterable[dt.date] | None = None) -> None:
        """Replace ``days``, or those that the frame has rows for; a day without rows becomes empty.

        Behind a connector, and for a catalog table that is not partitioned by
        day yet, the kept days are written again beside the new ones.
        """
        df = df.hint("rebalance", day)  # few files a day, and a large day in several tasks
        if not self.exists(table):
            if self.fmt is None:
                self.versions(table).replace(df, day)
            else:
                self.write(df, table, "overwrite")
        elif self.fmt is None and self.versions(table).partitioned_by(day):
            self.versions(table).replace_days(df, day, days)
        else:
            with Workspace(self.spark, table.lower()) as space:
                fresh = space.step(df)
                gone = fresh.select(day).distinct()
                if days is not None:
                    listed = self.spark.createDataFrame([(d,) for d in days], f"{day} date")
                    gone = gone.unionByName(listed).distinct()
                kept = self.read(table).join(gone, day, "left_anti")
                whole = space.step(kept.select(*fresh.columns).unionByName(fresh))
                if self.fmt is None:
                    self.versions(table).replace(whole, day)
                else:
                    self.write(whole, table, "overwrite")

    def pending(self, consumer: str, space: Workspace) -> DataFrame | None:
        """(LoadID, LoadedDay) of the loads that a job has not taken in; None without a ledger."""
        name, done = self._name(LEDGER), self._name(LEDGER_DONE)
        if self.fmt is not None or not self.spark.catalog.tableExists(name):
            return None
        loads = self.spark.read.table(name).select("LoadID", "LoadedDay").distinct()
        if self.spark.catalog.tableExists(done):
            taken = self.spark.read.table(done).where(F.col("Consumer") == consumer)
            loads = loads.join(taken, "LoadID", "left_anti")
        return space.step(loads)

    def taken_in(self, consumer: str, loads: DataFrame) -> None:
        rows = loads.select(F.lit(consumer).alias("Consumer"), "LoadID").distinct().coalesce(1)
        write_table(rows, self._name(LEDGER_DONE), "append")


def _days_of(df: DataFrame, day: str) -> list[dt.date]:
    return sorted(r[0] for r in df.select(day).distinct().collect())  # one row a day


def ingest(
    files: list[DataFrame],
    raw_path: str,
    rules: R.RuleSet,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Union source frames, stamp them, and append the rows not ingested before.

    A row is known if its whole content is stored, which the digest index beside
    the raw layer tells without reading it; a row with new values for a known
    business key is kept, and cleaning takes the newest.  Returns the null
    profile of the stored raw layer, of no rows if nothing is stored.
    """
    schema = message_schema(rules.ddl)
    union = conform_schema(union_aligned([align_for_union(f, schema, rename) for f in files]), schema)
    spark = union.sparkSession
    index = ContentIndex(spark, raw_path, schema)
    index.catch_up()
    with Workspace(spark, "ingest") as space:
        # Written as a step, so the comparison runs once and the test for rows reads one.
        fresh = space.step(stamp(index.unknown(union)))
        if write_if_any(fresh, lambda df: write_entity(df, raw_path, "append")):
            index.catch_up()
    stored = stored_files(spark, raw_path)
    return op.null_profile(stamp(union).limit(0) if stored is None else stored)


def ingest_gate(raw: DataFrame, entity: str) -> DataFrame:
    """The critical-NULL report over a stored raw layer."""
    return op.quality_gate(raw, R.INGEST_CRITICAL[entity])


def clean_to_staging(
    raw: DataFrame, rules: R.RuleSet, path: str, audit_path: str | None = None
) -> DataFrame:
    """Write cleaned rows, and on request every reject and audit table.

    Returns the quality gate over what was written.
    """
    stages = Cleaning(raw, rules)
    write_entity(stages.clean, path, "overwrite")
    if audit_path is not None:
        side = {
            "critical_nulls": stages.critical_nulls,
            "rejects": stages.rejects,
            "superseded": stages.superseded,
            "fill_audit": stages.fill_audit,
            "change_audit": stages.change_audit,
            "funnel": stages.funnel,
        }
        if rules.medians:
            side["medians"] = stages.medians
        for name, frame in side.items():
            write_entity(frame, f"{audit_path}/{name}", "overwrite")
    return op.quality_gate(read_entity(raw.sparkSession, path), rules.critical)


def load_star(
    warehouse: Warehouse,
    staged: DataFrame,
    profile: str,
    incremental: bool = False,
    refresh: bool = False,
) -> DataFrame:
    """Load dimensions, then the fact, from one staging frame; returns the fact's gate.

    Dimensions get the members they lack, and attributes that this source knows
    fill stored NULLs; ``refresh`` also brings them up to date.  Nothing stored is
    lost.  The fact takes the place of stored rows with the same ids and leaves
    the others, such as streamed ones; with ``incremental`` it is only extended
    by ids not stored yet.  Only the days of the batch are read and written, and
    the ledger lists them.  The gate also counts repeated ids of the batch.
    """
    spec = star.STAR_FACTS[profile]
    with Workspace(warehouse.spark, f"star-{profile}") as space:
        staged = space.step(staged)
        for dim in star.STAR_DIMS[profile]:
            _load_dim(warehouse, space, staged, dim, refresh)

        # Every member was just loaded from this frame, so the fact needs no lookup.
        fact = star.build_fact_complete(staged, spec)
        row_id, stamped = "InteractionID", STAMP
        if profile == "video_stream":
            fact = stamp(star.stream_video_layout(fact), "LOAD_TIMESTAMP")
            row_id, stamped = row_id.upper(), stamped.upper()
        fact = space.step(fact.withColumn(star.STAMP_DAY, star.stamp_day(F.col(stamped))))
        if warehouse.fmt is not None:
            _load_fact_behind(warehouse, space, fact.drop(star.STAMP_DAY), spec.table, row_id, stamped, staged, incremental)
        elif not incremental:
            warehouse.upsert(fact, spec.table, row_id, stamped)
        elif not warehouse.exists(spec.table):
            warehouse.append(fact, spec.table)
        else:
            # An id holds its stamp, so only the batch's own days can have it.
            warehouse.versions(spec.table).recover()
            known = warehouse.by_day(spec.table, stamped, _days_of(fact, star.STAMP_DAY))
            fresh = space.step(op.anti_append(fact, known, row_id).select(*fact.columns))
            write_if_any(fresh, lambda df: warehouse.append(df, spec.table))
        census = op.duplicate_census(fact, [row_id])
        gate = op.quality_gate(fact, spec.critical)
        row = {**gate.first().asDict(), **census.first().asDict()}
    literals = [F.lit(value).alias(name) for name, value in row.items()]
    return warehouse.spark.range(1).select(*literals)


def _load_fact_behind(
    warehouse: Warehouse, space: Workspace, fact: DataFrame, table: str, row_id: str, stamped: str,
    staged: DataFrame, incremental: bool,
) -> None:
    """The fact load where days cannot be replaced one by one."""
    stored = warehouse.stored(table)
    if stored is None:
        warehouse.write(fact, table, "overwrite")
    elif incremental:
        known = op.within_range(stored, stamped, staged, STAMP)
        fresh = space.step(op.anti_append(fact, known, row_id))
        write_if_any(fresh, lambda df: warehouse.write(df, table, "append"))
    else:
        others = op.anti_append(stored, fact, row_id).select(*stored.columns)
        warehouse.write(space.step(others.unionByName(fact.select(*stored.columns))), table, "overwrite")


def _load_dim(
    warehouse: Warehouse, space: Workspace, staged: DataFrame, dim: star.Dim, refresh: bool
) -> None:
    existing = warehouse.stored(dim.table)
    if existing is None:
        warehouse.write(star.build_dim(staged, dim), dim.table, "overwrite")
    elif dim.known and (refresh or not star.fillable(staged, dim, existing).isEmpty()):
        merged = space.step(star.merged_members(staged, dim, existing, refresh))
        warehouse.write(merged, dim.table, "overwrite")
    else:
        members = space.step(star.new_members(staged, dim, existing))
        write_if_any(members, lambda df: warehouse.write(df, dim.table, "append"))


def load_activity(warehouse: Warehouse, since: str | None = None) -> DataFrame:
    """Bring daily activity up to date; returns its quality gate.

    Without ``since`` the days of all fact loads that the ledger lists and that
    activity has not taken in yet are computed again, so late rows of any day
    count; all days are where there is no ledger or no activity yet.  With
    ``since``, days from that one on are computed again, whole days whatever its
    time.  What is stored of those days is replaced; other days are neither read
    nor written, and a repeated load changes nothing.
    """
    first = None if since is None else dt.date.fromisoformat(since[:10])
    with Workspace(warehouse.spark, "activity") as space:
        for table in [f.table for f in star.STAR_FACTS.values()] if warehouse.fmt is None else []:
            warehouse.versions(table).recover()
        loads = warehouse.pending("activity", space)
        days = None
        if loads is not None and first is None and warehouse.exists(FACT_USER_ACTIVITY):
            days = _days_of(loads, "LoadedDay")
        if days is None or days:
            facts = _activity_facts(warehouse, days, first)
            rows = activity.user_activity(activity.unify_activity(*facts))
            rows = stamp(stamp(rows), "LoadTimestamp")
            warehouse.replace_days(rows, FACT_USER_ACTIVITY, ACTIVITY_DAY, days)
        if loads is not None and first is None:
            warehouse.taken_in("activity", loads)
    critical = ("InteractionID", "UserID_Surrogate", ACTIVITY_DAY)
    return op.quality_gate(warehouse.read(FACT_USER_ACTIVITY), critical)


def _activity_facts(
    warehouse: Warehouse, days: Iterable[dt.date] | None = None, since: dt.date | None = None
) -> list[DataFrame]:
    """Community, live and video facts; streamed video counts with the batch one."""
    community, live, video = (
        warehouse.by_day(star.STAR_FACTS[e].table, STAMP, days, since).drop(star.STAMP_DAY)
        for e in ("community", "live", "video")
    )
    table = star.FACT_VIDEO_STREAM.table
    if not warehouse.exists(table):
        return [community, live, video]
    streamed = warehouse.by_day(table, STAMP.upper(), days, since).drop(star.STAMP_DAY)
    return [community, live, star.all_video(video, streamed)]


def load_marts(warehouse: Warehouse) -> None:
    """Bring the six summary tables up to date.

    In the catalog the facts' sums by day are stored, and only the days of loads
    that marts have not taken in are read from the facts again; the tables come
    from the sums.  Behind a connector they come from the facts.
    """
    if warehouse.fmt is not None:
        _write_marts(warehouse, *_activity_facts(warehouse))
        return
    with Workspace(warehouse.spark, "marts") as space:
        for table in {f.table for f in star.STAR_FACTS.values()}:
            warehouse.versions(table).recover()
        loads = warehouse.pending("marts", space)
        names = {e: f"PART_{e.upper()}_BY_DAY" for e in marts.PARTS}
        days = None
        if loads is not None and all(warehouse.exists(n) for n in names.values()):
            days = _days_of(loads, "LoadedDay")
        if days is None or days:
            for (entity, name), fact in zip(names.items(), _activity_facts(warehouse, days)):
                warehouse.replace_days(marts.day_parts(fact, entity), name, star.STAMP_DAY, days)
        _write_marts(warehouse, *[warehouse.read(n) for n in names.values()])
        if loads is not None:
            warehouse.taken_in("marts", loads)


def _write_marts(warehouse: Warehouse, community: DataFrame, live: DataFrame, video: DataFrame) -> None:
    read = warehouse.read
    tables = {
        "MART_ENGAGEMENT_OVERVIEW": marts.engagement_overview(
            community, live, video, read("DIM_PLATFORM")
        ),
        "MART_COMMUNITY_TRENDS": marts.community_trends(community, read("DIM_COMMUNITY")),
        "MART_LIVE_STREAMING": marts.live_streaming(
            live, read("DIM_EVENT"), read("DIM_DEVICE_TYPE")
        ),
        "MART_VIDEO_INTERACTIONS": marts.video_interactions(video, read("DIM_WATCH_REASON")),
        "MART_TIME_TRENDS": marts.time_trends(video, read("DIM_TIME")),
        "MART_DEMOGRAPHICS": marts.demographics(video, read("DIM_USER")),
    }
    for name, mart in tables.items():
        warehouse.write(mart, name, "overwrite")

