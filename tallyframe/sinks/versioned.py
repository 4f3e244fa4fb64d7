"""Tables that are loaded as a whole or not at all: a folder for each version of a table, and a log whose last record says which folders count.

A load writes new folders for the tables that it changes and then appends one record, which appears by the rename with
which Spark commits a file. Until then readers see the last record's folders; a load that fails leaves no record. A
record names every table's folder and its rows before and after, so going back is one more record that names older
folders, and the log tells what was done. One load at a time writes to a root; any number may read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import action_counts, delete_cascade, upsert
from .places import delete

RECORD = "seq long, action string, note string, tables map<string,string>, counts array<struct<table:string,n_before:long,n_after:long,n_insert:long,n_update:long,n_unchanged:long>>"


class VersionedTables:
    """The tables below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log_path = f"{self.root}/_log"

    def log(self) -> DataFrame:
        """All records: seq, action, note, tables (name to folder), counts."""
        try:
            return self.spark.read.schema(RECORD).parquet(f"{self.log_path}/seq=*")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], RECORD)

    def history(self) -> DataFrame:
        """seq, action, note, table, rows before and after, and what an upsert did: a row for each table that a record changed."""
        return self.log().select("seq", "action", "note", F.explode("counts").alias("c")).select("seq", "action", "note", "c.*")

    def record(self, seq: int | None = None):
        """The record of a number, or the last one; None if there is none."""
        log = self.log() if seq is None else self.log().where(F.col("seq") == seq)
        return log.orderBy(F.desc("seq")).limit(1).first()

    def read(self, name: str, seq: int | None = None) -> DataFrame:
        """A table as the last record has it, or as record seq had it."""
        r = self.record(seq)
        if r is None or name not in r.tables:
            raise KeyError(f"no table {name} in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{r.tables[name]}").drop("_action")

    def has_note(self, note: str) -> bool:
        """Whether a record has that note: loads that name their batch are not done twice."""
        return not self.log().where(F.col("note") == note).isEmpty()

    def publish(self, tables: dict[str, DataFrame], action: str = "load", note: str | None = None) -> int:
        """New versions of some tables, all at once. What a column _action (see upsert) says is counted; readers don't see it. The number of the record."""
        last, folders, counts = self.record(), {}, []
        held = dict(last.tables) if last else {}
        try:
            for name, df in tables.items():
                folders[name] = f"{name}/{uuid.uuid4().hex}"
                path = f"{self.root}/{folders[name]}"
                before = self.spark.read.parquet(f"{self.root}/{held[name]}").count() if name in held else 0
                df.write.parquet(path)
                made = self.spark.read.parquet(path)
                # Counted in what was written, so that tasks that ran twice don't count twice.
                done = {r["_action"]: r.n_rows for r in action_counts(made).collect()} if "_action" in df.columns else {}
                counts.append((name, before, made.count(), *(done.get(k, 0) if done else None for k in ("insert", "update", "unchanged"))))
        except Exception:
            for folder in folders.values():
                delete(self.spark, f"{self.root}/{folder}")
            raise
        return self._append(action, note, held | folders, counts, last)

    def _append(self, action: str, note: str | None, tables: dict[str, str], counts: list[tuple], last) -> int:
        seq = last.seq + 1 if last else 1
        one = self.spark.createDataFrame([(seq, action, note, tables, counts)], RECORD).coalesce(1)
        # The folder's name makes a second writer of the same record fail.
        one.write.mode("errorifexists").parquet(f"{self.log_path}/seq={seq:012d}")
        return seq

    def upsert(self, name: str, new: DataFrame, keys: list[str], note: str | None = None) -> int:
        """A load of a table after new rows (see operators.upsert.upsert)."""
        return self.publish({name: upsert(self.read(name), new, keys)}, "upsert", note)

    def delete(self, names: list[str], key: str, gone: DataFrame, note: str | None = None) -> int:
        """A load of several tables without the keys of gone, children before parents, all at once."""
        left, _ = delete_cascade({n: self.read(n) for n in names}, key, gone)
        return self.publish(left, "delete", note)

    def roll_back(self, seq: int, note: str | None = None) -> int:
        """One more record, with the tables of record seq. Folders are not touched, so it can be taken back in the same way."""
        now, then = self.record(), self.record(seq)
        if then is None:
            raise KeyError(f"no record {seq} in {self.root}")
        changed = [n for n in now.tables if now.tables[n] != then.tables.get(n)]
        size = lambda r, n: self.spark.read.parquet(f"{self.root}/{r.tables[n]}").count() if n in r.tables else 0
        return self._append("roll back", note or f"to {seq}", then.tables, [(n, size(now, n), size(then, n), None, None, None) for n in changed], now)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders that only records before the last keep ones name; the folders deleted. Those records can't be read or rolled back to any more."""
        records = self.log().orderBy(F.desc("seq")).select("tables").collect()
        held = {f for r in records[:keep] for f in r.tables.values()}
        old = sorted({f for r in records[keep:] for f in r.tables.values()} - held)
        for folder in old:
            delete(self.spark, f"{self.root}/{folder}")
        return old


def keep_newest(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """upsert() where a row gives way only to one that comes no earlier by order; of rows of new with one key the last counts."""
    newest = F.struct(*order)
    last = new.groupBy(*keys).agg(F.max_by(F.struct(*new.columns), newest).alias("r")).select("r.*")
    held = old.select(*keys, newest.alias("_held"))
    fresh = last.join(held, keys, "left").where(F.col("_held").isNull() | (newest >= F.col("_held"))).select(*old.columns)
    return upsert(old, fresh, keys)


def day_before(as_of: datetime, zone: str = "America/New_York") -> date:
    """The calendar day before as_of (UTC where it has no zone) at a place."""
    at = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    return at.astimezone(ZoneInfo(zone)).date() - timedelta(days=1)


def load_day(tables: VersionedTables, name: str, rows: DataFrame, at: str, as_of: datetime, keys: list[str], order: list[Column], zone: str = "America/New_York") -> int | None:
    """Load the rows whose timestamp at lies on the day before as_of at a place, once: the record's number, or None if that day was loaded.

    The day is in the record that loads it, so a run that fails leaves the mark where it was, and runs may be repeated.
    """
    day = day_before(as_of, zone)
    note = f"daily {day}"
    if tables.has_note(note):
        return None
    news = rows.where(F.to_date(F.from_utc_timestamp(F.col(at), zone)) == F.lit(day))
    last = tables.record()
    if last is None or name not in last.tables:
        news = news.groupBy(*keys).agg(F.max_by(F.struct(*news.columns), F.struct(*order)).alias("r")).select("r.*")
        return tables.publish({name: news}, "daily", note)
    return tables.publish({name: keep_newest(tables.read(name), news, keys, order)}, "daily", note)


def last_day(tables: VersionedTables) -> DataFrame:
    """One row: day, the last that load_day() loaded (null: none)."""
    return tables.log().where("action = 'daily'").agg(F.max(F.regexp_extract("note", r"^daily (\S+)$", 1)).alias("day"))


def into(tables: VersionedTables, name: str, keys: list[str], order: list[Column], stream: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch of a stream goes into a table once. The batch's number is in the record that loads it, so a batch that comes
    again, after a failure between load and checkpoint or with a lost checkpoint, changes nothing."""

    def each(batch: DataFrame, number: int) -> None:
        note = f"{stream} batch {number}"
        if tables.has_note(note):
            return
        last = tables.record()
        if last is None or name not in last.tables:
            first = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.struct(*order)).alias("r")).select("r.*")
            tables.publish({name: first}, "batch", note)
        else:
            tables.publish({name: keep_newest(tables.read(name), batch, keys, order)}, "batch", note)

    return each
