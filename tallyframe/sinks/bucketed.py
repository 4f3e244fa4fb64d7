"""Tables bucketed by their key, so that an upsert moves the new rows to the old ones and never the old ones.

A merge writes the next version, bucketed alike, and then points a view of the table's name at it; readers use the view.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import require
from .places import delete

#: Keys of each entity. A lineup's players are compared by functions.text.lineup_hash, as lists can't be bucketed.
KEYS = {
    "games": ["game_id"],
    "pbp_events": ["game_id", "event_num"],
    "shot_events": ["game_id", "player_id", "period", "loc_x", "loc_y"],
    "lineup_stints": ["game_id", "team_id", "period", "lineup_hash"],
    "advanced_player_stats": ["game_id", "player_id"],
    "misc_player_stats": ["game_id", "player_id"],
    "usage_player_stats": ["game_id", "player_id"],
    "advanced_team_stats": ["game_id", "team_id"],
    "ref_assignments": ["game_id", "referee_name_slug"],
    "ref_alternates": ["game_id", "referee_name_slug"],
    "outcomes": ["game_id"],
}


class BucketedTable:
    """A table of the session's catalog with data below path; keys are not null, and each occurs once."""

    def __init__(self, spark: SparkSession, name: str, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.name, self.path, self.keys, self.buckets, self.version = spark, name, path.rstrip("/"), keys, buckets, 0

    @classmethod
    def of(cls, spark: SparkSession, entity: str, path: str, name: str | None = None, buckets: int = 64) -> BucketedTable:
        """For an entity of KEYS."""
        return cls(spark, name or entity, path, KEYS[entity], buckets)

    def _stored(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def read(self) -> DataFrame:
        return self.spark.table(self._stored(self.version))

    def _write(self, df: DataFrame) -> None:
        table, path = self._stored(self.version + 1), f"{self.path}/v{self.version + 1}"
        try:
            df.write.mode("overwrite").option("path", path).bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(table)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            delete(self.spark, path)
            raise
        self.version += 1
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {table}")
        if self.version > 1:
            self._drop(self.version - 1)

    def _drop(self, version: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._stored(version)}")
        delete(self.spark, f"{self.path}/v{version}")

    def create(self, rows: DataFrame) -> None:
        """The first version. Rows without a key are left out; rejected() has them."""
        good, _ = require(rows, self.keys)
        self._write(good.repartition(self.buckets, *self.keys))

    def rejected(self, rows: DataFrame) -> DataFrame:
        """Rows that lack a key, with its names in column missing."""
        return require(rows, self.keys)[1]

    def merged(self, new: DataFrame, always: bool = False) -> DataFrame:
        """The table after new rows, with _action (see operators.upsert). always: a row that came is an update, changed or not.

        Keys aren't null, so they are compared by =, and the old side stays in its buckets; only new rows are exchanged.
        """
        old, keys = self.read(), self.keys
        good, _ = require(new, keys)
        values = [c for c in old.columns if c not in keys]
        n = good.select(*keys, F.struct(*values).alias("_new"))
        o = old.select(*keys, F.struct(*values).alias("_old"))
        j = o.join(n, keys, "full_outer")
        differs = F.lit(True) if always else reduce(lambda a, b: a | b, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in values], F.lit(False))
        action = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "kept").when(differs, "update").otherwise("unchanged")
        picked = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in values]
        cols = {c: F.col(c) for c in keys} | dict(zip(values, picked, strict=True))
        return j.select(*[cols[c] for c in old.columns], action.alias("_action"))

    def upsert(self, new: DataFrame, always: bool = False) -> None:
        self._write(self.merged(new, always).drop("_action"))

    def drop(self) -> None:
        """Remove view, table and data."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        self._drop(self.version)
