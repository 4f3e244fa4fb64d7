"""Keyed writes as pure DataFrame operations: what a table becomes, and what happened to each row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old after new, with _action: insert, update, unchanged (an equal row came) or kept (none came).

    Rows differ if any column does, null = null. Keys are compared null-safely. A key occurs once on each side.
    """
    values = [c for c in old.columns if c not in keys]
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns], F.lit(True).alias("o_here"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in old.columns], F.lit(True).alias("n_here"))
    on = reduce(lambda a, b: a & b, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys])
    j = o.join(n, on, "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in values], F.lit(False))
    came = F.col("n_here").isNotNull()
    action = F.when(F.col("o_here").isNull(), "insert").when(~came, "kept").when(differs, "update").otherwise("unchanged")
    return j.select(*[F.when(came, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in old.columns], action.alias("_action"))


def overwrite_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys of new, plus new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def action_counts(result: DataFrame) -> DataFrame:
    return result.groupBy("_action").agg(F.count("*").alias("n_rows"))


def require(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose fields are all there, and the others with missing (names of the fields that aren't)."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in fields]))
    marked = rows.withColumn("missing", missing)
    return marked.where(F.size("missing") == 0).drop("missing"), marked.where(F.size("missing") > 0)


def require_any(rows: DataFrame, rules: list[list[list[str]]]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all rules, and the others with missing (the rules that they don't meet, as texts). A rule is a list of groups of fields,
    of which one must be there as a whole: neither null nor empty. Rows of a game, say, need a team or both sides."""
    there = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    holds = lambda rule: reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [there(c) for c in group]) for group in rule])
    missing = F.array_compact(F.array(*[F.when(~holds(rule), F.lit(" or ".join(", ".join(g) for g in rule))) for rule in rules]))
    marked = rows.withColumn("missing", missing)
    return marked.where(F.size("missing") == 0).drop("missing"), marked.where(F.size("missing") > 0)


def with_parent(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is null or among the parents'."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(key).distinct(), key, "left_semi").unionByName(rows.where(F.col(key).isNull()).select(key, *[c for c in rows.columns if c != key]))


def load_derived(old: DataFrame, new: DataFrame, keys: list[str], required: list[str], complete: DataFrame, parents: DataFrame) -> DataFrame:
    """upsert() of the rows that have all required fields, come from a complete game and have a parent."""
    good, _ = require(new, required)
    good = with_parent(good.join(complete.select("game_id").distinct(), "game_id", "left_semi"), parents, "game_id")
    return upsert(old, good.select(*old.columns), keys)


def delete_cascade(tables: dict[str, DataFrame], key: str, gone: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without the keys of gone, children before parents in the order given, and (table, n_before, n_after)."""
    left = {name: t.join(gone.select(key).distinct(), key, "left_anti") for name, t in tables.items()}
    counts = [tables[n].agg(F.count("*").alias("n_before")).crossJoin(left[n].agg(F.count("*").alias("n_after"))).select(F.lit(n).alias("table"), "n_before", "n_after") for n in tables]
    return left, reduce(DataFrame.unionByName, counts)


def drop_duplicate_shots(shots: DataFrame) -> DataFrame:
    """Shots fetched for each team, once."""
    return shots.dropDuplicates(["GAME_ID", "PLAYER_ID", "PERIOD", "MINUTES_REMAINING", "SECONDS_REMAINING", "LOC_X", "LOC_Y"])
