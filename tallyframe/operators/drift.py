"""Drift of payloads: which keys of JSON bodies are there, of which types, against those that are expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_paths(body: Column, depth: int = 4) -> Column:
    """array<struct(path, type)> of a JSON text, each once: $.a.b for keys and $.a[] for what an array holds, down to depth; null if it is no JSON.

    Types are OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN and VOID (null).
    """
    kind = lambda v: F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)
    at = lambda path, v: F.struct(path.alias("path"), v.alias("v"), kind(v).alias("type"))
    none = F.expr("cast(array() as array<struct<path:string,v:variant,type:string>>)")

    def children(x: Column) -> Column:
        keys = F.transform(F.map_entries(F.variant_get(x["v"], "$", "map<string,variant>")), lambda e: at(F.concat(x["path"], F.lit("."), e["key"]), e["value"]))
        items = F.transform(F.variant_get(x["v"], "$", "array<variant>"), lambda e: at(F.concat(x["path"], F.lit("[]")), e))
        return F.when(x["type"] == "OBJECT", keys).when(x["type"] == "ARRAY", items).otherwise(none)

    def deeper(acc: Column, _: Column) -> Column:
        return bound(F.flatten(F.transform(acc["now"], children)), lambda n: F.struct(F.concat(acc["found"], n).alias("found"), n.alias("now")))

    every = lambda v: F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.struct(none.alias("found"), F.array(at(F.lit("$"), v)).alias("now")), deeper)["found"]
    named = lambda v: F.array_distinct(F.transform(every(v), lambda x: F.struct(x["path"].alias("path"), x["type"].alias("type"))))
    return bound(F.try_parse_json(body), lambda v: F.when(v.isNotNull(), named(v)))


def bound(value: Column, use) -> Column:
    """use(value) with value worked out once, however often use names it."""
    return F.transform(F.array(value), use)[0]


def payload_drift(rows: DataFrame, body: str, expected: DataFrame, depth: int = 4) -> DataFrame:
    """path, expected, found, problem, n_rows: what bodies have that expected (path, type; a small table) doesn't say.

    absent: n_rows bodies lack the path; new: n_rows have one that isn't expected; retyped: n_rows have it with another type.
    A null is of any type. Bodies that are no JSON count as path $ of type INVALID. One scan; counts meet before they are compared.
    """
    paths = F.coalesce(key_paths(F.col(body), depth), F.array(F.struct(F.lit("$").alias("path"), F.lit("INVALID").alias("type"))))
    # A path counts once for each of its types, once for itself and, as the empty path, once for the body, so that rows are read once.
    whole = F.array(F.struct(F.lit("").alias("path"), F.lit("ANY").alias("type")))
    itself = lambda ps: F.array_distinct(F.transform(ps, lambda p: F.struct(p["path"].alias("path"), F.lit("ANY").alias("type"))))
    counts = rows.select(F.explode(bound(paths, lambda ps: F.concat(ps, itself(ps), whole))).alias("p")).groupBy("p.path", "p.type").agg(F.count("*").alias("n"))
    seen = counts.groupBy("path").agg(F.max(F.when(F.col("type") == "ANY", F.col("n"))).alias("n_path"), F.expr("collect_list(struct(type, n)) FILTER (WHERE type <> 'ANY')").alias("types"))
    want = expected.select("path", F.col("type").alias("expected")).unionByName(expected.sparkSession.createDataFrame([("", "ANY")], "path string, expected string"))
    both = seen.join(want, "path", "full_outer")
    total = both.agg(F.max(F.when(F.col("path") == "", F.col("n_path"))).alias("n_all"))
    both = both.where("path <> ''").crossJoin(F.broadcast(total))
    known, there = F.col("expected").isNotNull(), F.coalesce("n_path", F.lit(0))
    odd = F.filter(F.coalesce("types", F.array().cast("array<struct<type:string,n:bigint>>")), lambda t: ~known | ((t["type"] != F.col("expected")) & (t["type"] != "VOID")))
    lacking = F.when(known & (there < F.coalesce("n_all", F.lit(0))), F.array(F.struct(F.lit(None).cast("string").alias("type"), (F.coalesce("n_all", F.lit(0)) - there).alias("n")))).otherwise(F.array().cast("array<struct<type:string,n:bigint>>"))
    each = both.select("path", "expected", F.explode(F.concat(odd, lacking)).alias("t"))
    problem = F.when(F.col("t.type").isNull(), "absent").when(F.col("expected").isNull(), "new").otherwise("retyped")
    return each.select("path", "expected", F.col("t.type").alias("found"), problem.alias("problem"), F.col("t.n").alias("n_rows"))
