"""The raw file tree root/<date>/<game>/<endpoint>.json, read and written by Spark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PLACE = r"/(\d{4}-\d{2}-\d{2})/([^/._][^/]*)/([A-Za-z]+?)(?:v2)?\.json(?:\.gz)?$"

FILE = "day string, game_id string, endpoint string, path string, n_bytes long, modified timestamp, body string, error string"


def read(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """(day, game_id, endpoint, body) of each file; of one day only, if given, which prunes the listing. Both spellings of an endpoint (with and without v2) are one."""
    files = spark.read.text(f"{root}/{day}" if day else root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json*")
    at = F.col("_metadata.file_path")
    out = files.select(*[F.regexp_extract(at, PLACE, i + 1).alias(n) for i, n in enumerate(("day", "game_id", "endpoint"))], F.col("value").alias("body"))
    return out.where("game_id <> '' and endpoint <> 'manifest'")


def scan(spark: SparkSession, root: str, days: list[str] | None = None, endpoints: list[str] | None = None) -> DataFrame:
    """day, game_id, endpoint, path, n_bytes, modified, body, error of each file of the tree, bad ones too; of some days and endpoints only, if given.

    Days and endpoints are part of the listed pattern, so no other file is listed. A file that is there plain and compressed, or
    in both spellings of its endpoint, counts once. No file at all, or no such day, gives no row.
    """
    some = lambda names: "{%s}" % ",".join(names) if names else "*"
    pattern = f"{root}/{some(days)}/[^_.]*/{some([x for e in endpoints for x in (e, e + 'v2')] if endpoints else None)}.{{json,json.gz}}"
    try:
        files = spark.read.text(pattern, wholetext=True)
        listed = spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE)
    place = lambda at: [F.regexp_extract(at, PLACE, i + 1).alias(n) for i, n in enumerate(("day", "game_id", "endpoint"))]
    nth = F.row_number().over(Window.partitionBy("day", "game_id", "endpoint").orderBy("path"))
    again = listed.select("path", *place(F.col("path"))).withColumn("nth", nth).where("nth > 1").select("path")
    m = "_metadata."
    found = files.select(*place(F.col(m + "file_path")), F.col(m + "file_path").alias("path"), F.col(m + "file_size").alias("n_bytes"), F.col(m + "file_modification_time").alias("modified"), F.col("value").alias("body"))
    return found.join(again, "path", "left_anti").where("game_id <> '' and endpoint <> 'manifest'").withColumn("error", error(F.col("body"))).select(*[c.split()[0] for c in FILE.split(", ")])


def error(body: Column) -> Column:
    """What keeps a file's text from being used: null if nothing does."""
    return F.when(F.trim(F.coalesce(body, F.lit(""))) == "", "empty").when(F.try_parse_json(body).isNull(), "no JSON")


def stored(spark: SparkSession, path: str, days: list[str] | None = None, endpoints: list[str] | None = None) -> DataFrame:
    """game_id, body, sha1, n_bytes, error, day, endpoint of what write() stored; conditions on day and endpoint prune folders before they are listed."""
    got = spark.read.schema("game_id string, body string, sha1 string, n_bytes long, day string, endpoint string").json(path)
    for column, values in (("day", days), ("endpoint", endpoints)):
        if values is not None:
            got = got.where(F.col(column).isin(values))
    return got.withColumn("error", error(F.col("body")))


def endpoint(files: DataFrame, name: str) -> DataFrame:
    """Files of one endpoint whose body is JSON."""
    return files.where((F.col("endpoint") == name) & F.try_parse_json("body").isNotNull())


def with_sha1(files: DataFrame) -> DataFrame:
    return files.withColumn("sha1", F.sha1("body")).withColumn("n_bytes", F.octet_length("body").cast("long"))


def write(files: DataFrame, path: str) -> None:
    """Append files (day, game_id, endpoint, body) to a folder for each day and endpoint, with their sizes and SHA-1; Spark compresses and splits what it writes."""
    with_sha1(files.select("day", "game_id", "endpoint", "body")).hint("rebalance", "day", "endpoint").write.partitionBy("day", "endpoint").mode("append").option("compression", "gzip").json(path)
