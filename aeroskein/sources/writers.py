"""Writers of archives, tables, frames and manifests."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroskein.operators.training import preferred_order


def write_night_archive(nights: DataFrame, root: str) -> None:
    """Night documents in folders year=/date=."""
    parts = nights.withColumns({"year": F.year("night_date"), "date": F.date_format("night_date", "yyyyMMdd")})
    parts.repartition("year", "date").write.partitionBy("year", "date").mode("append").json(root)


def write_packs(rows: DataFrame, root: str, by: list[str], path: str, header: list[str]) -> None:
    """CSV objects in packs, a pack for each value of `by`: a pack's rows are an object each, its path and its whole text with a header line."""
    line = F.to_csv(F.struct(*header), {"escape": '"'})
    texts = rows.select(*by, path, line.alias("line")).repartition(*by).groupBy(*by, path).agg(F.concat(F.lit(",".join(header) + "\n"), F.array_join(F.collect_list("line"), "\n"), F.lit("\n")).alias("value"))
    texts.withColumnRenamed(path, "path").write.partitionBy(*by).parquet(root)


def write_hourly(hourly: DataFrame, path: str) -> None:
    hourly.write.mode("overwrite").parquet(path)


def latest_summary(nights: DataFrame) -> DataFrame:
    """One row: newest night, nights, radars and classes."""
    return nights.agg(
        F.max("night_date").alias("latest_night"), F.count("*").alias("nights"), F.countDistinct("radar").alias("radars"), F.count_if(F.col("quality_class") == "good").alias("good"),
        F.count_if(F.col("integrated_interval_count") > 0).alias("integrable"),
    )


def geojson_features(rows: DataFrame) -> DataFrame:
    """A GeoJSON point feature (column feature) of each row with coordinates; other columns are properties."""
    rest = [c for c in rows.columns if c not in ("latitude", "longitude")]
    placed = rows.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    geometry = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    return placed.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*rest).alias("properties"))).alias("feature"))


def write_training_table(rows: DataFrame, path: str) -> None:
    """CSV with a header, known columns first."""
    preferred_order(rows).write.option("header", True).mode("overwrite").csv(path)


def write_daily_frames(frames: DataFrame, root: str) -> None:
    """Frames, a line an hour and tile, in folders by pulse and day."""
    docs = frames.withColumn("date", F.date_format("hour", "yyyyMMdd"))
    docs.write.partitionBy("pulse", "date").mode("overwrite").json(root)


def write_daily_by_year(daily: DataFrame, root: str) -> None:
    parts = daily.withColumn("year", F.year(F.col("date").cast("date")))
    parts.repartition("year").write.partitionBy("year").mode("overwrite").json(root)


def write_feature_rows(rows: DataFrame, path: str, kind: str) -> None:
    """Rows as json, csv or parquet."""
    if kind not in ("json", "csv", "parquet"):
        raise ValueError(f"unknown kind of table: {kind}")
    w = rows.write.mode("overwrite")
    (w.option("header", True) if kind == "csv" else w).format(kind).save(path)


def manifest(rows: DataFrame, time: str, policy: dict[str, str]) -> DataFrame:
    """One row: counts, first and last time, and the constants of a policy as a map, with its JSON."""
    consts = F.create_map(*[F.lit(x) for kv in policy.items() for x in kv]) if policy else F.create_map().cast("map<string,string>")
    sums = rows.agg(F.count("*").alias("rows"), F.countDistinct("radar").alias("radars"), F.min(time).alias("first"), F.max(time).alias("last")).withColumn("policy", consts)
    return sums.withColumn("document", F.to_json(F.struct("rows", "radars", "first", "last", "policy")))


def _files(spark: SparkSession, path: str):
    """Hadoop's file context, whose renames are atomic where the store's are, and its path class."""
    hadoop = spark._jvm.org.apache.hadoop
    uri = hadoop.fs.Path(path).toUri()
    conf = spark._jsc.hadoopConfiguration()
    return (hadoop.fs.FileContext.getFileContext(uri, conf) if uri.getScheme() else hadoop.fs.FileContext.getFileContext(conf)), hadoop.fs.Path


def _put(spark: SparkSession, path: str, document: str, replace: bool) -> None:
    """Write a small file aside and rename it into place; without `replace` an existing one is an error."""
    files, at = _files(spark, path)
    folder, _, name = path.rpartition("/")
    aside = at(f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = aside.getFileSystem(spark._jsc.hadoopConfiguration()).create(aside, True)
    out.write(bytearray(document.encode()))
    out.close()
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    rename = spark._sc._gateway.new_array(kinds, 1)
    rename[0] = kinds.OVERWRITE if replace else kinds.NONE
    try:
        files.rename(aside, at(path), rename)
    except Exception:
        files.delete(aside, False)
        raise


def commits(spark: SparkSession, pointer: str) -> list[int]:
    """Numbers of the commits of a pointer, in order."""
    files, at = _files(spark, pointer)
    folder = at(f"{pointer}.commits")
    if not files.util().exists(folder):
        return []
    names = [s.getPath().getName() for s in files.util().listStatus(folder)]
    return sorted(int(n.split(".")[0]) for n in names if not n.startswith("."))


def current_version(spark: SparkSession, pointer: str) -> str | None:
    """The version of the last commit; None if there is none."""
    found = commits(spark, pointer)
    return spark.read.json(f"{pointer}.commits/{found[-1]:012d}.json").first()["version"] if found else None


def publish_immutable(rows: DataFrame, archive: str, pointer: str, version: str) -> None:
    """Write a version, which must not exist, and then swap the small pointer to it.

    Who publishes takes the number after the last commit that was there before the rows were
    written, by a rename that doesn't overwrite: of two at once one is refused, and its rows stay unseen. The
    pointer, a JSON file, is replaced by a rename too, so that a reader always finds one. Both need a
    store whose renames are atomic.
    """
    spark, target = rows.sparkSession, f"{archive}/{version}"
    number = (commits(spark, pointer) or [0])[-1] + 1
    rows.write.mode("errorifexists").parquet(target)
    try:
        _put(spark, f"{pointer}.commits/{number:012d}.json", json.dumps({"version": version, "path": target}) + "\n", replace=False)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        raise FileExistsError(f"another version was published while {version} was written") from e
    # a slower one may come after a faster one: the pointer ends at the last commit
    while True:
        last = commits(spark, pointer)[-1]
        row = spark.read.json(f"{pointer}.commits/{last:012d}.json").first()
        _put(spark, pointer, json.dumps({"version": row["version"], "path": row["path"]}) + "\n", replace=True)
        if commits(spark, pointer)[-1] == last:
            break


def artifact_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(key, size, sha256) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split(":")[-1].lstrip("/") + "/"
    return files.select(F.regexp_extract(F.col("path"), rf"\Q{base}\E(.*)$", 1).alias("key"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def release_problems(assets: DataFrame, files: DataFrame, data_available: Column) -> DataFrame:
    """Assets (asset) of a manifest that no file (key) is, and whether the release has data; web addresses aren't looked for."""
    local = assets.where(~F.col("asset").rlike("^https?://"))
    missing = local.join(files.select(F.col("key").alias("asset")), "asset", "left_anti").select("asset", F.lit("missing").alias("problem"))
    empty = assets.sparkSession.range(1).where(~F.coalesce(data_available, F.lit(False))).select(F.lit(None).cast("string").alias("asset"), F.lit("no_data").alias("problem"))
    return missing.union(empty)
