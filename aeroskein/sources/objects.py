"""Rows of the listed objects of an archive: nothing else is opened, and each file says by its own header what its columns are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.sources.scratch import written

#: Columns of profile files and of tables like them.
PROFILE_COLUMNS = (
    "radar datetime height u v w ff dd sd_vvp gap eta dens dbz dbz_all n n_dbz n_all n_dbz_all DBZH rcs sd_vvp_threshold vcp radar_latitude radar_longitude radar_height radar_wavelength "
    "source_file timestamp_utc time datetime_utc date_time height_m altitude_m density ground_speed_ms speed direction_deg direction latitude longitude sunrise sunset day pulse"
).split()
#: Objects that are read and joined with their list at a time: some 200 bytes each are broadcast.
AT_ONCE = 50_000
#: A comma outside quotes.
COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def cells(line: Column) -> Column:
    """The values of a line of CSV, unquoted; a quoted value may hold commas and doubled quotes, but no line break."""
    unquoted = F.transform(F.split(line, COMMA), lambda v: F.regexp_replace(F.regexp_replace(v, r'^\s*"([\s\S]*)"\s*$', "$1"), '""', '"'))
    return F.when(F.contains(line, F.lit('"')), unquoted).otherwise(F.split(line, ","))


def by_header(files: DataFrame, columns: list[str] = PROFILE_COLUMNS) -> DataFrame:
    """A row for each line below the first of each file's text (column value), with `columns` as text by the names in that first line.

    A column that a file lacks is null, as is the value of a line that is too short; columns with other
    names aren't read. Empty values are null. Lines may end with CR LF; a byte order mark is skipped.
    Of two columns of one name the first counts.
    """
    lines = F.split(F.regexp_replace(F.col("value"), "^﻿", ""), "\r?\n")
    named = files.withColumn("_lines", lines).withColumn("_names", F.transform(cells(F.get("_lines", F.lit(0))), F.trim))
    # where each column is in this file: -1 if it isn't there
    placed = named.withColumn("_at", F.array(*[(F.array_position("_names", c) - 1).cast("int") for c in columns]))
    rest = [F.col(c) for c in files.columns if c != "value"]
    rows = placed.select(*rest, "_at", F.explode(F.slice("_lines", F.lit(2), F.greatest(F.size("_lines") - 1, F.lit(0)))).alias("_line")).where(F.trim("_line") != "")
    split = rows.withColumn("_cells", cells(F.col("_line")))
    return split.select(*rest, *[F.nullif(F.get("_cells", F.get("_at", F.lit(i))), F.lit("")).alias(f"_c_{c}") for i, c in enumerate(columns)])


def read_objects(root: str, objects: DataFrame, path: Column, columns: list[str] = PROFILE_COLUMNS, pack: Column | None = None) -> DataFrame:
    """Rows of the files of `objects`, with the columns of `objects` and then `columns` as text, prefixed with _c_.

    `path` says of an object where below `root` it is: a file, or a folder of files. The list of
    objects comes to the driver, which holds the files of any scan; a missing object is an error. A file is a
    task's single row until its lines are split, so files should be of some MB at most, as daily ones
    are; the contents of files aren't shuffled.

    Of an archive with packs, `pack` says in which an object is, null if it is a file of its own. A
    pack, a file or folder below `root` too, is a Parquet table of objects: their paths (column path) and whole texts (value). Only packs
    that have listed objects are opened, and only those objects' lines are split; just the names of packs come to the driver.
    """
    spark, root = objects.sparkSession, root.rstrip("/")
    listed = objects.withColumn("_path", path)
    parts = []
    if pack is not None:
        placed = written(listed.withColumn("_pack", pack), "listed")
        parts += _packed(root, placed.where(F.col("_pack").isNotNull()), columns)
        listed = placed.where(F.col("_pack").isNull()).drop("_pack")
    schema, listed = listed.schema, listed.collect()
    for start in range(0, len(listed), AT_ONCE):
        some = listed[start : start + AT_ONCE]
        files = spark.read.text([f"{root}/{r['_path']}" for r in some], wholetext=True)
        uri = F.col("_metadata.file_path")
        # the object's path is what ends the file's path, or that of its folder
        known = files.select("value", uri.alias("_uri"), _below(uri, root).alias("_full")).withColumn("_folder", F.regexp_extract("_full", "^(.*)/[^/]*$", 1))
        table = spark.createDataFrame(some, schema)
        joined = known.withColumn("_path", F.explode(F.array("_full", "_folder"))).join(F.broadcast(table), "_path")
        parts.append(by_header(joined.drop("_full", "_folder", "_path"), columns))
    if not parts:
        empty = objects.limit(0).select("*", F.lit(None).cast("string").alias("_uri"), *[F.lit(None).cast("string").alias(f"_c_{c}") for c in columns])
        return empty
    return reduce(DataFrame.unionByName, parts)


def _packed(root: str, listed: DataFrame, columns: list[str]) -> list[DataFrame]:
    """Rows of the listed objects (with _path and _pack) of packs, in parts of AT_ONCE objects or a pack."""
    spark = listed.sparkSession
    groups, room = [], 0
    for r in listed.groupBy("_pack").count().orderBy("_pack").collect():
        if r["count"] > room:
            groups.append([])
            room = AT_ONCE
        groups[-1].append(r["_pack"])
        room -= r["count"]
    parts, there = [], []
    for packs in groups:
        uri = F.col("_metadata.file_path")
        held = spark.read.schema("path string, value string").parquet(*[f"{root}/{p}" for p in packs])
        known = held.select(F.col("path").alias("_path"), "value", uri.alias("_file"), _below(uri, root).alias("_full")).withColumn("_folder", F.regexp_extract("_full", "^(.*)/[^/]*$", 1))
        found = known.withColumn("_pack", F.explode(F.array("_full", "_folder")))
        there.append(found.select("_pack", "_path"))
        joined = found.join(F.broadcast(listed.where(F.col("_pack").isin(packs))), ["_pack", "_path"]).withColumn("_uri", F.concat("_file", F.lit("#"), "_path"))
        parts.append(by_header(joined.drop("_file", "_full", "_folder", "_path", "_pack"), columns))
    if there:
        lost = listed.join(reduce(DataFrame.unionAll, there), ["_pack", "_path"], "left_anti").first()
        if lost:
            raise FileNotFoundError(f"{root}/{lost['_pack']} has no object {lost['_path']}")
    return parts


def _below(uri: Column, root: str) -> Column:
    """The decoded path of a file below the root."""
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    base = root.split(":", 1)[-1].lstrip("/")
    return F.substring_index(plain, base + "/", -1) if base else plain
