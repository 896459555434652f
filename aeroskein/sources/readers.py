"""Readers of archives, weather, predictions, packages and boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroskein.functions.coerce import num
from aeroskein.operators.historical import annual_records, coverage_records, daily_records, phenology_records
from aeroskein.operators.profiles import canonical_layers
from aeroskein.sources.objects import PROFILE_COLUMNS, read_objects

DEFAULT_RANGE_M = 255_000.0

def _array_of(df: DataFrame, *names: str) -> DataFrame:
    """Rows of the first of the named arrays that the documents have; documents without one are rows."""
    there = [n for n in names if n in df.columns and isinstance(df.schema[n].dataType, T.ArrayType)]
    if not there:
        return df
    return df.select(F.explode(F.coalesce(*[F.col(n) for n in there])).alias("r")).select("r.*")


def read_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of a json, jsonl, csv, tsv or parquet table; a json document may be a list or hold items or records."""
    if kind == "json":
        return _array_of(spark.read.option("multiLine", True).json(path), "items", "records")
    if kind == "jsonl":
        return spark.read.json(path)
    if kind in ("csv", "tsv"):
        return spark.read.option("header", True).option("sep", "," if kind == "csv" else "\t").csv(path)
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown kind of table: {kind}")


def key_tail(path: Column) -> Column:
    """Radar, year and name of an archive file, which its key and its path end with."""
    return F.regexp_extract(path, r"([^/]+/\d{4}/[^/]+)$", 1)


def read_vpts_archive(spark: SparkSession, root: str, inventory: DataFrame, max_files: int | None = None, path_of=key_tail, pack_of=None) -> DataFrame:
    """Layers of the inventory's objects (radar, day, pulse, key, etag), of the first max_files by radar, day and pulse if given.

    Only these objects are opened, each read by its own header. path_of says of an object's
    key where it is below the root, and pack_of, for an archive that has packs, in which pack it is (null: a file of its own). The inventory says whose rows they are: radar and pulse in the
    rows are overridden.
    """
    if max_files is not None:
        inventory = inventory.orderBy("radar", "day", "pulse").limit(max_files)
    objects = inventory.select("radar", "pulse", F.col("key").alias("source_key"), F.col("etag").alias("source_etag"))
    rows = read_objects(root, objects, path_of(F.col("source_key")), pack=pack_of and pack_of(F.col("source_key")))
    named = [F.col(f"_c_{c}").alias(c) for c in PROFILE_COLUMNS if c not in ("radar", "pulse")]
    return canonical_layers(rows.select(*objects.columns, F.col("_uri").alias("source_uri"), *named))


def name_tail(path: Column) -> Column:
    """Year and name of another archive's file."""
    return F.regexp_extract(path, r"([^/]+/[^/]+)$", 1)


def read_external_vpts(spark: SparkSession, root: str, objects: DataFrame, pulse: str = "unknown", path_of=name_tail) -> DataFrame:
    """Rows, as text, of another archive's listed daily files with their source; they keep the radar that they name."""
    listed = objects.select("source", F.col("key").alias("source_url"), F.col("radar").alias("archive_radar"), F.col("day").alias("archive_date"))
    rows = read_objects(root, listed, path_of(F.col("source_url")))
    return rows.select(*[F.col(f"_c_{c}").alias(c) for c in PROFILE_COLUMNS if c != "pulse"], *listed.columns, F.lit(pulse).alias("pulse"))


def _pick(df: DataFrame, *names: str, kind: str = "double") -> Column:
    there = [F.col(n) for n in names if n in df.columns]
    if not there:
        return F.lit(None).cast(kind)
    return num(*there) if kind == "double" else F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in there])


def radars_of(df: DataFrame) -> DataFrame:
    """The radar table from rows with any of the usual names; rows without a name are dropped."""
    out = df.select(
        _pick(df, "slug", "radar", kind="string").alias("radar"), _pick(df, "label", "name", kind="string").alias("label"), _pick(df, "latitude", "lat").alias("latitude"),
        _pick(df, "longitude", "lon").alias("longitude"), _pick(df, "height_m", "height").alias("height_m"), _pick(df, "max_range_m", "range_m").alias("max_range_m"),
    )
    return out.where(F.col("radar").isNotNull())


def read_radars(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Radars from csv, or json as a list or under `radars`."""
    df = _array_of(spark.read.option("multiLine", True).json(path), "radars") if kind == "json" else read_records(spark, path, kind)
    return radars_of(df)


def radars_from_catalog(catalog: DataFrame, default_range_m: float = DEFAULT_RANGE_M) -> DataFrame:
    """Radars of catalog documents (radars: [{radar, spatial{latitude, longitude, height_m, max_range_m}}]), and whence their range comes."""
    r = catalog.select(F.explode("radars").alias("r")).select("r.radar", "r.spatial.*")
    named = r.where(F.coalesce("radar", F.lit("")) != "")
    given = F.col("max_range_m").isNotNull()
    return named.select(
        "radar", F.initcap(F.regexp_replace("radar", "[-_]", " ")).alias("label"), "latitude", "longitude", "height_m", F.coalesce("max_range_m", F.lit(default_range_m)).alias("max_range_m"),
        F.when(given, "catalog").otherwise("default").alias("range_source"),
    )


def read_site_features(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of daily documents {rows: [...]}."""
    return _array_of(spark.read.option("multiLine", True).json(pattern), "rows")


HISTORICAL_FILES = {"daily": daily_records, "annual": annual_records, "phenology": phenology_records, "coverage": coverage_records}


def read_historical_package(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The package's tables by name; a missing one is an error before anything is read."""
    out = {}
    for name, records in HISTORICAL_FILES.items():
        out[name] = records(spark.read.option("header", True).csv(f"{root}/{name}"))
    out["radars"] = _array_of(spark.read.option("multiLine", True).json(f"{root}/radars"), "radars")
    return out


def region_weeks(raw: DataFrame, value: str) -> DataFrame:
    """Rows with a region, a week start and a value; effort is 0 if missing. A week start that is no ISO date is an error."""
    effort = num(F.col("complete_list_count")) if "complete_list_count" in raw.columns else F.lit(None).cast("double")
    given = raw.where((F.coalesce("region", F.lit("")) != "") & (F.coalesce("week_start", F.lit("")) != "") & num(F.col(value)).isNotNull())
    day = F.col("week_start").try_cast("date")
    week = F.when(day.isNotNull() & F.col("week_start").rlike(r"^\d{4}-\d{2}-\d{2}$"), day).otherwise(F.raise_error(F.concat(F.lit("week_start is no ISO date: "), F.col("week_start"))).cast("date"))
    return given.select("region", week.alias("week_start"), num(F.col(value)).alias(value), F.coalesce(effort, F.lit(0.0)).cast("long").alias("complete_list_count"))


def read_region_week(spark: SparkSession, path: str, value: str) -> DataFrame:
    return region_weeks(spark.read.option("header", True).csv(path), value)


def _required(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df


def read_wide_predictions(spark: SparkSession, path: str, targets: tuple[str, ...]) -> DataFrame:
    """Wide predictions; all of the named columns have to be there."""
    df = _required(spark.read.option("header", True).csv(path), ["hour", "longitude", "latitude", "support", *targets, *[f"uncertainty_{t}" for t in targets]])
    return df.select(F.col("hour").try_cast("timestamp").alias("hour"), *[num(F.col(c)).alias(c) for c in df.columns if c not in ("hour", "pulse")], *([F.col("pulse")] if "pulse" in df.columns else []))


def read_long_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Long predictions; without support the table is refused."""
    df = _required(spark.read.option("header", True).csv(path), ["hour", "longitude", "latitude", "support", "pulse", "target", "value"])
    return df.select(F.col("hour").try_cast("timestamp").alias("hour"), "pulse", "target", *[num(F.col(c)).alias(c) for c in df.columns if c not in ("hour", "pulse", "target")])


def metrics_of(documents: DataFrame, validation: str | None = None) -> DataFrame:
    """Rows of metrics arrays; a row without a validation is of leave_one_radar_out."""
    rows = documents.select(F.explode("metrics").alias("m")).select("m.*")
    named = rows.withColumn("validation", F.coalesce("validation", F.lit("leave_one_radar_out")) if "validation" in rows.columns else F.lit("leave_one_radar_out"))
    return named if validation is None else named.where(F.col("validation") == validation)


def read_metrics(spark: SparkSession, path: str, validation: str | None = None) -> DataFrame:
    return metrics_of(spark.read.option("multiLine", True).json(path), validation)


RING = T.ArrayType(T.ArrayType(T.DoubleType()))
BOUNDARY = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])),
])))])


def read_boundary(spark: SparkSession, path: str, code: str, wanted: list[str]) -> DataFrame:
    """(code, polygons) of the wanted countries of a GeoJSON collection, which must all be there.

    Polygons and multipolygons come alike, as array<array<array<struct<x, y>>>>; rings of
    fewer than three points are dropped.
    """
    f = spark.read.schema(BOUNDARY).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    coords = F.col("f.geometry.coordinates")
    polygon, multi = F.from_json(coords, T.ArrayType(RING)), F.from_json(coords, T.ArrayType(T.ArrayType(RING)))
    nested = F.when(F.col("f.geometry.type") == "Polygon", F.array(polygon)).when(F.col("f.geometry.type") == "MultiPolygon", multi)
    point = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    clean = F.transform(nested, lambda poly: F.transform(F.filter(poly, lambda ring: F.size(ring) >= 3), lambda ring: F.transform(ring, point)))
    out = f.select(F.element_at(F.col("f.properties"), code).alias("code"), clean.alias("polygons")).where(F.col("code").isin(*wanted))
    missing = set(wanted) - {r["code"] for r in out.select("code").distinct().collect()}
    if missing:
        raise ValueError(f"the boundary lacks {sorted(missing)}")
    return out


#: Names that sources give a variable of weather in long form.
WEATHER_NAMES = {"sp": ("sp", "surface_pressure"), "tcc": ("tcc", "total_cloud_cover"), "t": ("t", "temperature"), "u": ("u", "u_component_of_wind"), "v": ("v", "v_component_of_wind")}


def read_weather_long(spark: SparkSession, path: str, levels: list[int] | None = None) -> DataFrame:
    """Weather as rows (hour, latitude, longitude, level, variables), with usual names and only the wanted levels."""
    df = spark.read.parquet(path)
    time = next(c for c in ("hour", "valid_time", "time") if c in df.columns)
    level = next((c for c in ("level", "pressure_level", "isobaricInhPa") if c in df.columns), None)
    there = {k: [F.col(a) for a in names if a in df.columns] for k, names in WEATHER_NAMES.items()}
    out = df.select(F.col(time).alias("hour"), "latitude", "longitude", *([F.col(level).cast("int").alias("level")] if level else []), *[F.coalesce(*c).alias(k) for k, c in there.items() if c])
    return out.where(F.col("level").isin(*levels)) if levels and level else out
