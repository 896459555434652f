"""Observations and weather: merging, joining, nearest cells, coverage and support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.functions.geo import EARTH_KM, great_circle_km
from aeroskein.sources.scratch import written

KM_PER_DEGREE = 110.0


def merge_weather_datasets(rows: DataFrame, keys: tuple[str, ...] = ("radar", "hour")) -> DataFrame:
    """Fold the surface and pressure-level rows of a key into one, with flags of what was there.

    Of several values the one of the highest dataset_index wins; a null never overwrites a
    value. Combines before the shuffle.
    """
    values = [c for c in rows.columns if c not in (*keys, "dataset_index")]
    return rows.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("dataset_index"))).alias(c) for c in values],
        F.bool_or(F.col("dataset_index") == 0).alias("has_surface"), F.bool_or(F.col("dataset_index") == 1).alias("has_levels"),
    )


def join_observed_weather(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of each observed (radar, hour); an hour's weather serves every pulse. Observed columns get a prefix."""
    named = hourly.select("radar", "hour", *[F.col(c).alias(f"observed_{c}") for c in hourly.columns if c not in ("radar", "hour")])
    return named.join(weather, ["radar", "hour"])


def unmatched(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("radar", "hour")) -> DataFrame:
    """Rows of `left` without a partner."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def sample_unmatched(rows: DataFrame, n: int = 25) -> DataFrame:
    """The first rows by key, for a report."""
    return rows.orderBy("radar", "pulse", "hour").limit(n)


def nearest_grid_cells(sites: DataFrame, grid: DataFrame) -> DataFrame:
    """Nearest latitude and longitude of the grid to each site, each axis by itself; of equals the lower.

    Only the distinct values of an axis are compared with sites, and both are small tables:
    a grid has hundreds of values an axis, a network hundreds of sites.
    """

    def nearest(axis: str, site: str):
        values = grid.select(F.col(axis).alias("v")).distinct()
        gap = F.abs(F.col("v") - F.col(site))
        return sites.join(values).groupBy("radar").agg(F.min(F.struct(gap.alias("gap"), F.col("v"))).alias("m")).select("radar", F.col("m.v").alias(f"cell_{axis}"))

    return nearest("latitude", "latitude").join(nearest("longitude", "longitude"), "radar")


def tile_of(latitude: Column, longitude: Column) -> tuple[Column, Column]:
    """The degree square of a place; longitudes count around the globe."""
    return F.floor(latitude).cast("int"), F.pmod(F.floor(longitude), F.lit(360)).cast("int")


def in_tiles(radars: DataFrame) -> DataFrame:
    """Place and range of each radar (_lat, _lon, _km), once for each degree square (_row, _col) that its range may reach.

    The squares follow from the cap that the range is: all longitudes where it holds a pole, both
    sides of the date line where it crosses it.
    """
    r = radars.select(F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), (F.col("max_range_m") / 1000.0).alias("_km")).where("_lat is not null and _lon is not null and _km >= 0")
    reach = F.col("_km") / EARTH_KM + 1e-9
    high = F.degrees(reach)
    beside = F.when(F.abs("_lat") + high < 90, F.degrees(F.asin(F.least(F.lit(1.0), F.sin(reach) / F.cos(F.radians("_lat")))))).otherwise(180.0) + 1e-9
    rows = F.sequence(F.floor(F.greatest(F.col("_lat") - high, F.lit(-90.0))), F.floor(F.least(F.col("_lat") + high, F.lit(90.0))))
    first, last = F.floor(F.col("_lon") - beside), F.floor(F.col("_lon") + beside)
    columns = F.sequence(first, F.least(last, first + 359))
    placed = r.withColumn("_row", F.explode(rows)).withColumn("_at", F.explode(columns))
    return placed.select("_lat", "_lon", "_km", F.col("_row").cast("int").alias("_row"), F.pmod("_at", F.lit(360)).cast("int").alias("_col"))


def in_tiles_of(cells: DataFrame) -> DataFrame:
    row, column = tile_of(F.col("latitude"), F.col("longitude"))
    return cells.select("latitude", "longitude").distinct().withColumns({"_row": row, "_col": column})


def cells_in_coverage(cells: DataFrame, radars: DataFrame) -> DataFrame:
    """Distinct cells within the range of some radar: a hash join on degree squares, then the distance."""
    close = great_circle_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")) <= F.col("_km")
    tiled, reached = in_tiles_of(cells), in_tiles(radars)
    return tiled.join(reached, (tiled["_row"] == reached["_row"]) & (tiled["_col"] == reached["_col"]) & close, "left_semi").select("latitude", "longitude")


def support_scores(cells: DataFrame, radars: DataFrame) -> DataFrame:
    """Largest exp(-(distance / range)^2) over the radars whose range holds a cell; 0 outside all."""
    km = great_circle_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    # a range of 0 holds its own place alone
    score = F.when(km <= F.col("_km"), F.exp(-F.pow(F.coalesce(F.try_divide(km, F.col("_km")), F.lit(0.0)), F.lit(2.0))))
    both = in_tiles_of(cells).join(in_tiles(radars), ["_row", "_col"], "left")
    return both.groupBy("latitude", "longitude").agg(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.max(score), F.lit(0.0)))), 6).alias("support"))


def boundary_edges(boundary: DataFrame, band: float) -> DataFrame:
    """Edges (code, polygon, x1, y1, x2, y2) of (code, polygons), once for each band of y (_band) that they cross; level edges, which no ray counts, are left out."""
    rings = boundary.select("code", F.posexplode("polygons").alias("polygon", "_rings")).select("code", "polygon", F.explode("_rings").alias("_ring"))
    closed = F.concat(F.slice("_ring", F.lit(2), F.size("_ring")), F.slice("_ring", 1, 1))
    edges = rings.select("code", "polygon", F.explode(F.zip_with("_ring", closed, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))).alias("e")).select("code", "polygon", "e.*").where("y1 <> y2")
    at = lambda c: F.floor(c / band)
    return edges.withColumn("_band", F.explode(F.sequence(at(F.least("y1", "y2")), at(F.greatest("y1", "y2")))))


def points_in_boundary(points: DataFrame, boundary: DataFrame, x: str = "longitude", y: str = "latitude", band: float = 0.25) -> DataFrame:
    """Distinct (x, y, code): the points inside each country of `boundary` (code, polygons), outside its holes.

    A ray to the east crosses an odd number of a polygon's edges from a point inside. Points
    meet the edges of their band of y alone, by a hash join, and crossings are counted before they are
    shuffled on; no polygon is a literal in the plan.
    """
    at = points.select(x, y).distinct().withColumn("_band", F.floor(F.col(y) / band))
    crossed = ((F.col("y1") > F.col(y)) != (F.col("y2") > F.col(y))) & (F.col(x) < (F.col("x2") - F.col("x1")) * (F.col(y) - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    hits = at.join(boundary_edges(boundary, band), "_band").where(crossed).groupBy(x, y, "code", "polygon").agg(F.count("*").alias("_n"))
    return hits.where("_n % 2 = 1").select(x, y, "code").distinct()


def pivot_levels(grid: DataFrame, variables: tuple[str, ...] = ("t", "u", "v"), levels: tuple[int, ...] = (700, 850, 925)) -> DataFrame:
    """One row a (hour, cell) with a column for each variable and level, and the surface values."""
    surface = [c for c in grid.columns if c not in ("hour", "latitude", "longitude", "level", *variables)]
    return grid.groupBy("hour", "latitude", "longitude").agg(
        *[F.max(c).alias(c) for c in surface],
        *[F.max(F.when(F.col("level") == p, F.col(v))).alias(f"{v}_pressure_level_{p}") for v in variables for p in levels],
    )


def merge_grid_weather(grid: DataFrame, radars: DataFrame) -> DataFrame:
    """Weather of every covered cell and hour; coverage is decided once a cell, before the hours."""
    covered = cells_in_coverage(grid, radars)
    return pivot_levels(grid.join(covered, ["latitude", "longitude"], "left_semi"))


def site_features(grid: DataFrame, sites: DataFrame) -> DataFrame:
    """Weather of each site's nearest cell; only the rows of such cells are pivoted."""
    cells = written(nearest_grid_cells(sites, grid), "nearest")
    there = cells.selectExpr("cell_latitude as latitude", "cell_longitude as longitude").distinct()
    return pivot_levels(grid.join(there, ["latitude", "longitude"], "left_semi")).join(cells, (F.col("latitude") == F.col("cell_latitude")) & (F.col("longitude") == F.col("cell_longitude")))


def day_completeness(rows: DataFrame, features: list[str], expected_radars: int) -> DataFrame:
    """Of each day: complete (radar, hour) groups and whether all radars have all 24 hours with all features."""
    groups = rows.groupBy("radar", "hour").agg(*[F.bool_or(F.col(c).isNotNull()).alias(c) for c in features])
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(c)
    days = groups.groupBy(F.to_date("hour").alias("day")).agg(F.count("*").alias("groups"), F.count_if(whole).alias("complete"))
    return days.withColumn("ok", F.col("complete") == expected_radars * 24)


def hours_per_day(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """Distinct hours of each day of the spine (day), 0 where there is none, and whether they are 24."""
    counts = rows.groupBy(F.to_date("hour").alias("day")).agg(F.countDistinct("hour").alias("hours"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("hours", F.lit(0)).alias("hours"), (F.coalesce("hours", F.lit(0)) == 24).alias("ok"))


def coverage_box(radars: DataFrame, step: float = 0.25, margin: float = 0.25) -> DataFrame:
    """The box that holds all ranges, snapped outwards to the grid, with a margin."""
    km = F.col("max_range_m") / 1000.0
    dlat, dlon = km / KM_PER_DEGREE, km / (KM_PER_DEGREE * F.cos(F.radians("latitude")))
    up = lambda c: F.ceil(c / step) * step + margin
    down = lambda c: F.floor(c / step) * step - margin
    return radars.agg(
        up(F.max(F.col("latitude") + dlat)).alias("north"), down(F.min(F.col("longitude") - dlon)).alias("west"),
        down(F.min(F.col("latitude") - dlat)).alias("south"), up(F.max(F.col("longitude") + dlon)).alias("east"),
    )


def radar_metadata_problems(radars: DataFrame) -> DataFrame:
    """One row: how many radars there are, and the sorted names of those without a place or range."""
    bad = F.col("latitude").isNull() | F.col("longitude").isNull() | F.col("max_range_m").isNull() | (F.col("max_range_m") <= 0)
    return radars.agg(F.count("*").alias("radars"), F.array_sort(F.collect_list(F.when(bad, F.col("radar")))).alias("incomplete"))


def kernel_grid(cells: DataFrame, points: DataFrame, sigma: float = 12.0, background: float = 0.04) -> DataFrame:
    """Gaussian-weighted mean of points (row, col, value) on cells (row, col, climatology), with a background weight.

    The kernel is a product, one factor an axis, so sums go along the rows first and then along the
    columns: two hash aggregations. A place meets the rows of the grid and a partial sum its columns, never
    all cells; what goes to every task is the two axes, some thousand numbers.
    """
    axis = lambda c: F.lit(sorted(r[0] for r in cells.select(c).distinct().collect()))
    factor = lambda a, b: F.exp(-F.pow(F.col(a) - F.col(b), F.lit(2.0)) / (2 * sigma * sigma))
    both = lambda w, *names: [F.sum(w * F.col(n)).alias(n) for n in names]
    places = points.groupBy(F.col("row").alias("_r"), F.col("col").alias("_c")).agg(F.sum("value").alias("wx"), F.count("*").cast("double").alias("w"))
    down = places.withColumn("row", F.explode(axis("row"))).groupBy("row", "_c").agg(*both(factor("row", "_r"), "wx", "w"))
    across = down.withColumn("col", F.explode(axis("col"))).groupBy("row", "col").agg(*both(factor("col", "_c"), "wx", "w"))
    clim = F.greatest(F.col("climatology"), F.lit(0.01))
    sums = cells.join(across, ["row", "col"], "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return sums.select("row", "col", ((background * clim + none("wx")) / (background + none("w"))).alias("value"))
