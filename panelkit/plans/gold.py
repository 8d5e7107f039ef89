"""Silver and gold tables of the tourism/weather panel from the raw sources
(weather JSON documents, hotel statistics table, holiday calendar, airport
cell grids), composed from panelkit operators.

Every function returns a lazy DataFrame conformed to its declared schema in
:mod:`panelkit.schemas`; writing is left to :func:`sources.sinks.write_table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import schemas
from panelkit.functions.dates import calendar_columns, date_parts, year_month
from panelkit.functions.numeric import bucket, clean_number, log1p_clipped, sqrt_clipped
from panelkit.functions.text import strip_ws, title_case
from panelkit.operators import grid as G
from panelkit.operators.joins import Side, drop_known, feature_panel, latest_per_key, lookup, resolve_alias, unmapped
from panelkit.operators.rollups import monthly_rollup, parent_rollup, scoped_counts
from panelkit.session import stored
from panelkit.sources.dims import DAILY_WEATHER_VARS, GOLD_FEATURE_SOURCE, NATIONAL_REGION_CODE, dimension
from panelkit.sources.files import file_fields, read_daily_json
from panelkit.sources.sinks import conform

SUM_VARS = [v for v in DAILY_WEATHER_VARS if v.endswith("_sum") or v == "precipitation_hours"]
AVG_VARS = [v for v in DAILY_WEATHER_VARS if v not in SUM_VARS]

# Raw hotel statistics columns -> silver names.
HOTEL_COLUMNS = {
    "VIAJEROS": "hotel_travelers", "PERNOCTACIONES": "hotel_overnights", "ESTANCIA_MEDIA": "hotel_avg_stay",
    "ESTABLECIMIENTOS_ESTIMADOS": "hotel_establishments_estimated",
    "HABITACIONES_ESTIMADAS": "hotel_rooms_estimated", "PLAZAS_ESTIMADAS": "hotel_beds_estimated",
    "GRADO_OCUPA_PLAZAS": "hotel_occupancy_rate",
    "GRADO_OCUPA_PLAZAS_FIN_SEMANA": "hotel_weekend_occupancy_rate",
    "GRADO_OCUPA_POR_HABITACIONES": "hotel_room_occupancy_rate", "PERSONAL_EMPLEADO": "hotel_staff",
}


def weather_daily(spark: SparkSession, path: str, latest_only: bool = True) -> DataFrame:
    """One row per location and day; location code -> province
    (unknown codes pass through). ``latest_only`` keeps only the newest
    download per location and date range (greatest file name), so
    re-downloads do not double the days (ledger L2) and files of different
    ranges all count."""
    daily = read_daily_json(spark, path, DAILY_WEATHER_VARS)
    if latest_only:
        # location and range: the file name up to its second date
        span = F.regexp_extract("source_file", r"^(.*?_\d{8}_\d{8})", 1)
        key = F.coalesce(F.nullif(span, F.lit("")), "source_file")
        daily = daily.withColumn("__key", key)
        newest = daily.groupBy("__key").agg(F.max("source_file").alias("source_file"))
        daily = daily.join(newest, ["__key", "source_file"], "left_semi").drop("__key")
    loc = dimension(spark, "locations").select(F.col("code").alias("location_code"), "province")
    daily = lookup(daily, loc, "location_code", {"province": "location_code"})
    return daily.withColumns({"date": F.col("time"), "year_month": F.substring("time", 1, 7)})


def silver_weather_monthly(spark: SparkSession, path: str, latest_only: bool = True) -> DataFrame:
    """A1: daily weather -> (province, month)."""
    monthly = monthly_rollup(weather_daily(spark, path, latest_only), ["province", "year_month"],
                             AVG_VARS, SUM_VARS, count_as="days")
    return conform(monthly, schemas.SILVER_WEATHER_MONTHLY)


def normalize_province(spark: SparkSession, df: DataFrame, col: str) -> DataFrame:
    """Alias map -> accent-folded canonical name -> raw trimmed value."""
    aliases = dimension(spark, "province_aliases").select("alias", F.col("province").alias("target"))
    canonical = dimension(spark, "province_regions").select(F.col("province").alias("name"))
    return resolve_alias(df, col, aliases, canonical)


def silver_hotels(spark: SparkSession, raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """Hotel statistics rows whose trimmed ``LUGAR_RESIDENCIA`` is
    ``Total``, renamed and typed; NaN/unparsable numbers -> NULL, rounded 4."""
    rows = raw.where(strip_ws("LUGAR_RESIDENCIA") == "Total")
    rows = normalize_province(spark, rows, "PROVINCIA")
    year = F.col("AÑO").cast("double").cast("int")
    month = F.col("MES").cast("double").cast("int")
    metrics = {v: clean_number(F.expr(f"try_cast(`{k}` AS DOUBLE)") if k in raw.columns else F.lit(None))
               for k, v in HOTEL_COLUMNS.items()}
    src = F.lit(source_file) if source_file else (F.col("source_file") if "source_file" in raw.columns
                                                   else F.lit(None).cast("string"))
    out = rows.select(F.col("PROVINCIA").alias("province"), year.alias("year"), month.alias("month"),
                      year_month(year, month).alias("year_month"),
                      (F.col("CCAA").cast("string") if "CCAA" in raw.columns else F.lit(None)).alias("ccaa"),
                      *[c.alias(n) for n, c in metrics.items()], src.alias("source_file"))
    return conform(out, schemas.SILVER_HOTEL_BY_PROVINCE)


def merge_holidays(national: DataFrame, regional: DataFrame) -> DataFrame:
    """National rows + regional rows that do not repeat a national
    (date, name), deduplicated on (date, region, name, scope)."""
    keep = drop_known(regional, national.select("date", "holiday_name"), ["date", "holiday_name"])
    return national.unionByName(keep).dropDuplicates(["date", "region_code", "holiday_name", "scope"])


def silver_holidays(calendar: DataFrame) -> DataFrame:
    """F-D1: calendar enriched with year, month, year_month, weekday (Mon=0), weekend."""
    out = calendar_columns(calendar.withColumn("date", F.col("date").cast("string")), "date")
    return conform(out, schemas.SILVER_HOLIDAYS)


def silver_air_traffic(spark: SparkSession, cells: DataFrame, strict: bool = True) -> DataFrame:
    """G1-G4 + S2 + J3: airport-month rows from workbook cells. Unparsable
    file names and unmapped airports fail the job when ``strict``."""
    heads = stored(G.sheet_heads(cells), "sheet-heads")
    titles = stored(G.find_title_rows(cells, strict=strict, heads=heads), "titles")
    pairs = stored(G.pair_blocks(G.head_cells(heads), titles, strict=strict), "pairs")
    tidy = G.pivot_blocks(G.extract_blocks(cells, pairs, strict=strict))
    airports = dimension(spark, "airport_provinces")
    tidy = tidy.withColumnRenamed("entity_name", "airport_normalized")
    if strict:
        unmapped(tidy, airports, "airport_normalized", strict=True)
    f = file_fields("source_file", strict=strict)
    out = (tidy.join(airports, "airport_normalized", "left")
               .join(titles.select("source_file", F.col("sheet_name").alias("source_sheet")), "source_file")
               .withColumns({"year": f["file_year"], "month": f["file_month"]}))
    out = out.withColumns({"year_month": year_month("year", "month"),
                           "airport_name": title_case("airport_normalized")})
    return conform(out, schemas.SILVER_AIR_TRAFFIC)


def silver_air_traffic_by_province(air: DataFrame) -> DataFrame:
    """A2: airport-month -> province-month: 3 sums + airport count."""
    out = parent_rollup(air, ["province", "year_month"], ["passengers", "operations", "cargo_kg"],
                        count_as="airport_count")
    return conform(out, schemas.SILVER_AIR_TRAFFIC_BY_PROVINCE)


def gold_monthly_features(spark: SparkSession, weather: DataFrame, holidays: DataFrame | None = None,
                          air_by_province: DataFrame | None = None, hotels: DataFrame | None = None) -> DataFrame:
    """One gold row per weather row (L25). Holiday counts and airport
    metrics default to 0, hotel columns stay NULL, ``target_available`` is
    ``hotel_overnights IS NOT NULL`` (L5). Missing optional sources give the
    defaults, as in the reference."""
    regions = dimension(spark, "province_regions")
    sides = [Side(regions, ["province"], ["region_code"])]
    if holidays is not None:
        counts = scoped_counts(holidays, ["year_month", "region_code"], "scope", ["national", "regional"])
        national = counts.where(F.col("region_code") == NATIONAL_REGION_CODE).select(
            "year_month", F.col("n").alias("national_holiday_count"))
        regional = counts.where(F.col("region_code") != NATIONAL_REGION_CODE).select(
            "year_month", "region_code", F.col("n").alias("regional_holiday_count"))
        sides += [Side(national, ["year_month"], ["national_holiday_count"], {"national_holiday_count": 0}),
                  Side(regional, ["year_month", "region_code"], ["regional_holiday_count"],
                       {"regional_holiday_count": 0})]
    if air_by_province is not None:
        ren = {"passengers": "aena_passengers", "operations": "aena_operations", "cargo_kg": "aena_cargo_kg",
               "airport_count": "aena_airport_count"}
        sides.append(Side(air_by_province, ["province", "year_month"], list(ren), {v: 0 for v in ren.values()},
                          rename=ren))
    if hotels is not None:
        hcols = list(HOTEL_COLUMNS.values())
        # One hotel row per key; the greatest (source_file, year, month) wins.
        # Rows of one file are told apart by their values, so the choice is the
        # same under any partitioning.
        h = latest_per_key(hotels.select("province", "year_month", "source_file", *hcols),
                           ["province", "year_month"], ["source_file", *hcols])
        sides.append(Side(h, ["province", "year_month"], hcols))
    panel = feature_panel(weather, sides)
    for c in ["national_holiday_count", "regional_holiday_count", "aena_passengers", "aena_operations",
              "aena_cargo_kg", "aena_airport_count"]:
        if c not in panel.columns:
            panel = panel.withColumn(c, F.lit(0))
    panel = panel.withColumns({
        "total_holiday_count": F.col("national_holiday_count") + F.col("regional_holiday_count"),
        "target_available": (F.col("hotel_overnights").isNotNull() if "hotel_overnights" in panel.columns
                             else F.lit(False)),
        "feature_source": F.lit(GOLD_FEATURE_SOURCE),
    })
    return conform(panel, schemas.GOLD_MONTHLY_FEATURES, strict=False)


# The modelling frame's features, targets and bucket edges.
TARGET = "hotel_overnights"
MODEL_NUMERIC = """temperature_2m_mean_avg temperature_2m_max_avg temperature_2m_min_avg precipitation_sum_total
    rain_sum_total precipitation_hours_total wind_speed_10m_mean_avg wind_speed_10m_max_avg national_holiday_count
    regional_holiday_count total_holiday_count aena_passengers aena_operations aena_cargo_kg aena_airport_count
    month quarter is_high_season aena_passengers_log1p temperature_2m_mean_sq precipitation_sqrt""".split()
MODEL_CATEGORICAL = ["province", "region_code", "temperature_bucket", "precipitation_bucket"]
TEMPERATURE_BUCKETS = ([float("-inf"), 10.0, 18.0, 25.0, float("inf")], ["cold", "mild", "warm", "hot"])
PRECIPITATION_BUCKETS = ([-0.001, 20.0, 80.0, float("inf")], ["dry", "normal", "rainy"])
DEMAND_SEGMENTS = ["low", "medium", "high", "very_high"]


def modelling_frame(gold: DataFrame, segments: bool = True) -> DataFrame:
    """Gold rows with a target, calendar parts, transforms, buckets and (``segments``) demand quartiles."""
    from panelkit.operators.features import quantile_bucket

    out = date_parts(gold.dropna(subset=[TARGET]), "year_month")
    out = out.withColumns({
        "hotel_overnights_log1p": F.log1p(TARGET), "aena_passengers_log1p": log1p_clipped("aena_passengers"),
        "precipitation_sqrt": sqrt_clipped("precipitation_sum_total"),
        "temperature_2m_mean_sq": F.col("temperature_2m_mean_avg") * F.col("temperature_2m_mean_avg"),
        "temperature_bucket": bucket("temperature_2m_mean_avg", *TEMPERATURE_BUCKETS),
        "precipitation_bucket": bucket("precipitation_sum_total", *PRECIPITATION_BUCKETS)})
    return quantile_bucket(out, TARGET, DEMAND_SEGMENTS, "demand_segment") if segments else out


def prepare_model_data(gold: DataFrame, ratio: float = 0.8):
    """(train, test, fitted preparation); whole months, statistics from the train months only."""
    from panelkit.operators.features import Preparation, train_test

    train, test = train_test(modelling_frame(gold, segments=False), "year_month", ratio)
    return train, test, Preparation.fit(train, MODEL_NUMERIC, MODEL_CATEGORICAL)
