"""The tourism/weather gold table from literal raw fixtures (FIXTURES.md)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from panelkit.plans import gold as GD
from panelkit.sources import dims
from tests.test_grid import DATA, DECOY, sheet_cells


def write_json(folder, name, doc):
    with open(os.path.join(folder, name), "w") as fh:
        json.dump(doc, fh)


@pytest.fixture()
def weather_dir(tmp_dir):
    # short array, missing variable, null inside array
    write_json(tmp_dir, "madrid_20160130_20160201_20240101T000000Z.json",
               {"daily": {"time": ["2016-01-30", "2016-01-31", "2016-02-01"],
                          "temperature_2m_mean": [10.0, 12.0, None], "precipitation_sum": [1.5, 0.0],
                          "precipitation_hours": [2.0, 0.0, 3.0]}})
    # an older download of the same location (dropped by latest_only)
    write_json(tmp_dir, "madrid_20160130_20160201_20230101T000000Z.json",
               {"daily": {"time": ["2016-01-30"], "temperature_2m_mean": [99.0]}})
    # a range starting in 2020 and a location with an all-NULL month
    write_json(tmp_dir, "girona_20200101_20200102_20240101T000000Z.json",
               {"daily": {"time": ["2020-01-01", "2020-01-02"], "temperature_2m_mean": [None, None]}})
    return tmp_dir


def test_silver_weather(spark, weather_dir):
    w = {(r.province, r.year_month): r for r in GD.silver_weather_monthly(spark, weather_dir).collect()}
    assert set(w) == {("Madrid", "2016-01"), ("Madrid", "2016-02"), ("Girona", "2020-01")}
    jan = w[("Madrid", "2016-01")]
    assert (jan.days, jan.temperature_2m_mean_avg, jan.precipitation_sum_total, jan.precipitation_hours_total) \
        == (2, 11.0, 1.5, 2.0)
    feb = w[("Madrid", "2016-02")]
    assert (feb.days, feb.temperature_2m_mean_avg, feb.precipitation_sum_total) == (1, None, None)
    assert w[("Girona", "2020-01")].temperature_2m_mean_avg is None
    both = GD.silver_weather_monthly(spark, weather_dir, latest_only=False)
    assert both.where("province = 'Madrid' AND year_month = '2016-01'").first().days == 3  # L2


def hotel_raw(spark):
    rows = [("2016", "1", "MADRID", "MD", " Total ", "100", "250", "2.5"),
            ("2016", "1", "MADRID", "MD", "Extranjero", "40", "90", "2.2"),
            ("2016", "2", "Madrid", "MD", "Total", "120", "NaN", "1.0"),
            ("2020", "1", "GERONA", "CT", "Total", "30", "0", "1.0"),
            ("2016", "1", "Málaga", "AN", "Total", "10", "20", "2"),
            ("2016", "1", "Atlantis", None, "Total", "1", "1", "1")]
    cols = "`AÑO` string, MES string, PROVINCIA string, CCAA string, LUGAR_RESIDENCIA string, " \
           "VIAJEROS string, PERNOCTACIONES string, ESTANCIA_MEDIA string"
    return spark.createDataFrame(rows, cols)


def test_silver_hotels(spark):
    h = {(r.province, r.year_month): r for r in GD.silver_hotels(spark, hotel_raw(spark), "h.xlsx").collect()}
    assert set(h) == {("Madrid", "2016-01"), ("Madrid", "2016-02"), ("Girona", "2020-01"),
                      ("Malaga", "2016-01"), ("Atlantis", "2016-01")}
    assert h[("Madrid", "2016-01")].hotel_overnights == 250.0
    assert h[("Madrid", "2016-02")].hotel_overnights is None  # NaN -> NULL
    assert h[("Girona", "2020-01")].hotel_overnights == 0.0
    assert len(h[("Madrid", "2016-01")]) == 16 and h[("Madrid", "2016-01")].hotel_staff is None


def holidays(spark):
    nat = [("2016-01-06", "ES", "ES", "España", "Epifanía", "national"),
           ("2016-01-01", "ES", "ES", "España", "Año Nuevo", "national")]
    reg = [("2016-01-06", "ES", "MD", "Madrid", "Epifanía", "regional"),      # repeats national
           ("2016-01-06", "ES", "MD", "Madrid", "Otra fiesta", "regional"),   # same day, other name
           ("2016-01-30", "ES", "MD", "Madrid", "Sábado", "regional"),
           ("2016-01-30", "ES", "MD", "Madrid", "Sábado", "regional"),        # exact duplicate
           ("2016-02-02", "ES", "MD", "Madrid", "Local", "local")]
    cols = "date string, country string, region_code string, region_name string, holiday_name string, scope string"
    return GD.merge_holidays(spark.createDataFrame(nat, cols), spark.createDataFrame(reg, cols))


def test_silver_holidays(spark):
    cal = GD.silver_holidays(holidays(spark))
    assert cal.count() == 5
    sat = cal.where("holiday_name = 'Sábado'").first()
    assert (sat.day_of_week, sat.is_weekend, sat.year_month) == (5, True, "2016-01")


def air_cells(spark):
    rows = (sheet_cells("01.Enero-Definitivo-2016.xls", "Notas", 0, DECOY)
            + sheet_cells("01.Enero-Definitivo-2016.xls", "Datos", 1, DATA))
    return spark.createDataFrame(rows, "source_file string, sheet_name string, sheet_index int, row int, "
                                       "col int, value string")


def test_silver_air_traffic_strict_unmapped(spark):
    with pytest.raises(ValueError):  # the fixture airports are not in the airport map
        GD.silver_air_traffic(spark, air_cells(spark)).collect()


def test_gold_table(spark, weather_dir):
    cells = air_cells(spark).withColumn(
        "value", F.regexp_replace(F.regexp_replace("value", "Madrid", "Adolfo Suarez Madrid"),
                                  "Extra Aeropuerto", "Menorca"))
    cells = cells.withColumn("value", F.regexp_replace("value", "Palma[ /-]+Mallorca", "Palma de Mallorca"))
    air = GD.silver_air_traffic(spark, cells)
    got = {r.airport_normalized: (r.province, r.year_month, r.passengers, r.airport_name) for r in air.collect()}
    assert got["ADOLFO SUAREZ MADRID-BARAJAS"] == ("Madrid", "2016-01", 120, "Adolfo Suarez Madrid-Barajas")
    by_prov = GD.silver_air_traffic_by_province(air)
    weather = GD.silver_weather_monthly(spark, weather_dir)
    hotels = GD.silver_hotels(spark, hotel_raw(spark), "h.xlsx")
    gold = GD.gold_monthly_features(spark, weather, GD.silver_holidays(holidays(spark)), by_prov, hotels)
    rows = {(r.province, r.year_month): r for r in gold.collect()}
    assert len(gold.columns) == 31 and len(rows) == weather.count()
    jan = rows[("Madrid", "2016-01")]
    assert (jan.region_code, jan.national_holiday_count, jan.regional_holiday_count, jan.total_holiday_count) \
        == ("MD", 2, 2, 4)
    assert (jan.aena_passengers, jan.aena_airport_count, jan.hotel_overnights, jan.target_available) \
        == (120, 1, 250.0, True)
    feb = rows[("Madrid", "2016-02")]
    assert (feb.aena_passengers, feb.hotel_overnights, feb.target_available) == (0, None, False)
    gir = rows[("Girona", "2020-01")]
    assert (gir.region_code, gir.hotel_overnights, gir.target_available) == ("CT", 0.0, True)  # L5
    assert gold.select(F.countDistinct("province", "year_month")).first()[0] == gold.count()


def test_dimensions_sizes(spark):
    sizes = {n: dims.dimension(spark, n).count() for n in
             ["locations", "regions", "province_regions", "province_aliases", "airport_provinces"]}
    assert sizes == {"locations": 52, "regions": 19, "province_regions": 52, "province_aliases": 17,
                     "airport_provinces": 58}


def test_modelling_frame_prepares_99_columns(spark):
    from panelkit.operators.features import named_features

    places = dims.dimension(spark, "province_regions").select("province", "region_code")
    months = spark.range(20).select(F.date_format(F.add_months(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
                                                  "yyyy-MM").alias("year_month"), F.col("id").alias("m"))
    n = F.pmod(F.xxhash64("province", "m"), F.lit(97))
    gold = places.crossJoin(months).withColumns({   # 52 provinces, 20 months: a bounded fixture
        "temperature_2m_mean_avg": n * 0.35, "precipitation_sum_total": n * 1.1, "hotel_overnights": F.when(n > 2, n * 10.0),
        "aena_passengers": n * 100, "month": F.lit(0)})
    for c in GD.MODEL_NUMERIC:
        if c not in gold.columns and c not in ("quarter", "is_high_season", "aena_passengers_log1p",
                                               "temperature_2m_mean_sq", "precipitation_sqrt"):
            gold = gold.withColumn(c, F.when(n != 5, n * 1.0))
    frame = GD.modelling_frame(gold)
    assert frame.where("hotel_overnights IS NULL").count() == 0
    assert {r.demand_segment for r in frame.select("demand_segment").distinct().collect()} == set(GD.DEMAND_SEGMENTS)
    train, test, prep = GD.prepare_model_data(gold)
    assert len(prep.names) == 99 and len(GD.MODEL_NUMERIC) == 21 and prep.names[:21] == GD.MODEL_NUMERIC
    assert train.select("year_month").distinct().count() == 16 and test.select("year_month").distinct().count() == 4
    per_row = named_features(prep.transform(test), prep.names, ["year_month", "province"]) \
        .groupBy("year_month", "province").agg(F.count("*").alias("n"), F.sum(F.expr(
            "IF(feature LIKE 'province_%', value, 0)")).alias("p"))
    assert {(r.n, r.p) for r in per_row.collect()} == {(99, 1.0)}


def test_output_stems(spark):
    from panelkit.functions.dates import output_stem

    rows = [("Air traffic (2015)", 2015, 10, 2024, 12), ("Hotel-occupancy", 2015, None, 2024, 12), ("x", 2015, 1, 2015, 2)]
    df = spark.createDataFrame(rows, "name string, y1 int, m1 int, y2 int, m2 int")
    got = [r[0] for r in df.select(output_stem("name", "y1", "m1", "y2", "m2")).collect()]
    assert got == ["air_traffic_2015_201510_202412", "hotel_occupancy", "x_201501_201502"]
    assert df.select(output_stem("name")).first()[0] == "air_traffic_2015"


def test_lake_layers_can_be_repeated(spark, tmp_dir):
    from panelkit.plans import lake

    sf = "/root/testdata/sf0.001"
    names = lake.run_lake(spark, sf, tmp_dir, "repeat")
    try:
        first = sorted(map(str, spark.table("repeat_gold_panel").collect()))
        lake.gold(spark, tmp_dir)    # from the silver layer alone
        again = spark.read.parquet(f"{tmp_dir}/gold/panel")
        assert sorted(map(str, again.collect())) == first
        assert {n.split("_", 1)[1] for n in names} == {"gold_panel", *(f"silver_{n}" for n in lake.SILVER)}
        twice = spark.read.parquet(f"{tmp_dir}/silver/target").limit(1)
        twice.write.mode("append").parquet(f"{tmp_dir}/silver/target")
        with pytest.raises(ValueError, match="repeats a key"):
            lake.gold(spark, tmp_dir)
    finally:
        for n in names:
            spark.sql(f"DROP TABLE {n}")
