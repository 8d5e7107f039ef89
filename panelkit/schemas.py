"""One schema per table: the single source of truth used to read, write and
catalogue the silver and gold layers (S17, FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import types as T

# Declared column names and types of the catalogued tables.
SILVER_WEATHER_MONTHLY = """province string, year_month string, days int,
    temperature_2m_mean_avg double, temperature_2m_max_avg double, temperature_2m_min_avg double,
    precipitation_sum_total double, rain_sum_total double, precipitation_hours_total double,
    wind_speed_10m_mean_avg double, wind_speed_10m_max_avg double"""

SILVER_HOTEL_BY_PROVINCE = """province string, year int, month int, year_month string, ccaa string,
    hotel_travelers double, hotel_overnights double, hotel_avg_stay double,
    hotel_establishments_estimated double, hotel_rooms_estimated double, hotel_beds_estimated double,
    hotel_occupancy_rate double, hotel_weekend_occupancy_rate double, hotel_room_occupancy_rate double,
    hotel_staff double, source_file string"""

SILVER_HOLIDAYS = """date string, country string, region_code string, region_name string,
    holiday_name string, scope string, year int, month int, year_month string,
    day_of_week int, is_weekend boolean"""

SILVER_AIR_TRAFFIC = """year int, month int, year_month string, airport_name string,
    airport_normalized string, province string, passengers bigint, operations bigint,
    cargo_kg bigint, source_file string, source_sheet string"""

SILVER_AIR_TRAFFIC_BY_PROVINCE = """province string, year_month string, passengers bigint,
    operations bigint, cargo_kg bigint, airport_count int"""

GOLD_MONTHLY_FEATURES = """province string, year_month string, days int,
    temperature_2m_mean_avg double, temperature_2m_max_avg double, temperature_2m_min_avg double,
    precipitation_sum_total double, rain_sum_total double, precipitation_hours_total double,
    wind_speed_10m_mean_avg double, wind_speed_10m_max_avg double, region_code string,
    national_holiday_count int, regional_holiday_count int, total_holiday_count int,
    aena_passengers bigint, aena_operations bigint, aena_cargo_kg bigint, aena_airport_count int,
    hotel_travelers double, hotel_overnights double, hotel_avg_stay double,
    hotel_establishments_estimated double, hotel_rooms_estimated double, hotel_beds_estimated double,
    hotel_occupancy_rate double, hotel_weekend_occupancy_rate double, hotel_room_occupancy_rate double,
    hotel_staff double, target_available boolean, feature_source string"""

LANDING_MANIFEST = """source string, name string, url string, downloaded_at string,
    overwrite_mode boolean, content_type string, bytes_written bigint, local_path string,
    detected_format string, original_content_type string"""

CELL_TABLE = """source_file string, sheet_name string, sheet_index int, row int, col int, value string"""

FILE_INVENTORY = """file_name string, suffix string, bytes bigint, modified_at timestamp"""

# name -> (relative location, DDL)
CATALOG = {
    "silver_open_meteo_monthly": ("silver/open_meteo_monthly", SILVER_WEATHER_MONTHLY),
    "silver_dataestur_hotel_occupancy_by_province": ("silver/hotel_occupancy_by_province",
                                                     SILVER_HOTEL_BY_PROVINCE),
    "silver_holidays_calendar": ("silver/holidays_calendar", SILVER_HOLIDAYS),
    "silver_aena_monthly_air_traffic": ("silver/air_traffic", SILVER_AIR_TRAFFIC),
    "silver_aena_monthly_air_traffic_by_province": ("silver/air_traffic_by_province",
                                                    SILVER_AIR_TRAFFIC_BY_PROVINCE),
    "gold_tourism_weather_monthly_features": ("gold/monthly_features", GOLD_MONTHLY_FEATURES),
}


def struct(ddl: str) -> T.StructType:
    """Parse a DDL column list into a ``StructType``."""
    return T._parse_datatype_string(" ".join(ddl.split()))


def columns(ddl: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in struct(ddl).fields]
