"""Explicit schemas; nothing is inferred."""

PRICE_FILES = (
    "delivery_date date, interval_start timestamp_ntz, interval_end timestamp_ntz, "
    "price_sek_kwh double, price_eur_kwh double, eur_sek_rate double, resolution_minutes int, "
    "zone string, month string"
)
WEATHER = (
    "point string, zone string, valid_at timestamp_ntz, temperature_2m double, "
    "wind_speed_100m double, shortwave_radiation double, cloud_cover double"
)
WEATHER_SNAPSHOT = "issue_date date, fetched_at timestamp_ntz, " + WEATHER
DAY_STATUS = "zone string, day date, source string, reason string, month string"
ISSUED = (
    "zone string, delivery_date date, hour_start timestamp_ntz, hour_local int, "
    "weather_source string, q10 double, q50 double, q90 double, interval_margin double, "
    "naive_day double, issued_at timestamp_ntz, model_version string, trained_through date"
)
ZONES_SEED = "zone string, zone_name string, largest_city string"
HOLIDAYS_SEED = "holiday_date date, holiday_name string"
