"""Raw documents made from a price panel that Spark computes."""

import json
import os
from collections import defaultdict
from datetime import UTC, date, datetime, timedelta
from functools import cache
from pathlib import Path
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from zonecast.config import MARKET_TZ, WEATHER_POINTS, WEATHER_VARIABLES
from zonecast.session import local_session

LOCAL = ZoneInfo(MARKET_TZ)
RATE = 11.5  # kronor a euro, the same every day


def day_bounds(day: date) -> tuple[datetime, datetime]:
    """First instant of a local day and of the next one, in UTC."""
    first, last = (datetime.combine(d, datetime.min.time(), LOCAL) for d in (day, day + timedelta(days=1)))
    return first.astimezone(UTC), last.astimezone(UTC)


@cache
def _price_panel(minutes: int, seed: int) -> dict[date, list[tuple[datetime, float]]]:
    """Instants and prices of each local day of three years: a daily wave and a hash for noise."""
    times = f"sequence(timestamp'2023-12-30', timestamp'2026-12-31', interval {minutes} minutes)"
    noise = F.pmod(F.xxhash64("t", F.lit(seed)), F.lit(1000)) / 2500
    wave = F.cos(F.hour("t") * 3.14159 / 12) / 5
    panel = local_session().range(1).select(F.explode(F.expr(times)).alias("t")).select(
        F.unix_seconds("t").alias("s"), F.round(0.7 + wave + noise, 4).alias("price")
    )
    days = defaultdict(list)
    for r in panel.collect():
        at = datetime.fromtimestamp(r["s"], LOCAL)
        days[at.date()].append((at, r["price"]))
    return days


def day_document(day: date, minutes: int = 60, seed: int = 0, scale: float = 1.0) -> list[dict]:
    """The records of one raw price day."""
    length = timedelta(minutes=minutes)
    out = []
    for at, price in _price_panel(minutes, seed)[day]:
        end = (at.astimezone(UTC) + length).astimezone(LOCAL)
        kronor = round(price * scale, 5)
        out.append(dict(SEK_per_kWh=kronor, EUR_per_kWh=round(kronor / RATE, 5), EXR=RATE, time_start=at.isoformat(), time_end=end.isoformat()))
    return out


@cache
def _weather_panel(first: date, last: date, seed: int) -> str:
    hours = F.expr(f"sequence(timestamp'{first}', timestamp'{last} 23:00:00', interval 1 hour)")
    value = lambda name, point: F.transform(
        "h", lambda t: F.round(F.pmod(F.xxhash64(t, F.lit(name), F.lit(point), F.lit(seed)), F.lit(2400)) / 100 - 4, 2)
    )
    points = [
        F.struct(
            F.lit(lat).alias("latitude"),
            F.lit(lon).alias("longitude"),
            F.struct(
                F.transform("h", lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm")).alias("time"),
                *[value(v, name).alias(v) for v in WEATHER_VARIABLES],
            ).alias("hourly"),
        )
        for name, _, lat, lon in WEATHER_POINTS
    ]
    return local_session().range(1).select(hours.alias("h")).select(F.to_json(F.array(*points))).first()[0]


def point_document(first: date, last: date, seed: int = 0) -> list[dict]:
    """A weather payload of every point for the hours of first..last."""
    return json.loads(_weather_panel(first, last, seed))


def put(path: Path, document: object) -> None:
    os.makedirs(path.parent, exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        json.dump(document, out)
