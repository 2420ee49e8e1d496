"""Pieces of the comparison SQL: clock conversions, rounding and the shared panels as CTEs."""

from __future__ import annotations

from zonecast.config import MARKET_TZ
from zonecast.plans.shape import NUDGE

# Fixed values of the holiday comparison, stated apart from the engine's: month-day or days after Easter Sunday, the name,
# and the first and last year of a holiday that came or went.
_ON_DATE = (
    ("01-01", "Nyårsdagen", 0, 9999),
    ("01-06", "Trettondedag jul", 0, 9999),
    ("05-01", "Första maj", 0, 9999),
    ("06-06", "Nationaldagen", 2005, 9999),
    ("12-25", "Juldagen", 0, 9999),
    ("12-26", "Annandag jul", 0, 9999),
)
_AFTER_EASTER = (
    (-2, "Långfredagen", 0, 9999),
    (0, "Påskdagen", 0, 9999),
    (1, "Annandag påsk", 0, 9999),
    (39, "Kristi himmelsfärdsdag", 0, 9999),
    (49, "Pingstdagen", 0, 9999),
    (50, "Annandag pingst", 0, 2004),
)
_SATURDAY_FROM = (("06-20", "Midsommardagen"), ("10-31", "Alla helgons dag"))


def LOCAL(utc: str) -> str:
    return f"timezone('{MARKET_TZ}', timezone('UTC', {utc}))"


def UTC(local: str) -> str:
    return f"timezone('UTC', timezone('{MARKET_TZ}', {local}))"


def R6(value: str) -> str:
    return f"round(({value}) + {NUDGE!r}, 6)"


def with_ctes(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


INTERVALS = f"""intervals as (
    select zone, interval_start, cast({LOCAL('interval_start')} as date) as delivery_date,
           {LOCAL('interval_start')} as interval_start_local,
           interval_start + interval 15 minutes as interval_end,
           15 as resolution_minutes, price_sek_kwh
    from (select event_type as zone, time_bucket(interval 15 minutes, ts) as interval_start,
                 cast(sum(cast(value as decimal(18,2))) as double) / count(*) - 20.0 as price_sek_kwh
          from events group by all))"""

HOURLY = f"""hourly as (
    select zone, delivery_date, hour_start, hour({LOCAL('hour_start')}) as hour_local,
           price_sek_kwh, n_intervals
    from (select zone, delivery_date, date_trunc('hour', interval_start) as hour_start,
                 avg(price_sek_kwh) as price_sek_kwh, count(*) as n_intervals
          from intervals group by all))"""

DAILY_PANEL = """hourly as (
    select o_orderpriority as zone, cast(o_orderdate as date) as delivery_date,
           cast(cast(o_orderdate as date) as timestamp) as hour_start, 0 as hour_local,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 100000.0 as price_sek_kwh
    from orders group by all)"""


def HOLIDAYS(years: str) -> str:
    """Holiday table for a query of years (column y); Easter by the paschal full moon of Gauss's rule."""
    rows = " union all ".join(
        [f"select cast(y || '-{d}' as date) as day, '{n}' as name from sundays where y between {a} and {z}" for d, n, a, z in _ON_DATE]
        + [f"select easter + {k}, '{n}' from sundays where y between {a} and {z}" for k, n, a, z in _AFTER_EASTER]
        + [
            f"select unnest(range(cast(y || '-{d}' as date), cast(y || '-{d}' as date) + 7, interval 1 day))::date, '{n}' from sundays"
            for d, n in _SATURDAY_FROM
        ]
    )
    return f"""holiday_years as ({years}),
    moons as (
        select y, (15 + y // 100 - y // 400 - (8 * (y // 100) + 13) // 25 + 19 * (y % 19)) % 30 as d from holiday_years),
    full_moons as (
        -- Days after 21 March; the two late moons are moved back a day.
        select y, make_date(y, 3, 21) + cast(d - (d = 29 or (d = 28 and y % 19 > 10))::int as int) as moon from moons),
    sundays as (select y, moon + cast(7 - isodow(moon) % 7 as int) as easter from full_moons),
    holidays as (
        select day as holiday_date, name || case when isodow(day) = 7 then '; Söndag' else '' end as holiday_name
        from ({rows}) where isodow(day) = 6 or name not in ({", ".join(repr(n) for _, n in _SATURDAY_FROM)}))"""

WEATHER = f"""event_weather as (
    select event_type || '-' || case when user_id < 75 then 'low' else 'high' end as point, event_type as zone,
           date_trunc('hour', ts) as hour,
           avg(cast(props ->> '$.k' as integer)) - 40.0 as temperature_2m,
           avg(cast(props ->> '$.k' as integer)) / 5.0 as wind_speed_100m,
           avg(user_id) as shortwave_radiation,
           cast(max(cast(props ->> '$.k' as integer)) as double) as cloud_cover
    from events group by all),
horizon as (select max(delivery_date) as last_day from hourly),
offers as (
    -- Each reading is offered twice: for its own hour, and a day ahead as what was forecast then.
    select zone, hour + to_days(ahead) as valid_at, ahead = 1 as foreseen,
           cast({LOCAL('hour')} as date) as made_on, temperature_2m, wind_speed_100m, shortwave_radiation, cloud_cover
    from event_weather, (select unnest([0, 1]) as ahead)),
usable as (
    select o.* from offers as o, horizon
    where not foreseen or made_on <= last_day
    qualify not foreseen or made_on = max(made_on) over (partition by foreseen)),
weather as (
    select zone, valid_at, avg(temperature_2m) as temperature_c, avg(wind_speed_100m) as wind_100m_ms,
           avg(shortwave_radiation) as solar_w_m2, avg(cloud_cover) as cloud_cover_pct,
           case when foreseen then 'forecast' else 'archive' end as weather_source
    from usable, horizon
    where foreseen = (cast({LOCAL('valid_at')} as date) > last_day)
    group by zone, valid_at, foreseen)"""

# What a feature row gets from a fact, by name; a fact is a value with the day it serves and, where it is bound to
# them, the zone, the local hour and the instant.
_FACTS = (
    "lag_1d", "lag_2d", "lag_7d", "prev_day_mean", "prev_day_min", "prev_day_max", "prev_day_std",
    "prev_day_peak_mean", "prev_week_mean", "prev_day_mean_change", "prev_click_mean", "prev_purchase_mean",
    "prev_view_mean", "temperature_c", "wind_100m_ms", "solar_w_m2", "cloud_cover_pct", "north_wind_ms",
    "target_day_temp_c", "target_day_wind_ms",
)


def features(source: str, tag: str) -> str:
    """CTE ``features_<tag>`` from the hourly CTE named ``source``: facts sent forward to the days they serve, then pivoted."""
    pivot = ", ".join(f"{R6(f'max(value) filter (name = {name!r})')} as {name}" for name in _FACTS)
    return f"""prices_{tag} as (
    select zone, delivery_date as day, list(struct_pack(h := hour_local, p := price_sek_kwh)) as xs from {source} group by all),
means_{tag} as (select zone, day, list_avg([x.p for x in xs]) as mean from prices_{tag}),
facts_{tag} as (
    select 'lag_' || k || 'd' as name, zone, delivery_date + k as day, hour_local as hour,
           cast(null as timestamp) as instant, avg(price_sek_kwh) as value
    from {source}, (select unnest([1, 2, 7]) as k) group by zone, delivery_date, hour_local, k
    union all
    select 'prev_day_' || unnest(['mean', 'min', 'max', 'std', 'peak_mean']), zone, day + 1, null, null,
           unnest([list_avg([x.p for x in xs]), list_min([x.p for x in xs]), list_max([x.p for x in xs]),
                   list_stddev_samp([x.p for x in xs]), list_avg([x.p for x in xs if x.h >= 17 and x.h <= 20])])
    from prices_{tag}
    union all
    -- A day's mean is a part of the means of the seven days after it, where the day before is there too.
    select 'prev_week_mean', m.zone, m.day + k, null, null, avg(m.mean)
    from means_{tag} as m, (select unnest([1, 2, 3, 4, 5, 6, 7]) as k)
    where exists (select 1 from means_{tag} as p where p.zone = m.zone and p.day = m.day + k - 1)
    group by m.zone, m.day + k
    union all
    select 'prev_day_mean_change', m.zone, m.day + 1, null, null, m.mean - p.mean
    from means_{tag} as m asof join means_{tag} as p on p.zone = m.zone and p.day < m.day
    union all
    select 'prev_' || zone || '_mean', null, day + 1, null, null, mean
    from means_{tag} where zone in ('click', 'purchase', 'view')
    union all
    select unnest(['temperature_c', 'wind_100m_ms', 'solar_w_m2', 'cloud_cover_pct']), zone,
           cast({LOCAL('valid_at')} as date), null, valid_at,
           unnest([temperature_c, wind_100m_ms, solar_w_m2, cloud_cover_pct]) from weather
    union all
    select 'north_wind_ms', null, cast({LOCAL('valid_at')} as date), null, valid_at, avg(wind_100m_ms)
    from weather where zone in ('click', 'error') group by valid_at
    union all
    select unnest(['target_day_temp_c', 'target_day_wind_ms']), zone, day, null, null, unnest([t, w])
    from (select zone, cast({LOCAL('valid_at')} as date) as day, avg(temperature_c) as t, avg(wind_100m_ms) as w
          from weather group by all)),
span_{tag} as (select min(delivery_date) + 7 as first_day, max(delivery_date) + 1 as coming from {source}),
slots_{tag} as (
    select zone, delivery_date, hour_start, hour_local, price_sek_kwh from {source}
    union all
    -- The coming day's hours, counted in UTC so that a clock change makes it shorter or longer.
    select zone, coming, h, hour({LOCAL('h')}), null
    from (select unnest(list_distinct(list(event_type))) as zone from events), span_{tag},
         generate_series({UTC('cast(coming as timestamp)')}, {UTC('cast(coming + 1 as timestamp)')} - interval 1 hour, interval 1 hour) as g(h)),
features_{tag} as (
    select s.zone, s.delivery_date, s.hour_start, cast(s.hour_local as bigint) as hour_local,
           s.delivery_date - 1 as issue_date, {R6('any_value(s.price_sek_kwh)')} as target_price,
           isodow(s.delivery_date) as iso_dow, month(s.delivery_date) as month,
           isodow(s.delivery_date) in (6, 7) as is_weekend, bool_or(o.holiday_date is not null) as is_holiday,
           isodow(s.delivery_date) not in (6, 7) and bool_and(o.holiday_date is null) as is_workday,
           any_value(w.weather_source) as weather_source, {pivot}
    from slots_{tag} as s cross join span_{tag} as b
    left join (select distinct holiday_date from holidays) as o on o.holiday_date = s.delivery_date
    left join weather as w on w.zone = s.zone and w.valid_at = s.hour_start
    left join facts_{tag} as f on f.day = s.delivery_date and coalesce(f.zone, s.zone) = s.zone
      and coalesce(f.hour, s.hour_local) = s.hour_local and coalesce(f.instant, s.hour_start) = s.hour_start
    where s.delivery_date >= b.first_day
    group by s.zone, s.delivery_date, s.hour_start, s.hour_local)"""
