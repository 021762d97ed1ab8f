"""Profiles, travel windows and recommendations, with historical means as the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.operators import profiles as pf
from tidemark.operators import reports
from tidemark.plans.registry import query, rounded, tidy, wide_ints
from tidemark.plans.standins import HOURLY_TYPE_SQL, TIDY_SQL, hourly_by_type, tidy_readings

_WEATHER = {"click": "Clear", "view": "Clouds", "purchase": "Rain", "signup": "Mist", "error": "Snow"}
_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _WEATHER.items())

_PROFILES = f"""WITH {HOURLY_TYPE_SQL},
named AS (SELECT *, CASE event_type {_CASES} END AS weather_main,
  CASE is_weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS day_type FROM he),
single AS (SELECT day_type, weather_main, hour, avg(traffic_volume) AS volume FROM named GROUP BY ALL),
freq AS (SELECT weather_main, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM named) AS frequency FROM named GROUP BY 1),
p AS (
  SELECT day_type, weather_main AS weather_condition, hour, volume FROM single
  UNION ALL
  SELECT day_type, '{vocab.TYPICAL_MIX}', hour, sum(volume * frequency) FROM single JOIN freq USING (weather_main) GROUP BY ALL)"""

KEYS = ["day_type", "weather_condition"]


def _named(spark, sf):
    weather = None
    for kind, name in _WEATHER.items():
        test = F.col("event_type") == kind
        weather = F.when(test, name) if weather is None else weather.when(test, name)
    day = F.when(F.col("is_weekend") == 1, "weekend").otherwise("weekday")
    return hourly_by_type(spark, sf).withColumns({"weather_main": weather, "day_type": day})


def scenario_profiles_of(spark, sf):
    named = _named(spark, sf)
    single = named.groupBy("day_type", "weather_main", "hour").agg(F.avg("traffic_volume").alias("volume"))
    return pf.scenario_profiles(single, reports.weather_profile(named, []))


@query(f"{_PROFILES} SELECT day_type, weather_condition, CAST(hour AS BIGINT) AS hour, round(volume, 6) AS volume FROM p")
def scenario_profiles(spark, sf):
    return tidy(scenario_profiles_of(spark, sf))


_NEIGHBOURS = f"""{_PROFILES},
n AS (
  SELECT p.*, b.volume AS before, a.volume AS after FROM p
  JOIN p b ON b.day_type = p.day_type AND b.weather_condition = p.weather_condition AND b.hour = (p.hour + 23) % 24
  JOIN p a ON a.day_type = p.day_type AND a.weather_condition = p.weather_condition AND a.hour = (p.hour + 1) % 24),
minima AS (SELECT * FROM n WHERE volume <= before AND volume <= after),
deep AS (SELECT * FROM minima WHERE volume > 0 AND least(before - volume, after - volume) / volume * 100 >= 5)"""


@query(f"{_NEIGHBOURS} SELECT day_type, weather_condition, CAST(hour AS BIGINT) AS hour, round(volume, 6) AS volume FROM minima")
def local_minima(spark, sf):
    return tidy(pf.local_minima(scenario_profiles_of(spark, sf), KEYS))


@query(f"{_NEIGHBOURS} SELECT day_type, weather_condition, CAST(hour AS BIGINT) AS hour, round(volume, 6) AS volume FROM deep")
def local_minima_prominent(spark, sf):
    return tidy(pf.local_minima(scenario_profiles_of(spark, sf), KEYS, vocab.MIN_PROMINENCE_PCT))


@query(f"""{_PROFILES},
w AS (SELECT day_type, weather_condition, hour, avg(volume) OVER o AS m, count(*) OVER o AS c FROM p
  WINDOW o AS (PARTITION BY day_type, weather_condition ORDER BY hour ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))
SELECT DISTINCT ON (day_type, weather_condition) day_type, weather_condition, CAST(hour AS BIGINT) AS start_hour,
  CAST(hour + 3 AS BIGINT) AS end_hour, round(m, 6) AS avg_volume
FROM w WHERE hour BETWEEN 5 AND 20 AND c = 3 ORDER BY day_type, weather_condition, round(m, 9), hour""")
def lowest_window(spark, sf):
    return tidy(pf.lowest_window(scenario_profiles_of(spark, sf), KEYS, window_size=3))


def _around_sql(size: int, earliest: int, latest: int = 22) -> str:
    """Window around ``best`` of table ``chosen``, with its mean and the daily peak."""
    half = (size - 1) // 2
    return f"""ends AS (SELECT *, least({latest + 1}, greatest({earliest}, best - {half}) + {size}) AS end_hour FROM chosen),
placed AS (
  SELECT ends.day_type, ends.weather_condition, any_value(end_hour) - {size} AS start_hour, any_value(end_hour) AS end_hour,
    avg(CASE WHEN p.hour >= end_hour - {size} AND p.hour < end_hour THEN volume END) AS avg_volume,
    max(volume) AS peak_volume, any_value(is_trough) AS is_trough
  FROM ends JOIN p USING (day_type, weather_condition) GROUP BY 1, 2)"""


_PLACED_COLUMNS = """day_type, weather_condition, CAST(start_hour AS BIGINT) AS start_hour, CAST(end_hour AS BIGINT) AS end_hour,
  round(avg_volume, 6) AS avg_volume, round(peak_volume, 6) AS peak_volume, is_trough"""


@query(f"""{_NEIGHBOURS},
dip AS (SELECT DISTINCT ON (day_type, weather_condition) day_type, weather_condition, hour FROM deep
  WHERE hour BETWEEN 7 AND 22 ORDER BY day_type, weather_condition, volume, hour),
low AS (SELECT DISTINCT ON (day_type, weather_condition) day_type, weather_condition, hour FROM p
  WHERE hour BETWEEN 7 AND 22 ORDER BY day_type, weather_condition, volume, hour),
chosen AS (SELECT low.day_type, low.weather_condition, coalesce(dip.hour, low.hour) AS best, dip.hour IS NOT NULL AS is_trough
  FROM low LEFT JOIN dip USING (day_type, weather_condition)),
{_around_sql(1, 7)} SELECT {_PLACED_COLUMNS} FROM placed""")
def minimum_window(spark, sf):
    out = pf.minimum_window(
        scenario_profiles_of(spark, sf), KEYS, earliest=7, min_prominence_pct=vocab.MIN_PROMINENCE_PCT
    )
    return tidy(out)


def _first(name: str, source: str, where: str, order: str) -> str:
    return f"""{name} AS (SELECT DISTINCT ON (day_type, weather_condition) day_type, weather_condition, hour, volume
  FROM {source} WHERE {where} ORDER BY day_type, weather_condition, {order})"""


_BEST = f"""{_PROFILES},
{_first('am', 'p', 'hour BETWEEN 5 AND 11', 'volume DESC, hour')},
{_first('pm', 'p', 'hour BETWEEN 12 AND 20', 'volume DESC, hour')},
peaks AS (
  SELECT am.day_type, am.weather_condition, am.hour AS ah, am.volume AS av, pm.hour AS ph, pm.volume AS pv,
    CASE WHEN am.volume >= pm.volume THEN am.hour ELSE pm.hour END AS top
  FROM am JOIN pm USING (day_type, weather_condition)),
j AS (SELECT * FROM p JOIN peaks USING (day_type, weather_condition)),
{_first('mid', 'j', 'ph - ah >= 2 AND hour BETWEEN greatest(ah + 1, 7) AND least(ph - 1, 22)', 'volume, hour')},
{_first('pre', 'j', 'hour BETWEEN 7 AND top - 1', 'volume, hour')},
{_first('post', 'j', 'hour BETWEEN top + 1 AND 22', 'volume, hour')},
chosen AS (
  SELECT k.day_type, k.weather_condition, coalesce(mid.volume < av AND mid.volume < pv, false) AS is_trough,
    CASE WHEN coalesce(mid.volume < av AND mid.volume < pv, false) THEN mid.hour
         WHEN post.hour IS NULL OR pre.volume <= post.volume THEN pre.hour ELSE post.hour END AS best
  FROM peaks k LEFT JOIN mid USING (day_type, weather_condition) LEFT JOIN pre USING (day_type, weather_condition)
  LEFT JOIN post USING (day_type, weather_condition))"""


@query(f"{_BEST}, {_around_sql(1, 7)} SELECT {_PLACED_COLUMNS} FROM placed")
def best_window(spark, sf):
    return tidy(pf.best_window(scenario_profiles_of(spark, sf), KEYS))


@query(f"{_BEST}, {_around_sql(3, 7)} SELECT {_PLACED_COLUMNS} FROM placed")
def best_window_three_hours(spark, sf):
    return tidy(pf.best_window(scenario_profiles_of(spark, sf), KEYS, window_size=3))


def _clock(h: str) -> str:
    return (
        f"CAST(CASE WHEN {h} % 12 = 0 THEN 12 ELSE {h} % 12 END AS VARCHAR) || ':00 ' || "
        f"CASE WHEN {h} % 24 < 12 THEN 'AM' ELSE 'PM' END"
    )


def _whole(v: str) -> str:
    return f"CAST(CAST(round_even({v}, 0) AS BIGINT) AS VARCHAR)"


_RECOMMENDED = f"""{_BEST}, {_around_sql(1, 7)},
r AS (SELECT *, (1 - avg_volume / peak_volume) * 100 AS pct FROM placed)
SELECT day_type, weather_condition, {_clock('start_hour')} AS recommended_start, {_clock('end_hour')} AS recommended_end,
  round(avg_volume, 1) AS predicted_volume, round(peak_volume, 1) AS daily_peak_volume, round(pct, 1) AS pct_below_peak,
  is_trough AS is_genuine_trough,
  'For a ' || day_type || ' journey' ||
  CASE WHEN weather_condition = '{vocab.TYPICAL_MIX}' THEN '' ELSE ' during ' || lower(weather_condition) || ' conditions' END ||
  CASE WHEN is_trough THEN ', consider travelling between ' || {_clock('start_hour')} || ' and ' || {_clock('end_hour')} ||
    ', when historical traffic volumes dip to a local low between the morning and evening rush periods '
  ELSE ', there is no significant midday dip between rush periods; the lowest point within typical travel hours is around ' ||
    {_clock('start_hour')} || ' to ' || {_clock('end_hour')} || ' ' END ||
  '(predicted volume approximately ' || {_whole('avg_volume')} || ', ' || {_whole('pct')} ||
  '% below the daily peak of approximately ' || {_whole('peak_volume')} || ').' AS recommendation_text
FROM r"""

@query(_RECOMMENDED)
def recommendations(spark, sf):
    return pf.recommendations(scenario_profiles_of(spark, sf))


_ASKED = ", ".join(f"('{d}', '{w}')" for d in vocab.DAY_TYPES for w in [vocab.TYPICAL_MIX, *vocab.WEATHER])


@query(f"""SELECT day_type, weather_condition, recommended_start, recommended_end, predicted_volume, daily_peak_volume, pct_below_peak,
  is_genuine_trough, coalesce(recommendation_text, 'No recommendation for a ' || day_type || ' journey: no conditions are known for '
    || weather_condition || '.') AS recommendation_text
FROM (SELECT * FROM (VALUES {_ASKED}) v(day_type, weather_condition)
  UNION SELECT d.*, weather_condition FROM (VALUES ('weekday'), ('weekend')) d(day_type), (SELECT weather_condition FROM ({_RECOMMENDED}))) a
LEFT JOIN ({_RECOMMENDED}) b USING (day_type, weather_condition)""")
def recommendation_table(spark, sf):
    """All categories, declared or found; those without readings say that nothing is known."""
    return pf.recommendation_table(scenario_profiles_of(spark, sf))


_GRID_COLUMNS = [
    "day_type", "weather_main", "hour", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "is_holiday",
    "wx_Clear", "wx_Snow", "is_severe_weather", "is_low_visibility", "rain_1h", "snow_1h", "clouds_all",
]


@query(f"""WITH {TIDY_SQL},
c AS (SELECT weather_main, avg(rain_1h) AS rain_1h, avg(snow_1h) AS snow_1h, avg(clouds_all) AS clouds_all FROM tidy GROUP BY 1),
d(day_type, is_weekend, dow) AS (VALUES ('weekday', 0, 2), ('weekend', 1, 5)),
g AS (SELECT * FROM c CROSS JOIN d CROSS JOIN range(24) t(hour))
SELECT day_type, weather_main, hour, round(sin(2 * pi() * hour / 24), 6) AS hour_sin, round(cos(2 * pi() * hour / 24), 6) AS hour_cos,
  round(sin(2 * pi() * dow / 7), 6) AS dow_sin, round(cos(2 * pi() * dow / 7), 6) AS dow_cos,
  CAST(is_weekend AS BIGINT) AS is_weekend, CAST(0 AS BIGINT) AS is_holiday,
  CAST(CASE WHEN weather_main = 'Clear' THEN 1 ELSE 0 END AS BIGINT) AS wx_Clear,
  CAST(CASE WHEN weather_main = 'Snow' THEN 1 ELSE 0 END AS BIGINT) AS wx_Snow,
  CAST(CASE WHEN weather_main IN ('Thunderstorm', 'Squall') THEN 1 ELSE 0 END AS BIGINT) AS is_severe_weather,
  CAST(CASE WHEN weather_main IN ('Fog', 'Mist', 'Haze', 'Smoke') THEN 1 ELSE 0 END AS BIGINT) AS is_low_visibility,
  round(rain_1h, 6) AS rain_1h, round(snow_1h, 6) AS snow_1h, round(clouds_all, 6) AS clouds_all FROM g""")
def scenario_grid(spark, sf):
    conditions = reports.weather_profile(tidy_readings(spark, sf), ["rain_1h", "snow_1h", "clouds_all"])
    return tidy(pf.scenario_grid(conditions).select(*_GRID_COLUMNS))


@query(f"""WITH {TIDY_SQL}, w AS (SELECT weather_main, count(*) AS n FROM tidy WHERE hour(date_time) = 3 GROUP BY 1)
SELECT w.weather_main, n FROM w ANTI JOIN
  (SELECT weather_main FROM tidy WHERE temp <= 0 GROUP BY 1) k ON k.weather_main = w.weather_main""")
def scenarios_without_conditions(spark, sf):
    """Categories asked for that the conditions table does not hold."""
    rows = tidy_readings(spark, sf)
    asked = rows.where(F.hour("date_time") == 3).groupBy("weather_main").agg(F.count("*").alias("n"))
    known = rows.where("temp <= 0").groupBy("weather_main").agg(F.avg("rain_1h").alias("rain_1h"))
    return wide_ints(pf.attach_conditions(asked, known)[1])


_ALIGNED = f"""{_PROFILES},
mix AS (SELECT day_type, hour, volume FROM p WHERE weather_condition = '{vocab.TYPICAL_MIX}'),
hist AS (SELECT day_type, hour, avg(traffic_volume) AS volume FROM named GROUP BY 1, 2),
aligned AS (SELECT day_type, hour, mix.volume AS simulated, hist.volume AS historical_mean,
  mix.volume - hist.volume AS difference FROM mix FULL JOIN hist USING (day_type, hour))"""


def _aligned(spark, sf):
    mix = scenario_profiles_of(spark, sf).where(F.col("weather_condition") == vocab.TYPICAL_MIX)
    history = _named(spark, sf).groupBy("day_type", "hour").agg(F.avg("traffic_volume").alias("volume"))
    return pf.align_profiles(mix, history, ["day_type", "hour"])


@query(f"""{_ALIGNED}
SELECT day_type, CAST(hour AS BIGINT) AS hour, round(simulated, 6) AS simulated, round(historical_mean, 6) AS historical_mean,
  round(difference, 6) AS difference FROM aligned""")
def profile_check(spark, sf):
    return tidy(_aligned(spark, sf))


@query(f"{_ALIGNED} SELECT day_type, round(corr(simulated, historical_mean), 6) AS correlation FROM aligned GROUP BY 1")
def profile_correlation(spark, sf):
    return rounded(pf.profile_correlation(_aligned(spark, sf), ["day_type"]))
