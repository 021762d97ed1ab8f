"""Fixed values of the hourly road-sensor preset.

Everything here is data: names, word lists, ranks, bounds and model settings that
results depend on. The operators take them as parameters and default to these.
"""

# --- fixed values: raw table -------------------------------------------------
RAW_COLUMNS = [
    "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
    "weather_main", "weather_description", "date_time", "traffic_volume",
]

# Tokens a CSV reader takes as a missing cell (the usual NA spellings).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: weather ---------------------------------------------------
WEATHER = [
    "Clear", "Clouds", "Drizzle", "Fog", "Haze", "Mist",
    "Rain", "Smoke", "Snow", "Squall", "Thunderstorm",
]
SEVERE = ["Thunderstorm", "Squall"]
LOW_VISIBILITY = ["Fog", "Mist", "Haze", "Smoke"]
PRECIPITATION = ["Rain", "Drizzle", "Snow"]
SEVERITY = {
    "Clear": 0, "Clouds": 1, "Mist": 2, "Haze": 2, "Smoke": 2, "Fog": 2,
    "Drizzle": 3, "Rain": 3, "Snow": 4, "Thunderstorm": 5, "Squall": 5,
}

# --- fixed values: validity bounds -------------------------------------------
MIN_TEMP_EXCLUSIVE = 0.0
MAX_RAIN_INCLUSIVE = 1000.0

# --- fixed values: labels and cut points -------------------------------------
THREE_LEVELS = ["Low", "Medium", "High"]
FOUR_LEVELS = ["Low", "Medium", "High", "Severe"]
DAY_PARTS = [(5, "Night"), (9, "Morning Rush"), (15, "Midday"), (19, "Evening Rush")]
LAST_DAY_PART = "Evening"
LEVEL_BOUNDS = [4500.0, 5500.0]
LABEL_RATE_BOUNDS = (0.01, 0.5)

# --- fixed values: model inputs, in order ------------------------------------
FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "is_weekend", "is_holiday",
    "wx_Clear", "wx_Clouds", "wx_Drizzle", "wx_Fog", "wx_Haze", "wx_Mist",
    "wx_Rain", "wx_Smoke", "wx_Snow", "wx_Squall", "wx_Thunderstorm",
    "is_severe_weather", "is_low_visibility",
    "temp_scaled", "rain_1h", "snow_1h", "clouds_all",
]
CLUSTER_FEATURES = ["hour_sin", "hour_cos", "weather_severity", "traffic_volume"]
SEQUENCE_FEATURES = ["traffic_volume", "hour_sin", "hour_cos", "is_weekend", "weather_severity"]
RULE_ATTRIBUTES = ["time_of_day", "weather_bucket", "weekday_type", "congestion_level"]

# --- fixed values: model settings --------------------------------------------
TEST_FRACTION = 0.2
SEED = 42
FOREST = {"numTrees": 150, "maxDepth": 15, "minInstancesPerNode": 10}
FOREST_VERSIONS = {
    "v1": {"numTrees": 300, "maxDepth": 30, "minInstancesPerNode": 1},
    "v2": {"numTrees": 200, "maxDepth": 20, "minInstancesPerNode": 5},
    "v3": {"numTrees": 150, "maxDepth": 15, "minInstancesPerNode": 10},
}
CLUSTER_COUNT = 6
CLUSTER_SWEEP = list(range(2, 9))
CLUSTER_RESTARTS = 10
SILHOUETTE_SAMPLE = 5000
MIN_SUPPORT = 0.005
MIN_LIFT = 1.0
LOOKBACK = 24

# --- fixed values: travel-window search --------------------------------------
MORNING_HOURS = (5, 11)
EVENING_HOURS = (12, 20)
EARLIEST_HOUR = 7
LATEST_HOUR = 22
MIN_PROMINENCE_PCT = 5.0
DAY_TYPES = {"weekday": (0, 2), "weekend": (1, 5)}
TYPICAL_MIX = "any (typical mix)"

# --- fixed values: drift monitoring ------------------------------------------
CONTINUOUS_FIELDS = ["temp", "rain_1h", "snow_1h", "clouds_all"]
MAX_ABS_Z = 1.0
MAX_SHARE_RATIO = 3.0
MAX_ERROR_RATIO = 2.0

# --- fixed values: scoring requests ------------------------------------------
LOG_COLUMNS = [
    "request_timestamp", "input_date_time", "weather_main", "temp", "rain_1h", "snow_1h",
    "clouds_all", "is_holiday", "predicted_traffic_volume", "model_version",
]
