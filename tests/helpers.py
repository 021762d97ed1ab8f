"""Small frames and plain-Python statements of the rules, used as independent checks."""

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)

# --- fixed values: the cleaning case (columns as in the raw table, ``_ord`` first) ---
RAW_CSV = """_ord,holiday,temp,rain_1h,snow_1h,clouds_all,weather_main,weather_description,date_time,traffic_volume
1,None,288.0,0.0,0.0,40,Clouds,scattered clouds,2012-10-02 09:00:00,5500
2,None,290.0,0.0,0.0,75, Clouds ,broken clouds,2012-10-02 10:00:00,4500
3,None,290.0,0.0,0.0,75,Mist,MIST,2012-10-02 10:00:00,4500
4,None,0.0,0.0,0.0,1,Clear,Sky is Clear,2012-10-02 11:00:00,4800
5,None,300.0,9831.3,0.0,0,Rain,very heavy rain,2016-07-11 17:00:00,5600
6,Labor Day,295.0,0.0,0.0,1,Clear,sky is clear,2015-09-07 00:00:00,900
7,None,0.0,0.0,0.0,1,Clear,sky is clear,not-a-date,100
8,None,291.0,0.5,0.0,1,Clear,sky is clear,also-bad,200
9,None,280.0,0.2,0.0,90,Snow,light snow,2013-10-02 12:00:00,4000
10,None,281.0,0.2,0.0,90,Snow,light snow,2013-10-02 12:00:00,4100
11,None,288.0,0.0,0.0,40,Clouds,scattered clouds,2012-10-02 09:00:00,5500
"""

# --- fixed values: hour profiles ---
TWO = [500, 300, 200, 200, 400, 2000, 4500, 6000, 5200, 4800, 4500, 4600,
       4900, 5000, 5300, 5800, 6200, 6500, 5000, 3500, 2800, 2500, 2000, 1200]
ONE = [900, 600, 400, 300, 300, 400, 700, 1200, 1900, 2600, 3300, 3900,
       4300, 4400, 4300, 4200, 4100, 4000, 3600, 3000, 2600, 2200, 1700, 1200]
LATE = ONE[:12] + [4000, 4100, 4200, 4300, 4400, 4500, 4600, 4700, 4800] + ONE[21:]
FLAT = [100] * 24
PROFILES = {"two": TWO, "one": ONE, "late": LATE, "flat": FLAT}


def hours(numbers):
    return [START + timedelta(hours=n) for n in numbers]


def profile_rows(profiles):
    return [(k, h, float(v)) for k, vs in profiles.items() for h, v in enumerate(vs)]


def series_frame(spark, numbers, **columns):
    rows = [(t, *[float(c[i]) for c in columns.values()]) for i, t in enumerate(hours(numbers))]
    names = ", ".join(["date_time timestamp_ntz", *[f"{n} double" for n in columns]])
    return spark.createDataFrame(rows, names)


def expected_window(v, size, earliest=7, latest=22):
    """The travel-window rule, spelled out over one list of 24 numbers."""
    def first_best(hs, best):
        return best(hs, key=lambda h: (v[h], h) if best is min else (v[h], -h)) if hs else None

    am, pm = first_best(range(5, 12), max), first_best(range(12, 21), max)
    inner = [h for h in range(am + 1, pm) if earliest <= h <= latest] if pm - am >= 2 else []
    dip = first_best(inner, min)
    trough = dip is not None and v[dip] < v[am] and v[dip] < v[pm]
    if trough:
        best = dip
    else:
        top = am if v[am] >= v[pm] else pm
        sides = [first_best(list(range(earliest, top)), min), first_best(list(range(top + 1, latest + 1)), min)]
        best = min((h for h in sides if h is not None), key=lambda h: v[h])
    end = min(latest + 1, max(earliest, best - (size - 1) // 2) + size)
    return end - size, end, sum(v[end - size:end]) / size, trough
