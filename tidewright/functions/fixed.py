"""Formats, word lists and constants that results depend on."""

# ---- catch tables ---------------------------------------------------------

CATCH_COLUMNS = [
    "date", "time", "species", "size_cm", "weight_kg", "count",
    "bait", "method", "spot", "spot_lat", "spot_lng", "nearest_station",
    "tide", "weather", "temp", "water_temp", "wind", "memo", "source",
]

MASTER_V1_COLUMNS = ["record_id", *CATCH_COLUMNS,
                     "canonical_spot", "sea_area", "entered_at",
                     "source_detail", "prompt_version", "confidence"]

MASTER_COLUMNS = [*MASTER_V1_COLUMNS, "boat_id", "area_id"]

REQUIRED_COLUMNS = ["record_id", "date", "species", "spot", "source", "entered_at"]

# The fields a content-derived record id is made of, after the boat id.
RECORD_ID_COLUMNS = ["date", "time", "species", "size_cm", "weight_kg", "count",
                     "bait", "method", "spot", "memo", "source"]

# Name space of the version-5 ids that stored records carry; pass another one
# to start a new id family.
RECORD_ID_NAMESPACE = "779bf4b5-57d4-5a58-85ec-b782a27d8f2d"

TIDES = ["大潮", "中潮", "小潮", "長潮", "若潮"]
WEATHERS = ["晴れ", "曇り", "雨", "雪"]

SOURCE_TO_INTERNAL = {"Instagram": "instagram", "Manual": "manual", "Other": "other"}
SOURCE_PREFIXES = ["blog:", "import:", "ocr:"]

DROP_FILE_PATTERN = r"^fishing_data_([a-zA-Z0-9_]+)\.csv$"

# ---- condition and current tables -----------------------------------------

CONDITION_COLUMNS = [
    "日付", "地点名", "観測地点名", "県", "緯度", "経度",
    "気温_平均", "気温_最高", "気温_最低", "風速_最大", "風向", "降水量",
    "天気コード", "天気", "水温", "最大波高", "波向", "波周期",
    "潮汐", "月齢", "月相",
]

CURRENT_COLUMNS = ["date", "point", "lat", "lon", "u_ms", "v_ms", "speed_ms",
                   "speed_kn", "direction", "temp_c", "salinity"]

# The fifteen condition columns that the integrated wide table carries; the
# value is the output name.
CONDITION_TO_INTEGRATED = {
    "気温_平均": "気温_平均", "気温_最高": "気温_最高", "気温_最低": "気温_最低",
    "風速_最大": "風速_最大", "風向": "風向_計測", "降水量": "降水量",
    "天気コード": "天気コード", "天気": "天気_計測", "水温": "水温_計測",
    "最大波高": "最大波高", "波向": "波向", "波周期": "波周期",
    "潮汐": "潮汐_計測", "月齢": "月齢", "月相": "月相",
}

# The same fifteen for the two-point wide table, split around the current block.
CONDITION_TO_TWO_POINT_HEAD = {"潮汐": "潮汐", "月齢": "月齢", "月相": "月相"}
CONDITION_TO_TWO_POINT_TAIL = {
    "気温_平均": "気温_平均", "気温_最高": "気温_最高", "気温_最低": "気温_最低",
    "風速_最大": "風速_最大", "風向": "風向", "降水量": "降水量",
    "天気コード": "天気コード", "天気": "天気", "水温": "水温(Open-Meteo)",
    "最大波高": "最大波高", "波向": "波向", "波周期": "波周期",
}
CURRENT_TO_TWO_POINT = {"speed_kn": "流速kn", "direction": "流向",
                        "temp_c": "水温", "salinity": "塩分"}
TWO_POINTS = ["室戸沖", "北西"]
TWO_POINT_SPOT_WORD = "室戸"

PROFILE_METRICS = [
    "室戸沖_流速kn", "室戸沖_流向", "室戸沖_水温", "室戸沖_塩分",
    "北西_流速kn", "北西_流向", "北西_水温", "北西_塩分",
    "気温_平均", "気温_最高", "気温_最低", "風速_最大", "降水量",
    "水温(Open-Meteo)", "最大波高", "波周期", "月齢",
]

# ---- places ----------------------------------------------------------------

# (name, latitude, longitude, prefecture)
STATIONS = [
    ("室戸", 33.29, 134.18, "高知"),
    ("高知", 33.56, 133.54, "高知"),
    ("足摺", 32.72, 132.72, "高知"),
    ("宇和島", 33.22, 132.56, "愛媛"),
    ("松山", 33.84, 132.77, "愛媛"),
    ("来島", 34.12, 132.99, "愛媛"),
    ("高松", 34.35, 134.05, "香川"),
    ("阿南", 33.92, 134.66, "徳島"),
]

# (name, latitude, longitude, sea area)
CURRENT_POINTS = [
    ("北西", 33.213852, 134.078931, "室戸沖"),
    ("西", 33.102084, 134.078931, "室戸沖"),
    ("室戸沖", 33.102084, 134.184056, "室戸沖"),
    ("東", 33.102084, 134.246407, "室戸沖"),
    ("北東", 33.213852, 134.246407, "室戸沖"),
]

EARTH_RADIUS_KM = 6371.0
STATION_LIMIT_KM = 300.0
POINT_LIMIT_KM = 50.0
GRID_TOLERANCE_DEG = 0.15
KNOTS_PER_MS = 1.944

OTHER = "その他"
UNKNOWN = "不明"

# Long station names found in older tables, and their short forms.
STATION_RECODE = {
    "室戸岬沖": "室戸", "高知市沖": "高知", "足摺岬沖": "足摺", "宇和島沖": "宇和島",
    "松山沖": "松山", "来島海峡": "来島", "高松沖": "高松", "阿南市沖": "阿南",
}

SPOT_BLANKS = [" ", "　", "\t"]
SPOT_BRACKETS = ["(", ")", "（", "）"]
SPOT_PREFIXES = ["高知県", "愛媛県", "香川県", "徳島県", "和歌山県",
                 "高知", "愛媛", "香川", "徳島", "和歌山"]
SPOT_ALIASES = {
    "室戸沖磯": "室戸沖", "室戸磯": "室戸沖", "室戸地磯": "室戸沖", "地磯": "室戸沖",
    "室戸港内": "室戸沖", "室戸港": "室戸沖", "室戸沖港": "室戸沖", "室戸近場": "室戸沖",
    "室戸沖近場": "室戸沖", "室戸近海": "室戸沖", "室戸岬沖": "室戸沖",
    "室戸岬近海": "室戸沖", "室戸沖岬沖": "室戸沖", "室戸沖周辺": "室戸沖",
    "室戸沖周辺散歩がてら": "室戸沖", "室戸沖風裏": "室戸沖", "室戸沖風浦": "室戸沖",
    "甲浦風裏": "甲浦", "安満地風裏": "安満地",
    "小笠原沖": "小笠原", "小笠原諸島": "小笠原",
}

# ---- directions, weather, moon and tide -------------------------------------

COMPASS_8 = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
COMPASS_8_JA = ["北", "北東", "東", "南東", "南", "南西", "西", "北西"]
COMPASS_16 = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
              "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]

WEATHER_TEXT = {
    0: "快晴", 1: "晴れ", 2: "一部曇り", 3: "曇り",
    45: "霧", 48: "着氷霧",
    51: "弱い霧雨", 53: "霧雨", 55: "強い霧雨",
    56: "着氷霧雨(弱)", 57: "着氷霧雨(強)",
    61: "弱い雨", 63: "雨", 65: "強い雨",
    66: "着氷雨(弱)", 67: "着氷雨(強)",
    71: "弱い雪", 73: "雪", 75: "強い雪", 77: "霧雪",
    80: "弱いにわか雨", 81: "にわか雨", 82: "激しいにわか雨",
    85: "弱いにわか雪", 86: "強いにわか雪",
    95: "雷雨", 96: "雷雨(雹弱)", 99: "雷雨(雹強)",
}

SYNODIC_DAYS = 29.530588853
NEW_MOON_JULIAN_DAY = 2451550.1
EPOCH_JULIAN_DAY = 2440587.5  # 1970-01-01

# (upper bound, exclusive, of the moon age; name); the last name has no bound.
MOON_PHASES = [(1.85, "新月"), (5.55, "三日月"), (9.25, "上弦"), (12.95, "十日夜"),
               (16.65, "満月"), (20.35, "十六夜"), (24.05, "下弦"), (27.75, "二十六夜"),
               (None, "晦日")]

# (upper bound, inclusive, of the moon age; tide). Ages from SPRING_TIDE_FROM on
# are spring tide as well; the last name has no bound.
SPRING_TIDE_FROM = 28
TIDE_STEPS = [(2, "大潮"), (5, "中潮"), (8, "小潮"), (10, "長潮"), (12, "若潮"),
              (16, "大潮"), (19, "中潮"), (22, "小潮"), (24, "長潮"), (26, "若潮"),
              (None, "中潮")]

TARGET_HOURS = [0, 6, 12, 18]

# ---- trends -------------------------------------------------------------------

# (lower bound, inclusive) from the top, (upper bound, inclusive) from the bottom.
TEMP_TREND = {"rise": [(1.5, "急上昇"), (0.5, "上昇")],
              "fall": [(-1.5, "急下降"), (-0.5, "下降")], "flat": "安定"}
SPEED_TREND = {"rise": [(0.2, "流速増加")], "fall": [(-0.2, "流速減少")],
               "flat": "流速安定"}

SPEED_BINS = [(0.3, "弱(0〜0.3kn)"), (0.6, "中(0.3〜0.6kn)"), (1.0, "強(0.6〜1.0kn)"),
              (None, "激流(1.0kn+)")]

# ---- gridded source variables ---------------------------------------------------

VARIABLE_ALIASES = {
    "u": ["u", "uo", "u_velocity", "ucur", "uvel", "u10"],
    "v": ["v", "vo", "v_velocity", "vcur", "vvel", "v10"],
    "temp": ["temp", "thetao", "temperature", "sst", "sea_water_potential_temperature"],
    "salt": ["salt", "so", "salinity", "sal", "sea_water_salinity"],
    "lon": ["lon", "longitude", "x"],
    "lat": ["lat", "latitude", "y"],
    "depth": ["depth", "deptht", "lev", "level", "z"],
}
GRID_BOX = {"lat": (33.0, 33.6), "lon": (134.0, 134.6), "depth": (0.0, 1.0)}
REANALYSIS_LAST_DAY = "2025-12-31"
SOURCE_ORDER = ["jcope_cache", "local", "cmems_cache", "cmems", "jcope_opendap", "jcope_ftp"]
ARCHIVE_LAG_DAYS = 5

# ---- go / no-go criteria -----------------------------------------------------------

GO_CRITERIA = {
    "excellent_max": 0.8, "good_max": 1.2, "caution_max": 1.6,
    "wind_speed_threshold": 8.0,
    "south_range_min": 135.0, "south_range_max": 225.0, "south_penalty": 0.4,
    "north_range_min": 315.0, "north_range_max": 45.0, "ew_penalty": 0.2,
    "reverse_angle_min": 120.0, "reverse_penalty": 0.2,
    "cross_angle_min": 90.0, "cross_penalty": 0.1,
    "wave_height_threshold": 0.8, "compound_penalty": 0.1,
    "compound_include_cross": False,
    "trend_change_threshold": 2.0, "trend_up_penalty": 0.2, "trend_down_bonus": 0.2,
    "ww_good_max": 0.3, "ww_good_bonus": 0.3, "ww_bad_min": 0.7, "ww_bad_penalty": 0.3,
}
GO_TAGS = {"south": "南風↑", "north": "北風◎", "east_west": "東西風", "reverse": "逆波",
           "cross": "交差波", "compound": "複合悪化", "wind_up": "風↑", "wind_down": "風↓",
           "small_wind_wave": "風波小", "big_wind_wave": "風波大"}
GO_VERDICTS = [("× 出船不可", "❌ 中止"), ("△ 未定・要確認", "⚠ 要確認"),
               ("○ 出船可能", "✅ 出船可"), ("◎ 釣り日和", "✅ 出船可")]
COMPASS_16_JA = ["北", "北北東", "北東", "東北東", "東", "東南東", "南東", "南南東",
                 "南", "南南西", "南西", "西南西", "西", "西北西", "北西", "北北西"]

# Places of the criteria in a criteria document: section -> key -> criterion.
GO_CRITERIA_DOCUMENT = {
    "thresholds": {"excellent_max": "excellent_max", "good_max": "good_max",
                   "caution_max": "caution_max"},
    "f2_wind_direction": {
        "wind_speed_threshold": "wind_speed_threshold",
        "south_range_min": "south_range_min", "south_range_max": "south_range_max",
        "south_penalty": "south_penalty", "north_range_min": "north_range_min",
        "north_range_max": "north_range_max", "ew_penalty": "ew_penalty"},
    "f3_opposing_wave": {
        "reverse_angle_min": "reverse_angle_min", "reverse_penalty": "reverse_penalty",
        "cross_angle_min": "cross_angle_min", "cross_penalty": "cross_penalty"},
    "f4_compound": {"wave_height_threshold": "wave_height_threshold",
                    "penalty": "compound_penalty",
                    "include_cross_wave": "compound_include_cross"},
    "f5_wind_trend": {"change_threshold": "trend_change_threshold",
                      "up_penalty": "trend_up_penalty", "down_bonus": "trend_down_bonus"},
    "f6_wind_wave": {"good_max": "ww_good_max", "good_bonus": "ww_good_bonus",
                     "bad_min": "ww_bad_min", "bad_penalty": "ww_bad_penalty"},
}
