"""Values fixed by the data format and by the published reports."""

# Labels in report results.
DAYTIME, NIGHT = "白天", "夜晚"
WEEKEND, WEEKDAY = "週末", "週間"
PRESENT, MISSING = "有", "缺"
COMFORTABLE, HOT, COLD, HUMID, DRY, OTHER = "舒適", "炎熱", "寒冷", "潮濕", "乾燥", "其他"

# Column headings of the two exports.
EXPORT_MONTH_HEADINGS = {
    "year": "年份",
    "month": "月份",
    "record_time": "記錄時間",
    "channel1_temperature": "溫度(°C)",
    "channel2_humidity": "濕度(%)",
    "channel3_uv": "UV(W/m²)",
    "channel4_lux": "照度(lux)",
    "channel5_device_temp": "設備溫度(°C)",
}
EXPORT_DAILY_HEADINGS = {
    "date": "日期",
    "record_count": "記錄數",
    "avg_temperature": "平均溫度",
    "max_temperature": "最高溫度",
    "min_temperature": "最低溫度",
    "avg_humidity": "平均濕度",
    "max_humidity": "最高濕度",
    "min_humidity": "最低濕度",
    "avg_uv": "平均UV",
    "max_lux": "最高照度",
}

# Default limits of the reports.
DAY_HOURS = (6, 17)
MIDDAY_HOURS = (12, 14)
HIGH_TEMPERATURE = 35
HIGH_HUMIDITY = 95
HIGH_UV = "0.8"
COMFORT_TEMPERATURE = (20, 28)
COMFORT_HUMIDITY = (40, 70)
TEMPERATURE_BUCKET = 5
HUMIDITY_BUCKET = 10

# Worksheet layout and header words.
DATA_MARKER = "Data"
UNITS_AFTER_MARKER = 2
SAMPLES_AFTER_MARKER = 3
COUNTER_HEADERS = ["NO.", "Number"]
TIME_HEADERS = ["time", "時間"]
BLANK_HEADER = "Unnamed"
TEMPERATURE_UNITS = ["degc"]
HUMIDITY_UNITS = ["%", "rh"]
UV_UNITS = ["w/m2"]
LUX_UNITS = ["lux"]
FIRST_REPEAT = ".1"

# File names. The folder is searched for `<prefix>YYMM….xlsx`.
WORKBOOK_PREFIX = "*RAWDATA_"
WORKBOOK_SUFFIX = ".xlsx"
LOCK_FILE_PREFIX = "~$"
CENTURY = 2000

# Texts that pandas reads as a missing cell.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
