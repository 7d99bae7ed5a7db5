"""Values that must equal those of the source data: fixed text, not logic."""

# Texts that mean no value, compared in lower case after trimming.
NULL_TOKENS = ("", "-", "--", "null", "none", "n/a", "na", "nan")
# The further ones that derived features know.
FEATURE_NULL_TOKENS = ("", "-", "null", "none", "nan", "nat", "<na>")

# Short or former names of the first-level regions, and their standard names.
REGION_NAMES = {
    "서울": "서울특별시",
    "부산": "부산광역시",
    "대구": "대구광역시",
    "인천": "인천광역시",
    "광주": "광주광역시",
    "대전": "대전광역시",
    "울산": "울산광역시",
    "세종": "세종특별자치시",
    "경기": "경기도",
    "강원": "강원특별자치도",
    "강원도": "강원특별자치도",
    "충북": "충청북도",
    "충남": "충청남도",
    "전북": "전북특별자치도",
    "전라북도": "전북특별자치도",
    "전남": "전라남도",
    "경북": "경상북도",
    "경남": "경상남도",
    "제주": "제주특별자치도",
    "제주도": "제주특별자치도",
}

# Latitude and longitude bounds of valid coordinates; hotspots may lie further south.
LATITUDES, HOTSPOT_LATITUDES, LONGITUDES = (33.0, 39.5), (32.0, 39.5), (124.0, 132.0)

# Words of warning bulletins.
NO_WARNING = r"^[oO○]?\s*없음$"
BULLET = r"^[oO○]\s*"
ADVISORY, WARNING, PRELIMINARY = "주의보", "경보", "예비특보"
SEA_WORDS = ("앞바다", "먼바다", "해역")

# Words of closing-day rules.
WEEKDAYS = "월화수목금토일"
OPEN_ALL_YEAR, WEEKEND = "연중무휴", "주말"
PUBLIC_HOLIDAYS = ("공휴일", "법정공휴일", "법정휴일", "법적공휴일")
RULE_SEPARATORS = r"[+,/·]|및"

# The state of a facility in operation, places of exercise, and dry weather.
IN_OPERATION = "정상운영"
INDOOR, OUTDOOR = "실내", "실외"
NO_RAIN = "강수없음"
