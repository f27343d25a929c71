"""Fixed values of the flight-delay task: codes, column names and bounds that results depend on."""

# Missing-value code of each part of a packed weather field, in order.
# None marks a part without a code.  The length of the list is the number of parts.
PACKED_FIELDS = {
    "WND": ["999", "9", "9", "9999", "9"],
    "CIG": ["99999", "9", "9", "9"],
    "VIS": ["999999", "9", "9", "9"],
    "TMP": ["9999", None],
    "DEW": ["9999", None],
    "SLP": ["99999", None],
    "AW1": [None, None],
    "GA1": ["99", None, "99999", None, "99", None],
    "GE1": ["9", "999999", "99999", "99999"],
    "KA1": ["999", "9", "9999", None],
    "MA1": ["99999", None, "99999", None],
    "MD1": ["9", None, "999", None, "999", None],
    "OC1": ["9999", None],
    "GD1": ["9", "99", None, "99999", None, "9"],
    "CH1": ["99", "9999", "9", None, "9999", "9", None],
    "CT1": ["9999", "9", None],
    "AO1": ["99", "9999", "9", None],
    "AA1": ["99", "9999", "9", None],
    "AU1": ["9", "9", "99", "9", "9", "9", None],
    "CO1": ["99", "99999"],
    "CB1": [None, None, None, None],
    "CG1": ["99999", "9", None],
    "CW1": ["99999", "9", None, "99999", "9", None],
}

# Numbers of the parts that are measurements, per packed field.
DOUBLE_PARTS = {
    "WND": [1, 4], "CIG": [1], "VIS": [1], "TMP": [1], "DEW": [1], "SLP": [1], "GA1": [3], "GE1": [3, 4],
    "KA1": [1, 3], "MA1": [1, 3], "MD1": [3, 5], "GD1": [4], "CH1": [1, 2, 5], "CT1": [1], "AO1": [1, 2],
    "AA1": [1, 2], "CB1": [1, 2], "CG1": [1], "CW1": [1, 4], "OC1": [1],
}
INTEGER_PARTS = {"CO1": [1, 2]}

# Columns known only after departure.
AFTER_DEPARTURE = [
    "DEP_TIME", "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DELAY_GROUP", "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN",
    "ARR_TIME", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "ARR_DELAY_GROUP", "ARR_TIME_BLK", "ACTUAL_ELAPSED_TIME",
    "AIR_TIME", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]

# Columns that repeat others or only served the joins.
REPEATED = [
    "FL_DATE", "CRS_DEP_TIME", "DEP_TIME_BLK", "FLIGHTS", "OP_UNIQUE_CARRIER", "OP_CARRIER_AIRLINE_ID",
    "ORIGIN_AIRPORT_ID", "ORIGIN_AIRPORT_SEQ_ID", "ORIGIN_CITY_MARKET_ID", "ORIGIN_CITY_NAME", "ORIGIN_STATE_NM",
    "ORIGIN_STATE_FIPS", "ORIGIN_WAC", "DEST_AIRPORT_ID", "DEST_AIRPORT_SEQ_ID", "DEST_CITY_MARKET_ID",
    "DEST_CITY_NAME", "DEST_STATE_NM", "DEST_STATE_FIPS", "DEST_WAC", "TIMEZONE", "LATITUDE", "LONGITUDE",
    "LATITUDE_ORIG", "LONGITUDE_ORIG", "NAME", "DATE", "REPORT_TYPE", "CALL_SIGN", "QUALITY_CONTROL", "REM", "EQD",
    "GA2", "GA3", "KA2", "GD2", "GD3", "CT2", "CT3", "CG2", "CG3", "CLOSEST_CITY",
]

# Of the columns above, those that an extract of the flight or weather tables may lack.
MAY_BE_ABSENT = [
    "DEP_TIME", "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DELAY_GROUP", "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN",
    "ARR_TIME", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15", "ARR_DELAY_GROUP", "ARR_TIME_BLK", "ACTUAL_ELAPSED_TIME",
    "AIR_TIME", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "DEP_TIME_BLK", "FLIGHTS", "OP_UNIQUE_CARRIER", "OP_CARRIER_AIRLINE_ID", "ORIGIN_AIRPORT_ID",
    "ORIGIN_AIRPORT_SEQ_ID", "ORIGIN_CITY_MARKET_ID", "ORIGIN_CITY_NAME", "ORIGIN_STATE_NM", "ORIGIN_STATE_FIPS",
    "ORIGIN_WAC", "DEST_AIRPORT_ID", "DEST_AIRPORT_SEQ_ID", "DEST_CITY_MARKET_ID", "DEST_CITY_NAME", "DEST_STATE_NM",
    "DEST_STATE_FIPS", "DEST_WAC", "TIMEZONE", "LATITUDE", "LONGITUDE", "LATITUDE_ORIG", "LONGITUDE_ORIG", "NAME",
    "DATE", "REPORT_TYPE", "CALL_SIGN", "QUALITY_CONTROL", "REM", "EQD", "GA2", "GA3", "KA2", "GD2", "GD3", "CT2",
    "CT3", "CG2", "CG3", "CLOSEST_CITY",
]

# The 50 states and DC.
STATES = (
    "AL AK AZ AR CA CO CT DC DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR "
    "PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()

# Bounds.
MIN_LOOKBACK_HOURS, MAX_LOOKBACK_HOURS = 2, 4
SPARSE_BEFORE_JOIN = 0.95
SPARSE_BEFORE_MODEL = 0.89
STRONG_CORRELATION = 0.75
TRAIN_FRACTION = 0.8
FOLDS = 3
COUNTRY = "US"
NEIGHBOURS = 3
NEW_ROWS_PER_LATE_FLIGHT = 2


def part_codes() -> dict[str, str]:
    return {f"{f}{i}": code for f, codes in PACKED_FIELDS.items() for i, code in enumerate(codes, 1) if code}


def part_names(parts: dict[str, list[int]]) -> list[str]:
    return [f"{field}{i}" for field, numbers in parts.items() for i in numbers]
