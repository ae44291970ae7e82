"""Column lists and settings of the flight data model.

Everything in the library takes column names as arguments; these lists are
only the defaults for flight records.
"""

# The 44 columns of a flight record, in table order.
FLIGHT_COLUMNS = [
    "FlightDate", "Airline", "Origin", "Dest", "Cancelled", "Diverted",
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek",
    "Operating_Airline",
    "OriginAirportID", "OriginCityName", "OriginState", "OriginStateName",
    "DestAirportID", "DestCityName", "DestState", "DestStateName",
    "DepDel15", "DepartureDelayGroups", "DepTimeBlk",
    "ArrivalDelayGroups", "ArrTimeBlk", "ArrDel15", "DistanceGroup",
    "CRSDepTime", "DepTime", "DepDelayMinutes", "DepDelay",
    "ArrTime", "ArrDelayMinutes", "AirTime",
    "CRSElapsedTime", "ActualElapsedTime", "Distance",
    "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn",
    "CRSArrTime", "ArrDelay", "DivAirportLandings",
]

# The columns profiled as categories (27) and as numbers (17).
CATEGORICAL_COLUMNS = FLIGHT_COLUMNS[:27]
NUMERICAL_COLUMNS = FLIGHT_COLUMNS[27:]

# Categories charted as bars.
CHART_CATEGORIES = [
    "Airline", "Cancelled", "Diverted", "Year", "Quarter", "Month",
    "DayofMonth", "DayOfWeek", "Operating_Airline", "OriginStateName",
    "DestStateName", "DepDel15", "DepartureDelayGroups", "DepTimeBlk",
    "ArrivalDelayGroups", "ArrTimeBlk", "ArrDel15", "DistanceGroup",
]

# The scatter grid's x column and its y columns.
SCATTER_X = "ActualElapsedTime"
SCATTER_Y = [c for c in NUMERICAL_COLUMNS if c != SCATTER_X]

# Casts of the cleaning step and of the model-input step.
CLEAN_CASTS = {
    "DepDel15": "boolean",
    "ArrDel15": "boolean",
    "OriginAirportID": "string",
    "DestAirportID": "string",
}
MODEL_CASTS = {"ArrDel15": "int", "DepDel15": "int"}
DELAY_GROUP_CASTS = {"DepartureDelayGroups": "int", "ArrivalDelayGroups": "int"}

# Label rule, clock buckets [from, to) in hours, months per season.
LATE_MINUTES = 5
TIME_OF_DAY = [(5, 12, 1), (12, 17, 2), (17, 21, 3)]
NIGHT = 4
SEASONS = [((12, 1, 2), 1), ((3, 4, 5), 2), ((6, 7, 8), 3)]
FALL = 4
TIME_COLUMNS = {
    "CRSArrTime": "ScheduledArrTimeOfDay",
    "CRSDepTime": "ScheduledDepTimeOfDay",
}

# Columns that do not enter the feature table (delay outcomes,
# raw clock times, duplicates of kept columns).
NON_FEATURE_COLUMNS = [
    "FlightDate", "Airline", "Origin", "Dest", "Cancelled", "Diverted",
    "Quarter", "OriginState", "DestState",
    "DepDel15", "DepartureDelayGroups", "DepTimeBlk",
    "ArrivalDelayGroups", "ArrTimeBlk", "ArrDel15",
    "CRSDepTime", "DepTime", "DepDelayMinutes", "DepDelay",
    "ArrTime", "ArrDelayMinutes", "AirTime", "ActualElapsedTime",
    "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn",
    "CRSArrTime", "ArrDelay", "DivAirportLandings",
]

# Encoder inputs.
STRING_CATEGORIES = [
    "Operating_Airline", "OriginStateName", "DestStateName", "DistanceGroup",
]
INTEGER_CATEGORIES = [
    "DayOfWeek", "Month", "Season", "DayofMonth",
    "ScheduledArrTimeOfDay", "ScheduledDepTimeOfDay",
]
CONTINUOUS_COLUMNS = ["CRSElapsedTime", "Distance"]
CORRELATION_COLUMNS = ["CRSElapsedTime", "Distance", "Year"]

# Raw columns that only travel along until encoding and are then trimmed.
UNENCODED_COLUMNS = [
    "Year", "Quarter", "OriginAirportID", "OriginCityName",
    "DestAirportID", "DestCityName",
]

# Split, grid and model settings.
SPLIT_WEIGHTS = (0.7, 0.3)
SEED = 42
FOLDS = 3
GRID_MAX_ITER = 5
REG_PARAMS = [0.0, 0.3, 0.6, 1.0]
ELASTIC_NET_PARAMS = [0.0, 0.5, 1.0]
FOREST_TREES = 10

# Type names as they appear in DataFrame.dtypes.
INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")
FLOAT_TYPES = ("float", "double")
NESTED_TYPES = ("array", "map", "struct")
