"""Values that results depend on: names, types, bounds and labels.

Fixed values. They are stated here once, as plain text, and imported everywhere else.
"""

# The trip fields, in file order, with the type each has after harmonisation.
TRIP_FIELDS = [
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("RatecodeID", "bigint"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("fare_amount", "double"),
    ("tip_amount", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("improvement_surcharge", "double"),
    ("airport_fee", "double"),
]

# The fields whose type is repaired. All others keep the type their file has.
REPAIRED_TYPES = {
    "VendorID": "int",
    "passenger_count": "bigint",
    "DOLocationID": "int",
    "PULocationID": "int",
    "RatecodeID": "bigint",
}

# The narrow projection of interest.
COLUMNS_OF_INTEREST = [
    "VendorID",
    "passenger_count",
    "total_amount",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
]

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Lineage columns and the columns of the schema audit.
AUDIT_TIME = "AUD_ING_DTTM"
AUDIT_SYSTEM = "AUD_ING_SYSTEM"
AUDIT_SCRIPT = "AUD_ING_SCRIPT"
# Not in the layers of a run: the batch that rows were appended with.
AUDIT_BATCH = "AUD_ING_BATCH"
FILE_NAME = "FILE_NAME"
AUDIT_FIELDS = [AUDIT_TIME, AUDIT_SYSTEM, AUDIT_SCRIPT, FILE_NAME]
FIELD_NAME = "FIELD_NAME"
VARIABLE_TYPE = "VARIABLE_TYPE"
MATRIX_FILE = "File_Name"

# Key columns of the roll-ups.
TIME_SLICE = "TIME_SLICE"
MONTH_SLICE = "MONTH_SLICE"
DAY_SLICE = "DAY_SLICE"
HOUR_SLICE = "HOUR_SLICE"
GRAINS = ["month", "day", "hour"]

# The stored silver layer has the pickup day as a date beside the pickup time (see sinks.tables).
PICKUP_DATE = "PICKUP_DATE"

# The columns that get total, average, maximum and minimum, in output order.
MONEY_AND_DISTANCE = [
    "total_amount",
    "fare_amount",
    "tip_amount",
    "airport_fee",
    "congestion_surcharge",
    "improvement_surcharge",
    "trip_distance",
]

# Gate bounds (both ends are kept) and the default pickup window.
RATE_CODES = (1, 6)
ZONES = (1, 263)
WINDOW_FIRST_DAY = "2023-01-01"
WINDOW_LAST_DAY = "2023-05-31"
FOCUS_MONTH = 5

# Month labels of the revenue report; other months have none.
MONTH_LABELS = {1: "1. Jan", 2: "2. Fev", 3: "3. Mar", 4: "4. Abr", 5: "5. Mai"}

# Status texts (above, below, at the mean) of the two reports.
REVENUE_STATUS = ("🟢 Acima da Média", "🔴 Abaixo da Média", "🟡 Na Média")
DENSITY_STATUS = (
    "🟢 Densidade Superior à Média",
    "🔴 Densidade Inferior à Média",
    "🟡 Na Média Global",
)
