"""Fixed values that loads must honour exactly."""

# Cell texts that a default pandas CSV read treats as missing
# (pandas documentation, ``na_values`` defaults). Exported files are cleaned
# with exactly this list so loads keep the same nulls.
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Text a missing cell contributes to the row id (``str`` of a float NaN).
NULL_HASH_TOKEN = "nan"

# Boolean spellings that a default pandas CSV read turns into booleans,
# and the text they are stored as.
TRUE_SPELLINGS: tuple[str, ...] = ("True", "TRUE", "true")
FALSE_SPELLINGS: tuple[str, ...] = ("False", "FALSE", "false")

# Logical column types of a mapping and the Spark type each loads as;
# any other type name loads as text.
LOGICAL_TYPES: dict[str, str] = {
    "STRING": "string",
    "NUMBER": "double",
    "DATE": "string",
    "BOOLEAN": "string",
}
FALLBACK_TYPE = "string"

# Job states of the sync registry.
PENDING, PASS, FAILED = "PENDING", "PASS", "FAILED"

# Zone and text layout of the alert time stamp.
ALERT_ZONE = "Asia/Kolkata"
ALERT_FORMAT = "dd-MM-yyyy HH:mm:ss"
