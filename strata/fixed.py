"""Fixed values.

Everything in this file must be the same as in the system this engine is compatible with: word lists,
format lists, thresholds, reserved names and message texts. Nothing here is logic.
"""

# ---- column types a table config may name, and the Spark type each one means -------------------------------
COLUMN_TYPES = {
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bigint": "bigint",
    "string": "string",
    "float": "float",
    "double": "double",
    "decimal": "decimal(38,18)",
    "date": "date",
    "timestamp": "timestamp",
}

# ---- texts that stand for "no value" (compared lower-cased and trimmed) ------------------------------------
NULL_WORDS = ["null", "none", "na", "n/a", "nan", "-", "", "nat"]

# ---- date and timestamp patterns, in order of preference ---------------------------------------------------
DATE_PATTERNS = [
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd/MM/yyyy",
    "MM-dd-yyyy",
    "dd-MM-yyyy",
    "yyyy/MM/dd",
    "dd-MMM-yy",
    "dd-MMM-yyyy",
]
TIMESTAMP_PATTERNS = [
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "MM-dd-yyyy HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
]

# ---- CSV source reader defaults ----------------------------------------------------------------------------
CSV_READ_DEFAULTS = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": "\\",
    "comment": "#",
    "encoding": "UTF-8",
    "nullValue": "NA",
    "nanValue": "NaN",
    "positiveInf": "Inf",
    "negativeInf": "-Inf",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "multiLine": False,
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "locale": "en-US",
    "maxColumns": 20480,
    "maxCharsPerColumn": -1,
    "maxMalformedLogPerPartition": 10,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "lineSep": "\n",
    "charToEscapeQuoteEscaping": "\\",
    "unescapedQuoteHandling": "STOP_AT_DELIMITER",
    "recursiveFileLookup": False,
}
JSON_READ_DEFAULTS = {
    "multiLine": True,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "encoding": "UTF-8",
}
PARQUET_READ_DEFAULTS = {
    "mergeSchema": True,
    "recursiveFileLookup": True,
    "datetimeRebaseMode": "EXCEPTION",
    "int96RebaseMode": "EXCEPTION",
}
JDBC_READ_DEFAULTS = {
    "fetchsize": "10000",
    "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
WORKBOOK_LAST_ROW = 1048576
WORKBOOK_NULLS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# ---- landing options that steer the engine and are never handed to a reader --------------------------------
RESERVED_LANDING_KEYS = [
    "source_path",
    "file_format",
    "format_options_key",
    "format_options",
    "excel_options",
    "notebook_path",
    "parameters",
    "pii_columns",
]

# ---- reserved column names ---------------------------------------------------------------------------------
LINEAGE_COLUMN = "source_file_name"
MALFORMED_COLUMN = "_malformed_line"
HASH_COLUMN = "row_hash"
VALID_FROM, VALID_TO, IS_CURRENT = "__effective_from", "__effective_to", "__is_current"
HASH_EXCLUDED = [
    "created_at",
    "updated_at",
    "ingestion_time",
    "ingestion_ts",
    "__effective_from",
    "__effective_to",
    "__is_current",
    "__is_expired",
    "__hash",
    "run_id",
    "load_timestamp",
    "row_hash",
    "_rescued_data",
]

# ---- loads -------------------------------------------------------------------------------------------------
LOAD_TYPES = ["append", "overwrite", "scd_type1", "scd_type2"]
LOAD_ALIASES = {"scd1": "scd_type1", "scd2": "scd_type2"}

# ---- checks ------------------------------------------------------------------------------------------------
DUPLICATE_CHECK = "duplicate_row_validation"
COUNT_CHECK = "row_count_validation"
KEY_CHECK = "primary_key_validation"
SCHEMA_CHECK = "schema_validation"
DEFAULT_CHECKS = [COUNT_CHECK, KEY_CHECK, SCHEMA_CHECK]

# ---- config rules ------------------------------------------------------------------------------------------
REQUIRED_FIELDS = ["source_name", "region", "market", "domain", "ingestion_steps"]
CONFIG_FORMATS = ["excel", "csv", "parquet", "json", "delta"]
FORMATS_WITH_OPTIONS = ["excel", "csv", "json"]
TRIGGER_TYPES = ["schedule", "file_arrival"]

# ---- freshness: hours a table may lag behind, by cadence ---------------------------------------------------
CADENCE_HOURS = {"DAILY": 26, "WEEKLY": 170, "MONTHLY": 745, "QUARTERLY": 2208, "YEARLY": 8760}
REGION_INFIXES = ["_NA_", "_EU_", "_APAC_"]

# ---- column specs ------------------------------------------------------------------------------------------
SQL_TYPE_GROUPS = {
    "string": ["string", "varchar", "char", "text"],
    "date": ["date"],
    "timestamp": ["timestamp", "datetime"],
    "double": [
        "int",
        "integer",
        "smallint",
        "tinyint",
        "bigint",
        "float",
        "double",
        "decimal",
        "numeric",
        "number",
    ],
}
REGION_CODES = {
    "NORTH AMERICA": "na",
    "SOUTH AMERICA": "sa",
    "LATIN AMERICA": "latam",
    "EUROPE": "eu",
    "ASIA PACIFIC": "apac",
    "APAC": "apac",
    "MIDDLE EAST": "me",
    "AFRICA": "af",
    "GLOBAL": "global",
}
NO_KEY_WORDS = ["NO PRIMARY KEY", "NONE", "N/A", "NA", "-"]
PII_HINTS = [
    "email",
    "phone",
    "ssn",
    "social_security",
    "address",
    "dob",
    "date_of_birth",
    "birth_date",
    "passport",
    "credit_card",
    "card_number",
    "ip_address",
    "first_name",
    "last_name",
    "full_name",
    "customer_name",
    "account_number",
    "national_id",
]
PLACEHOLDER_EMAIL = "REPLACE_ME@company.com"

# ---- reports -----------------------------------------------------------------------------------------------
GOOD_SCORE, FAIR_SCORE = 90.0, 70.0
SUMMARY_FUNCTION = "pipeline_summary"
NO_LOG_ENTRY = "No log entry found — task may have crashed before logging"

# ---- error capture -----------------------------------------------------------------------------------------
COLUMN_IN_MESSAGE = r"column '([^']+)'"
NOT_APPLICABLE = "N/A"
ALL_COLUMNS = "ALL"
DEFAULT_SEVERITY = "CRITICAL"

# ---- message texts -----------------------------------------------------------------------------------------
COUNT_FAILED = "ROW COUNT FAILED: found 0 row(s) but expected at least 1 row(s) -- short by 1 row"
DUPLICATES_FAILED = "DUPLICATE ROWS FAILED: found {dup} duplicate row(s) (total: {total}, distinct: {distinct})"
KEY_NULLS_FAILED = "PRIMARY KEY FAILED: column '{col}' has {n} NULLs"
KEY_FAILED = "PRIMARY KEY FAILED: column '{col}' has {dup} duplicate rows (unique: {distinct}, total: {total})"
COMPOSITE_KEY_FAILED = "PRIMARY KEY FAILED: composite key [{cols}] has {dup} duplicate rows"
MISSING_COLUMN = "SCHEMA FAILED: missing column '{col}'"
UNEXPECTED_COLUMN = "SCHEMA FAILED: unexpected column '{col}'"

# what a report shows of a failed run: so many failed checks, so many characters of an error
SHOWN_CHECKS = 3
SHOWN_ERROR = 150
