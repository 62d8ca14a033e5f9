"""Names, tags and formats that output tables must carry verbatim."""

# Fixed value: the fields of one query-log line, in line order.
QUERY_LOG_FIELDS = [
    "ServerName",
    "Host",
    "Port",
    "Id_",
    "UserName",
    "DatabaseName",
    "NotificationType",
    "SessionId",
    "StartTime",
    "EndTime",
    "Duration",
    "WaitingTime",
    "NumRows",
    "State",
    "Completed",
    "Cache",
    "Query",
    "RequestType",
    "Element",
    "UserAgent",
    "AccessInterface",
    "ClientIP",
    "TransactionId",
    "WebServiceName",
]

# Fixed value: the fields of one usage event, in table order.
USAGE_FIELDS = ["start_date", "start_time", "id", "ontology", "activity"]

# Fixed value: the fields of one metadata event, in table order.
METADATA_FIELDS = ["ontology", "filename", "size_in_kb"]

# Fixed value: the activity whose events carry a file.
FILE_ACTIVITY = "Download"

# Fixed value: log directories and the file-name prefix used in each.
QUERY_LOG_DIRECTORIES = {
    "AVDP1": "dev_azure_vdp1-queries.log.",
    "AVDP2": "dev_azure_vdp2-queries.log.",
}

# Fixed value: where a query-log file of one day lies below the source folder.
QUERY_LOG_LAYOUT = "{directory}/{prefix}{day}"

# Date and time formats.
FILE_DAY_FORMAT = "MMddyyyy"
CHECKPOINT_DAY_FORMAT = "yyyyMMdd"
NUMERIC_TIME_FORMAT = "yyyyMMddHHmmssSSS"
MINUTE_FORMAT = "yyMMddHHmm"

# Patterns over source paths.
FILE_DAY_PATTERN = r"\.(\d{8})$"
SOURCE_DIR_PATTERN = r"/(AVDP[123])/"

# Log type and table type tags.
QUERY_LOG_TYPE = "logm.denodo.queries"
QUERY_TABLE_TYPE = "LOGM_DENODO_QUERIES_CL"
METADATA_LOG_TYPE = "logm.omp.metadata"
METADATA_TABLE_TYPE = "LOGM_OMP_MEATADATA_CL"

# Element ids of the two price fields on a product page, preferred one first.
PRICE_ELEMENT_IDS = ["priceblock_dealprice", "priceblock_ourprice"]

# Price watch texts.
PRICE_BELOW = "Available at your price"
PRICE_NOT_BELOW = "Still at same price"
