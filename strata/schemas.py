"""Declared input and table schemas (DDL). Nothing in this library infers a schema."""

# --- Fixed values: input formats that callers' files and messages already have. ---

INVOICE = """
    InvoiceNumber string, CreatedTime bigint, StoreID string, PosID string, CashierID string,
    CustomerType string, CustomerCardNo string, TotalAmount double, NumberOfItems bigint,
    PaymentMethod string, TaxableAmount double, CGST double, SGST double, CESS double,
    DeliveryType string,
    DeliveryAddress struct<
        AddressLine: string, City: string, ContactNumber: string, PinCode: string, State: string>,
    InvoiceLineItems array<struct<
        ItemCode: string, ItemDescription: string, ItemPrice: double, ItemQty: bigint, TotalValue: double>>
"""

TRADE = "CreatedTime string, Type string, Amount double, BrokerCode string"

REGISTERED_USER = "user_id long, device_id long, mac_address string, registration_timestamp double"

GYM_LOGIN = "mac_address string, gym bigint, login double, logout double"

MESSAGE = "key string, value string, topic string, partition bigint, offset bigint, timestamp bigint"

# Epoch seconds are doubles: a 4-byte float would round them to multiples of 128 s.
# The postal code stays a string so that leading zeros survive.
USER_INFO = """
    user_id bigint, update_type string, timestamp double, dob string, sex string, gender string,
    first_name string, last_name string,
    address struct<street_address: string, city: string, state: string, zip: string>
"""

WORKOUT = "user_id bigint, workout_id bigint, timestamp double, action string, session_id bigint"

HEART_RATE = "device_id bigint, time timestamp, heartrate double"

DATE_LOOKUP = """
    date date, week int, year int, month int, dayofweek int, dayofmonth int, dayofyear int, week_part string
"""

# --- Fixed values: stored tables. ---

TABLES = {
    "users": "user_id bigint, device_id bigint, mac_address string, registration_timestamp timestamp",
    "gym_logs": "mac_address string, gym bigint, login timestamp, logout timestamp",
    "user_profile": """
        user_id bigint, dob date, sex string, gender string, first_name string, last_name string,
        street_address string, city string, state string, zip string, updated timestamp
    """,
    "heart_rate": "device_id bigint, time timestamp, heartrate double, valid boolean",
    "user_bins": "user_id bigint, age string, gender string, city string, state string",
    "workouts": "user_id bigint, workout_id bigint, time timestamp, action string, session_id bigint",
    "completed_workouts": """
        user_id bigint, workout_id bigint, session_id bigint, start_time timestamp, end_time timestamp
    """,
    "session_devices": """
        user_id bigint, device_id bigint, workout_id bigint, session_id bigint, start_time timestamp,
        end_time timestamp
    """,
    "workout_bpm": """
        user_id bigint, workout_id bigint, session_id bigint, start_time timestamp, end_time timestamp,
        time timestamp, heartrate double
    """,
    "workout_bpm_summary": """
        workout_id bigint, session_id bigint, user_id bigint, age string, gender string, city string,
        state string, min_bpm double, avg_bpm double, max_bpm double, num_recordings bigint
    """,
    "customer_rewards": "CustomerCardNo string, TotalAmount double, TotalPoints double",
    "invoice_messages": """
        key string, value string, topic string, partition bigint, offset bigint, timestamp timestamp
    """,
}

# Messages as stored: partition columns last, where a scan puts them. A stream over a folder that is
# still empty does not know them as such yet, and pairs columns by position.
STORED_MESSAGE = """
    key string, value string, partition bigint, offset bigint, timestamp bigint,
    load_time timestamp, source_file string, date date, load_day date, topic string, week_part string
"""

# Columns that a bronze file ingest appends to its input schema; the day is a partition column.
LINEAGE = "load_time timestamp, source_file string, load_day date"

STORED_USER, STORED_LOGIN = f"{REGISTERED_USER}, {LINEAGE}", f"{GYM_LOGIN}, {LINEAGE}"
