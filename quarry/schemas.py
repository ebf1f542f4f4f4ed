"""Declared table schemas (S16). Loads enforce these; nothing is inferred.

Type choices: FLOAT money → double; NUMERIC(38,0) player ratings → long;
TIMESTAMP_NTZ → timestamp_ntz.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

DDL = {
    "transactions": "transaction_id string, customer_id string, transaction_date timestamp_ntz, "
                    "amount double, currency string, transaction_type string, channel string, "
                    "merchant_name string, merchant_category string, location_country string, "
                    "location_city string, is_flagged boolean",
    "customers": "customer_id string, first_name string, last_name string, date_of_birth date, "
                 "gender string, email string, phone_number string, address string, city string, "
                 "country string, occupation string, income_bracket string, customer_since date",
    "accounts": "account_id string, customer_id string, account_type string, account_status string, "
                "open_date date, current_balance double, currency string, credit_limit double",
    "credit_data": "customer_id string, credit_score int, number_of_credit_accounts int, "
                   "total_credit_limit double, total_credit_used double, "
                   "number_of_late_payments int, bankruptcies int",
    "watchlist": "entity_id string, entity_name string, entity_type string, risk_category string, "
                 "listed_date date, source string",
    "person_master": "id string, name string, age int, location string, zip string, "
                     "filename string, filerownumber long, ingestedtimestamp timestamp_ntz",
    "person_age": "name string, age int",
    "person_location": "name string, location string",
    "list_table": "username string, is_live boolean",
    "info_table": "username string, followers long, country string, joined date, location string, "
                  "name string, player_id string, status string, title string, primary_key long",
    "stats_table": "last_blitz long, draw_blitz long, loss_blitz long, win_blitz long, "
                   "last_bullet long, draw_bullet long, loss_bullet long, win_bullet long, "
                   "last_rapid long, draw_rapid long, loss_rapid long, win_rapid long, "
                   "fide long, primary_key long",
    "emp_basic": "first_name string, last_name string, email string, streetaddress string, "
                 "city string, start_date date",
}

KEYS = {
    "transactions": "transaction_id",
    "customers": "customer_id",
    "accounts": "account_id",
    "credit_data": "customer_id",
    "watchlist": "entity_id",
    "person_master": "id",
}

# The positional customer file: ordinal -> column name; ordinal 15 unused.
FILE_CUSTOMER_POSITIONS = {
    1: "C_CUSTOMER_SK", 2: "C_CUSTOMER_ID", 3: "C_CURRENT_CDEMO_SK", 4: "C_CURRENT_HDEMO_SK",
    5: "C_CURRENT_ADDR_SK", 6: "C_FIRST_SHIPTO_DATE_SK", 7: "C_FIRST_SALES_DATE_SK",
    8: "C_SALUTATION", 9: "C_FIRST_NAME", 10: "C_LAST_NAME", 11: "C_PREFERRED_CUST_FLAG",
    12: "C_BIRTH_DAY", 13: "C_BIRTH_MONTH", 14: "C_BIRTH_YEAR", 16: "C_LOGIN",
    17: "C_EMAIL_ADDRESS", 18: "C_LAST_REVIEW_DATE",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(DDL[name])


class _Schemas(dict):
    """Parsed on first use: DDL parsing needs a live session."""

    def __missing__(self, name: str) -> StructType:
        self[name] = schema(name)
        return self[name]


SCHEMAS = _Schemas()
