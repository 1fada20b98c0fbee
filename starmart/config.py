"""Fixed values and defaults.

Everything in the "fixed values" block must stay as written: results,
log messages and metric names are compared against them.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values -----------------------------------------------------------
# First version of a new dimension member starts here, so that past sales find it.
FIRST_VALID_FROM = dt.date(1900, 1, 1)
# Stand-in for an open valid_to in range predicates.
OPEN_VALID_TO = dt.date(9999, 12, 31)
# Holidays as (month, day): 1 Jan, 1 May, 15 Aug, 25 Dec.
HOLIDAYS = [(1, 1), (5, 1), (8, 15), (12, 25)]
# Store type by store business key mod 3.
STORE_TYPES = ["Standard", "Outlet", "Flagship"]
# Metric names written by a load.
METRIC_CUSTOMER_ROWS = "dim_customer_rows_processed"
METRIC_PRODUCT_ROWS = "dim_product_rows_processed"
METRIC_STORE_ROWS = "dim_store_rows_processed"
METRIC_FACT_INSERTED = "fact_sales_inserted"
METRIC_FACT_TOTAL = "fact_sales_count_total"
METRIC_SALES_UNMATCHED = "sales_without_dimension"
# Event messages (prefix + business key).
MSG_INSERTED = {"customer": "Inserted new customer BK=", "product": "Inserted new product BK="}
MSG_SCD2_CHANGE = "SCD2 change for BK="
MSG_STORE_UPSERT = "Upsert store BK="
MSG_MARTS_RUN = "Refreshing Marts"
MSG_DIMENSIONS = "Dimensions loaded from staging"
MSG_FACT = "Fact sales loaded from staging"
MSG_MARTS_DONE = "All marts refreshed successfully"
# Columns that a loaded sale must have.
SALES_NOT_NULL = ("transaction_id", "quantity", "unit_price", "total_amount")
# Declared VARCHAR lengths of the staging tables, checked by the quality job.
VARCHAR_LIMITS = {
    "customers": {"first_name": 100, "last_name": 100, "email": 150, "gender": 10,
                  "country": 50, "city": 100},
    "stores": {"store_name": 200, "city": 100, "country": 50, "region": 50, "store_type": 50},
    "products": {"product_name": 300, "brand": 100, "category": 100, "subcategory": 100},
}
# --- end of fixed values ----------------------------------------------------

# Second batch used by the change scenarios (derived from the driver tables).
BATCH2_AS_OF = dt.date(1999, 1, 1)
INCREMENT_FROM = dt.date(1998, 7, 1)
INCREMENT_TO = dt.date(1999, 6, 30)

# Tracked attributes per dimension, in declaration order.
CUSTOMER_ATTRS = ["first_name", "last_name", "email", "gender", "country", "city", "birth_date"]
PRODUCT_ATTRS = ["product_name", "brand", "category", "subcategory", "catalog_price"]
STORE_ATTRS = ["store_name", "city", "country", "region", "store_type", "opening_date"]

FACT_COLUMNS = ["sales_key", "date_key", "customer_key", "store_key", "product_key",
                "transaction_id", "quantity", "unit_price", "total_amount", "discount_amount"]
