"""Table contracts: types of the operational tables and of the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
INT, LONG, TEXT, BOOL = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
DATE, TIME = T.DateType(), T.TimestampType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Source layout A: integer keys, local-language names, stored total.
LAYOUT_A = {
    "cities": _table(
        city_id=INT, city_ar=TEXT, is_active=BOOL, created_at=TIME,
    ),
    "customers": _table(
        customer_id=LONG, full_name=TEXT, phone=TEXT, city_id=INT, signup_date=TIME,
    ),
    "products": _table(
        product_id=LONG, product_name=TEXT, category=TEXT, unit_price=INT, is_active=BOOL,
    ),
    "orders": _table(
        order_id=TEXT, customer_id=LONG, product_id=LONG, quantity=INT, unit_price_at_sale=INT,
        total_price=LONG, order_date=TIME,
    ),
}

# Source layout B: text keys, English names, no stored total.
LAYOUT_B = {
    "clients": _table(
        client_id=TEXT, client_name=TEXT, msisdn=TEXT, city_en=TEXT, registered_at=DATE,
        inserted_ts=TIME,
    ),
    "items": _table(
        item_id=TEXT, item_name=TEXT, item_type=TEXT, price_syp=T.DecimalType(12, 2),
    ),
    "transactions": _table(
        tx_id=TEXT, client_id=TEXT, item_id=TEXT, qty=INT, price_at_tx=T.DecimalType(12, 2),
        tx_date=DATE, tx_time=TEXT, inserted_ts=TIME,
    ),
}

# Mapping files.
CITY_MAP = _table(
    ar=TEXT, en=TEXT,
)
CATALOG = _table(
    offering_id=TEXT, category=TEXT, local_name=TEXT, local_price=TEXT, mapped_category=TEXT,
    english_name=TEXT, english_price=TEXT,
)

# Warehouse. Surrogate keys of unbounded tables are BIGINT.
DIM_COMPANY = _table(
    company_sk=INT, company_code=TEXT, company_name_ar=TEXT, company_name_en=TEXT,
)
DIM_DATE = _table(
    date_sk=INT, full_date=DATE, year=INT, quarter=INT, month=INT, month_name=TEXT, day=INT,
    day_of_week=INT, is_weekend=BOOL,
)
DIM_CUSTOMER = _table(
    customer_sk=LONG, source_system=TEXT, source_customer_id=TEXT, full_name=TEXT,
    phone_e164=TEXT, city=TEXT, signup_date=DATE, etl_loaded_at=TIME, etl_batch_id=TEXT,
)
DIM_PRODUCT = _table(
    product_sk=LONG, source_system=TEXT, source_product_id=TEXT, product_name_en=TEXT,
    category=TEXT, unit_price_syp=MONEY, etl_loaded_at=TIME, etl_batch_id=TEXT,
)
FACT_SALES = _table(
    date_sk=INT, customer_sk=LONG, product_sk=LONG, company_sk=INT, quantity=INT,
    unit_price_syp=MONEY, total_amount_syp=MONEY, source_order_id=TEXT, etl_loaded_at=TIME,
    etl_batch_id=TEXT,
)
ETL_RUNS = _table(
    batch_id=TEXT, mode=TEXT, started_at=TIME, finished_at=TIME, rows_extracted=LONG,
    rows_loaded=LONG, rows_quarantined=LONG, status=TEXT, notes=TEXT, logged_at=TIME, feeds=TEXT,
)
ETL_ERRORS = _table(
    batch_id=TEXT, source_system=TEXT, source_table=TEXT, source_row=TEXT, reason_code=TEXT,
    reason=TEXT, occurred_at=TIME,
)

CUSTOMER_ATTRIBUTES = ["full_name", "phone_e164", "city", "signup_date"]
PRODUCT_ATTRIBUTES = ["product_name_en", "category", "unit_price_syp"]
CUSTOMER_KEY = ["source_system", "source_customer_id"]
PRODUCT_KEY = ["source_system", "source_product_id"]
FACT_KEY = ["company_sk", "source_order_id"]
FACT_COLUMNS = [
    "date_sk", "customer_sk", "product_sk", "company_sk",
    "quantity", "unit_price_syp", "total_amount_syp", "source_order_id",
]
# Which of several copies of one order is the first: earliest date, then the rest.
FACT_ORDER = [
    "date_sk", "product_sk", "quantity", "unit_price_syp", "total_amount_syp", "customer_sk",
]
CATEGORIES = ["INTERNET", "VOICE", "BUNDLE"]
