"""Column names and declared schemas.

Our names are snake_case.  The raw CSV headers of the retail data set map
onto them as listed in ``RAW_SALES_HEADER`` / ``RAW_STORE_HEADER``.
Sales are integer cents (``sales_cents``); ``sales`` in euros is derived
only in final outputs.
"""

from pyspark.sql import types as T

SALES_COLUMNS = ["store", "date", "open", "sales_cents", "customers", "promo",
                 "state_holiday", "school_holiday"]
STORE_COLUMNS = ["store", "store_type", "assortment", "competition_distance",
                 "promo_interval"]

# Header of the raw daily sales file, in file order.
RAW_SALES_HEADER = ["Store", "DayOfWeek", "Date", "Sales", "Customers", "Open",
                    "Promo", "StateHoliday", "SchoolHoliday"]
# The store-file columns the pipeline uses.
RAW_STORE_HEADER = ["Store", "StoreType", "Assortment", "CompetitionDistance",
                    "PromoInterval"]

RAW_SALES_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Sales", T.DecimalType(18, 2)),
    T.StructField("Customers", T.LongType()),
    T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
])

RAW_STORE_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("PromoInterval", T.StringType()),
])

SALES_SCHEMA = T.StructType([
    T.StructField("store", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.IntegerType()),
    T.StructField("sales_cents", T.LongType()),
    T.StructField("customers", T.LongType()),
    T.StructField("promo", T.IntegerType()),
    T.StructField("state_holiday", T.StringType()),
    T.StructField("school_holiday", T.IntegerType()),
])
