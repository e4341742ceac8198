"""Sources: the fact and dimension tables."""

from shopcast.sources.schemas import (  # noqa: F401
    SALES_COLUMNS, STORE_COLUMNS, RAW_SALES_SCHEMA, RAW_STORE_SCHEMA)
from shopcast.sources.tables import (  # noqa: F401
    daily_sales, stores, load, register)
from shopcast.sources.files import (  # noqa: F401
    read_sales, read_stores, read_table)
