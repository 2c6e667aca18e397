from strata.sources.tables import (OFFLINE_COLUMNS, OFFLINE_SCHEMA, ONLINE_COLUMNS, ONLINE_SCHEMA, Tables,
                                  read_sales_csv, read_table, text_schema, write_csv)

__all__ = ["OFFLINE_COLUMNS", "OFFLINE_SCHEMA", "ONLINE_COLUMNS", "ONLINE_SCHEMA", "Tables",
           "read_sales_csv", "read_table", "text_schema", "write_csv"]
