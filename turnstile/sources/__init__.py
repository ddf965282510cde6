from turnstile.sources.files import (
    Config,
    read_config,
    read_configured,
    read_csv,
    read_table,
    write_csv,
)
from turnstile.sources.fixtures import cust_emp, emp, table

__all__ = ["Config", "read_config", "read_configured", "read_csv", "read_table",
           "write_csv", "cust_emp", "emp", "table"]
