from starloom.sinks.csv_extract import run_path, write_csv_extract
from starloom.sinks.jdbc import append_jdbc, in_transaction, jdbc_appender, jdbc_publisher, publish_jdbc, warehouse_creator
from starloom.sinks.load import append_new_keys, new_rows, preview, require_loaded, stage, write_both
from starloom.sinks.runs import FileWarehouse

__all__ = [
    "FileWarehouse",
    "append_jdbc",
    "append_new_keys",
    "in_transaction",
    "jdbc_appender",
    "jdbc_publisher",
    "new_rows",
    "preview",
    "publish_jdbc",
    "require_loaded",
    "run_path",
    "stage",
    "warehouse_creator",
    "write_both",
    "write_csv_extract",
]
