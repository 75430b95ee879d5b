from starloom.sources.files import read_csv_extract
from starloom.sources.jdbc import JdbcConnection, KeyRange, highest_key, key_predicates, key_range, read_jdbc_table
from starloom.sources.session import object_store_conf, remove_folder, scratch_folder, shared_folder
from starloom.sources.views import register_views

__all__ = [
    "JdbcConnection",
    "KeyRange",
    "highest_key",
    "key_predicates",
    "key_range",
    "object_store_conf",
    "read_csv_extract",
    "read_jdbc_table",
    "register_views",
    "remove_folder",
    "scratch_folder",
    "shared_folder",
]
