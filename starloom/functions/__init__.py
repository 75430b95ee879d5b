from starloom.functions.dates import calendar_columns, date_key, year_quarter

__all__ = ["calendar_columns", "date_key", "year_quarter"]
