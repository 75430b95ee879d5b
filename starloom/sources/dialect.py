"""CSV options shared by the writer and the reader of extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for a backslash, a line feed and a carriage return in a lossless extract.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def dialect_options(lossless: bool) -> dict[str, object]:
    """Options of the plain or the lossless dialect.

    The plain dialect trims outer blanks and turns empty text into NULL on reading.
    The lossless one keeps both, doubles quotes instead of escaping them, and escapes line
    ends in texts (see ``escaped``), so that a line is a record and files can be split.
    """
    if not lossless:
        return {"header": True}
    return {
        "header": True,
        "nullValue": "\\N",
        "quote": '"',
        "escape": '"',
        "lineSep": "\n",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def _texts(df: DataFrame, change: object) -> DataFrame:
    return df.withColumns({f.name: change(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)})


def escaped(df: DataFrame) -> DataFrame:
    """``df`` with the backslashes and line ends of its texts escaped; backslashes first."""

    def change(text: Column) -> Column:
        for plain, code in ESCAPES:
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text

    return _texts(df, change)


def unescaped(df: DataFrame) -> DataFrame:
    """The inverse of ``escaped``; backslashes last, as every other code holds one."""

    def change(text: Column) -> Column:
        for plain, code in reversed(ESCAPES):
            text = F.replace(text, F.lit(code), F.lit(plain))
        return text

    return _texts(df, change)
