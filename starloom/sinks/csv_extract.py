"""CSV extracts, one directory per table and run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.sources.dialect import dialect_options, escaped

ROWS_PER_FILE = 2_000_000
BYTES_PER_FILE = 256 * 1024 * 1024


def run_path(base: str, table: str, run_id: str | int) -> str:
    """``<base>/<table>/<run_id>.csv``, a directory of part files.

    The run id comes from the caller; a clock reading would differ on a rerun.
    """
    return f"{base.rstrip('/')}/{table}/{run_id}.csv"


def write_csv_extract(
    df: DataFrame,
    path: str,
    lossless: bool = False,
    rows_per_file: int | None = None,
    replace: bool = False,
    bytes_per_file: int = BYTES_PER_FILE,
    compression: str | None = None,
) -> None:
    """Write an extract with header; an existing path raises, or is replaced on demand.

    Files hold ``rows_per_file`` rows at most. Without that number, frames with text are measured
    in a scan of their own (so pass a staged frame): a file of a plain extract, which is
    read by one task, then holds no more than ``bytes_per_file`` or one row; files of a lossless
    one, which can be split, hold that much on average. ``compression`` names a codec of Spark's
    CSV writer, whose reader knows it by the file name; bytes are counted before it, and a
    compressed file is read by one task.
    """
    if rows_per_file is None:
        rows_per_file = _rows_within(df, bytes_per_file, lossless)
    (
        (escaped(df) if lossless else df)
        .write.options(maxRecordsPerFile=rows_per_file, compression=compression or "none", **dialect_options(lossless))
        .mode("overwrite" if replace else "errorifexists")
        .csv(path)
    )


def _rows_within(df: DataFrame, most: int, on_average: bool) -> int:
    """How many rows fit ``most`` bytes, as their longest or their mean; quoting can double a text."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return ROWS_PER_FILE
    lengths = " + ".join([f"{32 * len(df.columns)}L", *(f"2 * coalesce(octet_length(`{c}`), 0L)" for c in text)])
    size = df.selectExpr(f"avg({lengths}) AS n" if on_average else f"max({lengths}) AS n").first()["n"]
    return ROWS_PER_FILE if size is None else max(1, min(ROWS_PER_FILE, int(most // size)))
