"""Session settings: object-store credentials and the shared working folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def object_store_conf(access_key: str, secret_key: str, endpoint: str) -> dict[str, str]:
    """Settings for ``SparkSession.builder.config(map=...)`` that open an S3-type store."""
    return {
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.endpoint": endpoint,
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a local session may do without the setting; it gets a folder in its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/starloom-work"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder of its own below the shared one, which lives as long as the block.

    A frame that reads from it must be written elsewhere before the block ends.
    """
    path = f"{shared_folder(spark)}/starloom/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove_folder(spark, path)
