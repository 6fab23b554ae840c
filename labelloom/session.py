"""Session settings and the folder shared by the driver and the executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
SHARED_DIR = "labelloom.shared.dir"


def local_session(cores: str = "*", app_name: str = "labelloom", **settings: str) -> SparkSession:
    """A session on this machine, for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else in ``labelloom.shared.dir``.

    The second is a setting of a running session, for those started without the first.
    """
    for setting in (_CHECKPOINT_DIR, SHARED_DIR):
        if folder := spark.conf.get(setting, None):
            return folder.rstrip("/")
    raise RuntimeError(
        f"Set {_CHECKPOINT_DIR}, or {SHARED_DIR} in a running session, to a folder that the driver "
        "and all executors share."
    )


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path not used before inside the shared folder."""
    return f"{shared_folder(spark)}/labelloom/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """The name of a database in the shared folder; it goes, with the tables it manages, when the
    block ends."""
    name = f"labelloom_{uuid.uuid4().hex}"
    path = new_folder(spark, "scratch").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
