"""Where tables go that a run makes for itself, and what it leaves on disk besides."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Lets Spark delete the shuffle files of a statement when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name in ``spark.checkpoint.dir``; below a local temporary folder only in a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{tempfile.gettempdir()}/finmarts-{spark.sparkContext.applicationId}"
        os.makedirs(folder, exist_ok=True)
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Statements that write a table inside leave no shuffle files.

    Without it these stay until the driver happens to collect the statement's plan, so that a run of many writes holds
    the shuffles of all of them. A plan that is run again makes its shuffles again.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
