"""Small helpers around the Spark session."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package, wherever the driver was started.

    On a cluster the package is installed or sent with --py-files; an unknown folder does no harm.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where a session on this machine alone names none, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or tempfile.mkdtemp(prefix="capstream-")
