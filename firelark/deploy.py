"""Brings this package to executors that don't have it on their path, and names the folder that they share."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset and the master is local (tests, one machine) a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="firelark-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return f"file://{_LOCAL[app]}"


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the workers, once an application."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    d = tempfile.mkdtemp(prefix="firelark-")  # executors may ask for the file as long as the driver runs
    atexit.register(shutil.rmtree, d, True)
    path = os.path.join(d, "firelark_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("firelark", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)
