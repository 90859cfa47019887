"""Session set-up and the shared folder used for written intermediates."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "rateflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans in this package are written for.

    Partition counts are left to AQE: start with many shuffle partitions on a
    cluster (``spark.sql.shuffle.partitions``) and let it coalesce.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where that is unset *and* the master is
    local, as in tests: executors on other machines could not read it. It is
    removed when the process ends; the shared folder is the cluster's to clean.
    """
    unique = f"{label}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{unique}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return f"{_local_folder()}/{unique}"
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="rateflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
