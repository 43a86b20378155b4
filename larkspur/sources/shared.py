"""Where jobs put the tables they write between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_own_folder: str | None = None


def use_folder(path: str) -> None:
    """Name the shared folder for sessions whose cluster names none, as in tests."""
    global _own_folder
    _own_folder = path


def named_folder(spark: SparkSession) -> str | None:
    """The folder that the session's ``spark.checkpoint.dir`` names, if any."""
    return spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)


def shared_folder(spark: SparkSession) -> str:
    """Root folder for intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``; :func:`use_folder` sets
    one only for sessions without that setting.
    """
    folder = named_folder(spark) or _own_folder
    if not folder:
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return folder.rstrip("/")


def _work_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/larkspur-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table, under this application's work folder."""
    return f"{_work_root(spark)}/{label}-{uuid.uuid4().hex}"


def delete_work(spark: SparkSession, path: str) -> None:
    """Delete one table of the work folder, if it is there."""
    if not path.startswith(_work_root(spark)):
        raise ValueError(f"{path} is not in the work folder")
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def clear_work(spark: SparkSession) -> None:
    """Delete every table this application has put in its work folder.

    Call it when nothing read from those tables is needed any more.
    """
    delete_work(spark, _work_root(spark))
