"""Folders that the driver and all executors share."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that executors and the driver share, from spark.checkpoint.dir; one of our own only where that is unset and all run in one process, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="loomspan-ckpt-")
            atexit.register(shutil.rmtree, folder, True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def discard(folder: str) -> None:
    """Removes a folder of ours, if it is there."""
    fs, root = file_system(folder)
    if fs.get_file_info(root).type != pafs.FileType.NotFound:
        fs.delete_dir(root)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it goes when the driver's process ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(discard, folder)
    return folder


def keeper(spark: SparkSession, folder: str | None = None) -> Callable[[str, DataFrame], DataFrame]:
    """Each step is written once, to the folder or one that goes with the driver's process, and read back. A lost executor repeats tasks of one step, not of all before it."""
    folder = folder or scratch(spark, "evidence")

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return keep
