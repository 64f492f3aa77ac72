"""Numbered commit files.  File ``n`` of a folder is created once and whole, by whoever comes first.

A writer that loses the race works its content out again for the next number, so two writers
never get the same number and never overwrite each other.  Only names and single small files pass the driver.
"""

import json
import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

NAME = re.compile(r"^([0-9]{12})\.json$")


def file_system(spark: SparkSession, folder: str) -> tuple:
    """The Hadoop file system of ``folder`` and the folder's path in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


def numbers(spark: SparkSession, folder: str) -> list:
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return []
    found = (NAME.match(status.getPath().getName()) for status in fs.listStatus(path))
    return sorted(int(m.group(1)) for m in found if m)


def read(spark: SparkSession, folder: str, number: int) -> dict:
    fs, path = file_system(spark, _file(folder, number))
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, folder: str) -> dict:
    """Content of the greatest number; empty before the first commit."""
    taken = numbers(spark, folder)
    return read(spark, folder, taken[-1]) if taken else {}


def _rename_to_new(spark: SparkSession, source, target) -> bool:
    """Rename unless the target exists, which the file system decides in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, none)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def _create(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Whether the file was new.  It is written under a hidden name first, so no reader sees half of it."""
    fs, hidden = file_system(spark, f"{folder}/.{uuid.uuid4().hex}")
    _, target = file_system(spark, _file(folder, number))
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return _rename_to_new(spark, hidden, target)
        # Hadoop looks and renames in two steps on local disks; a hard link is one.
        os.link(hidden.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(hidden, False)


def commit(spark: SparkSession, folder: str, make, attempts: int = 1000) -> int:
    """Create the next file with ``make(number, before)`` and return its number; ``before`` is the content of the last."""
    for _ in range(attempts):
        taken = numbers(spark, folder)
        number = taken[-1] + 1 if taken else 1
        if _create(spark, folder, number, make(number, read(spark, folder, taken[-1]) if taken else {})):
            return number
    raise RuntimeError(f"{attempts} lost races for the next file of {folder}")
