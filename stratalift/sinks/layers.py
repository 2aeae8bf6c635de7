"""File layers. A write that fails raises."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stratalift.staging import delete_folder, list_folder, make_file

RUN_DATE = "run_date"
MAX_RECORDS_PER_FILE = 1_000_000
VERSION, MARK = "version-", "_current-"


def write_layer(
    df: DataFrame, path: str, fmt: str = "parquet", max_records: int = MAX_RECORDS_PER_FILE
) -> None:
    """Overwrite a layer's table, schema included."""
    _writer(df, fmt, max_records).option("overwriteSchema", "true").save(path)


def publish_layer(
    df: DataFrame, path: str, fmt: str = "parquet", max_records: int = MAX_RECORDS_PER_FILE, keep: int = 1
) -> str:
    """Write a layer's new version beside the old one and then make it the current one.

    Until the new rows are whole, and where writing them fails, ``read_layer`` gives the old
    ones, so ``df`` may read the very layer. A version is a folder; an empty file whose name
    holds a number and the version makes it current, which is one step in any store, without a
    rename. ``keep`` older versions stay for those who read them still. Returns the folder.
    """
    spark = df.sparkSession
    number, _ = max(marks(spark, path), default=(0, ""))
    version = f"{VERSION}{uuid.uuid4().hex}"
    place = f"{path.rstrip('/')}/{version}"
    try:
        _writer(df, fmt, max_records).save(place)
    except Exception:
        delete_folder(spark, place)
        raise
    make_file(spark, f"{path.rstrip('/')}/{MARK}{number + 1:012d}-{version}")
    old = sorted(marks(spark, path))[: -1 - keep]
    for at, gone in old:
        delete_folder(spark, f"{path.rstrip('/')}/{MARK}{at:012d}-{gone}")
        delete_folder(spark, f"{path.rstrip('/')}/{gone}")
    return place


def marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and version of every version that was made current."""
    names = [n.removeprefix(MARK) for n in list_folder(spark, path) if n.startswith(MARK)]
    return [(int(at), version) for at, _, version in (n.partition("-") for n in names)]


def current_path(spark: SparkSession, path: str) -> str:
    """Where a layer's rows are: its current version, or the path itself of an unversioned one."""
    _, version = max(marks(spark, path), default=(0, ""))
    return f"{path.rstrip('/')}/{version}" if version else path


def dated_snapshot(
    df: DataFrame,
    path: str,
    run_date: date | str,
    fmt: str = "parquet",
    max_records: int = MAX_RECORDS_PER_FILE,
    publish: bool = False,
) -> None:
    """Overwrite one day of a table kept by run date; other days stay as they are.

    The day's folder is written as such, not as a dynamic partition: a day
    without rows then replaces what was there before, and keeps its schema. With
    ``publish`` the day has versions, as ``publish_layer`` writes them.
    """
    if publish:
        publish_layer(df.drop(RUN_DATE), dated_path(path, run_date), fmt, max_records)
        return
    _writer(df.drop(RUN_DATE), fmt, max_records).save(dated_path(path, run_date))


def dated_path(path: str, run_date: date | str) -> str:
    return f"{path.rstrip('/')}/{RUN_DATE}={date.fromisoformat(str(run_date))}"


def _writer(df: DataFrame, fmt: str, max_records: int):
    return df.write.format(fmt).mode("overwrite").option("maxRecordsPerFile", max_records)
