"""Times the design choices behind the operators, on lineitem at ``$BENCH_SF_DIR``.

Prints one JSON line of seconds, the best of three runs each.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bench import session
from stratalift.plans.spec import EXPRESSIONS
from stratalift.functions import fitting_cast
from stratalift.operators import dataset_checksum, quality_report
from stratalift.plans import ColumnSpec, FileLayer, RunOptions, TableSpec, transfer
from stratalift.sinks import write_layer
from stratalift.staging import staging_path

COLUMNS = ("l_returnflag", "l_linestatus", "l_orderkey")
ALPHANUMERIC = EXPRESSIONS["alphanumeric"]


def best(work: Callable[[], object]) -> float:
    times = []
    for _ in range(3):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(min(times), 2)


def one_job_per_check(path_frame: Callable[[], DataFrame]) -> None:
    """The plain way: cache the table, then one counting job for every check."""
    rows = path_frame().persist(StorageLevel.MEMORY_AND_DISK)
    rows.count()
    for name in COLUMNS:
        text = F.col(name).cast("string")
        rows.where(F.col(name).isNull()).count()
        rows.where(text == "").count()
        rows.where(text.rlike(r"^\s+$")).count()
        rows.select(name).distinct().count()
        rows.where(text.rlike(ALPHANUMERIC)).count()
    rows.unpersist(blocking=True)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))

    def lines() -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    checks = {c: ("Null", "Blank", "Unique", "UserDefined:alphanumeric") for c in COLUMNS}
    regexes = EXPRESSIONS
    flags = F.col("l_returnflag")
    spec = TableSpec(
        "bench", "lines", tuple(ColumnSpec(c, quality=("Null", "Blank")) for c in COLUMNS)
    )
    root = staging_path(spark, "bench")
    layers = {"LZ": FileLayer(f"{root}/LZ"), "RZ": FileLayer(f"{root}/RZ")}
    write_layer(lines(), layers["LZ"].path)

    def hop(**more) -> None:
        transfer(spark, spec, "LZ", "RZ", layers, RunOptions("2025-03-01", **more))

    def count(value) -> None:
        lines().agg(F.count(value)).collect()

    seconds = {
        "quality report": best(lambda: quality_report(lines(), checks, regexes).collect()),
        "quality, one job per check": best(lambda: one_job_per_check(lines)),
        "checksum additive": best(lambda: dataset_checksum(lines(), "additive").collect()),
        "checksum tree": best(lambda: dataset_checksum(lines(), "tree").collect()),
        "failing casts, guarded": best(
            lambda: count(fitting_cast(flags, T.StringType(), T.IntegerType()))
        ),
        "failing casts, try_cast": best(lambda: count(flags.try_cast("int"))),
        "copy of the table": best(lambda: write_layer(lines(), layers["RZ"].path)),
        "hop with quality": best(lambda: hop()),
        "hop with quality and checksum": best(lambda: hop(integrity=True)),
    }
    spark.stop()
    print(json.dumps({"metric": "design choices", "unit": "sec", "seconds": seconds}))


if __name__ == "__main__":
    main()
