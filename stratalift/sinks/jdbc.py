"""Database targets."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from stratalift.staging import staged

PARTITIONS = 40
BATCH_ROWS = 10_000
ATTEMPTS = 10
DELAY_SECONDS = 5.0


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    driver: str,
    partitions: int = PARTITIONS,
    batch: int = BATCH_ROWS,
    attempts: int = ATTEMPTS,
    delay: float = DELAY_SECONDS,
    properties: Mapping[str, str] | None = None,
    save: Callable[[DataFrame, Mapping[str, str]], None] | None = None,
) -> None:
    """Overwrite a database table over at most ``partitions`` connections.

    Every attempt is a whole overwrite, so trying again is safe. After the last
    attempt its error is raised. ``save`` replaces the JDBC writer. The rows are staged
    once, so that another attempt does not compute them again, and partitions are only put
    together, never shuffled.
    """
    options = {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "driver": driver,
        "batchsize": str(batch),
    }
    with staged(df, "jdbc") as rows:
        for attempt in range(1, attempts + 1):
            try:
                return (save or _save)(rows.coalesce(partitions), options)
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(delay)


def _save(df: DataFrame, options: Mapping[str, str]) -> None:
    df.write.format("jdbc").mode("overwrite").options(**options).save()
