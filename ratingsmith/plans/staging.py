"""Tables staged once per application and input, below the shared checkpoint folder.

``staged`` writes a table the first time it is asked for and reads it back from
then on.  The key holds the metadata of the input files (path, size, time; no
data is read for it), so a changed input is staged anew.  Checks, windows and
reports over the same star then scan one written table each instead of building
it again, and a lost executor never recomputes beyond it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ratingsmith.operators.runlog import listing_metadata
from ratingsmith.session import workspace

_written: dict[tuple[str, str, str], str] = {}


def input_key(spark: SparkSession, sf_dir: str, tables: Sequence[str]) -> str:
    """One value that changes whenever a file of the named tables does."""
    return "-".join(str(listing_metadata(spark, f"{sf_dir}/{t}.parquet", t).first()["etag"]) for t in tables)


def staged(spark: SparkSession, name: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    app = spark.sparkContext.applicationId
    at = (app, name, key)
    if at not in _written:
        path = workspace(spark, "staged", app, key, name)
        build().write.mode("overwrite").parquet(path)
        _written[at] = path
    return spark.read.parquet(_written[at])
