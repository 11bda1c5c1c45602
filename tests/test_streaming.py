import os

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ratingsmith.sources.contracts import RATINGS
from ratingsmith.streaming.ingest import ingest_new_files


def _read(spark, target):
    schema = StructType(RATINGS.schema.fields + [StructField("line", StringType()),
                                                 StructField("malformed", BooleanType())])
    return spark.read.schema(schema).parquet(target)


def _file(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(("userId,movieId,rating,timestamp", *lines, "")))


def _good(spark, target):
    return sorted(tuple(r) for r in _read(spark, target).filter(~F.col("malformed")).select("userId", "rating").collect())


def test_ingest_only_new_files(spark, tmp_dir):
    src, target = (os.path.join(tmp_dir, x) for x in ("in", "out"))
    _file(src, "a.csv", "1,2,3.5,100", "bad,1,1,1")
    assert ingest_new_files(spark, src, RATINGS, target)
    assert not ingest_new_files(spark, src, RATINGS, target)     # nothing new: no duplicates
    df = _read(spark, target)
    assert df.filter(~F.col("malformed")).count() == 1 and df.filter("malformed").count() == 1
    _file(src, "b.csv", "2,2,4.0,200")
    assert ingest_new_files(spark, src, RATINGS, target)
    assert _good(spark, target) == [(1, 3.5), (2, 4.0)]


def test_targets_of_one_name_do_not_share_progress(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    x, y = (os.path.join(tmp_dir, d, "ratings") for d in "xy")
    _file(src, "a.csv", "1,2,3.5,100")
    ingest_new_files(spark, src, RATINGS, x)
    ingest_new_files(spark, src, RATINGS, y)
    assert _good(spark, x) == _good(spark, y) == [(1, 3.5)]
    _file(src, "b.csv", "7,2,4.0,200")
    ingest_new_files(spark.newSession(), src, RATINGS, x)        # another session goes on where the last stopped
    assert _good(spark, x) == [(1, 3.5), (7, 4.0)]
