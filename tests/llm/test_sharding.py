from collections import Counter

from pyspark.sql import functions as F

from ratingsmith.llm import sharding


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, slot string, row string, place long, size long")


def rows_of():
    big = [(i, "hot", f"t{i}", "x", "y", i, 0) for i in range(300)]
    same = [(7, "copies", "same", None, None, None, None)] * 150          # one row, many times
    few = [(1000 + i, f"s{i}", None, "", "", 0, 0) for i in range(57)]    # sources of one row
    return big + same + few + [(None, None, "", None, None, 1, 1)] * 30


def test_counts_slots_and_mixture(spark):
    df = table(spark, rows_of())
    out = sharding.assign(df, shards=7)
    assert out.columns == ["doc_id", "source", "text", "slot", "row", "place", "size", "shard"]
    got = out.collect()
    assert Counter((r.doc_id, r.source, r.text) for r in got) == Counter((r[0], r[1], r[2]) for r in rows_of())
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    sizes = [len(v) for v in by.values()]
    assert set(by) == set(range(7)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    for source, n in Counter(r[1] for r in rows_of()).items():
        for v in by.values():
            assert abs(sum(r.source == source for r in v) - n / 7) <= 2.5
    # one-row sources are not heaped up in one shard
    assert max(sum((r.source or "").startswith("s") for r in v) for v in by.values()) <= 25


def test_rows_are_shuffled_and_reruns_agree(spark):
    df = table(spark, rows_of())
    order = F.hash("doc_id", "text")
    a, b = (sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in sharding.assign(df, 7, order=order).collect()) for _ in range(2))
    assert a == b
    hot = [r.doc_id for r in sorted(sharding.assign(df, 1).collect(), key=lambda r: r.slot) if r.source == "hot"]
    assert hot != sorted(hot)


def test_few_rows_and_none(spark):
    assert sharding.assign(table(spark, [])).collect() == []
    got = sharding.assign(table(spark, rows_of()[:3]), shards=40).collect()
    assert len({r.shard for r in got}) == 3 and {r.slot for r in got} == {0}


def test_written_shards_hold_their_rows(spark, tmp_dir):
    out = sharding.assign(table(spark, rows_of()), shards=5)
    sharding.write(out, f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert Counter((r.shard, int(r.slot)) for r in back.collect()) == Counter((r.shard, int(r.slot)) for r in out.collect())
