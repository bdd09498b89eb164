from collections import Counter

import pytest

from llm.cases import frame
from conftest import rows
from shopgrain.llm import sharding as S


def check(got, n, shards):
    """Counts at most one apart, slots without gaps."""
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == n and max(sizes.values()) - min(
        [sizes.get(i, 0) for i in range(shards)]) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(size))


def test_every_shard_has_the_mixture(spark):
    data = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id bigint, source string")
    got = S.interleave(df, "source", 16, range_rows=64).collect()
    check(got, 3000, 16)
    whole = Counter(s for _, s in data)
    for shard in range(16):
        here = Counter(r["source"] for r in got if r["shard"] == shard)
        assert all(abs(here[s] - n / 16) <= 2 for s, n in whole.items())
    # Any stretch of a shard has it, too.
    half = Counter(r["source"] for r in got if r["shard"] == 5 and r["slot"] < 94)
    assert all(abs(half[s] - n / 32) <= 2 for s, n in whole.items())
    # The order is drawn: neighbours in id are not neighbours in a shard.
    first = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == 0)
    assert [x for _, x in first] != sorted(x for _, x in first)


@pytest.mark.parametrize("range_rows", [1, 50, 1 << 16])
def test_storage_and_ranges_change_nothing(spark, range_rows):
    data = [(i // 2, f"s{i % 5}" if i % 11 else None) for i in range(700)] + [(5, "copy")] * 300
    df = spark.createDataFrame(data, "doc_id bigint, source string")
    want = rows(S.interleave(df, "source", 7))
    assert rows(S.interleave(df.repartition(13, "doc_id"), "source", 7,
                             range_rows=range_rows)) == want
    assert rows(S.interleave(df, "source", 7, seed="another")) != want
    check(S.interleave(df, "source", 7).collect(), 1000, 7)


def test_brute_force(spark):
    import hashlib

    data = [(i, ["a", "b", None][i % 3 if i < 60 else 0]) for i in range(100)]
    df = spark.createDataFrame(data, "doc_id bigint, source string")

    def draw(*parts):
        text = "|".join(str(p) for p in parts if p is not None)
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    ranked = []
    for source in ("a", "b", None):
        mine = sorted((draw("shard", i, s), i) for i, s in data if s == source)
        phase = draw("shard", "phase", source) / 2**60
        ranked += [((r + phase) / len(mine), source is not None, source or "", i)
                   for r, (_, i) in enumerate(mine)]
    order = [x[-1] for x in sorted(ranked)]
    got = sorted((r["shard"], r["slot"], r["doc_id"]) for r in S.interleave(
        df, "source", 8, range_rows=8).collect())
    assert [x[-1] for x in got] == order


def test_odd_rows(spark):
    odd = frame(spark)
    got = S.interleave(odd, "source", 4)
    assert got.columns == odd.columns + ["shard", "slot"]
    assert rows(got.drop("shard", "slot")) == rows(odd)
    check(got.collect(), odd.count(), 4)
    clash = odd.selectExpr("*", "7 AS copies", "'x' AS row", "1.5D AS fraction", "3 AS shard",
                           "text AS stratum", "0 AS `n.x`", "9 AS slot", "source AS place")
    same = S.interleave(clash, "source", 4)
    assert sorted(same.columns) == sorted(clash.columns)
    assert rows(same.drop("shard", "slot")) == rows(clash.drop("shard", "slot"))
    check(same.collect(), odd.count(), 4)
    assert S.interleave(odd.limit(0), "source", 4).count() == 0


def test_written_shards(spark, tmp_path):
    odd = frame(spark)
    found = S.write_shards(odd, str(tmp_path / "out"), "source", 3, file_rows=2)
    assert rows(found.select(*odd.columns)) == rows(odd)
    check(found.collect(), odd.count(), 3)
    for part in (tmp_path / "out").glob("shard=*/*.parquet"):
        slots = [r["slot"] for r in spark.read.parquet(str(part)).collect()]
        assert slots == list(range(slots[0], slots[0] + len(slots))) and len(slots) <= 2
