import zlib
from collections import Counter, defaultdict

import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from variantrank.llm import kdtree
from variantrank.llm.common import components, number_rows


def dimensions():
    return {"size": F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1), "lang": F.crc32(F.col("lang")), "id": F.col("doc_id")}


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_bytes_are_balanced_and_copies_stay_together(spark, shards):
    rows = [(i, prose(i % 400, 20 + i % 37), "en" if i % 3 else "de", "s") for i in range(800)]  # noqa: F405
    rows += [(1000 + i, "a copy of a text that makes up a large share " * 2, "en", "s") for i in range(700)]
    got = kdtree.shard(documents(spark, rows), shards, dimensions()).collect()  # noqa: F405
    texts = {r[0]: r[1] for r in rows}
    assert Counter(r.doc_id for r in got) == Counter(texts.keys())
    total, by_shard, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        total[r.shard] += r.size
        by_shard[r.shard].append(r.slot)
        groups[data].add(r.shard)
    assert set(total) == set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    mean = sum(total.values()) / shards
    assert all(abs(v - mean) < 0.06 * mean for v in total.values())
    assert sum(len(v) > 1 for k, v in groups.items() if not k.startswith(b"a copy")) <= 4 * shards


def test_odd_and_empty(odd, none, odd_rows):
    got = kdtree.shard(odd, 4, dimensions()).collect()
    assert len(got) == len(odd_rows)
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (100, 101)} == {(1, 0)}
    assert kdtree.shard(none, 4, dimensions()).count() == 0


def test_number_rows(spark):
    df = spark.range(5000).selectExpr("nullif(id % 3, 2) AS g", "(id * 7919) % 5000 AS v", "id AS n")
    got = defaultdict(list)
    for r in number_rows(df, ["g"], ["v"], "at", ordered=True).collect():
        got[r.g].append((r.at, r.v))
    for rows in got.values():
        rows.sort()
        assert [at for at, _ in rows] == list(range(len(rows)))
        assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (300, 200), (300, 400), (7, 7), (9, 9), (500, 500)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | dict.fromkeys((100, 200, 300, 400), 100)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
