"""Stored indexes against reading all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import indexes, serving
from tests.conftest import DATA


def files_read(df):
    """Directories of a partitioned table that a plan's scans ask for."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]


def test_search_finds_what_a_scan_finds(spark):
    rng = random.Random(1)
    words = ["cafe", "카페", "é", "aaa", "ab", "a", "🙂x", "%_", "o'b", ""]
    rows = [(k, "".join(rng.choice(words) for _ in range(rng.randrange(4)))) for k in range(300)] + [(300, None), (301, "x" * 5000), (301, "twice")]
    markers = spark.createDataFrame(rows, "id long, form string").selectExpr("*", "1 as n", "id as `a.b`")
    index = indexes.write_search_index(markers, "id", "form")
    for asked in [" ", "a", "aa", "aaaa", "카페e", "🙂", "%_", "ＣＡＦＥ", "zzz", "xxxxx"]:
        found = indexes.indexed_search(spark, index, asked)
        want = serving.search(markers, F.col("form"), asked)
        assert set(found.columns) == set(markers.columns)
        assert sorted((r["id"], r["form"]) for r in found.collect()) == sorted((r["id"], r["form"]) for r in want.collect()), asked
    met = indexes.candidates(spark, index, "cafe")
    assert any("bucket" in part for part in files_read(met))


def boxes_of(rng, points, n):
    out = []
    for k in range(n):
        a, b = (rng.choice(points) if rng.random() < 0.5 else (rng.uniform(-2, 12), rng.uniform(-2, 12)) for _ in range(2))
        south, north = (min(a[0], b[0]), max(a[0], b[0])) if rng.random() < 0.95 else (a[0], b[0])
        west, east = min(a[1], b[1]), max(a[1], b[1])
        out.append((k, float(south), float(west), float(north), float(east)))
    return out


@pytest.mark.parametrize("points", ["spread", "one", "none"])
def test_a_thousand_boxes(spark, points):
    rng = random.Random(7)
    rows = {"spread": [(rng.choice([rng.uniform(0, 10), float(rng.randrange(11))]), rng.uniform(0, 10)) for _ in range(3000)], "one": [(5.0, 5.0)] * 9, "none": []}[points]
    table = spark.createDataFrame([*rows, (None, 1.0), (2.0, None), (float("nan"), 3.0)], "latitude double, longitude double")
    boxes = boxes_of(rng, rows or [(0.0, 0.0)], 1000)
    found = {r["box"]: (r["total"], r["in_view"]) for r in indexes.counts_in_boxes(spark, indexes.write_pyramid(table), boxes).collect()}
    assert found == {k: (len(rows) + 3, sum(s <= a <= n and w <= b <= e for a, b in rows)) for k, s, w, n, e in boxes}


def test_tiles_of_a_rectangle():
    rng = random.Random(3)
    side = 1 << indexes.LEVELS
    for _ in range(40):
        x0, x1, y0, y1 = (rng.randrange(side) for _ in range(4))
        tiles = indexes.inner_tiles(x0, y0, x1, y1)
        assert sum(4 ** (indexes.LEVELS - level) for level, _ in tiles) == max(0, x1 - x0 + 1) * max(0, y1 - y0 + 1)
        assert len(tiles) <= 4 * (abs(x1 - x0) + abs(y1 - y0) + 2)


def test_pages(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, rng.choice("가나abB"), rng.randrange(1, 9)) for k in range(700)]
    markers = spark.createDataFrame(rows, "business long, merchant string, visit_count long")
    columns = ["business", "merchant", "visit_count", "rank", "place"]
    got = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: r[4])
    for collation in (None, "ko"):
        want = got(serving.ranked(markers, collation))
        assert got(indexes.first_page(markers, 50, collation)) == want[:50]
        index = indexes.write_order(markers, collation)
        for number, size in ((0, 50), (3, 50), (6, 100), (7, 100), (9, 100), (0, 5000), (40, 17)):
            found = indexes.indexed_page(spark, index, number, size)
            assert got(found) == want[number * size : (number + 1) * size]
    assert any("part" in part for part in files_read(indexes.indexed_page(spark, index, 3, 50)))
    monkeypatch.setattr(indexes, "RANKS", 2)
    assert got(indexes.indexed_page(spark, indexes.write_order(markers), 2, 200)) == got(serving.ranked(markers))[400:600]
    plain = got(serving.ranked(markers))
    last = (plain[49][2], plain[49][1], plain[49][0])
    after = sorted(tuple(r) for r in indexes.page_after(markers, last, 50).select("business", "merchant", "visit_count").collect())
    assert after == sorted(r[:3] for r in plain[50:100])
    assert indexes.first_page(markers.limit(0), 50).count() == 0 and indexes.indexed_page(spark, indexes.write_order(markers.limit(0)), 0, 9).count() == 0


def test_first_page_is_a_bounded_top(spark):
    """Page 0 of the flagship query sorts and writes nothing whole."""
    from tallyweave.plans import places

    plan = places.flagship_serving(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
