"""Components by star steps against a union-find; hubs and large keys."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweave import tables
from tallyweave.operators import graphs, reposts


def plain(links):
    """node -> least node that it reaches."""
    head = {}

    def find(x):
        while head.setdefault(x, x) != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        head[max(x, y)] = min(x, y)
    return {x: find(x) for x in head}


def made(seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(400 + k, 401 + k) for k in range(60)]  # a path
    links += [(999, 500 + k) if k % 2 else (500 + k, 999) for k in range(200)]  # a hub that is the largest
    links += [(1000, 1001 + k) for k in range(200)] + [(1100, 1400), (7, 7)]
    rng.shuffle(links)
    return links + links[:20]


@pytest.mark.parametrize("hot_rows", [10_000, 5])
def test_components(spark, monkeypatch, hot_rows):
    """Paths, hubs, repeated links and loops; hubs joined by shuffle and by broadcast."""
    monkeypatch.setattr(tables, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(tables, "HOT_SHARE", 50)
    links = made(hot_rows)
    found = graphs.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: v for k, v in plain(links).items() if k != v}
    assert {r["node"]: r["component"] for r in found} == want and len(found) == len(want)


def test_components_of_structs_and_none(spark):
    rows = [("x", 1, 2), ("x", 2, 3), ("y", 2, 3), ("y", 5, 4)]
    node = lambda c: F.struct("k", F.col(c).alias("v"))
    found = graphs.components(spark.createDataFrame(rows, "k string, p int, q int").select(node("p").alias("a"), node("q").alias("b")))
    assert sorted((*r["node"], *r["component"]) for r in found.collect()) == [("x", 2, "x", 1), ("x", 3, "x", 1), ("y", 3, "y", 2), ("y", 5, "y", 4)]
    assert graphs.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_expense_in_very_many_sources(spark):
    """An expense that 200,000 sources carry: one component, whose links no task holds."""
    n = 200_000
    counts = spark.range(n).select(F.col("id").alias("source"), F.explode(F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("own"), F.col("id").cast("string")))).alias("expense"), F.lit(1).cast("long").alias("n"))
    links = tables.cut_lineage(reposts._links_of_expenses(counts, reposts.repost_links(counts)))
    assert links.count() == 2 * (n - 1)
    node = lambda c: F.struct("expense", F.col(c).alias("source"))
    edges = links.select(node("b").alias("a"), node("a").alias("b"))
    both = tables.cut_lineage(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    assert least.agg(F.max("n")).first()[0] == n - 1
    dealt = [r["count"] for r in graphs._pointed(both, least).groupBy(F.spark_partition_id()).count().collect()]
    assert max(dealt) < 0.6 * sum(dealt) and len(dealt) > 2
    found = reposts.expense_components(counts, links).groupBy("expense").agg(F.count("*").alias("n"), F.max("component").alias("most"), F.min("component").alias("least"))
    shared = {r["expense"]: tuple(r)[1:] for r in found.where("not startswith(expense, 'own')").collect()}
    assert shared == {"a": (n, 0, 0), "b": (n, 0, 0)}
    assert found.where("startswith(expense, 'own') and n = 1").count() == n


def test_facts_of_hot_keys(spark, monkeypatch):
    """Hot keys, rare ones and null; rows without facts go; names that clash."""
    monkeypatch.setattr(tables, "HOT_ROWS", 10)
    monkeypatch.setattr(tables, "HOT_SHARE", 10)
    rows = spark.createDataFrame([("hot" if k % 2 else (None if k % 4 else f"r{k}"), k) for k in range(200)], "k string, _key int")
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("_key").alias("_own")).where("k is null or k <> 'r8'")
    found = sorted((tuple(r) for r in tables.with_facts(rows, facts, "k", "n").collect()), key=str)
    held = {r["k"]: r for r in facts.collect()}
    want = sorted(((r["k"], r["_key"], held[r["k"]]["n"], held[r["k"]]["_own"]) for r in rows.collect() if r["k"] in held), key=str)
    assert found == want and len(found) == 199


def test_manifests_differ_by_tree(spark, monkeypatch):
    """One path in a thousand differs: under a hundredth of the rows is joined; nulls and tables without a row."""
    from tallyweave.operators import manifests

    n = 40_000
    wanted = spark.range(n).select(F.concat(F.lit("p/"), "id").alias("path"), F.md5(F.col("id").cast("string").cast("binary")).alias("sha256"))
    k = F.substring("path", 3, 9).cast("int")
    found = wanted.withColumn("sha256", F.when(k % 2000 == 7, "other").otherwise(F.col("sha256"))).where(k % 4000 != 3999).union(spark.createDataFrame([("new", "x"), ("new 2", None)], "path string, sha256 string"))
    joined = []
    plain = manifests.manifest_difference
    monkeypatch.setattr(manifests, "manifest_difference", lambda x, y: joined.append((x, y)) or plain(x, y))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(manifests.manifest_difference_by_tree(wanted, found)) == rows(plain(wanted, found))
    assert sum(side.count() for side in joined[0]) < 0.01 * 2 * n
    none = wanted.limit(0)
    assert manifests.manifest_difference_by_tree(none, none).count() == 0
    few = wanted.limit(3)
    assert rows(manifests.manifest_difference_by_tree(none, few)) == rows(plain(none, few))
