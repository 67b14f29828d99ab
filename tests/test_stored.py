"""Stored tables that are brought up to date, samples, exact counts, sketches,
rejected rows and prompt parts."""

import os

import pytest
from pyspark.sql import functions as F

from lakegraph.operators import cleanse, profile, retrieve, stored
from lakegraph.session import shared_dir
from lakegraph.sources import io


def files(path):
    return {f for f in (os.path.join(d, x) for d, _, names in os.walk(path.removeprefix("file:")) for x in names) if f.endswith(".parquet")}


@pytest.fixture
def nodes(spark):
    df = spark.createDataFrame([(i, f"n{i}", i % 3) for i in range(200)], "k long, name string, risk int")
    return stored.StoredNodes.create(df, ["k"], shared_dir(spark, "t-nodes"), 8)


def test_merge_touches_only_its_buckets(spark, nodes):
    before = files(nodes.path)
    updates = spark.createDataFrame([(7, "seven", 9), (900, "new", None), (7, "seven", 8), (None, "none", 1)], "k long, name string, risk int")
    replaced = nodes.merge(updates)
    after = files(nodes.path)
    assert 1 <= len(replaced) <= 2
    gone = {f.split("key_bucket=")[1].split("/")[0] for f in before - after}
    assert gone <= {str(b) for b in replaced} and len(before & after) >= 6
    got = {r.k: (r.name, r.risk) for r in nodes.rows.collect()}
    want = {i: (f"n{i}", i % 3) for i in range(200)} | {7: ("seven", 9), 900: ("new", None)}
    assert got == want and nodes.rows.count() == 201
    assert nodes.merge(updates) == [] and files(nodes.path) == after            # run again: nothing changes


def test_merge_sets_listed_columns_only(spark, nodes):
    nodes.merge(spark.createDataFrame([(3, 77)], "k long, risk int"), ["risk"])
    assert nodes.rows.filter("k = 3").first().asDict() == {"k": 3, "name": "n3", "risk": 77}
    assert nodes.merge(nodes.rows.limit(0)) == []


def test_merge_reads_touched_buckets_only(spark, nodes):
    plan = nodes._stored().filter(F.col(stored.BUCKET).isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan


def test_kept_averages(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, None), (2, 5.0), (None, 1.0)], "g int, v double")
    kept = stored.KeptAverages(spark, shared_dir(spark, "t-states"), {"g": F.col("g")}, "v")
    kept.load("a", rows)
    first = files(kept.path)
    more = spark.createDataFrame([(1, 12.0), (3, 1.0)], "g int, v double")
    for _ in range(2):                                                          # the same load twice counts once
        kept.load("b", more)
    assert first <= files(kept.path)                                            # earlier states are not written again
    assert {r.g: r.average for r in kept.averages().collect()} == {1: 6.0, 2: 5.0, 3: 1.0, None: 1.0}


def test_scatter_sample_is_the_same_at_any_partitioning(spark):
    df = spark.range(5000).select("id", (F.col("id") % 97).cast("double").alias("x"), F.sqrt("id").alias("y"))
    df = df.unionByName(spark.createDataFrame([(9000, None, 1.0), (9001, float("nan"), 1.0)], "id long, x double, y double"))
    one = {tuple(r) for r in profile.scatter_sample(df.coalesce(1), "x", "y", ["id"], 6, 3).collect()}
    many = {tuple(r) for r in profile.scatter_sample(df.repartition(13), "x", "y", ["id"], 6, 3).collect()}
    cells = profile.density_2d(df, "x", "y", 6).collect()
    assert one == many and len(one) == sum(min(3, c["count"]) for c in cells)


def test_exact_distinct(spark):
    df = spark.createDataFrame([(1, -5, "a", 1.5, 2 ** 62), (1, 7, None, None, -(2 ** 62)), (2, None, "b", 1.5, 3), (2, 7, "a", 2.5, 3)],
                               "i int, l long, s string, d double, far long")
    want = {"i": 2, "l": 2, "s": 2, "d": 2, "far": 3}
    assert {r.column_name: r.n_distinct for r in profile.exact_distinct(df).collect()} == want
    assert set(r.n_distinct for r in profile.exact_distinct(df.limit(0)).collect()) == {0}


def test_quantile_states_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 30).alias("day"), F.col("id").cast("double").alias("v"))
    states = profile.quantile_states(df, ["g", "day"], "v")
    for r in profile.merged_quantiles(states, ["g"], [0.1, 0.5, 0.9]).collect():
        assert r.n == 10_000 and abs(r.value / 20_000 - r.q) < 0.02


def test_reasons(spark):
    path = shared_dir(spark, "t-lines")
    lines = ["1,2.5,2020-01-01", "2,x,2020-01-02", "3,4.5", "4,1.0,2020-99-01", "5,0.1,2020-01-01", "6,,2020-01-01", "a,b,c", "7,1,2020-01-01,extra"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = io.read_csv_kept_lines(spark, path, ["k", "price", "day"], header=False)
    out = cleanse.with_reason(rows, {"k": "bigint", "price": "double", "day": "date"}, {"price too small": F.col("price") >= 1}, "malformed_line").collect()
    got = [(r.k, r.reason) for r in out]
    assert got == [(1, None), (2, "price is no double"), (3, "malformed line"), (4, "day is no date"), (5, "price too small"), (6, "price too small"),
                   (None, "k is no bigint"), (7, "malformed line")]
    assert [r.malformed_line for r in out if r.reason == "malformed line"] == ["3,4.5", "7,1,2020-01-01,extra"]


def test_prompt_parts_hold_every_item_once(spark):
    """One question holds most items; its parts are bounded and in order."""
    items = spark.range(3000).select(F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 10).alias("query_id"), F.col("id").alias("o"),
                                     F.concat(F.lit("item "), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int"))).alias("content"))
    got = retrieve.prompt_parts(items.repartition(7), ["o"], "content", 300, "Why?").collect()
    for q in {r.query_id for r in got}:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.part)
        seen = [int(x.split()[2].rstrip("x")) for r in mine for x in r.user_prompt.split("\n\nQuestion: Why?")[0].split("\n")[1:]]
        want = sorted(r.o for r in items.filter(F.col("query_id") == q).collect())
        assert seen == want and sum(r.n_items for r in mine) == len(want)
        assert all(len(r.user_prompt) <= 300 + 20 + 3 * r.n_items + 30 for r in mine)


def test_edges_of_bucketed_tables_join_without_exchange(spark):
    from lakegraph.plans import catalog
    from places import SF_SMALL
    g = catalog._bucketed(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        walk = g.contains.join(g.orders.filter("status = 'DELAYED'"), "order_id")
        plan = walk._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = catalog._g(spark, SF_SMALL)
        assert walk.count() == want.contains.join(want.orders.filter("status = 'DELAYED'"), "order_id").count()
        match = catalog.pattern_3hop_stored(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        edges = [x for x in match.splitlines() if "graph_" in x and "_contains" in x]
        assert edges and all("Bucketed: true" in x for x in edges)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("graph_") and t.name.endswith("_orders"))
    stats = spark.sql(f"DESCRIBE EXTENDED {name} order_id").collect()
    assert any(r[0] == "distinct_count" and r[1] != "NULL" for r in stats)


def test_buckets_grow_with_the_edges(spark, monkeypatch):
    """Same rows in as many buckets as the edges ask for, with either way of
    making the edges distinct; a repeated edge is stored once."""
    from dataclasses import replace

    from lakegraph.plans import supply_graph as sg
    from places import SF_SMALL
    monkeypatch.setattr(sg, "BUCKET_ROWS", 500)
    g = sg.tables_graph(spark, SF_SMALL)
    g = replace(g, contains_rows=g.contains_rows.unionByName(g.contains_rows))
    want, n = sorted(map(tuple, g.contains.collect())), -(-g.contains_rows.count() // 500)
    assert n > 4
    key = "spark.sql.requireAllClusterKeysForDistribution"
    before = spark.conf.get(key)
    try:
        for i, all_keys in enumerate(("true", "false")):
            spark.conf.set(key, all_keys)
            made = sg.bucketed_graph(g, f"grown_{i}", 4)
            assert sorted(map(tuple, made.contains.collect())) == want
            for part in ("orders", "contains"):
                told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED grown_{i}_{part}").collect()}
                assert told["Num Buckets"] == str(n)
            files = made.contains.inputFiles()
            assert len(files) <= n
    finally:
        spark.conf.set(key, before)
