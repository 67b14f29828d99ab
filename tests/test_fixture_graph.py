"""The supply-chain demo rows: structure counts, the exact 3-hop answer,
seeded expansion and the formatted texts."""

from pyspark.sql import functions as F

from lakegraph.operators import graph, match, retrieve
from lakegraph.plans import supply_graph as sg
from lakegraph.sources.fixtures import supply_tables


def test_node_and_edge_counts(fixture_graph):
    pg = fixture_graph.property_graph()
    nodes = [tuple(r) for r in graph.node_counts(pg).collect()]
    edges = [tuple(r) for r in graph.edge_counts(pg).collect()]
    assert nodes == [("Batch", 6), ("Order", 7), ("Supplier", 4), ("Warehouse", 4)]
    assert edges == [("CONTAINS", 7), ("MANUFACTURED_BY", 6), ("STORED_IN", 6)]


def test_pattern_3hop_exact_answer(fixture_graph):
    rows = match.pattern_3hop(fixture_graph, sg.high_delayed(), sg.failed(), sg.high_risk()) \
                .orderBy("oid").collect()
    assert [tuple(r) for r in rows] == [
        ("O001", "Charite Berlin", "B001", "Aspirin 500mg", "ChemSynth GmbH", "HIGH", "Hamburg"),
        ("O002", "UKE Hamburg", "B001", "Aspirin 500mg", "ChemSynth GmbH", "HIGH", "Hamburg"),
        ("O005", "Karolinska", "B005", "Metformin 1000mg", "ChemSynth GmbH", "HIGH", "Hamburg"),
    ]


def test_seeded_expand_all_batches(fixture_graph):
    g = fixture_graph
    out = match.seeded_expand(g.batches.select("batch_id"), g)
    assert out.count() == 7
    assert sorted({r.batch_id for r in out.collect()}) == ["B001", "B002", "B003", "B004", "B005"]
    assert len(out.columns) == 10


def test_seeded_expand_five_seeds_drops_unordered_batch(fixture_graph):
    g = fixture_graph
    seeds = g.batches.filter(F.col("batch_id") != "B002").select("batch_id")
    assert match.seeded_expand(seeds, g).count() == 6


def test_texts(spark, fixture_graph):
    g = fixture_graph
    b = g.batches.filter(F.col("batch_id") == "B001").first()
    assert b.description == "Aspirin 500mg batch B001 quality FAILED supplier S001"
    line = g.batches.filter(F.col("batch_id") == "B001").select(
        retrieve.hit_line("batch_id", "product", "quality", "quality_status").alias("l")).first().l
    assert line == "B001 | Aspirin 500mg | quality: FAILED"
    items = retrieve.retrieval_items(match.seeded_expand(g.batches.select("batch_id"), g),
                                     F.col("batch_id"))
    o1 = items.filter(F.col("metadata")["order_id"] == "O001").first()
    assert o1.content == ("Order O001 (Charite Berlin, DELAYED, priority:HIGH) | Batch B001 "
                          "(Aspirin 500mg) | quality: FAILED | supplier: ChemSynth GmbH [risk:HIGH] | "
                          "warehouse: Hamburg")


def test_context_text(spark):
    hits = spark.createDataFrame([(1, 2, 0.5, "B002 | x | quality: PASSED"),
                                  (1, 1, 0.91234, "B001 | y | quality: FAILED")],
                                 "query_id int, rank int, score double, ctx string")
    ctx = retrieve.vector_context(hits).first().context
    assert ctx == "- B001 | y | quality: FAILED (score: 0.912)\n- B002 | x | quality: PASSED (score: 0.500)"


def _with_extra_rows(spark):
    t = supply_tables(spark)
    extra_b = spark.createDataFrame(
        [("B007", "Orphan 1mg", "FAILED", "2024-03-01", "S999", "W999")], t["batches"].schema)
    extra_o = spark.createDataFrame(
        [("O008", "Nowhere", "B999", "DELAYED", "HIGH", "2024-03-02"),
         ("O009", "Somewhere", "B007", "DELAYED", "HIGH", "2024-03-03")], t["orders"].schema)
    t["batches"] = t["batches"].unionByName(extra_b)
    t["orders"] = t["orders"].unionByName(extra_o)
    return t


def test_missing_targets_give_no_edge_and_are_reported(spark):
    t = _with_extra_rows(spark)
    g = sg.fixture_graph(spark, t)
    edges = dict(graph.edge_counts(g.property_graph()).collect())
    assert edges == {"CONTAINS": 8, "MANUFACTURED_BY": 6, "STORED_IN": 6}
    nodes = dict(graph.node_counts(g.property_graph()).collect())
    assert nodes["Batch"] == 7 and nodes["Order"] == 9      # nodes are never dropped
    dang = graph.dangling_refs(t["orders"], ["batch_id"], t["batches"], ["batch_id"]).collect()
    assert [r.order_id for r in dang] == ["O008"]
    summ = {r.reference: (r.n_refs, r.n_dangling) for r in graph.dangling_summary({
        "orders.batch_id": (t["orders"], ["batch_id"], t["batches"], ["batch_id"]),
        "batches.supplier_id": (t["batches"], ["supplier_id"], t["suppliers"], ["supplier_id"]),
    }).collect()}
    assert summ == {"orders.batch_id": (9, 1), "batches.supplier_id": (7, 1)}


def test_optional_legs_keep_rows_with_none(spark):
    t = _with_extra_rows(spark)
    g = sg.fixture_graph(spark, t)
    out = match.seeded_expand(g.batches.select("batch_id"), g)
    row = out.filter(F.col("batch_id") == "B007").first()
    assert row.order_id == "O009" and row.supplier_name is None and row.warehouse_location is None
    item = retrieve.retrieval_items(out.filter(F.col("batch_id") == "B007"), F.col("batch_id")).first()
    assert item.content.endswith("| supplier: None [risk:None] | warehouse: None")
    # the exact match needs every leg, so the orphan batch is not an answer
    exact = match.pattern_3hop(g, sg.high_delayed(), sg.failed(), sg.high_risk())
    assert "O009" not in {r.oid for r in exact.collect()}


def test_key_violations_and_enforcement(spark):
    t = supply_tables(spark)
    dup = t["orders"].unionByName(t["orders"].filter(F.col("order_id") == "O003"))
    v = graph.key_violations(dup, ["order_id"]).collect()
    assert [(r.order_id, r.n) for r in v] == [("O003", 2)]
    assert graph.drop_duplicate_keys(dup, ["order_id"]).count() == 7


def test_upsert_update_wins_even_when_null(spark):
    base = spark.createDataFrame([("S1", "a", 1), ("S2", "b", 2)], "k string, name string, n long")
    upd = spark.createDataFrame([("S2", None, 20), ("S3", "c", 3)], "k string, name string, n long")
    out = {r.k: (r.name, r.n, r.change) for r in graph.upsert(base, upd, ["k"]).collect()}
    assert out == {"S1": ("a", 1, "keep"), "S2": (None, 20, "update"), "S3": ("c", 3, "insert")}


def test_chained_load_drops_supplier_edge_of_unstored_batch(spark):
    t = supply_tables(spark)
    extra = spark.createDataFrame([("B008", "Chained 1mg", "FAILED", "2024-03-04", "S001", "W999")],
                                  t["batches"].schema)
    t["batches"] = t["batches"].unionByName(extra)
    free = dict(graph.edge_counts(sg.fixture_graph(spark, t).property_graph()).collect())
    chained = dict(graph.edge_counts(sg.fixture_graph(spark, t, chained=True).property_graph()).collect())
    assert free["MANUFACTURED_BY"] == 7 and chained["MANUFACTURED_BY"] == 6
    assert free["STORED_IN"] == chained["STORED_IN"] == 6


def test_repeated_rows_are_one_node(spark):
    t = supply_tables(spark)
    t["orders"] = t["orders"].unionByName(t["orders"].filter(F.col("order_id") == "O001"))
    t["batches"] = t["batches"].unionByName(t["batches"].filter(F.col("batch_id") == "B001"))
    g = sg.fixture_graph(spark, t)
    assert g.orders.count() == 7 and g.batches.count() == 6
    exact = match.pattern_3hop(g, sg.high_delayed(), sg.failed(), sg.high_risk())
    assert sorted(r.oid for r in exact.collect()) == ["O001", "O002", "O005"]
    report = {r.label: (r.n_rows, r.n_keys, r.n_repeated, r.n_null) for r in
              graph.label_key_report({"Order": (t["orders"], ["order_id"])}).collect()}
    assert report == {"Order": (8, 7, 1, 0)}


def test_missing_part_of_description_prints_none(spark):
    t = supply_tables(spark)
    t["batches"] = t["batches"].withColumn("product", F.when(F.col("batch_id") != "B001", F.col("product")))
    text = sg.fixture_graph(spark, t).batches.filter("batch_id = 'B001'").first().description
    assert text == "None batch B001 quality FAILED supplier S001"


def test_equal_seeds_stay_as_many_rows_in_both_forms(spark):
    g = sg.fixture_graph(spark)
    seeds = g.batches.filter("batch_id = 'B001'").select("batch_id")
    once = match.seeded_expand(seeds, g).count()
    assert match.seeded_expand(seeds.union(seeds), g).count() == 2 * once
    rows = g.contains.union(g.contains)                 # the same edges as rows that repeat
    g.contains_rows = rows
    assert match.seeded_expand(seeds, g).count() == once
    assert match.seeded_expand(seeds.union(seeds), g).count() == 2 * once


def test_upsert_keeps_columns_it_does_not_set(spark):
    base = spark.createDataFrame([("S1", "a", 1), ("S2", "b", 2)], "k string, name string, n long")
    upd = spark.createDataFrame([("S2", "x"), ("S2", "y"), ("S3", "z")], "k string, name string")
    out = {r.k: (r.name, r.n, r.change) for r in graph.upsert(base, upd, ["k"], columns=["name"]).collect()}
    assert out == {"S1": ("a", 1, "keep"), "S2": ("y", 2, "update"), "S3": ("z", None, "insert")}


def test_questions_without_hits_are_scored(spark):
    from lakegraph.operators import evaluate
    truth = spark.createDataFrame([("m", 1), ("m", 2)], "method string, item_id long")
    got = spark.createDataFrame([("q1", "m", 1), ("q1", "m", 9)], "query_id string, method string, item_id long")
    asked = spark.createDataFrame([("q1", "m"), ("q2", "m")], "query_id string, method string")
    rows = {r.query_id: (r.n_retrieved, r.n_missing, r.precision, r.recall) for r in evaluate.retrieval_eval(got, truth, asked).collect()}
    assert rows == {"q1": (2, 1, 0.5, 0.5), "q2": (0, 2, None, 0.0)}
    missing = {(r.query_id, r.item_id) for r in evaluate.missing_items(got, truth, asked).collect()}
    assert missing == {("q1", 2), ("q2", 1), ("q2", 2)}


def test_dangling_summary_counts_null_and_hot_keys(spark):
    refs = spark.createDataFrame([("a",)] * 50 + [("b",), (None,), ("zz",)], "k string")
    tgt = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    r = graph.dangling_summary({"refs.k": (refs, ["k"], tgt, ["k"])}).first()
    assert (r.n_refs, r.n_dangling) == (53, 2)


def test_upsert_rejects_repeated_update_keys(spark):
    import pytest
    base = spark.createDataFrame([("S1", "a")], "k string, name string")
    upd = spark.createDataFrame([("S1", "b"), ("S1", "c")], "k string, name string")
    with pytest.raises(ValueError):
        graph.upsert(base, upd, ["k"], check_unique=True)
