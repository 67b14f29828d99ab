"""Operators against brute force or exact round trips, on small hard tables."""

import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from lakegraph.llm import decontaminate, jaccard_join, langid, ngram_lm, packing, quality, queries, token_files, tokens, url_filter, warc
from lakegraph.llm.elias_fano import EliasFano, encode

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_words string, hits string"
BASE = " ".join(f"w{i}" for i in range(200))


def hard_docs():
    near = [BASE.replace("w7 ", "x "), BASE.replace("w150 ", "y "), BASE.replace("w7 ", "x ").replace("w150 ", "y "), BASE.upper()]
    rows = [None, "", " \n\t ", "one", "ONE", "one two", "a b c", "été Straße", "!!! ...", "12 34", "日本語 テキスト", BASE, BASE, *near,
            "line one\nline one\n\n\nline two", ("five words that come again " * 30).strip(), "z " * 60_000, "é" * 1000, "#*$%&|<>"]
    return [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", "clash", "clash") for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_docs(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    assert compare(queries.JOBS[name](spark, SF), duck(SF), queries.SQL[name])["ok"]


def test_query_columns(spark):
    for name, job in queries.JOBS.items():
        assert len(set(job(spark, SF).columns)) == len(job(spark, SF).columns), name


# ---- decontamination ------------------------------------------------------

def benchmark(spark):
    return spark.createDataFrame([(1, "Alpha beta, GAMMA"), (2, " ".join(f"w{i}" for i in range(20, 40))), (3, None), (4, "..."),
                                  (2, " ".join(f"w{i}" for i in range(20, 40))), (None, "straße"), (10, "w25 w26 w27 w28 w29 w30 w31 w32 w33 w34 x")],
                                 "item_id long, text string")


@pytest.mark.parametrize("max_bytes", [1 << 20, 150])
def test_hits(spark, docs, max_bytes):
    extra = spark.createDataFrame([(100, "so alpha BETA gamma it is"), (101, "alpha beta delta")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    got = {r.doc_id: r for r in decontaminate.find_hits(rows, benchmark(spark), ["doc_id"], max_bytes=max_bytes).collect()}
    assert len(got) == rows.count()
    assert (got[100].n_hit, got[100].n_items) == (3, 1) and got[101].n_hit == 0
    assert (got[7].n_hit, got[7].n_items) == (1, 1)                       # item without an id
    whole = [r for r in got.values() if r.n_words == 200]
    assert {(r.n_hit, r.n_items) for r in whole} == {(20, 2)} and len(whole) == 6
    import hashlib
    assert whole[0].items_sha256 == hashlib.sha256(b"10,2").hexdigest()
    assert got[0].n_words == 0 and got[0].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_decontaminate_empty(spark, docs, none):
    assert decontaminate.find_hits(none, benchmark(spark), ["doc_id"]).count() == 0
    empty = benchmark(spark).limit(0)
    assert decontaminate.keep_clean(docs, empty, ("doc_id", "text", "n_words")).count() == docs.count()


# ---- Jaccard join -------------------------------------------------------------

def jaccard(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar(df).collect()}


def test_jaccard_equals_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert jaccard(docs) == brute.jaccard_components(rows)


def test_jaccard_near_copies_of_all_sizes(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for size in (9, 10, 11, 12, 20, 30, 47, 60, 120, 400):
        base = [f"{size}_{i}" for i in range(size + 2)]
        for k in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                i = rnd.randrange(len(w))
                w[i:i + 1] = rnd.choice([[], [f"n{rnd.random()}"], [w[i], w[i]]])
            rows.append((len(rows) * 3, " ".join(w + [f"t{k}"] * (k % 2))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert jaccard(df) == brute.jaccard_components(rows)


def test_jaccard_chains_and_common_passage(spark):
    # each text differs from the next by a few words, so ends of a chain do not link directly
    words = [f"c{i}" for i in range(300)]
    rows = [(i, " ".join(words[4 * i:] + [f"d{j}" for j in range(4 * i)])) for i in range(20)]
    rows += [(100 + i, BASE[:200] + " " + " ".join(f"u{i}_{j}" for j in range(30))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard(df)
    assert got == brute.jaccard_components(rows)
    assert {got[i][1] for i in range(20)} == {0}
    left = {r.doc_id for r in jaccard_join.keep_smallest(df, ("doc_id", "text")).collect()}
    assert left == {0, *range(100, 140)}


def test_jaccard_empty(none):
    assert jaccard_join.similar(none).count() == 0


def test_boundary_follows_cost():
    assert jaccard_join.boundary([]) == 8
    assert 9 < jaccard_join.boundary([(n, 10) for n in range(1, 400)]) < 399


# ---- packing ---------------------------------------------------------------------

def reference_ids(texts, name, end=2):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.vocabulary(name))
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def test_packing(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    ids = dict(zip([d for d, _ in rows], reference_ids([t for _, t in rows], "byte_bpe_50k.json"), strict=True))
    got = packing.pack(packing.pieces(docs, queries.vocabulary("byte_bpe_50k.json")), block=16).collect()
    by_doc = {}
    for r in got:
        x = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(x, dtype="<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for d, x in ids.items():
        pieces = sorted(by_doc[d])
        assert [p[0] for p in pieces] == list(range(-(-len(x) // 1024)))
        assert sum(p[2] for p in pieces) == len(x) and all(p[2] == 1024 for p in pieces[1:])
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.1 * sum(map(len, ids.values())) / 1024 + 2


def test_sum_of_squares_fills_bins():
    sizes = np.random.default_rng(0).integers(1, 1025, 20_000)
    needed = []
    for order in packing.arrivals(sizes):
        where, offset = packing.sum_of_squares(sizes, order=order)
        assert np.bincount(where, weights=sizes).max() <= 1024
        needed.append(where.max() + 1)
    assert min(needed) <= 1.03 * sizes.sum() / 1024
    assert packing.sum_of_squares(np.zeros(0, np.int64))[0].size == 0


def test_packing_empty(none):
    assert packing.pack(packing.pieces(none, queries.vocabulary("byte_bpe_50k.json"))).count() == 0


# ---- quality ---------------------------------------------------------------------

def test_quality_hard_cases(spark, docs):
    got = {r.doc_id: r for r in quality.judge(docs, ("doc_id", "source")).collect()}
    assert len(got) == docs.count()
    assert got[0].n_words == 0 and got[0].base_failed and not got[0].kept
    lines = next(r for r in got.values() if r.n_dup_lines)
    assert lines.n_dup_lines == 1
    again = next(r for r in got.values() if r.n_words == 150)
    assert again.n_repeat_words == 150 and again.base_failed
    assert got[7].word_chars == 9


def test_bad_host_loses_its_documents(spark):
    good = " ".join(f"g{i}" for i in range(30))
    rows = [(i, good, "ok") for i in range(200)] + [(1000 + i, good if i < 5 else "bad", "worst") for i in range(100)] + [(5000, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in quality.judge(df, ("doc_id", "source")).collect()}
    assert got[5000] and all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(100))
    left = quality.keep(df, ("doc_id", "text", "source"))
    assert {r.doc_id for r in left.collect()} == {i for i, k in got.items() if k}


def test_one_small_host_is_shrunk(spark):
    good = " ".join(f"g{i}" for i in range(30))
    rows = [(h * 1000 + i, good, f"h{h}") for h in range(30) for i in range(40)] + [(90_000, "bad", "tiny")]
    hosts = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), ("doc_id", "source"))
    assert {r.source: r.rejected for r in quality.host_verdicts(hosts).collect()}["tiny"] is False


def test_quality_empty(none):
    assert quality.judge(none, ("doc_id", "source")).count() == 0
    assert quality.keep(none, ("doc_id", "text", "source")).count() == 0


# ---- WARC ---------------------------------------------------------------------------

def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", "x"), (2, "http://a/2", "x"), (3, None, None), (4, "http://a\r\nb", ""), (5, "u", "päge\r\n\r\nbody"),
            (2, "http://a/2", "x"), (None, "n", "x"), (7, "big", "<p>long</p>" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    index = warc.write_archive(pages)
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.url): r for r in got}
    assert by[1, "http://a/1"].refers_to == 2 and by[1, "http://a/1"].record_type == "revisit"
    assert by[None, "n"].refers_to == 2 and by[2, "http://a/2"].refers_to is None
    assert bytes(by[5, "u"].payload).decode() == "päge\r\n\r\nbody" and by[7, "big"].payload_bytes == 2_200_000
    assert by[3, None].refers_to == 4 and by[4, "http://a%0D%0Ab"].payload_digest == warc.base32_sha1(b"") == by[3, None].payload_digest
    some = warc.read_records(index.filter("page_id in (5, 7)")).collect()
    assert {r.page_id for r in some} == {5, 7}
    assert warc.write_archive(pages.limit(0)).count() == 0


def test_archives_are_plain_gzip_members(spark):
    import gzip
    index = warc.write_archive(spark.createDataFrame([(1, "u", "hello"), (2, "v", "world")], "page_id long, url string, html string").coalesce(1)).collect()
    raw = gzip.open(index[0].file.removeprefix("file:")).read()
    assert raw.count(b"WARC/1.1\r\n") == 2 and b"hello" in raw and b"world" in raw


def test_ranges_join_neighbours():
    rows = iter([("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP + 1, 3), ("b", 0, 4)])
    assert [(f, s, e, len(m)) for f, s, e, m in warc.ranges(rows)] == [("a", 0, 15, 2), ("a", 16 + warc.GAP, 19 + warc.GAP, 1), ("b", 0, 4, 1)]


# ---- language model ------------------------------------------------------------------

def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, u in ((0, 10), (1, 1), (5, 100), (1000, 1000), (1000, 10 ** 9), (70_000, 10 ** 12), (2000, 300)):
        v = np.sort(rng.integers(0, u, n))
        e = EliasFano(encode(v, u))
        assert (e.at(np.arange(n)) == v).all()
        q = np.concatenate([v, rng.integers(0, u, 500), [-1, u, u + 5]])
        found = e.find(q)
        assert ((found >= 0) == np.isin(q, v)).all() and (v[found[found >= 0]] == q[found >= 0]).all()
        begin, end = np.sort(rng.integers(0, n + 1, (2, len(q))), axis=0)
        within = e.find(q, begin, end)                   # only among the values begin to end
        assert [w >= 0 for w in within] == [x in v[i:j] for x, i, j in zip(q, begin, end, strict=True)]
        assert ((begin <= within) & (within < end))[within >= 0].all()


@pytest.mark.parametrize(("order", "per_file", "held"), [(2, 20_000, 10 ** 6), (3, 16 << 20, 10 ** 6), (3, 20_000, 10 ** 6), (3, 20_000, 300)])
def test_scores(spark, docs, monkeypatch, order, per_file, held):
    monkeypatch.setattr(ngram_lm, "BYTES_PER_FILE", per_file)
    monkeypatch.setattr(ngram_lm, "TRIPLES_HELD", held)
    rows = queries.read(spark, SF, "documents").select("doc_id", "text").unionByName(docs.selectExpr("doc_id + 100000 as doc_id", "text"))
    df = rows.withColumn("held_out", langid.fold(F.col("doc_id"), 5, 1))
    plain = [(r.doc_id, r.text) for r in rows.collect()]
    base, model = brute.lm_base(plain), brute.lm_score(plain, order)
    got = ngram_lm.score(df, ngram_lm.build(df.filter("not held_out"), order)).collect()
    assert len(got) == len(plain)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == base[r.doc_id][:4]
        assert r.base_score == pytest.approx(base[r.doc_id][4], rel=1e-9)
        assert abs(r.score - model[r.doc_id]) <= 0.03 * r.n_tokens        # one byte per probability
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_word_hashes_tell_words_apart():
    texts = ["", "a", "b", "ab", "abcdefgh", "abcdefghi", "abcdefg", "x" * 63, "x" * 64, "x" * 65, "x" * 66, "y" * 300, "x" * 16, "x" * 17]
    texts += [f"{k:x}" for k in range(5000)] + [f"prefix-prefix-{k}" for k in range(5000)]
    data = np.frombuffer(" ".join([*texts, *texts]).encode(), dtype=np.uint8)
    h, _ = ngram_lm.tokens(data, np.array([0, len(data)]))
    words_in = " ".join(texts).split()
    assert (h[:len(words_in)] == h[len(words_in):-1]).all()
    assert len(set(h.tolist())) == len({*words_in}) + 1       # and the end


def test_summed_pairs_of_any_width():
    rng = np.random.default_rng(1)
    for scale in (1, 1 << 40):                           # in one number, and beyond it
        g, r, c = rng.integers(0, 30, 500) * scale, rng.integers(0, 30, 500) * scale, rng.integers(1, 5, 500)
        want: dict = {}
        for x, y, n in zip(g.tolist(), r.tolist(), c.tolist(), strict=True):
            want[x, y] = want.get((x, y), 0) + n
        a, b, bucket, n = ngram_lm._summed(g, r, g % 7, c)
        assert list(zip(a.tolist(), b.tolist(), n.tolist(), strict=True)) == [(*k, want[k]) for k in sorted(want)]
        assert (bucket == a % 7).all()


def test_hot_contexts_are_split_over_files(spark, monkeypatch):
    """Two words before a third of all tokens: their followers go on from file
    to file, and every level gives the same as one file."""
    rows = [(i, " ".join(f"of the w{(i * 31 + k * k) % 997}" for k in range(60))) for i in range(120)] + [(500, ""), (501, None), (502, "of the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", langid.fold(F.col("doc_id"), 5, 1))
    monkeypatch.setattr(ngram_lm, "BYTES_PER_FILE", 2_000)
    manifest = ngram_lm.build(df.filter("not held_out"))
    for kind in ("pairs", "triples"):
        files = manifest[kind]
        assert max(sum(f["lo"] <= c <= f["hi"] for f in files) for c in {f["hi"] for f in files}) > 5
        assert all((f["hi"], g["lo"]) == tuple(sorted((f["hi"], g["lo"]))) for f, g in zip(files, files[1:], strict=False))
    model = brute.lm_score(rows)
    for r in ngram_lm.score(df, manifest).collect():
        assert abs(r.score - model[r.doc_id]) <= 0.03 * r.n_tokens


def test_only_touched_files_are_opened(spark):
    """2,000 files of each level; a short text opens those of its own words."""
    rows = [(i, " ".join(f"w{i * 40 + k}" for k in range(40))) for i in range(500)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_lm, "BYTES_PER_FILE", sum(len(t) + 1 for _, t in rows) // 2_000)
        manifest = ngram_lm.build(train)
    assert len(manifest["pairs"]) > 1_500 and len(manifest["triples"]) > 1_500
    trie = ngram_lm.Trie(manifest)
    text = np.frombuffer(rows[7][1].encode(), dtype=np.uint8)
    count, base, model = trie.score(*ngram_lm.tokens(text, np.array([0, len(text)])))
    assert (count[:-1] == 1).all() and (model > base).all()
    assert max(len(trie.level2.open), len(trie.level3.open), len(trie.vocab.arrays.open)) < 200


def test_scores_without_training(spark, docs, none):
    held = docs.withColumn("held_out", F.lit(True))
    got = ngram_lm.score(held, ngram_lm.build(none)).collect()
    assert len(got) == docs.count() and all(r.train_tokens == 0 and r.n_known == 0 and r.score <= 0 for r in got)
    assert ngram_lm.score(none.withColumn("held_out", F.lit(True)), ngram_lm.build(docs)).count() == 0


# ---- token files -----------------------------------------------------------------------

@pytest.mark.parametrize("partition_bytes", [32 << 20, 5_000])
def test_token_files(spark, docs, partition_bytes):
    path = queries.vocabulary("word_bpe_49k.json")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    index = token_files.write_tokens(docs, path, partition_bytes=partition_bytes)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_tokens(index).collect()}
    start = 0
    for (d, _), ids in zip(rows, reference_ids([t for _, t in rows], "word_bpe_49k.json"), strict=True):
        assert got[d] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_token_file_batches(spark, docs):
    index = token_files.write_tokens(docs, queries.vocabulary("word_bpe_49k.json"), partition_bytes=1 << 30)
    file, n = index.groupBy("file").agg(F.sum("n_tokens")).first()
    source = pa.memory_map(file.removeprefix("file:"))
    before = pa.total_allocated_bytes()
    table = pa.ipc.open_stream(source).read_all()
    assert table.schema.field("ids").type == pa.list_(pa.uint16(), token_files.ROW)
    assert pa.total_allocated_bytes() == before                         # nothing was copied
    mask = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["mask"].chunks])
    assert mask.sum() == n and mask[:n].all()


def test_token_files_empty_and_repeated(spark, none):
    path = queries.vocabulary("word_bpe_49k.json")
    assert token_files.read_tokens(token_files.write_tokens(none, path)).count() == 0
    twice = spark.createDataFrame([(None, "a"), (5, "b c"), (5, "b c"), (6, None)], "doc_id long, text string")
    got = sorted((r.start, r.n_tokens) for r in token_files.read_tokens(token_files.write_tokens(twice, path)).collect())
    assert got == [(0, 2), (2, 3), (5, 3), (8, 1)]


@pytest.mark.parametrize(("name", "byte_level"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_is_exact(name, byte_level, monkeypatch):
    import random
    rnd = random.Random(3)
    parts = [*"ab'sT.,!?|<>  \n\n\t\r19é×÷ßĀ", " ", " ", "\x85", "\x1c", "\x0b", "é", "́", "日", "’", "<|endoftext|>",
             "<|startoftext|>", "İ", "Σ", "ﬁ", "Å", "'ll", "don't ", "　", "½"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + [None, "", " "]
    monkeypatch.setattr(tokens, "CACHE_BYTES", 20_000)
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 3_000)
    enc = tokens.Encoder(queries.vocabulary(name), byte_level, 2)
    got = [x.tolist() for _, found in enc.batches(pa.array(texts, pa.string())) for x in found]
    assert got == reference_ids(texts, name)


# ---- language identification ---------------------------------------------------------

def test_marginals_equal_brute_force():
    import itertools
    rng = np.random.default_rng(0)
    first, trans = np.array([0, 5, 5, 6]), rng.normal(size=(3, 3))
    scores = rng.normal(size=(6, 3))
    want, pairs = np.zeros((6, 3)), np.zeros((3, 3))
    for a, b in ((0, 5), (5, 6)):
        paths = list(itertools.product(range(3), repeat=b - a))
        w = np.array([np.exp(sum(scores[a + i, y] for i, y in enumerate(p)) + sum(trans[x, y] for x, y in zip(p, p[1:], strict=False))) for p in paths])
        for p, x in zip(paths, w / w.sum(), strict=True):
            for i, y in enumerate(p):
                want[a + i, y] += x
            for y, z in zip(p, p[1:], strict=False):
                pairs[y, z] += x
    got, expected = langid.marginals(scores, first, trans, pairs=True)
    assert np.allclose(got, want) and np.allclose(expected, pairs)
    # segments of a long row join as if there were none
    scores, first = rng.normal(size=(150, 3)), np.array([0, 150])
    alpha = np.zeros((150, 3))
    alpha[0] = np.exp(scores[0])
    for t in range(1, 150):
        alpha[t] = (alpha[t - 1] / alpha[t - 1].sum()) @ np.exp(trans) * np.exp(scores[t])
    assert np.allclose(langid.marginals(scores, first, trans)[-1], alpha[-1] / alpha[-1].sum())


def test_language_accuracy_and_switching(spark):
    docs = queries.read(spark, SF, "documents").withColumn("held_out", langid.fold(F.col("doc_id"), 4, 2))
    model = langid.train(docs.filter("not held_out"))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in langid.predict(docs, model).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    # half a text in each of two languages: labels switch near the middle
    one, two = (next(r.text for r in docs.collect() if r.lang == x and len(r.text or "") > 1000).split()[:100] for x in ("en", "fr"))
    from lakegraph.llm import words
    data, offs = words.flat(pa.array([" ".join(one + two)]))
    w = langid.Words(data, offs)
    best = np.argmax(langid.marginals(w.emissions(model)[w.of], w.first, model["trans"]), axis=1)
    en, fr = model["labels"].index("en"), model["labels"].index("fr")
    assert (best[:90] == en).mean() > 0.9 and (best[-90:] == fr).mean() > 0.9


def test_language_hard_cases(spark, docs, none):
    held = docs.withColumn("held_out", F.lit(False))
    model = langid.train(held)
    got = {r.doc_id: r for r in langid.predict(held, model).collect()}
    assert len(got) == docs.count()
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert all(r.score == 0 for r in got.values() if r.lang_pred == "und")
    assert langid.train(none) is None
    assert {r.lang_pred for r in langid.predict(held, None).collect()} == {"und"}
    assert langid.predict(none.withColumn("held_out", F.lit(True)), model).count() == 0


# ---- URL filter ---------------------------------------------------------------------------

def test_url_rules(spark):
    urls = {1: "HTTP://A.Example.ORG/es/x?q#f", 2: "http://example.org/en/12", 3: "http://org", 4: "http://x.com/fr/", 5: "http://x.com/de/1",
            6: "http://x.com/", 7: None, 8: "no scheme", 9: "http://spam-farm.example.net/a", 10: "http://b.spam-farm.example.net", 11: "http://com/fr",
            12: "http://notexample.org/es/", 13: "://q", 14: "http://", 15: "http://example.org?x"}
    pages = spark.createDataFrame(list(urls.items()) + [(1, urls[1])], "page_id long, url string").repartition(2)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, queries.URL_RULES).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("org", "", None, "allow") and got[15] == ("example.org", "", None, "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block") and got[6][2:] == (None, "allow")
    assert got[7] == got[8] == ("", "", None, "allow") == got[14]
    assert got[9][2:] == got[10][2:] == (None, "block") and got[11] == ("com", "/fr", None, "allow")
    assert got[12][2:] == ("org/", "allow") and got[13][0] == "q"
    assert url_filter.filter_urls(pages, queries.URL_RULES).count() == 16


def test_digest_files_split_and_collide(spark, monkeypatch):
    listed = [(f"h{i}.net", "", url_filter.LISTED) for i in range(300)] + [(None, "", 2), ("h1.net", "", 2)]
    files = url_filter.write_digest_files(spark.createDataFrame(listed, "host string, path string, kind int"), per_file=50)
    assert len(files) > 2
    array = url_filter.DigestArray(files)
    found = array.find([("h7.net", ""), ("h299.net", ""), ("h300.net", ""), ("h7.ne", "t")])
    assert found == [[2], [2], [], []]                                   # same digest text, other string
    empty = url_filter.filter_urls(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), [], ())
    assert [(r.rule, r.verdict) for r in empty.collect()] == [(None, "allow")]


def test_clashing_names_of_kept_columns(spark):
    """Columns named like results or helpers do no harm."""
    docs = spark.createDataFrame([(1, "alpha beta gamma", "s", "x", "y", "z")], "doc_id long, text string, source string, _text string, n_words string, _row string")
    for max_bytes in (1 << 20, 100):
        r = decontaminate.find_hits(docs, benchmark(spark), ["doc_id", "_text", "_row", "n_words", "text"], max_bytes=max_bytes).first()
        assert (r._text, r._row, r.n_words, r.n_hit, r.text) == ("x", "z", 3, 3, "alpha beta gamma")
    r = quality.judge(docs, ("doc_id", "source", "n_words", "_text")).first()
    assert (r.n_words, r._text, r.kept) == (3, "x", False)
