import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest

from lakegraph.llm import suffix_dedup, words
from lakegraph.llm.suffix_array import common_prefixes, longest_with_smaller, suffix_array


def test_suffix_array_equals_sorted_suffixes():
    rnd = random.Random(1)
    for _ in range(800):
        text = [rnd.randint(1, rnd.choice([1, 2, 3, 5])) for _ in range(rnd.randint(0, 30))] + [0]
        array = suffix_array(text)
        assert array == sorted(range(len(text)), key=lambda i: text[i:])  # noqa: B023
        owner = [rnd.randint(0, 4) for _ in text]
        best = longest_with_smaller(array, common_prefixes(text, array, 0), owner)
        for i in range(len(text)):
            want = 0
            for j in range(len(text)):
                k = 0
                while owner[j] < owner[i] and max(i, j) + k < len(text) and text[i + k] == text[j + k] > 0:
                    k += 1
                want = max(want, k)
            assert best[i] == want


def hard_texts() -> list[tuple[int, str | None]]:
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    passage = " ".join(word() for _ in range(40))
    line = "the very common line that stands in many texts, end"
    base = " ".join(word() for _ in range(400))
    texts = [None, "", "short", "a" * 49, "a" * 50, "a" * 51, "a" * 500, "ab" * 200, "ba" * 200, "é" * 60, "日本語" * 40,
             "\0" * 80, "\0" * 60 + "x", passage, passage, passage[:120], passage[13:], "x" + passage + "y", line, base, base]
    texts += [line[:k] for k in range(40, len(line))]
    for _ in range(60):
        t = list(base)
        for _ in range(rnd.randint(1, 12)):
            t[rnd.randrange(len(t))] = rnd.choice("xyz ")
        texts.append("".join(t))
        texts.append(" ".join(word() for _ in range(rnd.randint(0, 30))) + line + " ".join(word() for _ in range(rnd.randint(0, 30))))
        texts.append(passage[rnd.randrange(100):] + word() + passage[:rnd.randrange(len(passage))])
    texts.append(base * 30)
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("block", "bucket"), [(8 << 20, 4 << 20), (9_000, 5_000)])
def test_equals_brute_force(spark, monkeypatch, block, bucket):
    docs = hard_texts()
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, n_removed string").repartition(3)
    got = suffix_dedup.dedup(df, block_bytes=bucket).collect()
    want = brute.suffix_dedup(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert len(got) == len(docs)


def test_text_output_ties_and_null_ids(spark):
    t = "0123456789" * 6
    rows = [(None, t), (7, t), (7, t), (9, "x" + t), (None, "y" + t)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), ("doc_id", "text")).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text, r.n_removed) for r in got) == [
        (-1, "", 60), (-1, "y", 60), (7, t, 0), (7, t, 0), (9, "x", 60)]


def test_empty_table(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_buckets_hold_equally_many_anchors():
    rnd = np.random.default_rng(3)
    data = rnd.integers(97, 123, 400_000).astype(np.uint8)
    _, place, h = suffix_dedup.anchors(data, np.arange(0, len(data) + 1, 2_000))
    assert len(place) > 20_000
    used, cut = suffix_dedup._runs(np.sort(h), 16)
    sizes = np.diff(cut)
    assert len(used) == 16 and sizes.max() < 1.5 * sizes.mean()


def test_rows_of_a_block_take_little_memory():
    """Judging a block's rows holds no array of numbers as long as its bytes."""
    text = bytes(range(97, 123)) * 4_000
    table = pa.table({"doc_id": pa.array(range(40), pa.int64()), "text": pa.array([text.decode()] * 40)})
    data, offs = words.flat(table["text"])
    gone = np.zeros(len(data), dtype=bool)
    gone[offs[1]:offs[1] + 10] = gone[offs[1] + 20:offs[2]] = True
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("text", pa.string())])
    tracemalloc.start()
    try:
        out = suffix_dedup._rows(table, data, offs, gone, schema, True).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * len(data)
    assert (out[1]["n_removed"], out[1]["n_spans"], out[1]["text"]) == (len(text) - 10, 2, text[10:20].decode())
    assert all(r["n_removed"] == 0 and r["text"] == text.decode() for r in out if r["doc_id"] != 1)
