"""Links of the Jaccard join against brute force."""

import random
from itertools import combinations

import brute

from lakegraph.llm import jaccard_join


def test_links_inside_a_group(spark):
    rnd, rows = random.Random(5), []
    for size in (9, 12, 30, 60, 120, 400):
        base = [f"{size}_{i}" for i in range(size + 2)]
        for k in range(12):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, size // 30))):
                w[rnd.randrange(len(w))] = f"n{rnd.random()}"
            rows += [(len(rows) * 3 + i, " ".join(w)) for i in range(1 + (k % 3 == 0))]
    rows += [(10_000 + i, " ".join([f"c{j}" for j in range(4 * i, 300)] + [f"d{j}" for j in range(4 * i)])) for i in range(12)]
    rows += [(20_000, "two words"), (20_001, "Two words"), (20_002, ""), (20_003, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = {d: frozenset(brute.shingles(t)) for d, t in rows}
    first = {}
    for d in sorted(sets):
        first.setdefault(sets[d], d)
    near = [(x, y) for x, y in combinations(sorted(sets), 2) if sets[x] and 190 * len(sets[x] & sets[y]) >= 90 * (len(sets[x]) + len(sets[y]))]
    got = [(r.a, r.b) for r in jaccard_join.links(df).collect()]
    assert sorted(got) == sorted({(x, y) for x, y in near if sets[x] != sets[y] and first[sets[x]] == x and first[sets[y]] == y})
    parts = brute.jaccard_components(rows)
    want = {d: (*parts[d], sum(d in p for p in near)) for d in sets}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.similar(df, counted=True).collect()} == want
