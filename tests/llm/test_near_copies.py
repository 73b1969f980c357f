"""Near copies, vectors and components against brute force."""

import collections
import random

import numpy as np
import pandas as pd
import pytest

from quotelift.llm import adaptive_scan, dart_minhash, itq
from quotelift.llm.components import components

DOCS = "doc_id long, text string, node long, key string, weight string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "w") for r in rows], DOCS)


def find(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def brute(rows):
    parent, sets = {}, []
    for i, t in rows:
        words = (t or "").split()
        find(parent, i)
        if words:
            c = collections.Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
            for j, d in sets:
                if sum((c & d).values()) >= 0.8 * sum((c | d).values()):
                    a, b = find(parent, i), find(parent, j)
                    parent[max(a, b)] = min(a, b)
            sets.append((i, c))
    return {i: find(parent, i) for i, _ in rows}


def changed(rng, words, share):
    return [rng.choice("pqrstu") * 3 + str(rng.randrange(999)) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([40, 120, 400]))]
        for _ in range(12):
            rows.append(" ".join(changed(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04, 0.1]))))
    rows += [" ".join(f"x{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    rows += ["the same short", "the same short", "the  same\nshort ", "one", "one", "", None, " \n", "rep " * 300, "rep " * 290]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small_bucket", [16, 2])
def test_classes_are_those_of_brute_force(spark, corpus, small_bucket, monkeypatch):
    monkeypatch.setattr(dart_minhash, "SMALL_BUCKET", small_bucket)
    got = {r["doc_id"]: r["class_id"] for r in dart_minhash.classes(docs(spark, corpus)).collect()}
    assert got == brute(corpus)


def test_mates_in_small_buckets_meet_whatever_a_crowd_shares(spark):
    rng = random.Random(8)
    new = lambda n: [f"y{rng.randrange(10**6)}" for _ in range(n)]
    passage, own = new(100), new(100)
    a = passage + own
    b = [*a[:100], *new(5), *a[105:]]
    rows = [(1, a), (2, b), (3, new(200)), *((10 + i, passage + new(100)) for i in range(20))]
    rows = [(i, " ".join(w)) for i, w in rows]
    near = brute(rows)
    assert near[1] == near[2] and near[10] == 10
    texts = docs(spark, rows).select("doc_id", "text")
    nodes = dart_minhash.signed(texts).selectExpr("doc_id node", "weight", "sketch")
    # 1 is in a bucket with the crowd and in a small one with 2, which is not in the large one
    large, small = [(0, i) for i, _ in rows if i == 1 or i >= 10], [(5, 1), (5, 2), (5, 3)]
    members = spark.createDataFrame([*large, *small], "key long, node long")
    found = spark.createDataFrame([(2, 2), (3, 2)], "node long, component_id long")
    got = dart_minhash._second_round(members, nodes, found, texts).collect()
    assert (1, 2) in {(r["a"], r["b"]) for r in got}


def test_signatures_agree_as_often_as_texts_are_alike():
    rng, hashes = random.Random(1), dart_minhash.WordHashes()
    for n, share in ((30, 0.02), (300, 0.01), (3000, 0.03)):
        base = [f"w{rng.randrange(200)}" for _ in range(n)]
        a, b = (dart_minhash.shingles(" ".join(w), hashes) for w in (base, changed(rng, base, share)))
        c, d = collections.Counter(a.tolist()), collections.Counter(b.tolist())
        true = sum((c & d).values()) / sum((c | d).values())
        s = dart_minhash.signatures([a, b])
        assert abs((s[0] == s[1]).mean() - true) < 0.15


def test_a_signature_does_not_depend_on_its_batch():
    texts = [dart_minhash.shingles(" ".join(f"w{i * k % 97}" for i in range(5 + 50 * k)), dart_minhash.WordHashes()) for k in range(1, 8)]
    together = dart_minhash.signatures(texts)
    assert all((dart_minhash.signatures([t])[0] == s).all() for t, s in zip(texts, together, strict=True))


def test_one_of_each_class_stays(spark, corpus):
    rows = docs(spark, [*corpus, corpus[0], (None, "the same short"), (None, None)])
    got = dart_minhash.one_per_class(rows)
    want = brute(corpus)
    assert got.columns == rows.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 2


def test_near_copies_of_nothing(spark):
    assert dart_minhash.classes(docs(spark, [])).count() == 0
    got = dart_minhash.classes(docs(spark, [(1, None), (1, None), (None, "a b"), (2, "a b")])).collect()
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(60)] + [(7, 7)]
    parent = {}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component_id"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(parent, x) for x in linked}


VECTORS = "vec_id long, embedding array<float>, label int, node string, n_links string, list string, score string"


def vectors(spark, x, extra=()):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + list(extra)
    return spark.createDataFrame([(*r, 0, "n", "l", "i", "s") for r in rows], VECTORS)


BAD = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [1.0] * 15 + [None]), (9004, [float("inf")] * 16), (9005, [1.0] * 3), (9006, [])]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(220, 16))
    near = base[rng.integers(0, 60, 200)] + rng.normal(size=(200, 16)) * rng.uniform(0.01, 0.25, (200, 1))
    return np.vstack([base, near, near[:20] * 3, base[:5]]).astype(np.float32)


def test_links_of_vectors(spark, points):
    got = {r["vec_id"]: r for r in itq.near_copies(vectors(spark, points, BAD)).collect()}
    y = points.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    close = (y @ y.T) >= 0.9
    np.fill_diagonal(close, False)
    found = np.array([got[i]["n_links"] for i in range(len(points))])
    assert (found <= close.sum(axis=1)).all() and found.sum() >= 0.9 * close.sum()
    for i, _ in BAD:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got.values())
    # equal vectors are linked whatever the codes say
    assert all(got[420 + 20 + i]["component_id"] == got[i]["component_id"] for i in range(5))


def test_exploded_codes_are_not_broadcast(spark, points, monkeypatch):
    """The files of the codes are below the threshold, their buckets and neighbours far above it."""
    plans, write = {}, itq.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(itq, "materialize", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        found = itq.near_copies(vectors(spark, points)).agg({"n_links": "sum"}).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plans["code-pairs"] and "BroadcastHashJoin" not in plans["code-pairs"]
    assert found == itq.near_copies(vectors(spark, points)).agg({"n_links": "sum"}).first()[0]


def test_vectors_of_nothing(spark):
    assert itq.near_copies(vectors(spark, [])).count() == 0
    got = itq.near_copies(vectors(spark, [], [*BAD, (None, [1.0] * 16), (1, [1.0] * 16), (1, [1.0] * 16), (2, [2.0] * 16)]))
    rows = [r for r in got.collect() if r["vec_id"] in (1, 2)]
    assert len(rows) == 3 and all(r["n_links"] == 1 and r["component_id"] == 1 for r in rows)
    empty = adaptive_scan.search(vectors(spark, [], BAD[:5]), vectors(spark, [], BAD[:5]))
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0


def nearest(x, queries, k=20):
    x = x.astype(np.float64)
    out = {}
    for q in queries:
        s = x @ x[q]
        order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-s[i], i))[:k]
        out[q] = [(i, s[i]) for i in order]
    return out


def test_search_of_one_list_is_exact(spark, points):
    rows = vectors(spark, points, BAD)
    got = collections.defaultdict(list)
    for r in adaptive_scan.search(rows, rows.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = nearest(points, range(0, len(points), 20))
    assert set(got) == set(want)
    for q, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [r[2] for r in rows] == pytest.approx([s for _, s in want[q]], abs=1e-9)
        assert np.mean([v in {i for i, _ in want[q]} for _, v, _ in rows]) > 0.9


def test_fewer_candidates_than_asked_for(spark):
    x = np.eye(4, dtype=np.float32)
    rows = vectors(spark, x)
    got = adaptive_scan.search(rows, rows.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(adaptive_scan, "ONE_LIST", 100)
    monkeypatch.setattr(adaptive_scan, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(30, 24))[rng.integers(0, 30, 1500)] + 0.6 * rng.normal(size=(1500, 24))) * rng.uniform(0.5, 2, (1500, 1))
    x = x.astype(np.float32)
    rows = vectors(spark, x)
    want = nearest(x, range(0, 1500, 20))
    got = collections.defaultdict(set)
    for r in adaptive_scan.search(rows, rows.filter("vec_id % 20 = 0")).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert all(len(v) == 20 for v in got.values())
    assert np.mean([len(got[q] & {i for i, _ in w}) / 20 for q, w in want.items()]) >= 0.9


@pytest.mark.parametrize("kind", ["unit", "signs"])
def test_copies_of_the_longest_vector_find_each_other(spark, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1000, 64))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if kind == "unit" else np.sign(x)
    x = x.astype(np.float32)
    x[:400] = x[np.argmax((x.astype(np.float64) ** 2).sum(axis=1))]
    rows = vectors(spark, x)
    # the product of one query is rounded in another way than that of many rows
    got = adaptive_scan.search(rows, rows.filter("vec_id = 7")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [i for i in range(21) if i != 7]


def test_queries_left_short_are_scanned_again(spark, points, monkeypatch):
    tile = adaptive_scan._tile

    def hasty(index, k):
        whole = tile(index, k)
        return lambda rows, queries: whole(rows, queries[~np.isfinite(queries["bound"])])

    monkeypatch.setattr(adaptive_scan, "_tile", hasty)
    rows = vectors(spark, points)
    got = collections.Counter(r["query_id"] for r in adaptive_scan.search(rows, rows.filter("vec_id % 50 = 0")).collect())
    assert got == {q: 20 for q in range(0, len(points), 50)}


@pytest.mark.parametrize("dense", [0.0, 1.0])
def test_a_block_gives_back_only_what_reaches_the_bound(dense, monkeypatch):
    """All pairs at once or only those left: the pairs given back are those that brute force finds."""
    monkeypatch.setattr(adaptive_scan, "DENSE", dense)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 40)).astype(np.float32)
    product = x[:50].astype(np.float64) @ x.astype(np.float64).T
    np.fill_diagonal(product, -np.inf)
    ranked = -np.sort(-product, axis=1)
    # a bound that seven rows reach, and none at all
    bound = np.where(np.arange(50) % 2 == 0, (ranked[:, 6] + ranked[:, 7]) / 2, -np.inf)
    index = adaptive_scan.fit(x.astype(np.float64), float((x.astype(np.float64) ** 2).sum(axis=1).max()), len(x))
    rows = pd.DataFrame({"vec_id": np.arange(600), "embedding": list(x)})
    queries = pd.DataFrame({"query_id": np.arange(50), "embedding": list(x[:50]), "bound": bound})
    got = adaptive_scan._tile(index, 20)(rows, queries).groupby("query_id")["vec_id"].agg(set)
    for q in range(50):
        best = np.argsort(-product[q])
        if q % 2:
            assert len(got[q] & set(best[:20])) >= 19 and len(got[q]) == 20
        else:
            assert got.get(q, set()) <= set(best[:7])
    assert sum(len(got.get(q, ())) for q in range(0, 50, 2)) >= 0.95 * 7 * 25


def test_the_bound_is_reached_by_ids_not_by_vectors(spark, monkeypatch):
    """One id with many near vectors in the lists scanned first hides no other id."""
    monkeypatch.setattr(adaptive_scan, "ONE_LIST", 100)
    monkeypatch.setattr(adaptive_scan, "BOUND_ROWS", 1)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    more = [(1000, [float(v) for v in x[0] * (1.5 + 0.01 * i)]) for i in range(15)]
    rows = vectors(spark, x, more)
    got = [r["vec_id"] for r in adaptive_scan.search(rows, rows.filter("vec_id = 0")).orderBy("rank").collect()]
    want = [i for i, _ in nearest(x, [0], 19)[0]]
    assert got[0] == 1000 and len(got) == len(set(got)) == 20
    assert len(set(got[1:]) & set(want)) >= 17


def test_signatures_take_no_more_memory_for_many_short_texts(monkeypatch):
    """Batches are bounded by darts, and the parts of a long input give the same signature."""
    import tracemalloc

    rng = np.random.default_rng(4)
    texts = [np.sort(rng.integers(0, 2**63, 10).astype(np.uint64)) for _ in range(int(dart_minhash.BATCH / dart_minhash.DARTS))]
    tracemalloc.start()
    whole = dart_minhash.signatures(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    monkeypatch.setattr(dart_minhash, "BATCH", 1000)
    assert (dart_minhash.signatures(texts[:20]) == whole[:20]).all()


def test_scores_do_not_depend_on_the_block_and_ties_go_to_the_smaller_id(spark, monkeypatch):
    """Copies lie in several blocks and lists; their scores are equal to the last bit."""
    monkeypatch.setattr(adaptive_scan, "BLOCK_ROWS", 7)
    monkeypatch.setattr(adaptive_scan, "ONE_LIST", 10)
    rng = np.random.default_rng(12)
    one = rng.normal(size=64).astype(np.float32)
    rows = [(i, one.tolist()) for i in range(1, 60)] + [(0, (one * 0.5).tolist())]
    rows += [(100 + i, (rng.normal(size=64) * 0.1).astype(np.float32).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = adaptive_scan.search(frame, frame.filter("vec_id = 0")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(1, 21))
    want = float((one.astype(float) * (one * np.float32(0.5)).astype(float)).sum())
    assert {r["score"] for r in got} == {want}


def test_lengths_are_tables_of_their_own_and_ids_count_with_their_best(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 3.0, 0.0]), (5, [5.0, 5.0, 5.0]), (2, [3.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in adaptive_scan.search(frame, frame.filter("vec_id in (1, 4)")).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 2, 3.0), (4, 1, 5, 15.0), (4, 2, 3, 0.0)]
