"""Fingerprints and exact search."""

import hashlib

import numpy as np
from llm_rows import ODD

from tenderloom.llm import queries, topk, weighted_sampling
from tenderloom.llm.weighted_sampling import Sampler, likeness, terms_of, weight


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sampler = Sampler(64)
    out = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = sampler.fingerprints([text, changed, after])
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), sha, a.hex(), b.hex(), likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


def test_fingerprints_of_the_table(spark, sf, texts):
    rows = queries.op1_weighted_sampling(spark, sf).collect()
    assert sorted(map(tuple, rows), key=str) == expected(list(texts.items()))


def test_fingerprints_of_odd_rows(odd, empty):
    for partitions in (1, 3, 40):
        rows = weighted_sampling.fingerprint(odd, partitions=partitions).collect()
        assert sorted(map(tuple, rows), key=str) == expected([(i, t or "") for i, t, _ in ODD])
    assert weighted_sampling.fingerprint(empty).collect() == []
    one = weighted_sampling.fingerprint(odd.where("doc_id = 1")).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(1, 1.0)]


def test_collisions_follow_the_generalised_jaccard_similarity():
    random = np.random.default_rng(5)
    words = [f"word{k}" for k in range(60)]
    errors = []
    for _ in range(12):
        x = " ".join(random.choice(words, random.integers(20, 200)))
        y = " ".join([*x.split()[: random.integers(5, 150)], *random.choice(words, random.integers(1, 80))])
        a, b = ({w: weight(w, n) for w, n in terms_of(t).items()} for t in (x, y))
        keys = a.keys() | b.keys()
        true = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
        errors.append(likeness(*Sampler(4096).fingerprints([x, y])) - true)
    assert np.abs(errors).max() < 0.035
    assert abs(np.mean(errors)) < 0.015


def test_fingerprints_dont_depend_on_what_was_seen_before(texts):
    sampler, some = Sampler(64), list(texts.values())[:40]
    together = sampler.fingerprints(some)
    assert together == [Sampler(64).fingerprints([t])[0] for t in some]
    assert Sampler(8).fingerprints(["", " \n", "!!"])[:2] == [bytes(16)] * 2


# --- exact search ----------------------------------------------------------------------------------


def brute(rows, k=5):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, [int(np.floor(256 * np.float64(x))) for x in v]))
    queries_ = {}
    for i, v in usable:
        if i % 50 == 0:
            queries_[i] = min(v, queries_.get(i, v), key=lambda w: (len(w), w))
    out = []
    for i, v in queries_.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(w) == len(v))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_search_of_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op10_exact_top_k(spark, sf).collect())) == brute(rows)


def test_search_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 3)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    nan, inf = float("nan"), float("inf")
    rows = [(k, [0.5, float(k % 3)]) for k in range(40)]
    rows += [(50, [1.0, 1.0]), (100, [1.0, -1.0]), (150, None), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0])]
    rows += [(None, [1.0, 1.0]), (350, []), (400, [1.0, 2.0, 3.0]), (450, [1e12, 1.0]), (7, [9.0, 9.0]), (-50, [0.1, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS shard")
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows)
    assert topk.top_k(df.limit(0)).collect() == []


def test_copies_of_matrices_are_never_broadcast(spark, plan_of, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 3)
    df = spark.createDataFrame([(k, [0.5, float(k % 3)]) for k in range(60)], "vec_id long, embedding array<double>")
    plan = plan_of(topk.top_k(df), run=True)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_scores_beyond_a_long_are_an_error():
    import pytest

    big, ids = np.array([[2.0**32, 1.0]]), np.array([1], np.int64)
    exact = topk.best_of_tile(big, ids, np.array([[2.0**30, 3.0]]), np.array([2], np.int64), 5)
    assert exact[2].tolist() == [2**62 + 3]
    with pytest.raises(OverflowError):
        topk.best_of_tile(big, ids, big, np.array([2], np.int64), 5)
