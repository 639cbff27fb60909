"""Near-duplicate classes against all pairs."""

import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from llm_rows import ODD, frame
from pyspark.sql import functions as F

from tenderloom.llm import bottom_k, queries


def plain_sets(rows):
    out = []
    for doc_id, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        out.append((doc_id, frozenset(grams)))
    return out


def expected(rows, num, den):
    """{(doc_id, n_shingles, component_id, kept)} by comparing all pairs."""
    sets = plain_sets(rows)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, (a, x)), (j, (b, y)) in combinations(enumerate(sets), 2):
        if a is not None and b is not None and x and y and den * len(x & y) >= num * len(x | y):
            root[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    return sorted(
        [(d, len(s), None if d is None else smallest[find(i)], d is None or d == smallest[find(i)]) for i, (d, s) in enumerate(sets)],
        key=str,
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_the_table(spark, sf, texts):
    assert found(queries.op8_bottom_k_near_duplicates(spark, sf)) == expected(texts.items(), 85, 100)


def test_odd_rows(odd):
    assert found(bottom_k.near_duplicates(odd, Fraction(4, 5))) == expected([(i, t) for i, t, _ in ODD], 4, 5)


def test_nothing(empty):
    assert bottom_k.near_duplicates(empty, Fraction(4, 5)).collect() == []


def changed(random, words, share):
    words = list(words)
    for k in np.flatnonzero(random.random(len(words)) < share):
        words[k] = f"n{random.integers(1 << 40)}"
    return " ".join(words)


@pytest.mark.parametrize(("num", "den"), [(4, 5), (85, 100)])
@pytest.mark.parametrize("short", [2, 32])
def test_families_of_copies_and_shared_passages(spark, num, den, short):
    """Copies with more and more changes, a passage in most texts, short texts and chains, in small blocks."""
    random = np.random.default_rng(num + short)
    base = [f"w{random.integers(5000)}" for _ in range(260)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [changed(random, base, share) for share in np.linspace(0, 0.06, 70)]
    rows += [f"{passage} " + " ".join(f"o{random.integers(1 << 40)}" for _ in range(random.integers(3, 80))) for _ in range(60)]
    few = [f"s{k}" for k in range(40)]
    rows += [changed(random, few, 0.02) for _ in range(30)]
    chain = [f"c{k}" for k in range(130)]
    rows += [" ".join(chain[k : k + 90]) for k in range(0, 40, 2)]
    rows += rows[:20]
    rows = [(int(i), t) for i, t in zip(random.permutation(len(rows)), rows)]
    df = frame(spark, [(i, t, None) for i, t in rows])
    got = bottom_k.near_duplicates(df, Fraction(num, den), short=short, block=8)
    assert found(got) == expected(rows, num, den)


def test_repeated_rows_and_ids_on_several_texts(spark):
    base = [f"w{k}" for k in range(60)]
    near = [*base[:-1], "other"]
    rows = [(5, " ".join(base))] * 40 + [(6, " ".join(near))] * 3 + [(5, "something else in five words"), (9, " ".join(near[1:]))]
    df = frame(spark, [(i, t, None) for i, t in rows])
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in bottom_k.near_duplicates(df, Fraction(4, 5)).collect()}
    assert got == {(5, 56, 5), (6, 56, 5), (5, 1, 5), (9, 55, 5)}


def test_least_overlap_is_safe_and_useful():
    for t in (Fraction(4, 5), Fraction(17, 20)):
        least = bottom_k.least_overlap(48, t)
        draws = np.random.default_rng(1).binomial(48, float(t), 1_000_000)
        assert draws.min() >= least >= 16


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(500, 400)], "a long, b long")
    got = {r["class"]: r["component"] for r in bottom_k.components(links).collect()}
    assert got == {**dict.fromkeys(range(101), 0), 400: 400, 500: 400}


def test_a_class_has_one_full_set_however_often_its_row_comes(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(5, " ".join(base))] * 50 + [(5, " ".join(base).upper())] * 5 + [(6, " ".join([*base[:-1], "other"])), (5, "other text")]
    df = frame(spark, [(i, t, None) for i, t in rows])
    first = "min(struct(doc_id, key)) AS r"
    classes = bottom_k.sketches(df).groupBy("class").agg(F.expr(first)).select("class", "r.*")
    sets = bottom_k._full_sets(df, classes.select("class"), classes, bottom_k.WORDS).collect()
    assert len(sets) == classes.count() == 3
    assert all(bottom_k._class(np.frombuffer(r["values"], np.uint64)) == r["class"] for r in sets)
