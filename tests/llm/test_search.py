"""Reversed search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from llm_rows import LONG, ODD, frame
from tenderloom.llm import reversed_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, asked in wanted.items():
        scored = []
        for doc, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t, times in asked.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=str)


def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, term string, times string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark, documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(rs.search(documents, items)) == expected(docs, [tuple(r) for r in items.select("item_id", "text").collect()])


@pytest.mark.parametrize("most", [400_000, 3])
def test_odd_rows(spark, most):
    rnd = random.Random(11)
    words = ["Ab", "été", "x9", "Émile", "the", "\U0001f600", "zz", "q"]
    more = [(k, rnd.choice(["-", " ", "\x7f"]).join(rnd.choices(words, k=rnd.randint(1, 9))), "en") for k in range(20, 90)]
    copies = [(k, "the same Ab text", "en") for k in range(200, 260)]
    docs = [*ODD, *more, *copies, (None, "the same Ab text", "en"), (2**62 + 1, "zz zz", "en")]
    items = [(1, "a word5 AND b"), (2, "AB été the x9"), (2, "zz"), (None, "émile Émile q"), (3, None), (4, "!?"), (5, "nowhere"), (6, LONG)]
    df = frame(spark, docs).selectExpr("*", "'x' AS n", "'x' AS terms", "'x' AS tf", "'x' AS score").repartition(5)
    got = rows_of(rs.search(df, items_frame(spark, items), most=most))
    assert got == expected([(i, t) for i, t, _ in docs], items)


def test_no_rows(spark, empty, documents):
    some = items_frame(spark, [(1, "the")])
    for df in (rs.search(empty, some), rs.search(documents, some.limit(0))):
        assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.collect() == []


def test_terms_of_long_texts_are_whole():
    text = "Ab,é" * 1000 + " end"
    for chunk in (1, 7, 100, 10_000_000):
        assert [t.decode() for part in rs.terms_of(text, chunk) for t in part] == terms(text)


def test_damping_is_exact_beyond_64_bits():
    import numpy as np

    n, docs, total = 10**9, 10**12, 10**14
    assert rs.damping(np.array([n, 1]), docs, total).tolist() == [25 + 75 * n * docs // total, 25 + 75 * docs // total]


def test_heaps_keep_small_ids_among_equals():
    import numpy as np

    heaps = rs.Heaps(2, 3)
    heaps.update([4, 5, 6, 7, None], np.array([[5, 0], [5, 0], [5, 1], [5, 0], [9, 0]]))
    heaps.update([1, 2, 3], np.array([[5, 0], [4, 0], [5, 0]]))
    found = [sorted(((s, -i if named else None) for s, named, i in h), key=str) for h in heaps.heaps]
    assert found == [[(5, 1), (5, 3), (9, None)], [(1, 6)]]


def test_blocks_are_bounded_and_whole(spark):
    items = items_frame(spark, [(k, " ".join(f"w{j}" for j in range(k % 7 + 1))) for k in range(60)])
    postings = rs.item_terms(items)
    blocks = [b.collect() for b in rs.in_blocks(postings, most=10)]
    assert all(len(b) <= 27 for b in blocks) and sum(map(len, blocks)) == postings.count()
    owners = [{r.item_id for r in b} for b in blocks]
    assert sum(map(len, owners)) == 60
