"""Fill-in-middle against plain string operations."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import ODD, frame
from tenderloom.llm import fill_middle as fim

PIECES = ["a", "é", "\U0001f600", "<", ">", "P", "S", "M", "\n", "<P", "S>", "漢"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def output(form, prefix, middle, suffix):
    if form == "plain":
        return prefix + middle + suffix
    return f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"


def expected(doc_id, text):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    plain = not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
    cuts = (None, None) if plain else (low, high - low)
    return doc_id, n, form, *cuts, sha(output(form, text[:low], text[low:high], text[high:])), sha(text)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(fim.round_trip(documents)) == sorted((expected(*r) for r in rows), key=str)


def test_odd_rows(spark):
    rnd = random.Random(5)
    more = [(k, "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))), None) for k in range(100, 600)]
    rows = [*ODD, *more, (600, "<P>", "en"), (601, "x\U0001f600é" * 700_000, "en"), (2**62, "y<", None), (7, "\x00a\x00", "en")]
    df = frame(spark, rows).selectExpr("*", "'x' AS n", "'x' AS first", "'x' AS form", "'x' AS output").repartition(3)
    assert rows_of(fim.round_trip(df)) == sorted((expected(i, t) for i, t, _ in rows), key=str)


def test_no_rows(spark, empty):
    df = fim.round_trip(empty)
    assert df.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert df.collect() == []


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_scatter_and_gather(block):
    rnd = random.Random(block)
    for _ in range(400):
        texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 6))]
        held = [not t or any(s in t for s in ("<P>", "<S>", "<M>")) for t in texts]
        forms = np.array(["plain" if h else rnd.choice(["plain", "psm", "spm"]) for h in held], object)
        cuts = np.array([sorted((rnd.randint(0, len(t)), rnd.randint(0, len(t)))) for t in texts])
        data, offsets = fim.texts_array(pa.array(["before", *texts])[1:])
        places = fim.cut_bytes(data, np.array([len(t) for t in texts]), cuts, block)
        out, out_offsets = fim.scatter(data, offsets, places, forms, block)
        wanted = [output(f, t[:a], t[a:b], t[b:]) for t, f, (a, b) in zip(texts, forms, cuts)]
        assert fim.arrow_texts(out, out_offsets).to_pylist() == wanted
        assert fim.arrow_texts(*fim.gather(out, out_offsets, forms, block)).to_pylist() == texts


def test_output_of_another_form_is_refused():
    data, offsets = fim.texts_array(pa.array(["<P>a<S>b<M>c"]))
    for form, texts in (("spm", ["<P>a<S>b<M>c"]), ("psm", ["<P>a<S>b"])):
        data, offsets = fim.texts_array(pa.array(texts))
        with pytest.raises(ValueError):
            fim.gather(data, offsets, np.array([form], object))


def test_texts_do_not_shuffle(spark, documents, plan_of):
    assert "Exchange" not in plan_of(fim.round_trip(documents))
