"""The stages one by one and together."""

import random

import corpus_pipeline
import public_tokenizers  # noqa: F401
from llm_rows import frame
from test_near import expected
from test_tokens import places_hold

from tenderloom.llm import language_codes, ordinal_toxicity


def test_run_equals_the_operators_applied_in_turn(spark, sf, documents, texts):
    rows = corpus_pipeline.run(spark, sf).collect()
    found = {r["doc_id"]: r for r in language_codes.identify(documents).collect()}
    kept = {i for i, r in found.items() if r["lang_pred"] != "und" and not (r["ambiguous"] and r["score"] < 1.1 / 4)}
    left = documents.where(documents["doc_id"].isin(sorted(kept)))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept -= {r["doc_id"] for r in ordinal_toxicity.assess(left, labels).where("toxic").collect()}
    classes = expected([(i, texts[i]) for i in sorted(kept)], 4, 5)
    assert {r["doc_id"] for r in rows} == {i for i, _, _, own in classes if own}
    assert all(r["length"] <= 2048 for r in rows)
    places_hold(rows)


def test_stages_keep_the_columns_and_clean_rows(spark, sf, odd, empty):
    for df in (odd, empty, frame(spark, [(1, None, None)])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf)
            assert out.schema == df.schema
            out.collect()
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, empty, sf).collect() == []
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, odd, sf).collect()}
    assert kept == {1, None, 3, 4, 5, 6, 7, 9, -5}


def test_unlearnt_languages_and_gibberish_go_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text RLIKE '[a-z]'")
    unlearnt = docs.where("lang = 'de' AND length(text) > 300").selectExpr("doc_id + 1000000 AS doc_id", "text")
    draw = random.Random(5)
    letters = [("abcdefghijklmnopqrstuvwxyz    ", 2_000_000), ("абвгдежзийклмнопрст    ", 3_000_000)]
    rows = [(n + k, "".join(draw.choices(x, k=700))) for x, n in letters for k in range(30)]
    en, fr = (" ".join(r["text"] for r in docs.where(f"lang = '{g}'").limit(3).collect())[:600] for g in ("en", "fr"))
    rows.append((4_000_000, f"{en} {fr}"))
    planted = unlearnt.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    clean = docs.where("lang <> 'de'").select("doc_id", "text", "lang")
    kept = corpus_pipeline.identify_language(spark, clean.unionByName(planted, allowMissingColumns=True), sf)
    kept = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len({i for i in kept if i < 1_000_000}) >= 0.995 * clean.count()
    assert len({i for i in kept if 1_000_000 <= i < 2_000_000}) <= 0.1 * unlearnt.count()
    assert not {i for i in kept if 2_000_000 <= i < 4_000_000}
    assert 4_000_000 in kept


def test_one_row_of_each_group_whatever_the_ids(spark, sf):
    base = [f"w{k}" for k in range(60)]
    x, near, y = " ".join(base), " ".join([*base[:-1], "other"]), "a unique text of seven words here"
    z, q = "rows that come again and again", "rows without any id at all"
    rows = [(3, x), (5, x), (5, y), (7, z), (7, z), (7, z.upper()), (8, z), (3, near), (None, q), (None, q), (None, q + " ")]
    rows += [(None, None), (None, None), (11, ""), (11, "")]
    df = frame(spark, [(i, t, g) for (i, t), g in zip(rows, ["en", "fr", None] * 5)])
    out = corpus_pipeline.drop_near_duplicates(spark, df, sf)
    assert out.schema == df.schema
    kept = [(r["doc_id"], (r["text"] or "").lower().strip()) for r in out.collect()]
    threes = [t for i, t in kept if i == 3]
    assert len(threes) == 1 and threes[0] in (x, near)
    assert sorted(t for i, t in kept if i not in (3, 11) and t) == sorted([y, z, q])
    assert sorted(map(str, kept)) == sorted(map(str, [(3, threes[0]), (5, y), (7, z), (None, q), (None, ""), (None, ""), (11, ""), (11, "")]))


def test_of_repeated_rows_the_first_by_the_other_columns_stays(spark, sf):
    text = "rows that differ in their other columns alone"
    rows = [(1, text, lang, "s", n) for lang, n in (("fr", 1), ("en", 7), ("en", 3), (None, 9))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).selectExpr("*", "map('k', lang) AS m", "'x' AS judged_key").repartition(3)
        (kept,) = corpus_pipeline.drop_near_duplicates(spark, df, sf).collect()
        assert (kept.lang, kept.n_chars, kept.m) == (None, 9, {"k": None})
        some = corpus_pipeline.drop_near_duplicates(spark, df.where("lang IS NOT NULL"), sf).collect()
        assert [(r.lang, r.n_chars) for r in some] == [("en", 3)]
