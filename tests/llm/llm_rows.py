"""Rows that several tests use."""

SF = "/root/testdata/sf0.001"
CLASHING = ("class", "part", "row", "length", "lang_pred", "value", "component", "text_", "_id", "_key", "judged_id", "repeated")


def frame(spark, rows):
    """Documents (doc_id, text, lang) with further columns whose names operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, g, "s", None if t is None else len(t)) for i, t, g in rows]
    df = spark.createDataFrame(rows, schema)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


LONG = " ".join(f"word{k % 977} and{k % 13}" for k in range(30_000))
ODD = [
    (1, "a b c d e f g h", "en"),
    (2, "a b c d e f g h", "en"),
    (2, "a b c d e f g h", "en"),
    (None, "a b c d e f g h", None),
    (3, None, "en"),
    (4, "", "fr"),
    (5, " \n\t", None),
    (6, "!!! 123", "en"),
    (7, LONG, "de"),
    (8, LONG + " end", "de"),
    (9, "été \U0001f600 café", None),
    (-5, "x", "en"),
]
