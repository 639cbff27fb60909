"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1.  For each bit a binary classifier (logistic regression over
character n-gram frequencies) predicts it; the language whose codeword has the least logistic loss against
all predictions wins.  A document whose two best languages lie close together is flagged as ambiguous.

The classifiers learn from at most ``SAMPLE_PER_LANGUAGE`` different documents of each language, those with the smallest
hashes of id and text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import small_batches, slices, staged, texts_of

SAMPLE_PER_LANGUAGE = 1_000
FEATURES = 4_096
EXHAUSTIVE_UP_TO = 6
AMBIGUOUS = 0.6
UNDETERMINED = "und"
LETTER = r"\p{L}"
NOT_LETTERS = re.compile(r"[\W\d_]+")
HELD_OUT_OF, HELD_OUT = 4, 2
# Calibration of the rejecting score: this share of a language's own documents of a size may lie below, at least so many
# documents are needed, scores beyond a limit are as good as it, and a margin is left. The latter two are log-odds.
REJECTED, LEAST_CALIBRATING, SURE, MARGIN = 0.005, 20, 4.0, 1.0
BANDS = 64
PASSAGE_WORDS, PASSAGES_AT_ONCE = 12, 256


class Model(NamedTuple):
    """Languages, their codewords (languages x bits), and a weight row per feature plus one for the bias."""

    languages: list[str]
    codes: object
    weights: object


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder that is never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT


def codewords(languages: int):
    """All distinct splits of a few languages, or else random splits whose closest rows are farthest apart."""
    import numpy as np

    if languages <= EXHAUSTIVE_UP_TO:
        bits = range(1, 1 << max(languages - 1, 0))
        rows = [[1] * len(bits)] + [[-1 if b >> k & 1 else 1 for b in bits] for k in range(languages - 1)]
        return np.array(rows[:languages], np.float32).reshape(languages, len(bits))
    random = np.random.default_rng(languages)
    tries = [random.choice([-1.0, 1.0], (languages, int(12 * np.log2(languages)))) for _ in range(64)]

    def closest(code):
        return (code.shape[1] - (code @ code.T - 2 * code.shape[1] * np.eye(languages))).min()

    return max(tries, key=closest).astype(np.float32)


def features(texts: list[str], size: int = FEATURES):
    """Square roots of the frequencies of hashed letter n-grams (1 to 3 bytes); words are set apart by spaces."""
    return features_and_bands(texts, size)[0]


def features_and_bands(texts: list[str], size: int = FEATURES):
    """The features, and the bits of the number of bytes that they count: how much text a score rests on."""
    import numpy as np

    rows, bands = np.zeros((len(texts), size), np.float32), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        data = np.frombuffer(f" {NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode(), np.uint8).astype(np.uint32)
        pairs = data[:-1] << 8 | data[1:]
        triples = pairs[:-1] << 8 | data[2:]
        for n, grams in enumerate((data, pairs, triples)):
            hashed = (grams + np.uint32(n << 24)) * np.uint32(2654435761)
            rows[k] += np.bincount(hashed >> np.uint32(32 - size.bit_length() + 1), minlength=size)
        rows[k] = np.sqrt(rows[k] / max(1.0, rows[k].sum()))
        bands[k] = len(data).bit_length()
    return rows, bands


def fit(rows, labels: list[str], steps: int = 300) -> Model:
    """Classifiers of all bits at once, by gradient descent with momentum on a fixed number of steps."""
    import numpy as np

    languages = sorted(set(labels))
    codes = codewords(len(languages))
    number = {language: k for k, language in enumerate(languages)}
    own = np.array([number[label] for label in labels], np.int64)
    target = codes[own] if labels else np.zeros((0, 0), np.float32)
    weight = (1.0 / np.bincount(own, minlength=len(languages)))[own].astype(np.float32) if labels else np.zeros(0)
    weight = (weight / max(1e-9, weight.sum()))[:, None]
    x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    w = np.zeros((x.shape[1], codes.shape[1]), np.float32)
    speed = np.zeros_like(w)
    for _ in range(steps if labels else 0):
        margin = np.clip(target * (x @ w), -30, 30)
        step = x.T @ (-target * weight / (1 + np.exp(margin))) + 1e-5 * w
        speed = 0.9 * speed - 4.0 * step
        w += speed
    return Model(languages, codes, w)


def decode(model: Model, rows):
    """(position of the language with the least loss, its share among all, ambiguous) of each row."""
    import numpy as np

    f = rows @ model.weights[:-1] + model.weights[-1]
    loss = np.logaddexp(0, -f[:, None, :] * model.codes[None, :, :]).sum(axis=2)
    loss *= 2.0 / max(1, len(model.languages))  # each language differs from another in about half of all bits
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    share /= share.sum(axis=1, keepdims=True)
    return share.argmax(axis=1), share.max(axis=1), share.max(axis=1) < AMBIGUOUS


def calibrated(rows, bands, labels: list[str]):
    """Least scores (languages x bands) of texts that are like their language, in the order of ``fit``'s languages.

    Each half of the sample is scored by a model of the other half.  A cut comes from documents of about the same size
    that were decoded to their own language, or from smaller ones, which score less, if these are few.  It is 0
    where there are too few of both.
    """
    import numpy as np

    languages = sorted(set(labels))
    own = np.array([languages.index(label) for label in labels], np.int64)
    odds, right = np.zeros(len(labels)), np.zeros(len(labels), bool)
    for half in (0, 1):
        seen, unseen = np.arange(half, len(labels), 2), np.arange(1 - half, len(labels), 2)
        model = fit(rows[seen], [labels[i] for i in seen])
        if model.languages == languages and len(unseen):
            best, share, _ = decode(model, rows[unseen])
            odds[unseen], right[unseen] = np.log(np.maximum(share, 1e-9) / np.maximum(1 - share, 1e-9)), best == own[unseen]
    cuts = np.zeros((len(languages), BANDS))
    for k in range(len(languages)):
        mine = right & (own == k)
        for band in range(BANDS):
            for low in range(band - 1, -2, -1):
                like = mine & (bands >= low) & (bands <= band + 1)
                if like.sum() >= LEAST_CALIBRATING:
                    cut = np.quantile(np.minimum(odds[like], SURE), REJECTED, method="lower") - MARGIN
                    cuts[k, band] = 1 / (1 + np.exp(-cut))
                    break
    return cuts


def several_languages(model: Model, cuts, text: str) -> bool:
    """Whether a text that scores little as a whole changes between learnt languages.

    At least half of its passages reach the cut of their best language and size, and a tenth of these is not of the
    most frequent language.
    """
    import numpy as np

    words, seen = text.split(), 0
    passages = [" ".join(words[k : k + PASSAGE_WORDS]) for k in range(0, len(words), PASSAGE_WORDS)]
    like = np.zeros(len(model.languages), np.int64)
    for first in range(0, len(passages), PASSAGES_AT_ONCE):
        x, bands = features_and_bands(passages[first : first + PASSAGES_AT_ONCE])
        best, share, _ = decode(model, x)
        cut = cuts[best, bands]
        like += np.bincount(best[(share >= cut) & (cut > 0)], minlength=len(like))
        seen += int((cut > 0).sum())
    return seen > 0 and 2 * like.sum() >= seen and 10 * (like.sum() - like.max()) >= like.sum() > 0


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from the text and non-null lang of documents that are not held out."""
    rows, _, labels = sampled(docs, per_language)
    return fit(rows, labels)


def learn_calibrated(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE):
    """The same model, and the least scores of ``calibrated``."""
    rows, bands, labels = sampled(docs, per_language)
    return fit(rows, labels), calibrated(rows, bands, labels)


def sampled(docs: DataFrame, per_language: int):
    """Features, bands and languages of a bounded sample of documents that are not held out."""
    small_batches(docs.sparkSession)
    usable = docs.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    usable = usable.where(~F.coalesce(held_out(F.col("id")), F.lit(False)))
    usable = usable.withColumn("h", F.xxhash64("id", "text"))
    # Equal rows count once.  The smallest hashes of a language: so many of each task, then of all.
    numbers = usable.select("lang", "h").distinct()
    first = Window.partitionBy("lang").orderBy("h")
    least = staged(numbers.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language), "sample")
    chosen = usable.join(F.broadcast(least.select("lang", "h")), ["lang", "h"])
    chosen = chosen.groupBy("lang", "h").agg(F.first("id").alias("id"), F.first("text").alias("text"))

    def rows(batches) -> Iterator:
        for batch in batches:
            found, bands = features_and_bands(batch["text"].tolist())
            found = [x.astype("<f2").tobytes() for x in found]
            yield pd.DataFrame({"id": batch["id"], "lang": batch["lang"], "x": found, "band": bands})

    import numpy as np

    # At most per_language rows of 8 KB for each language.
    sample = chosen.select("id", "lang", "text").mapInPandas(rows, "id string, lang string, x binary, band long").collect()
    sample.sort(key=lambda r: (r["lang"], r["id"] or "", r["x"]))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in sample), "<f2").astype(np.float32).reshape(len(sample), FEATURES)
    return x, np.array([r["band"] for r in sample], np.int64), [r["lang"] for r in sample]


def predicted(text: Column, model: Model, cuts=None) -> Column:
    """struct(lang, score, ambiguous, unlike) of each whole text.

    A null text, or one without a letter, is ``und`` with score 0 and not ambiguous; so is every text if no language
    was learnt.  A text is unlike all languages if its score is below the cut of its best language and size
    and its passages are not of several.
    """
    @F.pandas_udf("lang string, score double, ambiguous boolean, unlike boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        import numpy as np
        import regex

        letter = regex.compile(LETTER).search
        rows = texts_of(texts)
        known = np.array([bool(model.languages) and letter(t) is not None for t in rows], bool)
        lang, score = np.full(len(rows), UNDETERMINED, object), np.zeros(len(rows))
        unsure, unlike = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
        at = np.flatnonzero(known)
        for first, last in slices([rows[i] for i in at]):
            part = at[first:last]
            x, bands = features_and_bands([rows[i] for i in part])
            best, share, close = decode(model, x)
            lang[part] = [model.languages[b] for b in best]
            score[part], unsure[part] = share, close
            if cuts is not None:
                low = np.flatnonzero(share < cuts[best, bands])
                unlike[part[low]] = [not several_languages(model, cuts, rows[part[i]]) for i in low]
        return pd.DataFrame({"lang": lang, "score": score, "ambiguous": unsure, "unlike": unlike})

    return predict(text.cast("string"))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row; lang, source and doc_id are no inputs.

    A null doc_id is held out of nothing.  Repeated rows get equal predictions.
    """
    small_batches(docs.sparkSession)
    model = model or learn(docs)
    rows = docs.select(F.col("doc_id"), predicted(F.col("text"), model).alias("p"))
    return rows.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        F.col("p.ambiguous").alias("ambiguous"),
    )
