"""Document fingerprints by consistent weighted sampling.

For every term of a text, with weight S, and every sample k, gamma-distributed r and c and a uniform b are drawn
from the term alone: t = floor(ln S / r + b), ln y = r (t - b), ln a = ln c - ln y - r.  The term with the smallest a is
the sample, together with its t.  Two texts have the same sample with a probability equal to the generalised
Jaccard similarity of their weights, sum(min) / sum(max).

Terms are lower-cased words; a weight is the number of occurrences times the squared length of the word, a
measure of its information that needs no corpus statistics, so fingerprints of different runs compare.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import kept_in_worker, small_batches, slices, texts_of

SAMPLES = 64
MAX_CACHE = 100_000
DIGITS = 4
WORD = re.compile(r"\w+")
FIRST = -(1 << 63)


def terms_of(text: str) -> Counter:
    """Occurrences by lower-cased word; a text without words but not blank is one term, a blank one has none."""
    return Counter(WORD.findall(text.lower())) or Counter([text.strip()] if text.strip() else [])


def weight(word: str, times: int) -> float:
    return float(times * len(word) ** 2)


class Sampler:
    """Fingerprints; the draws of a term and weight are the same wherever it occurs, and looked up."""

    def __init__(self, samples: int):
        import numpy as np

        self.samples = samples
        self.row: dict[tuple[str, int], int] = {}
        # Per term and sample: ln a as a sortable integer, and in the last 16 bits the name of the term and t.
        self.draws = np.empty((1024, samples), np.uint64)

    def _draw(self, terms: list[tuple[str, int]]):
        import numpy as np
        import xxhash

        seeds = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w, _ in terms], np.uint64)
        lanes = np.arange(1, 2 * self.samples + 1, dtype=np.uint64).reshape(2, 1, self.samples)
        x = seeds[None, :, None] + lanes * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)

        def uniform(bits, size):
            return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(0.5**size)

        mask = np.uint64(0xFFFFFF)
        products = uniform(x & mask, 24) * uniform(x >> np.uint64(24) & mask, 24)
        r, c = -np.log(products)  # Gamma(2, 1) is the sum of two exponentials
        b = uniform(x[0] >> np.uint64(48), 16)
        t = np.floor(np.log(np.array([weight(*term) for term in terms], np.float32))[:, None] / r + b)
        ln_a = np.log(c) - r * (t - b) - r
        name = (x[1] >> np.uint64(48)) + t.astype(np.int64).view(np.uint64) * np.uint64(0x9E37) & np.uint64(0xFFFF)
        bits = ln_a.view(np.uint32)
        sortable = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        return sortable << np.uint64(16) | np.maximum(name, np.uint64(1))  # 0 is for texts without terms

    def _learn(self, new: list[tuple[str, int]]) -> None:
        import numpy as np

        first = len(self.row)
        if first + len(new) > len(self.draws):
            self.draws = np.resize(self.draws, (2 * (first + len(new)), self.samples))
        for k in range(0, len(new), 2048):
            part = new[k : k + 2048]
            self.draws[first + k : first + k + len(part)] = self._draw(part)
        self.row.update(zip(new, range(first, first + len(new))))

    def fingerprints(self, texts: list[str]) -> list[bytes]:
        """Two bytes per sample; equal texts have equal fingerprints."""
        import numpy as np

        out = []
        for start, stop in slices(texts, 200_000):
            bags = [terms_of(t).items() for t in texts[start:stop]]
            if len(self.row) > MAX_CACHE:
                self.row.clear()
            found = self.row
            new = [term for bag in bags for term in bag if term not in found]
            if new:
                self._learn(list(dict.fromkeys(new)))
            sizes = [len(bag) for bag in bags]
            rows = np.fromiter((found[term] for bag in bags for term in bag), np.int64, sum(sizes))
            full = [k for k, n in enumerate(sizes) if n]
            names = np.zeros((len(bags), self.samples), ">u2")
            if full:
                firsts = np.cumsum([0, *(sizes[k] for k in full)])[:-1]
                names[full] = np.minimum.reduceat(self.draws[rows], firsts, axis=0) & np.uint64(0xFFFF)
            out += [row.tobytes() for row in names]
        return out


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal samples."""
    import numpy as np

    x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) characters replaced by the first as many of the following document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _with_following(docs: DataFrame, partitions: int) -> DataFrame:
    """Rows in ranges of doc_id, each range in order and closed by a copy of the first row of the next one.

    Ranges come from quantiles of the ids.  The last range is closed by the first row of all.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias("at"))
    ids = docs.select(key.alias("at"))
    cuts = ids.approxQuantile("at", [k / partitions for k in range(1, partitions)], 0.1 / partitions) if partitions > 1 else []
    cuts = F.array(*[F.lit(int(c)).cast("long") for c in sorted(set(cuts))]).cast("array<long>")
    part = F.size(F.filter(cuts, lambda c: c <= F.col("at")))
    starts = ids.groupBy(part.alias("part")).agg(F.min("at").alias("at")).collect()  # one row for each range
    starts = sorted((r["part"], r["at"]) for r in starts)
    closes = [(starts[k - 1][0], at) for k, (_, at) in enumerate(starts)]
    table = F.create_map(*[x for p, at in closes for x in (F.lit(at).cast("long"), F.lit(p))]) if closes else F.lit(None)
    own = F.struct(part.alias("part"), F.lit(0).alias("tail"))
    if not closes:
        return rows.select("*", F.lit(0).alias("part"), F.lit(0).alias("tail"))
    before = F.try_element_at(table, F.col("at"))
    copies = F.when(before.isNull(), F.array(own)).otherwise(F.array(own, F.struct(before.alias("part"), F.lit(1).alias("tail"))))
    rows = rows.withColumn("copy", F.explode(copies)).select("doc_id", "text", "at", "copy.part", "copy.tail")
    return rows.repartitionById(partitions, F.col("part")).sortWithinPartitions("part", "tail", "at", "text")


def fingerprint(docs: DataFrame, samples: int = SAMPLES, partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The next document is the one with the next larger doc_id, null ids first, equal ids by text; after the last comes
    the first.  A null text counts as empty.  Likeness is the share of equal samples; texts without words are
    like each other (1) and unlike all others (0).  Other columns are not read.
    """
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(batches) -> Iterator:
        import pandas as pd

        sampler = kept_in_worker(f"sampler {samples}", lambda: Sampler(samples))

        def result(pending, following):
            """The rows of ``pending``, whose last one is followed by ``following`` (None: by nothing here)."""
            if following is not None:
                pending = [*pending, following]
            texts = [t for *_, t in pending]
            own = sampler.fingerprints(texts)
            out, changed = [], []
            for (part, tail, _, text), (p, _, _, after) in zip(pending, pending[1:]):
                changed.append(edited(text, after) if part == p and not tail else "")
            prints = sampler.fingerprints(changed)
            for k, (part, tail, doc_id, text) in enumerate(pending[:-1]):
                if tail:
                    continue
                digest = hashlib.sha256(changed[k].encode()).hexdigest()
                near = likeness(own[k], prints[k]), likeness(own[k], own[k + 1])
                out.append((doc_id, len(text), digest, own[k].hex(), prints[k].hex(), *near))
            return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

        pending: list = []
        for batch in batches:
            known = [None if v is pd.NA else int(v) for v in batch["doc_id"].astype("Int64")]
            for row in zip(batch["part"], batch["tail"], known, texts_of(batch["text"])):
                pending.append(row)
            yield result(pending, None)
            pending = pending[-1:]

    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    small_batches(docs.sparkSession)
    ordered = _with_following(docs, partitions)
    return ordered.select("part", "tail", "doc_id", "text").mapInPandas(rows, schema)
