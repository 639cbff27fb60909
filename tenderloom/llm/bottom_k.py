"""Near-duplicate classes from bottom-k sketches.

A document is the set of its distinct word shingles.  One hash function orders all shingles, and a sketch keeps
the k smallest values of a set.  Equal sets are one class, and classes alone are compared:

* Inverted lists of retained values give candidates.  Two sets of similarity t or more share nearly t * k of the
  retained values; ``least_overlap`` is so low that missing a link has a probability below ``MISS``.  Values are ordered
  from rare to common, and a list needs only those that come first in a sketch: two sketches with that
  overlap share one of them.  So a passage that a third of all documents hold gives no list, unless it is
  nearly all of a document.
* Pairs of a short list stay candidates if the sketch of their union estimates that they could link.  The
  members of a long list all do, by way of its first: these are copies of one text with small changes.
* Candidates that hang together are a family.  A family is cut by set size and then into blocks; every two blocks whose
  sizes could link meet as a tile, which compares sketches first and full sets then, and returns a spanning
  forest of its links instead of all pairs.

Links are exact.  Components are found by moving classes to their smallest neighbours and contracting the links, with
tables written every round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import kept_in_worker, small_batches, staged, texts_of

WORDS = 5
K = 48
MISS = 1e-9
SHORT_LIST = 32
BLOCK = 64
BLOCK_SHINGLES = 200_000
MAX_WORDS = 200_000
# A-Z alone are lower-cased: in UTF-8 no other character has their bytes.  White space of bytes is 20 and 09 to 0D.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SETS = "n_shingles long, class long, sketch array<long>"


def shingle_set(text: str, words: int = WORDS):
    """The sorted distinct 64-bit values of a text's shingles.

    A-Z are lower-cased; a text of fewer words is one shingle, one without words gives none.
    """
    import numpy as np

    found = text.encode().translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([_value(b"\x00" + b" ".join(found))], np.uint64)
    known = kept_in_worker("words", dict)
    if len(known) > MAX_WORDS:
        known.clear()
    known.update([(w, _value(w)) for w in set(found) if w not in known])
    ids = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = len(ids) - words + 1
    value = np.zeros(n, np.uint64)
    for k in range(words):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n])
    return np.unique(value)


def _value(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _class(values) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(k: int, similarity: Fraction, miss: float = MISS) -> int:
    """The most retained values that two linked sets share with a probability of 1 - miss.

    The k smallest values of the union are a sample of it; those in both sets are in both sketches.
    """
    t, below, n = float(similarity), 0.0, 0
    while n < k:
        below += math.comb(k, n) * t**n * (1 - t) ** (k - n)
        if below > miss:
            break
        n += 1
    return max(1, n)


def _signed(values):
    """Unsigned values as signed ones of the same order."""
    import numpy as np

    return (values ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame, words: int = WORDS, k: int = K) -> DataFrame:
    """doc_id, key (of the text), n_shingles, class (null without shingles), sketch of every row."""

    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            sets = [shingle_set(t, words) for t in texts_of(batch["text"])]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "key": batch["key"],
                    "n_shingles": [len(s) for s in sets],
                    "class": pd.array([_class(s) if len(s) else None for s in sets], dtype="Int64"),
                    "sketch": [_signed(s[:k]) for s in sets],
                }
            )

    small_batches(docs.sparkSession)
    narrow = _narrow(docs)
    return narrow.mapInPandas(rows, f"doc_id long, key long, {SETS}")


def text_key() -> Column:
    """A number of a row's text: with the id it tells texts apart, without making their sets again."""
    return F.xxhash64(F.col("text").cast("string"))


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, text_key().alias("key"))


def _prefix_lists(classes: DataFrame, similarity: Fraction, k: int) -> DataFrame:
    """class, n_shingles, value: the rare retained values of each class that other classes have too."""
    t = float(similarity)
    # Sets of up to k values are kept whole, as are their partners or nearly: their overlap needs no estimate.
    own_least = F.ceil(F.size("sketch") * t - 1e-9)
    least = F.when(F.col("n_shingles") <= math.floor(k * t), own_least).otherwise(F.lit(least_overlap(k, similarity)))
    first = (F.size("sketch") - least + 1).cast("int")
    postings = classes.select("class", F.explode("sketch").alias("value"))
    common = postings.groupBy("value").agg(F.count("*").alias("times")).where("times > 1")
    # Values of a single class come first in this order, so a sketch needs only to know how many it has.
    shared = postings.join(staged(common, "common"), "value")
    ordered = shared.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("times", "value"))).alias("v"))
    wanted = F.col("first") - (F.col("size") - F.size("v"))
    rare = F.explode(F.slice("v", F.lit(1), F.greatest(F.lit(0), wanted))).alias("v")
    sizes = classes.select("class", "n_shingles", F.size("sketch").alias("size"), first.alias("first"))
    return ordered.join(sizes, "class").select("class", "n_shingles", rare).select("class", "n_shingles", "v.value")


def _candidates(classes: DataFrame, similarity: Fraction, k: int, short: int) -> DataFrame:
    """a, b: pairs of classes whose sketches allow a link, and the members of long lists with the first of them."""
    lists = staged(_prefix_lists(classes, similarity, k), "lists")
    per_value = lists.groupBy("value").agg(F.count("*").alias("times"), F.min("class").alias("head"))
    per_value = staged(per_value.where("times > 1"), "values")
    members = F.collect_list(F.struct("class", "n_shingles"))
    few = lists.join(per_value.where(F.col("times") <= short), "value").groupBy("value").agg(members.alias("m"))
    small, large = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
    pairs = few.select(F.explode("m").alias("x"), "m").select("x", F.explode("m").alias("y"))
    pairs = pairs.where(
        (F.col("x.class") < F.col("y.class")) & (small * similarity.denominator >= large * similarity.numerator)
    )
    pairs = pairs.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    # A class hangs on the smallest of the heads of its lists, and so do the other heads: copies of one text have the
    # same few heads, so this leaves about one link per member instead of one per list.
    heads = lists.join(per_value.where(F.col("times") > short), "value").groupBy("class").agg(
        F.collect_set("head").alias("heads")
    )
    hung = F.explode(F.array_union("heads", F.array("class"))).alias("b")
    many = heads.select(F.array_min("heads").alias("a"), hung).where("a <> b").distinct()
    return _estimated(pairs, classes, similarity, k).unionByName(many)


def _estimated(pairs: DataFrame, classes: DataFrame, similarity: Fraction, k: int) -> DataFrame:
    """The pairs with enough of the k smallest values of their union in both sketches."""
    s = classes.select("class", "sketch")
    both = pairs.join(s.select(F.col("class").alias("a"), F.col("sketch").alias("sa")), "a")
    both = both.join(s.select(F.col("class").alias("b"), F.col("sketch").alias("sb")), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = both.select("a", "b", union.alias("u"), F.array_intersect("sa", "sb").alias("c"))
    whole = F.ceil(F.size("u") * float(similarity) - 1e-9)
    least = F.when(F.size("u") < k, whole).otherwise(F.lit(least_overlap(k, similarity)))
    return both.where(F.size(F.array_intersect("u", "c")) >= least).select("a", "b")


def _full_sets(docs: DataFrame, wanted: DataFrame, representatives: DataFrame, words: int) -> DataFrame:
    """class, values (unsigned 64-bit, little-endian): the whole set of each wanted class, from one text."""

    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            sets = [shingle_set(t, words) for t in texts_of(batch["text"])]
            yield pd.DataFrame({"class": batch["class"], "values": [s.tobytes() for s in sets]})

    one = wanted.join(representatives.select("class", "doc_id", "key"), "class")
    # Rows that come again are reduced within each task before their texts are dealt out and made to sets.
    texts = _narrow(docs).join(one, ["doc_id", "key"]).groupBy("class").agg(F.first("text").alias("text"))
    return texts.mapInPandas(rows, "class long, values binary")


def _linked(x, y, similarity: Fraction) -> bool:
    import numpy as np

    shared = len(np.intersect1d(x, y, assume_unique=True))
    return similarity.denominator * shared >= similarity.numerator * (len(x) + len(y) - shared)


def _could_link(x, y, similarity: Fraction, k: int, least: int) -> bool:
    """Whether the union of the sketches of two sorted sets estimates enough in common."""
    import numpy as np

    if similarity.denominator * min(len(x), len(y)) < similarity.numerator * max(len(x), len(y)):
        return False
    union = np.union1d(x[:k], y[:k])[:k]
    shared = np.intersect1d(np.intersect1d(x[:k], y[:k], assume_unique=True), union, assume_unique=True)
    return len(union) < k or len(shared) >= least


def tile_links(classes, sets, half: int, similarity: Fraction, k: int = K) -> list[tuple[int, int]]:
    """A spanning forest of the links among sorted ``sets``: of the first ``half`` with the rest, or all if there is none.

    Pairs with the largest overlap of sketches come first; a pair that is already connected needs no look.
    """
    import numpy as np

    least, n = least_overlap(k, similarity), len(sets)
    sizes = np.array([min(k, len(s)) for s in sets])
    row = np.repeat(np.arange(n), sizes)
    _, column = np.unique(np.concatenate([s[:k] for s in sets]), return_inverse=True)
    kept = np.zeros((n, int(column.max()) + 1), np.float32)
    kept[row, column] = 1
    overlap = kept @ kept.T
    x, y = np.triu_indices(n, 1)
    if half:
        across = (x < half) & (y >= half)
        x, y = x[across], y[across]
    enough = np.minimum(least, np.ceil(float(similarity) * np.minimum(sizes[x], sizes[y]) - 1e-6))
    maybe = overlap[x, y] >= enough
    x, y = x[maybe], y[maybe]
    order = np.argsort(-overlap[x, y], kind="stable")
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in zip(x[order].tolist(), y[order].tolist()):
        p, q = find(i), find(j)
        if p != q and _could_link(sets[i], sets[j], similarity, k, least) and _linked(sets[i], sets[j], similarity):
            root[max(p, q)] = min(p, q)
            links.append((int(classes[i]), int(classes[j])))
    return links


def _family_links(docs, classes: DataFrame, candidates: DataFrame, similarity: Fraction, words: int, k: int, block: int):
    """a, b: links among the classes that candidates name, from tiles of two blocks each."""
    family = components(candidates).join(classes.select("class", "n_shingles"), "class")
    # Sizes within a factor of the similarity share a band; linked classes are of one band or of two neighbours.
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / -math.log(float(similarity)))
    family = staged(family.withColumn("band", band.cast("int")), "families")
    totals = family.groupBy("component", "band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    totals = staged(totals.select("component", "band", blocks.alias("blocks")), "bands")
    placed = family.join(totals, ["component", "band"]).select(
        "component", "band", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"), "class"
    )
    numbered = totals.select("component", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    x, y = numbered.alias("x"), numbered.alias("y")
    same = (F.col("x.band") == F.col("y.band")) & (F.col("x.block") <= F.col("y.block"))
    met = x.join(y, F.col("x.component") == F.col("y.component"))
    met = met.where(same | (F.col("x.band") + 1 == F.col("y.band")))
    met = met.select("x.component", F.struct("x.band", "x.block").alias("x"), F.struct("y.band", "y.block").alias("y"))
    sides = F.when(F.col("x") == F.col("y"), F.array("x")).otherwise(F.array("x", "y"))
    tiles = met.select("component", "x", "y", F.posexplode(sides).alias("side", "at"))
    tiles = tiles.select("component", "x", "y", "side", F.col("at.band").alias("band"), F.col("at.block").alias("block"))
    sets = staged(_full_sets(docs, family.select("class"), classes, words), "sets")
    full = tiles.join(placed, ["component", "band", "block"]).join(sets, "class")

    def links(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["side", "class"])
        sets = [np.frombuffer(v, np.uint64) for v in pdf["values"]]
        half = int((pdf["side"] == 0).sum())
        found = tile_links(pdf["class"].to_numpy(), sets, half if half < len(sets) else 0, similarity, k)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    full = full.select("component", "x", "y", "side", "class", "values")
    return full.groupBy("component", "x", "y").applyInPandas(links, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """class, component (the smallest class reachable) of every class that a link (a, b) of two names.

    Each round a class moves to the smallest of its neighbours, if that is smaller, and on to where that one moves.
    Links then join the places their ends have moved to, and those within one place are gone: every link takes its
    larger end away, so few are left after a round or two.  Rounds end with the last link; each is written, so that
    lineage and memory stay bounded.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = staged(links.where("a <> b").select(low, high).distinct(), "links")
    found = None
    while True:
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = staged(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "near")
        far = near.select(F.col("a").alias("label"), F.col("label").alias("far"))
        moves = staged(near.join(far, "label").select("a", F.least("label", "far").alias("label")), "moves")
        if found is None:
            found = moves
        else:
            on = moves.select(F.col("a").alias("label"), F.col("label").alias("far"))
            found = staged(found.join(on, "label", "left").select("a", F.coalesce("far", "label").alias("label")), "labels")
        moved = edges.join(moves.withColumnRenamed("label", "x"), "a")
        moved = moved.join(moves.select(F.col("a").alias("b"), F.col("label").alias("y")), "b").where("x <> y")
        edges = staged(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return found.select(F.col("a").alias("class"), F.col("label").alias("component"))


def near_duplicates(
    docs: DataFrame, similarity: Fraction, words: int = WORDS, k: int = K, short: int = SHORT_LIST, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Rows link if |A & B| >= similarity * |A | B| on their full shingle sets.  ``component_id`` is the smallest doc_id
    reachable, and ``kept`` says that it is the row's own.  A row without words (null, empty or white space) links
    with nothing.  A null doc_id has no name: such a row links with nothing and is kept, with component_id null.
    Repeated rows are equal texts of one document.  Columns other than doc_id and text are not read.
    """
    rows, names = _grouped(docs, similarity, words, k, short, block)
    smallest = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    out = rows.join(names, "class", "left").select("doc_id", "n_shingles", smallest.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _grouped(docs: DataFrame, similarity: Fraction, words: int, k: int, short: int, block: int):
    """The sketches of all rows; and class, found (smallest doc_id reachable), group (smallest class) of named classes."""
    rows = staged(sketches(docs, words, k), "sketches")
    named = rows.where("class IS NOT NULL AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "key", "n_shingles", "sketch")).alias("r")
    classes = staged(named.groupBy("class").agg(first).select("class", "r.*"), "classes")
    candidates = _candidates(classes, similarity, k, short)
    found = components(_family_links(docs, classes, candidates, similarity, words, k, block))

    own = classes.select("class", F.col("doc_id").alias("own"))
    found = found.join(own, "class")
    smallest = found.groupBy("component").agg(F.min("own").alias("linked"))
    found = found.join(staged(smallest, "smallest"), "component").select("class", "linked", "component")
    names = own.join(found, "class", "left").select(
        "class", F.coalesce("linked", "own").alias("found"), F.coalesce("component", "class").alias("group")
    )
    return rows, staged(names, "names")


def decisions(
    docs: DataFrame, similarity: Fraction, words: int = WORDS, k: int = K, short: int = SHORT_LIST, block: int = BLOCK
) -> DataFrame:
    """doc_id, key, repeated: texts under an id of which not every row stays.

    One row of each group stays, that with the smallest doc_id (then key).  It is named here, as ``repeated``, if
    several rows have that id and text; all others of the group are named with ``repeated`` false.  Rows with a null
    doc_id link with nothing, but those of one class are a group.  Rows without words are in no group.
    """
    rows, names = _grouped(docs, similarity, words, k, short, block)
    rows = rows.where("class IS NOT NULL").select("doc_id", "key", "class")
    texts = staged(rows.groupBy("doc_id", "key", "class").agg(F.count("*").alias("times")), "texts")
    placed = texts.where("doc_id IS NOT NULL").join(names, "class").select("doc_id", "key", "times", "group")
    placed = placed.withColumn("named", F.lit(True)).unionByName(
        texts.where("doc_id IS NULL").select("doc_id", "key", "times", F.col("class").alias("group"), F.lit(False).alias("named"))
    )
    placed = staged(placed, "placed")
    first = placed.groupBy("group", "named").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    judged = placed.join(staged(first, "firsts"), ["group", "named"])
    stays = F.struct("doc_id", "key").eqNullSafe(F.col("first"))
    return judged.where(~stays | (F.col("times") > 1)).select("doc_id", "key", stays.alias("repeated"))
