"""Language codes, toxicity grades and the URL filter."""

import zlib

import numpy as np
import pytest
from llm_rows import frame

from tenderloom.llm import language_codes, ordinal_toxicity, queries, url_markov

# --- language --------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op3_output_codes(spark, sf).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in lang}
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_codewords_are_distinct_and_far_apart():
    for n in (1, 2, 3, 4, 6, 7, 20):
        code = language_codes.codewords(n)
        rows = {tuple(r) for r in code.tolist()}
        assert len(rows) == n or n == 1
        if n > 2:
            least = min((a != b).sum() for k, a in enumerate(code) for b in code[:k])
            assert least >= code.shape[1] / 4


def test_odd_texts_and_languages(spark, odd, empty):
    rows = language_codes.identify(odd).collect()
    assert len(rows) == 12
    und = {(r["doc_id"]) for r in rows if r["lang_pred"] == "und"}
    assert und == {3, 4, 5, 6}
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language_codes.identify(empty).collect() == []
    nothing = frame(spark, [(1, "some text", None)])
    assert [tuple(r) for r in language_codes.identify(nothing).collect()] == [(1, False, "und", 0.0, False)]
    one = frame(spark, [(k, "some text", "en") for k in range(8)])
    assert {r["lang_pred"] for r in language_codes.identify(one).collect()} == {"en"}


def test_learning_never_sees_held_out_or_unlabelled_rows(spark):
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 4 == 2]
    rows = [(k, "abc def", "xx") for k in held] + [(k, "ghi jkl", "yy") for k in range(200) if k not in held]
    assert language_codes.learn(frame(spark, rows)).languages == ["yy"]


# --- toxicity --------------------------------------------------------------------------------------


def test_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.01"
    # Some labels are noise: junk of quality 0 that is marked as toxic without a toxic word.
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 OR toxic = 0")
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = {r["doc_id"]: r for r in queries.op4_ordinal_toxicity(spark, sf).collect()}
    flagged = {i for i in known if rows[i]["toxic"]}
    toxic = {i for i, t in known.items() if t}
    assert len(flagged & toxic) >= 0.95 * len(toxic)
    assert len(flagged - toxic) <= 0.01 * len(known)
    grades = {r["grade"] for r in rows.values()}
    assert grades <= {0, 1, 2, 3} and len(grades) >= 3


def test_thresholds_ascend_and_weights_are_shared():
    random = np.random.default_rng(0)
    words, grades = [], []
    for _ in range(600):
        n = int(random.integers(0, 4))
        words.append({f"w{random.integers(30)}" for _ in range(8)} | {f"bad{k}" for k in range(n)})
        grades.append(n)
    model = ordinal_toxicity.fit(words, grades)
    assert len(model.thresholds) == 3 and sorted(model.thresholds) == model.thresholds
    assert min(model.weights[f"bad{k}"] for k in range(3)) > max(model.weights.get(f"w{k}", 0) for k in range(30))


def test_gradient_of_the_likelihood():
    """The fit reaches a point that small changes of any weight don't improve."""
    words = [{"a"}, {"a", "b"}, {"b"}, set(), {"c"}] * 30
    grades = [0, 2, 1, 0, 1] * 30
    model = ordinal_toxicity.fit(words, grades, steps=3000, penalty=1e-3)

    def loss(weights, cuts):
        total = 0.0
        bounds = np.array([-np.inf, *cuts, np.inf])
        for row, g in zip(words, grades):
            s = sum(weights.get(w, 0.0) for w in row)
            p = 1 / (1 + np.exp(-(bounds[g + 1] - s))) - 1 / (1 + np.exp(-(bounds[g] - s)))
            total -= np.log(p)
        return total / len(words) + 1e-3 / 2 * sum(v * v for v in weights.values())

    best = loss(model.weights, model.thresholds)
    for w in model.weights:
        for change in (-0.05, 0.05):
            assert loss({**model.weights, w: model.weights[w] + change}, model.thresholds) > best - 1e-5


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 0, "x"), (2, 1, "x"), (2, 0, "x"), (None, 1, "x"), (7, None, "x"), (99, 1, "x")],
        "doc_id long, toxic int, text string",
    )
    rows = ordinal_toxicity.assess(odd, labels).collect()
    assert len(rows) == 12 and not any(r["toxic"] for r in rows)
    assert ordinal_toxicity.assess(empty, labels).collect() == []
    assert len(ordinal_toxicity.assess(odd, labels.limit(0)).collect()) == 12


# --- urls ------------------------------------------------------------------------------------------


def brute_judge(urls):
    """The models by dictionaries: {url: (host, path, rule, verdict)}."""
    import hashlib
    import math
    from collections import Counter, defaultdict

    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        k = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k])
        end = next((j for j, c in enumerate(rest[k:]) if c in "?#"), len(rest) - k)
        return host, rest[k : k + end]

    def rule_of(host, path):
        fits = [
            r for r in url_markov.RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        return max(fits, key=lambda r: len(r.name), default=None)

    rows = [(u, *parts(u)) for u in urls]
    rows = [(u, h, p, rule_of(h, p)) for u, h, p in rows]

    def folded(u):
        return u is not None and hashlib.md5(u.encode()).hexdigest()[0] in "012"

    def grams(h, p):
        s = "^" * 5 + h + p + "$"
        return [s[i : i + 6] for i in range(len(s) - 5)]

    counts = {"allow": [Counter() for _ in range(6)], "block": [Counter() for _ in range(6)]}
    seen = set()
    for u, h, p, r in rows:
        for g in grams(h, p):
            seen.add(g[-1])
            if r and not folded(u):
                for k in range(6):
                    counts[r.verdict][k][g[5 - k :]] += 1
    total = {v: [Counter() for _ in range(6)] for v in counts}
    kinds = {v: [defaultdict(int) for _ in range(6)] for v in counts}
    for v in counts:
        for k in range(6):
            for g, n in counts[v][k].items():
                total[v][k][g[:-1]] += n
                kinds[v][k][g[:-1]] += 1

    def chance(v, g):
        q = 1 / len(seen)
        for k in range(6):
            part = g[5 - k :]
            n, t = total[v][k][part[:-1]], kinds[v][k][part[:-1]]
            if n:
                q = (counts[v][k][part] + t * q) / (n + t)
        return q

    def score(h, p):
        ratios = [round((math.log(chance("allow", g)) - math.log(chance("block", g))) * 1e9) for g in grams(h, p)]
        return sum(ratios) / len(ratios) / 1e9

    scores = {(h, p): score(h, p) for _, h, p, _ in rows}
    steps = [(math.floor(scores[h, p] * 100), r.verdict) for u, h, p, r in rows if r and folded(u)]
    a, b = (sum(v == x for _, v in steps) for x in ("allow", "block"))
    cut = 0.0
    if a and b:
        right = {
            s: sum(x >= s and v == "allow" for x, v in steps) / a + sum(x < s and v == "block" for x, v in steps) / b
            for s, _ in steps
        }
        cut = max(right, key=lambda s: (round(right[s], 9), -abs(s), -s)) / 100
    verdict = {(h, p): "allow" if s >= cut else "block" for (h, p), s in scores.items()}
    return [(h, p, r and r.name, r.verdict if r else verdict[h, p]) for _, h, p, r in rows]


def test_urls_of_the_table(spark, sf):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    got = {r["page_id"]: tuple(r)[1:] for r in queries.op7_url_markov(spark, sf).collect()}
    assert got == dict(zip(pages, brute_judge(pages.values())))


ODD_URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/x?y#z", "http://net/", "http://xnet/a", "http://net",
    "http://example.net/en", "ftp://sub.org/fr/a://b", "http://h?/x", "http://ÄB.org/FR/é", "x://example.com/de/",
    "http://a.org/" + "long/" * 3000, "http://a.org/de/1", "http://a.org/de/1", "http://b.com/fr/2#t", "://net/a",
]


def test_odd_urls(spark):
    df = spark.createDataFrame(list(enumerate(ODD_URLS)), "page_id int, url string").selectExpr("*", "'c' AS host", "1 AS gram")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_markov.judge(df).collect()}
    assert got == dict(enumerate(brute_judge(ODD_URLS)))


@pytest.mark.parametrize("urls", [[], ["http://a.com/x"], [None, None]])
def test_no_ruled_url(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    assert [r["verdict"] for r in url_markov.judge(df).collect()] == ["allow"] * len(urls)


# --- samples ---------------------------------------------------------------------------------------


def test_samples_are_bounded_whatever_the_ids(spark, monkeypatch):
    rows = [(None, f"abc def {k}", "xx") for k in range(300)] + [(3, f"ghi jkl {k}", "yy") for k in range(300)]
    rows += [(3, "ghi jkl 0", "yy")] * 300 + [(k, "mno pqr", "zz") for k in range(8)]
    df = frame(spark, rows)
    _, _, labels = language_codes.sampled(df, 50)
    assert (labels.count("xx"), labels.count("yy")) == (50, 50) and 0 < labels.count("zz") <= 8
    assert language_codes.sampled(frame(spark, rows[300:301] * 40), 50)[2] == ["yy"]

    seen = []
    monkeypatch.setattr(ordinal_toxicity, "marks_of", lambda words, toxic: seen.append(len(words)) or {})
    monkeypatch.setattr(ordinal_toxicity, "fit", lambda *a: None)
    ordinal_toxicity.learn(df, spark.createDataFrame([(3, 1), (4, 0)], "doc_id long, toxic int"), sample=50)
    ordinal_toxicity.learn(frame(spark, rows[300:301] * 40), spark.createDataFrame([(3, 1)], "doc_id long, toxic int"))
    assert seen == [50, 1]
