"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tenderloom.llm import chat_format, url_markov
from tenderloom.llm.template import compile_template

VECTOR_ROWS = """
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(256 * CAST(x AS DOUBLE))]) = 0
"""


def _url_sql(order: int = url_markov.ORDER) -> str:
    """Rules, models by window functions, calibration and verdicts."""
    longest = sorted(url_markov.RULES, key=lambda r: -len(r.name))
    fits = [
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in longest
    ]
    rule = " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, longest))
    ruling = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, longest))
    text = f"'{url_markov.PAD * order}' || host || path || '{url_markov.STOP}'"

    def grams(columns: str, source: str) -> str:
        return f"""
            SELECT {columns}, substr({text}, i, {order + 1}) AS gram
            FROM (SELECT *, unnest(range(1, length(host || path) + 2)) AS i FROM {source})"""

    levels = []
    for k in range(order + 1):
        counts = f"SELECT right(gram, {k + 1}) AS gram, sum(a) AS a, sum(b) AS b FROM seen GROUP BY ALL"
        below = (
            "1.0 / count(*) OVER () AS qa, 1.0 / count(*) OVER () AS qb FROM c"
            if k == 0
            else f"p.qa, p.qb FROM c JOIN p{k - 1} p ON p.gram = substr(c.gram, 2, {k})"
        )
        levels.append(f"""p{k} AS (
            SELECT gram, CASE WHEN na > 0 THEN (a + ta * qa) / (na + ta) ELSE qa END AS qa,
                   CASE WHEN nb > 0 THEN (b + tb * qb) / (nb + tb) ELSE qb END AS qb
            FROM (
                WITH c AS ({counts})
                SELECT c.gram, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b,
                       CAST(sum(a) OVER w AS DOUBLE) AS na, CAST(sum(b) OVER w AS DOUBLE) AS nb,
                       CAST(count(*) FILTER (a > 0) OVER w AS DOUBLE) AS ta,
                       CAST(count(*) FILTER (b > 0) OVER w AS DOUBLE) AS tb, {below}
                WINDOW w AS (PARTITION BY substr(c.gram, 1, {k}))
            ))""")
    widest, unit, bins = url_markov.WIDEST, url_markov.SCORE_UNIT, url_markov.BINS
    return f"""
        WITH parts AS (
            SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
        ),
        split AS (
            SELECT page_id, coalesce(substr(md5(url), 1, 1) IN ('0', '1', '2'), false) AS calibrates,
                   coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_markov.UPPER}', '{url_markov.LOWER}'), '') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
            FROM parts
        ),
        ruled AS (SELECT *, CASE {rule} END AS rule, CASE {ruling} END AS ruling FROM split),
        seen AS (
            SELECT gram, count(*) FILTER (NOT calibrates AND ruling = 'allow') AS a,
                   count(*) FILTER (NOT calibrates AND ruling = 'block') AS b
            FROM ({grams("calibrates, ruling", "ruled")}) GROUP BY gram
        ),
        {", ".join(levels)},
        texts AS (SELECT DISTINCT host, path FROM ruled),
        scores AS (
            SELECT host, path, CAST(sum(CAST(round((ln(qa) - ln(qb)) * {unit}) AS BIGINT)) AS DOUBLE) / count(*) / {unit} AS score
            FROM ({grams("host, path", "texts")}) JOIN p{order} USING (gram) GROUP BY ALL
        ),
        judged AS (SELECT * FROM ruled JOIN scores USING (host, path)),
        steps AS (
            SELECT greatest(-{widest}, least({widest}, CAST(floor(score * {bins}) AS INTEGER))) AS step,
                   count(*) FILTER (ruling = 'allow') AS a, count(*) FILTER (ruling = 'block') AS b
            FROM judged WHERE calibrates AND ruling IS NOT NULL GROUP BY ALL
        ),
        shares AS (
            SELECT step, 1 - coalesce(sum(a) OVER below, 0) / nullif(sum(a) OVER (), 0)
                   + coalesce(sum(b) OVER below, 0) / nullif(sum(b) OVER (), 0) AS share
            FROM steps WINDOW below AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ),
        cut AS (
            SELECT coalesce((
                SELECT step FROM shares WHERE share IS NOT NULL ORDER BY round(share, 9) DESC, abs(step), step LIMIT 1
            ) / {bins}, 0.0) AS cut
        )
        SELECT page_id, host, path, rule,
               coalesce(ruling, CASE WHEN score >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
        FROM judged
    """


def _chat_sql() -> str:
    """Digests of the turns as they are, and the length of their text once marked and escaped."""
    controls = compile_template(chat_format.CHAT).marks.controls
    begun = "|".join(sorted({c[:k] for c in controls for k in range(1, len(c))}))

    def escaped(x: str) -> str:
        marks = [(c, len(c)) for c in ("\\", *controls)]
        found = " + ".join(f"(length({x}) - length(replace({x}, '{c}', ''))) // {n}" for c, n in marks)
        return f"length({x}) + {found} + CASE WHEN regexp_matches({x}, '({begun})$') THEN 1 ELSE 0 END"

    per_turn = len(chat_format.TURN + chat_format.SAYS + chat_format.CLOSE + "\n")
    return f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = '{chat_format.GENERATED}'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(
                   string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{chat_format.GENERATED}'), ''
               )) AS loss_sha256,
               CAST({len(chat_format.OPEN + chat_format.END)} + sum({per_turn} + {escaped("role")} + {escaped("text")}) AS BIGINT)
                   AS formatted_chars
        FROM rows GROUP BY conv_id
    """


FILL_MIDDLE = """
    WITH rows AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    drawn AS (
        SELECT doc_id, text, length(text) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (length(text) + 1) AS x,
               CAST('0x' || substr(h, 9, 8) AS BIGINT) % (length(text) + 1) AS y,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                    WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM rows
    ),
    cut AS (
        SELECT *, substr(text, 1, least(x, y)) AS prefix, substr(text, least(x, y) + 1, greatest(x, y) - least(x, y)) AS middle,
               substr(text, greatest(x, y) + 1) AS suffix
        FROM drawn
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(x, y) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN greatest(x, y) - least(x, y) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM cut
"""

TERMS = r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
)"""
SEARCH = f"""
    WITH held AS (
        SELECT doc_id, {TERMS} AS terms
        FROM documents
    ),
    docs AS (SELECT row_number() OVER () AS r, doc_id, terms, len(terms) AS n FROM held WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
    wanted AS (
        SELECT item_id, term, count(*) AS times
        FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark)
        GROUP BY ALL
    ),
    counts AS (
        SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs)
        WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
    ),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM counts, totals GROUP BY term, n_docs
    ),
    scores AS (
        SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM counts JOIN weights USING (term) JOIN wanted USING (term), totals GROUP BY ALL
    ),
    ranked AS (
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op11_template_compiler": _chat_sql(),
    "op12_displacement_scatter": FILL_MIDDLE,
    "op13_reversed_search": SEARCH,
    "op7_url_markov": _url_sql(),
    "op10_exact_top_k": f"""
        WITH vectors AS ({VECTOR_ROWS}),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scores
        )
        SELECT * FROM ranked WHERE rank <= 5
    """,
}
