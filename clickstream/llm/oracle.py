"""The same results in DuckDB SQL, where SQL can express them."""

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The runs of symbols that repeated windows cover, from the windows' first symbols.
_RUNS = """
    first AS (SELECT g, min(doc_id) AS m FROM w GROUP BY g),
    hit AS (SELECT doc_id, s FROM w JOIN first USING (g) WHERE m < doc_id),
    edge AS (
        SELECT doc_id, s,
               coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {window}, true) AS opens
        FROM hit
    ),
    numbered AS (
        SELECT doc_id, s, sum(opens::int) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM edge
    ),
    run AS (
        SELECT doc_id, min(s) AS a, max(s) + {window} - 1 AS b FROM numbered GROUP BY doc_id, run
    ),
    gap AS (
        SELECT doc_id, a, b,
               coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS since
        FROM run
    )"""

ORACLE_SQL = {
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY content) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept,
               sha256(content) AS text_sha256
        FROM t
        WINDOW w AS (PARTITION BY content ORDER BY n DESC, doc_id)
    """,
    "op3_substring_dedup": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x
            FROM documents
        ),
        w AS (
            SELECT doc_id, s, x[s : s + 12] AS g
            FROM (SELECT doc_id, x, unnest(range(1, len(x) - 11)) AS s FROM d)
        ),
        {_RUNS.format(window=13)},
        kept AS (
            SELECT doc_id, sum(b - a + 1) AS gone, max(b) AS last,
                   flatten(list(x[since : a - 1] ORDER BY a)) AS parts
            FROM gap JOIN d USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, len(x)::bigint AS n_words, coalesce(gone, 0)::bigint AS n_removed,
               sha256(array_to_string(
                   list_concat(coalesce(parts, []), x[coalesce(last, 0) + 1 :]), ' '
               )) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op6_decontamination": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS x FROM documents),
        i AS (SELECT item_id, {_WORDS} AS x FROM benchmark),
        item AS (
            SELECT DISTINCT item_id, x[s : s + l - 1] AS g
            FROM (
                SELECT item_id, x, least(13, len(x)) AS l,
                       unnest(range(1, len(x) - least(13, len(x)) + 2)) AS s
                FROM i WHERE len(x) > 0
            )
        ),
        size AS (SELECT DISTINCT len(g) AS l FROM item),
        hit AS (
            SELECT doc_id, s, l, item_id
            FROM (
                SELECT doc_id, s, l, x[s : s + l - 1] AS g
                FROM (SELECT doc_id, x, l, unnest(range(1, len(x) - l + 2)) AS s FROM d, size)
            ) JOIN item USING (g)
        ),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hit) GROUP BY doc_id
        ),
        found AS (
            SELECT doc_id, count(DISTINCT item_id) AS n,
                   string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS ids
            FROM hit GROUP BY doc_id
        )
        SELECT doc_id, len(x)::bigint AS n_words, coalesce(covered.n, 0)::bigint AS n_hit,
               coalesce(found.n, 0)::bigint AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(covered.n, 0) > 0 AND 20 * covered.n >= len(x) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op10_suffix_dedup": f"""
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n
            FROM documents
        ),
        w AS (
            SELECT doc_id, s, substr(x, 2 * s - 1, 100) AS g
            FROM (SELECT doc_id, x, unnest(range(1, n - 48)) AS s FROM d)
        ),
        {_RUNS.format(window=50)},
        kept AS (
            SELECT doc_id, count(*) AS spans, sum(b - a + 1) AS gone, max(b) AS last,
                   string_agg(substr(x, 2 * since - 1, 2 * (a - since)), '' ORDER BY a) AS parts
            FROM gap JOIN d USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, n::bigint AS n_bytes, coalesce(gone, 0)::bigint AS n_removed,
               coalesce(spans, 0)::bigint AS n_spans,
               sha256(unhex(coalesce(parts, '') || substr(x, 2 * coalesce(last, 0) + 1)))
                   AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op11_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source, {_TERMS} AS x
            FROM documents
        ),
        t AS (SELECT r, lang, source, unnest(x) AS term FROM d),
        kept AS (
            SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
        ),
        l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        c AS (
            SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term)
            GROUP BY lang, source, term
        ),
        g AS (
            SELECT lang, source, coalesce(sum(n), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source)
            GROUP BY lang, source
        ),
        p AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
                   1 + 1000000000::hugeint * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
                   1 + 1000000000::hugeint * (kept.n + 1) // (l.total + l.v) AS q
            FROM g JOIN l USING (lang) JOIN kept USING (lang)
            LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
        ),
        pair AS (
            SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source
            GROUP BY lang, a.source, b.source
        ),
        entry AS (
            SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b USING (lang)
            LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
            WHERE a.source <> b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::bigint AS value, "rank"::integer AS "rank"
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY lang, source, part ORDER BY value DESC, item
            ) AS "rank" FROM entry
        )
        WHERE part = 'pair' OR "rank" <= 200
    """,
}
