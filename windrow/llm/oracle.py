"""The queries of this subpackage in SQL, over views of the given tables, where SQL can express them."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LINES = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"


def count_of(pattern: str) -> str:
    return f"len(regexp_extract_all(coalesce(text, ''), '{pattern}'))"


MEASURES = rf"""
    SELECT doc_id, text, lang, source, n_chars, len(w) AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           {count_of('[#*$%&|<>]')} AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
           {count_of(chr(92) + 'p{Lu}')} AS n_upper, {count_of(chr(92) + 'p{L}')} AS n_letters, w
    FROM (SELECT *, {WORDS} AS w, {LINES} AS l FROM documents)"""

#: Rows with the failed bits of the ledger; documents of one id count as one for the windows.
LEDGER = rf"""
    measures AS ({MEASURES}),
    windows AS (
        SELECT doc_id, i, w[i + 1 : i + 8] AS words
        FROM (SELECT doc_id, w, unnest(range(len(w) - 7)) AS i FROM measures WHERE len(w) > 7)
    ),
    again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, words) AS n FROM windows) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(*) AS n
        FROM (SELECT DISTINCT doc_id, i + k AS place FROM again, (SELECT unnest(range(8)) AS k))
        GROUP BY doc_id
    ),
    counted AS (SELECT m.* EXCLUDE (w), coalesce(n, 0) AS n_repeat_words FROM measures m LEFT JOIN covered USING (doc_id)),
    ledger AS (
        SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
               + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * n_upper > n_letters)::BIGINT
               + 16 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
               + 32 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT AS failed_bits
        FROM counted
    )"""

VECTORS = """
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vector
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0"""

MIXED = rf"""
    rows AS (
        SELECT doc_id, source, lang,
               CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'tabular'
                    WHEN regexp_matches(coalesce(text, ''), '[#$%&*]{{3}}') THEN 'symbolic'
                    WHEN contains(coalesce(text, ''), '!!') THEN 'loud' ELSE 'prose' END AS topic,
               len({WORDS})::BIGINT AS n_tokens
        FROM documents
    ),
    cells AS (
        SELECT coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, topic, sum(n_tokens)::DOUBLE AS tokens
        FROM rows GROUP BY ALL
    ),
    total AS (SELECT sum(tokens) AS total FROM cells)"""
SHARES = {
    "source": "SELECT source AS category, pow(sum(tokens), 0.5::DOUBLE) AS share FROM cells GROUP BY source",
    "lang": "VALUES ('en', 0.5::DOUBLE), ('fr', 0.2), ('de', 0.2), ('es', 0.1)",
    "topic": "VALUES ('prose', 0.9::DOUBLE), ('tabular', 0.06), ('symbolic', 0.02), ('loud', 0.02)",
}


def mixture(sweeps: int) -> str:
    """So many sweeps of proportional fitting, written out."""
    steps = [MIXED]
    for margin, shares in SHARES.items():
        steps.append(f"""
    sums_{margin} AS (
        SELECT category, t, share FROM (SELECT {margin} AS category, sum(tokens) AS t FROM cells GROUP BY 1)
        LEFT JOIN ({shares}) AS s(category, share) USING (category) WHERE t > 0
    ),
    goal_{margin} AS MATERIALIZED (
        SELECT category, CASE WHEN share IS NULL THEN t / (SELECT sum(t) FROM sums_{margin})
            ELSE share / (SELECT sum(share) FROM sums_{margin})
                 * (1 - (SELECT coalesce(sum(t) FILTER (share IS NULL), 0) / sum(t) FROM sums_{margin})) END AS share
        FROM sums_{margin}
    )""")
    steps.append("w0 AS (SELECT *, 1::DOUBLE AS weight FROM cells)")
    number = 0
    for _ in range(sweeps):
        for margin in SHARES:
            steps.append(f"""
    w{number + 1} AS MATERIALIZED (
        SELECT c.* EXCLUDE (weight), weight * coalesce(g.share * (SELECT total FROM total) / nullif(held, 0), 1) AS weight
        FROM w{number} c
        JOIN (SELECT {margin}, sum(tokens * weight) AS held FROM w{number} GROUP BY 1) USING ({margin})
        LEFT JOIN goal_{margin} g ON g.category = {margin}
    )""")
            number += 1
    steps.append(f"chances AS (SELECT *, weight / (SELECT max(weight) FROM w{number}) AS probability FROM w{number})")
    return "WITH " + ",".join(steps)


ORACLE: dict[str, str] = {
    "op4_mixing": f"""
        {mixture(20)}
        SELECT r.*, round(weight, 6) AS weight, round(probability, 6) AS probability,
               ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '(none)')), 1, 8))::BIGINT / 4294967296::DOUBLE
               < probability AS sampled
        FROM rows r JOIN chances c ON coalesce(r.source, '(none)') = c.source
             AND coalesce(r.lang, '(none)') = c.lang AND r.topic = c.topic""",
    "op5_top_k": f"""
        WITH vectors AS ({VECTORS}),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.vector::DOUBLE[], c.vector::DOUBLE[])::BIGINT AS score
            FROM vectors q, vectors c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        WHERE rank <= 10""",
    "op6_substring_dedup": f"""
        WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM docs WHERE len(w) > 19),
        windows AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 20], ' ') AS words FROM starts),
        later AS (
            SELECT doc_id, i
            FROM (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
        ),
        gone AS (SELECT DISTINCT doc_id, i + k AS place FROM later, (SELECT unnest(range(20)) AS k)),
        placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM docs),
        kept AS (
            SELECT p.doc_id, count(g.place) AS n_removed,
                   string_agg(word, ' ' ORDER BY p.place) FILTER (g.place IS NULL) AS words
            FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY 1
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op8_suffix_dedup": """
        WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        starts AS (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM docs WHERE len(h) > 99),
        later AS (
            SELECT doc_id, i
            FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY substr(h, 2 * i + 1, 100)) AS first FROM starts)
            WHERE first < doc_id
        ),
        marked AS (SELECT *, i > lag(i, 1, -100) OVER (PARTITION BY doc_id ORDER BY i) + 50 AS new FROM later),
        numbered AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
        spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY 1, 2),
        parts AS (
            SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z,
                   row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS last FROM spans
        ),
        kept AS (
            SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
                   string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || max(substr(h, 2 * b + 1)) FILTER (last) AS k
            FROM parts JOIN docs USING (doc_id) GROUP BY 1
        )
        SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(k, h))) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op10_quality_rules": f"""
        WITH {LEDGER}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               (failed_bits & 3) <> 0 AS base_failed, (failed_bits & 15) = 0 AS kept,
               n_lines, n_upper, n_letters, failed_bits
        FROM ledger""",
    "op13_filter_audit": rf"""
        WITH letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)),
        orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                   [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
            JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit)
            JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
        ),
        steps AS (
            SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::BIGINT AS before
            FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)
        ),
        marks AS (
            SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ),
        texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
        masks AS (
            SELECT doc_id, part,
                   (len(w) < 200)::BIGINT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::BIGINT
                   + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text))::BIGINT
                   + 8 * regexp_matches(text, '[#$%&*|]')::BIGINT
                   + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::BIGINT AS mask
            FROM texts
        ),
        counters AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
        )
        SELECT part, filter_order, step,
               coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost,
               coalesce(sum(n * 120 // bit_count(mask)) FILTER (mask & bit <> 0), 0)::BIGINT AS shapley
        FROM counters, steps GROUP BY part, filter_order, step""",
}
