"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from .licenses import SHARE, SHINGLE, TEMPLATES, template_words

OP4 = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP9 = f"""
WITH RECURSIVE
    words AS (
        SELECT doc_id,
               regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id,
               CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
        FROM words
    ),
    grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ),
    reach AS (
        SELECT doc_id AS x, doc_id AS y FROM documents
        UNION
        SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
    )
SELECT sets.doc_id, cast(len(s) AS bigint) AS n_shingles, c.component_id
FROM sets JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON sets.doc_id = c.x
"""


def _licenses() -> str:
    """Every window of 2 T shingles, one every T, against every template."""
    rows = []
    for name, text in sorted(TEMPLATES.items()):
        words = template_words(text)
        size = min(SHINGLE, len(words))
        grams = sorted({" ".join(words[i : i + size]) for i in range(len(words) - size + 1)})
        rows.append(f"('{name}', {size}, {len(words) - size + 1}, [{', '.join(repr(g) for g in grams)}])")
    return f"""
WITH
    templates(license, size, t, grams) AS (VALUES {", ".join(rows)}),
    words AS (
        SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL
    ),
    shingles AS (
        SELECT doc_id, size,
               list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' ')) AS s
        FROM words, (SELECT DISTINCT size FROM templates)
    ),
    windows AS (
        SELECT doc_id, license, grams, s, t, unnest(range(0, greatest(len(s) - t, 1), t)) AS begin_shingle
        FROM shingles JOIN templates USING (size) WHERE len(s) > 0 AND len(list_intersect(s, grams)) > 0
    ),
    shares AS (
        SELECT doc_id, license, begin_shingle,
               len(list_intersect(s[begin_shingle + 1:begin_shingle + 2 * t], grams)) / len(grams) AS share
        FROM windows
    )
SELECT doc_id, license, share, begin_shingle FROM shares WHERE share >= {SHARE}
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY share DESC, begin_shingle) = 1
"""


OP11 = """
WITH
    marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    docs AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    masks AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
               + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
               + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
               + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
               + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
        FROM docs LEFT JOIN marks USING (doc_id)
    ),
    groups AS (SELECT part, good, toxic, mask, count(*) AS n FROM masks GROUP BY ALL),
    letters(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    orders AS (
        SELECT a.c || b.c || d.c || e.c || f.c AS o FROM letters a, letters b, letters d, letters e, letters f
        WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5
    ),
    steps AS (
        SELECT o, s, o[s] AS filter, 1 << (ascii(o[s]) - 65) AS own,
               coalesce(list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(o[i]) - 65))), 0)::INTEGER AS before
        FROM orders, range(1, 6) r(s)
    ),
    report AS (
        SELECT part, o AS filter_order, s::INTEGER AS step, filter,
               coalesce(sum(n) FILTER (mask & (before | own) = 0), 0) AS kept,
               coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0) AS removed,
               coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0) AS redundant,
               coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
               coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0 AND good), 0) AS good_lost,
               coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0 AND toxic), 0) AS toxic_lost
        FROM groups, steps GROUP BY ALL
    )
SELECT part, filter_order, step, filter, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM report
"""


def _clusters(rounds: int = 10, k: int = 8) -> str:
    """All distances in every round."""
    assign = """
    a{i} AS MATERIALIZED (
        SELECT row, vec_id, q, j, list_sum(list_transform(range(1, 65), lambda x: (q[x] - c[x]) * (q[x] - c[x])))::BIGINT AS d
        FROM kept, c{i} QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, j) = 1
    )"""
    move = """
    m{i} AS (
        SELECT j, x, sum(q[x]) AS s, count(*) AS n FROM a{i}, range(1, 65) r(x) GROUP BY j, x
    ),
    f{i} AS (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY x) AS c FROM m{i} GROUP BY j),
    c{next} AS MATERIALIZED (SELECT o.j, coalesce(f{i}.c, o.c) AS c FROM c{i} o LEFT JOIN f{i} USING (j))"""
    steps = [part.format(i=i, next=i + 1) for i in range(rounds) for part in (assign, move)]
    steps.append(assign.format(i=rounds))
    return f"""
WITH
    kept AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id,
               list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND abs(x::DOUBLE) <= 131072)) = 64
    ),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS j, q AS c
        FROM (SELECT sha256('3:' || vec_id) AS h, q FROM kept ORDER BY h NULLS LAST, q LIMIT {k})
    ),{",".join(steps)}
SELECT vec_id, j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (j)
"""


OP13 = f"""
WITH
    split AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (
        SELECT row, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split
    ),
    keys AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            '{_CAPITALS}', '{_CAPITALS.lower()}') AS key
        FROM lines
    ),
    repeated AS (
        SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    ),
    marked AS (SELECT row, keys.doc_id, line, pos, coalesce(keys.doc_id <> first, false) AS gone FROM keys LEFT JOIN repeated USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row
"""


def registered() -> dict[str, str]:
    return {
        "op2_licenses": _licenses(), "op4_exact_dedup": OP4, "op9_jaccard_join": OP9, "op11_filter_audit": OP11,
        "op12_centroids": _clusters(), "op13_line_dedup": OP13,
    }
