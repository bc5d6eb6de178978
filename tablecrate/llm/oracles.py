"""The same results in DuckDB SQL, for the operators that SQL can express."""

OP8_RULES = r"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT doc_id, text,
           list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM base
), numbered AS (
    SELECT doc_id, text, words, lines, row_number() OVER () AS id FROM split
), word AS (
    SELECT id, unnest(words) AS w, unnest(range(len(words))) AS i FROM numbered
), gram AS (
    SELECT id, i, [w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o] AS g,
           lead(w, 4) OVER o AS fifth
    FROM word WINDOW o AS (PARTITION BY id ORDER BY i)
), hit AS (
    SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS n FROM gram WHERE fifth IS NOT NULL)
    WHERE n > 1
), covered AS (
    SELECT id, count(DISTINCT i + k) AS n FROM hit, (SELECT unnest(range(5)) AS k) GROUP BY id
), counted AS (
    SELECT doc_id, text, words, len(lines) AS n_lines,
           len(words)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM numbered LEFT JOIN covered USING (id)
), failed AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 100 * n_symbols > 25 * n_words
            OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 100 * length(regexp_replace(text, '\P{Lu}', '', 'g')) > 60 * length(regexp_replace(text, '\P{L}', '', 'g'))
            OR 100 * len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) < 50 * n_words
            OR 100 * len(list_distinct(words)) < 5 * n_words) AS kept
FROM failed
"""

OP9_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source,
           len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
           (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
               / 4503599627370496.0 AS u
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size,
           ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
    FROM sources
), ranked AS (
    SELECT *, row_number() OVER s AS k, sum(3 * source_size) OVER s AS given, sum(weight) OVER s AS capped_weight
    FROM weighed WINDOW s AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), units AS (
    SELECT k, (((SELECT sum(source_size) FROM sources) - given)::DOUBLE
               / nullif((SELECT sum(weight) FROM weighed) - capped_weight, 0)::DOUBLE) AS unit
    FROM ranked
    UNION ALL
    SELECT 0, (SELECT sum(source_size) FROM sources)::DOUBLE / (SELECT sum(weight) FROM weighed)::DOUBLE
), chosen AS (
    SELECT unit FROM units LEFT JOIN ranked r ON r.k = units.k + 1
    WHERE unit IS NOT NULL AND (r.k IS NULL OR r.weight * unit <= 3 * r.source_size)
    ORDER BY units.k LIMIT 1
), goals AS (
    SELECT source, source_size, least(weight * unit, (3 * source_size)::DOUBLE) AS target,
           CASE WHEN source_size > 0
                THEN floor(least(weight * unit, (3 * source_size)::DOUBLE) / source_size) ELSE 0 END AS whole
    FROM weighed, chosen
), rests AS (
    SELECT *, target - whole * source_size AS rest FROM goals
), placed AS (
    SELECT doc_id, d.source, size, u, source_size, target, whole, rest,
           sum(size) OVER (PARTITION BY d.source ORDER BY (u / (1 - u)) / ((rest / source_size) / (1 - rest / source_size)), doc_id NULLS FIRST, size
                           RANGE UNBOUNDED PRECEDING) AS reached,
           -- rows of equal key, source and size go together
           sum(size) OVER (PARTITION BY d.source, doc_id, size) AS own
    FROM sized d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND size > 0 AND reached - rest <= rest - (reached - own) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

OP11_SUBSTRINGS = r"""
WITH split AS (
    SELECT row_number() OVER () AS id, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT id, doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS w
    FROM (SELECT *, unnest(range(1, len(words) - 48)) AS i FROM split)
), firsts AS (
    SELECT w, min(doc_id) AS least FROM windows GROUP BY w
), gone AS (
    SELECT DISTINCT id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (w) WHERE doc_id > least
), kept AS (
    SELECT id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text
    FROM (SELECT id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM split) ANTI JOIN gone USING (id, i)
    GROUP BY id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (id)
"""

OP12_NEGATIVES = r"""
WITH rows AS (
    SELECT row_number() OVER () AS id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND b.vec_id IS DISTINCT FROM a.vec_id
), positives AS (
    SELECT id, anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id NULLS LAST) AS place
    FROM scored WHERE same QUALIFY place <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.id, p.place ORDER BY score DESC, n.vec_id NULLS LAST)::INTEGER AS rank,
       n.vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN (SELECT id, vec_id, score FROM scored WHERE NOT same) n USING (id)
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def op13_codes() -> str:
    """Four rounds of the same two steps, written out."""
    rounds = "".join(
        f"""
), near{turn} AS (
    SELECT id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
    FROM (SELECT p.id, p.part, b.entry,
                 list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM parts p JOIN book{turn} b USING (part))
    GROUP BY id, part"""
        + (
            f"""
), book{turn + 1} AS (
    SELECT part, entry, coalesce(moved, v) AS v
    FROM book{turn} LEFT JOIN (
        SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY i) AS moved
        FROM (SELECT part, entry, i, sum(x)::DOUBLE AS total, count(*) AS n
              FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{turn} JOIN parts USING (id, part))
              GROUP BY part, entry, i)
        GROUP BY part, entry) USING (part, entry)"""
            if turn < 4
            else ""
        )
        for turn in range(5)
    )
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT id, vec_id, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS v
    FROM (SELECT *, unnest(range(4)) AS part FROM kept)
), book0 AS (
    SELECT part, entry, parts.v
    FROM parts JOIN (SELECT id, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept) USING (id) WHERE entry < 256{rounds}
), coded AS (
    SELECT id, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near4 GROUP BY id
), books AS (
    SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM book4)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), books
"""
