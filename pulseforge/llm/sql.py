"""The queries that SQL can express, in DuckDB's dialect."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _unit(*parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / 4503599627370496)"


MIX = f"""
WITH sized AS (SELECT doc_id, source, text, len({WORDS})::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
    source_size * 2.0::DOUBLE AS most FROM totals),
levels AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
        - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM weighed),
goals AS (SELECT source, source_size,
    coalesce(least(most, (max(level) FILTER (most / w >= level) OVER ()) * w), most) AS target FROM levels),
rated AS (SELECT s.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
drawn AS (SELECT *, floor(rate) AS whole, rate - floor(rate) AS part, size > source_size * 0.001::DOUBLE AS large,
    {_unit("'7'", "coalesce(source, '')")} AS start, {_unit("'7'", "coalesce(source, '')", "coalesce(doc_id::VARCHAR, '')")} AS own,
    count(*) OVER (PARTITION BY source, doc_id) > 1 AS again, {_unit("'7'", "coalesce(source, '')", "coalesce(doc_id::VARCHAR, '')", "coalesce(md5(text), '')")} AS counted FROM rated),
counted AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, text, large) * part + counted AS turn FROM drawn),
placed AS (SELECT *, row_number() OVER (PARTITION BY source, large ORDER BY size DESC, doc_id NULLS FIRST, md5(text) NULLS FIRST) * part + start AS step FROM counted)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN large THEN floor(step) > floor(step - part) WHEN again THEN floor(turn) > floor(turn - part) ELSE own < part END::INT))::BIGINT AS taken FROM placed
"""

REPEATS = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents),
windows AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w FROM texts, unnest(range(1, len(words) - 33)) AS t(i)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
gone AS (SELECT DISTINCT r, i + d AS p FROM again, range(35) AS t(d)),
words AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM texts),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

SIMILAR = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {WORDS} AS words FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g
    FROM texts, unnest(range(1, greatest(len(words) - 3, 2))) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n, string_agg(g, chr(10) ORDER BY g) AS all_grams FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 5 * shared.n >= 4 * (a.n + b.n - shared.n)
    UNION ALL SELECT a.doc_id, b.doc_id FROM texts a JOIN texts b ON len(a.words) = 0 AND len(b.words) = 0 AND a.doc_id <> b.doc_id),
reach AS (SELECT doc_id AS u, doc_id AS v FROM texts UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
classes AS (SELECT u, min(v) AS class_id FROM reach GROUP BY u),
degrees AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT t.doc_id, class_id, min(t.doc_id) OVER (PARTITION BY coalesce(all_grams, '')) AS copy_id, coalesce(d.n, 0)::BIGINT AS n_links
FROM texts t JOIN classes c ON c.u = t.doc_id LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN degrees d ON d.u = t.doc_id
"""


def _leaves(text: str) -> str:
    """The MD5s of each line's leaves."""
    tokens = "regexp_extract_all(line, '[^ ]{0,63}[^ ] ?| ')"
    marked = f"array_to_string(list_transform({tokens}, lambda t: t || CASE WHEN md5(t) < '3' THEN chr(10) ELSE '' END), '')"
    return f"list_transform(string_split({text}, chr(10)), lambda line: list_transform(string_split(rtrim(coalesce({marked}, ''), chr(10)), chr(10)), lambda leaf: md5(leaf)))"


def _sha(nodes: str) -> str:
    return f"sha256(array_to_string({nodes}, ''))"


def _sections(paragraphs: str) -> str:
    return f"list_transform(range(0, len({paragraphs}), 16), lambda i: {_sha(f'{paragraphs}[i + 1:i + 16]')})"


def _nodes(name: str) -> str:
    return f"list_concat(list_concat(flatten(l_{name}), p_{name}), list_concat(s_{name}, [{_sha(f's_{name}')}]))"


def _likeness(name: str) -> str:
    shared = "SELECT least(a.n, b.n) AS n FROM (SELECT x, count(*) AS n FROM unnest(n_text) AS t(x) GROUP BY x) a JOIN"
    shared += f" (SELECT x, count(*) AS n FROM unnest(n_{name}) AS t(x) GROUP BY x) b USING (x)"
    return f"2.0::DOUBLE * coalesce((SELECT sum(n) FROM ({shared})), 0)::DOUBLE / (len(n_text) + len(n_{name}))"


def _differences(a: str, b: str) -> str:
    return f"array_to_string(list_filter(range(0, greatest(len({a}), len({b}))), lambda i: {a}[i + 1] IS DISTINCT FROM {b}[i + 1]), ',')"


_THREE = ("text", "edited", "other")

MERKLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pairs AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS other FROM texts),
edits AS (SELECT *, left(text, length(text) - length(text) // 2) || left(other, length(text) // 2) AS edited FROM pairs),
cut AS (SELECT *, {', '.join(f'{_leaves(n)} AS l_{n}' for n in _THREE)} FROM edits),
lines AS (SELECT *, {', '.join(f"list_transform(l_{n}, lambda x: {_sha('x')}) AS p_{n}" for n in _THREE)} FROM cut),
tops AS (SELECT *, {', '.join(f"{_sections(f'p_{n}')} AS s_{n}" for n in _THREE)} FROM lines),
trees AS (SELECT *, {', '.join(f'{_nodes(n)} AS n_{n}' for n in _THREE)} FROM tops)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {_sha('s_text')} AS fingerprint, {_sha('s_edited')} AS edited_fingerprint,
    {_likeness('edited')} AS near_edited, {_likeness('other')} AS near_next,
    {_differences('s_text', 's_edited')} AS edit_sections, {_differences('p_text', 'p_edited')} AS edit_paragraphs
FROM trees
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
stats AS (SELECT count(*)::BIGINT AS many, sum(len(terms))::BIGINT AS total FROM docs WHERE len(terms) > 0),
occurrences AS (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs),
counts AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM occurrences GROUP BY ALL),
wanted AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weights AS (SELECT term, floor(1000.0::DOUBLE * ln((2 * many + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term), stats),
scores AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * many) // total))))::BIGINT AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term), stats GROUP BY ALL HAVING score > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM scores QUALIFY rank <= 10
"""


def _integers(factor: int, columns: str = "vec_id") -> str:
    return f"""SELECT {columns}, list_transform(embedding, lambda x: floor({factor}.0::DOUBLE * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


# All sums stay below 2^53 in these tables, so that doubles hold them exactly.
HIGHEST = f"""
WITH rows AS ({_integers(1024)}),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM rows q JOIN rows c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM scores QUALIFY rank <= 10
"""

NEGATIVES = f"""
WITH rows AS ({_integers(256, "vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")} AND label IS NOT NULL),
scores AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
    FROM rows a JOIN rows c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
