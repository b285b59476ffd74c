"""DuckDB SQL for those operators whose whole result SQL can express."""

from __future__ import annotations


def similar_sets(share: int) -> str:
    """Common tables up to ``reach``: all documents' shingle sets, similar pairs, and who reaches whom by links."""
    return fr"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    placed AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i, len(w) AS words FROM split),
    runs AS (
        SELECT doc_id, i, words, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS x
        FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    each AS (SELECT DISTINCT doc_id, x FROM runs WHERE i <= words - 4 OR i = 1),
    sized AS (SELECT d.doc_id, count(e.x) AS n FROM documents d LEFT JOIN each e ON e.doc_id = d.doc_id GROUP BY d.doc_id),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
        JOIN sized n ON n.doc_id = a.doc_id JOIN sized m ON m.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, n.n, m.n HAVING 100 * count(*) >= {share} * (n.n + m.n - count(*))),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)"""


OP5 = similar_sets(80) + """
    SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id,
           CAST((SELECT count(*) FROM links l WHERE l.a = s.doc_id) AS BIGINT) AS n_links
    FROM sized s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n"""

OP12 = similar_sets(85) + """
    SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
    FROM sized s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n"""

#: The crc32 goes bit by bit: each byte joins the state, then eight steps (-1) shift it.
OP13 = r"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS times
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
        WHERE length(run) >= 6 GROUP BY ALL),
    hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM runs),
    hashed AS (
        SELECT w, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
                   range(1, length(x), 2), lambda k: [CAST('0x' || substring(x, k, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)) END),
               CAST(4294967295 AS BIGINT)) AS h FROM hexed),
    words AS (
        SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
            SELECT CASE WHEN h % 199 = 0 THEN substring(w, 1, h % length(w)) || substring(w, h % length(w) + 2) ELSE w END AS word, times
            FROM hashed)
        WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
    less AS (
        SELECT word, i, substring(word, 1, i) || substring(word, i + 2) AS rest
        FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
    best AS (
        SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, o.n AS other_n,
               row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
        FROM near JOIN words o ON o.word = near.other),
    forms AS (
        SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
               CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
        FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
    ways AS (
        SELECT word, word AS at FROM forms
        UNION ALL SELECT ways.word, f.form FROM ways JOIN forms f ON f.word = ways.at WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, ways.at AS root, f.n, f.n_near, f.form_n FROM forms f
    JOIN ways ON ways.word = f.word JOIN forms l ON l.word = ways.at AND l.form IS NULL"""
