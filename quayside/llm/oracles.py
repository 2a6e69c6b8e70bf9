"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Links by shared 5-word windows, classes by closure.
OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS gram
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * k >= 4 * (x.n + y.n - k)
),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS class_id FROM r GROUP BY a)
SELECT doc_id, class_id, (SELECT count(*) FROM l WHERE l.a = doc_id) AS n_links FROM documents JOIN m ON m.a = doc_id
"""

#: Every 200-byte window by its hexadecimal text, cut from pieces of 300 bytes; a byte is covered if a repeated window begins at most 199 bytes before.
OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
z AS (SELECT doc_id, b, substr(h, 200 * b + 1, 600) AS z FROM d, unnest(range(0, len(h) // 200 + 1)) AS t(b)),
w AS (
  SELECT doc_id, 100 * b + o AS i, md5(substr(z, 2 * o + 1, 400)) AS s
  FROM z, unnest(range(0, least(100, greatest(len(z) // 2 - 199, 0)))) AS t(o)
),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS k FROM w) WHERE k > 1),
e AS (SELECT doc_id, i, lag(i) OVER o AS before, lead(i) OVER o AS after FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
b AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e WHERE before IS NULL OR i - before > 200),
f AS (SELECT doc_id, i + 200 AS j, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e WHERE after IS NULL OR after - i > 200),
s AS (SELECT b.doc_id, b.k, b.i, f.j, lag(f.j, 1, 0) OVER (PARTITION BY b.doc_id ORDER BY b.k) AS last FROM b JOIN f USING (doc_id, k)),
p AS (
  SELECT doc_id, count(*) AS n_spans, sum(j - i) AS n_removed, max(j) AS tail,
    string_agg(substr(h, 2 * last + 1, 2 * (i - last)), '' ORDER BY k) AS head
  FROM s JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)
"""


def _covered(words: int) -> str:
    """Words of a text in windows of ``words`` words that occur twice or more."""
    return f"""
SELECT doc_id, count(DISTINCT j) AS k FROM (
  SELECT doc_id, unnest(range(i, i + {words})) AS j FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
    FROM (SELECT doc_id, i, w[i:i + {words - 1}] AS g FROM d, unnest(range(1, greatest(len(w) - {words - 2}, 1))) AS t(i))
  ) WHERE n > 1
) GROUP BY doc_id"""


#: The longest repeat is above 60 words if a window of 61 words repeats.
OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
five AS ({_covered(5)}),
ten AS ({_covered(10)}),
long AS ({_covered(61)}),
line AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
f AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(line.k, 0) AS n_dup_lines, coalesce(five.k, 0) AS n_repeat_words,
    coalesce(ten.k, 0) AS n_ten, coalesce(long.k, 0) AS n_long
  FROM d LEFT JOIN line USING (doc_id) LEFT JOIN five USING (doc_id) LEFT JOIN ten USING (doc_id) LEFT JOIN long USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_ten <= 20 * n_words AND n_long = 0 AS kept
FROM f
"""

#: All pairs of lines that share a word, by length; of equal lines only the first is paired.
OP10 = rf"""
WITH l AS (
  SELECT doc_id, t.i - 1 AS line, list_sort(list_distinct(regexp_extract_all(p[t.i], '[^\x20\x09-\x0D]+'))) AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents), unnest(range(1, len(p) + 1)) AS t(i)
),
f AS (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS k FROM l WHERE len(w) > 0
),
u AS (SELECT row_number() OVER (ORDER BY doc_id, line) AS id, doc_id, line, len(w) AS n, w FROM f WHERE k = 1),
x AS (SELECT id, n, unnest(w) AS word FROM u),
df AS (SELECT word, count(*) AS f FROM x GROUP BY word),
y AS (SELECT id, n, x.word, row_number() OVER (PARTITION BY id ORDER BY f, x.word) AS pos FROM x JOIN df USING (word)),
c AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM y a JOIN y b ON a.word = b.word AND a.id < b.id
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
    AND a.pos <= a.n - ceil(0.8 * a.n - 0.000001) + 1 AND b.pos <= b.n - ceil(0.8 * b.n - 0.000001) + 1
),
m AS (
  SELECT DISTINCT b FROM c JOIN u p ON p.id = a JOIN u q ON q.id = b
  WHERE 9 * len(list_intersect(p.w, q.w)) >= 4 * (p.n + q.n)
),
g AS (
  SELECT doc_id, line FROM f WHERE k > 1
  UNION ALL SELECT doc_id, line FROM u WHERE id IN (SELECT b FROM m)
)
SELECT documents.doc_id, count(g.line) AS n_removed,
  coalesce(string_agg(g.line::VARCHAR, ',' ORDER BY g.line), '') AS removed_lines
FROM documents LEFT JOIN g ON g.doc_id = documents.doc_id GROUP BY documents.doc_id
"""

#: Every window of a document beside every window of an item of the same length.
OP12 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
i AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[s:s + least(len(w), 10) - 1] AS g
  FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(s) WHERE len(w) > 0
),
d AS (
  SELECT doc_id, s, n, w[s:s + n - 1] AS g FROM w, (SELECT DISTINCT n FROM i) AS k, unnest(range(1, len(w) - n + 2)) AS t(s)
),
m AS (SELECT doc_id, s, n, item_id FROM d JOIN i USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS j FROM m) GROUP BY doc_id),
x AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS id FROM m) GROUP BY doc_id
)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)
"""

_PIECE = r"unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'))"

#: All phrases of up to 5 words by language and text; those frequent enough beside all their cuts and all phrases inside them.
OP13 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, {_PIECE} AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS (
  SELECT lang || ' ' || array_to_string(w[i:i + k - 1], ' ') AS g, k, count(*) AS f
  FROM w, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL
),
total AS (SELECT split_part(g, ' ', 1) AS lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY ALL),
c AS (SELECT split_part(g, ' ', 1) AS lang, g, string_split(g, ' ')[2:] AS w, k, f AS a FROM f WHERE k > 1 AND f >= 100),
cuts AS (
  SELECT *, lang || ' ' || array_to_string(w[1:i], ' ') AS x, lang || ' ' || array_to_string(w[i + 1:], ' ') AS y
  FROM c, unnest(range(1, k)) AS t(i)
),
lefts AS (SELECT cuts.*, f AS l FROM cuts JOIN f ON f.g = x),
rights AS (SELECT lefts.*, f AS r FROM lefts JOIN f ON f.g = y),
scores AS (SELECT rights.*, n, (1000::HUGEINT * a * n) // (l::HUGEINT * r) AS score FROM rights JOIN total USING (lang)),
least_ AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score, i) AS cut FROM scores),
inside AS (
  SELECT lang || ' ' || array_to_string(w[i:i + m - 1], ' ') AS g, max(a) AS f
  FROM c, unnest(range(2, k)) AS s(m), unnest(range(1, k - m + 2)) AS t(i) GROUP BY ALL
),
kept AS (
  SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, n, score FROM least_ LEFT JOIN inside USING (g)
  WHERE cut = 1 AND (inside.f IS NULL OR 100 * inside.f < 100 * a)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

ORACLES = {
    "op4_jaccard_join": OP4, "op6_suffix_dedup": OP6, "op7_quality_rules": OP7, "op10_line_dedup": OP10,
    "op12_decontamination": OP12, "op13_collocations": OP13,
}
