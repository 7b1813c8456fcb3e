"""SQL against which the queries of this package are checked, where SQL can express them."""

from __future__ import annotations

from offerlens.llm import decontaminate, fingerprint, passages, phrases

_WORDS = "list_filter(regexp_split_to_array(lower({text}), '[^\\pL\\pN]+'), lambda w: w <> '')"


def decontamination() -> str:
    """Every diagonal with enough equal words for an overlap, and on it every stretch that is long and similar enough."""
    least, similarity = decontaminate.LEAST_WORDS, decontaminate.SIMILARITY
    return f"""
WITH texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
tw AS (SELECT md5(text) AS t, {_WORDS.format(text='text')} AS w FROM texts),
items AS (SELECT DISTINCT item_id, {_WORDS.format(text='text')} AS iw FROM benchmark),
known AS (SELECT DISTINCT iw, least({least}, len(iw)) AS n FROM items WHERE len(iw) > 0),
tp AS (SELECT t, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM tw),
ip AS (SELECT iw, n, generate_subscripts(iw, 1) AS q, unnest(iw) AS word FROM known),
diagonals AS (SELECT t, iw, n, p - q AS g FROM tp JOIN ip USING (word) GROUP BY ALL HAVING count(*) >= n * {similarity}),
cells AS (SELECT t, iw, n, g, w, greatest(0, -g) AS lo, unnest(range(greatest(0, -g), least(len(iw), len(w) - g))) AS q
  FROM diagonals JOIN tw USING (t)),
same AS (SELECT t, iw, n, g, lo, q - lo AS i, (iw[q + 1] = w[q + g + 1])::INT AS hit FROM cells),
sums AS (
  SELECT *, sum(CASE WHEN hit = 1 THEN 1 ELSE -4 END) OVER o AS gain, sum(hit) OVER o AS hits
  FROM same WINDOW o AS (PARTITION BY t, iw, g ORDER BY i)),
bounds AS (SELECT t, iw, n, g, lo, i + 1 AS i, gain, hits FROM sums
  UNION ALL SELECT DISTINCT t, iw, n, g, lo, 0, 0, 0 FROM same),
stretches AS (
  SELECT a.t, a.iw, a.g, a.lo, a.i AS b, e.i AS e, e.gain - a.gain AS gain, e.hits - a.hits AS matched
  FROM bounds a JOIN bounds e ON a.t = e.t AND a.iw = e.iw AND a.g = e.g AND e.i - a.i >= a.n AND e.gain >= a.gain),
best AS (
  SELECT t, iw, lo + g + b AS start, e - b AS words, matched FROM stretches
  QUALIFY row_number() OVER (PARTITION BY t, iw, g ORDER BY gain DESC, e, b DESC) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t, iw ORDER BY matched DESC, words, start) AS rn FROM best)
SELECT doc_id, item_id, start::INT AS start, words::INT AS words, matched::INT AS matched
FROM documents JOIN ranked ON md5(text) = t JOIN items USING (iw) WHERE rn = 1"""


def passages_sql() -> str:
    n = passages.LEAST_WORDS
    return f"""
WITH texts AS (SELECT md5(text) AS t, {_WORDS.format(text='any_value(text)')} AS w FROM documents WHERE text IS NOT NULL GROUP BY md5(text)),
ids AS (SELECT DISTINCT doc_id, md5(text) AS t FROM documents WHERE text IS NOT NULL),
owners AS (SELECT t, min(doc_id) AS first, count(*) AS copies FROM ids GROUP BY t),
places AS (SELECT t, w, unnest(range(0, len(w) - {n - 1})) AS s FROM texts WHERE len(w) >= {n}),
windows AS (SELECT t, s, md5(array_to_string(w[s + 1:s + {n}], ' ')) AS c FROM places),
marked AS (
  SELECT t, s, row_number() OVER (PARTITION BY c ORDER BY t, s) > 1 AS later FROM windows
  QUALIFY count(*) OVER (PARTITION BY c) > 1),
new AS (SELECT *, coalesce(s > lag(s) OVER o + {n}, true)::INT AS new FROM marked WINDOW o AS (PARTITION BY t, later ORDER BY s)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY t, later ORDER BY s) AS span FROM new),
spans AS (SELECT t, later, min(s) AS start, max(s) - min(s) + {n} AS words FROM numbered GROUP BY t, later, span)
SELECT first AS doc_id, start::INT AS start, words::INT AS words, later FROM spans JOIN owners USING (t) WHERE later OR copies = 1
UNION ALL
SELECT doc_id, 0, len(w)::INT, doc_id IS DISTINCT FROM first
FROM ids JOIN owners USING (t) JOIN texts USING (t) WHERE copies > 1 AND len(w) >= {n}"""


def fingerprints() -> str:
    k, width, digits = fingerprint.K, fingerprint.WIDTH, fingerprint.DIGITS

    def near(a: str, b: str) -> str:
        union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{k}]"
        return f"""CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE
          ELSE len(list_intersect(list_intersect({a}, {b}), {union}))::DOUBLE / greatest(len({union}), 1) END"""

    def sketches(of: str) -> str:
        return f"""SELECT doc_id, list_sort(list(DISTINCT h))[1:{k}] AS k FROM (
          SELECT doc_id, left(md5(array_to_string(w[i + 1:i + {width}], ' ')), {digits}) AS h FROM (
            SELECT doc_id, w, unnest(range(0, greatest(len(w) - {width}, 0) + 1)) AS i FROM (
              SELECT doc_id, {_WORDS.format(text=of)} AS w FROM pairs) WHERE len(w) > 0)) GROUP BY doc_id"""

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
led AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS next,
  coalesce(lead(doc_id) OVER (ORDER BY doc_id), first(doc_id) OVER (ORDER BY doc_id)) AS next_id FROM d),
pairs AS (SELECT *, left(text, length(text) - length(text) // 4) || left(next, length(text) // 4) AS edited FROM led),
own AS ({sketches('text')}),
changed AS ({sketches('edited')}),
sk AS (SELECT p.doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
  coalesce(o.k, []::VARCHAR[]) AS a, coalesce(c.k, []::VARCHAR[]) AS e, coalesce(x.k, []::VARCHAR[]) AS b
  FROM pairs p LEFT JOIN own o USING (doc_id) LEFT JOIN changed c USING (doc_id) LEFT JOIN own x ON x.doc_id = p.next_id)
SELECT doc_id, n_chars, edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(e, '') AS edited_fingerprint,
  {near('a', 'e')} AS near_edited, {near('a', 'b')} AS near_next FROM sk"""


def collocations() -> str:
    order, least, percent, top = phrases.ORDER, phrases.LEAST_COUNT, phrases.COVER_PERCENT, phrases.TOP
    return f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
sizes AS (SELECT unnest(range(1, {order + 1})) AS k),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, sizes WHERE len(w) >= k),
grams AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, g, f AS a FROM grams WHERE k >= 2 AND f >= {least}),
inner_sizes AS (SELECT c.lang, c.g, c.k, c.a, s.k AS m FROM candidates c JOIN sizes s ON s.k BETWEEN 2 AND c.k - 1),
inner_places AS (SELECT *, unnest(range(1, k - m + 2)) AS i FROM inner_sizes),
through AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS through FROM inner_places GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN through t ON c.lang = t.lang AND c.g = t.g
  WHERE t.through IS NULL OR 100 * t.through < {percent} * c.a),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
parts AS (SELECT c.lang, c.g, c.a, c.cut, x.f AS l, y.f AS r, n,
  (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:c.cut] JOIN grams y ON y.lang = c.lang AND y.g = c.g[c.cut + 1:c.k]
  JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, c.cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM parts QUALIFY rank <= {top}"""
