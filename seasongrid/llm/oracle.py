"""SQL for the operators it can express, stated without their methods.

Operators that tokenize, train a model or hash with XXH64 have none.
"""

from __future__ import annotations

from seasongrid.llm.chat import END, ESCAPES, TEXT, TURN

#: Cosine of every pair, then everything that links reach.
LATTICE = """
WITH RECURSIVE parts AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), normed AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM parts
), usable AS (
  SELECT * FROM normed WHERE norm > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
   AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: Places of documents where ten words, or all of a shorter item, are an item's.
DECONTAMINATION = f"""
WITH bench AS (
  SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark
), known AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS stretch
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bench WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS stretch
  FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM docs CROSS JOIN (SELECT DISTINCT size FROM known) WHERE len(w) >= size
  )
), hits AS (
  SELECT doc_id, i, size, item FROM places JOIN known USING (size, stretch)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)
"""

#: Every stretch of 100 bytes, two hex digits a byte, and where it starts first; then runs of covered bytes.
REPEATS = """
WITH docs AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), starts AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS stretch
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM docs WHERE len(h) >= 200)
), again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY stretch ORDER BY doc_id, i) AS nth FROM starts
  ) WHERE nth > 1
), runs AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM again)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run
), kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id
), rest AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS h
  FROM kept JOIN docs USING (doc_id) GROUP BY doc_id
), counts AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(r.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN rest r USING (doc_id) LEFT JOIN counts c ON c.doc_id = d.doc_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    for plain, code in ESCAPES:
        column = f"replace({column}, {_text(plain)}, {_text(code)})"
    return column


def chat(hostile: str) -> str:
    """Turns and learned texts from the table itself; only the length is that of the template."""
    marks = len(TURN) + len(TEXT) + len(END)
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', {_text(hostile)}), (-7, 1, 'assistant', {_text(hostile)})
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({marks} + length({_escaped("role")}) + length({_escaped("text")}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def vector_codes(rounds: int) -> str:
    """Every distance of every round; ``key`` orders entries by distance, then index."""

    def assigned(books: str) -> str:
        square = "list_sum(list_transform(list_zip(points.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return (
            f"SELECT vec_id, label, points.p, points.c, min(coalesce({square}, 0)::HUGEINT * 16 + b.e) AS key"
            f" FROM points JOIN {books} b USING (p) GROUP BY ALL"
        )

    steps = []
    for i in range(rounds):
        steps.append(f"""near{i} AS MATERIALIZED ({assigned(f"books{i}")}),
sums{i} AS (
  SELECT p, e, place, sum(x)::HUGEINT AS s, count(*) AS n
  FROM (SELECT p, key % 16 AS e, unnest(c) AS x, generate_subscripts(c, 1) AS place FROM near{i}) GROUP BY ALL
), means{i} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY place)::BIGINT[] AS c FROM sums{i} GROUP BY ALL
), books{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM books{i} b LEFT JOIN means{i} m USING (p, e)
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(4096 * x)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS c
  FROM (SELECT *, unnest(range(8)) AS p FROM kept)
), firsts AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16
), books0 AS MATERIALIZED (
  SELECT p, e, c FROM points JOIN firsts USING (vec_id)
), {", ".join(steps)}, last AS ({assigned(f"books{rounds}")}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', (key % 16)::INT), '' ORDER BY p) AS code, sum(key // 16)::BIGINT AS error
  FROM last GROUP BY ALL
), flat AS (
  SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS place FROM books{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, place)) FROM flat) AS codebooks_sha256
FROM coded
"""


def phrases(least: int, top: int, share: int) -> str:
    """All pairs and triples of words counted, without activation or shards."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), found AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
  GROUP BY ALL
), frequent AS MATERIALIZED (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM found WHERE f >= {least}
), cuts AS (
  SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS cut, w FROM frequent WHERE k > 1
), scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c
  JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM frequent WHERE k = 3
  UNION ALL
  SELECT lang, array_to_string(w[2:3], ' ') AS phrase, f FROM frequent WHERE k = 3
), candidates AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND c.k = 2 AND 100 * i.f >= {share} * c.a
  )
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM found WHERE k = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM candidates JOIN totals USING (lang)
QUALIFY rank <= {top}
"""
