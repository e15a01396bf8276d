"""DuckDB SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from collections.abc import Mapping

CHAT = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), r AS (
  SELECT conv_id, turn,
    coalesce(turn::VARCHAR, '~') || chr(2) || coalesce('+' || role, '-') || chr(2) || coalesce('+' || text, '-') AS said,
    '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS piece,
    role, text
  FROM t
), p AS (
  SELECT conv_id, turn, md5(string_agg(said, chr(3)) OVER (
    PARTITION BY conv_id ORDER BY turn NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS prefix,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS FIRST) AS back,
    rank() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS FIRST) AS far
  FROM (SELECT * FROM r ORDER BY conv_id, turn NULLS LAST, said)
), whole AS (
  SELECT prefix, min(conv_id) AS conv_id FROM p WHERE far = 1 GROUP BY prefix
), kept AS (
  SELECT conv_id FROM whole WHERE prefix NOT IN (SELECT prefix FROM p WHERE far > 1)
)
SELECT conv_id,
  CASE WHEN turn IS NULL THEN -1 WHEN turn < 0 THEN floor(turn / 64.0) - 1 ELSE floor(turn / 64.0) END::BIGINT AS part,
  count(*)::INTEGER AS n_turns,
  string_agg(piece, '' ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS text
FROM r WHERE conv_id IN (SELECT conv_id FROM kept)
GROUP BY 1, 2
"""

URLS = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM p
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


def mixing(weights: Mapping[str, float], seed: int) -> str:
    """The mix for the given source weights; others weigh 1."""
    weight = " ".join(f"WHEN name = '{k}' THEN {float(v)!r}" for k, v in weights.items())
    number = lambda what: f"(('0x' || substr(md5({what}), 1, 13))::BIGINT / 4503599627370496.0)"
    return f"""
WITH d AS (
  SELECT *, coalesce(source, '') AS name, coalesce(doc_id::VARCHAR, '') AS key FROM documents
), s AS (
  SELECT name, sum(coalesce(strlen(text), 0) + 1)::DOUBLE AS bytes, CASE {weight} ELSE 1.0 END AS weight
  FROM d GROUP BY name
), r AS (
  SELECT name, weight / sum(weight) OVER () * sum(bytes) OVER () / bytes AS rate FROM s
), q AS (
  SELECT name, rate, greatest(1, ceil(rate / 16.0))::BIGINT AS draws FROM r
), c AS (
  SELECT name, draws, k, sum(exp(k * ln(rate / draws) - rate / draws - lgamma(k + 1)))
    OVER (PARTITION BY name ORDER BY k) AS cdf
  FROM q, range(96) t(k)
), tables AS (
  SELECT name, any_value(draws) AS draws, list(cdf ORDER BY k) AS cdf FROM c GROUP BY name
), n AS (
  SELECT d.*, (
    SELECT sum(len(list_filter(cdf, lambda c: c <= {number(f"'draw|{seed}|' || key || '|' || i")})))
    FROM range(1, draws + 1) v(i)
  )::BIGINT AS copies
  FROM d JOIN tables USING (name)
)
SELECT doc_id, text, lang, source, n_chars, copies, copy::BIGINT AS copy,
  md5('order|{seed}|' || key || '|' || copy) AS mix_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM n WHERE copies > 0)
"""


COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM pieces
), spot AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), grams AS (
  SELECT lang, 1 AS size, ws[i] AS phrase FROM spot
  UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1] FROM spot WHERE i + 1 <= len(ws)
  UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM spot WHERE i + 2 <= len(ws)
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY 1
), c AS (
  SELECT lang, size, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND a >= 10
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(ws[1:k], ' ') AS one, array_to_string(ws[k + 1:], ' ') AS two
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)
), scored AS (
  SELECT cuts.lang, cuts.size, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r,
    ((1000000::HUGEINT * cuts.a * cuts.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.one JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.two
), least AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), inner_of AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM c WHERE size = 3
    UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM c WHERE size = 3
  ) GROUP BY ALL
), kept AS (
  SELECT least.* FROM least LEFT JOIN inner_of USING (lang, phrase)
  WHERE nth = 1 AND (size = 3 OR most IS NULL OR 100 * most < 50 * a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


IMATCH = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, len(coalesce(text, '')) AS n,
    coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS next_text,
    coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id
  FROM documents WINDOW o AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT doc_id, next_id, n, text, substr(text, 1, n - n // 4) || substr(next_text, 1, n // 4) AS edited FROM d
), two AS (
  SELECT doc_id, 0 AS kind, text AS body FROM e UNION ALL SELECT doc_id, 1, edited FROM e
), t AS (
  SELECT doc_id, kind, list_distinct(list_filter(regexp_split_to_array(
    translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-/:-`{-\\x7f]+'), lambda x: x <> '')) AS ts
  FROM two
), lexicon AS (
  SELECT term FROM (SELECT unnest(ts) AS term FROM t WHERE kind = 0) GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= greatest(2, 0.05 * (SELECT count(*) FROM documents))
), leveled AS (
  SELECT doc_id, kind, CASE WHEN len(ts) >= 32 THEN length(bin(len(ts) // 16)) - 1 ELSE 0 END AS level, ts FROM t
), terms AS (
  SELECT doc_id, kind, level, term, ('0x' || substr(md5(term), 1, 8))::BIGINT AS h
  FROM (SELECT doc_id, kind, level, unnest(ts) AS term FROM leveled)
), sampled AS (
  SELECT *, term IN (SELECT term FROM lexicon) AS inside FROM terms WHERE h < (1::BIGINT << (32 - level))
), chosen AS (
  SELECT * FROM (SELECT *, max(inside) OVER (PARTITION BY doc_id, kind) AS any_inside FROM sampled) WHERE inside OR NOT any_inside
), parts AS (
  SELECT doc_id, kind, term, up * 16 + (h >> (28 - level - up)) AS k
  FROM chosen, (VALUES (0), (1), (2), (3)) AS u(up) WHERE (h >> (28 - level - up)) < 16
), signs AS (
  SELECT doc_id, kind, k, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 4) AS sign FROM parts GROUP BY doc_id, kind, k
), frame AS (
  SELECT doc_id, kind, level, k FROM leveled, range(64) AS r(k)
), prints AS (
  SELECT doc_id, kind, level, lpad(level::VARCHAR, 2, '0') || ' ' || string_agg(coalesce(sign, '-'), ' ' ORDER BY k) AS fp,
    list(coalesce(sign, '-') ORDER BY k) AS signs
  FROM frame LEFT JOIN signs USING (doc_id, kind, k) GROUP BY doc_id, kind, level
), pairs AS (
  SELECT e.doc_id, 'edited' AS kind, a.fp AS one, b.fp AS two, a.level AS l1, b.level AS l2, a.signs AS s1, b.signs AS s2
  FROM e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 1
  UNION ALL
  SELECT e.doc_id, 'next', a.fp, b.fp, a.level, b.level, a.signs, b.signs
  FROM e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = e.next_id AND b.kind = 0
), met AS (
  SELECT doc_id, kind, one, two, l1, l2,
    s1[16 * greatest(l2 - l1, 0) + 1 : 16 * (4 + least(l2 - l1, 0))] AS x,
    s2[16 * greatest(l1 - l2, 0) + 1 : 16 * (4 + least(l1 - l2, 0))] AS y
  FROM pairs
), counted AS (
  SELECT doc_id, kind, one, two, l1, l2,
    len(list_filter(list_zip(x, y), lambda z: z[1] = z[2] AND z[1] <> '-')) AS same,
    len(list_filter(list_zip(x, y), lambda z: z[1] <> '-' OR z[2] <> '-')) AS present
  FROM met
), near AS (
  SELECT doc_id, kind, CASE WHEN one = two THEN 1.0 WHEN abs(l2 - l1) > 3 OR present = 0 THEN 0.0
    ELSE same::DOUBLE / present END::DOUBLE AS value
  FROM counted
)
SELECT e.doc_id, e.n::BIGINT AS n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
  x.value AS near_edited, y.value AS near_next
FROM e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 1
JOIN near x ON x.doc_id = e.doc_id AND x.kind = 'edited' JOIN near y ON y.doc_id = e.doc_id AND y.kind = 'next'
"""
