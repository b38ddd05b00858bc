"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
capped AS (
  SELECT *, 2 * source_size AS cap, CAST([5, 2, 1][((place - 1) % 3) + 1] AS BIGINT) AS w FROM sources),
-- The level at which a set of sources stops: every prefix in the order of cap / weight is tried.
prefix AS (
  SELECT CAST((SELECT sum(source_size) FROM sources) * 150
              - 100 * coalesce((SELECT sum(b.cap) FROM capped b WHERE (b.cap / b.w, b.place) < (a.cap / a.w, a.place)), 0)
              AS DOUBLE)
         / (100 * (SELECT sum(b.w) FROM capped b WHERE (b.cap / b.w, b.place) >= (a.cap / a.w, a.place))) AS level,
         a.cap / a.w AS ratio, a.place, a.cap, a.w
  FROM capped a),
final AS (SELECT level FROM prefix WHERE level * w <= cap ORDER BY ratio, place LIMIT 1),
goal AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM final) * w, CAST(cap AS DOUBLE))) AS target FROM capped),
rated AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
              AS DOUBLE) / 4503599627370496.0 AS u
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target,
       CAST(floor(rate) + CAST(u < rate - floor(rate) AS INT) AS BIGINT) AS copies,
       size * CAST(floor(rate) + CAST(u < rate - floor(rate) AS INT) AS BIGINT) AS taken
FROM rated
"""


def _spans(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    """DuckDB SQL of one rule's spans: the lengths of the matches and of the text between them, summed up."""
    return f"""
  SELECT k, {place} AS place, '{kind}' AS kind, pos AS start, pos + len(found[i]) AS stop
  FROM (
    SELECT k, found, judged, i,
           CAST(coalesce(list_sum([len(x) for x in between[1:i]]), 0)
                + coalesce(list_sum([len(x) for x in found[1:i - 1]]), 0) AS BIGINT) AS pos
    FROM (
      SELECT k, found, judged, between, unnest(range(1, len(found) + 1)) AS i
      FROM (
        SELECT k, regexp_extract_all(text, '{pattern}') AS found, regexp_extract_all(text, '{pattern}', {group}) AS judged,
               string_split_regex(text, '{pattern}') AS between
        FROM texts WHERE regexp_matches(text, '{pattern}'))))
  WHERE len(judged[i]) >= {least}"""


_ANY_CASE = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key")
)
_RULES = [
    ("assign", rf"""({_ANY_CASE})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("url", "://[A-Za-z0-9._~%-]{1,64}:[A-Za-z0-9._~%!$&*+-]{4,64}@", 0, 1),
]

ORACLE["op13_secret_scan"] = f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_spans(kind, at, *rest) for at, (kind, *rest) in enumerate(_RULES))}),
joined AS (
  SELECT k, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY k)
SELECT t.doc_id, coalesce(j.n_assign, 0) AS n_assign, coalesce(j.n_access, 0) AS n_access, coalesce(j.n_hex, 0) AS n_hex,
       sha256(coalesce(j.base, '')) AS base_sha256, coalesce(j.spans, '') AS spans
FROM texts t LEFT JOIN joined j USING (k)
"""
