"""SQL (DuckDB) for the corpus queries that SQL can express."""

from tripmart.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

ORACLES: dict[str, str] = {}

ORACLES["op1_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""

ORACLES["op4_line_windows"] = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, i - 1 AS pos, ls[i] AS a, ls[i + 1] AS b, ls[i + 2] AS c
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM l WHERE len(ls) >= 3)
),
f AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
  FROM w WHERE regexp_matches(a || b || c, '[^\x20\x09-\x0D]')
),
covered AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM f WHERE nth > 1),
lines AS (SELECT doc_id, i - 1 AS pos, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM lines ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
)
SELECT l.doc_id, CASE WHEN l.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       CASE WHEN l.text IS NULL THEN 0 ELSE len(l.ls) - coalesce(k.n, 0) END::INT AS lines_removed
FROM l LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op9_digest_index"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents
),
k AS (
  SELECT doc_id, bare, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM k
"""

ORACLES["op10_curriculum_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, md5('0:' || coalesce(doc_id::VARCHAR, 'null')) AS order_key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth, 2.0::DOUBLE * source_size AS most FROM s
),
w AS (SELECT *, [5.0, 2.0, 1.0][nth % 3 + 1]::DOUBLE AS weight FROM r),
a AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS rate
  FROM w WINDOW o AS (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (
  SELECT source, source_size,
         least(most, coalesce(weight * max(CASE WHEN most > weight * rate THEN rate END) OVER (), most)) AS target
  FROM a
),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.order_key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS read
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
n AS (
  SELECT *, ((2 * read + size <= 2 * target)::INT + (2 * (read + source_size) + size <= 2 * target)::INT) AS copies FROM c
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM n
"""

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _words(text: str) -> str:
    return _WORDS.format(text)


def _phrase(phrase: str, label: str) -> str:
    parts = phrase.split()
    here = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(parts))
    return f"SELECT r, '{label}' AS label, list_filter(range(1, len(words) + 1), lambda i: {here}) AS places FROM w"


ORACLES["op13_license_blocks"] = f"""
WITH t AS (
  SELECT label, unit, list_distinct({_words("notice")}) AS own
  FROM (VALUES {", ".join(f"('{label}', '{unit}', '{text}')" for label, unit, text in TEMPLATES)}) AS v(label, unit, notice)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text FROM documents
), w AS (
  SELECT r, {_words("text")} AS words FROM d
), places AS (
  {" UNION ALL ".join(_phrase(p, label) for p, label in PHRASES.items())}
), base AS (
  SELECT r, SUM(len(places)) AS n_base, MIN(list_min(places)) - 1 AS first_word, MAX(list_max(places)) - 1 AS last_word,
    list(label) FILTER (WHERE len(places) > 0) AS found
  FROM places GROUP BY r
), block AS (
  SELECT r, 'line' AS unit, unnest(string_split(text, chr(10))) AS part FROM d
  UNION ALL
  SELECT r, 'paragraph', unnest(regexp_split_to_array(text, '\n[\x20\x09-\x0D]*\n')) FROM d
), numbered AS (
  SELECT row_number() OVER () AS b, r, unit, list_distinct({_words("part")}) AS held FROM block
), shared AS (
  SELECT b, r, label, len(list_intersect(own, held)) AS common, len(own) AS size FROM numbered JOIN t USING (unit)
), hits AS (
  SELECT b, r, label, common, CAST(common AS DOUBLE) / size AS share FROM shared WHERE common >= {THRESHOLD} * size
), best AS (
  SELECT r, label, share FROM hits QUALIFY rank() OVER (PARTITION BY b ORDER BY share DESC, common DESC) = 1
), own_labels AS (
  SELECT r, list(label) AS labels, MAX(share) AS share FROM best GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(n_base AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, COALESCE(list_aggregate(list_sort(found), 'string_agg', ','), '') AS base_labels,
  COALESCE(list_aggregate(list_sort(list_distinct(list_concat(found, labels))), 'string_agg', ','), '') AS labels,
  CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE COALESCE(share, CAST(0 AS DOUBLE)) END AS score
FROM d JOIN w USING (r) JOIN base USING (r) LEFT JOIN own_labels USING (r)
"""
