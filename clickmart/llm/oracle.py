"""SQL twins of the text operators, where SQL can express them."""

OP5 = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
split AS (
  SELECT page_id, url, row_number() OVER () AS row,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, row,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
hits AS (
  SELECT p.row, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON h.row = p.row AND h.place = 1
"""

#: targets: the k sources with the smallest cap per weight are capped, for the one k at
#: which exactly those exceed the level
OP8 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(concat_ws('|', '20817', doc_id, text)), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sources),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k FROM weighed),
levels AS (
  SELECT a.k,
    (1.5 * (SELECT sum(source_size) FROM weighed) - 2.0 * coalesce(sum(b.source_size) FILTER (b.k < a.k), 0))
      / sum(b.w) FILTER (b.k >= a.k) AS level,
    any_value(a.source_size / a.w) AS ratio
  FROM ordered a, ordered b GROUP BY a.k),
chosen AS (SELECT level FROM levels WHERE 2.0 * ratio > level ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, least((SELECT level FROM chosen) * w, 2.0 * source_size) AS target FROM weighed),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, r.source_size, r.target,
  CAST(s.size * (floor(rate) + CASE WHEN s.draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
"""




def _add(state: str, cost: str, edit: str) -> str:
    """A state is nine digits of cost and the audit so far; null if it can't be reached."""
    return f"(printf('%09d', CAST(substr({state}, 1, 9) AS INTEGER) + {cost}) || substr({state}, 10) || {edit})"


def _inserted(name: str) -> str:
    """States of ``name`` after cheapest insertions: a row follows none (s0), s (s1), u or a."""
    into_u = ", ".join(_add(f"{name}.{state}", "5", "'I'") for state in ("s0", "s1", "s3"))
    return (
        f"{name}.s0 AS n, {name}.s1 AS s, least({name}.s2, {into_u}) AS u, "
        f"least({name}.s3, {_add('u', '5', chr(39) + 'I' + chr(39))}) AS a"
    )


def _entered(initial: str, *states: str) -> str:
    """A row that becomes ``initial`` behind any of ``states``."""
    price, edit = f"more + CASE WHEN r = '{initial}' THEN 0 ELSE 1 END", f"CASE WHEN r = '{initial}' THEN 'K' ELSE 'R' END"
    return f"CASE WHEN stays THEN least({', '.join([*[_add(s, price, edit) for s in states], 'NULL'])}) END"


#: the checksum bit by bit; a walk along all conversations at once that keeps the best of each state
OP11 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda sum, byte: list_reduce(
        [xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295) % 20 AS kind
  FROM keyed),
damaged AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid, conv_id, turn, kind,
    CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn),
ordered AS (
  SELECT *, row_number() OVER (
      PARTITION BY cid ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY i) || left(role, 1) AS pair
  FROM ordered),
symbols AS (
  SELECT cid, i, r, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS stays,
    CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
  FROM judged),
walk(cid, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT cid, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM symbols
  UNION ALL
  SELECT cid, i, {_add('n', '2', "'D'")},
    least({_add('s', '2', "'D'")}, CASE WHEN stays AND r = 's' THEN {_add('n', 'more', "'K'")} END),
    least({_add('u', '2', "'D'")}, {_entered('u', 'n', 's', 'a')}),
    least({_add('a', '2', "'D'")}, {_entered('a', 'u')})
  FROM (SELECT w.cid, x.i, x.r, x.stays, x.more, {_inserted('w')}
        FROM walk w JOIN symbols x ON x.cid = w.cid AND x.i = w.i + 1)),
last AS (
  SELECT cid, least(n, a) AS best
  FROM (SELECT w.cid, w.i, max(w.i) OVER (PARTITION BY w.cid) AS rows, {_inserted('w')} FROM walk w)
  WHERE i = rows),
audits AS (
  SELECT cid, CAST(substr(best, 1, 9) AS BIGINT) AS cost, substr(best, 10) AS audit,
    length(replace(substr(best, 10), 'D', '')) % 2 AS odd
  FROM last),
steps AS (
  SELECT cid, odd, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i,
    length(replace(substr(audit, 1, p), 'D', '')) AS place
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM audits)),
lines AS (
  SELECT s.cid, s.p, CASE s.edit WHEN 'K' THEN j.role
      ELSE CASE WHEN (s.place - s.odd) % 2 = 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE s.edit WHEN 'I' THEN '' ELSE j.text END AS line
  FROM steps s LEFT JOIN judged j ON j.cid = s.cid AND j.i = s.i
  WHERE s.edit <> 'D'),
repaired AS (SELECT cid, string_agg(line, chr(10) ORDER BY p) AS body FROM lines GROUP BY cid),
counted AS (
  SELECT cid, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY cid),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(a.cost, 0) AS cost,
  coalesce(a.audit, '') AS audit, sha256(coalesce(b.body, '')) AS repaired_sha256
FROM ids
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN audits a ON a.cid = c.cid
LEFT JOIN repaired b ON b.cid = c.cid
"""

OP13 = """
WITH payloads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
shared AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100
  GROUP BY payload_digest HAVING count(*) > 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN s.first_id <> p.page_id OR (s.first_id IS NOT NULL AND p.page_id IS NULL) THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN s.first_id <> p.page_id OR p.page_id IS NULL THEN s.first_id END AS refers_to
FROM payloads p LEFT JOIN shared s USING (payload_digest)
"""


def statements() -> dict[str, str]:
    return {"op5_urls": OP5, "op8_mixing": OP8, "op11_conversations": OP11, "op13_warc": OP13}
