"""SQL (DuckDB) for the queries that SQL can express."""

_URL = """
SELECT page_id, url,
       CASE WHEN contains(url, '://') THEN
         translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
       ELSE '' END AS host,
       CASE WHEN contains(url, '://') THEN
         regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
       ELSE '' END AS path
FROM pages
"""

_USABLE = """
SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0
"""



def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    return (
        f"xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length({text}) + 1), "
        f"lambda i: ord(substr({text}, i, 1))::BIGINT), lambda c, b: "
        "list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], "
        "lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
    )


# Secrets: kind, rank, pattern, group with the value, fewest characters of it.
_WORDS = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_KINDS = (
    ("assign", 0, rf"""({_WORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    ("hex", 2, "[0-9a-f]+", 0, 24),
    # Runs that a key may start; of each, what comes before a sign of equality.
    ("generic", 3, "[A-Za-z0-9+/_=-]+", 0, 1),
)
_MATCHES = " UNION ALL ".join(
    f"""SELECT id, '{kind}' AS kind, {rank} AS rank, {least} AS least,
               unnest(regexp_split_to_array(t, '{pattern}')) AS gap,
               unnest(regexp_extract_all(t, '{pattern}', 0)) AS found,
               unnest(regexp_extract_all(t, '{pattern}', {group})) AS value,
               unnest(range(1, length(t) + 2)) AS i
        FROM texts WHERE regexp_matches(t, '{pattern}')"""
    for kind, rank, pattern, group, least in _KINDS
)
_LISTED = "array_to_string(list(kind || ':' || a || ':' || b ORDER BY a, rank) FILTER ({}), ',')"

# Repair: an edit is (initial, cost, next role state). States: none, system, user, assistant.
_STEPS = """
moves(q, letter, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
wants(q, letter, role) AS (VALUES (0, 'u', 'user'), (1, 'u', 'user'), (2, 'a', 'assistant'), (3, 'u', 'user')),
inserts(q, q2, cost, letters, lines) AS (VALUES
  (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
  (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
  (2, 2, 10, 'II', ['assistant:', 'user:']), (3, 3, 10, 'II', ['user:', 'assistant:']))"""

# A paragraph's hash as numbers of 60 bits, their sums, and sums of bits in fields of 20.
_MARKS = """
SELECT id, list_transform(list_filter(list_transform(
         regexp_extract_all(t, '[^\\n.!?]*[.!?]+|[^\\n.!?]+'), lambda p: trim(p, ' ')), lambda p: p <> ''),
         lambda p: sha256(p)) AS h FROM texts"""
_NUMBERS = "list_transform(h, lambda x: ('0x' || substr(x, {at}, 15))::BIGINT)"
_SUM = "(coalesce(list_sum({numbers}), 0)::HUGEINT % 1152921504606846976)::BIGINT"
_BITS = "list_transform(n{k}, lambda x: (x >> {j}) & 1099512676353)"
_ENTRIES = ", ".join(
    ["len(h)::BIGINT"]
    + [_SUM.format(numbers=f"n{k}") for k in range(4)]
    + [_SUM.format(numbers=_BITS.format(k=k, j=j)) for k in range(2) for j in range(20)]
)
_COUNTER = "(((v >> {f}) & 1048575) * 2 - e[1] + 524288) & 1048575"
_COUNTERS = ", ".join(f"({_COUNTER.format(f=f)}) - 524288" for f in (0, 20, 40))


def _near(b: str) -> str:
    dot = "list_sum(list_transform(list_zip({}.c, {}.c), lambda p: p[1] * p[2]))::DOUBLE"
    aa, bb, ab = dot.format("a", "a"), dot.format(b, b), dot.format("a", b)
    return (
        f"CASE WHEN a.e = {b}.e THEN 1.0::DOUBLE WHEN {aa} * {bb} > 0 "
        f"THEN least(greatest({ab} / sqrt({aa} * {bb}), 0.0), 1.0) ELSE 0.0::DOUBLE END"
    )


ORACLE = {
    "op2_embedding_dedup": f"""
WITH RECURSIVE usable AS ({_USABLE}),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 END),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
groups AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN groups USING (vec_id) LEFT JOIN counts USING (vec_id)
""",
    "op4_minhash_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
           THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
           WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_ AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM both_ JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
groups AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN groups USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op6_url_filter": f"""
WITH parts AS ({_URL}),
ruled AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
                   AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'example.net' OR ends_with(host, '.example.net'))
                   AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'org' OR ends_with(host, '.org'))
                   AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net'))
                   AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN host = '' THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
    "op10_secret_scan": f"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
         concat_ws('/', source, lang) AS repository FROM documents),
matches AS ({_MATCHES}),
placed AS (
  SELECT id, kind, rank, least, found, value,
         (sum(length(gap)) OVER w + sum(length(coalesce(found, ''))) OVER w - length(coalesce(found, '')))::BIGINT AS a
  FROM matches WHERE gap IS NOT NULL WINDOW w AS (PARTITION BY id, rank ORDER BY i)),
cut AS (
  SELECT id, kind, rank, least, a, CASE kind WHEN 'generic' THEN regexp_extract(found, '^[^=]*') ELSE found END AS found,
         CASE kind WHEN 'generic' THEN regexp_extract(found, '^[^=]*') ELSE value END AS value
  FROM placed WHERE found IS NOT NULL),
spans AS (
  SELECT id, kind, rank, a, a + length(found) AS b, sha256(value) AS hash FROM cut
  WHERE CASE kind WHEN 'generic' THEN length(value) >= 20 AND regexp_matches(value, '[0-9]')
                                      AND regexp_matches(value, '[A-Za-z]')
             ELSE length(value) >= least END),
apart AS (
  SELECT * FROM spans s WHERE rank < 3 OR NOT EXISTS (
    SELECT 1 FROM spans o WHERE o.id = s.id AND o.rank < 3 AND o.a < s.b AND s.a < o.b)),
owners AS (
  SELECT hash, count(DISTINCT owner) AS n FROM apart JOIN texts USING (id) GROUP BY hash),
judged AS (SELECT apart.*, n FROM apart JOIN owners USING (hash) WHERE rank < 3 OR n = 1)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce({_LISTED.format("rank < 3")}, '')) AS base_sha256,
       coalesce({_LISTED.format("kind IS NOT NULL")}, '') AS spans,
       count(*) FILTER (n < 3) AS n_live, count(*) FILTER (n >= 3) AS n_copied
FROM texts LEFT JOIN judged USING (id) GROUP BY id, doc_id
""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
faulty AS (SELECT *, {_crc32('name')} % 20 AS fault FROM named),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM faulty WHERE fault <> 0),
placed AS (
  SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown, substr(role, 1, 1) AS letter,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(letter) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
{_STEPS},
search AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM counted
  UNION ALL
  SELECT conv_id, i, q, arg_min({{'cost': cost, 'audit': audit, 'lines': lines}}, (cost, audit)) FROM (
    SELECT s.conv_id, s.i + 1 AS i, e.q2 AS q, s.best.cost + n.cost + e.cost AS cost,
           s.best.audit || n.letters || e.edit AS audit,
           s.best.lines || n.lines || CASE WHEN e.line IS NULL THEN [] ELSE [e.line] END AS lines
    FROM search s JOIN inserts n ON n.q = s.q
    JOIN (
      SELECT conv_id, i, q, 2 AS cost, 'D' AS edit, q AS q2, NULL AS line FROM judged, wants
      UNION ALL
      SELECT conv_id, i, q, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', q2, role || ':' || text
      FROM judged JOIN moves USING (letter) WHERE fault IN ('none', 'truncated')
      UNION ALL
      SELECT conv_id, i, w.q, 1 + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'R', m.q2, w.role || ':' || text
      FROM judged j, wants w JOIN moves m ON m.q = w.q AND m.letter = w.letter WHERE fault IN ('none', 'truncated')
    ) e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.i = s.i + 1 AND e.q = n.q2)
  GROUP BY conv_id, i, q),
ended AS (
  SELECT s.conv_id, min((s.best.cost + n.cost, s.best.audit || n.letters, s.best.lines || n.lines)) AS best
  FROM search s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i
  JOIN inserts n ON n.q = s.q WHERE n.q2 IN (0, 3) GROUP BY s.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best[1], 0)::BIGINT AS cost,
       coalesce(best[2], '') AS audit, sha256(coalesce(array_to_string(best[3], chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
""",
    "op12_fingerprints": f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS id FROM documents),
followed AS (
  SELECT a.*, b.text AS next_text, b.id AS next_id, length(a.text) AS n FROM ordered a
  JOIN ordered b ON b.id = a.id % (SELECT count(*) FROM ordered) + 1),
edits AS (
  SELECT *, substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) AS edited FROM followed),
texts AS (SELECT id, text AS t FROM edits UNION ALL SELECT -id, edited FROM edits),
marks AS ({_MARKS}),
numbers AS (SELECT id, h, {", ".join(_NUMBERS.format(at=15 * k + 1) + f" AS n{k}" for k in range(4))} FROM marks),
sums AS (SELECT id, [{_ENTRIES}] AS e FROM numbers),
prints AS (
  SELECT id, e, flatten(list_transform(e[6:45], lambda v: [{_COUNTERS}])) AS c,
         array_to_string(list_transform(e, lambda x: format('{{:015x}}', x)), '') AS s FROM sums)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, a.s AS fingerprint, b.s AS edited_fingerprint,
       {_near('b')} AS near_edited, {_near('c')} AS near_next
FROM edits d JOIN prints a ON a.id = d.id JOIN prints b ON b.id = -d.id JOIN prints c ON c.id = d.next_id
""",
    "op13_prefix_trie": rf"""
WITH turns AS (
  SELECT conv_id, sha256(sha256(coalesce(text, '')) || coalesce(role, '')) AS turn_id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32('conv_id::VARCHAR')} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, i, turn_id, words FROM convs c JOIN turns t ON t.conv_id = c.base AND i <= h
  UNION ALL
  SELECT c.conv_id, 1, i, turn_id, words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND i > h),
paths AS (
  SELECT conv_id, words, row_number() OVER w AS depth, string_agg(turn_id, '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lasts AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_last FROM paths),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_last), '')) AS ends_sha256
  FROM lasts GROUP BY path, depth),
kids AS (SELECT substr(path, 1, length(path) - 64) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
subtrees AS (
  SELECT top.path, count(*) FILTER (below.n_children = 0) AS n_leaves,
         sum((below.n_convs - 1) * below.words)::BIGINT AS saved_tokens
  FROM (SELECT path, depth FROM nodes) top JOIN counted below ON below.path[1:64 * top.depth] = top.path
  GROUP BY top.path)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (path)
LEFT JOIN nodes p ON c.depth > 0 AND p.path = substr(c.path, 1, length(c.path) - 64)
""",
}
