"""The registered queries that SQL can express, in DuckDB SQL."""



def _level(k: int, order: int) -> str:
    """CTEs of the probabilities of endings of ``k + 1`` characters."""
    shorter = "1.0::DOUBLE / 256" if k == 0 else None
    pa, pr = (shorter, shorter) if k == 0 else ("s.pa", "s.pr")
    join = "" if k == 0 else f"JOIN p{k - 1} s ON s.gram = right(t.gram, {k})"
    return f"""
    t{k} AS (SELECT right(gram, {k + 1}) AS gram, sum(a)::BIGINT AS a, sum(r)::BIGINT AS r FROM g{order} GROUP BY 1),
    c{k} AS (SELECT left(gram, {k}) AS context, sum(a)::BIGINT AS a, sum(r)::BIGINT AS r FROM t{k} GROUP BY 1),
    p{k} AS (SELECT t.gram, (t.a::DOUBLE + 4.0::DOUBLE * ({pa})) / (c.a::DOUBLE + 4.0::DOUBLE) AS pa,
                    (t.r::DOUBLE + 4.0::DOUBLE * ({pr})) / (c.r::DOUBLE + 4.0::DOUBLE) AS pr
             FROM t{k} t JOIN c{k} c ON c.context = left(t.gram, {k}) {join}),"""


URL_FILTER = f"""
WITH w AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM w),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h),
v AS (SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 1 WHEN rule IS NOT NULL THEN -1 ELSE 0 END AS side FROM r),
u AS (SELECT url, count(*) AS uses, max(side) AS side, left(md5(url), 1) IN ('0', '1', '2') AS held FROM v GROUP BY url),
x AS (SELECT url, uses, CASE WHEN held THEN 0 ELSE side END AS side, unnest(range(1, length(url) + 2)) AS i FROM u),
g AS (SELECT url, uses, side, substr(repeat(chr(2), 3) || url || chr(3), i, 4) AS gram FROM x),
g3 AS (SELECT gram, sum(CASE WHEN side > 0 THEN uses ELSE 0 END)::BIGINT AS a,
              sum(CASE WHEN side < 0 THEN uses ELSE 0 END)::BIGINT AS r FROM g GROUP BY gram),
{"".join(_level(k, 3) for k in range(4))}
m AS (SELECT gram, round((ln(pa) - ln(pr)) * 1e6)::BIGINT AS micro FROM p3),
s AS (SELECT g.url, trunc(sum(micro)::DOUBLE / count(*))::BIGINT AS score FROM g JOIN m USING (gram) GROUP BY g.url),
k AS (SELECT u.url, u.side, u.held, s.score FROM u JOIN s USING (url)),
c AS (SELECT coalesce(trunc((trunc(sum(CASE WHEN held AND side = 1 THEN score ELSE 0 END)::DOUBLE
                                   / nullif(sum((held AND side = 1)::INT), 0))
                             + trunc(sum(CASE WHEN held AND side = -1 THEN score ELSE 0 END)::DOUBLE
                                     / nullif(sum((held AND side = -1)::INT), 0))) / 2), 0)::BIGINT AS cut,
             sum((NOT held AND side = 1)::INT) > 0 AND sum((NOT held AND side = -1)::INT) > 0 AS trained FROM k)
SELECT v.page_id, v.host, v.path, v.rule,
       CASE WHEN v.side = 1 THEN 'allow' WHEN v.side = -1 THEN 'block'
            WHEN (CASE WHEN trained THEN k.score ELSE 0 END) >= (CASE WHEN trained THEN cut ELSE 0 END) THEN 'allow'
            ELSE 'block' END AS verdict,
       CASE WHEN trained THEN k.score ELSE 0 END AS score, CASE WHEN trained THEN cut ELSE 0 END AS threshold
FROM v JOIN k USING (url), c
"""

FIXITY = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, left(md5(coalesce(html, '')), 2) AS sign FROM pages),
bits AS (
  SELECT coalesce(min(b), 63)::INT AS b FROM range(10, 64) t(b), (SELECT min(page_id) AS lo, max(page_id) AS hi, count(page_id) AS n FROM pages)
  WHERE (hi >> b) = (lo >> b) OR ((hi >> b) - (lo >> b) + 1) * 256 <= n),
both_replicas AS (
  SELECT 'a' AS side, page_id, url, html FROM p
  UNION ALL
  SELECT 'b', page_id, url, CASE WHEN sign = '00' AND html <> '' THEN '~' || substr(html, 2)
                                 WHEN sign = '01' THEN repeat('0', strlen(html)) ELSE html END FROM p WHERE sign NOT IN ('02', '03')
  UNION ALL SELECT 'b', page_id, url, html FROM p WHERE sign IN ('04', '05')
  UNION ALL SELECT 'b', page_id, url || '#new', '' FROM p WHERE sign IN ('06', '07')),
r AS (
  SELECT side, page_id, url,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13)
         || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
         || strlen(html)::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10) || html
         || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM both_replicas),
d AS (SELECT side, page_id, url, strlen(record) AS n, sha256(record) AS digest FROM r),
f AS (SELECT d.*, CASE WHEN page_id IS NULL THEN 'none-' || left(digest, 3) ELSE (page_id >> b)::VARCHAR END AS file FROM d, bits),
l AS (
  SELECT side, page_id, url, digest, file, (row_number() OVER w - 1)::BIGINT AS seq, (sum(n) OVER w - n)::BIGINT AS "start",
         (sum(n) OVER w)::BIGINT AS "end" FROM f
  WINDOW w AS (PARTITION BY side, file ORDER BY page_id NULLS LAST, url, digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT *, row_number() OVER (PARTITION BY side, file, page_id, url, digest ORDER BY seq) AS nth FROM l),
e AS (
  SELECT x.*, y.side IS NOT NULL AS matched, y."start" = x."start" AND y."end" = x."end" AS there
  FROM k x LEFT JOIN k y ON y.side <> x.side AND y.file = x.file AND y.page_id IS NOT DISTINCT FROM x.page_id
                            AND y.url = x.url AND y.digest = x.digest AND y.nth = x.nth),
u AS (SELECT *, row_number() OVER (PARTITION BY side, page_id, url ORDER BY file, seq) AS n2 FROM e WHERE NOT matched)
SELECT page_id, file, seq, "start", "end", digest, CASE WHEN there THEN 'ok' ELSE 'moved' END AS status
FROM e WHERE side = 'a' AND matched
UNION ALL
SELECT x.page_id, x.file, x.seq, x."start", x."end", x.digest,
       CASE WHEN y.side IS NOT NULL THEN 'damaged' WHEN x.side = 'a' THEN 'missing' ELSE 'extra' END
FROM u x LEFT JOIN u y ON y.side <> x.side AND y.page_id IS NOT DISTINCT FROM x.page_id AND y.url = x.url AND y.n2 = x.n2
WHERE x.side = 'a' OR y.side IS NULL
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER w - 1 AS pos, coalesce(lag(role) OVER w, '') AS before,
         length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS body,
         CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
              ELSE 1 + length(role) + length(regexp_replace(role, '[^\\#<\n:]', '', 'g')) END + 6 AS head
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
m AS (
  SELECT *, CASE WHEN pos = 0 THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
                 WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role = 'user'
                 WHEN before = '' THEN role IN ('system', 'user') ELSE false END AS ok FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(head + body + 8)::BIGINT AS formatted_chars,
       bool_and(ok) AND arg_max(role, pos) IN ('assistant', 'user') AS valid,
       min(CASE WHEN NOT ok THEN pos END)::INT AS first_bad_turn
FROM m GROUP BY conv_id
"""

# CRC-32 runs over the bytes of each text with a table made from its polynomial
SHARDS = """
WITH RECURSIVE bits(n, c, i) AS (
  SELECT n, n, 0 FROM range(256) r(n)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY n) AS tab FROM bits WHERE i = 8),
d AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size,
         CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(list_reduce(
           list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
           lambda acc, b: xor(acc >> 8, tab[xor(acc, b) % 256 + 1]), 4294967295), 4294967295) END AS text_crc32
  FROM documents, crc),
ids AS (SELECT DISTINCT coalesce(doc_id, -1) AS id FROM d),
jump(id, k, j, lo, hi) AS (
  SELECT id, CASE WHEN id < 0 THEN id::HUGEINT + 18446744073709551616 ELSE id::HUGEINT END, 0::BIGINT, 0, 0 FROM ids
  UNION ALL
  SELECT id, k2, trunc((j + 1) * (2147483648::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT,
         CASE WHEN j < 24 THEN j ELSE lo END, j
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jump WHERE j < 25)),
place AS (SELECT id, max(lo)::INT AS shard, max(hi)::INT AS grown_shard FROM jump GROUP BY id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS slot, grown_shard
FROM d JOIN place ON id = coalesce(doc_id, -1)
"""

FILTERS = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT doc_id, part,
         (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN first_id < doc_id THEN 'E' ELSE '' END) AS failed FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS n_good, sum(coalesce(toxic, 0)) AS n_toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, failed),
k(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
      FROM k a JOIN k b ON b.x <> a.x JOIN k c ON c.x NOT IN (a.x, b.x) JOIN k d ON d.x NOT IN (a.x, b.x, c.x)
      JOIN k e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT c.*, filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS done
      FROM c, o, (VALUES (1), (2), (3), (4), (5)) t(step)),
x AS (SELECT *, contains(failed, letter) AS fails, translate(done, failed, '') = done AS there FROM s),
t AS (SELECT part, filter_order, step, letter,
             sum(CASE WHEN there AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN there AND fails THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN fails AND NOT there THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN failed = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN there AND fails THEN n_good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN there AND fails THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM x GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM t
"""

ORACLE_SQL = {
    "op4_url_language_models": URL_FILTER,
    "op5_merkle_fixity_audit": FIXITY,
    "op6_chat_state_machine": CHAT,
    "op8_jump_hash_shards": SHARDS,
    "op13_filter_interactions": FILTERS,
}
