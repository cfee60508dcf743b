"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

SQL: dict[str, str] = {}

SQL["op3_mix"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size, md5(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
      FROM d GROUP BY source),
-- sources by the share at which they fill up; those before the first that does not fill are full
o AS (SELECT *, coalesce(sum(3 * source_size) OVER before, 0) AS spent, sum(w) OVER after AS weight
      FROM s WINDOW before AS (ORDER BY source_size::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    after AS (ORDER BY source_size::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (SELECT sum(source_size) AS total FROM s),
f AS (SELECT spent, weight FROM o, t WHERE 3 * source_size * weight >= (total - spent) * w ORDER BY source_size::DOUBLE / w, source LIMIT 1),
g AS (SELECT s.source, source_size, least(3 * source_size::DOUBLE, w::DOUBLE * (total - f.spent)::DOUBLE / f.weight::DOUBLE) AS target FROM s, t, f),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
             ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.digest), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM r
"""

SQL["op5_url_filter"] = r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path, bad
      FROM pages LEFT JOIN l ON l.doc_id = try_cast(regexp_extract(url, '/([0-9]+)(?:\.html)?/?(?:[?#].*)?$', 1) AS BIGINT)),
lab AS (SELECT DISTINCT host, string_split(host, '.') AS x FROM p),
nm AS (SELECT host, x[-2:] AS two, x[-3:] AS three, x[-1:] AS one FROM lab),
name AS (SELECT host, array_to_string(CASE WHEN j THEN two ELSE one END, '.') AS suffix, array_to_string(CASE WHEN j THEN three ELSE two END, '.') AS domain
         FROM (SELECT *, array_to_string(two, '.') IN ('ac.uk','co.jp','co.nz','co.uk','com.au','com.br','com.cn','org.uk') AS j FROM nm)),
h AS (SELECT host, suffix, domain, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS b FROM p JOIN name USING (host) GROUP BY ALL),
dm AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM h GROUP BY ALL),
sx AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM dm GROUP BY ALL),
lv AS (SELECT 'h' AS lv, n, b FROM h WHERE n > 0 UNION ALL SELECT 'd', n, b FROM dm WHERE n > 0 UNION ALL SELECT 's', n, b FROM sx WHERE n > 0),
q AS (SELECT lv, count(*) AS g, sum(n) AS n, sum(b) AS b, sum(n * n) AS nn, sum(b * b / n) AS bb FROM lv GROUP BY lv),
v AS (SELECT lv, g, n, CASE WHEN g < 2 OR n <= g THEN NULL ELSE (bb - b * b / n) / (g - 1) END AS bt,
             CASE WHEN g < 2 OR n <= g THEN NULL ELSE (b - bb) / (n - g) END AS wi, CASE WHEN g < 2 THEN NULL ELSE (n - nn / n) / (g - 1) END AS n0 FROM q),
k AS (SELECT lv, CASE WHEN bt > wi THEN least(greatest((bt + (n0 - 1) * wi) / (bt - wi) - 1, 2.0), 200.0) ELSE 200.0 END AS k FROM v),
kk AS (SELECT coalesce((SELECT k FROM k WHERE lv = 's'), 200.0) AS ks, coalesce((SELECT k FROM k WHERE lv = 'd'), 200.0) AS kd, coalesce((SELECT k FROM k WHERE lv = 'h'), 200.0) AS kh),
base AS (SELECT CASE WHEN coalesce(sum(n), 0) > 0 THEN (sum(b) + 1) / (sum(n) + 2) ELSE 0.5 END AS m FROM sx),
s2 AS (SELECT suffix, (b + m * ks) / (n + ks) AS m FROM sx, base, kk),
d2 AS (SELECT domain, (b + m * kd) / (n + kd) AS m FROM dm JOIN s2 USING (suffix), kk),
h2 AS (SELECT host, (b + m * kh) / (n + kh) AS r, n + kh + 1 AS c FROM h JOIN d2 USING (domain), kk),
h3 AS (SELECT host, r - 1.645 * sqrt(r * (1 - r) / c) AS bound FROM h2),
rules(rhost, rpath, says) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(says, length(rhost || rpath)) AS says
        FROM (SELECT DISTINCT page_id, host, path FROM p), rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN h3 USING (host) LEFT JOIN fit USING (page_id)
"""

SQL["op9_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

SQL["op10_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

SQL["op8_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
lo AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN lo USING (h) WHERE doc_id > first),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
k AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' '), '')) AS kept_sha256 FROM k
"""

SQL["op2_near_dedup"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, hash(s) AS s FROM (
         SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
         UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
-- linked sets share one of their first n - ceil(0.85 n) + 1 shingles in a common order, the rarest first
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY c, s) AS k FROM sh JOIN (SELECT s, count(*) AS c FROM sh GROUP BY s) USING (s)),
p AS (SELECT doc_id, s, n FROM r JOIN n USING (doc_id) WHERE k <= n - ceil(n * 85 / 100.0) + 1),
cand AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y ON x.s = y.s AND x.doc_id < y.doc_id
         WHERE least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 85),
hit AS (SELECT a, b, na, nb, count(*) AS inter FROM cand JOIN sh x ON x.doc_id = a JOIN sh y ON y.doc_id = b AND y.s = x.s GROUP BY ALL),
link AS (SELECT a, b FROM hit WHERE 100 * inter >= 85 * (na + nb - inter)),
e AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


def _network(p: str, n: str) -> str:
    """The sharding network once, on column ``p`` of 0..n-1 numbers, as a nested SELECT's text."""
    from sifter.llm.sharding import FACTORS, PRIME, SEED, round_keys

    def mixed(x: str, key: int) -> str:
        t = f"((({x} + {key}) % {PRIME} * {FACTORS[0]}) % {PRIME})"
        t = f"(xor({t}, {t} >> 15) * {FACTORS[1]} % {PRIME})"
        return f"xor({t}, {t} >> 13)"

    inner = f"SELECT *, {p} // b AS l0, {p} % b AS r0 FROM {n}"
    keys = round_keys(SEED)
    for j in range(0, len(keys), 2):
        k = j // 2
        inner = f"SELECT *, (l{k} + {mixed(f'r{k}', keys[j])}) % a AS l{k + 1} FROM ({inner})"
        inner = f"SELECT *, (r{k} + {mixed(f'l{k + 1}', keys[j + 1])}) % b AS r{k + 1} FROM ({inner})"
    return f"SELECT doc_id, size, crc, n, a, b, l{len(keys) // 2} * b + r{len(keys) // 2} AS p FROM ({inner})"


SQL["op13_merkle"] = r"""
WITH RECURSIVE enc AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS h, text FROM documents),
leaf AS (SELECT doc_id, source, sha256(h || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(h || coalesce(strlen(low) || ':' || low, '-')) AS lowered
         FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM enc)),
-- CRC-32 of the decimal doc_id, eight bit steps a digit
crc(s, i, c) AS (SELECT doc_id::VARCHAR, 1, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION SELECT s, i + 1, list_reduce(list_prepend(xor(c, ascii(s[i])::BIGINT), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) FROM crc WHERE i <= length(s)),
hit AS (SELECT s FROM crc WHERE i > length(s) AND xor(c, 4294967295) % 5 = 0),
no AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
              count(*) OVER (PARTITION BY source) AS n, doc_id::VARCHAR IN (SELECT s FROM hit) AS touched FROM leaf),
node(tree, lv, idx, n, d) AS (SELECT tree, 0, idx, n, leaf FROM no
  UNION ALL SELECT tree, lv + 1, idx // 16, (any_value(n) + 15) // 16, sha256(string_agg(d, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY tree, lv, idx // 16),
sub AS (SELECT tree, lv AS depth, d FROM node WHERE n = 1),
top(lv, idx, n, d) AS (SELECT 0, tree, count(*) OVER (), d FROM sub
  UNION ALL SELECT lv + 1, idx // 16, (any_value(n) + 15) // 16, sha256(string_agg(d, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lv, idx // 16),
run AS (SELECT tree, lv, idx // 16 AS run, list(d ORDER BY idx) AS ds FROM node WHERE n > 1 GROUP BY tree, lv, idx // 16),
toprun AS (SELECT lv, idx // 16 AS run, list(d ORDER BY idx) AS ds FROM top WHERE n > 1 GROUP BY lv, idx // 16),
steps AS (
  SELECT no.tree, no.idx, lv, (no.idx >> (4 * lv)) % 16 AS slot, ds FROM no JOIN run ON run.tree = no.tree AND run.run = no.idx >> (4 * lv + 4)
  UNION ALL SELECT no.tree, no.idx, depth + lv, (no.tree >> (4 * lv)) % 16, ds FROM no JOIN sub USING (tree) JOIN toprun ON toprun.run = no.tree >> (4 * lv + 4)),
path AS (SELECT tree, idx, list({'before': array_to_string(ds[:slot], ''), 'after': array_to_string(ds[slot + 2:], '')} ORDER BY lv) AS st FROM steps GROUP BY tree, idx),
fold(tree, idx, st, i, d) AS (SELECT no.tree, no.idx, coalesce(st, []), 1, CASE WHEN touched THEN lowered ELSE leaf END FROM no LEFT JOIN path USING (tree, idx)
  UNION ALL SELECT tree, idx, st, i + 1, sha256(st[i].before || d || st[i].after) FROM fold WHERE i <= len(st)),
root AS (SELECT d AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, sub.d AS subroot, root, sha256(coalesce(array_to_string(list_transform(st, lambda x: x.before || x.after), ''), '')) AS proof_sha256,
       fold.d AS folded_root, fold.d = root AS verified
FROM no JOIN sub USING (tree) JOIN fold ON fold.tree = no.tree AND fold.idx = no.idx AND fold.i = len(fold.st) + 1, root
"""

# CRC-32, which DuckDB lacks, is folded over the bytes of a text's hex form
SQL["op11_shards"] = rf"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) AS c FROM range(256) r(i))),
num AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS number FROM documents),
crcs AS (SELECT doc_id, size, number, CASE WHEN size = 1 THEN 0 ELSE xor(list_reduce(list_prepend(4294967295,
           list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) END AS crc FROM num, tab),
cnt AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM documents),
start AS (SELECT doc_id, size, crc, n, a, (n + a - 1) // a AS b, number AS p FROM crcs, cnt),
walk AS (SELECT * FROM ({_network('p', 'start')})
  UNION ALL SELECT * FROM ({_network('p', '(SELECT doc_id, size, crc, n, a, b, p FROM walk WHERE p >= n)')}))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (p % 8)::INT AS shard, (p // 8)::BIGINT AS slot, NULL::INT AS grown_shard FROM walk WHERE p < n
"""
