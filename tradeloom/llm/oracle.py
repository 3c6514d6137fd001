"""SQL for the corpus queries that SQL can express."""

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Jump hashing step by step in exact integers, and CRC-32 byte by byte over a table built from its polynomial.
SHARDING = """
WITH RECURSIVE bits AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
), content AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS digits FROM documents
), sums AS (
    SELECT doc_id, n, xor(list_reduce(
        list_transform(range(n), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS text_crc32
    FROM content CROSS JOIN bits
), jumps(doc_id, shards, state, landed, following) AS (
    SELECT doc_id, shards, (CAST(doc_id AS HUGEINT) + 18446744073709551616) % 18446744073709551616, CAST(-1 AS BIGINT), CAST(0 AS BIGINT)
    FROM documents CROSS JOIN (VALUES (24), (25)) AS counts(shards)
    UNION ALL
    SELECT doc_id, shards, next, following, CAST(floor((following + 1) * (2147483648.0 / CAST(next // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
    FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM jumps WHERE following < shards)
), placed AS (
    SELECT doc_id, max(landed) FILTER (shards = 24) AS shard, max(landed) FILTER (shards = 25) AS grown_shard
    FROM jumps WHERE following >= shards GROUP BY doc_id
)
SELECT doc_id, CAST(n + 8 AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM sums JOIN placed USING (doc_id)
"""

URLFILTER = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT row_number() OVER () AS row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {LETTERS}) AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM cut
), rules(rule, host, path, verdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fits AS (
    SELECT row, rule, verdict, row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC) AS place
    FROM parts JOIN rules ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host))
                         AND starts_with(parts.path, rules.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)
"""

SIMJOIN = f"""
WITH RECURSIVE held AS (
    SELECT doc_id, regexp_extract_all(translate(text, {LETTERS}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), tokens AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS token
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM held WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
    SELECT a, b FROM ways UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.other = ways.a
), least AS (
    SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT held.doc_id, coalesce(sizes.n, 0) AS n_shingles, least(held.doc_id, coalesce(least.other, held.doc_id)) AS component_id
FROM held LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

#: The exponent by bisection, 40 steps: the flattest mixture in which no source is passed over more than twice.
MIXING = """
WITH RECURSIVE held AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0b\\f\\r]+')) AS tokens,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
    FROM documents
), totals AS (
    SELECT source, sum(tokens) AS t FROM held GROUP BY source
), ends AS (
    SELECT CAST(min(t) AS DOUBLE) AS low, CAST(max(t) AS DOUBLE) AS high FROM totals WHERE t > 0
), steps(n, low, high) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
    UNION ALL
    SELECT n + 1, CASE WHEN pow(e.low / e.high, (s.low + s.high) / 2 - 1) <= 2 THEN s.low ELSE (s.low + s.high) / 2 END,
           CASE WHEN pow(e.low / e.high, (s.low + s.high) / 2 - 1) <= 2 THEN (s.low + s.high) / 2 ELSE s.high END
    FROM steps s CROSS JOIN ends e WHERE n < 40
), exponent AS (
    SELECT CASE WHEN e.high / e.low <= 2 THEN 0 ELSE s.high END AS a, e.high AS largest FROM steps s CROSS JOIN ends e WHERE n = 40
), plan AS (
    SELECT source, t, CASE WHEN t > 0 THEN pow(t, a) / (SELECT sum(pow(t, a)) FROM totals WHERE t > 0) ELSE 0 END AS weight,
           CASE WHEN t > 0 THEN round(pow(t / largest, a - 1), 9) ELSE 1 END AS epochs
    FROM totals CROSS JOIN exponent
), need AS (
    SELECT source, weight, epochs, CAST(floor(epochs) AS BIGINT) AS whole, CAST(round((epochs - floor(epochs)) * t) AS BIGINT) AS more FROM plan
), laid AS (
    SELECT h.*, weight, epochs, whole, more,
           md5('mix:' || CAST(whole + 1 AS VARCHAR) || ':' || left(key, 3)) AS block
    FROM held h JOIN need USING (source)
), taken AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY block, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM laid
), passes AS (
    SELECT doc_id, source, tokens, weight, epochs, whole + CASE WHEN more > 0 AND before < more THEN 1 ELSE 0 END AS times FROM taken
)
SELECT doc_id, source, tokens, round(weight, 9) AS weight, epochs, CAST(unnest(range(1, times + 1)) AS INTEGER) AS pass FROM passes
"""

SUPERKMERS = """
WITH held AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS said
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM held WHERE len(w) >= 13)
), least AS (
    SELECT said, min(doc_id) AS first FROM windows GROUP BY said
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM windows JOIN least USING (said) WHERE first < doc_id
), lists AS (
    SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ')) AS kept_sha256
FROM held LEFT JOIN lists USING (doc_id)
"""

#: The cheapest edits by the least (cost, audit) for each state of the grammar, turn by turn: one insert at most before a turn,
#: as two would lead back to the same state.
REPAIR = r"""
WITH RECURSIVE bits AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), faults AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(
        list_transform(range(strlen(k)), lambda i: CAST('0x' || substr(hex(encode(k)), 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 20 AS f
    FROM keyed CROSS JOIN bits
), damaged AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM faults WHERE f <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown, left(role, 1) AS letter
    FROM damaged
), turns AS (
    SELECT *, CASE WHEN shown = '' THEN 0 WHEN again THEN 1 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 2 ELSE 3 END AS kind,
           lag(letter) OVER (PARTITION BY conv_id ORDER BY n) AS former
    FROM placed
), follows(state, next) AS (
    VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')
), moves(state, next, price, edits) AS (
    SELECT state, state, 0, '' FROM (VALUES (''), ('s'), ('u'), ('a')) AS states(state)
    UNION ALL SELECT state, next, 5, 'I' FROM follows WHERE next <> 's'
), steps(conv_id, n, state, best) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '', {'cost': 0, 'audit': ''} FROM conversations
    UNION ALL
    SELECT conv_id, n, state, min({'cost': cost, 'audit': audit}) FROM (
        SELECT s.conv_id, t.n, CASE WHEN e.edit = 'D' THEN m.next ELSE f.next END AS state,
               s.best.cost + m.price + CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
               + CASE WHEN e.edit <> 'D' AND t.kind = 2 THEN 5 ELSE 0 END AS cost, s.best.audit || m.edits || e.edit AS audit
        FROM steps s
        JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.n + 1
        JOIN moves m ON m.state = s.state
        CROSS JOIN (VALUES ('D'), ('K'), ('R')) AS e(edit)
        LEFT JOIN follows f ON f.state = m.next AND e.edit <> 'D'
        WHERE e.edit = 'D' OR (t.kind >= 2 AND f.next IS NOT NULL AND CASE WHEN e.edit = 'K' THEN f.next = t.letter ELSE f.next <> 's' END)
    ) GROUP BY conv_id, n, state
), sizes AS (
    SELECT c.conv_id, count(t.n) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (kind = 0) AS blank, count(*) FILTER (kind = 1) AS duplicate, count(*) FILTER (kind = 2) AS truncated,
           count(*) FILTER (former IS NOT NULL AND former || letter NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id
), cheapest AS (
    SELECT z.conv_id, min({'cost': s.best.cost + m.price, 'audit': s.best.audit || m.edits}) AS best
    FROM sizes z JOIN steps s ON s.conv_id IS NOT DISTINCT FROM z.conv_id AND s.n = z.rows
    JOIN moves m ON m.state = s.state AND m.next IN ('', 'a') GROUP BY z.conv_id
), edits AS (
    SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM cheapest
), made AS (
    SELECT e.conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS n,
           length(replace(substr(audit, 1, p), 'D', '')) - 1 - length(replace(audit, 'D', '')) % 2 AS place
    FROM edits e
), repaired AS (
    SELECT m.conv_id, string_agg(CASE WHEN edit = 'K' THEN t.role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN edit = 'I' THEN '' ELSE t.text END, chr(10) ORDER BY p) AS whole
    FROM made m LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM m.conv_id AND t.n = m.n AND m.edit <> 'I'
    WHERE edit <> 'D' GROUP BY m.conv_id
)
SELECT z.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(c.best.cost AS BIGINT) AS cost,
       c.best.audit AS audit, sha256(coalesce(r.whole, '')) AS repaired_sha256
FROM sizes z JOIN cheapest c ON c.conv_id IS NOT DISTINCT FROM z.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM z.conv_id
"""

ORACLE = {"op1_sharding": SHARDING, "op5_mixing": MIXING, "op7_urlfilter": URLFILTER, "op9_simjoin": SIMJOIN,
          "op11_superkmers": SUPERKMERS, "op12_repair": REPAIR}
