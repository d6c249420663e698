"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ),
        words AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words
            FROM pieces
        ),
        starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM words),
        counted AS (
            SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f
            FROM starts, (SELECT unnest([1, 2, 3]) AS size)
            WHERE i + size - 1 <= len(words)
            GROUP BY ALL
        ),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
        candidates AS (
            SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS parts
            FROM counted WHERE size > 1 AND f >= 10
        ),
        cuts AS (
            SELECT lang, phrase, a, k,
                   array_to_string(parts[1 : k], ' ') AS left_part,
                   array_to_string(parts[k + 1 : size], ' ') AS right_part
            FROM candidates, (SELECT unnest([1, 2]) AS k)
            WHERE k < size
        ),
        scored AS (
            SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r,
                   ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score,
                   row_number() OVER (
                       PARTITION BY c.lang, c.phrase
                       ORDER BY (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f), c.k
                   ) AS cut
            FROM cuts c
            JOIN counted x ON x.lang = c.lang AND x.phrase = c.left_part
            JOIN counted y ON y.lang = c.lang AND y.phrase = c.right_part
        ),
        inside AS (
            SELECT lang, array_to_string(parts[i : i + 1], ' ') AS phrase, max(a) AS longer
            FROM candidates, (SELECT unnest([1, 2]) AS i)
            WHERE size = 3
            GROUP BY ALL
        ),
        ranked AS (
            SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
                   row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
            FROM scored s
            LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
            WHERE s.cut = 1 AND (i.longer IS NULL OR 100 * i.longer < 50 * s.a)
        )
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
        FROM ranked r JOIN totals t ON t.lang = r.lang
        WHERE r.rank <= 2000
    """,
    "op12_conversation_trie": """
        WITH turns AS (
            SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
                   ) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        lengths AS (SELECT conv, count(*) AS turns FROM turns GROUP BY conv),
        hashed AS (
            SELECT conv, turns, conv - conv % 5 AS source,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT,
                           list_transform(string_split(conv::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                       lambda crc, octet: list_reduce(
                           list_prepend(xor(crc, octet), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda c, step: xor(c >> 1, 3988292384::BIGINT * (c & 1)))),
                       4294967295::BIGINT) % 9 AS h
            FROM lengths
        ),
        plan AS (
            SELECT x.conv, x.source, x.h, least(x.h, coalesce(s.turns, 0)) AS opening
            FROM hashed x LEFT JOIN lengths s ON s.conv = x.source
        ),
        rebuilt AS (
            SELECT p.conv, t.place, t.role, t.text
            FROM plan p JOIN turns t ON t.conv = p.source AND t.place <= p.opening
            UNION ALL
            SELECT p.conv, p.opening + t.place - p.h, t.role, t.text
            FROM plan p JOIN turns t ON t.conv = p.conv AND t.place > p.h
        ),
        prefixes AS (
            SELECT conv, place AS depth, strlen(text) AS bytes,
                   string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '')
                       OVER (PARTITION BY conv ORDER BY place) AS key,
                   place = max(place) OVER (PARTITION BY conv) AS last
            FROM rebuilt
            UNION ALL
            SELECT conv, 0, 0, '', conv NOT IN (SELECT conv FROM rebuilt) FROM plan
        ),
        linked AS (
            SELECT *, lag(key) OVER (PARTITION BY conv ORDER BY depth) AS parent FROM prefixes
        ),
        nodes AS (
            SELECT key, depth, min(conv) AS conv, any_value(parent) AS parent, count(*) AS n_convs,
                   any_value(bytes) AS bytes,
                   sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (WHERE last), '')) AS ends
            FROM linked GROUP BY key, depth
        ),
        children AS (SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
        counted AS (
            SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.parent = n.key
        ),
        summed AS (
            SELECT p.key, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves,
                   sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved
            FROM counted n JOIN prefixes p ON p.conv = n.conv AND p.depth <= n.depth
            GROUP BY p.key
        )
        SELECT n.conv AS conv_id, n.depth, u.conv AS parent_conv_id, n.n_convs, n.n_children,
               s.n_leaves, s.saved AS saved_tokens, n.ends AS ends_sha256
        FROM counted n
        JOIN summed s ON s.key = n.key
        LEFT JOIN nodes u ON n.depth > 0 AND u.key = n.parent
    """,
    "op13_suffix_dedup": """
        WITH texts AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS octets,
                   strlen(coalesce(text, '')) AS n_bytes
            FROM documents
        ),
        blocks AS (
            SELECT rid, n_bytes, unnest(range(0, n_bytes - 24, 100)) AS base, octets
            FROM texts WHERE n_bytes >= 200
        ),
        parts AS (
            SELECT rid, n_bytes, base, substr(octets, 2 * base + 1, 248) AS part,
                   unnest(range(least(100, n_bytes - 24 - base))) AS i
            FROM blocks
        ),
        pieces AS (
            SELECT rid, n_bytes, base + i AS s, hash(substr(part, 2 * i + 1, 50)) AS piece FROM parts
        ),
        digests AS MATERIALIZED (
            SELECT rid, s, n_bytes,
                   hash(piece, lead(piece, 25) OVER w, lead(piece, 50) OVER w, lead(piece, 75) OVER w,
                        lead(piece, 100) OVER w, lead(piece, 125) OVER w, lead(piece, 150) OVER w,
                        lead(piece, 175) OVER w) AS digest
            FROM pieces WINDOW w AS (PARTITION BY rid ORDER BY s)
            QUALIFY s <= n_bytes - 200
        ),
        repeated AS (
            SELECT rid, s FROM digests
            WHERE digest IN (SELECT digest FROM digests GROUP BY digest HAVING count(*) > 1)
        ),
        marked AS (
            SELECT rid, s, coalesce(s > lag(s) OVER (PARTITION BY rid ORDER BY s) + 200, true) AS begins
            FROM repeated
        ),
        numbered AS (
            SELECT rid, s, sum(begins::INT) OVER (PARTITION BY rid ORDER BY s) AS run FROM marked
        ),
        runs AS (
            SELECT rid, run, min(s) AS first, max(s) + 200 AS stop FROM numbered GROUP BY rid, run
        ),
        kept AS (
            SELECT r.rid, r.run, r.stop - r.first AS gone,
                   substr(t.octets, 2 * coalesce(lag(r.stop) OVER (PARTITION BY r.rid ORDER BY r.run), 0) + 1,
                          2 * (r.first - coalesce(lag(r.stop) OVER (PARTITION BY r.rid ORDER BY r.run), 0))) AS part
            FROM runs r JOIN texts t ON t.rid = r.rid
        ),
        sums AS (
            SELECT k.rid, sum(k.gone)::BIGINT AS n_removed, count(*) AS n_spans,
                   string_agg(k.part, '' ORDER BY k.run) AS head, max(r.stop) AS stop
            FROM kept k JOIN runs r ON r.rid = k.rid AND r.run = k.run GROUP BY k.rid
        )
        SELECT t.doc_id, t.n_bytes, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(s.head, '') || substr(t.octets, 2 * coalesce(s.stop, 0) + 1))) AS kept_sha256
        FROM texts t LEFT JOIN sums s ON s.rid = t.rid
    """,
    "given_url_rules": """
        WITH rests AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ),
        hosts AS (
            SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
        ),
        parts AS (
            SELECT page_id,
                   translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM hosts
        ),
        rules(rule_host, rule_path, given) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        ),
        ranked AS (
            SELECT p.page_id, host, path, rule_host || rule_path AS rule, given,
                   row_number() OVER (
                       PARTITION BY p.page_id, host, path ORDER BY length(rule_host || rule_path) DESC NULLS LAST
                   ) AS place
            FROM parts p
            LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                           AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, given FROM ranked WHERE place = 1
    """,
}
