"""The line-dedup query in DuckDB's SQL: candidates by shared thirds at all shifts, checked by the engine's edit distance.

That distance counts bytes, so every character beyond ASCII is first replaced by one ASCII letter for the comparison of lengths
and distances; lines that differ in such characters alone are told apart by their own text. Lines below 40 characters are compared for equality.
"""

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(x, chr(10))) AS raw, unnest(range(len(string_split(x, chr(10))))) AS pos FROM d),
e AS (SELECT *, trim(raw, {BLANKS}) AS line, coalesce(doc_id, -9223372036854775808)::HUGEINT * 2147483648 + pos AS place FROM l),
u AS (SELECT row_number() OVER () AS id, line, length(line) AS n, min(place) AS first FROM e WHERE line <> '' GROUP BY line),
s AS (SELECT id, line, n, i, n // 3 * i + greatest(0, n % 3 - 3 + i) AS b, n // 3 + CAST(n % 3 >= 3 - i AS INT) AS w FROM u, range(3) t(i) WHERE n >= 40),
ix AS (SELECT id AS a, i, n, substring(line, CAST(b + 1 AS BIGINT), CAST(w AS BIGINT)) AS seg FROM s),
pl AS (SELECT u.id AS b, u.line, u.n - k AS n, i, h, (u.n - k) // 3 * i + greatest(0, (u.n - k) % 3 - 3 + i) + h AS p,
    (u.n - k) // 3 + CAST((u.n - k) % 3 >= 3 - i AS INT) AS w FROM u, range(3) t(k), range(3) t2(i), range(-2, 3) t3(h) WHERE u.n >= 40),
pr AS (SELECT b, i, n, substring(line, CAST(p + 1 AS BIGINT), CAST(w AS BIGINT)) AS seg FROM pl WHERE p >= 0),
c AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ix JOIN pr USING (i, n, seg) WHERE a <> b),
chars AS (SELECT a, b, list_transform(string_split(x.line, ''), lambda q: q) AS xs, string_split(y.line, '') AS ys
    FROM c JOIN u x ON x.id = c.a JOIN u y ON y.id = c.b),
codes AS (SELECT a, b, xs, ys, list_distinct(list_concat(xs, ys)) AS al FROM chars),
plain AS (SELECT a, b, array_to_string(list_transform(xs, lambda q: chr(CAST(32 + list_position(al, q) AS INT))), '') AS x,
    array_to_string(list_transform(ys, lambda q: chr(CAST(32 + list_position(al, q) AS INT))), '') AS y FROM codes),
g AS (SELECT a, b FROM plain WHERE levenshtein(x, y) <= 2),
w AS (SELECT a, b FROM g UNION ALL SELECT b, a FROM g),
near AS (SELECT a AS id, min(first) AS near, count(*) AS links FROM w JOIN u ON u.id = w.b GROUP BY a),
m AS (SELECT line, least(first, coalesce(near, first)) AS stays, coalesce(links, 0) AS links FROM u LEFT JOIN near USING (id)),
f AS (SELECT r, doc_id, pos, raw, line <> '' AND place > stays AS gone, coalesce(links, 0) AS links FROM e LEFT JOIN m USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (coalesce(gone, false)) AS n_removed, CAST(sum(links) AS BIGINT) AS n_links,
    sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT coalesce(gone, false)), '')) AS kept_sha256
FROM f GROUP BY r, doc_id
"""
