"""DuckDB twins of this subpackage's queries, where SQL can express them."""

ORACLES: dict[str, str] = {
    "op2_warc": """
        WITH given AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), measured AS (
            SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM given
        ), firsts AS (
            SELECT digest, min(page_id) AS first_id FROM measured WHERE n >= 100 GROUP BY digest
        )
        SELECT m.page_id,
               CAST(m.n AS BIGINT) AS payload_bytes,
               m.digest AS payload_digest,
               CASE WHEN f.first_id < m.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first_id < m.page_id THEN f.first_id END AS refers_to
        FROM measured m LEFT JOIN firsts f USING (digest)
    """,
    "op6_decontaminate": r"""
        WITH items AS (
            SELECT item_id, regexp_extract_all(lower(text), '(?:[0-9a-z]|[^\x00-\x7F])+') AS w FROM benchmark
        ), sized AS (
            SELECT item_id, w, least(5, len(w)) AS k FROM items WHERE len(w) > 0
        ), item_grams AS (
            SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
            FROM sized, unnest(range(1, len(w) - k + 2)) AS places(i)
        ), sizes AS (
            SELECT item_id, count(*) AS n FROM item_grams GROUP BY item_id
        ), docs AS (
            SELECT row_number() OVER () AS place, doc_id,
                   regexp_extract_all(lower(text), '(?:[0-9a-z]|[^\x00-\x7F])+') AS w
            FROM documents
        ), doc_grams AS (
            SELECT DISTINCT place, doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
            FROM docs, (SELECT DISTINCT k FROM sized) AS widths, unnest(range(1, len(w) - k + 2)) AS places(i)
        ), shared AS (
            SELECT place, doc_id, item_id, count(*) AS hits
            FROM doc_grams JOIN item_grams USING (k, g) GROUP BY place, doc_id, item_id
        )
        SELECT doc_id, item_id, CAST(hits AS DOUBLE) / n AS containment
        FROM shared JOIN sizes USING (item_id) WHERE hits >= 0.8 * n
    """,
    # Articles of pages whose article is one element, as in the given tables.
    "op11_html": r"""
        WITH inner_html AS (
            SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS a FROM pages
        ), blocks AS (
            SELECT page_id, url, regexp_split_to_array(a, '</?(?:p|h1)>') AS b FROM inner_html
        ), plain AS (
            SELECT page_id, url, list_transform(b, lambda x: trim(regexp_replace(
                regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                    regexp_replace(replace(x, '<br>', ' '), '<[^<>]*>', '', 'g'),
                    '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
                '\s+', ' ', 'g'))) AS b
            FROM blocks
        ), joined AS (
            SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) AS text FROM plain
        )
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
    """,
    "op13_spelling": r"""
        WITH RECURSIVE tables AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) AS r(i))
        ), runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
            FROM documents
        ), counted AS (
            SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
        ), coded AS (
            SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM counted
        ), summed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2),
                    lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
            FROM coded, tables
        ), made AS (
            SELECT n, CASE WHEN h % 199 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM summed
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), places AS (
            SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
        ), cut AS (
            SELECT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM places
        ), near AS (
            SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, head, tail) WHERE a.word <> b.word
            UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.head || c.tail
            UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.head || c.tail
        ), ranked AS (
            SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near,
                   row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place
            FROM near JOIN (SELECT word AS other, n FROM words) USING (other)
        ), forms AS (
            SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
                   CASE WHEN r.n >= 5 * w.n THEN r.other END AS form,
                   CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
        ), followed AS (
            SELECT word, word AS root, 0 AS step FROM forms
            UNION ALL
            SELECT d.word, f.form, d.step + 1 FROM followed d JOIN forms f ON f.word = d.root WHERE f.form IS NOT NULL
        ), roots AS (
            SELECT word, arg_max(root, step) AS root FROM followed GROUP BY word
        )
        SELECT word, n, CAST(n_near AS BIGINT) AS n_near, form, CAST(form_n AS BIGINT) AS form_n, root
        FROM forms JOIN roots USING (word)
    """,
}
