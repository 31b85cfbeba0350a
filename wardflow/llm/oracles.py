"""SQL for those queries whose results SQL can express, written from their meaning."""

from __future__ import annotations

# Every 50-byte string and its first document; then runs of covered bytes. Hex digits stand for bytes.
OP4 = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
           FROM documents),
  pieces AS (SELECT doc_id, k, substr(h, 2000 * k + 1, 2098) AS c, least(1000, n - 49 - 1000 * k) AS m
             FROM (SELECT doc_id, h, n, unnest(range(0, (greatest(n - 49, 0) + 999) // 1000)) AS k FROM d)),
  grams AS (SELECT doc_id, 1000 * k + j AS p, substr(c, 2 * j + 1, 100) AS s
            FROM (SELECT doc_id, k, c, unnest(range(0, m)) AS j FROM pieces)),
  first AS (SELECT s, min(doc_id) AS m FROM grams GROUP BY s),
  hits AS (SELECT g.doc_id, g.p FROM grams g JOIN first f ON g.s = f.s WHERE f.m < g.doc_id),
  marked AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER w + 50 THEN 0 ELSE 1 END AS new
             FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
  numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM marked),
  runs AS (SELECT doc_id, min(p) AS b, max(p) + 50 AS e FROM numbered GROUP BY doc_id, k),
  cut AS (SELECT r.doc_id, b, e, coalesce(lag(e) OVER w, 0) AS before
          FROM runs r WINDOW w AS (PARTITION BY r.doc_id ORDER BY b)),
  gone AS (SELECT c.doc_id, sum(e - b) AS removed, count(*) AS spans, max(e) AS last,
                  string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' ORDER BY b) AS kept
           FROM cut c JOIN d ON d.doc_id = c.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id"""

# Equal payloads of 100 bytes or more.
OP5 = """WITH p AS (SELECT page_id, trim(url) AS target_uri, coalesce(html, '') AS h FROM pages),
  f AS (SELECT h, min(page_id) AS first_id FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT page_id, strlen(p.h) AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, target_uri
FROM p LEFT JOIN f ON p.h = f.h"""

# Shared shingles counted per pair; the smallest id reachable.
OP8 = """WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
  s AS (SELECT doc_id, unnest(CASE WHEN len(words) < 2 THEN list_filter([words], lambda x: len(x) > 0)
          ELSE list_distinct(list_transform(range(1, len(words)), lambda i: [words[i], words[i + 1]])) END) AS g
        FROM w),
  sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
             FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * common >= 80 * (p.n + q.n - common)),
  edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
  reach AS (SELECT doc_id, doc_id AS r FROM documents
            UNION SELECT e.y, reach.r FROM reach JOIN edges e ON e.x = reach.doc_id WHERE reach.r < e.y),
  least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON least.doc_id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id"""

# Units as a list; the parts are slices of it.
OP12 = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || doc_id) AS x FROM documents),
  h AS (SELECT doc_id, t, u, len(u) AS n, list_transform(range(0, 4),
          lambda k: ('0x' || substr(x, 8 * k + 1, 8))::BIGINT) AS h FROM d),
  f AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
               THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
  s AS (SELECT *, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
          array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s"""

# The checksum bit by bit; near words share a word with one place left out, or lack one place.
OP13 = """WITH RECURSIVE r AS (SELECT doc_id, w, count(*) AS n
           FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
           WHERE length(w) >= 7 GROUP BY 1, 2),
  c AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            range(0, strlen(doc_id || ':' || w)),
            lambda i: ('0x' || substr(hex(encode(doc_id || ':' || w)), 2 * i + 1, 2))::BIGINT)),
          lambda s, y: list_reduce(list_prepend(xor(s, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda q, z: xor(q >> 1, 3988292384 * (q & 1))))) AS h FROM r),
  e AS (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM c),
  words AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
  less AS (SELECT word, n, i, word[:i] || word[i + 2:] AS rest
           FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
  near AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
           UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
           UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
  best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS form, max(n) AS form_n
           FROM near GROUP BY word),
  f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
          CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
        FROM words w LEFT JOIN best ON best.word = w.word),
  chain AS (SELECT word, word AS root, form AS next FROM f
            UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN f ON f.word = chain.next)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN chain ON chain.word = f.word AND chain.next IS NULL"""

ORACLES = {
    "op4_suffix_dedup": OP4,
    "op5_warc": OP5,
    "op8_near_duplicates": OP8,
    "op12_fill_middle": OP12,
    "op13_spelling": OP13,
}
