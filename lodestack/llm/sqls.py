"""DuckDB SQL for the llm queries that SQL can express."""

_MIX = """
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                  md5(concat('mix-1:', CAST(doc_id AS VARCHAR))) AS k FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM p),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS ratio, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget, sum(w) OVER () AS all_w FROM w),
c AS (SELECT *, coalesce(sum(cap) OVER b, 0.0) AS caps, coalesce(sum(w) OVER b, 0.0) AS ws FROM r
      WINDOW b AS (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, ratio * (all_w - ws) <= budget - caps AS capped FROM c),
g AS (SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0.0) AS fl, coalesce(sum(CASE WHEN capped THEN w END) OVER (), 0.0) AS fw FROM f),
t AS (SELECT source, source_size, budget, CASE WHEN capped THEN cap ELSE (budget - fl) * w / (all_w - fw) END AS target FROM g),
q AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.budget,
             CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
e AS (SELECT doc_id, size, budget, CAST(z.k * source_size + cum AS DOUBLE) / target AS vft FROM q, (VALUES (0), (1)) z(k) WHERE size > 0),
a AS (SELECT doc_id, size, sum(size) OVER (ORDER BY vft RANGE UNBOUNDED PRECEDING) <= budget AS fits FROM e),
n AS (SELECT doc_id, CAST(sum(CASE WHEN fits THEN size ELSE 0 END) AS BIGINT) AS taken FROM a GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(n.taken, 0) AS taken FROM q LEFT JOIN n USING (doc_id)
"""

_DEDUP = """
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept, h AS text_sha256
FROM n WINDOW g AS (PARTITION BY h ORDER BY chars DESC, doc_id)
"""

_WARC = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN n >= 100 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> m THEN m END AS refers_to FROM f
"""

_STAMPS = r"""
WITH s AS (SELECT stamp_id, source, zone, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM stamps),
w AS (SELECT *, regexp_extract(t, '^(?:(20[0-9]{2})-([0-9]{2})-([0-9]{2})|(20[0-9]{2})([0-9]{2})([0-9]{2})|([0-9]{2})[.]([0-9]{2})[.](20[0-9]{2})|([0-9]{2}) (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (20[0-9]{2})|([0-9]{2})/([0-9]{2})/(20[0-9]{2}))((?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2})?(?: ?[AP]M)?(?: ?(?:Z|[+-][0-9]{2}:?[0-9]{2}))?)?)$',
             ['y1', 'm1', 'd1', 'y2', 'm2', 'd2', 'd3', 'm3', 'y3', 'd4', 'b4', 'y4', 'd5', 'm5', 'y5', 'rest']) AS g,
             regexp_full_match(t, '[0-9]{10}') AS secs, regexp_full_match(t, '[0-9]{13}') AS millis FROM s),
d AS (SELECT *, TRY_CAST(CASE WHEN g.y1 <> '' THEN g.y1 || '-' || g.m1 || '-' || g.d1 WHEN g.y2 <> '' THEN g.y2 || '-' || g.m2 || '-' || g.d2
                              WHEN g.y3 <> '' THEN g.y3 || '-' || g.m3 || '-' || g.d3
                              WHEN g.y4 <> '' THEN g.y4 || '-' || lpad(CAST((strpos('JanFebMarAprMayJunJulAugSepOctNovDec', g.b4) + 2) // 3 AS VARCHAR), 2, '0') || '-' || g.d4
                              WHEN g.y5 <> '' THEN g.y5 || '-' || g.m5 || '-' || g.d5 END AS DATE) AS df,
             TRY_CAST(CASE WHEN g.y5 <> '' THEN g.y5 || '-' || g.d5 || '-' || g.m5 END AS DATE) AS mf,
             regexp_extract(g.rest, '^.([0-9]{2}):([0-9]{2})(?::([0-9]{2}))?(?: ?([AP]M))?(?: ?(.*))?$', ['h', 'mi', 's', 'half', 'off']) AS c FROM w),
e AS (SELECT *, TRY_CAST(c.h AS INT) AS h, coalesce(TRY_CAST(c.mi AS INT), 0) AS mi, coalesce(TRY_CAST(c.s AS INT), 0) AS sec,
             TRY_CAST(substr(c.off, 2, 2) AS INT) AS oh, TRY_CAST(right(c.off, 2) AS INT) AS om FROM d),
f AS (SELECT *, CASE WHEN g.rest = '' THEN 0 WHEN mi > 59 OR sec > 59 THEN NULL WHEN c.half <> '' AND NOT h BETWEEN 1 AND 12 THEN NULL WHEN c.half = '' AND h > 23 THEN NULL
                ELSE (CASE WHEN c.half = 'PM' THEN h % 12 + 12 WHEN c.half = 'AM' THEN h % 12 ELSE h END) * 3600 + mi * 60 + sec END AS tod,
             CASE WHEN c.off = 'Z' THEN 0 WHEN c.off <> '' AND oh <= 14 AND om <= 59 THEN (CASE WHEN c.off[1] = '-' THEN -1 ELSE 1 END) * (oh * 3600 + om * 60) END AS shift FROM e),
k AS (SELECT *, CASE WHEN secs OR millis THEN 'epoch' WHEN t IS NULL OR coalesce(df, mf) IS NULL OR tod IS NULL OR (c.off <> '' AND shift IS NULL) OR (c.off = '' AND zone IS NULL) THEN 'bad'
                     WHEN df <> mf THEN 'both' ELSE 'plain' END AS kind FROM f),
v AS (SELECT source, count(*) FILTER (WHERE mf IS NULL) AS days, count(*) FILTER (WHERE df IS NULL) AS months FROM k WHERE kind = 'plain' AND g.y5 <> '' GROUP BY source),
r AS (SELECT stamp_id, zone, t, kind, secs, shift, CASE WHEN kind <> 'both' THEN kind WHEN coalesce(days, 0) = coalesce(months, 0) THEN 'default' ELSE 'votes' END AS rule,
             CAST(CASE WHEN kind = 'both' AND coalesce(months, 0) > coalesce(days, 0) THEN mf ELSE coalesce(df, mf) END AS TIMESTAMP) + to_seconds(tod) AS wall
      FROM k LEFT JOIN v ON k.source IS NOT DISTINCT FROM v.source),
b AS (SELECT *, wall + (wall - INTERVAL 2 DAY - timezone(zone, timezone('UTC', wall - INTERVAL 2 DAY))) AS c0, wall + (wall + INTERVAL 2 DAY - timezone(zone, timezone('UTC', wall + INTERVAL 2 DAY))) AS c1
      FROM r WHERE rule NOT IN ('bad', 'epoch') AND shift IS NULL),
p AS (SELECT *, timezone(zone, timezone('UTC', c0)) = wall AS fits0, timezone(zone, timezone('UTC', c1)) = wall AS fits1 FROM b)
SELECT stamp_id, CASE WHEN rule = 'epoch' THEN CAST(t AS BIGINT) * (CASE WHEN secs THEN 1000000 ELSE 1000 END) WHEN rule <> 'bad' THEN epoch_us(wall) - CAST(shift AS BIGINT) * 1000000 END AS utc_us,
       rule, rule IN ('votes', 'default') AS ambiguous FROM r WHERE rule IN ('bad', 'epoch') OR shift IS NOT NULL
UNION ALL
SELECT stamp_id, epoch_us(CASE WHEN fits0 AND NOT fits1 THEN c0 ELSE c1 END), rule, rule <> 'plain' OR (c0 <> c1 AND fits0 = fits1) FROM p
"""

_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) x(k, r)),
b AS (SELECT *, row_number() OVER w AS place, lag(role) OVER w AS above, lead(role) OVER w AS below,
             regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|TURN\])', '\1\\\2\3', 'g') AS quoted FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
p AS (SELECT *, CASE WHEN above = role THEN '[TURN]' WHEN role = 'assistant' THEN '' WHEN role = 'user' THEN '[INST]' ELSE '[INST][ROLE]' || role || '[/ROLE]' END
             || quoted || CASE WHEN below = role THEN '' WHEN role = 'assistant' THEN '</s>' ELSE '[/INST]' END AS piece FROM b)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
       CAST(3 + sum(length(piece)) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""

SQL = {
    "op5_warc_dictionary": _WARC,
    "op6_fair_mix": _MIX,
    "op7_compacted_shards": "SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes, sha256(coalesce(text, '')) AS text_sha256, true AS compacted FROM documents",
    "op9_exact_dedup": _DEDUP,
    "op12_offset_stamps": _STAMPS,
    "op13_chat_template": _CHAT,
}
