"""DuckDB SQL for the queries that SQL can express, from their definitions."""

from __future__ import annotations

from raresift.llm.warc import BLOCK_TAGS, DATE, ENTITIES, HTML_TYPE


def _uuid(text: str) -> str:
    mark = f"sha256({text})"
    cuts = ", ".join(f"substr({mark}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || concat_ws('-', {cuts}) || '>'"


def _text(html: str) -> str:
    for pattern in ("(?s)<!--.*?-->", "(?is)<script[^>]*>.*?</script[^>]*>", "(?is)<style[^>]*>.*?</style[^>]*>"):
        html = f"regexp_replace({html}, '{pattern}', '', 'g')"
    html = f"regexp_replace({html}, '(?i)</?(?:{BLOCK_TAGS})(?:[\\s/][^>]*)?>', chr(10), 'g')"
    html = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for entity, char in ENTITIES:
        char = char.replace("'", "''")
        html = f"replace({html}, '{entity}', '{char}')"
    html = f"regexp_replace({html}, '[ \\t\\r\\f]+', ' ', 'g')"
    html = f"regexp_replace({html}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"trim({html}, ' ' || chr(10))"


_CRLF = "chr(13) || chr(10)"

OP5 = f"""
WITH pages_in AS (
    SELECT page_id, url AS target_uri, coalesce(html, '') AS payload FROM pages
), response AS (
    SELECT *, {_uuid("'response' || chr(10) || coalesce(page_id::VARCHAR, '') || chr(10) || coalesce(target_uri, '') || chr(10) || payload")} AS refers_to,
        'sha256:' || sha256(payload) AS source_digest, strlen(payload) AS source_length
    FROM pages_in
), parts AS (
    SELECT *, {_uuid("'conversion' || chr(10) || refers_to")} AS conversion_id,
        {_uuid("'metadata' || chr(10) || refers_to")} AS metadata_id,
        trim(regexp_extract(payload, '<title[^>]*>([^<]*)</title', 1, 'is')) AS title,
        regexp_extract(payload, '<html[^>]*\\slang="([^"]*)"', 1, 'i') AS lang,
        regexp_extract_all(payload, '(?i)<a\\s[^>]*href="([^"]*)"', 1) AS links,
        {_text("payload")} AS body
    FROM response
), blocks AS (
    SELECT *, 'source-payload-digest: ' || source_digest || {_CRLF} || 'source-payload-length: ' || source_length || {_CRLF}
        || 'conversion: ' || conversion_id || {_CRLF} || 'title: ' || title || {_CRLF} || 'language: ' || lang || {_CRLF}
        || 'source-header: HTTP/1.1 200 OK' || {_CRLF} || 'source-header: Content-Type: {HTML_TYPE}' || {_CRLF}
        || 'source-header: Content-Length: ' || source_length || {_CRLF}
        || coalesce(array_to_string(list_transform(links, lambda x: 'outlink: ' || x || {_CRLF}), ''), '') AS fields
    FROM parts
), records AS (
    SELECT page_id, 'metadata' AS warc_type, metadata_id AS record_id, refers_to, target_uri, 'application/warc-fields' AS content_type,
        fields AS block, source_digest FROM blocks
    UNION ALL
    SELECT page_id, 'conversion', conversion_id, refers_to, target_uri, 'text/plain', body, source_digest FROM blocks
), digests AS (
    SELECT *, strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest FROM records
)
SELECT page_id, warc_type, record_id, refers_to, target_uri, '{DATE}' AS warc_date, content_type, content_length, block_digest, source_digest,
    sha256('WARC/1.1' || {_CRLF} || 'WARC-Type: ' || warc_type || {_CRLF} || 'WARC-Record-ID: ' || record_id || {_CRLF}
        || 'WARC-Refers-To: ' || refers_to || {_CRLF} || coalesce('WARC-Target-URI: ' || target_uri || {_CRLF}, '')
        || 'WARC-Date: {DATE}' || {_CRLF} || 'WARC-Block-Digest: ' || block_digest || {_CRLF} || 'Content-Type: ' || content_type || {_CRLF}
        || 'Content-Length: ' || content_length || {_CRLF} || {_CRLF} || block || {_CRLF} || {_CRLF}) AS record_sha256
FROM digests
"""

_COMPONENTS = """
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(node, least) AS (
    SELECT a, a FROM both_ways
    UNION
    SELECT w.b, r.least FROM reach r JOIN both_ways w ON w.a = r.node WHERE r.least < w.b
), named AS (
    SELECT node, min(least) AS component FROM reach GROUP BY node
)
"""

OP1 = f"""
WITH RECURSIVE good AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98
{_COMPONENTS}
SELECT vec_id, coalesce((SELECT count(*) FROM links WHERE a = vec_id), 0)::BIGINT AS n_links,
    coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN named ON node = vec_id
"""

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents
), windows AS (
    SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d)
), again AS (
    SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM windows SEMI JOIN again USING (h)
), kept AS (
    SELECT t.doc_id, count(*) AS n, string_agg(t.word, ' ' ORDER BY t.p) AS text
    FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) t ANTI JOIN gone g ON g.doc_id = t.doc_id AND g.p = t.p
    GROUP BY t.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{_SPACED}') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
    UNION ALL
    SELECT doc_id, md5(array_to_string(w, ' ')) FROM d WHERE len(w) BETWEEN 1 AND 2
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
{_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id, d.doc_id = coalesce(component, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN named ON node = d.doc_id
"""

OP6 = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents
), i AS (
    SELECT item_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS t
    FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)
), dw AS (
    SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS t
    FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
), found AS (
    SELECT doc_id, s, k, item_id FROM dw JOIN iw USING (k, t)
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _crc32(data: str) -> str:
    """CRC-32 of a list of bytes."""
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {step}), 4294967295::BIGINT)"


OP11 = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all({_AZ.format("text")}, '[a-z\u00c0-\u00ff]+')) AS run FROM documents) GROUP BY doc_id, run
), drawn AS (
    SELECT run, n, {_crc32("""flatten(list_transform(string_split(doc_id || ':' || run, ''),
        lambda s: CASE WHEN ord(s) < 128 THEN [ord(s)::BIGINT] ELSE [195::BIGINT, ord(s)::BIGINT - 64] END))""")} AS h FROM runs
), vocabulary AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM drawn GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), shorter AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN vocabulary b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN vocabulary b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word
), judged AS (
    SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
        CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
    FROM vocabulary v LEFT JOIN best USING (word)
), followed(word, root) AS (
    SELECT word, word FROM judged WHERE form IS NULL
    UNION ALL
    SELECT j.word, f.root FROM followed f JOIN judged j ON j.form = f.word
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN followed USING (word)
"""

OP12 = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""


OP13 = f"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w,
        {_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)")} AS h
    FROM documents
), drawn AS (
    SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split
), d AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN w
        ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1]) END AS w
    FROM drawn
), grams AS (
    SELECT doc_id, n, i, md5(array_to_string(w[i + 1:i + 5], ' ')) AS k FROM (SELECT *, unnest(range(0, n - 4)) AS i FROM d WHERE n > 5)
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS text
    FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d) t ANTI JOIN gone g ON g.doc_id = t.doc_id AND g.i = t.i
    GROUP BY t.doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
        first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS longest
    FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, longest.s::BIGINT AS start, longest.l::BIGINT AS length, longest.p::BIGINT AS period,
    (1000 * longest.l // longest.p)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_embeddings": OP1,
    "op2_repeats": OP2,
    "op4_near_duplicates": OP4,
    "op5_warc": OP5,
    "op6_decontamination": OP6,
    "op11_spelling_variants": OP11,
    "op12_exact_dedup": OP12,
    "op13_periodic_runs": OP13,
}
