"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
win AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, a) AS n
    FROM (SELECT rid, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda k: w[k:k + 4])) AS a
          FROM d WHERE len(w) > 5)),
rep AS (
    SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM win WHERE n > 1) GROUP BY rid),
lines AS (
    SELECT rid, count(*) - count(DISTINCT l) AS n
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
    SELECT d.doc_id, d.source, len(d.w)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(d.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source),
s AS (SELECT sum(n) AS n, sum(f)::DOUBLE / sum(n) AS mean, count(*) AS k, sum(n * (f / n) * (f / n)) AS sq FROM h),
t AS (SELECT *, mean * (1 - mean) AS noise, sq / n - mean * mean - mean * (1 - mean) * k / n AS spread FROM s),
p AS (SELECT CASE WHEN noise = 0 THEN greatest(mean, 1e-9) ELSE mean * strength END AS alpha,
             CASE WHEN noise = 0 THEN greatest(1 - mean, 1e-9) ELSE (1 - mean) * strength END AS beta
      FROM (SELECT *, CASE WHEN spread > 0 THEN least(greatest(noise / spread - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM t)),
v AS (SELECT source, f + alpha AS a, n - f + beta AS c FROM h, p),
bad AS (SELECT source, a / (a + c) - 2 * sqrt(a * c / ((a + c) * (a + c) * (a + c + 1))) > 0.5 AS bad FROM v)
SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
       NOT b.base_failed AND NOT bad.bad AS kept
FROM b JOIN bad ON b.source IS NOT DISTINCT FROM bad.source
"""

OP4 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
win AS (
    SELECT DISTINCT item_id, len(a) AS n, array_to_string(a, ' ') AS k
    FROM (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS a FROM b WHERE len(w) > 0)),
occ AS (
    SELECT o.rid, o.i, o.n, win.item_id
    FROM (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i,
                 unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS k
          FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n) o
    JOIN win ON o.k = win.k AND o.n = win.n),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM occ) GROUP BY rid),
ids AS (
    SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""


def _escaped(column: str) -> str:
    """SQL of the template's escape; no control string overlaps itself, so one replacement of each is enough."""
    sql = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for c in ["<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]"]:
        sql = f"replace({sql}, '{c}', '{c[0]}\\-{c[1:]}')"
    return sql


OP5 = f"""
WITH c AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns,
           coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (role = 'assistant'), '') AS loss,
           sum(length('<|turn|><|text|><|end|>') + length({_escaped('role')}) + length({_escaped('text')})) AS n
    FROM c GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, (n + 3)::BIGINT AS formatted_chars
FROM t
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
best AS (SELECT html, max(page_id) AS best FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN best IS NULL OR best IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN best IS DISTINCT FROM page_id THEN best END AS refers_to
FROM p LEFT JOIN best ON p.html = best.html
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 (reflected polynomial 0xEDB88320) of a text's UTF-8 bytes, byte by byte through its table of 256
_CRC_TABLE = "SELECT list(c ORDER BY n) AS tab FROM (SELECT n, list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n) AS c FROM range(256) r(n))"
_CRC = ("xor(list_reduce(list_transform(range(0, strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT), "
        "lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1]), 4294967295), 4294967295)")

OP12 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
crc AS (SELECT f, {_CRC} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), ({_CRC_TABLE})),
s AS (SELECT bucket, count(*) AS n FROM df JOIN crc USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN crc USING (f) GROUP BY bucket),
n AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t),
gain AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (n.s + 10000) / ((s.n + 1)::DOUBLE * (n.t + 10000))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), n),
w AS (SELECT rid, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
    SELECT rid, doc_id, len(d.w) AS n_words, coalesce(w.n, 0) AS n_features, coalesce(w.weight, 0) AS weight,
           coalesce(w.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM d LEFT JOIN w USING (rid)),
able AS (
    SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, rank::BIGINT AS rank
FROM scored LEFT JOIN (SELECT rid, rank FROM able WHERE rank <= 25 * n // 100) USING (rid)
"""

OP13 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (
    SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + v.v) AS p,
           1 + 1000000000::HUGEINT * (kept.n + 1) // (v.n + v.v) AS q
    FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank
FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM every)
WHERE part = 'pair' OR rank <= 200
"""

SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op4_decontamination": OP4,
    "op5_chat": OP5,
    "op9_warc": OP9,
    "op12_importance_resampling": OP12,
    "op13_source_divergence": OP13,
}
