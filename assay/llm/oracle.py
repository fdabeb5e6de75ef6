"""The registered queries in DuckDB's SQL, where it can express them."""

from .mixing import BLOCK_DOCS, WEIGHTS

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_POOLS = ", ".join(f"('{n}', {i}, {WEIGHTS[n]})" for i, n in enumerate(sorted(WEIGHTS), 1))

_ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
           r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?"""
           r"""([A-Za-z0-9+/_.=-]+)""")


def _matches(order: int, pattern: str, group: int, least: int) -> str:
    return f"""
SELECT doc_id, {order} AS kind, {least} AS least, unnest(range(len(gaps))) AS i,
       unnest(gaps) AS gap, unnest(found) AS found, unnest(judged) AS judged
FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps,
             regexp_extract_all(t, '{pattern}', 0) AS found,
             regexp_extract_all(t, '{pattern}', {group}) AS judged
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))"""

_TERMS = (f"regexp_extract_all(translate(text, {_LOWER}), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


ORACLE = {
    "op2_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND
           len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
             ::INTEGER AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 20""",
    "op5_mixing": f"""
WITH RECURSIVE named(source, pool, weight) AS (VALUES {_POOLS}),
sources AS (
  SELECT source, coalesce(weight, 1) AS weight, row_number() OVER (
           ORDER BY pool NULLS LAST, (count(*) - 1) // {BLOCK_DOCS} DESC,
                    md5(coalesce('=' || source, ''))) AS pool
  FROM documents LEFT JOIN named USING (source) GROUP BY source, named.pool, named.weight),
d AS (
  SELECT doc_id, documents.source, pool, weight, row_number() OVER (
           PARTITION BY pool ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS rank
  FROM documents JOIN sources ON documents.source IS NOT DISTINCT FROM sources.source),
b AS (SELECT pool, weight, max(rank) // {BLOCK_DOCS} + 1 AS n FROM d GROUP BY ALL),
cuts AS (SELECT 0 AS first UNION SELECT n // weight FROM b UNION SELECT n // weight + 1 FROM b),
spans AS (SELECT first, lead(first) OVER (ORDER BY first) AS next FROM cuts),
c AS (SELECT first, next, list(greatest(0, least(weight, n - first * weight)) ORDER BY pool) AS cs,
             list(pool ORDER BY pool) AS pools,
             sum(greatest(0, least(weight, n - first * weight)))::BIGINT AS q
      FROM spans, b WHERE next IS NOT NULL GROUP BY ALL HAVING q > 0),
shapes AS (SELECT *, coalesce(sum((next - first) * q) OVER (
             ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
           FROM c),
run AS (
  SELECT first, q, cs, 0::BIGINT AS t, list_transform(cs, lambda x: 0::BIGINT) AS done,
         NULL::BIGINT AS p FROM shapes
  UNION ALL
  SELECT first, q, cs, t + 1, list_transform(range(len(cs)), lambda i:
           done[i + 1] + CASE WHEN i = pick THEN 1 ELSE 0 END), pick
  FROM (SELECT *, list_min(list_filter(list_transform(range(len(cs)), lambda i:
            CASE WHEN done[i + 1] < cs[i + 1] AND done[i + 1] * q // cs[i + 1] <= t
                 THEN ((done[i + 1] + 1) * q + cs[i + 1] - 1) // cs[i + 1] * 10000 + i END),
          lambda x: x IS NOT NULL)) % 10000 AS pick FROM run WHERE t < q)),
placed AS (SELECT run.first, next, before, run.q, pools[p + 1] AS pool, run.cs[p + 1] AS c,
                  done[p + 1] - 1 AS k, t - 1 AS place
           FROM run JOIN shapes USING (first) WHERE p IS NOT NULL),
e AS (SELECT *, rank // {BLOCK_DOCS} AS block, rank // {BLOCK_DOCS} // weight AS round,
             rank // {BLOCK_DOCS} % weight AS k FROM d)
SELECT doc_id, source, block, before + (round - first) * q + e.k * q // c AS release,
       before + (round - first) * q + ((e.k + 1) * q + c - 1) // c AS deadline,
       before + (round - first) * q + place AS slot,
       (before + (round - first) * q + place) * {BLOCK_DOCS} + rank % {BLOCK_DOCS} AS position
FROM e JOIN placed p ON p.pool = e.pool AND p.k = e.k AND round >= first AND round < next""",
    "op7_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS d
           FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE bytes >= 100 GROUP BY d)
SELECT page_id, bytes AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op8_repeats": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
f AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM g JOIN f USING (h)
         WHERE doc_id > first),
k AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
j AS (SELECT k.doc_id, count(*) AS n,
             string_agg(word, ' ' ORDER BY k.i) FILTER (WHERE gone.i IS NULL) AS kept,
             count(gone.i) AS removed
      FROM k LEFT JOIN gone ON gone.doc_id = k.doc_id AND gone.i = k.i GROUP BY k.doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_words, coalesce(removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN j USING (doc_id)""",
    "op9_secrets": f"""
WITH m AS ({_matches(0, _ASSIGN, 2, 6)} UNION ALL {_matches(1, "AKIA[A-Z0-9]+", 0, 20)}
           UNION ALL {_matches(2, "[0-9a-f]+", 0, 24)}),
located AS (SELECT *, sum(length(gap)) OVER w + coalesce(sum(length(found)) OVER (
         PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS start FROM m WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i)),
hit AS (SELECT doc_id, kind, start::BIGINT AS s, (start + length(found))::BIGINT AS e
        FROM located WHERE length(judged) >= least),
r AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b,
             count(*) FILTER (WHERE kind = 2) AS c,
             string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || s || ':' || e, ','
                        ORDER BY s, kind) AS spans
      FROM hit GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM documents LEFT JOIN r USING (doc_id)""",
    "op10_lines": rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
                          '[\x20\x09-\x0D]+\z', ''), {_LOWER}) AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, first IS NOT NULL AND doc_id > first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM j GROUP BY doc_id""",
    "op12_lexical": f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY doc_id),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM p, g GROUP BY term, docs),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) //
             (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (doc_id), g
      GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
             ::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10""",
}
