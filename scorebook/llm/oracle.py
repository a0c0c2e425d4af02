"""DuckDB twins of the queries that SQL can express over whole tables."""

from __future__ import annotations

import itertools

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ORDERS = ", ".join(f"('{''.join(p)}')" for p in itertools.permutations("ABCDE"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Every round as its own tables: the parts' nearest entries, then the floored means."""
    distance = "CAST(list_sum(list_transform(range(1, len(xs) + 1), lambda k: (xs[k] - c[k]) * (xs[k] - c[k]))) AS BIGINT)"
    steps = []
    for r in range(rounds + 1):
        found = (f"f{r} AS MATERIALIZED (SELECT id, p, vec_id, label, xs, arg_min(e, d * 100 + e) AS e, min(d) AS d "
                 f"FROM (SELECT x.*, e, {distance} AS d FROM x JOIN b{r} USING (p)) GROUP BY id, p, vec_id, label, xs)")
        means = (f"m{r} AS (SELECT p, e, list(v ORDER BY k) AS c FROM (SELECT p, e, k, CAST(floor(CAST(sum(xs[k]) AS DOUBLE) / count(*)) AS BIGINT) AS v "
                 f"FROM (SELECT p, e, xs, unnest(range(1, len(xs) + 1)) AS k FROM f{r}) GROUP BY p, e, k) GROUP BY p, e), "
                 f"b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} USING (p, e))")
        steps += [found, means] if r < rounds else [found]
    return f"""
        WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
                          list_transform(embedding, lambda y: CAST(floor({scale} * CAST(y AS DOUBLE)) AS BIGINT)) AS z
                   FROM embeddings WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
        x AS MATERIALIZED (SELECT id, vec_id, label, p, z[p * (len(z) // {parts}) + 1 : (p + 1) * (len(z) // {parts})] AS xs
              FROM v, (SELECT unnest(range(0, {parts})) AS p)),
        b0 AS MATERIALIZED (SELECT p, id AS e, xs AS c FROM x WHERE id < {entries}),
        {", ".join(steps)},
        r AS (SELECT id, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
              FROM f{rounds} GROUP BY id, vec_id, label),
        g AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM r GROUP BY label),
        s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, label_error, codebooks_sha256
        FROM r JOIN g ON r.label IS NOT DISTINCT FROM g.label, s"""


ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50),
        win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM spots),
        least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
        bad AS (SELECT w.doc_id, w.i FROM win w JOIN least USING (h) WHERE m < w.doc_id),
        gone AS (SELECT DISTINCT doc_id, i + k AS p FROM bad, (SELECT unnest(range(0, 50)) AS k)),
        g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
        pos AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op5_embedding_near_dup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b
              ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
        r(u, w) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u),
        c AS (SELECT u, min(w) AS component_id FROM r GROUP BY u),
        n AS (SELECT u, count(*) AS k FROM l GROUP BY u)
        SELECT vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN c ON c.u = vec_id LEFT JOIN n ON n.u = vec_id""",
    "op7_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        bi AS (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
               FROM b WHERE len(ws) > 0),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS t FROM bi),
        di AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
               FROM d JOIN (SELECT DISTINCT n FROM bw) ON len(ws) >= n),
        dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS t FROM di),
        m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, t)),
        h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
        x AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY doc_id)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)""",
    "op8_warc_audit": """
        WITH r AS (SELECT page_id, CAST(floor(page_id / 1000) AS BIGINT) AS shard, page_id % 97 = 13 AND length(html) > 0 AS damaged,
                   'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
                   || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
                   || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10)
                   || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\\r\\n]', '', 'g') || chr(13) || chr(10)
                   || 'Content-Type: text/html' || chr(13) || chr(10)
                   || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
                   || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM pages)
        SELECT page_id, shard, 0 AS file, row_number() OVER w - 1 AS seq,
               CAST(coalesce(sum(strlen(rec)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
               CAST(strlen(rec) AS BIGINT) AS "length", sha256(rec) AS sha256, coalesce(damaged, false) AS damaged
        FROM r WINDOW w AS (PARTITION BY shard ORDER BY page_id, rec)""",
    "op12_filter_audit": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
        w AS (SELECT doc_id, t, part, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS m FROM d),
        l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
                            100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
                            regexp_matches(t, '[#$%&*|]'), coalesce(m < w.doc_id, false)] AS fails,
                     coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
              FROM w LEFT JOIN l USING (doc_id)),
        c AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY part, fails),
        o AS (SELECT col0 AS filter_order, unnest(range(1, 6)) AS step FROM (VALUES {_ORDERS})),
        j AS (SELECT part, filter_order, step, n, good, toxic, fails[ord(filter_order[step]) - 64] AS here,
                     len(list_filter(range(1, step), lambda k: fails[ord(filter_order[k]) - 64])) > 0 AS before,
                     len(list_filter(fails, lambda x: x)) = 1 AS lone
              FROM c, o),
        s AS (SELECT part, filter_order, step,
                     coalesce(sum(n) FILTER (NOT here AND NOT before), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT before), 0) AS removed,
                     coalesce(sum(n) FILTER (here AND before), 0) AS redundant, coalesce(sum(n) FILTER (here AND lone), 0) AS unique_fails,
                     coalesce(sum(good) FILTER (here AND NOT before), 0) AS good_lost,
                     coalesce(sum(toxic) FILTER (here AND NOT before), 0) AS toxic_lost
              FROM j GROUP BY part, filter_order, step)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
        FROM s""",
    "op13_vector_codes": _codes_sql(),
}
