"""DuckDB SQL for the operators that SQL can express."""

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

URL_FILTER = r"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), tails AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
    FROM tails
)
SELECT page_id, host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
    coalesce(arg_max(r_verdict, length(r_host || r_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
GROUP BY page_id, host, path
"""

MIX_SOURCES = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sizes GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][1 + (place - 1) % 3] AS weight, 2 * source_size AS cap FROM sources
), steps AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)::DOUBLE)
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS step
    FROM weighed
    WINDOW before AS (ORDER BY cap * (6 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(cap::DOUBLE, weight * max(step) OVER ()) AS target FROM steps
), drawn AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        ('0x' || substr(md5('0:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM drawn
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents
), found AS (
    SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 30
), sides AS (
    SELECT DISTINCT lang, source, false AS whole FROM docs UNION ALL SELECT DISTINCT lang, NULL, true FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term
), filled AS (
    SELECT s.lang, s.source, s.whole, k.term, CASE WHEN s.whole THEN k.n ELSE coalesce(c.n, 0) END AS n
    FROM sides s JOIN kept k ON s.lang = k.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), priced AS (
    SELECT *, (1 + (1000000000::HUGEINT * (n + 5)::HUGEINT)
        // (sum(n) OVER side + 5 * count(*) OVER side)::HUGEINT)::BIGINT AS p
    FROM filled WINDOW side AS (PARTITION BY lang, source, whole)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
    SELECT g.lang, g.source, 'term' AS part, g.term AS item, g.p - l.p AS value
    FROM priced g JOIN priced l ON g.lang = l.lang AND g.term = l.term AND NOT g.whole AND l.whole
    WHERE g.n > 0 AND g.p > l.p
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (FROM pairs UNION ALL FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def _assigned(r: int) -> str:
    """Round r: the nearest centroid (squared distance, number) of every vector."""
    square = "list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    return f"""near{r} AS MATERIALIZED (
    SELECT row, any_value(kept.vec_id) AS vec_id, any_value(kept.v) AS v, min({{'d': {square}, 'k': c.k}}) AS best
    FROM kept, centroids{r} c GROUP BY row
)"""


def _moved(r: int) -> str:
    """The centroids after round r."""
    floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
    return f"""centroids{r + 1} AS MATERIALIZED (
    SELECT c.k, coalesce(m.v, c.v) AS v FROM centroids{r} c LEFT JOIN (
        SELECT k, list({floor} ORDER BY i) AS v FROM (
            SELECT best.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM near{r}, range(1, 65) t(i) GROUP BY ALL
        ) GROUP BY k
    ) m ON c.k = m.k
)"""


CENTROID_CLUSTERS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64
), centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v
    FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 40)
), {", ".join(f"{_assigned(r)}, {_moved(r)}" for r in range(5))}, {_assigned(5)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia,
    sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near5 JOIN centroids5 c ON best.k = c.k
"""

ORACLE = {
    "op5_mix_sources": MIX_SOURCES,
    "op8_line_dedup": LINE_DEDUP,
    "op9_url_filter": URL_FILTER,
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_centroid_clusters": CENTROID_CLUSTERS,
}
