"""DuckDB SQL for the registered queries of this package that SQL can express."""

OP4 = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), p AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
        3.0::DOUBLE * source_size AS most
    FROM p
), l AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER (
            ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (
            ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w
), t AS (
    SELECT source, source_size,
        least(most, weight * max(level) FILTER (WHERE level * weight <= most) OVER ()) AS target
    FROM l
), k AS (
    SELECT d.*, t.source_size, t.target,
        lpad(length(bin(size))::VARCHAR, 2, '0') || rpad(substr(bin(size), 1, 4), 4, '0') AS class,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 64 AS slice,
        (('0x' || substr(md5('7:' || coalesce(d.source, '')), 1, 8))::BIGINT % 1048576)::DOUBLE / 1048576 AS start,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each_copies
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
    SELECT *, row_number() OVER (
        PARTITION BY source ORDER BY class DESC, slice, doc_id ASC NULLS FIRST, size) AS place
    FROM k
), c AS (
    SELECT *, (floor(place * each_copies + start) - floor((place - 1) * each_copies + start))::BIGINT AS copies FROM r
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM c
"""

OP7 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), listed AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces
), spread AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM listed
), grams AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM spread, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(words)
), f AS (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), often AS (
    SELECT * FROM f WHERE f >= 30
), cuts AS (
    SELECT o.lang, o.size, o.phrase, o.f AS a, k, string_split(o.phrase, ' ') AS w
    FROM often o, (SELECT unnest([1, 2, 3]) AS k) WHERE k < o.size
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, h.f AS l, t.f AS r,
        ((2000000::HUGEINT * c.a) // (h.f::HUGEINT + t.f))::BIGINT AS score
    FROM cuts c JOIN often h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[:c.k], ' ')
    JOIN often t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[c.k + 1:], ' ')
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, f, string_split(phrase, ' ') AS w, unnest(range(1, size + 1)) AS s, size FROM often WHERE size > 2
), covers AS (
    SELECT lang, array_to_string(w[s:e], ' ') AS phrase, max(f) AS longer
    FROM inside, (SELECT unnest([2, 3, 4]) AS e) WHERE e > s AND e <= size AND e - s + 1 < size GROUP BY ALL
), kept AS (
    SELECT w.* FROM weakest w LEFT JOIN covers c ON c.lang = w.lang AND c.phrase = w.phrase
    WHERE c.longer IS NULL OR 100::HUGEINT * c.longer < 80::HUGEINT * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT k.*, t.n, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM kept k JOIN totals t ON t.lang = k.lang
) WHERE rank <= 2000
"""

OP12 = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), degree AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
), component AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN degree ON a = vec_id
"""

ORACLES: dict[str, str] = {
    "op4_source_mix": OP4,
    "op7_top_k": OP7,
    "op11_collocations": OP11,
    "op12_embedding_near_dedup": OP12,
}
