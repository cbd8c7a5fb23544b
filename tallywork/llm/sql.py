"""DuckDB SQL for the queries that SQL can express."""

from tallywork.llm import chat, mixing

MIX = f"""
WITH docs AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           ('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
    FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
sources AS (
    SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
           [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM totals
),
steps AS (  -- the sources that fill up first, in turn, and what is left for the others by weight
    SELECT cap / weight AS until, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k,
           coalesce(sum(cap) OVER before, 0) AS full_words,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
           {mixing.SHARE}::DOUBLE * sum(source_size) OVER () AS wanted
    FROM sources
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
    SELECT arg_min((wanted - full_words) / open_weight, k) AS level
    FROM steps WHERE (wanted - full_words) / open_weight <= until
),
targets AS (
    SELECT source, source_size, least(cap, weight * coalesce(level, 'infinity'::DOUBLE)) AS target
    FROM sources, level
),
plan AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole
    FROM targets
),
placed AS (
    SELECT d.doc_id, d.size, p.source_size, p.target, p.whole::BIGINT AS whole,
           p.target - p.whole * p.source_size AS need,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) AS up_to,
           sum(d.size) OVER (PARTITION BY d.source, d.place) AS here
    FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN 2 * up_to - here <= 2 * need THEN 1 ELSE 0 END) AS taken
FROM placed
"""

TOP_K = """
WITH parts AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
),
rows AS (
    SELECT vec_id, list_transform(e, lambda x: floor(1024 * x)::DOUBLE) AS v
    FROM parts
    WHERE vec_id IS NOT NULL AND e IS NOT NULL
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.v, c.v)::BIGINT AS score
    FROM rows q JOIN rows c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
           vec_id, score
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")


def _escaped_length(text: str) -> str:
    """Length of an escaped text: one more character for each backslash and each control string."""
    more = [f"(len({text}) - len(replace({text}, '{c}', ''))) / {len(c)}" for c in ("\\", *_CONTROL)]
    return f"len({text}) + " + " + ".join(more)


_MARKS = sum(map(len, (chat.ChatTemplate.opening, chat.ChatTemplate.before_text, chat.ChatTemplate.closing)))

CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
moves AS (
    SELECT *, coalesce(lag(role) OVER in_order, 'start') AS before
    FROM turns
    WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
           AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
           FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({_MARKS} + {_escaped_length('role')} + {_escaped_length('text')})::BIGINT AS formatted_chars,
       bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'),
                                   ('user', 'assistant'), ('assistant', 'user')))
           AND last(role ORDER BY turn NULLS FIRST, role, text) = 'assistant' AS valid
FROM moves
GROUP BY conv_id
"""


def _round(n: int) -> str:
    """Nearest centroids of round ``n``, and the centroids after it."""
    return f"""
near{n} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v,
           arg_min(c, struct_pack(gap, c)) AS c, min(gap) AS gap
    FROM (
        SELECT r, vec_id, p.v, c,
               (list_inner_product(p.v, p.v) + list_inner_product(q.v, q.v)
                - 2 * list_inner_product(p.v, q.v))::BIGINT AS gap
        FROM points p CROSS JOIN centroids{n} q
    )
    GROUP BY r
),
centroids{n + 1} AS MATERIALIZED (
    SELECT c, coalesce(m.v, q.v) AS v
    FROM centroids{n} q LEFT JOIN (
        SELECT c, list(mean ORDER BY i) AS v
        FROM (
            SELECT c, i, floor(sum(v[i]) / count(*)) AS mean
            FROM near{n}, (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i
        )
        GROUP BY c
    ) m USING (c)
)"""


CENTROIDS = f"""
WITH parts AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
),
points AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: floor(64 * x)) AS v
    FROM parts
    WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
centroids0 AS MATERIALIZED (
    SELECT (row_number() OVER seeds - 1)::INTEGER AS c, v FROM points
    WINDOW seeds AS (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) QUALIFY c < 16
),
{",".join(map(_round, range(4)))}
SELECT vec_id, c AS cluster, gap AS distance,
       sum(gap) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(gap) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(q.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM near3 JOIN centroids3 q USING (c)
"""
