"""DuckDB SQL with the same result as the query of the same name."""

# A-Z and a-z are the only letters that translate here; lower() would change others too.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Words of 0-9, a-z and whatever is not ASCII, after lower-casing A-Z.
WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _lloyd(rounds: int = 4) -> str:
    """Rounds of assignment and update as a chain of common table expressions."""
    steps = [
        """
        v AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        parts AS MATERIALIZED (
            SELECT vec_id, p, list_slice(e, p * len(e) // 4 + 1, (p + 1) * len(e) // 4) AS x
            FROM v, (SELECT unnest(range(4)) AS p)
        ),
        b0 AS MATERIALIZED (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS c, x AS y
            FROM parts
            WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256)
        )"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
        a{i} AS MATERIALIZED (
            SELECT vec_id, p, any_value(x) AS x, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (
                SELECT vec_id, p, c, x,
                    list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM parts JOIN b{i} USING (p)
            )
            GROUP BY vec_id, p
        ),
        m{i} AS MATERIALIZED (
            SELECT p, c, list(mean ORDER BY i) AS y
            FROM (
                SELECT p, c, i, floor(sum(u)::DOUBLE / count(*))::BIGINT AS mean
                FROM (SELECT p, c, unnest(x) AS u, unnest(range(len(x))) AS i FROM a{i})
                GROUP BY p, c, i
            )
            GROUP BY p, c
        ),
        b{i + 1} AS MATERIALIZED (
            SELECT p, c, coalesce(m{i}.y, b{i}.y) AS y FROM b{i} LEFT JOIN m{i} USING (p, c)
        )"""
        )
    return "WITH" + ",".join(steps)


ORACLES = {
    "op6_exact_dedup": f"""
        WITH normal AS (SELECT doc_id, {LOWER} AS t FROM documents)
        SELECT
            doc_id,
            max(doc_id) OVER same AS keep_id,
            count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept,
            sha256(t) AS text_sha256
        FROM normal
        WINDOW same AS (PARTITION BY t)
    """,
    # What the formatted text is read back to is what went in; its length follows from the
    # marks of a turn (23 characters) and from one more character for each escape.
    "op9_chat": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        turns AS (
            SELECT
                conv_id,
                role,
                text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
                23 + length(role) + length(text) + len(regexp_extract_all(
                    role || chr(10) || text, '\\|<\||</?s>|<</?SYS>>|\[/?INST\]'
                )) AS chars
            FROM said
        )
        SELECT
            conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars
        FROM turns
        GROUP BY conv_id
    """,
    "op10_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
            FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id
            WHERE q.vec_id % 100 = 0
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_decontaminate": f"""
        WITH docs AS (SELECT row_number() OVER () AS place, doc_id, {WORDS} AS w FROM documents),
        items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, list_slice(w, i, least(i + 9, len(w))) AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
        ),
        words AS (SELECT place, unnest(w) AS word, unnest(range(len(w))) AS spot FROM docs),
        stretches AS (
            SELECT place, spot, list(word) OVER (
                PARTITION BY place ORDER BY spot ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING
            ) AS g
            FROM words
        ),
        sized AS (
            SELECT place, spot, n, array_to_string(list_slice(g, 1, n), ' ') AS g
            FROM stretches JOIN (SELECT DISTINCT len(g) AS n FROM windows) ON len(g) >= n
        ),
        hits AS (
            SELECT place, spot, n, item_id
            FROM sized JOIN (SELECT item_id, array_to_string(g, ' ') AS g FROM windows) USING (g)
        ),
        marked AS (
            SELECT place, count(DISTINCT spot) AS n_hit
            FROM (SELECT place, unnest(range(spot, spot + n)) AS spot FROM (SELECT DISTINCT place, spot, n FROM hits))
            GROUP BY place
        ),
        named AS (
            SELECT place, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM (SELECT DISTINCT place, item_id FROM hits)
            GROUP BY place
        )
        SELECT
            doc_id,
            len(w) AS n_words,
            coalesce(n_hit, 0) AS n_hit,
            coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256,
            n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN marked USING (place) LEFT JOIN named USING (place)
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT
                vec_id,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                list_inner_product(a.e, r.e)::BIGINT AS score
            FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id
            WHERE a.vec_id % 50 = 0
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored
            WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ),
        negatives AS (
            SELECT
                anchor_id,
                positive_id,
                row_number() OVER (
                    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id
                )::INT AS rank,
                vec_id AS negative_id,
                positive_score,
                score AS negative_score
            FROM positives JOIN scored USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        )
        SELECT * FROM negatives WHERE rank <= 3
    """,
    "op13_vector_codes": f"""
        {_lloyd()},
        coded AS (
            SELECT vec_id, string_agg(printf('%02x', c), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
            FROM a4
            GROUP BY vec_id
        ),
        books AS (
            SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, c)) AS codebooks_sha256 FROM b4
        )
        SELECT
            vec_id,
            code,
            error,
            (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            codebooks_sha256
        FROM coded JOIN v USING (vec_id), books
    """,
}
