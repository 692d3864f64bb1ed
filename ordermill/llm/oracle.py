"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations


def _share(name: str, children: str, parent: str, child: str) -> str:
    """Water filling of ``children`` (parent keys, child, weight, cap, budget)."""
    return f"""
        {name}_ranked AS (
            SELECT *, row_number() OVER o AS place,
                   greatest(budget - coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY CASE WHEN weight > 0
                       THEN cap::DOUBLE / weight::DOUBLE END NULLS LAST, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS rest,
                   sum(weight) OVER (PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN cap::DOUBLE / weight::DOUBLE END
                       NULLS LAST, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
            FROM {children}
            WINDOW o AS (PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN cap::DOUBLE / weight::DOUBLE END NULLS LAST, {child})),
        {name}_level AS (
            SELECT {parent}, min(place) AS first, arg_min(rest, place) AS level_rest, arg_min(weights, place) AS level_weights
            FROM {name}_ranked WHERE cap * weights > weight * rest GROUP BY {parent}),
        {name} AS (
            SELECT r.* EXCLUDE (place, rest, weights), CASE WHEN first IS NULL OR place < first THEN cap
                   ELSE coalesce(weight * level_rest // nullif(level_weights, 0), 0) END::HUGEINT AS share
            FROM {name}_ranked r LEFT JOIN {name}_level USING ({parent}))"""


_MIXING = rf"""
        WITH rows AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   coalesce('d' || (try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 4)::VARCHAR,
                            'other') AS domain,
                   length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'),
                                         '[\x20\x09-\x0D]+', '', 'g')) AS tokens
            FROM documents),
        leaves AS (SELECT domain, lang, source, sum(tokens) AS supply FROM rows GROUP BY ALL),
        domain_nodes AS (
            SELECT 0 AS root, domain, sum(supply) * 3 AS cap, (SELECT sum(supply) FROM leaves) AS budget,
                   coalesce(CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 END, 1)::HUGEINT AS weight
            FROM leaves GROUP BY domain),{_share("domains", "domain_nodes", "root", "domain")},
        lang_nodes AS (
            SELECT domain, lang, n.cap, share AS budget,
                   coalesce(CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 END, 1)::HUGEINT AS weight
            FROM (SELECT domain, lang, sum(supply) * 3 AS cap FROM leaves GROUP BY ALL) n
            JOIN domains d USING (domain)),{_share("langs", "lang_nodes", "domain", "lang")},
        source_nodes AS (
            SELECT l.domain, l.lang, l.source, l.supply, l.supply * 3 AS cap, share AS budget, 1::HUGEINT AS weight
            FROM leaves l JOIN langs USING (domain, lang)),{_share("sources", "source_nodes", "domain, lang", "source")},
        planned AS (
            SELECT domain, lang, source, share::BIGINT AS leaf_budget,
                   CASE WHEN supply > 0 THEN share // supply WHEN share > 0 THEN 1 ELSE 0 END::BIGINT AS whole,
                   CASE WHEN supply > 0 THEN share % supply ELSE 0 END::BIGINT AS rest
            FROM sources),
        running AS (
            SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
                       ORDER BY md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id
                       ROWS UNBOUNDED PRECEDING) AS upto
            FROM rows JOIN planned USING (domain, lang, source))
        SELECT doc_id, domain, lang, source, tokens, leaf_budget,
               unnest(range(whole + CASE WHEN upto <= rest AND rest > 0 THEN 1 ELSE 0 END))::BIGINT AS epoch
        FROM running
"""

def _clustering(rounds: int = 5, clusters: int = 40) -> str:
    """Lloyd's rounds over integer vectors, one set of tables a round."""
    parts = ["""
        usable AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: floor(256 * x)::BIGINT) AS v FROM usable),
        flat AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(v) AS x FROM vectors),
        centroids0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM vectors
            ORDER BY sha256('2:' || vec_id), v LIMIT %d)""" % clusters]
    for k in range(rounds + 1):
        parts.append(f"""
        near{k} AS MATERIALIZED (
            SELECT r, vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
                SELECT r, vec_id, c, list_sum(list_transform(list_zip(w.v, z.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
                FROM vectors w CROSS JOIN centroids{k} z) GROUP BY r, vec_id)""")
        if k < rounds:
            parts.append(f"""
        sums{k} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM near{k} JOIN flat USING (r) GROUP BY c, i),
        centroids{k + 1} AS MATERIALIZED (
            SELECT c, coalesce(m.v, z.v) AS v FROM centroids{k} z LEFT JOIN (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums{k} GROUP BY c) m USING (c))""")
    return f"""
        WITH {",".join(parts)}
        SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
        FROM near{rounds} JOIN centroids{rounds} USING (c)
    """


_SPELLING = r"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
        lowered AS (
            SELECT doc_id, word, count(*) AS n, encode(doc_id || ':' || word) AS bytes FROM (
                SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM runs)
            GROUP BY doc_id, word),
        summed AS (
            SELECT word, n, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(octet_length(bytes)), lambda k: ('0x' || substr(hex(bytes), 2 * k + 1, 2))::BIGINT)),
                lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                      lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
            FROM lowered),
        words AS MATERIALIZED (
            SELECT word, sum(n)::BIGINT AS n, length(word) AS len FROM (
                SELECT CASE WHEN crc % 97 = 0 THEN substr(word, 1, (crc % length(word))::INT) || substr(word, (crc % length(word))::INT + 2)
                            ELSE word END AS word, n FROM summed)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cut AS MATERIALIZED (
            SELECT word, n, len, k, substr(word, 1, k::INT) || '*' || substr(word, k::INT + 2) AS hole,
                   substr(word, 1, k::INT) || substr(word, k::INT + 2) AS rest
            FROM (SELECT *, unnest(range(len)) AS k FROM words)),
        half AS (
            SELECT DISTINCT c.word AS a, c.n AS a_n, w.word AS b, w.n AS b_n FROM cut c JOIN words w ON c.rest = w.word),
        near AS (
            SELECT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM cut a JOIN cut b ON a.hole = b.hole AND a.word <> b.word
            UNION ALL SELECT a, a_n, b, b_n FROM half UNION ALL SELECT b, b_n, a, a_n FROM half),
        best AS MATERIALIZED (
            SELECT a AS word, count(*) AS n_near, arg_min(b, (-b_n, b)) AS b, max(b_n) AS b_n, any_value(a_n) AS n FROM near GROUP BY a),
        forms AS MATERIALIZED (SELECT word, b AS form, b_n AS form_n FROM best WHERE b_n >= 2 * n),
        steps AS (
            SELECT word, form AS root, 1 AS step FROM forms
            UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON s.root = f.word),
        roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
        SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n
        FROM words w LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
"""

SQL = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER t AS keep_id,
               count(*) OVER t AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
    """,
    "op3_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        marked AS (
            SELECT *, role = 'assistant' AS loss,
                   length(regexp_replace(replace(text, '\', '\\'), '(\[|<)(ROLE\]|/?INST\]|/?s>)', '\1\\\2', 'g')) AS len,
                   length(regexp_replace(replace(role, '\', '\\'), '(\[|<)(ROLE\]|/?INST\]|/?s>)', '\1\\\2', 'g')) AS role_len
            FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (loss), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (loss), '')) AS loss_sha256,
               sum(CASE WHEN loss THEN len + 7 ELSE len + role_len + 19 END)::BIGINT AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op6_warc": """
        WITH sized AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest FROM pages),
        grouped AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
            FROM sized)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM grouped
    """,
    "op7_mixing": _MIXING,
    "op11_centroid_clustering": _clustering(),
    "op12_spelling_variants": _SPELLING,
}
