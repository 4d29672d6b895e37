"""DuckDB SQL of the operators whose SQL is long."""

from __future__ import annotations


def codes_sql(rounds: int = 6) -> str:
    """Each round as tables of its own: whole searches, floors of means, entries that nothing uses kept."""
    dist = "list_sum([(p.v[i] - e.v[i]) * (p.v[i] - e.v[i]) FOR i IN range(1, len(p.v) + 1)])"
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS r, [CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT) FOR x IN embedding] AS q FROM embeddings"
        " WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        "parts AS MATERIALIZED (SELECT r, s, q[s * (len(q) // 8) + 1 : (s + 1) * (len(q) // 8)] AS v FROM kept, range(8) t(s))",
        "e0 AS MATERIALIZED (SELECT s, k, v FROM (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS k FROM kept) JOIN parts USING (r) WHERE k < 16)",
    ]
    for n in range(rounds + 1):
        steps.append(f"b{n} AS MATERIALIZED (SELECT r, p.s, min(CAST({dist} AS HUGEINT) * 16 + k) AS best FROM parts p JOIN e{n} e ON p.s = e.s GROUP BY r, p.s)")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT s, k, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM (
                SELECT s, CAST(best % 16 AS BIGINT) AS k, i, sum(v[i])::HUGEINT AS total, count(*)::HUGEINT AS n FROM b{n} JOIN parts USING (r, s), range(1, len(v) + 1) t(i) GROUP BY ALL) GROUP BY ALL)""")
            steps.append(f"e{n + 1} AS MATERIALIZED (SELECT e.s, e.k, coalesce(m.v, e.v)::BIGINT[] AS v FROM e{n} e LEFT JOIN m{n} m ON e.s = m.s AND e.k = m.k)")
    return f"""
        WITH {', '.join(steps)},
             c AS (SELECT r, string_agg(printf('%02x', CAST(best % 16 AS INT)), '' ORDER BY s) AS code, CAST(sum(best // 16) AS BIGINT) AS error FROM b{rounds} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY s, k, i)) FROM (SELECT s, k, unnest(v) AS x, unnest(range(len(v))) AS i FROM e{rounds})) AS codebooks_sha256
        FROM kept JOIN c USING (r)"""


def repair_sql() -> str:
    """Damage, faults, and the cheapest edits by a recursion over the turns: of each conversation and place of the grammar the least cost and audit."""
    bit = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    crc = f"xor(list_reduce([4294967295::BIGINT] || [ord(c)::BIGINT FOR c IN string_split(key, '')], lambda h, b : list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i : {bit})), 4294967295)"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    # What may stand at a place next, of which s can't be made by an edit.
    nexts = "(VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) t(place, role_to)"
    least = lambda source: f"SELECT conv_id, i, place, min(w) AS w FROM ({source}) GROUP BY ALL"
    # A way is its cost in eight digits and its audit, so the least text is the cheapest way of least audit.
    more = lambda n, sign: f"printf('%08d', CAST(left(w, 8) AS BIGINT) + {n}) || substr(w, 9) || {sign}"
    inserted = lambda source: least(f"SELECT conv_id, i, place, w FROM ({source}) UNION ALL SELECT conv_id, i, role_to, {more(5, chr(39) + 'I' + chr(39))} FROM ({source}) JOIN {nexts} USING (place) WHERE role_to <> 's'")
    return f"""
        WITH RECURSIVE d AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind
                  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations)), range(2) c(copy)
            WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, right(rtrim(text, {space}), 1) AS ending FROM d),
        f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM o),
        t AS MATERIALIZED (SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, CASE WHEN ending = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM f),
        z AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS place, '00000000' AS w FROM t),
        w AS (
            SELECT * FROM ({inserted(inserted('SELECT * FROM z'))})
            UNION ALL
            SELECT * FROM ({inserted(inserted(f'''
                SELECT w.conv_id, t.i, place, {more(2, "'D'")} AS w FROM w JOIN t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1
                UNION ALL SELECT w.conv_id, t.i, role_to, printf('%08d', CAST(left(w, 8) AS BIGINT) + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END + CASE WHEN initial = role_to THEN 0 ELSE 1 END) || substr(w, 9) || CASE WHEN initial = role_to THEN 'K' ELSE 'R' END
                FROM w JOIN t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1 JOIN {nexts} USING (place) WHERE fault NOT IN ('blank', 'duplicate') AND (initial = role_to OR role_to <> 's')'''))})),
        n AS (SELECT conv_id, max(i) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM t GROUP BY conv_id),
        g AS (SELECT conv_id, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT conv_id, i, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM t) GROUP BY conv_id),
        b AS (SELECT w.conv_id, min(w) AS w FROM w JOIN n ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.i = n.n WHERE place IN ('', 'a') GROUP BY w.conv_id),
        e AS (SELECT conv_id, substr(w, 9) AS audit, unnest(range(1, len(w) - 7)) AS j FROM b),
        x AS (SELECT conv_id, j, audit[j] AS sign, len(replace(left(audit, j), 'I', '')) AS i, len(replace(left(audit, j), 'D', '')) - 1 - len(replace(audit, 'D', '')) % 2 AS spot FROM e),
        l AS (SELECT x.conv_id, j, CASE WHEN sign = 'K' THEN role WHEN spot % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN sign = 'I' THEN '' ELSE text END AS line
              FROM x LEFT JOIN t ON x.conv_id IS NOT DISTINCT FROM t.conv_id AND x.i = t.i WHERE sign <> 'D'),
        r AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS whole FROM l GROUP BY conv_id)
        SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(CAST(left(w, 8) AS BIGINT), 0) AS cost, coalesce(substr(w, 9), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON a.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN g ON a.conv_id IS NOT DISTINCT FROM g.conv_id
             LEFT JOIN b ON a.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN r ON a.conv_id IS NOT DISTINCT FROM r.conv_id"""
