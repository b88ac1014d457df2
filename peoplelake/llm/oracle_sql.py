"""SQL of the queries that SQL can express, written apart from their operators."""

from __future__ import annotations

from peoplelake.llm.clusters import CLUSTERS, ROUNDS

TOP_K = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
        WHERE q.vec_id % 50 = 0
    ), r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _centroid_rounds(rounds: int) -> str:
    """a0, c1, a1, ...: assignments and centroids in turn; floor of a quotient of integers by its remainder."""
    squared = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
            SELECT vec_id, x, cluster, distance FROM (
                SELECT v.vec_id, v.x, c.cluster, CAST({squared} AS BIGINT) AS distance,
                       row_number() OVER (PARTITION BY v.n ORDER BY {squared}, c.cluster) AS place
                FROM v CROSS JOIN c{i} c
            ) WHERE place = 1
        )""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (
                SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
                    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS x FROM (
                        SELECT cluster, pos, sum(value) AS s, count(*) AS n
                        FROM (SELECT cluster, unnest(x) AS value, unnest(range(len(x))) AS pos FROM a{i}) GROUP BY cluster, pos
                    ) GROUP BY cluster
                ) m USING (cluster)
            )""")
    return ", ".join(out)


CLUSTER = f"""
    WITH v AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER () AS n
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), c0 AS MATERIALIZED (
        SELECT CAST(place - 1 AS INTEGER) AS cluster, x FROM (SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id), x) AS place FROM v) WHERE place <= {CLUSTERS}
    ), {_centroid_rounds(ROUNDS)}
    SELECT a.vec_id, a.cluster, a.distance,
           CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c.x, ',')) AS centroid_sha256
    FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)
"""


def _crc_steps() -> str:
    """The 256 remainders of CRC-32: eight shifts of every byte."""
    inner = "SELECT i, CAST(i AS BIGINT) AS v FROM (SELECT unnest(range(256)) AS i)"
    for _ in range(8):
        inner = f"SELECT i, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) AS v FROM ({inner})"
    return inner


def _with(state: str, cost: str, edit: str, line: str | None = None) -> str:
    """A way carried on: cost, audit and text of state ``state``."""
    text = f"{state}.o" if line is None else f"{state}.o || chr(10) || {line}"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {text}}}"


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _inserted(columns: str, source: str) -> str:
    """The best ways after any inserts: to a user's turn first, then to an assistant's."""
    user = [_with(s, "5", "I", "'user:'") for s in ("s0", "s1", "s3")]
    return f"""SELECT {columns}, s0, s1, t2 AS s2, {_least("s3", _with("t2", "5", "I", "'assistant:'"))} AS s3
        FROM (SELECT *, {_least("s2", *user)} AS t2 FROM ({source}))"""


def _conversations() -> str:
    nothing = "{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}"
    none = "{'c': CAST(1000000000000 AS BIGINT), 'a': '', 'o': ''}"
    delete = {s: _with(s, "2", "D") for s in ("s0", "s1", "s2", "s3")}

    def taken(state: str, initial: str, word: str | None) -> str:
        keep = _with(state, "cut", "K", "role || ':' || text")
        other = _with(state, "cut + 1", "R", f"'{word}:' || text") if word else none
        return f"CASE WHEN out THEN {none} WHEN left(role, 1) = '{initial}' THEN {keep} ELSE {other} END"

    step = f"""SELECT n, place, left_over, {delete["s0"]} AS s0, {_least(delete["s1"], taken("s0", "s", None))} AS s1,
        {_least(delete["s2"], *[taken(s, "u", "user") for s in ("s0", "s1", "s3")])} AS s2, {_least(delete["s3"], taken("s2", "a", "assistant"))} AS s3
        FROM (SELECT w.n, r.place, w.left_over - 1 AS left_over, w.s0, w.s1, w.s2, w.s3, r.role, r.text, r.out, r.cut FROM ways w JOIN r ON r.n = w.n AND r.place = w.place + 1)"""
    begin = f"SELECT n, 0 AS place, rows AS left_over, {nothing} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM sizes"
    return f"""
    WITH RECURSIVE crc AS MATERIALIZED (
        SELECT list(v ORDER BY i) AS t FROM ({_crc_steps()})
    ), ids AS MATERIALIZED (
        SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS n FROM (SELECT DISTINCT conv_id FROM conversations)
    ), keyed AS (
        SELECT i.n, c.turn, coalesce(c.role, ' ') AS role, coalesce(c.text, ' ') AS text,
               coalesce(CAST(c.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(c.turn AS VARCHAR), ' ') AS key
        FROM conversations c JOIN ids i ON i.conv_id IS NOT DISTINCT FROM c.conv_id
    ), faults AS MATERIALIZED (
        SELECT n, turn, role, text, xor(list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS fault
        FROM keyed, crc
    ), spoilt AS (
        SELECT n, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM faults WHERE fault <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY n ORDER BY turn NULLS FIRST, role, text) AS place,
               NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank
        FROM spoilt
    ), marked AS (
        SELECT *, NOT blank AND row_number() OVER (PARTITION BY n, role, text ORDER BY place) > 1 AS again,
               regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') AS ends_badly,
               lag(left(role, 1)) OVER (PARTITION BY n ORDER BY place) || left(role, 1) AS pair
        FROM placed
    ), r AS MATERIALIZED (
        SELECT *, blank OR again AS out, NOT blank AND NOT again AND ends_badly AS broken,
               CASE WHEN NOT blank AND NOT again AND ends_badly THEN 5 ELSE 0 END AS cut
        FROM marked
    ), sizes AS MATERIALIZED (
        SELECT n, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (broken) AS truncated,
               count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM r GROUP BY n
    ), ways AS (
        {_inserted("n, place, left_over", begin)}
        UNION ALL
        {_inserted("n, place, left_over", step)}
    ), ended AS (
        SELECT n, {_least("s0", "s3")} AS w FROM ways WHERE left_over = 0
    )
    SELECT i.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank,
           CAST(coalesce(s.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated,
           CAST(coalesce(s.illegal, 0) AS BIGINT) AS illegal, coalesce(e.w.c, 0) AS cost, coalesce(e.w.a, '') AS audit,
           sha256(coalesce(substr(e.w.o, 2), '')) AS repaired_sha256
    FROM ids i LEFT JOIN sizes s USING (n) LEFT JOIN ended e USING (n)
    """


CONVERSATIONS = _conversations()
