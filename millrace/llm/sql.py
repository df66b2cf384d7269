"""DuckDB SQL for the operators on conversations and the exact search."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: eight shifts for each byte."""
    byte = f"list_transform(range(1, 1 + length({text})), lambda i: CAST(ascii(substr({text}, CAST(i AS INTEGER), 1)) AS BIGINT))"
    shifts = "list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda a, b: {shifts}))"


def dearer(value: str, cost: str, letter: str) -> str:
    """A value is nine digits of cost, then the audit; null is out of reach."""
    return f"(lpad(CAST(CAST(substr({value}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({value}, 10) || '{letter}')"


def step() -> str:
    """The values of the four states after one more turn, from those before it with insertions (e0 to e3)."""
    gone = [dearer(f"e{i}", "4", "D") for i in range(4)]
    free = "least(e0, e1, e3)"
    stay = "sym <> 'x'"
    system = f"CASE WHEN {stay} AND kind = 's' THEN {dearer('e0', 'more', 'K')} END"
    user = f"CASE WHEN {stay} THEN CASE WHEN kind = 'u' THEN {dearer(free, 'more', 'K')} ELSE {dearer(free, '(3 + more)', 'R')} END END"
    assistant = f"CASE WHEN {stay} THEN CASE WHEN kind = 'a' THEN {dearer('e2', 'more', 'K')} ELSE {dearer('e2', '(3 + more)', 'R')} END END"
    values = [gone[0], f"least({gone[1]}, {system})", f"least({gone[2]}, {user})", f"least({gone[3]}, {assistant})"]
    return ", ".join(f"{v} AS v{i}" for i, v in enumerate(values))


#: Insertions: from 0, 1 and 3 to 2, then from 2 to 3, then once more to 2 from the old 2 is never cheaper.
INSERTED = f"""v0 AS e0, v1 AS e1,
    least(v2, {dearer("v0", "3", "I")}, {dearer("v1", "3", "I")}, {dearer("v3", "3", "I")}) AS e2,
    least(v3, {dearer(f"least(v2, {dearer('v0', '3', 'I')}, {dearer('v1', '3', 'I')})", "3", "I")}) AS e3"""

WORD = r"[^\x20\x09-\x0D]"

REPAIR = f"""
    WITH RECURSIVE faulty AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fault
      FROM conversations),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM faulty WHERE fault <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
             list_extract(regexp_extract_all(text, '{WORD}'), -1) AS last
      FROM damaged),
    told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS again FROM placed),
    turns AS (
      SELECT *, substr(role, 1, 1) AS kind,
             CASE WHEN last IS NULL THEN 'b' WHEN again > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
             CASE WHEN last IS NULL OR again > 1 THEN 'x' ELSE '' END AS sym,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
      FROM told),
    counted AS (
      SELECT conv_id, count(*) AS n_turns,
             coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
             count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (n > 1 AND before || kind NOT IN ('su', 'ua', 'au')) AS illegal
      FROM turns GROUP BY conv_id),
    solved AS (
      SELECT conv_id, 0::BIGINT AS n, '000000000' AS v0, NULL::VARCHAR AS v1, NULL::VARCHAR AS v2, NULL::VARCHAR AS v3 FROM counted
      UNION ALL
      SELECT conv_id, n, {step()}
      FROM (SELECT t.conv_id, t.n, t.kind, t.sym, CASE WHEN t.fault = 't' THEN 3 ELSE 0 END AS more, {INSERTED}
            FROM solved s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.n + 1) x),
    ends AS (
      SELECT s.conv_id, least(v0, {dearer(dearer("v1", "3", "I"), "3", "I")}, {dearer("v2", "3", "I")}, v3) AS best
      FROM solved s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n_turns = s.n),
    audits AS (SELECT conv_id, CAST(substr(best, 1, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM ends),
    letters AS (
      SELECT conv_id, p, substr(audit, CAST(p AS INTEGER), 1) AS letter,
             length(replace(audit, 'D', '')) AS kept,
             length(replace(substr(audit, 1, CAST(p AS INTEGER)), 'D', '')) AS place,
             length(replace(substr(audit, 1, CAST(p AS INTEGER)), 'I', '')) AS n
      FROM (SELECT conv_id, audit, unnest(range(1, 1 + length(audit))) AS p FROM audits)),
    texts AS (
      SELECT l.conv_id, string_agg(
               CASE WHEN letter = 'K' THEN t.role WHEN (kept - place) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' ||
               CASE WHEN letter = 'I' THEN '' ELSE t.text END, chr(10) ORDER BY p) AS whole
      FROM letters l LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.n = l.n
      WHERE letter <> 'D' GROUP BY l.conv_id)
    SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) i
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM i.conv_id"""


TRIE = f"""
    WITH own AS (
      SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
      SELECT c, c - c % 5 AS base, {crc32("CAST(c AS VARCHAR)")} % 9 AS h
      FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
    parts AS (
      SELECT i.c, 0 AS part, n, role, text FROM ids i JOIN own o ON o.c = i.base WHERE n <= h
      UNION ALL
      SELECT i.c, 1, n, role, text FROM ids i JOIN own o ON o.c = i.c WHERE n > h),
    turns AS (
      SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, n) AS d, strlen(text) AS bytes,
             CAST(length(role) AS VARCHAR) || ':' || role || text AS turn
      FROM parts),
    paths AS (
      SELECT c, d, bytes, sha256(string_agg(CAST(length(turn) AS VARCHAR) || ':' || turn, '') OVER (PARTITION BY c ORDER BY d)) AS path
      FROM turns
      UNION ALL
      SELECT c, 0, 0, '' FROM ids),
    members AS (
      SELECT *, min(c) OVER (PARTITION BY d, path) AS owner, count(*) OVER (PARTITION BY d, path) AS n,
             max(d) OVER (PARTITION BY c) AS len
      FROM paths),
    reach AS (SELECT *, max(len) OVER (PARTITION BY d, path) AS far FROM members),
    nodes AS (SELECT DISTINCT owner, d, n, (n - 1) * bytes AS saved, far = d AS leaf FROM reach),
    up AS (
      SELECT DISTINCT lower.owner, lower.d, upper.owner AS parent
      FROM members lower JOIN members upper ON upper.c = lower.c AND upper.d = lower.d - 1),
    inside AS (
      SELECT DISTINCT a.owner AS top_owner, a.d AS top_d, b.owner, b.d FROM members a JOIN members b ON b.c = a.c AND b.d >= a.d),
    totals AS (
      SELECT top_owner, top_d, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens,
             count(*) FILTER (i.d = top_d + 1) AS n_children
      FROM inside i JOIN nodes v ON v.owner = i.owner AND v.d = i.d GROUP BY 1, 2),
    ends AS (SELECT owner, d, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM members WHERE d = len GROUP BY 1, 2)
    SELECT v.owner AS conv_id, v.d AS depth, parent AS parent_conv_id, v.n AS n_convs, n_children, n_leaves, saved_tokens,
           sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes v JOIN totals t ON t.top_owner = v.owner AND t.top_d = v.d
    LEFT JOIN up ON up.owner = v.owner AND up.d = v.d
    LEFT JOIN ends e ON e.owner = v.owner AND e.d = v.d"""


TOP_PRODUCTS = """
    WITH vectors AS (
      SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)) AS score
      FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""
