"""DuckDB SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

from tickroll.llm import quality, secrets

_SPACE = r"[\x20\x09-\x0D]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secrets_sql() -> str:
    found = "\nUNION ALL\n".join(f"""
SELECT doc_id, source, lang, {i} AS kind, unnest(regexp_extract_all(t, {_text(pattern)})) AS m,
       unnest(list_transform(string_split_regex(t, {_text(pattern)})[:-2], lambda x: length(x))) AS gap,
       unnest(range(1, 1 + len(regexp_extract_all(t, {_text(pattern)})))) AS pos
FROM d WHERE regexp_matches(t, {_text(pattern)})""" for i, (_, pattern, _) in enumerate(secrets.KINDS))
    least = " ".join(f"WHEN {i} THEN {n}" for i, (_, _, n) in enumerate(secrets.KINDS))
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _, _) in enumerate(secrets.KINDS))
    return rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
f AS ({found}),
p AS (SELECT *, CAST(sum(gap + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS BIGINT) AS stop,
             CASE WHEN kind = 0 THEN regexp_extract(m, {_text(secrets.ASSIGN)}, 2) ELSE m END AS secret FROM f),
c AS (SELECT *, stop - length(m) AS start,
             regexp_matches(secret, '[0-9]') AND regexp_matches(secret, '[A-Za-z]') AND NOT regexp_matches(secret, {_text(secrets.PLACEHOLDERS)})
             AND len(list_distinct(string_split(secret, ''))) >= {secrets.LEAST_DISTINCT} AS looks
      FROM p WHERE length(secret) >= CASE kind {least} END),
o AS (SELECT secret, count(DISTINCT source) AS owners, count(DISTINCT row(source, lang)) AS repositories FROM c GROUP BY secret),
j AS (SELECT c.*, owners, repositories,
             CASE WHEN owners >= {secrets.COPIED_OWNERS} OR repositories >= {secrets.COPIED_REPOSITORIES} THEN 'copied'
                       WHEN owners <= {secrets.MAX_OWNERS} AND looks THEN 'live' ELSE 'unclear' END AS verdict
      FROM c JOIN o USING (secret)),
s AS (SELECT *, CASE kind {names} END || ':' || start || ':' || stop AS said FROM j
      WHERE kind < {len(secrets.BASE)} OR (verdict = 'live' AND NOT EXISTS (
        SELECT 1 FROM j b WHERE b.doc_id = j.doc_id AND b.kind < {len(secrets.BASE)} AND b.start < j.stop AND b.stop > j.start)))
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(said, ',' ORDER BY start, kind) FILTER (WHERE kind < {len(secrets.BASE)}), '')) AS base_sha256,
       coalesce(string_agg(said, ',' ORDER BY start, kind), '') AS spans,
       count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE verdict = 'copied') AS n_copied,
       coalesce(max(owners), 0) AS most_owners, coalesce(max(repositories), 0) AS most_repositories
FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


def decontamination_sql(window: int = 13) -> str:
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return rf"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
n AS (SELECT item_id, w, CAST(least({window}, len(w)) AS BIGINT) AS size FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(w) - size + 2),
             lambda i: array_to_string(w[i:i + size - 1], ' '))) AS gram FROM n),
z AS (SELECT DISTINCT size FROM n),
p AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos,
             unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS gram
      FROM d, z WHERE len(w) >= size),
m AS (SELECT doc_id, p.size, pos, item_id FROM p JOIN g USING (size, gram)),
h AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (
        SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT doc_id, size, pos FROM m)) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id"""


def quality_sql(rules=None) -> str:
    rules = quality.RULES if rules is None else rules
    stop = ", ".join(_text(w) for w in sorted({w for words in quality.STOP_WORDS.values() for w in words}))
    said = []
    for r in rules:
        tests = [f"{r.measure} < {r.least!r}"] * (r.least is not None) + [f"{r.measure} > {r.most!r}"] * (r.most is not None)
        said.append(f"CASE WHEN ({' OR '.join(tests)}) AND n_words >= {r.from_words} THEN {_text(r.name)} END")
    word = lambda n: f"CASE WHEN n_words > 0 THEN CAST({n} AS DOUBLE) / n_words ELSE 0 END"
    line = lambda n: f"CASE WHEN n_lines > 0 THEN CAST({n} AS DOUBLE) / n_lines ELSE 0 END"
    return rf"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM a),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS pos,
             unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS gram FROM b WHERE len(ws) >= 5),
r AS (SELECT doc_id, count(DISTINCT word) AS n FROM (
        SELECT doc_id, unnest(range(pos, pos + 5)) AS word FROM (
          SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM g) WHERE k > 1) GROUP BY doc_id),
c AS (SELECT b.doc_id, ws, ls, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM b LEFT JOIN r ON r.doc_id = b.doc_id),
m AS (SELECT *, {word('word_chars')} AS mean_word_chars, {word('n_symbols')} AS symbol_ratio,
             {word(f'len(list_filter(ws, lambda x: lower(x) IN ({stop})))')} AS stop_ratio,
             {word('len(list_filter(ws, lambda x: length(x) > 1 AND x = upper(x) AND x <> lower(x)))')} AS shout_ratio,
             {line("len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…'))")} AS ellipsis_line_ratio,
             {line("len(list_filter(ls, lambda x: ltrim(x, ' ') LIKE '- %' OR ltrim(x, ' ') LIKE '* %' OR ltrim(x, ' ') LIKE '• %'))")} AS bullet_line_ratio,
             {line('n_dup_lines')} AS dup_line_ratio,
             n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
f AS (SELECT *, concat_ws(',', {', '.join(said)}) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f"""


def near_duplicates_sql(shingle: int = 3, threshold: int = 85) -> str:
    """Exact pairs by shared shingles, then the least id reachable."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - {shingle} + 2)),
             lambda i: array_to_string(w[i:i + {shingle} - 1], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
      JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= {threshold} * (p.n + q.n - shared)),
c AS (SELECT a AS node, a AS root FROM l UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.node),
r AS (SELECT node, min(root) AS root FROM c GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
       coalesce(root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.node = d.doc_id"""


def chat_sql() -> str:
    """Lengths with escapes: a backslash for each backslash and each control string."""
    from tickroll.llm import chat

    marks = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    controls = "|".join("".join("\\" + x if x in "[]|/<>()." else x for x in c) for c in chat.CONTROLS)
    size = lambda c: (f"length({c}) + length({c}) - length(replace({c}, '\\', '')) + len(regexp_extract_all({c}, {_text(controls)}))")
    said = "'</s>[INST] ok [/INST]'"
    return rf"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', {said} UNION ALL SELECT -1, 1, 'assistant', {said})
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({marks} + {size('role')} + {size('text')}) AS BIGINT) AS formatted_chars
FROM a GROUP BY conv_id"""


def embedding_links_sql(threshold: float = 0.95) -> str:
    """All pairs in double precision."""
    return rf"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, v FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                                AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= {threshold}),
c AS (SELECT a AS node, a AS root FROM l UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.node),
r AS (SELECT node, min(root) AS root FROM c GROUP BY node),
n AS (SELECT a AS node, count(*) AS links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(links, 0) AS n_links, coalesce(root, e.vec_id) AS component_id, coalesce(root, e.vec_id) = e.vec_id AS kept
FROM e LEFT JOIN n ON n.node = e.vec_id LEFT JOIN r ON r.node = e.vec_id"""


def prefix_trie_sql() -> str:
    """Prefixes as strings of turn hashes; CRC-32 bit by bit, for DuckDB has none."""
    crc = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), "
           "lambda d: CAST(ascii(d) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), "
           "lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295)")
    return rf"""
WITH a AS (SELECT conv_id AS c, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                  strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, k, size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) - 1 AS pos FROM a),
n AS (SELECT c, own, c - c % 5 AS base, {crc} % 9 AS h FROM (SELECT c, count(*) AS own FROM t GROUP BY c)),
w AS (SELECT n.c, CASE WHEN n.c = n.base THEN pos ELSE pos - n.h + least(n.h, coalesce(m.own, 0)) END AS pos, k, size
      FROM t JOIN n ON n.c = t.c LEFT JOIN n m ON m.c = n.base WHERE n.c = n.base OR pos >= n.h
      UNION ALL SELECT n.c, pos, k, size FROM n JOIN t ON t.c = n.base WHERE n.c <> n.base AND pos < n.h),
p AS (SELECT c, pos + 1 AS depth, size, string_agg(k, '') OVER (PARTITION BY c ORDER BY pos) AS path FROM w
      UNION ALL SELECT c, 0, 0, '' FROM n),
q AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY depth) AS over, depth = max(depth) OVER (PARTITION BY c) AS last FROM p),
g AS (SELECT path, min(c) AS least, any_value(over) AS over FROM q GROUP BY path),
k AS (SELECT over AS path, count(*) AS children FROM g WHERE over IS NOT NULL GROUP BY over),
f AS (SELECT least AS c FROM g WHERE path NOT IN (SELECT path FROM k)),
s AS (SELECT q.*, q.c IN (SELECT c FROM f) AS leaf,
             sum(CASE WHEN q.c <> g.least THEN size ELSE 0 END) OVER (PARTITION BY q.c ORDER BY depth DESC) AS saved
      FROM q JOIN g ON g.path = q.path),
r AS (SELECT path, min(c) AS conv_id, min(depth) AS depth, any_value(over) AS over, count(*) AS n_convs, count(*) FILTER (WHERE leaf) AS n_leaves,
             CAST(sum(saved) AS BIGINT) AS saved_tokens,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
      FROM s GROUP BY path)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, g.least AS parent_conv_id, n_convs, coalesce(children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM r LEFT JOIN g ON g.path = r.over LEFT JOIN k ON k.path = r.path"""


ORACLES = {
    "op1_secrets": secrets_sql(), "op2_decontamination": decontamination_sql(), "op3_minhash": near_duplicates_sql(),
    "op7_quality": quality_sql(), "op9_chat": chat_sql(), "op11_embedding_dedup": embedding_links_sql(),
    "op13_prefix_trie": prefix_trie_sql(),
}
