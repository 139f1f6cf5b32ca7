"""DuckDB statements for the training-data queries that SQL can express."""

from __future__ import annotations

#: Levels written out below: enough for 3**15 leaves a source and 3**15 sources.
_LEVELS = 15


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit; the polynomial is a fixed value."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, _: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    fields = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


def _tree(name: str, leaves: str) -> str:
    """Per level: the nodes, each with its parent's number, and the steps of the leaves below.

    ``leaves`` has g, i and d. Tables: <name>_n (level, g, i, d) and <name>_s (g, leaf, level,
    left and right siblings), <name>_r (g, root).
    """
    parts = [f"{name}_l0 AS (SELECT g, i, d FROM {leaves})"]
    for k in range(_LEVELS):
        parts.append(f"""{name}_l{k + 1} AS (
SELECT g, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}_l{k}
WHERE g IN (SELECT g FROM {name}_l{k} WHERE i = 1) GROUP BY g, i // 3)""")
    nodes = " UNION ALL ".join(f"SELECT {k} AS level, g, i, d FROM {name}_l{k}" for k in range(_LEVELS + 1))
    parts.append(f"{name}_n AS ({nodes})")
    parts.append(f"""{name}_s AS (
SELECT x.g, x.i AS leaf, p.level,
  coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (WHERE n.i < x.i // pow(3, p.level - 1)::BIGINT), '') AS lft,
  coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (WHERE n.i > x.i // pow(3, p.level - 1)::BIGINT), '') AS rgt
FROM {name}_l0 x JOIN {name}_n p ON p.g = x.g AND p.level > 0 AND p.i = x.i // pow(3, p.level)::BIGINT
JOIN {name}_n n ON n.g = x.g AND n.level = p.level - 1 AND n.i // 3 = p.i
GROUP BY x.g, x.i, p.level)""")
    parts.append(f"""{name}_r AS (SELECT g, arg_max(d, level) AS root FROM {name}_n GROUP BY g)""")
    return ",\n".join(parts)


def manifest_sql() -> str:
    crc = _crc32("CAST(doc_id AS VARCHAR)")
    folded = "list_reduce(list_prepend(forged, steps), lambda a, s: sha256(replace(s, '@', a)))"
    return f"""
WITH base AS (
SELECT doc_id, source, {_leaf('text')} AS d,
  CASE WHEN {crc} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS forged
FROM documents),
leaves AS (
SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS i
FROM base),
{_tree('t', 'leaves')},
tops AS (SELECT 0 AS g, g AS i, root AS d FROM t_r),
{_tree('u', 'tops')},
steps AS (
SELECT g, leaf, level, lft, rgt FROM t_s
UNION ALL SELECT l.g, l.i, 100 + s.level, s.lft, s.rgt FROM leaves l JOIN u_s s ON s.leaf = l.g),
paths AS (
SELECT g, leaf, list(lft || '@' || rgt ORDER BY level) AS steps, string_agg(lft || rgt, '' ORDER BY level) AS proof
FROM steps GROUP BY g, leaf),
found AS (
SELECT doc_id, l.d AS leaf, t_r.root AS subroot, u_r.root AS root, forged,
  coalesce(steps, []::VARCHAR[]) AS steps, coalesce(proof, '') AS proof
FROM leaves l JOIN t_r ON t_r.g = l.g CROSS JOIN u_r
LEFT JOIN paths ON paths.g = l.g AND paths.leaf = l.i)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, {folded} AS folded_root,
  {folded} = root AS verified
FROM found"""


def warc_sql() -> str:
    """Digests and revisits of all pages; five hexadecimal digits make four of base 32."""
    digit = "((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1"
    base32 = (
        "array_to_string(list_transform(generate_series(0, 31), "
        f"lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', {digit}, 1)), '')"
    )
    return f"""
WITH k AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS h FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY h, bytes) AS owner FROM k)
SELECT page_id, bytes AS payload_bytes, {base32} AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM o"""


def substrings_sql(window: int = 13) -> str:
    """Words outside every window that also starts in a document with a smaller id."""
    back = window - 1
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT rn, doc_id, pos, w[pos] AS word,
    CASE WHEN pos + {back} <= len(w) THEN array_to_string(w[pos:pos + {back}], ' ') END AS passage
  FROM (SELECT *, unnest(generate_series(1, len(w))) AS pos FROM d)),
m AS (SELECT rn, pos, word,
    passage IS NOT NULL AND min(doc_id) OVER (PARTITION BY passage) < doc_id AS repeats FROM p),
r AS (SELECT rn, pos, word, bool_or(repeats) OVER (
    PARTITION BY rn ORDER BY pos ROWS BETWEEN {back} PRECEDING AND CURRENT ROW) AS gone FROM m),
s AS (SELECT rn, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM r GROUP BY rn)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (rn)"""
