"""DuckDB SQL for the queries whose rows SQL can express."""

# words are runs without white space; upper-case A-Z only is lowered
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP6 = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM w),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
           FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT u, v FROM shared JOIN sizes p ON p.doc_id = u JOIN sizes q ON q.doc_id = v
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT links.v, reach.r FROM reach JOIN links ON links.u = reach.doc_id WHERE reach.r < links.v),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN least USING (doc_id)
"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda k:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(hex, CAST(5 * i + 1 AS BIGINT), 5) AS INTEGER) >> k) & 31) + 1, 1)), '')), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, leaves: str, levels: int) -> str:
    """CTEs name0..: the nodes of each level (tree, i, h); a tree that is down to one node stays as it is."""
    out = [f"{name}0 AS MATERIALIZED (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(levels):
        out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (SELECT tree, i // 8 AS i, "
                   f"CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY {name}{k}.i)) END AS h FROM {name}{k} GROUP BY tree, {name}{k}.i // 8))")
    return ", ".join(out)


def _climb(name: str, levels: int, start: str) -> str:
    """CTEs climbing each row of start(tree, i, id, now, proof) up the levels of name, with the siblings it meets."""
    out, last = [], start
    for k in range(levels):
        # what stands left and right of a node in its run
        side = (f"SELECT a.tree, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, "
                f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r, any_value(a.n) AS n "
                f"FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.i // 8 = b.i // 8 GROUP BY a.tree, a.i")
        out.append(f"{start}{k + 1} AS MATERIALIZED (SELECT c.tree, c.i // 8 AS i, c.id, CASE WHEN n = 1 THEN now ELSE sha256(l || now || r) END AS now, "
                   f"proof || l || r AS proof FROM {last} c JOIN ({side}) s ON s.tree = c.tree AND s.i = c.i)")
        last = f"{start}{k + 1}"
    return ", ".join(out)


_DEEP, _WIDE = 10, 4  # levels that the SQL has: up to 8^10 documents of a language, 8^4 languages
# crc32 of the decimal doc_id, bit by bit
_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda k: CAST(ascii(substr(CAST(doc_id AS VARCHAR), k, 1)) AS BIGINT))), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
OP11 = f"""
WITH hashed AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf('text')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
rows AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS id FROM hashed),
{_levels('t', '(SELECT tree, i, leaf AS h FROM rows)', _DEEP)},
{_levels('u', f'(SELECT 0 AS tree, tree AS i, h FROM t{_DEEP})', _WIDE)},
a AS (SELECT tree, i, id, coalesce(changed, leaf) AS now, '' AS proof FROM rows),
{_climb('t', _DEEP, 'a')},
b AS (SELECT 0 AS tree, tree AS i, id, now, proof FROM a{_DEEP}),
{_climb('u', _WIDE, 'b')}
SELECT doc_id, leaf, s.h AS subroot, g.h AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = g.h AS verified
FROM rows JOIN b{_WIDE} f USING (id) JOIN t{_DEEP} s ON s.tree = rows.tree JOIN u{_WIDE} g ON true
"""

OP12 = OP6.replace("< 5 THEN", "< 4 THEN").replace("len(ws) - 3)", "len(ws) - 2)").replace("ws[i:i + 4]", "ws[i:i + 3]").replace(
    ">= 75 *", ">= 85 *").replace(", doc_id = component_id AS kept", "")

ORACLE_SQL = {
    "op6_setsketch_dedup": OP6,
    "op8_warc_round_trip": OP8,
    "op9_prefix_target_chat": OP9,
    "op11_merkle_butterfly": OP11,
    "op12_count_vector_rtree": OP12,
}
