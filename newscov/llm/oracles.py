"""DuckDB SQL with the same result as those queries that SQL can express."""

from __future__ import annotations

_LINKED = """
  ({linked}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
parts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""


def _rules(rules) -> str:
    return ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in rules)


OP1 = f"""
WITH RECURSIVE valid AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links(a, b) AS {_LINKED.format(linked='''
  SELECT x.vec_id, y.vec_id FROM valid x JOIN valid y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9''')}
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(b, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN parts ON parts.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id"""

OP10 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '') AS words FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct([array_to_string(words[i : i + 4], ' ') FOR i IN range(1, greatest(len(words) - 4, 1) + 1)])) AS grams
  FROM split WHERE len(words) > 0),
classes AS (SELECT grams, min(doc_id) AS rep, count(*) AS copies, len(grams) AS n FROM sets GROUP BY grams),
single AS (SELECT rep, n, unnest(grams) AS gram FROM classes),
common AS (
  SELECT x.rep AS a, y.rep AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS n
  FROM single x JOIN single y ON x.gram = y.gram AND x.rep <> y.rep GROUP BY 1, 2),
links(a, b) AS {_LINKED.format(linked='SELECT a, b FROM common WHERE n >= 0.8e0 * (na + nb - n)')},
weighted AS (SELECT a, sum(copies) AS n_links FROM links JOIN classes ON rep = b GROUP BY a)
SELECT d.doc_id, coalesce(rep, d.doc_id) AS class_id,
       (coalesce(w.n_links, 0) + coalesce(copies - 1, 0))::BIGINT AS n_links,
       coalesce(least(rep, l.b), rep, d.doc_id) AS component_id,
       coalesce(least(rep, l.b), rep, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN classes c ON c.grams = sets.grams
LEFT JOIN weighted w ON w.a = rep LEFT JOIN least l ON l.a = rep"""


def url_filters(rules) -> str:
    return rf"""
WITH rules(rule_host, rule_path, v) AS (VALUES {_rules(rules)}),
rest AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM rest),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(v, length(rule_host || rule_path)) AS v
  FROM parts JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)"""


OP8 = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
first AS (SELECT hex, min(page_id) AS first_id FROM hashed GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)
           FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN first USING (hex)"""


def _later(state: int, bits: int) -> int:
    """The CRC-32 state that ``bits`` zero bits lead to."""
    for _ in range(bits):
        state = state >> 1 ^ (0xEDB88320 if state & 1 else 0)
    return state


def _crc32(rows: str, block: int = 256) -> str:
    """CTEs up to ``crcs(id, crc)``, the unsigned CRC-32 of the UTF-8 bytes in ``rows(id, value)``.

    DuckDB has no such function. Blocks of bytes are reduced nibble by nibble, low before high, and then joined
    block by block; the first block is the short one, so that every join shifts by the same length.
    """
    nibbles = [_later(value, 4) for value in range(16)]
    moved = [f"{[_later(value << 4 * i, 8 * block) for value in range(16)]}[((s >> {4 * i}) & 15) + 1]" for i in range(8)]
    joined = "c"
    for term in moved:
        joined = f"xor({joined}, {term})"
    return f"""
coded AS (SELECT id, hex(encode(value)) AS h, octet_length(encode(value)) AS n FROM {rows} WHERE value IS NOT NULL),
cuts AS (SELECT id, h, n, unnest(range((n + {block - 1}) // {block})) AS k FROM coded),
ends AS (SELECT id, h, k, n - {block} * ((n + {block - 1}) // {block} - 1 - k) AS e FROM cuts),
blocks AS (
  SELECT id, k, substr(h, 2 * greatest(e - {block}, 0) + 1, 2 * (e - greatest(e - {block}, 0))) AS h FROM ends),
states AS (
  SELECT id, k, list_reduce(
    [strpos('123456789ABCDEF', substr(h, CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END, 1))::BIGINT FOR i IN range(length(h))],
    lambda s, x: xor({nibbles}[(xor(s, x) & 15) + 1], s >> 4), CASE WHEN k = 0 THEN 4294967295 ELSE 0 END::BIGINT) AS c
  FROM blocks),
crcs AS (
  SELECT id, xor(list_reduce(list(c ORDER BY k), lambda s, c: {joined}), 4294967295) AS crc FROM states GROUP BY id
  UNION ALL SELECT id, 0 FROM coded WHERE n = 0)"""


def sharding(shards: int, seed: int) -> str:
    return f"""
WITH rows AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS value, doc_id, source FROM documents),
{_crc32("rows")},
keys AS (
  SELECT doc_id, source, (octet_length(encode(value)) + 1)::BIGINT AS size, crc::BIGINT AS text_crc32,
         ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM rows JOIN crcs USING (id)),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, text_crc32) - 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY source) AS fraction FROM keys),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, key, source NULLS FIRST, doc_id NULLS FIRST, size, text_crc32) - 1 AS place,
         count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, place * {shards} // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard,
       (place - (shard * total + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INT AS grown_shard FROM cut"""


def merkle(arity: int, fields, levels: int = 12) -> str:
    """Levels are written out; twelve reach further than any table DuckDB checks here."""

    def digest(text: str) -> str:
        values = [text if f == "text" else f"{f}::VARCHAR" for f in fields]
        parts = [f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values]
        return f"sha256({' || '.join(parts)})"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = f"CASE WHEN crc % 3 = 0 THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END"

    def build(name: str, start: str) -> str:
        """``name_l(t, i, d, w)``: nodes of level l; w is the number of nodes of its tree there."""
        ctes = [f"{name}_0 AS ({start})"]
        for n in range(1, levels):
            ctes.append(
                f"{name}_{n} AS (SELECT t, i // {arity} AS i, sha256(string_agg(d, '' ORDER BY i)) AS d, "
                f"(any_value(w) + {arity - 1}) // {arity} AS w FROM {name}_{n - 1} WHERE w > 1 GROUP BY t, i // {arity})"
            )
        tops = " UNION ALL ".join(f"SELECT t, d FROM {name}_{n} WHERE w = 1" for n in range(levels))
        steps = " UNION ALL ".join(
            f"SELECT {n} AS n, x.t, x.i, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS b, "
            f"coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS a FROM {name}_{n} x JOIN {name}_{n} y "
            f"ON x.t = y.t AND x.i // {arity} = y.i // {arity} WHERE x.w > 1 GROUP BY x.t, x.i"
            for n in range(levels)
        )
        return ",\n".join([*ctes, f"{name}_top AS ({tops})", f"{name}_step AS ({steps})"])

    def folds(above: str, name: str, n: int, i: str) -> str:
        return (
            f"SELECT f.id, f.t, f.i, CASE WHEN s.b IS NULL THEN f.d ELSE sha256(s.b || f.d || s.a) END AS d, "
            f"f.p || coalesce(s.b || s.a, '') AS p FROM {above} f LEFT JOIN {name}_step s ON s.n = {n} AND s.t = f.t AND s.i = {i}"
        )

    walk = ["f0 AS (SELECT id, t, i, candidate AS d, '' AS p FROM placed)"]
    for n in range(levels):
        walk.append(f"f{n + 1} AS ({folds(f'f{n}', 'tree', n, f'f.i // {arity ** n}')})")
    walk.append(f"g0 AS (SELECT id, 0 AS t, t AS i, d, p FROM f{levels})")
    for n in range(levels):
        walk.append(f"g{n + 1} AS ({folds(f'g{n}', 'over', n, f'f.i // {arity ** n}')})")
    return f"""
WITH rows AS (SELECT row_number() OVER () AS id, doc_id::VARCHAR AS value, * FROM documents),
{_crc32("rows")},
leaves AS (SELECT id, doc_id, lang, {digest("text")} AS leaf, {digest(f"({changed})")} AS candidate FROM rows LEFT JOIN crcs USING (id)),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, candidate) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS w FROM leaves),
{build("tree", "SELECT t, i, leaf AS d, w FROM placed")},
{build("over", "SELECT 0 AS t, t AS i, d, count(*) OVER () AS w FROM tree_top")},
{", ".join(walk)}
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256(g.p) AS proof_sha256, g.d AS folded_root, g.d = r.d AS verified
FROM g{levels} g JOIN placed USING (id) JOIN tree_top s ON s.t = placed.t CROSS JOIN over_top r"""


def spelling(least_length: int, least_count: int, factor: int) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= {least_length} GROUP BY ALL),
rows AS (SELECT row_number() OVER () AS id, doc_id || ':' || run AS value, run, n FROM counted),
{_crc32("rows")},
damaged AS (
  SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, (crc % length(run))::BIGINT) || substr(run, (crc % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM rows LEFT JOIN crcs USING (id)),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {least_length} GROUP BY word HAVING sum(n) >= {least_count}),
holes AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS hole FROM words),
less AS (SELECT word, n, hole, substr(word, 1, hole - 1) AS head, substr(word, hole + 1) AS tail FROM holes),
pairs AS (
  SELECT x.word AS a, y.word AS b FROM less x JOIN less y ON x.hole = y.hole AND x.head = y.head AND x.tail = y.tail AND x.word <> y.word
  UNION SELECT x.word, y.word FROM less x JOIN words y ON y.word = x.head || x.tail
  UNION SELECT y.word, x.word FROM less x JOIN words y ON y.word = x.head || x.tail),
near AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS top, max(n) AS top_n FROM pairs JOIN words ON word = b GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= {factor} * n THEN top END AS form,
         CASE WHEN top_n >= {factor} * n THEN top_n END AS form_n FROM words LEFT JOIN near USING (word)),
chain(word, reached) AS (
  SELECT word, word FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL),
lasts AS (SELECT c.word, c.reached FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NULL)
SELECT word, form, e.reached AS root, n, n_near::BIGINT AS n_near, form_n FROM formed JOIN lasts e USING (word)"""
