"""DuckDB queries for the operators that plain SQL can express."""

from __future__ import annotations

_W = "[^\\x20\\x09-\\x0D]+"
_S = "[\\x20\\x09-\\x0D]"

OP1 = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INT) AS fetched_on,
         lower(regexp_extract(coalesce(url, ''), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS h,
         regexp_extract(coalesce(url, ''), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
e AS (
  SELECT DISTINCT unnest([h, regexp_replace(h, '^www\.', ''), h || regexp_extract(path, '^(/[^/]+/)', 1)]) AS entry FROM p WHERE h <> ''),
d AS (
  SELECT entry, CAST('0x' || md5(entry)[1] AS INT) AS d1, CAST('0x' || md5(entry)[2] AS INT) AS d2, CAST('0x' || md5(entry)[3] AS INT) AS d3,
         CAST('0x' || md5(entry)[4] AS INT) AS d4, CAST('0x' || md5(entry)[5] AS INT) AS d5 FROM e),
i AS (
  SELECT entry, ['spam', 'adult', 'malware', 'gambling'][d1 + 1] AS category, DATE '2024-01-01' + (d2 * 8 + d4) AS from_day,
         CASE WHEN d3 % 2 = 0 THEN DATE '2024-01-01' + (d2 * 8 + d4 + 30 + d5 * 6) END AS to_day FROM d WHERE d1 < 4
  UNION ALL
  SELECT entry, ['spam', 'adult', 'malware', 'gambling'][d1 + 1], DATE '2024-01-01' + (d2 * 8 + d4 + 150 + d5 * 6), NULL
  FROM d WHERE d1 < 4 AND d3 % 2 = 0 AND d3 <= 4),
hits AS (
  SELECT page_id, url, i.*, row_number() OVER (PARTITION BY page_id, url ORDER BY length(entry) DESC, entry, category, from_day) AS place
  FROM p JOIN i ON (p.h = i.entry OR ends_with(p.h, '.' || i.entry)
                    OR (contains(i.entry, '/') AND starts_with(p.h || p.path, i.entry)))
   AND from_day <= fetched_on AND (to_day IS NULL OR fetched_on < to_day))
SELECT p.page_id, p.url, p.fetched_on, hits.entry IS NOT NULL AS blocked, hits.entry, hits.category, hits.from_day AS listed_on
FROM p LEFT JOIN hits ON hits.page_id = p.page_id AND hits.url = p.url AND place = 1
"""

OP5 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
n AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         length(regexp_replace(replace(role, '\', '\b'), '<(/?turn)', '\\l\1', 'g')) + length(role) - length(replace(role, '>', '')) + 7 AS opening,
         length(regexp_replace(replace(text, '\', '\b'), '<(/?turn)', '\\l\1', 'g')) + 8 AS closing
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
s AS (SELECT *, sum(opening + closing) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM n)
SELECT conv_id, max(n_turns) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' OR place = n_turns THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_S}', '', 'g') AS norm, length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""

OP8 = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_W}') AS words FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS words_13
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
f AS (SELECT words_13, min(doc_id) AS first_doc FROM g GROUP BY words_13),
gone AS (
  SELECT doc_id, list(DISTINCT place) AS places
  FROM (SELECT doc_id, unnest(range(i, i + 13)) AS place FROM g JOIN f USING (words_13) WHERE first_doc < doc_id) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words
         ELSE [words[p] for p in range(1, len(words) + 1) if NOT list_contains(places, p)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

OP9 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_W}')) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS weight
  FROM d GROUP BY source),
level(step, full_ones, level) AS (
  SELECT 0, CAST(-1 AS BIGINT), 1.5 * CAST(sum(source_size) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) FROM s
  UNION ALL
  SELECT step + 1, x.n, CASE WHEN x.free > 0 THEN (1.5 * CAST(x.total AS DOUBLE) - CAST(x.capped AS DOUBLE)) / CAST(x.free AS DOUBLE) ELSE level.level END
  FROM level, LATERAL (
    SELECT count(*) FILTER (2 * source_size < level.level * weight) AS n, sum(source_size) AS total,
           coalesce(sum(2 * source_size) FILTER (2 * source_size < level.level * weight), 0) AS capped,
           coalesce(sum(weight) FILTER (NOT (2 * source_size < level.level * weight)), 0) AS free FROM s) x
  WHERE x.n <> level.full_ones AND step < 100),
t AS (
  SELECT s.*, least(CAST(2 * source_size AS DOUBLE), (SELECT arg_max(level, step) FROM level) * weight) AS target FROM s),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS wanted,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (wanted // source_size) * size + greatest(0, least(start + size, wanted % source_size) - start) END AS taken
FROM p
"""

OP11 = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
c AS (SELECT lang, sum(len(words)) AS n FROM p GROUP BY lang),
w AS (SELECT piece, lang, unnest(words) AS w1, unnest(range(len(words))) AS i FROM p),
x AS (SELECT *, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
g AS (
  SELECT lang, 1 AS m, w1 AS phrase FROM x
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM x WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM x WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM x WHERE w4 IS NOT NULL),
f AS (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS words FROM g GROUP BY ALL HAVING count(*) >= 30),
s AS (
  SELECT a.lang, a.m, a.phrase, a.words, a.f AS a, k, l.f AS l, r.f AS r, (2000000 * CAST(a.f AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS score
  FROM f a JOIN (SELECT unnest([1, 2, 3]) AS k) ON k < a.m
  JOIN f l ON l.lang = a.lang AND l.phrase = array_to_string(a.words[1:k], ' ')
  JOIN f r ON r.lang = a.lang AND r.phrase = array_to_string(a.words[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (
  SELECT lang, array_to_string(words[i:i + z - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM f, (SELECT unnest([2, 3]) AS z) WHERE z < m) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE NOT coalesce(100 * CAST(longer AS HUGEINT) >= 80 * CAST(a AS HUGEINT), false))
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM k JOIN c USING (lang) WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000
"""

# CRC-32 of ASCII or UTF-8 bytes: a table of 256 entries from the polynomial, then one step per byte.
_CRC_TABLE = "SELECT list(v ORDER BY b) AS crc FROM (SELECT b, list_reduce([b, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS b))"


def _crc32(code_points: str) -> str:
    """Of a list of byte values, with `crc` in scope."""
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {code_points}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"


_BYTES = "list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT))"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(prefix: str, levels: int) -> str:
    """Levels 1 to `levels` of 16-ary trees above {prefix}0(tree, idx, digest): each node, and the run it was made of."""
    made = []
    for k in range(1, levels + 1):
        made.append(
            f"{prefix}r{k} AS (SELECT tree, idx // 16 AS idx, list(digest ORDER BY idx) AS run FROM"
            f" (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {prefix}{k - 1}) WHERE n > 1 GROUP BY tree, idx // 16)"
        )
        made.append(f"{prefix}{k} AS (SELECT tree, idx, sha256(array_to_string(run, '')) AS digest FROM {prefix}r{k})")
    return ",\n".join(made)


def _steps(prefix: str, levels: int, start: str, rows: str) -> str:
    """Walks (id, tree, idx, h, proof) of `start` up a tree: h takes in its siblings, the proof lists them."""
    made, before = [], start
    for k in range(1, levels + 1):
        place = "CAST(b.idx % 16 AS INT)"
        made.append(
            f"{rows}{k} AS (SELECT b.id, b.tree, b.idx // 16 AS idx,"
            f" CASE WHEN r.run IS NULL THEN b.h ELSE sha256(array_to_string(list_concat(run[1:{place}], [b.h], run[{place} + 2:]), '')) END AS h,"
            f" b.proof || CASE WHEN r.run IS NULL THEN '' ELSE array_to_string(list_concat(run[1:{place}], run[{place} + 2:]), '') END AS proof"
            f" FROM {before} b LEFT JOIN {prefix}r{k} r ON r.tree = b.tree AND r.idx = b.idx // 16)"
        )
        before = f"{rows}{k}"
    return ",\n".join(made)


def _roots(prefix: str, levels: int) -> str:
    """The one node of each tree's last level."""
    return " UNION ALL ".join(
        f"SELECT tree, any_value(digest) AS digest FROM {prefix}{k} GROUP BY tree HAVING count(*) = 1" for k in range(levels + 1)
    )


#: Levels enough for 16 ** 5 documents a source and as many sources; those above a tree's root change nothing.
_LEVELS = 5

OP12 = f"""
WITH k AS ({_CRC_TABLE}),
d AS (
  SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id, {_leaf('text')}) AS id, doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 5 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents, k),
p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY id) - 1 AS idx FROM d),
t0 AS (SELECT tree, idx, leaf AS digest FROM p),
{_tree("t", _LEVELS)},
subroots AS (SELECT tree, min(digest) AS digest FROM ({_roots("t", _LEVELS)}) GROUP BY tree),
u0 AS (SELECT 0 AS tree, tree AS idx, digest FROM subroots),
{_tree("u", _LEVELS)},
roots AS (SELECT min(digest) AS root FROM ({_roots("u", _LEVELS)})),
b0 AS (SELECT id, tree, idx, coalesce(changed, leaf) AS h, '' AS proof FROM p),
{_steps("t", _LEVELS, "b0", "b")},
c0 AS (SELECT b{_LEVELS}.id, 0 AS tree, p.tree AS idx, h, proof FROM b{_LEVELS} JOIN p USING (id)),
{_steps("u", _LEVELS, "c0", "c")}
SELECT p.doc_id, p.leaf, subroots.digest AS subroot, root, sha256(c{_LEVELS}.proof) AS proof_sha256,
       c{_LEVELS}.h AS folded_root, c{_LEVELS}.h = root AS verified
FROM p JOIN subroots USING (tree) JOIN c{_LEVELS} USING (id), roots
"""

OP13 = f"""
WITH k AS ({_CRC_TABLE}),
d AS (
  SELECT doc_id, source, CAST(octet_length(encode(t)) + 16 AS BIGINT) AS size, {_crc32(_BYTES)} AS text_crc32, md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
         CAST(CAST('0x' || substr(md5('13:' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS phase
  FROM (SELECT *, coalesce(text, '') AS t FROM documents), k),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id, text_crc32, size) - 1 AS place, count(*) OVER (PARTITION BY source) AS n,
         count(*) OVER () AS total FROM d),
o AS (
  SELECT *, row_number() OVER (ORDER BY (CAST(place AS DOUBLE) + phase) / CAST(n AS DOUBLE), source NULLS FIRST, place) - 1 AS pos FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(40 * pos // total AS INT) AS shard,
       row_number() OVER (PARTITION BY 40 * pos // total ORDER BY pos) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM o
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_url_filters": OP1,
        "op5_chat_formatting": OP5,
        "op7_exact_dedup": OP7,
        "op8_substring_dedup": OP8,
        "op9_source_mixing": OP9,
        "op11_phrase_mining": OP11,
        "op12_merkle_manifest": OP12,
        "op13_stratified_sharding": OP13,
    }
