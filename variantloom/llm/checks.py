"""DuckDB SQL for the results of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FURNITURE = (
    "accept all cookies|accept cookies|add to cart|all rights reserved|back to top|click here|cookie policy|"
    "cookie settings|enable javascript|follow us on|forgot your password|leave a comment|log in to|"
    "privacy policy|read more|share this|sign up for|skip to content|skip to main content|subscribe to our|"
    "terms of service|terms of use|this site uses cookies|we use cookies"
)


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


LINE_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest({WORDS.format(text='text')}) AS w, generate_subscripts({WORDS.format(text='text')}, 1) AS i FROM d),
g AS (SELECT r, i, concat_ws(chr(32), w, lead(w) OVER o, lead(w, 2) OVER o) AS g, lead(w, 2) OVER o AS third
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
m AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE third IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM m, (VALUES (0), (1), (2)) v(j) WHERE m.n >= 2 GROUP BY r),
l AS (SELECT r, l, {WORDS.format(text='l')} AS ws, row_number() OVER (PARTITION BY r, l ORDER BY i) AS nth, i
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
      WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
f AS (SELECT *, len(ws) AS n,
        (len(ws) <= 15 AND regexp_matches({LOWER.format(text='l')}, '{_FURNITURE}'))
        OR {_count('l', '[#*$%&|<>]')} * 100 > len(ws) * 50
        OR ({_count('l', '[|•»›]')} >= 3 AND {_count('l', '[|•»›]')} * 100 > len(ws) * 25)
        OR ({_count('l', '!')} >= 3 AND {_count('l', '!')} * 100 > len(ws) * 50)
        OR (len(ws) >= 10 AND len(list_distinct(ws)) * 100 < len(ws) * 20) AS bad
      FROM l),
s AS (SELECT r, count(*) AS n_lines, count(*) FILTER (nth > 1) AS n_dup_lines, count(*) FILTER (NOT bad) AS n_kept_lines,
        coalesce(sum(length(array_to_string(ws, ''))) FILTER (NOT bad), 0) AS kept_chars FROM f GROUP BY r),
t AS (SELECT d.r, doc_id, CAST(len({WORDS.format(text='text')}) AS BIGINT) AS n_words,
        CAST(length(array_to_string({WORDS.format(text='text')}, '')) AS BIGINT) AS word_chars,
        CAST({_count('text', '[#*$%&|<>]')} AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_kept_lines, 0) AS BIGINT) AS n_kept_lines,
        CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
      FROM d LEFT JOIN s USING (r) LEFT JOIN covered c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_kept_lines, kept_chars,
  n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50 OR (word_chars - kept_chars) * 100 > word_chars * 50) AS kept
FROM t"""

# One step of the jump hash: the state is (b, j, key), the key unsigned modulo 2**64.
_JUMP = """list_reduce(
  list_prepend({{'b': -1::BIGINT, 'j': 0::BIGINT, 'k': (CASE WHEN {key} < 0 THEN {key}::HUGEINT + 18446744073709551616 ELSE {key}::HUGEINT END)}},
    [{{'b': 0::BIGINT, 'j': 0::BIGINT, 'k': 0::HUGEINT}} FOR x IN range({n})]),
  lambda s, x: CASE WHEN s.j < {n} THEN {{'b': s.j,
    'j': floor((s.j + 1) * (2147483648.0::DOUBLE / ((((s.k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592) + 1)::DOUBLE))::BIGINT,
    'k': (s.k * 2862933555777941757 + 1) % 18446744073709551616}} ELSE s END).b::INT"""

# CRC-32 byte by byte: the table holds the remainder of every byte by the reversed polynomial.
_CRC_ROW = "list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)"
JUMP_SHARDS = f"""
WITH t AS (SELECT list({_CRC_ROW} ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        [('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(size - 1)]),
        lambda c, b: xor(t.t[xor(c, b) % 256 + 1], c >> 8))) AS text_crc32 FROM d, t),
s AS (SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, {_JUMP.format(key='coalesce(doc_id, 0)', n=16)} AS shard,
        {_JUMP.format(key='coalesce(doc_id, 0)', n=17)} AS grown_shard FROM c)
SELECT doc_id, size, text_crc32, law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  grown_shard FROM s"""

ENTROPY_MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS.format(text='text')}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS bound FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
o AS (SELECT min_by(level, bound / weight) AS level FROM l WHERE bound / weight > level),
t AS (SELECT l.source, source_size, bound, CASE WHEN bound / weight <= l.level THEN bound ELSE weight * o.level END AS target FROM l, o),
r AS (SELECT *, round(CASE WHEN target <= 0 THEN 0 WHEN target >= bound THEN 3.0 ELSE least(3.0, target / source_size) END, 9) AS rate FROM t),
p AS (SELECT doc_id, size, source_size, target, rate, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) - 1 AS place
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST((floor(rate) + floor((rate - floor(rate)) * (place + 1) + 0.5) - floor((rate - floor(rate)) * place + 0.5)) * size AS BIGINT) AS taken
FROM p"""

# Pairs share a shingle; components by the smallest id that spreads along the links.
JACCARD_GROUPS = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=LOWER.format(text="text"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [concat_ws(' ', w[i], w[i + 1], w[i + 2]) FOR i IN range(1, len(w) - 1)] END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id"""

_KEY = LOWER.format(text="trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")
LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, i, ls[i] AS l FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
k AS (SELECT *, {_KEY} AS k FROM l),
c AS (SELECT k, max(doc_id) AS keeper FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
x AS (SELECT k.*, c.k IS NOT NULL AND doc_id <> keeper AS dropped FROM k LEFT JOIN c USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM x GROUP BY r, doc_id"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(name: str, start: str, keys: str) -> str:
    """Nodes (keys, level, place, n, digest) of binary trees from their leaves up."""
    return f"""{name} AS (SELECT {keys}, 0 AS level, place, n, digest FROM {start} UNION ALL
  SELECT {keys}, level + 1, place // 2, (max(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM {name} WHERE n > 1
  GROUP BY {keys}, level, place // 2)"""


def _climb(name: str, start: str, nodes: str, keys: str) -> str:
    """Every leaf's way up: folded digest and siblings so far."""
    same = " AND ".join(f"x.{k} IS NOT DISTINCT FROM c.{k}" for k in keys.split(", "))
    held = ", ".join(f"c.{k}" for k in keys.split(", "))
    return f"""{name} AS (SELECT r, {keys}, 0 AS level, place, n, folded, siblings FROM {start} UNION ALL
  SELECT c.r, {held}, c.level + 1, c.place // 2, (c.n + 1) // 2,
    sha256(CASE WHEN x.digest IS NULL THEN c.folded WHEN c.place % 2 = 1 THEN x.digest || c.folded ELSE c.folded || x.digest END),
    c.siblings || coalesce(x.digest, '')
  FROM {name} c LEFT JOIN {nodes} x ON {same} AND x.level = c.level AND x.place = xor(c.place, 1) WHERE c.n > 1)"""


MERKLE_PROOFS = f"""
WITH RECURSIVE t AS (SELECT list({_CRC_ROW} ORDER BY i) AS t FROM range(256) r(i)),
h AS (SELECT *, row_number() OVER () AS r, hex(encode(doc_id::VARCHAR)) AS h FROM documents),
d AS (SELECT h.*, coalesce(xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        [('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(strlen(h) // 2)]),
        lambda c, b: xor(t.t[xor(c, b) % 256 + 1], c >> 8))) % 7 = 0, false) AS hit FROM h, t),
f AS (SELECT r, doc_id, lang, {_leaf('n_chars')} AS digest, {_leaf('(n_chars + hit::BIGINT)')} AS folded FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
        '' AS siblings FROM f),
{_levels('b', 'p', 'lang')},
s AS (SELECT lang, digest AS subroot FROM b WHERE n = 1),
l AS (SELECT 0 AS one, lang, subroot AS digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM s),
{_levels('u', 'l', 'one')},
{_climb('c', 'p', 'b', 'lang')},
m AS (SELECT r, l.one, l.place, l.n, folded, siblings FROM c JOIN l ON l.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1),
{_climb('v', 'm', 'u', 'one')}
SELECT p.doc_id, p.digest AS leaf, s.subroot, u.digest AS root, sha256(v.siblings) AS proof_sha256, v.folded AS folded_root,
  v.folded = u.digest AS verified
FROM p JOIN v ON v.r = p.r AND v.n = 1 JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN u ON u.n = 1"""


def _terms(text: str) -> str:
    return r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(LOWER.format(text=f"coalesce({text}, '')"))


LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(t))::BIGINT AS words FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({_terms('text')}) AS t FROM benchmark),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, count(*) AS df FROM p WHERE t IN (SELECT t FROM q) GROUP BY t),
w AS (SELECT t, floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, s),
k AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.n * s.n) // s.words))))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t), s GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank FROM k WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 50"""
