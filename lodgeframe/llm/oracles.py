"""SQL that gives the rows of those queries that SQL can express, by comparing everything with everything."""

from __future__ import annotations

from lodgeframe.llm.fingerprints import PIECE, SHOWN
from lodgeframe.llm.secret_scan import BASE, RULES

VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
  l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
  r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
  SELECT vec_id, (SELECT count(*) FROM l WHERE l.x = vec_id) AS n_links, min(y) AS component_id, vec_id = min(y) AS kept
  FROM embeddings JOIN r ON r.x = vec_id GROUP BY vec_id"""

NGRAMS = r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
  g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM d),
  n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
  i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
  l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 10 * shared >= 8 * (p.n + q.n - shared)),
  r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
  SELECT x AS doc_id, min(y) AS class_id, (SELECT count(*) FROM l WHERE l.x = r.x) AS n_links FROM r GROUP BY x"""

HARD_NEGATIVES = """WITH v AS (SELECT vec_id AS i, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.i AS a, b.i AS b, a.l = b.l AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS s FROM v a JOIN v b ON a.i <> b.i WHERE a.i % 50 = 0),
  p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
  n AS (SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS INTEGER) AS rank,
      s.b AS negative_id, p.s AS positive_score, s.s AS negative_score
    FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
  SELECT * FROM n WHERE rank <= 3"""

# The checksum bit by bit: one step a bit, the next byte of the decimal number before each eighth.
PREFIX_TRIE = """WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
  crc AS (SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM ids
    UNION ALL SELECT c, s, i + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
    FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(s, i // 8 + 1, 1))) ELSE v END AS x FROM crc WHERE i < 8 * length(s))),
  h AS (SELECT c, xor(v, 4294967295) % 9 AS h, c - c % 5 AS b FROM crc WHERE i = 8 * length(s)),
  l AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), unhex(md5(coalesce(text, ''))))
    AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  w AS (SELECT h.c, coalesce(b.l, [])[1 : h.h] || o.l[h.h + 1 :] AS l FROM h JOIN l o ON o.c = h.c LEFT JOIN l b ON b.c = h.b),
  m AS (SELECT c, len(l) AS n, unnest(range(0, len(l) + 1)) AS d, l FROM w),
  n AS (SELECT l[1 : d] AS k, d, min(c) AS conv_id, count(*) AS n_convs, array_to_string(list(c ORDER BY c) FILTER (n = d), ',') AS ends FROM m GROUP BY 1, 2),
  p AS (SELECT k, d, conv_id, n_convs, ends, CASE WHEN d > 0 THEN strlen(k[d].t) ELSE 0 END AS bytes FROM n),
  g AS (SELECT a.d, a.conv_id, count(*) FILTER (b.d = a.d + 1) AS n_children, CAST(sum((b.n_convs - 1) * b.bytes) AS BIGINT) AS saved_tokens,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM p x WHERE x.d = b.d + 1 AND x.k[1 : b.d] = b.k)) AS n_leaves
    FROM p a JOIN p b ON b.d >= a.d AND b.k[1 : a.d] = a.k GROUP BY a.d, a.conv_id)
  SELECT p.conv_id, p.d AS depth, q.conv_id AS parent_conv_id, p.n_convs, g.n_children, g.n_leaves, g.saved_tokens, sha256(coalesce(p.ends, '')) AS ends_sha256
  FROM p JOIN g ON g.d = p.d AND g.conv_id = p.conv_id LEFT JOIN p q ON q.d = p.d - 1 AND p.k[1 : q.d] = q.k"""


def secrets_sql() -> str:
    """Pieces between matches and matches alternate, so their lengths add up to positions."""
    parts, lists = [], []
    for i, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        group = rule.least[0]
        parts.append(
            f"string_split_regex(t, '{pattern}') AS s{i}, regexp_extract_all(t, '{pattern}') AS m{i}, regexp_extract_all(t, '{pattern}', {group}) AS v{i}"
        )
        start = f"list_sum(list_transform(s{i}[1 : j], lambda x: length(x))) + coalesce(list_sum(list_transform(m{i}[1 : j - 1], lambda x: length(x))), 0)"
        item = f"{{'a': CAST({start} AS BIGINT), 'rank': {i}, 'kind': '{rule.kind}', 'b': CAST({start} + length(m{i}[j]) AS BIGINT), 'n': length(v{i}[j])}}"
        lists.append(f"list_filter(list_transform(range(1, len(m{i}) + 1), lambda j: {item}), lambda z: z.n >= {rule.least[1]})")
    shown = "array_to_string(list_transform({}, lambda z: z.kind || ':' || z.a || ':' || z.b), ',')"
    kinds = ", ".join(f"'{r.kind}'" for r in BASE)
    base = f"list_filter(f, lambda z: z.kind IN ({kinds}))"
    counts = ", ".join(f"len(list_filter(f, lambda z: z.kind = '{r.kind}')) AS n_{r.kind}" for r in BASE)
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), p AS (SELECT doc_id, {', '.join(parts)} FROM d), "
        f"q AS (SELECT doc_id, list_sort(flatten([{', '.join(lists)}])) AS f FROM p) "
        f"SELECT doc_id, {counts}, sha256({shown.format(base)}) AS base_sha256, {shown.format('f')} AS spans FROM q"
    )


def fingerprints_sql() -> str:
    """The tree level by level as nested lists, and pieces in common as bags."""

    def joined(items: str) -> str:
        return f"coalesce(array_to_string({items}, ''), '')"

    def tree(text: str) -> str:
        pieces = f"list_transform(regexp_extract_all(p, '{PIECE}'), lambda q: md5(q))"
        lines = f"list_transform(string_split(s, chr(10)), lambda p: {pieces})"
        return f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: {lines})"

    def sections(of: str) -> str:
        lines = f"list_transform(s, lambda l: {{'h': md5({joined('l')}), 'l': l}})"
        return f"list_transform(list_transform({of}, lambda s: {lines}), lambda s: {{'h': md5({joined('list_transform(s, lambda p: p.h)')}), 'p': s}})"

    def shown(of: str) -> str:
        pieces = joined(f"list_transform(p.l, lambda q: substr(q, 1, {SHOWN}))")
        lines = joined(f"list_transform(s.p, lambda p: '/' || substr(p.h, 1, {SHOWN}) || ':' || {pieces})")
        tops = joined(f"list_transform({of}, lambda s: '|' || substr(s.h, 1, {SHOWN}) || {lines})")
        return f"md5({joined(f'list_transform({of}, lambda s: s.h)')}) || {tops}"

    bag = f"list_transform(flatten(flatten({{}})), lambda q: substr(q, 1, {SHOWN}))"
    likeness = (
        "SELECT doc_id, CASE WHEN max(na + nb) = 0 THEN 1.0 ELSE 2 * sum(least(coalesce(a, 0), coalesce(b, 0))) / max(na + nb) END AS near FROM ("
        "SELECT doc_id, x, count(*) FILTER (side = 1) AS a, count(*) FILTER (side = 2) AS b FROM ("
        "SELECT doc_id, 1 AS side, unnest(bt) AS x FROM b UNION ALL SELECT doc_id, 2, unnest({other}) FROM b) GROUP BY ALL) "
        "RIGHT JOIN (SELECT doc_id, len(bt) AS na, len({other}) AS nb FROM b) USING (doc_id) GROUP BY doc_id"
    )
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), "
        "n AS (SELECT *, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nx FROM d), "
        "e AS (SELECT *, substr(t, 1, n - n // 2) || substr(nx, 1, n // 2) AS ed FROM n), "
        f"r AS (SELECT *, {tree('t')} AS rt, {tree('ed')} AS re, {tree('nx')} AS rn FROM e), "
        f"s AS (SELECT *, {sections('rt')} AS st, {sections('re')} AS se FROM r), "
        f"b AS (SELECT *, {bag.format('rt')} AS bt, {bag.format('re')} AS be, {bag.format('rn')} AS bn FROM r), "
        f"le AS ({likeness.format(other='be')}), ln AS ({likeness.format(other='bn')}) "
        f"SELECT doc_id, n AS n_chars, sha256(ed) AS edited_sha256, {shown('st')} AS fingerprint, {shown('se')} AS edited_fingerprint, "
        "le.near AS near_edited, ln.near AS near_next FROM s JOIN le USING (doc_id) JOIN ln USING (doc_id)"
    )
