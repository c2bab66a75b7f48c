"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
p AS (
  SELECT *, sum(n) OVER () AS total,
         coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_caps,
         sum(w) OVER (ORDER BY 3 * n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM s),
c AS (SELECT *, 3 * n * open_w <= w * (total - lower_caps) AS full_up FROM p),
t AS (
  SELECT source, n,
         CASE WHEN full_up THEN CAST(3 * n AS DOUBLE)
              ELSE w * (CAST(total - coalesce(sum(3 * n) FILTER (full_up) OVER (), 0) AS DOUBLE)
                        / CAST(sum(w) FILTER (NOT full_up) OVER () AS DOUBLE)) END AS target
  FROM c),
r AS (
  SELECT d.doc_id, d.size, t.n, t.target,
         CASE WHEN t.n > 0 THEN CAST(floor(t.target / t.n) AS BIGINT) ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       CAST(whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * n - ahead)) AS BIGINT) AS taken
FROM r"""

URL_FILTERS = r"""
WITH RECURSIVE
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (
  SELECT row_number() OVER () AS n, page_id, url, html,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_replace(url, '(?s)#.*$', '') AS bare
  FROM pages),
linked AS (
  SELECT bare AS a, unnest([regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
                            regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*\bcontent\s*=\s*["''][^"''>]*?\burl\s*=\s*([^"''\s>]+)', 1)]) AS b
  FROM p WHERE url IS NOT NULL),
e AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked) WHERE a <> '' AND b <> ''),
reach(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
nodes AS (
  SELECT DISTINCT b AS node, regexp_extract(b, '(?s)^.*?://([^/?#]*)', 1) AS host, regexp_extract(b, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM e),
said AS (
  SELECT node, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM nodes n JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
  GROUP BY node),
shared AS (
  SELECT reach.a AS node, bool_or(said.verdict = 'block') AND NOT bool_or(said.verdict = 'allow') AS blocked
  FROM reach JOIN said ON said.node = reach.b GROUP BY reach.a),
own AS (
  SELECT p.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.n)
SELECT p.page_id, p.host, p.path, own.rule,
       coalesce(own.verdict, CASE WHEN shared.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN own ON own.n = p.n LEFT JOIN shared ON shared.node = p.bare"""


DECONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS terms
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, list_slice(w, i, i + n - 1) AS terms
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN lengths WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.terms = bw.terms),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
item AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)"""


JACCARD = r"""
WITH RECURSIVE
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
c AS MATERIALIZED (
  SELECT min(r) AS c, w, count(*) AS copies, list(r) AS rows FROM d WHERE len(w) > 0 GROUP BY w),
s AS MATERIALIZED (
  SELECT DISTINCT c, list_slice(w, i, i + least(5, len(w)) - 1) AS sh
  FROM (SELECT c, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM c)),
z AS (SELECT c, count(*) AS n FROM s GROUP BY c),
both_in AS (SELECT x.c AS a, y.c AS b, count(*) AS n FROM s x JOIN s y ON x.sh = y.sh AND x.c <> y.c GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM both_in i JOIN z za ON za.c = i.a JOIN z zb ON zb.c = i.b
  WHERE 5 * i.n >= 4 * (za.n + zb.n - i.n)),
reach(a, b) AS (SELECT c, c FROM c UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
grp AS (SELECT a AS c, min(b) AS g FROM reach GROUP BY a),
deg AS (SELECT a AS c, sum(c.copies) AS n FROM link JOIN c ON c.c = link.b GROUP BY a),
member AS (SELECT c.c, unnest(c.rows) AS r, c.copies FROM c),
first_id AS (SELECT g, min(doc_id) AS class_id FROM member JOIN grp USING (c) JOIN d USING (r) GROUP BY g)
SELECT d.doc_id, CASE WHEN len(d.w) = 0 THEN d.doc_id ELSE class_id END AS class_id,
       CAST(coalesce(member.copies - 1 + coalesce(deg.n, 0), 0) AS BIGINT) AS n_links
FROM d LEFT JOIN member USING (r) LEFT JOIN grp USING (c) LEFT JOIN first_id USING (g) LEFT JOIN deg USING (c)"""



#: The table of CRC-32, from its rule, and the CRC of the UTF-8 bytes of a text column.
CRC_TABLE = """
crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    """``text`` with the table ``crc.t`` in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)),"
            f" lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)")


SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (SELECT run, times, {crc32("(id || ':' || run)")} AS h FROM runs, crc),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) AS p, substr(word, i + 2) AS s FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = cut.p || cut.s
  UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = cut.p || cut.s),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS n FROM near GROUP BY word),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * v.n THEN other END AS form,
         CASE WHEN best.n >= 5 * v.n THEN best.n END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain(word, pos) AS (SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.pos WHERE f.form IS NOT NULL)
SELECT f.word, f.form, ends.pos AS root, f.n, f.n_near, f.form_n
FROM f JOIN (SELECT chain.word, chain.pos FROM chain JOIN f ON f.word = chain.pos WHERE f.form IS NULL) ends USING (word)"""


def _merkle_levels(name: str, tree: str, most: int) -> str:
    """Levels ``{name}0 .. {name}{most}`` (tree, pos, n, digest) of the trees of
    ``{name}0``, and the digests beside each node of a level."""
    out = []
    for k in range(most):
        out.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT {tree}, pos // 8 AS pos, count(*) OVER (PARTITION BY {tree}) AS n, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
  FROM {name}{k} WHERE n > 1 GROUP BY {tree}, pos // 8),
{name}_beside{k} AS MATERIALIZED (
  SELECT {tree}, pos, coalesce(string_agg(digest, '') OVER (before ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (before ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE n > 1 WINDOW before AS (PARTITION BY {tree}, pos // 8 ORDER BY pos))""")
    return ",\n".join(out)


def _merkle() -> str:
    """The manifest's SQL: up to 8 levels in a language, 3 over the languages."""
    def digest(*fields):
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in fields) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    own, over = 8, 3
    steps = []
    for k in range(own):
        steps.append(f"""p{k + 1} AS MATERIALIZED (
  SELECT p.* REPLACE (p.pos // 8 AS pos, CASE WHEN b.pos IS NULL THEN p.node ELSE sha256(b.l || p.node || b.r) END AS node, p.proof || coalesce(b.l || b.r, '') AS proof)
  FROM p{k} p LEFT JOIN a_beside{k} b ON p.pos = b.pos AND p.tree = b.tree)""")
    for k in range(over):
        steps.append(f"""q{k + 1} AS MATERIALIZED (
  SELECT q.* REPLACE (q.place // 8 AS place, CASE WHEN b.pos IS NULL THEN q.node ELSE sha256(b.l || q.node || b.r) END AS node, q.proof || coalesce(b.l || b.r, '') AS proof)
  FROM q{k} q LEFT JOIN b_beside{k} b ON q.place = b.pos)""")
    tops = " UNION ALL ".join(f"SELECT tree, digest FROM a{k} WHERE n = 1" for k in range(own + 1))
    roots = " UNION ALL ".join(f"SELECT digest FROM b{k} WHERE n = 1" for k in range(over + 1))
    return f"""
WITH {CRC_TABLE},
d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {digest("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {digest("doc_id", "source", "lang", "n_chars", lower)} END AS other
  FROM documents, crc),
a0 AS MATERIALIZED (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_merkle_levels("a", "tree", own)},
b0 AS MATERIALIZED (SELECT 0 AS every, tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM ({tops})),
{_merkle_levels("b", "every", over)},
p0 AS (SELECT doc_id, tree, pos, leaf, coalesce(other, leaf) AS node, '' AS proof FROM a0),
{", ".join(steps[:own])},
q0 AS (SELECT p.*, b0.pos AS place, b0.digest AS subroot FROM p{own} p JOIN b0 USING (tree)),
{", ".join(steps[own:])},
root AS ({roots})
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = root.digest AS verified
FROM q{over} CROSS JOIN root"""


MANIFEST = _merkle()


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": MIXING, "op4_decontamination": DECONTAMINATION, "op6_jaccard": JACCARD, "op8_url_filters": URL_FILTERS,
            "op12_spelling": SPELLING, "op13_manifest": MANIFEST}
