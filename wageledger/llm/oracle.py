"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

RULE_LEDGER = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
win AS (
    SELECT r, i, w[i:i+2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
twice AS (SELECT r, g FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (r, g)) GROUP BY r
),
lines AS (
    SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS again
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
),
m AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_lines,
        coalesce(again, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS n_letters
    FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)
),
f AS (
    SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 20 * n_words)::INT
        + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT
        + 32 * (100 * n_upper > 50 * n_letters)::INT + 64 * (10 * n_letters < 4 * word_chars)::INT AS BIGINT) AS failures
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 != 0 AS base_failed,
    failures = 0 AS kept, failures
FROM f
"""

WARC_CAPTURES = r"""
WITH p AS (
    SELECT page_id, regexp_replace(url, '[\x00-\x20\x7f]', '%20', 'g') AS target_uri, coalesce(html, '') AS h,
        strlen(coalesce(html, '')) AS n
    FROM pages
),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, target_uri,
    CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""

# The weights and the seed are those of the query.
SOURCE_MIX = """
WITH d AS (SELECT *, CASE WHEN source IN ('src0', 'src1', 'src2') THEN source ELSE '*' END AS g FROM documents),
size AS (SELECT g, sum(length(text)) AS n FROM d GROUP BY g),
weight(g, w) AS (VALUES ('src0', 0.25::DOUBLE), ('src1', 0.10), ('src2', 0.10), ('*', 0.55)),
mean AS (SELECT g, w * (SELECT sum(n) FROM size)::DOUBLE / n AS m FROM size JOIN weight USING (g)),
steps AS (SELECT g, m, k, CASE WHEN k = 0 THEN 0.0 ELSE ln(m / k) END AS l FROM mean, range(0, 80) t(k)),
logs AS (SELECT g, k, exp(sum(l) OVER (PARTITION BY g ORDER BY k) - m) AS p FROM steps),
cdf AS (SELECT g, k, sum(p) OVER (PARTITION BY g ORDER BY k) AS c FROM logs),
u AS (SELECT *, ('0x' || md5('2024:' || doc_id || ':0')[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS u FROM d),
n AS (SELECT doc_id, (SELECT count(*) FROM cdf WHERE cdf.g = u.g AND c <= u.u) AS n FROM u)
SELECT d.* EXCLUDE (g), copy_no::INTEGER AS copy_no, md5('2024:place:' || doc_id || ':' || copy_no) AS place
FROM (SELECT doc_id, unnest(range(0, n)) AS copy_no FROM n) JOIN d USING (doc_id)
"""

REMOVED_LINES = r"""
WITH l AS (
    SELECT doc_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)
),
w AS (SELECT doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l),
o AS (SELECT *, len(w) AS n FROM w WHERE len(w) >= 1),
e AS (SELECT w, n, min((doc_id, line_no)) AS rep FROM o GROUP BY w, n),
d AS (SELECT * FROM e WHERE n >= 8),
v AS (SELECT w, n, rep, i, hash(list_concat(w[1:i-1], w[i+1:n])) AS v FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d)),
s AS (SELECT v, i, n, min(rep) AS other FROM v GROUP BY ALL HAVING count(*) > 1),
t AS (
    SELECT w, other FROM v JOIN s USING (v, i, n)
    UNION ALL SELECT v.w, d.rep FROM v JOIN d ON hash(d.w) = v.v AND d.n = v.n - 1
    UNION ALL SELECT d.w, v.rep FROM v JOIN d ON hash(d.w) = v.v AND d.n = v.n - 1
),
f AS (SELECT e.w, rep, least(rep, coalesce(min(other), rep)) AS kept FROM e LEFT JOIN t USING (w) GROUP BY e.w, rep)
SELECT doc_id, line_no::INTEGER AS line_no, kept[1] AS kept_doc_id, kept[2]::INTEGER AS kept_line_no, (kept <> rep)::INTEGER AS edits
FROM o JOIN f USING (w) WHERE (doc_id, line_no) <> kept
"""

EMBEDDING_GROUPS = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT vec_id, least(vec_id, coalesce(min(b), vec_id)) AS component_id FROM embeddings LEFT JOIN r ON a = vec_id GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c
"""


EXACT_GROUPS = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, a byte at a time."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    codes = f"[ascii(c)::BIGINT for c in string_split({text}, '')]"
    step = f"lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"


def merkle_manifest(levels: int = 6) -> str:
    """Up to 16 ** ``levels`` leaves in a source, and as many sources."""
    leaf = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tampered = leaf.replace(_field("text"), _field(lower))
    ctes = [
        f"d AS (SELECT doc_id, source, sha256({leaf}) AS h, CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN sha256({tampered}) END AS x FROM documents)",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d)",
    ]

    def tree(name: str, group: str) -> None:
        for k in range(levels):
            ctes.append(
                f"{name}{k + 1} AS (SELECT {group}, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,"
                f" any_value((n + 15) // 16) AS n, list(h ORDER BY pos) AS run FROM {name}{k} GROUP BY {group}, pos // 16)"
            )

    tree("a", "source")
    ctes.append(f"b0 AS (SELECT 0 AS tree, source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM a{levels})")
    tree("b", "tree")
    # all flanks of a node on the way up: a lone node has none
    for name, group in (("a", "source"), ("b", "tree")):
        joins = " ".join(f"JOIN {name}{k + 1} AS r{k} ON r{k}.{group} IS NOT DISTINCT FROM z.{group} AND r{k}.pos = z.pos // {16 ** (k + 1)}" for k in range(levels))
        at = [f"(z.pos // {16**k} % 16)" for k in range(levels)]
        flanks = ", ".join(f"[array_to_string(r{k}.run[:{at[k]}], ''), array_to_string(r{k}.run[{at[k]} + 2:], ''), (len(r{k}.run) > 1 OR z.n > {16**k})::VARCHAR]" for k in range(levels))
        ctes.append(f"{name}p AS (SELECT z.*, [{flanks}] AS path FROM {name}0 AS z {joins})")
    fold = "list_reduce(list_prepend([coalesce(x, ap.h)], path), lambda c, s: CASE WHEN s[3] = 'true' THEN [sha256(s[1] || c[1] || s[2])] ELSE c END)[1]"
    ctes.append(f"root AS (SELECT h AS root FROM b{levels})")
    ctes.append(
        "p AS (SELECT ap.doc_id, ap.h AS h, ap.x, bp.h AS subroot, list_concat(ap.path, bp.path) AS path FROM ap JOIN bp ON ap.source IS NOT DISTINCT FROM bp.source)"
    )
    ctes.append(f"f AS (SELECT doc_id, h AS leaf, subroot, sha256(array_to_string([s[1] || s[2] for s in path], '')) AS proof_sha256, {fold.replace('ap.h', 'h')} AS folded_root FROM p)")
    return f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f, root"


SOURCE_DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(c) AS n FROM x GROUP BY ALL),
full_ AS (
    SELECT g.lang, g.source, kept.term, coalesce(x.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(x.c, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (kept.c + 5)) // (l.n + 5 * l.v) AS q
    FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN x USING (lang, source, term)
),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM full_ a JOIN full_ b USING (lang, term) GROUP BY ALL),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b USING (lang) LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source WHERE a.source <> b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM full_ WHERE c > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_captures": WARC_CAPTURES,
        "op4_rule_ledger": RULE_LEDGER,
        "op5_removed_lines": REMOVED_LINES,
        "op9_embedding_groups": EMBEDDING_GROUPS,
        "op10_source_mix": SOURCE_MIX,
        "op11_exact_groups": EXACT_GROUPS,
        "op12_merkle_manifest": merkle_manifest(),
        "op13_source_divergence": SOURCE_DIVERGENCE,
    }
