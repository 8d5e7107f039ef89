"""DuckDB SQL for the queries whose results SQL can express, written from their definitions alone."""

from __future__ import annotations

# CRC-32 in SQL: the table of its polynomial by rule, then one step per byte.
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc)"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a VARCHAR expression's UTF-8 bytes; ``crc`` must be in scope."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * p::INTEGER + 1, 2))::BIGINT"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen({text})), lambda p: {byte})),"
            " lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255)::INTEGER + 1])))")


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Words near each other share a string among themselves and their one-letter deletions; levenshtein counts bytes, so
# U+00C0 to U+00FF are first put onto 64 one-byte characters that no word holds.
SPELLING = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, {_lower("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}'))")} AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM counted, crc_table),
changed AS (SELECT c, CASE WHEN h % 199 = 0
    THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM hashed),
vocab AS (SELECT word, sum(c)::BIGINT AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
plain AS (SELECT word, n, translate(word,
    list_aggregate(list_transform(range(64), lambda x: chr((192 + x)::INTEGER)), 'string_agg', ''),
    list_aggregate(list_transform(range(64), lambda x: chr((CASE WHEN x < 26 THEN 65 + x ELSE 33 + x - 26
        + CASE WHEN x >= 58 THEN 58 ELSE 0 END END)::INTEGER)), 'string_agg', '')) AS p FROM vocab),
cut AS (SELECT word, n, p, unnest(list_distinct(list_append(list_transform(range(length(p)),
    lambda x: substr(p, 1, x::INTEGER) || substr(p, x::INTEGER + 2)), p))) AS d FROM plain),
near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (d)
    WHERE a.word <> b.word AND levenshtein(a.p, b.p) = 1),
best AS (SELECT word, n, count(*) AS n_near, max(other_n) AS top_n,
    (list(other ORDER BY other_n DESC, other))[1] AS top FROM near GROUP BY word, n),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN top_n >= 5 * v.n THEN top END AS form, CASE WHEN top_n >= 5 * v.n THEN top_n END AS form_n
    FROM vocab v LEFT JOIN best b ON v.word = b.word),
chain AS (SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN chain c ON f.word = c.word AND c.next IS NULL"""

SOURCE_LEVELS, TOP_LEVELS = 7, 5   # 16^7 documents a source and 16^5 sources


def _counted(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _merkle() -> str:
    leaf = lambda text: "sha256(" + " || ".join(
        _counted(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    parts = [CRC_TABLE, f"""rows AS (SELECT row_number() OVER () AS r, doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(_lower("text"))} END AS claimed
    FROM documents, crc_table)""",
             """s0 AS (SELECT r, source AS grp, leaf AS digest,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM rows)"""]

    def climb(name: str, levels: int) -> None:
        """Levels over ``name``0, each with the siblings of its nodes; a lone node moves up as it is."""
        for k in range(levels):
            parts.append(f"""{name}{k}n AS (SELECT *, count(*) OVER (PARTITION BY grp) AS size,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rr
    FROM {name}{k} WINDOW run AS (PARTITION BY grp, i // 16 ORDER BY i))""")
            parts.append(f"""{name}{k + 1} AS (SELECT grp, i // 16 AS i,
    CASE WHEN max(size) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest
    FROM {name}{k}n GROUP BY grp, i // 16)""")

    climb("s", SOURCE_LEVELS)
    parts.append(f"""t0 AS (SELECT '' AS grp, grp AS name, digest,
    row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS i FROM s{SOURCE_LEVELS})""")
    climb("t", TOP_LEVELS)
    joins, folded, sides = [], "coalesce(claimed, leaf)", []
    for k in range(SOURCE_LEVELS):
        joins.append(f"JOIN s{k}n a{k} ON a{k}.grp IS NOT DISTINCT FROM source AND a{k}.i = "
                     + (f"p.i // {16 ** k}" if k else "p.i"))
    joins.append(f"JOIN s{SOURCE_LEVELS} top ON top.grp IS NOT DISTINCT FROM source")
    joins.append("JOIN t0 g ON g.name IS NOT DISTINCT FROM source")
    for k in range(TOP_LEVELS):
        joins.append(f"JOIN t{k}n b{k} ON b{k}.i = g.i // {16 ** k}")
    named = [f"a{k}" for k in range(SOURCE_LEVELS)] + [f"b{k}" for k in range(TOP_LEVELS)]
    parts.append("paths AS (SELECT p.r, doc_id, leaf, claimed, top.digest AS subroot, "
                 + ", ".join(f"{x}.size AS {x}s, {x}.l AS {x}l, {x}.rr AS {x}r" for x in named)
                 + f", (SELECT digest FROM t{TOP_LEVELS}) AS root FROM rows JOIN s0 p ON p.r = rows.r "
                 + " ".join(joins) + ")")
    step = "paths"
    parts.append(f"f0 AS (SELECT *, {folded} AS cur, '' AS sides FROM {step})")
    for k, x in enumerate(named):
        parts.append(f"""f{k + 1} AS (SELECT * REPLACE (
    CASE WHEN {x}s > 1 THEN sha256({x}l || cur || {x}r) ELSE cur END AS cur, sides || {x}l || {x}r AS sides) FROM f{k})""")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(sides) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM f{len(named)}""")


MERKLE = _merkle()


# Captures of all pages: the smallest page id of a payload of 100 bytes or more is its response, others revisit it;
# the rank is by URL key (host labels reversed, then port, path and query), time and id.
ARCHIVE = """
WITH hashed AS (SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM hashed WHERE n >= 100 GROUP BY digest),
cut AS (SELECT hashed.*, first, split_part(trim(coalesce(url, ''), chr(32) || chr(9) || chr(10) || chr(13)), '#', 1) AS u
    FROM hashed LEFT JOIN firsts USING (digest)),
bare AS (SELECT *, CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE u END AS rest FROM cut),
parts AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS site FROM bare),
hosts AS (SELECT *, substr(rest, length(site) + 1) AS path, lower(regexp_extract(site, '([^@]*)$', 1)) AS host FROM parts),
keyed AS (SELECT *, split_part(host, ':', 1) AS name, substr(host, length(split_part(host, ':', 1)) + 2) AS port FROM hosts),
captures AS (SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to,
    array_to_string(list_reverse(list_filter(string_split(name, '.'), lambda x: x <> '')), ',')
        || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END || ')'
        || CASE WHEN path = '' THEN '/' ELSE path END AS urlkey,
    strftime(make_timestamp((1704067200 + page_id % 31536000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts FROM keyed)
SELECT *, row_number() OVER (ORDER BY urlkey, ts, page_id) AS rank FROM captures"""

# Sets of five-word shingles; documents link at 75 hundredths; components by following links to every document.
NEAR_DUPLICATES = f"""
WITH RECURSIVE worded AS (SELECT doc_id,
    regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""
