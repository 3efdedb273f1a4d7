"""SQL counterparts, for DuckDB, of operators whose results SQL can express."""

from __future__ import annotations

# All pairs of distinct sets that share a shingle, then everything that links reach.
NGRAM_JACCARD_JOIN = r"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS row_id, doc_id, list_filter(
    string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS words
  FROM documents
), described AS (
  SELECT row_id, doc_id, list_sort(list_distinct(
    CASE WHEN len(words) BETWEEN 1 AND 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, greatest(len(words) - 2, 1)),
      lambda i: array_to_string(words[i:i + 3], ' ')) END)) AS shingles
  FROM split
), sets AS (
  SELECT md5(array_to_string(shingles, chr(10))) AS set_id, any_value(shingles) AS shingles,
    len(any_value(shingles)) AS n, min(doc_id) AS first
  FROM described WHERE len(shingles) > 0 GROUP BY 1
), grams AS (
  SELECT set_id, n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.set_id AS a, b.set_id AS b
  FROM grams a JOIN grams b ON a.shingle = b.shingle AND a.set_id <> b.set_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.set_id, b.set_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT set_id, set_id AS other FROM sets
  UNION
  SELECT r.set_id, l.b FROM reached r JOIN links l ON r.other = l.a
), components AS (
  SELECT r.set_id, min(s.first) AS component_id
  FROM reached r JOIN sets s ON s.set_id = r.other GROUP BY r.set_id
)
SELECT d.doc_id, len(d.shingles)::BIGINT AS n_shingles,
  CASE WHEN len(d.shingles) = 0 THEN d.doc_id ELSE c.component_id END AS component_id
FROM described d
LEFT JOIN components c
  ON len(d.shingles) > 0 AND c.set_id = md5(array_to_string(d.shingles, chr(10)))
"""

# Steps of a CRC-32 over bytes, by a table of 256 entries that a rule makes.
CRC32 = """
crc_table AS (
  SELECT list(entry ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, unused:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
    FROM (SELECT unnest(range(256))::BIGINT AS b)
  )
)"""


def crc32(text: str) -> str:
    """The CRC-32 of a text in UTF-8, where ``crcs`` of ``crc_table`` is in reach."""
    code = f"hex(encode({text}))"
    octets = (
        f"list_transform(range(1, len({code}) + 1, 2), "
        f"lambda i: ('0x' || {code}[i:i + 1])::BIGINT)"
    )
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: "
        "xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
    )


# Near words meet on what is left of both when a letter is taken away; a place tells a replaced
# letter from two moved ones.
SPELLING_VARIANTS = rf"""
WITH RECURSIVE {CRC32},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(
      unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0
      THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION
  SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near,
    CASE WHEN first(other_n ORDER BY other_n DESC, encode(other)) >= 5 * any_value(n)
      THEN first(other ORDER BY other_n DESC, encode(other)) END AS form,
    CASE WHEN first(other_n ORDER BY other_n DESC, encode(other)) >= 5 * any_value(n)
      THEN first(other_n ORDER BY other_n DESC, encode(other)) END AS form_n
  FROM near GROUP BY word
), found AS (
  SELECT w.word, w.n, b.form, b.form_n, coalesce(b.n_near, 0)::BIGINT AS n_near
  FROM words w LEFT JOIN best b USING (word)
), steps AS (
  SELECT word, word AS at, form AS next FROM found
  UNION ALL
  SELECT s.word, s.next, f.form FROM steps s JOIN found f ON f.word = s.next
)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM found f JOIN steps s ON s.word = f.word AND s.next IS NULL
"""

# Nodes by their whole sequences; a node's ancestors are its smallest member's shorter prefixes.
CONVERSATION_TRIE = f"""
WITH {CRC32},
own AS (
  SELECT conv_id, list(struct_pack(role := role, text := text)
    ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS turns
  FROM (SELECT conv_id, turns, {crc32("conv_id::VARCHAR")} % 9 AS h FROM own, crc_table) o
  LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), prefixes AS (
  SELECT conv_id, depth, turns[:depth] AS start, depth = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS (
  SELECT start, depth, min(conv_id) AS node_id, count(*) AS n_convs,
    coalesce(strlen(start[depth].text), 0) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
      FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY start, depth
), paths AS (
  SELECT p.conv_id, p.depth, n.node_id FROM prefixes p JOIN nodes n USING (depth, start)
), parents AS (
  SELECT n.node_id, n.depth, p.node_id AS parent_id
  FROM nodes n LEFT JOIN paths p ON p.conv_id = n.node_id AND p.depth = n.depth - 1
), children AS (
  SELECT parent_id AS node_id, depth - 1 AS depth, count(*) AS n_children
  FROM parents WHERE parent_id IS NOT NULL GROUP BY ALL
), below AS (
  SELECT p.node_id, p.depth, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens,
    count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves
  FROM nodes n
  JOIN paths p ON p.conv_id = n.node_id AND p.depth <= n.depth
  LEFT JOIN children c ON c.node_id = n.node_id AND c.depth = n.depth
  GROUP BY ALL
)
SELECT n.node_id AS conv_id, n.depth::BIGINT AS depth, p.parent_id AS parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0)::BIGINT AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n
JOIN parents p ON p.node_id = n.node_id AND p.depth = n.depth
JOIN below b ON b.node_id = n.node_id AND b.depth = n.depth
LEFT JOIN children c ON c.node_id = n.node_id AND c.depth = n.depth
"""
