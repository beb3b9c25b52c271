"""SQL that gives the rows of the operators that SQL can express."""

from __future__ import annotations

from landstrata.llm import licences

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def component_ids(width: int, threshold: tuple[int, int]) -> str:
    """All pairs that share a shingle are counted; links are followed from every document."""
    num, den = threshold
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {width} THEN list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE {den} * c >= {num} * (x.n + y.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT node, min(other) AS component_id FROM reached GROUP BY node) q ON node = d.doc_id"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _terms(text: str) -> str:
    plain = f"regexp_replace(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}.]+', ' ', 'g'), '\\.\\.+', ' ', 'g')"
    return f"list_filter(list_transform(string_split({plain}, ' '), lambda t: trim(t, '.')), lambda t: t <> '')"


def license_scan(threshold: float = licences.THRESHOLD) -> str:
    """Cosines of all units that share a term with a template; directories are walked by their prefixes."""
    templates = ", ".join(f"({n}, {_quoted(spdx)}, {_quoted(said)}, {paragraph}, {decides})" for n, spdx, said, paragraph, decides in licences.ALL)
    sentences = "string_split_regex(regexp_replace(coalesce(text, ''), '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), '[\\n\\r]+')"
    cleaned = "regexp_replace(coalesce(text, ''), '(?m)^[ \\t]*(?:#+|//+|/?\\*+/?|--+|;+|%+)?[ \\t]*', '', 'g')"
    anchor = licences.ANCHOR.removeprefix("(?i)")
    return f"""
WITH templates(template, licence, said, paragraph, decides) AS (VALUES {templates}),
spelt AS (SELECT template, licence, paragraph, decides, unnest({_terms('said')}) AS term FROM templates),
wording AS MATERIALIZED (SELECT template, licence, paragraph, decides, term, count(*) AS tf FROM spelt GROUP BY template, licence, paragraph, decides, term),
files AS MATERIALIZED (
  SELECT doc_id, text, coalesce(source, 'unknown') || '/' || CASE WHEN doc_id >= 100 THEN
           array_to_string(list_transform(range(0, CAST(ceil(length(CAST(doc_id // 100 AS VARCHAR)) / 2) AS BIGINT)), lambda i: substr(CAST(doc_id // 100 AS VARCHAR), CAST(2 * i + 1 AS BIGINT), 2)), '/') || '/' ELSE '' END
         || CASE WHEN doc_id % 100 = 0 THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS path FROM documents),
held AS (SELECT DISTINCT doc_id, unnest({_terms("coalesce(text, '')")}) AS term FROM files),
counted AS MATERIALIZED (SELECT term, count(*) AS n FROM held JOIN (SELECT DISTINCT term FROM wording) w USING (term) GROUP BY term),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
weights AS MATERIALIZED (SELECT term, ln(((SELECT n FROM total) + 1) / (coalesce(c.n, 0) + 1)) + 1 AS w FROM (SELECT DISTINCT term FROM wording) v LEFT JOIN counted c USING (term)),
units AS (SELECT DISTINCT doc_id, false AS paragraph, unnest({sentences}) AS s FROM files
          UNION SELECT DISTINCT doc_id, true, unnest(list_filter(string_split_regex({cleaned}, '\\n(?:[ \\t\\r]*\\n)+'), lambda p: regexp_matches(p, '{anchor}', 'i'))) FROM files),
listed AS (SELECT doc_id, paragraph, s, {_terms('s')} AS terms FROM units),
shares AS (SELECT doc_id, paragraph, s, count(w) AS known, count(*) AS n FROM (SELECT doc_id, paragraph, s, unnest(list_distinct(terms)) AS term FROM listed) q LEFT JOIN weights USING (term) GROUP BY doc_id, paragraph, s),
likely AS (SELECT listed.* FROM listed JOIN shares USING (doc_id, paragraph, s) WHERE known >= greatest(1, n * {threshold} * {threshold})),
spread AS (SELECT doc_id, paragraph, s, unnest(terms) AS term FROM likely),
said AS MATERIALIZED (
  SELECT doc_id, paragraph, s, term, count(*) * coalesce(any_value(w), ln((SELECT n FROM total) + 1) + 1) AS w FROM spread LEFT JOIN weights USING (term) GROUP BY doc_id, paragraph, s, term),
norms AS (SELECT doc_id, paragraph, s, sqrt(sum(w ** 2)) AS norm FROM said GROUP BY doc_id, paragraph, s),
weighed AS (SELECT template, licence, paragraph, decides, term, tf * w AS w FROM wording JOIN weights USING (term)),
template_norms AS (SELECT template, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY template),
dots AS (SELECT doc_id, paragraph, s, template, licence, decides, sum(said.w * t.w) AS dot FROM said JOIN weighed t USING (term, paragraph) GROUP BY doc_id, paragraph, s, template, licence, decides),
near AS (SELECT doc_id, licence, decides, round(dot / (n.norm * t.norm), 9) AS score FROM dots JOIN norms n USING (doc_id, paragraph, s) JOIN template_norms t USING (template)),
own AS MATERIALIZED (
  SELECT files.doc_id, path, regexp_replace(path, '/[^/]*$', '') AS folder, licence, score
  FROM files LEFT JOIN (SELECT doc_id, licence, score, row_number() OVER (PARTITION BY doc_id ORDER BY decides DESC, score DESC, licence) AS place FROM near WHERE score >= {threshold}) q
    ON q.doc_id = files.doc_id AND place = 1),
votes AS (SELECT folder, licence, row_number() OVER (PARTITION BY folder ORDER BY count(*) FILTER (path LIKE '%/LICENSE') DESC, count(*) DESC, licence) AS place FROM own WHERE licence IS NOT NULL GROUP BY folder, licence),
nearest AS (
  SELECT f.folder, v.folder AS directory, v.licence, row_number() OVER (PARTITION BY f.folder ORDER BY length(v.folder) DESC) AS place
  FROM (SELECT DISTINCT folder FROM own) f JOIN votes v ON v.place = 1 AND (f.folder = v.folder OR starts_with(f.folder, v.folder || '/')))
SELECT o.doc_id, o.path, coalesce(o.licence, n.licence) AS licence, o.score,
       CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN n.licence IS NOT NULL THEN 'inherited' END AS origin, CASE WHEN o.licence IS NULL THEN n.directory END AS directory
FROM own o LEFT JOIN nearest n ON n.folder = o.folder AND n.place = 1"""


def _crc32(digits: str) -> str:
    """The unsigned CRC-32 of a short text: one byte after the other, bit by bit."""
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda v, _: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))"
    ascii_codes = f"list_transform(string_split({digits}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {ascii_codes}), lambda c, b: {byte}), 4294967295)"


def prefix_trie() -> str:
    """Every beginning of every rebuilt conversation as a list of turns; every node meets all its ancestors."""
    return f"""
WITH ids AS (SELECT c, c - c % 5 AS leader, CASE WHEN c % 5 = 0 THEN 0 ELSE {_crc32('CAST(c AS VARCHAR)')} % 9 END AS h FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL) q),
turns AS MATERIALIZED (
  SELECT conv_id AS c, said, n_bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS at
  FROM (SELECT conv_id, turn, CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
               octet_length(encode(coalesce(text, ''))) AS n_bytes, sha256(said) AS mark FROM conversations WHERE conv_id IS NOT NULL) q),
rebuilt AS (
  SELECT i.c, t.said, t.n_bytes, t.at AS place FROM ids i JOIN turns t ON t.c = i.leader AND t.at < i.h
  UNION ALL SELECT i.c, t.said, t.n_bytes, 1000 + t.at FROM ids i JOIN turns t ON t.c = i.c AND t.at >= i.h),
paths AS MATERIALIZED (SELECT i.c, coalesce(list(sha256(said) ORDER BY place) FILTER (said IS NOT NULL), []) AS path, coalesce(list(n_bytes ORDER BY place) FILTER (said IS NOT NULL), []) AS sizes
                       FROM ids i LEFT JOIN rebuilt r ON r.c = i.c GROUP BY i.c),
begun AS MATERIALIZED (SELECT c, unnest(list_transform(range(0, len(path) + 1), lambda d: {{'depth': d, 'node': path[1:d], 'up': path[1:d - 1], 'n_bytes': CASE WHEN d = 0 THEN 0 ELSE sizes[d] END}}), recursive := true) FROM paths),
nodes AS MATERIALIZED (SELECT node, any_value(depth) AS depth, any_value(CASE WHEN depth > 0 THEN up END) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes FROM begun GROUP BY node),
children AS (SELECT up AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
above AS (SELECT n.node, unnest(list_transform(range(0, n.depth + 1), lambda d: n.node[1:d])) AS node_above FROM nodes n),
sums AS (SELECT node_above AS node, sum((n_convs - 1) * n_bytes) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
         FROM above a JOIN nodes n ON n.node = a.node LEFT JOIN children k ON k.node = a.node GROUP BY node_above),
ends AS (SELECT path AS node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM paths GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.up LEFT JOIN children k ON k.node = n.node JOIN sums s ON s.node = n.node LEFT JOIN ends e ON e.node = n.node"""


def fill_in_middle() -> str:
    """Tokens as lists; the restored text is the text itself."""
    group = ", ".join(f"CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    return f"""
WITH given AS (SELECT doc_id, coalesce(text, '') AS said, regexp_extract_all(said, '[A-Za-z]+|[^A-Za-z]') AS tokens, CAST(len(tokens) AS BIGINT) AS n, {group} FROM documents),
cut AS (SELECT *, array_to_string(tokens[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
               array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
               array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix,
               CASE WHEN said = '' OR contains(said, '<P>') OR contains(said, '<S>') OR contains(said, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM given)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN said WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(said) AS restored_sha256
FROM cut"""
