"""SQL twins of the queries that DuckDB expresses, written from the definitions."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def alnum(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


CONTAMINATION = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {alnum('text')} AS w FROM benchmark),
keys AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[k + 1:k + least(10, len(w))], ' ') AS key
  FROM (SELECT *, unnest(range(0, greatest(1, len(w) - 9))) AS k FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {alnum('text')} AS w FROM documents),
places AS (
  SELECT doc_id, k, size, array_to_string(w[k + 1:k + size], ' ') AS key
  FROM (SELECT doc_id, w, size, unnest(range(0, greatest(0, len(w) - size + 1))) AS k
        FROM docs CROSS JOIN (SELECT DISTINCT size FROM keys))),
hits AS (SELECT p.doc_id, p.k, p.size, i.item_id FROM places p JOIN keys i ON p.key = i.key AND p.size = i.size),
words AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS spot FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""

CONTROLS = r"<\|turn\|>|<\|text\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>"


def escaped_length(column: str) -> str:
    return (
        f"(length({column}) + length({column}) - length(replace({column}, chr(92), ''))"
        f" + len(regexp_extract_all({column}, '{CONTROLS}')))"
    )


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len('<|turn|><|text|><|end|>')} + {escaped_length('role')} + {escaped_length('text')}) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_rewrites, CAST(0 AS BIGINT) AS n_unlocated
FROM turns GROUP BY conv_id"""

WARC = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT body, min(page_id) AS first FROM hashed GROUP BY body),
cut AS (SELECT *, list_transform(range(0, 8), lambda g: CAST('0x' || hex[5 * g + 1:5 * g + 5] AS BIGINT)) AS groups FROM hashed)
SELECT page_id, CAST(strlen(cut.body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32),
         lambda i: substr('{ALPHABET}', CAST(((groups[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM cut JOIN firsts ON cut.body = firsts.body"""

SUBSTRING = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, k, sha256(array_to_string(w[k + 1:k + 50], ' ')) AS key
  FROM (SELECT *, unnest(range(0, greatest(0, len(w) - 49))) AS k FROM docs)),
firsts AS (SELECT key, min(doc_id) AS first FROM windows GROUP BY key),
later AS (SELECT doc_id, k FROM windows JOIN firsts USING (key) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS spot FROM later),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS spot FROM docs) ANTI JOIN gone USING (doc_id, spot)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def mixing(shares: dict[str, int], other: int, block_rows: int) -> str:
    """Earliest deadline first over one period of all sources by recursion; sources in order decide ties."""
    named = ", ".join(f"('{name}', {share})" for name, share in sorted(shares.items()))
    return f"""
WITH RECURSIVE given(source, share) AS (VALUES {named}),
present AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS FIRST) AS i, sum(share) OVER () AS total
  FROM (SELECT source, coalesce(any_value(share), {other}) AS share FROM documents LEFT JOIN given USING (source) GROUP BY source)),
docs AS (SELECT doc_id, d.source, i AS name FROM documents d JOIN present p ON d.source IS NOT DISTINCT FROM p.source),
parts AS (SELECT list(share ORDER BY i) AS a, max(total) AS d FROM present),
edf AS (
  SELECT -1 AS slot, 0 AS pick, list_transform(a, lambda x: 0) AS done FROM parts
  UNION ALL
  SELECT slot + 1, chosen, list_transform(range(1, len(done) + 1), lambda j: done[j] + CASE WHEN j = chosen THEN 1 ELSE 0 END)
  FROM (
    SELECT slot, done, list_sort(list_transform(list_filter(range(1, len(a) + 1),
             lambda j: done[j] < a[j] AND done[j] * d // a[j] <= slot + 1),
             lambda j: [(((done[j] + 1) * d + a[j] - 1) // a[j]), j]))[1][2] AS chosen
    FROM edf CROSS JOIN parts WHERE slot + 1 < d)),
slots AS (
  SELECT i AS name, share, total, slot, row_number() OVER (PARTITION BY i ORDER BY slot) - 1 AS k
  FROM edf JOIN present ON pick = i WHERE slot >= 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, source) - 1 AS spot FROM docs),
placed AS (
  SELECT doc_id, source, (spot // {block_rows}) // share * total + slot AS slot, spot % {block_rows} AS place
  FROM numbered JOIN slots USING (name) WHERE (spot // {block_rows}) % share = k),
ends AS (
  SELECT min((n // {block_rows}) // share * total + slot) AS stop
  FROM (SELECT name, count(*) AS n FROM docs GROUP BY name) JOIN slots USING (name) WHERE (n // {block_rows}) % share = k)
SELECT doc_id, source, CAST(slot AS BIGINT) AS slot, CAST(place AS BIGINT) AS place,
       CAST(slot * {block_rows} + place AS BIGINT) AS position, slot < stop AS in_mix
FROM placed CROSS JOIN ends"""


#: The table of crc32, from its polynomial.
CRC_TABLE = """
steps(i, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) AS r(i)
  UNION ALL SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS entries FROM steps WHERE k = 8)"""


def crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes, beside ``crc_table``."""
    byte = f"CAST('0x' || substr(hex(encode({text})), CAST(2 * spot + 1 AS BIGINT), 2) AS BIGINT)"
    data = f"list_transform(range(0, strlen({text})), lambda spot: {byte})"
    step = "xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: {step}), 4294967295)"


def _tree(name: str, leaves: str, levels: int = 6) -> str:
    """Levels of the trees over ``leaves`` (tree, pos, n, digest): nodes with what stands left and right in their run.

    ``name``_up has the roots, ``name``_path(tree, pos) each leaf's siblings and steps to them.
    """
    parts = []
    nodes = leaves
    for k in range(levels):
        run = "PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
        parts.append(f"""
{name}_{k} AS (
  SELECT *, CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
         CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
  FROM {nodes}),
{name}_n{k + 1} AS (
  SELECT tree, CASE WHEN n > 1 THEN pos // 16 ELSE pos END AS pos, any_value(CASE WHEN n > 1 THEN (n + 15) // 16 ELSE n END) AS n,
         CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY {name}_{k}.pos)) ELSE any_value(digest) END AS digest
  FROM {name}_{k} GROUP BY tree, 2)""")
        nodes = f"{name}_n{k + 1}"
    joins = "".join(
        f" JOIN {name}_{k} AS s{k} ON s{k}.tree IS NOT DISTINCT FROM s0.tree"
        f" AND s{k}.pos = CASE WHEN s{k}.n = 1 THEN 0 ELSE s0.pos // {16**k} END"
        for k in range(1, levels)
    )
    steps = ", ".join(f"{{'l': s{k}.l, 'r': s{k}.r}}" for k in range(levels))
    parts.append(f"""
{name}_path AS (
  SELECT s0.tree, s0.pos, list_filter([{steps}], lambda s: s.l IS NOT NULL) AS steps FROM {name}_0 AS s0{joins})""")
    return ",".join(parts) + f",\n{name}_up AS (SELECT tree, digest FROM {nodes})"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_FOLD = (
    "list_reduce(list_prepend({{'l': {0}, 'r': ''}}, path), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l"
)

MERKLE = f"""
WITH RECURSIVE {CRC_TABLE.strip()},
hashes AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0
              THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf('text')} END AS given
  FROM documents CROSS JOIN crc_table),
leaves AS (
  SELECT source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, leaf AS digest, doc_id, given FROM hashes),
bare AS (SELECT tree, pos, n, digest FROM leaves),{_tree('doc', 'bare')},
tops AS (
  SELECT 0 AS tree, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, digest, tree AS source
  FROM doc_up),
top_bare AS (SELECT tree, pos, n, digest FROM tops),{_tree('top', 'top_bare')},
proofs AS (
  SELECT doc_id, leaves.digest AS leaf, given, tops.digest AS subroot, top_up.digest AS root,
         list_concat(doc_path.steps, top_path.steps) AS path
  FROM leaves JOIN doc_path ON doc_path.tree IS NOT DISTINCT FROM leaves.tree AND doc_path.pos = leaves.pos
  JOIN tops ON tops.source IS NOT DISTINCT FROM leaves.tree JOIN top_path ON top_path.pos = tops.pos CROSS JOIN top_up),
again AS (SELECT *, {_FOLD.format('given')} AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM again"""

#: Words one edit apart: one is the other without a code point, or both are equal without that of one position.
SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
keyed AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs),
hashed AS (SELECT run, n, CAST({crc32('key')} AS BIGINT) AS h FROM keyed CROSS JOIN crc_table),
vocabulary AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
shorter AS (
  SELECT word, n, spot, substr(word, 1, spot) || substr(word, spot + 2) AS rest
  FROM (SELECT *, unnest(range(0, length(word))) AS spot FROM vocabulary)),
links AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN vocabulary b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top, min(encode(near)) FILTER (near_n = most) AS form
  FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS most FROM links) GROUP BY word),
formed AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN decode(form) END AS form,
         CASE WHEN top >= 2 * n THEN top END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
followed AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NOT NULL),
ends AS (SELECT f.word, root FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""
