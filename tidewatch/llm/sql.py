"""The SQL that registered queries must equal, where SQL can express them on whole tables."""

# The blanks that are stripped from a line, as the other engine writes them.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_LINES = f"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM cut
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, {_BLANKS}), {_LOWER}) AS key FROM numbered
), repeated AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING min(doc_id) < max(doc_id)
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.owner AS dropped
  FROM keyed k LEFT JOIN repeated r USING (key)
)
"""

_MIX = """
WITH sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size,
    CASE source WHEN 'src0' THEN 4.0 WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 2.0 ELSE 1.0 END::DOUBLE
      AS weight
  FROM documents GROUP BY source
), rated AS (
  SELECT source, weight / (SELECT sum(weight) FROM sizes) * (SELECT sum(size) FROM sizes) / size
    AS rate FROM sizes
), counted AS (
  SELECT source, rate, unnest(range(CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k
  FROM rated
), chances AS (
  SELECT source, k,
    exp(k * ln(rate) - rate - sum(CASE WHEN k > 0 THEN ln(greatest(k, 1)) ELSE 0.0 END) OVER up_to)
      AS chance
  FROM counted WINDOW up_to AS (PARTITION BY source ORDER BY k)
), summed AS (
  SELECT source, k, sum(chance) OVER (PARTITION BY source ORDER BY k) AS upto FROM chances
), drawn AS (
  SELECT doc_id, source,
    (('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u
  FROM documents
), copies AS (
  SELECT d.doc_id, count(*) FILTER (WHERE s.upto < d.u) AS n
  FROM drawn d JOIN summed s ON d.source IS NOT DISTINCT FROM s.source GROUP BY d.doc_id
), repeated AS (
  SELECT doc_id, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM copies
)
"""

_SWAPPED = """
WITH last AS (
  SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), rejected AS (
  SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c LEFT JOIN last l USING (conv_id)
  WHERE l.turn IS NULL OR c.turn < l.turn
  UNION ALL
  SELECT l.conv_id, l.turn, 'assistant', o.text FROM last l JOIN last o ON xor(o.conv_id, 1) = l.conv_id
), sides AS (
  SELECT 'c' AS side, conv_id, turn, role, text FROM conversations
  UNION ALL SELECT 'r', conv_id, turn, role, text FROM rejected
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY side, conv_id ORDER BY turn, role, text) AS pos,
    '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body
  FROM sides
), matched AS (
  SELECT conv_id, pos, count(DISTINCT side || role || ':' || text) AS turns,
    count(DISTINCT role || ':' || text) AS kinds FROM placed GROUP BY conv_id, pos
), common AS (
  SELECT conv_id, CAST(coalesce(min(pos) FILTER (WHERE NOT (turns = 2 AND kinds = 1)) - 1, max(pos))
    AS INTEGER) AS n FROM matched GROUP BY conv_id
)
SELECT p.conv_id, any_value(n) AS n_prompt_turns"""

_SIDE = """,
  coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE {where}), '') AS {name}"""
_MASK = """,
  coalesce(string_agg(length(head) || '- ' || length(body)
    || CASE role WHEN 'assistant' THEN '+' ELSE '-' END, ' ' ORDER BY pos)
    FILTER (WHERE {where}), '') AS {name}"""

# crc32 of a key's decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    [4294967295] || list_transform(string_split(CAST({key} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = [f"CAST({name} AS VARCHAR)" for name in ("doc_id", "source", "lang", "n_chars")]
    return f"sha256({' || '.join(map(_field, [*fields, text]))})"


# One level up a tree: the run's digests, what a digest folds to between its siblings, and those.
_KIDS = """
  SELECT tree, level, place // 8 AS run, list(digest ORDER BY place) AS kids FROM {nodes} GROUP BY ALL"""
_UP = """
  SELECT n.tree, n.level + 1, n.place // 8, (n.size + 7) // 8,
    sha256(string_agg(n.digest, '' ORDER BY n.place)) FROM {nodes} n WHERE n.size > 1
  GROUP BY n.tree, n.level, n.place // 8, n.size"""
_STEP = """
  SELECT c.doc_id, c.tree, c.level + 1, c.place // 8, (c.size + 7) // 8,
    sha256(array_to_string(k.kids[:c.place % 8] || [c.folded] || k.kids[c.place % 8 + 2:], '')),
    c.proof || array_to_string(k.kids[:c.place % 8] || k.kids[c.place % 8 + 2:], '')
  FROM {climb} c JOIN {kids} k ON c.tree = k.tree AND c.level = k.level AND c.place // 8 = k.run
  WHERE c.size > 1"""

_MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC.format(key="doc_id")} % 3 = 0 THEN {_leaf(f"translate(text, {_LOWER})")} END
      AS tampered,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS size FROM documents
), nodes(tree, level, place, size, digest) AS (
  SELECT tree, 0, place, size, leaf FROM leaves UNION ALL {_UP.format(nodes="nodes")}
), kids AS ({_KIDS.format(nodes="nodes")}
), subroots AS (SELECT tree, digest FROM nodes WHERE size = 1
), tops(tree, level, place, size, digest) AS (
  SELECT -1, 0, tree, (SELECT count(*) FROM subroots), digest FROM subroots
  UNION ALL {_UP.format(nodes="tops")}
), top_kids AS ({_KIDS.format(nodes="tops")}
), climb(doc_id, tree, level, place, size, folded, proof) AS (
  SELECT doc_id, tree, 0, place, size, coalesce(tampered, leaf), '' FROM leaves
  UNION ALL {_STEP.format(climb="climb", kids="kids")}
), last_climb(doc_id, tree, level, place, size, folded, proof) AS (
  SELECT doc_id, -1, 0, tree, (SELECT count(*) FROM subroots), folded, proof FROM climb WHERE size = 1
  UNION ALL {_STEP.format(climb="last_climb", kids="top_kids")}
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(c.proof) AS proof_sha256,
  c.folded AS folded_root, c.folded = r.digest AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN last_climb c ON c.doc_id = l.doc_id AND c.size = 1
  CROSS JOIN (SELECT digest FROM tops WHERE size = 1) r
"""

_TERMS = f"""regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
_RANKED = f"""
WITH cut AS (
  SELECT doc_id, {_TERMS} AS terms FROM documents
), stats AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM cut WHERE len(terms) > 0
), damped AS (
  SELECT doc_id, terms, 75 + (25 * len(terms) * docs) // total AS m FROM cut, stats
  WHERE len(terms) > 0
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), held AS (
  SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(terms) AS term FROM damped)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, stats GROUP BY term
), scored AS (
  SELECT item_id, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weighted USING (term) GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLES: dict[str, str] = {
    "op11_ranked_search": _RANKED,
    "op12_merkle": _MERKLE,
    "op1_mixing": _MIX + """
SELECT d.*, r.copy,
  ('0x' || substr(md5('mix/order:' || doc_id || ':' || r.copy), 1, 13))::BIGINT AS shuffle_key
FROM documents d JOIN repeated r USING (doc_id)
""",
    "op5_line_dedup": _LINES + """
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op3_preferences": _SWAPPED
    + _SIDE.format(where="side = 'c' AND pos <= n", name="prompt")
    + _SIDE.format(where="side = 'c' AND pos > n", name="chosen")
    + _MASK.format(where="side = 'c' AND pos > n", name="chosen_mask")
    + _SIDE.format(where="side = 'r' AND pos > n", name="rejected")
    + _MASK.format(where="side = 'r' AND pos > n", name="rejected_mask")
    + """
FROM placed p JOIN common USING (conv_id) GROUP BY p.conv_id
""",
}
