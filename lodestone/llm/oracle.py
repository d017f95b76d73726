"""DuckDB SQL of the registered queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATION = f"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
spans AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
  FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM spans),
grams AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM words, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, n, i, item FROM grams JOIN spans USING (n, gram)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

#: crc32 bit by bit: a value from 0 up is a byte to mix in, -1 a shift.
CRC32 = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text))) + ")"


def _tree(name: str, start: str) -> str:
    return f"""{name}(tree, level, idx, hash, n) AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 7) // 8
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 8)"""


def _sides(tree: str, first: int) -> str:
    return f"""SELECT p.r, {first} + t.level AS step, coalesce(string_agg(t.hash, '' ORDER BY t.idx) FILTER (t.idx < p.own), '') AS l,
         coalesce(string_agg(t.hash, '' ORDER BY t.idx) FILTER (t.idx > p.own), '') AS g
  FROM {tree} t JOIN (SELECT r, tree, level, place // CAST(pow(8, level) AS BIGINT) AS own FROM places_{tree}, (SELECT DISTINCT level FROM {tree})) p
    ON p.tree = t.tree AND p.level = t.level AND p.own // 8 = t.idx // 8
  WHERE t.n > 1 GROUP BY p.r, t.level"""


MERKLE = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('text')} AS leaf,
         CASE WHEN {CRC32} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf('text')} END AS shown
  FROM documents),
ranked AS (SELECT r, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS place FROM rows),
places_own AS (SELECT r, tree, place FROM ranked),
{_tree('own', "SELECT tree, 0, place, leaf, count(*) OVER (PARTITION BY tree) FROM ranked JOIN rows USING (r)")},
subroots AS (SELECT tree, hash AS subroot FROM own WHERE n = 1),
places_top AS (SELECT r, 0 AS tree, tree AS place FROM ranked),
{_tree('top', "SELECT 0, 0, tree, subroot, count(*) OVER () FROM subroots")},
sides AS ({_sides('own', 0)} UNION ALL {_sides('top', 1000)}),
ordered AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k, l, g FROM sides),
proofs AS (SELECT r, sha256(string_agg(l || g, '' ORDER BY k)) AS proof FROM ordered GROUP BY r),
folds(r, k, hash) AS (
  SELECT r, CAST(0 AS BIGINT), shown FROM rows
  UNION ALL
  SELECT f.r, f.k + 1, sha256(o.l || f.hash || o.g) FROM folds f JOIN ordered o ON o.r = f.r AND o.k = f.k + 1),
folded AS (SELECT r, arg_max(hash, k) AS folded FROM folds GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM rows JOIN ranked USING (r) JOIN subroots USING (tree) JOIN folded USING (r) LEFT JOIN proofs USING (r),
     (SELECT hash AS root FROM top WHERE n = 1)
"""

EXACT_TOPK = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
"""

ORACLES = {"op10_decontamination": DECONTAMINATION, "op11_merkle_manifest": MERKLE, "op12_exact_topk": EXACT_TOPK}
