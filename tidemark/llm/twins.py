"""SQL twins of the resampling and the Merkle manifest; CRC-32 is spelled out, DuckDB has none."""

from __future__ import annotations

#: The remainders of all bytes, as one row with a list.
REMAINDERS = """
  remainders AS (
    SELECT list(list_reduce(list_concat([b], range(8)), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT unnest(range(256)) AS b))
"""


def crc32(bytes_list: str) -> str:
    """CRC-32 of a list of byte values, given the list ``t`` of remainders."""
    return (
        f"xor(list_reduce(list_concat([4294967295], {bytes_list}), "
        "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
    )


FEATURE_BYTES = """list_transform(range(len(x) // 2), lambda i:
        (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16
        + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)"""
ID_BYTES = "list_transform(range(len(id_text)), lambda i: ascii(substr(id_text, i + 1, 1)))"

RESAMPLING = rf"""
WITH {REMAINDERS},
  texts AS (
    SELECT 'd' AS kind, doc_id, text FROM documents
    UNION ALL SELECT 'b', NULL, text FROM benchmark),
  words AS (
    SELECT kind, doc_id, row_number() OVER () AS r, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
  features AS (
    SELECT kind, r, array_to_string(w[i : i + n - 1], ' ') AS feature
    FROM (SELECT kind, r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM words, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)),
  counted AS (SELECT kind, r, feature, count(*) AS c FROM features GROUP BY ALL),
  hashed AS (
    SELECT feature, {crc32(FEATURE_BYTES)} % 10000 AS bucket
    FROM (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM counted)),
      remainders),
  placed AS (
    SELECT kind, r, bucket, sum(c) AS c FROM counted JOIN hashed USING (feature) GROUP BY ALL),
  sums AS (
    SELECT bucket, coalesce(sum(c) FILTER (kind = 'd'), 0)::DOUBLE AS s,
      coalesce(sum(c) FILTER (kind = 'b'), 0)::DOUBLE AS t
    FROM placed GROUP BY bucket),
  totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
  gains AS (
    SELECT bucket,
      floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS gain
    FROM sums, totals),
  weights AS (
    SELECT r, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY r),
  scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
      coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT
        AS score
    FROM words LEFT JOIN weights USING (r) WHERE kind = 'd'),
  ranks AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranks USING (doc_id)
"""


def field(column: str) -> str:
    value = f"{column}::VARCHAR"
    return (
        f"CASE WHEN {column} IS NULL THEN '-' "
        f"ELSE octet_length(encode({value})) || ':' || {value} END"
    )


def leaf(n_chars: str) -> str:
    parts = [field(c) for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


MERKLE = rf"""
WITH RECURSIVE {REMAINDERS},
  trees AS (
    SELECT lang AS name, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree
    FROM (SELECT DISTINCT lang FROM documents)),
  changed AS (
    SELECT *, CASE WHEN {crc32(ID_BYTES)} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS n_more
    FROM (SELECT *, doc_id::VARCHAR AS id_text FROM documents), remainders),
  hashed AS (SELECT doc_id, lang, {leaf("n_chars")} AS leaf, {leaf("n_more")} AS other FROM changed),
  leaves AS (
    SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place, doc_id, leaf, other
    FROM hashed JOIN trees ON lang IS NOT DISTINCT FROM name),
  nodes(tree, level, place, node) AS (
    SELECT tree, 0, place, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1
    GROUP BY tree, level, place // 2),
  subroots AS (
    SELECT tree, arg_max(node, level) AS subroot, max(level) AS height FROM nodes GROUP BY tree),
  tops(level, place, node) AS (
    SELECT 0, tree, subroot FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, place // 2),
  roots AS (SELECT arg_max(node, level) AS root, max(level) AS top FROM tops),
  found AS (
    SELECT l.tree, l.place, l.level, s.node, s.place < l.place >> l.level AS before
    FROM (SELECT tree, place, unnest(range(height)) AS level FROM leaves JOIN subroots USING (tree)) l
      JOIN nodes s
      ON s.tree = l.tree AND s.level = l.level AND s.place = xor(l.place >> l.level, 1)
    UNION ALL
    SELECT l.tree, l.place, 100 + g.level, s.node, s.place < l.tree >> g.level
    FROM leaves l, (SELECT unnest(range(top)) AS level FROM roots) g
      JOIN tops s ON s.level = g.level AND s.place = xor(l.tree >> g.level, 1)),
  steps AS (
    SELECT tree, place, level, coalesce(node, '') AS node, coalesce(before, false) AS before
    FROM (SELECT tree, place, unnest(list_concat(
            range(height), list_transform(range(top), lambda x: 100 + x))) AS level
          FROM leaves JOIN subroots USING (tree), roots)
      LEFT JOIN found USING (tree, place, level)),
  paths AS (
    SELECT tree, place, sha256(string_agg(node, '' ORDER BY level)) AS proof_sha256,
      list(CASE WHEN before THEN 'b' ELSE 'a' END || node ORDER BY level) AS path
    FROM steps GROUP BY tree, place),
  folded AS (
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
      list_reduce(list_concat([other], coalesce(path, [])), lambda h, s:
        CASE WHEN s[1] = 'b' THEN sha256(s[2:] || h) ELSE sha256(h || s[2:]) END) AS folded_root
    FROM leaves JOIN subroots USING (tree) LEFT JOIN paths USING (tree, place), roots)
SELECT *, folded_root = root AS verified FROM folded
"""
