"""DuckDB SQL for the operators that SQL can express."""

from millrace.llm.lines import BASE, DIVISOR, MODULUS, REACH, WINDOW
from millrace.llm.quality import STOP_WORDS, THRESHOLDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _passes() -> str:
    clauses = []
    for t in THRESHOLDS:
        if t.low is not None:
            clauses.append(f"{t.measure} >= {t.of} * {t.low}::DOUBLE")
        if t.high is not None:
            clauses.append(f"{t.measure} <= {t.of} * {t.high}::DOUBLE")
    return " AND ".join(clauses)


QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
lines AS (
  SELECT rid, doc_id, text, words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
grams AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM docs)),
repeated AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
covered AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
            FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM repeated) GROUP BY rid),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop_words,
         len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words
  FROM lines LEFT JOIN covered USING (rid)),
based AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_passes()} AS kept
FROM based
"""



def _rolling() -> str:
    value = "0"
    for back in range(WINDOW - 1, -1, -1):
        value = f"(({value} * {BASE} + CASE WHEN i > {back} THEN hashes[i - {back}] ELSE 0 END) % {MODULUS})"
    return value


def line_dedup(source: str) -> str:
    """Line dedup of a table with ``doc_id`` (unique) and ``text``, as common table expressions up to ``deduped``."""
    return rf"""
line_rows AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM {source}),
line_worded AS (
  SELECT doc_id, lines, list_filter(range(1, len(lines) + 1), lambda i: regexp_matches(lines[i], '[^\x20\x09-\x0D]')) AS pos FROM line_rows),
line_hashes AS (
  SELECT doc_id, lines, pos, list_transform(pos, lambda i: ('0x' || substr(md5(lines[i]), 1, 7))::BIGINT) AS hashes FROM line_worded WHERE len(pos) > 1),
line_ends AS (
  SELECT doc_id, lines, pos,
         list_filter(range(1, len(pos) + 1), lambda i: i = len(pos) OR {_rolling()} % {DIVISOR} = 0 OR (i > 1 AND hashes[i] = hashes[i - 1])) AS ends
  FROM line_hashes),
line_chunks AS (
  SELECT doc_id, lines, pos, ends[k] AS e, CASE WHEN k = 1 THEN 1 ELSE ends[k - 1] + 1 END AS s, coalesce(ends[k + 1], ends[k] + 1) AS q
  FROM (SELECT *, unnest(range(1, len(ends) + 1)) AS k FROM line_ends)),
line_bounds AS (
  SELECT doc_id, lines, pos, unnest(range(greatest(1, least(s, e) - 1, e - {REACH}), e)) AS f, e AS l FROM line_chunks
  UNION ALL SELECT doc_id, lines, pos, s, e FROM line_chunks WHERE s < e - {REACH}
  UNION ALL SELECT doc_id, lines, pos, greatest(e - 1, 1), unnest(range(e + 1, least(q, e + {REACH} + 1))) FROM line_chunks),
line_places AS (
  SELECT doc_id, pos[f] AS first, pos[l] AS last, array_to_string(lines[pos[f]:pos[l]], chr(10)) AS bytes FROM line_bounds),
line_judged AS (
  SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, first) AS n, count(*) OVER (PARTITION BY bytes) AS total FROM line_places),
line_removed AS (
  SELECT doc_id, list_filter(gone, lambda i: NOT coalesce(list_contains(stay, i), false)) AS gone FROM (
    SELECT doc_id, list_distinct(flatten(list(range(first, last + 1)) FILTER (WHERE n > 1))) AS gone,
           list_distinct(flatten(list(range(first, last + 1)) FILTER (WHERE n = 1))) AS stay
    FROM line_judged WHERE total > 1 GROUP BY doc_id)),
deduped AS (
  SELECT line_rows.doc_id, len(lines)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed_lines,
         CASE WHEN coalesce(len(gone), 0) = 0 THEN text ELSE array_to_string(list_transform(
           list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]), chr(10)) END AS text
  FROM line_rows LEFT JOIN line_removed USING (doc_id))"""


LINE_DEDUP = f"WITH {line_dedup('documents')} SELECT doc_id, text, n_lines, n_removed_lines FROM deduped"

TERMS = r"""list_filter(string_split_regex(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


def decontamination(source: str) -> str:
    """Benchmark hits of a table with ``doc_id`` (unique) and ``text``, as common table expressions up to ``hits``."""
    return rf"""
item_words AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {TERMS} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, len(words) AS m, array_to_string(words, ' ') AS phrase FROM (
    SELECT item, words[i:i + 9] AS words FROM (
      SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item_words WHERE len(words) > 0))),
doc_words AS (SELECT doc_id, {TERMS} AS words FROM {source}),
doc_windows AS (
  SELECT doc_id, m, i, array_to_string(words[i:i + m - 1], ' ') AS phrase FROM (
    SELECT doc_id, words, m, unnest(range(1, len(words) - m + 2)) AS i
    FROM doc_words, (SELECT DISTINCT m FROM item_windows))),
found AS (SELECT doc_id, i, m, item FROM doc_windows JOIN item_windows USING (m, phrase)),
hit_words AS (
  SELECT doc_id, count(DISTINCT place)::BIGINT AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + m)) AS place FROM (SELECT DISTINCT doc_id, i, m FROM found)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id),
hits AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
         sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id))"""


DECONTAMINATION = f"WITH {decontamination('documents')} SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM hits"

EXACT = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM normal WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f})::VARCHAR || ':' || {f} END" for f in fields) + ")"


# crc32 of the decimal number, bit by bit.
CRC = """xor(4294967295, list_reduce(
  [4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k::INTEGER)::BIGINT & 1))),
  lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN {CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS part FROM leaves),
up AS (
  SELECT part, 0 AS lvl, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT part, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY part, lvl, pos // 8, n),
subroots AS (SELECT part, node AS subroot FROM up WHERE n = 1),
over AS (
  SELECT 0 AS lvl, part AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS node FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM over WHERE n > 1 GROUP BY lvl, pos // 8, n),
steps AS (
  SELECT part, lvl, pos, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM up WHERE n > 1 WINDOW run AS (PARTITION BY part, lvl, pos // 8 ORDER BY pos)),
over_steps AS (
  SELECT lvl, pos, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM over WHERE n > 1 WINDOW run AS (PARTITION BY lvl, pos // 8 ORDER BY pos)),
walk AS (
  SELECT doc_id, part, leaf, 0 AS lvl, pos AS at, '' AS proof, coalesce(tampered, leaf) AS folded FROM placed
  UNION ALL
  SELECT w.doc_id, w.part, w.leaf, w.lvl + 1, w.at // 8, w.proof || s.before || s.after, sha256(s.before || w.folded || s.after)
  FROM walk w JOIN steps s ON s.part = w.part AND s.lvl = w.lvl AND s.pos = w.at),
inner_walk AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id, leaf ORDER BY lvl DESC) = 1),
over_walk AS (
  SELECT doc_id, part, leaf, 0 AS lvl, part AS at, proof, folded FROM inner_walk
  UNION ALL
  SELECT w.doc_id, w.part, w.leaf, w.lvl + 1, w.at // 8, w.proof || s.before || s.after, sha256(s.before || w.folded || s.after)
  FROM over_walk w JOIN over_steps s ON s.lvl = w.lvl AND s.pos = w.at),
ended AS (SELECT * FROM over_walk QUALIFY row_number() OVER (PARTITION BY doc_id, leaf ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM ended JOIN subroots USING (part) CROSS JOIN (SELECT node AS root FROM over WHERE n = 1)
"""

SQL = {
    "op11_exact_dedup": EXACT,
    "op12_merkle_manifest": MERKLE,
    "op1_line_dedup": LINE_DEDUP,
    "op4_benchmark_decontamination": DECONTAMINATION,
    "op7_quality_rules": QUALITY,
}
