"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

#: Line dedup: keys in 10 or more documents lose their lines everywhere.
OP3 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: Quality: the base counts by windows over words and lines, the verdict by the rules of quality.default_rules().
OP9 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)
),
tri AS (
  SELECT doc_id, pos, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
),
counted AS (
  SELECT doc_id, pos, w2 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w1, w2) > 1 AS again FROM tri
),
marked AS (
  SELECT doc_id, again OR coalesce(lag(again, 1) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS rep
  FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
),
reps AS (SELECT doc_id, count(*) FILTER (WHERE rep) AS n_repeat_words FROM marked GROUP BY doc_id),
distincts AS (SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
f AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_distinct, 0) AS n_distinct,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) + strlen(text) - strlen(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS n_alpha,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM d LEFT JOIN distincts USING (doc_id) LEFT JOIN line_counts USING (doc_id) LEFT JOIN reps USING (doc_id)
),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         (n_words >= 50 AND n_distinct < 0.1::DOUBLE * pow(n_words, 0.9::DOUBLE))
         OR n_dup_lines > 0.5::DOUBLE * greatest(n_lines, 1)
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR n_symbols > 0.25::DOUBLE * greatest(n_words, 1)
         OR n_upper > 0.5::DOUBLE * greatest(n_alpha, 1)
         OR n_digits > 0.3::DOUBLE * greatest(word_chars, 1)
         OR 2 * n_alpha < word_chars AS cascade_failed
  FROM f
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT cascade_failed AS kept
FROM judged
"""

#: Mixing: water level from the sources in order of size per weight; the partial round in order of the seeded hash.
OP10 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
  FROM documents
),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sized GROUP BY source
),
filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS rest_words,
         sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
  FROM per_source
  WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
-- the first source, in that order, that the level does not fill sets the level
level AS (
  SELECT arg_min(rest_words, source_size / weight) AS words, arg_min(rest_weight, source_size / weight) AS weight
  FROM filled WHERE 2.0::DOUBLE * source_size > rest_words * weight / rest_weight
),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(level.words * p.weight / CAST(level.weight AS DOUBLE), 2.0::DOUBLE * source_size)) AS target
  FROM per_source p LEFT JOIN level ON true
),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM targets
),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole, CAST(floor(g.target) AS BIGINT) - g.whole * g.source_size AS rest,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord) AS BIGINT) AS upto
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - upto + size)) AS BIGINT) AS taken
FROM placed
"""

#: CRC-32 of an ASCII text, bit by bit (3988292384: the reversed polynomial).
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda x: ord(x)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""


def _leaf(text: str) -> str:
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Merkle manifest: levels by recursion, paths by joining each node with its run.
OP11 = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS rid,
         coalesce({CRC32.format("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0 AND doc_id IS NOT NULL, false) AS hit,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), leaves AS (
  SELECT rid, doc_id, source, {_leaf('text')} AS leaf, CASE WHEN hit THEN {_leaf('low')} ELSE {_leaf('text')} END AS claim FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) AS tree
  FROM leaves
), level AS (
  SELECT tree, 0 AS lvl, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM level WHERE n > 1 GROUP BY tree, lvl, idx // 16, n
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM level WHERE n = 1
), toplevel AS (
  SELECT 0 AS lvl, idx, subroot AS h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM toplevel WHERE n > 1 GROUP BY lvl, idx // 16, n
), nodes AS (
  SELECT tree, lvl, idx, h, n FROM level UNION ALL SELECT 0, lvl, idx, h, n FROM toplevel
), sides AS (
  SELECT a.tree, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS after
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 16 = b.idx // 16
  WHERE a.n > 1 GROUP BY ALL
), walk AS (
  SELECT rid, tree AS own, tree, 0 AS lvl, idx, claim AS h, '' AS proof FROM placed
  UNION ALL
  SELECT w.rid, w.own, CASE WHEN s.idx IS NOT NULL THEN w.tree ELSE 0 END, CASE WHEN s.idx IS NOT NULL THEN w.lvl + 1 ELSE 0 END,
         CASE WHEN s.idx IS NOT NULL THEN w.idx // 16 ELSE r.idx END,
         CASE WHEN s.idx IS NOT NULL THEN sha256(s.before || w.h || s.after) ELSE w.h END, w.proof || coalesce(s.before || s.after, '')
  FROM walk w LEFT JOIN sides s ON s.tree = w.tree AND s.lvl = w.lvl AND s.idx = w.idx LEFT JOIN subroots r ON r.tree = w.tree
  WHERE s.idx IS NOT NULL OR w.tree > 0
), ended AS (
  SELECT rid, arg_max(h, (tree = 0, lvl)) AS folded_root, arg_max(proof, (tree = 0, lvl)) AS proof FROM walk GROUP BY rid
)
SELECT p.doc_id, p.leaf, r.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = t.h AS verified
FROM placed p JOIN ended e USING (rid) JOIN subroots r ON r.tree = p.tree JOIN toplevel t ON t.n = 1
"""

#: Chat formatting: the digests from the rows themselves, the length from the marks and the escapes.
OP12 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, '\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|<\|endoftext\|>' AS unsafe FROM c
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, unsafe)) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 8
         ELSE 18 + length(role) + len(regexp_extract_all(role, unsafe)) END AS chars
  FROM m
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _op13() -> str:
    """Repair: per conversation the lightest weight of each grammar state, row by row; a weight is a twelve-digit cost and its audit."""
    def plus(weight: str, cost: str, edit: str) -> str:
        return f"(lpad(CAST(CAST(substr({weight}, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({weight}, 13) || '{edit}')"

    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    moved = []
    for to in range(4):
        ways = [plus(f"w{to}", "2", "D")]
        for (q, symbol), end in step.items():
            if end == to:
                ways.append(f"CASE WHEN NOT gone AND initial = '{symbol}' THEN {plus(f'w{q}', 'more', 'K')} END")
                if symbol != "s":
                    ways.append(f"CASE WHEN NOT gone THEN {plus(f'w{q}', '1 + more', 'R')} END")
        moved.append(f"least({', '.join(ways)}) AS v{to}")
    # insertions: user after nothing, system or assistant, assistant after user; a second one never pays twice
    v2 = f"least(v2, {plus('v0', '5', 'I')}, {plus('v1', '5', 'I')}, {plus('v3', '5', 'I')})"
    inserted = f"v0 AS w0, v1 AS w1, {v2} AS w2, least(v3, {plus(v2, '5', 'I')}) AS w3"
    zero = "'000000000000'"
    return f"""
WITH RECURSIVE kinds AS (
  SELECT *, {CRC32.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind,
         coalesce(role, ' ') AS r, coalesce(text, ' ') AS x
  FROM conversations
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0
), convs AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id NULLS FIRST) AS cid FROM (SELECT DISTINCT conv_id FROM conversations)
), numbered AS (
  SELECT cid, r.*, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM rows r JOIN convs ON convs.conv_id IS NOT DISTINCT FROM r.conv_id
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 AS seen, lag(substr(role, 1, 1)) OVER (PARTITION BY cid ORDER BY i) AS prior,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS unended
  FROM numbered
), faulty AS (
  SELECT *, blank OR seen AS gone, NOT blank AND seen AS duplicate, NOT blank AND NOT seen AND unended AS truncated,
         CASE WHEN unended THEN 5 ELSE 0 END AS more
  FROM judged
), figures AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY cid
), parse AS (
  SELECT cid, 0 AS i, {inserted}
  FROM (SELECT cid, {zero} AS v0, CAST(NULL AS VARCHAR) AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3 FROM convs)
  UNION ALL
  SELECT cid, i, {inserted}
  FROM (SELECT cid, f.i, {', '.join(moved)} FROM parse p JOIN faulty f USING (cid) WHERE f.i = p.i + 1)
), best AS (
  SELECT cid, arg_max(least(w0, w3), i) AS w FROM parse GROUP BY cid
), edits AS (
  SELECT cid, unnest(string_split(substr(w, 13), '')) AS edit, unnest(range(length(w) - 12)) AS pos FROM best WHERE length(w) > 12
), used AS (
  SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY cid ORDER BY pos) AS i FROM edits
), kept AS (
  SELECT u.cid, u.pos, edit, CASE WHEN edit <> 'I' THEN f.role END AS role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text,
         row_number() OVER (PARTITION BY u.cid ORDER BY u.pos) AS nth
  FROM used u LEFT JOIN faulty f ON f.cid = u.cid AND f.i = u.i WHERE edit <> 'D'
), opened AS (
  SELECT *, max(CASE WHEN nth = 1 AND edit = 'K' AND substr(role, 1, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY cid) AS offs FROM kept
), lines AS (
  SELECT cid, pos, CASE WHEN edit = 'K' THEN role WHEN (nth - offs) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text AS line FROM opened
), repaired AS (SELECT cid, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines GROUP BY cid)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(substr(w, 1, 12) AS BIGINT) AS cost, substr(w, 13) AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM convs JOIN best USING (cid) LEFT JOIN figures USING (cid) LEFT JOIN repaired r USING (cid)
"""


OP13 = _op13()

ORACLES = {"op11_merkle_manifest": OP11, "op12_chat_format": OP12, "op13_conversation_repair": OP13, "op3_line_dedup": OP3, "op9_quality": OP9, "op10_mixing": OP10}
