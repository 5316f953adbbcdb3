"""SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from ledgerline.llm.quality import RULES, steps_of

_WORDS = r"[x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"

SUBSTRING_DEDUP = f"""
WITH base AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM base, unnest(range(1, len(w) - 18)) AS t(i)),
placed AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS rn FROM win),
gone AS (SELECT DISTINCT doc_id, p FROM placed, unnest(range(i, i + 20)) AS u(p) WHERE rn > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM base),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS line, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM base LEFT JOIN kept USING (doc_id)
"""


def quality_rules(risk: float = 0.02, level: float = 0.05) -> str:
    """Metrics by unnested windows; the exact binomial tail added up term by term instead of an incomplete beta function."""
    values = ", ".join(f"{r.value} AS v{i}" for i, r in enumerate(RULES))
    steps = steps_of(RULES)
    counts = ", ".join(f"count(*) FILTER ({' OR '.join(f'v{i} > {c}' for i, c in enumerate(step))}) AS x{j}" for j, step in enumerate(steps))
    chosen = ", ".join(
        "CASE " + " ".join(f"WHEN step = {j + 1} THEN {step[i]}" for j, step in enumerate(steps)) + f" END AS c{i}" for i in range(len(RULES))
    )
    failed = ", ".join(f"CASE WHEN v{i} > c{i} THEN '{r.name}' END" for i, r in enumerate(RULES))
    term = f"exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({risk}) + (n - k) * ln(1 - {risk}))"
    return f"""
WITH base AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
        FROM base, unnest(range(1, len(w) - 1)) AS u(i)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM win, unnest(range(i, i + 3)) AS u(p) WHERE c > 1 GROUP BY doc_id),
lined AS (SELECT *, [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS ls FROM base),
counted AS (SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(t) - length(replace(t, '!', '')) AS n_exclaim, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
    length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters FROM lined LEFT JOIN rep USING (doc_id)),
valued AS (SELECT *, {values} FROM counted),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
seen AS (SELECT stratum, count(*) AS n, {counts} FROM valued JOIN good USING (doc_id) GROUP BY stratum),
tested AS (SELECT stratum, n, unnest(range(1, {len(steps) + 1})) AS step, unnest([{', '.join(f'x{j}' for j in range(len(steps)))}]) AS x FROM seen),
tail AS (SELECT stratum, step, list_sum([{term} FOR k IN range(0, x + 1)]) AS p FROM tested),
safe AS (SELECT stratum, max(step) AS step FROM (SELECT *, max(p) OVER (PARTITION BY stratum ORDER BY step) AS worst FROM tail)
    WHERE worst <= {level} / (SELECT count(*) FROM seen) GROUP BY stratum),
chosen AS (SELECT stratum, {chosen} FROM safe),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {failed}) AS failed_rules
    FROM valued LEFT JOIN chosen USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules,
    NOT base_failed AND failed_rules = '' AS kept FROM judged
"""


_CRC_TABLE = """(SELECT list(v ORDER BY b) AS tab FROM (SELECT b, list_reduce([b] || range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(b)))"""


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of ``text``, byte by byte with the table ``tab``."""
    size = f"octet_length(encode({text}))"
    value = f"CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT)"
    step = "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295] || list_transform(range({size}), lambda k: {value}), {step}), 4294967295)"


WARC = """
WITH hashed AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
latest AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM hashed),
parts AS (SELECT *, [CAST('0x' || substr(h, 5 * k + 1, 5) AS BIGINT) FOR k IN range(8)] AS fives FROM latest)
SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((fives[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31) + 1, 1) FOR k IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id < top THEN top END AS refers_to FROM parts
"""

PREFIX_TRIE = f"""
WITH crc AS {_CRC_TABLE},
own AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
    FROM conversations GROUP BY conv_id),
sized AS (SELECT c, s, {_crc32('CAST(c AS VARCHAR)')} % 4 AS h FROM own, crc),
rebuilt AS (SELECT a.c, coalesce(b.s, [])[1:a.h] || a.s[a.h + 1:] AS s FROM sized a LEFT JOIN own b ON b.c = a.c - a.c % 20),
depths AS (SELECT c, len(s) AS n, d AS depth, s[1:d] AS path FROM rebuilt, unnest(range(len(s) + 1)) AS u(d)),
named AS (SELECT c, n, depth, path, min(c) OVER (PARTITION BY depth, path) AS conv_id FROM depths),
nodes AS (SELECT conv_id, depth, count(*) AS n_convs, list(CAST(c AS VARCHAR) ORDER BY c) FILTER (n = depth) AS done,
    (count(*) - 1) * coalesce(len([x FOR x IN string_split_regex(any_value(path[depth].t), '[\\x20\\x09-\\x0D]+') IF x <> '']), 0) AS saved
    FROM named GROUP BY conv_id, depth),
up AS (SELECT nodes.*, a.conv_id AS parent_conv_id FROM nodes LEFT JOIN named a ON a.c = nodes.conv_id AND a.depth = nodes.depth - 1),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
below AS (SELECT a.conv_id, a.depth, sum(b.saved) AS saved_tokens, count(*) FILTER (k.n_children IS NULL) AS n_leaves
    FROM nodes b JOIN named a ON a.c = b.conv_id AND a.depth <= b.depth
    LEFT JOIN kids k ON k.conv_id = b.conv_id AND k.depth = b.depth GROUP BY a.conv_id, a.depth)
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(array_to_string(done, ','), '')) AS ends_sha256
FROM up JOIN below USING (conv_id, depth) LEFT JOIN kids USING (conv_id, depth)
"""

SPELLING = f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
found AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS k FROM found WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32("(doc_id || ':' || run)")} AS h FROM runs, crc),
cut AS (SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS u(i)),
near AS (SELECT a.word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, encode(near))) AS near, max(m) AS m FROM near GROUP BY word),
judged AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN near END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
    FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root FROM judged UNION ALL SELECT walk.word, j.form FROM walk JOIN judged j ON j.word = walk.root WHERE j.form IS NOT NULL),
last AS (SELECT walk.word, walk.root FROM walk JOIN judged j ON j.word = walk.root WHERE j.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN last USING (word)
"""


SQL = {
    "op2_quality_rules": quality_rules(),
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op11_warc": WARC,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_spelling_variants": SPELLING,
}
