"""SQL for another engine that gives the same rows as the queries, where SQL can express them. Ids are taken to be unique."""

from __future__ import annotations

from freightlane.llm import decontaminate as dc
from freightlane.llm import host_quality as hq
from freightlane.llm import license_scan as ls
from freightlane.llm import prefix_trie as pt
from freightlane.llm import spelling as sp
from freightlane.llm import substring_dedup as sd

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TOKENS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digits FROM pages),
lasts AS (SELECT body, max(page_id) AS last FROM bodies GROUP BY body),
parts AS (
    SELECT bodies.*, last, unnest(range(0, 32)) AS nth FROM bodies JOIN lasts USING (body)
),
letters AS (
    SELECT page_id, body, last, nth,
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(digits, (1 + 5 * (nth // 4))::INT, 5))::BIGINT >> (15 - 5 * (nth % 4))::INT) % 32 + 1)::INT, 1) AS letter
    FROM parts
)
SELECT page_id, strlen(any_value(body))::BIGINT AS payload_bytes, string_agg(letter, '' ORDER BY nth) AS payload_digest,
    CASE WHEN page_id = any_value(last) THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> any_value(last) THEN any_value(last) END AS refers_to
FROM letters GROUP BY page_id
"""


def _templates() -> str:
    rows = [(f"phrase {i}", label, "true", 2, text.split()) for i, (text, label) in enumerate(ls.PHRASES.items())]
    rows += [(f"notice {i}", label, "false", ls.NOTICE_GRAM, text.split()) for i, (label, text) in enumerate(ls.NOTICES.items())]
    return ", ".join(f"('{n}', '{label}', {p}, {k}, {w!r})" for n, label, p, k, w in rows)


OP3 = f"""
WITH docs AS (SELECT doc_id, {TOKENS} AS ws FROM documents),
templates(template, label, phrase, k, ws) AS (VALUES {_templates()}),
grams AS (SELECT template, label, phrase, k, len(ws) AS n, unnest(range(0, len(ws) - k + 1)) AS pos, ws FROM templates),
keyed AS (SELECT template, label, phrase, k, n, pos, ws[pos + 1 : pos + k] AS gram FROM grams),
places AS (SELECT doc_id, ws, unnest(range(0, len(ws))) AS place FROM docs),
windows AS (
    SELECT doc_id, place, 2 AS k, ws[place + 1 : place + 2] AS gram FROM places
    UNION ALL SELECT doc_id, place, {ls.NOTICE_GRAM}, ws[place + 1 : place + {ls.NOTICE_GRAM}] FROM places
),
votes AS (
    SELECT doc_id, template, label, phrase, keyed.k AS k, n, place - pos AS diagonal, pos
    FROM windows JOIN keyed ON windows.k = keyed.k AND windows.gram = keyed.gram
),
diagonals AS (
    SELECT DISTINCT doc_id, template, label, phrase, k, n, diagonal FROM votes
),
marked AS (
    SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal), 999)
        > {ls.MERGE_DIAGONALS} THEN 1 ELSE 0 END AS own FROM diagonals
),
grouped AS (
    SELECT *, sum(own) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked
),
covered AS (
    SELECT doc_id, template, span, count(DISTINCT pos + j) AS words FROM (
        SELECT g.doc_id, g.template, g.span, v.pos, unnest(range(0, g.k)) AS j
        FROM grouped g JOIN votes v ON g.doc_id = v.doc_id AND g.template = v.template AND g.diagonal = v.diagonal
    ) GROUP BY doc_id, template, span
),
measured AS (
    SELECT g.doc_id, g.template, g.span, any_value(g.label) AS label, bool_and(g.phrase) AS phrase, any_value(g.n) AS n,
        min(g.diagonal) AS first_word, max(v.pos) - min(v.pos) + any_value(g.k) + max(g.diagonal) - min(g.diagonal) AS length
    FROM grouped g JOIN votes v ON g.doc_id = v.doc_id AND g.template = v.template AND g.diagonal = v.diagonal
    GROUP BY g.doc_id, g.template, g.span
),
spans AS (
    SELECT m.doc_id, label, phrase, first_word, words / n::DOUBLE AS coverage
    FROM measured m JOIN covered c ON m.doc_id = c.doc_id AND m.template = c.template AND m.span = c.span
    WHERE CASE WHEN phrase THEN words = n
        ELSE words / n::DOUBLE >= {ls.COVERAGE} AND words / length::DOUBLE >= {ls.COVERAGE} END
),
facts AS (
    SELECT doc_id, count(*) FILTER (WHERE phrase) AS n_base, min(first_word) FILTER (WHERE phrase) AS first_word,
        max(first_word) FILTER (WHERE phrase) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
    FROM spans GROUP BY doc_id
)
SELECT docs.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN facts ON docs.doc_id = facts.doc_id
"""

OP5 = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i : i + 1])
        WHEN len(ws) = 1 THEN [ws] ELSE [] END) AS shingle FROM docs
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT x, y FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
    WHERE 100 * common.n >= 80 * (sx.n + sy.n - common.n)
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs UNION SELECT reached.doc_id, y FROM reached JOIN links ON x = other
)
SELECT docs.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id, docs.doc_id = min(other) AS kept
FROM docs JOIN reached ON docs.doc_id = reached.doc_id LEFT JOIN sizes ON docs.doc_id = sizes.doc_id GROUP BY docs.doc_id
"""


def _hosts() -> str:
    """The moments, priors and verdicts of each rule."""
    rates = ", ".join(f"count(*) FILTER (WHERE {test})::DOUBLE AS f_{r}" for r, test in hq.SOFT_RULES.items())
    moments = ", ".join(f"sum(f_{r}) / sum(n) AS m_{r}, sum(f_{r} * f_{r} / n) / sum(n) AS q_{r}" for r in hq.SOFT_RULES)
    prior = lambda r: (
        f"CASE WHEN q_{r} - m_{r} * m_{r} - m_{r} * (1 - m_{r}) * hosts / docs > 0 THEN least(greatest("
        f"m_{r} * (1 - m_{r}) / (q_{r} - m_{r} * m_{r} - m_{r} * (1 - m_{r}) * hosts / docs) - 1, 1), 1000000) ELSE 1000000 END"
    )
    weights = ", ".join(f"{prior(r)} AS w_{r}" for r in hq.SOFT_RULES)
    bad = ", ".join(f"(f_{r} + m_{r} * w_{r}) / (n + w_{r}) > {hq.MAX_RATE} AS bad_{r}" for r in hq.SOFT_RULES)
    return f"""
hosts AS (SELECT source, count(*)::DOUBLE AS n, {rates} FROM facts GROUP BY source),
moments AS (SELECT sum(n) AS docs, count(*) AS hosts, {moments} FROM hosts),
priors AS (SELECT *, {weights} FROM moments),
verdicts AS (SELECT source, {bad} FROM hosts, priors)"""


OP7 = rf"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
),
windows AS (
    SELECT doc_id, place, ws[place : place + 2] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS place FROM docs)
),
counted AS (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
repeats AS (
    SELECT doc_id, count(DISTINCT place + j) AS n FROM (SELECT doc_id, place, unnest([0, 1, 2]) AS j FROM counted WHERE n > 1) GROUP BY doc_id
),
facts AS (
    SELECT docs.doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '{hq.SYMBOLS}'))::BIGINT AS n_symbols, len(lines) AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
    FROM docs LEFT JOIN repeats ON docs.doc_id = repeats.doc_id
),{_hosts()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < {hq.MIN_WORDS} OR 100 * n_repeat_words > {hq.MAX_REPEATED} * n_words) AS base_failed,
    NOT (n_words < {hq.MIN_WORDS} OR 100 * n_repeat_words > {hq.MAX_REPEATED} * n_words
        OR {" OR ".join(f"({test} AND bad_{r})" for r, test in hq.SOFT_RULES.items())}) AS kept
FROM facts JOIN verdicts ON facts.source IS NOT DISTINCT FROM verdicts.source
"""


def _seeds(table: str, key: str) -> str:
    """The words that each mask selects, at every place of a full window."""
    span = len(dc.MASKS[0])
    chosen = lambda m: ", ".join(f"ws[place + {i + 1}]" for i, on in enumerate(m) if on == "1")
    return " UNION ALL ".join(
        f"SELECT {key}, place, {n} AS mask, [{chosen(m)}] AS seed FROM"
        f" (SELECT {key}, ws, unnest(range(0, len(ws) - {span - 1})) AS place FROM {table})"
        for n, m in enumerate(dc.MASKS)
    )


OP8 = f"""
WITH docs AS (SELECT doc_id, {TOKENS} AS ws FROM documents),
items AS (SELECT item_id, {TOKENS} AS ws FROM benchmark),
doc_seeds AS ({_seeds("docs", "doc_id")}),
item_seeds AS ({_seeds("items", "item_id")}),
hits AS (
    SELECT DISTINCT doc_id, item_id, d.place - i.place AS diagonal
    FROM doc_seeds d JOIN item_seeds i ON d.mask = i.mask AND d.seed = i.seed
),
aligned AS (
    SELECT h.doc_id, h.item_id, greatest(diagonal, 0) AS first_word, len(items.ws) AS n_item, least({dc.WINDOW}, len(items.ws)) AS length,
        list_transform(range(greatest(-diagonal, 0), least(len(items.ws), len(docs.ws) - diagonal)),
            lambda i: CASE WHEN docs.ws[diagonal + i + 1] = items.ws[i + 1] THEN 1 ELSE 0 END) AS same
    FROM hits h JOIN docs ON docs.doc_id = h.doc_id JOIN items ON items.item_id = h.item_id
),
starts AS (
    SELECT *, unnest(range(1, len(same) - length + 2)) AS start FROM aligned WHERE len(same) >= length
),
proven AS (
    SELECT DISTINCT doc_id, item_id, first_word, n_item, same FROM starts
    WHERE list_sum(same[start : start + length - 1]) >= ceil(length * {dc.AGREE})
),
measured AS (SELECT doc_id, item_id, first_word, list_sum(same) AS n_agree, len(same) AS n_aligned, n_item FROM proven),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_agree DESC, n_aligned DESC, first_word) AS nth FROM measured
)
SELECT doc_id, item_id, first_word::BIGINT AS first_word, n_agree::BIGINT AS n_agree, n_aligned::BIGINT AS n_aligned,
    n_agree / n_item::DOUBLE AS share FROM ranked WHERE nth = 1
"""

OP10 = """
WITH calls AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
results AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
linked AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn - 1) AS of_turn, c.turn AS call_turn, r.turn AS result_turn,
        c.text AS question, r.text AS reply
    FROM calls c FULL OUTER JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.turn - 1
),
named AS (
    SELECT *, 'turn-' || of_turn AS call_id, CASE WHEN call_turn IS NOT NULL THEN 'reply' END AS name,
        CASE WHEN call_turn IS NULL THEN 'orphan' WHEN result_turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
        CASE WHEN call_turn IS NOT NULL AND coalesce(question, '') = '' THEN '$.text: length' ELSE '' END AS errors
    FROM linked
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(call_turn, result_turn), call_id, status) - 1 AS position FROM named
)
SELECT conv_id, call_id, name, call_turn, result_turn, status, (call_turn IS NOT NULL)::BIGINT AS n_calls,
    (result_turn IS NOT NULL)::BIGINT AS n_results, errors, position::BIGINT AS position,
    '{"arguments":' || CASE WHEN call_turn IS NULL THEN 'null' ELSE '{"text":' || to_json(coalesce(question, ''))::VARCHAR || '}' END
        || ',"call_id":"' || call_id || '","conversation":' || conv_id || ',"errors":"' || errors || '","name":'
        || CASE WHEN name IS NULL THEN 'null' ELSE '"' || name || '"' END || ',"position":' || position
        || ',"result":' || CASE WHEN result_turn IS NULL THEN 'null' ELSE to_json(coalesce(reply, ''))::VARCHAR END
        || ',"status":"' || status || '"}' AS record
FROM placed
"""

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
placed AS (SELECT r, unnest(range(1, len(ws) + 1)) AS p, ws FROM docs),
windows AS (
    SELECT r, p, ws[p] AS word,
        CASE WHEN p + {sd.SPAN - 1} <= len(ws) THEN array_to_string(ws[p : p + {sd.SPAN - 1}], ' ') END AS span
    FROM placed
),
counted AS (SELECT r, p, word, span IS NOT NULL AND count(*) OVER (PARTITION BY span) > 1 AS again FROM windows),
marked AS (
    SELECT r, p, word,
        max(again::INT) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {sd.SPAN - 1} PRECEDING AND CURRENT ROW) AS gone FROM counted
),
summed AS (
    SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone = 0) AS rest FROM marked GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN summed USING (r)
"""

# CRC-32 of a text of characters below U+0800: the table by its rule, then byte by byte.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs"""


def _crc32(text: str) -> str:
    code = "CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + ord(x) // 64, 128 + ord(x) % 64]::BIGINT[] END"
    codes = f"flatten(list_transform(string_split({text}, ''), lambda x: {code}))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"


OP12 = f"""
WITH RECURSIVE tab AS ({CRC_TABLE}),
found AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]{{{sp.MIN_LENGTH},}}')) AS run FROM documents
),
lowered AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM found),
hashed AS (SELECT run, length(run) AS size, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM lowered, tab),
changed AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word FROM hashed
),
words AS (SELECT word, count(*) AS n FROM changed WHERE length(word) >= {sp.MIN_LENGTH} GROUP BY word HAVING count(*) >= {sp.MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
pairs AS (
    SELECT a.word AS word, b.word AS near, b.n AS near_n FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM masked a JOIN words b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM masked a JOIN words b ON a.less = b.word
),
best AS (
    SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS nth FROM pairs
),
formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {sp.RATIO} * words.n THEN near END AS form,
        CASE WHEN near_n >= {sp.RATIO} * words.n THEN near_n END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word AND nth = 1
),
ways AS (
    SELECT word, word AS stop, 0 AS steps FROM formed
    UNION ALL SELECT ways.word, formed.form, steps + 1 FROM ways JOIN formed ON formed.word = ways.stop WHERE formed.form IS NOT NULL
),
ends AS (SELECT word, arg_max(stop, steps) AS root FROM ways GROUP BY word)
SELECT word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN ends USING (word)
"""

OP13 = f"""
WITH tab AS ({CRC_TABLE}),
ordered AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
    FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT c, count(*) AS size, c - c % {pt.FAMILY} AS base FROM ordered GROUP BY c),
plans AS (
    SELECT s.c, s.base, {_crc32("s.c::VARCHAR")} % {pt.SHARED} AS h, coalesce(b.size, 0) AS base_size
    FROM sizes s LEFT JOIN sizes b ON b.c = s.base, tab
),
turns AS (
    SELECT plans.c, r, x, p FROM plans JOIN ordered o ON o.c = base AND p < h
    UNION ALL SELECT plans.c, r, x, least(h, base_size) + p - h FROM plans JOIN ordered o ON o.c = plans.c AND p >= h
),
rebuilt AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY p) FILTER (p IS NOT NULL) AS ts FROM plans LEFT JOIN turns USING (c) GROUP BY c),
whole AS (SELECT c, coalesce(ts, []) AS ts FROM rebuilt),
members AS (
    SELECT c, d, len(ts) AS total, to_json(ts[1:d])::VARCHAR AS k, CASE WHEN d > 0 THEN to_json(ts[1 : d - 1])::VARCHAR END AS above,
        CASE WHEN d > 0 THEN len(regexp_extract_all(ts[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
    FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM whole)
),
nodes AS (
    SELECT d, k, any_value(above) AS above, min(c) AS name, count(*) AS n, any_value(w) AS w,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = total), '')) AS ends_sha256
    FROM members GROUP BY d, k
),
kids AS (SELECT d - 1 AS d, above AS k, count(*) AS children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(children, 0) AS children FROM nodes LEFT JOIN kids USING (d, k)),
sums AS (
    SELECT m.d, m.k, sum((children = 0)::INT) AS n_leaves, sum((n - 1) * u.w) AS saved
    FROM full_nodes u JOIN members m ON m.c = u.name AND m.d <= u.d GROUP BY m.d, m.k
)
SELECT f.name AS conv_id, f.d::BIGINT AS depth, p.name AS parent_conv_id, f.n::BIGINT AS n_convs, f.children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums USING (d, k) LEFT JOIN nodes p ON p.d = f.d - 1 AND p.k = f.above
"""

ORACLES = {
    "op2_warc_salvage": OP2,
    "op3_license_scan": OP3,
    "op5_near_dedup": OP5,
    "op7_host_quality": OP7,
    "op8_decontaminate": OP8,
    "op10_tool_calls": OP10,
    "op11_substring_dedup": OP11,
    "op12_spelling": OP12,
    "op13_prefix_trie": OP13,
}
