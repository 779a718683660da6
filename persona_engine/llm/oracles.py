"""DuckDB SQL of the results, or the parts of results, that SQL can say; written from the definitions."""

from __future__ import annotations

from persona_engine.llm.host_rules import WINDOW, HostRules
from persona_engine.llm.licenses import PHRASES
from persona_engine.llm.mixing import MixPlan
from persona_engine.llm.rank_order import UNKNOWN, ProfileRule

WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: docs with crc, the crc32 of the decimal doc_id (null: of the empty text), by the table of its 256 one-byte steps.
CRC = """crct AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
docs AS (SELECT d.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(coalesce(CAST(doc_id AS VARCHAR), '') AS VARCHAR), ''),
        lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS crc FROM documents d, crct)"""

BASE_WORD_SCORES = rf"""WITH {CRC},
tok AS (SELECT doc_id, crc, list_append(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}'), NULL) AS w FROM docs),
one AS (SELECT doc_id, crc, unnest(w) AS token FROM tok),
cnt AS (SELECT token, count(*) AS c FROM one WHERE crc % 10 <> 0 GROUP BY token),
whole AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM cnt)
SELECT one.doc_id, one.crc % 10 = 0 AS held_out, count(*) AS n_tokens, count(cnt.c) AS n_known, CAST(any_value(whole.n) AS BIGINT) AS train_tokens,
    round_even(sum(log10((coalesce(cnt.c, 0) + 0.1::DOUBLE) / (whole.n + 0.1::DOUBLE * (whole.v + 1)))), 6) AS base_score
FROM one LEFT JOIN cnt ON one.token IS NOT DISTINCT FROM cnt.token, whole GROUP BY one.doc_id, one.crc"""

_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, i, '{label}' AS label FROM spot WHERE list_slice(w, CAST(i + 1 AS BIGINT), CAST(i + {len(phrase.split())} AS BIGINT)) = {phrase.split()!r}"
    for phrase, label in PHRASES)
BASE_LICENSE_PLACES = rf"""WITH tok AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
spot AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM tok),
place AS ({_PLACES})
SELECT t.doc_id, len(t.w) AS n_words, count(p.i) AS n_base, coalesce(min(p.i), -1) AS first_word,
    coalesce(max(p.i), -1) AS last_word,
    coalesce(string_agg(DISTINCT p.label, ',' ORDER BY p.label), '') AS base_labels
FROM tok t LEFT JOIN place p ON t.doc_id = p.doc_id GROUP BY t.doc_id, len(t.w)"""

_P = MixPlan()
MIX_TARGETS = rf"""WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
src AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM docs GROUP BY source),
cap AS (SELECT *, {list(_P.weights)}[CAST(place % {len(_P.weights)} + 1 AS BIGINT)]::DOUBLE AS w, {_P.max_repeat}.0::DOUBLE * source_size AS cap FROM src),
lev AS (SELECT *, ({_P.share}::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER upto, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER upto, 0)) AS level
    FROM cap WINDOW upto AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fin AS (SELECT arg_min(level, (cap / w, source IS NULL, coalesce(source, ''))) AS level FROM lev WHERE cap >= level * w)
SELECT d.doc_id, d.size, CAST(l.source_size AS BIGINT) AS source_size, round_even(least(l.cap, fin.level * l.w), 6) AS target
FROM docs d JOIN lev l ON d.source IS NOT DISTINCT FROM l.source, fin"""

_R = HostRules()
HOST_RULES = rf"""WITH tok AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, CAST(i + 1 AS BIGINT), CAST(i + {WINDOW} AS BIGINT)), ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, 0))) AS i FROM tok)),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win), range({WINDOW}) r(j)
    WHERE c >= 2 GROUP BY doc_id),
cnt AS (SELECT t.doc_id, t.source AS host, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines FROM tok t LEFT JOIN rep r ON t.doc_id = r.doc_id),
base AS (SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_pct} * n_words AS base_failed FROM cnt),
host AS (SELECT host, count(*)::DOUBLE AS n, sum(CAST(base_failed OR 100 * n_symbols > {_R.max_symbol_pct} * word_chars
        OR 100 * n_dup_lines > {_R.max_dup_line_pct} * n_lines AS BIGINT))::DOUBLE AS f FROM base GROUP BY host),
prior AS (SELECT avg(f / n) AS m, coalesce(var_samp(f / n), 0) AS v, avg(1 / n) AS inv, sum(f) / sum(n) AS every FROM host),
weigh AS (SELECT *, m * (1 - m) AS spread, v - m * (1 - m) * inv AS beyond FROM prior),
rate AS (SELECT host, CASE WHEN beyond > 0 AND spread > 0 THEN (f + greatest(spread / beyond - 1, 0) * m) / (n + greatest(spread / beyond - 1, 0))
        ELSE every END AS r FROM host, weigh)
SELECT b.doc_id, b.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round_even(r.r, 9) AS host_rate,
    NOT base_failed AND r.r <= {_R.max_rate} AS kept
FROM base b JOIN rate r ON b.host IS NOT DISTINCT FROM r.host"""

_L = ProfileRule()
RANK_ORDER_LANGUAGE = rf"""WITH {CRC},
word AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, '_' || unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}]+')) || '_' AS w FROM docs)
    GROUP BY ALL),
gram AS (SELECT doc_id, g, sum(n) AS n FROM (SELECT doc_id, substring(w, CAST(i AS BIGINT), CAST(k AS BIGINT)) AS g, n FROM (
        SELECT *, unnest(range(1, length(w) - k + 2)) AS i FROM word, range(1, {_L.longest + 1}) r(k))) WHERE g <> '_' GROUP BY doc_id, g),
prof AS (SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, g) - 1 AS r FROM (
        SELECT lang, g, sum(n) AS n FROM gram JOIN docs USING (doc_id) WHERE crc % 5 <> 0 AND lang IS NOT NULL GROUP BY lang, g)
    QUALIFY r < {_L.size}),
own AS (SELECT doc_id, g, more + (ties - 1) / 2.0::DOUBLE AS r FROM (SELECT doc_id, g, rank() OVER (PARTITION BY doc_id ORDER BY n DESC) - 1 AS more,
        count(*) OVER (PARTITION BY doc_id, n) AS ties FROM gram) WHERE more < {_L.size}),
size AS (SELECT doc_id, count(*) * {_L.size}::DOUBLE AS worst FROM own GROUP BY doc_id),
near AS (SELECT own.doc_id, lang, sum(greatest(0.0::DOUBLE, {_L.size} - abs(own.r - prof.r))) AS credit FROM own JOIN prof USING (g) GROUP BY ALL),
every AS (SELECT doc_id, lang, worst, coalesce(credit, 0) AS credit FROM size CROSS JOIN (SELECT DISTINCT lang FROM prof) LEFT JOIN near USING (doc_id, lang)),
best AS (SELECT doc_id, lang, credit / worst AS score, coalesce(lead(credit) OVER first, 0) / worst AS next FROM every
    WINDOW first AS (PARTITION BY doc_id ORDER BY credit DESC, lang) QUALIFY row_number() OVER first = 1)
SELECT doc_id, crc % 5 = 0 AS held_out, CASE WHEN known THEN lang ELSE '{UNKNOWN}' END AS lang_pred, CASE WHEN known THEN score ELSE 0 END AS score,
    CASE WHEN known THEN score - next ELSE 0 END AS margin
FROM (SELECT d.doc_id, d.crc, b.*  EXCLUDE (doc_id), b.lang IS NOT NULL AND regexp_matches(d.text, '\p{{L}}') AS known FROM docs d LEFT JOIN best b USING (doc_id))"""
