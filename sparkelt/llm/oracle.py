"""DuckDB SQL that the text queries must agree with, where SQL can state them."""

from __future__ import annotations

import re

from .chat import INSTRUCT
from .divergence import MIN_DOCS, SCALE, TOP
from .license import DIAGONAL_GAP, K, MAX_STRETCH, MIN_COVERAGE, template_grams
from .quality import RULES, STOP_WORDS
from .warc import MIN_REVISIT

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _listed(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _quality() -> str:
    failed = []
    for r in RULES:
        low = [] if r.low is None else [f"{r.measure} < {r.low}"]
        high = [] if r.high is None else [f"{r.measure} > {r.high}"]
        failed.append((r.base, f"(n_words >= {r.min_words} AND ({' OR '.join(low + high)}))"))
    return rf"""
WITH worded AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM worded)
), marked AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) > 1 AS twice FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
  FROM marked, (SELECT unnest(range(0, 5)) AS o) WHERE twice GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper,
         length(regexp_replace(text, '[^!]', '', 'g')) AS bang,
         len(list_filter(words, lambda w: w IN ({_listed(STOP_WORDS)}))) AS stop
  FROM worded d LEFT JOIN covered USING (doc_id)
), measured AS (
  SELECT *, CASE WHEN n_words > 0 THEN 100 * n_repeat_words / n_words ELSE 0 END AS repeat_percent,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN bang / n_words ELSE 0 END AS marks_per_word,
         CASE WHEN word_chars > 0 THEN upper / word_chars ELSE 0 END AS upper_share,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN stop / n_words ELSE 0 END AS stop_word_share
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {" OR ".join(f for base, f in failed if base)} AS base_failed,
       NOT ({" OR ".join(f for _, f in failed)}) AS kept
FROM measured"""


def _license() -> str:
    rows = ", ".join(
        f"({t}, '{label}', {base}, {pos}, '{gram}', {grams})"
        for t, label, base, pos, gram, grams in template_grams()
    )
    return rf"""
WITH templates(t, label, base, tpos, gram, grams) AS (VALUES {rows}), worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), votes AS (
  SELECT doc_id, t, label, base, grams, tpos, pos, pos - tpos AS diagonal
  FROM (SELECT doc_id, i - 1 AS pos, array_to_string(words[i:i + {K - 1}], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {K - 2})) AS i FROM worded))
  JOIN templates USING (gram)
), diagonals AS (
  SELECT doc_id, t, label, base, grams, diagonal, count(*) AS votes, list(tpos) AS held,
         min(pos) AS low, max(pos) AS high
  FROM votes GROUP BY ALL
), stepped AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > {DIAGONAL_GAP} AS new
  FROM diagonals
), numbered AS (
  SELECT *, sum(coalesce(new, true)::INT) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS span FROM stepped
), spans AS (
  SELECT doc_id, t, label, base, grams, span,
         count(*) FILTER (base AND votes = grams) AS places,
         min(diagonal) FILTER (base AND votes = grams) AS first_at,
         max(diagonal) FILTER (base AND votes = grams) AS last_at,
         CASE WHEN max(high) + {K} - min(low) <= {MAX_STRETCH} * (grams + {K - 1})
              THEN len(list_distinct(flatten(list(held)))) / grams ELSE 0.0 END AS coverage
  FROM numbered GROUP BY doc_id, t, label, base, grams, span
), found AS (
  SELECT doc_id, sum(places) AS n_base, min(first_at) AS first_word, max(last_at) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (places > 0) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label)
           FILTER (places > 0 OR (NOT base AND coverage >= {MIN_COVERAGE})) AS labels,
         max(CASE WHEN places > 0 THEN 1.0 ELSE coverage END) AS score
  FROM spans GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM worded LEFT JOIN found USING (doc_id)"""


def _warc() -> str:
    revisit = f"payload_bytes >= {MIN_REVISIT} AND page_id <> newest"
    return f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), known AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN {revisit} THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN {revisit} THEN newest END AS refers_to
FROM known"""


def _chat() -> str:
    t = INSTRUCT
    tails = "|".join(re.escape(c[1:]) for c in t.controls)
    heads = "".join(sorted({c[0] for c in t.controls}))

    def escaped(c: str) -> str:
        doubled = f"replace({c}, chr(92), repeat(chr(92), 2))"
        return rf"length(regexp_replace({doubled}, '[{heads}]({tails})', '\0.', 'g'))"

    marks = " ".join(f"WHEN '{r}' THEN {len(m.open + m.close)}" for r, m in t.turns.items())
    loss = _listed(r for r, m in t.turns.items() if m.loss)
    steps = " ".join(f"WHEN '{s}' THEN role IN ({_listed(roles)})" for s, roles in t.follows.items())
    return rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), ordered AS (
  SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before, lead(role) OVER w AS next FROM given
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ({_listed(t.first)})
                 ELSE (CASE before {steps} ELSE FALSE END) END
            AND (next IS NOT NULL OR role IN ({_listed(t.ends)})) AS fine,
         CASE role {marks} ELSE {len("".join(t.other))} + {escaped("role")} END + {escaped("text")} AS chars
  FROM ordered
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role IN ({loss})), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role IN ({loss})), '')) AS loss_sha256,
       ({len(t.begin)} + sum(chars))::BIGINT AS formatted_chars, bool_and(fine) AS valid
FROM judged GROUP BY conv_id"""


def _divergence() -> str:
    return rf"""
WITH worded AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), held AS (
  SELECT lang, source, doc, unnest(words) AS term FROM worded
), kept AS (
  SELECT lang, term FROM held GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM held SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM worded
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT *, (1 + ({SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER g + count(*) OVER g))::HUGEINT AS p
  FROM dense WINDOW g AS (PARTITION BY lang, source)
), langs AS (
  SELECT lang, term, (1 + ({SCALE}::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER l + count(*) OVER l))::HUGEINT AS q
  FROM dense GROUP BY lang, term WINDOW l AS (PARTITION BY lang)
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS peer, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
  ) v ON v.lang = a.lang AND v.source = a.source AND v.peer = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT
  FROM shares JOIN langs USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": _license(),
        "op3_warc_segments": _warc(),
        "op9_quality_rules": _quality(),
        "op12_chat_format": _chat(),
        "op13_source_divergence": _divergence(),
    }
