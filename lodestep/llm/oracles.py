"""DuckDB SQL of the queries that SQL can express."""

from lodestep.llm.quality import COMMON_WORDS

OP1 = r"""
WITH sized AS (SELECT doc_id, source, len(array_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size,
  md5('1:' || coalesce(CAST(doc_id AS varchar), '')) AS key FROM documents),
ranked AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source),
weighted AS (SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM ranked),
levels AS (SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS double) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS double)
  / CAST(sum(weight) OVER (ORDER BY CAST(cap AS double) / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS double) AS level FROM weighted),
targets AS (SELECT source, source_size, least(CAST(cap AS double), weight * max(level) OVER ()) AS target FROM levels),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized),
joined AS (SELECT p.doc_id, p.size, p.start, t.source_size, t.target, CAST(floor(t.target) AS bigint) AS budget,
  CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS bigint) // t.source_size ELSE 0 END AS epochs
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS bigint) AS size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS bigint) AS taken FROM joined
"""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = rf"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_slice(w, i, i + 9) AS ws FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(ws) AS n FROM windows),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lengths WHERE len(w) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM starts JOIN windows ON array_slice(w, i, i + n - 1) = ws),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP2 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, CAST(n AS bigint) AS payload_bytes, digest AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""

OP11 = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
escaped AS (SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') AS body,
  replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ':', '\:') AS head FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || head || ':' || chr(10) || body || chr(10) || '</turn>' || chr(10))) AS bigint) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, array_to_string(array_slice(w, i, i + {k - 1}), ' ') AS phrase FROM (SELECT lang, w, unnest(generate_series(1, len(w) - {k - 1})) AS i FROM pieces)"
    for k in range(1, 6))
_CUTS = " UNION ALL ".join(
    f"SELECT lang, phrase, f AS a, {cut} AS cut, array_to_string(array_slice(w, 1, {cut}), ' ') AS head, array_to_string(array_slice(w, {cut + 1}, k), ' ') AS tail FROM candidates WHERE k > {cut}"
    for cut in range(1, 5))
OP13 = rf"""
WITH lowered AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, array_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered)),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM ({_GRAMS}) GROUP BY lang, k, phrase HAVING count(*) >= 100),
candidates AS (SELECT * FROM counts WHERE k > 1),
cuts AS ({_CUTS}),
scored AS (SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, n, (1000 * c.a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM cuts c JOIN counts l ON c.lang = l.lang AND c.head = l.phrase JOIN counts r ON c.lang = r.lang AND c.tail = r.phrase JOIN totals t ON c.lang = t.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM weakest s WHERE NOT EXISTS (SELECT 1 FROM candidates q WHERE q.lang = s.lang AND q.f >= s.a AND q.phrase <> s.phrase
  AND contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS bigint) AS n, CAST(score AS bigint) AS score FROM ranked WHERE rank <= 2000
"""

_COMMON = ", ".join(f"('{lang}', {i}, '{word}', '{word.capitalize()}')" for lang, words in COMMON_WORDS.items() for i, word in enumerate(words))
OP10 = rf"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
  CASE WHEN lang IN ({", ".join(f"'{lang}'" for lang in COMMON_WORDS)}) THEN lang ELSE 'other' END AS grp,
  array_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
  array_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
sized AS (SELECT *, len(words) AS n, length(array_to_string(words, '')) AS word_chars, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
  length(regexp_replace(text, '[^0-9]+', '', 'g')) AS n_digits, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  length(regexp_replace(text, '[^.,;:!?''"()\-]+', '', 'g')) AS n_marks FROM texts),
windows AS MATERIALIZED (SELECT rid, i, array_to_string(array_slice(words, i, i + 4), ' ') AS five FROM (SELECT rid, words, unnest(generate_series(1, n - 4)) AS i FROM sized WHERE n > 4)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT rid, count(DISTINCT place) AS n_repeat FROM (SELECT rid, unnest(generate_series(i, i + 4)) AS place FROM twice) GROUP BY rid),
counted AS MATERIALIZED (SELECT s.*, coalesce(n_repeat, 0) AS n_repeat, n < 10 OR 100 * coalesce(n_repeat, 0) > 20 * n AS failed FROM sized s LEFT JOIN repeats USING (rid)),
bins AS MATERIALIZED (SELECT rid, grp, text, 'chars' AS kind, generate_subscripts(v, 1) AS i, unnest(v) AS v
  FROM (SELECT *, [n_upper, n_digits, n_symbols, n_marks, length(text) - word_chars, word_chars - n_upper - n_digits - n_symbols - n_marks] AS v FROM counted WHERE n >= 50 AND NOT failed)
  UNION ALL SELECT rid, grp, text, 'words', c.i, len(array_filter(words, lambda w: w = c.word OR w = c.big))
  FROM counted JOIN (VALUES {_COMMON}) AS c(lang, i, word, big) ON grp = lang WHERE n >= 50 AND NOT failed),
shares AS MATERIALIZED (SELECT *, CAST(v AS double) / total AS share FROM (SELECT *, sum(v) OVER (PARTITION BY rid, kind) AS total FROM bins)
  WHERE total > 0 AND (kind = 'chars' OR total >= 20)),
middles AS (SELECT grp, kind, i, list_avg(quantile_cont(round(share, 3), [0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65])) AS m
  FROM (SELECT DISTINCT grp, kind, i, text, share FROM shares) GROUP BY grp, kind, i HAVING count(*) >= 10),
models AS (SELECT grp, kind, i, m / nullif(sum(m) OVER (PARTITION BY grp, kind), 0) AS q FROM middles),
distances AS (SELECT rid, kind, sqrt(greatest(0, sum(CASE WHEN share > 0 THEN share * log2(2 * share / (share + q)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * log2(2 * q / (share + q)) ELSE 0 END) / 2)) AS far FROM shares JOIN models USING (grp, kind, i) WHERE q IS NOT NULL GROUP BY rid, kind),
dropped AS (SELECT DISTINCT rid FROM distances WHERE far > CASE kind WHEN 'chars' THEN 0.3 ELSE 0.6 END)
SELECT doc_id, n AS n_words, CAST(word_chars AS bigint) AS word_chars, CAST(n_symbols AS bigint) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, n_repeat AS n_repeat_words, failed AS base_failed,
  NOT failed AND d.rid IS NULL AS kept FROM counted c LEFT JOIN dropped d ON c.rid = d.rid
"""

ORACLES = {"op1_mix_sources": OP1.strip(), "op2_warc": OP2.strip(), "op4_decontamination": OP4.strip(), "op10_quality": OP10.strip(),
           "op11_chat": OP11.strip(), "op13_collocations": OP13.strip()}
