"""DuckDB SQL that gives the rows of the registered queries, written from their definitions.

Limits, lists and patterns are spelled out here on purpose: the SQL shares no constant with the operators.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5),
keyed AS (SELECT doc_id, i, words[i:i + 4] AS w FROM windows),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM keyed GROUP BY doc_id, w HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, range(5) AS r(o) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
      FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id),
f AS (SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN 5 * n_capitals > 2 * n_letters THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
        + CASE WHEN word_chars > 15 * n_words THEN 64 ELSE 0 END AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM f
"""

_NOTICES = (
    ("agpl-3.0", "this work is licensed under the gnu affero general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-notice", "released under the mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "copyright all rights reserved"),
)
_PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = rf"""
WITH d AS (SELECT doc_id, {_ASCII_LOWER} AS text, regexp_extract_all({_ASCII_LOWER}, '{_LICENSE_WORD}') AS words FROM documents),
notices(label, words) AS (VALUES {', '.join(f"('{a}', list_distinct(string_split('{b}', ' ')))" for a, b in _NOTICES)}),
phrases(label, words) AS (VALUES {', '.join(f"('{a}', string_split('{b}', ' '))" for a, b in _PHRASES)}),
places AS (SELECT doc_id, label, unnest(list_filter(range(0, len(d.words)), lambda i: d.words[i + 1:i + len(p.words)] = p.words)) AS i
           FROM d, phrases AS p),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, list_distinct(list(label)) AS labels FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(text, chr(10))), '{_LICENSE_WORD}')) AS words FROM d),
shares AS (SELECT doc_id, label, len(list_intersect(b.words, n.words)) / len(n.words) AS share, len(list_intersect(b.words, n.words)) AS k,
             len(n.words) AS size FROM blocks AS b, notices AS n),
hits AS (SELECT doc_id, max(share) AS share, list_distinct(list(label)) AS labels FROM shares WHERE 10 * k >= 8 * size GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.z AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(hits.labels, [])))), ','), '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(hits.share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base ON d.doc_id = base.doc_id LEFT JOIN hits ON d.doc_id = hits.doc_id
"""

OP3 = r"""
WITH mass AS (SELECT source, sum(coalesce(length(text), 0)) AS mass, CASE WHEN source = 'src0' THEN 0.1::DOUBLE ELSE 0.05::DOUBLE END AS weight
              FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN mass > 0 AND weight > 0 THEN weight * (SELECT sum(mass) FROM mass)::DOUBLE
            / ((SELECT sum(weight) FROM mass WHERE mass > 0) * mass::DOUBLE) ELSE 0 END AS rate FROM mass),
parts AS (SELECT source, rate, greatest(1, ceil(rate / 8))::INTEGER AS parts FROM rates),
terms AS (SELECT source, rate, parts, k, exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1) AS p FROM parts, range(0, 49) AS r(k)),
cuts AS (SELECT source, any_value(rate) AS rate, any_value(parts) AS parts, list(c) AS cuts
         FROM (SELECT *, sum(p) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM terms) GROUP BY source),
drawn AS (SELECT d.*, c.rate, list_sum(list_transform(range(1, c.parts + 1), lambda i: len(list_filter(c.cuts, lambda x: x <=
            ('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || i), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)))) AS n
          FROM documents AS d JOIN cuts AS c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, CAST(copy AS INTEGER) AS copy,
  md5('order-17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS shuffle_key
FROM (SELECT * EXCLUDE (n), unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM drawn)
"""


_GAP = r"([ \t\r\n]|\\[nr])"
_KEY = (f"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----({_GAP}*[A-Za-z0-9+/=]{{16,}})*"
        f"(({_GAP}+[A-Za-z0-9+/=]+)?{_GAP}*-----END ([A-Z]+ )*PRIVATE KEY-----)?")


def _spans(kind: str, number: int, pattern: str, flags: str, test: str) -> str:
    """Spans of one kind: matches and the texts between them add up to the places."""
    options = f", '{flags}'" if flags else ""
    inline = "(?i)" if flags else ""
    return rf"""SELECT doc_id, {number} AS kind, '{kind}' AS name, s.a AS a, s.a + length(s.m) AS b FROM (
      SELECT doc_id, unnest(list_filter(list_transform(range(1, len(ms) + 1), lambda i: {{'m': ms[i],
        'a': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)}}),
        lambda s: {test})) AS s
      FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0{options}) AS ms, string_split_regex(text, '{inline}{pattern}') AS gaps FROM d
            WHERE regexp_matches(text, '{inline}{pattern}')))"""


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$"""
OP5 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS (
  {_spans('assign', 0, _ASSIGN, 'i', f"length(regexp_extract(s.m, '{_VALUE}', 1)) >= 12")}
  UNION ALL {_spans('access', 1, 'AKIA[A-Z0-9]+', '', 'length(s.m) >= 18')}
  UNION ALL {_spans('hex', 2, '[0-9a-f]{16,}', '', 'true')}
  UNION ALL {_spans('private_key', 3, _KEY, '', 'true')}
  UNION ALL {_spans('hosting', 4, 'gh[pousr]_[A-Za-z0-9]+', '', 'length(s.m) >= 40')}
  UNION ALL {_spans('chat', 5, 'xox[abprs]-[A-Za-z0-9-]+', '', 'length(s.m) >= 15')}
  UNION ALL {_spans('web_token', 6, 'eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+', '', 'true')}),
g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        coalesce(string_agg(concat(name, ':', CAST(a AS BIGINT), ':', CAST(b AS BIGINT)), ',' ORDER BY a, kind) FILTER (kind < 3), '') AS base,
        string_agg(concat(name, ':', CAST(a AS BIGINT), ':', CAST(b AS BIGINT)), ',' ORDER BY a, kind) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


def _shrunk(level: str, units: str, key: str) -> str:
    """Posterior mean and weight of each unit from its counts n, bad and its prior mean."""
    return f"""{level}_fit AS (SELECT least(greatest(CASE WHEN extra > 0 AND units >= 3 THEN CASE WHEN found > binomial
        THEN extra / (found - binomial) - 1 ELSE 1000 END ELSE 1 END, 1), 1000) AS k FROM (
        SELECT count(*) FILTER (n > 0) AS units, sum((bad - n * mean) * (bad - n * mean)) AS found, sum(n * mean * (1 - mean)) AS binomial,
          sum(n * (n - 1) * mean * (1 - mean)) AS extra FROM {units})),
  {level} AS (SELECT {key}, (least(k, known) * mean + bad) / (least(k, known) + n) AS rate, least(k, known) + n AS weight FROM {units}, {level}_fit)"""


OP7 = rf"""
WITH parsed AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    NOT contains(html, '</html>') OR length(regexp_replace(html, '<[^>]*>', '', 'g')) < 0.6 * length(html) AS bad FROM pages),
rules(rule, rhost, rpath, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
ruled AS (SELECT p.page_id, p.host, p.path, p.bad, regexp_replace(p.host, ':[0-9]*$', '') AS bare, (SELECT arg_max(r.rule, length(r.rule)) FROM rules AS r
            WHERE (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)) AS rule FROM parsed AS p),
fixed AS (SELECT u.*, r.verdict AS given FROM ruled AS u LEFT JOIN rules AS r ON u.rule = r.rule),
labels AS (SELECT bare, string_split(bare, '.') AS l, array_to_string(string_split(bare, '.')[-2:], '.') IN ('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au',
            'org.au', 'com.br', 'com.cn', 'co.in', 'ac.jp', 'co.jp', 'ne.jp', 'or.jp', 'co.kr', 'com.mx', 'co.nz', 'com.sg', 'com.tr', 'com.tw', 'co.za') AS two, bad FROM fixed),
hosts AS (SELECT bare AS host, any_value(array_to_string(CASE WHEN two THEN l[-3:] ELSE l[-2:] END, '.')) AS domain,
            any_value(array_to_string(CASE WHEN two THEN l[-2:] ELSE l[-1:] END, '.')) AS suffix,
            count(bad)::DOUBLE AS n, count(*) FILTER (bad)::DOUBLE AS bad FROM labels GROUP BY bare),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffix_units AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM hosts) AS mean, (SELECT sum(n) + 2 FROM hosts) AS known FROM domains GROUP BY suffix),
{_shrunk('top', 'suffix_units', 'suffix')},
domain_units AS (SELECT d.*, t.rate AS mean, t.weight AS known FROM domains AS d JOIN top AS t ON d.suffix = t.suffix),
{_shrunk('middle', 'domain_units', 'domain')},
host_units AS (SELECT h.host, h.n, h.bad, m.rate AS mean, m.weight AS known FROM hosts AS h JOIN middle AS m ON h.domain = m.domain),
{_shrunk('low', 'host_units', 'host')}
SELECT f.page_id, f.host, f.path, f.rule, coalesce(f.given, CASE WHEN round(l.rate - 1.0 * sqrt(l.rate * (1 - l.rate) / (l.weight + 1)), 6) > 0.5
    THEN 'block' ELSE 'allow' END) AS verdict, round(l.rate - 1.0 * sqrt(l.rate * (1 - l.rate) / (l.weight + 1)), 6) AS bad_low
FROM fixed AS f LEFT JOIN low AS l ON f.bare = l.host
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) >= 13)),
owners AS (SELECT w, min(doc_id) AS owner FROM windows GROUP BY w HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list([i, i + 1, i + 2, i + 3, i + 4, i + 5, i + 6, i + 7, i + 8, i + 9, i + 10, i + 11, i + 12]))) AS places
         FROM windows JOIN owners USING (w) WHERE doc_id > owner GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT d.doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d)
         LEFT JOIN (SELECT doc_id, unnest(places) AS i, 1 AS hit FROM gone) USING (doc_id, i) WHERE hit IS NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(gone.places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP9 = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b)) AS score FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
      WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""

SQL = {"op9_vantage_points": OP9, "op10_repeated_windows": OP10, "op1_quality_ledger": OP1, "op2_license_scan": OP2, "op3_poisson_mixture": OP3, "op5_secret_scan": OP5, "op7_host_reputation": OP7}
