"""DuckDB SQL of the document operators that SQL can express.

The strings are written from the contracts, not from the operators' methods:
windows are grouped as they stand, licence rules are tried on every text that
holds their keyword, payload digests are spelled out from the hash.  They are
meant for small tables; the operators are what scales.
"""

from __future__ import annotations

from txrisk.llm import licenses

#: Rules 0 to 10, the production policy of the quality rules.
POLICY = (1 << 11) - 1
#: A document's row, its text and its words; repeated ids stay apart.
_WORDS = r"""
docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
worded AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
marked AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM marked"""

QUALITY = rf"""
WITH {_WORDS},
grams AS (SELECT rid, i, w[i:i + 4] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM worded)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT rid, sum(least(5, coalesce(j - i, 5)))::BIGINT AS n_repeat_words FROM (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS j FROM again) GROUP BY rid),
lined AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM worded),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    coalesce(list_max(list_transform(w, lambda x: length(x))), 0)::BIGINT AS longest,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(ln)::BIGINT AS n_lines, (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '\P{{L}}+', '', 'g'))::BIGINT AS n_letters,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper,
    length(regexp_replace(text, '[^!]+', '', 'g'))::BIGINT AS n_exclaim,
    length(regexp_replace(text, '[^\x00-\x08\x0E-\x1F\x7F\x{{FFFD}}]+', '', 'g'))::BIGINT AS n_broken,
    len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis
  FROM lined LEFT JOIN covered USING (rid)),
b AS (SELECT *, ((n_words < 10)::BIGINT + (100 * n_repeat_words > 20 * n_words)::BIGINT * 2
    + (100 * n_symbols > 25 * n_words)::BIGINT * 4 + (100 * n_upper > 50 * n_letters)::BIGINT * 8
    + (100 * n_dup_lines > 30 * n_lines)::BIGINT * 16 + (10 * word_chars < 15 * n_words)::BIGINT * 32
    + (word_chars > 25 * n_words)::BIGINT * 64 + (100 * n_letters < 50 * word_chars)::BIGINT * 128
    + (100 * n_exclaim > 30 * n_words)::BIGINT * 256 + (100 * n_broken > word_chars)::BIGINT * 512
    + (100 * n_ellipsis > 30 * n_lines)::BIGINT * 1024 + (longest > 1000)::BIGINT * 2048) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  (fail_bits & {POLICY}) = 0 AS kept, fail_bits, n_letters, n_upper, n_exclaim FROM b"""

SUBSTRINGS = rf"""
WITH {_WORDS},
places AS MATERIALIZED (SELECT rid, doc_id, i, w[i] AS word,
    CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i:i + 19], ' ') END AS g
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM worded)),
later AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, rid, i) AS k
  FROM places WHERE g IS NOT NULL) WHERE k > 1),
lost AS (SELECT rid, i, word, coalesce(max(later.i) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM places LEFT JOIN later USING (rid, i)),
kept AS (SELECT rid, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS rest FROM lost GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (rid)"""

BYTES = """
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS MATERIALIZED (SELECT rid, i, substr(h, 2 * i + 1, 2) AS b, CASE WHEN 2 * i + 400 <= length(h) THEN md5(substr(h, 2 * i + 1, 400)) END AS g
  FROM (SELECT rid, h, unnest(range(length(h) // 2)) AS i FROM docs)),
again AS (SELECT rid, i, b, g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 AS hit FROM places),
lost AS (SELECT rid, i, b, max(hit::INT) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) = 1 AS gone FROM again),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), false) AS opens FROM lost),
kept AS (SELECT rid, count(*) FILTER (gone) AS n, count(*) FILTER (opens) AS spans, string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS rest FROM edges GROUP BY rid)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)"""


def _rule_rows(rules: list[licenses.Rule]) -> str:
    """The rules as SQL rows; words stand two blanks apart, so that each match
    has blanks of its own on both sides."""
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    return ",\n".join(
        f"({i}, {text(' (' + r.pattern.replace(' ', '  ') + ') ')}, {text(r.keyword)}, [{', '.join(map(text, r.stems or (r.keyword,)))}], "
        f"{text(r.label)}, {r.weight}::DOUBLE)" for i, r in enumerate(rules))


def license_sql() -> str:
    """Places of all rules, then the intervals that no other one contains."""
    base = [licenses.Rule(p, p.split()[0], label, 0.7, licenses.NAMED) for p, label in licenses.BASE]

    def places(rules: str) -> str:
        return rf"""(SELECT rid, o, l, w, unnest(list_zip(list_filter(range(len(m)), lambda i: starts_with(m[i + 1], chr(1))),
    list_filter(range(len(m)), lambda i: ends_with(m[i + 1], chr(2))))) AS se
  FROM (SELECT rid, o, l, w, string_split(trim(regexp_replace(wide, p, ' ' || chr(1) || '\1' || chr(2) || ' ', 'g')), '  ') AS m
    FROM (SELECT rid, o, l, w, p, wide FROM plain, {rules}
      WHERE contains(narrow, k) AND len(list_filter(stems, lambda x: contains(narrow, x))) > 0)))"""
    return rf"""
WITH rules(o, p, k, stems, l, w) AS (VALUES {_rule_rows(licenses.signature_rules())}),
base_rules(o, p, k, stems, l, w) AS (VALUES {_rule_rows(base)}),
plain AS MATERIALIZED (SELECT rid, doc_id, len(w)::BIGINT AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS narrow,
    ' ' || array_to_string(w, '  ') || ' ' AS wide
  FROM (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.WORD}') AS w FROM documents)),
found AS MATERIALIZED (SELECT rid, o, l, w, se[1] AS s, se[2] AS e FROM {places('rules')}),
heads AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY rid, s ORDER BY e DESC, o) = 1),
outer_ones AS (SELECT * FROM heads
  QUALIFY coalesce(max(e) OVER (PARTITION BY rid ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < e, true)),
more AS (SELECT rid, count(*) AS n_detections, max(w) AS best, list(l) AS ls FROM outer_ones GROUP BY rid),
base AS (SELECT rid, count(*) AS n_base, min(se[1]) AS first_word, max(se[1]) AS last_word, list(l) AS bs FROM {places('base_rules')} GROUP BY rid)
SELECT doc_id, n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(bs)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs, []), coalesce(ls, [])))), ','), '') AS labels,
  greatest(coalesce(best, 0::DOUBLE), CASE WHEN n_base > 0 THEN 0.7::DOUBLE ELSE 0::DOUBLE END) AS score,
  coalesce(n_detections, 0)::BIGINT AS n_detections
FROM plain LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)"""
