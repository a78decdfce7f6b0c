"""DuckDB SQL of the dealt operators that SQL can express."""

from . import divergence as d
from . import ranked_search as searched
from . import secrets as found

# Words, their 5-word windows, references and distances as in divergence.py.
QUALITY_RULES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, lang, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM docs
), one AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), windows AS (
  SELECT words.r, i, count(*) OVER (PARTITION BY words.r, list_slice(w, i, i + 4)) AS n
  FROM words, unnest(generate_series(1, len(w) - 4)) AS s(i)
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat
  FROM windows, unnest([0, 1, 2, 3, 4]) AS s(k) WHERE n > 1 GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), base AS (
  SELECT docs.r, doc_id, docs.lang, len(w) AS n_words, length(t) AS chars,
    coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_dup, 0) AS n_dup_lines,
    [length(regexp_replace(t, '\\P{{Lu}}+', '', 'g')),
     length(regexp_replace(t, '[^0-9]+', '', 'g')),
     length(regexp_replace(t, '[^.,;:!?''"()-]+', '', 'g')),
     length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')),
     length(t) - length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))] AS c5
  FROM docs JOIN words USING (r) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), classed AS (
  SELECT *, list_append(c5, chars - list_sum(c5)) AS c FROM base
), langs AS (
  SELECT lang, sum(n_words) AS n, [sum(c[1]), sum(c[2]), sum(c[3]), sum(c[4]), sum(c[5]), sum(c[6])] AS c
  FROM classed WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {d.REFERENCE_WORDS}
), common AS (
  SELECT lang, word, count(*) AS n FROM one JOIN words USING (r)
  WHERE lang IS NOT NULL GROUP BY lang, word
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {d.COMMON_WORDS}
), ref AS (
  SELECT lang, word, common.n / langs.n AS q FROM common JOIN langs USING (lang)
), hits AS (
  SELECT r, word, count(*) AS n FROM one JOIN words USING (r) JOIN common USING (lang, word)
  GROUP BY r, word
), shares AS (
  SELECT classed.r, coalesce(hits.n, 0) / n_words AS p, q FROM classed JOIN ref USING (lang)
  LEFT JOIN hits ON hits.r = classed.r AND hits.word = ref.word WHERE n_words > 0
  UNION ALL
  SELECT classed.r, (n_words - coalesce(h.n, 0)) / n_words, 1 - coalesce(s.q, 0)
  FROM classed JOIN langs USING (lang)
  LEFT JOIN (SELECT r, sum(n) AS n FROM hits GROUP BY r) h ON h.r = classed.r
  LEFT JOIN (SELECT lang, sum(q) AS q FROM ref GROUP BY lang) s USING (lang) WHERE n_words > 0
), word_js AS (
  SELECT r, sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS js
  FROM shares GROUP BY r
), class_shares AS (
  SELECT classed.r, unnest(classed.c) / chars AS p, unnest(langs.c) / list_sum(langs.c) AS q
  FROM classed JOIN langs USING (lang) WHERE chars > 0
), class_js AS (
  SELECT r, sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS js
  FROM class_shares GROUP BY r
)
SELECT doc_id, n_words::BIGINT AS n_words, (chars - c5[5])::BIGINT AS word_chars,
  c5[4]::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
    OR (n_words >= {d.CLASS_WORDS} AND coalesce(class_js.js, 0) > {d.CLASS_LIMIT})
    OR (n_words >= {d.WORD_WORDS} AND coalesce(word_js.js, 0) > {d.WORD_LIMIT})) AS kept
FROM classed LEFT JOIN word_js USING (r) LEFT JOIN class_js USING (r)
"""


def _spans_of(order, kind):
    """Matches of a kind; starts from the lengths of what lies between and before."""
    pattern, group = found.PATTERNS[kind]
    pattern = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT r, source, {order} AS k, '{kind}' AS kind, v[i] AS value, m[i] AS whole,
    list_sum(list_transform(p[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS first
  FROM (SELECT r, source, regexp_extract_all(t, {pattern}, 0) AS m,
          regexp_extract_all(t, {pattern}, {group}) AS v,
          regexp_split_to_array(t, {pattern}) AS p
        FROM docs WHERE regexp_matches(t, {pattern})), unnest(range(1, len(m) + 1)) AS s(i)"""


SECRET_SCAN = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), matched AS (
  {" UNION ALL ".join(_spans_of(k, kind) for k, kind in enumerate(found.KINDS))}
), spans AS (
  SELECT *, first + length(whole) AS after FROM matched
  WHERE (k > 0 OR length(value) >= {found.ASSIGN_LEAST})
    AND (k < 3 OR (regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
                   AND regexp_matches(value, '[0-9]')))
), candidates AS (
  SELECT * FROM spans s WHERE k < 3 OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.r = s.r AND b.k < 3 AND b.first < s.after AND s.first < b.after)
), owned AS (
  SELECT value, count(DISTINCT coalesce('s' || source, '')) AS n_owners, count(DISTINCT r) AS n_repos
  FROM candidates GROUP BY value
), judged AS (
  SELECT c.*, CASE WHEN n_owners >= {found.COPIED_OWNERS} OR n_repos >= {found.COPIED_REPOS} THEN 'copied'
    WHEN NOT regexp_matches(value, '{found.PLACEHOLDER}')
      AND len(list_distinct(string_split(value, ''))) >= {found.DISTINCT_CHARACTERS} THEN 'live'
    ELSE 'unclear' END AS status
  FROM candidates c JOIN owned USING (value)
), kept AS (
  SELECT *, kind || ':' || first || ':' || after AS shown FROM judged WHERE k < 3 OR status = 'live'
)
SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
  count(*) FILTER (k = 2) AS n_hex, count(*) FILTER (k = 3) AS n_opaque,
  sha256(coalesce(string_agg(shown, ',' ORDER BY first, k) FILTER (k < 3), '')) AS base_sha256,
  coalesce(string_agg(shown, ',' ORDER BY first, k), '') AS spans,
  count(*) FILTER (status = 'live') AS n_live, count(*) FILTER (status = 'copied') AS n_copied
FROM docs LEFT JOIN kept USING (r) GROUP BY r, doc_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _terms(text):
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')"


RANKED_SEARCH = f"""
WITH docs AS (
  SELECT doc_id, {_terms('text')} AS t FROM documents
), sized AS (
  SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM docs WHERE len(t) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sized
), postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM sized)
  GROUP BY r, doc_id, n, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus GROUP BY term, big_n
), wanted AS (
  SELECT DISTINCT i, item_id, term
  FROM (SELECT i, item_id, unnest(t) AS term
        FROM (SELECT row_number() OVER () AS i, item_id, {_terms('text')} AS t FROM benchmark))
), scored AS (
  SELECT i, item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term), corpus
  GROUP BY i, item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {searched.BEST}
"""

EXACT_COPIES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES = {
    "op1_secret_scan": SECRET_SCAN,
    "op10_quality_rules": QUALITY_RULES,
    "op11_ranked_search": RANKED_SEARCH,
    "op13_block_names": EXACT_COPIES,
}
