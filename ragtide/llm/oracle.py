"""DuckDB SQL with the meaning of those queries that SQL can express."""

from __future__ import annotations

from . import license_scan

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def op4_warc() -> str:
    # 20 bits of the digest (5 hex digits) are 4 characters in base 32
    digits = " || ".join(
        f"substr('{BASE32}', ((g >> {shift}) & 31)::INTEGER + 1, 1)" for shift in (15, 10, 5, 0))
    chunks = f"""array_to_string(list_transform(range(0, 8),
    lambda i: list_transform([('0x' || substr(h, i * 5 + 1, 5))::BIGINT], lambda g: {digits})[1]), '')"""
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, strlen(x)::BIGINT AS payload_bytes, {chunks} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)"""


def op6_substring_dedup(window: int = 35) -> str:
    return f"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'),
  lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(w[s:s + {window - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS s FROM d WHERE len(w) >= {window})),
rep AS (SELECT doc_id, s FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {window})) AS p FROM rep),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, len(d.w)::BIGINT - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256 FROM d LEFT JOIN kept k USING (doc_id)"""


def op7_decontaminate(window: int = 13) -> str:
    words = f"regexp_extract_all({LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""WITH d AS (SELECT doc_id, {words} AS w FROM documents),
i AS (SELECT item_id, {words} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS x
  FROM (SELECT item_id, w, least({window}, len(w)) AS n, unnest(range(1, greatest(len(w) - {window - 2}, 2))) AS s
        FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
occ AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (n, x)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""


def op11_license_scan(gap: int = 4, min_share: str = "0.8") -> str:
    def values(rows, phrase, k):
        return [f"('{label}', '{text}', {phrase}, {k})" for label, text in rows]

    templates = ", ".join(values(license_scan.PHRASES, "true", 2) + values(license_scan.NOTICES, "false", 3))
    words = f"regexp_extract_all({LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
t AS (SELECT row_number() OVER () AS t, label, phrase, k, {words} AS w
  FROM (VALUES {templates}) v(label, text, phrase, k)),
tg AS (SELECT t, label, phrase, k, len(w) AS n, o, array_to_string(w[o + 1:o + k], ' ') AS g
  FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS o FROM t)),
dg AS (SELECT r, k, p, array_to_string(w[p + 1:p + k], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)),
votes AS (SELECT r, t, label, phrase, k, n, p - o AS diagonal, o FROM dg JOIN tg USING (k, g)),
marked AS (SELECT *, CASE WHEN before IS NULL OR (CASE WHEN phrase THEN diagonal <> before ELSE diagonal - before > {gap} END)
    THEN 1 ELSE 0 END AS new
  FROM (SELECT *, lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal, o) AS before FROM votes)),
bands AS (SELECT *, sum(new) OVER (PARTITION BY r, t ORDER BY diagonal, o) AS band FROM marked),
s AS (SELECT r, t, label, phrase, band, min(p) AS start, count(DISTINCT c) / any_value(n) AS share
  FROM (SELECT *, diagonal + o AS p, unnest(range(o, o + k)) AS c FROM bands) GROUP BY r, t, label, phrase, band),
f AS (SELECT r, count(*) FILTER (phrase AND share = 1) AS n_base, min(start) FILTER (phrase AND share = 1) AS first_word,
    max(start) FILTER (phrase AND share = 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase AND share = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN phrase THEN share = 1 ELSE share >= {min_share} END)
      AS labels, max(share) AS score
  FROM s GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0), 6) AS score FROM d LEFT JOIN f USING (r)"""


def op12_spelling() -> str:
    run = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
          "'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    return f"""WITH RECURSIVE t AS (SELECT list_transform(range(0, 256),
  lambda b: list_reduce(range(0, 8), lambda c, k: {step}, b)) AS crc),
x AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest({run}) AS run FROM documents),
y AS (SELECT run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM x GROUP BY id, run),
z AS (SELECT run, n, xor(list_reduce(list_transform(range(0, length(h) // 2),
    lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM y, t),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 31 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM z)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
gone AS (SELECT DISTINCT c.word AS a, c.n AS na, w.word AS b, w.n AS nb FROM cut c JOIN w ON c.less = w.word),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION ALL SELECT a, na, b, nb FROM gone UNION ALL SELECT b, nb, a, na FROM gone),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (m = top) AS form
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN form END AS form,
    CASE WHEN m >= 10 * w.n THEN m END AS form_n FROM w LEFT JOIN best USING (word)),
up AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL
  UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
SELECT f.word, form, coalesce(r.root, f.word) AS root, f.n, n_near, form_n FROM f LEFT JOIN
  (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL) r USING (word)"""


def op13_source_audit(min_docs: int = 30, top: int = 50) -> str:
    terms = f"regexp_extract_all({LOWER}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+')"

    def share(n, total):
        return f"1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * v)"

    return f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  {terms} AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM x GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM x SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share('coalesce(c.n, 0)', 'coalesce(s.total, 0)')} AS p,
    {share('k.n', 'l.total')} AS q
  FROM g JOIN kept k USING (lang) JOIN l USING (lang) LEFT JOIN s USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) f
  ON f.lang = a.lang AND f.source = a.source AND f.item = b.source)
SELECT lang, source, 'pair' AS part, item, value,
  (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term))::INTEGER AS rank
  FROM p WHERE n > 0 AND p > q) WHERE rank <= {top}"""


def oracle_sql() -> dict[str, str]:
    return {f.__name__: f() for f in (op4_warc, op6_substring_dedup, op7_decontaminate, op11_license_scan,
                                       op12_spelling, op13_source_audit)}
