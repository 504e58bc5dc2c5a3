"""DuckDB SQL with the same meaning as each registered query.

The SQL reads the pre-registered parquet views (``documents``, ``part``, ...).
Fragments are assembled from small builders so that the BM25, dense and
fusion oracles are written once.
"""

from __future__ import annotations

WORD_RE = r"[\pL\pN_]+"


def tok(expr: str) -> str:
    return f"regexp_extract_all(lower(coalesce({expr}, '')), '{WORD_RE}')"


def strip(expr: str) -> str:
    """Python ``str.strip`` (ASCII and common Unicode spaces)."""
    return f"regexp_replace(regexp_replace({expr}, '^\\s+', ''), '\\s+$', '')"


# ---------------------------------------------------------------- inputs

DOC_CORPUS = "SELECT doc_id, source AS title, text FROM documents"
BENCH_QUERIES = "SELECT item_id AS query_id, text FROM benchmark"

LAW_CORPUS = """SELECT doc_id,
  (CASE doc_id % 4 WHEN 0 THEN '개인정보보호법' WHEN 1 THEN '전자금융거래법'
   WHEN 2 THEN '신용정보법' ELSE '정보통신망법' END) || ' ' || source AS title, text,
  CASE doc_id % 4 WHEN 0 THEN '개인정보보호법' WHEN 1 THEN '전자금융거래법'
   WHEN 2 THEN '신용정보법' ELSE '정보통신망법' END AS law_name,
  CAST(doc_id % 50 + 1 AS VARCHAR) AS law_no
FROM documents"""

LAW_BENCH_QUERIES = """SELECT item_id AS query_id,
  text || ' ' || (CASE item_id % 4 WHEN 0 THEN '개인정보보호법' WHEN 1 THEN '전자금융거래법'
   WHEN 2 THEN '신용정보법' ELSE '안내' END) || ' 제' || CAST(item_id % 50 + 1 AS VARCHAR) || '조' AS text
FROM benchmark"""

LAW_QUESTIONS = """SELECT p_partkey AS query_id,
  '다음 중 ' || (CASE p_partkey % 4 WHEN 0 THEN '개인정보보호법' WHEN 1 THEN '전자금융거래법'
   WHEN 2 THEN '신용정보법' ELSE '안내' END) || ' 제' || CAST(p_size AS VARCHAR) || '조에 따른 ' ||
  (CASE WHEN p_partkey % 3 = 0 THEN '처리 방법은?' ELSE '의무는?' END) AS question
FROM part"""

QA_QUESTIONS = """SELECT 'TEST_' || CAST(p_partkey AS VARCHAR) AS "ID",
  CASE WHEN p_partkey % 5 <> 0 THEN p_name || chr(10) || '1 ' || p_brand || chr(10) || '2 ' ||
       p_type || chr(10) || '3 none' ELSE p_name END AS question,
  CASE p_partkey % 6 WHEN 0 THEN '답변: 3' WHEN 1 THEN '정답은 2번' WHEN 2 THEN ''
       WHEN 3 THEN '설명 답변: 0 3' WHEN 4 THEN 'abc' ELSE '답변:12' END AS generated
FROM part"""


# ---------------------------------------------------------------- BM25

def bm25_ctes(corpus_sql: str, queries_sql: str, k: int | None, prefix: str = "b") -> str:
    """CTEs ending in ``{prefix}_run(query_id, doc_id, score, rank)``."""
    p = prefix
    lim = f"LIMIT {k}" if k is not None else ""
    rank_filter = f"WHERE rank <= {k}" if k is not None else ""
    return f"""
{p}_corpus AS ({corpus_sql}),
{p}_toks AS (SELECT doc_id, {tok("coalesce(title, '') || ' ' || coalesce(text, '')")} AS tokens FROM {p}_corpus),
{p}_dl AS (SELECT doc_id, len(tokens) AS dl FROM {p}_toks),
{p}_post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM {p}_toks) GROUP BY doc_id, term),
{p}_n AS (SELECT count(*)::DOUBLE AS n FROM {p}_corpus),
{p}_vraw AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS ctf,
    ln((SELECT n FROM {p}_n) - count(*) + 0.5) - ln(count(*) + 0.5) AS idf_raw FROM {p}_post GROUP BY term),
{p}_stats AS (SELECT (SELECT sum(dl) FROM {p}_dl)::DOUBLE / (SELECT n FROM {p}_n) AS avgdl, avg(idf_raw) AS mean_idf FROM {p}_vraw),
{p}_vocab AS (SELECT term, df, ctf, CASE WHEN idf_raw < 0 THEN 0.25 * mean_idf ELSE idf_raw END AS idf FROM {p}_vraw, {p}_stats),
{p}_queries AS ({queries_sql}),
{p}_qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({tok("text")}) AS term FROM {p}_queries) GROUP BY query_id, term),
{p}_contrib AS (
  SELECT q.query_id, po.doc_id,
         q.qtf * v.idf * (po.tf * 2.5::DOUBLE / (po.tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.dl / s.avgdl))) AS c
  FROM {p}_qt q JOIN {p}_vocab v ON q.term = v.term JOIN {p}_post po ON po.term = q.term
  JOIN {p}_dl d ON d.doc_id = po.doc_id CROSS JOIN {p}_stats s),
{p}_pool AS (SELECT doc_id FROM {p}_corpus ORDER BY doc_id {lim}),
{p}_pad AS (SELECT q.query_id, pl.doc_id, 0.0::DOUBLE AS c FROM {p}_queries q CROSS JOIN {p}_pool pl),
{p}_scores AS (SELECT query_id, doc_id, sum(c) AS score FROM
   (SELECT * FROM {p}_contrib UNION ALL SELECT * FROM {p}_pad) GROUP BY query_id, doc_id),
{p}_run AS (SELECT * FROM (SELECT query_id, doc_id, score,
   row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
   FROM {p}_scores) {rank_filter})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


def q_bm25_topk() -> str:
    return with_(bm25_ctes(DOC_CORPUS, BENCH_QUERIES, 10)) + """
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM b_run"""


def q_bm25_stats() -> str:
    return with_(bm25_ctes(DOC_CORPUS, BENCH_QUERIES, 10)) + """
SELECT term, df, ctf, round(idf, 6) AS idf FROM b_vocab"""



CHANGED_CORPUS = """SELECT doc_id, text,
  CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN source ELSE '' END AS title
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)"""


def q_bm25_changes() -> str:
    return with_(bm25_ctes(CHANGED_CORPUS, BENCH_QUERIES, 10)) + """
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM b_run"""


def q_bm25_merged() -> str:
    return q_bm25_changes()


# ---------------------------------------------------------------- dense

def hash_vec_ctes(corpus_sql: str, queries_sql: str, k: int | None, dim: int = 256,
                  prefix: str = "h") -> str:
    """Hashed term-frequency vectors and their exhaustive cosine ranking."""
    p = prefix
    bucket = f"('0x' || substr(md5(t), 1, 8))::UBIGINT % {dim}"
    rank_filter = f"WHERE rank <= {k}" if k is not None else ""
    return f"""
{p}_corpus AS ({corpus_sql}),
{p}_queries AS ({queries_sql}),
{p}_dvec AS (SELECT doc_id, {bucket} AS bucket, count(*)::DOUBLE AS w FROM
   (SELECT doc_id, unnest({tok("coalesce(title, '') || ' ' || coalesce(text, '')")}) AS t FROM {p}_corpus) GROUP BY doc_id, bucket),
{p}_qvec AS (SELECT query_id, {bucket} AS bucket, count(*)::DOUBLE AS w FROM
   (SELECT query_id, unnest({tok("text")}) AS t FROM {p}_queries) GROUP BY query_id, bucket),
{p}_dn AS (SELECT d.doc_id, greatest(sqrt(coalesce(sum(w * w), 0)), 1e-12) AS n FROM {p}_corpus d LEFT JOIN {p}_dvec v USING (doc_id) GROUP BY d.doc_id),
{p}_qn AS (SELECT q.query_id, greatest(sqrt(coalesce(sum(w * w), 0)), 1e-12) AS n FROM {p}_queries q LEFT JOIN {p}_qvec v USING (query_id) GROUP BY q.query_id),
{p}_dot AS (SELECT q.query_id, d.doc_id, sum(q.w * d.w) AS dot FROM {p}_qvec q JOIN {p}_dvec d ON q.bucket = d.bucket GROUP BY q.query_id, d.doc_id),
{p}_scores AS (SELECT q.query_id, d.doc_id, coalesce(t.dot, 0.0) / (q.n * d.n) AS score
   FROM {p}_qn q CROSS JOIN {p}_dn d LEFT JOIN {p}_dot t ON t.query_id = q.query_id AND t.doc_id = d.doc_id),
{p}_run AS (SELECT * FROM (SELECT query_id, doc_id, score,
   row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
   FROM {p}_scores) {rank_filter})"""


def emb_ctes(k: int, score: str, prefix: str = "e") -> str:
    """All-pairs exact scores over ``embeddings`` (self excluded)."""
    p = prefix
    if score == "cos_sim":
        expr = ("list_inner_product(q.v, d.v) / (greatest(sqrt(list_inner_product(q.v, q.v)), 1e-12) * "
                "greatest(sqrt(list_inner_product(d.v, d.v)), 1e-12))")
    else:
        expr = "list_inner_product(q.v, d.v)"
    return f"""
{p}_v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
{p}_scores AS (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, coalesce(nullif({expr}, 'NaN'::DOUBLE), -1.0) AS score
   FROM {p}_v q JOIN {p}_v d ON q.vec_id <> d.vec_id),
{p}_run AS (SELECT * FROM (SELECT query_id, doc_id, score,
   row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
   FROM {p}_scores) WHERE rank <= {k})"""


def q_dense_topk_cos() -> str:
    return with_(emb_ctes(10, "cos_sim")) + "\nSELECT query_id, doc_id, round(score, 6) AS score, rank FROM e_run"


def q_dense_topk_dot() -> str:
    return with_(emb_ctes(10, "dot")) + "\nSELECT query_id, doc_id, round(score, 6) AS score, rank FROM e_run"


def q_dense_pruned_cos() -> str:
    return q_dense_topk_cos()


def q_dense_pruned_dot() -> str:
    return q_dense_topk_dot()


def q_hash_embed() -> str:
    return with_(hash_vec_ctes(DOC_CORPUS, BENCH_QUERIES, 10)) + "\nSELECT doc_id, CAST(bucket AS BIGINT) AS bucket, w AS weight FROM h_dvec"


def q_hash_embed_sorted() -> str:
    return q_hash_embed()


def q_dense_topk_hash() -> str:
    return with_(hash_vec_ctes(DOC_CORPUS, BENCH_QUERIES, 10)) + \
        "\nSELECT query_id, doc_id, round(score, 6) AS score, rank FROM h_run"


# ---------------------------------------------------------------- fusion

def softmax_cte(src: str, name: str) -> str:
    return f"""
{name}_m AS (SELECT query_id, doc_id, exp(score - max(score) OVER (PARTITION BY query_id)) AS e FROM {src}),
{name} AS (SELECT query_id, doc_id, e / sum(e) OVER (PARTITION BY query_id) AS p FROM {name}_m)"""


def hybrid_ctes(corpus_sql: str, queries_sql: str, dense_k: int = 10, sparse_k: int = 10,
                alpha: float = 0.7, final_k: int | None = 5) -> str:
    """... ending in ``fused(query_id, doc_id, score)`` and ``final(…, rank)``."""
    rank_filter = f"WHERE rank <= {final_k}" if final_k is not None else ""
    return ",".join([
        bm25_ctes(corpus_sql, queries_sql, sparse_k, "b"),
        hash_vec_ctes(corpus_sql, queries_sql, dense_k, prefix="h"),
        softmax_cte("h_run", "h_sm"),
        softmax_cte("b_run", "b_sm"),
        f"""
fused AS (SELECT query_id, doc_id, sum(s) AS score FROM
  (SELECT query_id, doc_id, {alpha!r}::DOUBLE * p AS s FROM h_sm
   UNION ALL SELECT query_id, doc_id, {1.0 - alpha!r}::DOUBLE * p AS s FROM b_sm) GROUP BY query_id, doc_id),
final AS (SELECT * FROM (SELECT query_id, doc_id, score,
   row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM fused) {rank_filter})"""])


def q_softmax_normalize() -> str:
    return with_(bm25_ctes(DOC_CORPUS, BENCH_QUERIES, 10), softmax_cte("b_run", "b_sm")) + \
        "\nSELECT query_id, doc_id, round(p, 6) AS score FROM b_sm"


def q_hybrid_fuse() -> str:
    return with_(hybrid_ctes(DOC_CORPUS, BENCH_QUERIES)) + \
        "\nSELECT query_id, doc_id, round(score, 6) AS score FROM fused"


def q_hybrid_search() -> str:
    return with_(hybrid_ctes(DOC_CORPUS, BENCH_QUERIES)) + \
        "\nSELECT query_id, doc_id, round(score, 6) AS score, rank FROM final"


# ---------------------------------------------------------------- rerank

def overlap(q: str, t: str) -> str:
    qd = f"list_distinct({tok(q)})"
    return (f"CASE WHEN len({qd}) > 0 THEN len(list_intersect({qd}, {tok(t)}))::DOUBLE / len({qd}) "
            f"ELSE 0.0 END")


def rerank_ctes(cand: str, queries: str, corpus: str, k: int, name: str = "rr") -> str:
    pre = max(10 * k, 100)
    return f"""
{name}_c AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id
   ORDER BY round(score, 9) DESC, doc_id) AS pre FROM {cand}) WHERE pre <= {pre}),
{name}_p AS (SELECT c.query_id, c.doc_id, q.text AS qtext,
   'Title: ' || coalesce(d.title, '') || chr(10) || 'Text: ' || coalesce(d.text, '') AS ptext
   FROM {name}_c c JOIN {queries} q ON q.query_id = c.query_id JOIN {corpus} d ON d.doc_id = c.doc_id),
{name}_s AS (SELECT query_id, doc_id, {overlap("qtext", "ptext")} AS score FROM {name}_p),
{name}_run AS (SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id
   ORDER BY round(score, 9) DESC, doc_id) AS rank FROM {name}_s) WHERE rank <= {k})"""


def q_rerank_topk() -> str:
    return with_(bm25_ctes(DOC_CORPUS, BENCH_QUERIES, 100),
                 rerank_ctes("b_run", "b_queries", "b_corpus", 10)) + \
        "\nSELECT query_id, doc_id, round(score, 6) AS score, rank FROM rr_run"


def q_hybrid_rerank() -> str:
    return with_(hybrid_ctes(DOC_CORPUS, BENCH_QUERIES, final_k=None),
                 rerank_ctes("fused", "b_queries", "b_corpus", 5)) + \
        "\nSELECT query_id, doc_id, round(score, 6) AS score, rank FROM rr_run"


# ---------------------------------------------------------------- text & law

def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


LAW_NAME_LOOSE = r"([가-힣A-Za-z0-9·\-\s]+법)"
ARTICLE_LOOSE = r"제?\s*(\d+)\s*조"
LAW_NAME_STRICT = r"([가-힣A-Za-z]+법)"
ARTICLE_STRICT = r"제(\d+)조"


def law_name(q: str, pat: str) -> str:
    return f"nullif({strip(f'regexp_extract({strip(q)}, {lit(pat)}, 1)')}, '')"


def law_no(q: str, pat: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({strip(q)}, {lit(pat)}, 1), '') AS BIGINT)"


def digits(s: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(CAST({s} AS VARCHAR), '([0-9]+)', 1), '') AS BIGINT)"


def q_tokenize() -> str:
    return f"""SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {tok("text")} AS t FROM documents)"""


def q_digits_to_int() -> str:
    return f"""SELECT p_partkey AS id, {digits("'제' || CAST(p_size AS VARCHAR) || '조 ' || p_name")} AS article,
  {digits("p_type")} AS none_found FROM part"""


def q_extract_law_loose() -> str:
    return f"""SELECT query_id, {law_name("question", LAW_NAME_LOOSE)} AS law_name,
  {law_no("question", ARTICLE_LOOSE)} AS law_no FROM ({LAW_QUESTIONS})"""


def q_extract_law_strict() -> str:
    return f"""SELECT query_id, {law_name("question", LAW_NAME_STRICT)} AS law_name,
  {law_no("question", ARTICLE_STRICT)} AS law_no FROM ({LAW_QUESTIONS})"""


def q_law_corpus_normalize() -> str:
    return f"""SELECT doc_id, law_name, regexp_replace(coalesce(law_name, ''), '\\s+', '', 'g') AS law_name_norm,
  law_no AS law_no_str, {digits("law_no")} AS law_no_int FROM ({LAW_CORPUS})"""


LAW_LOOSE_QUESTIONS = """SELECT p_partkey AS query_id, CASE p_partkey % 4 WHEN 0 THEN '개인정보보호법'
  WHEN 1 THEN '전자금융거래법' WHEN 2 THEN '신용정보법' ELSE '정보통신망법' END || CASE p_partkey % 3 WHEN 0 THEN ''
  WHEN 1 THEN ' 제 ' || p_size || ' 조' ELSE ' ' || p_size || '조' END || ' 설명' AS question FROM part"""


def law_match_sql(normalized: bool, name: str = LAW_NAME_STRICT, article: str = ARTICLE_STRICT,
                  questions: str = LAW_QUESTIONS) -> str:
    if normalized:
        qn = "regexp_replace(qname, '\\s+', '', 'g')"
        dn = "regexp_replace(coalesce(c.law_name, ''), '\\s+', '', 'g')"
        dno = digits("c.law_no")
    else:
        qn, dn, dno = "qname", "coalesce(c.law_name, '')", f"TRY_CAST({strip('c.law_no')} AS BIGINT)"
    return f"""lq AS (SELECT query_id, {law_name("question", name)} AS qname,
     {law_no("question", article)} AS qno FROM ({questions})),
lq2 AS (SELECT query_id, {qn} AS qn, qno FROM lq WHERE qname IS NOT NULL),
m AS (SELECT q.query_id, c.doc_id FROM lq2 q JOIN ({LAW_CORPUS}) c
   ON contains({dn}, q.qn) AND (q.qno IS NULL OR {dno} = q.qno) WHERE q.qn <> '')"""


def q_law_match_contains() -> str:
    return with_(law_match_sql(False)) + "\nSELECT query_id, doc_id FROM m"


def q_law_match_normalized() -> str:
    return with_(law_match_sql(True)) + "\nSELECT query_id, doc_id FROM m"


LAW_SUMMARY = """
SELECT query_id, count(*) AS n_matches,
  array_to_string(list(CAST(doc_id AS VARCHAR) ORDER BY doc_id)[1:5], ',') AS first_docs
FROM m GROUP BY query_id"""


def q_law_match_summary() -> str:
    return with_(law_match_sql(False)) + LAW_SUMMARY


def q_law_match_loose() -> str:
    return with_(law_match_sql(False, LAW_NAME_LOOSE, ARTICLE_LOOSE, LAW_LOOSE_QUESTIONS)) + LAW_SUMMARY


def prio_ctes(k: int, name: str = LAW_NAME_STRICT, article: str = ARTICLE_STRICT) -> str:
    return bm25_ctes(LAW_CORPUS, LAW_BENCH_QUERIES, k, "b") + f""",
ext AS (SELECT query_id, {law_name("text", name)} AS qname, {law_no("text", article)} AS qno FROM b_queries),
meta AS (SELECT doc_id, {strip("coalesce(law_name, '')")} AS dn, TRY_CAST({strip("law_no")} AS BIGINT) AS dno FROM b_corpus),
pr AS (SELECT r.query_id, r.doc_id, r.score, r.rank AS r0,
   (CASE WHEN e.qname IS NOT NULL AND m.dn = e.qname AND e.qno IS NOT NULL AND m.dno = e.qno THEN 0
        WHEN e.qname IS NOT NULL AND m.dn = e.qname THEN 1 ELSE 2 END)::BIGINT AS priority
   FROM b_run r JOIN meta m ON m.doc_id = r.doc_id LEFT JOIN ext e ON e.query_id = r.query_id),
prr AS (SELECT query_id, doc_id, score, priority,
   row_number() OVER (PARTITION BY query_id ORDER BY priority, r0) AS rank FROM pr)"""


def q_prioritize_law() -> str:
    return with_(prio_ctes(20)) + "\nSELECT query_id, doc_id, round(score, 6) AS score, priority, rank FROM prr"


def q_prioritize_law_loose() -> str:
    return (with_(prio_ctes(20, LAW_NAME_LOOSE, ARTICLE_LOOSE))
            + "\nSELECT query_id, doc_id, round(score, 6) AS score, priority, rank FROM prr")


def q_context_docs() -> str:
    return with_(prio_ctes(5)) + """
SELECT p.query_id, count(*)::BIGINT AS n_docs, string_agg(c.text, chr(10) ORDER BY p.rank) AS context
FROM prr p JOIN b_corpus c ON c.doc_id = p.doc_id GROUP BY p.query_id"""


# ---------------------------------------------------------------- QA

OPTION_LINE = r"^\s*[1-9][0-9]?\s"


def lines(q: str) -> str:
    return f"string_split({strip(f'coalesce({q}, {lit(chr(39) * 0)})')}, chr(10))"


def n_options(q: str) -> str:
    return f"len(list_filter({lines(q)}, lambda l: regexp_matches(l, {lit(OPTION_LINE)})))"


def is_mc(q: str) -> str:
    return f"({n_options(q)} >= 2)"


def stem(q: str) -> str:
    return (f"array_to_string(list_transform(list_filter({lines(q)}, lambda l: NOT regexp_matches(l, {lit(OPTION_LINE)})), "
            f"lambda l: {strip('l')}), ' ')")


def options(q: str) -> str:
    return (f"array_to_string(list_transform(list_filter({lines(q)}, lambda l: regexp_matches(l, {lit(OPTION_LINE)})), "
            f"lambda l: {strip('l')}), chr(10))")


def answer_text(g: str) -> str:
    return strip(f"string_split(coalesce({g}, ''), '답변:')[-1]")


def extract(g: str, q: str, skip_free: bool = False) -> str:
    t = answer_text(g)
    num = f"regexp_extract({t}, {lit(r'^\D*([1-9][0-9]?)')}, 1)"
    core = (f"CASE WHEN {t} = '' THEN '미응답' WHEN {is_mc(q)} THEN "
            f"(CASE WHEN {num} = '' THEN '0' ELSE {num} END) ELSE {t} END")
    if skip_free:
        return f"CASE WHEN NOT {is_mc(q)} THEN '0' ELSE {core} END"
    return core


def q_is_multiple_choice() -> str:
    return f'SELECT "ID", {n_options("question")}::BIGINT AS n_options, {is_mc("question")} AS is_mc FROM ({QA_QUESTIONS})'


def q_split_choices() -> str:
    return f'SELECT "ID", {stem("question")} AS stem, {options("question")} AS options FROM ({QA_QUESTIONS})'


def q_extract_answer() -> str:
    return f'SELECT "ID", {extract("generated", "question")} AS answer FROM ({QA_QUESTIONS})'


VERDICTS = """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'T F T' WHEN 1 THEN 'TFT'
  WHEN 2 THEN ' t f ' ELSE '' END AS verdict FROM part"""


def verdict_idx(parts: str, n: int | None = None) -> str:
    cond = "y >= 0" if n is None else f"y >= 0 AND y < {n}"
    return (f"array_to_string(list_filter(list_transform({parts}, lambda x, i: CASE WHEN x = 'T' THEN i - 1 ELSE -1 END), "
            f"lambda y: {cond}), ',')")


def q_parse_verdict() -> str:
    t = f"upper({strip('verdict')})"
    toks = f"string_split_regex({t}, '\\s+')"
    chars = f"string_split(regexp_replace({t}, '\\s+', '', 'g'), '')"
    return (f"SELECT id, {verdict_idx(toks)} AS by_tokens, {verdict_idx(chars)} AS by_chars, "
            f"{verdict_idx(chars, 2)} AS by_chars_2 FROM ({VERDICTS})")


KEY_ROWS = """SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM orders"""
KEY = f"""SELECT 'ID_' || CAST(o_orderkey AS VARCHAR) AS "ID",
  CASE WHEN copy = 1 THEN '4' ELSE CAST(o_orderkey % 5 + 1 AS VARCHAR) END AS "Answer",
  (o_orderkey * 2 + copy)::BIGINT AS ord FROM ({KEY_ROWS})"""
SUB = f"""SELECT 'ID_' || CAST(o_orderkey AS VARCHAR) AS "ID",
  CASE WHEN copy = 1 THEN '2' ELSE (CASE o_orderkey % 9 WHEN 0 THEN CAST(o_orderkey % 5 + 1 AS VARCHAR)
    WHEN 1 THEN CAST((o_orderkey + 1) % 5 + 1 AS VARCHAR) WHEN 2 THEN '1,3' WHEN 3 THEN ' 3 , 1 '
    WHEN 4 THEN '3,3' WHEN 5 THEN '3.0' WHEN 6 THEN '정답은 3번입니다' WHEN 7 THEN '' END) END AS "Answer",
  (o_orderkey * 2 + copy)::BIGINT AS ord FROM ({KEY_ROWS}) WHERE o_orderkey % 9 <> 8"""


def parsed(a: str, prefix: str) -> str:
    s = strip(a)
    parts = f"list_transform(string_split({s}, ','), lambda p: {strip('p')})"
    numeric = (f"coalesce({s} IS NOT NULL AND {s} <> '' AND "
               f"list_bool_and(list_transform({parts}, lambda p: regexp_matches(p, '^[0-9]+$'))), false)")
    vals = f"list_sort(list_distinct(list_transform({parts}, lambda p: TRY_CAST(p AS BIGINT))))"
    kind = f"CASE WHEN NOT {numeric} THEN 'str' WHEN len({vals}) = 1 THEN 'single' ELSE 'multi' END"
    return (f"{kind} AS kind{prefix}, CASE WHEN NOT {numeric} THEN NULL ELSE array_to_string({vals}, ',') END "
            f"AS vals{prefix}")


def q_parse_answer() -> str:
    return f'SELECT "ID", ord, {parsed(chr(34) + "Answer" + chr(34), "")} FROM ({SUB})'


def first_rows(src: str) -> str:
    return f"""SELECT "ID", "Answer", ord FROM (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY ord) AS rn
  FROM ({src})) WHERE rn = 1"""


def q_dedupe_first() -> str:
    return first_rows(KEY)


GRADED = f"""graded AS (SELECT "ID", answer_key, answer_sub, kind_key, kind_sub, vals_key, vals_sub,
  coalesce(kind_key <> 'str' AND kind_sub <> 'str' AND vals_key = vals_sub, false) AS correct FROM
  (SELECT k."ID", k."Answer" AS answer_key, s."Answer" AS answer_sub, {parsed('k."Answer"', "_key")},
          {parsed('s."Answer"', "_sub")}
   FROM ({first_rows(KEY)}) k LEFT JOIN ({first_rows(SUB)}) s ON k."ID" = s."ID"))"""


def q_grade_answers() -> str:
    return with_(GRADED) + "\nSELECT * FROM graded"


def q_grade_summary() -> str:
    return with_(GRADED) + """
SELECT count(DISTINCT "ID")::BIGINT AS total, count_if(correct)::BIGINT AS correct,
  count_if(kind_sub = 'str')::BIGINT AS str_count FROM graded"""


QA_AS_QUERIES = f'SELECT "ID" AS query_id, question AS text FROM ({QA_QUESTIONS})'


def qa_ctx_ctes() -> str:
    return bm25_ctes(DOC_CORPUS, QA_AS_QUERIES, 3, "b") + """,
ctx AS (SELECT r.query_id, string_agg(c.text, chr(10) ORDER BY r.rank) AS rag, count(*) AS n,
   list(c.text ORDER BY r.rank) AS texts FROM b_run r JOIN b_corpus c ON c.doc_id = r.doc_id GROUP BY r.query_id)"""


MC_HEAD = ("당신은 금융보안 전문가입니다.\n"
           "아래 질문에 대해 적절한 **정답 선택지 번호만 출력**하세요.\n\n")
FREE_HEAD = ("당신은 금융보안 전문가입니다.\n"
             "아래 주관식 질문에 대해 정확하고 간략한 설명을 작성하세요.\n"
             "콜론, 번호, 불릿으로 시작하는 것은 금지이며, 반드시 줄글으로 작성하세요.\n\n")


def q_prompt_table() -> str:
    rag = "(coalesce(x.rag, '') || chr(10))"
    mc = (f"{lit(MC_HEAD)} || '질문: ' || {stem('q.question')} || chr(10) || '참고 문서: ' || {rag} || "
          f"'선택지:' || chr(10) || {options('q.question')} || chr(10) || chr(10) || '답변:'")
    free = (f"{lit(FREE_HEAD)} || '질문: ' || coalesce(q.question, '') || chr(10) || chr(10) || "
            f"'참고 문서: ' || {rag} || '답변:'")
    return with_(qa_ctx_ctes()) + f"""
SELECT q."ID", {is_mc('q.question')} AS is_mc, CASE WHEN {is_mc('q.question')} THEN {mc} ELSE {free} END AS prompt
FROM ({QA_QUESTIONS}) q LEFT JOIN ctx x ON x.query_id = q."ID\""""


SELECT_PARTS = ("당신은 금융 분야의 전문가입니다. 아래에 주어진 질의(Query)와 문서(Corpus)를 보고, "
                "각 문서가 질의에 답하는 데 관련이 있는지를 판단하세요.\n"
                "        정답은 반드시 **'T' 또는 'F' ",
                "개 문자로만** 연속해서 작성하세요. (추가 설명 없이)\n"
                "        'T'는 관련 있음, 'F'는 관련 없음 을 의미합니다. "
                "전부 다 F인 경우 가장 관련성이 높은 문서에 T를 부여하세요.\n"
                "        질의(Query): ",
                "\n")


def q_selection_prompt() -> str:
    a, b, c = (lit(x) for x in SELECT_PARTS)
    return with_(qa_ctx_ctes()) + f"""
SELECT q."ID", {a} || CAST(x.n AS VARCHAR) || {b} || coalesce(q.question, '') || {c} ||
  array_to_string(list_transform(x.texts, lambda d, i: chr(10) || '###문서_' || CAST(i AS VARCHAR) || chr(10) || d || chr(10)), '') AS prompt
FROM ({QA_QUESTIONS}) q JOIN ctx x ON x.query_id = q."ID\""""


def q_answer_table() -> str:
    return f"""SELECT q."ID", {extract("r.generated", "q.question", skip_free=True)} AS "Answer"
FROM ({QA_QUESTIONS}) q LEFT JOIN (SELECT "ID", generated FROM ({QA_QUESTIONS}) WHERE generated <> '') r ON r."ID" = q."ID\""""


def q_generated_answers() -> str:
    answer = "('답변: ' || CAST(length(p.prompt) % 4 + 1 AS VARCHAR))"
    return f"""SELECT q."ID", {extract(answer, "q.question")} AS "Answer", least(length(p.prompt), 128) AS eval_count
FROM ({q_prompt_table()}) p JOIN ({QA_QUESTIONS}) q ON q."ID" = p."ID\""""


def q_submission_table() -> str:
    return f"""WITH a AS (SELECT q."ID", {extract("r.generated", "q.question")} AS "Answer"
  FROM ({QA_QUESTIONS}) q LEFT JOIN (SELECT "ID", generated FROM ({QA_QUESTIONS}) WHERE generated <> '') r
  ON r."ID" = q."ID")
SELECT t."ID", a."Answer" FROM ({QA_QUESTIONS}) t LEFT JOIN (SELECT * FROM a WHERE "Answer" <> '미응답') a ON a."ID" = t."ID\""""


def q_gen_throughput() -> str:
    return """WITH g AS (SELECT event_type, event_id % 200 AS eval_count, value AS eval_duration FROM events),
t AS (SELECT *, eval_count IS NOT NULL AND eval_count <> 0 AND eval_duration IS NOT NULL AND eval_duration <> 0 AS ok FROM g),
u AS (SELECT *, CASE WHEN ok THEN eval_count / greatest(eval_duration / 1.0, 1e-9) END AS tokps FROM t)
SELECT event_type, count(*) AS n, count(tokps) AS n_measured, round(avg(tokps), 6) AS avg_tokps,
  round(min(tokps), 6) AS min_tokps, round(max(tokps), 6) AS max_tokps,
  sum(CASE WHEN ok THEN eval_count END)::BIGINT AS tokens FROM u GROUP BY event_type"""


# ---------------------------------------------------------------- parent / child

CHILD_ROWS = """SELECT CAST(doc_id AS VARCHAR) AS law_key, CAST(i - 1 AS INTEGER) AS start, CAST(i AS INTEGER) AS "end",
  lang AS title, CASE WHEN (i - 1) % 2 = 0 THEN source || ' ' || line ELSE '' END AS prefixed_text,
  line AS text, source AS law_name, CAST(doc_id % 50 + 1 AS VARCHAR) AS law_no, doc_id * 1000 + i - 1 AS ord
FROM (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"""

def child_corpus(rows: str) -> str:
    return f"""SELECT law_key || ':' || CAST(start AS VARCHAR) || ':' || CAST("end" AS VARCHAR) AS doc_id,
  coalesce(title, '') AS title, coalesce(nullif(prefixed_text, ''), nullif(text, ''), '') AS text, law_key,
  coalesce(law_name, '') AS law_name, coalesce(law_no, '') AS law_no, coalesce(title, '') AS title_meta, start, "end"
FROM ({rows})"""


CHILD_CORPUS = child_corpus(CHILD_ROWS)

EXPANDED_ALL = """SELECT CAST(doc_id AS VARCHAR) AS law_key, CAST(i - 1 AS INTEGER) AS start, CAST(i AS INTEGER) AS "end",
  concat_ws(chr(10), lag(line) OVER w, line, lead(line) OVER w) AS expanded
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""
EXPANDED = EXPANDED_ALL + "\nQUALIFY (doc_id * 1000 + i - 1) % 7 <> 0"

ARTICLES_ALL = "SELECT CAST(doc_id AS VARCHAR) AS law_key, string_split(text, chr(10))[1] AS head FROM documents"
ARTICLES = ARTICLES_ALL + " WHERE doc_id % 5 <> 0"


def q_pick_text() -> str:
    return f"SELECT law_key, start, coalesce(nullif(prefixed_text, ''), nullif(text, ''), '') AS picked FROM ({CHILD_ROWS})"


def q_child_id() -> str:
    return f"""SELECT law_key, start, "end", law_key || ':' || CAST(start AS VARCHAR) || ':' || CAST("end" AS VARCHAR) AS doc_id,
  law_key || ':' || CAST(CASE WHEN start = 0 THEN -1 ELSE start END AS VARCHAR) || ':' || CAST("end" AS VARCHAR) AS doc_id_compat
FROM ({CHILD_ROWS})"""


def q_child_corpus() -> str:
    return CHILD_CORPUS


def q_child_corpus_compat() -> str:
    return child_corpus(f"SELECT * REPLACE (CASE WHEN start = 0 THEN -1 ELSE start END AS start) FROM ({CHILD_ROWS})")


def ctx_join(src: str) -> str:
    return f"""SELECT c.*, coalesce(nullif(e.expanded, ''), c.text) AS expanded_text, coalesce(a.head, '') AS parent_head
FROM {src} c LEFT JOIN ({EXPANDED}) e ON e.law_key = c.law_key AND e.start = c.start AND e."end" = c."end"
LEFT JOIN ({ARTICLES}) a ON a.law_key = c.law_key"""


def q_parent_context() -> str:
    return f"SELECT doc_id, expanded_text, parent_head FROM ({ctx_join('(' + CHILD_CORPUS + ')')})"


def child_hybrid() -> str:
    return hybrid_ctes(CHILD_CORPUS, BENCH_QUERIES, final_k=5)


def q_rerank_parent() -> str:
    pair = ("'Head: ' || coalesce(d.parent_head, '') || chr(10) || 'Title: ' || coalesce(d.title, '') || chr(10) || "
            "'Text: ' || coalesce(d.expanded_text, '')")
    return with_(child_hybrid()) + f""",
rp_c AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id
   ORDER BY round(score, 9) DESC, doc_id) AS pre FROM fused) WHERE pre <= 100),
rp_d AS ({ctx_join('b_corpus')}),
rp_p AS (SELECT c.query_id, c.doc_id, q.text AS qtext, {pair} AS ptext
   FROM rp_c c JOIN b_queries q ON q.query_id = c.query_id JOIN rp_d d ON d.doc_id = c.doc_id),
rp_s AS (SELECT query_id, doc_id, {overlap("qtext", "ptext")} AS score FROM rp_p)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (SELECT query_id, doc_id, score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM rp_s) WHERE rank <= 5"""


def pack_ctes() -> str:
    return child_hybrid() + f""",
top5 AS (SELECT * FROM final WHERE rank <= 5),
pk_d AS ({ctx_join('b_corpus')}),
packed AS (SELECT t.query_id, t.rank, t.doc_id, t.score, d.law_key, d.law_name, d.law_no, d.title_meta AS title,
   substr(replace(coalesce(d.text, ''), chr(10), ' '), 1, 900) AS child_text,
   substr(replace(coalesce(d.expanded_text, ''), chr(10), ' '), 1, 900) AS expanded_text, d.parent_head
   FROM top5 t JOIN pk_d d ON d.doc_id = t.doc_id)"""


def q_context_pack() -> str:
    return with_(pack_ctes()) + """
SELECT query_id, rank, doc_id, round(score, 6) AS score, law_key, law_name, law_no, title, child_text,
  expanded_text, parent_head FROM packed"""


def q_context_render() -> str:
    return with_(pack_ctes()) + """
SELECT query_id, count(*)::BIGINT AS n_hits, string_agg('[' || CAST(rank AS VARCHAR) || '] Head: ' || parent_head ||
  chr(10) || 'Child: ' || child_text || chr(10) || 'Expanded: ' || expanded_text, chr(10) ORDER BY rank) AS rendered
FROM packed GROUP BY query_id"""


# ---------------------------------------------------------------- training prep

EXAM = """SELECT p_partkey AS no, p_name AS question, p_brand AS "A", p_type AS "B", CAST(p_size AS VARCHAR) AS "C",
  CAST(p_retailprice AS VARCHAR) AS "D", CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_name END AS "E",
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 10 = 0 THEN []::VARCHAR[]
       ELSE ['docid' || CAST(p_partkey % (SELECT count(*) FROM documents) AS VARCHAR), 'case' || CAST(p_size AS VARCHAR),
             'docid' || CAST((p_partkey * 7 + p_size) % (SELECT count(*) FROM documents) AS VARCHAR)] END AS ids
FROM part"""

FINAL_Q = ("""coalesce(question, 'None') || chr(10) || 'A. ' || coalesce("A", 'None') || chr(10) || 'B. ' || """
           """coalesce("B", 'None') || chr(10) || 'C. ' || coalesce("C", 'None') || chr(10) || 'D. ' || """
           """coalesce("D", 'None') || chr(10) || 'E. ' || coalesce("E", 'None')""")

DOC_IDS = "coalesce(list_filter(ids, lambda d: starts_with(d, 'docid')), []::VARCHAR[])"

EXPLODED = f"""SELECT no, final_question, doc_ids FROM (SELECT no, "E", ids, {FINAL_Q} AS final_question,
  unnest({DOC_IDS}) AS doc_ids FROM ({EXAM})) WHERE "E" IS NOT NULL AND ids IS NOT NULL"""

STATUTES = "SELECT 'docid' || CAST(doc_id AS VARCHAR) AS id, text AS contents FROM documents"

PAIRS = f"SELECT x.no, x.doc_ids, 1 AS rel FROM ({EXPLODED}) x JOIN ({STATUTES}) s ON s.id = x.doc_ids"


def q_compose_question() -> str:
    return f"SELECT no, {FINAL_Q} AS final_question FROM ({EXAM})"


def q_extract_doc_ids() -> str:
    return f"SELECT no, array_to_string({DOC_IDS}, ',') AS doc_ids FROM ({EXAM})"


def q_explode_doc_ids() -> str:
    return EXPLODED


def q_relation_pairs() -> str:
    return PAIRS


GRID = f"""grid AS (SELECT q.no, (n.n - coalesce(p.d, 0) + coalesce(p.c, 0))::BIGINT AS n_cells,
  coalesce(p.c, 0)::BIGINT AS n_pos, (n.n - coalesce(p.d, 0))::BIGINT AS n_zero
FROM (SELECT DISTINCT no FROM ({EXPLODED})) q
LEFT JOIN (SELECT no, count(*) AS c, count(DISTINCT doc_ids) AS d FROM ({PAIRS}) GROUP BY no) p ON p.no = q.no
CROSS JOIN (SELECT count(DISTINCT id) AS n FROM ({STATUTES})) n)"""


def q_qrels_grid() -> str:
    return with_(GRID) + "\nSELECT * FROM grid"


STD = f"""qstd AS (SELECT DISTINCT CAST(no AS VARCHAR) AS _id, CAST(no AS VARCHAR) AS title, final_question AS text
  FROM ({EXPLODED})),
cstd AS (SELECT id AS _id, id AS title, contents AS text FROM ({STATUTES})),
qrels AS (SELECT CAST(no AS VARCHAR) AS query_id, doc_ids AS corpus_id, rel AS score FROM ({PAIRS}) WHERE rel > 0),
alld AS (SELECT r.corpus_id, r.query_id, r.score, q.title AS title_queries, q.text AS text_queries,
  c.title AS title_corpus, c.text AS text_corpus FROM qrels r JOIN qstd q ON q._id = r.query_id
  JOIN cstd c ON c._id = r.corpus_id),
ordered AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(chr(1), query_id, corpus_id, CAST(score AS VARCHAR), '42')),
  query_id, corpus_id, score) AS pos FROM qrels),
split AS (SELECT query_id, corpus_id, score, CASE WHEN pos <= ceil(0.2::DOUBLE * (SELECT count(*) FROM qrels))
  THEN 'val' ELSE 'train' END AS split FROM ordered)"""


def q_std_tables() -> str:
    return with_(STD) + "\nSELECT * FROM qrels"


def q_all_data() -> str:
    return with_(STD) + "\nSELECT * FROM alld"


def q_prep_counts() -> str:
    return with_(GRID) + f"""
SELECT 'queries' AS "table", count(*) AS n_rows FROM (SELECT DISTINCT no, final_question FROM ({EXPLODED}))
UNION ALL SELECT 'corpus', count(*) FROM ({STATUTES})
UNION ALL SELECT 'relations', sum(n_cells)::BIGINT FROM grid"""


def q_train_val_split() -> str:
    return with_(STD) + "\nSELECT * FROM split"


def q_train_pairs() -> str:
    return with_(STD) + """
SELECT query_id, corpus_id, 'Query: ' || text_queries AS anchor,
  'Title: ' || title_corpus || chr(10) || 'Text: ' || text_corpus AS positive
FROM alld WHERE query_id IN (SELECT query_id FROM split WHERE split = 'train')"""


def q_eval_corpus() -> str:
    return with_(STD) + """,
sample AS (SELECT _id FROM (SELECT DISTINCT _id FROM cstd) ORDER BY md5(_id || '|42'), _id LIMIT 30),
req AS (SELECT corpus_id AS _id FROM split WHERE split = 'val' UNION SELECT _id FROM sample)
SELECT _id AS corpus_id, 'Title: ' || title || chr(10) || 'Text: ' || text AS text FROM cstd WHERE _id IN (SELECT _id FROM req)"""


def q_eval_queries() -> str:
    return with_(STD) + """
SELECT _id AS query_id, 'Query: ' || 'Title: ' || title || chr(10) || 'Text: ' || text AS text FROM qstd"""


def q_relevant_docs() -> str:
    return with_(STD) + """
SELECT query_id, array_to_string(list_sort(list_distinct(list(corpus_id))), ',') AS corpus_ids
FROM split WHERE split = 'val' GROUP BY query_id"""


def q_relevant_doc_chunks() -> str:
    return with_(STD) + """,
ids AS (SELECT DISTINCT query_id, corpus_id FROM split WHERE split = 'val'),
placed AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY corpus_id) - 1) // 4 AS chunk FROM ids)
SELECT query_id, CAST(chunk AS BIGINT) AS chunk, string_agg(corpus_id, ',' ORDER BY corpus_id) AS corpus_ids
FROM placed GROUP BY query_id, chunk"""


def q_ir_metrics_chunks() -> str:
    return q_ir_metrics_eval()


def q_retriever_search() -> str:
    return q_hybrid_search()


def q_nodup_check() -> str:
    return with_(STD) + """
SELECT count(*) AS rows_in, count(*) AS rows_out, 0::BIGINT AS n_repeats, 0::BIGINT AS n_too_large
FROM alld WHERE query_id IN (SELECT query_id FROM split WHERE split = 'train')"""


# ---------------------------------------------------------------- IR evaluation

def metrics_sql(judged: str, nrel: str) -> str:
    """``judged(query_id, rank, rel)`` and ``nrel(query_id, n_rel)`` -> long table."""
    hk = ",\n  ".join(f"sum(CASE WHEN rel AND rank <= {k} THEN 1 ELSE 0 END) AS h{k}" for k in (1, 3, 5, 10))
    per = [f"CASE WHEN coalesce(h{k}, 0) > 0 THEN 1.0 ELSE 0.0 END AS \"accuracy@{k}\"" for k in (1, 3, 5, 10)]
    for k in (1, 3, 5, 10):
        per.append(f"coalesce(h{k}, 0) / {float(k)!r} AS \"precision@{k}\"")
        per.append(f"coalesce(h{k}, 0) / n.n_rel AS \"recall@{k}\"")
    per.append('coalesce(mrr, 0.0) AS "mrr@10"')
    per.append('coalesce(dcg, 0.0) / (SELECT sum(1.0 / log2(i + 1)) FROM range(1, least(n.n_rel, 10) + 1) t(i)) AS "ndcg@10"')
    per.append('coalesce(ap, 0.0) / least(n.n_rel, 100) AS "map@100"')
    names = ["accuracy@1", "accuracy@3", "accuracy@5", "accuracy@10"]
    for k in (1, 3, 5, 10):
        names += [f"precision@{k}", f"recall@{k}"]
    names += ["mrr@10", "ndcg@10", "map@100"]
    unions = " UNION ALL ".join(f"SELECT '{m}' AS metric, round(avg(\"{m}\"), 6) AS value FROM pq" for m in names)
    return f"""
jh AS (SELECT *, sum(CASE WHEN rel THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY rank
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits FROM {judged}),
agg AS (SELECT query_id, {hk},
  max(CASE WHEN rel AND rank <= 10 THEN 1.0 / rank ELSE 0.0 END) AS mrr,
  sum(CASE WHEN rel AND rank <= 10 THEN 1.0 / log2(rank + 1) ELSE 0.0 END) AS dcg,
  sum(CASE WHEN rel AND rank <= 100 THEN hits / rank ELSE 0.0 END) AS ap FROM jh GROUP BY query_id),
pq AS (SELECT n.query_id, {", ".join(per)} FROM {nrel} n LEFT JOIN agg a ON a.query_id = n.query_id WHERE n.n_rel > 0)
{unions}"""


def q_ir_metrics() -> str:
    return "WITH " + emb_ctes(100, "cos_sim").strip() + """,
judged AS (SELECT r.query_id, r.rank, coalesce(lq.label = ld.label AND r.doc_id <> r.query_id, false) AS rel
  FROM e_run r LEFT JOIN embeddings ld ON ld.vec_id = r.doc_id LEFT JOIN embeddings lq ON lq.vec_id = r.query_id),
nrel AS (SELECT e.vec_id AS query_id, c.n - 1 AS n_rel FROM embeddings e
  JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c ON c.label = e.label),""" + \
        metrics_sql("judged", "nrel")


def q_ir_metrics_bm25() -> str:
    return with_(bm25_ctes(DOC_CORPUS, BENCH_QUERIES, 100)) + """,
qrels AS (SELECT DISTINCT q.query_id, d.doc_id FROM b_corpus d JOIN b_queries q ON contains(d.text, q.text)),
judged AS (SELECT r.query_id, r.rank, (q.doc_id IS NOT NULL) AS rel FROM b_run r
  LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id),
nrel AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY query_id),""" + metrics_sql("judged", "nrel")


def q_ir_metrics_eval() -> str:
    corpus = """SELECT _id AS doc_id, '' AS title, 'Title: ' || title || chr(10) || 'Text: ' || text AS text
  FROM cstd WHERE _id IN (SELECT _id FROM req)"""
    asked = """SELECT _id AS query_id, 'Query: ' || 'Title: ' || title || chr(10) || 'Text: ' || text AS text
  FROM qstd WHERE _id IN (SELECT query_id FROM rel)"""
    return with_(STD) + """,
sample AS (SELECT _id FROM (SELECT DISTINCT _id FROM cstd) ORDER BY md5(_id || '|42'), _id LIMIT 30),
req AS (SELECT corpus_id AS _id FROM split WHERE split = 'val' UNION SELECT _id FROM sample),
rel AS (SELECT DISTINCT query_id, corpus_id FROM split WHERE split = 'val'),""" + hash_vec_ctes(corpus, asked, 100) + """,
judged AS (SELECT r.query_id, r.rank, (q.corpus_id IS NOT NULL) AS rel FROM h_run r
  LEFT JOIN rel q ON q.query_id = r.query_id AND q.corpus_id = r.doc_id),
nrel AS (SELECT query_id, count(*) AS n_rel FROM rel GROUP BY query_id),""" + metrics_sql("judged", "nrel")


# ---------------------------------------------------------------- sources

def q_scan_jsonl_corpus() -> str:
    return f"""WITH c AS ({LAW_CORPUS}),
lines AS (SELECT doc_id * 2 AS k, doc_id FROM c UNION ALL SELECT doc_id * 2 + 1, NULL FROM c WHERE doc_id % 10 = 9),
pos AS (SELECT doc_id, row_number() OVER (ORDER BY k) AS ord FROM lines)
SELECT 'doc' || CAST(p.ord AS VARCHAR) AS doc_id, c.law_name || ' ' || string_split(c.title, ' ')[2] AS title, c.text,
  c.law_name, c.law_no FROM pos p JOIN c ON c.doc_id = p.doc_id WHERE p.doc_id IS NOT NULL"""


def q_scan_child_chunks() -> str:
    return CHILD_CORPUS


def q_scan_child_body() -> str:
    return CHILD_CORPUS


def q_scan_queries_object() -> str:
    return "SELECT 'b' || CAST(item_id AS VARCHAR) AS query_id, text FROM benchmark"


def q_scan_queries_list() -> str:
    return q_scan_queries_object()


def q_scan_expanded() -> str:
    return f"SELECT law_key, start, \"end\", coalesce(nullif(expanded, ''), '') AS expanded FROM ({EXPANDED_ALL})"


def q_scan_articles() -> str:
    return ARTICLES_ALL


def q_scan_questions_csv() -> str:
    return f'SELECT "ID", question FROM ({QA_QUESTIONS})'


def q_scan_submission() -> str:
    return q_submission_table()


def q_scan_queries_any() -> str:
    return """WITH lines AS (SELECT item_id * 2 AS k, item_id FROM benchmark
  UNION ALL SELECT item_id * 2 + 1, NULL FROM benchmark WHERE item_id % 7 = 3),
pos AS (SELECT item_id, row_number() OVER (ORDER BY k) AS ord FROM lines)
SELECT CASE b.item_id % 3 WHEN 0 THEN 'b' || CAST(b.item_id AS VARCHAR) WHEN 1 THEN 'c' || CAST(b.item_id AS VARCHAR)
  ELSE 'q' || CAST(p.ord AS VARCHAR) END AS query_id, coalesce(nullif(b.text, ''), '') AS text
FROM pos p JOIN benchmark b ON b.item_id = p.item_id"""


def q_scan_rag_json() -> str:
    return q_extract_doc_ids()


# ---------------------------------------------------------------- ranking helpers & templates

def q_run_topk() -> str:
    return with_(bm25_ctes(DOC_CORPUS, BENCH_QUERIES, 10)) + """,
hs AS (SELECT query_id, doc_id, sum(c) AS score FROM b_contrib GROUP BY query_id, doc_id)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY round(score, 9) DESC, doc_id) AS rank FROM hs) WHERE rank <= 5"""


def q_dedupe_last() -> str:
    return f"""SELECT "ID", "Answer", ord FROM (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY ord DESC) AS rn
  FROM ({SUB})) WHERE rn = 1"""


def q_format_pairs() -> str:
    return """SELECT doc_id, 'Query: ' || text AS as_query, 'Title: ' || source || chr(10) || 'Text: ' || text AS as_doc
FROM documents"""

def oracle_sql() -> dict[str, str]:
    out = {}
    for name, fn in sorted(globals().items()):
        if name.startswith("q_") and callable(fn):
            out[name[2:]] = fn()
    return out
