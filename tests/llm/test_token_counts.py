import pytest
from tokenizers import Tokenizer

from ragtide.llm import token_counts

ODD = ["a <|endoftext|> b <|STARTOFTEXT|> <|startoftext|>", "x\x1cy\x85z 　 k    m",
       "😀😀 12٣ ²³¼ “quoted” it’s I'll", "­é a\tb\n\n c   ", "Ⅷ   x ΑΣ ΣΑΣ. İstanbul K ſ ß ẞ ΐ",
       "''s ,'s 's's 'LL x'Re", "日本語のテキスト한국어"]


@pytest.mark.parametrize("batch, held", [(token_counts.BATCH_TOKENS, token_counts.HELD), (3000, 40)])
def test_equals_the_tokenizer(spark, documents, with_clashes, batch, held):
    docs = documents.select("doc_id", "text").unionByName(
        spark.createDataFrame([(5000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string"))
    rows = docs.collect()
    tokenizer = Tokenizer.from_file(token_counts.default_tokenizer())
    coded = tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(e.ids), len(e.ids) > 2048)
                  for r, e in zip(rows, coded))
    got = token_counts.token_counts(with_clashes(docs), batch_tokens=batch, held=held).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_empty_table_and_texts(spark, empty_docs):
    assert token_counts.token_counts(empty_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, token_counts.token_counts(blank).collect())) == [
        (1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False)]


def test_a_batch_beyond_the_held_numbers(spark):
    """One long text whose distinct pre-tokens return in many parts."""
    text = " ".join(f"{i:x}zqxj" for i in range(120_000))
    tokenizer = Tokenizer.from_file(token_counts.default_tokenizer())
    docs = spark.createDataFrame([(1, text), (2, "a b")], "doc_id bigint, text string").coalesce(1)
    got = dict(token_counts.token_counts(docs, held=1000).select("doc_id", "n_tokens").collect())
    assert got == {1: len(tokenizer.encode(text, add_special_tokens=False).ids), 2: 2}
