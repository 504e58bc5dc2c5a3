import zlib

import numpy as np
from tokenizers import Tokenizer

from ragtide.llm import packing

ODD = [None, "", "a <|endoftext|> b", "x\x1cy\x85z 　 k    m", "😀😀 12٣ ²³¼ “quoted” it’s I'll we'RE",
       "­é a\tb\n\n c   ", "Ⅷ   x", "  ", " lead", "日本語 한국어 ไทย"]


def test_pieces_cover_every_id(spark, documents, with_clashes, empty_docs):
    odd = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = documents.select("doc_id", "text").where("doc_id IS NOT NULL").dropDuplicates().unionByName(odd)
    packed = packing.pack(with_clashes(docs))
    pieces = [r.asDict() | {"crc": d.ids_crc32} for r, d in zip(
        packed.orderBy("sequence_id", "offset").collect(),
        packing.piece_digests(packed).orderBy("sequence_id", "offset").collect())]
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rows = docs.collect()
    coded = tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    ids = {r.doc_id: np.array([*e.ids, 0], "<u4") for r, e in zip(rows, coded)}
    at = dict.fromkeys(ids, 0)
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]].tobytes()
        assert p["start"] == at[p["doc_id"]] and p["doc_tokens"] == len(ids[p["doc_id"]])
        assert p["ids"] == part and p["crc"] == zlib.crc32(part) and p["length"] > 0
        at[p["doc_id"]] += p["length"]
    assert all(at[i] == len(x) for i, x in ids.items())
    fill = {}
    for p in pieces:
        assert p["offset"] == fill.get(p["sequence_id"], 0)
        fill[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in fill.values())
    assert packing.pack(empty_docs).count() == 0


def test_both_encoders_agree(documents):
    ids_of = packing.ByteIds(packing._spec(None))
    rng = np.random.default_rng(5)
    letters = list("aeinorstlu THEtion.,!?'-0123456789\n\t  éñüßçÀ“”’–€_/()[]#$%&*|")
    texts = ["".join(rng.choice(letters, rng.integers(1, 300))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 4000, " " * 3000, "\n" * 3000, "the" * 3000, "!" * 3000, "1" * 3000, "'s" * 2000]
    texts += [r.text for r in documents.where("text IS NOT NULL").collect()]
    assert sum(not ids_of.unusual(t) for t in texts) > 1500
    for t in texts:
        assert ids_of(t).tolist() == ids_of.plain(t).tolist(), t[:80]


def test_repeated_rows_are_packed_each(spark):
    df = spark.createDataFrame([(1, "same text")] * 3 + [(None, "x")], "doc_id bigint, text string")
    rows = packing.pack(df).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows if r.start == 0).count(("1", 3)) <= 3
    assert sum(r.length for r in rows) == 3 * 3 + 2


def test_hilbert_key_is_a_walk():
    grid = np.array(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1).T
    order = np.argsort(packing.hilbert_key(grid, 3))
    assert sorted(packing.hilbert_key(grid, 3).tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


def test_equal_texts_share_a_place(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "zz yy xx ww")], "doc_id bigint, text string")
    keys = {r.doc_id: r.curve for r in packing.encoded(df).collect()}
    assert keys[1] == keys[2] != keys[3]
