import hashlib
import re

from pyspark.sql import functions as F

from ragtide.llm import pii

KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
ODD = ["a@b@c.d", "a@b.c%d@e.f.g", "1.2.3.4.5.6.7.8", "0097.1.2.255 300.1.1.1 256.1.1.1",
       "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (212) 555-1234-. +12 +1(2", "é😀 a.b@c.d 😀 1.2.3.4",
       "aaa." * 2000, "1 " * 3000, "a@" * 800, "9" * 9000, "x@a" + ".b" * 9000, "1." * 9000, "+1" + "(" * 50 + "23456789",
       "12-34-5678--9012 4111 1111 1111 1111-", "1.1.1.1@x.y", "8 1.2.3.4@a.b +1 2345678 9 01", "", None]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def fine(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    spans = [(m.start(), i, k, m.end()) for i, (k, rx) in enumerate(KINDS.items())
             for m in rx.finditer(text or "") if fine(k, m.group())]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)], [sum(s[2] == k for s in spans) for k in KINDS]


def test_base_spans_equal_brute_force(spark, documents, with_clashes):
    odd = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = documents.select("doc_id", "text").unionByName(odd)
    rows = pii.pii_report(with_clashes(docs)).collect()

    def line(i, text):
        spans, counts = brute(text)
        return (str(i), *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())

    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == sorted(
        line(r.doc_id, r.text) for r in docs.collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert set(brute(texts[r.doc_id])[0]) <= set(r.spans.split(",")) | {""}


def test_positions_beyond_a_chunk(spark):
    text = " ".join(f"u{i}@x.org é" for i in range(pii.CHUNK * 3 + 5))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii.pii_report(df).first().spans.split(",") == brute(text)[0]


def test_contexts_discover_identifiers(spark):
    seeds = [f"please call or mail member number u{i}@mail.org about it" for i in range(12)]
    hidden = [f"please call or mail member number KX-{70000 + i} about it" for i in range(2)]
    plain = [f"in the year 19{10 + i} some {5000 + i} people came" for i in range(30)]
    texts = seeds + hidden + plain + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.pii_report(docs).collect()}
    for i in (12, 13):
        kind, a, b = found[i].split(":")
        assert kind == "id" and texts[i][int(a):int(b)] == f"KX-{70000 + i - 12}"
    assert all(not found[i] for i in range(14, len(texts)))


def letters(i):
    return chr(97 + i // 26) + chr(97 + i % 26)


def found_ids(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {}
    for r in pii.pii_report(docs).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        out[r.doc_id] = [texts[r.doc_id][int(a):int(b)] for kind, a, b in spans if kind == "id"]
    return [out[i] for i in range(len(texts))]


def test_seeds_without_digits(spark):
    """E-mails without digits in texts without digits carry patterns."""
    seeds = [f"please call or mail member number {letters(i)}.smith@corp.com about it" for i in range(12)]
    hidden = [f"please call or mail member number KX-{70000 + i} about it" for i in range(2)]
    assert found_ids(spark, seeds + hidden) == [[]] * 12 + [["KX-70000"], ["KX-70001"]]


def test_contexts_across_lines_tabs_and_other_numbers(spark):
    """Words around a mention come from the whole text, not from one gap."""
    layouts = ["our customer number:\n{}\nis in use", "plan\tanna\t{}\tpaid", "room {n} ref {} then",
               "kin of {n}.{n}@old.org, {} too", "a {long} {} b", "x(+1 212 555-12{n}) {}"]
    shapes = [x.replace("{long}", "w" * 60) for x in layouts]
    seeds, hidden = [], []
    for k, shape in enumerate(shapes):
        seeds += [shape.replace("{n}", str(10 + i)).replace("{}", f"{letters(i)}@corp.com") for i in range(8)]
        hidden.append(shape.replace("{n}", "77").replace("{}", f"KX-{70000 + k}"))
    assert found_ids(spark, seeds + hidden) == [[]] * len(seeds) + [[f"KX-{70000 + k}"] for k in range(len(shapes))]


def test_neighbours(spark):
    texts = ["a\x01b 12 c", "\t99\n", "é ü/7 x", "u@x.org 5 5", "4111 1111 1111 1111(+1 212 555-1234)q"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = docs.orderBy("doc_id").select(pii.matches(F.col("text"), pii.MENTION, "[0-9@]", words=True).alias("m")).collect()
    assert [[tuple(x) for x in r.m] for r in got] == [
        [("12", 4, "a", "b", "c")],
        [("99", 1, None, None, None)],
        [("7", 4, "é", "ü/", "x")],
        [("u@x.org", 0, None, None, "0"), ("5", 8, None, "@", "0"), ("5", 10, "@", "0", None)],
        [("4111 1111 1111 1111", 0, None, None, "("), ("+1 212 555-1234", 20, "0", "(", ")q")]]


def test_redact(spark, documents, with_clashes, empty_docs):
    odd = spark.createDataFrame([(1, "mail é a.b@c.d or 1.2.3.4@e.f!", "en", "s", 5), (2, None, "en", "s", None),
                                 (1, "mail é a.b@c.d or 1.2.3.4@e.f!", "en", "s", 5)], documents.schema)
    wide = with_clashes(odd)
    out = pii.redact(wide)
    assert out.columns == wide.columns
    assert sorted(str(r.text) for r in out.collect()) == ["None"] + ["mail é [EMAIL] or [EMAIL]!"] * 2
    assert pii.redact(empty_docs).count() == 0 and pii.pii_report(empty_docs).count() == 0
    again = pii.pii_report(pii.redact(documents)).agg(F.sum(F.col("n_email") + F.col("n_ip") + F.col("n_phone"))).first()[0]
    assert again == 0


def test_no_python_in_the_plan(spark, documents):
    plan = pii.pii_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
