import random

import pytest

from ragtide.llm import license_scan

from .test_decontaminate import split_words


def brute(rows, phrases, notices, k=3, gap=4, min_share=0.8):
    templates = [(label, split_words(t), True, 2) for label, t in phrases]
    templates += [(label, split_words(t), False, k) for label, t in notices]
    out = []
    for doc_id, text in rows:
        w, places, base, labels, score = split_words(text), [], set(), set(), 0.0
        for label, t, phrase, k in templates:
            votes = {}
            for at in range(len(t) - k + 1):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == t[at:at + k]:
                        votes.setdefault(p - at, set()).add(at)
            bands, last = [], None
            for d in sorted(votes):
                if last is None or phrase or d - last > gap:
                    bands.append([])
                bands[-1] += [(d, at) for at in votes[d]]
                last = d
            for band in bands:
                share = len({at + j for _, at in band for j in range(k)}) / len(t)
                score = max(score, share)
                if phrase and share == 1:
                    places.append(min(d + at for d, at in band))
                    base.add(label)
                if share == 1 if phrase else share >= min_share:
                    labels.add(label)
        out.append((str(doc_id), len(w), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 6)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng, notices = random.Random(5), dict(license_scan.NOTICES)
    found = [(1, None), (2, ""), (3, " !! "), (4, "MIT License mit license CC-BY cc by"), (4, "apache license"),
             (5, "GNU general public licence; GNU General Public License."), (None, "mit license"),
             (6, "gnu general public"), (7, "public license general public license"), (8, "cc"), (9, "ÀB CC by KELVINK")]
    for i, (label, text) in enumerate(notices.items()):
        words = text.split()
        less, more = list(words), list(words)
        del less[len(less) // 2]
        more.insert(len(more) // 2, "really")
        for j, w in enumerate((words, less, more, words[: len(words) // 2], words + words, ["the"] * 500 + words)):
            pad = [rng.choice(["the", "of", "license", "under", "this"]) for _ in range(rng.randrange(9))]
            found.append((100 * i + j + 100, " ".join(pad + w + pad)))
    found += found[:4] + found[-3:]
    return found


@pytest.mark.parametrize("max_runs", [license_scan.MAX_RUNS, 50])
def test_equals_brute_force(spark, rows, with_clashes, max_runs):
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = license_scan.license_scan(df, max_runs=max_runs).collect()
    want = brute(rows, license_scan.PHRASES, license_scan.NOTICES)
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == want
    assert {x for r in want for x in r[6].split(",")} >= {label for label, _ in license_scan.NOTICES}


def test_own_templates_and_odd_rows(spark, documents):
    own = license_scan.template_table(spark, [("a", "three four")], [("b", "one two three four five six")])
    docs = [(r.doc_id, r.text) for r in documents.where("source = 'odd' and length(text) < 1000 or text is null").collect()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = license_scan.license_scan(df, own).collect()
    want = brute(docs, [("a", "three four")], [("b", "one two three four five six")])
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == want
    with pytest.raises(ValueError):
        license_scan.template_table(spark, [("a", "three")], [])


def test_whole_texts_and_empty(spark, documents, empty_docs):
    long = "w " * 200_000 + "mit license"
    r = license_scan.license_scan(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).first()
    assert (r.n_words, r.first_word, r.base_labels) == (200_002, 200_000, "mit")
    assert license_scan.license_scan(empty_docs).collect() == []
    assert license_scan.license_scan(documents).count() == documents.count()


def test_no_python_or_loop_join(spark, documents):
    plan = license_scan.diagonals(documents, license_scan.template_table(spark))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text
