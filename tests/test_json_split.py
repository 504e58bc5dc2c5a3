import json
import random

import pytest

from ragtide.sources import files as src
from ragtide.sources.json_split import json_members, step

TEXTS = ['a, "b", {c} [d', 'ends with a backslash \\', '\\", ]}', "", "line\nbreak,\ttab", "é日本😀,,,", "]" * 40 + "," * 40]


def records(n):
    rng = random.Random(n)
    return [{"id": f"k{i}", "text": rng.choice(TEXTS) + str(i), "more": {"x": [1, [2, {"y": ","}]]}} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 2])
def test_lists_and_objects_are_cut_by_many_tasks(spark, tmp_path, small_splits, indent):
    tmp_dir = str(tmp_path)
    found = records(200)
    with open(tmp_dir + "/list.json", "w", encoding="utf-8") as f:
        json.dump(found, f, ensure_ascii=False, indent=indent)
    with open(tmp_dir + "/object.json", "w", encoding="utf-8-sig") as f:
        json.dump({r["id"]: r["text"] for r in found}, f, ensure_ascii=indent is None, indent=indent)
    assert spark.read.text(tmp_dir + "/list.json").rdd.getNumPartitions() > 10
    rows = json_members(spark, [tmp_dir + "/list.json", tmp_dir + "/object.json"]).collect()
    lists = sorted((r.ord, json.loads(r.value, strict=False)) for r in rows if r.kind == "[")
    assert [v for _, v in lists] == found and [o for o, _ in lists] == list(range(200))
    want = {(r["id"], r["text"]) for r in found}
    for name in ("list", "object"):
        assert {tuple(r) for r in src.scan_queries_any(spark, f"{tmp_dir}/{name}.json").collect()} == want


def test_empty_single_and_repeated(spark, tmp_path):
    def scan(text):
        path = f"{tmp_path}/{abs(hash(text))}.json"
        with open(path, "w") as f:
            f.write(text)
        return sorted(map(tuple, src.scan_queries_any(spark, path).collect()))

    assert scan("[]") == [] and scan(" { } ") == []
    assert scan('[{"query": "x, y"}]') == [("q1", "x, y")]
    assert scan('{"a": "1", "a": "2"}\n') == [("a", "2")]
    assert scan('[{"id": "a", "text": "1"}, {"id": "a", "text": "2"}]') == [("a", "2")]
    for broken in ('[{"id": 1}', '{"a": "x', '"literal"', '[{"id": "a"},, {"id": "b"}] [', "nothing"):
        with pytest.raises(Exception):
            scan(broken)


def test_step_keeps_state_over_pieces():
    text = json.dumps(records(30))
    for cut in range(0, len(text), 97):
        inside = depth = 0
        for piece in (text[:cut], text[cut:]):
            if piece.endswith("\\"):
                break
            inside, change = step(piece, inside)
            depth += change
        else:
            assert (inside, depth) == (0, 0) or text[:cut].endswith("\\")
