from collections import Counter

import pytest

from ragtide.operators import generate


def counting(log, stop=None, fail=()):
    class Killed(BaseException):
        """Not caught as a failure of the service."""

    class Client:
        def generate(self, prompt, **options):
            if stop and prompt == stop:
                raise Killed(prompt)
            with open(log, "a") as f:
                f.write(prompt + "\n")
            if prompt in fail:
                raise ValueError("no answer")
            return {"response": prompt.upper(), "eval_count": len(prompt), "eval_duration": 0.5}
    return Client


def calls(log):
    with open(log) as f:
        return Counter(f.read().split("\n")[:-1])


def test_equal_prompts_are_asked_once_and_reruns_not_at_all(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    rows = [(i, f"p{i % 5}") for i in range(20)] + [(99, None), (100, "")]
    prompts = spark.createDataFrame(rows, "ID int, prompt string")
    for _ in range(2):
        got = {r.ID: (r.generated, r.eval_count) for r in generate.generate(prompts, counting(log), store).collect()}
        assert got == {i: (p and p.upper() if p else p, None if p is None else len(p)) for i, p in rows}
    assert set(calls(log).values()) == {1} and len(calls(log)) == 6
    more = prompts.unionByName(spark.createDataFrame([(7000, "new")], "ID int, prompt string"))
    assert generate.generate(more, counting(log), store).count() == 23
    assert calls(log)["new"] == 1 and set(calls(log).values()) == {1}
    # other options are other requests
    generate.generate(prompts, counting(log), store, options={"temperature": 0}).count()
    assert calls(log)["p1"] == 2


def test_a_killed_run_repeats_nothing_that_was_committed(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(60)], "ID int, prompt string")
    with pytest.raises(Exception):
        generate.generate(prompts, counting(log, stop="p33"), store, wave_rows=6, parallel=1)
    committed = {r.generated.lower() for r in generate.stored_answers(spark, store).collect()}
    before = calls(log)
    assert 0 < len(committed) < 60 and "p33" not in committed
    got = generate.generate(prompts, counting(log), store, wave_rows=6, parallel=1).collect()
    assert {r.ID: r.generated for r in got} == {i: f"P{i}" for i in range(60)}
    after = calls(log)
    assert all(after[p] == before[p] == 1 for p in committed) and len(after) == 60


def test_failures_are_kept_and_asked_again(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    prompts = spark.createDataFrame([(1, "good"), (2, "bad")], "ID int, prompt string")
    got = {r.ID: r.generated for r in generate.generate(prompts, counting(log, fail=("bad",)), store, retries=1).collect()}
    assert got == {1: "GOOD", 2: None} and calls(log) == {"good": 1, "bad": 2}
    errors = spark.read.parquet(store).where("error is not null").collect()
    assert [r.error for r in errors] == ["ValueError: no answer"]
    got = {r.ID: r.generated for r in generate.generate(prompts, counting(log), store).collect()}
    assert got == {1: "GOOD", 2: "BAD"} and calls(log) == {"good": 1, "bad": 3}


def test_empty(spark, tmp_path):
    prompts = spark.createDataFrame([], "ID int, prompt string")
    assert generate.generate(prompts, counting(str(tmp_path / "log")), str(tmp_path / "s")).collect() == []


def test_a_wave_reads_its_own_folder_only(spark, tmp_path, monkeypatch):
    made = {}
    real = generate.scratch_path
    monkeypatch.setattr(generate, "scratch_path", lambda s, name: made.setdefault(name, real(s, name)))
    prompts = spark.createDataFrame([(i, f"p{i % 20}") for i in range(40)], "ID int, prompt string")
    got = generate.generate(prompts, counting(str(tmp_path / "log")), str(tmp_path / "store"), wave_rows=4)
    assert {r.ID: r.generated for r in got.collect()} == {i: f"P{i % 20}" for i in range(40)}
    queue = spark.read.parquet(made["waves"])
    assert queue.count() == 20 and 1 < queue.select("wave").distinct().count() <= 5
