"""Calls of the model: bounded in size and number, equal answers."""

import threading
import time

from pyspark.sql import functions as F

from ledgerflow.operators import scoring as sc


def test_calls_have_bounds_and_every_row_its_own_answer(spark):
    def counting(stage, sampling):
        """Answers tell the prompt, the size of its call and the most calls at a time so far."""
        lock, now = threading.Lock(), [0, 0]

        def answer(prompts):
            with lock:
                now[0] += 1
                now[1] = max(now)
            time.sleep(0.01)
            with lock:
                now[0] -= 1
            if "p" * 13 in prompts:
                raise RuntimeError("thirteen")
            size = len(prompts) * max(len(p) for p in prompts)
            return [f"{len(p)} {size} {now[1]}" for p in prompts]

        return answer

    rows = spark.range(400).select("id", F.expr("repeat('p', int(id % 60) + 1)").alias("prompt")).repartition(2)
    limits = sc.CallLimits(characters=200, in_flight=3)
    out = sc.score_batch(rows, "classify", counting, limits=limits).collect()
    assert sorted(r.id for r in out) == list(range(400))
    for r in out:
        if r.id % 60 + 1 == 13:
            assert (r.response, r.error) == (None, "thirteen")
            continue
        length, size, at_a_time = map(int, r.response.split())
        assert length == r.id % 60 + 1 and size <= 200 and at_a_time <= 3 and r.error is None
    assert max(int(r.response.split()[2]) for r in out if r.response) > 1


def test_calls_by_length_with_long_null_and_no_prompts():
    limits = sc.CallLimits(characters=10)
    prompts = ["a" * 4, "b" * 50, "", "c" * 5, None, "d" * 5]
    calls = sc.calls_of(prompts, limits)
    assert sorted(k for c in calls for k in c) == list(range(6))
    assert [1] in calls and all(len(c) * max(len(prompts[k] or "") for k in c) <= 10 for c in calls if c != [1])
    assert sc.calls_of(prompts, sc.CallLimits()) == [list(range(6))]


def test_a_call_with_too_few_answers_is_asked_again_one_by_one():
    found = sc.ask(lambda prompts: ["x"] if len(prompts) == 1 else [], ["a", "b"])
    assert [a for a, _ in found] == ["x", "x"]
    (error, _), = sc.ask(lambda prompts: [], ["a"])
    assert isinstance(error, Exception)
