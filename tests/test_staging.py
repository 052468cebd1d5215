"""Jobs that run side by side."""

import threading

import pytest

from ledgerflow.operators.staging import together


def test_steps_run_side_by_side_and_the_first_failure_is_raised(spark):
    met, done = threading.Barrier(2, timeout=60), []

    def step(name, fails=False):
        met.wait()
        if fails:
            raise ValueError(name)
        done.append(spark.range(3).count())

    together(spark)
    together(spark, lambda: step("a"), lambda: step("b"))
    assert done == [3, 3]
    with pytest.raises(ValueError, match="c"):
        together(spark, lambda: step("c", fails=True), lambda: step("d"))
    assert done == [3, 3, 3]
