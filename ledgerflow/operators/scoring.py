"""The model call as a pluggable step.

Either a table of captured answers is joined on, or a scorer runs inside the tasks.
A scorer factory is called once per task and returns ``answer(prompts) -> answers``;
an answer may be an exception, which becomes that row's error.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


@dataclass(frozen=True)
class Sampling:
    """Parameters of a model call."""

    temperature: float
    top_p: float
    max_tokens: int


# --- fixed values -----------------------------------------------------------
SAMPLING = {
    "classify": Sampling(temperature=0.1, top_p=0.95, max_tokens=256),
    "extract": Sampling(temperature=0.1, top_p=0.95, max_tokens=1500),
}
# ----------------------------------------------------------------------------

Scorer = Callable[[list[str]], list[str | Exception]]
ScorerFactory = Callable[[str, Sampling], Scorer]


@dataclass(frozen=True)
class CallLimits:
    """How a task asks the model.

    ``characters`` bounds the prompts of one call, all counted as long as the longest of
    them; a prompt beyond it is a call of its own.  Without it a batch is one call.
    ``in_flight`` bounds the calls a task waits for at a time; above 1 the scorer is called
    from as many threads.
    """

    characters: int | None = None
    in_flight: int = 1


def calls_of(prompts: list[str], limits: CallLimits) -> list[list[int]]:
    """The places of each call's prompts, those of similar length together."""
    if limits.characters is None:
        return [list(range(len(prompts)))]
    length = [len(p or "") for p in prompts]
    calls, own = [], []
    for at in sorted(range(len(prompts)), key=length.__getitem__):
        # in this order the prompt at hand is the longest of its call
        if own and (len(own) + 1) * length[at] > limits.characters:
            calls.append(own)
            own = []
        own.append(at)
    return [*calls, own]


def ask(answer: Scorer, prompts: list[str]) -> list[tuple[str | Exception, float]]:
    """(answer, seconds) of every prompt of one call; if it raises, they are asked one by one."""
    begun = time.perf_counter()
    try:
        answers = answer(prompts)
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
        each = (time.perf_counter() - begun) / len(prompts)
        return [(found, each) for found in answers]
    except Exception:
        out = []
        for prompt in prompts:
            alone = time.perf_counter()
            try:
                (found,) = answer([prompt])
            except Exception as error:
                found = error
            out.append((found, time.perf_counter() - alone))
        return out


def score_batch(
    prompts: DataFrame,
    stage: str,
    factory: ScorerFactory,
    profile: ResourceProfile | None = None,
    limits: CallLimits = CallLimits(),
) -> DataFrame:
    """Add ``response``, ``error`` and ``elapsed_sec`` to rows that carry a ``prompt``.

    When the scorer raises for a call, that call's prompts are asked one by one, and only
    those that raise on their own get the error.  A resource profile bounds how many tasks
    of an executor call the model at the same time, ``limits`` the calls within a task; the
    work itself stays in as many tasks as it came in, so a lost one asks little again.
    """
    kept = [f for f in prompts.schema.fields if f.name != "prompt"]
    schema = StructType(kept + [
        StructField("response", StringType()),
        StructField("error", StringType()),
        StructField("elapsed_sec", DoubleType()),
    ])
    sampling = SAMPLING[stage]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = factory(stage, sampling)
        with ThreadPoolExecutor(limits.in_flight) as pool:
            for batch in batches:
                if batch.empty:
                    continue
                asked = batch["prompt"].tolist()
                calls = calls_of(asked, limits)
                answers, each = [None] * len(asked), [0.0] * len(asked)
                for call, found in zip(calls, pool.map(lambda c, asked=asked: ask(answer, [asked[k] for k in c]), calls)):
                    for at, (text, seconds) in zip(call, found):
                        answers[at], each[at] = text, seconds
                failed = [isinstance(a, Exception) for a in answers]
                yield batch.drop(columns="prompt").assign(
                    response=[None if bad else a for a, bad in zip(answers, failed)],
                    error=[str(a) if bad else None for a, bad in zip(answers, failed)],
                    elapsed_sec=each,
                )

    return prompts.mapInPandas(run, schema, profile=profile)


def join_responses(messages: DataFrame, responses: DataFrame, stage: str) -> DataFrame:
    """Captured answers of one stage on their messages; a missing answer is an error."""
    answers = responses.filter(F.col("stage") == stage).select(
        "source_folder_id", "uid", "response", "error"
    )
    joined = messages.join(answers, ["source_folder_id", "uid"], "left")
    no_answer = F.col("response").isNull() & F.col("error").isNull()
    return joined.withColumn(
        "error", F.when(no_answer, F.lit("no response")).otherwise(F.col("error"))
    ).withColumn("elapsed_sec", F.lit(0.0))
