"""Model calls: a scripted offline model, and a manager with a cache, budgets and retries. One manager serves all stages of a run."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.plans.durable import durable


class BudgetExceeded(RuntimeError):
    pass


@dataclass
class ScriptedModel:
    """The reply of the first key that a prompt contains, else the default."""

    script: dict[str, str] = field(default_factory=dict)
    default: str = "{}"
    name: str = "mock"
    cost: float = 0.0

    def complete(self, prompt: str) -> tuple[str, float]:
        return next((v for k, v in self.script.items() if k in prompt), self.default), self.cost


def call(model: ScriptedModel, prompt: str, retries: int, backoff: float, passing: tuple[str, ...], sleep: Callable[[float], None]) -> tuple[str, float]:
    """A reply and its cost; passing errors are tried again."""
    for n in range(retries + 1):
        try:
            return model.complete(prompt)
        except Exception as e:
            if n == retries or not any(p in type(e).__name__ for p in passing):
                raise
            sleep(backoff * 2**n)
    raise AssertionError("the last try returns or raises")


def _replies(frames: Iterator[pd.DataFrame], model: ScriptedModel, retries: int, backoff: float, passing: tuple[str, ...], gap: float) -> Iterator[pd.DataFrame]:
    last = 0.0
    for frame in frames:
        rows = []
        for key, prompt in zip(frame["key"], frame["prompt"], strict=True):
            if gap > 0 and (wait := last + gap - time.monotonic()) > 0:
                time.sleep(wait)
            last = time.monotonic()
            try:
                reply, cost = call(model, prompt, retries, backoff, passing, time.sleep)
                rows.append((key, reply, cost, None))
            except Exception as e:  # one prompt's failure is its own
                rows.append((key, None, 0.0, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=["key", "reply", "cost", "error"]).astype({"cost": "float64"})


def make_model(name: str, default: str = "{}") -> ScriptedModel:
    """The model of a name: those that start with `mock` are scripted; others come from litellm, if it is installed."""
    if name.startswith("mock"):
        return ScriptedModel(default=default, name=name)
    return LiteModel(name=name)


@dataclass
class LiteModel:
    """A hosted model, by a client library that is asked for where it is used."""

    name: str

    def complete(self, prompt: str) -> tuple[str, float]:
        import litellm

        reply = litellm.completion(model=self.name, messages=[{"role": "user", "content": prompt}])
        return reply.choices[0].message.content or "", float(litellm.completion_cost(reply) or 0.0)


@dataclass
class ManagedModel:
    """Replies are kept by a hash of model, kind, temperature and prompt; kept replies are free.

    Budgets are checked before a call. Errors whose class name has one of `passing` are tried again after backoff * 2**n seconds.
    """

    model: ScriptedModel
    max_calls: int = 2000
    max_cost: float = 10.0
    retries: int = 4
    backoff: float = 20.0
    rpm: float = 0.0
    passing: tuple[str, ...] = ("RateLimit", "Timeout", "Connection", "ServiceUnavailable", "InternalServer")
    sleep: Callable[[float], None] = time.sleep
    kept: dict[str, str] = field(default_factory=dict)
    calls: int = 0
    spent: float = 0.0
    last: float = 0.0

    def prefix(self, kind: str, temperature: float = 0.0) -> str:
        return "|".join((self.model.name, kind, str(temperature), ""))

    def answers(self, prompts: DataFrame, kind: str, wave: int = 256) -> DataFrame:
        """prompts(id, prompt) with reply and error; both are null where the budgets ended before.

        Prompts that were asked before cost nothing. The others are asked in waves of at most `wave`, each dealt over partitions, so that
        the costs are known before the next one; a partition keeps its part of the calls a minute. Replies (one a call) are kept here.
        """
        spark = prompts.sparkSession
        prompts = durable(prompts.withColumn("key", F.sha2(F.concat(F.lit(self.prefix(kind)), "prompt"), 256)), "prompts")
        errors: list[tuple[str, str]] = []
        while self.calls < self.max_calls and self.spent < self.max_cost:
            known = spark.createDataFrame([(k,) for k in [*self.kept, *(k for k, _ in errors)]], "key string")
            open_ = prompts.select("key", "prompt").dropDuplicates(["key"]).join(known, "key", "left_anti").orderBy("key").limit(min(wave, self.max_calls - self.calls))
            parts = max(1, min(spark.sparkContext.defaultParallelism, wave))
            gap = 60 / self.rpm * parts if self.rpm > 0 else 0.0
            ask = partial(_replies, model=self.model, retries=self.retries, backoff=self.backoff, passing=self.passing, gap=gap)
            found = durable(open_.repartition(parts).mapInPandas(ask, "key string, reply string, cost double, error string"), "replies").collect()
            if not found:
                break
            for r in found:
                if r.error is None:
                    self.kept[r.key], self.calls, self.spent = r.reply, self.calls + 1, self.spent + r.cost
                else:
                    errors.append((r.key, r.error))
        asked = {r.key for r in prompts.select("key").distinct().join(spark.createDataFrame([(k,) for k in self.kept], "key string"), "key", "left_semi").collect()}  # kept ones only
        rows = [(k, self.kept[k], None) for k in asked] + [(k, None, e) for k, e in errors]
        return prompts.join(spark.createDataFrame(rows, "key string, reply string, error string"), "key", "left").drop("key")

    def complete(self, prompt: str, kind: str = "chat", temperature: float = 0.0) -> str:
        key = hashlib.sha256(self.prefix(kind, temperature).encode() + prompt.encode()).hexdigest()
        if key in self.kept:
            return self.kept[key]
        if self.calls >= self.max_calls:
            raise BudgetExceeded(f"{self.calls} calls were made")
        if self.spent >= self.max_cost:
            raise BudgetExceeded(f"{self.spent} was spent")
        if self.rpm > 0 and (wait := self.last + 60 / self.rpm - time.monotonic()) > 0:
            self.sleep(wait)
        self.last = time.monotonic()
        reply, cost = call(self.model, prompt, self.retries, self.backoff, self.passing, self.sleep)
        self.calls, self.spent = self.calls + 1, self.spent + cost
        self.kept[key] = reply
        return reply
