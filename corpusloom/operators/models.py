"""Model calls as a pluggable batch operator, with cached verdicts. An offline stub serves tests."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship

Validator = Callable[[dict], str | None]


class ModelBackend(Protocol):
    """Answers a batch of prompts. It is pickled to the executors; one instance serves a partition."""

    def complete(self, prompts: list[str], system: str) -> list[str]: ...


@dataclass
class StubBackend:
    """Deterministic answers for tests: ``answer(prompt)`` or the prompt's hash."""

    answer: Callable[[str], str] | None = None

    def complete(self, prompts: list[str], system: str) -> list[str]:
        f = self.answer or (lambda p: json.dumps({"hash": hashlib.sha256(p.encode()).hexdigest()[:8]}))
        return [f(p) for p in prompts]


class QuotaExhausted(RuntimeError):
    """No key can be used before the quota is renewed: the run stops, what is done stays done."""


# What cools a key down, and for how long (seconds).
COOLING = ("rate", "daily_quota", "invalid_key", "timeout", "server")
FIRST_PAUSE, LONGEST_PAUSE, LONGEST_SERVER_PAUSE, DAY = 30.0, 1800.0, 300.0, 86_400.0


def next_pacific_midnight(now: float) -> float:
    """The next midnight in Los Angeles, where providers' days end, as seconds since 1970."""
    import datetime
    from zoneinfo import ZoneInfo

    here = datetime.datetime.fromtimestamp(now, ZoneInfo("America/Los_Angeles"))
    return (here + datetime.timedelta(days=1)).replace(hour=0, minute=0, second=0, microsecond=0).timestamp()


@dataclass
class KeyPool:
    """Round robin over keys that aren't cooling down. Times are in seconds; ``clock`` and ``sleep`` are injected in tests; ``rows`` and ``restore`` carry the cooldowns between runs."""

    keys: list[str]
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    max_wait: float = 300.0
    until: dict[str, float] = field(default_factory=dict)
    strikes: dict[str, int] = field(default_factory=dict)
    reason: dict[str, str] = field(default_factory=dict)
    at: int = 0

    def healthy(self, key: str) -> bool:
        return self.until.get(key, 0) <= self.clock()

    def acquire(self) -> str:
        for _ in range(len(self.keys)):
            key = self.keys[self.at % len(self.keys)]
            self.at += 1
            if self.healthy(key):
                return key
        waitable = [self.until[k] for k in self.keys if self.reason.get(k) not in ("daily_quota", "invalid_key")]
        if not waitable:
            raise QuotaExhausted("every key is locked")
        wait = min(waitable) - self.clock()
        if wait > self.max_wait:
            raise QuotaExhausted("keys cool down for too long")
        self.sleep(max(0.0, wait))
        return self.acquire()

    def succeed(self, key: str) -> None:
        for held in (self.strikes, self.until, self.reason):
            held.pop(key, None)

    def fail(self, key: str, kind: str, retry_after: float | None = None) -> None:
        """Cool a key down: as long as the provider asks, else exponentially from 30 s to 30 min (5 min for server errors and timeouts), until the provider's midnight, or 4 days if the key is invalid.

        Other failures are the call's, not the key's. A strike counts on only while the key is still cooling.
        """
        if kind not in COOLING:
            return
        n = self.strikes[key] = 1 if self.healthy(key) else self.strikes.get(key, 0) + 1
        now = self.clock()
        if kind == "rate" and retry_after:
            pause = min(max(retry_after, 1.0), LONGEST_PAUSE)
        elif kind == "daily_quota":
            pause = max(60.0, next_pacific_midnight(now) - now)
        elif kind == "invalid_key":
            pause = 4 * DAY
        else:
            pause = min(FIRST_PAUSE * 2 ** (n - 1), LONGEST_SERVER_PAUSE if kind in ("timeout", "server") else LONGEST_PAUSE)
        self.until[key], self.reason[key] = now + pause, kind

    def rows(self) -> list[tuple[str, str, int, float]]:
        """(key, reason, strikes, until) of the keys that cool down, to be stored."""
        return [(k, self.reason[k], self.strikes.get(k, 1), self.until[k]) for k in self.keys if k in self.until]

    def restore(self, rows) -> KeyPool:
        for key, reason, strikes, until in rows:
            if key in self.keys:
                self.reason[key], self.strikes[key], self.until[key] = reason, strikes, until
        return self


# How providers say what went wrong: (kind, HTTP statuses, wordings without blanks, dashes and underscores), in order of precedence, and how they ask to wait.
ERRORS = (
    ("rate", (429,), ("429", "resourceexhausted", "rate")),
    ("invalid_key", (401, 403), ("apikey", "permission")),
    ("server", (404, 500, 502, 503, 504), ("unavailable", "notfound", "nolongeravailable")),
    ("timeout", (), ("timeout", "timedout")),
)
WAITS = (r"please retry in (\d+(?:\.\d+)?)\s*s", r"retryDelay['\":\s]+(\d+(?:\.\d+)?)s", r"retry[- ]after[:\s]*(\d+(?:\.\d+)?)")
DAILY = "perday"


def classify_error(message: str, status: int | None = None) -> tuple[str, float | None]:
    """(kind, seconds to wait if the provider says) of a provider's error; what fits no rule is ``other`` and isn't the key's fault."""
    packed = re.sub(r"[_\- ]", "", message.lower())
    kind = next((k for k, statuses, wordings in ERRORS if status in statuses or any(w in packed for w in wordings)), "other")
    if kind == "rate" and DAILY in packed:
        return "daily_quota", None
    asked = [float(n) + 0.5 for p in WAITS for n in re.findall(p, message, re.I)] if kind in ("rate", "server") else []
    return kind, asked[0] if asked else None


class ProviderError(RuntimeError):
    """A failed call of a provider."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


@dataclass
class PooledBackend:
    """Calls of a provider with keys in turn: ``call(key, prompt, system)`` answers or raises. A key that fails cools down and the next is tried, ``attempts`` times; calls start ``spacing`` seconds apart.

    One instance serves a partition, so that the spacing holds for each task: run calls in as many partitions as the provider's limits allow.
    """

    call: Callable[[str, str, str], str]
    pool: KeyPool
    attempts: int = 6
    spacing: float = 20.0
    last: float | None = None

    def complete(self, prompts: list[str], system: str) -> list[str]:
        return [self._one(p, system) for p in prompts]

    def _one(self, prompt: str, system: str) -> str:
        error: Exception | None = None
        for _ in range(self.attempts):
            key = self.pool.acquire()
            if self.last is not None:
                self.pool.sleep(max(0.0, self.last + self.spacing - self.pool.clock()))
            self.last = self.pool.clock()
            try:
                answer = self.call(key, prompt, system)
            except Exception as e:  # whatever the provider's client raises
                error, (kind, wait) = e, classify_error(str(e), getattr(e, "status", None))
                self.pool.fail(key, kind, wait)
                continue
            self.pool.succeed(key)
            return answer
        raise error or ProviderError("no attempt was made")


def complete(prompts: DataFrame, backend: ModelBackend, schema: str, system: str = "", validate: Validator | None = None, batch: int = 40, attempts: int = 3, key: str = "id", prompt: str = "prompt") -> DataFrame:
    """(key, answer struct, error) of each row's prompt.

    Batches of a partition go to the backend; an answer that isn't JSON or fails ``validate`` is asked again with the complaint attached. A batch that fails
    leaves its rows with an error, and the others go on.
    """
    ship(prompts.sparkSession)
    kind = prompts.schema[key].dataType.simpleString()

    def ask(text: str) -> tuple[str | None, str | None]:
        complaint, error = "", None
        for _ in range(attempts):
            raw = backend.complete([text + complaint], system)[0]
            try:
                got = json.loads(raw)
                error = None if validate is None else validate(got)
            except (ValueError, TypeError) as e:
                error = f"not JSON: {e}"
            if error is None:
                return raw, None
            complaint = f"\nThe last answer was refused: {error}"
        return None, error

    def run(pages):
        import pandas as pd

        for pdf in pages:
            for a in range(0, len(pdf), batch):
                part = pdf.iloc[a : a + batch]
                out = []
                for k, text in zip(part[key], part[prompt]):
                    try:
                        raw, error = ask(text)
                    except QuotaExhausted:
                        raise
                    except Exception as e:  # one bad call must not lose the others
                        raw, error = None, f"{type(e).__name__}: {e}"
                    out.append((k, raw, error))
                yield pd.DataFrame(out, columns=[key, "raw", "error"])

    answered = prompts.select(key, prompt).mapInPandas(run, f"{key} {kind}, raw string, error string")
    return answered.select(key, F.from_json("raw", schema).alias("answer"), "error")


def complete_cached(prompts: DataFrame, cache: DataFrame, backend: ModelBackend, schema: str, key: str = "id", limit: int | None = None, order: list | None = None, **kwargs) -> DataFrame:
    """Answers of the rows that ``cache`` (key, answer) lacks, so that nothing is asked twice; ``limit`` rows at most, in ``order``."""
    todo = prompts.join(cache.select(key), key, "left_anti")
    if limit:
        todo = todo.orderBy(*(order or [key])).limit(limit)
    return complete(todo, backend, schema, key=key, **kwargs)


def embed(texts: DataFrame, embedder: Callable[[list[str]], list[list[float]]], key: str = "id", text: str = "text", batch: int = 64, cache: DataFrame | None = None) -> DataFrame:
    """(key, vector): batches of a partition go to ``embedder``; rows in ``cache`` aren't embedded again."""
    ship(texts.sparkSession)
    todo = texts.join(cache.select(key), key, "left_anti") if cache is not None else texts
    kind = texts.schema[key].dataType.simpleString()

    def run(pages):
        import pandas as pd

        for pdf in pages:
            for a in range(0, len(pdf), batch):
                part = pdf.iloc[a : a + batch]
                yield pd.DataFrame({key: part[key].tolist(), "vector": embedder([t or "" for t in part[text]])})

    return todo.select(key, text).mapInPandas(run, f"{key} {kind}, vector array<double>")


def valid_mentions(mentions: DataFrame, doc: str = "doc", least: int = 2, most: int = 12) -> DataFrame:
    """``mentions`` (doc, pos, text, type, salience) with an error on those a response must not hold: blank text, salience outside 0 to 1, repeats, too many; too few mark the document."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(doc)
    again = F.row_number().over(Window.partitionBy(doc, F.trim("text"), "type").orderBy("pos")) > 1
    place = F.row_number().over(Window.partitionBy(doc).orderBy("pos"))
    error = (
        F.when(F.trim(F.coalesce("text", F.lit(""))) == "", "blank")
        .when(~F.coalesce(F.col("salience").between(0.0, 1.0), F.lit(False)), "salience")
        .when(F.col("_again"), "repeated")
        .when(F.col("_place") > most, "too many")
        .when(F.col("_n") < least, "too few")
    )
    m = mentions.withColumn("_again", again).withColumn("_place", place).withColumn("_n", F.count(F.lit(1)).over(w))
    return m.withColumn("error", error).drop("_again", "_place", "_n")
