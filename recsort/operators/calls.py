"""Calls to an outside service, each on its own, with a journal of the outcomes.

A call is named by its id and a hash of its request (``call_id``); input rows
that repeat both share one call, rows that repeat only the id are called each.
Calls run in tasks of ``calls_per_task``, inside a task ``concurrency`` at a
time, each with a timeout, retries and a growing pause between them. Whatever
a call does (an answer, an exception, no answer in time, no answer at all for
a row of a batch) becomes one outcome row and never ends the job.

Outcomes go to a journal, a plain Parquet folder of
(run, call_id, body, error, attempts, at): a task's outcomes are there as soon
as the task has ended, whether or not the job ends well, because the writer
moves files at task commit (file output committer, version 2). A run that is
started again, after a lost driver for instance, reads the replies it has paid
for and calls only for the rest; a lost executor repeats at most its running
tasks. Calls that failed are tried again by the next start of the run.

Python threads cannot be ended from outside: a call that has timed out is given
up and its thread left to end by itself, so give the client a timeout of its own.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.session import scratch_path

JOURNAL = "run string, call_id string, body string, error string, attempts int, at timestamp"
NO_RESPONSE = "no response"
TIMEOUT = "timeout"


class PermanentError(Exception):
    """Raise it in a call that further attempts cannot mend (a rejected request, say)."""


def call_id(key: Column | str, request: Column | str = "request") -> Column:
    """Name of a call: its id (null is an id of its own) and its request."""
    k, r = (F.col(c) if isinstance(c, str) else c for c in (key, request))
    named = F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("?"))
    return F.sha2(F.concat(F.octet_length(named).cast("string"), F.lit(":"), named, F.coalesce(r, F.lit(""))), 256)


def attempt(fn: Callable, arg, timeout: float):
    """(value, error, may be tried again) of ``fn(arg)`` in a thread of its own, given up after ``timeout`` seconds."""
    done: queue.SimpleQueue = queue.SimpleQueue()

    def body():
        try:
            done.put((fn(arg), None, False))
        except PermanentError as e:
            done.put((None, f"{type(e).__name__}: {e}", False))
        except Exception as e:  # noqa: BLE001  whatever the caller's function does is this call's outcome
            done.put((None, f"{type(e).__name__}: {e}", True))

    threading.Thread(target=body, daemon=True).start()
    try:
        return done.get(timeout=timeout)
    except queue.Empty:
        return None, TIMEOUT, True


def persist(fn: Callable, arg, timeout: float, attempts: int, backoff: float):
    """(value, error, attempts made): tries until there is a value, with pauses of backoff, 2 backoff, 4 backoff ..."""
    for n in range(1, attempts + 1):
        value, error, again = attempt(fn, arg, timeout)
        if error is None or not again or n == attempts:
            return value, error, n
        time.sleep(backoff * 2 ** (n - 1))
    raise ValueError("attempts must be at least 1")


class _Responder:
    """``responder(requests, key)``: requests (key, request) to one outcome (call_id, body, error) per call."""

    row_wise = False

    def __init__(self, fn: Callable, concurrency: int, timeout: float, attempts: int, backoff: float,
                 calls_per_task: int, max_tasks: int | None, journal: str | None, run: str):
        self.fn, self.concurrency, self.timeout, self.attempts, self.backoff = fn, concurrency, timeout, attempts, backoff
        self.calls_per_task, self.max_tasks, self.journal, self.run = calls_per_task, max_tasks, journal, run

    def _units(self, calls: list[tuple]) -> list[list[tuple]]:
        raise NotImplementedError

    def _answers(self):
        """A function of one unit: its (call_id, body, error, attempts) rows."""
        raise NotImplementedError

    def _task(self, key: str):
        answers, units, width = self._answers(), self._units, self.concurrency

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from concurrent.futures import ThreadPoolExecutor, as_completed
            with ThreadPoolExecutor(width) as pool:
                for batch in batches:
                    calls = list(zip(*[batch.column(c).to_pylist() for c in ("call_id", key, "request")]))
                    for f in as_completed([pool.submit(answers, u) for u in units(calls)]):
                        ids, bodies, errors, made = zip(*f.result())
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(bodies, pa.string()),
                                                          pa.array(errors, pa.string()), pa.array(made, pa.int32())],
                                                         names=["call_id", "body", "error", "attempts"])

        return run

    def replies(self, spark: SparkSession) -> DataFrame:
        """The journal's outcomes of this run: per call the reply if there is one, else the last failure."""
        if self.journal is None or not _exists(spark, self.journal):
            return spark.createDataFrame([], JOURNAL).select("call_id", "body", "error")
        own = spark.read.schema(JOURNAL).parquet(self.journal).filter(F.col("run") == self.run)
        best = F.max_by(F.struct("body", "error"), F.struct(F.col("error").isNull(), "at", F.coalesce("error", F.lit(""))))
        return own.groupBy("call_id").agg(best.alias("r")).select("call_id", "r.body", "r.error")

    def __call__(self, requests: DataFrame, key: str) -> DataFrame:
        spark = requests.sparkSession
        if self.journal is None:
            self.journal = scratch_path(spark, "calls")
        calls = requests.select(call_id(key).alias("call_id"), key, "request")
        calls = calls.groupBy("call_id").agg(F.any_value(key).alias(key), F.any_value("request").alias("request"))
        paid = self.replies(spark).filter("error IS NULL").select("call_id")
        todo = calls.join(paid, "call_id", "left_anti")
        tasks = max(1, -(-todo.count() // self.calls_per_task))
        waves = 1 if self.max_tasks is None else -(-tasks // self.max_tasks)
        for wave in range(waves):
            # Ids are digests, so their first digits deal the calls evenly.
            own = todo.filter(F.conv(F.substring("call_id", 1, 8), 16, 10).cast("long") % waves == wave)
            out = (own.repartition(-(-tasks // waves), "call_id").mapInArrow(self._task(key), "call_id string, body string, error string, attempts int")
                   .select(F.lit(self.run).alias("run"), "call_id", "body", "error", "attempts", F.current_timestamp().alias("at")))
            out.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self.journal)
        return self.replies(spark)


class CallResponder(_Responder):
    """``fn(request) -> body``, one call per request."""

    def __init__(self, fn: Callable[[str], str | None], concurrency: int = 2, timeout: float = 60.0, attempts: int = 3,
                 backoff: float = 0.5, calls_per_task: int = 64, max_tasks: int | None = None, journal: str | None = None, run: str = "run"):
        super().__init__(fn, concurrency, timeout, attempts, backoff, calls_per_task, max_tasks, journal, run)

    def _units(self, calls):
        return [[c] for c in calls]

    def _answers(self):
        fn, limits = self.fn, (self.timeout, self.attempts, self.backoff)

        def one(unit):
            ((cid, _, request),) = unit
            body, error, made = persist(fn, request, *limits)
            if error is None and body is None:
                error = NO_RESPONSE
            return [(cid, None if body is None else str(body), error, made)]

        return one


class PandasResponder(_Responder):
    """``fn(pdf[key, request]) -> pdf[key, body, error]``, at most ``batch_rows`` requests a call, none with the same id."""

    def __init__(self, fn: Callable[[pd.DataFrame], pd.DataFrame], concurrency: int = 2, batch_rows: int = 32, timeout: float = 60.0,
                 attempts: int = 1, backoff: float = 0.5, calls_per_task: int = 256, max_tasks: int | None = None,
                 journal: str | None = None, run: str = "run"):
        super().__init__(fn, concurrency, timeout, attempts, backoff, calls_per_task, max_tasks, journal, run)
        self.batch_rows = batch_rows

    def _task(self, key: str):
        self.key = key
        return super()._task(key)

    def _units(self, calls):
        units: list[dict] = []
        full = 0  # units before it hold batch_rows calls
        nth: dict = {}
        for c in calls:
            # The n-th call of an id goes to a unit behind those that hold it.
            at = max(nth.get(c[1], 0), full)
            while at < len(units) and len(units[at]) >= self.batch_rows:
                at += 1
            if at == len(units):
                units.append({})
            units[at][c[1]] = c
            nth[c[1]] = at + 1
            while full < len(units) and len(units[full]) >= self.batch_rows:
                full += 1
        return [list(u.values()) for u in units]

    def _answers(self):
        fn, key, limits = self.fn, self.key, (self.timeout, self.attempts, self.backoff)

        def many(unit):
            pdf = pd.DataFrame({key: [c[1] for c in unit], "request": [c[2] for c in unit]})
            out, error, made = persist(fn, pdf, *limits)
            if error is None:
                try:
                    given = {k: (b, e) for k, b, e in zip(*(out[c] for c in (key, "body", "error")))}
                except Exception as e:  # noqa: BLE001  not the promised frame
                    error = f"{type(e).__name__}: {e}"
            if error is not None:
                return [(c[0], None, error, made) for c in unit]
            text = lambda x: None if x is None or x is pd.NA or x != x else str(x)
            rows = []
            for cid, k, _ in unit:
                body, err = map(text, given.get(k, (None, NO_RESPONSE)))
                rows.append((cid, body, err if err is not None or body is not None else NO_RESPONSE, made))
            return rows

        return many


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
