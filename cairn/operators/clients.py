"""Jobs that call external services: paced, retried fetches and caption generation.

The client is a callable that the caller supplies; Spark deals out the requests. A task may run again after
a lost executor, so clients must bear repeated calls for the same id, and results should be written once."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.sources.scratch import filesystem, scratch

from .pace import Pace


class TransientError(Exception):
    """A failure that is worth another attempt."""


def call_with_retry(call: Callable, arg, attempts: int = 3, least: float = 4.0, most: float = 10.0, pause: Callable = time.sleep, slot: Callable | None = None):
    """(result, error): waits least to most seconds, doubling, between attempts at transient failures; slot() goes before each."""
    for k in range(attempts):
        try:
            if slot is not None:
                slot()
            return call(arg), None
        except (TransientError, ConnectionError, TimeoutError) as e:
            if k + 1 == attempts:
                return None, f"{type(e).__name__}: {e}"
            pause(min(most, max(least, least * 2 ** (k - 1) if k else least)))
        except Exception as e:  # the row is kept and counted, whatever the client does
            return None, f"{type(e).__name__}: {e}"


def fetch(requests: DataFrame, client: Callable[[str], str | None], key: str, argument: str, partitions: int | None = 1, per_second: float | None = 5.0, **retry) -> DataFrame:
    """(key, status, body, error) for each request. status: ok, missing (no answer) or error.

    As many requests as partitions are in flight at most; None leaves them where Spark has them. All share one
    rate, every attempt counted: tasks lease their slots from the driver, so what some don't use others do."""
    pace = Pace.of(requests.sparkSession, per_second) if per_second else None

    def run(batches):
        lease = pace.leases() if pace else None
        for b in batches:
            got = [(None, "no argument") if a is None else call_with_retry(client, a, slot=lease, **retry) for a in b["a"].to_pylist()]
            status = ["error" if error else "ok" if body is not None else "missing" for body, error in got]
            columns = [b["k"], *[pa.array(c, pa.string()) for c in (status, [body for body, _ in got], [error for _, error in got])]]
            yield pa.RecordBatch.from_arrays(columns, ["k", "status", "body", "error"])

    rows = requests.select(F.col(key).cast("string").alias("k"), F.col(argument).cast("string").alias("a"))
    dealt = rows.repartition(partitions, "k") if partitions else rows
    return dealt.mapInArrow(run, "k string, status string, body string, error string").withColumnRenamed("k", key)


def fetch_once(requests: DataFrame, client: Callable[[str], str | None], key: str, argument: str, path: str, **how) -> DataFrame:
    """fetch, written to a new table at the path and read again: what reads it, however often, asks nothing anew."""
    fetch(requests, client, key, argument, **how).write.mode("errorifexists").parquet(path)
    return requests.sparkSession.read.parquet(path)


def fetch_resumed(requests: DataFrame, client: Callable[[str], str | None], key: str, argument: str, log: str, batch: int = 10_000, again: tuple[str, ...] = ("error",), partitions: int | None = 1, **how) -> DataFrame:
    """fetch with a log of answers at a path, which grows task by task: a run that was killed goes on where it stopped.

    The requests that the log has answered are left out once, those but with a status in `again`, which
    are asked once more by a new run. A task's answers are in the log as soon as the task is done, so only what was in flight
    when a run was killed is asked twice, about `batch` requests. With a number of partitions, what waits is dealt out by a
    hash of the key and asked batch by batch; without one, all is one job, of tasks that each ask one core's share of
    a batch. Either way requests and log are read two or three times, however many batches there are. One row for each
    key: ok before missing before error. Keys should be distinct, null ones are left out."""
    spark = requests.sparkSession
    waiting = requests.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_key"), F.col(argument).cast("string").alias("_argument"))
    fs, at = filesystem(spark, log)
    schema = f"`{key}` string, status string, body string, error string"
    logged = lambda: spark.read.schema(schema).parquet(log) if fs.exists(at) else spark.createDataFrame([], schema)
    if fs.exists(at):
        answered = logged().where(~F.col("status").isin(*again)) if again else logged()
        waiting = waiting.join(answered.select(F.col(key).alias("_done")), F.col("_key") == F.col("_done"), "left_anti")

    def ask(own: DataFrame) -> None:
        got = fetch(own, client, "_key", "_argument", partitions, **how).withColumnRenamed("_key", key)
        # the second algorithm moves a task's file to the table when the task commits
        got.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode("append").parquet(log)

    batches = -(-waiting.count() // batch)
    if batches and partitions is None:
        ask(waiting.repartition(batches * min(batch, spark.sparkContext.defaultParallelism), "_key"))
    elif batches:
        folder = scratch(spark, "waiting")
        waiting.withColumn("_batch", F.pmod(F.xxhash64("_key"), F.lit(batches))).repartition("_batch").write.partitionBy("_batch").parquet(folder)
        store, _ = filesystem(spark, folder)
        for n in range(batches):
            own = f"{folder}/_batch={n}"
            if store.exists(filesystem(spark, own)[1]):  # a hash may leave a batch empty
                ask(spark.read.schema("_key string, _argument string").parquet(own))
        store.delete(filesystem(spark, folder)[1], True)
    rank = F.when(F.col("status") == "ok", 0).when(F.col("status") == "missing", 1).otherwise(2)
    best = logged().groupBy(key).agg(F.min(F.struct(rank.alias("r"), "status", "body", "error")).alias("b"))
    return best.select(key, "b.status", "b.body", "b.error")


def fetch_batch(requests: DataFrame, client: Callable[[str], str | None], order: str, argument: str, **how) -> DataFrame:
    """fetch in the order of a number column; failed requests have a null body."""
    got = fetch(requests, client, order, argument, **how)
    return got.withColumn(order, F.col(order).cast("bigint")).orderBy(order)


def generate(prompts: DataFrame, client: Callable[[str], str], key: str, prompt: str, at_once: int | None = 4, **retry) -> DataFrame:
    """(key, reply, error) of a text model for each prompt; at_once partitions are in flight, or as many as Spark has."""
    got = fetch(prompts, client, key, prompt, at_once, None, **retry)
    return got.select(key, F.col("body").alias("reply"), F.when(F.col("status") == "missing", "no response").otherwise(F.col("error")).alias("error"))


def reply(client: Callable[[str], str], prompt: Column, **retry) -> Column:
    """struct(reply, error) of a text model for each row's prompt, null for a null one; the row stays as it is, so nothing is joined back.

    Asked once for each row, however often the column is named."""

    @F.arrow_udf("struct<reply:string,error:string>")
    def ask(prompts: pa.Array) -> pa.Array:
        got = [(None, None) if p is None else call_with_retry(client, p, **retry) for p in prompts.to_pylist()]
        rows = [None if p is None else {"reply": r, "error": e if e or r is not None else "no response"} for p, (r, e) in zip(prompts.to_pylist(), got)]
        return pa.array(rows, pa.struct([("reply", pa.string()), ("error", pa.string())]))

    return ask.asNondeterministic()(prompt)
