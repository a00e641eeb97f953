"""Fetching through a transport that the caller gives (this library opens no connection): paged listings, answers that are refused, bodies, and files kept by their checksum."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Takes an address and its parameters, returns the answer's body.
Transport = Callable[[str, Mapping[str, object]], bytes]


class Refused(RuntimeError):
    """An answer that is not what was asked for."""


def json_body(body: bytes, what: str = "answer") -> object:
    """A body as JSON; a page of HTML or torn JSON is refused."""
    head = body.lstrip()[:200].lower()
    if head.startswith((b"<!doctype", b"<html")):
        raise Refused(f"{what}: a page came instead of data")
    try:
        return json.loads(body)
    except ValueError as e:
        raise Refused(f"{what}: not JSON ({e})") from e


def pages(get: Transport, address: str, parameters: Mapping[str, object], items: Callable[[object], Sequence], total: Callable[[object], int | None], size: int = 100, offset: str = "os", rows: str = "rows") -> Iterator[object]:
    """The items of a paged listing, page after page, until its own total is reached, or, where it names none, until a page is short. Fewer than the total is an error: a truncated listing is never returned as whole."""
    seen, expected = 0, None
    while True:
        answer = json_body(get(address, {**parameters, offset: seen, rows: size}), address)
        page = items(answer)
        expected = total(answer) if total(answer) is not None else expected
        yield from page
        seen += len(page)
        if (expected is not None and seen >= expected) or (expected is None and len(page) < size):
            return
        if not page:
            raise Refused(f"{address}: {seen} of {expected} items")


def page_starts(total: int, size: int) -> list[int]:
    """The offsets of a listing's pages."""
    return list(range(0, max(total, 1), size))


def fetch_table(spark: SparkSession, get: Transport, address: str, parameters: Mapping[str, object], total: int, schema: str, items: str, size: int = 100, offset: str = "os", rows: str = "rows", tasks: int = 8) -> DataFrame:
    """A listing whose total is known, its pages fetched by the executors: the driver holds offsets alone. Each page is checked to hold what it must; `get` is sent to the executors."""
    starts = spark.createDataFrame([(s, min(size, total - s)) for s in page_starts(total, size)], "start int, n int").repartition(tasks, "start")

    def run(batches):
        for pdf in batches:
            bodies = []
            for start, n in zip(pdf["start"], pdf["n"], strict=True):
                body = get(address, {**parameters, offset: int(start), rows: size})
                found = json_body(body, address)[items]
                if len(found) < n:
                    raise Refused(f"{address} from {start}: {len(found)} of {n} items")
                bodies += [json.dumps(x) for x in found[:n]]
            yield pdf.iloc[:0].assign(body=[]).reindex(range(len(bodies))).assign(body=bodies)[["body"]]

    return starts.mapInPandas(run, "body string").select(F.from_json("body", schema).alias("r")).select("r.*")


@dataclass
class Spend:
    """What calls have cost, step by step, against a cap."""

    cap: float
    steps: list[tuple[str, float]] = field(default_factory=list)

    @property
    def total(self) -> float:
        return sum(cost for _, cost in self.steps)

    def left(self) -> float:
        return self.cap - self.total

    def add(self, step: str, cost: float) -> None:
        """Records a step's cost; one beyond the cap is refused before it is made."""
        if cost > self.left():
            raise Refused(f"{step}: {cost} is more than the {self.left()} left")
        self.steps.append((step, cost))


def cap_left(ledger: DataFrame, cap: float, since: str) -> float:
    """The cap less what a ledger (cost, at) has recorded since a time."""
    spent = ledger.where(F.col("at") >= F.lit(since).cast("timestamp")).agg(F.sum("cost").alias("s")).first()["s"]
    return cap - float(spent or 0)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_whole(spark: SparkSession, path: str, data: bytes) -> None:
    """A file that appears whole or not at all, on any file system that Spark writes to."""
    fs, at = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(data))
    out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"could not write {path}")


def read_whole(spark: SparkSession, path: str) -> bytes | None:
    """A file's bytes; None if it is not there."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    return data


def store_keeping_old(spark: SparkSession, path: str, data: bytes) -> bool:
    """Stores a fetched file; bytes that differ from those there are kept beside them under their checksum first. Whether anything changed."""
    old = read_whole(spark, path)
    if old == data:
        return False
    if old is not None:
        write_whole(spark, f"{path}.{hashlib.sha256(old).hexdigest()[:12]}", old)
    write_whole(spark, path, data)
    return True
