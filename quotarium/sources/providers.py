"""Model providers.

A call costs money and never gives the same answer twice, so calls are made in chunks of a few hundred requests: each chunk's answers are committed to the landing folder
before the next begins, and are only read from there. A run that is resumed has the same key and skips the chunks that have landed, so what a lost executor or driver costs is one chunk.
"""

from __future__ import annotations

import abc
import hashlib
import json
import logging
import math
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quotarium.operators.pacing import TokenPacer
from quotarium.operators.requests import batch_bodies, data_uri
from quotarium.settings import Settings
from quotarium.storage import filesystem, read_text, scratch, small_batches, write_bytes, write_stream

log = logging.getLogger(__name__)

#: Requests or files of a chunk; requests of one submitted batch.
CHUNK, SHARD = 256, 1000


@dataclass
class BatchStatus:
    batch_id: str
    is_complete: bool
    results: str | None = None
    counts: dict[str, int] = field(default_factory=dict)


class ProviderError(RuntimeError):
    pass


class Provider(abc.ABC):
    """files: path, filename, idx. requests: of one category, as the request matrix gives them."""

    def __init__(self, spark: SparkSession, settings: Settings, landing: str):
        self.spark, self.settings, self.landing = spark, settings, landing.rstrip("/")
        #: Names this run's work in the landing folder; a resumed run is given that of the first.
        self.run_key = uuid.uuid4().hex

    def named(self, what: str) -> str:
        """A name that hangs on the run and on what is done, so that the same work finds what it has landed before."""
        return hashlib.sha256(f"{self.run_key}|{what}".encode()).hexdigest()[:24]

    def _landed(self, path: str) -> bool:
        fs, done = filesystem(self.spark, f"{path}/_SUCCESS")
        return fs.exists(done)

    def chunks(self, rows: DataFrame, key: str, size: int) -> list[DataFrame]:
        """The rows in parts of about `size`, dealt by a hash of the key: the same rows are dealt alike each time. Written once, so that no part reads the others."""
        n = max(1, math.ceil(rows.count() / size))
        path = scratch(self.spark, "chunks")
        rows.withColumn("chunk", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).repartition("chunk").write.partitionBy("chunk").parquet(path)
        all_ = self.spark.read.schema(StructType([*rows.schema.fields, StructField("chunk", IntegerType())])).parquet(path)
        return [all_.filter(F.col("chunk") == k).drop("chunk") for k in range(n)]

    def upload(self, files: DataFrame) -> DataFrame:
        """filename, file_id, idx; here the path is the identifier."""
        return files.select("filename", F.col("path").alias("file_id"), "idx")

    @abc.abstractmethod
    def submit(self, category: str, requests: DataFrame) -> str: ...

    @abc.abstractmethod
    def check(self, batch_id: str) -> BatchStatus: ...

    @abc.abstractmethod
    def fetch(self, category: str, status: BatchStatus) -> str:
        """The path of the batch's records."""

    def poll(self, batch_id: str, sleep: Callable[[float], None] = time.sleep) -> BatchStatus:
        """Until the batch is complete, or the deadline."""
        end = time.monotonic() + self.settings.poll_deadline_seconds
        while not (status := self.check(batch_id)).is_complete:
            if time.monotonic() > end:
                raise ProviderError(f"batch {batch_id} isn't complete after {self.settings.poll_deadline_seconds:g} s")
            log.info("batch %s: %s", batch_id, status.counts)
            sleep(self.settings.poll_seconds)
        return status

    def folder(self, batch_id: str) -> str:
        return f"{self.landing}/{batch_id}"


class LandedProvider(Provider):
    """A provider whose records lie in a folder of the landing place, complete when Spark's writer has committed it."""

    def submit(self, category: str, requests: DataFrame) -> str:
        raise ProviderError("this provider only reads what has landed")

    def check(self, batch_id: str) -> BatchStatus:
        if not self._landed(self.folder(batch_id)):
            return BatchStatus(batch_id, False)
        kinds = self.spark.read.text(self.folder(batch_id)).select((F.get_json_object("value", "$.result.type") == "succeeded").alias("ok")).agg(F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("errored")).first()
        return BatchStatus(batch_id, True, self.folder(batch_id), kinds.asDict())

    def fetch(self, category: str, status: BatchStatus) -> str:
        if not status.is_complete:
            raise ProviderError(f"batch {status.batch_id} isn't complete")
        return self.folder(status.batch_id)


def post(url: str, body: dict | bytes, headers: dict[str, str], timeout: float, method: str = "POST") -> tuple[bytes, dict]:
    """One HTTP call. Anything but success raises urllib's HTTPError, which carries code and headers."""
    data = json.dumps(body).encode() if isinstance(body, dict) else body
    ask = urllib.request.Request(url, data=data or None, headers={"content-type": "application/json"} | headers, method=method)
    with urllib.request.urlopen(ask, timeout=timeout) as r:
        return r.read(), dict(r.headers)


def retry_after(headers, default: float) -> float:
    """Seconds that a server asks to wait; what isn't a positive number is the default."""
    try:
        return float((headers or {}).get("Retry-After") or 0) or default
    except (TypeError, ValueError):
        return default


def with_retries(call: Callable[[], dict], settings: Settings, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Calls again when the provider says it is too much, as often as the settings allow."""
    for attempt in range(settings.throttled_attempts + 1):
        try:
            return call()
        except urllib.error.HTTPError as e:
            if e.code != 429 or attempt == settings.throttled_attempts:
                raise
            sleep(retry_after(e.headers, settings.throttled_wait_seconds))
    raise AssertionError


def response_call(base_url: str, headers: dict[str, str], model: str, timeout: float) -> Callable[..., dict]:
    """A call for SynchronousProvider: posts prompt and file to <base_url>/responses and takes the answer's text and the number of tokens it used."""
    url = f"{base_url.rstrip('/')}/responses"

    def call(custom_id: str, prompt: str, file_id: str, uri: str | None) -> dict:
        content = [{"type": "input_text", "text": prompt}, {"type": "input_file", "filename": file_id.rsplit("/", 1)[-1], "file_data": uri}]
        got = json.loads(post(url, {"model": model, "input": [{"role": "user", "content": content}]}, headers, timeout)[0])
        texts = [c.get("text") or "" for o in got.get("output") or [] for c in o.get("content") or [] if c.get("type") == "output_text"]
        return {"text": "\n".join(texts), "tokens": (got.get("usage") or {}).get("total_tokens") or 0}

    return call


class SynchronousProvider(LandedProvider):
    """One call a request, paced. call(custom_id, prompt, file_id, content) gives {"text": ..., "tokens": ...}; a failed call is a failed record, not a failed run.

    Tasks share the quota: with k lanes each paces itself to a k-th of it. What earlier chunks used within the window counts for the next.
    """

    def __init__(self, spark, settings, landing, call: Callable[..., dict], lanes: int = 1, with_content: bool = False, chunk: int = CHUNK):
        super().__init__(spark, settings, landing)
        self.call, self.lanes, self.with_content, self.chunk = call, lanes, with_content, chunk

    def submit(self, category: str, requests: DataFrame) -> str:
        batch_id = f"sync_{self.named(category)}"
        if self._landed(self.folder(batch_id)):
            return batch_id
        used: list[tuple[int, int]] = []
        for k, part in enumerate(self.chunks(requests.select("custom_id", "prompt", "file_id"), "custom_id", self.chunk)):
            path = f"{self.folder(batch_id)}/chunk={k}"
            if not self._landed(path):
                self._ask(part, used).write.mode("overwrite").text(path)
            since = time.time_ns() // 1000 - self.settings.window_seconds * 1_000_000
            lately = self.spark.read.schema("at long, tokens long").json(path).filter(F.col("at") >= since).collect()  # a chunk at most
            used = sorted([u for u in used if u[0] >= since] + [(r["at"], r["tokens"] or 0) for r in lately])
        write_bytes(self.spark, f"{self.folder(batch_id)}/_SUCCESS", b"")
        return batch_id

    def _ask(self, rows: DataFrame, used: list[tuple[int, int]]) -> DataFrame:
        """The answers to a chunk's requests, as lines. used: time and tokens of earlier calls in the window."""
        call, settings, lanes = self.call, self.settings, self.lanes

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pacer = TokenPacer(settings.token_budget // lanes, settings.window_seconds * 1_000_000, settings.history)
            pacer.resume([(t, n // lanes) for t, n in used], [n for _, n in used])
            now = lambda: time.time_ns() // 1000
            for b in batches:
                out = []
                for r in b.to_dict("records"):
                    while wait := pacer.wait_us(now()):
                        time.sleep(wait / 1e6)
                    tokens = 0
                    try:
                        got = with_retries(lambda r=r: call(r["custom_id"], r["prompt"], r["file_id"], r.get("uri")), settings)
                        tokens = int(got.get("tokens") or 0)
                        pacer.record(now(), tokens)
                        result = {"type": "succeeded", "text": got["text"]}
                    except Exception as e:  # noqa: BLE001  whatever a call raises becomes the record's error
                        result = {"type": "errored", "error_message": str(e) or type(e).__name__}
                    out.append(json.dumps({"custom_id": r["custom_id"], "result": result, "tokens": tokens, "at": now()}, ensure_ascii=False))
                yield pd.DataFrame({"value": out})

        if self.with_content:
            paths = [r["file_id"] for r in rows.select("file_id").distinct().collect()]  # of a chunk
            files = self.spark.read.format("binaryFile").load(paths)
            rows = rows.join(files.select(F.col("path").alias("file_id"), data_uri(F.col("content")).alias("uri")), "file_id", "left")
        return rows.repartition(lanes).mapInPandas(run, "value string")


class FakeProvider(SynchronousProvider):
    """Deterministic answers without a network, for tests and dry work: answer(custom_id, prompt, file_id) gives the text."""

    def __init__(self, spark, settings, landing, answer: Callable[[str, str, str], str] | None = None):
        answer = answer or (lambda custom_id, prompt, file_id: '{"findings": []}')
        super().__init__(spark, settings, landing, lambda custom_id, prompt, file_id, uri: {"text": answer(custom_id, prompt, file_id), "tokens": 0})


class HttpBatchProvider(Provider):
    """A batch service with files, a submission and a results address. Requests are posted as one batch a category."""

    def __init__(self, spark, settings, landing, base_url: str, headers: dict[str, str]):
        super().__init__(spark, settings, landing)
        self.base, self.headers = base_url.rstrip("/"), headers

    def _ask(self, path: str, body: dict | bytes = b"", method: str = "POST", headers: dict | None = None) -> dict:
        try:
            return json.loads(post(f"{self.base}{path}", body, self.headers | (headers or {}), self.settings.request_timeout_seconds, method)[0])
        except urllib.error.HTTPError as e:
            raise ProviderError(f"{method} {path}: status {e.code}: {e.read()[:500].decode('utf-8', 'replace')}") from e

    def upload(self, files: DataFrame) -> DataFrame:
        """Files go up from the executors, a chunk after the other; each is tried a few times. What has landed isn't sent again."""
        url, headers, settings = f"{self.base}/files", self.headers, self.settings
        folder = f"{self.landing}/uploads_{self.named('files')}"

        def send(name: str, content: bytes) -> str:
            edge = uuid.uuid4().hex
            body = f'--{edge}\r\nContent-Disposition: form-data; name="file"; filename="{name}"\r\nContent-Type: application/pdf\r\n\r\n'.encode() + content + f"\r\n--{edge}--\r\n".encode()
            for attempt in range(1, settings.upload_attempts + 1):
                try:
                    got = json.loads(post(url, body, headers | {"content-type": f"multipart/form-data; boundary={edge}"}, settings.request_timeout_seconds)[0])
                    break
                except OSError:  # HTTPError too
                    if attempt == settings.upload_attempts:
                        raise
                    time.sleep(settings.upload_wait_seconds)
            if not got.get("id"):
                raise ProviderError(f"no identifier for {name}")
            return got["id"]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"filename": b["filename"], "file_id": [send(n, bytes(c)) for n, c in zip(b["filename"], b["content"])], "idx": b["idx"]})

        small_batches(self.spark)
        for k, part in enumerate(self.chunks(files.select("path", "filename", "idx"), "path", CHUNK)):
            if not self._landed(f"{folder}/chunk={k}") and (paths := [r["path"] for r in part.select("path").collect()]):
                content = self.spark.read.format("binaryFile").load(paths).select("path", "content").join(part, "path")
                content.select("filename", "idx", "content").mapInPandas(run, "filename string, file_id string, idx long").write.mode("overwrite").parquet(f"{folder}/chunk={k}")
        return self.spark.read.schema("filename string, file_id string, idx long").parquet(folder)

    def submit(self, category: str, requests: DataFrame) -> str:
        """Batches of a bounded number of requests, one after another; each identifier is noted before the next is sent. Together they are the category's batch."""
        note = f"{self.landing}/submitted_{self.named(category)}.json"
        done = json.loads(read_text(self.spark, note) or "[]")
        for part in self.chunks(batch_bodies(requests, self.settings.model, self.settings.max_answer_tokens), "custom_id", SHARD)[len(done) :]:
            bodies = part.select("body").orderBy("custom_id").collect()  # about SHARD
            got = self._ask("/messages/batches", b'{"requests":[' + b",".join(r["body"].encode() for r in bodies) + b"]}")
            if not got.get("id"):
                raise ProviderError("no identifier for the batch")
            done.append(got["id"])
            write_bytes(self.spark, note, json.dumps(done).encode())
        return ",".join(done)

    def check(self, batch_id: str) -> BatchStatus:
        got = [self._ask(f"/messages/batches/{one}", method="GET") for one in batch_id.split(",")]
        counts: dict[str, int] = {}
        for g in got:
            for k, n in (g.get("request_counts") or {}).items():
                counts[k] = counts.get(k, 0) + n
        urls = [g.get("results_url") for g in got]
        return BatchStatus(batch_id, all(g.get("processing_status") == "ended" for g in got), " ".join(urls) if all(urls) else None, counts)

    def fetch(self, category: str, status: BatchStatus) -> str:
        """Results files are copied, block by block, under the landing place once; later runs read them from there."""
        if not status.is_complete or not status.results:
            raise ProviderError(f"batch {status.batch_id} has no results")
        folder = self.folder(hashlib.sha256(status.batch_id.encode()).hexdigest()[:24])
        if not self._landed(folder):
            for k, url in enumerate(status.results.split(" ")):
                with urllib.request.urlopen(urllib.request.Request(url, headers=self.headers), timeout=self.settings.download_timeout_seconds) as r:
                    write_stream(self.spark, f"{folder}/results-{k}.jsonl", r)
            write_bytes(self.spark, f"{folder}/_SUCCESS", b"")
        return folder


PROVIDERS: dict[str, type[Provider]] = {"fake": FakeProvider, "jsonl": LandedProvider, "synchronous": SynchronousProvider, "batch": HttpBatchProvider}


def get_provider(name: str, spark: SparkSession, settings: Settings, landing: str, **more) -> Provider:
    """A registered provider by its name, whatever its case."""
    if (key := name.strip().lower()) not in PROVIDERS:
        raise ValueError(f"no provider {name!r}; there are {sorted(PROVIDERS)}")
    return PROVIDERS[key](spark, settings, landing, **more)
