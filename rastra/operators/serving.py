"""Scoring by a model server: readiness, calls in flight, and the switch between a server and a model in the engine.

The server speaks the open inference protocol over HTTP: ``GET
/v2/health/ready``, ``GET /v2/models/NAME/ready`` and ``POST
/v2/models/NAME/infer`` with tensors as bytes behind a JSON header.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.operators import inference
from rastra.operators.inference import CHANNELS
from rastra.sources.manifests import Settings

_LENGTH = "Inference-Header-Content-Length"


@dataclass(frozen=True)
class HttpScorer:
    """Logits of rows of channels from a model of a server; anything but an answer of the right size is an ``OSError``."""

    url: str
    model: str
    timeout: float = 30.0
    input: str = "input"
    output: str = "output"

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        body = np.ascontiguousarray(rows, dtype="<f4").tobytes()
        asked = {"name": self.input, "shape": list(rows.shape), "datatype": "FP32", "parameters": {"binary_data_size": len(body)}}
        wanted = {"name": self.output, "parameters": {"binary_data": True}}
        head = json.dumps({"inputs": [asked], "outputs": [wanted]}).encode()
        headers = {"Content-Type": "application/octet-stream", _LENGTH: str(len(head))}
        request = urllib.request.Request(f"{self.url.rstrip('/')}/v2/models/{self.model}/infer", head + body, headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            raw, length = reply.read(), int(reply.headers.get(_LENGTH, 0))
        found = np.frombuffer(raw[length:], dtype="<f4") if length else np.array(json.loads(raw)["outputs"][0]["data"], dtype=np.float32)
        if len(found) != len(rows):
            raise OSError(f"{self.url} gave {len(found)} values for {len(rows)} rows")
        return found


def is_ready(url: str, model: str | None = None, timeout: float = 5.0) -> bool:
    """Whether the server, and the model if one is named, says that it can answer."""
    try:
        with urllib.request.urlopen(f"{url.rstrip('/')}/v2/" + (f"models/{model}/ready" if model else "health/ready"), timeout=timeout) as reply:
            return reply.status == 200
    except (OSError, ValueError):
        return False


def await_ready(url: str, model: str | None = None, wait: float = 30.0, pause: float = 0.5) -> None:
    """Returns when the server is ready, with pauses that double; one that is not after ``wait`` seconds is an error."""
    end = time.monotonic() + wait
    while not is_ready(url, model):
        if time.monotonic() + pause > end:
            raise ConnectionError(f"the model server at {url} is not ready")
        time.sleep(pause)
        pause = min(2 * pause, 10.0)


def _again(score: Callable[[np.ndarray], np.ndarray], rows: np.ndarray, attempts: int, pause: float) -> np.ndarray:
    for attempt in range(attempts):
        try:
            return score(rows)
        except urllib.error.HTTPError as e:
            if e.code < 500 and e.code not in (408, 429) or attempt == attempts - 1:  # the request itself is wrong
                raise
        except OSError:
            if attempt == attempts - 1:
                raise
        time.sleep(pause * 2**attempt)
    raise AssertionError


@dataclass(frozen=True)
class ServedModel:
    """A model behind a function of channel rows: each task has at most ``in_flight`` calls of ``rows_a_call`` rows under way, and takes answers in order.

    A call that fails is made again, after pauses that double, ``attempts`` times
    in all; then the task fails, and Spark repeats it elsewhere. A task holds no more
    than the rows that are under way. A null channel is sent as NaN.
    """

    score: Callable[[np.ndarray], np.ndarray]
    channels: tuple[str, ...] = CHANNELS
    in_flight: int = 4
    rows_a_call: int = 1 << 14
    attempts: int = 3
    pause: float = 0.5

    def logits(self, rows: DataFrame) -> DataFrame:
        score, channels, most, size, attempts, pause = self.score, self.channels, self.in_flight, self.rows_a_call, self.attempts, self.pause

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            under_way: deque[tuple[pa.RecordBatch, Future]] = deque()

            def answered() -> pa.RecordBatch:
                part, future = under_way.popleft()
                return pa.RecordBatch.from_arrays([*part.columns, pa.array(np.asarray(future.result(), dtype=np.float64))], names=[*part.schema.names, "logit"])

            with ThreadPoolExecutor(most) as pool:
                for batch in batches:
                    for at in range(0, batch.num_rows, size):
                        part = batch.slice(at, size)
                        if len(under_way) == most:
                            yield answered()
                        sent = np.stack([part[c].to_numpy(zero_copy_only=False).astype(np.float32) for c in channels], axis=1)
                        under_way.append((part, pool.submit(_again, score, sent, attempts, pause)))
                while under_way:
                    yield answered()

        return rows.drop("logit").mapInArrow(run, rows.drop("logit").select("*", F.lit(0.0).alias("logit")).schema)


def choose_model(spark: SparkSession, name: str, settings: Settings | None = None, wait: float = 30.0, **options) -> inference.Model:
    """The model of that name: of the server that the settings name, once it is ready, or else a registered or saved one in the engine."""
    server = (settings or Settings()).model_server
    if not server:
        return inference.choose_model(spark, name)
    await_ready(server, name, wait)
    return ServedModel(HttpScorer(server, name), **options)


def health(detections: DataFrame, settings: Settings) -> DataFrame:
    """The catalogue's health with the server's readiness; null where no server is set."""
    from rastra.operators import catalog

    return catalog.health(detections, is_ready(settings.model_server) if settings.model_server else None)
