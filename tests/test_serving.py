"""Scoring by a server: one that is slow, fails or isn't ready, against the same model in the engine."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS
from rastra.operators import inference, serving
from rastra.operators.inference import CHANNELS
from rastra.plans import pipelines
from rastra.sources import manifests, rasters
from rastra.sources.manifests import Settings


class Server:
    """The baseline model behind HTTP; counts its calls, and fails or waits as it is told."""

    def __init__(self, fail=0, code=503, wait=0.0, ready=0, short=False):
        self.fail, self.now, self.most, self.calls, self.ready = fail, 0, 0, 0, ready
        lock, own = threading.Lock(), self
        weights = np.array([inference.BASELINE.weights.get(c, 0.0) for c in CHANNELS], dtype=np.float32)

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def do_GET(self):
                own.ready -= 1
                self.send_response(200 if own.ready < 0 else 503)
                self.end_headers()

            def do_POST(self):
                body = self.rfile.read(int(self.headers["Content-Length"]))
                with lock:
                    own.now, own.calls = own.now + 1, own.calls + 1
                    own.most, own.fail, failing = max(own.most, own.now), own.fail - 1, own.fail > 0
                time.sleep(wait)
                n = int(self.headers[serving._LENGTH])
                shape = json.loads(body[:n])["inputs"][0]["shape"]
                out = (np.frombuffer(body[n:], dtype="<f4").reshape(shape) @ weights - 0.5).astype("<f4")
                out = out[:-1] if short else out
                head = json.dumps({"outputs": [{"name": "output", "datatype": "FP32", "shape": [len(out)]}]}).encode()
                with lock:
                    own.now -= 1
                self.send_response(code if failing else 200)
                self.send_header(serving._LENGTH, str(len(head)))
                self.end_headers()
                self.wfile.write(head + out.tobytes())

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.http.server_address[1]}"
        threading.Thread(target=self.http.serve_forever, daemon=True).start()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.http.shutdown()
        self.http.server_close()


def rows(spark, n=3000):
    return spark.range(n, numPartitions=1).select("id", *[F.rand(k).alias(c) for k, c in enumerate(CHANNELS)])


def served(spark, server, df, **options):
    model = serving.choose_model(spark, "baseline", Settings(model_server=server.url), wait=5, pause=0.01, **options)
    assert isinstance(model, serving.ServedModel)
    got = {r["id"]: r["logit"] for r in model.logits(df).collect()}
    wanted = {r["id"]: r["logit"] for r in inference.BASELINE.logits(df).collect()}
    assert got.keys() == wanted.keys() and max(abs(got[k] - wanted[k]) for k in got) < 1e-5


def test_calls_in_flight_are_bounded_and_overlap(spark):
    with Server(wait=0.05) as server:
        served(spark, server, rows(spark), in_flight=3, rows_a_call=100)
        assert server.calls == 30 and 1 < server.most <= 3


def test_a_failing_server_is_asked_again(spark):
    with Server(fail=4) as server:
        served(spark, server, rows(spark, 500), in_flight=2, rows_a_call=100, attempts=6)
        assert server.calls == 5 + 4


@pytest.mark.parametrize(("server", "options"), [({"fail": 10**6}, {"attempts": 2}), ({"fail": 10**6, "code": 400}, {"attempts": 50}), ({"short": True}, {"attempts": 1})])
def test_a_server_that_keeps_failing_is_an_error(spark, server, options):
    with Server(**server) as s:
        with pytest.raises(Exception, match="HTTP Error|values for"):
            serving.ServedModel(serving.HttpScorer(s.url, "m"), pause=0.001, **options).logits(rows(spark, 10)).collect()
        assert s.calls <= 8  # Spark's own attempts in tests: one


def test_readiness(spark):
    with Server(ready=3) as server:
        assert not serving.is_ready(server.url)
        serving.await_ready(server.url, "baseline", wait=5, pause=0.01)
        found = serving.health(spark.range(3), Settings(model_server=server.url)).first()
        assert (found["status"], found["model_ready"], found["detections"]) == ("ok", True, 3)
    with pytest.raises(ConnectionError, match="not ready"):
        serving.choose_model(spark, "baseline", Settings(model_server=server.url), wait=0.05)
    found = serving.health(spark.range(3), Settings(model_server=server.url)).first()
    assert (found["status"], found["model_ready"]) == ("degraded", False)
    assert serving.health(spark.range(3), Settings()).first()["model_ready"] is None
    assert serving.choose_model(spark, "baseline", Settings.load({})) is inference.BASELINE


def test_the_same_flow_on_files_by_either_model(spark, tmp_path):
    rasters.write_pixels(manifests.synthetic_raster(spark, 32, 32), str(tmp_path / "c"), edge=16, affine=(500.0, 0.0, 0.0, 0.0, -500.0, 0.0), striprows=16)
    args = {"threshold": 0.62, "min_px": 2, "eps": 1500.0}
    with Server() as server:
        model = serving.choose_model(spark, "baseline", Settings.load({"MODEL_SERVER": server.url}))
        far = pipelines.detect_in_files(spark, str(tmp_path / "c"), model, 16, 4, **args)
        near = pipelines.detect_in_files(spark, str(tmp_path / "c"), inference.BASELINE, 16, 4, **args)
        table = pipelines.scan_and_detect(manifests.synthetic_raster(spark, 32, 32).select("raster_id", "row", "col", *BANDS), inference.BASELINE, 16, 4, 32, 32, affine=(500.0, 0.0, 0.0, 0.0, -500.0, 0.0), **args)
        keys = ["component", "area_px", "xmin", "ymin"]
        assert sorted(far.select(keys).collect()) == sorted(near.select(keys).collect()) == sorted(table.select(keys).collect()) != []
    rasters.write_pixels(manifests.synthetic_raster(spark, 16, 16, raster_id=1), str(tmp_path / "c"), edge=16, mode="append")
    with pytest.raises(ValueError, match="more than one"):
        pipelines.detect_in_files(spark, str(tmp_path / "c"), inference.BASELINE, 16, 4)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.tif").write_bytes(b"?")
    with pytest.raises(ValueError, match="unreadable"):
        pipelines.detect_in_files(spark, str(tmp_path / "d"), inference.BASELINE, 16, 4)
