import json
import os
import tempfile

from tidemark.sources.raw import read_raw
from tidemark.streaming.landing_stream import land_stream, rejects_path


def write_records(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def test_land_stream_batches_and_replay(spark):
    base = tempfile.mkdtemp(prefix="tm-stream-")
    inp = f"{base}/in"
    write_records(inp, "a.json", [{"metric": "m", "economy": "A", "time": "YR2001", "value": 1.0},
                                  {"metric": "m", "economy": "B", "time": "bad", "value": 2.0}])
    land_stream(spark, inp, f"{base}/raw", f"{base}/ckpt", max_files_per_trigger=1)
    with open(f"{inp}/a2.json", "w") as f:
        f.write('{"metric": "m", broken\n{"metric": "m", "time": "2001", "value": 1}\n')
    land_stream(spark, inp, f"{base}/raw", f"{base}/ckpt", max_files_per_trigger=1)
    write_records(inp, "b.json", [{"metric": "m", "economy": "A", "time": "2002",
                                   "value": float("nan")}])
    land_stream(spark, inp, f"{base}/raw", f"{base}/ckpt", max_files_per_trigger=1)
    raw = read_raw(spark, f"{base}/raw")
    rows = sorted((r["batch_id"], r["period"], r["value"]) for r in raw.collect())
    assert rows == [("stream_000000000000", 2001, 1.0), ("stream_000000000002", 2002, None)]
    bad = sorted((r["batch_id"], r["reject_reason"]) for r in spark.read.parquet(rejects_path(f"{base}/raw")).collect())
    assert bad == [("stream_000000000000", "unreadable period"), ("stream_000000000001", "no entity"),
                   ("stream_000000000001", "unreadable line")]
    # running again with the same checkpoint lands nothing new
    land_stream(spark, inp, f"{base}/raw", f"{base}/ckpt")
    assert read_raw(spark, f"{base}/raw").count() == 2
