import gzip
import json
import os

from clickweave.streaming import normalise_stream, start_normalise_stream


def _drop(base, name, recs):
    os.makedirs(base, exist_ok=True)
    with gzip.open(os.path.join(base, name), "wt") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in recs) + "\n")


def test_stream_normalise_available_now(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in", "2024-01-01", "00")
    _drop(src, "a.gz", [{"userid": "u", "appid": "oppo", "views": [{"docid": "d1", "date": "t1"}]},
                        {"userid": "u", "appid": "oppo", "click": {"event": "like", "docid": "d2", "date": "t2"}},
                        "{bad"])
    out = os.path.join(tmp_dir, "out")
    q = start_normalise_stream(spark, os.path.join(tmp_dir, "in"), out, checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    ev = sorted((r.docid, r.event) for r in spark.read.parquet(f"{out}/events").collect())
    assert ev == [("d1", "vw"), ("d2", "lk")]
    assert [r.reason for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["bad_json"]
    assert normalise_stream(spark, os.path.join(tmp_dir, "in")).isStreaming
