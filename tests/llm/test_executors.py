"""Workers that cannot import this package, and state that does not outlive its stage."""

import os
import subprocess
import sys

from tidemark.llm import common, warc
from tidemark.llm.queries import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN = """
import sys
sys.path.insert(0, {repo!r})  # the driver alone: workers start in another folder and inherit no path
from tidemark.session import local_session
spark = local_session("4", "6g")
spark.sparkContext.setLogLevel("OFF")
def absent(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("tidemark") is not None]}})
assert not any(r["found"] for r in spark.range(4).mapInArrow(absent, "found boolean").collect())
from tidemark.llm.queries import QUERIES
for name, query in QUERIES.items():
    print("ROWS", name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_all_operators_run_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    tokenizers = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != REPO]
    if tokenizers:
        env["PYTHONPATH"] = os.pathsep.join(tokenizers)
    done = subprocess.run([sys.executable, "-c", RUN.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-3000:]
    assert {line.split()[1] for line in done.stdout.splitlines() if line.startswith("ROWS")} == set(QUERIES)


def test_worker_state_goes_with_the_next_stage(spark):
    def hold(batches):
        common.worker_state("a", 1, lambda: "something large")
        yield from batches

    def see(batches):
        import sys

        import pyarrow as pa

        for _ in batches:
            held = getattr(sys.modules.get("tidemark_worker_state"), "held", None)
            yield pa.RecordBatch.from_pydict({"held": [held is not None]})

    rows = spark.range(64, numPartitions=8)
    common.batch_map(rows, hold, "id long", state="a").collect()
    assert any(r["held"] for r in common.batch_map(rows, see, "held boolean", state="a").collect())
    assert not any(r["held"] for r in common.batch_map(rows, see, "held boolean").collect())


def test_an_archive_is_read_back_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK", 1 << 20)
    monkeypatch.setattr(warc, "WINDOW", 1 << 18)
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://a.com/', id) as url", "repeat(concat('text ', id), 3000) as html")
    scratch = common.Scratch(spark, "test")
    folder = scratch.folder()
    warc.write_archive(pages, folder, scratch)
    index = scratch.keep(warc.index_archive(spark, folder))
    assert index.agg({"length": "sum"}).first()[0] > 8 << 20
    stored = warc.read_payloads(index.where("type = 'response'"), window=1 << 18)
    by_task = stored.selectExpr("spark_partition_id() as t", "id").groupBy("t").count().collect()
    assert len(by_task) >= 6 and sum(r["count"] for r in by_task) == 400
