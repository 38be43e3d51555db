"""Incremental ingest equals a batch run over all files."""

import json

from threadloom.operators import corpus
from threadloom.sources import records
from threadloom.streaming import incremental


def test_incremental_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    batches = [
        [{"id": "a", "link_id": "t3_p", "body": "short"}, {"id": "b", "link_id": "t3_q", "body": "x", "score": 1}],
        [{"id": "a", "link_id": "t3_p", "body": "longer text"}, {"id": "c", "link_id": "t3_r"}, {"no": "id"}],
        [{"id": "b", "link_id": "t3_q", "body": "x"}],
    ]
    for n, rows in enumerate(batches):
        (source / f"{n}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
        incremental.ingest(spark, str(source), str(tmp_path / "out"), str(tmp_path / "check"), buckets=4).awaitTermination()
    got = {(r.id, r.body, r.score) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    whole = corpus.dedupe_comments(corpus.comments_from_raw(records.json_records(spark, str(source))))
    assert got == {(r.id, r.body, r.score) for r in whole.collect()} == {("a", "longer text", None), ("b", "x", 1), ("c", "", None)}


def test_buckets_double_and_ids_stay_single(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n, rows in enumerate([[{"id": f"i{k}", "link_id": "p", "body": "x"} for k in range(40)], [{"id": "i3", "link_id": "q", "body": "much longer"}]]):
        (source / f"{n}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
        incremental.ingest(spark, str(source), str(tmp_path / "out"), str(tmp_path / "check"), buckets=4, bucket_rows=5).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 40 and {r.buckets for r in got} == {8} and [r.link_id for r in got if r.id == "i3"] == ["q"]
