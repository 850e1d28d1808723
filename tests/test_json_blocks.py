"""One JSON document read in blocks gives the rows of a whole read; a stream's
batches reach the target once."""
import json
import os
import tempfile

import pytest

from posetide.sources import annotations as AN
from posetide.sources import json_blocks as B
from posetide.streaming import sinks as W


def _document(n=60):
    nasty = ['plain', 'q"uote', 'back\\', '\\\\"[', '{"annotations": [', 'é[ü]{', '\\u0022', '"' * 5, '\\' * 9]
    images = [{"id": i, "width": 640, "height": 480, "file_name": nasty[i % len(nasty)]} for i in range(n)]
    anns = [{"id": 100 + i, "image_id": i % n, "category_id": 1, "iscrowd": int(i % 7 == 0), "bbox": [i, 2.5, 30, 40],
             "area": 9.5, "keypoints": [float(i)] * 6, "foot_kpts": [], "extra": {"deep": [[{"a": "]}"}], nasty[i % len(nasty)]]}}
            for i in range(3 * n)]
    return {"info": {"annotations": [{"id": -1}], "note": "]"}, "images": images, "licenses": [], "annotations": anns,
            "categories": [{"id": 1, "name": "person"}]}


@pytest.mark.parametrize("block,indent", [(37, None), (1000, 2), (1 << 24, None)])
def test_blocks_give_the_rows_of_a_whole_read(spark, block, indent):
    d = tempfile.mkdtemp(prefix="posetide-blocks-")
    n = 12 if block < 100 else 60
    with open(os.path.join(d, "a.json"), "w", encoding="utf-8") as fh:
        json.dump(_document(n), fh, indent=indent, ensure_ascii=False)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    want, got = AN.read_coco(spark, d), AN.read_coco_blocks(spark, d, block_bytes=block)
    for w, g in zip(want, got):
        assert g.columns == w.columns
        assert sorted(map(str, g.collect())) == sorted(map(str, w.collect()))
    if block == 1000:
        e = B.json_elements(spark, d, "annotations", block)
        from pyspark.sql import functions as F
        assert e.select(F.spark_partition_id().alias("p")).distinct().count() > 5


def test_several_files_missing_arrays_and_broken_documents(spark):
    d = tempfile.mkdtemp(prefix="posetide-blocks-")
    for i, text in enumerate(['{"images": [{"id": 7}]}', '{}', '', '{"images": []}', ' {"x": "images", "images" : [ {"id":8} , 5 ] } ']):
        with open(os.path.join(d, f"{i}.json"), "w") as fh:
            fh.write(text)
    rows = B.read_json_array(spark, d, "images", AN.IMG_STRUCT, 10)
    assert sorted(r.id for r in rows.collect()) == [7, 8]
    assert B.read_json_array(spark, d, "nothing", AN.IMG_STRUCT, 10).count() == 0
    with open(os.path.join(d, "z.json"), "w") as fh:
        fh.write('{"images": [{"id": 7}')
    with pytest.raises(ValueError):
        B.json_elements(spark, d, "images", 10)


def test_a_batch_run_twice_leaves_one_copy(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="posetide-once-"), "t")
    df = spark.range(10)
    assert W.read_written(spark, path, "id long").count() == 0
    assert W.write_batch_once(df, path, 0) and not W.write_batch_once(df, path, 0)
    # an attempt that was cut off: files, but no commit
    df.write.parquet(W.batch_path(path, 1))
    os.remove(os.path.join(W.batch_path(path, 1), "_SUCCESS"))
    assert W.read_written(spark, path, "id long").count() == 10
    assert W.write_batch_once(spark.range(10, 15), path, 1)
    assert sorted(r.id for r in W.read_written(spark, path, "id long").collect()) == list(range(15))
    assert W.written_batches(spark, path) == [0, 1]


def test_a_stream_that_lost_its_commit_log_entry_writes_nothing_twice(spark):
    base = tempfile.mkdtemp(prefix="posetide-once-")
    src, out, ckpt = (os.path.join(base, n) for n in ("src", "out", "ckpt"))
    spark.range(5).coalesce(1).write.parquet(src)

    def run():
        s = spark.readStream.schema("id long").parquet(src)
        W.write_once(s, out, ckpt, shape=lambda df: df.selectExpr("id * 2 as id")).trigger(availableNow=True).start().awaitTermination(120)
    run()
    spark.range(5, 8).coalesce(1).write.mode("append").parquet(src)
    run()
    last = W.written_batches(spark, out)[-1]
    for name in (str(last), f".{last}.crc"):  # as after a crash between the write and the log
        os.remove(os.path.join(ckpt, "commits", name))
    run()
    assert sorted(r.id for r in W.read_written(spark, out, "id long").collect()) == [2 * i for i in range(8)]
