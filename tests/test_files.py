"""Files by planned partitions: label files, tails of logs, JSON documents by byte ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from annolake.plans import fixtures as fx
from annolake.sources import coco, files, yolo


def test_label_files_written_and_read_again(spark, sf, tmp_path):
    dets = fx.pred_boxes(spark, sf).withColumn("frame", F.concat(F.lit("f"), F.col("image_id")))
    frames = fx.images(spark, sf).select(F.concat(F.lit("f"), F.col("id")).alias("frame"))
    texts = yolo.yolo_lines(dets, "frame", 640, 480, frames=frames)
    yolo.write_yolo(texts, str(tmp_path / "labels"))
    there = {p.stem: p.read_text() for p in (tmp_path / "labels").glob("*.txt")}
    assert there == {r.frame: r.text for r in texts.collect()} and "" in there.values()
    assert (tmp_path / "labels/_SUCCESS").read_text() == str(len(there)) and not [p for p in (tmp_path / "labels").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]
    got, boxes = yolo.read_yolo(spark, str(tmp_path / "labels"), strict=True)
    assert {r.frame: r.status for r in got.collect()} == {f: "ok" if t else "empty" for f, t in there.items()}
    assert boxes.count() == sum(len(t.splitlines()) for t in there.values()) and boxes.rdd.getNumPartitions() >= 1
    yolo.write_yolo(texts.limit(2), str(tmp_path / "labels"))  # files of the run before go
    assert len(list((tmp_path / "labels").glob("*.txt"))) == 2


def test_label_files_of_one_round_stand_at_once(spark, tmp_path, monkeypatch):
    names = [f"f{k}" for k in range(90)] + ["a:b", "é"]
    rows = [(n, "" if k % 3 == 0 else f"{k} 0.1 0.2 0.3 0.4\n1 0.5 0.5 0.5 0.5") for k, n in enumerate(names)]
    texts, stood, written = spark.createDataFrame(rows, "frame string, text string"), [], yolo.write_yolo

    def write(some, path):
        written(some, path)
        stood.append(len(list(tmp_path.rglob("*.txt"))))

    monkeypatch.setattr(yolo, "write_yolo", write)
    monkeypatch.setattr(yolo, "STANDING", 20)
    got = yolo.through_files(texts, str(tmp_path / "labels"), len(rows))
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    assert sum(stood) == len(rows) and len(stood) == 5 and max(stood) < 40 and not list(tmp_path.rglob("*.txt"))
    assert yolo.through_files(texts.limit(0), str(tmp_path / "none"), 0).count() == 0


def test_label_queries_leave_no_files(spark, sf, monkeypatch):
    from annolake.plans import preparation
    from annolake.plans.queries import QUERIES

    folders, folder = [], preparation._folder
    monkeypatch.setattr(preparation, "_folder", lambda *a: folders.append(folder(*a)) or folders[-1])
    monkeypatch.setattr(yolo, "STANDING", 400)
    assert QUERIES["label_file_states"](spark, sf).count() == fx.images(spark, sf).count()
    assert QUERIES["label_file_boxes"](spark, sf).count() == fx.gt_boxes(spark, sf).count()
    assert len(folders) == 2 and not [f for x in folders for f in files.listed(x, ".txt")]


def test_label_files_pass_through_tasks(spark, tmp_path, monkeypatch):
    rows = [(f"f{k}", "" if k % 3 == 0 else f"{k} 0.1 0.2 0.3 0.4\n\n1 0.5 0.5 0.5 0.5") for k in range(90)] + [("a:b", "2 1 1 1 1"), ("é", "")]
    texts = spark.createDataFrame(rows, "frame string, text string")
    monkeypatch.setattr(yolo, "TASK_FILES", 10)
    read = yolo.by_files(texts, str(tmp_path / "labels"), len(rows))
    assert read.rdd.getNumPartitions() == 10 and sorted(map(tuple, read.collect())) == sorted(rows)
    frames, boxes = yolo.parse_lines(texts, strict=True)
    assert not [df for df in (frames, boxes) if "Exchange" in df._jdf.queryExecution().toString()]  # a file is a row all the way
    assert {r.frame for r in frames.collect() if r.status == "empty"} == {f for f, t in rows if not t}
    assert sorted((r.frame, r.line_no, r.class_id) for r in boxes.collect() if r.line_no == 2) == sorted((f, 2, 1) for f, t in rows if "\n" in t)
    stood, written = [], files.LabelWriter.commit
    monkeypatch.setattr(files.LabelWriter, "commit", lambda self, messages: written(self, messages) or stood.append(len(files.listed(self.path, ".txt"))))
    assert sorted(files.passed(iter(rows), str(tmp_path / "one"))) == sorted(rows)
    assert stood == [len(rows)] and not list(tmp_path.rglob("*.txt"))


def test_partitions_are_planned(tmp_path, monkeypatch):
    for k in range(10):
        (tmp_path / f"{k}.txt").write_text("x" * 10 * k)
    monkeypatch.setattr(files, "PART_BYTES", 100)
    parts = files.LabelReader(str(tmp_path)).partitions()
    assert len(parts) > 3 and sum(len(p.paths) for p in parts) == 10
    monkeypatch.setattr(files, "PART_FILES", 2)
    assert max(len(p.paths) for p in files.LabelReader(str(tmp_path)).partitions()) == 2


@pytest.mark.parametrize("step", [4, 1 << 16])
def test_last_lines(spark, tmp_path, step):
    texts = {"a": '{"x": 1}\n{"x": 2}\n\n', "b": '{"x": 3}', "c": "", "d": "\n\n", "e": '{"x": "' + "y" * 1000 + '"}\n'}
    for name, t in texts.items():
        (tmp_path / name).write_text(t)
    files.register(spark)
    got = {r.file: r.line for r in spark.read.format("last_lines").option("path", str(tmp_path)).option("step", step).load().collect()}
    assert got == {n: (t.split("\n")[-1] if (t := text.rstrip()) else "") for n, text in texts.items()}


def odd_document(rng, n):
    words = ['a"b', "c\\", "\\\\", '\\"', "{", "}]", "[{", ":", "é🙂", "\n", "annotations", '"annotations": [{']
    text = lambda: "".join(rng.choice(words) for _ in range(rng.randrange(6)))
    one = lambda k: {"id": k, "name": text(), "more": {"list": [{"in": text()}, []], text() or "k": None}}
    return {"info": {"annotations": [{"no": 1}]}, "images": [one(k) for k in range(n)], text() + "x": text(), "annotations": [one(-k) for k in range(n)], "empty": [], "numbers": [1, 2]}


@pytest.mark.parametrize(("seed", "size", "indent"), [(0, 137, None), (1, 264, 2), (2, 1000, None), (3, 211, None), (4, 10**7, 1)])
def test_lists_of_a_document_in_ranges(spark, tmp_path, seed, size, indent):
    rng = random.Random(seed)
    docs = {f"{k}.json": odd_document(rng, 12) for k in range(2)}
    for name, d in docs.items():
        (tmp_path / name).write_text(json.dumps(d, indent=indent, ensure_ascii=seed % 2 == 0))
    got = sorted((r.file, r.field, json.dumps(json.loads(r.record))) for r in files.json_lists(spark, str(tmp_path), ["images", "annotations", "empty"], size).coalesce(4).collect())
    assert got == sorted((n, f, json.dumps(x)) for n, d in docs.items() for f in ("images", "annotations") for x in d[f])


def test_an_outermost_list_and_one_task_a_range(spark, tmp_path):
    rows = [{"image_id": k, "category_id": 1, "bbox": [1.0, 2.0, 3.0, 4.0], "score": k / 100} for k in range(400)]
    path = tmp_path / "p.json"
    path.write_text(" \n" + json.dumps(rows))
    records = files.json_lists(spark, str(path), [""], 4096)
    assert records.rdd.getNumPartitions() >= 5 and records.select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(r.image_id for r in coco.read_predictions(spark, str(path)).collect()) == list(range(400))
    (tmp_path / "none.json").write_text("[]")
    assert coco.read_predictions(spark, str(tmp_path / "none.json")).count() == 0


def test_documents_of_a_store_that_only_spark_reads(spark):
    assert files.reachable("/tmp") and files.reachable("file:///tmp") and files.reachable("file:/tmp") and not files.reachable("viewfs://store/in")
