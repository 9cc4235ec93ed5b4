"""Readers and writers: round trips in a temporary folder."""

import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from curafold.sources import assets as A


@pytest.fixture
def tree(tmp_path):
    for name in ("a/001.JPG", "a/002.png", "a/raw_before_sr/001.jpg", "b/c/003.webp", "b/c/note.txt", "d/004.gif"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    (tmp_path / "a/ImageInfo.json").write_text('[{"IMG":"001.JPG","W":10,"H":20},{"IMG":"002.png","TXT":[["[[0,0],[1,1]]","hi","0.5"]],"A_CENTER":[0.1,0.2]}]')
    (tmp_path / "b/c/ImageInfo.json").write_text('[{"IMG":"003.webp","Q512":1.5}]')
    return tmp_path


def test_listing_and_discovery(spark, tree):
    rows = {r.path: r.length for r in A.list_files(spark, str(tree), excluded=("a/raw_before_sr",)).collect()}
    assert rows == {"a/001.JPG": 9, "a/002.png": 9, "b/c/003.webp": 12}
    assert "a/raw_before_sr" not in A.folders(spark, str(tree), ("a/raw_before_sr",)) and "b/c" in A.folders(spark, str(tree))
    assert {(r.path, r.found) for r in A.discover(spark, str(tree)).collect()} == {("a", True), ("b/c", True), ("d", False)}
    assert A.discover(spark, str(tree / "d")).count() == 0


def test_metadata(spark, tree):
    sets = {x: A.read_assets(spark, f"{tree}/{x}/ImageInfo.json") for x in ("a", "b/c")}
    assert A.read_assets(spark, f"{tree}/absent.json").count() == 0
    assert sets["a"].filter("IMG = '002.png'").first().TXT[0].quad == [[0.0, 0.0], [1.0, 1.0]]
    both = A.merged(sets)
    assert {r.IMG for r in both.collect()} == {"a/001.JPG", "a/002.png", "b/c/003.webp"}
    both.write.json(f"{tree}/out")  # one row a line
    assert spark.read.json(f"{tree}/out").count() == 3
    (tree / "MetaInfo.json").write_text('{"owner": "x", "W": 7}')
    assert {(r.owner, r.W) for r in A.with_constants(sets["a"], f"{tree}/MetaInfo.json").collect()} == {("x", 7)}


def test_small_tables(spark, tmp_path):
    files = {"pairs.json": '[["a","b","0.9"],["b","c",0.8]]', "tags.csv": "tag_id,name,category,count\n1,long_hair,0,5\n2,^_^,4,2\n", "ava.txt": "0 11 1 2 7\n1 12 3 4 8\n", "exif.tsv": "p\t" + "\t".join(["3.3985"] * 8) + "\tr\n", "pool.txt": "  a cat \n\n a dog\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    at = lambda name: f"{tmp_path}/{name}"
    assert [tuple(r) for r in A.read_pairs(spark, at("pairs.json")).collect()] == [("a", "b", 0.9), ("b", "c", 0.8)]
    assert {tuple(r) for r in A.read_vocabulary(spark, at("tags.csv")).collect()} == {("long hair", 0), ("^_^", 4)}
    rated = A.read_ratings(spark, at("ava.txt"), ["image_id", "s1", "s2", "tag"])
    assert [tuple(r) for r in A.with_distribution(rated, ["s1", "s2"]).select("image_id", "p").orderBy("image_id").collect()] == [(11, [1 / 3, 2 / 3]), (12, [3 / 7, 4 / 7])]
    assert A.read_exif(spark, at("exif.tsv")).first().tags == [0.0] * 8
    assert [r.line for r in A.read_lines(spark, at("pool.txt")).collect()] == ["a cat", "a dog"]


def test_tar_shards(spark, tmp_path):
    rows = [(f"k{i:02d}.jpg", bytes([i]) * 50, json.dumps({"i": i})) for i in range(20)]
    df = spark.createDataFrame(rows, "name string, content binary, info string").repartition(3)
    manifest = A.write_tar(df, f"{tmp_path}/tars", index="info").collect()
    assert sum(r.members for r in manifest) == 20 and len(list((tmp_path / "tars").iterdir())) == len(manifest)
    back = A.read_tar_shards(spark, f"{tmp_path}/tars/part-{{00000..0000{len(manifest) - 1}}}.tar", size=100)
    found = {r.key: dict(r.members) for r in back.collect() if r.key != "ImageInfo"}
    assert found == {n[:3]: {"jpg": c} for n, c, _ in rows}
    assert A.expanded("{a,b}-{08..10}") == ["a-08", "a-09", "a-10", "b-08", "b-09", "b-10"]
    whole = io.BytesIO()
    with tarfile.open(fileobj=whole, mode="w") as tar:
        for name in ("x/1.jpg", "x/1.txt", "y/1.jpg"):
            info = tarfile.TarInfo(name)
            info.size = 600
            tar.addfile(info, io.BytesIO(b"z" * 600))
    (tmp_path / "cut-0.tar").write_bytes(whole.getvalue()[:2300])  # damaged in its second member
    (tmp_path / "cut-1.tar").write_bytes(whole.getvalue())
    got = A.read_tar_shards(spark, f"{tmp_path}/cut-{{0,1}}.tar").collect()
    assert sorted((r.shard[-5], r.key, sorted(r.members)) for r in got if r.shard.endswith("1.tar")) == [("1", "x/1", ["jpg", "txt"]), ("1", "y/1", ["jpg"])]
    assert [r.key for r in got if r.shard.endswith("0.tar")] == ["x/1"]
    assert {r.shard[-5] for r in A.read_tar_shards(spark, f"{tmp_path}/cut-{{0,1}}.tar", rank=1, world=2).collect()} == {"1"}


def test_encrypted_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(f"a/{i}.jpg", i) for i in range(25)], "name string, n int")
    key = b"0123456789abcdef"
    A.write_encrypted(df, f"{tmp_path}/e", key, size=10)
    back = A.read_encrypted(spark, f"{tmp_path}/e", key, "name string, n int")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert {r.chunk: r["count"] for r in spark.read.parquet(f"{tmp_path}/e/shards").groupBy("chunk").count().collect()} == {0: 10, 10: 10, 20: 5}
    plan = back._jdf.queryExecution().toString()
    assert key.decode() not in plan and key.hex() not in plan.lower()


def test_labels(spark, tmp_path):
    for name, text in {"images/x/labels": None, "labels/1.txt": "0 0.5 0.5 0.1 0.1\n", "labels/2.txt": "", "labels/3.txt": "0 0.5 1.5 0.1 0.1\n"}.items():
        if text is not None:
            (tmp_path / name).parent.mkdir(exist_ok=True)
            (tmp_path / name).write_text(text)
    root = f"file:{tmp_path}"
    images = A.label_paths(spark.createDataFrame([(f"{root}/images/{i}.jpg",) for i in range(1, 5)], "path string"))
    labels = A.read_labels(spark, f"{tmp_path}/labels").withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    listed = spark.createDataFrame([(f"{root}/labels/{i}.txt",) for i in (1, 2, 3)], "path string").join(labels, "path", "left")
    assert A.label_report(images, listed).first().asDict() == {"found": 1, "missing": 1, "empty": 1, "corrupt": 1}


def test_lines_splits_runs(spark, tmp_path):
    df = spark.createDataFrame([("i", 3, 0.5, 0.123456789, 0.25, 1.0, 0.9)], "image string, cls int, xc double, yc double, w double, h double, conf double")
    assert A.detection_lines(df).first().line == "3 0.5 0.123457 0.25 1 0.9"
    A.write_splits(spark.range(200), f"{tmp_path}/s", "id", {"train": 0.9, "val": 0.05, "test": 0.05})
    back = spark.read.option("header", True).csv(f"{tmp_path}/s")
    assert back.count() == 200 and {r.split for r in back.select("split").distinct().collect()} <= {"train", "val", "test"}
    assert A.next_run(spark, str(tmp_path)).endswith("/run")
    (tmp_path / "run").mkdir()
    assert A.next_run(spark, str(tmp_path)).endswith("/run2")


def test_signatures(spark):
    png, jpg, gif = bytes.fromhex("89504E470D0A1A0A") + b"..", b"\xff\xd8\xff\xe0\x00\x10JFIF\x00", b"GIF89a.."
    rows = [("a.jpg", png), ("b.jpeg", jpg), ("c.PNG", png), ("d.png", gif), ("e.jpg", b"nothing")]
    got = {tuple(r) for r in A.rename_actions(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got == {("a.jpg", "rename", "a.png"), ("d.png", "rename", "d.gif"), ("e.jpg", "unknown", None)}


def test_coco(spark):
    images = spark.createDataFrame([("a.jpg", 4, 5, 1), ("b.jpg", 4, 5, 2)], "file_name string, width int, height int, id int")
    marks = spark.createDataFrame([(1, 7, 0, [0.0, 0.0, 1.0, 1.0], [1.0, 2.0], [3.0, 4.0], [2, 0])], "image_id int, id int, category_id int, bbox array<double>, xs array<double>, ys array<double>, vs array<int>")
    docs = {r.image_id: json.loads(r.document) for r in A.coco(images, marks).collect()}
    assert docs[1]["annotations"][0]["keypoints"] == [1.0, 3.0, 2.0, 2.0, 4.0, 0.0] and docs[1]["annotations"][0]["num_keypoints"] == 1
    assert docs[2]["annotations"] == []
