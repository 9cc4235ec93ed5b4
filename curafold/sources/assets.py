"""Readers and writers of asset metadata: JSON tables, listings, label files, tar shards, encrypted shards."""

from __future__ import annotations

import io
import re
import tarfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import rebased

POSE = "array<struct<BBOX:array<double>,INVLD_KPTS_IDX:array<int>,KPTS_X:array<double>,KPTS_Y:array<double>>>"
ASSET = (
    "IMG string, W int, H int, Q512 double, Q1024 double, Q2048 double, SPAQ double, A double, A_EAT double, QF int, HAS_WATERMARK double, DBRU_TAG string, "
    f"CAP array<string>, HQ_CAP array<string>, TXT array<array<string>>, POSE_KPTS {POSE}, OBJS struct<CLS:map<string,string>,RESULTS:array<array<double>>>, A_CENTER array<double>"
)
#: Mean and deviation of the numeric image tags.
MEAN, DEVIATION = 3.3985, 5.6570
IMAGES = (".jpg", ".webp", ".png", ".heic")


def read_assets(spark: SparkSession, path: str) -> DataFrame:
    """The table of a JSON array; a missing file gives an empty table. Mixed arrays become structs."""
    schema = T._parse_datatype_string(ASSET)
    try:
        raw = spark.read.schema(schema).json(path, multiLine=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raw = spark.createDataFrame([], schema)
    item = lambda t: F.struct(F.from_json(t[0], "array<array<double>>").alias("quad"), t[1].alias("text"), t[2].cast("double").alias("score"))
    centre = F.when(F.col("A_CENTER").isNotNull(), F.struct(F.col("A_CENTER")[0].alias("x"), F.col("A_CENTER")[1].alias("y")))
    return raw.withColumns({"TXT": F.transform("TXT", item), "A_CENTER": centre})


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(path)


def folders(spark: SparkSession, folder: str, excluded: tuple[str, ...] = ()) -> list[str]:
    """folder and all folders under it, relative; an excluded one (exact relative path) is never entered."""
    files, root = _place(spark, folder)
    found, waiting, gone = [], [("", root)], {x.strip("/") for x in excluded}
    while waiting:
        name, path = waiting.pop()
        found.append(name)
        for status in files.listStatus(path):
            if status.isDirectory():
                own = f"{name}/{status.getPath().getName()}".lstrip("/")
                if own not in gone:
                    waiting.append((own, status.getPath()))
    return sorted(found)


def list_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = IMAGES, excluded: tuple[str, ...] = ()) -> DataFrame:
    """path relative to folder, length, modificationTime; contents aren't read, and excluded folders aren't listed."""
    _, root = _place(spark, folder)
    base = root.toString().rstrip("/")
    places = [f"{base}/{x}".rstrip("/") for x in folders(spark, folder, excluded)]
    files = spark.read.format("binaryFile").load(places).select("path", "length", "modificationTime")
    relative = files.withColumn("path", F.substring(F.col("path"), len(base) + 2, 1 << 20))
    return relative.filter(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*extensions))


def discover(spark: SparkSession, folder: str, marker: str = "ImageInfo.json") -> DataFrame:
    """path, found: folders that hold the marker (their subfolders aren't visited), and folders without one whose siblings lead to one."""
    files, root = _place(spark, folder)
    rows: list[tuple[str, bool]] = []

    def visit(name: str, path) -> bool:
        entries = list(files.listStatus(path))
        if any(e.isFile() and e.getPath().getName() == marker for e in entries):
            rows.append((name or ".", True))
            return True
        below = [(f"{name}/{e.getPath().getName()}".lstrip("/"), e.getPath()) for e in entries if e.isDirectory()]
        led = {n: visit(n, p) for n, p in sorted(below, key=lambda x: x[0])}
        if any(led.values()):
            rows.extend((n, False) for n, hit in led.items() if not hit)
        return any(led.values())

    visit("", root)
    return spark.createDataFrame(rows, "path string, found boolean")


def with_constants(df: DataFrame, path: str) -> DataFrame:
    """df with the values of a JSON object as columns; they replace columns of the same name."""
    one = df.sparkSession.read.json(path, multiLine=True).limit(1)
    return df.drop(*[c for c in df.columns if c in one.columns]).crossJoin(F.broadcast(one))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """p1, p2, sim of a JSON array of triples."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<array<string>>")).alias("r"))
    return rows.select(F.col("r")[0].alias("p1"), F.col("r")[1].alias("p2"), F.col("r")[2].cast("double").alias("sim"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """name, category of a tag table, with names as they are shown; its other columns aren't read."""
    from ..functions.paths import tag_spelling

    return spark.read.option("header", True).csv(path).select(tag_spelling(F.col("name")).alias("name"), F.col("category").cast("int").alias("category"))


def read_ratings(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A table without header, separated by spaces, whose first column is left out."""
    df = spark.read.option("sep", " ").option("inferSchema", True).csv(path)
    return df.select(*[F.col(c).alias(n) for c, n in zip(df.columns[1:], names, strict=True)])


def with_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with `p`: the columns as shares of their sum."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return df.withColumn("p", F.array(*[F.col(c) / total for c in columns]))


def read_exif(spark: SparkSession, path: str) -> DataFrame:
    """name and the eight numeric tags of a table separated by tabs, brought to the scale that models were fitted on."""
    df = spark.read.option("sep", "\t").csv(path)
    scaled = [(F.col(c).cast("double") - MEAN) / DEVIATION for c in df.columns[1:9]]
    return df.select(F.col(df.columns[0]).alias("name"), F.array(*scaled).alias("tags"))


def expanded(pattern: str) -> list[str]:
    """Names of a pattern with braces: {a,b} and {000..012}, any number of them."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    span = re.fullmatch(r"(\d+)\.\.(\d+)", found[1])
    names = [f"{k:0{len(span[1])}d}" for k in range(int(span[1]), int(span[2]) + 1)] if span else found[1].split(",")
    return [whole for n in names for whole in expanded(pattern[: found.start()] + n + pattern[found.end() :])]


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    """path, line, cls, values of label text files: five numbers or a polygon a line."""
    rows = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split(F.trim("value"), r"\n")).alias("line", "row"))
    parts = F.split(F.trim("row"), r"\s+")
    return rows.filter("row <> ''").select("path", "line", F.get(parts, F.lit(0)).try_cast("int").alias("cls"), F.transform(F.slice(parts, 2, 10_000), lambda x: x.try_cast("double")).alias("values"))


def valid_label() -> dict:
    """Rules over cls and values, each a column that is true for a valid row."""
    return {
        "columns": (F.size("values") == 4) | (F.size("values") % 2 == 0) & (F.size("values") > 4),
        "not_negative": F.forall("values", lambda x: F.coalesce(x >= 0, F.lit(False))),
        "normalised": F.forall("values", lambda x: F.coalesce(x <= 1, F.lit(False))),
    }


def read_tar_shards(spark: SparkSession, pattern: str, rank: int = 0, world: int = 1, size: int = 64 << 20) -> DataFrame:
    """shard, key, members (extension to bytes): samples of tar files, one task a shard, of the shards that fall to a reader.

    A shard is read as a stream, in batches of about `size` bytes, so its length doesn't matter. A sample is a run of members
    of one name. A damaged shard gives what precedes the damage; a missing one is an error."""
    paths = expanded(pattern)[rank::world]

    def run(batches):
        from pyarrow import fs

        kind = pa.map_(pa.string(), pa.binary())
        make = lambda shard, rows: pa.RecordBatch.from_arrays([pa.array([shard] * len(rows), pa.string()), pa.array([k for k, _ in rows], pa.string()), pa.array([m for _, m in rows], kind)], ["shard", "key", "members"])
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                files, name = fs.FileSystem.from_uri(shard) if "://" in shard else (fs.LocalFileSystem(), shard)
                rows, held = [], 0
                with files.open_input_stream(name) as stream:
                    try:
                        with tarfile.open(fileobj=stream, mode="r|") as tar:
                            for m in tar:
                                if not m.isfile():
                                    continue
                                folder, _, leaf = m.name.rpartition("/")
                                stem, _, ext = leaf.partition(".")
                                key = f"{folder}/{stem}".lstrip("/")
                                if held > size and rows[-1][0] != key:
                                    yield make(shard, rows)
                                    rows, held = [], 0
                                content = tar.extractfile(m).read()
                                held += len(content)
                                if rows and rows[-1][0] == key:
                                    rows[-1][1].append((ext, content))
                                else:
                                    rows.append((key, [(ext, content)]))
                    except tarfile.TarError:
                        pass
                if rows:
                    yield make(shard, rows)

    table = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(len(paths), 1))
    return table.mapInArrow(run, "shard string, key string, members map<string,binary>")


def write_tar(df: DataFrame, folder: str, name: str = "name", content: str = "content", index: str | None = None) -> DataFrame:
    """Writes rows as members of tar files, one a partition, and gives the files' names and numbers of members.

    A file gets its name only when it is whole, so a task that is run again leaves one. With `index` (a column of JSON texts)
    each file ends with a member ImageInfo.json, the array of these texts."""

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        files, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        files.create_dir(root)
        task = TaskContext.get()
        final = f"{root}/part-{task.partitionId():05d}.tar"
        draft, count, lines = f"{final}.{task.taskAttemptId()}", 0, []

        def put(tar, member, data):
            info = tarfile.TarInfo(member)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))

        with files.open_output_stream(draft) as stream, tarfile.open(fileobj=stream, mode="w|") as tar:
            for batch in batches:
                rows = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
                for k, (member, data) in enumerate(zip(rows[0], rows[1], strict=True)):
                    if data is not None:
                        put(tar, member, bytes(data))
                        count += 1
                    if index:
                        lines.append(rows[2][k])
            if index:
                put(tar, "ImageInfo.json", ("[" + ",".join(lines) + "]").encode())
        if count or lines:
            files.move(draft, final)
            yield pa.RecordBatch.from_arrays([pa.array([final]), pa.array([count], pa.int64())], ["file", "members"])
        else:
            files.delete_file(draft)

    columns = [F.col(name), F.col(content).cast("binary"), *([F.col(index)] if index else [])]
    return df.select(*columns).mapInArrow(run, "file string, members long")


def merged(sets: dict[str, DataFrame], field: str = "IMG") -> DataFrame:
    """One table of all sets; a set's folder stands before each path."""
    whole = [df.withColumn(field, rebased(F.lit(folder), F.col(field))) for folder, df in sets.items()]
    out = whole[0]
    for df in whole[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def write_splits(df: DataFrame, path: str, key: str, shares: dict[str, float]) -> None:
    """A folder of CSV files with headers for each split."""
    from ..operators.relational import split

    split(df, key, shares).write.partitionBy("split").option("header", True).csv(path)


def compact(x: Column) -> Column:
    """A number in at most six significant digits without zeros at its end."""
    digits = F.greatest(F.lit(0), 6 - (F.floor(F.log10(F.greatest(F.abs(x), F.lit(1e-4)))) + 1))
    power = F.pow(F.lit(10.0), digits)
    return F.regexp_replace(F.format_string("%.10f", F.round(x * power) / power), r"\.?0+$", "")


def detection_lines(df: DataFrame, confidence: bool = True) -> DataFrame:
    """image, line: a detection as class, centre, sides and confidence."""
    numbers = ["xc", "yc", "w", "h", *(["conf"] if confidence else [])]
    return df.select("image", F.concat_ws(" ", F.col("cls").cast("string"), *[compact(F.col(c)) for c in numbers]).alias("line"))


def label_paths(images: DataFrame, path: str = "path") -> DataFrame:
    """images with `label`: the path of its label file, in a folder `labels` beside the last folder `images`, with extension txt."""
    moved = F.regexp_replace(F.col(path), r"^(.*)/images/", "$1/labels/")
    return images.withColumn("label", F.regexp_replace(moved, r"\.[^./]*$", ".txt"))


def label_report(images: DataFrame, labels: DataFrame) -> DataFrame:
    """found, missing, empty, corrupt over images (label) and their label rows (path, cls, values)."""
    good = F.col("cls").isNotNull() & valid_label()["columns"] & valid_label()["not_negative"] & valid_label()["normalised"]
    files = labels.groupBy(F.col("path").alias("label")).agg(F.count("cls").alias("rows"), F.bool_and(good).alias("good"))
    state = F.when(F.col("rows").isNull(), "missing").when(F.col("rows") == 0, "empty").when(F.col("good"), "found").otherwise("corrupt")
    return images.join(files, "label", "left").select(state.alias("state")).agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("found", "missing", "empty", "corrupt")])


def rename_actions(listing: DataFrame) -> DataFrame:
    """path, action, target: files (path, content) whose extension differs from what their first bytes say."""
    from ..functions.paths import extension
    from ..functions.scalars import file_kind

    kind = file_kind(F.col("content"))
    right = F.when(kind == "jpeg", ".jpg").otherwise(F.concat(F.lit("."), kind))
    known = F.when(extension(F.col("path")) == ".jpeg", ".jpg").otherwise(extension(F.col("path")))
    target = F.concat(F.regexp_replace("path", r"\.[^./]*$", ""), right)
    return listing.select("path", F.when(kind.isNull(), "unknown").otherwise("rename").alias("action"), target.alias("target"), (known != right).alias("_d")).filter("_d OR target IS NULL").drop("_d")


def next_run(spark: SparkSession, folder: str, name: str = "run") -> str:
    """A folder name with the first number that isn't used: run, run2, run3."""
    files, root = _place(spark, folder)
    used = {e.getPath().getName() for e in files.listStatus(root)} if files.exists(root) else set()
    n = 1
    while (own := name if n == 1 else f"{name}{n}") in used:
        n += 1
    return f"{folder}/{own}"


def _with_secret(df: DataFrame, key: bytes) -> DataFrame:
    """df with the key as a column of a one-row table: plans and event logs show that column's name, never its value."""
    return df.crossJoin(F.broadcast(df.sparkSession.createDataFrame([(key,)], "_secret binary")))


def write_encrypted(df: DataFrame, path: str, key: bytes, size: int = 10_000, order: str = "name") -> None:
    """Rows as AES-GCM blobs in shards of `size`, renamed by hash, with an encrypted index."""
    from ..functions.paths import hashed_name
    from ..operators.relational import ranked, uniform

    named = ranked(df, uniform(F.col(order)), order).withColumn("chunk", F.floor(F.col("rank") / size) * size)
    sealed = lambda c: F.aes_encrypt(F.to_json(c).cast("binary"), F.col("_secret"), F.lit("GCM")).alias("blob")
    rows = _with_secret(named, key)
    rows.select("chunk", hashed_name(F.col(order)).alias("name"), sealed(F.struct(*df.columns))).write.partitionBy("chunk").parquet(f"{path}/shards")
    rows.select(sealed(F.struct(hashed_name(F.col(order)).alias("name"), F.col(order).alias("origin"), "chunk"))).write.parquet(f"{path}/index")


def read_encrypted(spark: SparkSession, path: str, key: bytes, schema: str) -> DataFrame:
    plain = F.aes_decrypt("blob", F.col("_secret"), F.lit("GCM")).cast("string")
    return _with_secret(spark.read.parquet(f"{path}/shards"), key).select(F.from_json(plain, schema).alias("r")).select("r.*")


def write_rolling(df: DataFrame, path: str, rows: int = 100_000) -> None:
    df.write.option("maxRecordsPerFile", rows).parquet(path)


def coco(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """image_id, document: each image's COCO entry with its annotations; flat keypoints x, y, v."""
    flat = F.flatten(F.transform(F.arrays_zip("xs", "ys", "vs"), lambda p: F.array(p["xs"], p["ys"], p["vs"].cast("double"))))
    entry = F.struct(F.size(F.filter("vs", lambda v: v > 0)).alias("num_keypoints"), flat.alias("keypoints"), F.col("bbox"), F.col("category_id"), F.col("id"))
    of_image = annotations.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("id", entry.alias("e")))).alias("a"))
    joined = images.join(of_image, images["id"] == of_image["image_id"], "left").select(images["*"], F.transform("a", lambda x: x["e"]).alias("annotations"))
    return joined.select(F.col("id").alias("image_id"), F.to_json(F.struct("file_name", "width", "height", "id", F.coalesce("annotations", F.array()).alias("annotations"))).alias("document"))
