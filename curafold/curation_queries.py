"""Further registered queries: criteria, sampling, exports, detection, sequences and scalar columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalogue import _BOX, _U, _boxes, _r, _results, _truths, _xyxy, query
from .functions import boxes as B
from .functions import criteria as C
from .functions import scalars as X
from .functions.paths import hashed_name
from .operators import evaluate as E
from .operators import regions as G
from .operators import relational as R
from .operators import sequences as S
from .operators import vectors as V
from .plans.enrichment import Stage, enrich
from .sources.assets import coco

# ---- criteria over assets made from line items

_ASSET = """a AS (SELECT l_orderkey, l_linenumber, (300 + l_partkey % 1100)::bigint AS W, (280 + l_suppkey * 37 % 1300)::bigint AS H, l_extendedprice % 97 AS Q512, l_quantity % 9 AS A,
 l_quantity % 8 AS A_EAT, (l_partkey % 101)::int AS QF, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice % 89 END AS SPAQ, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE l_returnflag END AS CAP FROM lineitem)"""


def _rated(t):
    n = F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (300 + F.col("l_partkey") % 1100).alias("W"), (280 + F.col("l_suppkey") * 37 % 1300).alias("H"), (F.col("l_extendedprice") % 97).alias("Q512"), (F.col("l_quantity") % 9).alias("A"),
        (F.col("l_quantity") % 8).alias("A_EAT"), (F.col("l_partkey") % 101).cast("int").alias("QF"), F.when(n != 3, F.col("l_extendedprice") % 89).alias("SPAQ"), F.when(n == 2, "").when(n > 2, F.col("l_returnflag")).alias("CAP"),
    )


@query(f"""WITH {_ASSET} SELECT l_orderkey, l_linenumber, Q512 > 50 AND H * W > 802816 AND A_EAT > 5.5 AS c1, Q512 > 50 AND H * W > 802816 AND A > 2 AS c2, Q512 > 10 AND H * W > 802816 AND A > 2 AS c3,
 Q512 > 65 AND H * W >= 802816 AND A > 5.2 AS c4, Q512 > 70 AND QF > 80 AND H * W >= 802816 AND A > 5.2 AS qf, Q512 > 70 AND A_EAT > 6 AS finest, coalesce(SPAQ > 65 AND H * W >= 1048576, false) AS spaq,
 Q512 > 50 AND A_EAT > 5.5 AND H * W >= 802816 AS chosen, W * H > 147456 AND W * H < 802816 AND Q512 > 60 AS enlarge, W * H > 147456 AND Q512 > 35 AND (CAP IS NULL OR CAP = '') AS describe FROM a""")
def named_criteria(t):
    names = {"c1": "1", "c2": "2", "c3": "3", "c4": "4", "qf": "QF", "finest": "Finest", "spaq": "SPAQ", "chosen": "default"}
    flags = {n: C.criterion(c) for n, c in names.items()} | {"enlarge": C.worth_enlarging(), "describe": C.worth_describing("CAP")}
    return _rated(t).select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in flags.items()])


@query(f"""WITH {_ASSET} SELECT l_orderkey, l_linenumber, W * H AS pixels, round(W / H + 1e-9, 6) AS ratio, CASE WHEN CAP IS NULL THEN [l_orderkey, l_linenumber] END AS pair FROM a""")
def enrich_new_columns(t):
    pair = F.array(F.col("l_orderkey"), F.col("l_linenumber").cast("long"))
    stages = [Stage("size", {"pixels": C.pixels(), "ratio": F.round(F.col("W") / F.col("H") + 1e-9, 6)}), Stage("pair", {"pair": pair}, {"pixels"}, criterion=F.col("CAP").isNull())]
    return enrich(_rated(t), stages).select("l_orderkey", "l_linenumber", "pixels", "ratio", "pair")


# ---- sampling, weights, exports


@query(f"""WITH w AS (SELECT vec_id, (1 + vec_id % 5)::double AS w FROM embeddings), c AS (SELECT vec_id, sum(w) OVER (ORDER BY vec_id) - w AS low, sum(w) OVER (ORDER BY vec_id) AS high, sum(w) OVER () AS total FROM w)
 SELECT i AS draw, vec_id FROM (SELECT i, {_U.format('i')} AS u FROM range(5000) r(i)) d JOIN c ON d.u * c.total >= c.low AND d.u * c.total < c.high""")
def weighted_sample_wr(t):
    return R.weighted_sample_wr(t.embeddings.select("vec_id", (1 + F.col("vec_id") % 5).alias("w")), 5000, "vec_id", "w")


@query(f"""WITH n AS (SELECT count(*) AS n, ceil(count(*) * 2 / 3.0)::bigint AS each FROM embeddings), p AS (SELECT i, row_number() OVER (ORDER BY ('0x' || substr(md5('1:' || i), 1, 8))::bigint, i) - 1 AS p FROM n, range(each * 3) r(i)),
 k AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM embeddings) SELECT vec_id, p % 3 AS rank, p // 3 AS place FROM p, n JOIN k ON k.j = i % n.n""")
def epoch_shuffle_shard(t):
    return R.epoch_shares(t.embeddings, "vec_id", 3, epoch=1, ratio=2)


@query("""WITH c AS (SELECT i AS label, 1.0 / greatest((SELECT count(*) FROM lineitem WHERE l_partkey % 7 = i), 1) AS w FROM range(7) r(i)), s AS (SELECT label, w / sum(w) OVER () AS w FROM c)
 SELECT l_orderkey, round(sum(w), 8) AS weight FROM lineitem JOIN s ON s.label = l_partkey % 7 GROUP BY l_orderkey""")
def image_weights(t):
    rows = t.lineitem.select("l_orderkey", (F.col("l_partkey") % 7).alias("label"))
    return R.image_weights(rows, R.class_weights(rows, "label", 7), "l_orderkey", "label").select("l_orderkey", _r("weight", "weight", 8))


@query("SELECT vec_id, CASE label WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 WHEN 4 THEN 8 WHEN 5 THEN 13 WHEN 6 THEN 21 END AS code FROM embeddings")
def class_remap(t):
    return t.embeddings.select("vec_id", R.remapped(F.col("label"), {0: 1, 1: 2, 2: 3, 3: 5, 4: 8, 5: 13, 6: 21}).alias("code"))


@query("""WITH o AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages) SELECT page_id, ((row_number() OVER (ORDER BY page_id) - 1) // 50) * 50 AS start,
 md5(p) || lower(regexp_extract(regexp_extract(p, '([^/]*)$', 1), '^\\.*[^.].*(\\.[^.]*)$', 1)) AS name FROM o""")
def shard_export(t):
    named = t.pages.select("page_id", hashed_name(F.regexp_replace("url", "^[a-z]+://", "")).alias("name"))
    return R.chunked(named, "page_id", 50).select("page_id", (F.col("chunk") * 50).alias("start"), "name")


@query()
def xxhash_pair(t):
    text = F.concat(F.coalesce("url", F.lit("")), F.coalesce(F.md5("html"), F.lit("")))
    return t.pages.select("page_id", F.xxhash64(text).alias("hash"))


@query(f"WITH {_BOX} SELECT image, count(*) AS annotations, 3 * count(*) AS numbers, sum(2) AS points FROM b GROUP BY image".replace("3 * count(*)", "9 * count(*)"))
def coco_export(t):
    b = _boxes(t)
    images = t.lineitem.select(F.col("l_orderkey").alias("id")).distinct().select(F.concat(F.col("id"), F.lit(".jpg")).alias("file_name"), F.lit(100).alias("width"), F.lit(100).alias("height"), "id")
    marks = b.select(
        F.col("image").alias("image_id"), F.col("det").alias("id"), F.col("cls").alias("category_id"), F.array("x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"),
        F.array("x1", "x2", "x1").alias("xs"), F.array("y1", "y2", "y2").alias("ys"), F.array(F.lit(2), F.lit(1), F.lit(0)).alias("vs"),
    )
    entry = "struct<annotations:array<struct<num_keypoints:int,keypoints:array<double>>>>"
    parsed = coco(images, marks).select(F.col("image_id").alias("image"), F.from_json("document", entry).alias("d"))
    total = lambda c, f: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + f(x))
    return parsed.select("image", F.size("d.annotations").cast("long").alias("annotations"), total(F.col("d.annotations"), lambda x: F.size(x["keypoints"])).alias("numbers"), total(F.col("d.annotations"), lambda x: x["num_keypoints"]).alias("points"))


@query("SELECT label, len(list(vec_id)) AS n, row_number() OVER (ORDER BY count(*), label) - 1 AS place, list_sort(list(vec_id)) AS keys FROM embeddings GROUP BY label")
def group_lists(t):
    return R.group_lists(t.embeddings, "label", "vec_id")


@query("""WITH c AS (SELECT ceil(count(*) / 7.0)::bigint AS size FROM embeddings), o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings) SELECT vec_id FROM o, c WHERE i // size = 2""")
def jsonl_chunk(t):
    return R.one_chunk(t.embeddings.select("vec_id"), "vec_id", 7, 2)


@query("SELECT p_partkey FROM part QUALIFY row_number() OVER (ORDER BY p_size, p_partkey) <= round_even((SELECT count(*) FROM part) * 0.5, 0)")
def smallest_half(t):
    return R.smallest_half(t.part.select("p_partkey", "p_size"), F.col("p_size"), "p_partkey").select("p_partkey")


# ---- poses: an embedding's first 17 places are x, the next 17 are y, of a person in a box

_PERSON = """e AS (SELECT vec_id, label, embedding::double[] AS v FROM embeddings), p AS (SELECT vec_id, v, label, 0.3 + label * 0.05 AS w, 0.4 + label * 0.02 AS h FROM e),
 s AS (SELECT vec_id, sqrt(1 / (w * h)) AS r, CASE WHEN label % 3 = 0 THEN [16] WHEN label % 3 = 1 THEN [0, 16] ELSE [5, 11] END AS bad, v FROM p)"""


@query(f"""WITH {_PERSON}, c AS (SELECT *, list_transform(range(0, 17), lambda i: (v[i + 1] - 0.1) * r) AS x, list_transform(range(0, 17), lambda i: (v[i + 18] - 0.2) * r) AS y FROM s),
 m AS (SELECT *, CASE WHEN len(list_filter(bad, lambda b: b IN (0, 5, 6))) = 0 THEN (x[1] + x[6] + x[7]) / 3 WHEN len(list_filter(bad, lambda b: b IN (11, 12))) = 0 THEN (x[12] + x[13]) / 2 ELSE 0.5 END AS cx,
 CASE WHEN len(list_filter(bad, lambda b: b IN (0, 5, 6))) = 0 THEN (y[1] + y[6] + y[7]) / 3 WHEN len(list_filter(bad, lambda b: b IN (11, 12))) = 0 THEN (y[12] + y[13]) / 2 ELSE 0.5 END AS cy FROM c)
 SELECT vec_id, i AS place, round(CASE WHEN list_contains(bad, i % 17) THEN 0 WHEN i < 17 THEN x[i + 1] - cx ELSE y[i - 16] - cy END, 6) AS value FROM m, range(0, 34) t(i)""")
def body_embedding(t):
    v = V.doubles(F.col("embedding"))
    w, h = 0.3 + F.col("label") * F.lit(0.05), 0.4 + F.col("label") * F.lit(0.02)
    bad = F.when(F.col("label") % 3 == 0, F.array(F.lit(16))).when(F.col("label") % 3 == 1, F.array(F.lit(0), F.lit(16))).otherwise(F.array(F.lit(5), F.lit(11)))
    one = lambda scale: F.struct(F.array(F.lit(0.1), F.lit(0.2), 0.1 + w * scale, 0.2 + h * scale).alias("BBOX"), bad.alias("INVLD_KPTS_IDX"), F.slice(v, 1, 17).alias("KPTS_X"), F.slice(v, 18, 17).alias("KPTS_Y"))
    e = t.embeddings.select("vec_id", F.array(one(F.lit(0.5)), one(F.lit(1.0))).alias("persons"))
    return e.select("vec_id", F.posexplode(V.body_embedding(F.col("persons"))).alias("place", "x")).select("vec_id", F.col("place").cast("long").alias("place"), _r("x", "value"))


@query("""WITH p AS (SELECT vec_id, 0.1 + (vec_id % 7) * 0.05 AS x, 0.2 + (vec_id % 5) * 0.03 AS y FROM embeddings), b AS (SELECT vec_id, [x, y, x + 0.3, y + 0.4] AS a, [x + 0.2, y, x + 0.5, y + 0.3] AS c FROM p),
 u AS (SELECT *, least(a[1], c[1]) AS l, least(a[2], c[2]) AS t, sqrt(1 / ((greatest(a[3], c[3]) - least(a[1], c[1])) * (greatest(a[4], c[4]) - least(a[2], c[2])))) AS r FROM b),
 k AS (SELECT vec_id, [(a[1] - l) * r, (a[3] - l) * r, (c[1] - l) * r, (c[3] - l) * r] AS xs, [(a[2] - t) * r, (a[4] - t) * r, (c[2] - t) * r, (c[4] - t) * r] AS ys FROM u)
 SELECT vec_id, i AS place, round(CASE WHEN i < 4 THEN xs[i + 1] - list_avg(xs) WHEN i BETWEEN 10 AND 13 THEN ys[i - 9] - list_avg(ys) ELSE 0 END, 6) AS value FROM k, range(0, 20) g(i)""")
def layout_embedding(t):
    x, y = 0.1 + (F.col("vec_id") % 7) * F.lit(0.05), 0.2 + (F.col("vec_id") % 5) * F.lit(0.03)
    boxes = F.array(F.array(x + 0.2, y, x + 0.5, y + 0.3), F.array(x, y, x + 0.3, y + 0.4), F.array(x, y, x + 0.01, y + 0.01))
    return t.embeddings.select("vec_id", F.posexplode(V.layout_embedding(boxes)).alias("place", "x")).select("vec_id", F.col("place").cast("long").alias("place"), _r("x", "value"))


@query("""WITH e AS (SELECT vec_id, embedding::double[] AS v FROM embeddings), x AS (SELECT vec_id, v, list_max(v) AS m FROM e) SELECT vec_id, i AS place, round(exp((v[i + 1] - m) * 3) / list_sum(list_transform(v, lambda z: exp((z - m) * 3))), 8) AS p,
 round(1 / (1 + exp(-v[i + 1])), 8) AS s FROM x, range(0, 64) g(i)""")
def softmax_scores(t):
    v = V.doubles(F.col("embedding"))
    zipped = F.arrays_zip(V.softmax(v, 3.0).alias("p"), F.transform(v, X.sigmoid).alias("s"))
    return t.embeddings.select("vec_id", F.posexplode(zipped).alias("place", "x")).select("vec_id", F.col("place").cast("long").alias("place"), _r("x.p", "p", 8), _r("x.s", "s", 8))


# ---- detection


@query(f"WITH {_BOX}, c AS (SELECT cls AS truth, l AS pred, count(*) AS n FROM (SELECT cls, det % 3 AS l FROM b) GROUP BY 1, 2) SELECT truth, pred, n, round(1.0 * n / sum(n) OVER (PARTITION BY truth), 6) AS share FROM c")
def confusion_normalized(t):
    counts = _boxes(t).groupBy(F.col("cls").alias("truth"), (F.col("det") % 3).alias("pred")).agg(F.count("*").alias("n"))
    return E.normalised(counts).select("truth", "pred", "n", _r("share", "share"))


@query(f"WITH {_BOX} SELECT image, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM b GROUP BY image")
def union_boxes(t):
    boxes = _boxes(t).groupBy("image").agg(F.collect_list(F.array("x1", "y1", "x2", "y2")).alias("b"))
    return boxes.select("image", B.union_box(F.col("b")).alias("u")).select("image", "u.*")


@query(f"""WITH {_BOX}, n AS (SELECT *, x1 + 1 AS a1, y1 AS a2, x2 - det % 5 AS a3, y2 - det % 7 AS a4 FROM b), k AS (SELECT *, greatest(least(x2, a3) - greatest(x1, a1), 0) * greatest(least(y2, a4) - greatest(y1, a2), 0) AS bt,
 (x2 - x1) * (y2 - y1) AS sa, (a3 - a1) * (a4 - a2) AS sb FROM n) SELECT image, det, round(power(bt / (sa + sb - bt), 3), 6) AS alpha, round(bt / sb, 6) AS cover,
 (a3 - a1 > 2 AND a4 - a2 > 2 AND sb / (sa + 1e-16) > 0.1 AND greatest((a3 - a1) / (a4 - a2 + 1e-16), (a4 - a2) / (a3 - a1 + 1e-16)) < 20) AS survives FROM k""")
def box_measures(t):
    a, d = _xyxy(), F.col("det")
    b = (a[0] + 1, a[1], a[2] - d % 5, a[3] - d % 7)
    return _boxes(t).select("image", "det", _r(B.alpha_iou(a, b), "alpha"), _r(B.over_second(a, b), "cover"), B.survives(a, b).alias("survives"))


@query("""WITH s AS (SELECT p_partkey, 200 + p_size * 30 AS w, 300 + p_partkey % 700 AS h FROM part), r AS (SELECT *, least(640.0::double / h, 640.0::double / w) AS r FROM s), n AS (SELECT *, round_even(w * r, 0)::int AS nw, round_even(h * r, 0)::int AS nh FROM r)
 SELECT p_partkey, round(r, 6) AS scale, nw AS w, nh AS h, (640 - nw) % 32 / 2.0::double AS pad_x, (640 - nh) % 32 / 2.0::double AS pad_y FROM n""")
def letterbox(t):
    s = t.part.select("p_partkey", (200 + F.col("p_size") * 30).alias("w"), (300 + F.col("p_partkey") % 700).alias("h"))
    box = B.letterbox(F.col("w"), F.col("h"))
    return s.select("p_partkey", _r(box.pop("scale"), "scale"), *[c.alias(k) for k, c in box.items()])


_ANCHORS = [(10.0, 13.0), (16.0, 30.0), (33.0, 23.0), (30.0, 61.0)]


@query("""WITH b AS (SELECT 4 + l_quantity AS w, 5 + l_partkey % 60 AS h FROM lineitem), f AS (SELECT greatest("""
    + ", ".join(f"least(w / {a}, {a} / w, h / {b}, {b} / h)" for a, b in _ANCHORS)
    + """) AS best FROM b) SELECT round(avg((best > 0.25)::int), 6) AS recall, round(avg(best * (best > 0.25)::int), 6) AS fitness FROM f""")
def anchor_recall(t):
    best = B.anchor_fit(4 + F.col("l_quantity"), 5 + F.col("l_partkey") % 60, _ANCHORS)
    hit = (F.col("best") > 0.25).cast("int")
    return t.lineitem.select(best.alias("best")).agg(_r(F.avg(hit), "recall"), _r(F.avg(F.col("best") * hit), "fitness"))


@query()
def nms_plain(t):
    return E.suppress_plain(_boxes(t))


@query("""WITH b AS (SELECT l_orderkey, least(floor((l_quantity - 1) / 49.0 * 10) + 1, 10)::int AS bx, least(floor(l_discount / 0.1 * 5) + 1, 5)::int AS bz, l_linenumber FROM lineitem)
 SELECT l_orderkey, l_linenumber, round(ln(count(*) OVER (PARTITION BY bx, bz)), 6) AS density FROM b""")
def density_lookup(t):
    h = E.histogram_2d(t.lineitem, "l_quantity", "l_discount", ((1.0, 50.0), (0.0, 0.1)), (10, 5))
    keyed = t.lineitem.select("l_orderkey", "l_linenumber", E.bucket(F.col("l_quantity"), 1.0, 50.0, 10).alias("bx"), E.bucket(F.col("l_discount"), 0.0, 0.1, 5).alias("by"))
    return keyed.join(h, ["bx", "by"]).select("l_orderkey", "l_linenumber", _r(F.log("n"), "density"))


# ---- sequences


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 2 OR row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 2 AS border FROM events")
def border_flags(t):
    return S.border_flags(t.events, "user_id", ["ts", "event_id"], 2).select("event_id", "border")


@query("""SELECT event_id, [lead(event_id, 4) OVER w, lead(event_id, 2) OVER w, event_id, lag(event_id, 2) OVER w, lag(event_id, 4) OVER w] AS near FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def neighbour_frames(t):
    return S.neighbours(t.events, "user_id", ["ts", "event_id"], "event_id", 2, step=2, backwards=True).select("event_id", "near")


@query("""WITH o AS (SELECT user_id, event_id, ts, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 20 AS b FROM events)
 SELECT event_id, round(avg(value) OVER (PARTITION BY user_id, b ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS mean, b AS w FROM o""")
def running_mean(t):
    e = S.count_windows(t.events.select("user_id", "event_id", "ts", "value"), "user_id", ["ts", "event_id"], 20)
    return S.running_mean(e, "user_id", ["ts", "event_id"], "value", reset=20).select("event_id", _r("mean", "mean"), F.col("window").alias("w"))


@query("SELECT event_id, CASE WHEN event_id <= 100 THEN 0.1 WHEN event_id <= 350 THEN 0.05 WHEN event_id <= 800 THEN 0.01 END::double AS rate FROM events")
def scheduled_rate(t):
    return t.events.select("event_id", S.scheduled(F.col("event_id"), [100, 250, 450], [0.1, 0.05, 0.01]).alias("rate"))


# ---- scalar columns


@query("""SELECT p_partkey, (ceil(p_size / 8.0) * 8)::bigint AS multiple, round((1 - cos(p_size * pi() / 50)) / 2 * 0.9 + 0.1, 6) AS cycle, replace(replace(p_brand || '|x', '|', '_'), '#', '_') AS plain,
 list_concat(range(p_size % 4), list_transform(range(4 - p_size % 4), lambda i: -1::bigint)) AS padded FROM part""")
def scalar_functions(t):
    n = F.col("p_size")
    some = F.slice(F.array(*[F.lit(k).cast("long") for k in range(3)]), F.lit(1), n % 4)
    return t.part.select("p_partkey", X.next_multiple(n, 8).alias("multiple"), _r(X.one_cycle(n, 0.1, 1.0, 50), "cycle"), X.plain_name(F.concat("p_brand", F.lit("|x"))).alias("plain"), X.padded(some, F.lit(4), -1).alias("padded"))


@query("""WITH c AS (SELECT p_partkey, (p_size * 5) % 256 AS r, p_partkey * 7 % 256 AS g, p_partkey * 13 % 256 AS b FROM part), x AS (SELECT *, greatest(r, g, b) / 255.0::double AS most, least(r, g, b) / 255.0::double AS least FROM c)
 SELECT p_partkey, round((65.481 * r + 128.553 * g + 24.966 * b) / 255 + 16, 5) AS y, round(CASE WHEN most = least THEN 0 WHEN (most + least) / 2 > 0.5 THEN (most - least) / (2 - most - least) ELSE (most - least) / (most + least) END, 6) AS s,
 round(greatest(1 - power((((r / 256.0::double - 1.0 / 3 + 1) % 2.0) * 0.5 - 0.5) * 16, 2), 0), 5) AS third FROM x""")
def colours(t):
    r, g, b = F.col("p_size") * 5 % 256, F.col("p_partkey") * 7 % 256, F.col("p_partkey") * 13 % 256
    return t.part.select("p_partkey", _r(X.luma(r, g, b), "y", 5), _r(X.saturation(r, g, b), "s"), _r(X.thirds(r / 256), "third", 5))


@query("""SELECT conv_id, turn, CASE WHEN text LIKE 'a%' THEN trim(substr(text, 2)) ELSE trim(text) END AS answer FROM conversations""".replace("trim(text)", "trim(text, ' ')").replace("trim(substr(text, 2))", "trim(substr(text, 2), ' ')"))
def answers(t):
    return t.conversations.select("conv_id", "turn", X.answer(F.col("text"), "a", "\u0000").alias("answer"))


@query("SELECT doc_id AS id, text AS caption, false AS custom FROM documents UNION ALL SELECT item_id, text, true FROM benchmark")
def candidate_union(t):
    caption = lambda df, key: df.select(F.col(key).alias("id"), F.col("text").alias("caption"))
    return R.exclusive_union(caption(t.documents, "doc_id"), caption(t.benchmark, "item_id"))


# ---- regions and points


@query(f"""WITH {_BOX}, c AS (SELECT image, det, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y, (x2 - x1) * 1.2 + 3 AS w, (y2 - y1) * 1.2 + 3 AS h FROM b)
 SELECT image, det, round(least(greatest(x - w / 2, 0), 60), 6) AS x1, round(least(greatest(y - h / 2, 0), 50), 6) AS y1, round(least(greatest(x + w / 2, 0), 60), 6) AS x2, round(least(greatest(y + h / 2, 0), 50), 6) AS y2 FROM c""")
def crop_boxes(t):
    cut = G.padded_crop(_xyxy(), 60, 50)
    return _boxes(t).select("image", "det", *[_r(c, n) for c, n in zip(cut, ("x1", "y1", "x2", "y2"), strict=True)])


@query("""WITH s AS (SELECT p_partkey, (700 + p_size * 20)::int AS w, (780 + p_partkey % 300)::int AS h FROM part), l AS (SELECT *, w > 800 AND h > 800 AS large FROM s),
 k AS (SELECT *, CASE WHEN large THEN list_distinct(list_append(range(0, w - 512, 416), (w - 512)::bigint)) ELSE [0::bigint] END AS xs, CASE WHEN large THEN list_distinct(list_append(range(0, h - 512, 416), (h - 512)::bigint)) ELSE [0::bigint] END AS ys FROM l)
 SELECT p_partkey, x, y, CASE WHEN large THEN 512 ELSE w END AS pw, CASE WHEN large THEN 512 ELSE h END AS ph FROM k, LATERAL (SELECT unnest(xs) AS x) a, LATERAL (SELECT unnest(ys) AS y) b""")
def patch_grid(t):
    s = t.part.select("p_partkey", (700 + F.col("p_size") * 20).cast("int").alias("w"), (780 + F.col("p_partkey") % 300).cast("int").alias("h"))
    return G.patches(s).select("p_partkey", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "pw", "ph")


@query("""WITH s AS (SELECT p_partkey, 100 + p_size AS w, 100 + p_partkey % 50 AS h FROM part), c AS (SELECT p_partkey, w, h, k * 80 AS cw, k * 60 AS ch, k AS scale FROM s, (SELECT unnest([1.5::double, 1.0::double]) AS k) WHERE k * 80 <= w AND k * 60 <= h),
 g AS (SELECT *, greatest(1 - power(((((x + cw / 2) / w - 1.0::double / 3 + 1) % 2.0::double) * 0.5 - 0.5) * 16, 2), 0) + scale AS score FROM (SELECT *, unnest(range(0, floor(w - cw)::bigint + 1, 8)) AS x FROM (SELECT *, unnest(range(0, floor(h - ch)::bigint + 1, 8)) AS y FROM c)))
 SELECT p_partkey, scale, x, y, round(score, 6) AS score FROM g QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, scale DESC, y, x) = 1""")
def crop_candidates(t):
    s = t.part.select("p_partkey", (100 + F.col("p_size")).alias("w"), (100 + F.col("p_partkey") % 50).alias("h"))
    score = lambda x, y, cw, ch, scale: X.thirds((x + cw / 2) / F.col("w")) + scale
    return G.best_crop(s, ["p_partkey"], 80, 60, [1.5, 1.0], 8, score).select("p_partkey", "scale", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), _r("score", "score"))


@query(f"WITH {_BOX} SELECT image, list_transform(list_sort(list({{'x': (x1 + x2) / 2, 'y': (y1 + y2) / 2, 'b': [x1, y1, x2, y2]}})), lambda k: k.b) AS boxes FROM b GROUP BY image")
def person_order(t):
    return _boxes(t).groupBy("image").agg(F.collect_list(F.array("x1", "y1", "x2", "y2")).alias("b")).select("image", G.left_to_right(F.col("b")).alias("boxes"))


@query("""WITH e AS (SELECT vec_id, embedding::double[] AS v FROM embeddings), p AS (SELECT vec_id, list_position(v, list_max(v)) - 1 AS place, list_max(v) AS m, v FROM e)
 SELECT vec_id, (place % 8)::int AS x, (place // 8)::int AS y, round(m, 6) AS score, round(list_sum(list_transform(range(0, 64), lambda i: CASE WHEN (i + 1) % 8 <> 0 THEN abs(v[i + 2] - v[i + 1]) ELSE 0 END + CASE WHEN i < 56 THEN abs(v[i + 9] - v[i + 1]) ELSE 0 END)), 5) AS variation FROM p""")
def heat_peaks(t):
    v = V.doubles(F.col("embedding"))
    return t.embeddings.select("vec_id", v.alias("v")).select("vec_id", G.peak(F.col("v"), 8).alias("p"), _r(G.variation(F.col("v"), 8), "variation", 5)).select("vec_id", "p.x", "p.y", _r("p.score", "score"), "variation")


@query("SELECT event_id, floor(value / 10) AS cx FROM events QUALIFY row_number() OVER (PARTITION BY floor(value / 10), floor(user_id / 10) ORDER BY event_id) = 1")
def thinned_points(t):
    return G.thinned(t.events.select("event_id", "value", "user_id"), "value", "user_id", 10, "event_id").select("event_id", F.floor(F.col("value") / 10).cast("double").alias("cx"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, abs(l_quantity / 20 - 1.2) AS d FROM lineitem) SELECT l_orderkey, l_linenumber, round(CASE WHEN d <= 1 THEN 1.5 * d * d * d - 2.5 * d * d + 1 WHEN d <= 2 THEN -0.5 * d * d * d + 2.5 * d * d - 4 * d + 2 ELSE 0 END, 6) AS weight FROM x""")
def cubic_weights(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", _r(G.cubic(F.col("l_quantity") / 20 - 1.2), "weight"))


@query(f"""WITH {_BOX}, c AS (SELECT image, det, [[x1, y1], [x2, y1], [x2, y2], [x1, y2]] AS ps FROM b), m AS (SELECT image, det, list_transform(ps, lambda p: (0.9 * p[1] - 0.1 * p[2] + 5) / (0.001 * p[1] + 1)) AS xs,
 list_transform(ps, lambda p: (0.1 * p[1] + 0.9 * p[2]) / (0.001 * p[1] + 1)) AS ys FROM c) SELECT image, det, round(100 - list_max(xs), 6) AS x1, round(list_min(ys), 6) AS y1, round(100 - list_min(xs), 6) AS x2, round(list_max(ys), 6) AS y2 FROM m""")
def moved_boxes(t):
    box = G.flipped(G.moved(_xyxy(), [[0.9, -0.1, 5.0], [0.1, 0.9, 0.0], [0.001, 0.0, 1.0]]), 100)
    return _boxes(t).select("image", "det", *[_r(c, n) for c, n in zip(box, ("x1", "y1", "x2", "y2"), strict=True)])


@query()
def mahalanobis(t):
    return G.distances(t.embeddings, "vec_id", "embedding")


@query()
def cluster_map(t):
    return G.mapped(t.embeddings, "vec_id", "embedding")


# ---- lookups and logs


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS present FROM customer")
def file_presence(t):
    return R.present(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_custkey")


@query("SELECT c.c_custkey, n.n_name AS name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def name_lookup(t):
    names = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    return R.named(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", names).select("c_custkey", "name")


@query("SELECT vec_id, label FROM embeddings WHERE label = (vec_id % 10)")
def agreed_labels(t):
    second = t.embeddings.select("vec_id", (F.col("vec_id") % 10).cast("int").alias("label"))
    return R.agreed(t.embeddings.select("vec_id", "label"), second, "vec_id", "label")


@query("SELECT r_regionkey, r_name, i AS round FROM region, range(3) k(i)")
def repeated_rows(t):
    return R.repeated(t.region.select("r_regionkey", "r_name"), 3).withColumn("round", F.col("round").cast("long"))


@query("""WITH u AS (SELECT DISTINCT l_partkey, l_quantity FROM lineitem) SELECT l_partkey, l_quantity, row_number() OVER (ORDER BY l_quantity DESC, l_partkey) - 1 AS place FROM u""")
def unique_log(t):
    rows = t.lineitem.select("l_partkey", "l_quantity")
    return R.logged(rows.filter("l_quantity > 10"), rows, "l_quantity")


@query("""SELECT regexp_extract(line, 'step (\\d+) value ([0-9.]+)', 1)::bigint AS step, regexp_extract(line, 'step (\\d+) value ([0-9.]+)', 2)::double AS value FROM (SELECT 'step ' || event_id || ' value ' || (event_id % 7) || '.5 end' AS line FROM events)""".replace("\\\\", "\\"))
def scraped_log(t):
    lines = t.events.select(F.concat(F.lit("step "), F.col("event_id"), F.lit(" value "), F.col("event_id") % 7, F.lit(".5 end")).alias("line"))
    return R.scraped(lines, r"step (\d+) value ([0-9.]+)")
