"""Registered queries of the operators, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import boxes as B
from .functions import paths as P
from .operators import evaluate as E
from .operators import relational as R
from .operators import sequences as S
from .operators import vectors as V

QUERIES: dict = {}
SQL: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None):
    def keep(make):
        QUERIES[make.__name__] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql:
            SQL[make.__name__] = sql
        return make

    return keep


def _r(c, name: str, digits: int = 6):
    return F.round(c, digits).alias(name)


# ---- assets: documents with their labels; a document's language is its cluster, -1 if it has no label

_ASSETS = """assets AS (SELECT d.doc_id, d.source, d.n_chars, CASE WHEN l.doc_id IS NULL THEN -1 WHEN d.lang = 'en' THEN 0 WHEN d.lang = 'de' THEN 1
  WHEN d.lang = 'es' THEN 2 WHEN d.lang = 'fr' THEN 3 ELSE -1 END AS lbl FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_WEIGHTS = f"""{_ASSETS}, f AS (SELECT lbl, count(*) AS freq FROM assets GROUP BY lbl),
 m AS (SELECT *, lbl <> -1 AND freq >= (SELECT max(freq) FROM f WHERE lbl <> -1) / 10.0 AS ok FROM f),
 s AS (SELECT min(freq) FILTER (ok) AS least, coalesce(sum(freq) FILTER (ok), 0) AS good, coalesce(sum(freq) FILTER (NOT ok), 0) AS rest, sum(freq) AS n FROM m),
 w AS (SELECT lbl, freq, CASE WHEN ok THEN 1.0 * least / freq * good / n ELSE 1.0 * rest / n END AS weight, CASE WHEN ok THEN lbl ELSE -1 END AS lbl_new FROM m, s)"""


def _assets(t: Tables) -> DataFrame:
    code = F.when(F.col("_l").isNull(), -1).when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).when(F.col("lang") == "es", 2).when(F.col("lang") == "fr", 3).otherwise(-1)
    labels = t.labels.select(F.col("doc_id").alias("_l"))
    return t.documents.select("doc_id", "source", "n_chars", "lang").join(labels, F.col("doc_id") == F.col("_l"), "left").select("doc_id", "source", "n_chars", code.alias("lbl"))


@query(f"WITH {_WEIGHTS} SELECT lbl, freq, round(weight, 6) AS weight, lbl_new FROM w")
def balance_weights(t):
    return R.balance_weights(_assets(t)).select("lbl", "freq", _r("weight", "weight"), "lbl_new")


@query(f"WITH {_WEIGHTS} SELECT doc_id, a.lbl, round(weight, 6) AS weight, lbl_new FROM assets a LEFT JOIN w ON a.lbl = w.lbl")
def balanced_table(t):
    return R.balanced(_assets(t)).select("doc_id", "lbl", _r("weight", "weight"), "lbl_new")


@query(f"WITH {_WEIGHTS} SELECT doc_id, round(weight / sum(weight) OVER (), 9) AS weight FROM assets a JOIN w ON a.lbl = w.lbl")
def normalize_weights(t):
    return R.normalized_weights(R.balanced(_assets(t))).select("doc_id", _r("weight", "weight", 9))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    chosen = R.sample_exact(_assets(Tables(spark, folder)).filter(F.col("n_chars") > 100), 40, "doc_id", by="source")
    return R.balanced(chosen).select("doc_id", "source", "lbl", _r("weight", "weight"), "lbl_new")


@query("""WITH """ + _ASSETS.replace("assets AS (", "every AS (") + """, assets AS (SELECT doc_id, source, n_chars, lbl FROM every WHERE n_chars > 100
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::varchar), doc_id) <= 40)""" + _WEIGHTS[len(_ASSETS):] + """
 SELECT doc_id, source, a.lbl, round(weight, 6) AS weight, lbl_new FROM assets a LEFT JOIN w ON a.lbl = w.lbl""")
def select_balance(t):
    return flagship(t._spark, t._folder)


@query("SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars > 200 AND l.quality >= 1 AND l.toxic = 0")
def select_criteria(t):
    return t.documents.select("doc_id", "n_chars").filter("n_chars > 200").join(t.labels.filter("quality >= 1 AND toxic = 0"), "doc_id").select("doc_id", "n_chars", "quality", "toxic")


@query("""SELECT d.source, count(*) AS total, count(*) FILTER (l.quality >= 1 AND l.toxic = 0) AS chosen,
 round(1.0 * count(*) FILTER (l.quality >= 1 AND l.toxic = 0) / count(*), 6) AS proportion FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source""")
def select_rate(t):
    chosen = F.count_if((F.col("quality") >= 1) & (F.col("toxic") == 0))
    return t.documents.select("doc_id", "source").join(t.labels, "doc_id").groupBy("source").agg(F.count("*").alias("total"), chosen.alias("chosen"), _r(chosen / F.count("*"), "proportion"))


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::varchar), doc_id) <= 30")
def sample_exact_n(t):
    return R.sample_exact(t.documents.select("doc_id", "source"), 30, "doc_id", by="source")


_U = "('0x' || substr(md5({}::varchar), 1, 8))::bigint / 4294967296.0"


@query(f"SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, -ln({_U.format('doc_id')} + power(2.0, -33)) / n_chars AS k FROM documents WHERE n_chars > 0) ORDER BY k, doc_id LIMIT 100")
def weighted_sample_wor(t):
    return R.sample_weighted(t.documents.select("doc_id", "n_chars").filter("n_chars > 0"), 100, "doc_id", "n_chars")


@query(f"SELECT doc_id, CASE WHEN {_U.format('doc_id')} < 0.9 THEN 'train' WHEN {_U.format('doc_id')} < 0.95 THEN 'val' ELSE 'test' END AS split FROM documents")
def split_90_5_5(t):
    return R.split(t.documents.select("doc_id"), "doc_id", {"train": 0.9, "val": 0.05, "test": 0.05}).select("doc_id", "split")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS chunk FROM documents")
def chunk_ids(t):
    return R.chunked(t.documents.select("doc_id"), "doc_id", 100).select("doc_id", F.col("chunk").cast("long"))


@query("""WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey + 20 AS k FROM orders)
 SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'NEW' WHEN b.k IS NULL THEN 'DELETED' ELSE 'KEPT' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def reconcile_diff(t):
    return R.reconcile(t.customer.select(F.col("c_custkey").alias("k")), t.orders.select((F.col("o_custkey") + 20).alias("k")), "k")


@query("""SELECT d.doc_id, 'no label' AS missing FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id
 UNION ALL SELECT l.doc_id, 'no document' FROM labels l ANTI JOIN documents d ON d.doc_id = l.doc_id""")
def missing_pairs(t):
    one = t.documents.select("doc_id").join(t.labels, "doc_id", "left_anti").select("doc_id", F.lit("no label").alias("missing"))
    return one.union(t.labels.join(t.documents.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit("no document")))


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.toxic IS NULL OR d.source IS NULL OR length(d.source) = 0")
def incremental_predicate(t):
    rows = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")
    return rows.filter(R.needs_update(["quality", "toxic"]) | R.missing_or_empty(F.col("source"))).select("doc_id")


@query("""SELECT d.doc_id, coalesce(l.quality, -1)::bigint AS n_chars_new, coalesce(l.toxic::bigint * 7, d.n_chars) AS n_chars,
 (l.doc_id IS NOT NULL AND l.toxic IS NOT NULL AND l.toxic::bigint * 7 <> d.n_chars) AS changed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def enrich_update(t):
    new = t.labels.select("doc_id", (F.col("toxic").cast("long") * 7).alias("n_chars"))
    quality = t.labels.select("doc_id", "quality")
    return R.enriched(t.documents.select("doc_id", "n_chars"), new, "doc_id", ["n_chars"]).join(quality, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).cast("long").alias("n_chars_new"), "n_chars", "changed")


# ---- paths

_PATH = "regexp_replace(url, '^[a-z]+://', '')"


def _path():
    return F.regexp_replace("url", "^[a-z]+://", "")


@query(rf"""SELECT page_id, regexp_extract({_PATH}, '([^/]*)$', 1) AS base, regexp_replace({_PATH}, '/?[^/]*$', '') AS dir,
 lower(regexp_extract(regexp_extract({_PATH}, '([^/]*)$', 1), '^\.*[^.].*(\.[^.]*)$', 1)) AS ext, replace(replace({_PATH}, '/', '_'), '\', '_') AS flat FROM pages""")
def path_funcs(t):
    p = _path()
    return t.pages.select("page_id", P.basename(p).alias("base"), P.dirname(p).alias("dir"), P.extension(p).alias("ext"), P.flattened(p).alias("flat"))


@query(f"""SELECT page_id, starts_with({_PATH}, split_part({_PATH}, '/', 1) || '/') AS strict,
 regexp_replace({_PATH}, '/?[^/]*$', '') = 'example.com' OR starts_with(regexp_replace({_PATH}, '/?[^/]*$', ''), 'example.com/') AS inclusive FROM pages""")
def dir_include_exclude(t):
    p = _path()
    return t.pages.select("page_id", P.inside(p, F.split_part(p, F.lit("/"), F.lit(1))).alias("strict"), P.inside_or_equal(P.dirname(p), "example.com").alias("inclusive"))


@query(rf"""SELECT page_id, md5({_PATH}) || lower(regexp_extract(regexp_extract({_PATH}, '([^/]*)$', 1), '^\.*[^.].*(\.[^.]*)$', 1)) AS name FROM pages""")
def md5_rename(t):
    return t.pages.select("page_id", P.hashed_name(_path()).alias("name"))


@query("SELECT p_partkey, replace(p_type, '_', ' ') AS tag, replace(replace(concat_ws(',', p_type, p_brand || '(' || p_size || ')'), '(', '\\('), ')', '\\)') AS joined FROM part")
def tag_normalize(t):
    joined = P.escaped_tags(F.array("p_type", F.concat("p_brand", F.lit("("), F.col("p_size").cast("string"), F.lit(")"))))
    return t.part.select("p_partkey", P.tag_spelling(F.col("p_type")).alias("tag"), joined.alias("joined"))


@query("""WITH s AS (SELECT p_partkey, p_size * 40 AS w, 300 + p_partkey % 1700 AS h FROM part), n AS (SELECT *, floor(sqrt(1638400.0 / (1.0 * w / h))) AS nh FROM s)
 SELECT p_partkey, CASE WHEN w * h <= 1638400 THEN w ELSE floor(nh * (1.0 * w / h)) END::bigint AS w, CASE WHEN w * h <= 1638400 THEN h ELSE nh END::bigint AS h FROM n""")
def export_resize(t):
    s = t.part.select("p_partkey", (F.col("p_size") * 40).alias("w"), (300 + F.col("p_partkey") % 1700).alias("h"))
    w, h = P.export_size(F.col("w"), F.col("h"), 1280 * 1280)
    return s.select("p_partkey", w.alias("w"), h.alias("h"))


@query("SELECT l_orderkey, l_linenumber, least(floor(32 * (least(greatest(l_extendedprice, 0.0), 100000.0)) / 100000.0), 31)::bigint AS q FROM lineitem")
def quantize(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", P.quantized(F.col("l_extendedprice"), 0.0, 100000.0, 32).alias("q"))


# ---- histograms and statistics

@query("""WITH h AS (SELECT CASE WHEN l_quantity BETWEEN 1 AND 50 THEN least(floor((l_quantity - 1) / 49.0 * 20) + 1, 20)::int END AS bin FROM lineitem)
 SELECT bin, count(*) AS n FROM h WHERE bin IS NOT NULL GROUP BY bin""")
def hist_1d(t):
    return E.histogram(t.lineitem, "l_quantity", 1.0, 50.0, 20)


@query("""WITH h AS (SELECT CASE WHEN l_quantity BETWEEN 1 AND 50 THEN least(floor((l_quantity - 1) / 49.0 * 20) + 1, 20)::int END AS bin FROM lineitem),
 c AS (SELECT bin, count(*) AS n FROM h WHERE bin IS NOT NULL GROUP BY bin) SELECT bin, n, round(1.0 * sum(n) OVER (ORDER BY bin) / sum(n) OVER (), 6) AS share FROM c""")
def hist_cdf(t):
    return E.cumulative(E.histogram(t.lineitem, "l_quantity", 1.0, 50.0, 20)).select("bin", "n", _r("share", "share"))


@query("""SELECT least(floor((l_quantity - 1) / 49.0 * 10) + 1, 10)::int AS bx, least(floor(l_discount / 0.1 * 5) + 1, 5)::int AS by, count(*) AS n
 FROM lineitem WHERE l_quantity BETWEEN 1 AND 50 AND l_discount BETWEEN 0 AND 0.1 GROUP BY 1, 2""")
def hist_2d(t):
    return E.histogram_2d(t.lineitem, "l_quantity", "l_discount", ((1.0, 50.0), (0.0, 0.1)), (10, 5))


@query("SELECT label, count(*) AS n, list_sort(list(vec_id))[1] AS first_id FROM embeddings GROUP BY label")
def group_to_list_sizes(t):
    return t.embeddings.groupBy("label").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))


@query("""WITH w AS (SELECT i AS label, 1.0 / greatest(coalesce((SELECT count(*) FROM embeddings WHERE label = i), 0), 1) AS w FROM range(12) r(i))
 SELECT label::int AS label, round(w / sum(w) OVER (), 6) AS weight FROM w""")
def class_weights(t):
    return R.class_weights(t.embeddings, "label", 12).select("label", _r("weight", "weight"))


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS pearson, round(avg(((l_quantity > 25) = (l_extendedprice > 30000))::int), 6) AS accuracy FROM lineitem")
def corr_accuracy(t):
    same = ((F.col("l_quantity") > 25) == (F.col("l_extendedprice") > 30000)).cast("int")
    return t.lineitem.agg(_r(F.corr("l_quantity", "l_extendedprice"), "pearson"), _r(F.avg(same), "accuracy"))


@query("""WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
 rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem) SELECT round(corr(a, b), 6) AS spearman FROM r""")
def corr_spearman(t):
    return E.spearman(t.lineitem.select("l_quantity", "l_extendedprice"), "l_quantity", "l_extendedprice").select(_r("spearman", "spearman"))


@query("""WITH f AS (SELECT o_orderpriority, l_orderkey, avg(l_quantity) AS m FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
 SELECT o_orderpriority, round(avg(m), 6) AS mean FROM f GROUP BY 1""")
def mean_of_means(t):
    means = t.lineitem.groupBy("l_orderkey").agg(F.avg("l_quantity").alias("m"))
    return means.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey").groupBy("o_orderpriority").agg(_r(F.avg("m"), "mean"))


@query("""SELECT l_orderkey, round(avg(power(l_quantity - l_linenumber * 7, 2)), 6) AS mse, round(avg(abs(l_quantity - l_linenumber * 7)), 6) AS l1,
 round(avg(sqrt(power(l_quantity - l_linenumber * 7, 2) + 1e-12)), 6) AS charbonnier,
 CASE WHEN avg(power(l_quantity - l_linenumber * 7, 2)) = 0 THEN 'Infinity'::double ELSE round(10 * log10(65025.0 / avg(power(l_quantity - l_linenumber * 7, 2))), 6) END AS psnr FROM lineitem GROUP BY l_orderkey""")
def psnr_rows(t):
    a, b = F.col("l_quantity"), F.col("l_linenumber") * 7
    mse = E.mean((a - b) ** 2)
    return t.lineitem.groupBy("l_orderkey").agg(_r(mse, "mse"), _r(E.mean(F.abs(a - b)), "l1"), _r(E.mean(E.charbonnier(a, b)), "charbonnier"), _r(E.psnr(mse), "psnr"))


@query("""WITH d AS (SELECT l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS draw FROM lineitem),
 f AS (SELECT min(draw) // 1000 AS b FROM d GROUP BY l_partkey), c AS (SELECT b, count(*) AS n FROM f GROUP BY b),
 s AS (SELECT i AS b, coalesce(n, 0) AS n FROM range((SELECT max(draw) // 1000 + 1 FROM d)) r(i) LEFT JOIN c ON c.b = r.i)
 SELECT ((b + 1) * 1000)::bigint AS draws, round(1.0 * sum(n) OVER (ORDER BY b) / sum(n) OVER (), 6) AS share FROM s""")
def coverage_curve(t):
    return R.coverage(t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber"), "l_partkey", ["l_orderkey", "l_linenumber"]).select("draws", _r("share", "share"))


@query("""SELECT d.doc_id, count(*) FILTER (n_chars < 50) + count(*) FILTER (lang <> 'en') + count(*) FILTER (source IS NULL) AS broken FROM documents d GROUP BY d.doc_id""")
def rule_counts(t):
    return t.documents.groupBy("doc_id").agg((F.count_if(F.col("n_chars") < 50) + F.count_if(F.col("lang") != "en") + F.count_if(F.col("source").isNull())).alias("broken"))


# ---- boxes: arithmetic on line items

_BOX = """b AS (SELECT l_orderkey AS image, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey AS det, l_partkey % 4 AS cls, l_discount * 8 AS conf, l_linenumber * 10.0 + l_partkey % 7 AS x1, l_linenumber * 10.0 + l_suppkey % 5 AS y1,
 l_linenumber * 10.0 + l_partkey % 7 + 8 + l_suppkey % 11 AS x2, l_linenumber * 10.0 + l_suppkey % 5 + 8 + l_partkey % 13 AS y2 FROM lineitem)"""
_LAB = "t AS (SELECT image, det AS lab, cls, x1 + 1 + f AS x1, y1 + (det % 3) AS y1, x2 + 1 + f AS x2, y2 + (det % 3) AS y2 FROM (SELECT *, CASE WHEN det % 4 = 0 THEN 500 ELSE 0 END AS f FROM b))"


def _boxes(t):
    n, p, s = F.col("l_linenumber") * F.lit(10.0), F.col("l_partkey"), F.col("l_suppkey")
    x, y = n + p % 7, n + s % 5
    return t.lineitem.select(F.col("l_orderkey").alias("image"), (F.col("l_linenumber") * F.lit(1000000000000) + p * 1000000 + s).alias("det"), (p % 4).alias("cls"), (F.col("l_discount") * 8).alias("conf"), x.alias("x1"), y.alias("y1"), (x + 8 + s % 11).alias("x2"), (y + 8 + p % 13).alias("y2"))


def _labels(t):
    d = F.col("det") % 3
    return _boxes(t).select("image", F.col("det").alias("lab"), "cls", (F.col("x1") + 1).alias("x1"), (F.col("y1") + d).alias("y1"), (F.col("x2") + 1).alias("x2"), (F.col("y2") + d).alias("y2"))


def _truths(t):
    """All boxes as labels; a quarter of them is moved out of reach of any detection."""
    far = F.when(F.col("lab") % 4 == 0, 500).otherwise(0)
    return _labels(t).withColumns({"x1": F.col("x1") + far, "x2": F.col("x2") + far})


def _xyxy(p=""):
    return tuple(F.col(f"{p}{c}") for c in ("x1", "y1", "x2", "y2"))


@query(f"WITH {_BOX} SELECT image, det, (x1 + x2) / 2 AS xc, (y1 + y2) / 2 AS yc, least(greatest(x2, 0), 60) - least(greatest(x1, 0), 60) AS w, least(greatest(y2, 0), 60) - least(greatest(y1, 0), 60) AS h FROM b")
def box_convert(t):
    c, inside = B.centred(_xyxy()), B.centred(B.clipped(_xyxy(), 60, 60))
    return _boxes(t).select("image", "det", c[0].alias("xc"), c[1].alias("yc"), inside[2].alias("w"), inside[3].alias("h"))


@query(f"WITH {_BOX} SELECT image, max_by(det, struct_pack(a := (x2 - x1) * (y2 - y1), d := det)) AS det FROM b GROUP BY image")
def largest_box(t):
    return _boxes(t).groupBy("image").agg(F.max_by("det", F.struct(B.area(_xyxy()), "det")).alias("det"))


_PAIRS = f"""{_BOX}, {_LAB}, p AS (SELECT b.image, b.det, t.lab, b.cls AS pred, t.cls AS truth, b.conf, b.x1 AS a1, b.y1 AS a2, b.x2 AS a3, b.y2 AS a4, t.x1 AS c1, t.y1 AS c2, t.x2 AS c3, t.y2 AS c4 FROM b JOIN t ON b.image = t.image),
 i AS (SELECT *, greatest(least(a3, c3) - greatest(a1, c1), 0) * greatest(least(a4, c4) - greatest(a2, c2), 0) AS bt, (a3 - a1) * (a4 - a2) AS sa, (c3 - c1) * (c4 - c2) AS sc,
 greatest(a3, c3) - least(a1, c1) AS hw, greatest(a4, c4) - least(a2, c2) AS hh FROM p), u AS (SELECT *, bt / (sc + sa - bt) AS iou, sa + sc - bt AS un FROM i)"""


@query(f"""WITH {_PAIRS} SELECT image, det, lab, round(iou + 1e-9, 6) AS iou, round(iou - (hw * hh - un) / (hw * hh) + 1e-9, 6) AS giou,
 round(iou - (power((a1 + a3 - c1 - c3) / 2, 2) + power((a2 + a4 - c2 - c4) / 2, 2)) / (hw * hw + hh * hh) + 1e-9, 6) AS diou,
 round(iou - (power((a1 + a3 - c1 - c3) / 2, 2) + power((a2 + a4 - c2 - c4) / 2, 2)) / (hw * hw + hh * hh)
  - power(4 / pi() ** 2 * power(atan((c3 - c1) / (c4 - c2)) - atan((a3 - a1) / (a4 - a2)), 2), 2) / (4 / pi() ** 2 * power(atan((c3 - c1) / (c4 - c2)) - atan((a3 - a1) / (a4 - a2)), 2) - iou + 1.0000001) + 1e-9, 6) AS ciou FROM u""")
def iou_pairs(t):
    rename = lambda df, p: df.select("image", *[F.col(c).alias(f"{p}{c}") for c in df.columns if c != "image"])
    p = rename(_boxes(t), "d").join(rename(_truths(t), "l"), "image")
    a, b = _xyxy("d"), _xyxy("l")
    return p.select("image", F.col("ddet").alias("det"), F.col("llab").alias("lab"), *[_r(f(a, b) + 1e-9, f.__name__) for f in (B.iou, B.giou, B.diou, B.ciou)])


_MATCH = f"""{_PAIRS}, m1 AS (SELECT * FROM u WHERE conf > 0.25 AND iou > 0.45 QUALIFY row_number() OVER (PARTITION BY image, det ORDER BY iou DESC, lab) = 1),
 m AS (SELECT * FROM m1 QUALIFY row_number() OVER (PARTITION BY image, lab ORDER BY iou DESC, det) = 1)"""


@query(f"""WITH {_MATCH}, c AS (SELECT pred, truth FROM m UNION ALL SELECT 4, cls FROM t WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.image = t.image AND m.lab = t.lab)
 UNION ALL SELECT cls, 4 FROM b WHERE conf > 0.25 AND image IN (SELECT image FROM m) AND NOT EXISTS (SELECT 1 FROM m WHERE m.image = b.image AND m.det = b.det))
 SELECT pred::bigint AS pred, truth::bigint AS truth, count(*) AS n FROM c GROUP BY 1, 2""")
def greedy_match_confusion(t):
    return E.confusion(_boxes(t), _truths(t), 4)


@query(f"""WITH {_MATCH}, r AS (SELECT b.cls, b.conf, b.image, b.det, (m.det IS NOT NULL)::int AS tp FROM b LEFT JOIN m ON m.image = b.image AND m.det = b.det AND m.pred = m.truth),
 n AS (SELECT cls, count(*) AS n_labels FROM t GROUP BY cls), s AS (SELECT *, row_number() OVER w AS n, sum(tp) OVER w AS tps FROM r WINDOW w AS (PARTITION BY cls ORDER BY conf DESC, image, det))
 SELECT s.cls::bigint AS cls, count(*) AS n, round(max(tps / (n_labels + 1e-16)), 6) AS recall, round(avg(1.0 * tps / s.n), 6) AS mean_precision FROM s JOIN n ON s.cls = n.cls GROUP BY s.cls""")
def precision_recall_curve(t):
    curve = E.precision_recall(_results(t), _truths(t).groupBy("cls").agg(F.count("*").alias("n_labels")))
    return curve.groupBy("cls").agg(F.count("*").alias("n"), _r(F.max("recall"), "recall"), _r(F.avg("precision"), "mean_precision"))


def _results(t):
    hit = E.matched(_boxes(t), _truths(t)).filter("pred = truth").select("image", "det", F.lit(1).alias("tp"))
    return _boxes(t).join(hit, ["image", "det"], "left").select("cls", "conf", F.coalesce("tp", F.lit(0)).alias("tp"), F.struct("image", "det").alias("id"))


@query(f"""WITH {_MATCH}, r AS (SELECT b.cls, b.conf, b.image, b.det, (m.det IS NOT NULL)::int AS tp FROM b LEFT JOIN m ON m.image = b.image AND m.det = b.det AND m.pred = m.truth),
 n AS (SELECT cls, count(*) AS n_labels FROM t GROUP BY cls), s AS (SELECT *, row_number() OVER w AS n, sum(tp) OVER w AS tps FROM r WINDOW w AS (PARTITION BY cls ORDER BY conf DESC, image, det)),
 c AS (SELECT s.cls, tps / (n_labels + 1e-16) AS recall, max(1.0::double * tps / s.n) AS high, min(1.0::double * tps / s.n) AS low FROM s JOIN n ON s.cls = n.cls GROUP BY 1, 2),
 e AS (SELECT * FROM c UNION ALL SELECT cls, 0, 1, 1 FROM c GROUP BY cls HAVING min(recall) > 0 UNION ALL SELECT cls, max(recall) + 0.01, 0, 0 FROM c GROUP BY cls),
 q AS (SELECT cls, recall, coalesce(max(high) OVER (PARTITION BY cls ORDER BY recall DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beyond, high, low FROM e),
 l AS (SELECT cls, recall AS r0, greatest(low, beyond) AS p0, lead(recall) OVER w AS r1, lead(greatest(high, beyond)) OVER w AS p1 FROM q WINDOW w AS (PARTITION BY cls ORDER BY recall)),
 g AS (SELECT cls, i, max(p0 + (p1 - p0) * (i / 100.0::double - r0) / (r1 - r0)) AS p FROM l, range(0, 101) k(i) WHERE i / 100.0::double >= r0 - 1e-11 AND i / 100.0::double < r1 - 1e-11 GROUP BY 1, 2)
 SELECT n.cls::bigint AS cls, round(coalesce(sum(p * CASE WHEN i IN (0, 100) THEN 0.5 ELSE 1 END) / 100, 0), 6) AS ap FROM n LEFT JOIN g ON g.cls = n.cls GROUP BY n.cls""")
def ap_per_class(t):
    return E.ap_per_class(_results(t), _truths(t).groupBy("cls").agg(F.count("*").alias("n_labels"))).select("cls", _r("ap", "ap"))


@query()
def nms(t):
    return E.suppress(_boxes(t))


@query()
def hungarian_attach(t):
    centre = lambda df, key: df.select("image", F.col(key).alias("id"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    return E.attach(centre(_boxes(t), "det"), centre(_labels(t), "lab"))


@query("""WITH g AS (SELECT p_partkey, p_size * 30 AS w FROM part) SELECT p_partkey, x::bigint AS x FROM g, LATERAL (SELECT unnest(list_distinct(list_append(CASE WHEN w > 256 THEN range(0, w - 255, 224) ELSE [0] END, greatest(w - 256, 0)))) AS x)""")
def tile_grid(t):
    w = F.col("p_size") * 30
    starts = F.when(w > 256, F.sequence(F.lit(0), w - 256, F.lit(224))).otherwise(F.array(F.lit(0)))
    return t.part.select("p_partkey", F.explode(F.array_distinct(F.concat(starts, F.array(F.greatest(w - 256, F.lit(0)))))).alias("x")).withColumn("x", F.col("x").cast("long"))


# ---- vectors

_VEC = "e AS (SELECT vec_id, label, embedding::double[] AS v FROM embeddings)"


@query(f"WITH {_VEC}, s AS (SELECT vec_id, sqrt(list_sum(list_transform(v, lambda x: (2 * x) * (2 * x)))) AS n, v FROM e) SELECT vec_id, round(2 * v[1] / n, 6) AS first, round(2 * v[64] / n, 6) AS last FROM s")
def l2_normalize(t):
    v = V.l2_normalized(F.transform(V.doubles(F.col("embedding")), lambda x: x * 2))
    return t.embeddings.select("vec_id", _r(v[0], "first"), _r(v[63], "last"))


@query(f"""WITH {_VEC}, c AS (SELECT label AS c, list(s ORDER BY i) AS m FROM (SELECT label, i, avg(v[i]) AS s FROM e, range(1, 65) r(i) GROUP BY label, i) GROUP BY label),
 d AS (SELECT vec_id, c, 100 * list_sum(list_transform(range(1, 65), lambda i: v[i] * m[i])) AS s FROM e, c), p AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id)) AS x FROM d)
 SELECT vec_id, c, round(x / sum(x) OVER (PARTITION BY vec_id), 5) AS p FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) <= 3""")
def clip_topk(t):
    e = t.embeddings.select("vec_id", "label", V.doubles(F.col("embedding")).alias("v"))
    cells = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centres = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("m")).select(F.col("label").alias("c"), F.col("m.m").alias("m"))
    held = centres.agg(F.sort_array(F.collect_list(F.struct("c", "m"))).alias("cs"))  # one row: a centre for each of ten labels
    scores = F.transform("cs", lambda c: V.dot(F.col("v"), c["m"]))
    p = e.crossJoin(held).select("vec_id", "cs", V.softmax(scores, 100.0).alias("p"))
    best = F.slice(F.array_sort(F.transform(F.arrays_zip("p", F.col("cs.c").alias("c")), lambda x: F.struct((-x["p"]).alias("k"), x["c"].alias("c"), x["p"].alias("p")))), 1, 3)
    return p.select("vec_id", F.explode(best).alias("b")).select("vec_id", F.col("b.c").alias("c"), _r("b.p", "p", 5))


@query(f"""WITH {_VEC}, s AS (SELECT vec_id, list_reverse_sort(v) AS s, v FROM e), g AS (SELECT vec_id, s, v, list_transform(range(1, 64), lambda i: s[i] - s[i + 1]) AS g FROM s),
 k AS (SELECT vec_id, v, s, list_position(g, list_max(g)) AS k FROM g) SELECT vec_id, round((s[k] + s[k + 1]) / 2, 6) AS threshold, len(list_filter(v, lambda x: x > (s[k] + s[k + 1]) / 2))::int AS n FROM k""")
def mcut_tags(t):
    e = t.embeddings.select("vec_id", V.doubles(F.col("embedding")).alias("v")).withColumn("m", V.mcut(F.col("v")))
    return e.select("vec_id", _r("m", "threshold"), F.size(F.filter("v", lambda x: x > F.col("m"))).alias("n"))


@query("SELECT vec_id, (dense_rank() OVER (ORDER BY label) - 1)::bigint AS code, label * 10 + 1 AS mapped FROM embeddings")
def dense_labels(t):
    codes = R.ranked(t.embeddings.select("label").distinct(), F.col("label"), "label", name="code", ranges=4)
    return t.embeddings.select("vec_id", "label").join(codes, "label").select("vec_id", "code", (F.col("label") * 10 + 1).alias("mapped"))


@query("SELECT vec_id, (i - 1)::int AS pos, round(embedding[i]::double, 6) AS score FROM embeddings, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i)")
def explode_detections(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "x")).select("vec_id", "pos", _r(F.col("x").cast("double"), "score"))


@query(f"""WITH {_VEC}, x AS (SELECT r.i AS i, s.i AS j, v[r.i + 1] AS a, v[s.i + 1] AS b FROM e, range(64) r(i), range(64) s(i) WHERE s.i >= r.i)
 SELECT i::int AS i, j::int AS j, round(avg(a), 8) AS mean_i, round(avg(b), 8) AS mean_j, round(covar_samp(a, b), 8) AS covariance FROM x GROUP BY i, j""")
def mvg_stats(t):
    return V.moments(t.embeddings, "embedding").select("i", "j", *[_r(c, c, 8) for c in ("mean_i", "mean_j", "covariance")])


@query(f"""WITH {_VEC}, p AS (SELECT vec_id, list_transform(v[1:10], lambda x: abs(x) + 0.01) AS p, list_transform(v[11:20], lambda x: abs(x) + 0.01) AS q FROM e)
 SELECT vec_id, round(list_sum(list_transform(range(1, 11), lambda i: p[i] * i)) / list_sum(p), 6) AS mean,
 round(sqrt(list_sum(list_transform(range(1, 11), lambda i: power(list_sum(p[1:i]) / list_sum(p) - list_sum(q[1:i]) / list_sum(q), 2))) / 10), 6) AS emd FROM p""")
def dist_expectation_emd(t):
    part = lambda a: F.transform(F.slice(V.doubles(F.col("embedding")), a, 10), lambda x: F.abs(x) + 0.01)
    e = t.embeddings.select("vec_id", part(1).alias("p"), part(11).alias("q"))
    unit = lambda c: F.transform(c, lambda x: x / F.aggregate(c, F.lit(0.0), lambda a, v: a + v))
    return e.select("vec_id", _r(V.expectation(F.col("p")), "mean"), _r(F.sqrt(V.emd_squares(unit(F.col("p")), unit(F.col("q")))), "emd"))


@query()
def kmeans_inertia(t):
    return V.cluster_costs(t.embeddings, "embedding", [2, 4, 8])


# ---- events in order

@query("SELECT user_id, count(*) AS kept FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events) WHERE i % 5 = 0 GROUP BY user_id")
def every_nth(t):
    return S.every_nth(t.events.select("user_id", "ts", "event_id"), "user_id", ["ts", "event_id"], 5).groupBy("user_id").agg(F.count("*").alias("kept"))



@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(t):
    return S.latest(t.events, "user_id", ["ts", "event_id"], ["value"]).select("user_id", "event_id", "value")


@query("SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS best FROM events")
def best_so_far(t):
    return S.best_so_far(t.events, "user_id", ["ts", "event_id"], "value").select("event_id", "best")


@query("""WITH RECURSIVE o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE value IS NOT NULL),
 s AS (SELECT user_id, i, value::double AS s FROM o WHERE i = 1 UNION ALL SELECT o.user_id, o.i, s.s * 0.9 + o.value * (1 - 0.9) FROM s JOIN o ON o.user_id = s.user_id AND o.i = s.i + 1)
 SELECT user_id, i AS n, round(s, 6) AS last FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY i DESC) = 1""")
def iir_smooth(t):
    return S.smoothed(t.events, "user_id", ["ts", "event_id"], "value", 0.9).select("user_id", "n", _r("last", "last"))


@query("""WITH s AS (SELECT user_id, date_trunc('day', ts)::timestamp AS slot, max_by(value, struct_pack(t := ts, v := value)) AS value FROM events GROUP BY 1, 2),
 g AS (SELECT user_id, unnest(generate_series(min(slot), max(slot), INTERVAL 1 DAY)) AS slot FROM s GROUP BY user_id)
 SELECT g.user_id, strftime(g.slot, '%Y-%m-%d') AS slot, last_value(s.value IGNORE NULLS) OVER (PARTITION BY g.user_id ORDER BY g.slot ROWS UNBOUNDED PRECEDING) AS value FROM g LEFT JOIN s ON g.user_id = s.user_id AND g.slot = s.slot""")
def fill_forward_grid(t):
    return S.filled_grid(t.events, "user_id", "ts", "value", "day").select("user_id", F.date_format("slot", "yyyy-MM-dd").alias("slot"), "value")


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling(t):
    return S.tumbling(t.events, "ts", "1 hour").withColumn("start", F.date_format("start", "yyyy-MM-dd HH"))


@query("""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR * k, '%Y-%m-%d %H') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, range(2) r(k) GROUP BY 1, 2""")
def sliding(t):
    return S.tumbling(t.events, "ts", "2 hours", "1 hour").withColumn("start", F.date_format("start", "yyyy-MM-dd HH"))


@query("""WITH g AS (SELECT user_id, ts, (ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL)::int AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session(t):
    return S.sessions(t.events, "user_id", "ts", "30 minutes").select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT event_id, (props::json ->> '$.k')::bigint AS k FROM events")
def json_props(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


_FRAMES = "f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events), o AS (SELECT *, i + k AS x, n - 1 AS m FROM f, range(-2, 3) r(k) WHERE n >= 5)"


@query(f"""WITH {_FRAMES} SELECT event_id, k::int AS k, CASE WHEN x < 0 THEN 0 WHEN x > m THEN m ELSE x END::bigint AS replicate, CASE WHEN x < 0 THEN -x WHEN x > m THEN 2 * m - x ELSE x END::bigint AS reflection,
 CASE WHEN x < 0 THEN i + 2 - x WHEN x > m THEN i - 2 - (x - m) ELSE x END::bigint AS reflection_circle, CASE WHEN x < 0 THEN 5 + x WHEN x > m THEN x - 5 ELSE x END::bigint AS circle FROM o""")
def frame_window_pad(t):
    from pyspark.sql import Window as W

    w = W.partitionBy("user_id")
    f = t.events.select("event_id", (F.row_number().over(w.orderBy("ts", "event_id")) - 1).alias("i"), F.count("*").over(w).alias("n")).filter("n >= 5")
    modes = ["replicate", "reflection", "reflection_circle", "circle"]
    zipped = F.arrays_zip(*[S.frame_window(F.col("i"), F.col("n"), 5, m).alias(m) for m in modes])
    return f.select("event_id", F.posexplode(zipped).alias("p", "x")).select("event_id", (F.col("p") - 2).alias("k"), *[F.col(f"x.{m}").alias(m) for m in modes])


@query("""WITH o AS (SELECT p_partkey, 1.0 * p_size / (1 + p_partkey % 9) AS ratio, row_number() OVER (ORDER BY 1.0 * p_size / (1 + p_partkey % 9), p_partkey) - 1 AS i FROM part)
 SELECT (i // 16)::bigint AS batch, count(*) AS n, round(min(ratio), 6) AS least, round(max(ratio), 6) AS most FROM o GROUP BY 1""")
def rect_batches(t):
    parts = t.part.select("p_partkey", (F.col("p_size") / (1 + F.col("p_partkey") % 9)).alias("ratio"))
    return R.ranked(parts, F.col("ratio"), "p_partkey").groupBy(F.floor(F.col("rank") / 16).alias("batch")).agg(F.count("*").alias("n"), _r(F.min("ratio"), "least"), _r(F.max("ratio"), "most"))


# ---- documents as files

@query("""WITH g AS (SELECT text, min(doc_id) AS first FROM documents GROUP BY text), p AS (SELECT g.first AS p1, d.doc_id AS p2 FROM documents d JOIN g ON d.text = g.text AND d.doc_id <> g.first)
 SELECT DISTINCT CASE WHEN a.doc_id % 7 > b.doc_id % 7 THEN p2 ELSE p1 END AS path FROM p JOIN documents a ON a.doc_id = p1 JOIN documents b ON b.doc_id = p2""")
def dup_resolve(t):
    key = t.documents.select("doc_id", F.sha2("text", 256).alias("h"))
    first = key.groupBy("h").agg(F.min("doc_id").alias("p1"))
    pairs = key.join(first, "h").filter("doc_id <> p1").select("p1", F.col("doc_id").alias("p2"))
    return R.unresolved_duplicates(pairs, t.documents.select(F.col("doc_id").alias("path"), (F.col("doc_id") % 7).alias("length")))


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)")
def decontaminate(t):
    return t.documents.select("doc_id", "text").join(t.benchmark.select("text"), "text", "left_anti").select("doc_id")


@query("SELECT doc_id AS id, lang, NULL::bigint AS item_id FROM documents UNION ALL SELECT NULL, NULL, item_id FROM benchmark")
def schema_union(t):
    return t.documents.select(F.col("doc_id").alias("id"), "lang").unionByName(t.benchmark.select("item_id"), allowMissingColumns=True)


@query("SELECT conv_id, count(*) AS turns, max(turn) AS last, count(*) FILTER (role = 'user') AS asked FROM conversations GROUP BY conv_id")
def conversation_turns(t):
    return t.conversations.groupBy("conv_id").agg(F.count("*").alias("turns"), F.max("turn").alias("last"), F.count_if(F.col("role") == "user").alias("asked"))


from . import curation_queries  # noqa: E402, F401  registers further queries
