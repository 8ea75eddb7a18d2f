"""Checks of pixel preprocessing and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import day_of_year, detection_hour, image_date, null_if_nan, sin_degrees
from ..operators import bands as B
from ..operators import features as X
from ..operators import geometry as G
from ..operators import samples as S
from ..schema import channel_names
from .registry import check
from .views import FOLDS, Tables

PIXEL = ["img", "r", "c"]


@check("p1_fire_missing", "SELECT img, r, c, coalesce(b_fire, 0) AS b_fire FROM px")
def fire_missing(t: Tables):
    return B.clean_fire_band(t.px, "b_fire").select(*PIXEL, "b_fire")


@check("p2_fire_hour", "SELECT img, r, c, floor(coalesce(b_fire, 0) / 100) AS fire_hour FROM px")
def fire_hour(t: Tables):
    return B.fire_to_hours(t.px, "b_fire", "fire_hour").select(*PIXEL, "fire_hour")


@check(
    "p3_label_mask",
    "SELECT img, r, c, CASE WHEN coalesce(b_fire, 0) > 0 THEN 1 ELSE 0 END AS label FROM px",
)
def label_mask(t: Tables):
    return B.add_label_mask(t.px, "b_fire").select(*PIXEL, "label")


@check("p4_degrees_sine", "SELECT img, r, c, round(sin(radians(b_deg)), 6) + 0 AS b_deg FROM px")
def degrees_sine(t: Tables):
    turned = B.degrees_to_sine(t.px, ["b_deg"])
    return turned.select(*PIXEL, F.round("b_deg", 6).alias("b_deg"))


@check(
    "p5_input_mask",
    """
SELECT img, r, c, CASE WHEN floor(coalesce(b_fire, 0) / 100) > 0 THEN CAST(1 AS DOUBLE)
       ELSE CAST(0 AS DOUBLE) END AS fire_mask FROM px""",
)
def input_mask(t: Tables):
    hours = B.fire_to_hours(t.px, "b_fire", "fire_hour")
    return B.add_input_mask(hours, "fire_hour").select(*PIXEL, "fire_mask")


def _prepared(t: Tables):
    return {
        "fire": F.floor(null_if_nan("b_fire") / 100),
        "deg": sin_degrees("b_deg"),
        "cont": F.col("b_cont"),
        "static": F.col("b_static"),
    }


def _stats(t: Tables):
    return B.band_stats(t.px, _prepared(t), [f[:2] for f in FOLDS])


_PAIRS = ", ".join(f"({a}, {b})" for a, b in sorted({f[:2] for f in FOLDS}))
_STATS = f"""
SELECT p.a AS year_a, p.b AS year_b, v.band, avg(v.x) AS mean, stddev_samp(v.x) AS std,
       1 - CAST(count(v.x) AS DOUBLE) / count(*) AS missing
FROM (SELECT year, 'fire' AS band, CAST(floor(b_fire / 100) AS DOUBLE) AS x FROM px
      UNION ALL SELECT year, 'deg', sin(radians(b_deg)) FROM px
      UNION ALL SELECT year, 'cont', b_cont FROM px
      UNION ALL SELECT year, 'static', b_static FROM px) v
JOIN (VALUES {_PAIRS}) p(a, b) ON v.year IN (p.a, p.b)
GROUP BY p.a, p.b, v.band"""


@check(
    "p7_band_stats",
    f"""
SELECT year_a, year_b, band, round(mean, 4) + 0 AS mean, round(std, 4) AS std,
       round(missing, 6) AS missing FROM ({_STATS}) s""",
)
def band_stats(t: Tables):
    return _stats(t).select(
        F.col("train_years")[0].alias("year_a"),
        F.col("train_years")[1].alias("year_b"),
        "band",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        F.round("missing", 6).alias("missing"),
    )


_SCALED = f"""
WITH stats AS ({_STATS}),
m AS (SELECT max(CASE WHEN band = 'fire' THEN mean END) AS fm, max(CASE WHEN band = 'fire' THEN std END) AS fs,
             max(CASE WHEN band = 'cont' THEN mean END) AS cm, max(CASE WHEN band = 'cont' THEN std END) AS cs
      FROM stats WHERE year_a = 1995 AND year_b = 1996)"""


def _scaler(t: Tables):
    one_fold = B.band_stats(t.px, _prepared(t), [FOLDS[0][:2]])
    return B.fit_scaler(one_fold, FOLDS[0][:2], untouched=["deg", "static"])


@check(
    "p6_standardize",
    _SCALED
    + """
SELECT img, r, c, round((floor(coalesce(b_fire, 0) / 100) - fm) / fs, 6) AS fire,
       round((b_cont - cm) / cs, 6) AS cont FROM px, m""",
)
def standardize(t: Tables):
    ready = t.px.select(*PIXEL, detection_hour("b_fire").alias("fire"), F.col("b_cont").alias("cont"))
    scaled = B.standardize(ready, _scaler(t))
    return scaled.select(*PIXEL, F.round("fire", 6).alias("fire"), F.round("cont", 6).alias("cont"))


@check(
    "p8_fill_missing",
    _SCALED
    + """
SELECT img, r, c, round(coalesce((b_cont - cm) / cs, 0), 6) AS cont FROM px, m""",
)
def fill_missing(t: Tables):
    ready = t.px.select(*PIXEL, F.col("b_cont").alias("cont"))
    scaler = {"cont": _scaler(t)["cont"]}
    filled = B.fill_missing(B.standardize(ready, scaler), ["cont"])
    return filled.select(*PIXEL, F.round("cont", 6).alias("cont"))


@check(
    "p9_land_cover_shares",
    "SELECT img, "
    + ", ".join(
        f"round(avg(CASE WHEN (coalesce(b_lc, 0) + 16) % 17 = {k} THEN 1.0 ELSE 0.0 END), 6) AS lc_{k + 1}"
        for k in range(17)
    )
    + " FROM px GROUP BY img",
)
def land_cover_shares(t: Tables):
    hot = B.one_hot_land_cover(t.px.select("img", "b_lc"), "b_lc")
    names = [f"lc_{k + 1}" for k in range(17)]
    return hot.groupBy("img").agg(*[F.round(F.avg(n), 6).alias(n) for n in names])


def _names_sql(only_base: bool) -> str:
    names = channel_names(only_base)
    values = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""
WITH names AS (SELECT * FROM (VALUES {values}) v(channel, name)),
long AS (SELECT r % {len(names)} AS channel, round(avg(b_cont), 4) AS value FROM px GROUP BY 1)
SELECT channel, value, name,
       CASE WHEN name LIKE 'Land%' THEN 'land cover' WHEN name LIKE 'Active fire%' THEN 'fire'
            WHEN name LIKE 'Forecast%' THEN 'forecast' ELSE 'observed' END AS kind,
       name LIKE 'Land%' OR name IN ('Slope', 'Aspect', 'Elevation') AS static
FROM long LEFT JOIN names USING (channel)"""


@check("p10_name_base_bands", _names_sql(True))
def name_base_bands(t: Tables):
    long = t.px.groupBy((F.col("r") % 23).alias("channel")).agg(F.round(F.avg("b_cont"), 4).alias("value"))
    return B.name_channels(long, only_base=True)


@check("p10_name_channels", _names_sql(False))
def name_channels(t: Tables):
    long = t.px.groupBy((F.col("r") % 40).alias("channel")).agg(F.round(F.avg("b_cont"), 4).alias("value"))
    return B.name_channels(long)


_IMAGE_FEATURES = ["avg_static", "n_mask", "n_px", "n_fire"]


def _packed(t: Tables):
    packed = F.array(*[F.col(c).cast("double") for c in _IMAGE_FEATURES])
    return t.indexed.withColumn("features", packed)


@check(
    "p11_keep_features",
    """
SELECT img, CAST(n_fire AS DOUBLE) AS k0, round(avg_static, 6) AS k1, CAST(n_px AS DOUBLE) AS k2
FROM imgs""",
)
def keep_features(t: Tables):
    kept = _packed(t).select("img", B.keep_features("features", [3, 0, 2]).alias("k"))
    columns = [F.round(F.col("k")[i], 6).alias(f"k{i}") for i in range(3)]
    return kept.select("img", *columns)


def _flat(t: Tables, n: int):
    windows = S.leading_windows(_packed(t), n, ["features"], "n_fire")
    days = F.transform("days", lambda d: d["features"])
    flat = B.dedupe_static(days, n, keep=[0, 1, 2], static=[0], dynamic=[1, 2, 3])
    return windows.select("year", "fire", "in_fire_index", flat.alias("flat"))


@check(
    "p12_dedupe_static",
    """
SELECT year, fire, CAST(i AS BIGINT) AS in_fire_index, CAST(n_mask AS DOUBLE) AS f0,
       CAST(n_px AS DOUBLE) AS f1, round(s1, 6) AS f2, CAST(m1 AS DOUBLE) AS f3, CAST(p1 AS DOUBLE) AS f4
FROM (SELECT year, fire, n_mask, n_px, row_number() OVER w - 1 AS i, lead(avg_static) OVER w AS s1,
             lead(n_mask) OVER w AS m1, lead(n_px) OVER w AS p1, lead(n_fire, 2) OVER w AS label
      FROM imgs WINDOW w AS (PARTITION BY year, fire ORDER BY obs_ts, img)) t
WHERE label IS NOT NULL""",
)
def dedupe_static(t: Tables):
    columns = [F.round(F.col("flat")[i], 6).alias(f"f{i}") for i in range(5)]
    return _flat(t, 2).select("year", "fire", "in_fire_index", *columns)


@check(
    "p13_width_audit",
    """
SELECT 7 AS width, count(*) AS samples, true AS as_expected
FROM (SELECT lead(n_fire, 3) OVER (PARTITION BY year, fire ORDER BY obs_ts, img) AS label FROM imgs) t
WHERE label IS NOT NULL""",
)
def width_audit(t: Tables):
    expected = B.expected_width(3, [0, 1, 2], True, static=[0], dynamic=[1, 2, 3])
    return B.width_audit(_flat(t, 3), "flat", expected)


@check(
    "p14_image_dates",
    """
SELECT path, CAST(regexp_extract(path, '([0-9-]{10})_', 1) AS DATE) AS obs_date,
       CAST(dayofyear(CAST(regexp_extract(path, '([0-9-]{10})_', 1) AS DATE)) AS INT) AS doy
FROM files""",
)
def image_dates(t: Tables):
    dated = t.files.select("path", image_date("path").alias("obs_date"))
    text = F.concat(F.col("obs_date").cast("string"), F.lit(".tif"))
    return dated.withColumn("doy", day_of_year(text))


@check(
    "p15_center_crop",
    """
WITH size AS (SELECT img, max(r) + 1 AS h, max(c) + 1 AS w FROM px GROUP BY img),
place AS (SELECT img, CAST(floor(h / 32) * 32 AS INT) AS nh, CAST(floor(w / 32) * 32 AS INT) AS nw,
                 CAST(round_even((h - floor(h / 32) * 32) / 2.0, 0) AS INT) AS top,
                 CAST(round_even((w - floor(w / 32) * 32) / 2.0, 0) AS INT) AS lft FROM size)
SELECT img, r - top AS r, c - lft AS c, nh AS height, nw AS width, b_static
FROM px JOIN place USING (img)
WHERE r >= top AND r < top + nh AND c >= lft AND c < lft + nw""",
)
def center_crop(t: Tables):
    sized = G.with_image_size(t.px.select(*PIXEL, "b_static"), ["img"])
    return G.center_crop_32(sized)


_SIZE = "WITH size AS (SELECT img, max(r) + 1 AS h, max(c) + 1 AS w FROM px GROUP BY img)"


@check(
    "p16_reflect_pad",
    _SIZE
    + """,
pad AS (SELECT img, h, w, greatest(h, 56) AS ph, greatest(w, 56) AS pw,
               CAST(floor((greatest(h, 56) - h) / 2) AS INT) AS top,
               CAST(floor((greatest(w, 56) - w) / 2) AS INT) AS lft FROM size),
rows_of AS (SELECT img, ph, y, abs((y - top + greatest(2 * (h - 1), 1) * 100 + (h - 1)) % greatest(2 * (h - 1), 1) - (h - 1)) AS sr
            FROM pad, unnest(range(ph)) u(y)),
cols_of AS (SELECT img, pw, x, abs((x - lft + greatest(2 * (w - 1), 1) * 100 + (w - 1)) % greatest(2 * (w - 1), 1) - (w - 1)) AS sc
            FROM pad, unnest(range(pw)) u(x))
SELECT p.img, CAST(count(*) AS BIGINT) AS pixels, CAST(sum(y * 100 + x) AS BIGINT) AS place_sum,
       round(sum(b_static * (y + 2 * x + 1)), 4) AS weighted, max(ph) AS height, max(pw) AS width
FROM px p JOIN rows_of a ON a.img = p.img AND a.sr = p.r JOIN cols_of b ON b.img = p.img AND b.sc = p.c
GROUP BY p.img""",
)
def reflect_pad(t: Tables):
    sized = G.with_image_size(t.px.select(*PIXEL, "b_static"), ["img"])
    padded = G.reflect_pad(sized, 56)
    return padded.groupBy("img").agg(
        F.count(F.lit(1)).alias("pixels"),
        F.sum(F.col("r") * 100 + F.col("c")).alias("place_sum"),
        F.round(F.sum(F.col("b_static") * (F.col("r") + 2 * F.col("c") + 1)), 4).alias("weighted"),
        F.max("height").alias("height"),
        F.max("width").alias("width"),
    )


@check(
    "p18_flip",
    _SIZE
    + """
SELECT img, CASE WHEN img % 4 >= 2 THEN h - 1 - r ELSE r END AS r,
       CASE WHEN img % 2 = 1 THEN w - 1 - c ELSE c END AS c, round(CASE WHEN img % 4 >= 2
       THEN ((180 - (CASE WHEN img % 2 = 1 THEN 360 - b_deg ELSE b_deg END)) % 360 + 360) % 360
       ELSE CASE WHEN img % 2 = 1 THEN 360 - b_deg ELSE b_deg END END, 4) + 0 AS b_deg
FROM px JOIN size USING (img)""",
)
def flip(t: Tables):
    sized = G.with_image_size(t.px.select(*PIXEL, "b_deg"), ["img"])
    flipped = G.flip(sized, ["b_deg"], F.col("img") % 2 == 1, F.col("img") % 4 >= 2)
    return flipped.select(*PIXEL, F.round("b_deg", 4).alias("b_deg"))


@check(
    "p19_rotate",
    """
SELECT img, CASE img % 4 WHEN 0 THEN r WHEN 1 THEN 63 - c WHEN 2 THEN 63 - r ELSE c END AS r,
       CASE img % 4 WHEN 0 THEN c WHEN 1 THEN r WHEN 2 THEN 63 - c ELSE 63 - r END AS c,
       round(CASE WHEN img % 4 = 0 THEN b_deg
             ELSE ((b_deg - 90 * (img % 4)) % 360 + 360) % 360 END, 4) + 0 AS b_deg
FROM px""",
)
def rotate(t: Tables):
    square = t.px.select(*PIXEL, "b_deg", F.lit(64).alias("height"), F.lit(64).alias("width"))
    turned = G.rotate(square, ["b_deg"], F.col("img") % 4)
    return turned.select(*PIXEL, F.round("b_deg", 4).alias("b_deg"))


_CROPS = """
WITH sq AS (SELECT img, r, c, floor(b_fire / 100) AS hour, CAST(b_fire > 0 AS INT) AS label FROM px),
tries AS (
  SELECT img, i, ('0x' || substr(md5(concat_ws('|', '7', img, i, 'top')), 1, 8))::BIGINT % 33 AS top,
         ('0x' || substr(md5(concat_ws('|', '7', img, i, 'left')), 1, 8))::BIGINT % 17 AS lft
  FROM (SELECT DISTINCT img FROM px), (SELECT unnest(range(10)) AS i)),
scores AS (
  SELECT t.img, t.i, round(sum(CASE WHEN r BETWEEN top AND top + 31 AND c BETWEEN lft AND lft + 31
                                    THEN coalesce(hour / 1024.0::DOUBLE, 0) + coalesce(1000 * label / 1024.0::DOUBLE, 0) ELSE 0 END), 9) AS score
  FROM tries t JOIN sq USING (img) WHERE hour > 0 OR label > 0 GROUP BY t.img, t.i),
best AS (SELECT img, i FROM scores QUALIFY row_number() OVER (PARTITION BY img ORDER BY score DESC, i) = 1)
SELECT sq.img, count(*) AS pixels, CAST(sum(label) AS BIGINT) AS burning
FROM sq LEFT JOIN best USING (img) JOIN tries t ON t.img = sq.img AND t.i = coalesce(best.i, 0)
WHERE r BETWEEN top AND top + 31 AND c BETWEEN lft AND lft + 31 GROUP BY sq.img"""


@check("p17_best_crop", _CROPS)
def best_crop(t: Tables):
    square = t.px.select(
        *PIXEL,
        detection_hour("b_fire").alias("fire_hour"),
        (F.col("b_fire") > 0).cast("int").alias("label"),
        F.lit(64).alias("height"),
        F.lit(48).alias("width"),
    )
    cropped = G.best_crop(square, ["img"], 32, seed=7)
    return cropped.groupBy("img").agg(
        F.count(F.lit(1)).alias("pixels"), F.sum("label").alias("burning")
    )


_AGGS = {
    "mean": "avg({0})",
    "max": "max({0})",
    "sum": "sum({0})",
}
_CHANNELS = {
    "fire": "floor(coalesce(b_fire, 0) / 100)",
    "deg": "sin(radians(b_deg))",
    "cont": "coalesce(b_cont, 0)",
    "static": "b_static",
}


def _spatial(kind: str):
    sql = ", ".join(
        f"round({_AGGS[kind].format(e)}, 6) + 0 AS {n}" for n, e in _CHANNELS.items()
    )

    @check(f"f1_spatial_{kind}", f"SELECT img, {sql} FROM px GROUP BY img")
    def spatial(t: Tables):
        channels = {
            "fire": detection_hour("b_fire"),
            "deg": sin_degrees("b_deg"),
            "cont": F.coalesce("b_cont", F.lit(0.0)),
            "static": F.col("b_static"),
        }
        reduced = X.spatial_agg(t.px, ["img"], channels, kind)
        return reduced.select("img", *[F.round(n, 6).alias(n) for n in channels])

    return spatial


for _kind in _AGGS:
    _spatial(_kind)
