"""Checks of exploration and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explore as X
from ..operators import features as A
from .registry import check
from .views import Tables


def _rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


_EXT = "regexp_extract(path, '(\\.[^./]+)$', 1)"


@check(
    "x1_files_by_extension",
    f"""
SELECT CASE WHEN grouping(e) = 1 THEN 'TOTAL' ELSE e END AS extension, count(*) AS files,
       CAST(sum(size) AS BIGINT) AS bytes, round(CAST(sum(size) AS DOUBLE) / 1048576, 6) AS megabytes
FROM (SELECT {_EXT} AS e, size FROM files) t GROUP BY ROLLUP (e)""",
)
def files_by_extension(t: Tables):
    return _rounded(X.files_by_extension(t.files), "megabytes")


@check(
    "x2_directory_counts",
    """
WITH parts AS (SELECT string_split(path, '/') AS p FROM files)
SELECT 'raw' AS directory, 1 AS depth, CAST(0 AS BIGINT) AS files
UNION ALL SELECT DISTINCT 'raw/' || p[2], 2, CAST(0 AS BIGINT) FROM parts
UNION ALL SELECT 'raw/' || p[2] || '/' || p[3], 3, count(*) FROM parts GROUP BY 1""",
)
def directory_counts(t: Tables):
    return X.directory_counts(t.files)


@check(
    "x2_top_level_files",
    """
SELECT concat(year, '_', img, CASE WHEN img % 50 = 0 THEN '.hdf5' ELSE '.tif' END) AS filename,
       n_px * 1024 AS size,
       CASE WHEN img % 50 = 0 THEN 'HDF5 (use h5py or xarray)' ELSE 'Unknown format (.tif)' END AS type
FROM imgs WHERE img % 3 = 0""",
)
def top_level_files(t: Tables):
    ending = F.when(F.col("img") % 50 == 0, ".hdf5").otherwise(".tif")
    name = F.concat_ws("_", F.col("year").cast("string"), F.concat(F.col("img").cast("string"), ending))
    folder = F.when(F.col("img") % 3 == 0, F.lit("raw/")).otherwise(F.lit("raw/deep/"))
    listing = t.img.select(F.concat(folder, name).alias("path"), (F.col("n_px") * 1024).alias("size"))
    return X.top_level_files(listing, "raw")


@check(
    "x2_documentation_files",
    """
SELECT path, size FROM (
  SELECT concat('raw/docs/', CASE WHEN img % 7 = 0 THEN 'README_' WHEN img % 11 = 0 THEN 'userGuide'
                ELSE 'x' END, img, '.txt') AS path, n_px AS size, img FROM imgs) t
WHERE img % 7 = 0 OR img % 11 = 0""",
)
def documentation_files(t: Tables):
    i = F.col("img")
    name = F.when(i % 7 == 0, "README_").when(i % 11 == 0, "userGuide").otherwise("x")
    path = F.concat(F.lit("raw/docs/"), name, i.cast("string"), F.lit(".txt"))
    return X.documentation_files(t.img.select(path.alias("path"), F.col("n_px").alias("size")))


@check(
    "x3_sample_files",
    """
SELECT year, fire, obs_ts, img FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY fire, obs_ts, img) AS k,
         dense_rank() OVER (ORDER BY year) AS y FROM imgs) t WHERE k = 1 AND y <= 3""",
)
def sample_files(t: Tables):
    return X.sample_files(t.img, ["fire", "obs_ts", "img"])


_BANDS = ("b_fire", "b_deg", "b_lc", "b_cont", "b_static", "b_flag")


def _band_sql(band: str, value: str) -> str:
    return f"""
SELECT year, '{band}' AS band, CAST(min({value}) AS DOUBLE) AS minimum, CAST(max({value}) AS DOUBLE) AS maximum,
       round(avg({value}), 6) AS mean, round(stddev_pop({value}), 4) AS std, count({value}) AS non_missing,
       CASE WHEN max({value}) <= 1.1 AND min({value}) >= -0.1 THEN
              CASE WHEN bool_and({value} IN (0, 1)) THEN 'binary' ELSE 'normalized' END
            WHEN max({value}) > 1 AND max({value}) < 1000 THEN 'continuous'
            WHEN max({value}) >= 1000 THEN 'raw' ELSE 'unknown' END AS kind
FROM px GROUP BY year"""


@check(
    "x4_x5_band_profile",
    " UNION ALL ".join(
        _band_sql(b, "CASE WHEN b_fire > 0 THEN 1 ELSE 0 END" if b == "b_flag" else b)
        for b in _BANDS
    ),
)
def band_profile(t: Tables):
    pixels = t.px.withColumn("b_flag", F.when(F.col("b_fire") > 0, 1).otherwise(0))
    profile = X.band_profile(pixels, {b: F.col(b) for b in _BANDS}, ["year"])
    return _rounded(_rounded(profile, "mean"), "std", places=4)


@check(
    "x6_band_count_summary",
    """
SELECT count(*) AS files, round(avg(bands), 6) AS mean_bands, min(bands) AS min_bands, max(bands) AS max_bands
FROM (SELECT img, CAST(max(CASE WHEN b_fire IS NULL THEN 0 ELSE 1 END)
             + max(CASE WHEN b_lc IS NULL THEN 0 ELSE 1 END) + 1 AS INT) AS bands FROM px GROUP BY img) t""",
)
def band_count_summary(t: Tables):
    some = F.max(F.col("b_fire").isNotNull().cast("int")) + F.max(F.col("b_lc").isNotNull().cast("int"))
    per_file = t.px.groupBy("img").agg((some + 1).alias("bands"))
    return _rounded(X.band_count_summary(per_file), "mean_bands")


@check(
    "x7_embedding_summary",
    """
SELECT (SELECT count(*) FROM embeddings) AS "rows", 64 AS width, round(min(v), 6) AS minimum,
       round(max(v), 6) AS maximum, round(avg(v), 6) + 0 AS mean, round(stddev_pop(v), 6) AS std
FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) t""",
)
def embedding_summary(t: Tables):
    summary = X.embedding_summary(t.read("embeddings"))
    return _rounded(summary, "minimum", "maximum", "mean", "std")


@check(
    "x8_dimension_stats",
    """
SELECT position, round(avg(v), 6) + 0 AS mean, round(stddev_samp(v), 6) AS std
FROM (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS position,
             CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) t GROUP BY position""",
)
def dimension_stats(t: Tables):
    return _rounded(X.dimension_stats(t.read("embeddings")), "mean", "std")


_NORMS = """
SELECT vec_id, label, sqrt(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) AS norm
FROM embeddings"""


@check(
    "x9_norm_summary",
    f"""
SELECT label, count(norm) AS "rows", round(avg(norm), 6) AS mean, round(stddev_pop(norm), 6) AS std,
       round(min(norm), 6) AS minimum, round(max(norm), 6) AS maximum
FROM ({_NORMS}) n GROUP BY ROLLUP (label)""",
)
def norm_summary(t: Tables):
    normed = X.add_norm(t.read("embeddings"))
    whole = X.norm_summary(normed).withColumn("label", F.lit(None).cast("int"))
    both = X.norm_summary(normed, by=["label"]).unionByName(whole)
    return _rounded(both, "mean", "std", "minimum", "maximum")


@check(
    "x9_norm_by_sample",
    f"""
SELECT s.img, CASE WHEN burned_area > 0 THEN 1 ELSE 0 END AS ignition, round(norm, 6) AS norm,
       round(ln(1 + CAST(burned_area AS DOUBLE)), 6) AS log_burned_area
FROM smp s JOIN ({_NORMS}) n ON n.vec_id = s.img""",
)
def norm_by_sample(t: Tables):
    normed = X.add_norm(t.feat.where(F.col("embedding").isNotNull()))
    targets = A.add_targets(normed.select("img", "burned_area", "norm"))
    return _rounded(targets, "norm", "log_burned_area").drop("burned_area")


_QUALITY = ["n_px", "avg_cont", "label", "embedding"]


@check(
    "x10_missing_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM feat" for c in _QUALITY
    ),
)
def missing_counts(t: Tables):
    return X.missing_counts(t.feat, _QUALITY)


@check(
    "x10_missing_totals",
    """
SELECT CAST((a > 0)::INT + (b > 0)::INT + (c > 0)::INT AS BIGINT) AS columns_with_missing, a + b + c AS missing_values
FROM (SELECT count(*) - count(avg_cont) AS a, count(*) - count(label) AS b,
             count(*) - count(embedding) AS c FROM feat) t""",
)
def missing_totals(t: Tables):
    return X.missing_totals(t.feat, _QUALITY)


@check(
    "x11_infinite_counts",
    """
SELECT 'embedding' AS "column", (SELECT count(*) FROM (SELECT unnest(embedding) AS v FROM embeddings) t
       WHERE isinf(v)) AS infinite
UNION ALL SELECT 'ratio', count(*) FROM embeddings WHERE label = 0""",
)
def infinite_counts(t: Tables):
    table = t.read("embeddings").withColumn(
        "ratio", F.when(F.col("label") == 0, F.lit(float("inf"))).otherwise(1.0 / F.col("label"))
    )
    return X.infinite_counts(table, ["embedding", "ratio"])


@check(
    "x12_value_counts",
    'SELECT split, year, month, count(*) AS "rows" FROM cal GROUP BY split, year, month',
)
def value_counts(t: Tables):
    return X.value_counts(t.cal, "split", "year", "month")


@check(
    "x13_duplicate_rows",
    """
SELECT count(*) AS "rows", count(*) - (SELECT count(*) FROM (SELECT DISTINCT year, fire, n_px, n_fire FROM smp) d) AS duplicates
FROM smp""",
)
def duplicate_rows(t: Tables):
    found = X.duplicate_rows(t.smp, ["year", "fire", "n_px", "n_fire"])
    return found


@check(
    "x13_duplicate_names",
    """
WITH n AS (SELECT string_split(string_split(path, '/')[-1], '_')[1] AS name FROM files)
SELECT count(*) AS "rows", count(*) - count(DISTINCT name) AS duplicates FROM n""",
)
def duplicate_names(t: Tables):
    name = F.split_part(F.element_at(F.split("path", "/"), -1), F.lit("_"), F.lit(1))
    return X.duplicate_rows(t.files.select(name.alias("name")), ["name"])


@check(
    "x14_matched_share",
    """
SELECT count(CASE WHEN value > 50 THEN 1 END) AS matched,
       count(*) - count(CASE WHEN value > 50 THEN 1 END) AS unmatched,
       round(100.0 * count(CASE WHEN value > 50 THEN 1 END) / count(*), 6) AS matched_percent,
       round(100.0 * (count(*) - count(CASE WHEN value > 50 THEN 1 END)) / count(*), 6) AS unmatched_percent
FROM cal""",
)
def matched_share(t: Tables):
    return _rounded(
        X.matched_share(t.cal, F.col("value") > 50), "matched_percent", "unmatched_percent"
    )


@check(
    "x15_target_summary",
    """
SELECT count(*) AS samples, CAST(sum(ignition) AS BIGINT) AS ignitions,
       round(100 * avg(ignition), 6) AS ignition_percent,
       round(CAST(count(CASE WHEN ignition = 0 THEN 1 END) AS DOUBLE) / sum(ignition), 6) AS imbalance,
       round(avg(l), 6) AS log_mean, round(stddev_samp(l), 6) AS log_std, round(min(l), 6) AS log_min,
       round(max(l), 6) AS log_max, round(quantile_cont(l, 0.25), 6) AS log_q25,
       round(quantile_cont(l, 0.5), 6) AS log_q50, round(quantile_cont(l, 0.75), 6) AS log_q75,
       count(CASE WHEN l = 0 THEN 1 END) AS log_zeros,
       round(100.0 * count(CASE WHEN l = 0 THEN 1 END) / count(*), 6) AS log_zero_percent,
       round(avg(burned_area), 6) AS area_mean, round(stddev_samp(burned_area), 6) AS area_std,
       CAST(min(burned_area) AS DOUBLE) AS area_min, CAST(max(burned_area) AS DOUBLE) AS area_max,
       count(CASE WHEN burned_area > 0 THEN 1 END) AS area_nonzero
FROM (SELECT burned_area, CASE WHEN burned_area > 0 THEN 1 ELSE 0 END AS ignition,
             ln(1 + CAST(burned_area AS DOUBLE)) AS l FROM smp) t""",
)
def target_summary(t: Tables):
    summary = X.target_summary(A.add_targets(t.stored_smp))
    doubles = [n for n, kind in summary.dtypes if kind == "double" and n not in ("area_min", "area_max")]
    return _rounded(summary, *doubles)


def _histogram_sql(bins: int, by: bool) -> str:
    g = "ignition, " if by else ""
    on = "USING (ignition)" if by else "ON true"
    return f"""
WITH e AS (SELECT {g}min(log_pred) AS lo, max(log_pred) AS hi FROM pred {'GROUP BY ignition' if by else ''}),
b AS (SELECT {g}least(CAST(floor((log_pred - lo) / ((hi - lo) / {bins})) AS INT), {bins - 1}) AS bin
      FROM pred JOIN e {on}),
n AS (SELECT {g}bin, count(*) AS n FROM b GROUP BY {g}bin)
SELECT {'e.ignition, ' if by else ''}CAST(g.i AS INT) AS bin, round(lo + g.i * ((hi - lo) / {bins}), 6) + 0 AS "left",
       round(lo + (g.i + 1) * ((hi - lo) / {bins}), 6) + 0 AS "right", coalesce(n.n, 0) AS "rows"
FROM e CROSS JOIN range({bins}) g(i) LEFT JOIN n ON n.bin = g.i {'AND n.ignition = e.ignition' if by else ''}"""


@check("x16_histogram", _histogram_sql(50, False))
def histogram(t: Tables):
    return _rounded(X.histogram(t.stored_pred, "log_pred", 50), "left", "right")


@check("x16_histogram_by_class", _histogram_sql(30, True))
def histogram_by_class(t: Tables):
    return _rounded(X.histogram(t.stored_pred, "log_pred", 30, by="ignition"), "left", "right")


@check(
    "x17_rates_by_month",
    """
SELECT month, round(100 * avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS ignition_percent,
       count(*) AS samples, round(avg(ln(1 + value)), 6) AS mean_log_area FROM cal GROUP BY month""",
)
def rates_by_month(t: Tables):
    rates = X.rates_by_period(t.cal, "month", F.col("value") > 50, F.log1p("value"))
    return _rounded(rates, "ignition_percent", "mean_log_area")


@check(
    "x17_rates_by_year",
    """
SELECT year, round(100 * avg(CASE WHEN burned_area > 0 THEN 1.0 ELSE 0.0 END), 6) AS ignition_percent,
       count(*) AS samples, round(avg(ln(1 + CAST(burned_area AS DOUBLE))), 6) AS mean_log_area
FROM smp GROUP BY year""",
)
def rates_by_year(t: Tables):
    targets = A.add_targets(t.smp)
    rates = X.rates_by_period(targets, "year", F.col("ignition"), F.col("log_burned_area"))
    return _rounded(rates, "ignition_percent", "mean_log_area")


@check(
    "x18_box_stats",
    """
WITH q AS (SELECT quantile_cont(log_pred, 0.25) AS q1, quantile_cont(log_pred, 0.5) AS q2,
                  quantile_cont(log_pred, 0.75) AS q3 FROM pred)
SELECT round(max(q1), 6) AS q1, round(max(q2), 6) AS median, round(max(q3), 6) AS q3,
       min(CASE WHEN log_pred BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) THEN log_pred END) AS whisker_low,
       max(CASE WHEN log_pred BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) THEN log_pred END) AS whisker_high,
       count(CASE WHEN log_pred < q1 - 1.5::DOUBLE * (q3 - q1) OR log_pred > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 END) AS outliers
FROM pred, q""",
)
def box_stats(t: Tables):
    return _rounded(X.box_stats(t.stored_pred, "log_pred"), "q1", "median", "q3")


@check(
    "x19_distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM cal"
        for c in ("year", "month", "day_of_year", "split", "burn_id")
    ),
)
def distinct_counts(t: Tables):
    return X.distinct_counts(t.cal, ["year", "month", "day_of_year", "split", "burn_id"])


@check(
    "x20_coverage",
    """
SELECT min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date,
       count(DISTINCT year) AS years, count(DISTINCT CAST(ts AS DATE)) AS dates FROM cal""",
)
def coverage(t: Tables):
    return X.coverage(t.cal.withColumn("date", F.to_date("ts")), "date", "year")


@check(
    "x20_events_coverage",
    """
SELECT count(*) AS events, round(avg(n), 6) AS mean_images
FROM (SELECT burn_id, count(*) AS n FROM cal WHERE burn_id IS NOT NULL GROUP BY burn_id) t""",
)
def events_coverage(t: Tables):
    return _rounded(X.events_coverage(t.cal, "burn_id"), "mean_images")


@check(
    "x21_first_per_class",
    """
SELECT year, fire, img, ignition FROM (
  SELECT *, row_number() OVER (PARTITION BY ignition ORDER BY year, fire, img) AS k FROM pred) t
WHERE k <= 5""",
)
def first_per_class(t: Tables):
    firsts = X.first_per_class(t.pred, "ignition", ["year", "fire", "img"])
    return firsts.select("year", "fire", "img", "ignition")
