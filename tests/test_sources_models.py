from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import schema
from emberline.models import heads as M
from emberline.operators import explore as X
from emberline.operators.prepare import assemble_features, name_features
from emberline.plans import evaluation, training
from emberline.sources import inventory as I
from emberline.sources import rasters as R
from emberline.sources import tables as A


def npy_decoder():
    """A closure travels to the workers by value; this module does not exist there."""

    def decode(content):
        import io

        import numpy as np

        return np.load(io.BytesIO(content)), (-120.5, 38.25)

    return decode


@pytest.fixture(scope="module")
def raw(tmp_path_factory, images):
    root = tmp_path_factory.mktemp("raw")
    for (year, fire, date), bands in images.items():
        folder = root / str(year) / fire
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / f"{date}.tif", "wb") as f:
            np.save(f, bands)
    (root / "2018" / "fire_empty").mkdir()
    (root / "README.txt").write_text("hello")
    (root / "2018" / "stack_1.hdf5").write_bytes(b"1234")
    return str(root)


def test_inventory_and_report(spark, raw, images):
    years = [2017, 2018, 2019]
    inventory = I.image_inventory(spark, raw, years)
    rows = {(r["year"], r["fire"], r["obs_date"]) for r in inventory.collect()}
    assert rows == {k for k in images if k[0] in years}
    assert inventory.where("size <= 0").isEmpty()
    fires = I.fire_directories(spark, raw, years)
    report = {(r["year"], r["fire"]) for r in I.inventory_report(inventory, years, fires).collect()}
    assert report == {(2017, None), (2018, "fire_empty")}
    assert I.inventory_report(inventory, [2018]).isEmpty()
    stacks = I.image_inventory(spark, raw, years, layout="stacks").collect()
    assert [(r["year"], r["fire"], r["size"]) for r in stacks] == [(2018, "stack_1", 4)]


def test_ingested_pixels_and_stacks(spark, raw, images, tmp_path):
    pixels = R.ingest_rasters(spark, raw, [2018, 2020], npy_decoder())
    assert pixels.count() == sum(b[0].size for k, b in images.items() if k[0] in (2018, 2020))
    key, bands = next((k, b) for k, b in images.items() if k[1] == "fire_1")
    one = pixels.where((F.col("fire") == key[1]) & (F.col("obs_date") == key[2]) & (F.col("year") == key[0]))
    got = one.orderBy("r", "c").collect()
    np.testing.assert_array_equal(
        np.array([r["bands"] for r in got], dtype=np.float32).T, bands.reshape(23, -1)
    )
    R.write_fire_stacks(pixels, f"{tmp_path}/stacks", f"{tmp_path}/fires")
    stored = R.read_fire_stacks(spark, f"{tmp_path}/stacks")
    assert stored.columns == schema.STACK_PIXELS.names and stored.count() == pixels.count()
    hours = stored.where((F.col("fire") == key[1]) & (F.col("obs_date") == key[2]) & (F.col("year") == key[0]))
    hours = [r["bands"][22] for r in hours.orderBy("r", "c").collect()]
    np.testing.assert_array_equal(hours, np.floor(np.nan_to_num(bands[22]).ravel() / 100))
    plan = stored.where("year = 2018 AND fire = 'fire_1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(fire,fire_1)" in plan
    places = stored.select("year", "fire", "obs_date", "day_index", "fire_days").distinct().collect()
    for r in places:
        days = sorted(k[2] for k in images if k[:2] == (r["year"], r["fire"]))
        assert days[r["day_index"]] == r["obs_date"] and r["fire_days"] == len(days)
    fires = spark.read.parquet(f"{tmp_path}/fires").collect()
    assert {(r["lng"], r["lat"], r["days"]) for r in fires} == {(-120.5, 38.25, 4)} and len(fires) == 4


def test_each_wanted_file_is_decoded_once(spark, raw, images, tmp_path):
    seen = f"{tmp_path}/seen"

    def decode(content):
        import io

        import numpy as np

        with open(seen, "ab") as log:
            log.write(b".")
        return np.load(io.BytesIO(content)), (1.0, 2.0)

    R.write_fire_stacks(R.ingest_rasters(spark, raw, [2019, 1950], decode), f"{tmp_path}/stacks", f"{tmp_path}/fires")
    with open(seen, "rb") as log:
        assert len(log.read()) == sum(k[0] == 2019 for k in images)
    assert {r["days"] for r in spark.read.parquet(f"{tmp_path}/fires").collect()} == {4}
    assert R.ingest_rasters(spark, raw, [1950], decode).isEmpty()


def test_listing_reports(spark, raw):
    files = I.list_files(spark, raw)
    kinds = {r["extension"]: r["files"] for r in X.files_by_extension(files).collect()}
    assert kinds == {".tif": 32, ".txt": 1, ".hdf5": 1, "TOTAL": 34}
    top = X.top_level_files(files, f"file:{raw}").collect()
    assert [(r["filename"], r["type"]) for r in top] == [("README.txt", "Unknown format (.txt)")]
    assert [r["path"].rsplit("/", 1)[1] for r in X.documentation_files(files).collect()] == ["README.txt"]
    folders = {r["directory"]: r["files"] for r in X.directory_counts(files, f"file:{raw}").collect()}
    assert folders["2018"] == 1 and folders["2018/fire_0"] == 4 and folders["2019"] == 0


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, "train", 1, [1.5, None, 3.0], [0.25, 0.5]), (2, "test", 0, [4.0, 5.0, 6.0], [1.0, 2.0])]
    keys = T.StructType.fromDDL("sample_idx int, split string, ignition int")
    df = spark.createDataFrame(
        rows, "sample_idx int, split string, ignition int, tif array<double>, embedding array<double>"
    )
    widths = {"tif": 3, "embedding": 2}
    A.write_feature_csv(df, f"{tmp_path}/csv", widths)
    header = spark.read.text(f"{tmp_path}/csv").first()[0]
    assert header.startswith("sample_idx,split,ignition,tif_feature_0,") and header.endswith("embedding_1")
    back = A.read_feature_csv(spark, f"{tmp_path}/csv", keys, widths)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    A.write_csv(df.select("sample_idx", "split"), f"{tmp_path}/plain")
    assert A.read_csv(spark, f"{tmp_path}/plain", T.StructType(keys.fields[:2])).count() == 2
    A.write_table(df, f"{tmp_path}/table", "split")
    assert A.read_table(spark, f"{tmp_path}/table").where("split = 'test'").count() == 1


def test_feature_list(spark, tmp_path):
    names = [f"embedding_{i}" for i in range(40)] + ["a b"]
    A.write_feature_list(spark, names, f"{tmp_path}/list")
    assert A.read_feature_list(spark, f"{tmp_path}/list") == names


@pytest.mark.parametrize(
    "losses,patience,want",
    [
        ([5, 4, 3, 3.5, 3.6, 2.0], 2, (3, True)),
        ([5, 4, 3, 3.5, 3.6, 2.0], 3, (6, False)),
        ([1, 2, 3], 5, (1, False)),
        ([3, 3, 3, 3], 3, (1, True)),
        ([3.0], 1, (1, False)),
    ],
)
def test_patience(losses, patience, want):
    assert M.patience_rounds(losses, patience) == want


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        x = rng.normal(size=3)
        area = float(np.round(np.exp(1.2 * x[0]) * 5)) if x[0] + 0.3 * rng.normal() > 0 else 0.0
        features = [float(v) for v in x]
        features[1] = None if i % 9 == 0 else features[1]
        split = "train" if i < 400 else "val" if i < 500 else "test"
        rows.append((i, split, int(area > 0), area, math.log1p(area), features))
    plain = spark.createDataFrame(
        rows, "id int, split string, ignition int, burned_area double, log_burned_area double, features array<double>"
    )
    return name_features(plain, ["x0", "x1", "x2"])


def test_heads_learn_save_and_load(spark, table, tmp_path):
    names = ["x0", "x1", "x2"]
    few = M.Boosting(rounds=40, depth=3, rate=0.2, patience=4)
    heads = training.train_heads(table, names, few)
    val = table.where("split = 'val'")
    report = {
        (r["model"], r["head"], r["metric"]): r["value"]
        for r in training.validation_report(heads, val).collect()
    }
    assert report[("boosted", "p", "roc_auc")] > 0.9 and report[("linear", "p", "roc_auc")] > 0.9
    assert report[("boosted", "a", "r2")] > 0.6
    assert heads["boosted"]["a"].model.getNumTrees <= 40

    head = heads["linear"]["p"]
    M.save_head(head, f"{tmp_path}/head", spark)
    loaded = M.load_head(f"{tmp_path}/head", spark)
    assert loaded.names == names and loaded.label == "ignition"
    test = table.where("split = 'test'")
    a = head.score(test, "p").orderBy("id").collect()
    b = loaded.score(test, "p").orderBy("id").collect()
    assert [r["p"] for r in a] == [r["p"] for r in b]
    assert all(0 <= r["p"] <= 1 for r in a) and len(a) == 100

    # The contract: named features are brought into the head's order, missing ones are refused.
    wide = test.select("id", *[F.col("features")[i].alias(n) for i, n in enumerate(names)])
    turned = assemble_features(wide, ["x2", "x0", "x1"])
    assert [r["p"] for r in head.score(turned, "p").orderBy("id").collect()] == [r["p"] for r in a]
    with pytest.raises(ValueError, match="missing"):
        head.score(assemble_features(wide, ["x0", "x1"]), "p")
    with pytest.raises(ValueError, match="no feature names"):
        head.score(test.withColumn("features", F.array_compact("features")), "p")
    alone = evaluation.score_model(test, head, None, ["id"], 3.0, "alone")
    report = {(r["head"], r["metric"]): r["value"] for r in evaluation.metric_report(alone).collect()}
    assert alone.where("hazard_score IS NOT NULL").isEmpty() and report[("ignition", "roc_auc")] > 0.9
    packed = training.pack_features(test.withColumnRenamed("features", "own").withColumn("one", F.lit(1)), {"own": names}, ["one"])
    assert packed.schema["features"].metadata["names"] == ["one", *names]
    with pytest.raises(Exception, match="should have 2 entries"):
        training.pack_features(test.withColumnRenamed("features", "own"), {"own": names[:2]}).select("features").collect()

    scored = None
    for family, pair in heads.items():
        part = evaluation.score_model(test, pair["p"], pair["a"], ["id"], 3.0, family)
        scored = part if scored is None else scored.unionByName(part)
    assert scored.count() == 200 and scored.where("log_burned_area > 3 OR hazard_score < 0").isEmpty()
    compared = evaluation.compare_families(evaluation.metric_report(scored))
    assert {"roc_auc", "rmse", "spearman", "log1p_hazard_n"} <= {r["metric"] for r in compared.collect()}


def test_logistic_matches_its_objective(spark, table):
    """L2 with C = 1: the gradient of 0.5 |w|^2 + sum of log losses vanishes."""
    train = table.where("split = 'train'")
    medians = training.feature_medians(train)
    model = M.logistic_baseline(train, ["x0", "x1", "x2"], medians).model
    w, b = model.coefficients.toArray(), model.intercept
    x = np.array([[m if v is None else v for v, m in zip(r["features"], medians)] for r in train.collect()])
    y = np.array([r["ignition"] for r in train.collect()])
    p = 1 / (1 + np.exp(-(x @ w + b)))
    np.testing.assert_allclose(w + x.T @ (p - y), 0, atol=0.2)
    np.testing.assert_allclose((p - y).sum(), 0, atol=0.2)


def test_more_rounds_share_their_first_trees(spark, table):
    """Rounds build on the ones before only, and losses are those of the validation rows."""
    names, medians = ["x0", "x1", "x2"], training.feature_medians(table)
    train, val = table.where("split = 'train'"), table.where("split = 'val'")
    heads = [M.boosted_regressor(train, val, names, medians, M.Boosting(rounds=r, depth=3, patience=None)) for r in (6, 12)]
    np.testing.assert_allclose(heads[0].model.losses, heads[1].model.losses[:6])
    scored = heads[1].score(val, "p").select(((F.col("p") - F.col("log_burned_area")) ** 2).alias("e")).agg(F.avg("e")).first()[0]
    np.testing.assert_allclose(heads[1].model.losses[-1], scored, rtol=1e-6)


def test_strips_of_a_file_are_read_by_tasks_of_their_own(spark, tmp_path):
    """One file in eight tasks gives the pixels of the whole file."""
    rng = np.random.default_rng(2)
    images = {"2018/fire_a/2018-07-01.tif": rng.normal(size=(23, 50, 12)), "2018/fire_a/2018-07-03.tif": rng.normal(size=(23, 3, 5)), "2019/b/2019-01-01.tif": rng.normal(size=(23, 9, 9))}
    for name, image in images.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        with open(tmp_path / name, "wb") as out:
            np.save(out, image.astype(np.float32))

    def strip(stream, part, parts):
        """Rows of a stored array, band by band, without reading the others."""
        import numpy as np

        np.lib.format.read_magic(stream)
        (bands, height, width), _, kind = np.lib.format.read_array_header_1_0(stream)
        begin, first, last = stream.tell(), part * height // parts, (part + 1) * height // parts
        out = np.zeros((bands, last - first, width), kind)
        for band in range(bands):
            stream.seek(begin + (band * height + first) * width * kind.itemsize)
            out[band] = np.frombuffer(stream.read((last - first) * width * kind.itemsize), kind).reshape(-1, width)
        return out, first, height, (1.5, 2.5)

    size = (tmp_path / "2018/fire_a/2018-07-01.tif").stat().st_size
    got = R.ingest_strips(spark, str(tmp_path), [2018, 2019], strip, strip_bytes=-(-size // 8))
    whole = R.ingest_rasters(spark, str(tmp_path), [2018, 2019], lambda content: (np.load(__import__("io").BytesIO(content)), (1.5, 2.5)))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() == 600 + 15 + 81
    tasks = got.where("height = 50").select(F.spark_partition_id().alias("task"), "r").distinct().groupBy("task").count()
    assert sorted(r["count"] for r in tasks.collect()) == [6, 6, 6, 6, 6, 6, 7, 7]


def test_trees_do_not_depend_on_partitions_or_order(spark, table):
    names, medians = ["x0", "x1", "x2"], [0.0, 0.0, 0.0]
    few = M.Boosting(rounds=3, depth=3, row_share=1.0, patience=None)
    found = [M.boosted_classifier(rows, None, names, medians, few).model for rows in (table, table.repartition(9), table.orderBy("id").coalesce(1))]
    for other in found[1:]:
        for a, b in zip(found[0].trees, other.trees, strict=True):
            assert a.feature.tolist() == b.feature.tolist() and a.threshold.tolist() == b.threshold.tolist()
            np.testing.assert_array_equal(a.value, b.value)


def test_early_stopping_grows_patience_trees_more_than_it_keeps(spark, table):
    names, medians = ["x0", "x1", "x2"], training.feature_medians(table)
    rules = M.Boosting(rounds=200, depth=2, rate=0.6, patience=4)
    model = M.boosted_regressor(table.where("split = 'train'"), table.where("split = 'val'"), names, medians, rules).model
    assert model.grown == len(model.trees) + 4 and len(model.losses) == model.grown
    assert min(model.losses) == model.losses[len(model.trees) - 1]


def test_scans_of_a_small_table_take_one_task_however_it_is_stored(spark, table, monkeypatch):
    """Rows travel in blocks; every level of every tree reads them in as few tasks as their number asks for."""
    from emberline.models import boosting as B

    tasks, splits = [], B._splits

    def seen(data, scan, b):
        tasks.append(data.rdd.getNumPartitions())
        assert data.count() < table.count() and data.agg(F.sum("rows")).first()[0] == table.count()
        return splits(data, scan, b)

    monkeypatch.setattr(B, "_splits", seen)
    rows = table.repartition(9).select("features", F.col("log_burned_area").alias("label"), F.lit(1.0).alias("weight"))
    model = B.fit_trees(rows, rows.where("false"), B.Boosting(rounds=B.CARRY + 1, depth=2, patience=None), False)
    assert len(model.trees) == B.CARRY + 1 and set(tasks) == {1}


def plain_boosting(x, y, w, b, logistic):
    """The same trees by plain loops over all thresholds."""
    margin = np.full(len(y), (np.average(y, weights=w) - 0.5) * 4 if logistic else np.average(y, weights=w))
    for _ in range(b.rounds):
        p = 1 / (1 + np.exp(-margin)) if logistic else margin
        g, h = w * (p - y), w * p * (1 - p) if logistic else w.copy()
        leaves = [np.ones(len(y), bool)]
        for _ in range(b.depth):
            after = []
            for rows in leaves:
                best = (1e-9, None)
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f])[:-1]:
                        left = rows & (x[:, f] <= cut)
                        right = rows & ~left
                        if min(h[left].sum(), h[right].sum()) < b.least_hessian:
                            continue
                        gain = sum(g[part].sum() ** 2 / (h[part].sum() + b.l2) * sign for part, sign in ((left, 1), (right, 1), (rows, -1)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (left, right))
                after += [rows] if best[1] is None else list(best[1])
            leaves = after
        for rows in leaves:
            margin[rows] -= b.rate * g[rows].sum() / (h[rows].sum() + b.l2)
    return 1 / (1 + np.exp(-margin)) if logistic else margin


@pytest.mark.parametrize("logistic", [True, False])
def test_trees_equal_plain_loops(spark, logistic):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(250, 3)), 1)
    y = (x[:, 0] + 0.5 * rng.normal(size=250) > 0).astype(float) if logistic else x[:, 0] ** 2 + 0.1 * rng.normal(size=250)
    rows = spark.createDataFrame([(i, float(v), x[i].tolist()) for i, v in enumerate(y)], "id int, label double, features array<double>")
    rules = M.Boosting(rounds=10, depth=3, rate=0.3, row_share=1.0, column_share=1.0, patience=None)
    model = M.fit_trees(rows.withColumn("weight", F.lit(1.0)), None, rules, logistic)
    got = np.array([r["s"] for r in rows.select("id", model.score("features").alias("s")).orderBy("id").collect()])
    np.testing.assert_allclose(got, plain_boosting(x, y, np.ones(250), rules, logistic), atol=1e-5)


def test_boosted_head_is_saved_and_loaded(spark, table, tmp_path):
    names = ["x0", "x1", "x2"]
    head = M.boosted_classifier(table, None, names, [0.0, 0.1, 0.0], M.Boosting(rounds=3, depth=2, patience=None))
    M.save_head(head, f"{tmp_path}/boosted", spark)
    again = M.load_head(f"{tmp_path}/boosted", spark)
    both = again.score(head.score(table, "before"), "after")
    assert both.where("before <> after OR before IS NULL").count() == 0 and again.names == names


def test_no_rows_no_trees(spark, table):
    model = M.boosted_regressor(table.where("false"), table, ["x0", "x1", "x2"], [0.0] * 3, M.Boosting(rounds=3)).model
    assert model.trees == [] and model.base == 0.0


def test_no_positive_rows_no_area_baseline(table):
    nothing = table.where("burned_area = 0")
    assert M.linear_baseline(nothing, ["x0", "x1", "x2"], [0.0, 0.0, 0.0]) is None
    assert M.class_weight(nothing) == 1.0


@pytest.mark.parametrize("name", ["boosted_classifier", "boosted_regressor", "train_heads", "scored_heads"])
def test_checks_train_with_published_settings_and_early_stopping(monkeypatch, name):
    from emberline.checks import model_checks as C

    class Seen(Exception):
        pass

    def record(*args):
        raise Seen(args)

    monkeypatch.setattr(C, "_parts", lambda t: ("train", "val", "test"))
    monkeypatch.setattr(C, "_table", lambda t: "table")
    monkeypatch.setattr(C.training, "feature_medians", lambda df: [])
    for owner, f in ((C.M, "boosted_classifier"), (C.M, "boosted_regressor"), (C.training, "train_heads")):
        monkeypatch.setattr(owner, f, record)
    with pytest.raises(Seen) as seen:
        getattr(C, name)(None)
    args = seen.value.args[0]
    assert args[-1] == C.M.Boosting()
    assert args[0] == "table" or args[1] == "val"
