"""Per-sample features and targets, embeddings joined to them, and summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import count_if, month_day
from ..schema import RGB_MEAN, RGB_STD
from .joins import lookup_join
from .ordering import prefix_sums

_KINDS: dict[str, Callable[[Column], Column]] = {"mean": F.avg, "max": F.max, "sum": F.sum}


def spatial_agg(
    pixels: DataFrame, image: Sequence[str], channels: dict[str, Column], kind: str = "mean"
) -> DataFrame:
    """Mean, maximum or sum of each channel over an image.

    Reduced within each task before the shuffle, so a very large image costs no more than others.
    """
    reduce = _reducer(kind)
    return pixels.groupBy(*image).agg(*[reduce(v).alias(n) for n, v in channels.items()])


def _reducer(kind: str) -> Callable[[Column], Column]:
    if kind not in _KINDS:
        raise ValueError(f"unknown aggregation {kind!r}: one of {sorted(_KINDS)}")
    return _KINDS[kind]


def spatial_agg_array(
    pixels: DataFrame,
    image: Sequence[str],
    channels: Sequence[Column],
    kind: str = "mean",
    name: str = "tif",
    drop_last: int = 1,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """As ``spatial_agg`` with the channels as one array; the last ``drop_last`` are left out.

    1 drops the binary fire mask only, 2 also today's fire hour.
    """
    reduce = _reducer(kind)
    used = list(channels)[: len(channels) - drop_last]
    reduced = pixels.groupBy(*image).agg(
        *[reduce(v).alias(f"_ch{i}") for i, v in enumerate(used)], *extra
    )
    chans = [f"_ch{i}" for i in range(len(used))]
    return reduced.withColumn(name, F.array(*[F.col(c) for c in chans])).drop(*chans)


def flatten_days(days: Column | str) -> Column:
    """Arrays of the leading days one after the other: position = day * channels + channel."""
    return F.flatten(days)


def to_long(df: DataFrame, keys: Sequence[str], features: Column | str) -> DataFrame:
    """One row per feature with its position."""
    return df.select(*keys, F.posexplode(features).alias("position", "value"))


def image_targets(pixels: DataFrame, image: Sequence[str], label: Column) -> DataFrame:
    """Burning pixels of an image and whether there is any."""
    return pixels.groupBy(*image).agg(
        F.sum(label).cast("bigint").alias("burned_pixels"), F.max(label).cast("int").alias("ignition")
    )


def add_targets(samples: DataFrame, area: str = "burned_area") -> DataFrame:
    """``ignition`` and ``log_burned_area`` from the number of burning pixels."""
    return samples.withColumns(
        {
            "ignition": (F.col(area) > 0).cast("int"),
            "log_burned_area": F.log1p(F.col(area).cast("double")),
        }
    )


def join_embeddings(
    features: DataFrame,
    embeddings: DataFrame,
    keys: Sequence[str],
    column: str = "embedding",
) -> DataFrame:
    """Left join on the sample key; a sample without an embedding keeps NULL."""
    return features.join(embeddings.select(*keys, column), list(keys), "left")


def match_coverage(joined: DataFrame, column: str = "embedding") -> DataFrame:
    matched = count_if(F.col(column).isNotNull())
    return joined.agg(
        F.count(F.lit(1)).alias("samples"),
        matched.alias("matched"),
        (F.count(F.lit(1)) == matched).alias("complete"),
    )


def join_by_position(
    left: DataFrame,
    left_order: Sequence[str],
    right: DataFrame,
    right_order: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Row i of ``left`` takes ``columns`` from row i of ``right``, both in key order.

    Only when both have the same number of rows; otherwise the columns stay NULL and
    ``lengths_agree`` is false.
    """
    sizes_agree = (
        left.agg(F.count(F.lit(1))).scalar() == right.agg(F.count(F.lit(1))).scalar()
    )

    def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
        one = df.withColumn("_one", F.lit(1).cast("bigint"))
        return prefix_sums(one, order, ["_one"]).drop("_one").withColumnRenamed("upto__one", "_at")

    a = numbered(left, left_order)
    b = numbered(right, right_order).select("_at", *columns)
    joined = a.join(b, "_at", "left")
    return joined.select(
        *left.columns,
        *[F.when(sizes_agree, F.col(c)).alias(c) for c in columns],
        sizes_agree.alias("lengths_agree"),
    )


def union_splits(parts: dict[str, DataFrame]) -> DataFrame:
    """All splits under each other, tagged; columns that a split lacks are NULL."""
    union = None
    for name, part in parts.items():
        tagged = part.withColumn("split", F.lit(name))
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)
    return union


def add_month_day(df: DataFrame, doy: str = "day_of_year") -> DataFrame:
    month, day = month_day(doy)
    return df.withColumns({"month": month.cast("int"), "day_of_month": day.cast("int")})


def split_summary(df: DataFrame, n_features: int | Column, split: str = "split") -> DataFrame:
    width = F.lit(n_features) if isinstance(n_features, int) else F.max(n_features)
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(F.col("ignition").cast("double")).alias("ignition_rate"),
        F.avg(F.col("burned_area").cast("double")).alias("mean_burned_area"),
        width.cast("int").alias("features"),
    )


def rgb_prepare(
    pixels: DataFrame,
    image: Sequence[str],
    bands: Sequence[str],
    means: Sequence[float] = RGB_MEAN,
    stds: Sequence[float] = RGB_STD,
) -> DataFrame:
    """Three input planes of the embedding network as columns ``red``, ``green``, ``blue``.

    Joint min-max over the three bands of an image, a constant image becoming 0, then the fixed
    channel constants. Fewer than three bands are filled up with zeros.
    """
    planes = [F.col(b).cast("double") for b in bands[:3]]
    planes += [F.lit(0.0)] * (3 - len(planes))
    three = pixels.withColumns({f"_p{i}": p for i, p in enumerate(planes)})
    ranges = three.groupBy(*image).agg(
        F.least(*[F.min(f"_p{i}") for i in range(3)]).alias("_lo"),
        F.greatest(*[F.max(f"_p{i}") for i in range(3)]).alias("_hi"),
        F.count(F.lit(1)).alias("_pixels"),
    )
    joined = lookup_join(three, ranges, image, ["r", "c"], weight="_pixels")
    span = F.col("_hi") - F.col("_lo")

    def unit(i: int) -> Column:
        shifted = F.col(f"_p{i}") - F.col("_lo")
        return F.when(span > 0, shifted / span).otherwise(shifted)

    return joined.select(
        *image,
        "r",
        "c",
        *[
            ((unit(i) - F.lit(means[i])) / F.lit(stds[i])).alias(n)
            for i, n in enumerate(("red", "green", "blue"))
        ],
    )


#: Rows of pixels packed into one row before an image is put together.
STRIP_ROWS = 64
#: Bytes of embeddings that leave a task together.
_RUN_BYTES = 16 << 20


def whole_runs(batches: Iterator, keys: Sequence[str]) -> Iterator[tuple]:
    """From batches sorted by ``keys``, batches of whole runs of equal keys, each with the places where its
    runs begin and its length at the end. A run may cross batches; at most one is held beside a batch."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def differs(a, b):
        same = pc.fill_null(pc.equal(a, b), False)
        return pc.invert(pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b))))

    def begins(batch, before=None):
        new = np.zeros(len(batch), bool)
        for key in keys:
            column = batch.column(key)
            new[1:] |= differs(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            if before is not None:
                new[0] |= differs(column[:1], before.column(key)[-1:])[0].as_py()
        return np.flatnonzero(new)

    def whole(parts):
        batch = pa.concat_batches(parts) if len(parts) > 1 else parts[0]
        return batch, np.array([0, *begins(batch), len(batch)])

    open_parts: list = []
    for batch in batches:
        if not len(batch):
            continue
        cuts = begins(batch, open_parts[-1] if open_parts else None)
        if not len(cuts):
            open_parts.append(batch)
            continue
        last = int(cuts[-1])
        if last:
            open_parts.append(batch.slice(0, last))
        if open_parts:
            yield whole(open_parts)
        open_parts = [batch.slice(last)]
    if open_parts:
        yield whole(open_parts)


def embed_images(
    planes: DataFrame,
    image: Sequence[str],
    load: Callable[[], Callable],
    max_pixels: int | None = None,
) -> DataFrame:
    """Run a user's embedding function over whole images: ``(key, embedding array<float>)``.

    ``load()`` is called once per task and returns ``fn(array of shape (3, H, W)) -> 1-d array``.
    Pixels are packed first: a strip of rows becomes one row of bytes, so an image is put together
    from a few rows of 20 bytes a pixel and may pass what one row of Spark can hold. Only pixels that
    are there are packed, and many small images at once. A
    network needs its whole image, so a task holds one image; two pixels at one place and pixels
    without a place are errors, pixels that are not there are 0. With ``max_pixels`` images are counted first (keys only,
    reduced within tasks), and a larger one fails the job before anything is gathered.
    """
    if max_pixels is not None:
        sizes = planes.groupBy(*image).agg(F.count(F.lit(1)).alias("pixels"))
        oversized = sizes.where(F.col("pixels") > max_pixels).limit(1).collect()
        if oversized:
            raise ValueError(f"image too large to embed: {oversized[0].asDict()}")
    names, colours = list(image), ("red", "green", "blue")
    keys = [planes.schema[n] for n in names]
    parts = {"r": "int32", "c": "int32", **dict.fromkeys(colours, "float32")}
    strips = T.StructType([*keys, *[T.StructField(n, T.BinaryType()) for n in parts]])

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for pixels, cuts in whole_runs(batches, [*names, "_strip"]):
            packed = []
            for n, kind in parts.items():
                column = pixels.column(n)
                if n in ("r", "c") and (column.null_count or (len(column) and column.to_numpy().min() < 0)):
                    raise ValueError("a pixel has no place in its image")
                values = np.ascontiguousarray(column.to_numpy(zero_copy_only=False), kind)
                # Packed like the values of a list: the bytes of a strip follow those of the strip before.
                ends = pa.py_buffer((cuts * values.itemsize).astype(np.int32))
                packed.append(pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, ends, pa.py_buffer(values)]))
            first = pa.array(cuts[:-1])
            yield pa.RecordBatch.from_arrays([*[pixels.column(n).take(first) for n in names], *packed], strips.names)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        fn = load()

        def values_of(column, kind: str) -> tuple:
            """All values of a column of packed bytes, and where the values of each row begin."""
            size = np.dtype(kind).itemsize
            _, ends, content = column.buffers()
            at = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1] // size
            return np.frombuffer(content, kind, count=int(at[-1])), at

        def embedded(keyed, vectors: list, rows: list):
            ends = np.cumsum([0, *map(len, vectors)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(vectors)))
            return pa.RecordBatch.from_arrays([*[keyed.column(n).take(pa.array(rows)) for n in names], lists], [*names, "embedding"])

        for packed, cuts in whole_runs(batches, names):
            r, at = values_of(packed.column("r"), "int32")
            c, _ = values_of(packed.column("c"), "int32")
            colour = [values_of(packed.column(n), "float32")[0] for n in colours]
            vectors, rows, held = [], [], 0
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own = slice(at[lo], at[hi])
                y, x = r[own], c[own]
                height, width = int(y.max()) + 1, int(x.max()) + 1
                places = y.astype(np.int64) * width + x
                seen = np.zeros(height * width, bool)
                seen[places] = True
                if np.count_nonzero(seen) < len(places):
                    raise ValueError("an image has two pixels at one place")
                grid = np.zeros((3, height * width), np.float32)
                for plane, values in enumerate(colour):
                    grid[plane, places] = values[own]
                vector = np.asarray(fn(grid.reshape(3, height, width)), dtype=np.float32).ravel()
                vectors.append(vector)
                rows.append(lo)
                held += vector.nbytes
                if held > _RUN_BYTES:
                    yield embedded(packed, vectors, rows)
                    vectors, rows, held = [], [], 0
            if rows:
                yield embedded(packed, vectors, rows)

    wanted = planes.select(*names, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), *[F.col(n).cast("float").alias(n) for n in colours])
    strip = F.floor(F.col("r") / STRIP_ROWS).cast("int").alias("_strip")
    # Shuffled and sorted by Spark, which spills; a task reads its keys one after the other.
    pixels = wanted.select("*", strip).repartition(*names, "_strip").sortWithinPartitions(*names, "_strip")
    packed = pixels.mapInArrow(pack, strips).repartition(*names).sortWithinPartitions(*names)
    schema = T.StructType([*keys, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return packed.mapInArrow(run, schema)
