"""Table schemas and the fixed channel, fold and file-type dictionaries."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: source bands in file order -------------------------------------------------
BASE_BANDS = [
    "VIIRS band M11",
    "VIIRS band I2",
    "VIIRS band I1",
    "NDVI",
    "EVI2",
    "Total precipitation",
    "Wind speed",
    "Wind direction",
    "Minimum temperature",
    "Maximum temperature",
    "Energy release component",
    "Specific humidity",
    "Slope",
    "Aspect",
    "Elevation",
    "Palmer drought severity index (PDSI)",
    "Landcover class",
    "Forecast: Total precipitation",
    "Forecast: Wind speed",
    "Forecast: Wind direction",
    "Forecast: Temperature",
    "Forecast: Specific humidity",
    "Active fire",
]

# --- fixed values: land-cover classes 1..17 ----------------------------------------------------
LAND_COVER = [
    "Evergreen Needleleaf Forests",
    "Evergreen Broadleaf Forests",
    "Deciduous Needleleaf Forests",
    "Deciduous Broadleaf Forests",
    "Mixed Forests",
    "Closed Shrublands",
    "Open Shrublands",
    "Woody Savannas",
    "Savannas",
    "Grasslands",
    "Permanent Wetlands",
    "Croplands",
    "Urban and Built-up Lands",
    "Cropland/Natural Vegetation Mosaics",
    "Permanent Snow and Ice",
    "Barren",
    "Water Bodies",
]

# --- fixed values: positions within the 23 source bands ----------------------------------------
DEGREE_BANDS = (7, 13, 19)
LAND_COVER_BAND = 16
FIRE_BAND = 22
N_BASE = len(BASE_BANDS)
N_CLASSES = len(LAND_COVER)
N_CHANNELS = N_BASE - 1 + N_CLASSES + 1

# --- fixed values: static channels after expansion (topography and land cover) -----------------
STATIC_CHANNELS = (12, 13, 14, *range(LAND_COVER_BAND, LAND_COVER_BAND + N_CLASSES))
DYNAMIC_CHANNELS = tuple(i for i in range(N_CHANNELS) if i not in STATIC_CHANNELS)

# --- fixed values: year folds (two training years, validation year, test year) -----------------
FOLD_YEARS = [
    (2018, 2019, 2020, 2021),
    (2018, 2019, 2021, 2020),
    (2018, 2020, 2019, 2021),
    (2018, 2020, 2021, 2019),
    (2018, 2021, 2019, 2020),
    (2018, 2021, 2020, 2019),
    (2019, 2020, 2018, 2021),
    (2019, 2020, 2021, 2018),
    (2019, 2021, 2018, 2020),
    (2019, 2021, 2020, 2018),
    (2020, 2021, 2018, 2019),
    (2020, 2021, 2019, 2018),
]

# --- fixed values: channel constants of the embedding network's input normalisation ------------
RGB_MEAN = (0.485, 0.456, 0.406)
RGB_STD = (0.229, 0.224, 0.225)

# --- fixed values: column names that are never features ----------------------------------------
TARGET_COLUMNS = ["ignition", "burned_area", "log_burned_area"]
METADATA_COLUMNS = ["filename", "date", "event_id", "tile", "matched"]
TEMPORAL_COLUMNS = ["year", "month", "day_of_year", "day_of_week"]
NON_FEATURES = [*TARGET_COLUMNS, *METADATA_COLUMNS, *TEMPORAL_COLUMNS, "split", "sample_idx"]

# --- fixed values: file-type labels of the dataset listing --------------------------------------
FILE_TYPES = {
    ".nc": "NetCDF (use xarray or netCDF4)",
    ".h5": "HDF5 (use h5py or xarray)",
    ".hdf5": "HDF5 (use h5py or xarray)",
    ".hdf": "HDF/HDF-EOS (use h5py, pyhdf, or xarray)",
    ".zip": "ZIP archive (extract first)",
    ".tar": "TAR archive (extract first)",
    ".gz": "GZIP compressed (may need extraction)",
    ".parquet": "Parquet (use pandas or pyarrow)",
    ".csv": "CSV (use pandas)",
    ".json": "JSON (use json or pandas)",
}
DOC_KEYWORDS = ["readme", "doc", "documentation", "guide", "info"]

SAMPLE_KEY = ["year", "fire", "in_fire_index"]
IMAGE_KEY = ["year", "fire", "obs_date"]

INVENTORY = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("fire", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)

#: One row per pixel. The image sides travel with every pixel (constant runs cost nothing in
#: Parquet), so cropping, padding and rotating need no join back to an image table.
PIXELS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("fire", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("r", T.IntegerType()),
        T.StructField("c", T.IntegerType()),
        T.StructField("bands", T.ArrayType(T.FloatType())),
    ]
)

#: Stored stacks also carry each image's position in its fire and the number of images there, as a
#: stacked file does by its time axis: which samples a pixel serves then follows without a join.
STACK_PIXELS = T.StructType(
    [
        *PIXELS.fields,
        T.StructField("day_index", T.LongType()),
        T.StructField("fire_days", T.LongType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField(name, T.DoubleType())
        for name in (
            "p_ignition",
            "log_burned_area",
            "burned_area",
            "hazard_score",
            "actual_ignition",
            "actual_burned_area",
            "actual_log_burned_area",
        )
    ]
)


def channel_names(only_base: bool = False) -> list[str]:
    """Names of the 23 source bands, or of the 40 channels after land-cover expansion."""
    if only_base:
        return list(BASE_BANDS)
    classes = [f"Land cover: {name}" for name in LAND_COVER]
    head, tail = BASE_BANDS[:LAND_COVER_BAND], BASE_BANDS[LAND_COVER_BAND + 1 :]
    return [*head, *classes, *tail, "Active fire (binary)"]
