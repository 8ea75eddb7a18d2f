"""Global order without a single task: range cells, prefix sums, ordinals and leads.

A window over a whole table, or over one hot group, would put all of it into one task. Here the
keys are dealt into ranges once; every range is a cell that is summed on its own, and only the cell
totals (one row per cell and group) are accumulated in order. The number of cells follows the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

CELL = "_cell"
#: Rows (distinct keys) of one cell: what one task orders and sums.
CELL_ROWS = 250_000


def range_cells(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), cells: int | None = None, stored: bool = False
) -> DataFrame:
    """``df``, stored, with a cell number that never falls when the keys ``by + order`` grow.

    One pass over all groups: a cell may hold several small groups, and a large group fills several
    cells. A table of one cell's size is one cell as it stands.
    """
    df = df if stored else stage(df)
    cells = cells or -(-df.count() // CELL_ROWS)
    if cells <= 1:
        return df.withColumn(CELL, F.lit(0))
    return stage(df.repartitionByRange(cells, *by, *order).withColumn(CELL, F.spark_partition_id()))


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    measures: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    cells: int | None = None,
    cell: Column | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add ``upto_<m>``, the sum of ``m`` over all rows up to and including the row's key.

    ``df`` holds one row per ``by + order`` key (aggregate ties first, so a value shared by a third
    of the table is one row here). ``cell`` gives an order-preserving cell when the caller knows
    one; otherwise cells come from ``range_cells`` (the keys are stored unless ``stored`` says they
    are). With a given ``cell`` the input is read twice: pass a stored or cheap one. The cell stays
    as a column if ``df`` has it.
    """
    order, by = list(order), list(by)
    if cell is None and CELL not in df.columns:
        celled = range_cells(df, order, by, cells, stored)
    else:
        celled = df if cell is None else df.withColumn(CELL, cell)
    sort = [F.col(name).desc() if descending else F.col(name).asc() for name in order]
    inside = (
        Window.partitionBy(*by, CELL)
        .orderBy(*sort)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = celled.select(
        "*", *[F.sum(m).over(inside).alias(f"_in_{m}") for m in measures]
    )

    # One row per cell: at most `cells` rows per group reach the accumulating window.
    totals = celled.groupBy(*by, CELL).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    cell_order = F.col(CELL).desc() if descending else F.col(CELL).asc()
    earlier = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy(cell_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *by,
        CELL,
        *[F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures],
    )
    return local.join(offsets, [*by, CELL]).select(
        *df.columns,
        *[(F.col(f"_in_{m}") + F.col(f"_o_{m}")).alias(f"upto_{m}") for m in measures],
    )


def with_next(
    celled: DataFrame, order: Sequence[str], columns: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``next_<c>``, the value of each column in the next row of the group's order, NULL at the end.

    ``celled`` comes from ``range_cells``. Rows look ahead inside their cell; the last row of a cell
    is given the first row of the next cell with rows of its group, found among the cells' ends.
    """
    order, by = list(order), list(by)
    sort = [F.col(name).desc() if descending else F.col(name).asc() for name in order]
    ahead = F.lead(F.struct(*columns)).over(Window.partitionBy(*by, CELL).orderBy(*sort))
    first = (F.max_by if descending else F.min_by)(F.struct(*columns), F.struct(*order))
    ends = celled.groupBy(*by, CELL).agg(first.alias("_first"))
    cell_order = F.col(CELL).desc() if descending else F.col(CELL).asc()
    later = F.lead("_first").over(Window.partitionBy(*(by or [F.lit(0)])).orderBy(cell_order))
    ends = ends.select(*by, CELL, later.alias("_later"))
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*by, CELL]]
    found = celled.withColumn("_ahead", ahead).alias("r").join(ends.alias("e"), same, "left")
    value = F.coalesce("_ahead", "_later")
    return found.select(*[F.col(f"r.{c}") for c in celled.columns], *[value[c].alias(f"next_{c}") for c in columns])


def group_ordinal(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    cell: Column,
    name: str,
) -> DataFrame:
    """Zero-based position of each row in its group, ``order`` being unique within the group.

    ``cell`` splits a group in order (the calendar day for images), so a fire that holds a third
    of all images is numbered by many tasks.
    """
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = prefix_sums(one, order, ["_one"], by=group, cell=cell)
    return numbered.select(
        *[c for c in df.columns if c != name], (F.col("upto__one") - 1).cast("bigint").alias(name)
    )


def ordinal_chunks(
    df: DataFrame, group: Sequence[str], ordinal: str, reach: int, chunk: int = 1024
) -> tuple[DataFrame, Window]:
    """Prepare looking ahead up to ``reach`` rows inside chunks of bounded size.

    Each group is cut into chunks of ``chunk`` consecutive rows; the first ``reach`` rows of a
    chunk are lent to the chunk before. Rows with ``_lent`` are only to be looked at, and must be
    dropped after the window. Returns the frame and the window partitioned by chunk.
    """
    chunk = max(chunk, reach)
    own = F.floor(F.col(ordinal) / chunk).cast("bigint")
    lend = (F.col(ordinal) % chunk < reach) & (F.col(ordinal) >= chunk)
    spread = df.withColumn(
        "_chunk", F.explode(F.when(lend, F.array(own, own - 1)).otherwise(F.array(own)))
    ).withColumn("_lent", F.col("_chunk") != own)
    return spread, Window.partitionBy(*group, "_chunk").orderBy(ordinal)


def lead_by_ordinal(
    df: DataFrame,
    group: Sequence[str],
    ordinal: str,
    steps: int,
    columns: dict[str, str],
) -> DataFrame:
    """Add ``{new: source}`` columns holding the value ``steps`` rows later in the group."""
    spread, window = ordinal_chunks(df, group, ordinal, steps)
    led = spread.select(
        "*", *[F.lead(source, steps).over(window).alias(new) for new, source in columns.items()]
    )
    return led.where(~F.col("_lent")).drop("_chunk", "_lent")
