"""Exact global order without a one-task window.

``OVER (ORDER BY time)`` and a window over one hot key both put all their rows
into one task. Here the rows are range-partitioned on the full order (ties
included, so one key or one instant may span many partitions), written once,
and numbered by adding each partition's offset. Windows then run on fixed-size
blocks of positions, each led by copies of the rows its frames reach back to.

A table whose files already are ranges of the order needs neither sorting nor a copy
(``rolling_stored``): every file hands its last rows to the next one that has the key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.session import scratch_path

if TYPE_CHECKING:
    import pyarrow as pa

PART = "_part"
INDEX = "_index"
POSITION = "_position"
BLOCK = "_block"
CARRIED = "_carried"
TIE = "_tie"
SLICE = "_part_slice"
PLACE = "_place"

BLOCK_ROWS = 20_000
# About 250 MB of narrow rows per shuffled partition.
PARTITION_ROWS = 4_000_000
MAX_PARTITIONS = 100_000
# Rows times frame length that keep one task busy for about two seconds.
TASK_FRAME_ROWS = 2_000_000


def tie_columns(df: DataFrame, tie_break: Sequence[str] | None) -> list[str]:
    """Columns that order readings of the same instant; message coordinates by default."""
    if tie_break is not None:
        return list(tie_break)
    return [c for c in ("kafka_partition", "kafka_offset") if c in df.columns]


def partitions_for(df: DataFrame, rows: int, frame: int = 0) -> list[int]:
    """An explicit partition count for ``rows``, or none where the session's is right.

    Adaptive execution merges partitions by their bytes: it does not split large
    ones, and it would merge small ones whose long frames are much work.
    """
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-rows // PARTITION_ROWS)
    if needed > session:
        if needed > MAX_PARTITIONS:
            raise ValueError(f"{rows} rows need more than {MAX_PARTITIONS} partitions; raise PARTITION_ROWS")
        return [needed]
    busy = min(-(-rows * frame // TASK_FRAME_ROWS), session)
    return [busy] if busy > 1 else []


def staged_order(df: DataFrame, order_by: Sequence[str], rows: int = 0) -> DataFrame:
    """``df`` range-partitioned and sorted, with its partition and index in it.

    Range bounds are sampled, so a second evaluation could cut elsewhere; the
    rows are therefore written once to the shared folder and read from there.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "order")
    (
        df.repartitionByRange(*partitions_for(df, rows), *order_by)
        .sortWithinPartitions(*order_by)
        .drop(TIE)
        .withColumn(PART, F.spark_partition_id())
        # The low 33 bits count the rows of the partition, the bits above name it.
        .withColumn(INDEX, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def with_position(df: DataFrame, order_by: Sequence[str], rows: int = 0) -> DataFrame:
    """Adds the 0-based rank of every row in the total order ``order_by``."""
    staged = staged_order(df, order_by, rows)
    sizes = staged.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    # One row per written partition, however many rows the data has.
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    return (
        staged.join(F.broadcast(offsets), PART)
        .withColumn(POSITION, F.col("_offset") + F.col(INDEX))
        .drop(PART, INDEX, "_offset")
    )


def with_blocks(df: DataFrame, preceding: int, block_rows: int) -> DataFrame:
    """Splits positions into blocks and copies every row into the later blocks whose frames reach it."""
    if preceding < 1:
        raise ValueError("preceding must be at least 1")
    if block_rows < 1:
        raise ValueError("a block must hold at least one row")
    own, last = F.expr(f"{POSITION} div {block_rows}"), F.expr(f"({POSITION} + {preceding}) div {block_rows}")
    return df.select("*", F.posexplode(F.sequence(own, last)).alias("_copy", BLOCK)).withColumn(CARRIED, F.col("_copy") > 0).drop("_copy")


def rolling(
    df: DataFrame,
    order_by: Sequence[str],
    preceding: int,
    measures: Callable[[WindowSpec], dict[str, Column]],
    keys: Sequence[str] = (),
    block_rows: int | None = None,
    small_groups: bool = False,
) -> DataFrame:
    """Adds window ``measures`` whose frames reach at most ``preceding`` rows back.

    ``measures`` gets an ordered window and returns the new columns. ``order_by``
    should be unique within a key (see ``tie_columns``); rows it leaves tied are
    ordered by a hash of their values. The result equals a plain
    ``PARTITION BY keys ORDER BY order_by`` window, but no task holds a whole
    series. A caller that knows every series to fit into one task may say so with
    ``small_groups`` and gets the plain window, without the staged copy.
    """
    keys = list(keys)
    df = df.withColumn(TIE, F.xxhash64(*df.columns))
    if keys and small_groups:
        window = Window.partitionBy(*keys).orderBy(*order_by, TIE)
        return df.select("*", *[c.alias(name) for name, c in measures(window).items()]).drop(TIE)
    if block_rows is not None and block_rows < preceding:
        raise ValueError("a block must hold at least as many rows as a frame reaches back")
    total = df.count()
    block_rows = block_rows or max(BLOCK_ROWS, 20 * preceding)
    blocked = with_blocks(with_position(df, [*keys, *order_by, TIE], total), preceding, block_rows)
    wide = partitions_for(df, total, preceding)
    if wide:
        blocked = blocked.repartition(*wide, BLOCK)
    window = Window.partitionBy(BLOCK, *keys).orderBy(POSITION)
    measured = blocked.select("*", *[c.alias(name) for name, c in measures(window).items()])
    return measured.where(~F.col(CARRIED)).drop(BLOCK, CARRIED, POSITION)


def rolling_apply(
    df: DataFrame,
    order_by: Sequence[str],
    preceding: int,
    measure: Callable[[pa.Table], dict[str, pa.Array]],
    added: Sequence[T.StructField],
    block_rows: int | None = None,
) -> DataFrame:
    """``rolling`` over one series for what no window function can express.

    ``measure`` gets the rows of a block in order, led by those that its frames reach back to
    and the series has, and returns the columns ``added``, one value per row. It must carry
    its own imports, because executors need not have this package.
    """
    columns = df.columns
    block_rows = block_rows or max(BLOCK_ROWS, 20 * preceding)
    positions = with_position(df.withColumn(TIE, F.xxhash64(*columns)), [*order_by, TIE], df.count())
    names, position, carried = [f.name for f in added], POSITION, CARRIED
    target = T.StructType([*df.schema.fields, *added])

    def run(block):
        block = block.sort_by(position)
        measured = measure(block)
        for name in names:
            block = block.append_column(name, measured[name])
        own = block.filter([not was for was in block[carried].to_pylist()])
        return own.select([*columns, *names])

    return with_blocks(positions, preceding, block_rows).groupBy(BLOCK).applyInArrow(run, target)


def rolling_stored(
    df: DataFrame,
    order_by: Sequence[str],
    preceding: int,
    measures: Callable[[WindowSpec], dict[str, Column]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """``rolling`` for rows read from files that are disjoint ranges of ``order_by``, in the order
    of their paths, as ``tables.write_sorted`` and ``tables.compact`` write them.

    ``df`` must come from a scan through filters and projections only. Windows run on the rows
    of one key in one block of a file, led by the key's last rows before it: at most
    ``preceding`` rows per key and block are exchanged for that. Rows that ``order_by`` leaves
    tied are taken file by file, then by a hash of their values. Files whose last rows
    interleave are refused when the result is computed.
    """
    if preceding < 1:
        raise ValueError("preceding must be at least 1")
    keys, columns = list(keys), df.columns
    path, start = F.input_file_name(), F.input_file_block_start()
    rows = df.select("*", F.xxhash64(*columns).alias(TIE), F.xxhash64(path, start).alias(SLICE))

    # The last rows of every key in every block.
    named = rows.withColumn("_path", F.concat(path, F.lpad(start.cast("string"), 20, "0")))
    backward = Window.partitionBy(SLICE, *keys).orderBy(*[F.col(c).desc() for c in (*order_by, TIE)])
    last = named.withColumn("_from_end", F.row_number().over(backward)).where(F.col("_from_end") <= preceding)

    # One row per block (and key) with these; its neighbours before it hold the rows to carry.
    place = F.struct(*order_by, "_path", TIE)
    rising = "array_sort(collect_list(struct(_from_end, _row)), (a, b) -> b._from_end - a._from_end)"
    blocks = last.withColumn("_row", F.struct(*columns, TIE)).groupBy(SLICE, *keys).agg(
        F.min(place).alias("_first"), F.max(place).alias("_last"), F.expr(rising).alias("_edge"), F.count(F.lit(1)).alias("_n")
    )
    by_place = Window.partitionBy(*keys).orderBy("_first")
    before = F.coalesce(F.sum("_n").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    blocks = blocks.select("*", before.alias("_before"), F.lag("_last").over(by_place).alias("_left"))
    # A block has ``preceding`` rows here at most, so those that are needed begin within twice as many.
    near = Window.partitionBy(*keys).orderBy("_before").rangeBetween(-2 * preceding, -1)
    found = F.flatten(F.collect_list("_edge").over(near))["_row"]
    wrong = F.raise_error(F.lit("files are no disjoint ranges of the order; use rolling instead"))
    entered = blocks.select(SLICE, found.alias("_rows"), "_left", "_first").where(F.col("_left").isNotNull())
    entered = entered.withColumn("_rows", F.when(F.col("_left") > F.col("_first"), wrong.cast(entered.schema["_rows"].dataType)).otherwise(F.col("_rows")))
    kept = F.slice("_rows", F.greatest(F.size("_rows") - F.lit(preceding - 1), F.lit(1)), F.lit(preceding))
    lead = entered.select(SLICE, F.posexplode(kept).alias(PLACE, "_row")).select("_row.*", SLICE, PLACE)

    both = rows.withColumn(PLACE, F.lit(preceding)).unionByName(lead)
    window = Window.partitionBy(SLICE, *keys).orderBy(*order_by, PLACE, TIE)
    measured = both.select("*", *[c.alias(name) for name, c in measures(window).items()])
    return measured.where(F.col(PLACE) == preceding).drop(TIE, SLICE, PLACE)
