"""Tag explosion, de-duplication, left enrichment, top-n."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import split_tags


def explode_tags(df: DataFrame, column: str, output: str, separator: str = ", ") -> DataFrame:
    """One row per tag. A NULL list gives no row: fill it first to keep the item."""
    return df.withColumn(output, F.explode(split_tags(column, separator)))


def _holds(data_type: T.DataType, *kinds: type) -> bool:
    if isinstance(data_type, kinds):
        return True
    if isinstance(data_type, T.StructType):
        return any(_holds(f.dataType, *kinds) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _holds(data_type.elementType, *kinds)
    return False


def dedup_by_key(
    df: DataFrame, keys: list[str], order_by: list[str] | None = None, keep: str = "first"
) -> DataFrame:
    """Keep one row per key: the first (or last) by ``order_by``, ties broken by the other columns.

    This is an aggregate, not a window, so every task reduces its own copies before the shuffle
    and a key that holds most of the table still reaches the reducer as one row per task. NULL
    keys form one group and NULL sorts first.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    leading = list(order_by or [])
    unsortable = {f.name for f in df.schema.fields if _holds(f.dataType, T.MapType, T.VariantType)}
    ranking = leading + [c for c in rest if c not in leading and c not in unsortable]
    if unsortable & set(rest):
        pick = F.min_by if keep == "first" else F.max_by
        best = pick(F.struct(*rest), F.struct(*ranking))
        wanted = rest
    else:
        # Key columns named in order_by are constant within the group: no need to carry them.
        wanted = [c for c in ranking if c not in keys]
        best = (F.min if keep == "first" else F.max)(F.struct(*wanted))
    return df.groupBy(*keys).agg(best.alias("_kept")).select(
        *[F.col(c) if c in keys else F.col("_kept").getField(c).alias(c) for c in df.columns]
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are equal in every column."""
    return df.distinct()


def drop_repeats(df: DataFrame, by: str, time: str, late: str = "1 day") -> DataFrame:
    """Rows with an id ``by`` that no earlier row has, bounded or streaming.

    A stream remembers ids until the watermark, ``late`` behind the latest ``time`` (a date or timestamp), has
    passed them, so its state does not grow with the stream; rows that come later than that are dropped, as
    their ids may be forgotten. A message that is sent or read twice changes nothing within that time. Rows
    without an id are repeats if they are equal in all columns.
    """
    same = F.coalesce(F.col(by).cast("string"), F.concat(F.lit("row "), F.xxhash64(*df.columns).cast("string")))
    marked = df.withColumn("_same", same)
    if not df.isStreaming:
        return dedup_by_key(marked, ["_same"]).drop("_same")
    timed = marked.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    return timed.dropDuplicatesWithinWatermark(["_same"]).drop("_same", "_time")


def _variable_bytes(column: Column, data_type: T.DataType) -> Column | None:
    """Bytes of a value beyond 16; None if every value of the type has a fixed size."""
    if isinstance(data_type, T.UserDefinedType):
        return _variable_bytes(F.unwrap_udt(column), data_type.sqlType())
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    if isinstance(data_type, T.VariantType):
        return F.octet_length(F.to_json(column))
    if isinstance(data_type, T.StructType):
        parts = [_variable_bytes(column.getField(f.name), f.dataType) for f in data_type.fields]
        parts = [F.coalesce(p.cast("bigint"), F.lit(0)) for p in parts if p is not None]
        return reduce(lambda a, b: a + b, parts, F.lit(16 * len(data_type.fields)).cast("bigint"))
    if isinstance(data_type, T.ArrayType):
        inner = _variable_bytes(F.lit(None).cast(data_type.elementType), data_type.elementType)
        if inner is None:
            return F.size(column) * 16
        each = lambda x: F.coalesce(_variable_bytes(x, data_type.elementType).cast("bigint"), F.lit(0)) + 16
        return F.aggregate(column, F.lit(0).cast("bigint"), lambda total, x: total + each(x))
    if isinstance(data_type, T.MapType):
        keys = _variable_bytes(F.map_keys(column), T.ArrayType(data_type.keyType))
        return keys + _variable_bytes(F.map_values(column), T.ArrayType(data_type.valueType))
    if isinstance(data_type, T.AtomicType) or isinstance(data_type, T.NullType):
        return None
    raise TypeError(f"{data_type.simpleString()} cannot be measured")


def measured_bytes(df: DataFrame) -> int | None:
    """Upper estimate of the size of ``df`` in memory: one aggregate pass, one number back. Vectors count by
    their stored entries, variants by their text. None if a column has a type that cannot be measured."""
    fixed, variable = 0, []
    for field in df.schema.fields:
        fixed += 16
        try:
            size = _variable_bytes(F.col(f"`{field.name}`"), field.dataType)
        except TypeError:
            return None
        if size is not None:
            variable.append(size)
    per_row = reduce(
        lambda a, b: a + b,
        [F.coalesce(v.cast("bigint"), F.lit(0)) for v in variable],
        F.lit(fixed).cast("bigint"),
    )
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def heavy_buckets(df: DataFrame, keys: list[str], buckets: int, slices: int) -> DataFrame:
    """Hash buckets of ``keys`` (NULL included) that hold more than one ``slices``-th of the rows,
    with the number of slices their rows fill: ``_bucket``, ``_fill``.

    One pass over the key columns, in which a task sends at most ``buckets`` small rows, however
    many keys there are. By counting there are fewer than ``slices`` heavy buckets.
    """
    counts = df.groupBy(_bucket(keys, buckets).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total")).scalar()
    return counts.where(F.col("_rows") * slices > total).select(
        "_bucket", F.ceil(F.col("_rows") * slices / total).cast("int").alias("_fill")
    )


def _row_hash(df: DataFrame, keys: list[str]) -> Column:
    """Spreads rows, equal rows of different tasks included, and is the same when a task is rerun.

    Only columns of a fixed size are read for it, texts if there are no others besides the keys.
    """
    rest = [f for f in df.schema.fields if f.name not in keys and not _holds(f.dataType, T.MapType, T.VariantType)]
    narrow = [f.name for f in rest if isinstance(f.dataType, T.AtomicType) and not _holds(f.dataType, T.StringType, T.BinaryType)]
    hashable = [f.name for f in rest if not isinstance(f.dataType, T.UserDefinedType)]
    return F.xxhash64(*keys, *(narrow or hashable), F.spark_partition_id())


def enrich_left(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    order_by: list[str] | None = None,
    suffix: str | None = None,
    unique: bool = False,
    broadcast_bytes: int = 64 << 20,
    slices: int | None = None,
) -> DataFrame:
    """Left join on equal keys after reducing ``right`` to one row per key (see ``dedup_by_key``;
    ``unique=True`` states that it already is). The key appears once; left rows without a match
    keep NULLs.

    Columns that both sides have besides the key are refused, or, with ``suffix``, renamed on the
    right.

    Runs jobs while the frame is built, as the data decide how the join runs. The right side is measured and broadcast if it is no larger
    than ``broadcast_bytes`` (0: do not measure, do not broadcast). Otherwise both sides are
    shuffled, after one counting pass over the left keys: left rows are cut into ``slices`` (default:
    two per shuffle partition) where their key, NULL included, holds more than one slice, and only
    the right rows of such keys' hash buckets are repeated - less than half the right side in
    the worst case, as there are four buckets and more to a slice.
    """
    spark = left.sparkSession
    keys = [on] if isinstance(on, str) else list(on)
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    if shared and suffix is None:
        raise ValueError(f"both sides have {shared}: rename them or give a suffix")
    if left.isStreaming or right.isStreaming:
        raise ValueError("this join counts both sides first and takes bounded frames only")
    size = measured_bytes(right) if broadcast_bytes > 0 else None
    small = size is not None and size <= broadcast_bytes
    if not unique:
        right = dedup_by_key(right, keys, order_by)
    right = right.withColumnsRenamed({c: c + suffix for c in shared}) if shared else right
    columns = left.columns + [c for c in right.columns if c not in keys]
    if small:
        return left.join(F.broadcast(right), keys, "left").select(*columns)

    slices = slices or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1024, 4 * slices)
    found = heavy_buckets(left, keys, buckets, slices)
    # Fewer than `slices` rows, so safe to collect and broadcast at any table size.
    heavy = found.collect()
    if not heavy:
        return left.join(right, keys, "left").select(*columns)
    heavy_df = F.broadcast(spark.createDataFrame(heavy, found.schema))

    def with_fill(df: DataFrame) -> DataFrame:
        bucketed = df.withColumn("_bucket", _bucket(keys, buckets))
        return bucketed.join(heavy_df, "_bucket", "left").fillna(1, ["_fill"])

    cut = with_fill(left.withColumn("_hash", _row_hash(left, keys))).select(
        *left.columns, F.pmod("_hash", "_fill").cast("int").alias("_slice")
    )
    repeated = with_fill(right).select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.col("_fill") - 1)).alias("_slice")
    )
    return cut.join(repeated, [*keys, "_slice"], "left").select(*columns)


def top_n(df: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """First ``n`` rows of an ordering; each task keeps only its own ``n`` best."""
    return df.orderBy(*order_by).limit(n)
