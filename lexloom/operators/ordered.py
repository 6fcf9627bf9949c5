"""Order-dependent primitives that hold up when one key owns most of the rows.

A window over a key runs in one task. So the keys with more than ``HOT`` rows are cut into
chunks of their ordering column: each chunk is scanned on its own, the chunk totals (up to
thousands of times fewer rows) are scanned per key and joined back. All other keys are
scanned whole, by one shuffle. Picks of a first, last or best row are aggregates, which
combine before the shuffle.
"""

from functools import reduce

from pyspark.sql import Window, functions as F
from pyspark.sql.types import MapType

from lexloom.session import cut

CHUNK = 4096
HOT = 16 * CHUNK  # rows of a key that are scanned in one task, at most


def _on(keys, left="l", right="r"):
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _by_heat(df, keys, hot, sizes=None):
    """(rows of keys with at most ``hot`` rows, rows of the others).

    ``sizes`` holds the keys of at least those rows, where they are cheaper to count. There are fewer than rows / ``hot`` hot keys, which bounds the broadcast; without any the second frame is dropped
    from the plan at run time.
    """
    many = F.broadcast((df if sizes is None else sizes).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot).select(*keys))
    part = lambda how: df.alias("l").join(many.alias("r"), _on(keys), how).select(*[F.col(f"l.{c}") for c in df.columns])
    return part("left_anti"), part("left_semi")


def _both(whole, parts, keys):
    """The union of two frames.

    Spark 4.1 takes a union's parts for partitioned alike, even if AQE has dropped one and coalesced the others apart,
    which gives wrong rows. Keys that are expressions keep it from doing so.
    """
    return whole.select(*[F.least(c, c).alias(c) if c in keys else F.col(c) for c in whole.columns]).unionByName(parts)


def scan(df, keys, ord_col, sums=None, carries=None, leads=None, chunk=CHUNK, *, sizes=None):
    """Running sums, last-seen values and next values over ``keys`` ordered by ``ord_col``.

    ``ord_col`` is an integer, unique within the keys. ``sums`` adds up to and including
    the row; ``carries`` gives the last non-NULL value at or before the row; ``leads``
    gives the value of the next row. Each maps an output name to a column name. ``sizes``
    holds the keys of at least the rows of ``df``: read for their number, before any work on them.
    """
    sums, carries, leads = sums or {}, carries or {}, leads or {}
    cold, many = _by_heat(df, keys, chunk * (HOT // CHUNK), sizes)
    w = Window.partitionBy(*keys).orderBy(ord_col)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = cold.select(
        "*", *[(F.sum(c).over(upto) + F.lit(0)).alias(o) for o, c in sums.items()], *[F.last(c, ignorenulls=True).over(upto).alias(o) for o, c in carries.items()],
        *[F.lead(c).over(w).alias(o) for o, c in leads.items()])
    return _both(whole, _chunked_scan(many, keys, ord_col, sums, carries, leads, chunk), keys)


def _chunked_scan(df, keys, ord_col, sums, carries, leads, chunk):
    """``scan`` of keys in chunks."""
    cols = df.columns
    df = df.withColumn("_chunk", F.floor(F.col(ord_col) / chunk))
    ck = keys + ["_chunk"]
    here = Window.partitionBy(*ck).orderBy(ord_col)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    local = df.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_s_{o}") for o, c in sums.items()],
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_c_{o}") for o, c in carries.items()],
        *[F.lead(F.struct(c)).over(here).alias(f"_l_{o}") for o, c in leads.items()])
    totals = df.groupBy(*ck).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_ts_{o}") for o, c in sums.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ord_col))).alias(f"_tc_{o}") for o, c in carries.items()],
        *[F.min_by(F.struct(c), ord_col).alias(f"_tl_{o}") for o, c in leads.items()])
    per_key = Window.partitionBy(*keys).orderBy("_chunk")
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *ck,
        *[F.sum(f"_ts_{o}").over(before).alias(f"_os_{o}") for o in sums],
        *[F.last(f"_tc_{o}", ignorenulls=True).over(before).alias(f"_oc_{o}") for o in carries],
        *[F.lead(f"_tl_{o}").over(per_key).alias(f"_ol_{o}") for o in leads])
    out = local.alias("l").join(offsets.alias("r"), _on(ck), "left")
    return out.select(
        *[F.col(f"l.{c}") for c in cols],
        *[(F.col(f"_s_{o}") + F.coalesce(F.col(f"_os_{o}"), F.lit(0))).alias(o) for o in sums],
        *[F.coalesce(F.col(f"_c_{o}"), F.col(f"_oc_{o}")).alias(o) for o in carries],
        *[F.coalesce(F.col(f"_l_{o}"), F.col(f"_ol_{o}")).getField(c).alias(o) for o, c in leads.items()])


def split_row_number(df, keys, coarse, order, out="rn", hot=HOT):
    """``row_number`` over ``keys`` ordered by ``order``, keys of more than ``hot`` rows numbered in pieces.

    ``coarse`` lists expressions that never decrease along ``order``; rows that share them
    form the pieces. ``order`` must be total within the keys.
    """
    cold, many = _by_heat(df, keys, hot)
    whole = cold.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    return _both(whole, _pieced_row_number(many, keys, coarse, order, out), keys)


def _pieced_row_number(df, keys, coarse, order, out):
    """``split_row_number`` of keys in pieces."""
    cols, names = df.columns, [f"_g{i}" for i in range(len(coarse))]
    df = df.withColumns(dict(zip(names, coarse)))
    ck = keys + names
    sizes = df.groupBy(*ck).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*ck, F.sum("_n").over(before).alias("_before"))
    local = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*ck).orderBy(*order)))
    return (local.alias("l").join(offsets.alias("r"), _on(ck), "left")
            .select(*[F.col(f"l.{c}") for c in cols], (F.col("_rn") + F.coalesce("_before", F.lit(0))).cast("long").alias(out)))


def global_scan(df, order, sums, out_rank="rank"):
    """Rank and running sums over the whole table in one total order.

    Range partitions are written once, so their borders stay fixed; only one row of
    totals per partition is scanned in one place.
    """
    order = [F.expr(o) if isinstance(o, str) else o for o in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = fixed.select("*", F.count(F.lit(1)).over(w).alias("_r"),
                         *[F.sum(c).over(w).alias(f"_s_{o}") for o, c in sums.items()])
    totals = fixed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                       *[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_pid").alias("_opid"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_on"),
                            *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums])
    # one row per range partition, so the broadcast is bounded by the partition count
    return (local.join(F.broadcast(offsets), F.col("_pid") == F.col("_opid"))
            .select(*df.columns, (F.col("_r") + F.col("_on")).alias(out_rank),
                    *[(F.col(f"_s_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums]))


def first_row(df, keys, order, last=False):
    """One whole row per key: the first (or last) by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), rank)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_k(df, keys, order, k, rank="rank"):
    """Best ``k`` rows per key. Spark limits each key per input partition first
    (WindowGroupLimit), so at most k rows per key and partition are shuffled."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def lookup_join(df, table, key, own):
    """Left join on ``key`` = ``own``. Rows without a key, which all have one place in a plain join, are spread by their other columns."""
    place = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(4096)).cast("int")
    rest = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    df = df.withColumn("_place", F.when(F.col(key).isNotNull(), place(key)).otherwise(place(*rest)))
    table = table.withColumn("_own_place", place(own))
    return df.join(table, (F.col(key) == F.col(own)) & (F.col("_place") == F.col("_own_place")), "left").drop("_place", "_own_place")


def sorted_stream(df, keys, order, fn, schema):
    """Python over rows grouped by ``keys`` and sorted by ``order``, batch by batch.

    Every key lies in one partition, in order, so ``fn`` sees its rows one after another and
    keeps only the state it needs instead of whole groups.
    """
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(fn, schema)
