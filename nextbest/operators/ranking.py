"""Row positions inside groups without sending a group to one task.

``Window.partitionBy(g).orderBy(v)`` puts every row of a group into one task;
with a group holding a third of the data that task does a third of the work.
Here the rows are range-partitioned on ``(group, order)`` instead, so a big
group spans many partitions.  Each task numbers its rows; a small table of
per-partition block sizes (at most partitions x groups-per-partition rows)
gives every block its offset.

Exact medians (interpolated, as pandas ``median``) and lower medians
(``percentile_disc(0.5)``), per group or global, never rank whole groups:

* a mergeable quantile sketch brackets the middle of every group;
* a second pass counts what lies below and collapses the copies inside;
* the counts tell whether the bracket holds the middle.  Where it doesn't, the
  side that does is bracketed anew, so a sketch that misses costs a pass, never
  a wrong or missing median;
* a bracket of more than ``ORDERED_ROWS`` values is cut at further quantiles,
  the pieces are counted, and only those with the middle go on, until what one
  task puts in order is below that number, whatever the size of the group.

Values are compared in their own type: whole numbers beyond 2^53, decimals and
timestamps are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextbest.operators.joins import join_small
from nextbest.session import ensure_checkpoint_dir


def _sort_key(c: str | Column, nulls_last: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_last() if nulls_last else col.asc_nulls_first()


def positions(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
              pos: str = "pos", nulls_last: bool = False,
              partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered by ``order_cols``.

    Without ``weight`` ties get distinct consecutive positions in an unspecified
    order.  With ``weight`` (a count column) ``pos`` is the cumulative weight up to
    and including the row, so a row of weight ``w`` covers positions
    ``pos - w + 1 .. pos``; pre-aggregating copies into one weighted row keeps a
    value repeated a billion times from landing in one range partition.
    """
    groups = list(group_cols or [])
    keys = [_sort_key(c, nulls_last) for c in groups + order_cols]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else \
        df.repartitionByRange(*keys)
    s = (ranged.sortWithinPartitions(*keys)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__i", F.monotonically_increasing_id()))
    # Partition ids and row ids must be read back exactly as numbered: a
    # recomputation may split partitions differently (AQE), and the cache is not
    # matched for plans with nondeterministic columns.  A reliable checkpoint in
    # the cluster's checkpoint folder fixes them and survives executor loss.
    ensure_checkpoint_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    w = F.col(weight) if weight else F.lit(1)
    s = s.withColumn("__key", group_key(groups))  # never null, so null groups join too
    blocks = s.groupBy("__pid", "__key").agg(F.min("__i").alias("__i0"),
                                             F.sum(w).alias("__n"))
    before = Window.partitionBy("__key").orderBy("__pid").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    if weight:
        # running weight inside one (partition, group) block: bounded by a partition
        run = Window.partitionBy("__pid", "__key").orderBy("__i").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        s = s.withColumn("__local", F.sum(w).over(run))
    else:
        s = s.withColumn("__local", F.col("__i") + 1)
    out = join_small(s, blocks.select("__pid", "__key", "__i0", "__off"), ["__pid", "__key"],
                     salt_by=["__i"])
    local = F.col("__local") if weight else F.col("__local") - F.col("__i0")
    return (out.withColumn(pos, (local + F.col("__off")).cast("bigint"))
            .drop("__pid", "__key", "__i", "__i0", "__off", "__local"))


def group_key(groups: list[str]) -> Column:
    """One text that is different for different groups and never null."""
    return F.to_json(F.struct(*groups)) if groups else F.lit("")


# The sketch's ranks are off by at most n / SKETCH_ACCURACY; the bracket allows
# for several times that on either side.
SKETCH_ACCURACY = 10_000
_MARGIN = 5 / SKETCH_ACCURACY
#: Distinct values of one group that a single task may put in order.
ORDERED_ROWS = 100_000
#: Pieces into which a larger bracket is cut, and grid steps of a missed side.
_PIECES = 64
_STEPS = 100

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def as_number(c: str, dtype: str) -> Column:
    """A numeric, date or timestamp column as a number in its order, without loss; text is refused.

    Whole numbers, dates (days) and timestamps (microseconds) become longs,
    floats doubles (NaN: null); decimals stay.
    """
    if dtype == "date":
        return F.unix_date(c).cast("bigint")
    if dtype.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if dtype in _WHOLE:
        return F.col(c).cast("bigint")
    if dtype.startswith("decimal"):
        return F.col(c)
    if dtype in ("float", "double"):
        return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    raise TypeError(f"{c} is {dtype}; a median needs numbers or dates (see numeric_coerce)")


def from_number(c: Column, dtype: str) -> Column:
    """Back from ``as_number``."""
    if dtype == "date":
        return F.date_from_unix_date(c.cast("int"))
    if dtype.startswith("timestamp"):
        return F.timestamp_micros(c.cast("bigint")).cast(dtype)
    return c.cast(dtype)


def halfway(low: str, high: str, dtype: str) -> Column:
    """The mean of two ``as_number`` values of a ``dtype`` column: decimal for longs and decimals."""
    if dtype == "bigint":
        return (F.col(low).cast("decimal(20,0)") + F.col(high).cast("decimal(20,0)")) \
            / F.lit(2).cast("decimal(1,0)")
    if dtype.startswith("decimal"):
        return (F.col(low) + F.col(high)) / F.lit(2).cast("decimal(1,0)")
    return (F.col(low) + F.col(high)) / 2


def _kept(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def middle(df: DataFrame, groups: list[str], key: str, extra: list[Column] | None = None,
           nulls_counted: bool = False) -> DataFrame:
    """``(groups..., n, low, high, extra...)``: the two middle values of ``key`` per group.

    ``key`` is an ``as_number`` column; nulls are ignored (``n`` counts the
    others), or with ``nulls_counted`` stand last and count.  ``low`` and
    ``high`` stand at positions floor((n + 1) / 2) and ceil((n + 1) / 2), null
    where a null stands there.  ``extra`` aggregates are computed in the first
    pass.  Reads ``df`` twice, and twice more for each bracket that misses.
    """
    names = list(groups)
    data = df.withColumn("__k", group_key(names))
    n = F.count(F.lit(1)) if nulls_counted else F.count(key)
    stats = _kept(data.groupBy("__k", *names).agg(
        n.alias("n"), F.count(key).alias("__m"),
        F.percentile_approx(key, [0.5 - _MARGIN, 0.5 + _MARGIN], SKETCH_ACCURACY).alias("__b"),
        *(extra or [])))
    first, second = F.floor((F.col("n") + 1) / 2), F.ceil((F.col("n") + 1) / 2)
    nothing = F.lit(None).cast(dict(df.dtypes)[key])
    asked = stats.where(first <= F.col("__m")).where("n > 0").select(
        "__k", first.alias("__r1"), F.least(second, F.col("__m")).alias("__r2"),
        F.col("__b")[0].alias("__from"), F.col("__b")[1].alias("__to"),
        nothing.alias("__above"), nothing.alias("__under"))
    values = data.where(F.col(key).isNotNull()).select("__k", F.col(key).alias("__v"))
    picks = _select(values, asked)
    return (stats.join(picks, "__k", "left")
            .withColumn("high", F.when(second <= F.col("__m"), F.col("high")))
            .drop("__k", "__b", "__m"))


def _region(values: DataFrame, asked: DataFrame) -> DataFrame:
    """The values of each group that lie between ``__above`` and ``__under`` (null: unbounded)."""
    v = F.col("__v")
    rows = join_small(values, asked.drop("__r1", "__r2"), ["__k"])
    return rows.where((F.col("__above").isNull() | (v > F.col("__above")))
                      & (F.col("__under").isNull() | (v < F.col("__under"))))


def _select(values: DataFrame, asked: DataFrame) -> DataFrame:
    """``(__k, low, high)``: the values at ranks ``__r1`` and ``__r2`` of each group's region."""
    found = None
    while True:
        # what lies below, inside (copies collapsed) and above the bracket
        v = F.col("__v")
        part = F.when(v < F.col("__from"), 0).when(v <= F.col("__to"), 1).otherwise(2)
        counted = _kept(_region(values, asked).select(
            "__k", "__v", part.alias("__part"), F.when(part == 1, v).alias("__in"))
            .groupBy("__k", "__part", "__in").agg(
                F.count(F.lit(1)).alias("__w"), F.max("__v").alias("__most"),
                F.min("__v").alias("__least")))
        below, inside, above = (F.col("__part") == p for p in range(3))
        seen = counted.groupBy("__k").agg(
            F.coalesce(F.sum(F.when(below, F.col("__w"))), F.lit(0)).alias("__offset"),
            F.coalesce(F.sum(F.when(inside, F.col("__w"))), F.lit(0)).alias("__inside"),
            F.count(F.when(inside, 1)).alias("__rows"),
            F.max(F.when(below, F.col("__most"))).alias("__top"),
            F.min(F.when(above, F.col("__least"))).alias("__bottom"))
        # the neighbours of the bracket serve too: only a rank beyond them is a miss
        past = F.col("__offset") + F.col("__inside") + 1
        judged = asked.join(seen, "__k").withColumn("__side", F.when(
            F.col("__r1") < F.col("__offset"), -1).when(F.col("__r2") > past, 1).otherwise(0))
        missed, largest = judged.agg(F.max(F.abs("__side")), F.max(F.when(
            F.col("__side") == 0, F.col("__rows")))).first()
        good = judged.where("__side = 0")
        held = counted.where(inside).select("__k", F.col("__in").alias("__v"), "__w")
        info = good.select("__k", "__r1", "__r2", "__offset", "__rows")
        if (largest or 0) > ORDERED_ROWS:
            held, info = _narrowed(held, info)
        upto = F.col("__offset") + F.sum("__w").over(Window.partitionBy("__k").orderBy(
            "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranked = held.join(info.drop("__rows"), "__k").withColumn("__upto", upto)

        def at(rank: str) -> Column:
            covers = (F.col("__upto") - F.col("__w") < F.col(rank)) & (F.col(rank) <= F.col("__upto"))
            return F.max(F.when(covers, F.col("__v")))

        def beside(pick: str, rank: str) -> Column:
            return F.coalesce(pick, F.when(F.col(rank) == F.col("__offset"), F.col("__top")),
                              F.when(F.col(rank) == past, F.col("__bottom")))

        picks = ranked.groupBy("__k").agg(at("__r1").alias("__low"), at("__r2").alias("__high"))
        now = good.join(picks, "__k", "left").select(
            "__k", beside("__low", "__r1").alias("low"), beside("__high", "__r2").alias("high"))
        found = now if found is None else found.unionByName(now)
        if not missed:
            return found
        asked = _kept(_asked_again(values, judged.where("__side <> 0")))


def _asked_again(values: DataFrame, missed: DataFrame) -> DataFrame:
    """New brackets, on a grid of quantiles, inside the side that holds the ranks.

    Sketches work in doubles.  Longs and decimals are sketched as differences to
    the value next to the bracket that missed, so each round tells values apart
    that looked alike from further away.
    """
    left, kind = F.col("__side") < 0, dict(values.dtypes)["__v"]
    gone = F.when(left, 0).otherwise(F.col("__offset") + F.col("__inside"))
    near = F.when(left, F.col("__top")).otherwise(F.col("__bottom"))
    sides = _kept(missed.select(
        "__k", (F.col("__r1") - gone).alias("__r1"), (F.col("__r2") - gone).alias("__r2"),
        F.when(left, F.col("__above")).otherwise(F.col("__to")).alias("__above"),
        F.when(left, F.col("__from")).otherwise(F.col("__under")).alias("__under"),
        (F.lit(0.0) if kind == "double" else near.cast("decimal(38,0)" if kind == "bigint" else kind))
        .alias("__near")))
    grid = _region(values, sides).groupBy("__k").agg(
        F.count(F.lit(1)).alias("__m"), F.percentile_approx(
            F.col("__v") - F.col("__near"), [i / _STEPS for i in range(_STEPS + 1)],
            SKETCH_ACCURACY).alias("__grid"))

    def step(rank: str, by: int) -> Column:
        at = F.floor(F.col(rank) / F.col("__m") * _STEPS).cast("int") + by
        return (F.col("__near") + F.get("__grid", F.greatest(F.lit(0), F.least(
            F.lit(_STEPS), at)))).cast(kind)

    return sides.join(grid, "__k").withColumns({
        "__from": step("__r1", -1), "__to": step("__r2", 2)}).drop("__m", "__grid", "__near")


def _narrowed(held: DataFrame, info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut the brackets of more than ``ORDERED_ROWS`` values until none is left.

    ``held`` (__k, __v, __w) has every value of a bracket once, ``info`` the
    ranks asked for and what lies before (__offset).  Every round keeps the one
    or two of ``_PIECES`` pieces that hold the ranks.
    """
    info = _kept(info)
    while (info.agg(F.max("__rows")).first()[0] or 0) > ORDERED_ROWS:
        large = F.col("__rows") > ORDERED_ROWS
        rows = join_small(held, info.where(large).drop("__rows"), ["__k"])
        grid = _kept(rows.groupBy("__k").agg(F.percentile_approx(
            "__v", [i / _PIECES for i in range(1, _PIECES)], SKETCH_ACCURACY).alias("__grid")))
        pieces = join_small(rows, grid, ["__k"]).withColumn("__piece", F.size(F.filter(
            "__grid", lambda x: x < F.col("__v")))).drop("__grid")
        sums = pieces.groupBy("__k", "__r1", "__r2", "__offset", "__piece").agg(
            F.sum("__w").alias("__w"), F.count(F.lit(1)).alias("__rows"))
        upto = F.col("__offset") + F.sum("__w").over(
            Window.partitionBy("__k").orderBy("__piece"))
        sums = sums.withColumn("__upto", upto).withColumn(
            "__before", F.col("__upto") - F.col("__w"))
        hit = _kept(sums.where((F.col("__upto") >= F.col("__r1"))
                               & (F.col("__before") < F.col("__r2"))))
        kept = join_small(pieces, hit.select("__k", "__piece"), ["__k", "__piece"])
        small = info.where(~large)
        held = _kept(join_small(held, small.select("__k"), ["__k"]).unionByName(
            kept.select("__k", "__v", "__w")))
        info = _kept(small.unionByName(hit.groupBy("__k", "__r1", "__r2").agg(
            F.min("__before").alias("__offset"), F.sum("__rows").alias("__rows"))))
    return held, info


def exact_median(df: DataFrame, value: str, group_cols: list[str] | None = None,
                 out: str = "median") -> DataFrame:
    """``(groups..., median)``: exact median of non-null values, interpolated.

    Groups without a value are left out; a null group is a group.  The median
    of longs and decimals is a decimal, of other numbers a double.
    """
    groups, dtype = list(group_cols or []), dict(df.dtypes)[value]
    data = df.select(*groups, as_number(value, dtype).alias("__key"))
    found = middle(data, groups, "__key").where(F.col("n") > 0)
    return found.select(*groups, halfway("low", "high", dtype).alias(out))


def lower_median(df: DataFrame, value: str, group_cols: list[str] | None = None,
                 nulls_counted: bool = False, out: str = "median") -> DataFrame:
    """``(groups..., median)``: the element at 0-based index ``floor((n - 1) / 2)``.

    Default: nulls ignored, as ``percentile_disc(0.5)``.  With
    ``nulls_counted`` the nulls sort last and count in ``n``, so the pick may be
    null (the positional rule of a pandas sort followed by ``median`` of the
    index).
    """
    groups, dtype = list(group_cols or []), dict(df.dtypes)[value]
    found = middle(df.select(*groups, as_number(value, dtype).alias("__key")), groups, "__key",
                   nulls_counted=nulls_counted).where(F.col("n") > 0)
    return found.select(*groups, from_number(F.col("low"), dtype).alias(out))
