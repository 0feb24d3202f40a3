"""Relational operators: fusion, precedence, as-of joins, islands, neighbours, ranking. All DataFrame operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def outer_with_indicator(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join with origin: both, left_only or right_only."""
    a, b = left.withColumn("_l", F.lit(1)), right.withColumn("_r", F.lit(1))
    j = a.join(b, on, "full_outer")
    origin = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both").when(F.col("_l").isNotNull(), "left_only").otherwise("right_only")
    return j.withColumn("origin", origin).drop("_l", "_r")


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order; ties need an order that decides them."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key, with their place; Spark cuts groups before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def preference(value: Column, order: Sequence[str]) -> Column:
    """The place of a value in a list of preferences, what is not listed last."""
    at = F.array_position(F.array(*[F.lit(v) for v in order]), value)
    return F.when(F.coalesce(at, F.lit(0)) > 0, at).otherwise(F.lit(len(order) + 1))


def fuse(sources: Mapping[str, DataFrame], keys: list[str], fields: Mapping[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """One row a key of any source; each field is taken from the first (source, column) that has it, with <field>_source.

    Sources should have one row a key (see keep_one); in_<source> tells where the key occurs.
    """
    out = None
    for name, df in sources.items():
        s = df.select(*keys, *[F.col(c).alias(f"_{name}__{c}") for c in df.columns if c not in keys], F.lit(True).alias(f"in_{name}"))
        out = s if out is None else out.join(s, keys, "full_outer")
    cols = [F.col(k) for k in keys]
    for field, ways in fields.items():
        refs = [(s, F.col(f"_{s}__{c}")) for s, c in ways]
        cols.append(F.coalesce(*[c for _, c in refs]).alias(field))
        src = F.when(refs[0][1].isNotNull(), refs[0][0])
        for s, c in refs[1:]:
            src = src.when(c.isNotNull(), s)
        cols.append(src.alias(f"{field}_source"))
    return out.select(*cols, *[F.coalesce(f"in_{s}", F.lit(False)).alias(f"in_{s}") for s in sources])


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, take: list[str], *, within: float | None = None, strict: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """left with, for each row, the columns of the latest right row of its key before it (or at the same place, unless strict).

    One sort of the union instead of a join on inequality. Rows farther away than within have nulls. order breaks ties among right rows.
    """
    place = F.struct(F.col(right_at).alias("_at"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_v_{c}") for c in take])
    r = right.select(*by, F.col(right_at).alias("_place"), F.lit(0 if not strict else 1).alias("_side"), place.alias("_seen"))
    l = left.withColumns({"_place": F.col(left_at), "_side": F.lit(1 if not strict else 0), "_seen": F.lit(None).cast(r.schema["_seen"].dataType)}).withColumn("_left", F.lit(True))
    u = l.unionByName(r.withColumn("_left", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy("_place", "_side", F.col("_seen").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_last", F.last("_seen", ignorenulls=True).over(w)).where("_left")
    near = F.lit(True) if within is None else (F.col("_place") - F.col("_last._at") <= within)
    cols = [F.when(near, F.col(f"_last._v_{c}")).alias(c if c not in left.columns else f"{c}_right") for c in take]
    return u.select(*left.columns, *cols)


def carry_forward(df: DataFrame, by: list[str], order: list[str], value: Column, name: str, *, inclusive: bool = True) -> DataFrame:
    """The last non-null value up to each row (or before it)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def interval_ends(df: DataFrame, by: list[str], start: str, end: str, default: Column | None = None) -> DataFrame:
    """Each row's end is the next row's start, the last one's the default."""
    nxt = F.lead(start).over(Window.partitionBy(*by).orderBy(start))
    return df.withColumn(end, nxt if default is None else F.coalesce(nxt, default))


def near_hit(df: DataFrame, by: list[str], order: str, hit: Column, width: int, name: str) -> DataFrame:
    """Whether the row or one of its neighbours at most width rows away is a hit."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-width, width)
    return df.withColumn(name, F.coalesce(F.max(hit).over(w), F.lit(False)))


def islands(df: DataFrame, by: list[str], order: str, gap: Column | float, name: str = "island") -> DataFrame:
    """Runs of rows whose neighbours are at most gap apart, numbered from 1 in each key."""
    w = Window.partitionBy(*by).orderBy(order)
    new = F.when(F.lag(order).over(w).isNull() | (F.col(order) - F.lag(order).over(w) > gap), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")


def round_robin(df: DataFrame, by: list[str], group: str, order: Sequence[Column], k: int) -> DataFrame:
    """k rows a key, one of each group in turn; groups in the order of their first rows."""
    w = Window.partitionBy(*by, group).orderBy(*order)
    n = df.withColumn("_turn", F.row_number().over(w))
    return n.withColumn("_pick", F.row_number().over(Window.partitionBy(*by).orderBy("_turn", *order))).where(F.col("_pick") <= k).withColumnRenamed("_pick", "pick").drop("_turn")


def transitions(df: DataFrame, by: list[str], period: str, state: str, step: int = 1) -> DataFrame:
    """from_state and to_state of keys in consecutive periods, with their number."""
    w = Window.partitionBy(*by).orderBy(period)
    p = df.withColumn("_p", F.lag(period).over(w)).withColumn("_s", F.lag(state).over(w)).where(F.col(period) - F.col("_p") == step)
    return p.groupBy(F.col("_s").alias("from_state"), F.col(state).alias("to_state")).agg(F.count(F.lit(1)).alias("n"))


def previous_stats(df: DataFrame, by: list[str], order: str, value: str, rows: int) -> DataFrame:
    """Mean and maximum of a value over so many rows before each row."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-rows, -1)
    return df.withColumns({"previous_mean": F.avg(value).over(w), "previous_max": F.max(value).over(w)})


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """Counts by rows and the listed values of columns, 0 where there are none."""
    out = df.groupBy(rows).agg(*[F.count_if(F.col(columns) == v).alias(f"{prefix}{v}") for v in values])
    return out


def crosstab_shares(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Each cell's count and share of its row."""
    c = df.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(rows)))


def debate_span(meetings: DataFrame, by: list[str], *, quiet: int = 8, least: int = 3, limit: int = 70) -> DataFrame:
    """The meetings of a debate: from a walk over numbered meetings (n, special, debate, autumn).

    The walk starts at the first autumn meeting and passes specials over; flagged meetings closer than quiet meetings form an island; the
    first island that is large enough, or the last whatever its size, spans first to last; at most limit meetings are looked at.
    """
    w = Window.partitionBy(*by).orderBy("n")
    started = F.max(F.col("autumn").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    walked = meetings.withColumn("_on", started).where("_on AND NOT special").withColumn("step", F.row_number().over(w)).where(F.col("step") <= limit).drop("_on")
    flagged = islands(walked.where("debate"), by, "step", quiet)
    sizes = flagged.groupBy(*by, "island").agg(F.count(F.lit(1)).alias("_size"), F.min("step").alias("_a"), F.max("step").alias("_b"))
    last = Window.partitionBy(*by)
    chosen = sizes.withColumn("_last", F.max("island").over(last)).where((F.col("_size") >= least) | (F.col("island") == F.col("_last")))
    chosen = keep_one(chosen, by, [F.col("island")]).select(*by, "_a", "_b")
    return walked.join(chosen, by).where("step BETWEEN _a AND _b").select(*by, "n", "debate")


def running_end(meetings: DataFrame, by: list[str], *, quiet: int = 3, under_way: int = 100, missing: int = 5) -> DataFrame:
    """Meetings (n, speeches, found) before the end: so many without speeches in a row once enough were made, or so many missing in a row."""
    w = Window.partitionBy(*by).orderBy("n")
    total = F.sum(F.coalesce("speeches", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    silent = F.sum(F.when(F.col("found") & (F.coalesce("speeches", F.lit(0)) == 0), 1).otherwise(0)).over(w.rowsBetween(-(quiet - 1), 0)) == quiet
    gone = F.sum(F.when(~F.col("found"), 1).otherwise(0)).over(w.rowsBetween(-(missing - 1), 0)) == missing
    m = meetings.withColumn("_stop", F.when((silent & (total >= under_way)) | gone, 1).otherwise(0))
    return m.withColumn("_stopped", F.sum("_stop").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_stopped = 0").drop("_stop", "_stopped")
