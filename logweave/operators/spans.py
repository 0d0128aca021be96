"""Splitting large groups into ordered spans.

A window over ``partitionBy(key)`` puts a whole key into one task. Where one
key may hold a third of all rows that task never ends, so the rows of groups
above a limit are range-partitioned by ``ord`` and cut into *spans* of at most
that many rows, which are processed on their own. What a span needs from the
rows before it is small and known: how many there are, and the last ``reach``
of them. These context rows are copied into the span, so the ordinary window
frames then give the exact result.

Where the ranges are cut only decides how evenly the work is spread. Any cut
gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import settle

#: Rows of one group that one task may take on.
ROWS_PER_SPAN = 1_000_000

#: Partitions of the exchange that sorts the large groups, at most; a partition
#: is cut into as many spans as its rows need.
_RANGES = 10_000

#: Bins of positions that the rows of one span would fill if they were evenly spread.
_BINS = 64

#: The span of a group that is not split.
WHOLE = -1


@dataclass(frozen=True)
class SpanPlan:
    """The rows to work on and, if any group is split, its spans.

    ``rows`` then has a column ``span``, and ``edges`` one row per span: the
    group, ``span``, the rows of the group ``before`` it and ``upto`` its end,
    and the ``first`` and ``last`` span of the group. ``workers`` bounds the tasks
    that work on the spans.
    """

    group: str
    rows: DataFrame
    edges: DataFrame | None = None
    workers: int | None = None

    def __bool__(self) -> bool:
        return self.edges is not None


#: Bits of a hash digit in the histograms that find large groups.
_DIGIT = 16


def large_groups(rows: DataFrame, group: str, limit: int,
                 weight: Column | None = None) -> DataFrame | None:
    """``group, rows`` for groups of more than ``limit`` rows, or None; with a
    ``weight``, whole numbers from 1 on, its sum stands for the number of rows.

    Rows are counted by a digit of the group's hash, so a task passes on at most
    65,536 counts, however many groups there are. A bucket holds at least the
    rows of each of its groups: none that is large is missed. The rows of buckets
    above the limit, usually none, are counted by a second digit, and then group
    by group.
    """
    def digit(at: int):
        return F.shiftrightunsigned(F.xxhash64(group), _DIGIT * at).bitwiseAND((1 << _DIGIT) - 1)

    heavy = F.count(F.lit(1)) if weight is None else F.sum("weight")
    rows = rows.select(group, (F.lit(1) if weight is None else weight).alias("weight"))
    names: list[str] = []
    for at in range(2):
        rows = rows.withColumn(f"digit{at}", digit(at))
        names.append(f"digit{at}")
        full = settle(rows.groupBy(*names).agg(heavy.alias("rows"))
                      .filter(F.col("rows") > limit).select(*names), "full-buckets")
        if full.isEmpty():
            return None
        rows = rows.join(full, names, "left_semi")
    found = settle(rows.groupBy(group).agg(heavy.alias("rows"))
                   .filter(F.col("rows") > limit), "large")
    return None if found.isEmpty() else found


def plan_spans(rows: DataFrame, group: str = "key", rows_per_span: int | None = None,
               bytes_per_span: int | None = None) -> SpanPlan:
    """Look for large groups and split them.

    With ``bytes_per_span``, which has the values' sizes read, groups of more value
    bytes are large too, and spans are cut by the running sum of the sizes: none
    has more rows or bytes than its limits, unless a single value has.

    Rows that take more than a scan to make are written to the shared folder
    first and counted there. The count reads the group column only. When no group
    is large, which is the usual case, nothing else happens. Otherwise the large
    groups are cut by the first number of the position, and all rows stay where they
    are. Where that number does not part them, or bytes count, the rows of the large
    groups are written in ranges.
    """
    limit = rows_per_span or ROWS_PER_SPAN
    if costly(rows):
        rows = settle(rows, "rows")
    weight = None
    if bytes_per_span:                # in rows: what of a span's bytes a value takes
        size = F.coalesce(F.octet_length(F.col("value").cast("string")), F.lit(0))
        weight = F.ceil((size + 1) * F.lit(limit / bytes_per_span)).cast("bigint")
        weight = F.greatest(weight, F.lit(1))
    large = large_groups(rows, group, limit, weight)
    if large is None:
        return SpanPlan(group, rows)
    found = large.agg(F.sum("rows")).first()[0]

    large = large.select(group)
    of_large = rows.join(large, group, "left_semi")
    if weight is None:
        split = _cut_by_position(of_large, group, limit)
        if split is not None:
            return _planned(rows, group, large, split)
    ranges = min(-(-found // limit), _RANGES)
    split = (of_large
             .repartitionByRange(ranges, group, "ord").sortWithinPartitions(group, "ord")
             .withColumn("place", F.monotonically_increasing_id()))
    # Partitions follow each other, and so do the rows of each.
    part = F.shiftright("place", 33) * (1 << 24)
    if weight is None:
        split = settle(split.withColumn("span", part + F.floor(
            F.col("place").bitwiseAND((1 << 33) - 1) / limit)).drop("place"), "spans")
    else:
        split = _cut_by_weight(settle(split.withColumn("weight", weight), "weighed"), part, limit)
    return _planned(rows, group, large, split)


def _planned(rows: DataFrame, group: str, large: DataFrame, split: DataFrame) -> SpanPlan:
    return SpanPlan(
        group,
        rows.join(large, group, "left_anti").withColumn(
            "span", F.lit(WHOLE).cast("bigint")).unionByName(split),
        edges_of(split, group))


def _cut_by_position(rows: DataFrame, group: str, limit: int) -> DataFrame | None:
    """Add ``span`` to the rows of large groups where they are, without an exchange.

    The first number of the position is cut into bins of one width, and the rows of
    each are counted: neighbouring bins make up spans of at most ``limit`` rows. None
    if a bin has more than half of that, as where first numbers repeat or crowd.
    """
    first = F.get("ord", F.lit(0))
    ends = settle(rows.groupBy(group).agg(
        F.min(first).alias("low"), F.max(first).alias("high"),
        (F.ceil(F.count(F.lit(1)) / limit) * _BINS).alias("bins")), "ends")
    if not ends.filter("low is null").isEmpty():
        return None
    width = F.col("high").cast("double") - F.col("low") + 1
    along = (F.coalesce(first, "low").cast("double") - F.col("low")) / width * F.col("bins")
    rows = rows.join(ends, group).withColumn("bin", F.floor(along)).drop("low", "high", "bins")
    counts = settle(rows.groupBy(group, "bin").agg(F.count(F.lit(1)).alias("rows")), "bins")
    half = max(limit // 2, 1)
    if not counts.filter(F.col("rows") > half).isEmpty():
        return None
    before = F.sum("rows").over(Window.partitionBy(group).orderBy("bin")) - F.col("rows")
    spans = settle(counts.select(group, "bin", F.floor(before / half).alias("span")), "cuts")
    return rows.join(spans, [group, "bin"]).drop("bin")


def _cut_by_weight(rows: DataFrame, part: Column, limit: int) -> DataFrame:
    """Add ``span`` to sorted rows by the weight of those before them. Weights are
    summed by blocks of neighbours, small enough that a span, cut where half the limit
    is full, does not exceed it."""
    heaviest = rows.agg(F.max("weight")).first()[0]
    bits = max((limit // 2 // heaviest).bit_length() - 1, 0)
    block = F.shiftright("place", min(bits, 10))
    sums = rows.groupBy(block.alias("block"), part.alias("part")).agg(
        F.sum("weight").alias("here"))
    before = F.sum("here").over(Window.partitionBy("part").orderBy("block")) - F.col("here")
    spans = settle(sums.select("block", (F.col("part") + F.floor(
        before / max(limit // 2, 1))).alias("span")), "blocks")
    return settle(rows.withColumn("block", block).join(spans, "block").drop(
        "block", "place", "weight"), "spans")


def edges_of(split: DataFrame, group: str) -> DataFrame:
    """Count the rows of each span of the large groups: a table of its own, as
    small as the spans are few."""
    along = Window.partitionBy(group).orderBy("span")
    whole = Window.partitionBy(group)
    upto = F.sum("rows").over(along.rowsBetween(Window.unboundedPreceding, 0))
    return settle(
        split.groupBy(group, "span").agg(F.count(F.lit(1)).alias("rows"))
        .select(group, "span", upto.alias("upto"), (upto - F.col("rows")).alias("before"),
                F.min("span").over(whole).alias("first"),
                F.max("span").over(whole).alias("last")), "edges")


def costly(rows: DataFrame) -> bool:
    """Is there more than a scan, filters and projections to repeat? What lies
    below a cached table is not repeated."""
    def look(node) -> bool:
        name = node.nodeName()
        if name == "InMemoryRelation":
            return False
        if name in _COSTLY or name.endswith("EvalPython") or name.startswith(_PYTHON):
            return True
        children = node.children()
        return any(look(children.apply(i)) for i in range(children.size()))

    return look(rows._jdf.queryExecution().optimizedPlan())


_COSTLY = {"Generate", "Window", "Aggregate", "Join", "Sort", "RepartitionByExpression"}
_PYTHON = ("MapIn", "FlatMap", "PythonMapIn", "AggregateInPandas", "WindowInPandas")


def in_first_span(rows: DataFrame, plan: SpanPlan) -> DataFrame:
    """Add ``span`` to rows that precede all others of their group."""
    first = plan.edges.filter("span = first").select(plan.group, "span")
    return rows.join(first, plan.group, "left").withColumn(
        "span", F.coalesce("span", F.lit(WHOLE)))


def in_all_spans(per_group: DataFrame, plan: SpanPlan) -> DataFrame:
    """Repeat one row per group for every span of its group, so that it joins
    to spanned rows on (group, span)."""
    spans = plan.edges.select(plan.group, "span")
    return per_group.join(spans, plan.group, "left").withColumn(
        "span", F.coalesce("span", F.lit(WHOLE)))


def _context(rows: DataFrame, plan: SpanPlan, order: list[str], reach: int,
             carried: bool) -> DataFrame:
    """The last ``reach`` rows before each span, with their number ``n0``.

    A row whose place in its group is ``m`` belongs to the spans that have at
    least ``m`` and less than ``m + reach`` rows before them. It meets them by
    those numbers divided by ``reach``, so a large group is spread over tasks.
    """
    group = plan.group
    split = rows.filter(F.col("span") != WHOLE)

    # Spark prunes to ``reach`` rows per span before it shuffles these.
    back = Window.partitionBy(group, "span").orderBy(
        *[F.col(c).desc() for c in order])
    tails = (split.withColumn("back", F.row_number().over(back))
             .filter(F.col("back") <= reach)
             .join(plan.edges.select(group, "span", "upto"), [group, "span"])
             .withColumn("m", F.col("upto") - F.col("back") + 1))
    n0 = F.col("m")
    if carried:
        seen = split.filter("n0 is not null").groupBy(group).agg(
            F.max("n0").alias("seen"))
        tails = tails.join(seen, group, "left")
        n0 = F.coalesce("n0", n0 + F.coalesce("seen", F.lit(0)))
    others = [c for c in rows.columns if c not in (group, "span", "n0")]
    bin_of = lambda c: F.floor(F.col(c) / reach)
    tails = tails.select(group, *others, n0.alias("n0"), "m", F.explode(F.array(
        bin_of("m"), bin_of("m") + 1)).alias("bin"))
    opens = plan.edges.filter("span <> first").select(
        group, "span", "before", bin_of("before").alias("bin"))
    return (tails.join(opens, [group, "bin"])
            .filter((F.col("before") >= F.col("m")) & (F.col("before") < F.col("m") + reach))
            .select(group, "span", *others, "n0"))


def numbered(rows: DataFrame, group: str, plan: SpanPlan | None = None,
             order: list[str] | None = None, reach: int = 1
             ) -> tuple[DataFrame, Window]:
    """Number the rows of each group from 1 in order, as column ``n``.

    ``rows`` may hold a column ``n0``: rows with a value there are context that
    already has its number, and fresh rows continue from it. Returns the rows,
    context included, and the window whose frames see at least ``reach`` rows
    back. Fresh rows are those with a null ``n0``.
    """
    order = order or ["ord"]
    carried = "n0" in rows.columns
    if not carried:
        rows = rows.withColumn("n0", F.lit(None).cast("bigint"))
    if plan:
        rows = rows.unionByName(_context(rows, plan, order, reach, carried))
        if plan.workers:
            rows = rows.repartition(plan.workers, group, "span")
        spec = Window.partitionBy(group, "span").orderBy(*order)
    else:
        spec = Window.partitionBy(group).orderBy(*order)
    n = F.row_number().over(spec).cast("bigint")
    if plan or carried:               # continue from the first row's number
        n = n - 1 + F.first(F.coalesce("n0", F.lit(1).cast("bigint"))).over(
            spec.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("n", n), spec
