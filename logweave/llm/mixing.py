"""Mixing sources to target weights by nested hash thresholds.

Every document has a place on its source's hash line. The words of a source
that a budget asks for are whole passes over the source plus the documents
below a threshold on that line, so that a larger budget only adds documents.
Words are summed by source and hash bucket; the bucket that holds a threshold
is refined, digit by digit, until it is one document. Documents are then
filtered by comparing their hash with their source's thresholds: nothing is
sorted. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.spans import costly
from ..storage import settle
from .columns import packed, unpacked

#: Bits of a digit, and digits of the hash of an id and of the hash below it.
DIGIT, _DIGITS = 12, 5
_BITS = DIGIT * _DIGITS
#: Sources whose thresholds are broadcast (some 100 bytes each); those of more
#: are joined, spread over so many shares of each source.
BROADCAST_SOURCES, SHARES = 50_000, 64

_KEY = ["_source", "_none"]


def word_count(text: Column) -> Column:
    """Number of runs other than of blanks (space, tab to carriage return);
    null has none. Each run becomes one letter, so that no list of words is
    made of a long text."""
    marked = F.regexp_replace(text.cast("string"), r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")),
                      F.lit(0)).cast("long")


def _units(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str,
           *more: Column) -> DataFrame:
    """Source, size and the two parts of the hash. Rows of one id are told apart
    by text and source, equal rows by their place in the input."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    source = F.col(source_col).cast("string")
    low = F.shiftrightunsigned(F.xxhash64(F.col(text_col).cast("string"), source), 4)
    place = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 4)
    mask = (1 << 2 * DIGIT) - 1
    return docs.select(
        *more, F.coalesce(source, F.lit("")).alias("_source"), source.isNull().alias("_none"),
        word_count(F.col(text_col)).alias("_size"),
        F.conv(F.substring(F.md5(F.concat(F.lit(seed), ident).cast("binary")), 1, _BITS // 4),
               16, 10).cast("long").alias("_h"),
        low.bitwiseAND(~mask).bitwiseOR(place.bitwiseAND(mask)).alias("_r"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``_rank``, the place by code point with null last. Sorted by range;
    a count for each partition goes to the driver."""
    spark = sources.sparkSession
    placed = settle(sources.orderBy("_none", "_source")
                    .withColumn("_part", F.spark_partition_id())
                    .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
                    "sources")
    before, rows = 0, []
    for r in sorted(placed.groupBy("_part").count().collect()):
        rows.append((r["_part"], before))
        before += r["count"]
    starts = spark.createDataFrame(rows, "_part int, _before long")
    return placed.join(F.broadcast(starts), "_part").withColumn(
        "_rank", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def _levels(sources: DataFrame, budgets: Sequence[float], most: int) -> list[float | None]:
    """For each budget, the words per weight at which capped targets add up to
    it; None where all sources are capped. Each round caps sources that exceed
    their cap and shares out the rest again; two sums a budget come back."""
    cap = F.col("_words") * most
    total = sources.agg(F.sum("_words")).first()[0] or 0
    level: list[float | None] = [0.0] * len(budgets)
    capped = [-1] * len(budgets)
    while True:
        over = [F.lit(True) if v is None else cap < F.col("_weight") * v for v in level]
        sums = sources.agg(*[x for i, o in enumerate(over) for x in (
            F.sum(F.when(o, cap).otherwise(0)).alias(f"c{i}"),
            F.sum(F.when(o, 0).otherwise(F.col("_weight"))).alias(f"w{i}"),
            F.count(F.when(o, 1)).alias(f"n{i}"))]).first()
        now = [sums[f"n{i}"] for i in range(len(budgets))]
        if now == capped:
            return level
        capped = now
        level = [(b * total - float(sums[f"c{i}"])) / float(sums[f"w{i}"])
                 if sums[f"w{i}"] else None for i, b in enumerate(budgets)]


def _prefix(level: int, h: str, r: str) -> list[Column]:
    """What the rows of a bucket have in common before digit ``level``."""
    if level <= _DIGITS:
        return [F.shiftright(h, _BITS - DIGIT * level)]
    return [F.col(h), F.shiftright(r, _BITS - DIGIT * (level - _DIGITS))]


def _thresholds(units: DataFrame, goals: DataFrame) -> DataFrame:
    """``_source, _none, _budget, _h_cut, _r_cut``: the documents below the cut
    have as nearly the goal's words as whole documents can.

    ``goals`` has ``_goal`` for each source and budget, above 0 and below the
    words of the source.
    """
    units = units.where("_size > 0")
    done, at = [], goals.select(
        *_KEY, "_budget", F.col("_goal"), F.lit(0).cast("long").alias("_below"),
        F.lit(0).cast("long").alias("_ph"), F.lit(0).cast("long").alias("_pr"))
    for level in range(2 * _DIGITS):
        digit = F.shiftright("_h" if level < _DIGITS else "_r",
                             _BITS - DIGIT * (level % _DIGITS + 1)).bitwiseAND((1 << DIGIT) - 1)
        names = [f"_p{i}" for i in range(len(_prefix(level, "_h", "_r")))]
        sought = at.select("*", *[c.alias(n) for c, n in
                                  zip(_prefix(level, "_ph", "_pr"), names, strict=True)])
        rows = units.select(*_KEY, "_size", digit.alias("_d"), *[
            c.alias(n) for c, n in zip(_prefix(level, "_h", "_r"), names, strict=True)])
        if level:                     # only the rows of buckets that hold a cut
            rows = rows.join(sought.select(*_KEY, *names).distinct(), [*_KEY, *names],
                             "left_semi")
        sums = rows.groupBy(*_KEY, *names, "_d").agg(
            F.sum("_size").alias("_here"), F.count(F.lit(1)).alias("_rows"))
        # At most 4096 digits below a prefix.
        before = F.sum("_here").over(Window.partitionBy(*_KEY, *names).orderBy("_d")) \
            - F.col("_here")
        held = sums.withColumn("_before", before).join(sought, [*_KEY, *names]).withColumn(
            "_lower", F.col("_below") + F.col("_before")).where(
            (F.col("_lower") < F.col("_goal")) & (F.col("_goal") <= F.col("_lower")
                                                  + F.col("_here")))
        last = level == 2 * _DIGITS - 1
        step = 1 << (_BITS - DIGIT * (level % _DIGITS + 1))
        # Words on either side of the goal decide whether the last one is taken.
        digit = F.col("_d") + F.when(F.col("_final") & (
            F.col("_lower") + F.col("_here") / 2 < F.col("_goal")), 1).otherwise(0)
        held = held.withColumn("_final", (F.col("_rows") == 1) | F.lit(last))
        high, low = F.col("_ph"), F.col("_pr")
        if level < _DIGITS:
            high = high + digit * step
        else:
            low = low + digit * step
        held = settle(held.select(*_KEY, "_budget", "_goal", F.col("_lower").alias("_below"),
                                  high.alias("_ph"), low.alias("_pr"), "_final"), "cuts")
        done.append(held.where("_final"))
        at = held.where("NOT _final").drop("_final")
        if at.isEmpty():
            break
    return reduce(DataFrame.union, done).select(
        *_KEY, "_budget", F.col("_ph").alias("_h_cut"), F.col("_pr").alias("_r_cut"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1),
                budgets: Sequence[float] = (1.0,), max_repeats: int = 3,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: str = "") -> DataFrame:
    """All rows and columns, with ``size`` (words), ``source_size`` (words of the
    row's source), ``target`` (words that the last budget asks of the source),
    ``copies`` (how often the mix takes the row), ``taken`` (size times copies)
    and ``taken_by_budget`` (the same for every budget). Input columns of these
    names are replaced.

    Sources in code-point order, null last, weigh ``weights``, repeating. A budget
    is a share of all words and is shared out by weight; a source gives at most
    ``max_repeats`` times its words, and what it can't give goes to the others by
    weight. A source's taken words differ from its target by at most half a
    document. Budgets ascend, and a larger one takes at least the copies that a
    smaller one takes. The choice depends on ids, texts, sources and ``seed``
    only; rows that repeat all three are told apart by their place, which decides
    nothing but which of the equal rows is taken.

    A null or empty text has size 0 and is taken 0 words, whatever its copies; a
    null id is an id of its own; an empty table gives no rows.
    """
    if not budgets or list(budgets) != sorted(budgets) or not 0 < budgets[-1] <= max_repeats:
        raise ValueError("budgets ascend, above 0 and at most max_repeats")
    if costly(docs):                  # both passes must see the same places
        docs = settle(docs, "to-mix")
    units = settle(_units(docs, id_col, text_col, source_col, seed), "mix-units")
    sources = _ranked(units.groupBy(*_KEY).agg(F.sum("_size").alias("_words")))
    sources = settle(sources.withColumn("_weight", F.get(
        F.array(*[F.lit(float(w)) for w in weights]),
        F.pmod("_rank", F.lit(len(weights))).cast("int"))), "weighed")
    cap = (F.col("_words") * max_repeats).cast("double")
    shares = [cap if v is None else F.least(cap, F.col("_weight") * v)
              for v in _levels(sources, budgets, max_repeats)]
    per_budget = sources.select(*_KEY, "_words", F.posexplode(F.array(*shares)).alias(
        "_budget", "_target")).withColumn("_passes", F.when(F.col("_words") > 0, F.floor(
            F.col("_target") / F.col("_words"))).otherwise(0).cast("int")).withColumn(
        "_goal", F.col("_target") - F.col("_passes") * F.col("_words"))
    cuts = _thresholds(units, per_budget.where("_goal > 0 AND _words > 0"))
    plan = per_budget.join(cuts, [*_KEY, "_budget"], "left").groupBy(*_KEY, "_words").agg(
        F.array_sort(F.collect_list(F.struct("_budget", "_target", "_passes", "_h_cut",
                                             "_r_cut"))).alias("_plan"))   # a row a budget
    plan = settle(plan, "mix-plan")

    rows = _units(docs, id_col, text_col, source_col, seed, packed(docs).alias("_row"))
    on = list(_KEY)
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    else:                             # a source's rows meet its plan in many tasks
        rows = rows.withColumn("_share", F.pmod("_h", F.lit(SHARES)))
        plan = plan.withColumn("_share", F.explode(F.sequence(
            F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))))
        on.append("_share")
    copies = F.transform("_plan", lambda b: b["_passes"] + F.when(
        (F.col("_h") < b["_h_cut"]) | ((F.col("_h") == b["_h_cut"])
                                       & (F.col("_r") < b["_r_cut"])), 1).otherwise(0))
    added = ["size", "source_size", "target", "copies", "taken", "taken_by_budget"]
    results = [
        F.col("_size"), F.col("_words"), F.element_at("_plan", -1)["_target"],
        F.element_at("_copies", -1), F.element_at("_copies", -1) * F.col("_size"),
        F.transform("_copies", lambda c: c * F.col("_size"))]
    # In a struct first: beside a user's column of the same name, a lambda would
    # take that one.
    placed = rows.join(plan, on).withColumn("_copies", copies).select("_row", F.struct(
        *[c.alias(n) for c, n in zip(results, added, strict=True)]).alias("_added"))
    return placed.select(*unpacked("_row", docs.columns, added), *unpacked("_added", added))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mixed corpus itself: every row as often as the mix takes it."""
    return mixed.where("copies > 0").withColumn("copies", F.explode(F.sequence(
        F.lit(1), F.col("copies"))))
