"""Histogram sort: exact byte counts find the splitters, one exchange sorts.

Rows are ordered by two 64-bit keys, a hash of the group (equal texts are
neighbours) and a hash that tells the rows of a group apart. The bytes below
candidate boundaries are counted exactly: every pass cuts each interval that
still holds a splitter into ``FAN`` probes and sums the bytes between them, until
each splitter lies within the tolerance or its interval is one key. The keys'
digits are walked from the group hash into the row hash, so a group that holds
a third of the data is cut as well. Shards are cut into parts for the exchange in
the same passes, to a looser tolerance, and the one exchange sends each row to the
part that the splitters give it. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import settle
from .columns import packed, unpacked

#: Bits of a digit; a pass has 2**DIGIT probes for each splitter.
DIGIT = 12
FAN = 1 << DIGIT
#: Digits of a key: 60 bits of the group hash, then 60 of the row hash.
_DIGITS = 5


def _digit(level: int) -> Column:
    name = "_g" if level < _DIGITS else "_r"
    return F.shiftright(name, 60 - DIGIT * (level % _DIGITS + 1)).bitwiseAND(FAN - 1)


def _hash60(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 4)


def _prefix(digits: tuple[int, ...]) -> tuple[int, int]:
    """The smallest key (group hash, row hash) that begins with the digits."""
    padded = (*digits, *[0] * (2 * _DIGITS - len(digits)))
    words = [0, 0]
    for i, d in enumerate(padded):
        words[i // _DIGITS] = words[i // _DIGITS] << DIGIT | d
    return words[0], words[1]


def splitters(keyed: DataFrame, parts: int, tolerance: float, within: int = 1,
              loose: float = 0.25) -> list[tuple[int, int]]:
    """``parts - 1`` keys; the bytes below the i-th differ from i shares of the
    total by at most ``tolerance`` shares, or by less than one key's rows. Where
    each ``within`` parts make a shard, that holds for the shards' borders and
    shares; those between may differ by ``loose`` of a part's share.

    ``keyed`` has ``_g, _r, _size``. Each pass brings ``FAN`` sums a splitter
    to the driver, whatever the number of rows.
    """
    found: dict[int, tuple[int, int]] = {}
    # The interval of every splitter that is still open, and the bytes below it.
    state: dict[int, tuple[tuple[int, ...], int]] = {i: ((), 0) for i in range(1, parts)}
    total = None
    for level in range(2 * _DIGITS):
        prefixes = sorted({digits for digits, _ in state.values()})
        rows = keyed
        if level:
            same = F.lit(False)
            tag = F.lit(None).cast("int")
            for k, digits in enumerate(prefixes):
                inside = F.lit(True)
                for at, d in enumerate(digits):
                    inside = inside & (_digit(at) == d)
                same, tag = same | inside, F.when(inside, k).otherwise(tag)
            rows = keyed.where(same).withColumn("_k", tag)
        else:
            rows = keyed.withColumn("_k", F.lit(0))
        sums: dict[int, dict[int, int]] = {}
        single: set[tuple[int, int]] = set()
        for r in rows.groupBy("_k", _digit(level).alias("_d")).agg(
                F.sum("_size").alias("_s"), F.count("*").alias("_n")).collect():
            sums.setdefault(r["_k"], {})[r["_d"]] = r["_s"]
            if r["_n"] == 1:
                single.add((r["_k"], r["_d"]))
        if total is None:
            total = sum(sums.get(0, {}).values())
        still = {}
        for i, (digits, below) in state.items():
            goal = total * i / parts
            for d in range(FAN):
                here = sums.get(prefixes.index(digits), {}).get(d, 0)
                if below + here >= goal or d == FAN - 1:
                    break
                below += here
            slack = total / parts * (tolerance * within if i % within == 0 else loose)
            if (prefixes.index(digits), d) in single:
                # One row is not divided: the splitter is on its nearer side.
                slack = max(slack, min(goal - below, below + here - goal))
            if goal - below <= slack or level == 2 * _DIGITS - 1:
                found[i] = _prefix((*digits, d))
            elif below + here - goal <= slack and d < FAN - 1:
                found[i] = _prefix((*digits, d + 1))
            else:
                still[i] = ((*digits, d), below)
        state = still
        if not state:
            break
    return [found[i] for i in range(1, parts)]


def histogram_shards(rows: DataFrame, size: Column, group: Column, row_key: Column,
                     shards: int = 8, tolerance: float = 0.001) -> DataFrame:
    """All rows and columns, with ``shard`` and ``slot``.

    ``size`` is a row's weight in bytes (null counts as 0), ``group`` the value
    whose rows are kept together and ``row_key`` what tells rows of a group
    apart; both may be null. The shards' bytes are equal up to the tolerance,
    a share of one shard, and one row. A group lies in one shard unless a
    splitter had to cut it. ``slot`` counts the rows of a shard from 0 without
    gaps, in key order. Rows that agree in both keys are told apart by their
    place in the input. An empty table gives no rows. Input columns named
    ``shard`` or ``slot`` are replaced; no other name clashes.
    """
    # The last digit tells repeated rows apart by their place in the input. The
    # table is written once, so that every pass sees the same keys.
    keyed = settle(rows.select(
        packed(rows).alias("_row"), F.coalesce(size.cast("long"), F.lit(0)).alias("_size"),
        _hash60(group).alias("_g"),
        _hash60(row_key).bitwiseAND(~(FAN - 1)).bitwiseOR(_hash60(
            F.monotonically_increasing_id()).bitwiseAND(FAN - 1)).alias("_r")), "sort-keys",
        compression="zstd")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    within = max(-(-partitions // shards), 1)
    cuts = splitters(keyed.select("_g", "_r", "_size"), shards * within, tolerance, within)
    # How many splitters a key has reached; they ascend.
    part = F.size(F.filter(F.array(*[F.struct(F.lit(g).alias("g"), F.lit(r).alias("r"))
                                     for g, r in cuts]),
                           lambda c: (F.col("_g") > c["g"]) | ((F.col("_g") == c["g"])
                                                               & (F.col("_r") >= c["r"]))))
    part = part if cuts else F.lit(0)
    sent = keyed.withColumn("_part", part).repartitionById(
        shards * within, "_part").sortWithinPartitions("_part", "_g", "_r")
    placed = settle(sent.select("_row", "_part", F.monotonically_increasing_id().bitwiseAND(
        (1 << 33) - 1).alias("_at")), "sorted", compression="zstd")
    # One row a part: where its rows begin, in the partition and in the shard.
    runs = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    shard = F.floor(F.col("_part") / within).cast("int")
    before = runs.select("_part", "_first", shard.alias("_shard"), (F.sum("_n").over(
        Window.partitionBy(shard).orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").select(
        *unpacked("_row", rows.columns, ("shard", "slot")), F.col("_shard").alias("shard"),
        (F.col("_at") - F.col("_first") + F.col("_before")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id",
                    text_col: str = "text", tolerance: float = 0.001) -> DataFrame:
    """Shard documents by the UTF-8 bytes of their text plus one (null: one); see
    :func:`histogram_shards`. Equal texts are neighbours, told apart by their ids;
    a very long text is one row and goes to one shard; null texts are a group."""
    text = F.col(f"`{text_col}`")
    return histogram_shards(
        docs, F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
        text.cast("string"), F.col(f"`{id_col}`"), shards, tolerance)
