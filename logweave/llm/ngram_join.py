"""Near-duplicate join on word n-grams: MinHash LSH forest, exact verification.

Documents with equal n-gram sets form a class; only classes are compared. A
class has a signature of ``trees`` labels, each of up to ``DEEPEST`` MinHash
values. A tree is the trie of its labels: classes that share the first ``depth``
values of a label lie under one node. Links are looked for below the nodes of
all trees and verified on the exact sets. The search begins at the deepest
prefix that reaches the target recall for links at the very threshold. After
verification the recall is estimated from the links found (each counts as the
inverse of its chance to be found), and the prefix is shortened if the estimate
falls short of the target. As links above the threshold have better chances, it
never did: in effect the depth is fixed by threshold, trees and target.

Nodes with few classes give pairs. Classes below larger nodes are dealt into
blocks of about ``BLOCK``; two blocks that meet below any node make a tile,
which one task verifies by a blocked matrix product and which returns sums and
a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle
from . import textual
from .columns import free_name
from .components import components

#: Values in a tree's label.
DEEPEST = 5
#: Largest node whose classes are paired directly, and classes in a block.
SMALL_NODE, BLOCK = 32, 256
#: Columns of a tile's incidence matrix that are held at once.
_COLUMNS = 8192
_U = np.uint64


def _rates(trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the MinHash functions."""
    seeds = textual.mix(np.arange(1, 2 * trees * DEEPEST + 1, dtype=_U))
    return seeds[::2] | _U(1), seeds[1::2]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The set of a document's n-grams, sorted; a shorter document that has a
    word is one n-gram, and one without words has none."""
    if 0 < len(hashes) < size:
        return textual.windows(hashes, len(hashes))
    return np.unique(textual.windows(hashes, size))


def _digest(grams: np.ndarray) -> bytes:
    again = textual.mix(grams ^ _U(0xA5A5A5A5A5A5A5A5))
    return np.array([grams.sum(dtype=_U), again.sum(dtype=_U)], _U).tobytes()


def _minima(grams: np.ndarray, rates) -> np.ndarray:
    out = np.full(len(rates[0]), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(grams), 4096):
        part = grams[at:at + 4096, None] * rates[0] + rates[1]
        np.minimum(out, (part >> _U(32)).astype(np.uint32).min(axis=0), out=out)
    return out


def _sets(batches, size: int):
    """``(columns, row, n-grams)`` of the texts of Arrow batches."""
    for batch in textual.small(batches):
        texts = batch.column("text").to_pylist()
        for first, last in textual.batches(texts):
            words = textual.words_of(texts[first:last])
            at = textual.bounds(words.text, last - first)
            for i in range(last - first):
                yield batch, first + i, shingles(words.hashes[at[i]:at[i + 1]], size)


def _signed(size: int, trees: int):
    schema = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("key", pa.binary()),
                        ("n", pa.int32()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rates, rows = _rates(trees), []
        for batch, i, grams in _sets(batches, size):
            rows.append((batch.column("id")[i].as_py(), batch.column("th")[i].as_py(),
                         _digest(grams) if len(grams) else None, len(grams),
                         _minima(grams, rates).tobytes() if len(grams) else None))
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                                                    schema.types, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types,
                                                strict=True)], schema=schema)
    return run


def _stored_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, grams in _sets(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(grams)]), pa.array([grams.tobytes()])], ["key", "grams"])
    return run


def _nodes(trees: int, depth: int):
    """Rows ``node, key, n`` of every tree for classes ``key, n, sig``."""
    schema = pa.schema([("node", pa.int64()), ("key", pa.binary()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = np.arange(trees, dtype=_U)
        for batch in textual.small(batches):
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32)
            label = sig.reshape(-1, trees, DEEPEST).astype(_U)
            node = textual.mix(tree + _U(1)) * np.ones((len(label), 1), _U)
            for k in range(depth):
                node = textual.mix(node ^ label[:, :, k])
            for at in range(0, len(label), 4096):
                part = node[at:at + 4096]
                rows = pa.array(np.repeat(np.arange(at, at + len(part)), trees))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.reshape(-1).view(np.int64)),
                     batch.column("key").take(rows), batch.column("n").take(rows)],
                    schema=schema)
    return run


_FOUND = "a binary, b binary, wa bigint, wb bigint, links bigint, expected double"


def _chance(jaccard, depth: int, trees: int):
    return 1 - (1 - jaccard ** depth) ** trees


def _verified_pairs(threshold: float, depth: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textual.small(batches):
            keep, chances = [], []
            for i, (x, y) in enumerate(zip(batch.column("ga"), batch.column("gb"),
                                           strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                jaccard = both / (len(x) + len(y) - both)
                if jaccard >= threshold:
                    keep.append(i)
                    chances.append(1 / _chance(jaccard, depth, trees))
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("a"), rows.column("b"), rows.column("sb"),
                 rows.column("sa"), pa.array([1] * len(keep), pa.int64()),
                 pa.array(chances, pa.float64())],
                ["a", "b", "wa", "wb", "links", "expected"])
    return run


def _common(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sorted sets."""
    values = np.unique(np.concatenate(rows))
    out = np.zeros((len(rows), len(columns)), np.float32)
    for at in range(0, len(values), _COLUMNS):
        part = values[at:at + _COLUMNS]
        sides = []
        for sets in (rows, columns):
            matrix = np.zeros((len(sets), len(part)), np.float32)
            for i, grams in enumerate(sets):
                grams = grams[np.searchsorted(grams, part[0]):
                              np.searchsorted(grams, part[-1], "right")]
                place = np.searchsorted(part, grams)
                matrix[i, place[part[np.minimum(place, len(part) - 1)] == grams]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out


def _verified_tile(threshold: float, depth: int, trees: int):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("key")
        one = tile["g1"].iloc[0] == tile["g2"].iloc[0]
        x = tile[tile["side"] == 0]
        y = x if one else tile[tile["side"] == 1]
        rows = []
        none = pd.DataFrame(rows, columns=["a", "b", "wa", "wb", "links", "expected"])
        if not len(x) or not len(y):
            return none
        gx, gy = ([np.frombuffer(v, _U) for v in side["grams"]] for side in (x, y))
        both = _common(gx, gy)
        sizes = np.array([len(v) for v in gx])[:, None] + np.array([len(v) for v in gy])
        jaccard = both / (sizes - both)
        linked = jaccard >= threshold - 1e-7
        # Whole numbers decide, as in a division in double precision.
        linked &= both.astype(np.float64) / (sizes - both.astype(np.float64)) >= threshold
        if one:
            np.fill_diagonal(linked, False)
        chances = 1 / _chance(np.maximum(jaccard, threshold), depth, trees)
        once = np.triu(linked, 1) if one else linked
        wx = linked @ y["size"].to_numpy(np.int64)
        kx, ky = x["key"].tolist(), y["key"].tolist()
        for i in np.flatnonzero(linked.any(axis=1)):
            rows.append((kx[i], None, int(wx[i]), 0, int(once[i].sum()),
                         float(chances[i][once[i]].sum())))
        if not one:
            wy = x["size"].to_numpy(np.int64) @ linked
            for j in np.flatnonzero(linked.any(axis=0)):
                rows.append((ky[j], None, int(wy[j]), 0, 0, 0.0))
        # A spanning forest of the tile's links, by breadth-first search.
        seen_x, seen_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
        for start in range(len(x)):
            if seen_x[start]:
                continue
            seen_x[start], queue = True, [(0, start)]
            if one:
                seen_y[start] = True
            while queue:
                side, i = queue.pop()
                near = linked[i] & ~seen_y if side == 0 else linked[:, i] & ~seen_x
                for j in np.flatnonzero(near):
                    rows.append((kx[i], ky[j], 0, 0, 0, 0.0) if side == 0
                                else (kx[j], ky[i], 0, 0, 0, 0.0))
                    if one:
                        seen_x[j] = seen_y[j] = True
                        queue.append((0, int(j)))
                    elif side == 0:
                        seen_y[j] = True
                        queue.append((1, int(j)))
                    else:
                        seen_x[j] = True
                        queue.append((0, int(j)))
        return pd.DataFrame(rows, columns=none.columns)
    return run


def start_depth(threshold: float, trees: int, target: float) -> int:
    """The deepest prefix that finds a link at the threshold with the target's
    chance."""
    for depth in range(DEEPEST, 1, -1):
        if _chance(threshold, depth, trees) >= target:
            return depth
    return 1


def _candidates(classes: DataFrame, trees: int, depth: int, threshold: float):
    """Pairs below small nodes, and tiles and blocks below large ones."""
    rows = classes.select("key", "n", "sig").mapInArrow(
        _nodes(trees, depth), "node bigint, key binary, n int")
    counts = rows.groupBy("node").agg(F.count("*").alias("held")).where("held > 1")
    rows = settle(rows.join(counts, "node"), "nodes")
    few, many = rows.where(F.col("held") <= SMALL_NODE), rows.where(
        F.col("held") > SMALL_NODE)
    # A class of large nodes lies in one block, a share of the largest of them:
    # a group of near copies has one or a few such homes, so few blocks meet.
    homes = settle(many.groupBy("key").agg(F.max(F.struct("held", "node")).alias("home"))
                   .select("key", "home.node"), "homes")
    sizes = homes.groupBy("node").agg(F.count("*").alias("lives"))
    blocks = settle(homes.join(sizes, "node").select("key", F.xxhash64("node", F.pmod(
        F.xxhash64("key"), F.ceil(F.col("lives") / BLOCK))).alias("g")), "blocks")
    met = many.join(blocks, "key").select("node", "g").distinct()
    tiles = settle(met.select("node", F.col("g").alias("g1")).join(
        met.select("node", F.col("g").alias("g2")), "node").where("g1 <= g2")
        .select("g1", "g2").distinct(), "tiles")
    close = (F.least("n", "m") >= threshold * F.greatest("n", "m") - 1e-6)
    pairs = (few.select("node", F.col("key").alias("a"), "n").join(
        few.select("node", F.col("key").alias("b"), F.col("n").alias("m")), "node")
        .where((F.col("a") < F.col("b")) & close).select("a", "b").distinct())
    # Pairs of classes whose blocks make a tile are left to the tile.
    placed = (pairs.join(blocks.toDF("a", "ga"), "a", "left")
              .join(blocks.toDF("b", "gb"), "b", "left")
              .select("a", "b", F.least("ga", "gb").alias("g1"),
                      F.greatest("ga", "gb").alias("g2"),
                      (F.col("ga").isNotNull() & F.col("gb").isNotNull()).alias("hot")))
    pairs = placed.where("not hot").select("a", "b").union(
        placed.where("hot").join(tiles, ["g1", "g2"], "left_anti").select("a", "b"))
    return pairs, tiles, blocks


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = 5, threshold: float = 0.8, trees: int = 16,
                target: float = 0.999) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class, the classes, and the verified links.

    Returns ``(members, classes, found)``: members ``id, th, key`` (th: a hash
    of the text; key: the class, null without words), classes ``key, size, n``
    and found ``a, b, wa, wb``: documents that class a (b) gains as linked; b
    is null where a tile gives a sum, and the weights are 0 on its forest.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    signed = settle(texts.mapInArrow(
        _signed(size, trees), "id bigint, th bigint, key binary, n int, sig binary"),
        "signatures")
    members = signed.select("id", "th", "key")
    classes = settle(signed.where("key is not null").groupBy("key").agg(
        F.count("*").alias("size"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.min(F.struct("id", "th")).alias("one")), "classes")
    depth = start_depth(threshold, trees, target)
    while True:
        pairs, tiles, blocks = _candidates(classes, trees, depth, threshold)
        pairs = settle(pairs, "pairs")
        wanted = blocks.select("key").union(pairs.select(F.col("a"))).union(
            pairs.select(F.col("b"))).distinct()
        from_text = classes.join(wanted, "key", "left_semi").select(
            F.col("one.id").alias("id"), F.col("one.th").alias("th"))
        chosen = texts.withColumn("k", F.xxhash64("id", "th")).join(
            from_text.select(F.xxhash64("id", "th").alias("k")).distinct(), "k",
            "left_semi")
        grams = settle(chosen.select("text").mapInArrow(
            _stored_sets(size), "key binary, grams binary").groupBy("key").agg(
                F.first("grams").alias("grams")).join(
                    classes.select("key", "size"), "key"), "sets")
        side = grams.select("key", "grams", "size")
        alone = pairs.join(side.toDF("a", "ga", "sa"), "a").join(
            side.toDF("b", "gb", "sb"), "b").mapInArrow(
                _verified_pairs(threshold, depth, trees), _FOUND)
        sides = tiles.select("g1", "g2", F.col("g1").alias("g"), F.lit(0).alias("side")).union(
            tiles.where("g1 <> g2").select("g1", "g2", F.col("g2"), F.lit(1)))
        tiled = sides.join(blocks.join(side, "key"), "g").groupBy("g1", "g2").applyInPandas(
            _verified_tile(threshold, depth, trees), _FOUND)
        found = settle(alone.union(tiled), "links")
        seen = found.agg(F.sum("links").alias("n"), F.sum("expected").alias("all")).first()
        if depth == 1 or not seen["n"] or seen["n"] >= target * seen["all"]:
            return members, classes, found
        depth -= 1


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, group_id, kept``.

    ``class_id`` is the smallest id with the same n-gram set, ``n_links`` the
    number of other documents at Jaccard similarity ``threshold`` or more (equal
    sets included), ``group_id`` the smallest id reachable by links and ``kept``
    whether the document stands for its group. A document without any word
    (null, empty) links with nothing, is its own class and group and is kept.
    Ids need not be unique: of rows that share the id that stands for a group,
    those with the smallest text hash are kept; rows equal in id and text fare
    alike. A null id sorts last in its group and is reported as null. Other
    columns are ignored. Options: see :func:`ngram_links`.
    """
    members, classes, found = ngram_links(docs, id_col, text_col, **options)
    last = F.lit((1 << 63) - 1)
    order = F.struct(F.coalesce("id", last).alias("id"), "th")
    linked = found.select(F.col("a").alias("key"), F.col("wa").alias("w")).union(
        found.where("b is not null").select("b", "wb")).groupBy("key").agg(
            F.sum("w").alias("w"))
    groups = components(found.where("b is not null").select("a", "b"))
    firsts = members.where("key is not null").groupBy("key").agg(F.min(order).alias("one"))
    table = (classes.select("key", "size").join(firsts, "key")
             .join(linked, "key", "left")
             .join(groups.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("component", F.coalesce("component", "key")))
    heads = table.groupBy("component").agg(F.min("one").alias("head"))
    table = table.join(heads, "component").select(
        "key", "one", "head", (F.col("size") - 1 + F.coalesce("w", F.lit(0))).alias("n"))
    real = lambda c: F.when(F.col(c) != last, F.col(c))
    return members.join(table, "key", "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("one").isNull(), F.col("id")).otherwise(real("one.id")).alias("class_id"),
        F.coalesce("n", F.lit(0)).alias("n_links"),
        F.when(F.col("head").isNull(), F.col("id")).otherwise(real("head.id")).alias("group_id"),
        (F.col("head").isNull() | (order == F.col("head"))).alias("kept"), "th")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", **options) -> DataFrame:
    """The rows of one document of each group, with all their columns, whatever
    these are called. Rows that repeat both id and text leave as one. Documents
    without a word (null and empty texts) are groups of their own and stay; an empty
    table gives no rows."""
    tag = free_name(docs.columns, "kept")
    kept = ngram_join(docs, id_col, text_col, **options).where("kept").select(
        F.xxhash64("doc_id", "th").alias(tag)).distinct()
    tagged = docs.withColumn(tag, F.xxhash64(
        F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))))
    chosen = tagged.join(kept, tag, "left_semi")
    return chosen.dropDuplicates([tag]).select(*[F.col(f"`{c}`") for c in docs.columns])
