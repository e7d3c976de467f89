"""Exact Jaccard self-join of documents over word n-grams as a blocked sparse product.

The incidence matrix has a row per document and a column per n-gram. Its columns are
dealt out over the tasks; each block adds up, per pair of documents, the columns that
both have, and pairs whose sizes and counts cannot reach the similarity are discarded
before the counts of the blocks meet.

* Only the part of a row that a similar pair must share goes into the product: with one
  order of the columns for all rows, two sets of similarity 0.8 share a column among the
  first n - ceil(0.8 n) + 1 of each. Columns found often anywhere come last in that order.
* Rows with equal sets are one row of the matrix.
* Cells travel packed, some hundred thousand at a time: 32 bits of a column in its block of
  columns, and differences of row, size and place, compressed. Two columns that agree in those
  bits are one column, which can only add candidates.
* A column of at most ``FEW`` rows is multiplied out in its block; what a pair shares in all
  blocks and cannot share beyond the parts sent decides whether it is a candidate.
* A column with more rows is not multiplied out. Its rows are first compared with one row of the
  column only (a different one per round), which joins a group of copies to one class;
  then just pairs of rows in different classes are left, so that the classes are exact.
* Candidates are compared over their whole sets, each sent once to a block of candidates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import fresh, materialise
from opsignal.operators.components import connected_components

#: Columns put last in the order, by descending number of uses. Bounds the list sent to all tasks (1 MB).
COMMON = 131_072
#: n-grams counted together in a task before the single ones are dropped.
COUNTED = 2_000_000
#: Candidate documents (8 bytes each) up to which their list is broadcast.
LISTED = 500_000
#: Rows of a column that all others of it are compared with, turn by turn.
CENTERS = (1, 8, 32)
#: Rows of a column up to which all its pairs are listed.
FEW = 16
#: Cells packed together by a task, and cells of a block of columns.
PACKED = 1 << 19
#: Candidates whose sets are compared together.
COMPARED = 512


def _document_sets(column: pa.Array, size: int):
    """Sorted distinct n-gram hashes of each text."""
    for _, _, offsets, data in textbuf.pieces(column):
        words = textbuf.tokens(offsets, data, textbuf.SPACE, textbuf.LOWER_VALUES)
        for d in range(len(offsets) - 1):
            grams = textbuf.shingle_hashes(words.hashes[words.first[d] : words.first[d + 1]], size)
            yield np.unique(grams) if len(grams) > 1 else grams


def common_columns(docs: DataFrame, size: int, keep: int = COMMON) -> np.ndarray:
    """The most used n-grams, rarest first; only the order of columns depends on them.

    A task counts the n-grams of a few thousand documents at a time and passes on
    those that it met twice; the counts of all tasks are summed. Every document is counted.
    """

    def run(batches):
        def counted(parts):
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            often = n > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[often].view(np.int64)), pa.array(n[often])], names=["gram", "n"]
            )

        parts, waiting = [], 0
        for batch in batches:
            for grams in _document_sets(batch.column("text"), size):
                if waiting and waiting + len(grams) > COUNTED:
                    yield counted(parts)
                    parts, waiting = [], 0
                parts.append(grams)
                waiting += len(grams)
        if parts:
            yield counted(parts)

    found = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "gram").limit(keep)  # a bounded list for the order, nothing is dropped
    return top.toPandas()["gram"].to_numpy(np.int64)[::-1].view(np.uint64)


def incidence(docs: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """``doc_id, n, key, prefix``: set size, 128-bit hash of the set, and the columns to be joined."""
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def run(batches):
        columns, rank = shared.value
        for batch in batches:
            sizes, keys, prefixes = [], [], []
            for grams in _document_sets(batch.column("text"), size):
                n = len(grams)
                sizes.append(n)
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()))
                kept = n - -(-percent * n // 100) + 1 if n else 0
                if n and len(columns):
                    at = np.minimum(np.searchsorted(columns, grams), len(columns) - 1)
                    often = columns[at] == grams
                    last = grams[often][np.argsort(rank[at[often]])]
                    grams = np.concatenate((grams[~often], last))
                prefixes.append(grams[:kept])
            lengths = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *prefixes]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
                ],
                names=["doc_id", "n", "key", "prefix"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, key binary, prefix array<long>")


_ZSTD = "zstd"


def _squeezed(values: np.ndarray) -> bytes:
    return pa.compress(np.diff(values, prepend=0).astype(np.int64).tobytes(), _ZSTD, asbytes=True)


def _restored(data: bytes, cells: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(data, 8 * cells, _ZSTD, asbytes=True), np.int64))


def packed_cells(inc: DataFrame, bits: int) -> DataFrame:
    """The cells of ``inc`` (``row, n, prefix``) dealt into ``2 ** bits`` blocks of columns, a row per block and pack."""

    def packs(parts):
        grams = np.concatenate([p[0] for p in parts])
        row, n, pos = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        block = (grams >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
        by = np.argsort(block, kind="stable")
        column = (grams >> np.uint64(32 - bits)).astype(np.uint32)[by]
        row, n, pos, block = row[by], n[by], pos[by], block[by]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        ends = np.r_[first[1:], len(block)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[first], pa.int64()),
                pa.array(ends - first, pa.int64()),
                pa.array([column[x:y].tobytes() for x, y in zip(first, ends)], pa.binary()),
                *[pa.array([_squeezed(v[x:y]) for x, y in zip(first, ends)], pa.binary()) for v in (row, n, pos)],
            ],
            names=["block", "cells", "columns", "rows", "sizes", "places"],
        )

    def run(batches):
        parts, waiting = [], 0
        for batch in batches:
            prefix = batch.column("prefix")
            lengths = prefix.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            grams = prefix.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            starts = np.cumsum(lengths) - lengths
            parts.append((
                grams,
                *(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), lengths) for c in ("row", "n")),
                np.arange(len(grams)) - np.repeat(starts, lengths),
            ))
            waiting += len(grams)
            if waiting >= PACKED:
                yield packs(parts)
                parts, waiting = [], 0
        if waiting:
            yield packs(parts)

    kinds = "block long, cells long, columns binary, rows binary, sizes binary, places binary"
    return inc.select("row", "n", "prefix").mapInArrow(run, kinds)


def _met(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A block of columns: pairs with the number of its columns of at most ``FEW`` rows they share, and the cells of the others."""
    cells, block = pdf["cells"].to_numpy(), pdf["block"].iat[0]
    column = np.concatenate([np.frombuffer(c, np.uint32) for c in pdf["columns"]])
    by = np.argsort(column, kind="stable")
    column = column[by]
    new = np.r_[True, column[1:] != column[:-1]]
    rows = np.diff(np.r_[np.flatnonzero(new), len(column)])
    held = np.repeat(rows, rows)
    some = held > 1
    by, column, held = by[some], column[some], held[some]
    row, n, pos = (
        np.concatenate([np.zeros(0, np.int64), *(_restored(v, k) for v, k in zip(pdf[c], cells))])[by]
        for c in ("rows", "sizes", "places")
    )
    many = held > FEW
    large = pd.DataFrame({"gram": (block << 32) | column[many].astype(np.int64), "row": row[many], "n": n[many], "pos": pos[many]})
    column, row, n = column[~many], row[~many], n[~many]
    found = [np.zeros((0, 4), np.int64)]
    for d in range(1, FEW):
        i = np.flatnonzero(column[:-d] == column[d:])
        if not len(i):
            break
        i = i[100 * np.minimum(n[i], n[i + d]) >= percent * np.maximum(n[i], n[i + d])]
        a, b = np.where(row[i] < row[i + d], i, i + d), np.where(row[i] < row[i + d], i + d, i)
        found.append(np.stack((row[a], row[b], n[a], n[b]), 1))
    pairs = pd.DataFrame(np.concatenate(found), columns=["row", "row2", "n", "n2"])
    pairs = pairs[pairs["row"] != pairs["row2"]].groupby(["row", "row2", "n", "n2"]).size().reset_index(name="shared")
    return pd.concat([pairs, large], ignore_index=True).reindex(columns=["gram", "row", "row2", "n", "n2", "pos", "shared"]).astype("Int64")


def met_columns(inc: DataFrame, percent: int, cells: int) -> tuple[DataFrame, DataFrame]:
    """``row, row2, n, n2, shared`` of pairs that share columns of few rows, and ``gram, row, n, pos`` of columns of many.

    ``cells`` is their number, by which columns are dealt into blocks of about ``PACKED`` cells.
    """
    packs = packed_cells(inc, max(0, (cells // PACKED).bit_length()))
    kinds = "gram long, row long, row2 long, n long, n2 long, pos long, shared long"
    met = materialise(packs.groupBy("block").applyInPandas(lambda pdf: _met(pdf, percent), kinds), "met", "zstd")
    pairs = met.filter("gram IS NULL").groupBy("row", "row2", "n", "n2").agg(F.sum("shared").alias("shared"))
    return pairs, met.filter("gram IS NOT NULL").select("gram", "row", "n", "pos")


def _sets_sent(asked: DataFrame, size: int) -> DataFrame:
    """``home, row, grams``: the set of every row of ``asked`` (``text, row, key, homes``), once for each of its homes."""

    def sent(homes, rows, sets):
        return pa.RecordBatch.from_arrays(
            [pa.array(homes, pa.int64()), pa.array(rows, pa.int64()), pa.array(sets, pa.binary())], names=["home", "row", "grams"]
        )

    def run(batches):
        for batch in batches:
            homes, rows, sets, waiting = [], [], [], 0
            known = zip(*(batch.column(c).to_pylist() for c in ("row", "key", "homes")))
            for grams, (row, key, where) in zip(_document_sets(batch.column("text"), size), known):
                data = grams.tobytes()
                if xxhash.xxh3_128_digest(data) != key:  # another text of the same number
                    continue
                for home in where:
                    homes.append(home)
                    rows.append(row)
                    sets.append(data)
                    waiting += len(data)
                    if waiting >= textbuf.PIECE_BYTES:
                        yield sent(homes, rows, sets)
                        homes, rows, sets, waiting = [], [], [], 0
            if homes:
                yield sent(homes, rows, sets)

    return asked.select("text", "row", "key", "homes").mapInArrow(run, "home long, row long, grams binary")


def _required(a: str, b: str, percent: int) -> Column:
    """Least overlap: 100 * i >= percent * (a + b - i)."""
    return F.expr(f"CAST(ceil({percent} * ({a} + {b}) / {100 + percent}D - 1e-9) AS BIGINT)")


def _may_link(percent: int) -> Column:
    """Sizes fit, and the columns after the shared one are enough for the overlap."""
    fits = F.expr(f"100 * least(n, n2) >= {percent} * greatest(n, n2)")
    return fits & (F.expr("1 + least(n - pos, n2 - pos2) - 1") >= _required("n", "n2", percent))


def _candidates(pairs: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``met_columns`` that can reach the overlap.

    Of the row whose part ends first in the order all shared columns up to there are known, those of many rows
    apart; behind it are ceil(percent / 100 * n) - 1 more.
    """
    held = large.groupBy("row").agg(F.count("*").alias("large"))
    known = pairs.join(held, "row", "left").join(held.select(F.col("row").alias("row2"), F.col("large").alias("large2")), "row2", "left")
    others = F.coalesce(F.least(F.coalesce("large", F.lit(0)), F.coalesce("large2", F.lit(0))), F.lit(0))
    behind = F.expr(f"CAST(ceil({percent} * greatest(n, n2) / 100D - 1e-9) AS BIGINT) - 1")
    reach = F.col("shared") + others + behind
    return known.filter(reach >= _required("n", "n2", percent)).select("row", "row2", "n", "n2")


def _verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among ``pairs`` by the overlap of the whole sets, from a further pass over the texts.

    Pairs are dealt by ``row2``, which is the center in the turns with stars, so that its set is sent once.
    """
    homes = F.pmod(F.xxhash64("row2"), F.lit(-(-pairs.count() // COMPARED) or 1)).cast("long")
    pairs = pairs.withColumn("home", homes)
    ends = pairs.select(F.explode(F.array("row", "row2")).alias("row"), "home")
    asked = ends.groupBy("row").agg(F.collect_set("home").alias("homes"))
    asked = materialise(rows.join(asked, "row").select("row", F.col("doc_id").alias("number"), "key", "homes"), "asked")
    wanted = F.broadcast(asked) if asked.count() <= LISTED else asked
    sent = _sets_sent(docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["number"])), size)

    def compare(pairs: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        sets = {row: np.frombuffer(data, np.uint64) for row, data in zip(sent["row"], sent["grams"])}
        i = [
            len(np.intersect1d(sets[a], sets[b], assume_unique=True)) if a in sets and b in sets else 0
            for a, b in zip(pairs["row"], pairs["row2"])
        ]
        both = pairs["n"] + pairs["n2"] - np.array(i, np.int64)
        link = 100 * np.array(i, np.int64) >= percent * both
        return pd.DataFrame({"src": pairs["row"][link], "dst": pairs["row2"][link]})

    return pairs.groupBy("home").cogroup(sent.groupBy("home")).applyInPandas(compare, "src long, dst long")


def _open_pairs(cells: DataFrame, roots: DataFrame | None, percent: int, turn: int) -> DataFrame:
    """Candidate pairs of rows in different classes: stars in the first turns, then all that are left."""
    if roots is None:
        live = cells.withColumn("class", F.col("row"))
    else:
        live = cells.join(roots, F.col("row") == F.col("node"), "left").select(
            "gram", "row", "n", "pos", F.coalesce("root", "row").alias("class")
        )
    is_open = (F.min("class") < F.max("class")).alias("open")
    if turn < len(CENTERS):
        if turn:  # for columns of few rows, the last turn is no more work
            large = live.groupBy("gram").agg(F.count("*").alias("rows"), is_open)
            large = large.filter(F.col("open") & (F.col("rows") > 2 * CENTERS[turn])).select("gram")
            live = live.join(large, "gram", "left_semi")
        row = F.struct("row", "n", "pos", "class")
        centers = F.array_distinct(F.array(*[F.min_by(row, F.xxhash64("row", F.lit(k))) for k in range(CENTERS[turn])]))
        one = live.groupBy("gram").agg(centers.alias("centers"), is_open).filter("open")
        one = one.select("gram", F.explode("centers").alias("c")).select(
            "gram", *[F.col(f"c.{c}").alias(f"{c}2") for c in ("row", "n", "pos", "class")]
        )
        # a star sees only part of a pair's columns, so that their number bounds nothing
        pairs = live.join(one, "gram").filter("class <> class2").filter(_may_link(percent))
    else:
        left = live.groupBy("gram").agg(is_open).filter("open").select("gram")
        live = materialise(live.join(left, "gram", "left_semi"), "open")
        other = live.select("gram", *[F.col(c).alias(f"{c}2") for c in ("row", "n", "pos", "class")])
        pairs = live.join(other, "gram").filter("row < row2 AND class <> class2").filter(_may_link(percent))
    once = pairs.groupBy(
        F.least("row", "row2").alias("low"), F.greatest("row", "row2").alias("high"),
        F.expr("IF(row < row2, n, n2)").alias("n_low"), F.expr("IF(row < row2, n2, n)").alias("n_high"),
    ).agg(F.max(F.expr("row < row2")).alias("up"))
    return once.selectExpr(
        "IF(up, low, high) AS row", "IF(up, high, low) AS row2", "IF(up, n_low, n_high) AS n", "IF(up, n_high, n_low) AS n2"
    )


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` of rows in different classes."""
    one, two = (roots.select(F.col("node").alias(f"node{k}"), F.col("root").alias(f"root{k}")) for k in (1, 2))
    named = pairs.join(one, F.col("row") == F.col("node1"), "left").join(two, F.col("row2") == F.col("node2"), "left")
    return named.filter("coalesce(root1, row) <> coalesce(root2, row2)").select("row", "row2", "n", "n2")


def classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words at white space; a text's set holds its distinct
    runs of ``size`` words, or its whole sequence of words if it has fewer. Two documents link when
    100 * overlap >= percent * union; ``component_id`` is the smallest ``doc_id`` reachable by links.

    Null, empty and blank texts have an empty set (0) and link with nothing. Repeated rows and copies
    link. A null ``doc_id`` is kept; it never names a component of others. Further columns are not
    read. Empty table: no rows. Sets are compared by 64-bit hashes of their n-grams.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    inc = incidence(docs, size, percent, common_columns(docs, size))
    inc = materialise(inc.withColumn("row", F.monotonically_increasing_id()), "incidence")

    rows = inc.select("row", "doc_id", "n", "key").filter("n > 0")
    heads = rows.groupBy("key").agg(F.min("row").alias("head"), F.count("*").alias("copies"))
    copies = rows.join(heads.filter("copies > 1"), "key").filter("row <> head").select("row", "head")
    copies = materialise(copies, "copies")
    repeats = copies.select("row")
    if repeats.count() <= LISTED:
        repeats = F.broadcast(repeats)
    cells = inc.filter("n > 0").join(repeats, "row", "left_anti").select("row", "n", "prefix")
    n_cells = inc.agg(F.sum(F.expr(f"n - CAST(ceil({percent} * n / 100D) AS BIGINT) + 1"))).first()[0] or 0
    few, large = met_columns(cells, percent, n_cells)

    links, roots, done = None, None, None
    for turn in range(len(CENTERS) + 1):
        pairs = _open_pairs(large, roots, percent, turn)
        if turn == len(CENTERS):
            pairs = pairs.unionByName(_apart(_candidates(few, large, percent), roots)).dropDuplicates(["row", "row2"])
        if done is not None:
            pairs = pairs.join(done, F.expr("low = least(row, row2) AND high = greatest(row, row2)"), "left_anti")
        pairs = materialise(pairs, "pairs")
        if done is not None and pairs.isEmpty():
            continue
        seen = pairs.select(F.least("row", "row2").alias("low"), F.greatest("row", "row2").alias("high"))
        done = seen if done is None else done.unionByName(seen)
        found = materialise(_verified(docs, rows, pairs, size, percent), "links")
        links = found if links is None else links.unionByName(found)
        roots = connected_components(links)

    rows = rows.join(copies, "row", "left").select("doc_id", "n", F.coalesce("head", "row").alias("rep"))
    members = rows.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n", F.coalesce("root", "rep").alias("root")
    )
    least = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = members.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = inc.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of the smallest ``doc_id``, of each class.

    Of rows that repeat a ``doc_id``, the one of the least text hash stays. Rows with a null ``doc_id`` stay.
    """
    heads = classes(docs, size, percent).filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(heads, "doc_id", "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    nth = fresh("_nth", docs.columns)
    named = named.withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1)
    return named.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
