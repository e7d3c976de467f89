"""Similarity joins on distinct texts and on dense vectors, without an n x n matrix."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.rounding import from_units, pair_count, pair_product, to_units
from opsignal.operators.packed import (
    AT_ONCE,
    COLUMNS,
    has_terms,
    hashed_idf,
    hashed_terms,
    posting_products,
    similar_blocks,
    text_blocks,
    text_counts,
    text_lengths,
)
from opsignal.operators.tfidf import term_counts, text_vectors, unit_vectors
from opsignal.session import discard, materialise, new_path

_SLACK = 1e-9


#: Candidates scored together, on average; a group also holds the vectors they ask for.
PAIRS_PER_GROUP = 4096
#: Postings of a term that meet in one join key; a term with more is dealt into blocks.
POSTINGS_PER_KEY = 4096
#: Texts that a task holds twice, to multiply them with as many others.
TEXTS_PER_BLOCK = 8192
#: Rows of a block that are multiplied with as many others at once.
ROWS_AT_ONCE = 2048
#: Blocks that few rows are dealt into, so that several tasks share them.
LEAST_BLOCKS = 4
#: From this threshold on texts meet in their rare terms; below, they share so many of them that blocks are multiplied.
PREFIX_FROM = 0.5
#: Products of single postings formed at once, and columns of a dense part.
_AT_ONCE = AT_ONCE
_COLUMNS = COLUMNS
#: Ratio of the lengths at both ends of a band of postings.
_BAND = 1.1


def index_vectors(
    df: DataFrame, threshold: float, text_column: str = "preprocessed_text", prefix: bool = True
) -> DataFrame:
    """The written vectors of the distinct texts, each with a short number ``vid``.

    Without ``prefix`` they can be multiplied, but not met in their rare terms.
    """
    _above_zero(threshold)
    vectors = text_vectors(df, threshold, text_column) if prefix else unit_vectors(df, text_column)
    return materialise(vectors.withColumn("vid", F.monotonically_increasing_id()), "vectors", "zstd")


def prefix_index(vectors: DataFrame) -> DataFrame:
    """``(vid, id, w, upto, rest)``: one row per prefix term."""
    return vectors.select("vid", F.inline("prefix"))


def may_begin(threshold: float) -> Column:
    """Whether a shared term can be the first one of a similar pair, or follow it closely."""
    return F.col("upto_a") * F.col("upto_b") >= F.lit(threshold - _SLACK)


def reaches(threshold: float) -> Column:
    """Upper bound of the cosine against the threshold, from the shared terms met so far.

    Shared terms that were not met stand behind the last one that was.
    """
    bound = F.sum(F.col("w_a") * F.col("w_b")) + F.min(F.col("rest_a") * F.col("rest_b"))
    return bound >= F.lit(threshold - _SLACK)


def side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{c}_{name}") for c in df.columns))


def dealt_postings(index: DataFrame, threshold: float, per_key: int = POSTINGS_PER_KEY) -> DataFrame:
    """The index with ``i, j, own``: which two blocks of its term a row is compared in, and its own.

    A term with at most ``per_key`` postings is one block. The postings of a more frequent one
    are dealt into bands of like ``upto`` and each band into blocks of about ``per_key``; a row
    is sent to the pairs of its block with those blocks whose ``upto`` suffices for the
    threshold. Texts that consist mostly of rarer terms meet few others in a frequent one.
    """
    band = F.floor(-F.log("upto") / F.lit(math.log(_BAND))).cast("int")
    index = index.withColumn("band", F.greatest(band, F.lit(0)))
    frequent = index.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > per_key).select("id")
    frequent = materialise(frequent, "frequent")
    rare = index.join(frequent, "id", "left_anti").drop("band")
    zero = F.lit(0).cast("long")
    rare = rare.withColumns({"i": zero, "j": zero, "own": zero})
    # At most as many bands as the lengths from 1 down to the threshold make.
    sizes = (
        index.join(frequent, "id", "left_semi").groupBy("id", "band")
        .agg(F.ceil(F.count("*") / F.lit(per_key)).cast("int").alias("blocks"))
        .groupBy("id").agg(F.collect_list(F.struct("band", "blocks")).alias("bands"))
    )
    code = lambda band, block: band.cast("long") * F.lit(1 << 32) + block
    top = lambda band: F.pow(F.lit(_BAND), -band)
    hot = index.join(sizes, "id")
    mine = F.element_at(F.filter("bands", lambda b: b["band"] == F.col("band")), 1)["blocks"]
    hot = hot.withColumn("own", code(F.col("band"), F.pmod(F.xxhash64("vid"), mine)))
    near = F.filter("bands", lambda b: top(b["band"]) * top(F.col("band")) >= F.lit(threshold - 1e-6))
    others = F.flatten(F.transform(near, lambda b: F.transform(F.sequence(F.lit(0), b["blocks"] - 1), lambda k: code(b["band"], k))))
    hot = hot.withColumn("other", F.explode(others))
    hot = hot.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return rare.unionByName(hot.select(*rare.columns))


def meeting_postings(index: DataFrame, threshold: float, per_key: int = POSTINGS_PER_KEY) -> DataFrame:
    """Pairs of postings of one term, ``vid_a < vid_b``, that can belong to a similar pair."""
    dealt = dealt_postings(index, threshold, per_key)
    a, b = side(dealt, "a"), side(dealt, "b")
    at = (F.col("id_a") == F.col("id_b")) & (F.col("i_a") == F.col("i_b")) & (F.col("j_a") == F.col("j_b"))
    # In a pair of two blocks every pair of rows is met twice, from either side, as in one block.
    across = (F.col("i_a") == F.col("j_a")) | (F.col("own_a") != F.col("own_b"))
    return a.hint("merge").join(b, at & across & (F.col("vid_a") < F.col("vid_b")) & may_begin(threshold))


def _score_block(pairs: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
    """Dot products of sparse vectors: the terms of all first texts are looked up in the second ones at once."""
    ids = np.concatenate(vectors["ids"].to_numpy())
    ws = np.concatenate(vectors["ws"].to_numpy())
    size = vectors["ids"].map(len).to_numpy()
    first = np.concatenate(([0], np.cumsum(size)))
    _, term = np.unique(ids, return_inverse=True)
    row = np.repeat(np.arange(len(vectors)), size)
    stored = (row << 32) | term
    by = np.argsort(stored)
    stored, weight = stored[by], ws[by]
    number = pd.Series(np.arange(len(vectors)), index=vectors["vid"].to_numpy())
    a, b = (number.loc[pairs[c]].to_numpy() for c in ("vid_a", "vid_b"))
    a, b = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    out = np.zeros(len(pairs))
    for low in range(0, len(pairs), 1024):  # so many terms at a time as a thousand texts have
        x, y = a[low : low + 1024], b[low : low + 1024]
        n = size[x]
        start = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(start[-1]) + np.repeat(first[x] - start[:-1], n)
        wanted = (np.repeat(y, n) << 32) | term[at]
        found = np.minimum(np.searchsorted(stored, wanted), len(stored) - 1)
        product = np.where(stored[found] == wanted, ws[at] * weight[found], 0.0)
        out[low : low + 1024] = np.add.reduceat(product, start[:-1])
    return pd.DataFrame({"vid_a": pairs["vid_a"], "vid_b": pairs["vid_b"], "cosine": out})


def verify(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``(vid_a, vid_b, cosine)`` of distinct candidate pairs from ``threshold`` on (inclusive).

    Texts are dealt into so many blocks that about ``PAIRS_PER_GROUP`` candidates fall to a pair
    of blocks. They are scored together, and a vector travels once per block pair that asks for
    it, not once per candidate.
    """
    pairs = materialise(pairs.select("vid_a", "vid_b"), "asked")
    blocks = F.lit(max(1, math.isqrt(2 * pairs.count() // PAIRS_PER_GROUP)))

    def block(vid: str) -> Column:
        return F.pmod(F.xxhash64(vid), blocks)

    dealt = pairs.select("vid_a", "vid_b", F.least(block("vid_a"), block("vid_b")).alias("i"), F.greatest(block("vid_a"), block("vid_b")).alias("j"))
    ends = dealt.select(
        F.col("i").alias("p"), F.col("j").alias("q"), F.explode(F.array("vid_a", "vid_b")).alias("vid")
    ).distinct()
    sent = ends.join(vectors.select("vid", "ids", "ws"), "vid")
    scored = (
        dealt.groupBy("i", "j")
        .cogroup(sent.groupBy("p", "q"))
        .applyInPandas(_score_block, "vid_a bigint, vid_b bigint, cosine double")
    )
    return scored.filter(F.col("cosine") >= threshold)


def sparse_products(left: tuple[pd.Series, pd.Series], right: tuple[pd.Series, pd.Series]) -> np.ndarray:
    """Dot products of all left with all right sparse vectors, given as their ids and weights."""
    shape = len(left[0]), len(right[0])
    if not all(shape):
        return np.zeros(shape)
    ends = []
    for ids, ws in (left, right):
        row = np.repeat(np.arange(len(ids)), ids.map(len).to_numpy())
        ends.append((row, *(np.concatenate(x.to_numpy()) for x in (ids, ws))))
    return posting_products(ends, shape, _AT_ONCE, _COLUMNS)


def block_count(n: int, block_rows: int) -> int:
    """How many blocks ``n`` rows are dealt into: few, as a row travels to each, but not fewer than tasks can share."""
    return max(1, -(-n // block_rows), min(LEAST_BLOCKS, -(-n // ROWS_AT_ONCE)))


def strips(left: np.ndarray, right: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of pieces of two lists of rows, which bound the product formed at once."""
    for x in range(0, len(left), rows):
        for y in range(0, len(right), rows):
            yield left[x : x + rows], right[y : y + rows]


def block_pairs(vectors: DataFrame, threshold: float, columns: list[str], block_rows: int = TEXTS_PER_BLOCK) -> DataFrame:
    """``columns`` of both rows, named ``_a`` and ``_b``, and ``cosine`` of every pair of ``vectors`` from ``threshold`` on.

    Texts are dealt into blocks of about ``block_rows``; a task multiplies two blocks and only
    pairs that pass leave it. A vector travels once per block, whatever its terms.
    """
    blocks = F.lit(block_count(vectors.count(), block_rows))
    own = vectors.select(*columns, "ids", "ws", F.pmod(F.xxhash64("key"), blocks).cast("int").alias("own"))
    sent = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    sent = sent.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    piece = ROWS_AT_ONCE

    def multiply(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(parts, ignore_index=True)
        own, i, j = pdf["own"].to_numpy(), pdf["i"].iat[0], pdf["j"].iat[0]
        ids, ws, held = pdf["ids"], pdf["ws"], {c: pdf[c].to_numpy() for c in columns}
        for left, right in strips(np.flatnonzero(own == i), np.flatnonzero(own == j), piece):
            if i == j and left[0] > right[-1]:
                continue
            cosine = sparse_products((ids.iloc[left], ws.iloc[left]), (ids.iloc[right], ws.iloc[right]))
            x, y = np.nonzero(cosine >= threshold)
            found, a, b = cosine[x, y], left[x], right[y]
            if i == j:
                found, a, b = found[a < b], a[a < b], b[a < b]
            ends = {f"{c}_{e}": held[c][at] for c in columns for e, at in (("a", a), ("b", b))}
            yield pd.DataFrame(ends | {"cosine": found})

    out = ", ".join(f"{c}_{e} {kinds[c]}" for c in columns for e in "ab")
    return sent.groupBy("i", "j").applyInPandas(multiply, f"{out}, cosine double")


def block_similar_texts(vectors: DataFrame, threshold: float, block_rows: int = TEXTS_PER_BLOCK) -> DataFrame:
    """``(key_a, key_b, cosine)`` as of ``similar_texts``, block by block."""
    return block_pairs(vectors, threshold, ["key"], block_rows).select(
        F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"), "cosine"
    )


def similar_texts(
    vectors: DataFrame, threshold: float, per_key: int = POSTINGS_PER_KEY, block_rows: int = TEXTS_PER_BLOCK
) -> DataFrame:
    """``(key_a, key_b, cosine)`` for pairs of different texts, ``key_a < key_b``.

    ``vectors`` must have been built for a threshold not above this one, which is above 0. Below
    ``PREFIX_FROM`` blocks of texts are multiplied: there a join on rare terms lists some fifty pairs
    of postings for every pair found.
    """
    if threshold < PREFIX_FROM:
        return block_similar_texts(vectors, threshold, block_rows)
    met = meeting_postings(prefix_index(vectors), threshold, per_key).groupBy("vid_a", "vid_b")
    met = met.agg(reaches(threshold).alias("_ok")).filter("_ok")
    names = vectors.select("vid", "key")
    return (
        verify(met, vectors, threshold)
        .join(side(names, "a").withColumnRenamed("key_a", "a"), "vid_a")
        .join(side(names, "b").withColumnRenamed("key_b", "b"), "vid_b")
        .select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"), "cosine")
    )


def text_members(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(key, first_id, copies)``: what a text key stands for."""
    return members_of(df, F.md5(text_column))


def members_of(df: DataFrame, key: Column) -> DataFrame:
    return df.groupBy(key.alias("key")).agg(F.min("signal_id").alias("first_id"), F.count("*").alias("copies"))


def similar_pairs(
    df: DataFrame,
    threshold: float | None = None,
    text_column: str = "preprocessed_text",
    cfg: Config = DEFAULT,
) -> DataFrame:
    """All similar signal pairs, one row per pair of distinct texts (see ``named_pairs``)."""
    threshold = cfg.similarity_threshold if threshold is None else threshold
    members = text_members(df, text_column)
    if threshold < PREFIX_FROM:
        return packed_pairs(packed_texts(df, members, threshold, text_column), members_with_terms(df, text_column), threshold)
    return similar_named(index_vectors(df, threshold, text_column), members, threshold)


def packed_texts(df: DataFrame, texts: DataFrame, threshold: float, text_column: str = "preprocessed_text") -> DataFrame:
    """``packed.text_blocks`` for a threshold, with the columns of ``texts`` (by ``key``)."""
    _above_zero(threshold)
    return text_blocks(df, texts, text_column)


def members_with_terms(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``text_members`` of texts that can be similar to something."""
    return text_members(df.filter(has_terms(text_column)), text_column)


def packed_pairs(blocks: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """``named_pairs`` from blocks of texts with ``first_id`` and ``copies``, and the members of texts with terms."""
    pairs = similar_blocks(blocks, threshold)
    different = pairs.select(
        F.least("first_id_a", "first_id_b").alias("signal_a"),
        F.greatest("first_id_a", "first_id_b").alias("signal_b"),
        "cosine",
        pair_product(F.col("copies_a"), F.col("copies_b")).alias("n_pairs"),
    )
    return _with_copies(different, members)


def _above_zero(threshold: float) -> None:
    if threshold <= 0:
        raise ValueError("the threshold must be above 0: below, texts without a shared term belong to the result")


def similar_named(
    vectors: DataFrame, members: DataFrame, threshold: float, block_rows: int = TEXTS_PER_BLOCK
) -> DataFrame:
    """``named_pairs`` of the ``similar_texts``; blocks are multiplied with the names in them, so that no pair is joined."""
    if threshold >= PREFIX_FROM:
        return named_pairs(similar_texts(vectors, threshold), vectors, members)
    named = vectors.select("key", "ids", "ws").join(members.withColumnRenamed("copies", "n"), "key")
    pairs = block_pairs(named, threshold, ["first_id", "n"], block_rows)
    different = pairs.select(
        F.least("first_id_a", "first_id_b").alias("signal_a"),
        F.greatest("first_id_a", "first_id_b").alias("signal_b"),
        "cosine",
        pair_product(F.col("n_a"), F.col("n_b")).alias("n_pairs"),
    )
    return _with_copies(different, members.join(vectors.select("key"), "key", "left_semi"))


def named_pairs(text_pairs: DataFrame, vectors: DataFrame, members: DataFrame) -> DataFrame:
    """``(signal_a, signal_b, similarity, n_pairs, above_threshold)``.

    The first signals of two texts, their score and the number of signal pairs it
    holds for. ``signal_a = signal_b`` stands for the pairs among the copies of one
    text, so copies never multiply rows and no pair is lost.
    """
    named_a = members.select(F.col("key").alias("key_a"), F.col("first_id").alias("a"), F.col("copies").alias("n_a"))
    named_b = members.select(F.col("key").alias("key_b"), F.col("first_id").alias("b"), F.col("copies").alias("n_b"))
    different = (
        text_pairs.join(named_a, "key_a")
        .join(named_b, "key_b")
        .select(
            F.least("a", "b").alias("signal_a"),
            F.greatest("a", "b").alias("signal_b"),
            "cosine",
            pair_product(F.col("n_a"), F.col("n_b")).alias("n_pairs"),
        )
    )
    return _with_copies(different, members.join(vectors.select("key"), "key", "left_semi"))


def _with_copies(different: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of different texts and, below them, those among the copies of each text; ``members`` have terms."""
    copies = (
        members.filter("copies > 1")
        .select(
            F.col("first_id").alias("signal_a"),
            F.col("first_id").alias("signal_b"),
            F.lit(1.0).alias("cosine"),
            pair_count(F.col("copies")).alias("n_pairs"),
        )
    )
    return different.unionByName(copies).select(
        "signal_a",
        "signal_b",
        from_units(to_units(F.col("cosine"))).alias("similarity"),
        "n_pairs",
        F.lit(True).alias("above_threshold"),
    )


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs by falling score; equal scores by their ids."""
    return pairs.orderBy(F.desc("similarity"), "signal_a", "signal_b")


@dataclass(frozen=True)
class CorpusIndex:
    """A corpus ready to be searched: tables written once, in buckets by what they are looked up by.

    ``weights (id, vid, tf)`` and ``idf (id, idf)`` by the hash of a term, ``signals (vid, signal_id, i, length)`` by
    the number of a text: the first ``depth`` signals of a text, in order, and the length of its vector. A posting
    is two small numbers, as weights follow from counts.
    """

    weights: DataFrame
    idf: DataFrame
    signals: DataFrame
    depth: int


#: Buckets of an index table; a lookup moves its questions to them and never the table.
INDEX_BUCKETS = 64
#: Most results that an index can be asked for.
INDEX_DEPTH = 100


def _bucketed(df: DataFrame, label: str, by: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, in sorted buckets."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    # one file a bucket: rows are dealt like the buckets are
    dealt = df.repartition(buckets, by)
    dealt.write.bucketBy(buckets, by).sortBy(by).option("path", new_path(spark, label)).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def index_corpus(
    corpus: DataFrame, text_column: str = "preprocessed_text", depth: int = INDEX_DEPTH, buckets: int = INDEX_BUCKETS
) -> CorpusIndex:
    """Term counts and idf of the distinct texts, and the first ``depth`` signals of every text."""
    key = F.unhex(F.md5(text_column))
    blocks = text_blocks(corpus, corpus.select(F.md5(text_column).alias("key"), key.alias("name")).distinct(), text_column)
    signals = corpus.select("signal_id", key.alias("name"))
    early = F.row_number().over(Window.partitionBy("name").orderBy("signal_id"))  # cut before the shuffle
    signals = signals.withColumn("i", early).filter(F.col("i") <= depth).join(text_lengths(blocks), "name").drop("name")
    index = CorpusIndex(
        _bucketed(text_counts(blocks), "index_weights", "id", buckets),
        _bucketed(hashed_idf(corpus, text_column), "index_idf", "id", buckets),
        _bucketed(signals, "index_signals", "vid", buckets),
        depth,
    )
    discard(blocks)
    return index


def top_k_similar(
    queries: DataFrame, index: CorpusIndex, k: int = 5, query_id: str = "item_id", text_column: str = "preprocessed_text"
) -> DataFrame:
    """``(query, signal_id, similarity, rank)``: the ``k`` most similar corpus signals per query.

    Both sides use the corpus' term weights. Scores are found per distinct text; the cut to ``k``
    texts happens before the shuffle, and of each text only its first ``k`` signals can matter.
    ``k`` is at most the index' depth.
    """
    if k > index.depth:
        raise ValueError(f"the index holds the first {index.depth} signals of a text")
    raw = F.col("tf") * F.col("idf")
    length = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(query_id)))
    asked = (
        term_counts(queries, query_id, hashed_terms(text_column)).withColumnRenamed("term", "id")
        .join(index.idf, "id")
        .select(query_id, "id", (raw * F.col("idf") / length).alias("w_q"))
    )
    scores = index.weights.join(asked, "id").groupBy(query_id, "vid").agg(F.sum(F.col("tf") * F.col("w_q")).alias("product"))
    first = index.signals.filter("i = 1").select("vid", F.col("signal_id").alias("first_id"), "length")
    best_texts = Window.partitionBy(query_id).orderBy(F.desc("units"), "first_id")
    units = to_units(F.col("product") / F.col("length"))
    near = scores.join(first, "vid").withColumn("units", units).withColumn("_r", F.row_number().over(best_texts))
    near = near.filter(F.col("_r") <= k)
    ids = index.signals.filter(F.col("i") <= k).select("vid", "signal_id")
    order = Window.partitionBy(query_id).orderBy(F.desc("units"), "signal_id")
    return (
        near.select(query_id, "vid", "units")
        .join(ids, "vid")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(query_id, "signal_id", from_units(F.col("units")).alias("similarity"), "rank")
    )


# --- dense vectors ---------------------------------------------------------------

BLOCK_ROWS = 8192


def vector_key(vector: str = "embedding") -> Column:
    """A digest of a vector's values, the same for equal vectors."""
    return F.md5(F.array_join(F.transform(vector, lambda x: x.cast("string")), ","))


def index_dense(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(key, vid, vector)``: the written distinct vectors, each with a short number.

    Null vectors, those with a null or not a number in them and those of length zero are
    similar to nothing, not even to copies, and are left out. Numbers are taken as doubles.
    """
    square = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    good = df.filter((square > 0) & ~F.isnan(square) & (square < float("inf")))
    distinct = good.groupBy(vector_key(vector).alias("key")).agg(F.first(F.col(vector).cast("array<double>")).alias("vector"))
    return materialise(distinct.withColumn("vid", F.monotonically_increasing_id()), "vectors")


def distinct_vectors(df: DataFrame, vector: str = "embedding", keys: tuple[str, ...] = ()) -> DataFrame:
    """``(first_id, copies, vector, *keys)``: equal vectors (within ``keys``) become one row."""
    return df.groupBy(*keys, F.col(vector).alias("vector")).agg(
        F.min("signal_id").alias("first_id"), F.count("*").alias("copies")
    )


def dense_similar_pairs(
    df: DataFrame,
    threshold: float | None = None,
    vector: str = "embedding",
    keys: tuple[str, ...] = (),
    cfg: Config = DEFAULT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of equal ``keys`` with cosine >= ``threshold``, in the form of ``named_pairs``.

    Each key's rows are dealt into blocks of about ``block_rows``, and a pair of
    blocks is one task's matrix product: no task holds more than two blocks however
    large a key is, work is spread evenly, and only pairs that pass leave it.
    """
    threshold = cfg.similarity_threshold if threshold is None else threshold
    rows = materialise(distinct_vectors(df, vector, keys), "vectors")
    gate = F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")
    rows = rows.withColumn("gate", gate)
    held = F.count("*")
    shared = F.least(F.lit(LEAST_BLOCKS), F.ceil(held / F.lit(ROWS_AT_ONCE)))
    blocks = rows.groupBy("gate").agg(F.greatest(F.ceil(held / F.lit(block_rows)), shared).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "gate").withColumn("own", F.pmod(F.xxhash64("first_id"), F.col("blocks")).cast("int"))
    # A row meets every block of its key once, its own included.
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "gate",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "own",
        "first_id",
        "copies",
        "vector",
    )

    piece = ROWS_AT_ONCE

    def multiply(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(parts, ignore_index=True)
        ids = pdf["first_id"].to_numpy()
        copies = pdf["copies"].to_numpy()
        own = pdf["own"].to_numpy()
        matrix = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        norm = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        for left, right in strips(np.flatnonzero(own == i), np.flatnonzero(own == j), piece):
            if i == j and left[0] > right[-1]:
                continue
            cosine = matrix[left] @ matrix[right].T
            x, y = np.nonzero(cosine >= threshold)
            a, b = left[x], right[y]
            if i == j:
                keep = a < b
                x, y, a, b = x[keep], y[keep], a[keep], b[keep]
            yield pd.DataFrame(
                {"a": ids[a], "b": ids[b], "cosine": cosine[x, y], "copies_a": copies[a], "copies_b": copies[b]}
            )

    found = sent.groupBy("gate", "i", "j").applyInPandas(
        multiply, "a string, b string, cosine double, copies_a bigint, copies_b bigint"
    )
    different = found.select(
        F.least("a", "b").alias("signal_a"),
        F.greatest("a", "b").alias("signal_b"),
        "cosine",
        pair_product(F.col("copies_a"), F.col("copies_b")).alias("n_pairs"),
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    copies = rows.filter((F.col("copies") > 1) & nonzero).select(
        F.col("first_id").alias("signal_a"),
        F.col("first_id").alias("signal_b"),
        F.lit(1.0).alias("cosine"),
        pair_count(F.col("copies")).alias("n_pairs"),
    )
    return different.unionByName(copies).select(
        "signal_a",
        "signal_b",
        from_units(to_units(F.col("cosine"))).alias("similarity"),
        "n_pairs",
        F.lit(True).alias("above_threshold"),
    )


def resolve_backend(df: DataFrame, wanted: str = "auto", vector: str = "embedding") -> str:
    """``dense`` if asked for (or auto) and there is a vector column, else ``lexical``."""
    return "dense" if wanted in ("auto", "dense") and vector in df.columns else "lexical"


def similar_pairs_auto(df: DataFrame, threshold: float | None = None, backend: str = "auto") -> DataFrame:
    """Similar pairs with the backend that is there, named in ``backend_used``."""
    used = resolve_backend(df, backend)
    pairs = dense_similar_pairs(df, threshold) if used == "dense" else similar_pairs(df, threshold)
    return pairs.withColumn("backend_used", F.lit(used))
