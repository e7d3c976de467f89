"""Correlation of signals into groups: similar text, same category, close in time.

The work runs on *cells*: all signals with one category, one text and one time
bucket as long as the window. Signals of a cell always belong together, so copies
and bursts shrink to one row before anything is joined, and groups, sizes and mean
similarities follow from cells and counts without listing signal pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.rounding import BIG, from_units, mean_of_units, pair_count, pair_product, round_half_up, to_units
from opsignal.functions.scoring import confidence
from opsignal.functions.clock import source_weight
from opsignal.functions.text import snippet
from opsignal.operators import packed
from opsignal.operators.evaluate import evaluate_group_counts
from opsignal.operators.components import connected_components
from opsignal.operators.ranking import global_rank
from opsignal.operators.similarity import (
    ROWS_AT_ONCE,
    index_dense,
    resolve_backend,
    sparse_products,
    strips,
    vector_key,
)
from opsignal.operators.timewindow import partial_pairs, with_bucket
from opsignal.session import discard, materialise

_CELL = ["predicted_category", "key", "bucket"]
#: Cells of one bucket that a task multiplies with as many others.
CELLS_PER_BLOCK = 1024
_SAME, _EARLY, _LATE = 0, 1, 2


@dataclass(frozen=True)
class Links:
    """Cells and the accepted links between them.

    ``cells``: ``node`` and the per-cell aggregates. ``edges``: ``(early, late, cosine,
    pairs)``, the score and the number of signal pairs it stands for.
    """

    signals: DataFrame
    vectors: DataFrame
    cells: DataFrame
    edges: DataFrame
    cfg: Config
    threshold: float


def placed(df: DataFrame, key: Column, cfg: Config) -> DataFrame:
    """Signals with their cell columns; without a category a signal matches nothing."""
    return with_bucket(df.filter(F.col("predicted_category").isNotNull()).withColumn("key", key), cfg)


def _column_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def build_cells(df: DataFrame, cfg: Config = DEFAULT, *more: Column) -> DataFrame:
    """One row per cell with everything a group header needs (and ``more`` aggregates), combined map-side."""
    zero = F.lit(0.0)
    seen = [
        F.max((F.col("source_type") == s).cast("int")).alias(f"is_{s}") for s in sorted(cfg.source_weights)
    ]
    cells = df.groupBy(*_CELL).agg(
        F.count("*").alias("n"),
        F.min("offset").alias("lo"),
        F.max("offset").alias("hi"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.min(F.struct("timestamp", "signal_id")).alias("first_signal"),
        F.max(source_weight(F.col("source_type"), cfg)).alias("weight"),
        F.max(F.coalesce(_column_or(df, "confidence", zero), zero)).alias("confidence"),
        F.max(F.coalesce(_column_or(df, "anomaly_score", zero), zero)).alias("anomaly"),
        *seen,
        *more,
    )
    return cells.withColumn("node", F.monotonically_increasing_id())


def link_signals(
    df: DataFrame,
    threshold: float | None = None,
    text_column: str = "preprocessed_text",
    cfg: Config = DEFAULT,
    backend: str = "auto",
    vector: str = "embedding",
) -> Links:
    """Find all accepted links. ``df`` carries ``predicted_category`` and the text or a vector.

    ``backend``: ``dense`` compares vectors, ``lexical`` TF-IDF weights of the text, ``auto``
    takes vectors where there are any. In either case category and time bucket gate the
    comparison before any score is made.
    """
    threshold = cfg.similarity_threshold if threshold is None else threshold
    if resolve_backend(df, backend, vector) == "dense":
        signals = placed(df, vector_key(vector), cfg)
        vectors = index_dense(df, vector)
        cells = materialise(build_cells(signals, cfg).join(vectors.select("key", "vid"), "key"), "cells")
        linked = materialise(dense_links(cells, vectors, threshold).unionByName(same_text_links(cells)), "links")
    else:
        if threshold <= 0:
            raise ValueError("the threshold must be above 0: below, texts without a shared term belong to the result")
        signals = placed(df, F.md5(text_column), cfg)
        # A text without terms is similar to nothing, not even to its copies.
        text = F.first(text_column).alias("cell_text")
        spoken = materialise(build_cells(signals.filter(packed.has_terms(text_column)), cfg, text), "cell_texts", "zstd")
        cells = materialise(spoken.drop("cell_text"), "cells")
        vectors = pack_cells(spoken)
        discard(spoken)
        crossing = packed_links(packed.with_idf(vectors, df, text_column), threshold)
        linked = materialise(crossing.unionByName(same_text_links(cells)), "links", "zstd")
        discard(vectors)
    return Links(signals, vectors, cells, count_pairs(linked, signals, cells, cfg), cfg, threshold)


#: Whole numbers of a cell that go with its text.
_OF_CELL = ("node", "bucket", "n", "lo", "hi")


def pack_cells(cells: DataFrame, block_rows: int = CELLS_PER_BLOCK) -> DataFrame:
    """The cells to be compared, packed with the terms of their ``cell_text``; written.

    Neighbouring buckets of a category share a block up to about ``block_rows`` cells, and a cell goes again
    only where the next bucket begins another block. A bucket with more cells is dealt into several blocks
    that meet in pairs. ``whole``: all rows are compared with each other, else those with ``late`` with those without.
    """
    here = ["predicted_category", "bucket"]
    time = Window.partitionBy("predicted_category").orderBy("bucket")
    held = cells.groupBy(*here).agg(F.count("*").alias("held"))
    before = F.coalesce(F.sum("held").over(time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.withColumns({"run": F.floor(before / F.lit(block_rows)), "hot": F.col("held") > block_rows})
    run = Window.partitionBy("predicted_category", "hot", "run")
    held = held.withColumns(
        {
            "unit": F.min("bucket").over(run),
            "total": F.sum("held").over(run),
            "blocks": F.when(F.col("hot"), F.ceil(F.col("held") / F.lit(block_rows))).otherwise(F.lit(1)).cast("int"),
        }
    )
    beside = F.struct("bucket", "unit", "blocks")
    held = held.withColumns({"after": F.lead(beside).over(time), "ahead": F.lag(beside).over(time)})
    held = materialise(held.drop("held", "run", "hot"), "cell_blocks")
    rows = cells.select(*here, "node", "key", "n", "lo", "hi", "cell_text").join(held, here)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own = F.col("own")

    def met(there: Column, others: Column, at: Column, adjacent: bool, place: Callable[[Column], tuple[Column, Column, Column]]) -> Column:
        """The blocks in which a cell meets ``others``, if ``there``."""

        def one(k: Column) -> Column:
            i, j, late = place(k)
            return F.struct(at.alias("at"), F.lit(adjacent).alias("adjacent"), i.alias("i"), j.alias("j"), late.alias("late"))

        return F.transform(F.when(there, F.sequence(F.lit(0), others - 1)).otherwise(F.array().cast("array<int>")), one)

    yes, no = F.lit(True), F.lit(False)
    after, ahead = F.col("after"), F.col("ahead")
    follows = (after["bucket"] == F.col("bucket") + 1) & (after["unit"] != F.col("unit"))
    leads = (ahead["bucket"] == F.col("bucket") - 1) & (ahead["unit"] != F.col("unit"))
    targets = F.concat(
        met(F.col("total") > 1, F.col("blocks"), F.col("unit"), False, lambda k: (F.least(own, k), F.greatest(own, k), own > k)),
        met(F.coalesce(follows, no), after["blocks"], F.col("bucket"), True, lambda k: (own, k, no)),
        met(F.coalesce(leads, no), ahead["blocks"], F.col("bucket") - 1, True, lambda k: (k, own, yes)),
    )
    to = ["predicted_category", "at", "adjacent", "i", "j"]
    sent = rows.withColumn("_to", F.explode(targets)).select("predicted_category", "_to.*", *_OF_CELL[:2], "key", *_OF_CELL[2:], "cell_text")
    # Texts travel; their terms, which are longer, are found where they arrive.
    sent = sent.repartition(*to).withColumn("terms", packed.hashed_terms("cell_text")).drop("cell_text")

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        terms = pa.concat_arrays(rows["terms"].chunks) if rows["terms"].num_chunks else rows["terms"].combine_chunks()
        block = packed.packed_terms(terms.value_lengths().to_numpy(), terms.flatten().to_numpy(zero_copy_only=False))
        out = {c: [block[c]] for c in ("ids", "sizes", "codes", "tfs")}
        out |= {c: [rows[c].to_numpy().astype(np.int64).tobytes()] for c in _OF_CELL}
        out["texts"] = [pd.factorize(rows["key"].to_pandas())[0].astype(np.int32).tobytes()]
        out["late"] = [rows["late"].to_numpy().astype(np.int8).tobytes()]
        adjacent = rows["adjacent"][0].as_py()
        out |= {"adjacent": [adjacent], "whole": [not adjacent and rows["i"][0].as_py() == rows["j"][0].as_py()]}
        return pa.table(out, schema=kinds)

    binary = ["sizes", "codes", "tfs", *_OF_CELL, "texts", "late"]
    kinds = pa.schema([("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in binary), ("adjacent", pa.bool_()), ("whole", pa.bool_())])
    schema = f"ids array<bigint>, {', '.join(c + ' binary' for c in binary)}, adjacent boolean, whole boolean"
    return packed.numbered(sent.groupBy(*to).applyInArrow(pack, schema))


def packed_links(blocks: DataFrame, threshold: float) -> DataFrame:
    """Links between cells of different texts in ``blocks`` (see ``pack_cells``) with weights of their terms."""

    def links(block: dict, held: dict) -> Iterator[pa.RecordBatch]:
        n, vectors = packed.postings(block)
        node, bucket, text = held["node"], held["bucket"], held["texts"]
        left = right = np.arange(n)
        if not held["whole"]:
            left, right = np.flatnonzero(held["late"] == 0), np.flatnonzero(held["late"])
        for some, others in strips(left, right, ROWS_AT_ONCE):
            if held["whole"] and some[0] > others[-1]:
                continue
            ends = [packed.chosen(x, n, vectors) for x in (some, others)]
            cosine = packed.posting_products(ends, (len(some), len(others)))
            x, y = np.nonzero(cosine >= threshold)
            found, e, l = cosine[x, y], some[x], others[y]
            swap = (bucket[e] > bucket[l]) | ((bucket[e] == bucket[l]) & (node[e] > node[l]))
            once = (e < l) if held["whole"] else np.ones(len(e), bool)
            e, l = np.where(swap, l, e), np.where(swap, e, l)
            adjacent = bucket[l] - bucket[e] == 1
            # Copies in neighbouring buckets are linked without a product.
            once &= (bucket[l] == bucket[e]) | (adjacent & (text[e] != text[l]) & (held["lo"][l] <= held["hi"][e]))
            e, l, found, adjacent = e[once], l[once], found[once], adjacent[once]
            out = {"early": node[e], "late": node[l]}
            for c in ("n", "lo", "hi"):
                out |= {f"{c}_e": held[c][e], f"{c}_l": held[c][l]}
            yield from pa.table(out | {"adjacent": adjacent, "cosine": found}).to_batches(max_chunksize=1 << 16)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = {c: np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in _OF_CELL}
                held["texts"] = np.frombuffer(batch.column("texts")[i].as_buffer(), np.int32)
                held["late"] = np.frombuffer(batch.column("late")[i].as_buffer(), np.int8)
                held["whole"] = batch.column("whole")[i].as_py()
                yield from links(packed.block_of(batch, i), held)

    kinds = "early bigint, late bigint, n_e bigint, n_l bigint, lo_e bigint, lo_l bigint, hi_e bigint, hi_l bigint"
    found = blocks.mapInArrow(multiply, f"{kinds}, adjacent boolean, cosine double")
    return found.select("early", "late", "n_e", "n_l", "lo_e", "hi_e", "lo_l", "hi_l", "adjacent", "cosine")


def lexical_links(cells: DataFrame, vectors: DataFrame, threshold: float, block_rows: int = CELLS_PER_BLOCK) -> DataFrame:
    """Links between cells of different texts, by their sparse vectors (see ``block_links``)."""

    def score(pdf: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return sparse_products(*((pdf["ids"].iloc[x], pdf["ws"].iloc[x]) for x in (left, right)))

    return block_links(cells, vectors, ["ids", "ws"], score, threshold, block_rows)


def dense_links(cells: DataFrame, vectors: DataFrame, threshold: float, block_rows: int = CELLS_PER_BLOCK) -> DataFrame:
    """Links between cells of different vectors (see ``block_links``)."""

    def score(pdf: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        matrix = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix[left] @ matrix[right].T

    return block_links(cells, vectors, ["vector"], score, threshold, block_rows)


def block_links(
    cells: DataFrame,
    vectors: DataFrame,
    columns: list[str],
    score: Callable[[pd.DataFrame, np.ndarray, np.ndarray], np.ndarray],
    threshold: float,
    block_rows: int,
) -> DataFrame:
    """Links between cells of different vectors, block by block inside category and touching buckets.

    ``columns`` hold a vector, ``score`` gives the cosines of some rows with others. The cells of a category and bucket are dealt into blocks; a task multiplies two blocks of
    one bucket or of neighbouring ones, whatever the size of the bucket, and gives out the
    pairs from ``threshold`` on.
    """
    at = ["predicted_category", "bucket"]
    held = F.count("*")
    blocks = cells.groupBy(*at).agg(F.ceil(held / F.lit(block_rows)).cast("int").alias("blocks"), (held > 1).alias("several"))
    blocks = materialise(blocks, "cell_blocks")
    rows = cells.select(*at, "node", "vid", "n", "lo", "hi").join(blocks, at)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def beside(step: int) -> DataFrame:
        """Rows with the number of blocks in the bucket ``step`` away."""
        other = blocks.select("predicted_category", (F.col("bucket") - step).alias("bucket"), F.col("blocks").alias("others"))
        return rows.join(other, at)

    def dealt(met: DataFrame, others: str, i: Column, j: Column, bucket: Column, side: int) -> DataFrame:
        """Where each row goes; its vector joins it after that."""
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        return met.select(
            "predicted_category", bucket.alias("bucket"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"),
            "own", "node", "vid", "n", "lo", "hi",
        )

    own, other, bucket = F.col("own"), F.col("other"), F.col("bucket")
    sent = (
        dealt(rows.filter("several"), "blocks", F.least(own, other), F.greatest(own, other), bucket, _SAME)
        .unionByName(dealt(beside(1), "others", own, other, bucket, _EARLY))
        .unionByName(dealt(beside(-1), "others", other, own, bucket - 1, _LATE))
        .withColumn("adjacent", F.col("side") != _SAME)
        .join(vectors.select("vid", *columns), "vid")
    )

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        first, side, i, j = pdf["own"].to_numpy(), pdf["side"].to_numpy(), pdf["i"].iat[0], pdf["j"].iat[0]
        if side[0] == _SAME:
            left, right = np.flatnonzero(first == i), np.flatnonzero(first == j)
        else:
            left, right = np.flatnonzero(side == _EARLY), np.flatnonzero(side == _LATE)
        cosine = score(pdf, left, right)
        x, y = np.nonzero(cosine >= threshold)
        found, e, l = cosine[x, y], left[x], right[y]
        vid, node = pdf["vid"].to_numpy(), pdf["node"].to_numpy()
        if side[0] == _SAME:
            once = (node[e] < node[l]) if i == j else np.ones(len(e), bool)
            e, l = np.where(node[e] < node[l], e, l), np.where(node[e] < node[l], l, e)
        else:  # copies in neighbouring buckets are linked without a product
            once = (vid[e] != vid[l]) & (pdf["lo"].to_numpy()[l] <= pdf["hi"].to_numpy()[e])
        e, l, found = e[once], l[once], found[once]
        out = {"early": node[e], "late": node[l]}
        for c in ("n", "lo", "hi"):
            out |= {f"{c}_e": pdf[c].to_numpy()[e], f"{c}_l": pdf[c].to_numpy()[l]}
        return pd.DataFrame(out | {"adjacent": side[0] != _SAME, "cosine": found})

    kinds = "early bigint, late bigint, n_e bigint, n_l bigint, lo_e bigint, lo_l bigint, hi_e bigint, hi_l bigint"
    found = sent.groupBy(*at, "i", "j", "adjacent").applyInPandas(multiply, f"{kinds}, adjacent boolean, cosine double")
    return found.select("early", "late", "n_e", "n_l", "lo_e", "hi_e", "lo_l", "hi_l", "adjacent", "cosine")


def same_text_links(cells: DataFrame) -> DataFrame:
    """Links between neighbouring buckets of one text; their score is 1."""
    columns = ["predicted_category", "key"]
    narrow = cells.select(*columns, "bucket", "node", "n", "lo", "hi")
    after = narrow.select(
        *columns,
        (F.col("bucket") - 1).alias("bucket"),
        F.col("node").alias("late"),
        F.col("n").alias("n_l"),
        F.col("lo").alias("lo_l"),
        F.col("hi").alias("hi_l"),
    )
    return (
        narrow.withColumnsRenamed({"node": "early", "n": "n_e", "lo": "lo_e", "hi": "hi_e"})
        .join(after, [*columns, "bucket"])
        .filter("lo_l <= hi_e")
        .select(
            "early", "late", "n_e", "n_l", "lo_e", "hi_e", "lo_l", "hi_l",
            F.lit(True).alias("adjacent"), F.lit(1.0).alias("cosine"),
        )
    )


def count_pairs(linked: DataFrame, signals: DataFrame, cells: DataFrame, cfg: Config) -> DataFrame:
    """``(early, late, cosine, pairs)``: exact number of signal pairs within the window per link.

    Same bucket, or all of the later cell before the earliest offset: every pair
    fits. Only partly overlapping neighbours need their offsets compared.
    """
    product = pair_product(F.col("n_e"), F.col("n_l"))
    simple = ~F.col("adjacent") | (F.col("hi_l") <= F.col("lo_e"))
    whole = linked.filter(simple).select("early", "late", "cosine", product.alias("pairs"))
    split = linked.filter(~simple).select("early", "late", "cosine")
    nodes = split.select(F.col("early").alias("node")).unionByName(split.select(F.col("late").alias("node")))
    wanted = cells.join(nodes.distinct(), "node", "left_semi").select(*_CELL, "node")
    rows = signals.select(*_CELL, "offset").join(wanted, _CELL)
    part = split.join(partial_pairs(split.select("early", "late"), rows, "node", cfg), ["early", "late"])
    return whole.unionByName(part.select("early", "late", "cosine", "pairs"))


def group_labels(links: Links) -> DataFrame:
    """``(node, root)`` for every cell that belongs to a group of at least two signals."""
    return _with_single_cells(links, connected_components(_ends(links.edges)))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("early").alias("src"), F.col("late").alias("dst"))


def _with_single_cells(links: Links, joined: DataFrame) -> DataFrame:
    alone = links.cells.filter("n > 1").join(joined, "node", "left_anti")
    return joined.unionByName(alone.select("node", F.col("node").alias("root")))


def nested_labels(links: Links, thresholds) -> dict[float, DataFrame]:
    """``group_labels`` at each threshold, from one pass over the links.

    Groups at a lower threshold are unions of those at a higher one. From the highest down, only
    the links between two thresholds are looked at, with the groups so far as their ends, so that a link
    enters the components once, and those inside a group not at all.
    """
    out, upto, labels = {}, None, None
    for t in sorted(set(thresholds), reverse=True):
        new = F.col("cosine") >= t
        ends = _ends(links.edges.filter(new if upto is None else new & (F.col("cosine") < upto)))
        if labels is not None:
            for side_of in ("src", "dst"):
                to = labels.select(F.col("node").alias(side_of), "root")
                ends = ends.join(to, side_of, "left").withColumn(side_of, F.coalesce("root", side_of)).drop("root")
        merged = connected_components(ends)
        if labels is not None:
            onto = merged.select(F.col("node").alias("root"), F.col("root").alias("onto"))
            moved = labels.join(onto, "root", "left").select("node", F.coalesce("onto", "root").alias("root"))
            merged = moved.unionByName(merged.join(labels, "node", "left_anti"))
        labels, upto = materialise(merged, "labels"), t
        out[t] = _with_single_cells(links, labels)
    return out


def group_headers(links: Links, labels: DataFrame) -> DataFrame:
    """One row per group: size, span, sources, similarity, anomaly, confidence.

    Everything is a sum, minimum or maximum over cells, so a group of any size is
    combined map-side.
    """
    cfg = links.cfg
    sources = sorted(cfg.source_weights)
    cells = links.cells.join(labels, "node")
    heads = cells.groupBy("root").agg(
        F.min("predicted_category").alias("predicted_category"),
        F.sum("n").alias("signal_count"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.min("first_signal").alias("first_signal"),
        F.max("weight").alias("weight"),
        F.max("confidence").alias("classifier"),
        F.max("anomaly").alias("anomaly"),
        F.sum(pair_count(F.col("n"))).cast(BIG).alias("inner_pairs"),
        *(F.max(f"is_{s}").alias(f"is_{s}") for s in sources),
    )
    scores = (
        links.edges.join(labels, F.col("early") == F.col("node"))
        .groupBy("root")
        .agg(
            F.sum(to_units(F.col("cosine")).cast("decimal(9,0)") * F.col("pairs")).cast(BIG).alias("units"),
            F.sum("pairs").cast(BIG).alias("pairs"),
        )
    )
    none = F.lit(0).cast(BIG)
    inner = F.col("inner_pairs")
    total = F.coalesce("units", none) + inner * 10_000
    count = F.coalesce("pairs", none) + inner
    span = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / F.lit(6e7)
    kinds = F.array_compact(F.array(*(F.when(F.col(f"is_{s}") == 1, F.lit(s)) for s in sources)))
    anomaly = round_half_up(F.col("anomaly"))
    return heads.join(scores, "root", "left").select(
        "root",
        "predicted_category",
        "signal_count",
        kinds.alias("source_types"),
        round_half_up(span, 2).alias("time_span_minutes"),
        mean_of_units(total, count).alias("avg_similarity"),
        anomaly.alias("max_anomaly_score"),
        confidence(F.col("weight"), F.col("classifier"), anomaly, cfg).alias("confidence_score"),
        "first_signal",
    )


def ranked_groups(heads: DataFrame) -> DataFrame:
    """Numbered ``CORR-001``... by confidence, then size, then first appearance."""
    order = [F.desc("confidence_score"), F.desc("signal_count"), F.asc("first_signal")]
    ranked = global_rank(heads, order)
    name = F.concat(F.lit("CORR-"), F.lpad(F.col("rank").cast("string"), 3, "0"))
    # lpad cuts long numbers, so it only applies below a thousand.
    long_name = F.concat(F.lit("CORR-"), F.col("rank").cast("string"))
    return ranked.withColumn("group_id", F.when(F.col("rank") < 1000, name).otherwise(long_name))


@dataclass(frozen=True)
class Correlation:
    """Groups and the table that says which cell belongs to which group."""

    links: Links
    labels: DataFrame
    groups: DataFrame

    def members(self) -> DataFrame:
        """One row per grouped signal: ``group_id, signal_id, source_type, text_snippet, ...``.

        Members stay rows: a group may be larger than any array.
        """
        named = self.groups.select("root", "group_id")
        cells = self.links.cells.join(self.labels, "node").join(named, "root").select(*_CELL, "root", "group_id")
        rows = self.links.signals
        keep = [c for c in ("source_type", "incident_group", "timestamp") if c in rows.columns]
        if "text" in rows.columns:
            rows = rows.withColumn("text_snippet", snippet(F.col("text")))
            keep.append("text_snippet")
        return rows.select(*_CELL, "signal_id", *keep).join(cells, _CELL).drop("bucket", "key")


def correlate_signals(
    df: DataFrame,
    threshold: float | None = None,
    text_column: str = "preprocessed_text",
    cfg: Config = DEFAULT,
    backend: str = "auto",
    vector: str = "embedding",
) -> Correlation:
    """Signals with ``predicted_category, confidence, anomaly_score`` to ranked groups (backends: ``link_signals``)."""
    links = link_signals(df, threshold, text_column, cfg, backend, vector)
    labels = materialise(group_labels(links), "labels")
    return Correlation(links, labels, ranked_groups(group_headers(links, labels)))


def group_rows(groups: DataFrame) -> DataFrame:
    """Group headers in their public columns."""
    return groups.select(
        "group_id", "predicted_category", "signal_count", "source_types", "time_span_minutes",
        "avg_similarity", "max_anomaly_score", "confidence_score",
    )


def gated_pairs(links: Links, members: DataFrame) -> DataFrame:
    """``(predicted_category, signal_a, signal_b, similarity, pairs)`` per pair of texts.

    Named by the first signals of the texts; ``pairs`` counts the signal pairs that
    passed all gates, pairs among copies included.
    """
    cell = links.cells.select("node", "predicted_category", "key", "n")
    early = cell.select(F.col("node").alias("early"), "predicted_category", F.col("key").alias("key_e"))
    late = cell.select(F.col("node").alias("late"), F.col("key").alias("key_l"))
    between = links.edges.join(early, "early").join(late, "late").select(
        "predicted_category",
        F.least("key_e", "key_l").alias("key_a"),
        F.greatest("key_e", "key_l").alias("key_b"),
        to_units(F.col("cosine")).alias("units"),
        "pairs",
    )
    inside = cell.filter("n > 1").select(
        "predicted_category",
        F.col("key").alias("key_a"),
        F.col("key").alias("key_b"),
        F.lit(10_000).cast("bigint").alias("units"),
        pair_count(F.col("n")).alias("pairs"),
    )
    summed = (
        between.unionByName(inside)
        .groupBy("predicted_category", "key_a", "key_b", "units")
        .agg(F.sum("pairs").cast(BIG).alias("pairs"))
    )
    named_a = members.select(F.col("key").alias("key_a"), F.col("first_id").alias("a"))
    named_b = members.select(F.col("key").alias("key_b"), F.col("first_id").alias("b"))
    return summed.join(named_a, "key_a").join(named_b, "key_b").select(
        "predicted_category",
        F.least("a", "b").alias("signal_a"),
        F.greatest("a", "b").alias("signal_b"),
        from_units(F.col("units")).alias("similarity"),
        "pairs",
    )


def group_hint(best: DataFrame, found: Correlation, signals: DataFrame) -> DataFrame:
    """For each best match the group it is in, else just its category."""
    members = found.members().select(
        "signal_id", "group_id", F.col("predicted_category").alias("group_category")
    )
    own = signals.select("signal_id", "category")
    return (
        best.join(own, "signal_id")
        .join(members, "signal_id", "left")
        .withColumn("related_category", F.coalesce("group_category", "category"))
    )


def feed(found: Correlation, categories) -> DataFrame:
    """Detail rows of the groups of some categories, with the number of true incidents behind each."""
    heads = found.groups.filter(F.col("predicted_category").isin(*categories)).select(
        "group_id", "confidence_score", "avg_similarity"
    )
    members = found.members().select("group_id", "signal_id", "source_type", "text_snippet", "incident_group")
    # Incidents per group first as pairs, so a large group is not one task's set.
    incidents = (
        members.groupBy("group_id", "incident_group")
        .agg(F.count("*").alias("n"))
        .groupBy("group_id")
        .agg(F.count("incident_group").alias("incidents"))
    )
    return (
        members.join(heads, "group_id")
        .join(incidents, "group_id")
        .select(
            "group_id", "confidence_score", "signal_id", "source_type", "text_snippet", "avg_similarity", "incidents"
        )
        .orderBy(F.desc("confidence_score"), "group_id", "signal_id")
    )


def threshold_sweep(links: Links, signals: DataFrame, thresholds) -> DataFrame:
    """Group quality for several thresholds from one set of scored links.

    ``links`` must have been found for the lowest threshold or one below. Signals are reduced
    to counts per cell and incident once; every threshold only relabels cells (``nested_labels``).
    """
    if min(thresholds) < links.threshold:
        raise ValueError(f"links were found for {links.threshold}; below it they are incomplete")
    wanted = links.cells.select(*_CELL, "node")
    truth = materialise(
        links.signals.groupBy(*_CELL, "incident_group").agg(F.count("*").alias("n")).join(wanted, _CELL)
        .select("node", "incident_group", "n"),
        "truth",
    )
    rows, labels = [], nested_labels(links, thresholds)
    for t in thresholds:
        labelled = truth.join(labels[t], "node")
        rows.append(
            evaluate_group_counts(
                labelled.groupBy("root", "incident_group").agg(F.sum("n").alias("n")), signals, "root"
            ).withColumn("threshold", F.lit(float(t)))
        )
    return reduce(DataFrame.unionByName, rows)
