"""Texts packed into blocks, and the products of all pairs of blocks.

A block is one row: up to ``TEXTS_PER_BLOCK`` texts with the dictionary of their terms, a code and a count for
every term of a text. Document frequencies are summed over dictionaries and weights come back to them, so that
no posting is ever shuffled. Pairs of blocks are a Cartesian product of parts that are dealt once and read again
for each other part: what is written does not grow with the number of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opsignal.functions.text import feature_terms
from opsignal.operators.tfidf import row_count, smooth_idf
from opsignal.session import discard, materialise

#: Texts of a block, multiplied with as many others at once.
TEXTS_PER_BLOCK = 2048
#: Occurrences of terms after which a block is closed; a longer text is a block of its own.
TERMS_PER_BLOCK = 1 << 20
#: Blocks in a part that a task reads for each other part.
BLOCKS_PER_PART = 8
#: Products of single postings formed at once, and columns of a dense part.
AT_ONCE = 1 << 20
COLUMNS = 1024
_SENT = ("sizes", "codes", "tfs")
_PACKED = "ids array<bigint>, sizes binary, codes binary, tfs binary"

#: Row of each posting, its term and its weight.
Postings = tuple[np.ndarray, np.ndarray, np.ndarray]


def has_terms(text_column: str) -> Column:
    """Whether a text has any term; the others are similar to nothing, not even to their copies."""
    return F.lower(text_column).rlike(r"[\p{L}\p{N}_]{2,}")


def hashed_terms(text_column: str) -> Column:
    """The terms of a text, in order, as 64-bit hashes."""
    return F.transform(feature_terms(F.col(text_column)), lambda t: F.xxhash64(t))


def hashed_idf(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(id, idf)`` of a corpus; every signal counts once for each of its terms, so that no text moves."""
    met = df.select(F.explode(F.array_distinct(feature_terms(F.col(text_column)))).alias("term"))
    met = met.select(F.xxhash64("term").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    return met.join(F.broadcast(row_count(df)), F.lit(True)).select("id", smooth_idf(F.col("n"), F.col("df")).alias("idf"))


def packed_terms(sizes: np.ndarray, terms: np.ndarray) -> dict:
    """``ids, sizes, codes, tfs`` of texts given as their numbers of terms and all terms in order."""
    ids, code = np.unique(terms, return_inverse=True)
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    cell, tf = np.unique((row << 32) | code, return_counts=True)
    held = np.bincount(cell >> 32, minlength=len(sizes)).astype(np.int32)
    return {
        "ids": ids,
        "sizes": held.tobytes(),
        "codes": (cell & 0xFFFFFFFF).astype(np.int32).tobytes(),
        "tfs": tf.astype(np.int32).tobytes(),
    }


def numbered(packed: DataFrame) -> DataFrame:
    """Packed rows with a number ``block``, written."""
    return materialise(packed.withColumn("block", F.monotonically_increasing_id()), "packed", "zstd")


def postings(block: dict) -> tuple[int, Postings]:
    """How many texts a block has, and their unit vectors."""
    sizes, codes, tfs = (np.frombuffer(block[c], np.int32) for c in _SENT)
    row = np.repeat(np.arange(len(sizes)), sizes)
    raw = tfs * block["idf"][codes]
    square = np.bincount(row, raw * raw, minlength=len(sizes))
    return len(sizes), (row, block["ids"][codes], raw / np.sqrt(square)[row])


def chosen(rows: np.ndarray, n: int, vectors: Postings) -> Postings:
    """Postings of some rows, which are numbered as listed."""
    place = np.full(n, -1)
    place[rows] = np.arange(len(rows))
    at = place[vectors[0]]
    keep = at >= 0
    return at[keep], vectors[1][keep], vectors[2][keep]


def posting_products(
    ends: Sequence[Postings], shape: tuple[int, int], at_once: int = AT_ONCE, dense_columns: int = COLUMNS
) -> np.ndarray:
    """Dot products of all left with all right sparse vectors, given as postings in the order of their rows.

    Terms that many of both sides have are multiplied as dense columns, the postings of the others
    one by one, so that neither zeros nor frequent terms set the time.
    """
    shared = np.intersect1d(ends[0][1], ends[1][1])
    out = np.zeros(shape)
    if not len(shared):
        return out
    cells, counts = [], []
    for row, ids, ws in ends:  # postings of shared terms, term by term
        term = np.minimum(np.searchsorted(shared, ids), len(shared) - 1)
        both = shared[term] == ids
        row, term, ws = row[both], term[both], ws[both]
        by = np.argsort(term, kind="stable")
        cells.append((row[by], term[by], ws[by]))
        counts.append(np.bincount(term, minlength=len(shared)))
    (row_a, term_a, w_a), (row_b, term_b, w_b) = cells
    often = counts[0] * counts[1] > max(shape[0] * shape[1] // 256, 1)
    columns = np.flatnonzero(often)
    for low in range(0, len(columns), dense_columns):
        some = columns[low : low + dense_columns]
        place = np.full(len(shared), -1)
        place[some] = np.arange(len(some))
        dense = []
        for n, (row, term, w) in zip(shape, cells):
            matrix, at = np.zeros((n, len(some))), place[term]
            matrix[row[at >= 0], at[at >= 0]] = w[at >= 0]
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    rare = ~often[term_a]
    row_a, term_a, w_a = row_a[rare], term_a[rare], w_a[rare]
    first = np.concatenate(([0], np.cumsum(counts[1])))
    n = counts[1][term_a]
    done = np.concatenate(([0], np.cumsum(n)))
    low = 0
    while low < len(n):
        high = max(low + 1, int(np.searchsorted(done, done[low] + at_once, "right")) - 1)
        size = n[low:high]
        at = np.arange(done[high] - done[low]) + np.repeat(first[term_a[low:high]] - (done[low:high] - done[low]), size)
        np.add.at(out.reshape(-1), np.repeat(row_a[low:high] * shape[1], size) + row_b[at], np.repeat(w_a[low:high], size) * w_b[at])
        low = high
    return out


def block_of(batch: pa.RecordBatch, i: int, end: str = "") -> dict:
    """A block from a row; lists become arrays without copies."""
    out = {}
    for c in ("ids", "idf"):
        held = batch.column(f"{c}{end}")
        first, last = held.offsets[i].as_py(), held.offsets[i + 1].as_py()
        out[c] = held.values.slice(first, last - first).to_numpy(zero_copy_only=False)
    for c in _SENT:
        out[c] = batch.column(f"{c}{end}")[i].as_buffer()
    return out


def with_idf(packed: DataFrame, df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """Written ``packed`` rows with ``idf``, a weight for each of their ``ids`` from the corpus ``df``.

    The steps are written one by one, so that no two of them have their shuffles on disk at once.
    """
    idf = materialise(hashed_idf(df, text_column), "idf", "zstd")
    wanted = packed.select("block", F.explode("ids").alias("id"))
    found = wanted.join(idf, "id").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("id", "idf"))).alias("_w"))
    weights = materialise(found.select("block", F.col("_w.idf").alias("idf")), "block_weights", "zstd")
    discard(idf)
    return packed.join(weights, "block")


def pack_texts(
    df: DataFrame, text_column: str = "preprocessed_text", block_rows: int = TEXTS_PER_BLOCK, terms: int = TERMS_PER_BLOCK
) -> DataFrame:
    """``(block, keys, ids, sizes, codes, tfs)``: texts where they lie, each at most once in a block; written."""
    rows = df.filter(has_terms(text_column)).select(F.unhex(F.md5(text_column)).alias("key"), hashed_terms(text_column).alias("terms"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict = {}
        sizes, parts, held = [], [], 0

        def done() -> pa.RecordBatch:
            block = packed_terms(np.array(sizes, np.int64), np.concatenate(parts))
            return pa.RecordBatch.from_pydict(
                {"ids": [block["ids"]], **{c: [block[c]] for c in _SENT}, "keys": [list(keys)]},
                schema=_schema,
            )

        for batch in batches:
            key, lists = batch.column("key").to_pylist(), batch.column("terms")
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            for i, k in enumerate(key):
                if k in keys:
                    continue
                n = int(at[i + 1] - at[i])
                if keys and (len(keys) >= block_rows or held + n > terms):
                    yield done()
                    keys, sizes, parts, held = {}, [], [], 0
                keys[k] = None
                sizes.append(n)
                parts.append(flat[at[i] : at[i + 1]].copy())
                held += n
        if keys:
            yield done()

    kinds = {"ids": pa.list_(pa.int64()), **{c: pa.binary() for c in _SENT}, "keys": pa.list_(pa.binary())}
    _schema = pa.schema(list(kinds.items()))
    return numbered(rows.mapInArrow(pack, f"{_PACKED}, keys array<binary>"))


def text_blocks(
    df: DataFrame,
    texts: DataFrame,
    text_column: str = "preprocessed_text",
    block_rows: int = TEXTS_PER_BLOCK,
    terms: int = TERMS_PER_BLOCK,
) -> DataFrame:
    """The written blocks of the distinct texts of ``df``, with weights and what is known of each text.

    ``texts`` has ``key`` and further columns, one row per text. A block's ``texts`` has a struct of its place
    (``pos``) and these columns for each text that is this block's: of a text in several blocks, the first one's.
    """
    packed = pack_texts(df, text_column, block_rows, terms)
    slots = packed.select("block", F.posexplode("keys").alias("pos", "key"))
    own = slots.groupBy("key").agg(F.min(F.struct("block", "pos")).alias("at"))
    known = texts.withColumn("key", F.unhex("key")).join(own, "key")
    more = [c for c in texts.columns if c != "key"]
    listed = known.groupBy("at.block").agg(F.sort_array(F.collect_list(F.struct("at.pos", *more))).alias("texts"))
    listed = materialise(listed, "block_texts", "zstd")
    blocks = materialise(with_idf(packed.drop("keys"), df, text_column).join(listed, "block"), "blocks", "zstd")
    discard(packed)
    return blocks


def pairs_of_blocks(blocks: DataFrame) -> DataFrame:
    """Every pair of blocks once, the columns of one named ``_a`` and of the other ``_b``; a block with itself too.

    Blocks are dealt into parts of about ``BLOCKS_PER_PART``, and a task reads two parts. A block is shuffled once,
    however many others it meets.
    """
    cores, n = blocks.sparkSession.sparkContext.defaultParallelism, blocks.count()
    few = blocks.repartition(max(1, min(n, max(math.isqrt(8 * cores), -(-n // BLOCKS_PER_PART)))))
    a, b = (few.select(*(F.col(c).alias(f"{c}_{e}") for c in few.columns)) for e in "ab")
    # Of two blocks either may come first, so that half of each part's pairs are kept.
    even = (F.col("block_a") + F.col("block_b")) % 2 == 0
    once = F.when(even, F.col("block_a") <= F.col("block_b")).otherwise(F.col("block_a") > F.col("block_b"))
    return a.hint("shuffle_replicate_nl").join(b, once)


def each_product(
    batches: Iterator[pa.RecordBatch], unpack: Callable[[pa.RecordBatch, int, str], dict]
) -> Iterator[tuple[dict, dict, np.ndarray]]:
    """What ``unpack`` makes of the texts of both blocks, and the cosines, of every pair of blocks in some batches.

    ``unpack`` gives ``rows``, the places of a block's own texts, and anything else. Of a block with itself, pairs
    below the diagonal and on it have the cosine -1.
    """
    last: tuple = (None, None)

    def read(batch: pa.RecordBatch, i: int, end: str) -> dict:
        held = unpack(batch, i, end)
        n, vectors = postings(block_of(batch, i, end))
        held["vectors"] = chosen(held["rows"], n, vectors)
        return held

    for batch in batches:
        for i in range(batch.num_rows):
            at = batch.column("block_a")[i].as_py()
            other = batch.column("block_b")[i].as_py()
            if last[0] != at:
                last = at, read(batch, i, "_a")
            a = last[1]
            b = a if at == other else read(batch, i, "_b")
            cosine = posting_products((a["vectors"], b["vectors"]), (len(a["rows"]), len(b["rows"])))
            if at == other:
                cosine[np.tri(len(a["rows"]), dtype=bool)] = -1.0
            yield a, b, cosine


def struct_fields(batch: pa.RecordBatch, i: int, column: str) -> pa.StructArray:
    """The structs listed in a row."""
    held = batch.column(column)
    first, last = held.offsets[i].as_py(), held.offsets[i + 1].as_py()
    return held.values.slice(first, last - first)


def _own_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.StructArray, dict]]:
    """Places of each block's own texts, their numbers ``vid``, what is known of them, and the block."""
    for batch in batches:
        for i in range(batch.num_rows):
            texts = struct_fields(batch, i, "texts")
            pos = texts.flatten()[texts.type.get_field_index("pos")].to_numpy().astype(np.int64)
            # A block has fewer texts than its number has room for.
            yield pos, batch.column("block")[i].as_py() * TEXTS_PER_BLOCK + pos, texts, block_of(batch, i)


def text_counts(blocks: DataFrame) -> DataFrame:
    """``(id, vid, tf)``: how often a text has a term."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pos, vid, _, block in _own_texts(batches):
            sizes, codes, tfs = (np.frombuffer(block[c], np.int32) for c in _SENT)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at, code, tf = chosen(pos, len(sizes), (row, codes, tfs))
            yield from pa.table({"id": block["ids"][code], "vid": vid[at], "tf": tf}).to_batches(max_chunksize=1 << 16)

    return blocks.mapInArrow(rows, "id bigint, vid bigint, tf int")


def text_lengths(blocks: DataFrame) -> DataFrame:
    """``(name, vid, length)``: the length of each text's vector; ``texts`` has its ``name``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pos, vid, texts, block in _own_texts(batches):
            sizes, codes, tfs = (np.frombuffer(block[c], np.int32) for c in _SENT)
            raw = tfs * block["idf"][codes]
            square = np.bincount(np.repeat(np.arange(len(sizes)), sizes), raw * raw, minlength=len(sizes))
            name = texts.flatten()[texts.type.get_field_index("name")]
            yield from pa.table({"name": name, "vid": vid, "length": np.sqrt(square[pos])}).to_batches()

    return blocks.mapInArrow(rows, "name binary, vid bigint, length double")


def similar_blocks(blocks: DataFrame, threshold: float) -> DataFrame:
    """``(first_id_a, first_id_b, copies_a, copies_b, cosine)`` of all pairs of different texts from ``threshold`` on."""

    def unpack(batch: pa.RecordBatch, i: int, end: str) -> dict:
        texts = struct_fields(batch, i, f"texts{end}")
        pos, first, copies = (texts.flatten()[texts.type.get_field_index(c)] for c in ("pos", "first_id", "copies"))
        return {"rows": pos.to_numpy(), "first_id": first, "copies": copies.to_numpy()}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, cosine in each_product(batches, unpack):
            x, y = np.nonzero(cosine >= threshold)
            ends = {"first_id_a": a["first_id"].take(pa.array(x)), "first_id_b": b["first_id"].take(pa.array(y))}
            counts = {"copies_a": a["copies"][x], "copies_b": b["copies"][y], "cosine": cosine[x, y]}
            yield from pa.table(ends | {k: pa.array(v) for k, v in counts.items()}).to_batches(max_chunksize=1 << 16)

    return pairs_of_blocks(blocks).mapInArrow(
        multiply, "first_id_a string, first_id_b string, copies_a bigint, copies_b bigint, cosine double"
    )


def units_of(cosine: np.ndarray) -> np.ndarray:
    """Cosines in units of a ten-thousandth, rounded half up on nine places (``rounding.to_units``)."""
    return np.floor(np.round(cosine * 1e9) / 1e5 + 0.5).astype(np.int64)


def pair_totals(blocks: DataFrame, threshold: float, levels: tuple[float, ...] = ()) -> DataFrame:
    """``(units, cosine, pairs, same, cosines, same_cosines)``: signal pairs of different texts, counted by score.

    The ``texts`` of the blocks have ``truth``, structs of ``incident_group`` and ``n``. ``units`` is the rounded
    score, ``cosine`` the highest of ``levels`` (and ``threshold``) that it reaches, ``same`` counts pairs of one
    incident, a null incident being one. Rows without ``units`` have the sums of cosines of all pairs.
    """
    steps = np.array(sorted({threshold, *levels}))

    def unpack(batch: pa.RecordBatch, i: int, end: str) -> dict:
        texts = struct_fields(batch, i, f"texts{end}")
        pos, truth = (texts.flatten()[texts.type.get_field_index(c)] for c in ("pos", "truth"))
        inner = truth.flatten().flatten()
        names = truth.type.value_type
        incident, n = (inner[names.get_field_index(c)] for c in ("incident_group", "n"))
        row = np.repeat(np.arange(len(pos)), truth.value_lengths().to_numpy())
        n = n.to_numpy()
        return {"rows": pos.to_numpy(), "row": row, "n": n, "incident": incident, "copies": np.bincount(row, n, len(pos)).astype(np.int64)}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[int]] = {}
        sums = [0.0, 0.0]
        for a, b, cosine in each_product(batches, unpack):
            names = pa.chunked_array([a["incident"], b["incident"]]).combine_chunks().dictionary_encode(null_encoding="encode")
            code = names.indices.to_numpy().astype(np.int64)
            own, other = code[: len(a["row"])], code[len(a["row"]) :]
            same = posting_products(((a["row"], own, a["n"].astype(float)), (b["row"], other, b["n"].astype(float))), cosine.shape)
            there = np.maximum(cosine, 0.0)
            sums[0] += float(a["copies"] @ there @ b["copies"])
            x, y = np.nonzero(same)
            sums[1] += float((same[x, y] * there[x, y]).sum())
            x, y = np.nonzero(cosine >= threshold)
            if not len(x):
                continue
            value = cosine[x, y]
            group = units_of(value) * len(steps) + np.searchsorted(steps, value, "right") - 1
            by = np.argsort(group, kind="stable")
            first = np.flatnonzero(np.diff(group[by], prepend=-1))
            pairs, alike = a["copies"][x] * b["copies"][y], same[x, y].astype(np.int64)
            for g, p, s in zip(group[by][first], np.add.reduceat(pairs[by], first), np.add.reduceat(alike[by], first)):
                held = found.setdefault(divmod(int(g), len(steps)), [0, 0])
                held[0] += int(p)
                held[1] += int(s)
        keys = list(found)
        yield pa.RecordBatch.from_pydict(
            {
                "units": [k[0] for k in keys] + [None],
                "cosine": [float(steps[k[1]]) for k in keys] + [None],
                "pairs": [str(found[k][0]) for k in keys] + ["0"],
                "same": [str(found[k][1]) for k in keys] + ["0"],
                "cosines": [0.0] * len(keys) + [sums[0]],
                "same_cosines": [0.0] * len(keys) + [sums[1]],
            },
            schema=pa.schema([("units", pa.int64()), ("cosine", pa.float64()), ("pairs", pa.string()), ("same", pa.string()), ("cosines", pa.float64()), ("same_cosines", pa.float64())]),
        )

    counted = pairs_of_blocks(blocks).mapInArrow(
        multiply, "units bigint, cosine double, pairs string, same string, cosines double, same_cosines double"
    )
    big = "decimal(38,0)"
    return counted.groupBy("units", "cosine").agg(
        F.sum(F.col("pairs").cast(big)).cast(big).alias("pairs"),
        F.sum(F.col("same").cast(big)).cast(big).alias("same"),
        F.sum("cosines").alias("cosines"),
        F.sum("same_cosines").alias("same_cosines"),
    )
