"""Importance resampling towards a target corpus over hashed word n-grams.

Every text is a bag of its runs of one to three words, hashed by CRC-32 into a fixed number of
buckets. A bucket's gain is the logarithm of its share in the target over its share in the corpus;
a document weighs the sum of its features' gains. Gumbel noise from a hash of the document's number
turns the largest scores into a sample without replacement.

The checksums of all features of a block are made at once. CRC-32 is linear: a byte at distance k
from the end of a message adds a value that only depends on the byte and k. These values are looked
up in a position table and combined over each feature's span by ``bitwise_xor.reduceat``; what the
register's start and end values add depends on the length alone. Spans longer than the table are
cut into blocks, whose sums are advanced over the bytes that follow them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import materialise
from opsignal.operators.ranking import global_rank

BUCKETS = 10_000
RUNS = (1, 2, 3)
PERCENT, LEAST_WORDS, SEED = 5, 20, 42
#: Distances that the position table holds; longer spans are folded block by block.
DISTANCES = 64
#: Words whose features are made at a time.
BLOCK_WORDS = 1 << 14
#: Steps of the histogram that finds the cut.
STEPS = 1 << 16

_FULL = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    """What a byte makes of an empty register (CRC-32, reflected polynomial 0xEDB88320)."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1).astype(np.uint32)
    return value


def _position_table(byte: np.ndarray) -> np.ndarray:
    """``[k, b]``: what byte ``b`` adds if ``k`` bytes follow it."""
    rows = [byte]
    for _ in range(DISTANCES - 1):
        rows.append((rows[-1] >> 8) ^ byte[rows[-1] & 255])
    return np.stack(rows)


def _advance_tables(byte: np.ndarray) -> np.ndarray:
    """``[j, i, b]``: byte ``i`` of a register, being ``b``, after ``2**j`` zero bytes."""
    registers = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    tables = [(registers >> 8) ^ byte[registers & 255]]
    for _ in range(39):
        tables.append(_apply(tables[-1], tables[-1]))
    return np.stack(tables)


def _apply(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return table[0][register & 255] ^ table[1][(register >> 8) & 255] ^ table[2][(register >> 16) & 255] ^ table[3][register >> 24]


_BYTE = _byte_table()
_POSITION = np.ascontiguousarray(_position_table(_BYTE)).ravel()
_ADVANCE = _advance_tables(_BYTE)


def advance(register: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Registers after ``zeros`` zero bytes each, by the binary digits of that number."""
    out, j = register.copy(), 0
    while (left := zeros >> j).any():
        some = (left & 1).astype(bool)
        out[some] = _apply(_ADVANCE[j], out[some])
        j += 1
    return out


#: What start and end value of the register add to messages shorter than the table.
_LENGTH = advance(np.full(DISTANCES + 1, _FULL), np.arange(DISTANCES + 1)) ^ _FULL


def span_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for spans of at least one byte."""
    size = ends - starts
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    distance = np.repeat(ends, size) - 1 - at
    if size.max(initial=0) <= DISTANCES:
        value = np.bitwise_xor.reduceat(_POSITION[(distance << 8) | data[at]], offsets[:-1])
        return value ^ _LENGTH[size]
    value = _POSITION[((distance % DISTANCES) << 8) | data[at]]
    block = distance // DISTANCES
    new = np.ones(len(at), bool)
    new[1:] = block[1:] != block[:-1]
    new[offsets[:-1]] = True
    first = np.flatnonzero(new)
    blocks = advance(np.bitwise_xor.reduceat(value, first), block[first] * DISTANCES)
    value = np.bitwise_xor.reduceat(blocks, np.searchsorted(first, offsets[:-1]))
    return value ^ _FULL ^ advance(np.full(len(size), _FULL), size)


def _joined(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, starts, ends, first)``: the words with one space after each, and the words before each text."""
    starts, ends = textbuf._runs(offsets, data, textbuf.NOT_ALNUM)
    size = ends - starts
    to = np.concatenate(([0], np.cumsum(size + 1)))
    at = np.arange(to[-1]) + np.repeat(starts - to[:-1], size + 1)
    out = data[np.minimum(at, max(0, len(data) - 1))] if len(data) else data
    upper = (out >= 65) & (out <= 90)
    out = np.where(upper, out + 32, out).astype(np.uint8)
    out[to[1:] - 1] = 32
    return out, to[:-1], to[1:] - 1, np.searchsorted(starts, offsets)


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text number, bucket)`` of every feature, block by block."""
    for row, _, offsets, data in textbuf.pieces(column):
        clean, starts, ends, first = _joined(offsets, data)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        for low in range(0, len(starts), BLOCK_WORDS):
            for n in RUNS:
                head = np.arange(low, min(low + BLOCK_WORDS, len(starts) - n + 1))
                head = head[text[head] == text[head + n - 1]]
                if len(head):
                    sums = span_checksums(clean, starts[head], ends[head + n - 1])
                    yield row + text[head], (sums % BUCKETS).astype(np.int64)


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features in every bucket over all rows: a sum per task, then per bucket; ``BUCKETS`` rows reach the driver."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, bucket in _features(batch.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of (smoothed share in the target / in the corpus), rounded down."""
    s, t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def _noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_features, weight, score, long_enough`` of every document."""

    def run(batches):
        for batch in batches:
            n = len(batch)
            counts, weight, words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for text, bucket in _features(batch.column("text")):
                base, size = int(text[0]), int(text[-1]) + 1
                here = text - base
                total = np.concatenate(([0], np.cumsum(gain[bucket])))
                edge = np.searchsorted(here, np.arange(size - base + 1))
                counts[base:size] += np.diff(edge)
                weight[base:size] += np.diff(total[edge])
            # a text of w words has w + (w - 1) + (w - 2) features, none of them negative
            words = np.where(counts >= 3, counts // 3 + 1, np.where(counts > 0, 1, 0))
            ids = batch.column("doc_id")
            score = weight + np.array([_noise(i, seed) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts), pa.array(weight), pa.array(score), pa.array(words >= least_words)],
                names=["doc_id", "n_features", "weight", "score", "long_enough"],
            )

    schema = "doc_id long, n_features long, weight long, score long, long_enough boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _cut(scored: DataFrame, percent: int) -> tuple[int, int | None]:
    """How many documents to draw, and a score that all of them reach, close to the least of theirs."""
    able = scored.filter("long_enough")
    total = able.agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    wanted = percent * total["n"] // 100
    if not wanted:
        return 0, None
    width = (total["high"] - total["low"]) // STEPS + 1
    step = F.floor((F.col("score") - total["low"]) / width).cast("int").alias("step")
    above = 0
    for r in sorted(able.groupBy(step).count().collect(), reverse=True):  # at most STEPS rows
        above += r["count"]
        if above >= wanted:
            return wanted, total["low"] + r["step"] * width
    raise AssertionError("the histogram holds all rows")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: all documents, those drawn with their rank.

    Words are runs of letters and digits, and of anything beyond ASCII, of the text with A-Z in lower
    case. ``percent`` of the documents of at least ``least_words`` words are drawn, highest scores first,
    ties to the smaller number. Two passes over whole texts, no text is shuffled; scores are written,
    and only documents near or above the cut are sorted, range by range.

    Null or empty text: no features, weight 0, not drawn. Null ``doc_id``: hashed as an empty number,
    last of ties. Repeated rows are rows of their own. Further columns of both tables are not read.
    Empty target: all gains are logarithms of (shares smoothed from nothing). Empty table: no rows.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = materialise(weigh(docs, gain, seed, least_words), "scores")
    wanted, least = _cut(scored, percent)
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*columns, none)
    near = F.col("long_enough") & (F.col("score") >= least)
    ranked = global_rank(scored.filter(near).select(*columns), [F.desc("score"), F.asc_nulls_last("doc_id")], "place")
    place = F.when(F.col("place") <= wanted, F.col("place")).cast("long").alias("rank")
    return scored.filter(~near).select(*columns, none).unionByName(ranked.select(*columns, place))
