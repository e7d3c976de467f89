"""Toxicity by multiple-instance learning: sentences combined by noisy-or.

A document is a bag of sentences; each has a probability from a linear model over hashed words,
and the document is toxic unless all its sentences are not: P = 1 - prod(1 - p). Only documents
have labels. The loss of P trains the sentence model, which then locates offending sentences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import materialise, with_columns

BUCKET_BITS = 18
#: Labelled documents that a fit looks at, for each of the labels.
FIT_ROWS = 8000
#: Only words met in so many documents of the sample, and more often in toxic ones by so many standard
#: errors, carry weight: what makes a bag positive is evidence, all else is left to the bias.
LEAST_DOCS, LEAST_Z = 5, 5.0
EPOCHS, RATE, L1, START = 20, 1.0, 2.5e-5, -7.0
BATCH_DOCS = 64
#: Ends of sentences: line breaks and ``.!?``.
_ENDS = np.zeros(256, bool)
_ENDS[[10, 33, 46, 63]] = True


def _sentences(offsets: np.ndarray, data: np.ndarray):
    """Words' table rows and sentence numbers (over the piece), the sentence bounds of each text, the words."""
    words = textbuf.tokens(offsets, data, textbuf.NOT_ALNUM, textbuf.LOWER_VALUES)
    rows = (words.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    before = np.searchsorted(np.flatnonzero(_ENDS[data]), words.starts)
    new = np.zeros(len(rows), bool)
    new[1:] = before[1:] != before[:-1]
    border = words.first[1:-1]
    new[border[(border > 0) & (border < len(rows))]] = True
    number = np.cumsum(new)
    bounds = np.append(number, number[-1] + 1 if len(number) else 0)[words.first]
    return rows, number, bounds, words


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, rows: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Probability of each sentence; a word counts each time it stands there."""
        if not len(rows):
            return np.zeros(0)
        w = self.weights[rows]
        return _sigmoid(np.bincount(number, w) + self.bias)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _noisy_or(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))))
    return -np.expm1(total[bounds[1:]] - total[bounds[:-1]])


def _sample(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``y, share, text`` of at most ``FIT_ROWS`` documents of each label, chosen by a hash of their number.

    The choice is made on the labels alone, so that no text is shuffled but those of the sample.
    """
    known = marks.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = materialise(known, "labels")
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    picked = None
    for y, n in sorted(counts.items()):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
        part = part.select(F.col("doc_id").alias("_of"), "y", F.lit(min(1.0, FIT_ROWS / n)).alias("share"))
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        picked = known.select(F.col("doc_id").alias("_of"), "y", F.lit(1.0).alias("share")).limit(0)
    picked = F.broadcast(materialise(picked, "picked"))  # at most 2 * FIT_ROWS numbers
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_of"))
    # of rows that repeat a number, the greatest text; made in part before the shuffle
    return texts.groupBy("doc_id", "y", "share").agg(F.max("text").alias("text")).select("y", "share", "text")


def _bags(sample: DataFrame):
    def run(batches):
        for batch in batches:
            all_rows, all_numbers = [], []
            for _, _, offsets, data in textbuf.pieces(batch.column("text")):
                rows, number, bounds, words = _sentences(offsets, data)
                for d in range(len(offsets) - 1):
                    own = slice(words.first[d], words.first[d + 1])
                    all_rows.append(rows[own].astype(np.int32))
                    all_numbers.append((number[own] - bounds[d]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("share"), pa.array(all_rows, pa.list_(pa.int32())), pa.array(all_numbers, pa.list_(pa.int32()))],
                names=["y", "share", "rows", "numbers"],
            )

    found = sample.mapInArrow(run, "y int, share double, rows array<int>, numbers array<int>").toArrow()
    out = []
    for y, share, rows, numbers in zip(*[found.column(c) for c in ("y", "share", "rows", "numbers")]):
        r, n = rows.values.to_numpy(zero_copy_only=False), numbers.values.to_numpy(zero_copy_only=False)
        if len(r):
            out.append((y.as_py(), min(1.0, share.as_py()), r, n))
    out.sort(key=lambda b: (b[0], len(b[2]), b[2].tobytes()))  # not by how the rows arrive
    return out


def fit(docs: DataFrame, marks: DataFrame, seed: int = 11) -> Model:
    """Train on ``(doc_id, text)`` rows and labels ``(doc_id, toxic)``.

    Null numbers, texts and labels teach nothing. A document with several labels is toxic if one says
    so; of rows that repeat a number, one is used. Without both labels: a constant.
    """
    bags = _bags(_sample(docs, marks))
    n_docs = max(1, len(bags))
    weights, bias = np.zeros(1 << BUCKET_BITS), START
    if len({b[0] for b in bags}) < 2:
        return Model(weights, bias)
    docs_of, toxic_of = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for b in bags:
        own = np.unique(b[2])
        docs_of[own] += 1
        toxic_of[own] += b[0]
    share = sum(b[0] for b in bags) / n_docs
    z = (toxic_of - docs_of * share) / np.sqrt(np.maximum(docs_of, 1) * share * (1 - share))
    live = (docs_of >= LEAST_DOCS) & (z >= LEAST_Z)
    rng = np.random.default_rng(seed)
    squares, bias_square = np.full(1 << BUCKET_BITS, 1e-6), 1e-6
    for epoch in range(EPOCHS):
        order = rng.permutation(n_docs)
        for i in range(0, n_docs, BATCH_DOCS):
            part = [bags[j] for j in order[i : i + BATCH_DOCS]]
            rows = np.concatenate([b[2] for b in part])
            n_sent = np.array([b[3][-1] + 1 for b in part])
            base = np.concatenate(([0], np.cumsum(n_sent)))
            number = np.concatenate([b[3] + o for b, o in zip(part, base)])
            p = _sigmoid(np.bincount(number, weights[rows], minlength=base[-1]) + bias)
            whole = _noisy_or(p, base)
            y = np.array([b[0] for b in part])
            rarity = 1 / np.array([b[1] for b in part])  # undo the different shares of the labels
            rarity /= rarity.mean()
            per_doc = np.where(y == 1, -(1 - whole) / np.maximum(whole, 1e-9), 1.0) * rarity
            g = np.repeat(per_doc, n_sent) * p / len(part)
            used, at = np.unique(rows, return_inverse=True)
            grad = np.bincount(at, g[number])
            squares[used] += grad**2
            step = RATE / np.sqrt(squares[used])
            w = weights[used] - step * grad
            weights[used] = np.where(live[used], np.sign(w) * np.maximum(0, np.abs(w) - step * L1), 0)
            bias_square += g.sum() ** 2
            bias -= RATE / 3 * g.sum() / np.sqrt(bias_square)
    return Model(weights, float(bias))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (noisy-or of the sentences), ``predicted`` and ``spans``.

    ``predicted`` is 1 where the score is 0.5 or more. ``spans`` lists ``start:end`` (bytes of the
    UTF-8 text, end exclusive) of the sentences that have half or more of their own, joined by commas.
    Sentences end at line breaks and ``.!?``. Null and empty texts and texts without words have no
    sentence: score 0. Only the text is looked at. Columns of the three names are replaced, others
    passed on. Empty table: no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(*[c for c in docs.columns if c not in ("score", "predicted", "spans")])

    def run(batches):
        m = sent.value
        for batch in batches:
            scores, spans = np.zeros(len(batch)), [""] * len(batch)
            for row, end, offsets, data in textbuf.pieces(batch.column("text")):
                rows, number, bounds, words = _sentences(offsets, data)
                p = m.sentence_scores(rows, number)
                scores[row:end] = _noisy_or(p, bounds)
                for s in np.flatnonzero(p >= 0.5):
                    w0, w1 = np.searchsorted(number, [s, s + 1])
                    d = int(np.searchsorted(bounds, s, side="right")) - 1
                    at = f"{words.starts[w0] - offsets[d]}:{words.ends[w1 - 1] - offsets[d]}"
                    spans[row + d] += f",{at}" if spans[row + d] else at
            out = batch.append_column("score", pa.array(np.clip(scores, 0, 1)))
            out = out.append_column("predicted", pa.array((scores >= 0.5).astype(np.int32)))
            yield out.append_column("spans", pa.array(spans, pa.string()))

    added = [("score", "double"), ("predicted", "integer"), ("spans", "string")]
    schema = with_columns(base.schema, added)
    return base.mapInArrow(run, schema)
