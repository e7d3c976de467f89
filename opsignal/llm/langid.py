"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its subwords (byte n-grams of the lower-cased text,
hashed to a fixed number of rows); a linear layer turns the average into one score per language.
Both are trained by stochastic gradient descent in numpy on a bounded sample of labelled texts;
a part of the sample is kept out to calibrate the probabilities (temperature) and the rejection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import fresh, with_columns

BUCKET_BITS = 16
WIDTH = 16
NGRAMS = (2, 3, 4)
#: Labelled texts that a fit looks at, in all and at least per language.
FIT_ROWS, FIT_ROWS_OF_LANGUAGE = 3000, 60
#: Share of held-out texts of known languages that may be rejected.
REJECT = 0.002
EPOCHS, RATE = 6, 20.0
UNKNOWN = "und"


def _subwords(offsets: np.ndarray, data: np.ndarray):
    """``(rows of the table, text number)`` of the subwords of a piece."""
    values = textbuf.LOWER_VALUES[data]
    end_of = np.repeat(offsets[1:], np.diff(offsets))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    position = np.arange(len(data))
    with np.errstate(over="ignore"):
        h = values.copy()
        for n in range(2, max(NGRAMS) + 1):
            if len(h) < 2:
                return
            h = h[:-1] * np.uint64(textbuf._BASE) + values[n - 1 :]
            if n in NGRAMS:
                inside = position[: len(h)] + n <= end_of[: len(h)]
                rows = (textbuf.mix(h + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
                yield (rows, doc[: len(h)]) if inside.all() else (rows[inside], doc[: len(h)][inside])


@dataclass
class Model:
    languages: list[str]
    #: Embedding times output weights: a row's share of the scores of a text.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Calibrated probabilities, one row per text; texts without subwords get the bias alone."""
        out = np.zeros((len(column), len(self.languages)))
        for row, end, offsets, data in textbuf.pieces(column):
            n = np.zeros(end - row)
            for buckets, doc in _subwords(offsets, data):
                n += np.bincount(doc, minlength=end - row)
                for k in range(len(self.languages)):
                    out[row:end, k] += np.bincount(doc, self.table[k][buckets], minlength=end - row)
            out[row:end] /= np.maximum(n, 1)[:, None]
        z = (out + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_sample(labelled: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """A bounded sample, a like share of every language, chosen by a hash of number and text.

    Copies of a text with numbers of their own are chosen one by one, so a text in many rows adds no more than its share.

    Common languages get ``FIT_ROWS`` shared among them, every language ``FIT_ROWS_OF_LANGUAGE``.
    """
    rows = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    counts = rows.groupBy(label).count().collect()  # one row per language
    share = {r[0]: max(FIT_ROWS // max(1, len(counts)), FIT_ROWS_OF_LANGUAGE) / r[1] for r in counts}
    if not share:
        return rows.limit(0)
    limit = F.create_map(*[F.lit(x) for kv in sorted(share.items()) for x in kv])
    point = F.pmod(F.xxhash64(*[c for c in ("doc_id", text) if c in rows.columns]), F.lit(1 << 24)) / (1 << 24)
    return rows.filter(point < F.element_at(limit, F.col(label)))


def _counted(sample: DataFrame, label: str) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Distinct subword rows and their counts of each text of the sample, made on the executors.

    The driver keeps the Arrow buffers as they come, with a view of them for each text.
    """

    def run(batches):
        for batch in batches:
            rows, counts = [], []
            for first, end, offsets, data in textbuf.pieces(batch.column("text"), 1 << 18):
                parts = list(_subwords(offsets, data))
                for d in range(end - first):
                    own = [b[np.searchsorted(t, d) : np.searchsorted(t, d + 1)] for b, t in parts]
                    r, c = np.unique(np.concatenate(own or [np.zeros(0, np.int64)]), return_counts=True)
                    rows.append(r.astype(np.int32))
                    counts.append(c.astype(np.int32))
            bounds = pa.array(np.cumsum([0, *map(len, rows)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x))) for x in (rows, counts)] if rows else [pa.array([], pa.list_(pa.int32()))] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("key"), *lists], names=["label", "key", "rows", "counts"]
            )

    key = F.xxhash64(label, "text").alias("key")
    schema = "label string, key long, rows array<int>, counts array<int>"
    found = sample.select(F.col(label).alias("label"), key, "text").mapInArrow(run, schema).toArrow().combine_chunks()
    # in a fixed order, so that a fit does not depend on how its rows arrive
    order = pc.sort_indices(found, sort_keys=[("label", "ascending"), ("key", "ascending")]).to_numpy()
    if not len(order):
        return []
    labels = found.column("label").to_pylist()
    rows, counts = (found.column(c).chunk(0) for c in ("rows", "counts"))
    at = rows.offsets.to_numpy()
    rows, counts = rows.values.to_numpy(), counts.values.to_numpy()
    return [(labels[i], rows[at[i] : at[i + 1]], counts[at[i] : at[i + 1]]) for i in order if at[i] < at[i + 1]]


def fit(labelled: DataFrame, label: str = "lang", seed: int = 7) -> Model:
    """Train on ``(text, label)`` rows; null labels and texts teach nothing. Without rows: a model of no language."""
    rows = _counted(fit_sample(labelled, "text", label), label)
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((0, 1 << BUCKET_BITS)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    order = rng.permutation(len(rows))
    held, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    if not len(held):
        held = used
    k = len(languages)
    embed = rng.normal(0, 1 / WIDTH, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)
    weights, bias = np.zeros((WIDTH, k), np.float32), np.zeros(k, np.float32)
    steps = EPOCHS * len(used)
    for step in range(steps):
        lang, at, n = rows[used[step % len(used)]] if step % len(used) else rows[used[0]]
        if step % len(used) == 0:
            used = rng.permutation(used)
        share = (n / n.sum()).astype(np.float32)
        mean = share @ embed[at]
        z = mean @ weights + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[number[lang]] -= 1
        rate = np.float32(RATE / WIDTH * (1 - step / steps))
        back = weights @ p
        weights -= rate * np.outer(mean, p)
        bias -= rate * np.float32(0.01) * p
        embed[at] -= rate * np.outer(share, back)
    table = np.ascontiguousarray((embed @ weights).T.astype(np.float64))
    z = np.array([[np.sum(table[j][at] * n) / n.sum() for j in range(k)] for _, at, n in (rows[i] for i in held)]) + bias
    truth = np.array([number[rows[i][0]] for i in held])

    def loss(t):
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return -(s[np.arange(len(s)), truth] - np.log(np.exp(s).sum(axis=1))).mean()

    temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    s = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
    top = (s / s.sum(axis=1, keepdims=True)).max(axis=1)
    # at most REJECT of texts of known languages fall under the threshold; chance level is its least use
    threshold = min(float(np.quantile(top, REJECT)), 1.0) * 0.9
    return Model(languages, table, bias.astype(np.float64), float(temperature), threshold)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``.

    ``score`` is the calibrated probability of the predicted language. Null texts and those without a
    letter: ``und``, score 0, rejected. ``rejected`` is also set where the score is under the model's
    threshold. Only the text is looked at, as a whole, whatever its length. Ties go to the language
    first in the alphabet; without a learned language everything is ``und``. Columns of the three
    names are replaced, others passed on. Empty table: no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    flag = fresh("_letter", columns)
    base = docs.select(*columns, has_letter(F.col("text")).alias(flag))

    def run(batches):
        m = sent.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            letter = batch.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            if m.languages:
                p = m.scores(batch.column("text"))
                best, top = p.argmax(axis=1), p.max(axis=1)
            else:
                best, top, letter = np.zeros(len(batch), int), np.zeros(len(batch)), np.zeros(len(batch), bool)
            best = np.where(letter, best, len(m.languages))
            top = np.where(letter, top, 0.0)
            out = batch.drop_columns([flag])
            out = out.append_column("lang_pred", pa.array(names[best], pa.string()))
            out = out.append_column("score", pa.array(np.clip(top, 0, 1)))
            yield out.append_column("rejected", pa.array(~letter | (top < m.threshold)))

    added = [("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")]
    schema = with_columns(docs.select(*columns).schema, added)
    return base.mapInArrow(run, schema)
