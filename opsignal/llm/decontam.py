"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import fresh, materialise

SEED = 4
SPACING = 4
SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of test items that one pass over the documents looks for; more items take more passes.
BLOCK_WORDS = 2_000_000
_BITS = 20


def _item_words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, _, offsets, data in textbuf.pieces(pa.array(texts, pa.string())):
        words = textbuf.tokens(offsets, data, textbuf.NOT_ALNUM, textbuf.LOWER_VALUES)
        out += [words.hashes[words.first[i] : words.first[i + 1]] for i in range(len(offsets) - 1)]
    return out


class _Lookup:
    """Membership and place of 64-bit values in a sorted list, behind a bit table."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[self.values >> np.uint64(64 - _BITS)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``values`` of members, and their places in the list."""
        if not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        may = np.flatnonzero(self.table[values >> np.uint64(64 - _BITS)])
        at = np.minimum(np.searchsorted(self.values, values[may]), len(self.values) - 1)
        hit = self.values[at] == values[may]
        return may[hit], at[hit]


def seed_uses(docs: DataFrame, grams: np.ndarray) -> dict[int, int]:
    """How often each of the test items' n-grams stands in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(np.unique(grams))

    def run(batches):
        look = _Lookup(sent.value)
        count = np.zeros(len(look.values), np.int64)
        for batch in batches:
            for _, _, offsets, data in textbuf.pieces(batch.column("text")):
                words = textbuf.tokens(offsets, data, textbuf.NOT_ALNUM, textbuf.LOWER_VALUES)
                _, at = look.find(textbuf.shingle_hashes(words.hashes, SEED))
                count += np.bincount(at, minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(look.values[used].view(np.int64)), pa.array(count[used])], names=["gram", "n"]
        )

    found = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {int(np.int64(g).astype(np.uint64)): n for g, n in found.collect()}  # at most the items' own n-grams


@dataclass
class Seeds:
    grams: np.ndarray
    #: For ``grams[k]``: entries ``first[k]:first[k + 1]`` of ``item`` and ``place``.
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    words: list[np.ndarray]
    item_ids: list[int]


def choose_seeds(items: list[np.ndarray], ids: list[int], uses: dict[int, int]) -> Seeds:
    """Of every ``SPACING`` neighbouring n-grams of an item, the one used least in the documents.

    Rarity is relative: each stretch keeps a seed, however often the item itself was copied, and
    any SEED + SPACING - 1 words left as they were hold one.
    """
    grams, item, place = [], [], []
    for i, words in enumerate(items):
        own = textbuf.shingle_hashes(words, SEED) if len(words) >= SEED else words[:0]
        n = [uses.get(int(g), 0) for g in own]
        for at in {min(range(s, s + SPACING), key=n.__getitem__) for s in range(max(0, len(own) - SPACING + 1))} or (
            {min(range(len(own)), key=n.__getitem__)} if len(own) else ()
        ):
            grams.append(own[at])
            item.append(i)
            place.append(at)
    order = np.argsort(np.array(grams, np.uint64), kind="stable")
    grams = np.array(grams, np.uint64)[order]
    unique, first = np.unique(grams, return_index=True)
    return Seeds(unique, np.append(first, len(grams)), np.array(item, np.int64)[order], np.array(place, np.int64)[order], items, ids)


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> int:
    """Best local alignment score of two word sequences; gaps cost ``GAP`` a word."""
    idx = np.arange(len(passage) + 1) * -GAP
    row, best = np.zeros(len(passage) + 1, np.int64), 0
    for word in item:
        step = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP)
        row = np.concatenate(([0], np.maximum(step, 0)))
        row = np.maximum.accumulate(row + idx) - idx
        best = max(best, int(row.max()))
    return best


def _clusters(item: np.ndarray, starts: np.ndarray, length: int):
    """Ranges of seed hits of one item whose alignments could overlap."""
    order = np.argsort(starts)
    starts = starts[order]
    cut = np.flatnonzero(np.diff(starts) > length // 2) + 1
    return [(int(g[0]), int(g[-1])) for g in np.split(starts, cut)]


def aligned(docs: DataFrame, seeds: Seeds, score: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(seeds)

    def run(batches):
        s = sent.value
        look = _Lookup(s.grams)
        bags = [np.unique(w) for w in s.words]
        for batch in batches:
            ids, items, scores = [], [], []
            doc_ids = batch.column("doc_id").to_pylist()
            for row, _, offsets, data in textbuf.pieces(batch.column("text")):
                words = textbuf.tokens(offsets, data, textbuf.NOT_ALNUM, textbuf.LOWER_VALUES)
                at, gram = look.find(textbuf.shingle_hashes(words.hashes, SEED))
                doc = np.searchsorted(words.first, at, side="right") - 1
                inside = at + SEED <= words.first[doc + 1]  # no n-gram across texts
                if not inside.any():
                    continue
                at, gram, doc = at[inside], gram[inside], doc[inside]
                n = s.first[gram + 1] - s.first[gram]
                entry = np.repeat(s.first[gram] - np.cumsum(n) + n, n) + np.arange(n.sum())
                at, doc = np.repeat(at, n), np.repeat(doc, n)
                item, begin = s.item[entry], at - s.place[entry]
                order = np.lexsort((begin, item, doc))
                doc, item, begin = doc[order], item[order], begin[order]
                bounds = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
                for group in np.split(np.arange(len(doc)), bounds):
                    d, i = int(doc[group[0]]), int(item[group[0]])
                    wanted = s.words[i]
                    size, best = len(wanted), 0
                    for low, high in _clusters(item[group], begin[group], size):
                        pad = size // 2 + 2
                        passage = words.hashes[
                            max(words.first[d], low - pad) : min(words.first[d + 1], high + size + pad)
                        ]
                        # no alignment matches more words than both have in common
                        common = np.isin(wanted, np.intersect1d(bags[i], passage)).sum()
                        if common < score * size:
                            continue
                        best = max(best, smith_waterman(wanted, passage))
                        if best == MATCH * size:
                            break
                    if best >= score * MATCH * size:
                        ids.append(doc_ids[row + d])
                        items.append(s.item_ids[i])
                        scores.append(best / (MATCH * size))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(items, pa.int64()), pa.array(scores, pa.float64())],
                    names=["doc_id", "item_id", "score"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id long, item_id long, score double")


def _blocks(items: DataFrame):
    """Test items in blocks of bounded size, by ranges of their number."""
    sizes = items.select("item_id", F.octet_length("text").alias("b")).filter("item_id IS NOT NULL AND b > 0")
    block, held = [], 0
    for item_id, b in sizes.orderBy("item_id").toLocalIterator():
        if block and held + b > 4 * BLOCK_WORDS:
            yield block[0], block[-1]
            block, held = [], 0
        block = [block[0] if block else item_id, item_id]
        held += b
    if block:
        yield block[0], block[-1]


def contaminated(docs: DataFrame, items: DataFrame, score: float = SCORE) -> DataFrame:
    """``doc_id, item_id, score``: best local alignment of each test item found in each document.

    Words are runs of letters and digits (all of what is not ASCII counts as letters), A-Z lower-cased.
    A pair is looked at if they share a seed, a run of four words that is rare among those of the
    item. The score is the Smith-Waterman score over that of the item with itself; pairs under ``score``
    are left out. One test set block is held by every task; larger test sets take more passes.

    Null and empty texts and items, and items of fewer than four words, are in no pair; so are null item
    numbers. Repeated rows of documents give one row (the best). A null ``doc_id`` is kept. Further
    columns are not read. Empty tables: no rows.
    """
    out = None
    for low, high in _blocks(items):
        rows = items.filter(F.col("item_id").between(low, high)).select("item_id", "text").collect()  # one bounded block
        rows = [(i, t) for i, t in rows if t]
        words = _item_words([t for _, t in rows])
        grams = [textbuf.shingle_hashes(w, SEED) for w in words if len(w) >= SEED]
        if not grams:
            continue
        seeds = choose_seeds(words, [i for i, _ in rows], seed_uses(docs, np.concatenate(grams)))
        found = aligned(docs, seeds, score)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double")
    return out.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def drop_contaminated(docs: DataFrame, items: DataFrame, score: float = SCORE) -> DataFrame:
    """``docs`` without those that hold a test item. Rows with a null ``doc_id`` are judged together."""
    number = fresh("_id", docs.columns)
    bad = materialise(contaminated(docs, items, score).select(F.col("doc_id").alias(number)).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad[number]), "left_anti")
