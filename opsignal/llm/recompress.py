"""Removal of repeated word sequences by recompression.

A text is a sequence of words, each named by a hash. A round rewrites the sequence: either every run of
one symbol becomes a symbol, or every pair of a left and the right symbol after it does (which symbols
are left and which are right is drawn anew, by name, in each round). The name of a new symbol is made
from those it stands for, so it is the same in every task and text, and whether two neighbours are joined
depends on nothing but the two. Equal passages therefore get equal symbols except near their ends.

1. The rounds name all texts; one count over the corpus finds the symbols that stand at more than one
   place, and the texts whose topmost name, that of the whole text, does (copies).
2. A window of words can only be repeated if all symbols of the last round that lie inside it whatever
   stands around it are shared. Such windows are signed: round by round, what their ends lose to symbols
   that may reach beyond them is folded into the signature, in the end the symbols that remain. Windows
   are equal if these foldings are.
3. Signatures that stand twice are repeated windows; their words go.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import materialise

WINDOW = 35
#: Rounds that join pairs, after one that joins runs. Six make symbols of about six words; windows of 35
#: words then keep, on either side of what their ends lose, about three whole symbols.
ROUNDS = 6

#: Marks of a text in place of a symbol's number: a copy, and the copy that stands for the others.
COPY, FIRST = -1, -2

_C = np.uint64(0xD1342543DE82EF95)
_KEY = "doc_id long, text_hash long"


@dataclass
class Round:
    """A rewriting: symbol ``i`` became part of symbol ``parent[i]``, which begins at symbol ``first[parent[i]]``."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    #: For pairs: which symbols are right ones. None: the round joined runs.
    right: np.ndarray | None


def _rewrite(symbols: np.ndarray, text: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, Round]:
    """One round over neighbouring symbols of the same text: names, texts and how they came about."""
    n = len(symbols)
    same = np.zeros(n, bool)
    same[1:] = text[1:] == text[:-1]
    with np.errstate(over="ignore"):
        if number == 0:
            right = None
            same[1:] &= symbols[1:] == symbols[:-1]
        else:
            right = (textbuf.mix(symbols + np.uint64(number) * _C) >> np.uint64(63)).astype(bool)
            same[1:] &= right[1:] & ~right[:-1]
        first = np.flatnonzero(~same)
        names = symbols[first]
        if right is None:
            size = np.diff(np.append(first, n)).astype(np.uint64)
            names = np.where(size > 1, textbuf.mix(names * _C + size), names)
        else:
            second = np.flatnonzero(same)
            at = np.searchsorted(first, second) - 1
            names[at] = textbuf.mix((symbols[second - 1] * _C + symbols[second]) * _C + np.uint64(number))
    parent = np.cumsum(~same) - 1
    return names, text[first], Round(symbols, parent, np.append(first, n), right)


def parse(words: np.ndarray, text: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, list[Round]]:
    """Symbols after the last round, the text of each, and all rounds."""
    found = []
    for number in range(rounds + 1):
        words, text, step = _rewrite(words, text, number)
        found.append(step)
    return words, text, found


def _fold(signs: np.ndarray | None, rows: np.ndarray, symbols: np.ndarray, tag) -> None:
    if signs is not None:
        with np.errstate(over="ignore"):
            tag = np.asarray(tag).astype(np.uint64)
            tag = tag[rows] if tag.ndim else tag
            signs[rows] = textbuf.mix(signs[rows] * _C + textbuf.mix(symbols[rows] + tag * _C))


def narrow(steps: list[Round], left: np.ndarray, right: np.ndarray, signs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """From words ``left:right`` to the symbols inside, whatever stands around; what is lost goes into ``signs``."""
    for number, step in enumerate(steps):
        live = left < right
        low, high = np.where(live, left, 0), np.where(live, right - 1, 0)
        if step.right is None:  # the runs at both ends may go on outside
            a, b = step.parent[low], step.parent[high]
            _fold(signs, live, step.symbols[low], np.minimum(step.first[a + 1], right) - left)
            _fold(signs, live & (a < b), step.symbols[high], right - np.maximum(step.first[b], left))
            left, right = a + 1, b
        else:  # a right symbol may be joined to one before, a left symbol to one behind
            lost = live & step.right[low]
            _fold(signs, lost, step.symbols[low], 2 * number)
            left = left + lost
            live = left < right
            lost = live & ~step.right[high]
            _fold(signs, lost, step.symbols[high], 2 * number + 1)
            right = right - lost
            live = left < right
            left, right = step.parent[np.where(live, left, 0)], step.parent[np.where(live, right - 1, 0)] + 1
        gone = ~live | (left >= right)
        left, right = np.where(gone, 0, left), np.where(gone, 0, right)
    return left, right


def _words(offsets: np.ndarray, data: np.ndarray) -> tuple[textbuf.Tokens, np.ndarray]:
    words = textbuf.tokens(offsets, data, textbuf.SPACE, textbuf.BYTE_VALUES)
    return words, np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))


def _spaced(data: np.ndarray, words: textbuf.Tokens, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words to keep with one space after each, and where each text's begin."""
    starts, size = words.starts, words.ends - words.starts + 1
    before = np.concatenate(([0], np.cumsum(np.where(kept, size, 0))))
    starts, size = starts[kept], size[kept]
    to = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(to[-1]) + np.repeat(starts - to[:-1], size)
    out = data[np.minimum(at, max(0, len(data) - 1))] if len(data) else data.copy()
    out[to[1:] - 1] = 32
    return out, before[words.first]


def _within(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys stand more than once, and one place of each of those."""
    _, first, number, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return count[number] > 1, first[count > 1]


def _rows(batch: pa.RecordBatch, names: list[str], *parts: tuple) -> pa.RecordBatch:
    """``doc_id, text_hash`` (of the batch's rows; -1: null) and further columns from parts one below the other; 0: null."""
    row = np.concatenate([p[0] for p in parts])
    at = pa.array(row, mask=row < 0)
    columns = [batch.column("doc_id").take(at), batch.column("text_hash").take(at)]
    sizes = [len(p[0]) for p in parts]
    for k in range(1, len(parts[0])):
        kind = next(p[k] for p in parts if not isinstance(p[k], int)).type
        columns.append(pa.concat_arrays([pa.nulls(n, kind) if isinstance(p[k], int) else p[k] for p, n in zip(parts, sizes)]))
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", *names])


def _lists(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Values of each row (in order of rows) as lists."""
    rows, first = np.unique(row, return_index=True)
    return rows, pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), pa.array(value.astype(np.int32)))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def name_texts(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """Symbols of the last round: ``doc_id, text_hash, name, check, symbol, weight, known``.

    Weight 1: a symbol. Weight 2, without a text: a name that stands twice among the texts of a batch, whose
    symbols are ``known``, one row per text, and need not be looked for. Weight 0: a whole text.
    """

    def run(batches):
        for batch in batches:
            row, name, number, whole, top, check = ([] for _ in range(6))
            for at, _, offsets, data in textbuf.pieces(batch.column("text")):
                words, text = _words(offsets, data)
                long = (np.diff(words.first) >= window)[text]
                if not long.any():
                    continue
                hashes, text = words.hashes[long], text[long]
                symbols, of, _ = parse(hashes, text, rounds)
                row.append(at + of)
                name.append(symbols)
                number.append(np.arange(len(of)) - np.searchsorted(of, of))
                # the name of a whole text folds its symbols; the words themselves give a second one
                texts = np.unique(text)
                whole.append(at + texts)
                for out, values, of_text in ((top, symbols, of), (check, hashes, text)):
                    ends = [np.searchsorted(of_text, texts, side=side) for side in ("left", "right")]
                    out.append(textbuf.run_hash(textbuf.run_sums(values), *ends))
            if not row:
                continue
            row, name, number, whole, top, check = map(np.concatenate, (row, name, number, whole, top, check))
            twice, one = _within(name)
            known = _lists(row[twice], number[twice])
            yield _rows(
                batch,
                ["name", "check", "symbol", "weight", "known"],
                (row[~twice], _longs(name[~twice]), 0, _ints(number[~twice]), _ints(np.ones((~twice).sum())), 0),
                (np.full(len(one), -1), _longs(name[one]), 0, 0, _ints(np.full(len(one), 2)), 0),
                (whole, _longs(top), _longs(check), 0, _ints(np.zeros(len(whole))), 0),
                (known[0], 0, 0, 0, 0, known[1]),
            )

    return docs.mapInArrow(run, f"{_KEY}, name long, check long, symbol int, weight int, known array<int>")


def shared_symbols(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """``doc_id, text_hash, marks``: numbers of a text's shared symbols; ``COPY`` or ``FIRST`` if the whole text stands twice."""
    named = materialise(name_texts(docs, window, rounds), "names")
    twice = named.filter("weight > 0").groupBy("name").agg(F.sum("weight").alias("n")).filter("n > 1").select("name")
    inner = named.filter("weight = 1").join(twice.hint("merge"), "name", "left_semi")
    inner = inner.groupBy("doc_id", "text_hash").agg(F.collect_set("symbol").alias("marks"))
    known = named.filter("known IS NOT NULL").select("doc_id", "text_hash", F.col("known").alias("marks"))
    whole, place = named.filter("weight = 0"), F.struct("doc_id", "text_hash")
    copies = whole.groupBy("name", "check").agg(F.count("*").alias("n"), F.min(place).alias("origin")).filter("n > 1")
    copies = whole.join(copies.hint("merge"), ["name", "check"])
    kind = F.when(place.eqNullSafe(F.col("origin")), FIRST).otherwise(COPY).cast("int")
    marks = inner.unionByName(known).unionByName(copies.select("doc_id", "text_hash", F.array(kind).alias("marks")))
    return marks.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("marks")).alias("marks"))


def _keyed(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """All documents, with what was found for them."""
    marks = marks.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = docs["doc_id"].eqNullSafe(marks["_id"]) & docs["text_hash"].eqNullSafe(marks["_hash"])
    return docs.join(marks.hint("merge"), same, "left").drop("_id", "_hash")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(row, value)`` of a column of lists; null lists are empty."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), size), column.flatten().to_numpy(zero_copy_only=False)


def sign_windows(docs: DataFrame, marks: DataFrame, window: int, rounds: int) -> DataFrame:
    """Signed windows that may be repeated: ``doc_id, text_hash, weight, a, b, at, starts``.

    Weight 1: a window, ``at`` its first word. Weight 2, without a text: a signature that stands twice in a
    batch, whose windows need not be looked for; ``starts``, one row per text, holds as many of their first
    words as cover the same. The first of a group of copies gives its signatures with weight 2 on behalf of
    all, the others give none.
    """

    def run(batches):
        for batch in batches:
            mark_row, mark = _numbers(batch.column("marks"))
            n = len(batch)
            copy, first = np.zeros(n, bool), np.zeros(n, bool)
            copy[mark_row[mark < 0]] = True
            first[mark_row[mark == FIRST]] = True
            row, a, b, at = [], [], [], []
            for base, end, offsets, data in textbuf.pieces(batch.column("text")):
                words, text = _words(offsets, data)
                start = np.arange(max(0, len(text) - window + 1))
                start = start[text[start] == text[start + window - 1]]
                start = start[~copy[base + text[start]] | first[base + text[start]]]
                if not len(start):
                    continue
                symbols, of, steps = parse(words.hashes, text, rounds)
                here = (mark >= 0) & (mark_row >= base) & (mark_row < end)
                shared = np.zeros(len(symbols) + 1, np.int64)
                shared[np.searchsorted(of, mark_row[here] - base) + mark[here] + 1] = 1
                shared = np.cumsum(shared)
                left, right = narrow(steps, start, start + window)
                start = start[(shared[right] - shared[left] == right - left) | first[base + text[start]]]
                signs = np.zeros(len(start), np.uint64)
                left, right = narrow(steps, start, start + window, signs)
                with np.errstate(over="ignore"):
                    a.append(textbuf.mix(signs * _C + textbuf.run_hash(textbuf.run_sums(symbols), left, right)))
                b.append(textbuf.run_hash(textbuf.run_sums(words.hashes), start, start + window))
                at.append(start - words.first[text[start]])
                row.append(base + text[start])
            if not row:
                continue
            row, a, b, at = map(np.concatenate, (row, a, b, at))
            twice, one = _within(a ^ textbuf.mix(b))
            alone = ~twice & ~first[row]
            vouch = np.concatenate((one, np.flatnonzero(~twice & first[row])))
            begin, own = at[twice & ~first[row]], row[twice & ~first[row]]
            new = np.ones(len(own), bool)  # of windows side by side, those a window apart and the last
            new[1:] = (own[1:] != own[:-1]) | (begin[1:] != begin[:-1] + 1)
            place = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
            cover = (place % window == 0) | np.append(new[1:], True)[: len(own)]
            known = _lists(own[cover], begin[cover])
            yield _rows(
                batch,
                ["weight", "a", "b", "at", "starts"],
                (row[alone], _ints(np.ones(alone.sum())), _longs(a[alone]), _longs(b[alone]), _ints(at[alone]), 0),
                (np.full(len(vouch), -1), _ints(np.full(len(vouch), 2)), _longs(a[vouch]), _longs(b[vouch]), 0, 0),
                (known[0], 0, 0, 0, 0, known[1]),
            )

    return _keyed(docs, marks).mapInArrow(run, f"{_KEY}, weight int, a long, b long, at int, starts array<int>")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, starts``: where repeated windows start, in up to two rows for a text."""
    twice = windows.filter("weight > 0").groupBy("a", "b").agg(F.sum("weight").alias("n")).filter("n > 1").select("a", "b")
    found = windows.filter("weight = 1").join(twice.hint("merge"), ["a", "b"], "left_semi")
    found = found.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("starts"))
    return found.unionByName(windows.filter("starts IS NOT NULL").select("doc_id", "text_hash", "starts"))


def _without(docs: DataFrame, starts: DataFrame, window: int) -> DataFrame:
    """Texts less the words that a repeated window covers; a start of ``COPY`` covers all."""

    def run(batches):
        for batch in batches:
            at_row, at = _numbers(batch.column("starts"))
            kept, n_words, removed = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, end, offsets, data in textbuf.pieces(batch.column("text")):
                words, text = _words(offsets, data)
                here = (at_row >= row) & (at_row < end)
                own, begin = at_row[here] - row, at[here]
                stop = np.where(begin == COPY, words.first[own + 1], words.first[own] + begin + window)
                begin = words.first[own] + np.maximum(begin, 0)
                level = np.bincount(begin, minlength=len(text) + 1) - np.bincount(stop, minlength=len(text) + 1)
                gone = np.cumsum(level)[:-1] > 0
                n_words.append(np.diff(words.first))
                removed.append(np.bincount(text[gone], minlength=end - row))
                spaced, bounds = _spaced(data, words, ~gone)
                kept += [spaced[a : max(a, b - 1)].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]
            text = pc.if_else(batch.column("text").is_null(), pa.scalar(None, pa.string()), pa.array(kept, pa.string()))
            counts = [pa.array(np.concatenate(c).astype(np.int64)) for c in (n_words, removed)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, text], names=["doc_id", "n_words", "n_removed", "text"])

    return _keyed(docs, starts).mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: every document less its repeated passages.

    A window is a run of ``window`` words (between white space 0x20 and 0x09 to 0x0D) of one text. A word
    goes if a window covers it whose words also stand at another place, in another text or the same one,
    overlapping or not. All places lose the words, the first one too. ``text`` holds the words left, joined
    by one space.

    Null text: stays null, without words. Empty and blank texts, and those with fewer words than a window,
    lose nothing. Rows that repeat number and text are copies like any others. Null ``doc_id``: a number of
    its own. Texts are read whole, whatever their length. Further columns are not read. Empty table: no rows.
    ``rounds`` changes the work, not the result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    marks = materialise(shared_symbols(texts, window, rounds), "marks")
    windows = materialise(sign_windows(texts, marks, window, rounds), "windows")
    copies = marks.filter(F.array_contains("marks", COPY) | F.array_contains("marks", FIRST))
    copies = copies.select("doc_id", "text_hash", F.array(F.lit(COPY)).alias("starts"))
    starts = repeated_windows(windows).unionByName(copies).groupBy("doc_id", "text_hash")
    starts = materialise(starts.agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")
    return _without(texts, starts, window)
