"""Removal of repeated runs of lines by winnowing.

A window is a run of lines of at least ``words`` words that is no longer than needed: from
every line forwards, and to every line backwards. Each window selects the line of least hash
(the last of equals); the selected lines of a text are its fingerprints. Equal windows select
equal lines, so any run of ``words`` words that stands in two places is found from fingerprints
that are there twice. The windows around shared fingerprints are then joined by their content to
their first place. Windows from every line of a run extend a match to the left and to the right up
to its ends: the forward ones cover all of a repeated run but its last few words, and the backward
one covers those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsignal.llm import textbuf
from opsignal.llm.common import fresh, materialise, with_columns

WORDS = 50
_WINDOWS = "doc_id long, text_hash long, fp long, windows array<struct<content:long,first:int,last:int>>"


def _select(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position of the last least hash of every window (``ends`` included), by doubling minima."""
    n = len(hashes)
    order = np.empty(n, np.int64)
    order[np.lexsort((-np.arange(n), hashes))] = np.arange(n)  # rank; of equals, the last is least
    levels, step = [order], 1
    while 2 * step <= n:
        last = levels[-1]
        levels.append(np.minimum(last[:-step], last[step:]))
        step *= 2
    where = np.argsort(order)
    size = ends - starts + 1
    k = np.frexp(size)[1] - 1
    out = np.empty(len(starts), np.int64)
    for level in np.unique(k):
        m = k == level
        row = levels[level]
        out[m] = where[np.minimum(row[starts[m]], row[ends[m] - (1 << int(level)) + 1])]
    return out


def line_windows(words: np.ndarray, hashes: np.ndarray, least: int):
    """``(first, last, content, selected)`` of the windows over the lines that have words."""
    n = len(words)
    total = np.concatenate(([0], np.cumsum(words)))
    start = np.arange(n)
    end = np.searchsorted(total, total[:-1] + least)  # least e with total[e] - total[start] >= least
    ok = end <= n
    forward = np.stack((start[ok], end[ok] - 1))
    begin = np.searchsorted(total, total[1:] - least, side="right") - 1  # greatest b with enough words
    ok = begin >= 0
    backward = np.stack((begin[ok], np.arange(n)[ok]))
    both = np.concatenate((forward, backward), axis=1)
    both = np.unique((both[0] << 32) | both[1])
    first, last = both >> 32, both & 0xFFFFFFFF
    if not len(first):
        return first, last, np.zeros(0, np.uint64), first
    content = textbuf.run_hash(textbuf.run_sums(hashes), first, last + 1)
    return first, last, content, _select(hashes, first, last)


def _lines(offsets: np.ndarray, data: np.ndarray):
    """Per text: number of lines and, of those with words, their number, words and hash."""
    lines = textbuf.tokens(offsets, data, textbuf.SPACE, textbuf.BYTE_VALUES)
    breaks = np.flatnonzero(data == 10)
    line_of = np.searchsorted(breaks, lines.starts)  # over all texts, a text's first line starts at its own base
    at = np.searchsorted(breaks, offsets)
    for d in range(len(offsets) - 1):
        w0, w1 = lines.first[d], lines.first[d + 1]
        ids = line_of[w0:w1] - at[d]
        if w1 == w0:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
            continue
        new = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        stop = np.append(new[1:], w1 - w0)
        total = textbuf.run_sums(lines.hashes[w0:w1])
        yield ids[new], stop - new, textbuf.run_hash(total, new, stop)


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """One row per fingerprint, with the windows that selected it."""

    def run(batches):
        for batch in batches:
            rows, fps, contents, firsts, lasts, sizes = [], [], [], [], [], []
            for row, _, offsets, data in textbuf.pieces(batch.column("text")):
                for d, (_, n_words, hashes) in enumerate(_lines(offsets, data)):
                    first, last, content, chosen = line_windows(n_words, hashes, words)
                    if not len(first):
                        continue
                    by = np.argsort(chosen, kind="stable")
                    places, counts = np.unique(chosen, return_counts=True)
                    rows.append(np.full(len(places), row + d))
                    fps.append(hashes[places])
                    contents.append(content[by])
                    firsts.append(first[by])
                    lasts.append(last[by])
                    sizes.append(counts)
            if not sizes:
                continue
            bounds = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
            windows = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate(contents).view(np.int64)),
                    pa.array(np.concatenate(firsts).astype(np.int32)),
                    pa.array(np.concatenate(lasts).astype(np.int32)),
                ],
                names=["content", "first", "last"],
            )
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array(np.concatenate(fps).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), windows),
                ],
                names=["doc_id", "text_hash", "fp", "windows"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, _WINDOWS)


def repeated_windows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, text_hash, first, last``: windows (by lines that have words) whose content stands earlier.

    Places are ordered by ``doc_id`` (null first), text hash and line.
    """
    prints = materialise(fingerprints(docs, words), "fingerprints")
    shared = prints.groupBy("fp").agg(F.count("*").alias("places")).filter("places > 1").select("fp")
    # joins of one kind at every size: none of these sides has a bound
    near = prints.join(shared.hint("merge"), "fp", "left_semi").select("doc_id", "text_hash", F.explode("windows").alias("w"))
    near = materialise(near.select("doc_id", "text_hash", "w.*"), "windows")
    # one row per content: the first place is a minimum, made in part before the shuffle
    place = F.struct("doc_id", "text_hash", "first")
    firsts = near.groupBy("content").agg(F.min(place).alias("origin"), F.count("*").alias("places")).filter("places > 1")
    later = near.join(firsts.select("content", "origin").hint("merge"), "content").filter(~place.eqNullSafe(F.col("origin")))
    return later.select("doc_id", "text_hash", "first", "last")


def _cut(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """Text without the spans of lines (counted over lines with words), lines with words, lines deleted.

    A line without words goes with the line with words before it.
    """
    lines = text.split("\n")
    gone = set()
    for first, last in spans:
        gone.update(range(first, last + 1))
    kept, number, drop, deleted = [], -1, False, 0
    for line in lines:
        if line.encode().strip(b" \t\n\x0b\x0c\r"):
            number += 1
            drop = number in gone
            deleted += drop
        if not drop:
            kept.append(line)
    return "\n".join(kept), number + 1, deleted


def dedup_lines(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with ``text`` less repeated runs, and ``n_lines, n_deleted`` (lines that have words).

    A line is deleted if it lies in a run of lines of at least ``words`` words in all that also stands
    at an earlier place: an earlier line of the text, or a text of smaller ``doc_id`` (of equal ones,
    of smaller text hash). Lines are equal if their words are; lines without words count for nothing.
    A run repeated within itself keeps its first line or lines.

    Null text stays null (0, 0); empty and blank texts stay. Rows that repeat both ``doc_id`` and text
    are one place and keep their lines. Null ``doc_id``: comes before all others. Further columns are
    passed on; columns named ``n_lines`` and ``n_deleted`` are replaced. Empty table: no rows.
    """
    found = repeated_windows(docs, words)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    base = docs.select(*columns)
    number, text_hash, spans = (fresh(c, columns) for c in ("_id", "_hash", "_spans"))
    marks = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias(spans))
    marks = materialise(marks.withColumnsRenamed({"doc_id": number, "text_hash": text_hash}), "spans")
    same = base["doc_id"].cast("long").eqNullSafe(marks[number]) & (F.xxhash64(base["text"]) == marks[text_hash])
    joined = base.join(marks.hint("merge"), same, "left").drop(number, text_hash)

    def run(batches):
        for batch in batches:
            texts, before, gone = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column(spans).to_pylist()):
                if text is None:
                    new, n, d = None, 0, 0
                else:
                    new, n, d = _cut(text, [(s["first"], s["last"]) for s in own or ()])
                texts.append(new)
                before.append(n)
                gone.append(d)
            out = batch.drop_columns([spans])
            at = out.schema.get_field_index("text")
            out = out.set_column(at, "text", pa.array(texts, pa.string()))
            out = out.append_column("n_lines", pa.array(before, pa.int64()))
            yield out.append_column("n_deleted", pa.array(gone, pa.int64()))

    schema = with_columns(base.schema, [("n_lines", "long"), ("n_deleted", "long")])
    return joined.mapInArrow(run, schema)
