"""Packing of documents into fixed token windows by the sum-of-squares rule."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 1024
END = b"\0\0\0\0"
#: Distinct chunks that a worker remembers; beyond, it begins anew with the next batch.
CACHE = 500_000
#: Bytes of new chunks that are encoded as one text.
TEXT_BYTES = 1 << 16
#: Windows that a partition keeps open; beyond, the older half is closed by cutting.
OPEN_WINDOWS = 4096

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, text_row long"
)

#: A space beside other white space: there the tokenizer may merge across it.
_UNEVEN = re.compile(r" (?:(?=\s)|(?<=\s ))")


class Chunks:
    """Chunks by number, in order of appearance, with their ids one behind the other."""

    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.known = 0
        self.ids = [np.zeros(0, "<u4")]
        self.size = [np.zeros(0, np.int64)]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        self.ids, self.size = [np.concatenate(self.ids)], [np.concatenate(self.size)]
        return self.ids[0], self.size[0]


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer never merges across a space that stands between two other visible
    characters, so a text is cut there and each chunk is encoded once and remembered. New
    chunks of a batch are joined to long texts; their ids are told apart by the bytes that
    every id stands for. Other texts are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()  # a character for each byte
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.width[number] = len(token)
        self.chunks = Chunks()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _learn(self) -> None:
        """Encode the chunks that came with this batch. The first chunk of a text is marked by a tab before it."""
        cache = self.chunks
        new = list(islice(cache.number, cache.known, None))
        cache.known = len(cache.number)
        first = [c[0] == "\t" for c in new]
        plain = [" " + c for c, f in zip(new, first) if not f]
        alone = self._encode([c[1:] for c, f in zip(new, first) if f])
        size = np.array([len(c.encode()) for c in plain], np.int64)
        end = np.cumsum(size)
        cuts = np.searchsorted(end, np.arange(TEXT_BYTES, end[-1] + TEXT_BYTES, TEXT_BYTES), side="right") if len(end) else []
        bounds = np.unique(np.concatenate(([0], cuts, [len(plain)])).astype(np.int64))
        joined = self._encode(["".join(plain[a:b]) for a, b in zip(bounds[:-1], bounds[1:])])
        counts = [np.zeros(0, np.int64)]
        for ids, a, b in zip(joined, bounds[:-1], bounds[1:]):
            at = np.cumsum(self.width[ids])
            stop = np.cumsum(size[a:b])
            last = np.searchsorted(at, stop)
            if not (last < len(at)).all() or not (at[last] == stop).all():
                raise ValueError("ids do not end where chunks do")
            counts.append(np.diff(np.concatenate(([0], last + 1))))
        # back into order of appearance: chunks of both kinds side by side
        ids = np.concatenate([np.zeros(0, "<u4"), *joined, *alone])
        n = np.concatenate([*counts, [len(x) for x in alone]]).astype(np.int64)
        place = np.concatenate((np.flatnonzero(~np.array(first, bool)), np.flatnonzero(np.array(first, bool))))
        start = np.cumsum(n) - n
        order = np.empty(len(new), np.int64)
        order[place] = np.arange(len(new))
        cache.ids.append(_gather(ids, start[order], n[order]))
        cache.size.append(n[order])

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        if len(self.chunks.number) > CACHE:
            self.chunks = Chunks()
        number = self.chunks.number.__getitem__
        numbers, rows, odd = [], [], []
        for row, text in enumerate(texts):
            if not text or text[0].isspace() or text[-1].isspace() or _UNEVEN.search(text):
                odd.append(row)
                continue
            head, *tail = text.split(" ")
            numbers.append(number("\t" + head))
            numbers.extend(map(number, tail))
            rows.append((row, len(tail) + 1))
        self._learn()
        ids, size = self.chunks.table()
        out = [b""] * len(texts)
        taken = np.array(numbers, np.int64)
        start = (np.cumsum(size) - size)[taken]
        words = np.concatenate(([0], np.cumsum([n for _, n in rows]))).astype(np.int64)
        for low in range(0, len(rows), 64):  # some texts at a time
            a, b = words[low], words[min(low + 64, len(rows))]
            flat = _gather(ids, start[a:b], size[taken[a:b]])
            stop = np.concatenate(([0], np.cumsum(size[taken[a:b]])))[words[low : low + 65] - a]
            for (row, _), x, y in zip(rows[low : low + 64], stop[:-1], stop[1:]):
                out[row] = flat[x:y].tobytes()
        whole = [r for r in odd if texts[r]]
        for row, found in zip(whole, self._encode([texts[r] for r in whole])):
            out[row] = found.tobytes()
        return out

    def ids(self, text: str) -> bytes:
        return self.batch([text])[0]


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` one behind the other."""
    to = np.cumsum(size) - size
    return values[np.arange(size.sum()) + np.repeat(start - to, size)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Level:
    """Partially filled windows by fill level; ``count[h]`` of them are filled to ``h``."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def place(self, size: int) -> int:
        """Level whose windows the piece (shorter than a window) joins, or 0 for a new window.

        Among the levels with room, the one is taken that makes the sum of squared
        counts least. Moving a window from level h to h + size changes the sum by
        2 * (count[h + size] - count[h]) + 2, where full windows count nothing; a new
        window changes it by 2 * count[size] + 1. Ties go to the fuller level.
        """
        count = self.count
        before = count[1 : self.window - size + 1][::-1]
        after = count[size + 1 : self.window + 1][::-1]
        change = 2 * (after - before) + 2
        change[0] -= 1  # to a full window; count[window] stays 0
        change[before == 0] = np.iinfo(np.int64).max
        best = int(np.argmin(change))
        return self.window - size - best if change[best] <= 2 * count[size] + 1 else 0

    def add(self, level: int, number: int) -> None:
        self.open[level].append(number)
        self.count[level] += 1

    def take(self, level: int) -> int:
        self.count[level] -= 1
        return self.open[level].pop()


def _tail_cuts(rest: int) -> list[int]:
    """``rest`` as falling powers of two."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Packer:
    """Places pieces online; yields ``(row, start, length, window number, offset)``.

    Whole windows are cut off a document first; what is left (always shorter than a
    window) is one item of the sum-of-squares rule. A window is only given out when
    it is full. At most ``limit`` windows are open: pieces that fit no others, such as
    many of one size, would keep them all; the older half is then laid end to end and
    cut into full windows. ``finish`` lays the few windows that stayed open end to end, cutting
    their items where a window ends, and cuts the last rest into powers of two, at
    which a window needs no padding.
    """

    def __init__(self, window: int = WINDOW, limit: int = OPEN_WINDOWS):
        self.window, self.limit = window, limit
        self.level = Level(window)
        self.items: dict[int, list[tuple[int, int, int]]] = {}
        self.fill: dict[int, int] = {}
        self.next = 0

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _out(self, number: int, items: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
        at = 0
        for row, start, length in items:
            yield row, start, length, number, at
            at += length

    def add(self, row: int, size: int) -> Iterator[tuple[int, int, int, int, int]]:
        whole = size - size % self.window
        for start in range(0, whole, self.window):
            yield row, start, self.window, self._new(), 0
        if size > whole:
            piece = size - whole
            level = self.level.place(piece)
            number = self.level.take(level) if level else self._new()
            self.items.setdefault(number, []).append((row, whole, piece))
            if level + piece == self.window:
                yield from self._out(number, self.items.pop(number))
            else:
                self.level.add(level + piece, number)
                if len(self.items) > self.limit:
                    yield from self._relieve()

    def _laid(self, left: list[tuple[int, int, int]], rooms: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
        """Items end to end in new windows filled to ``rooms``, cut where one ends."""
        number, at = self._new(), 0
        room = iter(rooms)
        size = next(room, 0)
        for row, start, length in left:
            while length:
                if at == size:
                    number, at, size = self._new(), 0, next(room)
                part = min(length, size - at)
                yield row, start, part, number, at
                start, length, at = start + part, length - part, at + part

    def _relieve(self) -> Iterator[tuple[int, int, int, int, int]]:
        """Close the older half of the open windows; what fills none is one open window again."""
        old = set(islice(self.items, len(self.items) // 2))
        left = [it for n in sorted(old) for it in self.items.pop(n)]
        for h, numbers in enumerate(self.level.open):
            if numbers:
                self.level.open[h] = [n for n in numbers if n not in old]
                self.level.count[h] = len(self.level.open[h])
        rest, kept = sum(n for _, _, n in left) % self.window, []
        while rest:
            row, start, length = left.pop()
            part = min(length, rest)
            kept.append((row, start + length - part, part))
            if part < length:
                left.append((row, start, length - part))
            rest -= part
        yield from self._laid(left, [self.window] * (sum(n for _, _, n in left) // self.window))
        if kept:
            number = self._new()
            self.items[number] = kept[::-1]
            self.level.add(sum(n for _, _, n in kept), number)

    def finish(self) -> Iterator[tuple[int, int, int, int, int]]:
        left = [it for _, items in sorted(self.items.items()) for it in items]
        total = sum(n for _, _, n in left)
        rooms = [self.window] * (total // self.window) + _tail_cuts(total % self.window)
        yield from self._laid(left, rooms)
        self.items.clear()


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, text_row``.

    A document is its token ids followed by id 0. Every partition of ``docs`` is packed on
    its own as its rows stream by: no shuffle, no sort, and memory for at most
    ``OPEN_WINDOWS`` open windows, ``CACHE`` chunks and one batch of texts. Window
    numbers carry the partition number in their upper bits; ``text_row`` numbers the rows
    of a partition likewise, so that rows with one ``doc_id`` stay apart.

    Null or empty text: the document is the single id 0. Null ``doc_id``: kept. Repeated rows:
    each is packed. A text longer than a window fills windows of its own. Empty table: no rows.
    Further columns are not read. Sequences are full but for at most one per power of two and
    partition, whose length is that power.
    """

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 40
        enc, packer, row = encoder(tokenizer_path), Packer(window), 0
        kept: dict[int, list] = {}  # row -> [doc_id, tokens, ids of the piece not given out yet, its start]

        def table(found):
            cols = [[] for _ in range(8)]
            for r, start, length, number, at in found:
                doc_id, total, ids, base, waiting = kept[r]
                ids = ids[4 * (start - base) : 4 * (start - base + length)]
                for c, v in zip(cols, (doc_id, start, length, zlib.crc32(ids), total, part + number, at, part + r)):
                    c.append(v)
                kept[r][4] = waiting - length
                if waiting == length:
                    del kept[r]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "text_row"],
            )

        def placed(batch):
            nonlocal row
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.batch(texts)):
                ids += END
                size = len(ids) // 4
                kept[row] = [doc_id, size, ids, 0, size]
                yield from packer.add(row, size)
                if row in kept and size > window:  # only the last part waits for its window
                    base = size - size % window
                    kept[row][2], kept[row][3] = ids[4 * base :], base
                row += 1

        for batch in batches:
            yield table(placed(batch))
        yield table(packer.finish())

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, SCHEMA)
