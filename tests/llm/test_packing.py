import zlib
from collections import defaultdict

import numpy as np
import pytest

from opsignal.llm import packing, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    return tokenizers.Tokenizer.from_file(queries.tokenizer_path())


def check(rows, docs, tokenizer, least_fill=0.97):
    """Every id lies in one piece, with the right checksum; sequences are gapless, of 1024 or a power of two."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["text_row"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert len(by_doc) == len(docs)
    left = [(i, t) for i, t in docs]
    for pieces in by_doc.values():
        pieces.sort(key=lambda r: r["start"])
        fit = next(x for x in left if x[0] == pieces[0]["doc_id"] and _same(x[1], pieces, tokenizer))
        left.remove(fit)
    padded = total = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for r in pieces:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        total += at
        padded += 0 if at & (at - 1) == 0 else 1024 - at
    assert padded == 0
    return total


def _same(text, pieces, tokenizer):
    ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    if pieces[0]["doc_tokens"] != len(ids):
        return False
    at = 0
    for r in pieces:
        assert r["start"] == at and r["length"] > 0
        if zlib.crc32(ids[at : at + r["length"]].tobytes()) != r["ids_crc32"]:
            return False
        at += r["length"]
    return at == len(ids)


def test_all_documents_are_packed_whole(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    rows = packing.pack_documents(docs, queries.tokenizer_path()).collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], tokenizer)


def test_edges(spark, edge_docs, no_docs, tokenizer):
    rows = packing.pack_documents(edge_docs, queries.tokenizer_path()).collect()
    check(rows, [tuple(r) for r in edge_docs.select("doc_id", "text").collect()], tokenizer)
    assert packing.pack_documents(no_docs, queries.tokenizer_path()).collect() == []


@pytest.mark.parametrize(
    "text", ["a  b", " lead", "trail ", "x\n y", "a  b", "<|endoftext|> in <|endoftext|>", "don't we'll 12 é漢 !?", " q z", "tab\there now"]
)
def test_cut_text_encodes_as_whole_text(tokenizer, text):
    own = np.frombuffer(packing.Encoder(queries.tokenizer_path()).ids(text), "<u4").tolist()
    assert own == tokenizer.encode(text, add_special_tokens=False).ids


def test_place_takes_the_least_sum_of_squares():
    rng = np.random.default_rng(3)
    level, fills = packing.Level(32), []
    for size in rng.integers(1, 32, 500):
        size = int(size)

        def cost(choice):
            after = fills + [size] if choice == 0 else None
            if after is None:
                after = list(fills)
                after.remove(choice)
                after.append(choice + size)
            counts = np.bincount([f for f in after if f < 32], minlength=33)
            return int((counts**2).sum())

        got = level.place(size)
        options = [0, *{f for f in fills if f + size <= 32}]
        assert cost(got) == min(map(cost, options))
        if got:
            fills.remove(got)
            level.take(got)
        fills.append(got + size)
        if got + size < 32:
            level.add(got + size, 0)
        fills = [f for f in fills if f < 32]


def test_uneven_blanks_are_encoded_whole(tokenizer):
    enc = packing.Encoder(queries.tokenizer_path())
    texts = ["a  b", " a", "a ", "\ta b", "a\n b", "a \nb", "a\nb c", "é  ß", "x  y", "", "one two", "日本 語 one", "a\tb two two", "\x1c a", "a \x1f b"]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, enc.batch(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_memory_is_emptied_between_batches(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    monkeypatch.setattr(packing, "TEXT_BYTES", 8)
    enc = packing.Encoder(queries.tokenizer_path())
    for text in ("one two three four five six", "six seven", "one one one", "tokenization of longer words"):
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("sizes", ([600] * 5000, [600, 700, 30, 500] * 2000, [1023] * 3000))
def test_open_windows_are_bounded_by_cutting(sizes):
    packer, out, most = packing.Packer(1024, 64), [], 0
    for row, size in enumerate(sizes):
        out += packer.add(row, size)
        most = max(most, len(packer.items))
    before = len(out)
    out += packer.finish()
    assert most <= 65 and before > len(out) - 200
    pieces, windows = defaultdict(list), defaultdict(list)
    for row, start, length, number, at in out:
        pieces[row].append((start, length))
        windows[number].append((at, length))
    for row, size in enumerate(sizes):
        at = 0
        for start, length in sorted(pieces[row]):
            assert start == at and length > 0
            at += length
        assert at == size
    fills = []
    for parts in windows.values():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        fills.append(at)
    assert sum(f < 1024 for f in fills) <= 10 and all(f & (f - 1) == 0 for f in fills)
