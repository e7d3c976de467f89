"""Secret scan: fixed patterns, and a randomness test battery under false-discovery control.

Candidates are long runs of letters, digits and ``+/_=-``. For each, the encoding it seems to be
written in is inferred, and its characters are tested against uniform random ones of that alphabet:
chi-squared counts, number of runs, serial correlation. The least of the three p-values, times
three, tells how well a random string explains the candidate. Ordinary words fail; how often they pass
by chance at a given length is read off the corpus itself, from the candidates that are letters only.
That gives each other candidate a p-value among ordinary words of its length, and the
Benjamini-Hochberg rule over all candidates of the corpus decides which are reported.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsignal.llm.common import materialise

#: Fixed patterns of the three base kinds, and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same as runs of [0-9a-f]+ of 16 and more
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
FDR = 0.01
#: A candidate that the battery itself refutes at this level is no random string, however rare.
REFUTED = 0.001
#: Length bands (20-23, 24-31, 32-47, 48-, ...) and steps of -log10 of the combined p-value.
BANDS, BINS, STEP = 12, 64, 0.25
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_SETS = [(name, frozenset(chars), {c: i for i, c in enumerate(chars)}, len(chars)) for name, chars in ALPHABETS]


def _chi2_tail(x: float, k: int) -> float:
    """Upper tail of chi-squared, by the Wilson-Hilferty normal."""
    if x <= 0:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _classes(characters) -> list[int]:
    """Counts of digits, capitals, small letters and signs: what short strings can be tested for."""
    kinds = [(c.isdigit(), c.isupper(), c.islower()) for c in characters]
    found = [sum(k[i] for k in kinds) for i in range(3)]
    return [*found, len(kinds) - sum(found)]


def battery(token: str) -> tuple[str, float]:
    """Inferred encoding and combined p-value of ``token`` under uniform random characters."""
    token = token.rstrip("=")
    seen = set(token)
    for name, chars, index, size in _SETS:
        if seen <= chars:
            break
    else:
        return "mixed", 0.0
    n = len(token)
    if n < 8:
        return name, 0.0
    at = [index[c] for c in token]
    counts = [0] * 8  # eight equal stretches of the alphabet, so that each is expected often enough
    for i in at:
        counts[i * 8 // size] += 1
    sizes = [sum(1 for i in range(size) if i * 8 // size == g) for g in range(8)]
    uniform = _chi2_tail(sum((c - n * s / size) ** 2 / (n * s / size) for c, s in zip(counts, sizes)), 7)
    if size > 36:  # letters of both cases and digits
        expected = [n * c / size for c in _classes(index)]
        pairs = [(c, e) for c, e in zip(_classes(token), expected) if e]
        classes = sum((c - e) ** 2 / e for c, e in pairs)
        uniform = min(1.0, 2 * min(uniform, _chi2_tail(classes, len(pairs) - 1)))
    high = [i * 2 >= size for i in at]
    a = sum(high)
    b = n - a
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        run_p = math.erfc(abs(runs - mean) / math.sqrt(2 * var))
    else:
        run_p = 2.0 ** (1 - n)
    mid = sum(at) / n
    spread = sum((i - mid) ** 2 for i in at)
    if spread:
        r = sum((x - mid) * (y - mid) for x, y in zip(at, at[1:])) / spread
        serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    else:
        serial = 0.0
    return name, min(1.0, 3 * min(uniform, run_p, serial))


def _band(length: int) -> int:
    return min(BANDS - 1, int(2 * math.log2(length / 20)))


def _bin(p: float) -> int:
    """0 for p near 1, higher for worse fits."""
    return BINS - 1 if p <= 0 else min(BINS - 1, int(-math.log10(p) / STEP))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns, sorted."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, bool, int, int]]:
    """``(start, end, letters only, band, bin)`` of candidates that touch no base span."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if any(a < e and s < b for a, _, b in taken):
            continue
        token = m[0]
        name, p = battery(token)
        out.append((s, e, token.isalpha(), _band(e - s), _bin(p)))
    return out


_FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<start:int,kind:int,end:int>>, maybe array<struct<start:int,end:int,plain:boolean,band:int,bin:int>>"
)


def scan_texts(docs: DataFrame) -> DataFrame:
    """Base spans and tested candidates of every text."""
    spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    tested = pa.list_(pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("plain", pa.bool_()), ("band", pa.int32()), ("bin", pa.int32())]
    ))

    def run(batches):
        for batch in batches:
            counts, sums, bases, maybes = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = base_spans(text or "")
                counts.append([sum(k == kind for _, k, _ in found) for kind in range(3)])
                sums.append(hashlib.sha256(_written(found).encode()).hexdigest())
                bases.append([dict(zip(("start", "kind", "end"), x)) for x in found])
                maybes.append([dict(zip(("start", "end", "plain", "band", "bin"), x)) for x in candidates(text or "", found)])
            cols = np.array(counts, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(cols[:, k]) for k in range(3)], pa.array(sums, pa.string()),
                 pa.array(bases, spans), pa.array(maybes, tested)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "maybe"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def reported_cells(ordinary: dict[tuple[int, int], int], other: dict[tuple[int, int], int], rate: float = FDR) -> set[tuple[int, int]]:
    """Cells ``(band, bin)`` whose candidates are reported.

    The p-value of a cell is the share of ordinary candidates of its length band and of shorter ones
    that fit randomness as well or better, counted with one more. Shorter words pass more easily,
    so that including them only makes the p-value larger. Benjamini-Hochberg over all other
    candidates of the corpus.
    """
    p_of = {}
    for band, bin_ in other:
        upto = [(bin_of, n) for (b, bin_of), n in ordinary.items() if b <= band]
        total = sum(n for _, n in upto)
        as_good = sum(n for bin_of, n in upto if bin_of <= bin_)
        p_of[band, bin_] = 1.0 if bin_ > _bin(REFUTED) else (1 + as_good) / (1 + total)
    m = sum(other.values())
    level, rank = 0.0, 0
    for p in sorted(set(p_of.values())):
        rank = sum(n for cell, n in other.items() if p_of[cell] <= p)
        if p <= rate * rank / m:
            level = p
    return {cell for cell, p in p_of.items() if p <= level}


def find_secrets(docs: DataFrame, rate: float = FDR) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row per document.

    Positions are code points, ends exclusive. ``spans`` lists the base spans and those of the method
    (kind ``random``) by start, then kind. A candidate that touches a base span is not tested. Null
    and empty texts have no span. Rows that repeat are scanned each; a null ``doc_id`` is kept. Further
    columns are not read. Empty table: no rows.
    """
    found = materialise(scan_texts(docs), "scanned")
    cells = found.select(F.explode("maybe").alias("m")).groupBy("m.plain", "m.band", "m.bin").count().collect()
    ordinary = {(r["band"], r["bin"]): r["count"] for r in cells if r["plain"]}  # at most BANDS * BINS cells
    other = {(r["band"], r["bin"]): r["count"] for r in cells if not r["plain"]}
    chosen = sorted(b * BINS + i for b, i in reported_cells(ordinary, other, rate))
    hit = F.array(*[F.lit(c) for c in chosen]) if chosen else F.array().cast("array<int>")
    random = F.filter("maybe", lambda m: ~m["plain"] & F.array_contains(hit, m["band"] * BINS + m["bin"]))
    extra = F.transform(random, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    every = F.transform(
        F.sort_array(F.concat("base", extra)),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(every, ",").alias("spans")
    )
