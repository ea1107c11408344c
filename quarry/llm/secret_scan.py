"""Operator 2: secret scan by patterns and a randomness test battery.

Base spans come from three patterns (assignments, access keys, hex runs).
The method adds ``random`` spans: every run of at least ``MIN_RUN`` encoding
characters is a candidate, and so is every part of that length between its
``+`` and ``/``, between its ``-`` and ``_``, and between all four; and

1. its encoding is inferred as the smallest alphabet that holds it (hex,
   base32, base62, base64, base64url; runs of digits alone, and runs no
   alphabet fits, are no candidates);
2. a battery tests it against randomness: chi-squared uniformity over the
   alphabet (as the number of equal pairs, standardised by its exact mean and
   variance, which also holds for runs shorter than the alphabet), the
   Wald-Wolfowitz runs test about the middle of the alphabet, and lag-1 serial
   correlation; Fisher's method combines the three, and a run that they
   reject as random is ordinary text;
3. false discoveries are controlled over all candidates of the table: the
   hypothesis is that a run is ordinary text of its alphabet, whose equal
   pairs have a known mean and variance at each length, and whose letters
   follow each other as in the whole table: pairs of neighbours (case and digit
   changes are among them) are counted over all texts, and the likelihood of a
   run among ordinary text against that of random symbols bounds its p-value;
   the smaller of both p-values counts, twice; they are weighted by length and
   pass a weighted
   Benjamini-Hochberg rule at level ``alpha``, taken at the edges of a fixed
   logarithmic grid so that one small histogram of the whole table decides.

Scale: three map-only passes.  The first gives at most one row a pair of
symbols and task, the second one a grid cell and task, both summed by Spark;
the third applies the limit.  Vectorised searches pick
the texts that may hold a match, so the others never reach Python's regular
expressions.  Nothing of a document leaves its task.

Defined results: null and empty texts have no spans (the digest is that of the
empty string); positions count code points, ends are exclusive; a ``random``
span that lies inside a base span or another ``random`` span is not repeated; one row a row of the input,
in whatever number an id repeats; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import record_batch, slices

# The base patterns and their least lengths.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
#: Vectorised searches that every text with a match of the kind fulfils.
MAY_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
MAY_ACCESS = "AKIA"
MAY_HEX = r"[0-9a-f]{24}"

MIN_RUN = 20
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
MAY_RUN = r"[A-Za-z0-9+/_-]{20}"
#: A run whole and its parts, as paths and joined names hold a token among other things.
PARTS = [RUN, re.compile(r"[A-Za-z0-9+/]{20,}"), re.compile(r"[A-Za-z0-9_-]{20,}"), re.compile(r"[A-Za-z0-9]{20,}")]

# Alphabets from small to large; under "ordinary text" two
# symbols agree with probability ``pair`` and three with ``triple`` (decimal
# digits for hex, letters of running text for the others).
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = [
    (DIGITS + "abcdef", 0.1, 0.01),
    (DIGITS + "ABCDEF", 0.1, 0.01),
    (UPPER + "234567", 0.0667, 0.0063),
    (UPPER + LOWER + DIGITS, 0.0667, 0.0063),
    (UPPER + LOWER + DIGITS + "+/", 0.0667, 0.0063),
    (UPPER + LOWER + DIGITS + "-_", 0.0667, 0.0063),
]
CODES = [({c: i for i, c in enumerate(a)}, pair, triple) for a, pair, triple in ALPHABETS]

#: Symbols of runs; everything else is one more symbol, OTHER.
SYMBOLS = {c: i for i, c in enumerate(UPPER + LOWER + DIGITS + "+/-_")}
OTHER = len(SYMBOLS)
SYMBOL_OF = np.full(256, OTHER, np.int64)
SYMBOL_OF[[ord(c) for c in SYMBOLS]] = list(SYMBOLS.values())

ALPHA = 0.01
#: A run that the battery rejects as random at this level is ordinary text.
BATTERY_LEVEL = 0.001
#: Grid cells a decade for the histogram of weighted p-values.
CELLS = 20
LEAST_P = 1e-300


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(codes: list[int], size: int) -> float:
    """Combined p-value of the three tests for random symbols of an alphabet of ``size``."""
    n = len(codes)
    pairs = sum(c * (c - 1) / 2 for c in Counter(codes).values())
    all_pairs = n * (n - 1) / 2
    p_chi = upper_tail((pairs - all_pairs / size) / math.sqrt(all_pairs / size * (1 - 1 / size)))
    high = [c * 2 >= size for c in codes]
    n1 = sum(high)
    n2 = n - n1
    if n1 and n2:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        mean = 2 * n1 * n2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    centre = sum(codes) / n
    spread = sum((c - centre) ** 2 for c in codes)
    if spread:
        r = sum((a - centre) * (b - centre) for a, b in zip(codes, codes[1:], strict=False)) / spread
        p_serial = 2 * upper_tail(abs(r + 1 / n) * math.sqrt(n))
    else:
        p_serial = 2.0 ** (1 - n)
    half = -sum(math.log(max(min(p, 1.0), LEAST_P)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def ordinary_p(codes: list[int], pair: float, triple: float) -> float:
    """How likely ordinary text of this length has as few equal pairs."""
    n = len(codes)
    pairs = sum(c * (c - 1) / 2 for c in Counter(codes).values())
    all_pairs = n * (n - 1) / 2
    var = all_pairs * (pair - pair * pair) + n * (n - 1) * (n - 2) * (triple - pair * pair)
    return upper_tail((all_pairs * pair - pairs - 0.5) / math.sqrt(var))


def likelihood_p(run: str, size: int, costs: list[list[float]]) -> float:
    """Bound of how likely ordinary text has a run that speaks so much for
    random symbols: by Markov's inequality the inverse of the likelihood ratio."""
    last, ordinary = OTHER, 0.0
    for c in run:
        now = SYMBOLS[c]
        ordinary += costs[last][now]
        last = now
    return math.exp(min(0.0, len(run) * math.log(size) - ordinary))


def neighbour_costs(docs: DataFrame) -> list[list[float]]:
    """-log of the share of each symbol after each symbol, over all texts (with one more of each)."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    size = OTHER + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in slices(batches, max_bytes=1 << 20):
            symbols = SYMBOL_OF[np.frombuffer("\n".join(["", *batch.column(0).drop_null().to_pylist(), ""]).encode(), np.uint8)]
            total += np.bincount(symbols[:-1] * size + symbols[1:], minlength=size * size)
        yield record_batch(schema, [np.flatnonzero(total), total[total > 0]])

    table = docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()  # a row a pair of symbols
    counts = np.ones((size, size))
    for r in table:
        counts[divmod(r.pair, size)] += r.n
    return (-np.log(counts / counts.sum(axis=1, keepdims=True))).tolist()


def weight_of(n: int) -> float:
    """Longer runs can carry more evidence, so they get more of the error budget."""
    return min(n, 64) / 32


def candidates(text: str, costs: list[list[float]]) -> Iterator[tuple[int, int, int, float]]:
    """(start, end, grid cell, weight) of every candidate run or part, long ones
    first; one that the battery rejects has p-value 1 and stays in the family."""
    spans = {(m.start() + q.start(), m.start() + q.end()) for m in RUN.finditer(text) for part in PARTS for q in part.finditer(m.group())}
    for start, end in sorted(spans, key=lambda span: (span[0] - span[1], span)):
        run = text[start:end]
        if run.isdigit():
            continue
        for code, pair, triple in CODES:
            if all(c in code for c in run):
                codes = [code[c] for c in run]
                p = 1.0
                if battery(codes, len(code)) >= BATTERY_LEVEL:
                    p = min(1.0, 2 * min(ordinary_p(codes, pair, triple), likelihood_p(run, len(code), costs)))
                weight = weight_of(len(run))
                yield start, end, math.floor(CELLS * math.log10(max(p / weight, LEAST_P))), weight
                break


def base_spans(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns."""
    spans = []
    if assign:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if access:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if hexes:
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_CHARS]
    return sorted(spans)


def _may(texts: pa.Array, pattern: str) -> list[bool]:
    return pc.match_substring_regex(texts, pattern).to_pylist()


def spans_of(texts: pa.Array, limit: int | None, costs: list[list[float]]) -> Iterator[tuple[list, list]]:
    """For each text its base spans and its added random spans."""
    texts = pc.fill_null(texts, "")
    may = [_may(texts, p) for p in (MAY_ASSIGN, MAY_ACCESS, MAY_HEX, MAY_RUN)]
    for i, (assign, access, hexes, run) in enumerate(zip(*may, strict=True)):
        if not (assign or access or hexes or run):
            yield [], []
            continue
        text = texts[i].as_py()
        base = base_spans(text, assign, access, hexes)
        added = []
        if run and limit is not None:
            for a, b, cell, _ in candidates(text, costs):
                if cell <= limit and not any(s <= a and b <= e for s, _, e in base + added):
                    added.append((a, 3, b))
        yield base, added


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def discovery_limit(docs: DataFrame, costs: list[list[float]], alpha: float = ALPHA) -> int | None:
    """The last grid cell whose candidates are discoveries (None: none are)."""
    schema = pa.schema([("cell", pa.int64()), ("n", pa.int64()), ("weight", pa.float64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, weights = Counter(), Counter()
        for batch in slices(batches):
            texts = pc.fill_null(batch.column(0), "")
            for text in texts.filter(pc.match_substring_regex(texts, MAY_RUN)).to_pylist():
                for _, _, cell, weight in candidates(text, costs):
                    n[cell] += 1
                    weights[cell] += weight
        yield record_batch(schema, [list(n), list(n.values()), [weights[c] for c in n]])

    cells = docs.select("text").mapInArrow(count, "cell long, n long, weight double")
    table = sorted(cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).collect())  # a row a grid cell
    total, found, limit = sum(r.weight for r in table), 0, None
    for r in table:
        found += r.n
        if 10 ** ((r.cell + 1) / CELLS) * total <= alpha * found:
            limit = r.cell
    return limit


def scan(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every row."""
    costs = neighbour_costs(docs)
    limit = discovery_limit(docs, costs, alpha)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64())]
        + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_random", pa.int64())]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for base, added in spans_of(batch.column(1), limit, costs):
                kinds = Counter(k for _, k, _ in base)
                digest = hashlib.sha256(join_spans(base).encode()).hexdigest()
                rows.append((kinds[0], kinds[1], kinds[2], digest, join_spans(base + added), len(added)))
            yield record_batch(schema, [batch.column(0), *map(list, zip(*rows, strict=True))])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(find, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redact(docs: DataFrame, mark: str = "[secret]", alpha: float = ALPHA) -> DataFrame:
    """``docs`` with every span (joined where they overlap) replaced by
    ``mark`` in ``text``, and ``n_chars``, if there, counted anew in changed
    rows; null texts stay null.  All other columns pass through."""
    costs = neighbour_costs(docs)
    limit = discovery_limit(docs, costs, alpha)
    at = docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        parts, done = [], 0
        for a, _, b in sorted(spans):
            if a >= done:
                parts += [text[done:a], mark]
            done = max(done, b)
        return "".join([*parts, text[done:]])

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=4 << 20):
            texts, columns = batch.column(at), list(batch.columns)
            new = {i: clean(texts[i].as_py(), base + added) for i, (base, added) in enumerate(spans_of(texts, limit, costs)) if base or added}
            if new:
                columns[at] = pa.array([new.get(i, t) for i, t in enumerate(texts.to_pylist())], texts.type)
                if count_at is not None:
                    counts = columns[count_at]
                    columns[count_at] = pa.array([len(new[i]) if i in new else n for i, n in enumerate(counts.to_pylist())], counts.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(change, docs.schema)
