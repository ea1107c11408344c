"""Repair of conversation structure (operator 11) by grammar-compressed DP.

A conversation becomes a word over nine symbols, one a row: its role's initial
(s, u, a, or o for any other) in lower case, in upper case for a truncated row,
or ``d`` for a row that must go (blank or duplicate).  Edits keep a row (K, 0),
set its role to user or assistant (R, 1), delete it (D, 2), or insert an empty
row (I, 5); a truncated row that stays costs 5 more.  The initials left must
read ``(s?(ua)+)?``, an automaton of four states in which the role that R or I
sets follows from the state.  So a row is a 4 x 4 min-plus matrix whose cells
hold a cost and the audit (the edits' letters); ties take the ASCII-least audit.
Audits of equal cost between the same states are never prefixes of each other,
so the order survives joining and the product is associative.

Method: a task compresses the distinct words of its segments by Re-Pair into
one grammar, evaluates one matrix a rule bottom-up (audits are ropes that share
the parts' ropes), and multiplies the few symbols left of each word.

Plan: only keys travel first: (conv_id, turn, role, digest of the text, flags)
are range-partitioned by conversation and turn, so that a hot conversation is
spread over many tasks, and numbered; the first row of every (conversation,
role, text) is a minimum with map-side combine.  Segments of at most
``SEGMENT`` rows give their matrices, which are folded in order a conversation.
Last, the texts are shuffled once by conversation, and their rows stream past
behind the audit into a SHA-256.  That digest is sequential by definition, so
one task reads all rows of a conversation, holding its audit and a batch.

Results: every conv_id of the table, also null (a conversation of its own),
gives one row.  Null roles and texts are one space; null turns come first.
Rows of equal turn follow role, then the MD5 of the text.  Repeated rows are
rows of their own.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarry.llm.common import Scratch

# Fixed values of the contract.
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Rows of a segment; symbols that share one grammar.
SEGMENT = 4096
GRAMMAR_SYMBOLS = 200_000
#: Ropes up to this length are plain strings.
FLAT = 64

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
    scratch = Scratch(conversations.sparkSession)
    rows = damaged(conversations)
    keys = scratch.store(numbered(rows, scratch), "keys")
    segments = scratch.store(segment_table(keys), "segments")
    audits = scratch.store(fold(segments), "audits")
    return scratch.finish(digests(rows, audits))


# -- rows ---------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): damage by crc32 of ``conv_id:turn``;
    ``copies`` is 0 for a dropped row and 2 for a repeated one."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def _digest(text: str = "text") -> Column:
    return F.md5(F.col(text).cast("binary"))


def numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, turn, symbol, there): the rows in order of ``pos``, with
    their symbols; a dropped row stays as one that is not ``there``."""
    solid = F.translate("text", BLANKS, "")
    initial = F.substring("role", 1, 1)
    keyed = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest().alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (solid == "").alias("blank"),
        (~F.substring(solid, -1, 1).isin(*STOPS)).alias("open"),
        "copies",
        F.monotonically_increasing_id().alias("at"),
    )
    copies = keyed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))))
    order = ["conv_id", "turn", "role", "digest", "at", "copy"]
    ordered = scratch.store(
        copies.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", "turn", "role", "digest", "initial", "blank", "open", (F.col("copies") > 0).alias("there"),
            F.monotonically_increasing_id().alias("pos"),
        ),
        "ordered",
    )
    firsts = ordered.filter("there").groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos"))
    marked = ordered.join(firsts.select("pos", F.lit(True).alias("first")), "pos", "left")
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("open"), F.upper("initial")).otherwise(F.col("initial"))
    return marked.select("conv_id", "pos", "turn", "initial", fault.alias("symbol"), "there")


# -- segments and their matrices -----------------------------------------------

SEGMENT_FIELDS = (
    "pos long, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, turns long, costs array<long>, audits array<string>"
)


class Segment:
    """Statistics and word of consecutive rows of one conversation."""

    def __init__(self, conv, pos: int):
        self.conv, self.pos = conv, pos
        self.word: list[str] = []
        self.first = self.last = None
        self.illegal = self.turns = 0
        self.low = self.high = None

    def add(self, turn, initial: str, symbol: str) -> None:
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.word.append(symbol)

    def row(self, matrix: list) -> tuple:
        word = "".join(self.word)
        return (
            self.conv, self.pos, len(word), word.count("b"), word.count("d"), sum(c.isupper() for c in word), self.illegal,
            self.first, self.last, self.low, self.high, self.turns,
            [None if cell is None else cell[0] for r in matrix for cell in r],
            [None if cell is None else flat(cell[1]) for r in matrix for cell in r],
        )


def segment_table(keys: DataFrame) -> DataFrame:
    """One row a segment: its statistics, and costs and audits of its matrix."""
    conv = keys.schema["conv_id"]
    schema = StructType([StructField("conv_id", conv.dataType), *StructType.fromDDL(SEGMENT_FIELDS).fields])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[Segment] = []
        symbols, now, block = 0, None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "initial", "symbol", "there")]
            for conv_id, pos, turn, initial, symbol, there in zip(*columns, strict=True):
                if now is None or conv_id != now.conv or pos >> 33 != block or len(now.word) >= SEGMENT:
                    if now is not None:
                        done.append(now)
                        symbols += len(now.word)
                    if symbols >= GRAMMAR_SYMBOLS or len(done) >= GRAMMAR_SYMBOLS:
                        yield from rows(done)
                        done, symbols = [], 0
                    now, block = Segment(conv_id, pos), pos >> 33
                if there:
                    now.add(turn, initial, symbol)
        if now is not None:
            yield from rows([*done, now])

    def rows(done: Sequence[Segment]) -> Iterator[pa.RecordBatch]:
        words = sorted({"".join(s.word) for s in done})
        matrices = dict(zip(words, evaluate([w.replace("b", "d") for w in words]), strict=True))
        size = 0
        part: list[tuple] = []
        for s in done:
            part.append(s.row(matrices["".join(s.word)]))
            size += len(s.word) + 16
            if size > 100_000:
                yield table(part)
                part, size = [], 0
        if part:
            yield table(part)

    def table(part: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in schema]
    ordered = keys.repartition(F.shiftright("pos", 33)).sortWithinPartitions("pos")
    return ordered.select("conv_id", "pos", "turn", "initial", "symbol", "there").mapInArrow(run, schema)


# -- min-plus matrices with ropes ------------------------------------------------

#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  Row ends in 0 or 3.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
SET = (2, 2, 3, 2)  # the state after the only role that can be set
ROLE = {2: b"user", 3: b"assistant"}
ACCEPTING = (0, 3)


class Rope:
    """Two joined audits, kept as parts."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left, right, size: int):
        self.left, self.right, self.size = left, right, size


def join(a, b):
    size = length(a) + length(b)
    if size <= FLAT:
        return a + b
    return b if not length(a) else a if not length(b) else Rope(a, b, size)


def length(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope.size


def leaves(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        r = stack.pop()
        if isinstance(r, str):
            yield r
        else:
            stack += (r.right, r.left)


def flat(rope) -> str:
    return "".join(leaves(rope))


def less(a, b) -> bool:
    """Whether audit ``a`` sorts before ``b``; parts shared by both are skipped."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if not isinstance(x, str) and (isinstance(y, str) or x.size >= y.size):
            left += (x.right, x.left)
            right.append(y)
        elif not isinstance(y, str):
            right += (y.right, y.left)
            left.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
    return not left and any(length(r) for r in right)


def better(cell, old) -> bool:
    return old is None or cell[0] < old[0] or (cell[0] == old[0] and less(cell[1], old[1]))


def times(row: list, matrix: list) -> list:
    """A row vector times a matrix."""
    out = [None] * 4
    for k, cell in enumerate(row):
        if cell is None:
            continue
        for j, step in enumerate(matrix[k]):
            if step is None:
                continue
            cost = cell[0] + step[0]
            if out[j] is None or cost <= out[j][0]:
                new = (cost, join(cell[1], step[1]))
                if better(new, out[j]):
                    out[j] = new
    return out


def product(a: list, b: list) -> list:
    return [times(row, b) for row in a]


IDENTITY = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]


def _inserts() -> list:
    """Any number of inserted rows: going round the loop never pays."""
    out = [list(r) for r in IDENTITY]
    for q in range(4):
        at, word = q, ""
        for _ in range(2):
            at, word = SET[at], word + "I"
            if out[q][at] is None:
                out[q][at] = (INSERT * len(word), word)
    return out


INSERTS = _inserts()


def symbol_matrix(symbol: str) -> list:
    """Inserted rows, then one row of this symbol."""
    out = [[None] * 4 for _ in range(4)]
    for q in range(4):
        options = [(DELETE, "D", q)]
        if symbol != "d":
            more = TRUNCATED if symbol.isupper() else 0
            options.append((REROLE + more, "R", SET[q]))
            if (to := KEEP.get((q, symbol.lower()))) is not None:
                options.append((more, "K", to))
        for cost, letter, to in options:
            if better((cost, letter), out[q][to]):
                out[q][to] = (cost, letter)
    return product(INSERTS, out)


SYMBOLS = "dsuaoSUAO"


def evaluate(words: Sequence[str]) -> list[list]:
    """The matrix of every word, through one grammar of all words."""
    rules, compressed = re_pair([[SYMBOLS.index(c) for c in w] for w in words])
    matrices = [symbol_matrix(c) for c in SYMBOLS]
    for left, right in rules:  # a rule's parts come before it
        matrices.append(product(matrices[left], matrices[right]))
    out = []
    for word in compressed:
        m = matrices[word[0]] if word else IDENTITY
        for s in word[1:]:
            m = product(m, matrices[s])
        out.append(m)
    return out


def re_pair(words: Sequence[Sequence[int]], terminals: int = len(SYMBOLS)) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Re-Pair: as long as a pair of neighbours occurs twice, the most frequent
    one becomes a rule.  Returns the rules (rule i is symbol ``terminals + i``)
    and the words over terminals and rules."""
    seq: list[int] = []
    starts = []
    for w in words:
        starts.append(len(seq))
        seq += w
        seq.append(-1)
    after = list(range(1, len(seq) + 1))
    before = list(range(-1, len(seq) - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for p in range(len(seq) - 1):
        if seq[p] >= 0 and seq[p + 1] >= 0:
            places[seq[p], seq[p + 1]].add(p)
    heap = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        at = places.get(pair, ())
        if len(at) != -count:
            if len(at) > 1:
                heapq.heappush(heap, (-len(at), pair))
            continue
        new, changed = terminals + len(rules), set()
        replaced = 0
        for p in sorted(places.pop(pair)):
            q = after[p]
            if seq[p] != pair[0] or q >= len(seq) or seq[q] != pair[1]:
                continue  # overlapped by the occurrence before
            o, r = before[p], after[q]
            if o >= 0 and seq[o] >= 0:
                places[seq[o], seq[p]].discard(o)
                places[seq[o], new].add(o)
                changed.add((seq[o], new))
            if seq[r] >= 0:
                places[seq[q], seq[r]].discard(q)
                places[new, seq[r]].add(p)
                changed.add((new, seq[r]))
            seq[p], seq[q] = new, -2
            after[p] = r
            before[r] = p
            replaced += 1
        if replaced:
            rules.append(pair)
        for other in changed:
            if len(places[other]) > 1:
                heapq.heappush(heap, (-len(places[other]), other))
    out = []
    for start in starts:
        word, p = [], start
        while seq[p] != -1:
            word.append(seq[p])
            p = after[p]
        out.append(word)
    return rules, out


# -- conversations ----------------------------------------------------------------


def fold(segments: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)."""
    conv = segments.schema["conv_id"]
    schema = StructType([StructField("conv_id", conv.dataType), *StructType.fromDDL(", ".join(f"{c} long" for c in COUNTS) + ", audit string").fields])

    def finish(conv_id, total: dict, row: list) -> dict:
        ends = times(row, INSERTS)
        best = None
        for q in ACCEPTING:
            if ends[q] is not None and better(ends[q], best):
                best = ends[q]
        gaps = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
        return {"conv_id": conv_id, "gaps": gaps, **{c: total[c] for c in COUNTS[1:5]}, "cost": best[0], "audit": flat(best[1])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, row = None, None, IDENTITY[0]
        for batch in batches:
            done = []
            for s in batch.to_pylist():
                if total is None or s["conv_id"] != now:
                    if total is not None:
                        done.append(finish(now, total, row))
                    now, row = s["conv_id"], IDENTITY[0]
                    total = dict.fromkeys(COUNTS, 0) | {"turns": 0, "low": None, "high": None, "last": None}
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    total[c] += s[c]
                if s["n"]:
                    if total["last"] is not None and total["last"] + s["first"] not in LEGAL:
                        total["illegal"] += 1
                    total["last"] = s["last"]
                if s["low"] is not None:
                    total["turns"] += s["turns"] - (s["low"] == total["high"])
                    total["low"] = s["low"] if total["low"] is None else total["low"]
                    total["high"] = s["high"]
                cells = [None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True)]
                row = times(row, [cells[i : i + 4] for i in range(0, 16, 4)])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
        if total is not None:
            yield pa.RecordBatch.from_pylist([finish(now, total, row)], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(run, schema)


class Repair:
    """Applies an audit to rows in order and hashes the rows that stay."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.sha, self.empty = hashlib.sha256(), True

    def _put(self, role: bytes, text: bytes) -> None:
        if not self.empty:
            self.sha.update(b"\n")
        self.empty = False
        self.sha.update(role + b":" + text)

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = SET[self.state]
            self._put(ROLE[self.state], b"")

    def row(self, role: bytes, text: bytes) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEEP[self.state, chr(role[0])]
            self._put(role, text)
        elif edit == "R":
            self.state = SET[self.state]
            self._put(ROLE[self.state], text)

    def digest(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with the digest of every repaired conversation; its rows
    stream past behind the audit, in the order that gave the symbols."""
    texts = rows.filter("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", _digest().alias("digest"), "text", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    )
    both = audits.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    schema = StructType([*audits.schema.fields, *StructType.fromDDL("repaired_sha256 string").fields])
    names = audits.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, now = None, None
        for batch in batches:
            heads, done = batch.select(names), []
            for i, (kind, role, text) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("kind", "role", "text")], strict=True)):
                if kind == 0:
                    if now is not None:
                        done.append(head | {"repaired_sha256": now.digest()})
                    head = heads.slice(i, 1).to_pylist()[0]
                    now = Repair(head["audit"])
                else:
                    now.row(role, text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
        if now is not None:
            yield pa.RecordBatch.from_pylist([head | {"repaired_sha256": now.digest()}], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return ordered.select(*names, "kind", F.col("role").cast("binary"), F.col("text").cast("binary")).mapInArrow(run, schema)
