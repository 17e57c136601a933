"""Pack tokenised documents into sequences of fixed capacity.

The lengths of all pieces make a histogram of at most ``capacity`` rows. A configuration is a
multiset of lengths that fits one sequence; the linear program that covers the histogram with the
least number of configurations is solved approximately by multiplicative weights: each length has a
price, each step adds the configuration of greatest value (an unbounded knapsack, by dynamic
programming) and lowers the prices of the lengths it serves. The fractional solution is rounded
down, the remaining pieces, few for each length, are packed best-fit with longest first, and the
plan, whose size depends on the capacity alone, is broadcast. Pieces find their places by rank
within their length, so no piece moves to meet another.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.encoding import WINDOW_BYTES, text_groups, worker_encoder
from tidemark.session import stored

STEPS = 300


def encode_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces (id, piece, start, length, ids) of all rows, written once.

    A document is its ids and ``end_id``; a longer one than ``capacity`` is cut so that only its
    first piece may be shorter. ``ids`` are little-endian unsigned 32-bit integers. ``task`` and
    ``nth`` tell the pieces of one length apart: the writing task and a count within it. Null and
    empty texts are one piece of one id; repeated rows are pieces of their own.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = worker_encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for row, data, offsets in text_groups(batch.column(1), WINDOW_BYTES):
                tokens, counts = encoder.ids_of(data, offsets)
                tokens = np.insert(tokens, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                n_pieces = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), n_pieces)
                first = np.cumsum(n_pieces) - n_pieces
                piece = np.arange(len(owner)) - first[owner]
                head = counts - (n_pieces - 1) * capacity  # length of the first piece
                length = np.where(piece == 0, head[owner], capacity)
                start = np.where(piece == 0, 0, head[owner] + (piece - 1) * capacity)
                nth = _running_counts(length, seen)
                ends = np.concatenate([[0], np.cumsum(length)])
                blobs = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(length), [None, pa.py_buffer(ends * 4), pa.py_buffer(tokens)]
                )
                for at in range(0, len(length), 8192):
                    some = slice(at, at + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(row + owner[some])),
                            pa.array(piece[some].astype(np.int32)),
                            pa.array(start[some]),
                            pa.array(length[some]),
                            blobs[some].cast(pa.binary()),
                            pa.array(np.full(len(length[some]), task, np.int64)),
                            pa.array(nth[some]),
                        ],
                        names=["id", "piece", "start", "length", "ids", "task", "nth"],
                    )

    schema = T.StructType(
        [T.StructField("id", picked.schema["id"].dataType), T.StructField("piece", T.IntegerType())]
        + [T.StructField(name, T.LongType()) for name in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(name, T.LongType()) for name in ("task", "nth")]
    )
    return stored(picked.mapInArrow(encode, schema), "pieces")


def _running_counts(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each piece, how many of its length came before; ``seen`` is carried on."""
    order = np.argsort(length, kind="stable")
    sizes = np.bincount(length, minlength=len(seen))
    rank = np.arange(len(length)) - (np.cumsum(sizes) - sizes)[length[order]]
    nth = np.empty(len(length), np.int64)
    nth[order] = rank + seen[length[order]]
    seen += sizes
    return nth


def best_configuration(price: np.ndarray, sizes: np.ndarray, capacity: int) -> Counter:
    """Unbounded knapsack: the lengths, with repeats, of greatest total price that fit."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right").tolist()
    for room in range(1, capacity + 1):
        n = fitting[room]
        best[room] = best[room - 1]
        if n:
            values = price[:n] + best[room - sizes[:n]]
            k = int(values.argmax())
            if values[k] > best[room]:
                best[room], pick[room] = values[k], k
    found: Counter = Counter()
    room = capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
            continue
        found[int(sizes[pick[room]])] += 1
        room -= int(sizes[pick[room]])
    return found


def solve(histogram: dict[int, int], capacity: int, steps: int = STEPS) -> list[tuple[Counter, int]]:
    """Configurations and how often each is used; every piece of the histogram is placed once.

    Full-length pieces are their own sequences and stay out of the program.
    """
    plan: list[tuple[Counter, int]] = []
    left = {int(s): int(n) for s, n in histogram.items() if n > 0}
    if left.get(capacity):
        plan.append((Counter({capacity: 1}), left.pop(capacity)))
    if left:
        plan += _cover(left, capacity, steps)
    return plan + _best_fit(left, capacity)


def _cover(left: dict[int, int], capacity: int, steps: int) -> list[tuple[Counter, int]]:
    """The rounded-down fractional solution; takes what it places out of ``left``."""
    sizes = np.array(sorted(left))
    demand = np.array([left[s] for s in sizes], float)
    # Duals of the covering program: a length's price starts at its share of a sequence and falls
    # as fast as its demand is met compared with the others.
    log_price = np.log(sizes / capacity)
    rate = 0.5
    served = np.zeros(len(sizes))
    used: Counter = Counter()
    target = (sizes * demand).sum() / capacity
    position = {int(s): k for k, s in enumerate(sizes)}
    for step in range(steps):
        price = np.exp(log_price - log_price.max())
        found = best_configuration(price, sizes, capacity)
        counts = np.zeros(len(sizes))
        for size, n in found.items():
            counts[position[size]] = n
        # Use it until the first of its lengths has had an equal part of its demand.
        width = (counts / demand).max()
        amount = min(1 / width, target) / (1 + step**0.5)
        key = tuple(sorted(found.items()))
        used[key] += amount
        served += amount * counts
        log_price -= rate * amount * counts / demand
    # Scaled so that no length is served beyond its demand; what is short is packed best-fit.
    scale = (served / demand).max()
    for key in used:
        used[key] /= scale
    plan = []
    for key, amount in used.most_common():
        times = min([int(amount + 1e-9), *(left[s] // n for s, n in key)])
        if times:
            plan.append((Counter(dict(key)), times))
            for s, n in key:
                left[s] -= n * times
    return plan


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Pack by length, longest first, into the fullest sequence with room; equal sequences together.

    Works on counts, not pieces: sequences of one content are one entry, so its work depends on the
    number of lengths and not on the number of pieces.
    """
    groups: dict[int, list[tuple[Counter, int]]] = {}  # by free room
    for size in sorted((s for s, n in left.items() if n), reverse=True):
        n = left[size]
        for room in range(size, capacity):
            if not n:
                break
            fits = room // size
            waiting = groups.pop(room, [])
            while waiting and n:
                content, times = waiting.pop()
                full = min(times, n // fits)
                if full:
                    groups.setdefault(room - fits * size, []).append(
                        (content + Counter({size: fits}), full)
                    )
                    n -= full * fits
                    times -= full
                if times and n and n < fits:
                    groups.setdefault(room - n * size, []).append((content + Counter({size: n}), 1))
                    n, times = 0, times - 1
                if times:
                    waiting.append((content, times))
            if waiting:
                groups.setdefault(room, []).extend(waiting)
        each = capacity // size
        if n // each:
            groups.setdefault(capacity - each * size, []).append((Counter({size: each}), n // each))
        if n % each:
            rest = n % each
            groups.setdefault(capacity - rest * size, []).append((Counter({size: rest}), 1))
        left[size] = 0
    return [entry for entries in groups.values() for entry in entries]


def slots(plan: list[tuple[Counter, int]]) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, offset): where ranks of a length go."""
    rows, sequence, used = [], 0, Counter()
    for content, times in plan:
        offset = 0
        for size in sorted(content, reverse=True):
            rows.append((size, used[size], content[size], sequence, offset))
            used[size] += content[size] * times
            offset += size * content[size]
        sequence += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int = 1024, steps: int = STEPS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless from offset 0.

    ``pieces`` has ``length``, ``task`` and ``nth`` as ``encode_pieces`` writes them; all other
    columns are kept. Ranks come from one small row for each task and length, summed in order.
    """
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(solve(histogram, capacity, steps)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    schema = T.StructType(
        [*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        firsts = _key(rows[:, 0], rows[:, 1])
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = rows[np.searchsorted(firsts, _key(length, rank), "right") - 1]
            copy, nth = np.divmod(rank - row[:, 1], row[:, 2])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(row[:, 3] + copy), pa.array(row[:, 4] + nth * length)],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(assign, schema).drop("task", "nth", "base", "rank")


def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """One sortable number of a length (below 2^20) and a rank (below 2^43)."""
    return (length << 43) + rank


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces (id, piece, start, length, ids, sequence_id, offset) of all rows, packed.

    An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    pieces = encode_pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    return place(pieces, capacity).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences (sequence_id, ids, lengths) of a packed frame: its pieces in order."""
    row = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(row.alias("p")).select(
        "sequence_id",
        F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("p.length").alias("lengths"),
    )
