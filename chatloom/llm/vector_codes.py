"""Vector code compression: product quantisation whose assignments are kept up by adaptive bounds.

Vectors become integers and are cut into parts; each part position has a codebook that a few rounds of
Lloyd's iteration improve. A round does not compare every part with every entry again:

* after the first assignment, each part keeps its ``b`` closest entries, an upper bound of the distance to the
  first, ordered lower bounds of the others' and one outer bound for all entries not in the list.
  They are written with the integer vector, so that a lost executor re-reads them;
* when a codebook has moved, bounds are shifted by how far their entries moved. A part whose upper bound
  is below all others keeps its entry unseen; otherwise the listed entries are compared as integers, and
  only if the best of them is not below the outer bound, all entries are;
* each batch shortens its lists to what its parts needed, so ``b`` adapts to how much still moves.

Bounds are integers in eighths, rounded away from certainty. Whatever they leave open is settled by exact
squared distances (integers below 2^53, so floats hold them exactly), ties to the lower index. So
the result is that of the full comparison.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import if_few, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: components beyond +-4096.0 count as that, so that squared distances stay exact
LIMIT = 1 << 20
#: bounds are kept in units of 1 / UNIT
UNIT = 8
#: stands for the distance of no entry
FAR = 1 << 50
#: a list must have sufficed for this share of a batch's parts to be shortened to its length
ENOUGH = 0.999
MAX_BROADCAST_ROWS = 200_000


def usable(vector: str | Column, parts: int) -> Column:
    """Whether a vector has only finite components and can be cut into equal parts."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & finite, F.lit(False))


def to_integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def first_vectors(vectors: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the ``entries`` smallest ids. Each scan reads the next ids, so one scan does unless ids repeat."""
    kept = vectors.where("id IS NOT NULL")
    ids: list = []
    while len(ids) < entries:
        after = kept.where(F.col("id") > F.lit(ids[-1])) if ids else kept
        found = sorted({r["id"] for r in after.select("id").orderBy("id").limit(entries).collect()})
        if not found:
            break
        ids += found
    ids = ids[:entries]
    if not ids:
        return []
    # of rows with one id, the least vector: at most ``entries`` rows
    rows = kept.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["id"])]


def up(squares: np.ndarray) -> np.ndarray:
    return np.ceil(np.sqrt(squares.astype(np.float64)) * UNIT * (1 + 1e-12)).astype(np.int64)


def down(squares: np.ndarray) -> np.ndarray:
    return np.floor(np.sqrt(squares.astype(np.float64)) * UNIT * (1 - 1e-12)).astype(np.int64)


def squares_to(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all entries."""
    a, c = x.astype(np.float64), book.astype(np.float64)
    return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)


def closest(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``b`` closest entries (ties to the lower index) and their bounds with the outer one last."""
    n = len(book)
    keys = squares_to(x, book) * n + np.arange(n)
    if b < n:
        keys = np.partition(keys, b, axis=1)[:, :b + 1]
    keys.sort(axis=1)
    near = keys[:, :b] % n
    squares = keys // n
    outer = down(squares[:, b:b + 1]) if b < n else np.full((len(x), 1), FAR)
    return near, np.concatenate([up(squares[:, :1]), down(squares[:, 1:b]), outer], axis=1)


def settle(x: np.ndarray, near: np.ndarray, bounds: np.ndarray, book: np.ndarray, moved: np.ndarray):
    """One part position: ``near`` and ``bounds`` against ``book``, whose entries moved by ``moved`` (rounded
    up). Returns both anew and how many entries each row needed to know (b + 1: all)."""
    n, b = len(book), near.shape[1]
    bounds = bounds.copy()
    bounds[:, 0] += moved[near[:, 0]]
    bounds[:, 1:b] -= moved[near[:, 1:]]
    bounds[:, b] -= np.where(bounds[:, b] < FAR, moved.max(), 0)
    near = near.copy()
    if b > 2:                                             # keep the list ordered by its bounds
        order = np.argsort(bounds[:, 1:b], axis=1, kind="stable")
        near[:, 1:] = np.take_along_axis(near[:, 1:], order, 1)
        bounds[:, 1:b] = np.take_along_axis(bounds[:, 1:b], order, 1)
    need = np.ones(len(x), np.int64)
    open_ = np.flatnonzero(bounds[:, 0] >= bounds[:, 1:].min(axis=1))
    if len(open_):
        listed = book[near[open_]]
        squares = ((x[open_][:, None, :] - listed) ** 2).sum(2)
        first = up(squares[:, 0])
        need[open_] = 1 + (bounds[open_][:, 1:b] <= first[:, None]).sum(1)
        keys = np.sort(squares * n + near[open_], axis=1)
        best = up(keys[:, 0] // n)
        certain = best < bounds[open_, b]
        rows, own = open_[certain], keys[certain]
        near[rows] = own % n
        bounds[rows, 0] = up(own[:, 0] // n)
        bounds[rows, 1:b] = down(own[:, 1:] // n)
        rest = open_[~certain]
        if len(rest):
            near[rest], bounds[rest] = closest(x[rest], book, b)
            need[rest] = b + 1
    return near, bounds, need


def shorten(near: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``b`` of the lists (rows, parts, entries); the outer bound takes over for the others."""
    outer = bounds[:, :, b:].min(axis=2, keepdims=True)
    return near[:, :, :b], np.concatenate([bounds[:, :, :b], outer], axis=2)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = values.reshape(len(values), -1)
    ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel(), type=kind))


STATE = "id {id}, label {label}, v array<int>, b int, near array<short>, bounds array<long>"


def state_batch(batch: pa.RecordBatch, x: np.ndarray, near: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), batch.column("label"), lists(x, pa.int32()), pa.array(np.full(len(x), near.shape[2]), pa.int32()),
         lists(near, pa.int16()), lists(bounds, pa.int64())], ["id", "label", "v", "b", "near", "bounds"])


def unpacked(batches, parts: int):
    """(batch, x, near, bounds) of a state table, one list length at a time."""
    for whole in batches:
        sizes = whole.column("b").to_numpy()
        for b in np.unique(sizes).tolist():
            batch = whole if (sizes == b).all() else whole.filter(pa.array(sizes == b))
            n = batch.num_rows
            flat = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("v", "near", "bounds")}
            yield batch, flat["v"].reshape(n, parts, -1), flat["near"].reshape(n, parts, b), flat["bounds"].reshape(n, parts, b + 1)


def start(vectors: DataFrame, book: np.ndarray, schema: str) -> DataFrame:
    """The state after the first assignment, from (id, label, v)."""
    parts, entries, width = book.shape

    def run(batches):
        b = max(1, entries // 8)
        for batch in batches:
            column = batch.column("v")
            if not batch.num_rows:
                continue
            x = to_integers(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, parts, width)
            found = [closest(x[:, p], book[p], b) for p in range(parts)]
            yield state_batch(batch, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1))

    return vectors.mapInArrow(run, schema)


def movement(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return up(((old - new) ** 2).sum(-1))


def again(state: DataFrame, old: np.ndarray, book: np.ndarray, schema: str) -> DataFrame:
    """The state after the codebooks moved from ``old`` to ``book``."""
    moved = movement(old, book)
    parts, entries, _ = book.shape

    def run(batches):
        for batch, x, near, bounds in unpacked(batches, parts):
            found = [settle(x[:, p], near[:, p], bounds[:, p], book[p], moved[p]) for p in range(parts)]
            near, bounds = np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)
            need = int(np.quantile(np.stack([f[2] for f in found]), ENOUGH, method="higher"))
            b = near.shape[2]
            fewer = min(b, max(need, entries // 16, 1))
            if fewer < b:
                near, bounds = shorten(near, bounds, fewer)
            yield state_batch(batch, x, near, bounds)

    return state.mapInArrow(run, schema)


def improved(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after each used entry became its parts' mean, rounded down. Tasks add up their own parts:
    what reaches the driver is one row per codebook cell."""
    parts, entries, width = book.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, x, near, _ in unpacked(batches, parts):
            for p in range(parts):
                np.add.at(total[p, :, :width], near[:, p, 0], x[:, p])
                total[p, :, width] += np.bincount(near[:, p, 0], minlength=entries)
        cells = np.flatnonzero(np.repeat(total[:, :, width] > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], ["cell", "s"])

    total = np.zeros(parts * entries * (width + 1), np.int64)
    sums = state.select("v", "b", "near", "bounds").mapInArrow(run, "cell long, s long").groupBy("cell").agg(F.sum("s").alias("s"))
    for row in sums.collect():
        total[row["cell"]] = row["s"]
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), book)


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: key, code (two hex digits per part), error (squared distance to the coded
    vector), label_error (its sum over equal labels, missing ones together), codebooks_sha256.

    Null vectors and those with null or non-finite components go, and so do those that cannot be cut into
    equal parts or differ in length from the vector of the smallest id. Missing ids never start a
    codebook; of rows with one id the least vector does. Fewer ids than entries: a codebook of as many
    entries. Repeated rows get the same code each. Components beyond +-4096 count as that.
    """
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits names 256 entries at most")
    kinds = {c: vectors.schema[n].dataType.simpleString() for c, n in (("id", key), ("label", label))}
    source = (vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
              .where(usable("v", parts)))
    first = first_vectors(source, entries)
    if not first:
        return spark.createDataFrame([], f"`{key}` {kinds['id']}, code string, error long, label_error long, codebooks_sha256 string")
    width = len(first[0]) // parts
    first = [v for v in first if len(v) == width * parts]
    source = source.where(F.size("v") == width * parts)
    book = to_integers(np.array(first)).reshape(-1, parts, width).transpose(1, 0, 2)
    schema = STATE.format(**kinds)
    state = stored(start(source, book, schema), "codes-0")
    old, book = book, improved(state, book)
    for i in range(1, rounds):
        state = stored(again(state, old, book, schema), f"codes-{i}")
        old, book = book, improved(state, book)
    moved = movement(old, book)

    def finish(batches):
        for batch, x, near, bounds in unpacked(batches, parts):
            codes = np.stack([settle(x[:, p], near[:, p], bounds[:, p], book[p], moved[p])[0][:, 0] for p in range(parts)], 1)
            error = sum(((x[:, p] - book[p][codes[:, p]]) ** 2).sum(1) for p in range(parts))
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                                             ["id", "label", "code", "error"])

    coded = stored(state.mapInArrow(finish, "id {id}, label {label}, code string, error long".format(**kinds)), "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return (coded.join(if_few(sums, MAX_BROADCAST_ROWS), F.col("label").eqNullSafe(F.col("_label")))
            .select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
