"""Compression of vectors to short codes, with exact whole-number k-means on parts of them.

Components become integers, vectors are cut into parts, and each part position has a codebook that
starts as the first vectors and is replaced by means a few times. Distances come from matrix products:
integers are broken into limbs so short that a float64 product of two limbs, summed over a part, stays
below 2**53 and is exact; products of limbs are put together as 64-bit integers, and the first of the
smallest distances wins. Where distances could reach 2**63, Python's own integers take over, for the
blocks concerned.

Codebooks (entries x dimension integers, whatever the table's size) are all that the driver sees and
tasks are sent. A task adds up its vectors by entry and sends one sum per entry, so neither a label
nor an entry with many vectors gathers them in one place. Vectors are read again in every round and
never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import opened, small, whole

#: Integers are kept within this; sums are sent in two halves of this many bits.
LARGEST, HALF = 1 << 62, 31
ROWS_AT_ONCE = 4096
SUMS = "part int, entry int, n long, high array<long>, low array<long>"


@dataclass(frozen=True)
class Codebooks:
    """`parts[p]` has one row of integers per entry; `scale` is what components are multiplied by."""

    scale: int
    size: int
    parts: list[np.ndarray]

    def digest(self) -> str:
        """sha256 of all integers, comma-joined by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for p in self.parts for x in p.ravel().tolist()).encode()).hexdigest()


def limb_bits(terms: int) -> int:
    """Bits of a limb such that sums of `terms` products of two stay below 2**53."""
    return (53 - max(1, terms).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """`x` as float64 limbs, lowest first; all but the last are from 0 to 2**bits - 1."""
    out, largest = [], max(int(x.max(initial=0)), -int(x.min(initial=0)))
    while largest >> bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x, largest = x >> bits, largest >> bits
    return [*out, x.astype(np.float64)]


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Dot products of all rows of `x` with all rows of `y`, modulo 2**64."""
    bits = limb_bits(x.shape[1])
    out = np.zeros((len(x), len(y)), dtype=np.int64)
    ys = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(ys):
            if bits * (i + j) < 64:
                out += (a @ b.T).astype(np.int64) << bits * (i + j)
    return out


def _nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest row of `book`, squared distance) of each row of `x`."""
    reach = sum(max(abs(int(v.max(initial=0))), abs(int(v.min(initial=0)))) for v in (x, book))
    if x.shape[1] * reach * reach >= 1 << 63:
        return _nearest_of_any_size(x, book)
    apart = (x * x).sum(axis=1)[:, None] - 2 * products(x, book) + (book * book).sum(axis=1)
    code = apart.argmin(axis=1)
    return code, apart[np.arange(len(x)), code]


def _nearest_of_any_size(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same in Python's integers, row by row; distances from 2**63 on count as 2**63 - 1."""
    book = book.astype(object)
    code, error = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for k, row in enumerate(x.astype(object)):
        apart = ((book - row) ** 2).sum(axis=1).tolist()
        error[k] = min(min(apart), (1 << 63) - 1)
        code[k] = apart.index(min(apart))
    return code, error


def integers(vectors: pa.Array, scale: int, size: int) -> np.ndarray:
    """Vectors of `size` usable components each as floor(scale * x), kept within 2**62."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), size)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -LARGEST, LARGEST).astype(np.int64)


def _borders(size: int, parts: int) -> list[int]:
    """Where parts begin and end; if they cannot be equal, the first ones are longer by one."""
    return [p * (size // parts) + min(p, size % parts) for p in range(parts + 1)]


def _assigned(x: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, that part of all rows, codes, squared distances)."""
    ends = _borders(x.shape[1], len(books))
    for part, book in enumerate(books):
        own = np.ascontiguousarray(x[:, ends[part] : ends[part + 1]])
        found = [_nearest(own[at : at + ROWS_AT_ONCE], book) for at in range(0, len(own), ROWS_AT_ONCE)]
        yield part, own, *map(np.concatenate, zip(*found, strict=True))


def _add(sent, scale: int, size: int):
    """One row for each entry that has vectors in this task: their number and sum, in two halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros((2, *b.shape), dtype=np.int64) for b in books]
        for batch in batches:
            if batch.num_rows:
                for part, x, code, _ in _assigned(integers(batch.column(0), scale, size), books):
                    order = np.argsort(code, kind="stable")
                    entries, first = np.unique(code[order], return_index=True)
                    counts[part][entries] += np.diff(np.append(first, len(order)))
                    for half, value in enumerate((x >> HALF, x & ((1 << HALF) - 1))):
                        sums[part][half][entries] += np.add.reduceat(value[order], first, axis=0)
        for part, n in enumerate(counts):
            used = np.flatnonzero(n)
            columns = [np.full(len(used), part, dtype=np.int32), used.astype(np.int32), n[used]]
            halves = [pa.array(list(s[used]), pa.list_(pa.int64())) for s in sums[part]]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), *halves], ["part", "entry", "n", "high", "low"]
            )

    return run


def _encode(sent, scale: int, size: int):
    def run(batches):
        for vectors in batches:
            codes, error = [], np.zeros(len(vectors), dtype=np.int64)
            if len(vectors):
                for _, _, code, apart in _assigned(integers(vectors, scale, size), sent.value):
                    codes.append(code.astype(np.int32))
                    room = np.iinfo(np.int64).max - error
                    error += np.minimum(apart, room)
            flat = np.stack(codes, axis=1).ravel() if codes else np.empty(0, dtype=np.int32)
            offsets = np.arange(len(vectors) + 1, dtype=np.int32) * len(codes)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.StructArray.from_arrays([lists, pa.array(error)], ["code", "error"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<code: array<int>, error: long>")


def _plain(vector: Column, kind: str) -> Column:
    return vector if kind in ("array<float>", "array<double>") else vector.cast("array<double>")


def _finite(vector: Column) -> Column:
    """Whether the vector is there, with components, none of them null, infinite or not a number."""
    each = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & each, F.lit(False))


def usable(vectors: DataFrame, *, vector_col: str = "embedding") -> tuple[Column, int]:
    """Condition for rows of `vectors` that take part, and the number of their components.

    Null and empty vectors and those with a null or non-finite component take no part, nor do vectors
    of another length than the most common one (of ties, the largest).
    """
    vector = _plain(F.col(vector_col), dict(vectors.dtypes)[vector_col])
    sizes = vectors.where(_finite(vector)).groupBy(F.size(vector).alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = most["size"] if most else 0
    return _finite(vector) & (F.size(vector) == size), size


def _first(rows: DataFrame, count: int) -> np.ndarray | None:
    """Vectors of the `count` smallest ids, by id. Ids alone are compared first."""
    ids = rows.select("id").orderBy(F.col("id").asc_nulls_last()).limit(count).agg(
        F.max("id").alias("last"), F.count("id").alias("given"), F.count("*").alias("n")
    ).first()
    if not ids["n"]:
        return None
    near = rows if ids["given"] < ids["n"] else rows.where(F.col("id") <= F.lit(ids["last"]))
    found = near.orderBy(F.col("id").asc_nulls_last(), "vector").limit(count).select("vector").collect()
    return np.array([r["vector"] for r in found], dtype=np.float64)


def train(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> Codebooks:
    """Codebooks of the usable rows of `vectors` (see `usable`).

    Components x become floor(scale * x), within -2**62 and 2**62; vectors are cut into `parts`
    consecutive parts (if they cannot be equal, the first are longer by one). A codebook starts as
    that part of the vectors with the smallest ids, by id (null last; of equal ids the smaller
    vector first), fewer if there are fewer than `entries`. In each round every part goes to the
    nearest entry by squared distance (of ties, the lowest) and each entry becomes the floor of the
    mean of its parts; one without parts stays. Without usable rows there are no codebooks.
    """
    takes_part, size = usable(vectors, vector_col=vector_col)
    kind = dict(vectors.dtypes)[vector_col]
    rows = vectors.where(takes_part).select(F.col(id_col).alias("id"), _plain(F.col(vector_col), kind).alias("vector"))
    start = _first(rows, entries) if size else None
    if start is None:
        return Codebooks(scale, 0, [])
    x = np.clip(np.floor(scale * start), -LARGEST, LARGEST).astype(np.int64)
    ends = _borders(size, parts)
    books = [x[:, a:b].copy() for a, b in zip(ends, ends[1:], strict=False)]
    context = vectors.sparkSession.sparkContext
    for _ in range(rounds):
        sent = context.broadcast(books)
        sums = rows.select("vector").mapInArrow(_add(sent, scale, size), SUMS)
        each = sums.select("part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "half"))
        wide = [F.sum(F.col(f"half.{h}").cast("decimal(20,0)")).alias(h) for h in ("high", "low")]
        found = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), *wide).collect()
        books = [b.copy() for b in books]
        for r in found:
            books[r["part"]][r["entry"], r["at"]] = ((int(r["high"]) << HALF) + int(r["low"])) // r["n"]
        sent.unpersist()
    return Codebooks(scale, size, books)


def encode(vectors: DataFrame, model: Codebooks, *, vector_col: str = "embedding", out: str = "coded") -> DataFrame:
    """The usable rows of `vectors`, all columns and a struct `out` of (code, error).

    `code` has for each part the index of the nearest entry, `error` is the sum of the squared
    distances; from 2**63 on it is 2**63 - 1. Rows are usable if their vector has the length the
    model was trained for and components that are neither null, infinite nor not a number; others are
    left out. Repeated rows stay. An input column named as `out` is replaced.
    """
    row = F.col("row")
    vector = _plain(row[vector_col], dict(vectors.dtypes)[vector_col])
    rows = whole(vectors).where(_finite(vector) & (F.size(vector) == model.size))
    if not model.parts:
        nothing = F.lit(None).cast("struct<code: array<int>, error: long>")
        return opened(rows, vectors.columns, **{out: nothing})
    sent = vectors.sparkSession.sparkContext.broadcast(model.parts)
    coded = _encode(sent, model.scale, model.size)(vector)
    return opened(rows.withColumn("coded", coded), vectors.columns, **{out: F.col("coded")})


def with_label_error(coded: DataFrame, *, label_col: str, error_col: str, out: str) -> DataFrame:
    """All columns of a stored `coded` and, as `out`, the errors summed over rows of an equal label.

    Rows without a label are summed together. Sums from 2**63 on are 2**63 - 1. A label's rows are
    summed where they are, and the sums, one row a label, come back by a join that Spark can split.
    """
    total = F.sum(F.col(error_col).cast("decimal(19,0)"))
    sums = coded.groupBy(F.col(label_col).alias("of")).agg(
        F.least(total, F.lit((1 << 63) - 1).cast("decimal(19,0)")).cast("long").alias("sum")
    )
    met = whole(coded).join(small(sums), F.col("row")[label_col].eqNullSafe(F.col("of")))
    return opened(met, coded.columns, **{out: F.col("sum")})
