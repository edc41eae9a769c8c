"""Whitening of embeddings from an exactly summed scatter matrix.

Numbers become integers, x = floor(256 * c).  The fit list holds each distinct integer vector once.  Partitions multiply
its rows by themselves modulo several primes, in double-precision products that stay below 2**53 and so are exact; Spark
adds the residues, and Chinese remaindering gives the exact scatter, whatever its size: the primes are as many as the
largest entry and the number of vectors ask for.  The covariance is the correctly rounded quotient of exact integers,
its eigenvectors are those of double precision.

A vector that is null or holds null or non-finite entries has no rows in the result.  Neither have vectors of another
length than most distinct ones have (the longer of equally frequent lengths): they stand in no common space.  Entries
beyond 63 bits are clamped.  Null and repeated ids stay, as do repeated rows.  A component along which the fit list doesn't vary
(as with one single vector) has a null ``whitened``, and without any variation ``explained`` and ``identity_error`` are
null.  A ``deviation`` beyond 63 bits is null.  An empty table gives no rows.  Columns beside the id and the vector are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import discard, saved

#: Fixed value of the contract: integer steps of one unit.
STEPS = 256

#: Primes stay below this, and so many rows are multiplied at once: ROWS * PRIME_BOUND ** 2 is at most 2 ** 53.
PRIME_BOUND, ROWS = 1 << 20, 1 << 13


def primes() -> Iterator[int]:
    """The primes below PRIME_BOUND, largest first."""
    sieve = np.ones(1025, bool)
    sieve[:2] = False
    for i in range(2, 33):
        if sieve[i]:
            sieve[i * i :: i] = False
    small = np.flatnonzero(sieve)
    for n in range(PRIME_BOUND - 1, 1, -1):
        if (n % small[small * small <= n]).all():
            yield n


def moduli(bound: int) -> list[int]:
    """As many primes as tell apart all integers from -bound to bound."""
    found, product = [], 1
    for p in primes():
        if product > 2 * bound:
            return found
        found.append(p)
        product *= p
    raise ValueError("no primes left")


def integers(vector: Column) -> Column:
    """array<bigint> of a vector of finite numbers; null for any other."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.when(finite, F.transform(v, lambda c: F.floor(c * STEPS)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def residues(fit: DataFrame, width: int, mods: list[int]) -> DataFrame:
    """(prime, i, j, r): the entries i <= j of the scatter of ``fit`` (x) modulo each prime.

    A last column of ones stands beside the vectors, so that the scatter holds their sums and number too.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {p: np.zeros((width + 1, width + 1), np.int64) for p in mods}
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), ROWS):
                block = np.column_stack([x[at : at + ROWS], np.ones(min(ROWS, len(x) - at), np.int64)])
                for p, s in sums.items():
                    m = (block % p).astype(np.float64)
                    s += (m.T @ m).astype(np.int64) % p
                    s %= p
        i, j = np.triu_indices(width + 1)
        for p, s in sums.items():
            yield pa.record_batch([pa.repeat(pa.scalar(p, pa.int32()), len(i)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(s[i, j], pa.int64())], ["prime", "i", "j", "r"])

    parts = fit.select("x").mapInArrow(products, "prime int, i int, j int, r bigint")
    return parts.groupBy("prime", "i", "j").agg((F.sum("r") % F.col("prime")).alias("r"))


def reconstructed(rows: list, width: int, mods: list[int]) -> np.ndarray:
    """The integers whose residues ``rows`` (prime, i, j, r) are, as a symmetric matrix of Python integers."""
    product = 1
    for p in mods:
        product *= p
    weights = {p: product // p * pow(product // p, -1, p) for p in mods}
    out = np.zeros((width + 1, width + 1), object)
    for prime, i, j, r in rows:
        out[i, j] += r * weights[prime]
    for i in range(width + 1):
        for j in range(i, width + 1):
            v = out[i, j] % product
            out[i, j] = out[j, i] = v - product if 2 * v > product else v
    return out


@dataclass
class Whitening:
    """The fit: n vectors with the sums S, covariance and its eigenvalues and unit eigenvectors (columns), largest first."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    largest: int

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def varies(self) -> np.ndarray:
        """The components along which the fit list varies by more than rounding."""
        top = max(float(self.values[0]), 0.0)
        return (self.values > top * self.width * np.finfo(float).eps) & (self.values > 0)


def fit(vectors: DataFrame) -> Whitening | None:
    """The whitening of ``vectors`` (x, distinct); None without any.

    What reaches the driver is one row for each pair of dimensions and prime.
    """
    best = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"), F.max(F.greatest(F.array_max("x"), -(F.array_min("x") + 1))).alias("top")).where("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return None
    mods = moduli(max(best.n * (best.top + 1) ** 2, best.n))
    m = reconstructed(residues(vectors.where(F.size("x") == best.d), best.d, mods).collect(), best.d, mods)
    n, sums = m[-1, -1], m[:-1, -1].tolist()
    # Exact numerators; the quotient of two Python integers is correctly rounded.
    covariance = np.array([[(n * m[i, j] - sums[i] * sums[j]) / (n * n) for j in range(best.d)] for i in range(best.d)])
    values, columns = np.linalg.eigh(covariance)
    return Whitening(n, sums, covariance, values[::-1].copy(), columns[:, ::-1].copy(), best.top + 1)


def projected(x: Column, w: Whitening, components: int) -> Column:
    """struct<deviation, whitened>: the sum of (n * x - S) ** 2, and the first components of the whitened vector."""
    k = min(components, w.width)
    n, sums, small = w.n, w.sums, w.width * (2 * w.n * w.largest) ** 2 < 1 << 63
    varies = w.varies[:k]
    scaled = w.vectors[:, :k] / np.sqrt(np.where(varies, w.values[:k], 1.0))
    kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    @F.arrow_udf("struct<deviation:bigint,whitened:array<double>>")
    def out(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = _matrix(column, len(sums))
            y = n * rows - np.array(sums, np.int64) if small else n * rows.astype(object) - np.array(sums, object)
            squares = (y * y).sum(axis=1).tolist() if len(y) else []
            z = (y / n).astype(np.float64) @ scaled
            flat = pa.array(z.ravel(), mask=np.broadcast_to(~varies, z.shape).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), flat)
            yield pa.StructArray.from_arrays([pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()), lists], fields=list(kind))

    return out(x)


def identity_error(fit_list: DataFrame, w: Whitening, components: int) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity, over the components that vary."""
    live = [i for i, v in enumerate(w.varies[:components]) if v]
    if not live:
        return None
    rows = fit_list.select(projected(F.col("x"), w, components)["whitened"].alias("z")).select(*(F.col("z")[i].alias(f"z{i}") for i in live))
    pairs = [F.abs(F.covar_pop(f"z{i}", f"z{j}") - float(i == j)) for i in live for j in live if i <= j]
    return float(rows.agg(F.greatest(*pairs) if len(pairs) > 1 else pairs[0]).first()[0])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    rows = vectors.select(F.col(id_col).alias("id"), integers(F.col(vector_col)).alias("x")).where("x is not null")
    distinct = saved(rows.select("x").distinct())
    w = fit(distinct)
    if w is None:
        discard(distinct)
        empty = rows.limit(0).select(F.col("id").alias(id_col), F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"))
        return empty.withColumns({c: F.lit(0.0) for c in ("whitened", "explained", "identity_error")})
    same = F.size("x") == w.width
    error = identity_error(distinct.where(same), w, components)
    discard(distinct)
    trace = float(np.trace(w.covariance))
    shares = F.array(*(F.lit(float(e) / trace if trace > 0 else None).cast("double") for e in w.values[:components]))
    placed = rows.where(same).select("id", projected(F.col("x"), w, components).alias("p")).select("id", "p.deviation", F.posexplode("p.whitened").alias("at", "whitened"))
    return placed.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(w.n).cast("bigint").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
