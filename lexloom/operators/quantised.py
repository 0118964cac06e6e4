"""Approximate nearest neighbours: an inverted file of product-quantised residuals, then an exact re-rank.

A vector is its cell and, for each of some parts of its residual, the number of the nearest entry of that part's
codebook: a byte a part instead of its numbers. A query looks at its nearest cells; what it scores there are sums of
table entries. The best by these sums are then compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.vectors import as_doubles, dot, unit
from lexloom.operators.frames import rank_hits
from lexloom.operators.vectors import _arrow_type, _Best, _matrix
from lexloom.session import cut_lineage, ship_package


@dataclass(frozen=True)
class Quantiser:
    """Cell centres ``(cells, dim)`` and codebooks ``(parts, codes, dim / parts)``, both over vectors of length one."""

    centres: np.ndarray
    books: np.ndarray

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def split(self, rows: np.ndarray) -> np.ndarray:
        return rows.reshape(len(rows), self.books.shape[0], -1)

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of every unit row, and its codes, a byte for each part."""
        cell = _nearest(rows, self.centres)
        parts = self.split(rows - self.centres[cell])
        codes = [_nearest(parts[:, j], book) for j, book in enumerate(self.books)]
        return cell, np.stack(codes, axis=1).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """``(queries, parts, codes)``: the share that each code of each part has in the cosine."""
        return np.einsum("qpd,pcd->qpc", self.split(queries), self.books)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * rows @ centres.T, axis=1)


def lloyd(rows: np.ndarray, n: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` centres of the rows: k-means from drawn rows; an empty centre moves to the row that is farthest off."""
    centres = rows[rng.permutation(len(rows))[:n]]
    for _ in range(rounds):
        near = _nearest(rows, centres)
        sums, sizes = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, rows)
        off = ((rows - centres[near]) ** 2).sum(1)
        centres = np.divide(sums, sizes[:, None], out=np.zeros_like(sums), where=sizes[:, None] > 0)
        empty = np.flatnonzero(sizes == 0)
        centres[empty] = rows[np.argsort(-off, kind="stable")[: len(empty)]]
    return centres


def fit_quantiser(
    vecs: DataFrame, n_cells: int, parts: int = 16, codes: int = 64, rounds: int = 10, sample: int = 1 << 15, seed: int = 42,
    key: str = "key", vec: str = "vec",
) -> Quantiser:
    """A quantiser fitted on the ``sample`` vectors whose keys hash lowest; every vector can be encoded with it.

    ``parts`` must divide the dimension, ``codes`` is at most 256. Cells are fitted in one task on the sample, then each
    part's codebook in a task of its own on its share of the residuals. Fewer vectors than centres give fewer centres.
    Null and zero vectors are left out; an empty table is an error.
    """
    if not 1 <= codes <= 256:
        raise ValueError(f"a code is a byte, so there can't be {codes} of them")
    ship_package(vecs.sparkSession)
    usable = vecs.where(F.exists(vec, lambda x: x != 0)).select(key, unit(vec).alias("vec"))
    drawn = cut_lineage(usable.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(sample))
    first = drawn.select("vec").first()
    if first is None:
        raise ValueError("no vectors to fit on")
    dim = len(first[0])
    if dim % parts:
        raise ValueError(f"{parts} parts don't divide {dim} dimensions")

    def centres_of(batches: Iterator[pa.RecordBatch], n: int, no: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(list(batches)).sort_by("at")
        rows = np.array(whole["vec"].to_pylist())
        found = lloyd(rows, min(n, len(rows)), rounds, np.random.default_rng([seed, no]))
        return pa.record_batch([pa.array([no] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()), pa.array(found.tolist())], names=["part", "code", "vec"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield centres_of(iter(held), n_cells, 0)

    def books(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            for no in sorted(set(table["part"].to_pylist())):
                yield centres_of(iter(table.filter(pa.compute.equal(table["part"], no)).to_batches()), codes, no)

    schema = "part int, code int, vec array<double>"
    at = F.xxhash64(key).alias("at")
    rows = drawn.select(at, "vec").repartition(1).mapInArrow(cells, schema).orderBy("code").collect()
    centres = np.array([r["vec"] for r in rows])

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("vec").to_pylist()).reshape(-1, dim)
            split = (rows - centres[_nearest(rows, centres)]).reshape(-1, dim // parts)
            part = np.tile(np.arange(parts, dtype=np.int32), batch.num_rows)
            yield pa.record_batch([batch.column("at").take(pa.array(np.repeat(np.arange(batch.num_rows), parts))), pa.array(part), pa.array(list(split))], names=["at", "part", "vec"])

    shares = drawn.select(at, "vec").mapInArrow(residuals, "at bigint, part int, vec array<double>").repartitionById(parts, "part")
    found = shares.mapInArrow(books, schema).collect()
    size = max(r["code"] for r in found) + 1
    filled = np.zeros((parts, size, dim // parts))
    for r in found:
        filled[r["part"], r["code"]] = r["vec"]
    return Quantiser(centres, filled)


def encode_vectors(vecs: DataFrame, quantiser: Quantiser, key: str = "key", vec: str = "vec") -> DataFrame:
    """``(key, cell, codes)`` of every vector; null vectors, ones with holes or of another length have no entry."""
    ship_package(vecs.sparkSession)
    shared = vecs.sparkSession.sparkContext.broadcast(quantiser)
    kind = vecs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("cell", T.IntegerType()), T.StructField("codes", T.BinaryType())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, usable = _matrix(batch.column(1), known.dim)
            kept = np.flatnonzero(usable)
            if not len(kept):
                continue
            cell, codes = known.encode(rows[kept])
            yield pa.record_batch(
                [batch.column(0).take(pa.array(kept)), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())],
                names=[key, "cell", "codes"],
            )

    return vecs.where(F.col(key).isNotNull()).select(key, as_doubles(vec).alias(vec)).mapInArrow(encoded, schema)


def _probes(queries: DataFrame, shared, nprobe: int, query: str, vec: str) -> DataFrame:
    """``(query, cell, vec)``: each query with the cells nearest to it."""
    kind = queries.schema[query].dataType
    schema = T.StructType([T.StructField(query, kind), T.StructField("cell", T.IntegerType()), T.StructField("vec", T.ArrayType(T.DoubleType()))])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, usable = _matrix(batch.column(1), known.dim)
            kept = np.flatnonzero(usable)
            if not len(kept):
                continue
            gap = (known.centres**2).sum(1) - 2 * rows[kept] @ known.centres.T
            cells = np.argsort(gap, axis=1, kind="stable")[:, :nprobe]
            at = np.repeat(np.arange(len(kept)), cells.shape[1])
            yield pa.record_batch([batch.column(0).take(pa.array(kept[at])), pa.array(cells.ravel().astype(np.int32)), pa.array(list(rows[kept][at]))], names=[query, "cell", "vec"])

    return queries.select(query, as_doubles(vec).alias(vec)).mapInArrow(near, schema)


def search_quantised(
    index: DataFrame, quantiser: Quantiser, vecs: DataFrame, queries: DataFrame, k: int, nprobe: int, rerank: int,
    key: str = "key", query: str = "query", vec: str = "vec", digits: int = 6, salts: int = 8, block: int = 4096,
) -> DataFrame:
    """The ``k`` nearest vectors to each query: ``(query, key, sim, rank)``, similarities exact and rounded.

    ``index`` is a table of :func:`encode_vectors`. In each of its ``nprobe`` nearest cells a query scores every entry
    by its codes; the ``rerank`` best of all cells are compared by their vectors in ``vecs``. A cell's entries are
    divided over ``salts`` tasks, its queries into groups of about ``block`` on average, so neither a crowded cell nor a
    large query table is one task's work. Queries must be told apart by their key; zero vectors score 0.
    """
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(quantiser)
    kinds = [queries.schema[query].dataType, index.schema[key].dataType]
    arrow = [_arrow_type(x) for x in kinds]
    probes = cut_lineage(_probes(queries, shared, nprobe, query, vec))
    groups = max(1, -(-probes.count() // (block * len(quantiser.centres))))

    def every(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = probes.select("cell", every(salts).alias("salt"), F.pmod(F.xxhash64(query), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("side"),
                          F.col(query).alias("query"), F.lit(None).cast(kinds[1]).alias("key"), "vec", F.lit(b"").alias("codes"))
    held = index.select("cell", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("salt"), every(groups).alias("group"), F.lit(1).alias("side"),
                        F.lit(None).cast(kinds[0]).alias("query"), F.col(key).alias("key"), F.array().cast("array<double>").alias("vec"), "codes")
    met = asked.unionByName(held).repartition("cell", "salt", "group").sortWithinPartitions("cell", "salt", "group", "side")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        at, names, vectors, tables, base, best = None, [], [], None, None, None

        def out() -> Iterator[pa.RecordBatch]:
            if best is not None and best.key is not None:
                yield pa.record_batch([pa.array(names, arrow[0]).take(pa.array(best.query)), pa.array(best.key, arrow[1]), pa.array(best.sim)], names=["query", "key", "near"])

        for batch in batches:
            cell, salt, group, side = (batch.column(c).to_numpy() for c in ("cell", "salt", "group", "side"))
            change = (np.diff(cell) != 0) | (np.diff(salt) != 0) | (np.diff(group) != 0) | (np.diff(side) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                here = (int(cell[lo]), int(salt[lo]), int(group[lo]))
                if here != at:
                    yield from out()
                    at, names, vectors, best = here, [], [], None
                part = batch.slice(lo, hi - lo)
                if side[lo] == 0:
                    names += part.column("query").to_pylist()
                    vectors += part.column("vec").to_pylist()
                elif names:
                    if best is None:
                        asked_here = np.array(vectors)
                        tables, base = known.tables(asked_here), asked_here @ known.centres[here[0]]
                        best = _Best(names, rerank, False)
                    codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(hi - lo, -1)
                    step = max(1, (1 << 22) // len(names))
                    keys = np.array(part.column("key").to_pylist())
                    for a in range(0, hi - lo, step):
                        sims = np.repeat(base[:, None], min(step, hi - lo - a), axis=1)
                        for j in range(codes.shape[1]):
                            sims += tables[:, j, :][:, codes[a : a + step, j]]
                        best.add(keys[a : a + step], sims)
        yield from out()

    schema = T.StructType([T.StructField("query", kinds[0]), T.StructField("key", kinds[1]), T.StructField("near", T.DoubleType())])
    found = rank_hits(met.select("cell", "salt", "group", "side", "query", "key", "vec", "codes").mapInArrow(scored, schema), "query", "near", "key", k=rerank)
    exact = (
        found.select("query", "key")
        .join(vecs.select(F.col(key).alias("key"), unit(vec).alias("_vec")), "key")
        .join(queries.select(F.col(query).alias("query"), unit(vec).alias("_q")), "query")
        .select(F.col("query").alias(query), F.col("key").alias(key), (F.round(dot("_vec", "_q"), digits) + 0.0).alias("sim"))
    )
    return rank_hits(exact, query, "sim", key, k=k)
