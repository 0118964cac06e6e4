"""Vector tables: pooling, comparing, exact and cell-based nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.vectors import as_doubles, cosine, dot, literal_vector, unit
from lexloom.operators.frames import rank_hits, unnest
from lexloom.session import ship_package

# Vectors of the small side that are held in one block, on the driver or in the Python worker of a cell.
BLOCK_VECTORS = 4096
# Rows of a batch that a task hands on.
OUTPUT_ROWS = 1 << 18

# Arrow types of the keys that vector tables may have.
KEY_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def vec_dim(vecs: DataFrame, vec: str = "vec") -> DataFrame:
    """One row: number of vectors, smallest and largest dimension."""
    size = F.size(vec)
    return vecs.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(size).alias("min_dim"), F.max(size).alias("max_dim")
    )


def mean_vec(vecs: DataFrame, group: str | list[str], vec: str = "vec") -> DataFrame:
    """The average vector of each group; averaged inside each task before the shuffle."""
    groups = [group] if isinstance(group, str) else group
    mean = Summarizer.mean(array_to_vector(as_doubles(vec)))
    return vecs.groupBy(*groups).agg(vector_to_array(mean).alias(vec))


def _unit_rows(values: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(values, axis=1, keepdims=True)
    return np.divide(values, norms, out=np.zeros_like(values), where=norms > 0)


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of width ``dim`` and which of them are vectors; null ones, holes and other lengths are not."""
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    usable = lengths == dim
    flat = column.flatten()
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
    values = np.asarray(flat.fill_null(float("nan")), dtype=np.float64)
    rows = np.zeros((len(column), dim))
    if dim and usable.any():
        rows[usable] = values[starts[usable][:, None] + np.arange(dim)]
    usable &= ~np.isnan(rows).any(axis=1)
    rows[~usable] = 0
    return _unit_rows(rows), usable


def one_dimension(vectors: list[list[float]]) -> np.ndarray:
    """The vectors as a matrix; a table of vectors has one dimension and no holes."""
    lengths = {len(v) for v in vectors}
    if len(lengths) > 1 or any(x is None for v in vectors for x in v):
        raise ValueError(f"vectors of one table need one length and no nulls, found lengths {sorted(lengths)}")
    return np.array(vectors, dtype=np.float64)


def _one_block(small: DataFrame, key: str, vec: str) -> tuple[list, np.ndarray] | None:
    """Keys and unit rows of a side of at most ``BLOCK_VECTORS`` vectors, which may go to every task; none: it has more."""
    rows = small.where(F.col(vec).isNotNull()).select(key, as_doubles(vec).alias(vec)).limit(BLOCK_VECTORS + 1).collect()
    if len(rows) > BLOCK_VECTORS:
        return None
    return [r[0] for r in rows], _unit_rows(one_dimension([r[1] for r in rows])) if rows else np.zeros((0, 0))


def _grid(wide: DataFrame, small: DataFrame, wide_key: str, small_key: str, vec: str) -> DataFrame:
    """Both sides in the cells of a block product: rows ``(side, small_key, wide_key, vec)``, a task per cell.

    A cell is a block of about ``BLOCK_VECTORS`` of the small side, which comes first, and a block of the wide side. Rows
    are dealt by the hash of their keys and repeated for each block of the other side, so any two of them meet in one cell.
    """
    picked = small.where(F.col(vec).isNotNull())
    n_small = -(-picked.count() // BLOCK_VECTORS)
    n_wide = max(1, -(-int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_small))

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def of(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    asked = picked.select(of(small_key, n_small).alias("a"), blocks(n_wide).alias("b"), F.lit(0).alias("side"), F.col(small_key).alias("_small"),
                          F.lit(None).cast(wide.schema[wide_key].dataType).alias("_wide"), as_doubles(vec).alias("vec"))
    met = wide.select(blocks(n_small).alias("a"), of(wide_key, n_wide).alias("b"), F.lit(1).alias("side"),
                      F.lit(None).cast(small.schema[small_key].dataType).alias("_small"), F.col(wide_key).alias("_wide"), as_doubles(vec).alias("vec"))
    cells = asked.union(met).repartitionById(n_small * n_wide, F.col("a") * n_wide + F.col("b"))
    return cells.sortWithinPartitions("side").select("side", "_small", "_wide", "vec")


def _cell_sides(batches: Iterator[pa.RecordBatch]) -> tuple[list, np.ndarray, Iterator[pa.RecordBatch]]:
    """Keys and unit rows of the block that a cell holds, and the batches ``(key, vec)`` of the side that streams past it."""
    names, vectors, first = [], [], None
    for batch in batches:
        cut = int(np.searchsorted(batch.column(0).to_numpy(), 1))
        names += batch.column(1).slice(0, cut).to_pylist()
        vectors += batch.column(3).slice(0, cut).to_pylist()
        if cut < batch.num_rows:
            first = batch.slice(cut)
            break

    def stream() -> Iterator[pa.RecordBatch]:
        for batch in ([first] if first is not None else []):
            yield batch.select([2, 3])
        for batch in batches:
            yield batch.select([2, 3])

    return names, _unit_rows(one_dimension(vectors)) if names else np.zeros((0, 0)), stream()


def _empty(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    return df.sparkSession.createDataFrame([], T.StructType(fields))


def cross_score(
    left: DataFrame,
    right: DataFrame,
    left_key: str = "key",
    right_key: str = "label",
    vec: str = "vec",
) -> DataFrame:
    """Cosine of every left vector with every right vector: ``(left_key, right_key, sim)``.

    The right side is the short one (labels, queries). Up to ``BLOCK_VECTORS`` vectors of it are sent out as one
    matrix, without any shuffle; more of them meet the left side in the cells of a block product.
    A zero vector scores 0; a null vector, one with holes or of another length scores null, as in
    :func:`cosine`. Null vectors on the right are left out, unequal lengths there are an error.
    """
    fields = [
        left.select(left_key).schema[0],
        right.select(right_key).schema[0],
        T.StructField("sim", T.DoubleType()),
    ]
    schema = T.StructType(fields)
    arrow_right = _arrow_type(fields[1].dataType)
    wide = left.select(left_key, as_doubles(vec).alias(vec))

    def scores(names: list, matrix: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_column = pa.array(names, type=arrow_right)
        step = max(1, OUTPUT_ROWS // max(1, len(names)))
        for batch in batches:
            for lo in range(0, batch.num_rows if names else 0, step):
                part = batch.slice(lo, step)
                rows, usable = _matrix(part.column(1), matrix.shape[1])
                at = np.repeat(np.arange(part.num_rows), len(names))
                every = np.tile(np.arange(len(names)), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(at)),
                        names_column.take(pa.array(every)),
                        pa.array((rows @ matrix.T).ravel(), mask=~usable[at]),
                    ],
                    names=[f.name for f in fields],
                )

    return _meet(wide, right, left_key, right_key, vec, scores, schema)


def _meet(wide: DataFrame, small: DataFrame, wide_key: str, small_key: str, vec: str, work: Callable, schema: T.StructType) -> DataFrame:
    """``work(names, matrix, batches)`` of the small side's vectors against all rows of the wide one.

    A small side of one block goes to every task, and the wide side is not shuffled. A larger one meets it in the cells
    of a block product; nothing but its count passes the driver then.
    """
    ship_package(wide.sparkSession)
    block = _one_block(small, small_key, vec)
    if block is None:
        return _grid(wide, small, wide_key, small_key, vec).mapInArrow(lambda batches: work(*_cell_sides(batches)), schema)
    if not block[0]:
        return _empty(wide, schema.fields)
    shared = wide.sparkSession.sparkContext.broadcast(block)
    return wide.mapInArrow(lambda batches: work(*shared.value, batches), schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    name = kind.simpleString()
    if name not in KEY_TYPES:
        raise TypeError(f"keys of vectors are {', '.join(KEY_TYPES)}, not {name}")
    return KEY_TYPES[name]


class _Best:
    """The best ``k`` neighbours of each query so far; ties go to the lower key."""

    def __init__(self, names: list, k: int, exclude_self: bool) -> None:
        self.k = k
        self.names = np.array(names)
        self.order = np.argsort(self.names, kind="stable") if exclude_self else None
        self.floor = np.full(len(names), -np.inf)
        self.query, self.sim, self.key = np.zeros(0, np.int64), np.zeros(0), None

    def add(self, keys: np.ndarray, sims: np.ndarray) -> None:
        """``sims`` has a row per query and a column per key."""
        if self.order is not None:
            ranked = self.names[self.order]
            lo, hi = np.searchsorted(ranked, keys, "left"), np.searchsorted(ranked, keys, "right")
            column = np.repeat(np.arange(len(keys)), hi - lo)
            within = np.arange(len(column)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
            sims[self.order[np.repeat(lo, hi - lo) + within], column] = -np.inf
        floor, n = self.floor, sims.shape[1]
        if n > self.k:
            floor = np.maximum(floor, np.partition(sims, n - self.k, axis=1)[:, n - self.k])
        query, at = np.nonzero((sims >= floor[:, None]) & (sims > -np.inf))
        query, sim = np.concatenate([self.query, query]), np.concatenate([self.sim, sims[query, at]])
        key = keys[at] if self.key is None else np.concatenate([self.key, keys[at]])
        order = np.lexsort((key, -sim, query))
        query, sim, key = query[order], sim[order], key[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        self.query, self.sim, self.key = query[rank < self.k], sim[rank < self.k], key[rank < self.k]
        full = rank == self.k - 1
        self.floor[query[full]] = sim[full]


def most_similar_to_vector(
    vecs: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "key",
    query: str = "query",
    vec: str = "vec",
    digits: int = 6,
    exclude_self: bool = False,
) -> DataFrame:
    """The ``k`` nearest vectors to each query vector: ``(query, key, sim, rank)``.

    Exact. Every task keeps the best ``k`` per query of its own rows, so at most ``k`` rows per
    query and task are shuffled. Queries may be a table of any size: beyond one block they meet the vectors in the
    cells of a block product. Vectors without a key, null vectors, ones with holes or of another length are no
    neighbours; queries of unequal lengths are an error. Similarities are rounded to ``digits`` before ranking and ties
    go to the lower key, so the result does not depend on the partitioning.
    """
    fields = [
        T.StructField(query, queries.schema[query].dataType),
        T.StructField(key, vecs.schema[key].dataType),
        T.StructField("sim", T.DoubleType()),
    ]
    schema = T.StructType(fields)
    arrow_query, arrow_key = _arrow_type(fields[0].dataType), _arrow_type(fields[1].dataType)
    wide = vecs.where(F.col(key).isNotNull()).select(key, as_doubles(vec).alias(vec))

    def best(names: list, matrix: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Best(names, k, exclude_self)
        step = max(1, 16 * OUTPUT_ROWS // max(1, len(names)))
        for batch in (whole.slice(lo, step) for whole in batches for lo in range(0, whole.num_rows if names else 0, step)):
            rows, usable = _matrix(batch.column(1), matrix.shape[1])
            keys = np.array(batch.column(0).to_pylist())[usable]
            if len(keys):
                kept.add(keys, np.round(matrix @ rows[usable].T, digits) + 0.0)
        if kept.key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, type=arrow_query).take(pa.array(kept.query)), pa.array(kept.key, type=arrow_key), pa.array(kept.sim)],
                names=[f.name for f in fields],
            )

    return rank_hits(_meet(wide, queries, key, query, vec, best, schema), query, "sim", key, k=k)


def most_similar_to_key(
    vecs: DataFrame, keys: DataFrame, k: int, key: str = "key", vec: str = "vec", digits: int = 6
) -> DataFrame:
    """The ``k`` nearest other vectors to each key in ``keys`` (one column); unknown keys give no rows."""
    wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    queries = vecs.join(wanted, key, "left_semi").select(F.col(key).alias("query"), vec)
    return most_similar_to_vector(vecs, queries, k, key=key, vec=vec, digits=digits, exclude_self=True)


def fit_cells(vecs: DataFrame, n_cells: int, seed: int = 42, vec: str = "vec") -> KMeansModel:
    """Cells for approximate search: k-means over the vectors scaled to length one."""
    points = vecs.select(array_to_vector(unit(vec)).alias("features"))
    return KMeans(k=n_cells, seed=seed, maxIter=10).fit(points)


def assign_cells(vecs: DataFrame, model: KMeansModel, vec: str = "vec") -> DataFrame:
    """Each vector scaled to length one, with the ``cell`` it lies in."""
    scaled = vecs.withColumn(vec, unit(vec))
    return (
        model.transform(scaled.withColumn("features", array_to_vector(vec)))
        .withColumnRenamed("prediction", "cell")
        .drop("features")
    )


def approx_most_similar(
    cells: DataFrame,
    model: KMeansModel,
    queries: DataFrame,
    k: int,
    nprobe: int,
    key: str = "key",
    query: str = "query",
    vec: str = "vec",
    digits: int = 6,
    salts: int = 8,
) -> DataFrame:
    """The ``k`` nearest vectors among the ``nprobe`` cells nearest to each query.

    ``cells`` comes from :func:`assign_cells`. Queries meet vectors by cell; a cell's vectors
    are divided over ``salts`` tasks, so a crowded cell is not one task's work. With
    ``nprobe`` equal to the number of cells the result is exact.
    """
    hits = probed_pairs(cells, model, queries, nprobe, key, query, vec, salts)
    sims = hits.select(query, key, (F.round(dot("_vec", "_q"), digits) + 0.0).alias("sim"))
    return rank_hits(sims, query, "sim", key, k=k)


def probed_pairs(
    cells: DataFrame,
    model: KMeansModel,
    queries: DataFrame,
    nprobe: int,
    key: str = "key",
    query: str = "query",
    vec: str = "vec",
    salts: int = 8,
) -> DataFrame:
    """``(query, key, _q, _vec)``: the candidates that the probed cells hold for each query."""
    centers = F.array(
        *[
            F.struct(F.lit(i).alias("cell"), literal_vector(c).alias("center"))
            for i, c in enumerate(model.clusterCenters())
        ]
    )
    nearest = F.slice(
        F.array_sort(
            F.transform(
                centers,
                lambda c: F.struct(
                    (dot(c["center"], c["center"]) - dot(c["center"], "_q") * 2).alias("gap"),
                    c["cell"].alias("cell"),
                ),
            )
        ),
        1,
        nprobe,
    )
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    probes = (
        queries.select(query, unit(vec).alias("_q"))
        .select(query, "_q", F.explode(nearest).alias("_near"))
        .select(query, "_q", F.col("_near.cell").alias("cell"), F.explode(every_salt).alias("_salt"))
    )
    salted = cells.select(
        key, F.col(vec).alias("_vec"), "cell", F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt")
    )
    return salted.join(probes, ["cell", "_salt"]).select(query, key, "_q", "_vec")


def pair_cosine(pairs: DataFrame, a: str, b: str, out: str = "sim") -> DataFrame:
    """Cosine of two vector columns of the same row."""
    return pairs.withColumn(out, cosine(a, b))


def context_vectors(
    docs: DataFrame, buckets: str, radius: int, key: str = "doc_id", tokens: str = "tokens", only: list[str] | None = None
) -> DataFrame:
    """Sparse context vectors ``(key, pos, token, bucket, x)``.

    The base vector of a token is 1 in its bucket; its context vector is the average of the
    base vectors from ``radius`` places before to ``radius`` places behind it. A plain local
    average, not a neural encoder. Built without a shuffle. With ``only``, places of other tokens are left out
    before their neighbours are counted.
    """
    size = F.size(tokens)
    near = [F.slice(F.concat(F.array_repeat(F.lit(None).cast("int"), k), buckets), 1, size) for k in range(radius, 0, -1)]
    near += [F.slice(buckets, k + 1, size) for k in range(radius + 1)]
    names = [f"b{k}" for k in range(len(near))]
    # one row per place with its neighbours' buckets, null beyond the ends
    places = F.arrays_zip(F.col(tokens).alias("token"), *[b.alias(name) for b, name in zip(near, names, strict=True)])
    at = unnest(docs, places, key, name="s", pos="pos").select(key, "pos", "s.*")
    if only is not None:
        at = at.where(F.col("token").isin(only))
    return _spread_mass(at.withColumn("near", F.array_compact(F.array(*names))), [key, "pos", "token"])


def _spread_mass(at: DataFrame, keys: list[str]) -> DataFrame:
    """Each place's neighbour buckets to ``(…, bucket, x)``, repeated buckets added up in the row."""
    shares = unnest(at, F.array_distinct("near"), *keys, "near", name="bucket")
    same = F.size("near") - F.size(F.array_remove("near", F.col("bucket")))
    return shares.select(*keys, "bucket", (same / F.size("near")).alias("x"))


def mean_context(contexts: DataFrame, key: str = "doc_id", token: str = "token") -> DataFrame:
    """The average context vector of each token in each text, sparse: ``(key, token, bucket, x)``.

    The sum over a token's places equals its average up to a factor, which cosine ignores.
    """
    return contexts.groupBy(key, token, "bucket").agg(F.sum("x").alias("x"))


def closer_of(means: DataFrame, target: str, a: str, b: str, key: str = "doc_id", digits: int = 6) -> DataFrame:
    """For each text that holds all three tokens: which of ``a`` and ``b`` is ``target`` nearer to.

    Rows: ``(key, sim_a, sim_b, closer)``. A tie goes to ``b``.
    """

    def of(word: str) -> Column:
        return F.sum(F.when(F.col("token") == word, F.col("x")))

    wide = (
        means.filter(F.col("token").isin(target, a, b))
        .groupBy(key, "bucket")
        .agg(of(target).alias("t"), of(a).alias("a"), of(b).alias("b"))
        .na.fill(0.0, ["t", "a", "b"])
        .groupBy(key)
        .agg(
            *[
                F.sum(F.col(x) * F.col(y)).alias(x + y)
                for x, y in (("t", "t"), ("a", "a"), ("b", "b"), ("t", "a"), ("t", "b"))
            ]
        )
        .filter((F.col("tt") > 0) & (F.col("aa") > 0) & (F.col("bb") > 0))
    )

    def sim(x: str) -> Column:
        return F.round(F.col("t" + x) / F.sqrt(F.col("tt") * F.col(x + x)), digits)

    return wide.select(
        key,
        sim("a").alias("sim_a"),
        sim("b").alias("sim_b"),
        F.when(sim("a") > sim("b"), a).otherwise(b).alias("closer"),
    )
