"""Approximate nearest neighbours by additive quantisation.

A vector is approximated by the sum of one full-dimensional codeword from each of ``books`` codebooks.
Codebooks are fitted on a bounded sample: residual k-means first, then rounds of beam-search encoding
and a least-squares update of all codewords together. Every row is encoded by beam search and stored with
the squared norm of its approximation. A query scores a row as ``norm - 2 * sum of table lookups``, where
its table holds the inner products with all codewords. The best ``shortlist`` of all rows, however they are
partitioned, are ranked again by the exact distance, in double precision.

Queries are a stated set, and are taken in blocks of at most ``query_block`` vectors, one block after the other:
a block is broadcast, every task scores its rows chunk by chunk and keeps the best so far, and the block's results
are written. So neither the driver nor a plan holds more than a block, and a task's memory is a chunk and a block.

Cases: vectors that are null, empty, zero, of another length than most, or that hold a null or non-finite
number take no part, nor do rows without an id; equal distances go to the smaller id, as do equal scores; of equal
vectors only the ``k`` + 1 with the smallest ids can be among anyone's nearest, so no more of them are kept, also
where very many rows are equal; repeated rows are one; rows that share a query's id are the query's own; with fewer
than ``k`` candidates all are returned; other columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quernstone.llm.arrow import small_batches, trim
from quernstone.llm.linear import smallest_hashes
from quernstone.plans.scratch import scratch_path, stored

SAMPLE = 8_192
BOOKS, WORDS, BEAM, SHORTLIST = 32, 64, 4, 512
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part, as doubles."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.filter(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter((F.size("v") > 0) & F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["size"] if sizes else 0))


def _matrix(column) -> np.ndarray:
    """A list column as a matrix, without a Python object for each number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = (np.einsum("ij,ij->i", centres, centres)[None, :] - 2 * x @ centres.T).argmin(1)
        counts = np.bincount(near, minlength=k)
        some = counts > 0
        order = np.argsort(near, kind="stable")
        centres[some] = np.add.reduceat(x[order], (np.cumsum(counts) - counts)[some], axis=0) / counts[some, None]
        centres[~some] = x[rng.choice(len(x), int((~some).sum()))]
    return centres


class Codebooks:
    """books x words x dimensions, with all inner products of codewords."""

    def __init__(self, words: np.ndarray):
        self.words = words.astype(np.float32)
        m, k, d = words.shape
        flat = self.words.reshape(m * k, d)
        self.products = (flat @ flat.T).reshape(m, k, m, k)
        self.norms = np.einsum("mkd,mkd->mk", self.words, self.words)

    def __reduce__(self):
        return Codebooks, (self.words,)

    def encode(self, x: np.ndarray, beam: int) -> np.ndarray:
        """Beam search: books are taken in turn, and of all one-word extensions of the beam the best stay."""
        m, k, _ = self.words.shape
        x = x.astype(np.float32)
        n = len(x)
        inner = np.einsum("nd,mkd->nmk", x, self.words, optimize=True)
        codes = np.zeros((n, 1, 0), np.int64)
        cost = np.zeros((n, 1), np.float32)
        for b in range(m):
            # |x - s - w|^2 = |x - s|^2 + |w|^2 - 2 x.w + 2 s.w, where s is the sum so far.
            grown = cost[:, :, None] + self.norms[b] - 2 * inner[:, None, b, :]
            for a in range(b):
                grown = grown + 2 * self.products[a, codes[:, :, a], b]
            width = min(beam, grown.shape[1] * k)
            flat = grown.reshape(n, -1)
            best = np.argpartition(flat, width - 1, axis=1)[:, :width]
            cost = np.take_along_axis(flat, best, 1)
            codes = np.concatenate([np.take_along_axis(codes, (best // k)[:, :, None], 1), (best % k)[:, :, None]], 2)
        return codes[np.arange(n), cost.argmin(1)].astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.words[b][codes[:, b]] for b in range(self.words.shape[0]))


def fit(x: np.ndarray, books: int = BOOKS, size: int = WORDS, beam: int = BEAM, rounds: int = 2, seed: int = 7) -> Codebooks:
    """Codebooks from a sample, which is bounded by the caller."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    size = max(1, min(size, 256, len(x)))
    residual, words = x.astype(np.float64), []
    for _ in range(books):
        words.append(_kmeans(residual, size, 10, rng))
        near = (np.einsum("ij,ij->i", words[-1], words[-1])[None, :] - 2 * residual @ words[-1].T).argmin(1)
        residual = residual - words[-1][near]
    found = Codebooks(np.stack(words))
    for _ in range(rounds):
        codes = np.concatenate([found.encode(part, beam) for part in np.array_split(x, max(1, len(x) // 1024))])
        places = codes.astype(np.int64) + np.arange(books) * size
        gram = np.zeros((books * size, books * size))
        right = np.zeros((books * size, d))
        for a in range(books):
            np.add.at(right, places[:, a], x)
            for b in range(books):
                np.add.at(gram, (places[:, a], places[:, b]), 1.0)
        # A small ridge towards the words so far keeps unused words where they are.
        old = found.words.reshape(-1, d).astype(np.float64)
        solved = np.linalg.solve(gram + 0.1 * np.eye(len(gram)), right + 0.1 * old)
        found = Codebooks(solved.reshape(books, size, d))
    return found


def sample_rows(rows: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` vectors, those with the smallest hash of the id; what is sent to the driver is bounded."""
    part = smallest_hashes(rows, "vec_id", most).select("v").toArrow()
    return _matrix(part.column("v")) if part.num_rows else np.zeros((0, 1))


def index(rows: DataFrame, found: Codebooks, beam: int = BEAM, chunk: int = 1024) -> DataFrame:
    """Every row (row, vec_id, v) with its codes and the squared norm of its approximation."""

    def run(parts):
        for part in parts:
            for at in range(0, part.num_rows, chunk):
                some = part.slice(at, chunk)
                codes = found.encode(_matrix(some.column(2)), beam)
                close = found.decode(codes)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(np.einsum("ij,ij->i", close, close).astype(np.float32))], names=["row", "vec_id", "v", "codes", "norm"])

    return rows.mapInArrow(run, "row long, vec_id long, v array<double>, codes binary, norm float")


class Best:
    """The best few rows of each query so far, by score and then by id."""

    def __init__(self, queries: int, most: int):
        self.most = most
        self.scores = np.zeros((queries, 0), np.float32)
        self.ids = np.zeros((queries, 0), np.int64)
        self.rows = np.zeros((queries, 0), np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``scores`` of rows for each query; infinite ones don't count."""
        n = len(scores)
        every = np.concatenate([self.scores, scores], 1)
        ids = np.concatenate([self.ids, np.broadcast_to(ids, (n, len(ids)))], 1)
        rows = np.concatenate([self.rows, np.broadcast_to(rows, (n, len(rows)))], 1)
        if every.shape[1] > self.most:
            best = np.argpartition(every, self.most - 1, axis=1)[:, : self.most]
            edge = np.take_along_axis(every, best, 1).max(1)
            for q in np.flatnonzero((every <= edge[:, None]).sum(1) > self.most):  # ties at the edge
                fits = np.flatnonzero(every[q] <= edge[q])
                best[q] = fits[np.lexsort((ids[q, fits], every[q, fits]))[: self.most]]
            every, ids, rows = (np.take_along_axis(x, best, 1) for x in (every, ids, rows))
        self.scores, self.ids, self.rows = every, ids, rows


def _shortlisted(indexed: DataFrame, asked, found: Codebooks, shortlist: int, chunk: int = 4096, together: int = 256) -> DataFrame:
    """(query, row, vec_id, score): the best of all rows for each query of a block, by the tables."""
    books = found.words.shape[0]

    def run(parts):
        query_ids, q = asked.value
        tables = np.einsum("qd,mkd->mqk", q.astype(np.float32), found.words, optimize=True)
        best = [Best(len(query_ids[at : at + together]), shortlist) for at in range(0, len(query_ids), together)]
        for part in parts:
            for start in range(0, part.num_rows, chunk):
                some = part.slice(start, chunk)
                rows, ids = some.column(0).to_numpy(), some.column(1).to_numpy()
                codes = np.frombuffer(b"".join(some.column(2).to_pylist()), np.uint8).reshape(-1, books)
                norms = some.column(3).to_numpy()
                for k, held in enumerate(best):
                    own = slice(k * together, (k + 1) * together)
                    score = np.broadcast_to(norms, (len(held.scores), len(norms))).copy()
                    for b in range(books):
                        score -= 2 * tables[b, own][:, codes[:, b]]
                    score[query_ids[own][:, None] == ids[None, :]] = np.inf
                    held.add(score, ids, rows)
        for k, held in enumerate(best):
            fair = np.isfinite(held.scores)
            query = np.repeat(np.arange(len(held.scores)) + k * together, fair.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(held.rows[fair]), pa.array(held.ids[fair]), pa.array(held.scores[fair], pa.float32())], names=["query", "row", "vec_id", "near"])
        trim()

    parts = indexed.select("row", "vec_id", "codes", "norm").mapInArrow(run, "query long, row long, vec_id long, near float")
    order = Window.partitionBy("query").orderBy("near", "vec_id", "row")
    return parts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= shortlist).select("query", "row", "vec_id")


def search(indexed: DataFrame, queries: DataFrame, found: Codebooks, k: int = 10, shortlist: int = SHORTLIST, query_block: int = 4096) -> DataFrame:
    """Each query's k nearest of the indexed rows: query_id, rank, vec_id, score."""
    spark = indexed.sparkSession
    blocks = -(-queries.count() // query_block)
    path = scratch_path(spark, "nearest")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for block in range(blocks):
        # Hashes deal the queries out evenly; a block's size is bounded by the mean and a little more.
        mine = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).select("vec_id", "v").toArrow()
        if not mine.num_rows:
            continue
        asked = spark.sparkContext.broadcast((mine.column("vec_id").to_numpy(), _matrix(mine.column("v"))))

        def exact(parts, asked=asked):
            query_ids, q = asked.value
            for part in parts:
                query = part.column(0).to_numpy()
                x = _matrix(part.column(2))
                away = np.sqrt(((x - q[query]) ** 2).sum(1)) if len(x) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[query], pa.int64()), part.column(1), pa.array(away)], names=["query_id", "vec_id", "score"])

        near = _shortlisted(indexed, asked, found, shortlist)
        with_vectors = near.select("query", "row", "vec_id").join(indexed.select("row", "v"), "row").select("query", "vec_id", "v")
        scored = with_vectors.mapInArrow(exact, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        asked.unpersist()
    return spark.read.schema(RESULT).parquet(path)


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, books: int = BOOKS, size: int = WORDS, beam: int = BEAM, shortlist: int = SHORTLIST, sample: int = SAMPLE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Fit, index every row, and search the rows where ``is_query`` holds among all rows."""
    rows = stored(usable(small_batches(vectors), vec_id, vector).distinct(), "vectors")
    x = sample_rows(rows, sample)
    if not len(x):
        return rows.sparkSession.createDataFrame([], RESULT)
    found = fit(x, books, size, beam)
    trim()
    # Of equal vectors only the first k + 1 ids matter; tasks send no more of them on.
    alike = Window.partitionBy(F.xxhash64("v"), F.xxhash64(F.lit(1), "v")).orderBy("vec_id")
    kept = rows.withColumn("copy", F.row_number().over(alike)).filter(F.col("copy") <= k + 1).select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    indexed = stored(index(kept, found, beam), "index")
    return search(indexed, rows.filter(is_query), found, k, shortlist)
