"""Exact top-k search by inner product: branch and bound over ball trees.

Vectors are dealt into shards of bounded size, those near one pivot together,
and each shard's rows are ordered as a balanced ball tree: every node is a run
of rows with a centre and a radius, so ``q . centre + |q| * radius`` bounds the
score of all its rows. A query first searches its own shard. Its k-th score so
far goes with it to all other shards: those whose root ball can't reach it are
left out, and inside the others nodes are pruned by it and leaves are visited
in order of their bounds, the k-th score rising on the way. Components are
integers, so scores are exact; bounds get a margin for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyspark.llm.common import scratch, small_batches, staged, table
from plyspark.llm.top_k import HIGHEST, Best

TOP = 5
SCALE = 256
#: Bytes of a shard's vectors (as doubles), rows of a leaf, queries of a block.
SHARD_BYTES, LEAF_ROWS, BLOCK_QUERIES = 4 << 20, 128, 8192
#: The pivots come from a sample of so many rows and bytes at most; they only
#: decide which vectors share a shard, never which are found.
SAMPLE_ROWS, SAMPLE_BYTES, MOST_PIVOTS = 8192, 16 << 20, 1024
#: Root balls that meet a block of queries at once.
BLOCK_ROOTS = 4096
_LOW = np.iinfo(np.int64).min
_MARGIN = 1e-9


def pack(values: np.ndarray) -> list[bytes]:
    """Rows of integers held as floats, in four bytes where they fit."""
    small = len(values) == 0 or np.abs(values).max(initial=0) < 1 << 24
    return [r.tobytes() for r in values.astype("<f4" if small else "<f8")]


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(packed), dim))
    for width in (4, 8) if dim else ():
        at = [i for i, raw in enumerate(packed) if len(raw) == width * dim]
        if at:
            out[at] = np.frombuffer(b"".join([packed[i] for i in at]), f"<f{width}").reshape(len(at), dim)
    return out


def integer_vectors(rows: DataFrame, is_query: str, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``_uid, _id, _query, _dim, _v``: the vectors that take part, each
    component x as floor(scale * x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = lists.flatten()
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(values.fill_null(np.nan).to_numpy(zero_copy_only=False) * scale)
            sizes = np.array(lists.value_lengths().fill_null(-1).to_pylist(), np.int64)
            ends = np.cumsum(np.maximum(sizes, 0))
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            starts = ends - np.maximum(sizes, 0)
            keep = np.flatnonzero((sizes >= 0) & (bad[ends] == bad[starts]))
            packed = [pack(flat[None, starts[i] : ends[i]])[0] for i in keep.tolist()]
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(kept) for c in range(3)), pa.array(sizes[keep]), pa.array(packed, pa.binary())],
                ["_uid", "_id", "_query", "_dim", "_v"],
            )

    wanted = rows.select(
        F.monotonically_increasing_id().alias("_uid"),
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.expr(is_query), F.lit(False)).alias("_query"),
        F.col(vector_col).cast("array<double>").alias("_vector"),
    )
    return wanted.mapInArrow(run, "_uid long, _id long, _query boolean, _dim long, _v binary")


def pivots(sample: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Centres of ``count`` groups of the sample at most."""
    centre = np.unique(sample, axis=0)
    centre = centre[np.random.default_rng(3).permutation(len(centre))[:count]]
    for _ in range(rounds if len(centre) > 1 else 0):
        near = nearest(sample, centre)
        sums = np.zeros_like(centre)
        np.add.at(sums, near, sample)
        held = np.bincount(near, minlength=len(centre))
        centre[held > 0] = sums[held > 0] / held[held > 0, None]
    return centre


def nearest(values: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (values @ centre.T - (centre * centre).sum(1) / 2).argmax(1)


class BallTree:
    """Rows in tree order. Level ``l`` halves the rows ``l`` times; the nodes
    of each level have a centre, a radius and a smallest identifier."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, null: np.ndarray, uids: np.ndarray, leaf: int = LEAF_ROWS, ordered: bool = False):
        n = len(values)
        cuts = [np.array([0, n])]
        while np.diff(cuts[-1]).max(initial=0) > leaf:
            halves = (cuts[-1][:-1] + cuts[-1][1:]) // 2
            cuts.append(np.sort(np.concatenate([cuts[-1], halves])))
        if not ordered:
            order = np.lexsort((ids, null))  # among equal vectors the smallest identifiers share a leaf
            for level in cuts[:-1]:
                for a, b in zip(level[:-1].tolist(), level[1:].tolist()):
                    part = values[order[a:b]]
                    far = part[((part - part.mean(0)) ** 2).sum(1).argmax()]
                    other = part[((part - far) ** 2).sum(1).argmax()]
                    order[a:b] = order[a:b][np.argsort(part @ (other - far), kind="stable")]
            values, ids, null, uids = values[order], ids[order], null[order], uids[order]
        self.values, self.ids, self.null, self.uids = values, ids, null, uids
        self.largest = float(np.abs(values).max(initial=0))
        shown = np.where(null, HIGHEST, ids)
        self.levels = []
        for level in cuts:
            starts, sizes = level[:-1], np.diff(level)
            centre = np.add.reduceat(values, starts, axis=0) / sizes[:, None]
            away = np.sqrt(((values - np.repeat(centre, sizes, axis=0)) ** 2).sum(1))
            self.levels.append((level, centre, np.maximum.reduceat(away, starts), np.minimum.reduceat(shown, starts)))

    def search(self, queries: np.ndarray, uids: np.ndarray, least: np.ndarray, least_id: np.ndarray, k: int) -> Best:
        """The best ``k`` of each query here that reach its k-th score so far
        (``least``, of the identifier ``least_id``). Its own row is left out."""
        best = Best(least, k, least_id)
        norm = np.sqrt((queries**2).sum(1))
        keep = np.ones((len(queries), 1), bool)
        for depth, (cuts, centre, radius, smallest) in enumerate(self.levels):
            bound = upper_bounds(queries, norm, centre, radius)
            if depth:
                keep = keep[:, np.searchsorted(self.levels[depth - 1][0], cuts[:-1], side="right") - 1]
            keep = keep & reaches(bound, smallest[None, :], best.least[:, None], best.least_id[:, None])
        turn = np.argsort(np.where(keep, -bound.astype(float), np.inf), axis=1, kind="stable")
        rows = np.arange(len(queries))
        place = {int(u): i for i, u in enumerate(self.uids.tolist())}
        itself = np.array([place.get(u, -1) for u in uids.tolist()], np.int64)
        for leaf in turn.T:  # each query's next leaf by its bound
            go = keep[rows, leaf] & reaches(bound[rows, leaf], smallest[leaf], best.least, best.least_id)
            if not go.any():
                break
            for j in np.unique(leaf[go]).tolist():
                asking = np.flatnonzero(go & (leaf == j))
                a, b = int(cuts[j]), int(cuts[j + 1])
                scores = inner_products(self.values[a:b], queries[asking], self.largest)
                best.add(asking, scores, self.ids[a:b], self.null[a:b], np.arange(a, b)[:, None] == itself[asking])
        return best


def inner_products(values: np.ndarray, queries: np.ndarray, largest: float) -> np.ndarray:
    """Exact scores, held at a long's ends where one exceeds them."""
    if largest * float(np.abs(queries).max(initial=0)) * max(1, values.shape[1]) < 2.0**53:
        return (values @ queries.T).astype(np.int64)
    whole, asked = ([[int(x) for x in row] for row in m.tolist()] for m in (values, queries))
    sums = [[min(max(sum(map(int.__mul__, v, q)), _LOW), HIGHEST) for q in asked] for v in whole]
    return np.array(sums, np.int64).reshape(len(values), len(queries))


def upper_bounds(queries: np.ndarray, norm: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The highest integer that a row of each ball can score, at a long's end
    where that is not known; the margin covers rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        bound = queries @ centre.T + norm[:, None] * radius
        bound = np.floor(bound + _MARGIN * (1 + norm[:, None] * (np.sqrt((centre**2).sum(1)) + radius)))
        known = bound < 2.0**62  # not so for NaN
        out = np.where(known, np.maximum(bound, -(2.0**62)), 0).astype(np.int64)
    return np.where(known, out, HIGHEST)


def reaches(bound: np.ndarray, smallest: np.ndarray, least: np.ndarray, least_id: np.ndarray) -> np.ndarray:
    """Whether a ball may hold a row above the k-th score, or level with it
    under a smaller identifier."""
    return (bound > least) | ((bound == least) & (smallest <= least_id))


_PAIR = "_quid long, _v binary, _least long, _least_id long, _dim long, _qb long, _shard string"
_PAIR_COLUMNS = [c.split()[0] for c in _PAIR.split(", ")]
_FOUND = "_quid long, _id long, _null boolean, score long"


def _search_pairs(pairs: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """What each pair of query and shard finds. A shard's tree meets its
    queries block by block."""
    wanted = trees.join(pairs.select("_shard", F.col("_qb").alias("_block")).distinct(), "_shard")

    def find(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"_quid": [], "_id": [], "_null": [], "score": []}).astype({"_null": bool})]
        for row in held.itertuples() if len(asked) else ():
            tree = BallTree(unpack_rows(row.tree, row.dim, row.width, row.rows), np.frombuffer(row.ids, "<i8"),
                            np.frombuffer(row.nulls, bool), np.frombuffer(row.uids, "<i8"), ordered=True)
            for at in range(0, len(asked), 1024):
                part = asked.iloc[at : at + 1024]
                uids = part["_quid"].to_numpy()
                best = tree.search(unpack(part["_v"].tolist(), row.dim), uids, part["_least"].to_numpy(), part["_least_id"].to_numpy(), k)
                out.append(pd.DataFrame({"_quid": uids[best.query], "_id": best.id, "_null": best.null, "score": best.score}))
        return pd.concat(out[1:] or out)

    return pairs.groupBy("_shard", "_qb").cogroup(wanted.groupBy("_shard", "_block")).applyInPandas(find, _FOUND)


def unpack_rows(raw: bytes, dim: int, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, f"<f{width}").reshape(rows, dim).astype(float) if dim else np.zeros((rows, 0))


def _shards(vectors: DataFrame, rows: int, largest_dim: int, shard_bytes: int) -> DataFrame:
    """``vectors`` with ``_shard``: its dimension, its nearest pivot, and a
    part of that cell where the cell holds more rows than a shard should."""
    of_dim = F.lit(shard_bytes) / (8 * F.greatest(F.col("_dim"), F.lit(1)))
    most = F.greatest(F.lit(16), F.floor(of_dim))
    sample_rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, largest_dim))))
    share = min(1.0, 4 * sample_rows / max(rows, 1))
    chosen = vectors.where(F.pmod(F.xxhash64("_uid"), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    sample: dict[int, list] = {}
    for r in chosen.select("_dim", "_v", F.xxhash64("_uid").alias("_h")).orderBy("_h").limit(sample_rows).collect():
        sample.setdefault(r["_dim"], []).append(bytes(r["_v"]))
    centre = {}
    for dim, packed in sample.items():
        shard = max(16, shard_bytes // (8 * max(1, dim)))
        centre[dim] = pivots(unpack(packed, dim), min(MOST_PIVOTS, max(1, -(-rows // shard))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            packed = batch.column(4).to_pylist()
            cell = np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim in centre and dim:
                    cell[at] = nearest(unpack([packed[i] for i in at], dim), centre[dim])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["_uid", "_id", "_query", "_dim", "_v", "_cell"])

    celled = staged(vectors.mapInArrow(cells, "_uid long, _id long, _query boolean, _dim long, _v binary, _cell long"), "balls-cells")
    parts = celled.groupBy("_dim", "_cell").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_dim", "_cell", F.ceil(F.col("_rows") / most).alias("_parts")
    )
    part = F.pmod(F.xxhash64("_uid"), F.col("_parts"))
    return celled.join(parts, ["_dim", "_cell"]).select(
        "_uid", "_id", "_query", "_dim", "_v", F.concat_ws("-", "_dim", "_cell", part).alias("_shard")
    )


def _trees(shards: DataFrame) -> DataFrame:
    """One row a shard: its rows in tree order, and its root ball."""

    def build(held: pd.DataFrame) -> pd.DataFrame:
        dim = int(held["_dim"].iloc[0])
        values = unpack(held["_v"].tolist(), dim)
        tree = BallTree(values, held["_id"].to_numpy(), held["_null"].to_numpy(bool), held["_uid"].to_numpy())
        width = 4 if tree.largest < 1 << 24 else 8
        _, centre, radius, smallest = tree.levels[0]
        return pd.DataFrame({
            "_shard": [held["_shard"].iloc[0]], "dim": [dim], "width": [width], "rows": [len(values)], "tree": [tree.values.astype(f"<f{width}").tobytes()],
            "ids": [tree.ids.astype("<i8").tobytes()], "nulls": [tree.null.tobytes()], "uids": [tree.uids.astype("<i8").tobytes()],
            "centre": [centre.tobytes()], "radius": [float(radius[0])], "smallest": [int(smallest[0])],
        })

    # A null identifier is marked: pandas would make doubles of all of them.
    rows = shards.select("_shard", "_dim", "_v", "_uid", F.coalesce("_id", F.lit(0)).alias("_id"), F.col("_id").isNull().alias("_null"))
    return rows.groupBy("_shard").applyInPandas(
        build,
        "_shard string, dim long, width int, rows long, tree binary, ids binary, nulls binary, uids binary, centre binary, radius double, smallest long",
    )


def _reached(asked: DataFrame, trees: DataFrame, query_blocks: int, root_blocks: int) -> DataFrame:
    """Pairs of a query and another shard whose root ball it may reach:
    blocks of queries meet blocks of root balls."""

    def reach(asked: pd.DataFrame, roots: pd.DataFrame) -> pd.DataFrame:
        out = [asked.iloc[:0]]
        if len(asked) and len(roots):
            centre = np.stack([np.frombuffer(c, "<f8") for c in roots["centre"]])
            shard, radius, smallest = (roots[c].to_numpy() for c in ("_shard", "radius", "smallest"))
            for at in range(0, len(asked), 1024):
                part = asked.iloc[at : at + 1024]
                queries = unpack(part["_v"].tolist(), centre.shape[1])
                bound = upper_bounds(queries, np.sqrt((queries**2).sum(1)), centre, radius)
                go = reaches(bound, smallest[None, :], part["_least"].to_numpy()[:, None], part["_least_id"].to_numpy()[:, None])
                query, root = np.nonzero(go & (part["_shard"].to_numpy()[:, None] != shard[None, :]))
                out.append(part.iloc[query].assign(_shard=shard[root]))
        return pd.concat(out[1:] or out)[_PAIR_COLUMNS]

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    roots = trees.select(
        "_shard", "centre", "radius", "smallest", F.col("dim").alias("_dim"),
        F.pmod(F.xxhash64("_shard"), F.lit(root_blocks)).alias("_rb"), every(query_blocks).alias("_qb"),
    )
    meet = ["_dim", "_qb", "_rb"]
    spread = asked.select(*_PAIR_COLUMNS, every(root_blocks).alias("_rb"))
    return spread.groupBy(*meet).cogroup(roots.groupBy(*meet)).applyInPandas(reach, _PAIR)


def top_inner_products(rows: DataFrame, is_query: str, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding",
                       scale: int = SCALE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that the SQL condition ``is_query`` marks
    the ``k`` other rows of highest integer inner product (all, if fewer), ties
    to the smaller identifier, null identifiers last.

    A component x counts as floor(scale * x). Vectors that are null or hold a
    null or non-finite component (scaled ones included) take no part; empty
    ones score 0. Only vectors of one length meet. A repeated row is a
    candidate of its own, and each repeated query is answered. Scores beyond a
    long are held at its end. Other columns are ignored. No rows give no rows.
    """
    spark = rows.sparkSession
    small_batches(spark)
    with scratch():
        vectors = staged(integer_vectors(rows, is_query, id_col, vector_col, scale), "balls-vectors")
        size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max("_dim").alias("dim"), F.count_if("_query").alias("asked")).first()
        shards = staged(_shards(vectors, int(size["n"]), int(size["dim"] or 0), shard_bytes), "balls-shards")
        trees = staged(_trees(shards), "balls-trees")
        query_blocks = max(1, -(-int(size["asked"]) // BLOCK_QUERIES))
        asked = shards.where("_query").select(
            F.col("_uid").alias("_quid"), "_v", F.lit(_LOW).alias("_least"), F.lit(HIGHEST).alias("_least_id"), "_dim",
            F.pmod(F.xxhash64("_uid"), F.lit(query_blocks)).alias("_qb"), "_shard",
        )
        first = staged(_search_pairs(asked, trees, k), "balls-own-shard")
        in_order = Window.partitionBy("_quid").orderBy(F.desc("score"), "_null", "_id")
        kth = first.withColumn("_rank", F.row_number().over(in_order)).where(F.col("_rank") == k).select(
            "_quid", F.col("score").alias("_kth"), F.when(F.col("_null"), HIGHEST).otherwise(F.col("_id")).alias("_kth_id")
        )
        bounded = asked.join(kth, "_quid", "left").withColumns(
            {"_least": F.coalesce("_kth", "_least"), "_least_id": F.coalesce("_kth_id", "_least_id")}
        )
        root_blocks = max(1, -(-trees.count() // BLOCK_ROOTS))
        pairs = staged(_reached(bounded, trees, query_blocks, root_blocks), "balls-pairs")
        found = first.unionByName(_search_pairs(pairs, trees, k))
        ranked = found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)
        queries = shards.where("_query").select(F.col("_uid").alias("_quid"), F.col("_id").alias("query_id"))
        return staged(
            ranked.join(queries, "_quid").select(
                "query_id", "rank", F.when(~F.col("_null"), F.col("_id")).alias("vec_id"), "score"
            ),
            "balls-ranked", keep=True,
        )


def op12_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


ORACLE_SQL = f"""
with v as (
  select row_number() over () as r, vec_id, [floor({SCALE} * cast(x as double)) for x in embedding] as q
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select a.r, a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.r <> b.r and len(a.q) = len(b.q)
), ranked as (
  select query_id, vec_id, score, row_number() over (partition by r order by score desc, vec_id nulls last) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= {TOP}
"""
