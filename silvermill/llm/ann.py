"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

The scheme of Chen et al., "SPANN" (2021). A balanced k-means tree over a bounded
sample gives centroids, which stay in memory as a neighbourhood graph. Every
vector goes to the list of its nearest centroid, and to further lists whose
centroids are nearly as near, unless one already chosen lies closer to them than
the vector does. A query walks the graph, keeps the lists whose centroids are
within a ratio of the nearest one's distance (or of the distance by which lists
hold as many vectors as are asked for), and compares itself with all of their
vectors in double precision.

Inner products become distances by one more coordinate: with M the greatest norm,
a vector x gets sqrt(M^2 - |x|^2) and a query 0, so that the nearest is the one
with the largest product.

Equal vectors are searched as one. A list is stored in blocks of bounded size, so
a list of any length is searched by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from silvermill.scratch import stored


# The index's memory: centroids and their graph

def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 0) -> np.ndarray:
    """Centroids of clusters of about equal size: the largest is split until there are `lists`."""
    draw = np.random.default_rng(seed)
    clusters = [sample]
    limit = max(2, -(-len(sample) // lists))
    while len(clusters) < lists:
        largest = max(range(len(clusters)), key=lambda i: len(clusters[i]))
        points = clusters[largest]
        if len(points) < 2:
            break
        ways = int(min(8, max(2, len(points) // limit), lists - len(clusters) + 1, len(points)))
        parts = [p for p in _balanced_split(points, ways, draw) if len(p)]
        if len(parts) < 2:
            parts = np.array_split(points, 2)
        clusters[largest : largest + 1] = parts
    return on_sphere(
        np.stack([points.mean(axis=0) for points in clusters if len(points)]),
        np.sqrt((sample * sample).sum(1).max()),
    )


def on_sphere(points: np.ndarray, norm: float) -> np.ndarray:
    """A mean of raised vectors is shorter than they are; on their sphere, distances
    between centroids compare with those to vectors."""
    length = np.sqrt((points * points).sum(1))[:, None]
    return np.where(length > 0, points * norm / np.where(length > 0, length, 1), points)


def _balanced_split(points: np.ndarray, ways: int, draw) -> list[np.ndarray]:
    """Lloyd's steps in which a crowded centre is made to look farther away."""
    centres = points[draw.choice(len(points), ways, replace=False)]
    fair = len(points) / ways
    sizes = np.full(ways, fair)
    spread = points.var(axis=0).sum()
    for _ in range(12):
        far = squared_distances(points, centres) + 0.5 * spread * (sizes / fair - 1)
        label = far.argmin(axis=1)
        sizes = 0.5 * sizes + 0.5 * np.bincount(label, minlength=ways)
        for i in range(ways):
            if (label == i).any():
                centres[i] = points[label == i].mean(axis=0)
    return [points[label == i] for i in range(ways)]


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def centroid_graph(centroids: np.ndarray, degree: int = 16, seed: int = 0) -> np.ndarray:
    """Each centroid's neighbours: the nearest that no kept one shields, then a few
    at random and the next in number, so that every centroid can be reached."""
    n = len(centroids)
    draw = np.random.default_rng(seed)
    near = np.zeros((n, degree + 4), np.int64)
    for i in range(n):
        far = squared_distances(centroids[i : i + 1], centroids)[0]
        far[i] = np.inf
        some = np.argsort(far)[: 4 * degree]
        kept: list[int] = []
        for j in some:
            if len(kept) == degree:
                break
            if all(((centroids[j] - centroids[k]) ** 2).sum() > far[j] for k in kept):
                kept.append(int(j))
        kept += [int(j) for j in some if j not in kept][: degree - len(kept)]
        kept += [(i + 1) % n, *draw.integers(0, n, degree + 3)]
        near[i] = kept[: degree + 4]
    return near


def walk_graph(
    points: np.ndarray, centroids: np.ndarray, near: np.ndarray, width: int, strides: int = 4
) -> tuple[np.ndarray, np.ndarray]:
    """For many points at once, best-first: the `width` nearest centroids found
    and their squared distances, nearest first. A step visits the neighbours of
    the `strides` best centroids whose neighbours are still unknown."""
    n, count = len(centroids), len(points)
    width = min(width, n)
    squares = (centroids * centroids).sum(1)
    own = (points * points).sum(1)
    beam = np.tile(np.unique(np.linspace(0, n - 1, width).astype(np.int64)), (count, 1))
    far = np.maximum(own[:, None] + squares[beam[0]] - 2 * points @ centroids[beam[0]].T, 0)
    open_ = np.ones(beam.shape, bool)
    seen = np.zeros((count, n), bool)
    seen[:, beam[0]] = True
    last = np.zeros((count, n), np.int32)  # of equal neighbours, the last counts
    while True:
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        beam, far, open_ = (np.take_along_axis(x, order, 1) for x in (beam, far, open_))
        active = np.flatnonzero(open_.any(axis=1))
        if not len(active):
            return beam, far
        best = np.argsort(~open_[active], axis=1, kind="stable")[:, :strides]
        row = active[:, None]
        usable = np.repeat(open_[row, best], near.shape[1], axis=1)
        open_[row, best] = False
        reached = near[beam[row, best]].reshape(len(active), -1)
        number = np.arange(reached.shape[1])
        last[row, reached] = number
        fresh = usable & ~seen[row, reached] & (last[row, reached] == number)
        seen[row, np.where(usable, reached, beam[active][:, :1])] = True
        new = np.full((count, reached.shape[1]), np.inf)
        i, j = np.nonzero(fresh)
        at, centre = active[i], reached[i, j]
        new[at, j] = np.maximum(
            own[at] + squares[centre] - 2 * np.einsum("ij,ij->i", points[at], centroids[centre]), 0
        )
        more = np.zeros(new.shape, np.int64)
        more[active] = reached
        beam = np.concatenate([beam, more], axis=1)
        far = np.concatenate([far, new], axis=1)
        open_ = np.concatenate([open_, np.isfinite(new)], axis=1)


def lists_of_vectors(
    points: np.ndarray, centroids: np.ndarray, near: np.ndarray, ratio: float, replicas: int, width: int
) -> Iterator[tuple[int, int]]:
    """(point, list): the nearest list, and others within `ratio` of its distance."""
    found, far = walk_graph(points, centroids, near, width)
    far = np.sqrt(far)
    for i in range(len(points)):
        chosen = [found[i, 0]]
        yield i, int(found[i, 0])
        for c, d in zip(found[i, 1:], far[i, 1:]):
            if len(chosen) == replicas or d > ratio * far[i, 0] + 1e-12:
                break
            if all(np.sqrt(((centroids[c] - centroids[k]) ** 2).sum()) > d for k in chosen):
                chosen.append(c)
                yield i, int(c)


# The distributed part

@dataclass(frozen=True)
class AnnIndex:
    """`vectors`: (key, vector, ids), each vector once; `postings`: (list, block,
    blocks, key, least, vector), `least` the smallest id. Both are tables in the
    shared folder. `counts`: how many vectors have a list as their nearest."""

    vectors: DataFrame
    postings: DataFrame
    centroids: np.ndarray
    near: np.ndarray
    norm: float
    counts: np.ndarray
    keep_ids: int = 21


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) without vectors that are null, zero, or hold null,
    NaN or infinity; and without those of another length than most have (ties:
    the shorter)."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = rows.where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = good.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").first()
    return good.where(F.size("vector") == (usual.length if usual else 0))


def build_index(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    list_size: int = 256, max_lists: int = 4096, max_sample: int = 65_536, ratio: float = 1.15,
    replicas: int = 4, width: int = 24, keep_ids: int = 21, block_rows: int = 4096,
) -> AnnIndex:
    """Every usable vector in its posting lists.

    The sample that centroids are fitted on has at most `max_sample` vectors,
    those whose hashes are lowest; there are at most `max_lists` centroids (4 MB
    at 128 dimensions), which are what is broadcast. Of the ids that share a
    vector, the `keep_ids` smallest are kept: as many neighbours as a search may
    ask for, and one more.
    """
    spark = table.sparkSession
    usable = usable_vectors(table, id_col, vector_col)
    key = F.xxhash64(F.transform("vector", lambda x: x + 0.0))
    keyed = usable.select("id", key.alias("key"), F.transform("vector", lambda x: x + 0.0).alias("vector"))
    same = Window.partitionBy("key", "vector").orderBy("id")
    ids = (
        keyed.withColumn("place", F.row_number().over(same)).where(F.col("place") <= keep_ids)
        .groupBy("key", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    vectors = stored(ids, "ann-vectors")
    norm2 = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    facts = vectors.agg(F.count("*").alias("n"), F.max(norm2).alias("norm2")).first()
    if not facts.n:
        none = np.zeros((0, 0))
        empty = vectors.select(
            F.lit(0).alias("list"), F.lit(0).alias("block"), F.lit(1).alias("blocks"), "key",
            F.col("ids")[0].alias("least"), "vector",
        )
        return AnnIndex(vectors, empty, none, none, 0.0, np.zeros(0, np.int64), keep_ids)
    norm = float(np.sqrt(facts.norm2))
    sample = vectors.orderBy(F.xxhash64("key"), "vector").limit(max_sample).select("vector").toPandas()
    points = raised(np.stack(sample["vector"]), norm)
    lists = int(min(max_lists, max(1, -(-facts.n // list_size)), len(points)))
    centroids = balanced_centroids(points, lists)
    near = centroid_graph(centroids)
    shared = spark.sparkContext.broadcast((centroids, near, norm))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, graph, top = shared.value
        for frame in frames:
            for at in range(0, len(frame), 512):
                part = frame.iloc[at : at + 512]
                places = list(lists_of_vectors(
                    raised(np.stack(part["vector"]), top), centres, graph, ratio, replicas, width
                ))
                row, number = np.array([p[0] for p in places]), np.array([p[1] for p in places])
                own = np.concatenate([[True], row[1:] != row[:-1]])  # the nearest comes first
                yield part.iloc[row].assign(list=number, own=own)[["list", "own", "key", "least", "vector"]]

    kind = usable.schema["id"].dataType.simpleString()
    dealt = stored(
        vectors.select("key", F.col("ids")[0].alias("least"), "vector").mapInPandas(
            deal, f"list int, own boolean, key long, least {kind}, vector array<double>"
        ),
        "ann-postings",
    )
    counts = np.zeros(len(centroids), np.int64)
    for row in dealt.where("own").groupBy("list").count().collect():
        counts[row["list"]] = row["count"]
    sizes = dealt.groupBy("list").count().withColumn("blocks", F.ceil(F.col("count") / block_rows))
    postings = dealt.join(sizes, "list").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    ).select("list", "block", "blocks", "key", "least", "vector")
    return AnnIndex(vectors, postings, centroids, near, norm, counts, keep_ids)


def raised(vectors: np.ndarray, norm: float) -> np.ndarray:
    """With the coordinate that makes the largest product the smallest distance."""
    rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row, coordinate after coordinate: the same for a pair wherever it stands."""
    total = np.zeros(len(queries))
    for k in range(queries.shape[1]):
        total = total + queries[:, k] * vectors[:, k]
    return total


def default_probes(lists: int) -> int:
    return max(96, -(-lists // 2))


def lists_of_queries(
    points: np.ndarray, index_memory: tuple, k: int, ratio: float, probes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, list, place) of the lists to search, nearest first.

    Lists count with the vectors they are the nearest of, so that several hold
    at least as many different vectors as the sum. The nearest that hold k + 1
    are searched, however many they are; further ones within `ratio` of the
    distance of the last of these, at most `probes` in all.
    """
    centres, graph, counts = index_memory
    wanted = min(k + 1, int(counts.sum()))
    if 4 * probes >= len(centres):  # so wide a walk costs more than a look at all
        far = squared_distances(points, centres)
        found = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, found, 1)
    else:
        found, far = walk_graph(points, centres, graph, probes)
    short = np.flatnonzero(counts[found].sum(axis=1) < wanted)
    rows, lists, places = [], [], []
    for i in range(len(points)):
        mine, away = found[i], far[i]
        if i in short:  # the lists at hand do not suffice: all of them, in order
            away = squared_distances(points[i : i + 1], centres)[0]
            mine = np.argsort(away, kind="stable")
            away = away[mine]
        enough = int(np.searchsorted(np.cumsum(counts[mine]), wanted)) + 1
        within = np.sqrt(away) <= ratio * np.sqrt(away[enough - 1]) + 1e-12
        kept = max(enough, min(probes, int(within.sum())))
        rows.append(np.full(kept, i))
        lists.append(mine[:kept])
        places.append(np.arange(kept))
    return np.concatenate(rows), np.concatenate(lists), np.concatenate(places)


def search(
    index: AnnIndex, queries: DataFrame, k: int = 20, ratio: float = 1.2, probes: int | None = None,
    query_rows: int = 2048, first_probes: int = 8,
) -> DataFrame:
    """(query_key, key, score): for each query vector the best vectors found.

    `queries` has key and vector. Lists whose centroid is within `ratio` times
    the distance of the nearest are searched, at most `probes`; but always as
    many of the nearest as hold k + 1 vectors. `probes` is half of the lists and
    96 at least: a fixed number loses recall as lists grow in number. As many
    vectors are kept as hold k + 1 ids or more.

    The nearest `first_probes` lists are searched first. What they give is a
    bound for the rest, which give out only vectors that reach it: nothing is
    lost, and the vectors given out grow with the queries, not with the lists.
    """
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.centroids, index.near, index.counts))
    probes = probes or default_probes(len(index.centroids))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = shared.value
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                points = np.stack(part["vector"])
                points = np.concatenate([points, np.zeros((len(points), 1))], axis=1)
                _, number, place = lists_of_queries(points, memory, k, ratio, probes)
                each = np.split(number, np.flatnonzero(place == 0)[1:])
                yield part.assign(lists=pd.Series(each, index=part.index))[["lists", "key", "vector"]]

    routed = stored(
        queries.mapInPandas(route, "lists array<int>, key long, vector array<double>"), "ann-routed"
    ).select(F.posexplode("lists").alias("place", "list"), "key", "vector")
    nearby = routed.where(F.col("place") < first_probes).withColumn("bound", F.lit(float("-inf")))
    first = stored(_compared(index, nearby, k, query_rows), "ann-first")
    place = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), "least"))
    bounds = (
        first.distinct().withColumn("place", place).where(F.col("place") == k + 1)
        .select(F.col("query_key").alias("key"), F.col("score").alias("bound"))
    )
    farther = routed.where(F.col("place") >= first_probes).join(bounds, "key", "left").withColumn(
        "bound", F.coalesce("bound", F.lit(float("-inf")))
    )
    found = first.unionByName(_compared(index, farther, k, query_rows))
    return found.distinct().withColumn("place", place).where(F.col("place") <= k + 1).drop("place", "least")


def _compared(index: AnnIndex, routed: DataFrame, k: int, query_rows: int) -> DataFrame:
    """(query_key, key, least, score): per routed query and block of its list, the
    k + 1 best of the vectors that reach the query's bound, ties to the smaller id."""
    # every block of a list meets every part of its queries; neither grows with the list
    parts = routed.groupBy("list").count().select("list", F.ceil(F.col("count") / query_rows).alias("parts"))
    blocks = index.postings.select("list", "blocks").distinct()
    asked = routed.join(parts.join(blocks, "list"), "list").select(
        "list", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key", "vector", "bound",
        F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"),
    )
    lists = index.postings.join(parts, "list").select(
        "list", "block", "key", "least", "vector",
        F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"),
    )
    meet = ["list", "block", "part"]

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_key": [], "key": [], "least": [], "score": []})
        right = right.sort_values("least")
        x = np.stack(right["vector"])
        key, least = right["key"].to_numpy(), right["least"].to_numpy()
        reach = 4 * x.shape[1] * np.finfo(float).eps * np.sqrt((x * x).sum(1).max())
        out = []
        for at in range(0, len(left), 512):
            part = left.iloc[at : at + 512]
            q, asker, bound = np.stack(part["vector"]), part["key"].to_numpy(), part["bound"].to_numpy()
            rough = q @ x.T
            if rough.shape[1] > k + 1:
                bound = np.maximum(bound, -np.partition(-rough, k, axis=1)[:, k])
            slack = reach * np.sqrt((q * q).sum(1))  # rough is rounded otherwise
            near = rough >= (bound - slack)[:, None]
            for some in np.array_split(np.arange(len(part)), min(len(part), 1 + near.sum() // 100_000)):
                row, hit = np.nonzero(near[some])  # with all that tie for the last place
                row = some[row]
                score = products(q[row], x[hit])
                order = np.lexsort((hit, -score, row))
                row, hit, score = row[order], hit[order], score[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) <= k
                out.append(pd.DataFrame({
                    "query_key": asker[row[best]], "key": key[hit[best]],
                    "least": least[hit[best]], "score": score[best],
                }))
        return pd.concat(out)

    kind = index.postings.schema["least"].dataType.simpleString()
    return asked.groupBy(*meet).cogroup(lists.groupBy(*meet)).applyInPandas(
        compare, f"query_key long, key long, least {kind}, score double"
    )


def nearest(
    index: AnnIndex, table: DataFrame, k: int = 20, id_col: str = "vec_id",
    vector_col: str = "embedding", **search_options,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of `table`.

    A row is no neighbour of itself (of its own id). Nearest first, ties to the
    smaller id. Rows without a usable vector have no answer; queries with equal
    vectors are searched once. Rows that are repeated in `table` get one answer.
    `k` must be below the `keep_ids` that the index was built with: it has no more
    ids of vectors that are equal.
    """
    if k >= index.keep_ids:
        raise ValueError(f"the index keeps {index.keep_ids} ids of a vector; build it with keep_ids above {k}")
    usable = usable_vectors(table, id_col, vector_col)
    asked = usable.select(
        F.col("id").alias("query_id"), F.transform("vector", lambda x: x + 0.0).alias("vector")
    ).withColumn("key", F.xxhash64("vector")).distinct()
    asked = stored(asked, "ann-queries")
    if not len(index.centroids):
        return asked.where("false").select(
            "query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")
        )
    found = search(index, asked.select("key", "vector").distinct(), k, **search_options)
    hits = (
        asked.select("query_id", F.col("key").alias("query_key"))
        .join(found, "query_key")
        .join(index.vectors.select("key", F.explode("ids").alias("vec_id")), "key")
        .where(F.col("vec_id") != F.col("query_id"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
