"""Centroid clustering (11) with Yinyang bounds, exact in whole numbers.

Components are turned into integers, so distances, sums and floors are exact and the result doesn't depend on how rows
are dealt. A round is one pass over a table of vectors, each with its cluster, an upper bound of the distance to its
centroid and one lower bound a group of centroids; it writes the table of the next round to the scratch folder, beside it
a row of sums for each cluster and task, and the driver gets sums of k centroids. Centroids are put into groups once, by
a clustering of the seeds. Bounds follow the distances that centroids have moved. A vector whose upper bound lies under
all its lower bounds stays where it is; else its distance is computed and it is compared again; then only groups whose
bound it reaches are looked at, and of those only centroids whose own bound, the group's of the round before less what
that centroid has moved, still reaches it are scanned. Bounds are kept a little too wide, so rounding can't hide a tie.

Defined results: vectors with another number of components, or with a null or non-finite one, are left out, as is what
has no embedding. Repeated rows are vectors of their own. Seeds with equal hashes are taken in the order of their
components; a vector without an id is no seed as long as there are others. With fewer vectors than clusters there are as
many clusters as vectors; without any the result is empty. A component beyond MOST in size is an error, since squared
distances wouldn't fit a long. Other columns, whatever their names, stay behind.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import parts_of, scratch_dir, to_arrow, to_batch

CLUSTERS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
#: The largest component, scaled.
MOST = 1 << 27
#: What bounds are widened by, relative: far more than the rounding of a root or a sum.
SLACK = 1e-12

ROUND = "vec_id long, x array<bigint>, cluster int, upper double, lower array<double>, n long, sums array<bigint>, scanned long"
PLACED = "vec_id long, cluster int, distance long, n long, total long"


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the integers of the components, of vectors that are whole."""
    value = F.col("embedding")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    too_large = F.raise_error(F.lit(f"a component is over {MOST} in size")).cast("long")
    scaled = F.transform(value, lambda v: F.when(F.abs(v * F.lit(float(scale))) <= MOST, F.floor(v.cast("double") * scale)).otherwise(too_large))
    rows = vectors.where((F.size(value) == dimensions) & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x"))


def seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first k vectors in the order of a hash of their ids."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.select(mark.alias("mark"), "x").orderBy(F.asc_nulls_last("mark"), "x").limit(k).collect()
    return np.array([r["x"] for r in found], np.int64)


def grouped(centroids: np.ndarray, groups: int, rounds: int = 5) -> np.ndarray:
    """The group of each centroid: farthest ones first, then a few rounds of means."""
    points = centroids.astype(float)
    at = [0]
    for _ in range(min(groups, len(points)) - 1):
        at.append(int(np.min([((points - points[i]) ** 2).sum(1) for i in at], 0).argmax()))
    means = points[at]
    for _ in range(rounds):
        own = np.argmin([((points - m) ** 2).sum(1) for m in means], 0)
        means = np.array([points[own == g].mean(0) if (own == g).any() else means[g] for g in range(len(means))])
    return own


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = x - centroid
    return np.einsum("ij,ij->i", apart, apart)


def above(d: np.ndarray) -> np.ndarray:
    return d * (1 + SLACK) + SLACK


def below(d: np.ndarray) -> np.ndarray:
    return d * (1 - SLACK) - SLACK


class Step:
    """Moves vectors to their nearest of `centroids`; `moved` are upper bounds of how far these have come since the last
    step, `group` is the group of each."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray, group: np.ndarray) -> None:
        self.centroids, self.moved, self.group = centroids, moved, group
        self.groups = [np.flatnonzero(group == g) for g in range(group.max() + 1)]
        self.furthest = np.array([moved[g].max() if len(g) else 0.0 for g in self.groups])
        self.scanned = 0  # distances computed

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds that tell nothing."""
        return np.zeros(n, np.int32), np.full(n, np.inf), np.zeros((n, len(self.groups)))

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)
        for j in np.unique(cluster):
            own = cluster == j
            out[own] = squared(x[own], self.centroids[j])
        self.scanned += len(x)
        return out

    def __call__(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cluster, upper = cluster.copy(), above(upper + self.moved[cluster])
        now = below(lower - self.furthest)
        least = now.min(1)
        rows = np.flatnonzero(upper >= least)  # all groups may be out of reach
        exact = self.distances(x[rows], cluster[rows])
        upper[rows] = above(np.sqrt(exact))
        close = upper[rows] >= least[rows]
        rows, best = rows[close], exact[close]
        if len(rows):
            cluster[rows], upper[rows], now[rows] = self._scan(x[rows], cluster[rows], best, lower[rows], now[rows])
        return cluster, upper, now

    def _scan(self, x, cluster, best, before, now):
        """Of vectors that no bound has settled: the nearest centroid, the bound to it, and new lower bounds."""
        own, reach = cluster.copy(), above(np.sqrt(best))
        # before and now are of the assigned centroid's group without it, so its own bound is its distance
        bound = below(before[:, self.group] - self.moved)
        at = np.arange(len(x))
        bound[at, own] = below(np.sqrt(best))
        for g, members in enumerate(self.groups):
            near = now[:, g] <= reach
            for j in members:
                rows = np.flatnonzero(near & (bound[:, j] <= reach) & (own != j))
                d = squared(x[rows], self.centroids[j])
                self.scanned += len(rows)
                bound[rows, j] = below(np.sqrt(d))
                nearer = (d < best[rows]) | ((d == best[rows]) & (j < cluster[rows]))
                rows, d = rows[nearer], d[nearer]
                best[rows], cluster[rows], reach[rows] = d, j, above(np.sqrt(d))
        bound[at, cluster] = np.inf
        lower = np.stack([bound[:, g].min(1) if len(g) else np.full(len(x), np.inf) for g in self.groups], 1)
        return cluster, reach, lower


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        if pa.types.is_list(column.type):
            out[name] = column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        else:
            out[name] = column.to_numpy(zero_copy_only=False) if name != "vec_id" else column
    return out


def _rows(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _bounds(step: Step, one: dict) -> tuple:
    return (one["cluster"], one["upper"], one["lower"]) if "upper" in one else step.first(len(one["x"]))


def moved_vectors(rows: DataFrame, step: Step) -> DataFrame:
    """A round: the vectors with their clusters and bounds, and rows of sums (n isn't null) a cluster and task."""
    arrow = to_arrow(rows.sparkSession, ROUND)
    names = arrow.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step.scanned = 0
        k = len(step.centroids)
        sums, n = np.zeros(step.centroids.shape, np.int64), np.zeros(k, np.int64)
        for batch in parts_of(batches):
            if not batch.num_rows:
                continue
            one = _arrays(batch)
            x = one["x"]
            cluster, upper, lower = step(x, *_bounds(step, one))
            np.add.at(sums, cluster, x)
            n += np.bincount(cluster, minlength=k)
            found = {"vec_id": one["vec_id"], "x": _rows(x), "cluster": cluster, "upper": upper, "lower": _rows(lower)}
            yield to_batch(found | dict.fromkeys(names[5:], [None] * len(x)), arrow)
        used = np.flatnonzero(n)
        found = {"cluster": used.astype(np.int32), "n": n[used], "sums": list(sums[used]), "scanned": [step.scanned] + [0] * (len(used) - 1)} if len(used) else None
        if found:
            yield to_batch(dict.fromkeys(names, [None] * len(used)) | found, arrow)

    return rows.mapInArrow(run, ROUND)


def placed_vectors(rows: DataFrame, step: Step) -> DataFrame:
    """The last round: clusters and exact distances, and rows of totals (n isn't null) a cluster and task."""
    arrow = to_arrow(rows.sparkSession, PLACED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(step.centroids)
        n, total = np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in parts_of(batches):
            if not batch.num_rows:
                continue
            one = _arrays(batch)
            cluster, _, _ = step(one["x"], *_bounds(step, one))
            d = step.distances(one["x"], cluster)
            n += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, d)
            nothing = [None] * len(d)
            yield to_batch({"vec_id": one["vec_id"], "cluster": cluster, "distance": d, "n": nothing, "total": nothing}, arrow)
        used = np.flatnonzero(n)
        if len(used):
            nothing = [None] * len(used)
            yield to_batch({"vec_id": nothing, "cluster": used.astype(np.int32), "distance": nothing, "n": n[used], "total": total[used]}, arrow)

    return rows.mapInArrow(run, PLACED)


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE, groups: int | None = None) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of each vector that is whole.
    groups: of centroids, by default about the root of k."""
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    rows = kept(vectors, dimensions, scale)
    centroids = seeds(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    base = f"{scratch_dir(spark)}/clusters-{uuid.uuid4().hex}"
    fs_path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = fs_path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    group = grouped(centroids, groups or max(1, round(len(centroids) ** 0.5)))
    moved = np.zeros(len(centroids))
    for r in range(rounds):
        moved_vectors(rows, Step(centroids, moved, group)).write.parquet(f"{base}/{r}")
        if r:
            fs.delete(fs_path(f"{base}/{r - 1}"), True)
        table = spark.read.schema(ROUND).parquet(f"{base}/{r}")
        rows = table.where(F.col("n").isNull()).select("vec_id", "x", "cluster", "upper", "lower")
        new = _means(table.where(F.col("n").isNotNull()), centroids)
        moved = above(np.sqrt(((new - centroids) ** 2).sum(1)))
        if (new == centroids).all():
            break  # all further rounds would be the same
        centroids = new
    placed_vectors(rows, Step(centroids, moved, group)).write.parquet(f"{base}/placed")
    if rounds:
        fs.delete(fs_path(f"{base}/{r}"), True)
    table = spark.read.schema(PLACED).parquet(f"{base}/placed")
    inertia = {x["cluster"]: x["total"] for x in table.where(F.col("n").isNotNull()).groupBy("cluster").agg(F.sum("total").alias("total")).collect()}  # k rows
    named = [(j, t, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, t in sorted(inertia.items())]
    about = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return table.where(F.col("n").isNull()).select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select(*(c.split()[0] for c in schema.split(", ")))


def _means(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of the clusters; k rows for each dimension come to the driver. Empty clusters stay."""
    out = centroids.copy()
    parts = sums.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    for r in parts.groupBy("cluster", "at").agg(F.sum("part").alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["at"]] = r["total"] // r["n"]
    return out


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the clusters of all embeddings."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> str:
    """Plain rounds in SQL, each written out."""
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings
            WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions})""",
        "p AS MATERIALIZED (SELECT rn, unnest(x) AS value, generate_subscripts(x, 1) AS i FROM v)",
        f"s AS (SELECT rn, (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, x) - 1)::INTEGER AS j FROM v QUALIFY j < {k})",
        "c0 AS MATERIALIZED (SELECT j, i, value AS mid FROM s JOIN p USING (rn))",
    ]
    for r in range(rounds + 1):
        steps.append(f"d{r} AS (SELECT rn, j, sum((value - mid) * (value - mid))::BIGINT AS d FROM p JOIN c{r} USING (i) GROUP BY rn, j)")
        steps.append(f"a{r} AS MATERIALIZED (SELECT rn, j, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rn ORDER BY d, j) = 1)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT j, i, ((sum(value)::HUGEINT - ((sum(value)::HUGEINT % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mid FROM a{r} JOIN p USING (rn) GROUP BY j, i)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT j, i, coalesce(m{r}.mid, c{r}.mid) AS mid FROM c{r} LEFT JOIN m{r} USING (j, i))")
    steps.append(f"h AS (SELECT j, sha256(string_agg(mid::VARCHAR, ',' ORDER BY i)) AS hex FROM c{rounds} GROUP BY j)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, j AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, hex AS centroid_sha256
FROM a{rounds} JOIN v USING (rn) JOIN h USING (j)"""


SQL = _sql()
