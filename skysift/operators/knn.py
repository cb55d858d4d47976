"""Exact nearest neighbours in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of query vectors sent to all tasks at once.
BLOCK_BYTES = 32_000_000


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, id, distance, rank): the k vectors nearest to each query by cosine distance.

    ``vectors`` and ``queries`` are (id long, vec array). Queries are cut into blocks of
    bounded size; each block runs against all vectors with matrix products in place, a task
    keeps its k best candidates of each query and sends them at its end, and the final ranking
    shuffles those only. A query is not its own
    neighbour. Ties go to the smaller id. Vectors of another size than the query's, empty or
    null ones and zero vectors have no neighbours.
    """
    spark = vectors.sparkSession
    sized = queries.where("id is not null and size(vec) > 0")
    stats = sized.agg(F.count("*"), F.max(F.size("vec"))).first()
    count, width = stats[0], stats[1] or 1
    blocks = max(1, -(-count * width * 8 // BLOCK_BYTES))
    schema = "query_id long, id long, distance double"
    result = None
    for b in range(blocks):
        rows = sized.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(r["vec"]) for r in rows}:
            mine = [r for r in rows if len(r["vec"]) == size]
            m = np.array([r["vec"] for r in mine], float)
            norm = np.linalg.norm(m, axis=1)
            by_size[size] = np.array([r["id"] for r in mine])[norm > 0], (m[norm > 0] / norm[norm > 0, None])
        sent = spark.sparkContext.broadcast(by_size)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            best = {size: (np.full((len(qid), k), np.inf), np.full((len(qid), k), np.iinfo(np.int64).max)) for size, (qid, _) in sent.value.items()}
            for batch in batches:
                ids, vec = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
                sizes = np.diff(np.asarray(vec.offsets))
                flat = vec.flatten().to_numpy(zero_copy_only=False).astype(float)
                starts = np.asarray(vec.offsets)[:-1] - np.asarray(vec.offsets)[0]
                for size, (qid, q) in sent.value.items():
                    pick = np.flatnonzero(sizes == size)
                    if not len(pick) or not len(qid):
                        continue
                    m = flat[starts[pick][:, None] + np.arange(size)]
                    norm = np.linalg.norm(m, axis=1)
                    pick, m = pick[norm > 0], m[norm > 0] / norm[norm > 0, None]
                    mine = ids[pick]
                    dist = 1 - np.clip(q @ m.T, -1, 1)
                    dist[qid[:, None] == mine[None, :]] = np.inf
                    dist = np.concatenate([best[size][0], dist], axis=1)
                    number = np.concatenate([best[size][1], np.broadcast_to(mine, (len(qid), len(mine)))], axis=1)
                    order = np.lexsort((number, dist), axis=1)[:, :k]
                    best[size] = np.take_along_axis(dist, order, 1), np.take_along_axis(number, order, 1)
            for size, (qid, _) in sent.value.items():
                d, number = best[size]
                ok = np.isfinite(d).ravel()
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, k)[ok]), pa.array(number.ravel()[ok]), pa.array(d.ravel()[ok])], ["query_id", "id", "distance"])

        part = vectors.select(F.col("id").cast("long"), F.col("vec").cast("array<double>")).where("id is not null and size(vec) > 0").mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k)
