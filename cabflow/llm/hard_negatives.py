"""Hard-negative mining: clusters of anchors share one candidate list, walked until certified.

Anchors are clustered by direction. For a cluster whose members lie within an angle ``t``
of its centre, no member ``u`` can score a row ``i`` above ``|u| |i| cos(max(0, a - t))``,
where ``a`` is the row's angle to the centre. The rows are sorted by that bound once a
cluster; every member walks the list from the top and stops as soon as the bound of the
next row cannot reach what it still needs: first its best rows of the same label (the
positives), then, for each positive's score, the best rows of other labels inside the
band of scores.

Anchors and rows grow with the data, so both are dealt to cells of bounded memory: rows
into blocks by position, anchors (packed by cluster) into groups, and each group meets
each block once. What a cell certifies for its block is merged for each anchor.

Exact: components are integers, products are summed in doubles only where every sum
stays below 2**53, in Python's integers otherwise (scores then stop at the limits of a
long). Clustering only decides how early a walk ends, never the result.

Defined results: rows with a null label or vector, or with a null or non-finite component,
take no part; scores exist between vectors of the same length only; a row is "other" if
its vec_id is not the anchor's, and rows without a vec_id are no anchors and stand last
in ties; repeated rows count each, and a repeated anchor gives its rows each time; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm.common import load, written

SCALE = 256.0
ANCHOR_EVERY = 50
SHIFT_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
BAND = (50, 95)  # per cent of the positive's score

# Centres are fitted on this many anchors at most, in order of a hash.
FIT_ANCHORS = 2_048
FIT_ROUNDS = 10
PACK = 256
# Bounds of a cell: bytes of its block of rows and of its anchors.
ROW_BYTES = 64 << 20
ANCHOR_BYTES = 16 << 20
LEAST_ROWS = 1_024
STEP = 1_024

_NONE = np.iinfo(np.int64).min
_PACKED = "pack long, dim int, cluster int, rows array<long>, ids array<long>, labels array<long>, parts binary"


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and integer components of the rows that take part."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = embeddings.filter(label.isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fine))
    shifted = F.when(vec_id % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    parts = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    return rows.select(vec_id.alias("vec_id"), shifted.alias("label"), parts.alias("parts"))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` with the rows of ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = int(max(a.max(), -int(a.min()))) * int(max(b.max(), -int(b.min()))) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, _NONE + 1, np.iinfo(np.int64).max).astype(np.int64)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero stays zero) and lengths."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def centres(vectors: np.ndarray) -> np.ndarray:
    """Centres of directions by Lloyd's rounds, about the square root of the vectors' number."""
    unit, _ = directions(vectors)
    centre = unit[: max(1, int(len(unit) ** 0.5))]
    for _ in range(FIT_ROUNDS):
        best = (unit @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, best, unit)
        centre = np.where((np.bincount(best, minlength=len(centre)) > 0)[:, None], directions(sums)[0], centre)
    return centre


def packed_anchors(anchors: DataFrame) -> DataFrame:
    """Anchors in packs of one length and cluster, ``PACK`` at most; ``row`` tells repeated anchors apart."""
    sample = anchors.orderBy(F.xxhash64("vec_id", "parts"), "vec_id").limit(FIT_ANCHORS).select("parts").collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["parts"]), []).append(r["parts"])
    fitted = {dim: centres(np.array(v, dtype=np.int64)) for dim, v in by_dim.items() if dim}

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], list] = {}

        def row_of(key: tuple[int, int], members: list) -> tuple:
            rows, ids, labels, parts = zip(*members)
            return (rows[0], *key, rows, ids, labels, np.concatenate(parts).tobytes())

        for batch in batches:
            out = []
            for row, vec_id, label, parts in zip(batch["row"], batch["vec_id"], batch["label"], batch["parts"]):
                parts = np.asarray(parts, dtype=np.int64)
                near = fitted.get(len(parts))
                key = (len(parts), int((near @ parts).argmax()) if near is not None else 0)
                members = held.setdefault(key, [])
                members.append((row, vec_id, label, parts))
                if len(members) == PACK:
                    out.append(row_of(key, held.pop(key)))
            if out:
                yield pd.DataFrame(out, columns=columns)
        if held:
            yield pd.DataFrame([row_of(k, m) for k, m in held.items()], columns=columns)

    columns = [c.split()[0] for c in _PACKED.split(", ")]
    rows = anchors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "parts")
    return rows.mapInPandas(pack, _PACKED)


class Cluster:
    """Members of one cluster, a block's rows in order of their upper bound, and the walk."""

    def __init__(self, packs: pd.DataFrame, dim: int, block: "Block"):
        self.rows = np.concatenate([np.asarray(x, dtype=np.int64) for x in packs["rows"]])
        self.packs = np.repeat(packs["pack"].to_numpy(), [len(x) for x in packs["rows"]])
        self.ids = np.concatenate([np.asarray(x, dtype=np.int64) for x in packs["ids"]])
        self.labels = np.concatenate([np.asarray(x, dtype=np.int64) for x in packs["labels"]])
        self.parts = np.frombuffer(b"".join(packs["parts"]), dtype=np.int64).reshape(len(self.rows), dim)
        self.block = block
        unit, self.norm = directions(self.parts)
        centre = directions(unit.sum(axis=0)[None])[0][0]
        if not centre.any() and self.norm.any():
            centre = unit[self.norm.argmax()]
        angle = np.arccos(np.clip(unit @ centre, -1, 1))
        spread = angle[self.norm > 0].max(initial=0)
        to_row = np.arccos(np.clip(block.unit @ centre, -1, 1))
        bound = block.norm * np.cos(np.maximum(0, to_row - spread - 1e-6))
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        self.slack = 1e-9 * block.norm.max(initial=0)

    def walk(self, members: np.ndarray, needed) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(members still walking, rows, scores) down the list; ``needed()`` is each member's least useful score."""
        for at in range(0, len(self.order), STEP):
            most = (self.bound[at] + self.slack) * self.norm[members] + 1e-6
            going = np.flatnonzero(needed() <= most)
            if not len(going):
                return  # certified for all members
            rows = self.order[at : at + STEP]
            yield going, rows, inner(self.parts[members[going]], self.block.parts[rows])


class Block:
    """Rows of one length; a missing id is the largest long, so that it stands last."""

    def __init__(self, rows: pd.DataFrame, dim: int):
        self.ids = np.array([np.iinfo(np.int64).max if pd.isna(x) else int(x) for x in rows["vec_id"]], dtype=np.int64)
        self.missing = rows["vec_id"].isna().to_numpy()
        self.labels = rows["label"].to_numpy(dtype=np.int64)
        self.parts = np.concatenate([np.asarray(x, dtype=np.int64) for x in rows["parts"]]).reshape(len(rows), dim)
        self.unit, self.norm = directions(self.parts)


def best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` first by score, ties by id."""
    if len(scores) > 8 * k:  # all that reach the k-th score
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, rows = scores[keep], rows[keep]
    order = np.lexsort((ids[rows], -scores))[:k]
    return scores[order], rows[order]


def best_of(cluster: Cluster, members, owner, least, most, same_label: bool, k: int) -> list[tuple]:
    """For each entry the ``k`` best rows with least <= score <= most; ``owner`` is its member's place."""
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in owner]
    need = least.copy()

    def needed() -> np.ndarray:
        out = np.full(len(members), np.inf)
        np.minimum.at(out, owner, need.astype(np.float64))
        return out

    block = cluster.block
    for going, rows, scores in cluster.walk(members, needed):
        place = np.full(len(members), -1)
        place[going] = np.arange(len(going))
        at = np.flatnonzero(place[owner] >= 0)
        mine = place[owner[at]]
        who = members[going]
        equal = cluster.labels[who][:, None] == block.labels[rows][None]
        other = (cluster.ids[who][:, None] != block.ids[rows][None]) | block.missing[rows][None]
        able = (equal if same_label else ~equal) & other
        hit = able[mine] & (scores[mine] >= need[at][:, None]) & (scores[mine] <= most[at][:, None])
        for i in np.flatnonzero(hit.any(axis=1)):
            e, cols = at[i], np.flatnonzero(hit[i])
            old_scores, old_rows = found[e]
            found[e] = best(
                np.append(old_scores, scores[mine[i]][cols]), np.append(old_rows, rows[cols]), block.ids, k
            )
            if len(found[e][0]) == k:
                need[e] = max(need[e], found[e][0][-1])
    return found


def _blocks(rows: pd.DataFrame, packs: pd.DataFrame) -> Iterator[tuple[Cluster, np.ndarray]]:
    """The clusters of a cell with its rows of the same length, members in chunks of ``PACK``."""
    if not len(rows) or not len(packs):
        return
    dims = rows["parts"].map(len)
    for dim, mine in packs.groupby("dim"):
        if not (dims == dim).any():
            continue
        block = Block(rows[dims == dim], dim)
        for _, group in mine.groupby("cluster"):
            cluster = Cluster(group, dim, block)
            for at in range(0, len(cluster.rows), PACK):
                yield cluster, np.arange(at, min(at + PACK, len(cluster.rows)))


def _ids(block: Block, rows: np.ndarray) -> list:
    return [None if block.missing[r] else int(block.ids[r]) for r in rows]


_POSITIVE = "pack long, row long, anchor_id long, positive_id long, positive_score long"
_NEGATIVE = "row long, positive_score long, negative_id long, negative_score long"


def _frame(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _positives(rows: pa.Table, packs: pa.Table) -> pa.Table:
    out = []
    for cluster, members in _blocks(rows.to_pandas(), packs.to_pandas()):
        none, top = np.full(len(members), _NONE), np.full(len(members), np.iinfo(np.int64).max)
        found = best_of(cluster, members, np.arange(len(members)), none, top, True, POSITIVES)
        for m, (scores, at) in zip(members, found):
            head = (int(cluster.packs[m]), int(cluster.rows[m]), int(cluster.ids[m]))
            out += [(*head, i, int(s)) for i, s in zip(_ids(cluster.block, at), scores)]
    return _frame(out, _POSITIVE)


def _negatives(rows: pa.Table, packs: pa.Table) -> pa.Table:
    out = []
    packs = packs.to_pandas()
    wanted: dict[int, list[int]] = {}
    for bands in packs["bands"]:
        for b in bands:
            wanted.setdefault(b["row"], []).append(b["positive_score"])
    for cluster, members in _blocks(rows.to_pandas(), packs):
        bands = [(i, s) for i, m in enumerate(members) for s in sorted(set(wanted.get(cluster.rows[m], []))) if s >= 0]
        if not bands:
            continue
        owner = np.array([i for i, _ in bands])
        least = np.array([-(-s * BAND[0] // 100) for _, s in bands], dtype=np.int64)
        most = np.array([s * BAND[1] // 100 for _, s in bands], dtype=np.int64)
        found = best_of(cluster, members, owner, least, most, False, NEGATIVES)
        for (i, s), (scores, at) in zip(bands, found):
            row = int(cluster.rows[members[i]])
            out += [(row, s, n, int(x)) for n, x in zip(_ids(cluster.block, at), scores)]
    return _frame(out, _NEGATIVE)


def _first(df: DataFrame, keys: list[str], score: str, name: str, k: int) -> DataFrame:
    """The ``k`` first rows of each key by score, ties by id, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(name))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(embeddings: DataFrame, row_bytes: int = ROW_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Hard negatives of every anchor and positive, best first.

    ``row_bytes`` and ``anchor_bytes`` bound what one cell holds; the result does not depend on them.
    """
    spark = embeddings.sparkSession
    rows = prepared(embeddings)
    packs = written(packed_anchors(rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)))
    size = embeddings.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    anchors = packs.agg(F.sum(F.size("rows")).alias("n")).first()["n"] or 0
    width = 8 * max(1, size["dim"] or 1)
    per_block, per_group = max(1, row_bytes // width), max(PACK, anchor_bytes // width)
    groups = max(1, -(-anchors // per_group))
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["n"] // LEAST_ROWS))
    blocks = max(1, tasks, -(-size["n"] // per_block))

    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = F.pmod(F.monotonically_increasing_id(), F.lit(blocks))
    left = rows.withColumn("block", place).withColumn("group", each(groups))
    left = left.select((F.col("block") * groups + F.col("group")).alias("cell"), "vec_id", "label", "parts")

    def cells(df: DataFrame) -> DataFrame:
        """Each pack in every block of rows."""
        group = F.pmod(F.xxhash64("pack"), F.lit(groups))
        return df.withColumn("group", group).withColumn("block", each(blocks)).select(
            (F.col("block") * groups + F.col("group")).alias("cell"), *df.columns
        )

    found = left.groupBy("cell").cogroup(cells(packs).groupBy("cell")).applyInArrow(_positives, _POSITIVE)
    positives = written(_first(found, ["row"], "positive_score", "positive_id", POSITIVES).drop("rank"))
    bands = positives.groupBy("pack").agg(F.collect_list(F.struct("row", "positive_score")).alias("bands"))
    banded = cells(packs.join(bands, "pack"))
    found = left.groupBy("cell").cogroup(banded.groupBy("cell")).applyInArrow(_negatives, _NEGATIVE)
    negatives = _first(found, ["row", "positive_score"], "negative_score", "negative_id", NEGATIVES)
    return positives.drop("pack").join(negatives, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors of ``embeddings``."""
    return mine(load(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_dot_product(a.parts, b.parts)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""
