"""Vector code compression: a codebook for each part of the vectors, fitted over metric trees of the parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.llm.common import cut_lineage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Scaled components are held within this, so that squared distances of a part fit in 64 bits.
MOST = 1 << 26
#: Vectors of one set of trees; a task holds one set at a time.
BLOCK = 4096
#: A ball of so many points at most is not split.
LEAF = 48


class Balls:
    """A metric tree of integer points, built middle-out from anchors.

    Every ball holds ``order[start:stop]`` and caches the sum of its points,
    their centre and an upper bound of their distance from it. The root is the
    last ball; ``left`` is -1 in a ball that is not split.
    """

    _TYPES = {
        "order": np.int32, "start": np.int32, "stop": np.int32, "left": np.int32, "right": np.int32,
        "centre": np.float64, "radius": np.float64, "sums": np.int64,
    }

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def grow(cls, points: np.ndarray, leaf: int = LEAF) -> Balls:
        at = points.astype(np.float64)
        left: list[int] = []
        right: list[int] = []
        held: list[np.ndarray | None] = []

        def ball(a: int, b: int, members: np.ndarray | None) -> int:
            left.append(a)
            right.append(b)
            held.append(members)
            return len(left) - 1

        def split(members: np.ndarray) -> int:
            owned = anchors(at[members]) if len(members) > leaf else [np.arange(len(members))]
            if len(owned) == 1:
                return ball(-1, -1, members)
            kids = [split(members[x]) for x in owned]
            centres = np.array([at[members[x]].mean(0) for x in owned])
            reach = np.array([np.sqrt(((at[members[x]] - c) ** 2).sum(1).max()) for x, c in zip(owned, centres)])
            return joined(kids, centres, reach, np.array([len(x) for x in owned], np.float64))

        def joined(kids: list[int], centres: np.ndarray, reach: np.ndarray, sizes: np.ndarray) -> int:
            """The two balls that the least ball can hold become one, until one is left."""
            alive = np.ones(len(kids), bool)

            def cost(i: int) -> np.ndarray:
                apart = np.sqrt(((centres - centres[i]) ** 2).sum(1))
                both = np.maximum((apart + reach + reach[i]) / 2, np.maximum(reach, reach[i]))
                both[~alive] = np.inf
                both[i] = np.inf
                return both

            costs = np.array([cost(i) for i in range(len(kids))])
            for _ in range(len(kids) - 1):
                i, j = divmod(int(costs.argmin()), len(kids))
                merged = (centres[i] * sizes[i] + centres[j] * sizes[j]) / (sizes[i] + sizes[j])
                reach[i] = max(np.sqrt(((merged - centres[x]) ** 2).sum()) + reach[x] for x in (i, j))
                centres[i], sizes[i] = merged, sizes[i] + sizes[j]
                kids[i] = ball(kids[i], kids[j], None)
                alive[j] = False
                costs[j, :] = costs[:, j] = np.inf
                costs[i] = costs[:, i] = cost(i)
            return kids[i]

        root = split(np.arange(len(points)))
        n = len(left)
        start, stop = np.zeros(n, np.int32), np.zeros(n, np.int32)
        order: list[np.ndarray] = []
        placed = 0
        todo = [root]
        while todo:  # leaves from left to right
            i = todo.pop()
            if left[i] < 0:
                start[i], stop[i] = placed, placed + len(held[i])
                placed = int(stop[i])
                order.append(held[i])
            else:
                todo += [right[i], left[i]]
        for i in range(n):  # a ball is made after the two in it
            if left[i] >= 0:
                start[i], stop[i] = start[left[i]], stop[right[i]]
        where = np.concatenate(order)
        total = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points[where], axis=0, out=total[1:])
        sums = total[stop] - total[start]
        centre = sums / np.maximum(stop - start, 1)[:, None]
        sorted_points = at[where]
        radius = np.array([np.sqrt(((sorted_points[a:b] - c) ** 2).sum(1).max(initial=0)) for a, b, c in zip(start, stop, centre)])
        return cls({
            "order": where.astype(np.int32), "start": start, "stop": stop, "left": np.array(left, np.int32),
            "right": np.array(right, np.int32), "centre": centre, "radius": radius, "sums": sums,
        })

    def packed(self) -> dict[str, bytes]:
        return {k: getattr(self, k).astype(t).tobytes() for k, t in self._TYPES.items()}

    @classmethod
    def unpacked(cls, row: dict[str, bytes], width: int) -> Balls:
        arrays = {k: np.frombuffer(row[k], t) for k, t in cls._TYPES.items()}
        for wide in ("centre", "sums"):
            arrays[wide] = arrays[wide].reshape(len(arrays["start"]), width)
        return cls(arrays)

    def nearest(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Nearest entry of each point (ties: the least), each entry's sum and count, and how many balls were owned whole.

        A ball hands the entries that may be nearest to a point of it down to its
        two; when one is left, the ball's cached sum and count are that entry's.
        """
        out = np.zeros(len(points), np.int32)
        sums = np.zeros(entries.shape, np.int64)
        counts = np.zeros(len(entries), np.int64)
        places = entries.astype(np.float64)
        whole = 0
        _, first = np.unique(entries, axis=0, return_index=True)  # of equal entries the least wins
        todo = [(len(self.start) - 1, np.sort(first))]
        while todo:
            i, asked = todo.pop()
            a, b = int(self.start[i]), int(self.stop[i])
            if len(asked) > 1:
                asked = may_own(self.centre[i], self.radius[i], places, asked)
            if len(asked) == 1:
                whole += 1
                out[self.order[a:b]] = asked[0]
                sums[asked[0]] += self.sums[i]
                counts[asked[0]] += b - a
            elif self.left[i] >= 0:
                todo += [(self.left[i], asked), (self.right[i], asked)]
            else:
                mine = self.order[a:b]
                best = asked[squares(points[mine], entries[asked]).argmin(1)]
                out[mine] = best
                np.add.at(sums, best, points[mine])
                np.add.at(counts, best, 1)
        return out, sums, counts, whole


def anchors(points: np.ndarray) -> list[np.ndarray]:
    """About the square root of the number of points of anchors, and which points each owns.

    The next anchor is the point farthest from its own; it takes points that are
    nearer to it, and asks only those farther from their anchor than half the
    distance between the two anchors.
    """
    chosen = [0]
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    owner = np.zeros(len(points), np.int64)
    while len(chosen) ** 2 < len(points):
        new = int(far.argmax())
        if far[new] == 0:
            break
        gap = np.sqrt(((points[chosen] - points[new]) ** 2).sum(1))
        ask = np.flatnonzero(2 * far >= gap[owner])
        away = np.sqrt(((points[ask] - points[new]) ** 2).sum(1))
        taken = away < far[ask]
        owner[ask[taken]], far[ask[taken]] = len(chosen), away[taken]
        chosen.append(new)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(chosen)))
    return [x for x in np.split(order, cuts) if len(x)]


def may_own(centre: np.ndarray, radius: float, places: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The asked entries that the plane between them and the entry nearest the centre does not part from the ball."""
    mine = places[asked]
    away = ((mine - centre) ** 2).sum(1)
    best = int(away.argmin())
    apart = np.sqrt(((mine - mine[best]) ** 2).sum(1))
    slack = 1e-9 * (away + away[best] + radius * apart) + 1e-6
    return asked[away - away[best] <= 2 * radius * apart + slack]


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of integer points from integer entries, exact."""
    most = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if most <= 1 << 21 and points.shape[1] <= 1 << 8 else np.int64  # sums stay under 2 ** 53
    p, e = points.astype(kind), entries.astype(kind)
    return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None, :]).astype(np.int64)


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> tuple[DataFrame, np.ndarray]:
    """Codes of each vector (vec_id, label, code, error) and the codebooks (parts, entries, width).

    Input columns vec_id, embedding, label; others are ignored. A component x
    counts as floor(1024 * x), held within 2 ** 26 either way. Vectors that are null
    or hold a null or a non-finite component are dropped. Vectors shorter than the
    longest one, or than a multiple of ``parts``, count as filled up with zeros. Each part's codebook starts as
    that part of the vectors with the least vec_ids (ties by components, a null vec_id last; with fewer vectors
    the codebook is shorter) and takes ``rounds`` rounds of means, rounded down, unused entries unchanged.
    ``code`` has two hex digits a part, so ``entries`` is 256 at most; ``error``
    is the squared distance summed over parts. Repeated rows are rows of
    their own; a null label is a label. An empty table gives no rows and codebooks without entries.

    Trees of each block of vectors are built once and written to the checkpoint
    folder; a round sends the codebooks to them and gets back sums and counts,
    one set for each task. Only these, ``parts`` x ``entries`` rows, come to the driver.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    spark = vectors.sparkSession
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(usable).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    width = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-width // parts)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    start = scaled(pa.array([r.embedding for r in first], pa.list_(pa.float64())), parts * width)
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    label = vectors.schema["label"].dataType
    coded = T.StructType([
        T.StructField("vec_id", vectors.schema["vec_id"].dataType), T.StructField("label", label),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])
    if not first:
        return spark.createDataFrame([], coded), books

    trees = cut_lineage(_trees(kept, parts, width, block))
    for _ in range(rounds):
        found = trees.select("points", "trees").mapInArrow(_totals(books), "part int, entry int, place int, value long")
        moved = found.groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).collect()
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for r in moved:
            if r.place < 0:
                counts[r.part, r.entry] = r.value
            else:
                sums[r.part, r.entry, r.place] = r.value
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
    return trees.mapInArrow(_codes(books, coded), coded), books


def scaled(vectors: pa.ListArray, width: int) -> np.ndarray:
    """floor(1024 * x) of each component, one row a vector, filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy().astype(np.int64)
    values = vectors.flatten().to_numpy()
    out = np.zeros((len(vectors), width), np.int64)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(vectors)), lengths), place] = np.floor(np.clip(values * SCALE, -MOST, MOST))
    return out


def _trees(kept: DataFrame, parts: int, width: int, block: int) -> DataFrame:
    """One row for each block of vectors: vec_ids, labels, points (32-bit integers) and a tree for each part."""
    ids, labels = kept.schema["vec_id"].dataType, kept.schema["label"].dataType
    schema = T.StructType([
        T.StructField("vec_ids", T.ArrayType(ids)), T.StructField("labels", T.ArrayType(labels)),
        T.StructField("points", T.BinaryType()),
        T.StructField("trees", T.ArrayType(T.StructType([T.StructField(k, T.BinaryType()) for k in Balls._TYPES]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = block - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(min(room, batch.num_rows))
                if sum(b.num_rows for b in held) == block:
                    yield made(pa.Table.from_batches(held))
                    held = []
        if held:
            yield made(pa.Table.from_batches(held))

    def made(rows: pa.Table) -> pa.RecordBatch:
        points = scaled(rows["embedding"].combine_chunks(), parts * width)
        grown = [Balls.grow(points[:, p * width : (p + 1) * width]).packed() for p in range(parts)]
        one = lambda name: pa.ListArray.from_arrays([0, rows.num_rows], rows[name].combine_chunks())
        return pa.RecordBatch.from_arrays(
            [one("vec_id"), one("label"), pa.array([points.astype(np.int32).tobytes()], pa.binary()),
             pa.array([grown], pa.list_(pa.struct([(k, pa.binary()) for k in Balls._TYPES])))],
            names=["vec_ids", "labels", "points", "trees"],
        )

    return kept.mapInArrow(run, schema)


def _opened(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[Balls]]]:
    parts, _, width = books.shape
    for i in range(batch.num_rows):
        points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).astype(np.int64)
        trees = [Balls.unpacked(t, width) for t in batch.column("trees")[i].as_py()]
        yield i, points.reshape(len(trees[0].order), parts * width), trees


def _totals(books: np.ndarray):
    """Sums (place 0 and on) and counts (place -1) of each entry, over all trees of the task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for _, points, trees in _opened(batch, books):
                for p, tree in enumerate(trees):
                    _, sums, counts, _ = tree.nearest(points[:, p * width : (p + 1) * width], books[p])
                    total[p, :, 0] += counts
                    total[p, :, 1:] += sums
        part, entry = np.nonzero(total[:, :, 0])
        for a in range(0, len(part), 1024):
            p, e = part[a : a + 1024], entry[a : a + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(p, width + 1).astype(np.int32)), pa.array(np.repeat(e, width + 1).astype(np.int32)),
                 pa.array(np.tile(np.arange(-1, width), len(p)).astype(np.int32)), pa.array(total[p, e].reshape(-1))],
                names=["part", "entry", "place", "value"],
            )

    return run


def _codes(books: np.ndarray, schema: T.StructType):
    parts, _, width = books.shape
    digits = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, points, trees in _opened(batch, books):
                code = np.full(len(points), "", "U1")
                error = np.zeros(len(points), np.int64)
                for p, tree in enumerate(trees):
                    mine = points[:, p * width : (p + 1) * width]
                    at = tree.nearest(mine, books[p])[0]
                    code = np.char.add(code, digits[at])
                    error += ((mine - books[p][at]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[i].values, batch.column("labels")[i].values, pa.array(code.tolist(), pa.string()), pa.array(error)],
                    names=schema.names,
                )

    return run


def decompress(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in components of the original scale."""
    at = [int(code[2 * p : 2 * p + 2], 16) for p in range(len(books))]
    return np.concatenate([books[p, e] for p, e in enumerate(at)]) / SCALE


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    found, books = compress(table(spark, sf_dir, "embeddings"))
    coded = cut_lineage(found)
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    of_label = totals.withColumnRenamed("label", "total_label")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("total_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """All rounds written out, one after the other."""
    square = "list_inner_product({0}, {0})"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS (
    SELECT r, part.p, min(CAST({square.format('x')} + {square.format('c')} - 2 * list_inner_product(x, c) AS HUGEINT) * {entries} + e) AS best
    FROM part JOIN book{i} ON part.p = book{i}.p GROUP BY r, part.p
), at{i} AS (
    SELECT r, p, CAST(best % {entries} AS BIGINT) AS e, CAST(best // {entries} AS BIGINT) AS error FROM near{i}
)""")
        if i < rounds:
            steps.append(f"""mean{i} AS (
    SELECT p, e, list(CAST(floor(total / n) AS DOUBLE) ORDER BY place) AS c FROM (
        SELECT at{i}.p, e, place, sum(x[place]) AS total, count(*) AS n
        FROM at{i} JOIN part ON part.r = at{i}.r AND part.p = at{i}.p, places GROUP BY ALL
    ) AS summed GROUP BY p, e
), book{i + 1} AS (
    SELECT book{i}.p, book{i}.e, coalesce(mean{i}.c, book{i}.c) AS c
    FROM book{i} LEFT JOIN mean{i} ON mean{i}.p = book{i}.p AND mean{i}.e = book{i}.e
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
           list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), width AS (
    SELECT max(len(v)) // {parts} AS w FROM kept
), places AS (
    SELECT unnest(generate_series(1, w)) AS place FROM width
), part AS MATERIALIZED (
    SELECT r, p, list_slice(v, p * w + 1, (p + 1) * w) AS x FROM kept, range({parts}) AS t(p), width
), book0 AS (
    SELECT p, r AS e, x AS c FROM part WHERE r < {entries}
), {", ".join(steps)}, code AS (
    SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(error) AS BIGINT) AS error FROM at{rounds} GROUP BY r
), told AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS digest
    FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM code JOIN kept ON kept.r = code.r, told
"""


SQL = _sql()
