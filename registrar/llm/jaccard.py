"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets verify them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import Words, append, cut_lineage, mix, raw_text, text_key
from registrar.llm.groups import candidate_groups, components, in_blocks, met

N = 5
#: A pair is a link if its n-gram sets have a Jaccard coefficient of LEAST / 10 or more.
LEAST = 8
#: 25 bands of 4 rows, the surest split of VALUES that keeps false candidates few: 2 in a million are missed at the threshold.
RECALL = 0.999998
#: Most MinHash values for each text.
VALUES = 100


def bands_and_rows(similarity: float, recall: float, values: int = VALUES) -> tuple[int, int]:
    """Most rows for each band (fewest false candidates) with which ``recall`` takes at most ``values`` values."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows > values:
            break
        best = (bands, rows)
    return best


def near_duplicates(docs: DataFrame, n: int = N, least: int = LEAST, recall: float = RECALL) -> DataFrame:
    """Class and number of links of each document: doc_id, key, class_id, n_links, n_copies, n_shingles, keeper.

    Shingles are the ``n``-word windows of lower-cased words (as in
    ``common.Words``); a text of fewer words, but not none, has one of all its
    words. Two documents are linked if the Jaccard coefficient of their
    shingle sets is ``least`` tenths or more. A class is a connected component of links; its
    id is its smallest doc_id, and ``keeper`` marks one document of it. ``n_links``
    counts the linked documents. One row for each document, a distinct
    pair of doc_id and text (``key`` is a hash of the text).

    Null, empty and wordless texts are linked with nothing. Documents with
    equal sets are one node of the join, with a count of copies. Band hashes
    are shuffled, not texts; nodes that meet in buckets form clusters. A
    cluster of bounded size is verified in one task; a larger one in blocks of
    bounded size by two, each pair once, as a whole or bucket by bucket,
    whichever sends fewer rows. Tasks return counts and a spanning forest, never
    the pairs of a group: each node has one edge, from the group of its block
    with itself, and a pair of blocks adds edges between their local roots
    only. At every size of
    the cluster, the linked pairs are those that share a band, which a pair at
    the threshold does with probability ``recall``.
    """
    bands, rows = bands_and_rows(least / 10, recall)
    sketches = cut_lineage(_sketches(docs, n, bands, rows).dropDuplicates(["doc_id", "key"]))
    nodes = (
        sketches.filter("n_shingles > 0")
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "key")).alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("size"),
             F.first("bands").alias("bands"))
    )
    nodes = cut_lineage(nodes)
    members = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    checked = cut_lineage(_verified(docs, nodes, candidate_groups(met(members)), n, least))
    labels = components(checked.filter("node != root").select("node", "root"))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    by_node = (
        nodes.select("node", "rep", "copies")
        .join(labels, "node", "left")
        .join(links, "node", "left")
        .select("node", "rep", "copies", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    classes = by_node.groupBy("label").agg(F.min("rep").alias("first"))
    known = by_node.join(classes, "label").select("node", "copies", "links", "first")
    joined = sketches.select("doc_id", "key", "n_shingles", "node").join(known, "node", "left")
    own = F.struct("doc_id", "key")
    return joined.select(
        "doc_id",
        "key",
        F.coalesce("first.doc_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.col("n_shingles").cast("long").alias("n_shingles"),
        (F.col("first").isNull() | own.eqNullSafe(F.col("first"))).alias("keeper"),
    )


def keep_one(docs: DataFrame, n: int = N, least: int = LEAST, recall: float = RECALL) -> DataFrame:
    """One document of each class: the first by doc_id, then by a hash of the text. Repeated rows go too."""
    names = docs.columns
    kept = near_duplicates(docs.select("doc_id", "text"), n, least, recall).filter("keeper").select(
        F.col("doc_id").alias("__doc"), F.col("key").alias("__doc_key")
    )
    keyed = docs.withColumn("__key", text_key())
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key"))
    return keyed.join(kept, on).dropDuplicates(["doc_id", "__key"]).select(*names)


def shingle_sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(*raw_text(batch.column(batch.schema.get_field_index("text"))))
    at, h = words.windows(n)
    place = np.searchsorted(at, words.first)
    for doc in range(batch.num_rows):
        start, end = place[doc], place[doc + 1]
        if start < end:
            yield np.unique(h[start:end])
        elif words.first[doc] < words.first[doc + 1]:
            text = words.text(words.first[doc], words.first[doc + 1])
            yield np.array([xxhash.xxh3_64_intdigest(text)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key, n_shingles, node (digest of the shingle set) and one hash for each band."""
    draw = np.random.default_rng(20240611)
    factors = draw.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 2**63, bands * rows, dtype=np.uint64)
    weights = draw.integers(1, 2**63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sets = list(shingle_sets(batch, n))
        full = [s for s in sets if len(s)]
        made: list[list[int] | None] = [None] * len(sets)
        if full:
            values = np.concatenate(full)
            starts = np.concatenate(([0], np.cumsum([len(s) for s in full])[:-1]))
            least = np.empty((len(full), bands, rows), np.uint64)
            for i in range(bands * rows):
                least[:, i // rows, i % rows] = np.minimum.reduceat((values ^ shifts[i]) * factors[i], starts)
            hashes = mix((least * weights).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)
            for i, row in zip([i for i, s in enumerate(sets) if len(s)], hashes.tolist()):
                made[i] = row
        return {
            "n_shingles": [len(s) for s in sets],
            "node": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            "bands": made,
        }

    keyed = docs.select("doc_id", "text", text_key().alias("key"))
    return append(keyed, "n_shingles int, node binary, bands array<long>", work).drop("text")


def _verified(docs: DataFrame, nodes: DataFrame, groups: DataFrame, n: int, least: int) -> DataFrame:
    """node, links (linked documents found in a group), root (of its component in the group)."""
    asked = groups.join(nodes.select("node", "rep", "copies"), "node").select(
        "*", F.col("rep.doc_id").alias("__doc"), F.col("rep.key").alias("__doc_key")
    )
    keyed = docs.select("doc_id", "text", text_key().alias("__key"))
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key"))
    texts = keyed.join(asked, on).dropDuplicates(["doc_id", "__key"]).select(
        "text", "node", "copies", "label", "buckets", "units"
    )

    def sets(batch: pa.RecordBatch) -> dict[str, object]:
        return {"grams": pa.array([s.tobytes() for s in shingle_sets(batch, n)], pa.binary())}

    rows = in_blocks(append(texts, "grams binary", sets).drop("text")).drop("label")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple[bytes, int, bytes]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["group"] != row["group"]:
                    out += compare(held, least)
                    held = []
                held.append(row)
            if out:
                yield _result(out)
                out = []
        if held:
            yield _result(compare(held, least))

    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(
        verify, "node binary, links long, root binary"
    )


def _result(rows: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.binary())],
        names=["node", "links", "root"],
    )


def compare(rows: list[dict], least: int) -> list[tuple[bytes, int, bytes]]:
    """Linked documents, and the node that it hangs on, of each node of a group that has a link in it.

    In a group of one block, nodes hang on the least node of their component.
    In one of two blocks, links across are counted, and only the blocks' own
    roots hang on the root of both.
    """
    rows = sorted(rows, key=lambda r: r["node"])
    sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
    linked = _linked(sets, least)
    # A pair counts if it shares a bucket: in a group that is one bucket, only in the smallest that both are in.
    bucket = rows[0]["bucket"]
    asked = [[b for b in r["buckets"] if bucket is None or b < bucket] for r in rows]
    names = {b: i for i, b in enumerate(sorted({b for x in asked for b in x}))}
    held = np.zeros((len(rows), len(names)), np.float32)
    for i, x in enumerate(asked):
        held[i, [names[b] for b in x]] = 1
    shared = held @ held.T > 0
    linked &= shared if bucket is None else ~shared
    side = np.array([r["side"] for r in rows])
    inside = linked & (side[:, None] == side[None, :])
    counted = linked & ~inside if rows[0]["crossed"] else linked
    counts = counted @ np.array([r["copies"] for r in rows])
    root = roots(linked)
    if rows[0]["crossed"]:
        at = np.arange(len(rows))
        root = np.where(roots(inside) == at, root, at)
    return [(rows[i]["node"], int(counts[i]), rows[root[i]]["node"]) for i in np.flatnonzero((counts > 0) | (root != np.arange(len(rows))))]


def roots(linked: np.ndarray) -> np.ndarray:
    """The least row that each one reaches, by repeated minima."""
    root = np.arange(len(linked))
    while True:
        reached = np.where(linked, root[None, :], len(linked)).min(1)
        lower = np.minimum(root, reached)
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def _linked(sets: list[np.ndarray], least: int) -> np.ndarray:
    """Which pairs have 10 * |A and B| >= least * |A or B|."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        shared = np.zeros((2, 2))
        shared[0, 1] = shared[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        common = counts[place] > 1  # the others are in no intersection
        column = (np.cumsum(counts > 1) - 1)[place[common]]
        owner = owner[common]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        width = max(256, 4_000_000 // len(sets))
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, (start, start + width))
            held = np.zeros((len(sets), min(width, int(column[-1]) + 1 - start)), np.float32)
            held[owner[a:b], column[a:b] - start] = 1
            shared += held @ held.T
    shared = np.rint(shared).astype(np.int64)
    linked = 10 * shared >= least * (sizes[:, None] + sizes[None, :] - shared)
    np.fill_diagonal(linked, False)
    return linked & (shared > 0)


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs)
    keyed = docs.select(F.col("doc_id").alias("__doc"), text_key().alias("__key"))
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key"))
    return keyed.join(found, on).select("doc_id", "class_id", "n_links", "n_copies", "n_shingles")


SQL = rf"""
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + 4), ' ') AS w
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS pos
          FROM word WHERE len(words) > 0)
), sized AS (
    SELECT doc_id, count(*) AS n, bit_xor(hash(w)) AS x, sum(CAST(hash(w) % 1000000007 AS BIGINT)) AS y
    FROM shingle GROUP BY doc_id
), link AS (
    SELECT a, b FROM (
        SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS n
        FROM shingle s JOIN shingle t ON s.w = t.w AND s.doc_id <> t.doc_id GROUP BY ALL
    ) AS pair JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
    WHERE 10 * pair.n >= {LEAST} * (p.n + q.n - pair.n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), class AS (
    SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a
), links AS (
    SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a
), copies AS (
    SELECT n, x, y, count(*) AS n_copies FROM sized GROUP BY ALL
)
SELECT documents.doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_copies, 1) AS n_copies,
       coalesce(sized.n, 0) AS n_shingles
FROM documents JOIN class ON class.doc_id = documents.doc_id
LEFT JOIN links ON links.doc_id = documents.doc_id
LEFT JOIN sized ON sized.doc_id = documents.doc_id
LEFT JOIN copies ON copies.n = sized.n AND copies.x = sized.x AND copies.y = sized.y
"""
