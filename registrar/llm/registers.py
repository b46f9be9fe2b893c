"""MinHash near-duplicates with compressed registers: leading zeros and some mantissa bits of each bucket's minimum."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import NOT_SPACE, Words, append, cut_lineage, mix, range_hash, raw_text, text_key
from registrar.llm.groups import candidate_groups, components, in_blocks, met

N = 3
#: Two documents are linked if 100 * |A and B| >= LEAST * |A or B|.
LEAST = 85
#: Buckets (registers) of a text, a power of two.
BUCKETS = 128
#: Mantissa bits of a register; six more hold the leading zeros.
MANTISSA = 10
#: 25 bands of 5 registers: a pair at the threshold shares none with a chance of 4 in ten million.
BANDS, ROWS = 25, 5
#: An estimate so many standard deviations under the threshold rules a pair out.
DEVIATIONS = 6

_EMPTY = np.uint16(0xFFFF)
_DRAW = np.random.default_rng(20250311)
#: Where an empty register looks for another one's value, in this order.
_PROBES = np.array([_DRAW.permutation(BUCKETS) for _ in range(BUCKETS)])
_WEIGHTS = _DRAW.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(batch: pa.RecordBatch, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts on end, and where each text's begin (and the last one's end)."""
    words = Words(*raw_text(batch.column(batch.schema.get_field_index("text"))), NOT_SPACE)
    at, h = words.windows(n)
    owner = np.searchsorted(words.first, at, side="right") - 1
    counts = np.diff(words.first)
    few = np.flatnonzero((counts > 0) & (counts < n))
    h = np.concatenate((h, range_hash(words.hashes, words.first[few], words.first[few + 1], 1)))
    owner = np.concatenate((owner, few))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(batch.num_rows + 1))


def registers(hashes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """The registers of each row's sorted hashes.

    The top bits of a hash name its bucket. A register is the number of leading
    zeros of the rest of the bucket's least hash, and the bits after its first one.
    """
    bits = BUCKETS.bit_length() - 1
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    key = owner * BUCKETS + bucket
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    rest = (hashes[first] << np.uint64(bits)) >> np.uint64(11)  # 53 bits, exact as a float
    length = np.frexp(rest.astype(np.float64))[1]  # position of the first one; 0 if there is none
    zeros = (53 - length).astype(np.uint64)
    after = (rest << (zeros + np.uint64(12))) >> np.uint64(64 - MANTISSA)
    out = np.full(rows * BUCKETS, _EMPTY, np.uint16)
    out[key[first]] = (zeros << np.uint64(MANTISSA)) | after
    return out.reshape(rows, BUCKETS)


def filled(values: np.ndarray) -> np.ndarray:
    """Registers with those of empty buckets taken from the first full one on the bucket's own list."""
    out = values.copy()
    row, at = np.nonzero((values == _EMPTY) & (values != _EMPTY).any(1)[:, None])
    for step in range(BUCKETS):
        if not len(row):
            break
        found = values[row, _PROBES[at, step]]
        out[row, at] = found
        left = found == _EMPTY
        row, at = row[left], at[left]
    return out


def band_hashes(values: np.ndarray) -> np.ndarray:
    parts = filled(values)[:, : BANDS * ROWS].astype(np.uint64).reshape(len(values), BANDS, ROWS)
    return mix(((parts + np.uint64(1)) * _WEIGHTS).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


_chances: list[np.ndarray] = []


def chance(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Chance that different least hashes of a bucket have one register, for sets of these sizes.

    From a table over powers of two of the mean number of hashes in a bucket.
    """
    if not _chances:
        lowest = np.concatenate([
            (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) * 2.0 ** -(z + 1) for z in range(54)
        ])
        width = np.repeat(2.0 ** -(np.arange(54) + 1 + MANTISSA), 1 << MANTISSA)
        mean = 2.0 ** np.arange(-8, 41)[:, None]
        held = np.exp(-mean * lowest) * -np.expm1(-mean * width) / -np.expm1(-mean)
        _chances.append(held @ held.T)
    place = [np.clip(np.rint(np.log2(np.maximum(s, 1) / BUCKETS)), -8, 40).astype(int) + 8 for s in (size_a, size_b)]
    return _chances[0][place[0], place[1]]


def may_link(one: np.ndarray, size: int, many: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Whether the estimated Jaccard coefficient, corrected for registers equal by chance, leaves a link possible."""
    full = one != _EMPTY
    used = (full | (many != _EMPTY)).sum(1)
    same = ((many == one) & full).sum(1)
    used = np.maximum(used, 1)
    by_chance = chance(np.full(len(sizes), size), sizes)
    estimate = (same / used - by_chance) / (1 - by_chance)
    wanted = least / 100
    return estimate + DEVIATIONS * np.sqrt(wanted * (1 - wanted) / used) >= wanted


def linked(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> bool:
    """Whether two sorted sets have 100 * |A and B| >= least * |A or B|; decided on the full sets."""
    if 100 * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    shared = int((a[at] == b).sum())
    return shared > 0 and 100 * shared >= least * (len(a) + len(b) - shared)


def near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, key, n_shingles, component_id and kept, one row for each input row (``key`` is a hash of the text).

    A document's set are its distinct shingles of three lower-cased (A-Z) words
    ``[^\\x20\\x09-\\x0D]+``; of fewer words, all of them are one. Documents are linked if
    100 * |A and B| >= ``least`` * |A or B| (85: Jaccard of 0.85). ``component_id`` is the smallest doc_id that
    links reach (a null one counts only if there is no other), ``kept`` that it is the
    document's own. Null, empty and wordless texts are linked with nothing. Repeated rows are linked and
    each is kept or not as the other. Only doc_id and text are read.

    Documents with equal sets are one node. Nodes that share a band of
    registers meet: first every node is compared with the least one of each
    of its bands (estimate from the registers, then full sets), which
    finds the components of almost all copies without pairs. Only bands
    whose nodes are still of several components are compared in full, in groups of bounded
    size, and only across components.
    """
    sketches = cut_lineage(_sketches(docs))
    nodes = cut_lineage(
        sketches.filter("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct("doc_id", "key")).alias("rep"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("size"),
            F.first("registers").alias("registers"), F.first("bands").alias("bands"),
        )
    )
    placed = met(nodes.select("node", "size", F.explode("bands").alias("bucket")))
    pairs = placed.filter("node != low").select("node", F.col("low").alias("centre")).distinct()
    sketch = nodes.select("node", "size", F.col("registers").alias("data"))
    possible = passing(pairs, sketch, _estimated(least))
    sets = cut_lineage(_sets(docs, nodes, placed.select("node").distinct()))
    stars = passing(possible, sets.select("node", "size", F.col("grams").alias("data")), _verified(least))
    labels = cut_lineage(components(stars.select("node", "centre")))

    named = placed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_buckets = named.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a != b").select("bucket")
    rest = cut_lineage(named.join(open_buckets, "bucket").withColumnRenamed("label", "component"))
    groups = candidate_groups(rest.drop("component"))
    of = rest.select("node", "component").distinct()
    rows = in_blocks(groups.join(of, "node").join(sets, "node").join(nodes.select("node", "registers"), "node")).drop("label")
    more = rows.repartition("group").sortWithinPartitions("group").mapInArrow(_compared(least), "a binary, b binary")
    joined = components(more)
    final = (
        labels.join(joined.withColumnRenamed("label", "top").withColumnRenamed("node", "at"), F.col("label") == F.col("at"), "left")
        .select("node", F.coalesce("top", "label").alias("label"))
        .union(joined.join(labels.select("node"), "node", "left_anti"))
    )
    by_node = nodes.select("node", "least").join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = by_node.groupBy("label").agg(F.min("least").alias("component_id"))
    known = by_node.join(classes, "label").select("node", "component_id")
    return sketches.select("doc_id", "key", "n_shingles", "node").join(known, "node", "left").select(
        "doc_id", "key", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"),
    )


def _sketches(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, node (digest of the set), registers and one hash for each band."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        h, first = shingle_sets(batch)
        sizes = np.diff(first)
        values = registers(h, np.repeat(np.arange(batch.num_rows), sizes), batch.num_rows)
        hashes = band_hashes(values).view(np.int64)
        full = sizes > 0
        return {
            "n_shingles": sizes.astype(np.int32).tolist(),
            "node": pa.array([xxhash.xxh3_128_digest(h[a:b].tobytes()) if a < b else None for a, b in zip(first, first[1:])], pa.binary()),
            "registers": pa.array([v.tobytes() if f else None for v, f in zip(values, full)], pa.binary()),
            "bands": [v.tolist() if f else None for v, f in zip(hashes, full)],
        }

    keyed = docs.select("doc_id", "text", text_key().alias("key"))
    return append(keyed, "n_shingles int, node binary, registers binary, bands array<long>", work).drop("text")


def _sets(docs: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """node, size, grams (the full set) of the nodes asked for, from one text of each."""
    of = nodes.join(asked, "node", "left_semi").select("node", "size", F.col("rep.doc_id").alias("__doc"), F.col("rep.key").alias("__doc_key"))
    keyed = docs.select("doc_id", "text", text_key().alias("__key"))
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key"))
    texts = keyed.join(of, on).dropDuplicates(["node"]).select("text", "node", "size")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        h, first = shingle_sets(batch)
        return {"grams": pa.array([h[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())}

    return append(texts, "grams binary", work).drop("text")


def passing(pairs: DataFrame, data: DataFrame, test: Callable) -> DataFrame:
    """The pairs (node, centre) that pass ``test``, given what both hold (node, size, data).

    Two joins on narrow pairs; the members of a hot centre are split by
    adaptive execution, and stream by in batches.
    """
    of_centre = data.toDF("centre", "centre_size", "centre_data")
    rows = pairs.join(data, "node").join(of_centre, "centre")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [batch.column(c) for c in ("size", "data", "centre_size", "centre_data")]
            passed = [bool(test(*row)) for row in zip(*(h.to_pylist() for h in held))]
            yield batch.select(["node", "centre"]).filter(pa.array(passed, pa.bool_()))

    return rows.mapInArrow(run, "node binary, centre binary")


def _estimated(least: int) -> Callable:
    def test(size: int, registers: bytes, centre_size: int, of_centre: bytes) -> bool:
        mine = np.frombuffer(registers, np.uint16)[None, :]
        return may_link(np.frombuffer(of_centre, np.uint16), centre_size, mine, np.array([size]), least)[0]

    return test


def _verified(least: int) -> Callable:
    def test(size: int, grams: bytes, centre_size: int, of_centre: bytes) -> bool:
        return linked(np.frombuffer(of_centre, np.uint64), np.frombuffer(grams, np.uint64), least)

    return test


def _compared(least: int) -> Callable:
    """Edges of a spanning forest of the links across components of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["group"] != row["group"]:
                    out += across(held, least)
                    held = []
                held.append(row)
            yield edges(out)
            out = []
        if held:
            yield edges(across(held, least))

    def edges(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


def across(rows: list[dict], least: int) -> list[tuple[bytes, bytes]]:
    """Pairs of components that a link joins, between rows that share a band; no more than join them all."""
    values = np.frombuffer(b"".join(r["registers"] for r in rows), np.uint16).reshape(len(rows), BUCKETS)
    sizes = np.array([r["size"] for r in rows])
    sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
    _, component = np.unique([r["component"].hex() for r in rows], return_inverse=True)
    top = np.arange(component.max() + 1)
    side = np.array([r["side"] for r in rows])
    buckets = [set(r["buckets"]) for r in rows]
    out = []
    for i in range(len(rows) - 1):
        late = np.arange(i + 1, len(rows))
        late = late[top[component[late]] != top[component[i]]]
        if rows[0]["crossed"]:
            late = late[side[late] != side[i]]
        late = late[may_link(values[i], sizes[i], values[late], sizes[late], least)]
        for j in late.tolist():
            a, b = top[component[i]], top[component[j]]
            if a != b and buckets[i] & buckets[j] and linked(sets[i], sets[j], least):
                top[top == max(a, b)] = min(a, b)
                out.append((rows[i]["component"], rows[j]["component"]))
    return out


def keep_one(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents that are kept, with all their columns."""
    kept = near_duplicates(docs, least).filter("kept").select(F.col("doc_id").alias("__doc"), F.col("key").alias("__doc_key")).distinct()
    keyed = docs.withColumn("__key", text_key())
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key"))
    return keyed.join(kept, on).select(*docs.columns)


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents")).drop("key")


SQL = rf"""
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + {N - 1}), ' ') AS w
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - {N - 1}, 1))) AS pos FROM word WHERE len(words) > 0)
), sized AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
    SELECT a, b FROM (
        SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS n
        FROM shingle s JOIN shingle t ON s.w = t.w AND s.doc_id <> t.doc_id GROUP BY ALL
    ) AS pair JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
    WHERE 100 * pair.n >= {LEAST} * (p.n + q.n - pair.n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), class AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN class ON class.doc_id = documents.doc_id LEFT JOIN sized ON sized.doc_id = documents.doc_id
"""
