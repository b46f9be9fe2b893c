"""Substring deduplication by suffix arrays: 100-byte strings that start earlier are removed.

A suffix array of all bytes would shuffle many times the corpus. Two things
keep the shuffles below it. Every 100-byte string has one anchor, the 32-byte
string inside it with the least hash (the leftmost of equals), so equal strings
have equal anchors and a string whose anchor stands once is unique. And
strings that follow each other with one anchor form a unit of at most 69 of
them; of equal units (by 64 bits of the anchor and 64 of a digest) only the
first goes on to the suffix arrays.
The suffix arrays are then built bucket by bucket, a bucket being the first
units of one anchor: the difference-cover algorithm sorts the sampled triples,
recurses on their names, merges the remaining suffixes, and adjacent prefixes
of 100 bytes are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.chunks import cut_spans
from registrar.llm.common import blocks, cut_lineage, mix, ranges, raw_text, runs, text_key

LENGTH = 100
#: Bytes of an anchor; REACH is the number of places for it in a string.
ANCHOR = 32
REACH = LENGTH - ANCHOR + 1
#: Most bytes that a suffix array is built of at once: three numbers up to it fit in 63 bits.
ARRAY_BYTES = (1 << 21) - 8
#: Buckets are put together up to so many bytes, which a core's cache holds.
PACKED_BYTES = 300_000
#: Bytes of text whose units are made at once, for the same reason.
UNIT_BLOCK = 500_000


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``symbols`` (positive, below 2**21) in sorted order.

    Difference cover modulo 3: suffixes at places 1 and 2 modulo 3 are the sample.
    """
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    s = np.concatenate((symbols, np.zeros(5, np.int64))).astype(np.uint64)
    bits = np.uint64(21)
    extra = n % 3 == 1  # a place after the end, so that the first part of the sample ends with a zero
    ones = np.arange(1, n + extra, 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    # Sort the sampled triples and name them.
    triples = (s[sample] << (bits + bits)) | (s[sample + 1] << bits) | s[sample + 2]
    order = np.argsort(triples)
    ordered = triples[order]
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate(([1], 1 + np.cumsum(ordered[1:] != ordered[:-1])))
    # Recurse on the names where they are not yet distinct.
    if names[order[-1]] < len(sample):
        order = suffix_array(names)
    sorted_sample = sample[order]
    rank = np.zeros(n + 5, np.uint64)
    rank[sorted_sample] = np.arange(1, len(sample) + 1, dtype=np.uint64)
    # Sort the remaining suffixes by their first symbol and the rank behind it.
    rest = np.arange(0, n, 3)
    keys = (s[rest] << bits) | rank[rest + 1]
    order = np.argsort(keys)
    rest, keys = rest[order], keys[order]
    # Merge: how many sampled suffixes of either kind are smaller than each remaining one.
    is_one = sorted_sample % 3 == 1
    first, second = sorted_sample[is_one], sorted_sample[~is_one]
    smaller = np.searchsorted((s[first] << bits) | rank[first + 1], keys) - int(extra)
    smaller += np.searchsorted(
        (s[second] << (bits + bits)) | (s[second + 1] << bits) | rank[second + 2],
        (s[rest] << (bits + bits)) | (s[rest + 1] << bits) | rank[rest + 2],
    )
    merged = np.empty(n, np.int64)
    places = np.arange(len(rest)) + smaller
    taken = np.zeros(n, bool)
    taken[places] = True
    merged[places] = rest
    merged[~taken] = sorted_sample[int(extra) :]
    return merged


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of the texts: first string, one past the last, text, hash of the anchor (places in ``data``)."""
    sizes = np.diff(offsets)
    if len(data) < LENGTH or sizes.max() < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    width, factor = 1, 0x85EBCA6B
    while width < ANCHOR:
        h = h[:-width] * np.uint32(factor) + h[width:]
        width, factor = width * 2, factor * factor & 0xFFFFFFFF
    h ^= h >> np.uint32(16)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    least, width = h, 1
    while width * 2 <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :])
    # Runs of strings with one least hash; a run begins at a text's first string, and
    # another after its last one, which holds the places that are no strings.
    fresh = np.empty(len(least), bool)
    fresh[0] = True
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    edges = np.concatenate((offsets[:-1], np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])))
    fresh[edges[edges < len(least)]] = True
    low = np.flatnonzero(fresh)
    high = np.append(low[1:], len(least))
    doc = np.searchsorted(offsets, low, side="right") - 1
    real = low + LENGTH <= offsets[doc + 1]
    low, high = low[real], high[real]
    # A run is a unit up to its leftmost anchor; if it goes on beyond, as in periodic text,
    # the hash stands there again.
    anchor = np.empty(len(low), np.int64)
    step = np.arange(REACH)
    for i in range(0, len(low), 10_000):
        part = low[i : i + 10_000]
        anchor[i : i + 10_000] = part + (h[part[:, None] + step] == least[part][:, None]).argmax(1)
    again = np.flatnonzero(high - 1 > anchor)
    if len(again):
        lows, highs, anchors = [np.delete(low, again)], [np.delete(high, again)], [np.delete(anchor, again)]
        for i in again.tolist():
            stands = low[i] + np.flatnonzero(h[low[i] : high[i] + REACH - 1] == least[low[i]])
            cuts = stands[stands < high[i] - 1] + 1
            lows.append(np.append(low[i], cuts))
            highs.append(np.append(cuts, high[i]))
            anchors.append(stands[np.searchsorted(stands, lows[-1])])
        low, high, anchor = (np.concatenate(x) for x in (lows, highs, anchors))
    name = np.empty(len(anchor), np.uint64)
    step = np.arange(ANCHOR)
    for i in range(0, len(anchor), 20_000):
        words = data[anchor[i : i + 20_000, None] + step].view(np.uint64)
        name[i : i + 20_000] = mix((mix(words + _SALT) * _FACTOR).sum(1, dtype=np.uint64))
    return low, high, np.searchsorted(offsets, low, side="right") - 1, name


_SALT = np.random.default_rng(20240613).integers(1, 2**63, ANCHOR // 8, dtype=np.uint64)
_FACTOR = np.random.default_rng(20240614).integers(1, 2**62, ANCHOR // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier: doc_id, key, spans array<struct<start,end>>.

    Earlier is a smaller doc_id, or the same document and a smaller start. A
    document is a distinct pair of doc_id and text (``key`` is a hash of the text,
    and orders texts of one doc_id); rows that repeat it are the same document.
    Texts are UTF-8 bytes, null is empty; texts under 100 bytes have no
    string. Spans overlap or touch nowhere; only texts with a span get a row.

    No group meets in one task uncombined: anchors are counted with a
    map-side combine and joined, where adaptive execution splits hot ones; equal
    units are combined to their first one; and a bucket whose first units have
    more than ARRAY_BYTES goes on string by string, by digest.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    # All joins with the texts have the same columns, also those that only ``dedup`` needs in
    # the end, so that Spark shuffles the texts once and reuses that exchange.
    keyed = docs.select(*docs.columns, text_key().alias("__key"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    anchors = keyed.select("doc_id", "text", "__key").mapInArrow(_anchors, f"doc_id {kind}, key long, anchor long")
    often = anchors.groupBy("anchor").count().filter("count > 1").select("anchor")
    survivors = cut_lineage(
        anchors.join(often, "anchor").groupBy("doc_id", "key").agg(F.collect_set("anchor").alias("__anchors"))
    ).withColumnsRenamed({"doc_id": "__doc", "key": "__doc_key"})
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key"))
    joined = keyed.join(survivors, on).select("doc_id", "__key", "text", "__anchors", *others)
    found_units = joined.mapInArrow(
        _units, f"doc_id {kind}, key long, place long, anchor long, digest long"
    )
    name, own = ["anchor", "digest"], F.struct("doc_id", "key", "place")
    first = found_units.groupBy(*name).agg(F.min(own).alias("first"), F.count("*").alias("count"))
    start, size = F.shiftright("place", 8).cast("int"), F.col("place").bitwiseAND(255).cast("int")
    copies = (
        found_units.join(first.filter("count > 1").select(*name, "first"), name)
        .filter(own > F.col("first"))
        .select("doc_id", "key", start.alias("start"), (start + size + LENGTH - 1).alias("end"))
    )
    # Buckets: the first units of anchors that have several. Their bytes are fetched from the texts.
    # The filter holds for every row; it keeps the aggregate the same in both uses, so that it runs once.
    singles = first.filter("count > 0").select("anchor", "first.*")
    sized = (
        singles.groupBy("anchor").agg(F.count("*").alias("units"), F.sum(size + LENGTH - 1).alias("bytes"))
        .filter("units > 1").select("anchor", (F.col("bytes") > ARRAY_BYTES).alias("large"))
    )
    asked = (
        singles.join(sized, "anchor").groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("place", "anchor", "large")).alias("__asked"))
        .withColumnsRenamed({"doc_id": "__doc", "key": "__doc_key"})
    )
    pieces = keyed.join(asked, on).select("doc_id", "__key", "text", "__asked", *others).mapInArrow(
        _pieces, f"anchor long, doc_id {kind}, key long, low int, count int, piece binary, large boolean"
    )
    spans = f"doc_id {kind}, key long, start int, end int"
    ordered = (
        pieces.filter("NOT large").drop("large").repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_sorted_buckets, spans)
    )
    strings = pieces.filter("large").mapInArrow(
        _strings, f"doc_id {kind}, key long, start int, digest binary"
    )
    at = F.struct("doc_id", "key", "start")
    earliest = strings.groupBy("digest").agg(F.min(at).alias("first"), F.max(at).alias("last")).filter("first != last")
    hot = strings.join(earliest.select("digest", "first"), "digest").filter(at != F.col("first")).select(
        "doc_id", "key", "start", (F.col("start") + LENGTH).alias("end")
    )
    found = copies.unionByName(ordered).unionByName(hot)
    listed = found.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias("text"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [_merged(x) for x in batch.column(2).to_pylist()]
            made = pa.array(merged, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["doc_id", "key", "spans"])

    return listed.mapInArrow(merge, f"doc_id {kind}, key long, spans array<struct<start:int,end:int>>")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated bytes; a character that lost a byte goes whole. Adds n_bytes, n_removed, n_spans."""
    return cut_spans(docs, repeated_spans(docs))


def _merged(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    start = np.array([x["start"] for x in spans])
    end = np.array([x["end"] for x in spans])
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    ends = end[np.append(fresh[1:], len(end)) - 1]
    return [{"start": s, "end": e} for s, e in zip(start[fresh].tolist(), ends.tolist())]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in blocks(whole, most=UNIT_BLOCK):
            _, _, doc, key = units(*raw_text(batch.column(1)))
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(key.view(np.int64))],
                names=["doc_id", "key", "anchor"],
            )


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units whose anchor is among the text's survivors; place is first string * 256 + number of strings."""
    for whole in batches:
        for batch in blocks(whole, most=UNIT_BLOCK):
            data, offsets = raw_text(batch.column(2))
            low, high, doc, name = units(data, offsets)
            wanted = batch.column(3)
            values = wanted.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
            step = np.uint64(0x9E3779B97F4A7C15)
            pairs = np.sort(values.view(np.uint64) + owner.astype(np.uint64) * step)
            mine = name + doc.astype(np.uint64) * step
            keep = pairs[np.minimum(np.searchsorted(pairs, mine), len(pairs) - 1)] == mine if len(pairs) else mine < 0
            low, high, doc, name = low[keep], high[keep], doc[keep], name[keep]
            view = memoryview(data)
            digests = [xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(low.tolist(), (high + LENGTH - 1).tolist())]
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(((low - offsets[doc]) << 8) + (high - low)),
                    pa.array(name.view(np.int64)),
                    pa.array(np.array(digests, np.uint64).view(np.int64)),
                ],
                names=["doc_id", "key", "place", "anchor", "digest"],
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the units asked for."""
    for whole in batches:
        for batch in blocks(whole, most=UNIT_BLOCK):
            data, offsets = raw_text(batch.column(2))
            asked = batch.column(3)
            doc = np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy(zero_copy_only=False))
            place, anchor, large = asked.flatten().flatten()
            place = place.to_numpy(zero_copy_only=False)
            low, count = place >> 8, place & 255
            view = memoryview(data)
            begin = (low + offsets[doc]).tolist()
            size = (count + LENGTH - 1).tolist()
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    anchor,
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(low.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array([bytes(view[s : s + n]) for s, n in zip(begin, size)], pa.binary()),
                    large,
                ],
                names=["anchor", "doc_id", "key", "low", "count", "piece", "large"],
            )


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole buckets, as many together as fit; rows come sorted by anchor."""
    held: list[tuple] = []
    size = open_at = open_size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if held and held[-1][0] != row[0]:
                open_at, open_size = len(held), size
            if size + len(row[5]) > PACKED_BYTES and open_at:
                yield _result(held[:open_at], batch)
                held, size, open_at = held[open_at:], size - open_size, 0
            held.append(row)
            size += len(row[5])
    if held:
        yield _result(held, batch)


def _result(rows: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
    # A document that is listed twice brings its units twice.
    rows = list({r[:4]: r for r in rows}.values())
    found = earlier_strings([r[1:] for r in rows])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[u][1] for u, _, _ in found], like.schema.field(1).type),
            pa.array([rows[u][2] for u, _, _ in found], pa.int64()),
            pa.array([rows[u][3] + s for u, s, _ in found], pa.int32()),
            pa.array([rows[u][3] + e + LENGTH - 1 for u, _, e in found], pa.int32()),
        ],
        names=["doc_id", "key", "start", "end"],
    )


def earlier_strings(rows: list[tuple]) -> list[tuple[int, int, int]]:
    """Runs (row, first, one past the last) of strings that stand earlier among the rows.

    ``rows`` are units (doc_id, key, low, count, piece).
    """
    text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    counts = np.array([r[3] for r in rows])
    starts = np.cumsum([0] + [len(r[4]) for r in rows])[:-1]
    order_of = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0], rows[i][1:3]))
    rank = np.empty(len(rows), np.int64)
    rank[order_of] = np.arange(len(rows))
    string = ranges(starts, counts)
    unit = np.repeat(np.arange(len(rows)), counts)
    number = string - starts[unit]
    at = np.full(len(text), -1, np.int64)
    at[string] = np.arange(len(string))
    order = at[suffix_array(text.astype(np.int64) + 1)]
    order = order[order >= 0]
    # Compare the adjacent prefixes.
    equal = np.zeros(len(order), bool)
    step = np.arange(LENGTH)
    for i in range(0, len(order) - 1, 20_000):
        here = string[order[i : i + 20_001]]
        window = text[here[:, None] + step]
        equal[i + 1 : i + len(here)] = (window[1:] == window[:-1]).all(1)
    time = rank[unit] * LENGTH + number
    group = np.flatnonzero(~equal)
    first = np.minimum.reduceat(time[order], group)
    covered = np.zeros(len(string), bool)
    covered[order] = time[order] > np.repeat(first, np.diff(np.append(group, len(order))))
    out = []
    edge = np.zeros(len(string) + 1, bool)
    edge[np.cumsum(counts)] = edge[0] = True  # runs end with their unit
    for s, e in zip(*runs(covered)):
        cuts = [s, *(s + 1 + np.flatnonzero(edge[s + 1 : e])), e]
        out += [(int(unit[a]), int(number[a]), int(number[b - 1]) + 1) for a, b in zip(cuts, cuts[1:])]
    return out


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every 100-byte string of the units of a bucket too large for one suffix array."""
    for batch in batches:
        names = batch.schema.names
        low, count, piece = (batch.column(names.index(c)).to_pylist() for c in ("low", "count", "piece"))
        for start in range(0, batch.num_rows, 2_000):
            part = range(start, min(start + 2_000, batch.num_rows))
            rows = pa.array([i for i in part for _ in range(count[i])], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(names.index("doc_id")).take(rows),
                    batch.column(names.index("key")).take(rows),
                    pa.array([low[i] + k for i in part for k in range(count[i])], pa.int32()),
                    pa.array(
                        [xxhash.xxh3_128_digest(piece[i][k : k + LENGTH]) for i in part for k in range(count[i])],
                        pa.binary(),
                    ),
                ],
                names=["doc_id", "key", "start", "digest"],
            )


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_spans(docs, repeated_spans(docs), digest=True).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
