"""Substring deduplication: content-defined chunks by a gear hash, deduplicated by digest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar.llm.common import append, blocks, raw_text, runs, text_key

#: A cut needs the largest gear hash among so many places on either side.
REACH = 24
#: Repeated chunks on end go if they have at least so many bytes together.
LEAST_BYTES = 64

#: Runs of a period of REACH bytes or less have no largest hash; from this length on they are cut by their period.
LEAST_RUN = 64

#: Gear values: one random number for each byte.
_GEAR = np.random.default_rng(20240607).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Gear rolling hash after each byte: h = 2 * h + gear[byte], on 32 bits, so of the last 32 bytes."""
    h = _GEAR[data]
    width = 1
    while width < 32 and len(h) > width:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
        width *= 2
    return h


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chunk edges in ``data``, all text edges among them.

    A cut comes after a byte whose gear hash is larger than those of the
    REACH places before it and not smaller than those of the REACH after it.
    A cut depends only on the bytes nearby, and after an insertion the next
    cuts are the old ones. Periodic runs have no such byte: their cuts are those
    of ``_run_cuts`` instead. Outside of them no chunk that ends at two such
    cuts is shorter than REACH.
    """
    # Between texts stand zeros, so that no cut depends on the texts next to it.
    gap = 32 + REACH
    sizes = np.diff(offsets)
    place = np.arange(len(data)) + np.repeat(np.arange(1, len(sizes) + 1) * gap, sizes)
    spaced = np.zeros(len(data) + (len(sizes) + 1) * gap, np.uint8)
    spaced[place] = data
    h = np.full(len(spaced), -1, np.int64)
    h[place] = gear_hash(spaced)[place]
    # Maxima of REACH neighbours by doubling: top[i] is that of h[i : i + REACH].
    width, top = 1, h
    while width * 2 <= REACH:
        top = np.maximum(top[:-width], top[width:])
        width *= 2
    top = np.maximum(top[: len(h) - REACH + 1], top[REACH - width : len(h) - width + 1])
    cut = (h[place] > top[place - REACH]) & (h[place] >= top[place + 1])
    cuts = np.flatnonzero(cut) + 1
    found = periodic_runs(data, offsets)
    if found:
        inside = np.zeros(len(data) + 2, np.int64)
        np.add.at(inside, [start + 1 for start, _, _ in found], 1)
        np.add.at(inside, [end for _, end, _ in found], -1)
        cuts = cuts[np.cumsum(inside)[cuts] == 0]
        cuts = np.concatenate([cuts, *[_run_cuts(data, *run) for run in found]])
    return np.unique(np.concatenate((cuts, offsets)))


_ALL_EQUAL = np.uint64(0x0101010101010101)


def periodic_runs(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the longest runs inside a text, of LEAST_RUN bytes or more, whose period is REACH or less."""
    found: dict[tuple[int, int], int] = {}
    for period in range(1, REACH + 1):
        if len(data) < LEAST_RUN:
            break
        equal = data[period:] == data[:-period]
        # A long run holds whole words of eight equal bytes; most blocks of text have none.
        words = equal[: len(equal) // 8 * 8].view(np.uint64) == _ALL_EQUAL
        if not (words[:-3] & words[1:-2] & words[2:-1] & words[3:]).any():
            continue
        edges = (offsets[1:-1, None] - 1 - np.arange(period)[None, :]).ravel()
        equal[edges[(edges >= 0) & (edges < len(equal))]] = False
        starts, ends = runs(equal)
        long = ends - starts + period >= LEAST_RUN
        for start, end in zip(starts[long].tolist(), (ends[long] + period).tolist()):
            found.setdefault((start, end), period)  # a multiple of the period has the same run
    return [(start, end, period) for (start, end), period in found.items()]


def _run_cuts(data: np.ndarray, start: int, end: int, period: int) -> np.ndarray:
    """Edges of a periodic run: its ends, and every REACH bytes or more where its least rotation starts.

    So the chunks within all runs of the same repeated bytes are equal,
    wherever in the period and after whatever text a run starts.
    """
    twice = data[start : start + period].tobytes() * 2
    first = start + min(range(period), key=lambda r: twice[r : r + period])
    return np.concatenate(([start], np.arange(first, end, -(-REACH // period) * period), [end]))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """One row for each chunk of each text: digest (high, low), doc_id, key, and at (start * 2**31 + size)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for whole in batches:
            for batch in blocks(whole):
                data, offsets = raw_text(batch.column(batch.schema.get_field_index("text")))
                edges = cut_places(data, offsets)
                owner = np.searchsorted(offsets, edges[:-1], side="right") - 1
                view = memoryview(data)
                digests = b"".join(
                    [xxhash.xxh3_128_digest(view[s:e]) for s, e in zip(edges.tolist(), edges[1:].tolist())]
                )
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(halves[:, 0])),
                        pa.array(np.ascontiguousarray(halves[:, 1])),
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(((edges[:-1] - offsets[owner]) << 31) + np.diff(edges)),
                    ],
                    names=["high", "low", "doc_id", "key", "at"],
                )

    return docs.select("doc_id", text_key().alias("key"), "text").filter("text != ''").mapInArrow(
        cut, f"high long, low long, doc_id {kind}, key long, at long"
    )


def repeated_spans(docs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Byte spans of each text that repeat earlier ones: doc_id, key, spans array<struct<start,end>>.

    A chunk repeats if its digest stands earlier: in a smaller doc_id, or in the
    same text further left. Repeated chunks on end make a span if they
    have ``least_bytes`` or more together. Rows with equal doc_id and text are
    one document; rows with equal doc_id and other text are ordered by a hash
    of the text. Only texts with a span get a row.

    Digests are counted with a map-side combine, so a chunk that a third of
    all documents hold is one small row per task before the shuffle; adaptive
    execution splits it where the rows come back to learn whether they are first.
    """
    rows = chunk_rows(docs)
    own = F.struct("doc_id", "key", "at")
    first = (
        rows.groupBy("high", "low")
        .agg(F.min(own).alias("first"), F.count("*").alias("count"))
        .filter("count > 1")
        .select("high", "low", "first")
    )
    again = rows.join(first, ["high", "low"]).filter(own > F.col("first")).select(
        "doc_id", "key", F.shiftright("at", 31).cast("int").alias("start"), F.col("at").bitwiseAND(2**31 - 1).cast("int").alias("size")
    )
    order = Window.partitionBy("doc_id", "key").orderBy("start")
    # Identical rows of documents give identical chunks: distinct places are what counts.
    places = again.select("doc_id", "key", "start", "size").distinct()
    opened = places.withColumn(
        "opens", (F.col("start") != F.coalesce(F.lag(F.col("start") + F.col("size")).over(order), F.lit(-1))).cast("int")
    )
    spans = (
        opened.withColumn("span", F.sum("opens").over(order))
        .groupBy("doc_id", "key", "span")
        .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"))
        .filter(F.col("end") - F.col("start") >= least_bytes)
    )
    return spans.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def cut_spans(docs: DataFrame, spans: DataFrame, digest: bool = False) -> DataFrame:
    """``docs`` without the spans: text, n_bytes, n_removed, n_spans.

    With ``digest`` the text is replaced by kept_sha256, of the kept bytes.
    Otherwise characters that lost a byte go whole. Null texts stay null.
    """
    names = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept_sha256")]
    keyed = docs.select(*names, text_key().alias("__key"))
    found = spans.withColumnsRenamed({"doc_id": "__doc", "key": "__doc_key", "spans": "__spans"})
    joined = keyed.join(
        found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key")), "left"
    ).drop("__doc", "__doc_key", "__key")
    gone = F.coalesce(F.aggregate("__spans", F.lit(0), lambda a, s: a + s["end"] - s.start), F.lit(0))
    counted = joined.withColumns({
        "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
        "n_removed": gone.cast("long"),
        "n_spans": F.coalesce(F.size("__spans"), F.lit(0)).cast("long"),
    })
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    if digest:
        # Only texts that lose something are taken apart.
        same = F.sha2(raw, 256)
        starts = F.concat(F.array(F.lit(0)), F.col("__spans.end"))
        ends = F.concat(F.col("__spans.start"), F.array(F.octet_length("text")))
        kept = F.array_join(F.zip_with(starts, ends, lambda s, e: F.hex(F.substr(raw, s + 1, e - s))), "")
        return counted.withColumn(
            "kept_sha256", F.when(F.col("n_spans") == 0, same).otherwise(F.sha2(F.unhex(kept), 256))
        ).drop("text", "__spans")

    def cut(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        out = []
        for text, found in zip(texts, batch.column(batch.schema.get_field_index("__spans")).to_pylist()):
            if text is not None and found:
                raw, at, kept = text.encode(), 0, []
                for span in found:
                    kept.append(raw[at : span["start"]].decode("utf-8", "ignore"))
                    at = span["end"]
                text = "".join([*kept, raw[at:].decode("utf-8", "ignore")])
            out.append(text)
        return {"text": out}

    return append(counted, "text string", cut).select(*names, "n_bytes", "n_removed", "n_spans")


def dedup(docs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``docs`` with the repeated spans cut out of the texts; see ``repeated_spans``."""
    return cut_spans(docs, repeated_spans(docs, least_bytes))


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_spans(docs, repeated_spans(docs), digest=True).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
