"""Benchmark decontamination: benchmark word windows looked up in document word windows."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.llm.common import Words, append, cut_lineage, put_back, raw_text, runs, set_aside, sha256, text_key

WINDOW = 13
#: Broadcast at most so many benchmark windows (some 200 bytes each); more are joined by shuffle.
BROADCAST_WINDOWS = 200_000

FIELDS = (
    "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean,"
    " items array<string>, hit_spans array<struct<start:int,end:int>>"
)
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``docs`` with the benchmark hits of each row.

    A word is lower-case text between ASCII non-alphanumerics. A window is
    ``n`` consecutive words of an item; an item of fewer words is one window.
    Added columns: words, words inside any occurrence of a window, items with
    occurring windows (count, ids, digest of the ids sorted and joined by
    commas), ``contaminated`` (at least one word in twenty is hit) and the byte
    spans of the hit words. Columns of these names are replaced.

    Null and empty texts have no words and no hits; null or wordless items
    have no windows; repeated items count once per id; items with a null id
    are left out; an empty benchmark hits nothing. Rows that repeat a doc_id
    are looked at one by one.

    The windows are broadcast as a hash set while there are at most
    ``broadcast_windows`` of them, which is counted first; beyond that they are
    joined by their hash.
    """
    windows = _windows(benchmark, n)
    if windows.limit(broadcast_windows + 1).count() > broadcast_windows:
        return _scan_by_join(docs, cut_lineage(windows), n)
    items: dict[bytes, list[str]] = defaultdict(list)
    for row in windows.collect():
        items[row.window.encode()].append(row.item_id)
    return _append_hits(docs, _Lookup(items))


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or without the hit spans.

    ``action`` is ``documents`` (contaminated rows go, others stay as they
    are) or ``spans`` (all rows stay; the bytes of each run of hit words go).
    """
    added = T._parse_datatype_string(FIELDS).names
    found = scan(set_aside(docs, added), benchmark)
    if action == "documents":
        return put_back(found.filter(~F.col("contaminated")), docs.columns)
    if action != "spans":
        raise ValueError(f"unknown action {action!r}")

    def cut(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        spans = batch.column(batch.schema.get_field_index("hit_spans")).to_pylist()
        out = []
        for text, gone in zip(texts, spans):
            if text is not None and gone:
                raw, at, kept = text.encode(), 0, []
                for span in gone:
                    kept.append(raw[at : span["start"]])
                    at = span["end"]
                text = b"".join([*kept, raw[at:]]).decode()
            out.append(text)
        return {"text": out}

    return put_back(append(found, "text string", cut), docs.columns)


def _windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct (item_id, window, number of words) rows."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = benchmark.filter("item_id IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"),
        F.regexp_extract_all(lower, F.lit(f"({_WORDS})"), F.lit(1)).alias("words"),
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.array_join(F.slice("words", F.col("at"), F.lit(n)), " ").alias("window"))
        .distinct()
    )


class _Lookup:
    """The broadcast set: window texts with their items, and hashes by window length."""

    def __init__(self, items: dict[bytes, list[str]]):
        self.items = dict(items)
        by_length: dict[int, list[bytes]] = defaultdict(list)
        for window in items:
            by_length[window.count(b" ") + 1].append(window)
        self.hashes = {}
        for length, windows in sorted(by_length.items()):
            data = np.frombuffer(b"\n".join(windows), np.uint8)
            sizes = np.array([len(w) for w in windows])
            offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
            offsets[-1] -= 1
            found = np.unique(Words(data, offsets).windows(length)[1])
            maybe = np.zeros(1 << 16, bool)
            maybe[(found & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.hashes[length] = (found, maybe)

    def hits(self, words: Words) -> list[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each verified occurrence."""
        out = []
        for length, (hashes, maybe) in self.hashes.items():
            at, h = words.windows(length)
            some = maybe[(h & np.uint64(0xFFFF)).astype(np.int64)]
            at, h = at[some], h[some]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for start in at[hashes[place] == h].tolist():
                items = self.items.get(words.text(start, start + length))
                if items is not None:
                    out.append((start, length, items))
        return out


def _append_hits(docs: DataFrame, lookup: _Lookup) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        words = Words(*raw_text(batch.column(batch.schema.get_field_index("text"))))
        _, offsets = raw_text(batch.column(batch.schema.get_field_index("text")))
        hits = [(start, length, items) for start, length, items in shared.value.hits(words)]
        return summary(words, offsets, hits)

    return append(docs, FIELDS, work)


def summary(
    words: Words, offsets: np.ndarray, hits: list[tuple[int, int, list[str]]]
) -> dict[str, object]:
    """The result columns of a block of texts from its verified occurrences."""
    n_docs = len(offsets) - 1
    edge = np.zeros(len(words.starts) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(n_docs)]
    if hits:
        starts = np.array([h[0] for h in hits])
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + np.array([h[1] for h in hits]), -1)
        for doc, (_, _, found) in zip(np.searchsorted(words.first, starts, side="right") - 1, hits):
            items[doc].update(found)
    hit = np.cumsum(edge[:-1]) > 0
    counted = np.concatenate(([0], np.cumsum(hit)))
    n_words = np.diff(words.first)
    n_hit = counted[words.first[1:]] - counted[words.first[:-1]]
    spans: list[list[dict[str, int]]] = [[] for _ in range(n_docs)]
    for doc in np.flatnonzero(n_hit):
        first, last = words.first[doc], words.first[doc + 1]
        for s, e in zip(*runs(hit[first:last])):
            spans[doc].append({
                "start": int(words.starts[first + s] - offsets[doc]),
                "end": int(words.ends[first + e - 1] - offsets[doc]),
            })
    ordered = [sorted(x) for x in items]
    return {
        "n_words": n_words.astype(np.int64),
        "n_hit": n_hit.astype(np.int64),
        "n_items": [len(x) for x in ordered],
        "items_sha256": [sha256(",".join(x).encode()) for x in ordered],
        "contaminated": (n_hit > 0) & (20 * n_hit >= n_words),
        "items": ordered,
        "hit_spans": spans,
    }


def _scan_by_join(docs: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """For a benchmark of any size: windows of both sides meet by their text's digest.

    Adaptive execution splits a window that very many documents hold. The hits
    of one document then come back to its row.
    """
    sized = windows.withColumn("length", F.size(F.split("window", " ")))
    lengths = [r.length for r in sized.select("length").distinct().collect()]  # at most n values

    def explode(batches):
        for batch in batches:
            words = Words(*raw_text(batch.column(2)))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
            for length in lengths:
                at, _ = words.windows(length)
                if len(at):
                    rows = pa.array(doc[at])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array((at - words.first[doc[at]]).astype(np.int32)),
                            pa.array(np.full(len(at), length, np.int32)),
                            pa.array([words.text(s, s + length).decode() for s in at.tolist()]),
                        ],
                        names=["doc_id", "__key", "at", "length", "window"],
                    )

    keyed = docs.withColumn("__key", text_key())
    kind = docs.schema["doc_id"].dataType.simpleString()
    spread = keyed.select("doc_id", "__key", "text").mapInArrow(
        explode, f"doc_id {kind}, __key long, at int, length int, window string"
    )
    found = (
        spread.withColumn("digest", F.sha2("window", 256)).drop("window")
        .join(sized.select(F.sha2("window", 256).alias("digest"), "item_id"), "digest")
        .groupBy("doc_id", "__key")
        .agg(F.collect_set(F.struct("at", "length", "item_id")).alias("__hits"))
        .withColumnsRenamed({"doc_id": "__doc", "__key": "__doc_key"})
    )
    joined = keyed.join(
        found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__doc_key")), "left"
    )

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        data, offsets = raw_text(batch.column(batch.schema.get_field_index("text")))
        words = Words(data, offsets)
        hits = [
            (int(words.first[doc]) + h["at"], h["length"], [h["item_id"]])
            for doc, found in enumerate(batch.column(batch.schema.get_field_index("__hits")).to_pylist())
            for h in found or ()
        ]
        return summary(words, offsets, hits)

    return append(joined, FIELDS, work).drop("__key", "__doc", "__doc_key", "__hits")


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH item AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark WHERE item_id IS NOT NULL
), gram AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(list_slice(words, pos, pos + 12), ' ') AS w
    FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS pos
          FROM item WHERE len(words) > 0)
), doc AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), spread AS (
    SELECT doc_id, n, pos, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS w
    FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS pos
          FROM doc, (SELECT DISTINCT n FROM gram))
), hit AS (
    SELECT doc_id, item_id, pos, spread.n FROM spread JOIN gram ON spread.w = gram.w AND spread.n = gram.n
), place AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(pos, pos + n - 1)) AS p FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(words), 0) AS contaminated
FROM doc LEFT JOIN place USING (doc_id) LEFT JOIN named USING (doc_id)
"""
