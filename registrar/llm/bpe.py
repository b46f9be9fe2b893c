"""Byte-level BPE encoding with content-defined chunk reuse, and decoding."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import append, blocks, ranges, raw_text, sha256

#: A chunk ends where a rolling hash of 32 bytes has so many low zero bits: 1 KiB on average.
CUT_BITS = 10
#: No chunk is longer; one that would be is cut here.
MAX_CHUNK = 16_384
#: So many shared chunks at most are encoded ahead and broadcast (of 1 KiB on average, 16 KiB at
#: most). It bounds memory, not results: any other chunk is encoded where it stands.
DICTIONARY_CHUNKS = 4_096
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encode(docs: DataFrame, path: str | None = None, dictionary_chunks: int = DICTIONARY_CHUNKS) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``n_tokens long``: token ids of the whole text.

    ``path`` is a byte-level BPE tokenizer file (JSON of the tokenizers library,
    no normalizer, pattern splitting on) that every executor can open; by default
    the installed public 50k vocabulary. The ids are those of that library's
    ``encode(text, add_special_tokens=False)``; strings of special tokens in a
    text become their ids, as there.

    Texts are cut at content-defined places. A chunk that stands in several
    places is encoded once: the most repeated ones, by bytes saved, are found
    with one count over all chunks, encoded ahead and broadcast. Where a cut
    may have split a token, the stretch between the two nearest sure
    boundaries is encoded again and put in place of what stood there.

    Null and empty texts give no ids. Rows that repeat are encoded alike.
    """
    return _with_codec(docs, path, dictionary_chunks, "ids array<int>, n_tokens long", lambda codec, texts: {
        "ids": (ids := [x.astype(np.int32) for x in texts]),
        "n_tokens": [len(x) for x in ids],
    })


def decode(frame: DataFrame, path: str | None = None) -> DataFrame:
    """``frame`` with ``decoded string`` from its ``ids``; bytes that are not UTF-8 become U+FFFD.

    Null ids give an empty text, like no ids.
    """
    def work(batch: pa.RecordBatch) -> dict[str, object]:
        codec = Codec.load(path)
        ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
        return {"decoded": [codec.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in ids]}

    return append(frame.withColumn("text", F.lit("")) if "text" not in frame.columns else frame, "decoded string", work)


def round_trip(
    docs: DataFrame, path: str | None = None, dictionary_chunks: int = DICTIONARY_CHUNKS, ids: bool = False
) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (ids as little-endian 32-bit) and decoded_sha256; with ``ids`` also the ids.

    Encodes and decodes each whole text in one pass, so that the ids need not
    leave the task. Null and empty texts as in ``encode``.
    """
    def fields(codec: Codec, texts: list[np.ndarray]) -> dict[str, object]:
        return ({"ids": [x.astype(np.int32) for x in texts]} if ids else {}) | {
            "n_tokens": [len(x) for x in texts],
            "ids_sha256": [sha256(x.astype("<u4").tobytes()) for x in texts],
            "decoded_sha256": [
                sha256(codec.decode(x).decode("utf-8", "replace").encode()) for x in texts
            ],
        }

    return _with_codec(
        docs, path, dictionary_chunks,
        "ids array<int>, " * ids + "n_tokens long, ids_sha256 string, decoded_sha256 string", fields,
    )


class Codec:
    """A vocabulary with its encoder; loaded once in each Python worker."""

    _loaded: dict[str | None, Codec] = {}

    def __init__(self, path: str):
        import tiktoken

        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        if spec["normalizer"] or model["type"] != "BPE" or not _is_byte_level(spec["pre_tokenizer"]):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        letters = _byte_letters()
        tokens = {
            bytes(letters[c] for c in token): i
            for token, i in model["vocab"].items()
            if all(c in letters for c in token)
        }
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        tokens = {t: i for t, i in tokens.items() if i not in special.values()}
        self._check_order(model["merges"], letters, tokens)
        self.encoder = tiktoken.Encoding(
            path, pat_str=_PATTERN, mergeable_ranks=tokens, special_tokens=special
        )
        by_id = {i: t for t, i in tokens.items()} | {i: t.encode() for t, i in special.items()}
        pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.sizes = np.array([len(x) for x in pieces])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    @staticmethod
    def _check_order(merges: list, letters: dict[str, int], tokens: dict[bytes, int]) -> None:
        """Merging by least id is merging by rank only if ids ascend with the ranks."""
        made = [
            tokens[bytes(letters[c] for c in "".join(m.split(" ") if isinstance(m, str) else m))]
            for m in merges
        ]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("token ids do not ascend with the merge ranks")

    @classmethod
    def load(cls, path: str | None) -> Codec:
        if path not in cls._loaded:
            import public_tokenizers

            cls._loaded[path] = cls(path or public_tokenizers.path("byte_bpe_50k.json"))
        return cls._loaded[path]

    def encode(self, text: bytes) -> np.ndarray:
        return self.encoder.encode_to_numpy(text.decode(), allowed_special="all")

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        return self.bytes[ranges(self.starts[ids], sizes)].tobytes()

    def encode_chunks(self, text: memoryview, cuts: np.ndarray, sure: np.ndarray, known: dict) -> np.ndarray:
        """Ids of a whole text from the ids of its chunks.

        ``cuts`` are the chunk edges from 0 to the end; ``sure`` the places
        where a token must end whatever stands around.
        """
        def ids_of(start: int, end: int) -> np.ndarray:
            piece = text[start:end]
            if known:
                found = known.get(xxhash.xxh3_128_digest(piece))
                if found is not None:
                    return found
            return self.encode(bytes(piece))

        edges = cuts.tolist()
        chunks = [(s, e, ids_of(s, e)) for s, e in zip(edges, edges[1:])]
        if len(chunks) == 1:
            return chunks[0][2]
        inner = cuts[1:-1]
        unsure = inner[~np.isin(inner, sure)]
        if not len(unsure):
            return np.concatenate([c[2] for c in chunks])
        # Stretches to encode again: from the sure place before a cut to the one after it.
        bounds = np.concatenate(([0], sure[(sure > 0) & (sure < edges[-1])], [edges[-1]]))
        at = np.searchsorted(bounds, unsure)
        spans: list[list[int]] = []
        for left, right in zip(bounds[at - 1].tolist(), bounds[at].tolist()):
            if spans and left <= spans[-1][1]:
                spans[-1][1] = max(right, spans[-1][1])
            else:
                spans.append([left, right])
        out, done = [], 0
        for left, right in [*spans, [edges[-1], edges[-1]]]:
            out += [self._part(c, done, left) for c in chunks if c[0] < left and c[1] > done]
            if right > left:
                out.append(self.encode(bytes(text[left:right])))
            done = right
        return np.concatenate(out)

    def _part(self, chunk: tuple[int, int, np.ndarray], start: int, end: int) -> np.ndarray:
        """The tokens of a chunk between two places where tokens end."""
        begin, stop, ids = chunk
        if start <= begin and end >= stop:
            return ids
        ends = begin + np.cumsum(self.sizes[ids])
        return ids[np.searchsorted(ends, max(start, begin), side="right") : np.searchsorted(ends, end, side="right")]


def _is_byte_level(spec: dict | None) -> bool:
    return bool(spec) and spec["type"] == "ByteLevel" and spec["use_regex"] and not spec["add_prefix_space"]


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True


def cut_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk edges (text starts among them) and sure token ends, as places in ``data``.

    A sure place has an ASCII white-space character after a visible ASCII one:
    no piece of the split pattern goes across it, and none looks across it. A
    chunk ends at the first sure place within 64 bytes after a hit of the
    rolling hash, or else at the next character, so that a cut depends on the
    bytes nearby alone and moves with them.
    """
    sure = np.flatnonzero(_SOLID[data[:-1]] & _SPACE[data[1:]]) + 1
    h = data.astype(np.uint32) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    width, factor = 1, 0x85EBCA6B
    while width < 32 and len(h) > width:
        h = h[:-width] * np.uint32(factor) + h[width:]
        width, factor = width * 2, factor * factor & 0xFFFFFFFF
    h ^= h >> np.uint32(16)
    hits = np.flatnonzero((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - CUT_BITS) == 0) + width
    places = np.append(sure, len(data))
    after = places[np.minimum(np.searchsorted(places, hits), len(places) - 1)]
    near = after - hits <= 64
    plain = hits[~near]
    for _ in range(3):  # to the start of a character
        inside = (plain < len(data)) & ((data[np.minimum(plain, len(data) - 1)] & 0xC0) == 0x80)
        plain = plain + inside
    cuts = np.unique(np.concatenate((after[near], plain, offsets)))
    cuts = cuts[cuts <= len(data)]
    long = np.flatnonzero(np.diff(cuts) > MAX_CHUNK)
    if len(long):
        more = []
        for start, end in zip(cuts[long].tolist(), cuts[long + 1].tolist()):
            for at in range(start + MAX_CHUNK, end, MAX_CHUNK):
                while at < end and data[at] & 0xC0 == 0x80:
                    at += 1
                more.append(at)
        cuts = np.unique(np.concatenate((cuts, more)))
    return cuts, sure


def _texts(batch: pa.RecordBatch):
    """Of each text: its bytes, chunk edges and sure places, counted from its start."""
    data, offsets = raw_text(batch.column(batch.schema.get_field_index("text")))
    cuts, sure = cut_places(data, offsets) if len(data) else (offsets, offsets[:0])
    view = memoryview(data)
    for start, end in zip(offsets.tolist(), offsets[1:].tolist()):
        first, last = np.searchsorted(cuts, (start, end))
        low, high = np.searchsorted(sure, (start + 1, end))
        yield view[start:end], cuts[first : last + 1] - start, sure[low:high] - start


def _with_codec(docs: DataFrame, path, dictionary_chunks: int, fields: str, finish) -> DataFrame:
    spark = docs.sparkSession
    texts = _shared_chunks(docs.select("text"), dictionary_chunks) if dictionary_chunks else []
    codec = Codec.load(path) if texts else None
    known = spark.sparkContext.broadcast({xxhash.xxh3_128_digest(t): codec.encode(t) for t in texts})
    none = np.zeros(0, np.uint32)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        codec = Codec.load(path)
        return finish(codec, [
            codec.encode_chunks(text, cuts, sure, known.value) if len(text) else none
            for text, cuts, sure in _texts(batch)
        ])

    return append(docs, fields, work)


def _shared_chunks(texts: DataFrame, most: int) -> list[bytes]:
    """The chunks that save most bytes if they are encoded once: at most ``most`` of them."""

    def chunks(batches):
        for whole in batches:
            for batch in blocks(whole):
                rows = [
                    (xxhash.xxh3_128_digest(text[s:e]), e - s)
                    for text, cuts, _ in _texts(batch)
                    if len(text)
                    for s, e in zip(cuts.tolist(), cuts[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())],
                    names=["digest", "size"],
                )

    counted = (
        texts.mapInArrow(chunks, "digest binary, size int").groupBy("digest", "size").count().filter("count > 1")
    )
    best = counted.orderBy(F.expr("(count - 1) * size").desc(), "digest").limit(most).select("digest")
    wanted = {bytes(r.digest) for r in best.collect()}
    if not wanted:
        return []

    def fetch(batches):
        seen: set[bytes] = set()
        for whole in batches:
            for batch in blocks(whole):
                new = {}
                for text, cuts, _ in _texts(batch):
                    for s, e in zip(cuts.tolist(), cuts[1:].tolist()):
                        digest = xxhash.xxh3_128_digest(text[s:e])
                        if digest in wanted and digest not in seen:
                            seen.add(digest)
                            new[digest] = bytes(text[s:e])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(new), pa.binary()), pa.array(list(new.values()), pa.binary())],
                    names=["digest", "chunk"],
                )

    found = texts.mapInArrow(fetch, "digest binary, chunk binary").groupBy("digest").agg(F.min("chunk").alias("chunk"))
    return [bytes(r.chunk) for r in found.collect()]


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
