"""Spelling variant grouping: words one edit apart, found by range searches in k-d trees of letter counts."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import BLOCK_BYTES, blocks, cut_lineage

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: One in so many hashes of (doc_id, run) loses a letter.
TYPO = 31
#: A word's form occurs at least so many times as often.
RATIO = 10
#: Words of a cell of the shared tree, about; a task holds one cell, or a block of it, at a time.
CELL = 20_000
#: Words of the sample from which the planes of the shared tree are taken, about.
SAMPLE = 65_536
#: Most cells whose sizes come to the driver because they need more than one block.
LARGE_CELLS = 10_000
#: Letters of a block, at most about.
BLOCK_LETTERS = 32_000_000
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
#: Points of a leaf of a task's own tree, and queries searched together.
LEAF = 16
TOGETHER = 32_768

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Letter classes (code points modulo 32), and the count at which one stops; both only bring words nearer.
CLASSES = 32
_STOP = 7


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of at least 7 code points and how often they occur; once or more.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z lower-cased; where 31
    divides the crc32 of ``doc_id:run``, the run's code point at that hash modulo its length is deleted.
    A null text has none; a null doc_id counts as an empty one. Repeated rows count each time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for whole in batches:
            for batch in blocks(whole):
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
                for doc_id, text in zip(ids, texts):
                    if text.is_valid:
                        count_words("" if doc_id is None else doc_id, text.as_buffer(), total)
                if len(total) >= COUNTED:
                    yield counted(total)
                    total = {}
        yield counted(total)

    def counted(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def count_words(doc_id: object, raw: object, total: dict[str, int]) -> None:
    """Add the words of one text (UTF-8 bytes) to ``total``, a stretch of about 0.5 MB at a time."""
    lowered = bytes(raw).lower()  # of bytes: A-Z only
    runs: dict[str, int] = {}
    start = 0
    while start < len(lowered):
        end = start + BLOCK_BYTES
        space = lowered.find(b" ", end)  # runs hold no space
        end = len(lowered) if end >= len(lowered) or space < 0 else space
        for run in _RUN.findall(lowered[start:end].decode()):
            if len(run) >= LEAST_LETTERS:
                runs[run] = runs.get(run, 0) + 1
        start = end
    before = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), before)
        if h % TYPO == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        total[run] = total.get(run, 0) + n


def letters(many: list[str]) -> np.ndarray:
    """Code points (all under 256) of words of one length, one row each."""
    return np.frombuffer("".join(many).encode("latin-1"), np.uint8).reshape(len(many), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Counts of each letter class. One edit changes the sum of increases and that of decreases by one at most."""
    rows = len(codes)
    out = np.empty((rows, CLASSES), np.uint8)
    step = max(1, 4_000_000 // max(1, codes.shape[1]))
    for a in range(0, rows, step):
        part = codes[a : a + step]
        key = (part & (CLASSES - 1)).astype(np.int64) + np.arange(len(part))[:, None] * CLASSES
        out[a : a + step] = np.minimum(np.bincount(key.ravel(), minlength=len(part) * CLASSES), _STOP).reshape(-1, CLASSES)
    return out


_ONES = np.uint64(0x0101010101010101)


def bytes_sum(rows: np.ndarray) -> np.ndarray:
    """Sum of the 32 small numbers of each row (they stay under 256 together)."""
    return (rows.view(np.uint64).sum(-1) * _ONES) >> np.uint64(56)


class KdTree:
    """A k-d tree of letter-count vectors; every node has the box that its points are in.

    ``order[start:stop]`` are the points of a leaf, ``leaf`` its number. With ``tight``
    the boxes are those of the points, otherwise those of the planes: for points not in the sample, too.
    """

    def __init__(self, points: np.ndarray, most: int, tight: bool):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[np.ndarray, np.ndarray, int, int]] = []  # box, then both children, or -1 and the leaf
        self.ranges: list[tuple[int, int]] = []
        open_box = np.zeros(CLASSES, np.uint8), np.full(CLASSES, _STOP, np.uint8)
        self._split(points, 0, len(points), most, tight, *open_box)

    def _split(self, points, a, b, most, tight, low, high) -> None:
        todo = [(a, b, low, high, -1, 0)]
        while todo:
            a, b, low, high, parent, which = todo.pop()
            mine = points[self.order[a:b]]
            if tight and b > a:
                low, high = mine.min(0), mine.max(0)
            here = len(self.nodes)
            if parent >= 0:
                box = self.nodes[parent]
                self.nodes[parent] = (*box[:2], here, box[3]) if which == 0 else (*box[:2], box[2], here)
            cut = self._cut(mine) if b - a > most else None
            if cut is None:
                self.nodes.append((low, high, -1, len(self.ranges)))
                self.ranges.append((a, b))
                continue
            letter, value = cut
            goes = mine[:, letter] <= value
            at = self.order[a:b]
            middle = a + int(goes.sum())
            self.order[a:b] = np.concatenate((at[goes], at[~goes]))
            up, down = high.copy(), low.copy()
            up[letter], down[letter] = value, value + 1
            self.nodes.append((low, high, -1, -1))
            todo += [(middle, b, down, high, here, 1), (a, middle, low, up, here, 0)]

    @staticmethod
    def _cut(mine: np.ndarray) -> tuple[int, int] | None:
        """The letter whose counts vary most, and the count next to its median that parts the points."""
        spread = mine.astype(np.float32).var(0)
        letter = int(spread.argmax())
        if spread[letter] == 0:
            return None
        counts = np.cumsum(np.bincount(mine[:, letter]))
        value = int(np.abs(counts[:-1] - len(mine) / 2).argmin())
        lowest = int(mine[:, letter].min())
        return letter, max(value, lowest)

    def search(self, asked: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) of the leaves whose box holds a point with at most ``more`` more and ``fewer`` fewer letters."""
        todo = [(0, np.arange(len(asked)))]
        while todo:
            node, at = todo.pop()
            low, high, left, right = self.nodes[node]
            q = asked[at]
            inside = bytes_sum(np.maximum(q, low) - q) <= more
            inside &= bytes_sum(np.maximum(q, high) - high) <= fewer
            at = at[inside]
            if not len(at):
                continue
            if left < 0:
                yield right, at
            else:
                todo += [(left, at), (right, at)]


def shared_trees(counted: DataFrame, total: int, cell: int = CELL, sample: int = SAMPLE) -> dict[int, KdTree]:
    """For each length with words for more than a cell, the tree whose leaves are the cells.

    The planes come from a sample of about ``sample`` words, by hash; every word and query follows them.
    """
    space = 1 << 30
    share = min(1.0, sample / max(1, total))
    drawn = counted.filter(F.pmod(F.xxhash64("word", F.lit(12)), F.lit(space)) < int(share * space) + (share == 1.0))
    by_length: dict[int, list[str]] = {}
    for r in drawn.select("word").limit(2 * sample).collect():
        by_length.setdefault(len(r.word), []).append(r.word)
    most = max(1, int(cell * share))
    return {n: KdTree(vectors(letters(sorted(w))), most, tight=False) for n, w in sorted(by_length.items()) if len(w) > most}


#: Rows sent to a cell: words of it, words of its length that search it, and words one letter shorter that search it.
_HELD, _SAME, _SHORTER = 0, 1, 2


def _routed(counted: DataFrame, trees: dict[int, KdTree], kinds: tuple[int, ...]) -> DataFrame:
    """Each word sent to its own cell, and to the cells that its searches reach: length, cell, kind, word, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = batch.column("word").to_pylist()
            sizes = np.array([len(w) for w in many])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                v = vectors(letters([many[i] for i in at]))
                for kind in kinds:
                    length = int(size) + (kind == _SHORTER)
                    tree = trees.get(length)
                    if tree is None:
                        found = [(0, np.arange(len(at)))]
                    else:
                        found = tree.search(v, *{_HELD: (0, 0), _SAME: (1, 1), _SHORTER: (1, 0)}[kind])
                    for cell, which in found:
                        rows = batch.take(pa.array(at[which]))
                        fixed = [pa.array(np.full(len(which), x, np.int32)) for x in (length, cell, kind)]
                        yield pa.RecordBatch.from_arrays(
                            [*fixed, rows.column("word"), rows.column("n")], names=["length", "cell", "kind", "word", "n"]
                        )

    return counted.select("word", "n").mapInArrow(run, "length int, cell int, kind int, word string, n long")


def near_words(counted: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, n, n_near, best_n, best) of distinct words: how many words are one edit away, and the most frequent of them.

    One edit is one code point inserted, deleted or replaced. Ties go to the
    word that is first in code-point order. A cell of more words than planes part
    (many words of the same letters, say) is cut into blocks, each of which gets all the cell's queries.
    """
    spark = counted.sparkSession
    total, all_letters = counted.agg(F.count("*"), F.coalesce(F.sum(F.length("word").cast("long")), F.lit(0))).first()
    trees = shared_trees(counted, total, cell, sample)
    most, most_letters = max(2 * cell, total // LARGE_CELLS), max(BLOCK_LETTERS, all_letters // LARGE_CELLS)
    own = _routed(counted, trees, (_HELD,)).withColumn("size", F.length("word").cast("long"))
    sizes = own.groupBy("length", "cell").agg(F.count("*").alias("rows"), F.sum("size").alias("letters"))
    needed = F.ceil(F.greatest(F.col("rows") / most, F.col("letters") / most_letters)).cast("int")
    large = sizes.select("length", "cell", needed.alias("blocks")).filter("blocks > 1")
    parts = {(r["length"], r.cell): r.blocks for r in large.collect()}
    rows = _routed(counted, trees, (_HELD, _SAME, _SHORTER))
    n_blocks = F.lit(1)
    if parts:
        table = F.create_map(*[F.lit(x) for (a, b), n in sorted(parts.items()) for x in (f"{a}/{b}", n)])
        n_blocks = F.coalesce(table[F.concat_ws("/", "length", "cell")], F.lit(1))
    mine = F.pmod(F.xxhash64("word"), n_blocks).cast("int")
    every = F.when(F.col("kind") == _HELD, F.array(mine)).otherwise(F.sequence(F.lit(0), n_blocks - 1))
    rows = rows.withColumn("block", F.explode(every))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["length", "cell", "block"]
    found = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "kind").mapInArrow(
        _search, "word string, n long, n_near long, best_n long, best string"
    )
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best")
    )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups come on end, the words of a cell before those that search it."""
    cell: Cell | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in ("length", "cell", "block", "kind")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            group, kind = tuple(key[:3, a].tolist()), int(key[3, a])
            if cell is None or cell.key != group:
                if cell is not None:
                    yield from cell.close()
                cell = Cell(group)
            part = batch.slice(a, b - a)
            yield from cell.take(kind, part.column("word").to_pylist(), part.column("n").to_pylist())
    if cell is not None:
        yield from cell.close()


class Cell:
    """The words of one block of a cell, a k-d tree of them, and what the searches found."""

    def __init__(self, key: tuple[int, int, int]):
        self.key, self.length = key, key[0]
        self.held: list[str] = []
        self.n: list[int] = []
        self.tree: KdTree | None = None
        self.waiting: dict[int, tuple[list[str], list[int]]] = {_SAME: ([], []), _SHORTER: ([], [])}

    def take(self, kind: int, many: list[str], n: list[int]) -> Iterator[pa.RecordBatch]:
        if kind == _HELD:
            self.held += many
            self.n += n
            return
        self.waiting[kind][0].extend(many)
        self.waiting[kind][1].extend(n)
        if len(self.waiting[kind][0]) >= TOGETHER:
            yield from self.ask(kind)

    def close(self) -> Iterator[pa.RecordBatch]:
        for kind in self.waiting:
            yield from self.ask(kind)
        if self.held:
            self._ready()
            yield self._rows(self.held, self.n, self.n_near, self.best_n, self.best)

    def _ready(self) -> None:
        if self.tree is None:
            self.codes = letters(self.held)
            self.vectors = vectors(self.codes)
            self.tree = KdTree(self.vectors, LEAF, tight=True)
            self.ranks, self.by_rank = ranked(self.held, self.n)
            self.n_near = np.zeros(len(self.held), np.int64)
            self.best_n = [None] * len(self.held)
            self.best = [None] * len(self.held)

    def ask(self, kind: int) -> Iterator[pa.RecordBatch]:
        many, n = self.waiting[kind]
        self.waiting[kind] = ([], [])
        if not many or not self.held:
            return
        self._ready()
        codes = letters(many)
        pairs = [near for near in self._near(codes, vectors(codes), kind)]
        if not pairs:
            return
        asking, found = (np.concatenate(x) for x in zip(*pairs))
        counts = np.bincount(asking, minlength=len(many))
        first = np.full(len(many), len(self.held))
        np.minimum.at(first, asking, self.ranks[found])
        hit = np.flatnonzero(counts)
        best = [int(self.by_rank[i]) for i in first[hit]]
        yield self._rows(
            [many[i] for i in hit], [n[i] for i in hit], counts[hit], [self.n[i] for i in best], [self.held[i] for i in best]
        )
        if kind == _SHORTER:  # the word held has the shorter one near it, too
            self.n_near += np.bincount(found, minlength=len(self.held))
            ranks, by_rank = ranked(many, n)
            first = np.full(len(self.held), len(many))
            np.minimum.at(first, found, ranks[asking])
            for i in np.unique(found).tolist():
                j = int(by_rank[first[i]])
                if self.best[i] is None or (-n[j], many[j]) < (-self.best_n[i], self.best[i]):
                    self.best_n[i], self.best[i] = n[j], many[j]

    def _near(self, codes: np.ndarray, asked: np.ndarray, kind: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, held word) one edit apart."""
        fewer = 1 if kind == _SAME else 0
        for leaf, at in self.tree.search(asked, 1, fewer):
            a, b = self.tree.ranges[leaf]
            mine = self.tree.order[a:b]
            points = self.vectors[mine][None, :, :]
            for c in range(0, len(at), 1024):
                some = at[c : c + 1024]
                q = asked[some][:, None, :]
                top = np.maximum(q, points)
                close = (bytes_sum(top - q) <= 1) & (bytes_sum(top - points) <= fewer)
                i, j = np.nonzero(close)
                if len(i):
                    i, j = some[i], mine[j]
                    right = replaced(codes[i], self.codes[j]) if kind == _SAME else inserted(codes[i], self.codes[j])
                    if right.any():
                        yield i[right], j[right]

    @staticmethod
    def _rows(word, n, n_near, best_n, best) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(word, pa.string()), pa.array(n, pa.int64()), pa.array(n_near, pa.int64()),
             pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
            names=["word", "n", "n_near", "best_n", "best"],
        )


def ranked(many: list[str], n: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each word, the most frequent first, ties in code-point order; and the words by rank."""
    by_rank = np.array(sorted(range(len(many)), key=lambda i: (-n[i], many[i])), np.int64)
    ranks = np.empty(len(many), np.int64)
    ranks[by_rank] = np.arange(len(many))
    return ranks, by_rank


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows that differ in exactly one place."""
    return (a != b).sum(1) == 1


def inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows whose long word is the short one with one letter put in."""
    before = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    after = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return before + after >= short.shape[1]


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of each distinct word that occurs ``least_count`` times or more.

    ``form`` is the most frequent of the word's near words (ties: the first in code-point order), if it is at
    least ``ratio`` times as frequent; ``root`` follows forms to the last. Only doc_id and text are read; a table without words gives no rows.
    """
    counted = cut_lineage(words(docs).filter(F.col("n") >= least_count))
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    known = cut_lineage(near_words(counted, cell, sample).select("word", "n", "n_near", form.alias("form"), "best_n"))
    jumps = cut_lineage(known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    longest = math.log(max(2, counted.agg(F.max("n")).first()[0] or 2), max(2, ratio)) + 1  # forms grow by the ratio
    for _ in range(math.ceil(math.log2(longest + 1))):
        further = jumps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumps = jumps.join(further, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"))
    return known.join(jumps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    return variants(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i)
), run AS (
    SELECT doc_id, w, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w
        FROM documents) AS every WHERE length(w) >= {LEAST_LETTERS} GROUP BY ALL
), hashed AS (
    SELECT w, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        flatten(list_transform(string_split(concat(doc_id, ':', w), ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::BIGINT[] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM run, crc
), word AS MATERIALIZED (
    SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % {TYPO} = 0 THEN concat(left(w, CAST(h % length(w) AS BIGINT)), substr(w, CAST(h % length(w) AS BIGINT) + 2)) ELSE w END AS w, n FROM hashed
    ) AS typed WHERE length(w) >= {LEAST_LETTERS} GROUP BY w HAVING sum(n) >= {LEAST_COUNT}
), place AS (
    SELECT w, n, unnest(generate_series(1, length(w))) AS i FROM word
), cut AS (
    SELECT w, n, i, concat(left(w, i - 1), substr(w, i + 1)) AS rest FROM place
), shorter AS (
    SELECT DISTINCT cut.w AS a, word.w AS b FROM cut JOIN word ON word.w = cut.rest
), near AS (
    SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter
    UNION ALL SELECT x.w, y.w FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.w <> y.w
), best AS MATERIALIZED (
    SELECT a AS w, b, n, rank() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS place, count(*) OVER (PARTITION BY a) AS n_near
    FROM near JOIN word ON word.w = b
), form AS MATERIALIZED (
    SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= {RATIO} * word.n THEN b END AS form,
           CASE WHEN best.n >= {RATIO} * word.n THEN best.n END AS form_n
    FROM word LEFT JOIN best ON best.w = word.w AND place = 1
), walk AS (
    SELECT w, w AS here, 0 AS step FROM form
    UNION ALL
    SELECT walk.w, form.form, step + 1 FROM walk JOIN form ON form.w = walk.here WHERE form.form IS NOT NULL
), last AS (
    SELECT w, max_by(here, step) AS root FROM walk GROUP BY w
)
SELECT form.w AS word, form, root, n, n_near, form_n FROM form JOIN last ON last.w = form.w
"""
