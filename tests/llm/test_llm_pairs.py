"""Near-duplicates by registers, spelling variants and vector codes against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registrar.llm import codes, groups, registers, spelling
from registrar.llm.common import ensure_checkpoint_dir
from test_llm_operators import LOWER, SCHEMA, prose, texts

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    ensure_checkpoint_dir(spark)
    rows = [(i, t, "en", "own", "own", "own", "own", "own") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# Near-duplicates by registers.

def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def components_truth(rows, least=85):
    """Size and component of each row, from all pairs of different texts."""
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, []).append(i)
    many = [(t, shingles(t)) for t in by_text]
    top = list(range(len(many)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (_, a) in enumerate(many):
        for j in range(i):
            b = many[j][1]
            shared = len(a & b)
            if shared and 100 * shared >= least * (len(a) + len(b) - shared):
                top[find(i)] = find(j)
    ids = {}
    for i, (t, s) in enumerate(many):
        if s:
            ids.setdefault(find(i), []).extend(by_text[t])
    out = []
    for i, (t, s) in enumerate(many):
        for doc in by_text[t]:
            known = [x for x in ids[find(i)] if x is not None] if s else [doc]
            least_id = min(known) if known else None
            out.append((doc, len(s), least_id, doc == least_id))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows_in_group", [512, 3])
def test_registers_equal_brute_force(spark, docs, none, monkeypatch, rows_in_group):
    monkeypatch.setattr(groups, "GROUP_ROWS", rows_in_group)
    draw = random.Random(4)
    base = prose(60, 140).split(" ")
    rows = list(texts())
    for i in range(100, 160):
        words = list(base)
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(3)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + k, " ".join(base[: 100 + k])) for k in range(0, 40, 4)]  # a chain of links
    rows += [(300, "a b"), (301, "A  B\n"), (302, "b a"), (303, "one"), (5, "another text of the same doc_id")]
    rows += [(400 + k, " ".join(f"t{x}" for x in range(13) if x != k)) for k in range(3)]
    got = registers.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert found(got) == components_truth(rows)
    assert registers.near_duplicates(none).count() == 0
    kept = registers.keep_one(docs)
    assert kept.columns == docs.columns and {r.node for r in kept.collect()} == {"own"}
    truth = components_truth(texts())
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _, _, keep in truth if keep)


def test_registers_of_many_variants_at_the_threshold(spark, monkeypatch):
    """A group of 900 variants of one text, of which about half are links: no link may be lost that joins two components."""
    monkeypatch.setattr(groups, "GROUP_ROWS", 128)
    ensure_checkpoint_dir(spark)
    draw = random.Random(12)
    rows = []
    for i in range(900):
        words = [f"b{k}" for k in range(300)]
        for at in draw.sample(range(0, 300, 3), draw.choice([3, 9, 10])):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    assert found(registers.near_duplicates(spark.createDataFrame(rows, DOCS))) == components_truth(rows)


def test_registers_and_their_estimate():
    draw = np.random.default_rng(1)
    assert registers.registers(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2).tolist() == [[0xFFFF] * 128] * 2
    one = registers.registers(np.array([(5 << 57) | (0b101 << 40)], np.uint64), np.zeros(1, np.int64), 1)[0]
    assert one[5] == (14 << 10) | (0b0100000000) and (np.delete(one, 5) == 0xFFFF).all()  # 14 zeros, a one, then 01 and zeros
    for size, other, shared in [(2000, 2000, 1800), (40, 44, 38), (100_000, 50_000, 50_000)]:
        guesses, links = [], []
        for _ in range(60 if size < 10_000 else 4):
            pool = np.unique(draw.integers(0, 2**64, size + other, dtype=np.uint64))
            draw.shuffle(pool)
            a, b = np.sort(pool[:size]), np.sort(pool[size - shared : size - shared + other])
            ra, rb = (registers.registers(x, np.zeros(len(x), np.int64), 1) for x in (a, b))
            used = ((ra != 0xFFFF) | (rb != 0xFFFF)).sum()
            chance = registers.chance(np.array([size]), np.array([other]))[0]
            guesses.append((((ra == rb) & (ra != 0xFFFF)).sum() / used - chance) / (1 - chance))
            links.append(registers.may_link(ra[0], size, rb, np.array([other]))[0])
        true = shared / (size + other - shared)
        assert abs(np.mean(guesses) - true) < 0.06
        assert true < 0.85 or all(links)
    apart = [registers.registers(np.sort(draw.integers(0, 2**64, 20_000, dtype=np.uint64)), np.zeros(20_000, np.int64), 1) for _ in range(300)]
    same = np.mean([(a == b).mean() for a, b in zip(apart, apart[1:])])
    assert abs(same - registers.chance(np.array([20_000]), np.array([20_000]))[0]) < 5e-4


def test_empty_registers_are_filled_alike():
    a = registers.registers(np.sort(np.arange(1, 8, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.zeros(7, np.int64), 1)
    full = registers.filled(a)
    assert (full != 0xFFFF).all() and set(full[0]) == set(a[0]) - {0xFFFF}
    assert (registers.filled(np.full((1, 128), 0xFFFF, np.uint16)) == 0xFFFF).all()


# Spelling variants.

def counted_truth(rows):
    total = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] = total.get(run, 0) + 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_truth(rows, ratio=10):
    n = counted_truth(rows)
    out = {}
    for w in n:
        near = sorted((x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)), key=lambda x: (-n[x], x))
        out[w] = (near[0] if near and n[near[0]] >= ratio * n[w] else None, len(near))
    rows = []
    for w, (form, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n[w], n_near, n[form] if form else None))
    return sorted(rows)


def typed():
    draw = random.Random(8)
    stems = ["".join(draw.choices("abcdeé", k=draw.randint(6, 9))) for _ in range(60)]
    stems += ["listens", "silents", "enlists", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Aaaaaab", "ÉÀaaaaa", "éàaaaaa", "×÷abcde"]
    rows = list(texts())
    for i in range(60):
        some = []
        for w in draw.choices(stems, k=80):
            if draw.random() < 0.25:
                at = draw.randrange(len(w))
                w = w[:at] + draw.choice(["", "a", "é", w[at] + "b"]) + w[at + 1 :]
            some.append(w)
        rows.append((1000 + i, draw.choice([" ", ", ", "\n"]).join(some)))
    rows += [(3000 + i, "commonword " * 40 + "commonwort " * 3) for i in range(4)] + [(4000, "commonwortt commonwortt"), (4001, "z" * 600_000), (4002, "z" * 600_000)]
    return rows


@pytest.mark.parametrize("cell, sample, letters", [(20_000, 65_536, 32_000_000), (8, 65_536, 32_000_000), (8, 60, 32_000_000), (3, 1, 50)])
def test_variants_equal_brute_force(spark, monkeypatch, cell, sample, letters):
    """One cell for each length; many; planes from a few words; cells cut into blocks."""
    ensure_checkpoint_dir(spark)
    monkeypatch.setattr(spelling, "BLOCK_LETTERS", letters)
    rows = [(i, t) for i, t in typed() if cell == 20_000 or len(t or "") < 500_000]
    got = spelling.variants(spark.createDataFrame(rows, DOCS).repartition(3), cell=cell, sample=sample).collect()
    truth = variants_truth(rows)
    assert sorted(tuple(r) for r in got) == truth
    assert ("commonwortt", "commonwort", "commonword") not in {t[:3] for t in truth} or len(truth) > 100


def test_roots_follow_chains_and_ties(spark, none):
    ensure_checkpoint_dir(spark)
    rows = [(i, "aaaaaaab " * 2) for i in range(1)] + [(7, "aaaaaabb " * 25), (8, "aaaaabbb " * 300), (9, "aaaacaab " * 25)]
    got = sorted(tuple(r) for r in spelling.variants(spark.createDataFrame(rows, DOCS)).collect())
    assert got == variants_truth(rows)
    assert {r[0]: r[2] for r in got}["aaaaaaab"] == "aaaaabbb"
    assert spelling.variants(none).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, ""), (3, "short words")], DOCS)).count() == 0


def test_words_of_very_long_texts_are_whole():
    total = {}
    spelling.count_words(5, ("abcdefgh " * 100_000 + "éèêëéèêë" * 90_000).encode(), total)
    assert sum(n for w, n in total.items() if len(w) < 20) == 100_000 and any(len(w) >= 719_999 for w in total)


def test_kd_tree_search_finds_all_in_reach():
    draw = np.random.default_rng(3)
    points = draw.integers(0, 3, (700, 32), dtype=np.uint8) * (draw.random((700, 32)) < 0.2)
    points = points.astype(np.uint8)
    tree = spelling.KdTree(points, 8, tight=True)
    assert sorted(tree.order.tolist()) == list(range(700))
    assert all(b - a <= 8 or len(np.unique(points[tree.order[a:b]], axis=0)) == 1 for a, b in tree.ranges)
    reached = {(int(q), int(p)) for leaf, at in tree.search(points, 1, 1) for q in at for p in tree.order[slice(*tree.ranges[leaf])]}
    up = np.maximum(points[None].astype(int) - points[:, None], 0).sum(2)
    assert {(int(q), int(p)) for q, p in zip(*np.nonzero((up <= 1) & (up.T <= 1)))} <= reached
    assert len(reached) < 700 * 700 / 4


# Vector codes.

def codes_truth(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    points = np.array([[int(np.floor(x * 1024)) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept], object)
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    out = [["", 0] for _ in kept]
    digest = []
    for p in range(parts):
        mine = points[:, p * width : (p + 1) * width]
        book = [list(mine[r]) for r in first]
        for step in range(rounds + 1):
            at = [min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)) for x in mine]
            if step < rounds:
                for k in range(len(book)):
                    of = [x for x, (_, e) in zip(mine, at) if e == k]
                    if of:
                        book[k] = [sum(c) // len(of) for c in zip(*of)]
        for row, (error, e) in zip(out, at):
            row[0] += f"{e:02x}"
            row[1] += error
        digest += [str(x) for e in book for x in e]
    return sorted(((i, *o, label) for (i, _, label), o in zip(kept, out)), key=str), hashlib.sha256(",".join(digest).encode()).hexdigest()


def made_vectors(n, width, seed):
    draw = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in draw.normal(0, 0.3, width)], int(draw.integers(3))) for i in draw.permutation(n)]
    rows += [(n + k, rows[3][1], None) for k in range(n // 3)]  # one very common vector
    rows += [(None, rows[5][1], 1), (4, rows[6][1], 2), (rows[7][0], rows[7][1], rows[7][2])]
    rows += [(5000, None, 1), (5001, [1.0, None] * (width // 2), 1), (5002, [float("nan")] * width, 1), (5003, [float("inf")] * width, None)]
    return rows


@pytest.mark.parametrize("n, width, entries, block", [(300, 16, 256, 4096), (150, 8, 7, 40), (60, 6, 256, 16)])
def test_codes_equal_brute_force(spark, n, width, entries, block):
    ensure_checkpoint_dir(spark)
    rows = made_vectors(n, width, n)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("own")).repartition(3)
    got, books = codes.compress(df, entries=entries, block=block)
    expected, digest = codes_truth(rows, entries=entries)
    assert sorted(((r.vec_id, r.code, r.error, r.label) for r in got.collect()), key=str) == expected
    assert codes.digest(books) == digest
    assert got.columns == ["vec_id", "label", "code", "error"]


def test_codes_of_odd_tables(spark):
    ensure_checkpoint_dir(spark)
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1)]):
        got, books = codes.compress(spark.createDataFrame(rows, schema))
        assert got.count() == 0 and codes.digest(books) == hashlib.sha256(b"").hexdigest()
    rows = [(1, [], 1), (2, [1.0, 2.0, 3.0], None), (3, [3e38, -3e38], 1)]
    got = {r.vec_id: (r.code, r.error) for r in codes.compress(spark.createDataFrame(rows, schema))[0].collect()}
    assert got == {1: ("00000000", 0), 2: ("01010100", 0), 3: ("02020000", 0)}
    assert codes.decompress("01010100", codes.compress(spark.createDataFrame(rows[:2], schema))[1]).tolist() == [1.0, 2.0, 3.0, 0.0]


def test_balls_hold_their_points_and_whole_balls_are_owned():
    draw = np.random.default_rng(7)
    near = np.concatenate([draw.integers(-9, 9, (500, 6)) + centre for centre in draw.integers(-5000, 5000, (8, 6))])
    for points in (near, near[:1], np.zeros((300, 4), np.int64), np.zeros((9, 0), np.int64)):
        tree = codes.Balls.unpacked(codes.Balls.grow(points).packed(), points.shape[1])
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        for a, b, c, r, s in zip(tree.start, tree.stop, tree.centre, tree.radius, tree.sums):
            mine = points[tree.order[a:b]]
            assert (mine.sum(0) == s).all() and np.sqrt(((mine - c) ** 2).sum(1)).max() <= r + 1e-6
        entries = points[:: max(1, len(points) // 40)]
        at, sums, counts, whole = tree.nearest(points, entries)
        away = ((points[:, None, :] - entries[None]) ** 2).sum(2)
        assert (at == away.argmin(1)).all() and counts.sum() == len(points) and (sums.sum(0) == points.sum(0)).all()
        assert whole or len(points) == len(near)
    clusters = near[::500]
    assert codes.Balls.grow(near).nearest(near, clusters)[3] < 60  # nearly all points are assigned with their ball


def test_scaled_rounds_down():
    made = codes.scaled(pa.array([[0.5, -0.0001], [], [1.0, 2.0, 3.0]], pa.list_(pa.float64())), 4)
    assert made.tolist() == [[512, -1, 0, 0], [0, 0, 0, 0], [1024, 2048, 3072, 0]]
