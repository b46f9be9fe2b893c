"""Each operator against a brute-force version, with nulls, empty, long, tied and repeated texts."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from registrar.llm import bpe, chunks, decontaminate, groups, jaccard, langid, licenses, quality, rules, suffixes, urls
from registrar.llm.common import ensure_checkpoint_dir

SCHEMA = "doc_id long, text string, lang string, score string, spans string, node string, n_words string, items string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n):
    draw = random.Random(seed)
    parts = ["an", "er", "über", "ción", "the", "of", "que", "ñ", "Éa", "st", "x9"]
    words = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n)]
    return " ".join(w + draw.choice(["", "", "", ".", ",", ".\n"]) for w in words)


def texts():
    base = prose(1, 120)
    words = base.split(" ")
    passage = prose(2, 60)
    return [
        (0, base),
        (1, " ".join([*words[:50], "changed", *words[51:]])),
        (2, base),
        (3, None),
        (4, ""),
        (5, prose(3, 9000) + " " + passage + " " + prose(4, 9000)),
        (6, "Start <|endoftext|> " + passage + "\n\n  two  spaces here 🙂🙂 it's we'll 12345 "),
        (7, "一二三四五六七八九十" * 400 + "x" * 700),
        (8, "ab " * 900),
        (9, "one two three"),
        (10, "?!..."),
        (2, base),
        (11, None),
        (None, passage + " " + prose(5, 40)),
        (12, prose(6, 30) + "\n" + passage),
        (13, "Released under the MIT License.\n" + prose(7, 30)),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    ensure_checkpoint_dir(spark)
    rows = [(i, t, "en", "own", "own", "own", "own", "own") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower_words(text):
    return WORD.findall((text or "").translate(LOWER))


# Decontamination.

def hits(text, items, n=13):
    words = lower_words(text)
    hit, found, places = set(), set(), {}
    for item, item_text in items:
        w = lower_words(item_text)
        if item is None or not w:
            continue
        size = min(n, len(w))
        if size not in places:
            places[size] = {}
            for j in range(len(words) - size + 1):
                places[size].setdefault(tuple(words[j : j + size]), []).append(j)
        for i in range(len(w) - size + 1):
            for j in places[size].get(tuple(w[i : i + size]), []):
                hit.update(range(j, j + size))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)


BENCHMARK = [(1, prose(2, 60)), (10, prose(2, 60)), (2, "three"), (3, None), (4, ""), (None, "one"), (5, prose(99, 30)), (2, "three")]


@pytest.mark.parametrize("most", [1000, 3])
def test_decontamination_equals_brute_force(spark, docs, most):
    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 20_000)
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    got = decontaminate.scan(short, benchmark, broadcast_windows=most).collect()
    expected = sorted((str(i), hits(t, BENCHMARK)) for i, t in texts() if len(t or "") < 20_000)
    assert sorted((str(r.doc_id), (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got) == expected


def test_decontamination_keeps_columns_and_cuts_spans(spark, docs, none):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r.n_words for r in rows} == {"own"} and {r["items"] for r in rows} == {"own"}
    gone = {i for i, t in texts()} - {r.doc_id for r in rows}
    assert gone == {None, 6, 9, 12}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, benchmark, "spans").collect()}
    assert cut[9] == "one two " and cut[3] is None
    assert len(cut[5].encode()) < len(dict(texts())[5].encode()) - 200
    assert decontaminate.scan(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.scan(none, benchmark).count() == 0


# BPE.

def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return tokenizer, [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("dictionary", [0, 4096])
def test_bpe_equals_the_tokenizers_library(docs, dictionary):
    got = bpe.round_trip(docs, dictionary_chunks=dictionary, ids=True).collect()
    tokenizer, ids = reference_ids([r.text or "" for r in got])
    for row, expected in zip(got, ids):
        assert row["ids"] == expected and row.n_tokens == len(expected)
        assert row.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        decoded = tokenizer.decode(expected, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_joins_are_repaired_wherever_the_cuts_are(monkeypatch):
    """Chunks of some bytes only, cut in the middle of words, special tokens and white space."""
    codec = bpe.Codec.load(None)
    draw = random.Random(5)
    letters = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ñ", "漢", "🙂", "1", "23", ".", "!!", "<|endoftext|>", "<|", " ", "　", "\x00"]
    many = ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(400)]
    _, expected = reference_ids(many)
    for text, ids in zip(many, expected):
        raw = np.frombuffer(text.encode(), np.uint8)
        _, sure = bpe.cut_places(raw, np.array([0, len(raw)]))
        starts = [i for i in range(1, len(raw)) if raw[i] & 0xC0 != 0x80]
        cuts = sorted({0, len(raw), *draw.sample(starts, min(len(starts), draw.randint(0, 8)))})
        assert codec.encode_chunks(memoryview(raw), np.array(cuts), sure, {}).tolist() == ids, text


def test_encode_then_decode(docs, none):
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert bpe.round_trip(none).count() == 0


# Licences.

def test_licences(docs, none):
    rows = licenses.scan(docs).collect()
    found = {r.doc_id: [x.license for x in r.licenses] for r in rows}
    assert found[13] == ["MIT"] and not any(v for k, v in found.items() if k != 13)
    assert {r.score for r in rows} == {"own"} and licenses.scan(none).count() == 0


def test_licences_of_wrapped_and_standard_texts(spark):
    clause = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the"
              " following conditions are met:\n\n1. Keep this.\n\n")
    third = ("3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote"
             " products derived from\n   this software without specific prior written permission.\n")
    mit = "\n".join(re.findall(r".{1,70}(?: |$)", licenses.MORE["MIT"][0]))
    apache = "Some tool for texts.\nLicensed under the Apache License,\nVersion 2.0.\nMore words follow here, on lines of their own.\n"
    cases = [
        ("MIT License\n\nCopyright (c) 2020 A\n\n" + mit + "\n", ["MIT"]),
        ("Licensed under the MIT License.", ["MIT"]), ("This project is licensed under the MIT License.", ["MIT"]),
        ("x = 1\n# SPDX-License-Identifier: MIT\n", ["MIT"]), ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
        (apache, ["Apache-2.0"]), (clause + third, ["BSD-3-Clause"]), (clause, ["BSD-2-Clause"]),
        (clause + third + "\n" + clause, ["BSD-2-Clause", "BSD-3-Clause"]), (licenses.MORE["ISC"][0], ["ISC"]), (prose(9, 200), []),
    ]
    made = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    assert {r.doc_id: [x.license for x in r.licenses] for r in licenses.scan(made).collect()} == {i: l for i, (_, l) in enumerate(cases)}


def test_licences_of_usual_notices_in_query_and_sql(spark, tmp_path):
    """Notices that differ in a word or a version, wrapped and embedded: the query and its SQL name each right."""
    notice = lambda kind, v, thing="program": (
        f"This {thing} is free software: you can redistribute it and/or modify\nit under the terms of the GNU {kind}General"
        " Public License as\npublished by the Free Software Foundation, either version " + v + " of the\nLicense, or (at your"
        " option) any later version.\n")
    warranty = "\n".join(re.findall(r".{1,60}(?: |$)", licenses.MORE["MIT"][1]))
    cases = [
        (notice("", "2"), "GPL-2.0"), (notice("", "3"), "GPL-3.0"), (notice("Affero ", "3"), "AGPL-3.0"),
        (notice("Lesser ", "2.1", "library"), "LGPL-2.1"), (notice("Lesser ", "3"), "LGPL-3.0"),
        (notice("Library ", "2", "library"), "LGPL-2.0"), (notice("", "2") + "\nfoo\n\n" + notice("Affero ", "3"), "AGPL-3.0,GPL-2.0"),
        ("Words of prose.\n\nThis work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License. More.", "CC-BY-4.0"),
        ("Photo. Licensed under CC BY-NC-SA 3.0. Thanks.", "CC-BY-NC-SA-3.0"), ("Licensed under CC BY 2.0.", ""),
        ("Not released under the MIT License.", ""), ("Released under the MIT License.", "MIT"), ("mit\n\n" + warranty, "MIT"),
        ("# SPDX-License-Identifier: CC-BY-NC-SA-4.0", "CC-BY-NC-SA-4.0"), ("// SPDX-License-Identifier: AGPL-3.0-only", "AGPL-3.0"),
        (licenses.MORE["Unlicense"][0] + "\n\n" + licenses.MORE["Unlicense"][1] + "\n\n" + licenses.MORE["Unlicense"][2], "Unlicense"),
        ("To the extent possible under law, Ann has waived all copyright and related or neighboring rights to this work.", "CC0-1.0"),
        ("2. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
         " derived from this software without specific prior written permission.", "BSD-3-Clause"),
        (licenses.MORE["Zlib"][0], "Zlib"), (None, ""), ("", ""), ("word " * 150_000, ""),
        ("word " * 120_000 + "\n" + notice("Affero ", "3"), "AGPL-3.0"), ("Licensed under the Apache License,\nVersion 2.0.\n" * 3, "Apache-2.0"),
    ]
    made = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in licenses.query(spark, str(tmp_path)).select("doc_id", "n_licenses", "licenses", "best_dice").collect())
    assert {r[0]: r[2] for r in got} == {i: names for i, (_, names) in enumerate(cases)}
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert sorted(connection.execute(licenses.SQL).fetchall()) == got


def test_licence_key_words_miss_nothing():
    """A passage that reaches the coefficient holds one of the key words, also after edits."""
    draw = random.Random(3)
    for texts_ in licenses.TEMPLATES.values():
        for text in texts_:
            grams = licenses._bigrams(text)
            keys = licenses._key_words(grams, 0.8)
            low, high = licenses._bounds(len(grams), 0.8)
            words = re.findall("[a-z0-9]+", text.lower())
            for _ in range(200):
                edited = [w for w in words if draw.random() > 0.05] + draw.choices(["foo", "bar"], k=draw.randint(0, 2))
                other = licenses._bigrams(" ".join(edited))
                if 2 * len(set(grams) & set(other)) >= 0.8 * (len(grams) + len(other)):
                    assert low <= len(other) <= high
                    assert any(k in " ".join(edited) for k in keys)


# Chunks.

def test_chunk_cuts_move_with_the_text_and_not_with_neighbours():
    text = prose(8, 400).encode()
    cuts = lambda *parts: (lambda o: [set((chunks.cut_places(np.frombuffer(b"".join(parts), np.uint8), o) - s).tolist()) for s in o])(
        np.cumsum([0, *map(len, parts)])
    )
    alone = cuts(text)[0]
    beside = {c for c in cuts(b"other words before", text, b"after")[1] if 0 <= c <= len(text)}
    assert alone == beside and len(alone) > 20
    shifted = {c - 7 for c in cuts(text[:900] + b"INSERTE" + text[900:])[0] if c > 1000}
    assert shifted == {c for c in alone if c > 993}


def test_chunk_dedup_finds_long_passages_and_leaves_others(docs, none):
    rows = {(r.doc_id, r.text): r for r in chunks.cut_spans(docs, chunks.repeated_spans(docs)).collect()}
    removed = {k[0]: r.n_removed for k, r in rows.items()}
    assert removed[2] == len(dict(texts())[0].encode()) and removed[0] == 0
    assert removed[12] > 150 and removed[6] + removed[5] > 150  # the passage
    assert removed[13] == removed[9] == removed[3] == removed[4] == 0
    assert chunks.dedup(none).count() == 0


def test_chunk_dedup_finds_periodic_passages(spark):
    """Passages of a repeated phrase between other words: each is found, and only bytes that stand earlier go."""
    phrases = ["ha ", "-", "ab", "buy now ", "ab cd ef gh ij kl mn op", "x y z w v u t s r q p o ", "é ", "no no yes "]
    rows = []
    for i, phrase in enumerate(phrases):
        passage = (phrase * 400)[: 300 + 7 * i]
        rows += [(4 * i, prose(100 + i, 60) + " " + passage + prose(200 + i, 60)),
                 (4 * i + 1, prose(300 + i, 60) + " q" + passage[3:] + "z " + prose(400 + i, 60)),
                 (4 * i + 2, prose(500 + i, 40) + passage * 40 + prose(600 + i, 40)),
                 (4 * i + 3, prose(500 + i, 40) + passage * 20 + "!" + passage * 20 + prose(600 + i, 40))]
    got = {r.doc_id: r for r in chunks.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    earlier = b""
    for i, text in rows:
        raw, spans = text.encode(), got[i].spans if i in got else []
        for span in spans:
            pieces = chunks.cut_places(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            inner = [(a, b) for a, b in zip(pieces, pieces[1:]) if span["start"] <= a and b <= span["end"]]
            assert all(raw[a:b] in earlier or raw.find(raw[a:b]) < a for a, b in inner)
        if i % 4:
            phrase = phrases[i // 4].encode()
            whole = len(raw) - len((prose(500 + i // 4, 40) + prose(600 + i // 4, 40)).encode()) if i % 4 > 1 else 300
            assert sum(s["end"] - s["start"] for s in spans) >= whole - 4 * 24 - 2 * len(phrase) - 20, (i, phrase)
        earlier += raw


def test_no_chunk_of_periodic_text_is_long():
    for phrase in [b"a", b"ab ", b"lorem ipsum dolor sit am", b"one two three four "]:
        data = np.frombuffer(phrase * 5000, np.uint8)
        edges = chunks.cut_places(data, np.array([0, 1000, 1010, len(data)]) if len(data) > 1010 else np.array([0, len(data)]))
        assert np.diff(edges).max() <= 3 * chunks.REACH


# Quality rules.

def rule_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    n = len(words)
    return (
        n, len("".join(words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        n < 10 or 100 * len(repeated) > 20 * n,
    )


def test_quality_rules_equal_brute_force(docs, none):
    rows = rules.measure(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == sorted(
        (str(i), *rule_counts(t)) for i, t in texts()
    )
    assert rules.measure(none).count() == 0


def test_line_rules(spark):
    good = "\n".join(prose(20 + i, 12) + "." for i in range(4))
    bad = "Home | News | About | Contact us | Imprint | Search\nClick here to subscribe to our newsletter now please.\nNext"
    made = spark.createDataFrame([(1, good), (2, good + "\n" + bad), (3, prose(30, 10) + ".\n" + bad * 3)], "doc_id int, text string")
    rows = {r.doc_id: r for r in rules.measure(made).collect()}
    assert rows[1].kept and rows[1].n_bad_lines == 0
    assert rows[2].n_bad_lines == 3 and rows[2].clean_text == "\n".join(x for x in good.split("\n") if x.strip())
    assert not rows[3].kept


# Quality ranking.

def test_ranking_learns_held_out_labels(spark, sf_dir, none):
    table = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    ranking = quality.learn(table("documents"), table("labels"))
    joined = quality.score(table("documents"), ranking).join(table("labels"), "doc_id")
    rows = joined.filter("pmod(crc32(cast(doc_id as string)), 3) = 1").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.score(none, ranking).count() == 0


def test_ranking_of_odd_texts(docs, spark):
    ranking = quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = quality.score(docs, ranking).collect()
    assert len(rows) == len(texts()) and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    kept = quality.keep_good(docs, spark.createDataFrame([(0, None), (1, 1), (1, 0)], "doc_id long, quality int"))
    assert kept.columns == docs.columns and {r.score for r in kept.collect()} == {"own"}


# Language.

def test_gradients_of_the_network():
    draw = np.random.default_rng(0)
    network = langid.Network.start(["a", "b", "c"], 1)
    for name in ("embed", "recur", "bias", "out", "base"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    codes = draw.integers(0, 256, (6, 3)).astype(np.uint8)
    wanted, weight = np.array([0, 2, 1]), np.full((6, 3), 1 / 18, np.float32)
    _, gradients = network.step(codes, wanted, weight)
    for part, gradient in zip(network.parts(), gradients):
        places = [np.unravel_index(np.abs(gradient).argmax(), part.shape)]
        for place in places:
            before = part[place]
            part[place] = before + 1e-2
            up, _ = network.step(codes, wanted, weight)
            part[place] = before - 1e-2
            down, _ = network.step(codes, wanted, weight)
            part[place] = before
            assert gradient[place] == pytest.approx((up - down) / 2e-2, rel=0.03)


def test_language_of_held_out_documents(spark, sf_dir, docs, none):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    network = langid.learn(table, ~held_out)
    rows = langid.predict(table, network).filter(held_out).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    odd = {r.doc_id: r for r in langid.predict(docs, network).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (3, 4, 10, 11))
    assert odd[5].lang_pred in network.languages
    assert langid.predict(none, network).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.learn(none, F.lit(True))).collect()} == {"und"}


# Suffix arrays.

def test_suffix_array():
    draw = np.random.default_rng(1)
    for n in [*range(30), 200, 333]:
        for letters in (1, 2, 200):
            s = draw.integers(1, letters + 1, n)
            assert suffixes.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s.tolist()[i:])


def earlier_bytes(rows):
    seen, out = set(), {}
    for name, raw in rows:
        covered = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                covered[p : p + 100] = True
            seen.add(raw[p : p + 100])
        kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        out[name] = (len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("array_bytes", [suffixes.ARRAY_BYTES, 2_000, 0])
def test_suffix_dedup_equals_brute_force(docs, none, monkeypatch, array_bytes):
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", array_bytes)
    got = chunks.cut_spans(docs, suffixes.repeated_spans(docs), digest=True).collect()
    distinct = {i: (t or "").encode() for i, t in texts()}
    ordered = sorted(distinct.items(), key=lambda x: (x[0] is not None, x[0] or 0))
    expected = earlier_bytes(ordered)
    assert len(got) == len(texts())
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id] for r in got)
    assert {r.spans for r in got} == {"own"}


def test_suffix_dedup_of_many_variants(spark):
    """Copies with edits at random places, and periodic texts."""
    ensure_checkpoint_dir(spark)
    draw = random.Random(9)
    base = prose(40, 150)
    rows = []
    for i in range(40):
        text = list(base)
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(len(text))] = draw.choice(["", "ß", "QQ"])
        rows.append((i, "".join(text)[draw.randint(0, 200) :]))
    rows += [(50 + k, ("abc" * k)[: 200 + k] + "z" * 150) for k in range(60, 70)]
    got = suffixes.repeated_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    expected = earlier_bytes([(i, t.encode()) for i, t in rows])
    assert {r.doc_id: (sum(s.end - s.start for s in r.spans), len(r.spans)) for r in got} == {
        i: x[1:3] for i, x in expected.items() if x[1]
    }


def test_suffix_dedup_text_stays_utf8(docs, none):
    rows = suffixes.dedup(docs).collect()
    assert {r.doc_id for r in rows if r.text == "" and r.n_removed} == {2} and len(rows) == len(texts())
    assert suffixes.dedup(none).count() == 0


# URLs.

def test_urls_as_of(spark):
    captures = spark.sql("""
        SELECT * FROM VALUES ('http://a.b.org/x', DATE'2024-02-01'), ('http://a.b.org/x', DATE'2024-03-10'),
        ('https://u@A.B.ORG:80?q', DATE'2024-03-31'), ('http://c.org', DATE'2024-03-01'), ('http://c.org', DATE'2030-03-01'),
        (NULL, DATE'2024-03-01'), ('nonsense', DATE'2024-03-01'), ('http://c.org', NULL), ('http://c.org', DATE'2024-03-01')
        AS t(url, fetched_on)""").withColumn("host", F.lit("own"))
    entries = spark.sql("""
        SELECT * FROM VALUES ('l', 'b.org', 'block', DATE'2024-01-01'), ('l', 'a.b.org', 'allow', DATE'2024-03-01'),
        ('l', 'a.b.org', 'unlist', DATE'2024-03-31'), ('l', 'c.org', 'block', DATE'2024-03-01'),
        ('m', 'c.org', 'allow', DATE'2024-01-01'), ('l', 'c.org', 'unlist', DATE'2024-12-01'), ('l', NULL, 'block', DATE'2024-01-01')
        AS t(list, domain, action, listed_on)""")
    rows = urls.evaluate(captures, entries).collect()
    got = sorted((str(r.host), str(r.fetched_on), r.list_action, r.list_domain, r.kept) for r in rows)
    assert got == sorted([
        ("a.b.org", "2024-02-01", "block", "b.org", False), ("a.b.org", "2024-03-10", "allow", "a.b.org", True),
        ("a.b.org", "2024-03-31", "block", "b.org", False), ("c.org", "2024-03-01", "block", "c.org", False),
        ("c.org", "2024-03-01", "block", "c.org", False), ("c.org", "2030-03-01", "allow", "c.org", True),
        ("None", "2024-03-01", None, None, False), ("None", "2024-03-01", None, None, False), ("c.org", "None", None, None, True),
    ])
    assert urls.evaluate(captures.limit(0), entries).count() == 0
    assert urls.evaluate(captures, entries.limit(0)).filter("list_action IS NOT NULL").count() == 0


def test_hosts_in_query_and_sql(spark, tmp_path):
    """Ports, names, a dot at the end, IPv6 addresses: query and SQL read the same host."""
    hosts = {
        "http://[::1]:80/x": "[::1]", "https://u:p@[2001:DB8::1]/": "[2001:db8::1]", "http://ex.com./a": "ex.com", "http://EX.com:80": "ex.com",
        "http://a.ex.com?q=/b": "a.ex.com", "http://.": None, "http:///x": None, "http://[::1": "[", "ftp+x://h.org#f": "h.org", "": None,
    }
    made = spark.createDataFrame([(i, u) for i, u in enumerate([*hosts, None])], "page_id long, url string")
    made.write.parquet(f"{tmp_path}/pages.parquet")
    got = urls.query(spark, str(tmp_path)).collect()
    assert {r.page_id: r.host for r in got} == dict(enumerate([*hosts.values(), None]))
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert sorted(map(str, connection.execute(urls.SQL).fetchall())) == sorted(str(tuple(r)) for r in got)


def test_url_intervals_from_long_before_the_captures(spark):
    """An entry of two centuries before has pieces from the first capture on only, and still decides."""
    captures = spark.sql("SELECT 'http://c.org' AS url, DATE'2024-03-01' AS fetched_on UNION ALL SELECT 'http://d.org', DATE'2024-01-01'")
    entries = spark.sql("""
        SELECT * FROM VALUES ('l', 'C.org.', 'block', DATE'1800-01-01'), ('l', 'd.org', 'block', DATE'1800-01-01'),
        ('l', 'd.org', 'unlist', DATE'2024-01-01') AS t(list, domain, action, listed_on)""")
    got = {r.host: (r.list_domain, r.kept) for r in urls.evaluate(captures, entries).collect()}
    assert got == {"c.org": ("c.org", False), "d.org": (None, True)}


# Jaccard join.

def jaccard_truth(rows, n=5):
    sets = {}
    for i, t in rows:
        w = lower_words(t)
        sets[i] = {" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    links = {i: {j for j in sets if j != i and sets[i] & sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])} for i in sets}
    classes = {}
    for i in sorted(sets, key=lambda x: (x is not None, x or 0)):
        if i not in classes:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in classes:
                    classes[j] = i
                    todo += links[j]
    return {i: (classes[i], len(links[i])) for i in sets}


@pytest.mark.parametrize("texts_in_group", [512, 4])
def test_jaccard_join_equals_brute_force(spark, docs, none, monkeypatch, texts_in_group):
    monkeypatch.setattr(groups, "GROUP_ROWS", texts_in_group)
    draw = random.Random(4)
    base = prose(60, 140).split(" ")
    rows = [(i, t) for i, t in texts() if t is None or len(t) < 20_000]
    for i in range(100, 130):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(3)}"
        rows.append((i, " ".join(words)))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(made).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == jaccard_truth(rows)
    assert sum(r.keeper for r in got) == len({c for c, _ in jaccard_truth(rows).values()})


@pytest.mark.parametrize("texts_in_group", [512, 5000])
def test_jaccard_join_of_many_variants_near_the_threshold(spark, monkeypatch, texts_in_group):
    """Links of a group of 600 variants, in one task or bucket by bucket."""
    monkeypatch.setattr(groups, "GROUP_ROWS", texts_in_group)
    draw = random.Random(12)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(600):
        words = list(base)
        for at in draw.sample(range(400), draw.choice([4, 5])):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    truth = jaccard_truth(rows)
    assert 20_000 < sum(n for _, n in truth.values()) < 600 * 599
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == truth


@pytest.mark.parametrize("n", [600, 1200, 2400])
def test_jaccard_join_makes_few_edges_of_many_variants(spark, monkeypatch, n):
    """Edges grow with the texts, not with their pairs, also where a cluster is cut into blocks."""
    made = []

    def counted(edges):
        made.append(edges.count())
        return groups.components(edges)

    monkeypatch.setattr(jaccard, "components", counted)
    draw = random.Random(13)
    rows = []
    for i in range(n):
        words = [f"b{k}" for k in range(400)]
        for at in draw.sample(range(400), draw.choice([3, 5])):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == n
    assert n - 1 <= made[0] <= 2 * n


def test_keep_one(docs, none):
    kept = jaccard.keep_one(docs)
    rows = kept.collect()
    truth = jaccard_truth([(i, t) for i, t in texts()])
    assert kept.columns == docs.columns and {r.node for r in rows} == {"own"}
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(c) for c in {c for c, _ in truth.values()})
    assert jaccard.keep_one(none).count() == 0


def test_bands_reach_the_recall():
    bands, rows = jaccard.bands_and_rows(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= jaccard.VALUES


def test_components(spark):
    edges = [(bytes([a]), bytes([b])) for a, b in [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 21)]]
    rows = groups.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert {r.node[0]: r.label[0] for r in rows} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 20: 20, 21: 20}


def test_components_of_long_paths_and_hot_nodes(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(999, i) for i in range(300, 500)] + [(700, 700)]
    names = list(range(1000))
    draw.shuffle(names)
    made = [(names[a], names[b]) for a, b in edges]
    rows = groups.components(spark.createDataFrame(made, "a long, b long")).collect()
    path, star = {names[i] for i in range(100, 161)}, {names[i] for i in [999, *range(300, 500)]}
    assert {r.node: r.label for r in rows} == {x: min(s) for s in (path, star) for x in s}
    assert groups.components(spark.createDataFrame([], "a long, b long")).count() == 0
