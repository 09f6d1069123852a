"""Quality rules, near-duplicates, language model, toxicity, licences and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tephra.llm import bpe, licenses, lm, minhash, quality_rules, toxicity

import corpus_pipeline

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(t):
    return BLANK.findall((t or "").translate(LOW))


# ---- quality rules

def binomial_tail(k, n, a):
    return sum(math.comb(n, j) * a ** j * (1 - a) ** (n - j) for j in range(k + 1))


@pytest.mark.parametrize("alpha,delta", [(0.0125, 0.003), (0.2, 0.05), (0.5, 0.4)])
def test_allowed_rejections_are_the_exact_bound(spark, alpha, delta):
    got = spark.range(0, 400, 13).select("id", quality_rules.most_allowed(F.col("id"), alpha, delta).alias("k")).collect()
    for n, k in got:
        assert k == max([-1] + [j for j in range(n + 1) if binomial_tail(j, n, alpha) <= delta and j <= math.ceil(n * alpha)])


def text_of(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choices(alphabet, k=5)) for _ in range(n))


def quality_table(spark, n=1600):
    rng, rows, marks = random.Random(5), [], []
    for i in range(n):
        bad, lang = i % 4 == 0, ("en", "de", None)[i % 3 % 2 if i % 50 else 2]
        t = text_of(rng, 60)
        rows.append((i, t.replace(" ", "$$ ") if bad else t, lang, "x", 1))
        marks.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words string, label int")
    return docs, spark.createDataFrame(marks + [(0, 0), (1, None), (None, 1)], "doc_id long, quality int")


def test_rules_reject_bad_and_keep_good(spark):
    docs, labels = quality_table(spark)
    out = quality_rules.quality_rules(docs, labels, alpha=0.2)
    got = {r.id: r for r in out.collect()}
    good = [got[i] for i in got if i % 4]
    assert sum(not r.kept for r in good) <= 0.2 * len(good)
    assert sum(r.kept for i, r in got.items() if i % 4 == 0) < 0.2 * len(got) / 4
    assert got[4].failed == ["symbols"] and got[4].doc.label == 1 and got[0].kept     # hardly any label has no language


def test_few_labels_prove_nothing(spark):
    docs, labels = quality_table(spark, 120)
    assert all(r.kept for r in quality_rules.quality_rules(docs, labels).collect())
    assert quality_rules.quality_rules(docs.limit(0), labels).count() == 0


def test_counts_match_plain_python(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "one", "a b c a b c", "x\nx\n \n\nx y\nx", "#a $$ b|c <>", "A!! B C d " * 300, text_of(rng, 9000, "ab"), "q w e r " * 5 + "unlike words", "ä ö ü ä ö ü\x85z"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(4, texts[4], "en"), (None, "z", None)], "doc_id long, text string, lang string")
    out = quality_rules.quality_rules(docs, spark.createDataFrame([], "doc_id long, quality int"), keep=False)
    for r in (r for r in out.collect() if r.id is not None):
        t = texts[r.id] or ""
        w, lines = BLANK.findall(t), [x for x in t.split("\n") if BLANK.search(x)]
        seen = Counter(zip(w, w[1:], w[2:]))
        covered = {p + k for p, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)), t
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and r.kept != r.base_failed


# ---- near-duplicates

def brute_groups(rows, size, percent=80):
    sets, parent = defaultdict(set), {}
    for i, t in rows:
        w = words(t)
        if w and i is not None:
            sets[i].add(frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))))

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def copies(seed=1, groups=6, each=25):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(each):
            w = base[:]
            for _ in range(rng.randrange(0, max(2, len(w) // 9))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10_000)}"
            rows.append(" ".join(w))
    rng.shuffle(rows)
    odd = [None, "", " \n", "single", "SINGLE", "two words", "Two  words", "x y z", rows[0], rows[0], "long " * 30_000, "é È", "é è"]
    return list(enumerate(rows + odd))


@pytest.mark.parametrize("size", [2, 5])
def test_groups_match_all_pairs(spark, size):
    rows = copies()
    more = [(None, rows[0][1]), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows + more], "doc_id long, text string, n int, bands string")
    want = brute_groups(rows, size)
    got = minhash.near_groups(docs, size=size).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert r.component_id == (want.get(r.id, r.id)) and r.kept == (r.id is None or r.id == want.get(r.id, r.id))
    kept = minhash.near_dedup(docs, size=size)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} - {None} == {i for i, _ in rows if want.get(i, i) == i}


def test_nothing_to_group(spark):
    assert minhash.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 50)] + [(50, 5), (7, 7)]
    got = {r.id: r.component for r in minhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[k] for k in range(101, 161)} == {100} and {got[k] for k in range(6, 51)} == {5}


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(0)
    for n in (3, 50, 5_000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[:int(n * 0.9)], rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)])
        apart = int(np.unpackbits((minhash.parity(a) ^ minhash.parity(b)).view(np.uint8)).sum())
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


# ---- language model

def test_elias_fano_and_trie(tmp_path):
    rng = np.random.default_rng(1)
    for top, n in ((1 << 64, 500), (1_000, 800), (1, 0), (5, 1)):
        values = np.sort(rng.integers(0, max(1, top - 1), n, dtype=np.uint64))
        assert (lm.EliasFano(lm.EliasFano.packed(values, top)).values() == values).all()
    c, w = np.sort(rng.integers(0, 50, 900, dtype=np.uint64)), rng.integers(0, 1 << lm.PRINT, 900, dtype=np.uint64)
    order = np.lexsort((w, c))
    c, w, p = c[order], w[order], rng.random(900) * 0.9 + 0.01
    (tmp_path / "level").write_bytes(lm.Trie.packed(c, w, p))
    trie = lm.Trie(np.memmap(tmp_path / "level", np.uint8, "r"))
    assert np.abs(np.log10(trie.probability(trie.find(c, w), trie.least)) - np.log10(p)).max() < 0.01
    assert not trie.find(c, w[::-1].copy() ^ np.uint64(1)).any() and not trie.find(np.array([99], np.uint64), w[:1]).any()


def test_successors_are_found_on_the_compact_form():
    rng = np.random.default_rng(2)
    for top, n in ((1 << 64, 900), (1 << 64, 1), (1_000, 800), (700, 3_000), (10, 0), (1 << 20, 70_000)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        level = lm.EliasFano(lm.EliasFano.packed(values, top))
        goals = np.concatenate([values[:2_000], rng.integers(0, top, 500, dtype=np.uint64), np.array([0, top - 1], np.uint64)])
        at, equal = level.successor(goals)
        assert (at == np.searchsorted(values, goals)).all() and (equal == np.isin(goals, values)).all()
        begin = rng.integers(0, n + 1, len(goals))
        end = np.minimum(n, begin + rng.integers(0, 9, len(goals)))
        at, equal = level.successor(goals, begin, end)
        assert at.tolist() == [a + int(np.searchsorted(values[a:b], g)) for a, b, g in zip(begin, end, goals)]
        assert equal.tolist() == [bool((values[a:b] == g).any()) for a, b, g in zip(begin, end, goals)]


def test_trie_answers_like_a_dictionary():
    rng = random.Random(3)
    grams = sorted({(rng.choice([0, 5, 1 << 63]) + rng.randrange(40), rng.randrange(1 << lm.PRINT) if rng.random() < 0.3 else rng.randrange(60)) for _ in range(3_000)})
    chance = {g: rng.random() * 0.9 + 0.01 for g in grams}
    trie = lm.Trie.mapped(lm.Trie.packed(*(np.array(x, np.uint64) for x in zip(*grams)), np.array([chance[g] for g in grams])))
    asked = grams + [(c, (w * 7 + 1) % 61) for c, w in grams] + [(c + 41, w) for c, w in grams]
    rng.shuffle(asked)
    found = trie.probability(trie.find(*(np.array(x, np.uint64) for x in zip(*asked))), trie.least)
    for g, p in zip(asked, found):
        assert p == 0 if g not in chance else abs(math.log10(p) - math.log10(chance[g])) < 0.01


@pytest.mark.parametrize("sizes", [{}, {"batch_tokens": 60, "shard_tokens": 40}])
def test_scores_match_plain_counts(spark, sizes):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["the", "The", "of", "b,", "c", "d\n", "é", "É"], k=rng.randrange(0, 40))) for _ in range(60)] + [None, "", "unseen", "the " * 500, "the " * 500]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 10 == 0, 1.0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [(5, texts[5], False, 0.0)], "doc_id long, text string, held_out boolean, score double")
    single, pairs, before = Counter(), Counter(), Counter()
    for i, t, held, _ in rows + [(5, texts[5], False, 0.0)]:
        if not held:
            w = words(t) + ["\n"]
            single.update(w)
            pairs.update(zip(["\r"] + w, w))
            before.update((["\r"] + w)[:len(w)])
    n, v = sum(single.values()), len(single)
    one = lambda x: (single[x] + 0.1) / (n + 0.1 * (v + 1))
    got = lm.lm_scores(docs, **sizes).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        w = words(texts[r.id]) + ["\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(single[x] > 0 for x in w), n, rows[r.id][2])
        assert r.base_score == pytest.approx(sum(math.log10(one(x)) for x in w), abs=1e-9)
        assert r.score == pytest.approx(sum(math.log10((pairs[a, x] + 20 * one(x)) / (before[a] + 20)) for a, x in zip(["\r"] + w, w)), abs=0.01 * len(w))


def test_no_documents_have_no_scores(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, held_out boolean")
    assert lm.lm_scores(empty).count() == 0
    alone = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held_out boolean")
    assert lm.lm_scores(alone).first().train_tokens == 0


# ---- toxicity

INSULTS = ["idiot", "scumbag", "moronic", "worthless"]


def toxic_table(spark):
    rng, rows, marks = random.Random(6), [], []
    for i in range(400):
        w = text_of(rng, 40, "etaoinshr").split()
        if bad := i % 5 == 0:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        rows.append((i, " ".join(w), 9.0))
        marks.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(marks + [(3, None), (None, 1)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs, labels = toxic_table(spark)
    return toxicity.train(docs, labels.where("doc_id % 2 = 0 or doc_id is null"))


def test_insults_are_found_with_gaps(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0 or doc_id is null"))
    out = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    held = [i for i in out if i % 2]
    assert sum(out[i].predicted != int(i % 5 == 0) for i in held) <= 6
    more = spark.createDataFrame([(1, "you idiot scumbag"), (2, "an id-i.ot a scu*mbag"), (3, "i d i o t and w o r t h l e s s"), (4, "idxiot scuumbag"), (5, None), (6, ""), (7, "ratio nose this " * 20_000), (8, "zyx" * 50_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(more, model).collect()}
    assert [got[k].predicted for k in range(1, 9)] == [1, 1, 1, 1, 0, 0, 0, 0] and got[5].score == got[6].score
    assert toxicity.toxicity(more.limit(0), model).count() == 0


def test_stems_are_found_by_how_often_they_occur(spark):
    """No single word tells: clean texts hold the stem once, toxic ones several times, each with another ending."""
    rng, rows = random.Random(9), []
    for i in range(600):
        w = text_of(rng, 60, "etaoinshr").split()
        for _ in range(4 if i % 5 == 0 else i % 2):
            w.insert(rng.randrange(len(w)), "bomente" + "".join(rng.choices("etaoinshr", k=rng.randrange(4))))
        rows.append((i, " ".join(w), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.where("doc_id % 3 > 0").select("doc_id", "toxic"))
    held = toxicity.toxicity(docs.where("doc_id % 3 = 0"), model).collect()
    assert sum(r.predicted for r in held if r.toxic) >= 36 and sum(r.predicted for r in held if not r.toxic) <= 4


@pytest.mark.parametrize("insult", ["idxxiot", "ixdxixoxt", "iadbicodt", "scuyymbag", "morxxonic", "sacbudmbeafg", "sometextbeforeidiotandafterit", "http://sometext/before/idiot/and/after/it.html", "we.say.scumbag,and,so.on,to,all,of.them"])
def test_insults_are_found_with_many_gaps_and_in_long_runs(toxic_model, insult):
    plain = ["rain stone heart", "sometextbeforeandafteritwithoutany", "http://sometext/before/and/after/it.html", "xaxbxcxdx"]
    scores = toxic_model.scores(toxicity.Features(toxic_model.landmarks).of([f"rain {insult} stone heart", *plain]))
    assert scores[0] >= 0.7 and scores[1:].max() < 0.1


def test_explicit_map_gives_the_kernel():
    marks = toxicity.Landmarks(["idiot", "scumbag"])
    for word in ("idiot", "idxiot", "scumidiot", "scmbg", "other"):
        maps = [toxicity.subsequences(s) for s in (word, *marks.strings)]
        dot = lambda a, b: sum(v * b.get(k, 0) for k, v in a.items())
        want = {k: dot(maps[0], m) / math.sqrt(dot(maps[0], maps[0]) * dot(m, m)) for k, m in enumerate(maps[1:])}
        assert dict(marks.similar([word])[0]) == pytest.approx({k: x for k, x in want.items() if x >= toxicity.FLOOR})


def test_one_kind_of_label_gives_no_model(spark):
    docs, labels = toxic_table(spark)
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.toxicity(docs.limit(2), None).agg({"predicted": "max"}).first()[0] == 0


# ---- licences

def test_licences(spark):
    rng = random.Random(8)
    plain = [(100 + i, "\n".join(text_of(rng, 12) for _ in range(4)), 0) for i in range(60)]
    rows = [(1, "Some text.\nLicensed under the Apache License, Version 2.0.\nmore", 0), (2, "ALL RIGHTS RESERVED.", 0), (3, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", 0), (3, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", 0),
            (4, "This work is licensed under the GNU General Public License, version 2.", 0), (5, None, 0), (6, "", 0), (7, "license of the reserved right", 0), (None, "All rights reserved.", 0), (8, "word " * 20_000, 0)]
    docs = spark.createDataFrame(rows + plain, "doc_id long, text string, n_notices int")
    out = licenses.license_scan(docs)
    got = {r.doc_id: (r.licenses, r.n_notices) for r in out.collect()}
    assert out.columns == ["doc_id", "text", "n_notices", "licenses"] and out.count() == len(rows) + len(plain)
    assert got[1] == (["apache"], 1) and got[2][0] == ["proprietary"] and got[3] == (["cc-by-nc", "mit"], 2) and got[4][0] == ["gpl"] and got[None][0] == ["proprietary"]
    assert all(got[k] == ([], 0) for k in [5, 6, 7, 8, *(100 + i for i in range(60))])


def test_notices_are_found_however_common_they_are(spark):
    rng = random.Random(8)
    rows = [(100 + i, "\n".join(text_of(rng, 12) for _ in range(4)) + f"\nCopyright (c) {1990 + i % 30} {text_of(rng, 2)}. All rights reserved.") for i in range(60)]
    got = {r.doc_id: (r.licenses, r.n_notices) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 + i] == (["proprietary"], 1) for i in range(60))


NAMED = [("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"), ("CC BY-SA 4.0", "cc-by-sa"), ("Academic Free License, Version 3.0", None),
         ("It is distributed under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or any later version.", "lgpl"),
         ("We discussed all rights reserved for members under the new law.", None), ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: Zlib", None), ("GPL-3.0-or-later", "gpl"),
         ("Licensed under the Foo License, Version 2.0.", None), ("Licensed under the Eclipse Public License 2.0", None), ("wir gehen mit der Bahn", None),
         ("MIT License\n\nCopyright (c) 2020 A B\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software\nand associated documentation files, to deal in the Software without restriction.", "mit")]


def test_families_are_told_apart(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, (t, _) in enumerate(NAMED)], "doc_id long, text string, licenses int")
    out = licenses.license_scan(docs)
    assert out.columns == ["doc_id", "text", "licenses", "n_notices"]
    assert {k: r.licenses for k, r in enumerate(out.orderBy("doc_id").collect())} == {k: [f] if f else [] for k, (_, f) in enumerate(NAMED)}
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_sentences_confirmed_as_in_plain_python(spark):
    """The comparison with templates, by brute force over all of them, for sentences of which words were taken out."""
    rng = random.Random(12)
    known = [r.asDict() for r in licenses.template_rows(spark).collect()]
    texts = []
    for row in known:
        words = row["words"]
        for share in (0.0, 0.15, 0.3):
            texts.append(" ".join(w for w in words if rng.random() >= share) or "word")
    base = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("version", F.xxhash64("text"))
    got = {r.id: (r.family, round(r.agreement, 9)) for r in licenses.license_units(base, licenses.train(spark), least=0.0).collect()}
    grams = lambda words: set(words) | {f"{x} {y}" for x, y in zip(words, words[1:])}
    seen = 0
    for k, text in enumerate(texts):
        own = grams(text.split())
        fits = []
        for t in known:
            both = len(own & set(t["grams"]))
            short = t["title"] or len(t["grams"]) < 10
            if both >= 0.6 * len(t["grams"]) and (not short or both >= (0.5 if t["title"] else 0.33) * len(own)) and 2 * len(own & set(t["keys"])) >= len(t["keys"]):
                fits.append((both / len(t["grams"]), both, t["family"]))
        if k in got:
            best = max(f[:2] for f in fits)
            assert (got[k][1], got[k][0]) in {(round(s, 9), f) for s, b, f in fits if (s, b) == best}
            seen += 1
    assert seen > 100


WRAPPED = {
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met.",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * any later version.",
    "mit": "// Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software and associated documentation files, to deal in the Software\n// without restriction.",
}


def test_wrapped_notices_and_titles(spark):
    rng = random.Random(8)
    rows = [(k, t) for k, t in enumerate(WRAPPED.values())] + [(3, "BSD 3-Clause License"), (4, "MIT License"), (5, "The MIT License (MIT)"), (6, "Creative Commons Attribution-NonCommercial 4.0")]
    rows += [(200 + i, "\n".join(text_of(rng, 12) for _ in range(4))) for i in range(20)]
    got = {r.doc_id: (r.licenses, r.n_notices) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k] for k in range(7)] == [([f], 1) for f in [*WRAPPED, "bsd", "mit", "mit", "cc-by-nc"]]
    assert all(got[200 + i] == ([], 0) for i in range(20))


# ---- pipeline

def brute_pipeline(docs, items):
    """After the quality stage, whose cutoffs are tested above."""
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(LOW)
    held = defaultdict(set)
    for i, t in docs:
        for line in t.split("\n"):
            held[key(line)].add(i)
    gone = {k: max(v) for k, v in held.items() if len(k) >= 20 and len(v) >= 3}
    docs = [(i, "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i)) for i, t in docs]
    group = brute_groups(docs, 5)
    docs = [(i, t) for i, t in docs if group.get(i, i) == i]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOW))
    wins = {tuple(w[p:p + 10]) for w in map(split, items) if w for p in range(max(1, len(w) - 9))}
    sizes = {len(k) for k in wins}
    docs = [(i, t) for i, t in docs if not any(tuple(w[p:p + n]) in wins for w in [split(t)] for n in sizes for p in range(len(w) - n + 1))]
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    return sorted((i, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs for e in [plain.encode_ordinary(t)])


def test_pipeline_matches_plain_python(spark, tmp_path):
    rng = random.Random(9)
    items = [text_of(rng, 15) for _ in range(3)] + ["tiny item"]
    rows = []
    for i in range(60):
        t = text_of(rng, 80, "abcdefghijkl") + "\n" + rng.choice(["A passage that many documents of this table share", "another " + str(i), items[i % 4] if i % 9 == 0 else ""])
        rows.append(t)
    rows += [rows[3].replace("a", "a", 1) + " tail", rows[5], rows[5], "short", "", None]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [(i, t) for i, t in enumerate(rows) if len(BLANK.findall(t or "")) >= 50]
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = brute_pipeline(kept, items)
    assert got == want and 0 < len(want) < len(kept)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


def test_a_document_of_two_texts_joins_both_groups(spark):
    rng = random.Random(4)
    a, b = text_of(rng, 60), text_of(rng, 60)
    near = lambda t, w: " ".join([*t.split()[:-1], w])
    for order in (0, 1):
        rows = [(1, a), (1, b)][::1 - 2 * order] + [(2, near(b, "other")), (3, near(a, "word")), (4, text_of(rng, 60))]
        got = {(r.id, r.component_id) for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def template_docs(n, rng):
    """Texts that share 72 percent of their words' pairs with a template, so about 0.56 with each other."""
    common = [f"t{i}" for i in range(100)]
    return [(k, " ".join([*common, *[f"d{k}x{rng.randrange(10**6)}" for _ in range(39)]])) for k in range(n)]


def test_a_template_under_the_threshold_does_not_pair_all(spark, monkeypatch):
    counted = []
    plain = minhash.overlaps
    monkeypatch.setattr(minhash, "overlaps", lambda pairs, sets: counted.append(pairs.count()) or plain(pairs, sets))
    totals = {}
    for n in (150, 600):
        counted.clear()
        out = minhash.near_groups(spark.createDataFrame(template_docs(n, random.Random(6)), "doc_id long, text string").repartition(2), size=2)
        assert out.where("kept").count() == n
        totals[n] = sum(counted)
    assert totals[600] <= 6 * totals[150] and totals[600] < 600 * 599 / 20


def test_pairs_at_the_threshold_link_in_a_crowd_too(spark):
    """Pairs at exactly 0.8 among many other documents at 0.71: each must link, whatever the crowd."""
    common = [f"t{i}" for i in range(151)]
    pairs = 250
    rows = [(2 * k + side, " ".join([*common, *[f"p{k}x{i}" for i in range(10)], *[f"d{k}x{side}x{i}" for i in range(20)]])) for k in range(pairs) for side in (0, 1)]
    got = {r.id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), size=2).collect()}
    assert got == {i: i - i % 2 for i in range(2 * pairs)}


def test_second_keys_find_nine_in_ten_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for k in range(150):
        shared = rng.integers(-2**62, 2**62, 160)
        pairs += [(2 * k, [*map(int, shared), *map(int, rng.integers(-2**62, 2**62, 20))]), (2 * k + 1, [*map(int, shared), *map(int, rng.integers(-2**62, 2**62, 20))])]
    keys = minhash.second_keys(spark.createDataFrame(pairs, "node long, shingles array<long>"))
    met = keys.selectExpr("key", "node div 2 as pair").groupBy("key", "pair").count().where("count > 1").select("pair").distinct().count()
    assert met >= 135
