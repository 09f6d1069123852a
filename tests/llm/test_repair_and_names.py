"""Personal data, conversations and spelling variants against plain Python."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tephra.llm import conversations, pii, spelling

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def valid(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15
    found = [(m.start(), k, m.end()) for k, (kind, form) in enumerate(FORMS.items()) for m in re.finditer(form, text) if valid(kind, m[0])]
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(found)]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    bits = ["a@b.c", "x.y@z", "@", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+49 30 1234567", "é", "𝒳", " ", "\n", ".", "0001.2.3.4", "-", "_q@r.st", "12", "+", "5"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(300)]
    return texts + [None, "", "9" * 30_000, "a" * 30_000 + "@b.c", ("1 " * 9_000) + "x", "a.b@c.d_e@f.g", "1.2.3.4.5.6.7.8", "x@y@z.w@q.r", "4111 1111 1111 1111 " * 400]


def test_base_spans_are_those_of_the_patterns(spark, odd_texts):
    docs = spark.createDataFrame([(i if i != 5 else None, t, 0) for i, t in enumerate(odd_texts)], "doc_id long, text string, spans int")
    out = pii.personal_data(docs)
    assert out.columns == ["doc_id", "text", "spans", "base"]
    for row in out.collect():
        assert [tuple(s) for s in row.base] == plain_spans(row.text or ""), row.text


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    card = lambda i: next(f"4{i:014d}{c}" for c in range(10) if plain_spans(f"4{i:014d}{c}"))
    texts = [f"Please reach them on {n} after lunch, item {i}00 was sold" for i, n in enumerate([f"+1 (555) 010-{k:04d}" for k in range(12)] + ["555-0199", "0049 30 123456"])]
    texts += [f"charged to card {card(i)} this week" for i in range(9)] + ["charged to card 4000 0000 0000 0009 this week"]
    texts += [f"write to user{i}@mail{i}.example.com for help" for i in range(8)] + ["write to jörg@bücher.de for help"]
    texts += ["there are 555-0199 of them in stock", "the build 2024 0101 0101 passed", None, ""] + ["we sold 555-0000 of the new ones"] * 30
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    more = {r.doc_id: [(s.kind, r.text[s.start:s.end]) for s in r.spans if s not in r.base] for r in pii.personal_data(docs).collect()}
    found = {texts[i]: v for i, v in more.items() if v}
    assert found == {"Please reach them on 555-0199 after lunch, item 1200 was sold": [("phone", "555-0199")], "Please reach them on 0049 30 123456 after lunch, item 1300 was sold": [("phone", "0049 30 123456")],
                     "charged to card 4000 0000 0000 0009 this week": [("card", "4000 0000 0000 0009")], "write to jörg@bücher.de for help": [("email", "jörg@bücher.de")]}
    # copies of one text prove no pattern
    copies = spark.createDataFrame([(i, "call +1 (555) 010-0000 now") for i in range(40)] + [(99, "call 555-0199 now")], "doc_id long, text string")
    assert all(r.spans == r.base for r in pii.personal_data(copies).collect())
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_a_common_word_in_the_slot_outweighs_seeds(spark):
    texts = [f"sent to +1 (555) 010-{k:04d} today" for k in range(8)] + ["sent to 555-0199 today"] + ["sent to London today"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.spans == r.base for r in pii.personal_data(docs).collect())


# conversations

def all_scripts(codes):
    """The least (cost, edits) over all scripts with at most two insertions side by side, by recursion over rows and what has been put out."""
    @functools.cache
    def best(i, out, inserted):
        turn, then = {"": ("u", "u"), "s": ("u", "u"), "ua": ("u", "u"), "u": ("a", "ua")}[out]
        options = [(0, "")] if i == len(codes) and out in ("", "ua") else []
        add = lambda cost, edit, rest: options.append((cost + rest[0], edit + rest[1]))
        if inserted < 2:
            add(3, "I", best(i, then, inserted + 1))
        if i < len(codes):
            initial, go, cut = "uas?"[codes[i] & 3], codes[i] & 4, 3 if codes[i] & 8 else 0
            add(4, "D", best(i + 1, out, 0))
            if not go:
                add(cut + (0 if initial == turn else 3), "K" if initial == turn else "R", best(i + 1, then, 0))
                if out == "" and initial == "s":
                    add(cut, "K", best(i + 1, "s", 0))
        return min(options, default=(10**9, ""))
    return best(0, "", 0)


def test_cheapest_is_the_least_of_all_scripts():
    for n in range(1, 4):
        for codes in itertools.product([0, 1, 2, 3, 4, 8, 9, 10], repeat=n):
            assert conversations.cheapest(bytes(codes)) == all_scripts(codes), codes


def test_blocks_change_nothing():
    rng = random.Random(2)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3]) | rng.choice([0, 0, 0, 4, 8]) for _ in range(rng.randint(1, 30)))
        assert len({conversations.cheapest(codes, b) for b in (1, 3, 8, 64)}) == 1, codes
    long = bytes(i % 2 if rng.random() > 0.1 else 3 for i in range(20_000))
    assert conversations.cheapest(long)[0] <= 3 * 4_000


def rows(spark, data):
    return spark.createDataFrame(data, "conv long, turn long, role string, text string, dropped boolean")


def test_repair_of_each_fault(spark):
    data = [(1, 0, "system", "Be kind.", False), (1, 1, "user", "Hi?", False), (1, 3, "assistant", "Yes.", False),            # nothing to mend, one number missing
            (2, 0, "user", "Hi.", False), (2, 0, "user", "Hi.", False), (2, 1, "assistant", " \n", False),                    # a repeat, a blank
            (3, 0, "user", "One.", False), (3, 1, "user", "Two", False), (3, None, "tool", "Zero.", False),
            (4, 0, "user", "gone", True), (None, 7, None, None, False)]
    out = {r.conv: r for r in conversations.repair(rows(spark, data)).collect()}
    sha = lambda *lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert tuple(out[1]) == (1, 1, 0, 0, 0, 0, 0, "KKK", sha("system:Be kind.", "user:Hi?", "assistant:Yes."))
    assert (out[2].duplicate, out[2].blank, out[2].illegal, out[2].cost, out[2].audit) == (1, 1, 1, 11, "KDDI")
    assert out[2].repaired_sha256 == sha("user:Hi.", "assistant:")
    assert (out[3].truncated, out[3].gaps, out[3].cost, out[3].audit) == (1, 0, 10, "DKR")
    assert tuple(out[4]) == (4, 0, 0, 0, 0, 0, 0, "", sha())
    assert (out[None].blank, out[None].cost, out[None].audit) == (1, 4, "D")
    turns = conversations.repaired_turns(rows(spark, data).withColumn("position", F.lit("x"))).where("conv = 2").orderBy("position").collect()
    assert [tuple(t) for t in turns] == [(2, 0, "K", "user", "Hi."), (2, 1, "I", "assistant", "")]
    assert conversations.repair(rows(spark, [])).count() == 0


def test_repair_against_all_scripts(spark):
    rng = random.Random(5)
    data = [(c, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["A.", "B", "", "C!", "A."]), rng.random() < 0.1) for c in range(60) for _ in range(rng.randint(1, 6))]
    want = {}
    for c in {d[0] for d in data}:
        own = sorted(((t is not None, t or 0, r, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), x) for k, t, r, x, d in data if k == c and not d))
        seen, codes = set(), []
        for _, _, role, _, text in own:
            fault = 4 if not text or (role, text) in seen else 0 if text[-1] in ".!?" else 8
            seen.add((role, text))
            codes.append({"u": 0, "a": 1, "s": 2}.get(role[:1], 3) | fault)
        want[c] = all_scripts(codes) if codes else (0, "")
    got = {r.conv: (r.cost, r.audit) for r in conversations.repair(rows(spark, data).repartition(4)).collect()}
    assert got == want


# spelling variants

def test_variants_against_all_pairs(spark):
    rng = random.Random(8)
    roots = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(25)] + ["x" * 100, "x" * 101, ""]
    words = []
    for w in roots:
        words += [w] * rng.choice([3, 40, 500])
        for _ in range(6):
            k = rng.randrange(len(w) + 1)
            words += [w[:k] + rng.choice(["", "a", "é", "z"]) + w[k + rng.choice([0, 1]):]] * rng.choice([1, 2, 5, 30])
    n = {w: words.count(w) for w in set(words) if words.count(w) >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        return a != b and (sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b) else len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b))))
    want = {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        want[w] = (n[w], len(others), best if best is not None and n[best] >= 10 * n[w] else None)
    df = spark.createDataFrame([(w, 1) for w in words] + [(None, 1)], "word string, n int").repartition(3)
    out = {r.word: r for r in spelling.variant_groups(df).collect()}
    assert {w: (r.n, r.n_near, r.form) for w, r in out.items()} == want
    for w, r in out.items():
        last = w
        while want[last][2] is not None:
            last = want[last][2]
        assert r.root == last and r.form_n == (n[r.form] if r.form is not None else None)
    assert spelling.variant_groups(df.limit(0)).count() == 0


def test_filters_hold_every_word_and_few_others(spark):
    rng = random.Random(1)
    words = list({"".join(rng.choices("abcdefgh", k=rng.randint(7, 12))) for _ in range(20_000)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    filters = spelling.Filters({k: sum(len(w) == k for w in words) for k in range(7, 13)})
    bits = spelling.filter_bits(df, filters)
    sums = lambda ws, k: (filters.letters(spelling.code_points(ws, k)) * filters.powers(k)).sum(axis=1, dtype="uint64")
    own = [w for w in words if len(w) == 9]
    assert len(filters.held(bits, sums(own, 9), 9)) == len(own)
    other = ["".join(rng.choices("ijklmn", k=9)) for _ in range(20_000)]
    assert len(filters.held(bits, sums(other, 9), 9)) < 0.02 * len(other)


def test_runs_lose_a_code_point_by_their_digest(spark):
    docs = spark.createDataFrame([(i, "Überraschung straße NAÏVETÉ abcdefg_hijklmn kurz") for i in range(200)] + [(None, "abcdefgh"), (3, None), (4, "")], "doc_id long, text string")
    got = sorted(r.word for r in spelling.runs_of(docs).select(spelling.one_lost(F.col("id"), F.col("run")).alias("word")).collect())
    want = []
    for row in docs.collect():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text or "")
        for run in re.findall("[a-zÀ-ÿ]{7,}", low):
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            want.append(run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run)
    assert got == sorted(want)
