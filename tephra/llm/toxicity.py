"""Toxicity by a support vector machine on a gapped-subsequence string kernel with Nystroem landmarks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_by_text, crc_part, hashed_share, table

DECAY = 0.6
#: Distances between neighbouring characters of a subsequence of three: up to two characters may lie between.
STEPS = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3)]
#: Similarities below this are not listed by similar(); far below that of an insult with a letter put between each pair (0.11). Features have no floor.
FLOOR = 0.02
#: Longer words are seen in overlapping windows.
WIDEST, WINDOW = 14, 10
#: Stands before a word's first character: no letter or digit, so no word has it.
START = "^"
POWER = 8
#: What a landmark counts all of whose runs of three are there with gaps of up to two characters.
GAPPED = 0.95
REMEMBER, AT_ONCE = 200_000, 10_000
NOT_ALNUM = re.compile(r"[\W_]+")


def forms(text: str) -> list[str]:
    """The words of a text, lower-cased, as often as they occur; runs of three or more single characters also count as the word they spell."""
    words = text.lower().split()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    single = np.flatnonzero(np.diff(np.concatenate([[0], sizes == 1, [0]])))
    return words + ["".join(words[a:b]) for a, b in zip(single[::2], single[1::2]) if b - a >= 3]


def stretches(word: str) -> list[str]:
    """A word's letters and digits behind a mark for its start; a long word in overlapping windows of about a landmark's length, so that its norm drowns no match.

    Where every other character is the same filler, the word without it counts too.
    """
    word = NOT_ALNUM.sub("", word)
    whole = START + word if word else ""
    out = [whole] if len(word) <= WIDEST else [whole[k:k + WINDOW] for k in range(0, len(whole) - WINDOW // 2, WINDOW // 2)]
    for k in (0, 1):
        if len(word) >= 7 and word[k::2] == word[k] * len(word[k::2]):
            out.append(START + word[1 - k::2][:WIDEST])
    return out


def subsequences(word: str) -> Counter:
    """The explicit feature map: subsequences of three characters, each weighted by DECAY for every character it skips."""
    out: Counter = Counter()
    for a, b in STEPS:
        for i in range(len(word) - a - b):
            out[word[i], word[i + a], word[i + a + b]] += DECAY ** (a + b - 2)
    return out


class Landmarks:
    """Kernel values between words and a fixed set of strings."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        maps = [subsequences(s) for s in strings]
        self.norm = np.sqrt([sum(v * v for v in m.values()) for m in maps])
        letters = sorted({c for s in strings for c in s})
        self.letter = {c: i for i, c in enumerate(letters)}
        self.base = len(letters) + 1
        self.alphabet = np.array([ord(c) for c in letters], np.uint32)
        self.loose = np.ones(len(strings))
        features: dict[str, list[tuple[int, float]]] = {}
        for k, m in enumerate(maps):
            for (a, b, c), v in m.items():
                features.setdefault(a + b + c, []).append((k, v))
        self.place = np.full(self.base ** 3, -1, np.int32)
        self.place[[(self.letter[a] * self.base + self.letter[b]) * self.base + self.letter[c] for a, b, c in features]] = np.arange(len(features))
        self.begin = np.cumsum([0] + [len(v) for v in features.values()])
        self.who = np.array([k for v in features.values() for k, _ in v], np.int64)
        self.weight = np.array([x for v in features.values() for _, x in v])
        runs = [{s[k:k + 3] for k in range(len(s) - 2)} for s in strings]
        self.run = np.array([("".join(f) in runs[k]) / len(runs[k]) for f, k in zip((f for f, v in features.items() for _ in v), self.who)])

    def values(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Three rows for each word: its similarity k(w, l) / sqrt(k(w, w) k(l, l)) to each landmark l; how much of l it holds, k(w, l) / k(l, l) up to 1;
        and the share of l's runs of three characters that it holds with gaps, whatever stands in them."""
        m, n = len(self.strings), len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
        kinds, own = np.unique(chars, return_inverse=True)
        spot = np.minimum(np.searchsorted(self.alphabet, kinds), len(self.alphabet) - 1)
        code, base = np.where(self.alphabet[spot] == kinds, spot, self.base - 1), max(1, len(kinds))
        owner = np.repeat(np.arange(n), sizes)
        keys, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b in STEPS:
            at = np.flatnonzero(owner[:max(0, len(chars) - a - b)] == owner[a + b:])
            keys.append(((owner[at] * base + own[at]) * base + own[at + a]) * base + own[at + a + b])
            weights.append(np.full(len(at), DECAY ** (a + b - 2)))
        keys = np.concatenate(keys)
        if not len(keys):
            return np.zeros((n, m)), np.zeros((n, m)), np.zeros((n, m))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        each, keys = np.add.reduceat(np.concatenate(weights)[order], first), keys[first]
        who, x, y, z = keys // base ** 3, keys // base ** 2 % base, keys // base % base, keys % base
        norm = np.sqrt(np.bincount(who, each * each, n))
        f = self.place[(code[x] * self.base + code[y]) * self.base + code[z]]
        who, each, f = who[f >= 0], each[f >= 0], f[f >= 0]
        many = self.begin[f + 1] - self.begin[f]
        entry = np.repeat(self.begin[f] - np.cumsum(many) + many, many) + np.arange(many.sum())
        cells = np.repeat(who * m, many) + self.who[entry]
        dots = np.bincount(cells, self.weight[entry] * np.repeat(each, many), n * m).reshape(n, m)
        runs = np.bincount(cells, self.run[entry], n * m).reshape(n, m)
        return dots / (np.maximum(norm, 1e-9)[:, None] * self.norm), np.minimum(dots / self.norm ** 2, 1), runs

    def loosen(self, clean: list[str]) -> None:
        """Matches with gaps throughout count for the landmarks that hardly any word of the clean texts matches so."""
        pieces = sorted({s for t in clean for w in set(forms(t)) for s in stretches(w)})
        met = sum(((self.values(pieces[k:k + AT_ONCE])[2] > 0.999).sum(0) for k in range(0, len(pieces), AT_ONCE)), np.zeros(len(self.strings)))
        self.loose = (met <= max(1, len(clean) / 500)).astype(float)

    def similar(self, words: list[str]) -> list[tuple]:
        """For each word the (landmark, similarity) pairs from FLOOR up."""
        return [tuple((k, float(row[k])) for k in np.flatnonzero(row >= FLOOR)) for row in self.values(words)[0]]


class Features:
    """A text's greatest similarity to each landmark, which a match with gaps throughout reaches too, and beside it a text-level kernel: the sum over its words, as often as they occur, of how
    much of the landmark they hold (POWER sharpens it), by the fourth root of their number. Words already met are remembered, up to a bound."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks, self.known = landmarks, {}
        self.rows = np.zeros((1024, 2 * len(landmarks.strings)), np.float32)

    def of(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), 2 * len(self.landmarks.strings)))
        held, size = [], 0
        for i, t in enumerate(texts):
            counts = Counter(forms(t))
            held.append((i, list(counts), np.fromiter(counts.values(), np.float32, len(counts))))
            if (size := size + len(counts)) >= AT_ONCE or i == len(texts) - 1:
                self.fill(held, out)
                held, size = [], 0
        return out

    def fill(self, held: list[tuple], out: np.ndarray) -> None:
        m = len(self.landmarks.strings)
        if len(self.known) > REMEMBER:
            self.known.clear()
        new = [w for w in dict.fromkeys(w for _, words, _ in held for w in words) if w not in self.known]
        for at in range(0, len(new), AT_ONCE):
            self.learn(new[at:at + AT_ONCE])
        for i, words, counts in held:
            best, total = np.zeros(m, np.float32), np.zeros(m, np.float32)
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            for k in range(0, len(at), AT_ONCE):
                v = self.rows[at[k:k + AT_ONCE]]
                best = np.maximum(best, v[:, :m].max(0))
                total += counts[k:k + AT_ONCE] @ v[:, m:]
            out[i, :m], out[i, m:] = best, total / max(1.0, counts.sum()) ** 0.25

    def learn(self, words: list[str]) -> None:
        pieces = [stretches(w) for w in words]
        sizes = np.fromiter(map(len, pieces), np.int64, len(words))
        near, held, gapped = self.landmarks.values([s for p in pieces for s in p])
        gapped = GAPPED * gapped ** POWER * self.landmarks.loose
        found = np.hstack([np.maximum(near, gapped), np.maximum(held ** POWER, gapped)]).astype(np.float32)
        found = np.maximum.reduceat(found, np.cumsum(sizes) - sizes)
        start = len(self.known)
        if start + len(words) > len(self.rows):
            more = np.zeros((max(2 * len(self.rows), start + len(words)), found.shape[1]), np.float32)
            more[:start] = self.rows[:start]
            self.rows = more
        self.rows[start:start + len(words)] = found
        self.known.update(zip(words, range(start, start + len(words))))


def choose_landmarks(toxic: list[str], clean: list[str], count: int, seed: int = 7) -> list[str]:
    """Strings of four to eight characters that together cover the toxic texts, then at most as many words of clean texts.

    A string that clean texts hold too may still tell by how often it occurs: once, twice or three times in a text are judged apart.
    """
    def parts(text: str, among: set[str] | None = None) -> set[tuple[str, int]]:
        seen: Counter = Counter()
        for w, n in Counter(forms(text)).items():
            for p in {s[k:k + size] for s in stretches(w) for size in (4, 5, 6, 7, 8) for k in range(len(s) - size + 1)}:
                if among is None or p in among:
                    seen[p] += n
        return {(p, times) for p, n in seen.items() for times in range(1, min(n, 3) + 1)}

    bags = [parts(t) for t in toxic]
    seen = Counter(p for b in bags for p in b)
    wanted = {p for p, n in seen.items() if n > 1}
    among = {p for p, _ in wanted}
    bad = Counter(p for t in clean for p in parts(t, among) & wanted)
    rate = len(toxic) / max(1, len(clean))
    pool = {p: set() for p in wanted if seen[p] >= 9 * rate * (bad[p] + 0.5)}
    for i, b in enumerate(bags):
        for p in b & pool.keys():
            pool[p].add(i)
    chosen: list[str] = []
    need = np.full(len(toxic), 3)                                  # each toxic text by up to three strings
    gain_of = lambda p, n: (n - 3 * rate * bad[p]) * len(p[0].strip(START))
    ranked = sorted(pool, key=lambda p: (-gain_of(p, len(pool[p])), START in p[0], p))
    while len(chosen) < count * 3 // 4 and ranked:
        best, gain = None, 5 * max(3, len(toxic) // 50)            # a string of a few texts may be there by chance
        for p in ranked:
            if gain_of(p, len(pool[p])) <= gain:
                break
            if (g := gain_of(p, int((need[list(pool[p])] > 0).sum()))) > gain:
                best, gain = p, g
        if best is None:
            break
        chosen.append(best[0])
        need[list(pool[best])] -= 1
        taken = {best[0][k:k + 3] for k in range(len(best[0]) - 2)}
        ranked = [p for p in ranked if 2 * sum(p[0][k:k + 3] in taken for k in range(len(p[0]) - 2)) < len(p[0]) - 2]
    plain = sorted({s for t in clean for w in set(forms(t)) for s in stretches(w) if len(s) >= 5} - set(chosen))
    rng = np.random.default_rng(seed)
    return chosen + [plain[i] for i in sorted(rng.choice(len(plain), min(len(plain), count - len(chosen), max(8, len(chosen))), replace=False))]


class Classifier:
    """A linear SVM on Nystroem coordinates, its margins turned into probabilities."""

    def __init__(self, landmarks: Landmarks, features: np.ndarray, labels: np.ndarray, cost: float = 10.0):
        self.landmarks = landmarks
        maps = [subsequences(s) for s in landmarks.strings]
        gram = np.array([[sum(v * b.get(f, 0.0) for f, v in a.items()) for b in maps] for a in maps]) / np.outer(landmarks.norm, landmarks.norm)
        # k(., L) K_LL^(-1/2): coordinates in which the kernel is the dot product, for the greatest similarities and for the sums of powers
        self.whiten = [self.coordinates(g) for g in (gram, gram ** POWER)]
        x, y = self.mapped(features), np.where(labels > 0, 1.0, -1.0)
        fold = np.arange(len(y)) % 4
        margins = np.zeros(len(y))
        for k in range(4):                                         # margins of texts that the machine has not seen
            margins[fold == k] = x[fold == k] @ self.solved(x[fold != k], y[fold != k], cost)
        self.slope, self.offset = self.platt(margins, y)
        self.weights = self.solved(x, y, cost)

    @staticmethod
    def coordinates(gram: np.ndarray) -> np.ndarray:
        value, vector = np.linalg.eigh(gram)
        kept = value > 1e-6
        return vector[:, kept] / np.sqrt(value[kept])

    def mapped(self, features: np.ndarray) -> np.ndarray:
        m = len(self.landmarks.strings)
        return np.c_[features[:, :m] @ self.whiten[0], features[:, m:] @ self.whiten[1], np.ones(len(features))]

    @staticmethod
    def solved(x: np.ndarray, y: np.ndarray, cost: float) -> np.ndarray:
        """Squared hinge loss by Newton steps on the active rows; classes weigh the same."""
        share = np.where(y > 0, max(1, len(y)) / (2 * max(1, (y > 0).sum())), max(1, len(y)) / (2 * max(1, (y < 0).sum()))) * cost / max(1, len(y))
        w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 1e-2
        active = None
        for _ in range(50):
            on = y * (x @ w) < 1
            if active is not None and (on == active).all():
                break
            active = on
            a = x[on] * share[on, None]
            w = np.linalg.solve(ridge + a.T @ x[on], a.T @ y[on])
        return w

    @staticmethod
    def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Logistic fit of the margins with Platt's smoothed targets."""
        pos, neg = (y > 0).sum(), (y < 0).sum()
        goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        z, p = np.c_[margins, np.ones(len(y))], np.array([1.0, 0.0])
        for _ in range(100):
            q = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
            step = np.linalg.solve(z.T @ (z * np.maximum(q * (1 - q), 1e-9)[:, None]) + 1e-3 * np.eye(2), z.T @ (q - goal) + 1e-3 * p)
            p = p - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        return float(max(p[0], 1e-6)), float(p[1])

    def scores(self, features: np.ndarray) -> np.ndarray:
        margins = self.mapped(features) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -700, 700)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", landmarks: int = 96, max_toxic: int = 1_000, max_clean: int = 2_000) -> Classifier | None:
    """Fit on a bounded sample: about `max_toxic` and `max_clean` labelled ids by hash, with their whole texts; None if either kind is missing or they hold no words."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).alias("label"))
    sides = known.agg(F.count_if(F.col("label") > 0).alias("toxic"), F.count_if(F.col("label") <= 0).alias("clean")).first()
    pick = lambda of, n, total: [r.label_id for r in known.where(of & hashed_share(F.col("label_id"), n, total)).collect()]
    bad = set(pick(F.col("label") > 0, max_toxic, sides.toxic))
    good = set(pick(F.col("label") <= 0, max_clean, sides.clean))
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(bad | good)], f"label_id {known.schema['label_id'].dataType.simpleString()}")
    # about max_toxic + max_clean ids, so the hint is safe
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).join(F.broadcast(ids), F.col("id") == F.col("label_id"), "left_semi").collect()
    texts = {r.text: max(0, r.id in bad) for r in sorted(rows, key=lambda r: (r.id in bad, r.id))}      # copies count once
    toxic, clean = sorted(t for t, x in texts.items() if x), sorted(t for t, x in texts.items() if not x)
    if not toxic or not clean:
        return None
    strings = choose_landmarks(toxic, clean, landmarks)
    if not strings:
        return None
    chosen = Landmarks(strings)
    chosen.loosen(clean)
    order = np.random.default_rng(3).permutation(len(texts))
    both, marks = toxic + clean, np.array([1] * len(toxic) + [0] * len(clean))
    return Classifier(chosen, Features(chosen).of([both[i] for i in order]), marks[order])


def toxicity(docs: DataFrame, model: Classifier | None, text_col: str = "text", threshold: float = 0.7, keep_text: bool = True) -> DataFrame:
    """`docs` with score double (0 to 1) and predicted int for each whole text.

    A text is as toxic as its words: each is compared with the landmarks by a kernel on subsequences of three characters with gaps, so
    inserted characters, spaced letters and other endings still match; the machine weighs the greatest similarities, and sums over all words.
    Null and empty texts have none and get the score of no evidence. Without a model (no labels of both kinds) scores are 0.
    Extra columns stay; score and predicted are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable[[list[str]], list[list]]:
        own = shared.value
        features = Features(own.landmarks) if own else None

        def work(texts: list[str]) -> list[list]:
            s = own.scores(features.of(texts)).tolist() if own else [0.0] * len(texts)
            return [s, [int(x >= threshold) for x in s]]
        return work
    return add_by_text(docs, text_col, "score double, predicted int", start, keep_text)


def op3_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_part(F.col("doc_id"), 3) != 1))
    out = toxicity(docs.withColumn("held_out", crc_part(F.col("doc_id"), 3) == 1), model, keep_text=False)
    return out.select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLES: dict[str, str] = {}
