"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

A word is a string of folded letters; whatever stands between them (dots,
stars, hyphens) leaves a gap. The kernel of two words counts their common
subsequences of four letters, gaps included, each weighted by ``DECAY`` to the
length it spans, and is normalised; so ``tr.a-sh`` is near ``trash`` and
inserted letters cost a little. Runs of single letters are one word.

Training (on the driver, from a bounded sample) is multiple-instance: the
sentences of a document carry its label, a sentence is as toxic as its worst
word, and the worst words of toxic documents and of clean documents are chosen
anew in each round. The SVM is linear in the Nystroem features
``K_mm^(-1/2) k_m(x)`` of the landmark words. Since its decision is then a
weighted sum of subsequence counts, those weights are written out as one
four-letter table, and scoring a word costs its subsequences instead of a
kernel evaluation per landmark; the values are the same. The two worst word
places of a text give its probability by logistic calibration on sample
documents that were not trained on.

Documented bound: the sample is at most ``SAMPLE`` toxic and ``SAMPLE`` clean
labelled documents, those with the smallest id hashes. Labels are read for rows
whose crc32 of the id as text leaves a remainder other than 0 by 5.

Defined results: null and empty texts score like a text whose words are all
harmless; rows without a label are scored like any other; repeated label rows
count once, ids whose label rows contradict each other are left out of the
sample; without labels of both kinds every score is 0; words of more than
``LONGEST`` letters are scored by overlapping parts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsort.llm.common import worker_state

SAMPLE = 3000
LANDMARKS = 128
DECAY = 0.6
ORDER = 4
LONGEST = 14
ROUNDS = 3
COST = 4.0
FOLDS = 5
CACHE = 700_000
BLOCK = 3000  # words in one array, few enough for a processor's cache
AT_ONCE = 500  # texts whose words are looked up together
HARMLESS = -1.0  # the negative margin; decisions are not told apart below it
LETTERS = 48  # codes: 0 begin of a word, 1-26 a-z, 27-47 other letters

# Characters commonly written for letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
# Marks that end a word and are no part of it.
ENDS = ".,;:!?"


def _code(c: str) -> int:
    c = LOOKALIKE.get(c, c)
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 21 if c.isalpha() else 0


def _codes() -> np.ndarray:
    """Code of every character of the basic plane; 0 for what is no letter."""
    return np.array([_code(chr(k)) for k in range(0xD800)] + [0] * (0x10000 - 0xD800), np.int8)


class Parts:
    """Words of the same number of letters, letters by words: whose they are, letter codes (0 first if the word begins here) and places."""

    def __init__(self, owner: np.ndarray, codes: np.ndarray, places: np.ndarray):
        self.owner, self.codes, self.places = owner, codes, places

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.codes[:, k:k + 1], self.places[:, k:k + 1]


def fold(words: list[str]) -> Iterator[Parts]:
    """The parts of words of at least three letters: one, unless a word is very long."""
    table = worker_state("toxicity letters", _codes)
    text = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.cumsum(text == 10)
    codes = table[np.minimum(text, 0xFFFF)]
    at = np.flatnonzero(codes)
    codes, word = codes[at].astype(np.int64), word[at]
    n = np.bincount(word, minlength=len(words))
    begin = np.cumsum(n) - n
    sections: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}
    own, k = np.flatnonzero(n >= 3), 0
    while len(own):
        left = np.minimum(n[own] - k, LONGEST)
        for size in np.unique(left).tolist():
            if k == 0 or size >= ORDER:
                some = own[left == size]
                sections.setdefault((size, k == 0), []).append((some, begin[some] + k))
        k += LONGEST // 2
        own = own[(n[own] > LONGEST) & (n[own] > k)]
    for (size, marked), found in sections.items():
        owner, first = (np.concatenate(x) for x in zip(*found, strict=True))
        for a in range(0, len(owner), BLOCK):
            rows = first[None, a:a + BLOCK] + np.arange(size)[:, None]
            places = np.minimum(at[rows] - at[rows[:1]] + 1, 4 * LONGEST).astype(np.float64)
            c = codes[rows]
            if marked:
                c, places = np.r_[np.zeros_like(c[:1]), c], np.r_[np.zeros_like(places[:1]), places]
            yield Parts(owner[a:a + BLOCK], c, places)


def _kernel(c1: np.ndarray, p1: np.ndarray, c2: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Subsequence kernel of words side by side: codes and places of shapes (a, n) and (b, n) or (b, 1)."""
    same = c1[:, None] == c2[None, :]
    decay = (DECAY ** p1)[:, None] * (DECAY ** p2)[None, :]
    k = same * (DECAY ** 2 / decay)  # in units of the decay up to the last letters
    for _ in range(ORDER - 1):
        s = np.cumsum(np.cumsum(k, axis=0), axis=1)
        k = np.zeros_like(s)
        k[1:, 1:] = s[:-1, :-1] * same[1:, 1:]
    return (k * decay).sum(axis=(0, 1))


def _norm(p: Parts) -> np.ndarray:
    places = p.places.astype(np.float32)
    return np.maximum(np.sqrt(_kernel(p.codes, places, p.codes, places)), 1e-9)


def gram(words: list[str], landmarks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Normalised kernel of every word (its first part) with every landmark."""
    own = [float(_norm(Parts(np.zeros(1), *m))[0]) for m in landmarks]
    out = np.zeros((len(words), len(landmarks)))
    for p in fold(words):
        if p.codes[0, 0] == 0:
            scale = _norm(p)
            for m, (c, places) in enumerate(landmarks):
                out[p.owner, m] = _kernel(p.codes, p.places, c, places) / scale / own[m]
    return out


def first_parts(words: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Codes and places of the words that are one part."""
    return {words[i]: p[k] for p in fold(words) if p.codes[0, 0] == 0 and len(p.codes) <= LONGEST for k, i in enumerate(p.owner.tolist())}


def one_part(words: list[str]) -> set[str]:
    """The words that ``first_parts`` would give, without their codes."""
    return {words[a + i] for a in range(0, len(words), 50_000) for p in fold(words[a:a + 50_000])
            if p.codes[0, 0] == 0 and len(p.codes) <= LONGEST for i in p.owner.tolist()}


def words_of(text: str | None) -> list[str]:
    """Lower-cased words of several characters; three or more single characters in a row are one word."""
    text = (text or "").lower()
    for stop in ENDS:
        text = text.replace(stop + " ", " ").replace(stop + "\n", "\n")
    words = text.split()
    out = [w for w in words if len(w) > 1]
    if len(words) - len(out) > 2:
        run: list[str] = []
        for w in [*words, "  "]:
            if len(w) == 1:
                run.append(w)
            else:
                if len(run) > 2:
                    out.append(" ".join(run))
                run = []
    return out


def weight_table(landmarks: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> np.ndarray:
    """The decision's weight of every four-letter subsequence."""
    table = np.zeros((LETTERS,) * ORDER)
    for (c, p), w in zip(landmarks, weights, strict=True):
        n = float(_norm(Parts(np.zeros(1), c, p))[0])
        for at in combinations(range(len(c)), ORDER):
            table[tuple(int(c[k, 0]) for k in at)] += w / n * DECAY ** (p[at[-1], 0] - p[at[0], 0] + 1)
    return table.astype(np.float32)


class Model:
    """``table`` and ``bias`` decide on words, ``calibration`` (two slopes, intercept) on texts."""

    def __init__(self, table: np.ndarray, bias: float, calibration: tuple[float, float, float]):
        self.table, self.bias, self.calibration = table.ravel(), bias, calibration
        self.seen: set[str] = set()
        self.known: dict[str, float] = {}

    def decide(self, p: Parts) -> np.ndarray:
        c, n = p.codes, len(p.codes)
        head, tail = DECAY ** (1 - p.places), DECAY ** p.places
        low = {(k, m): c[k] * LETTERS + c[m] for k in range(2, n) for m in range(k + 1, n)}
        total = np.zeros(c.shape[1])
        for i in range(n - 3):
            inner = np.zeros(c.shape[1])
            for j in range(i + 1, n - 2):
                high = (c[i] * LETTERS + c[j]) * LETTERS ** 2
                for m in range(j + 2, n):
                    for k in range(j + 1, m):
                        inner += self.table[high + low[k, m]] * tail[m]
            total += inner * head[i]
        return total / _norm(p) + self.bias

    def suspects(self, words: set[str]) -> dict[str, float]:
        """The decisions above the negative margin, of all words seen so far; every other word is harmless."""
        new = words - self.seen
        if len(self.seen) + len(new) > CACHE:
            self.seen, self.known, new = set(), {}, words
        if new:
            names = list(new)
            best = np.full(len(names), HARMLESS)
            for p in fold(names):
                np.maximum.at(best, p.owner, self.decide(p))
            self.known.update((names[k], float(best[k])) for k in np.flatnonzero(best > HARMLESS).tolist())
            self.seen |= new
        return self.known

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The two highest word decisions (repeats included) of each text."""
        out = np.full((len(texts), 2), HARMLESS)
        for a in range(0, len(texts), AT_ONCE):
            lists = [words_of(t) for t in texts[a:a + AT_ONCE]]
            known = self.suspects(set().union(*lists))
            for k, ws in enumerate(lists, a):
                top = sorted((known[w] for w in ws if w in known), reverse=True)[:2]
                out[k, :len(top)] = top
        return out

    def probability(self, worst: np.ndarray) -> np.ndarray:
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * worst[:, 0] + b * worst[:, 1] + c, -30, 30)))


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights (the last one the bias) of the linear SVM, by Newton steps on the rows within the margin."""
    x = np.c_[x, np.ones(len(x))]
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w, before = np.zeros(x.shape[1]), None
    for _ in range(50):
        inside = y * (x @ w) < 1
        if before is not None and (inside == before).all():
            break
        part = x[inside] * cost[inside, None]
        w = np.linalg.solve(ridge + part.T @ x[inside], part.T @ y[inside])
        before = inside
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last one the intercept) by ridge-damped Newton steps."""
    x, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * w
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(w)), grad)
    return w


def fit(texts: list[str], labels: list[int], calibrate: list[bool]) -> Model:
    """Learn from whole texts; those marked ``calibrate`` only set the probabilities."""
    bags = [Counter(words_of(t)) for t in texts]
    train = [k for k, c in enumerate(calibrate) if not c]
    toxic, clean = [k for k in train if labels[k]], [k for k in train if not labels[k]]
    in_toxic, in_clean = Counter(), Counter()
    for k in train:
        (in_toxic if labels[k] else in_clean).update(bags[k].keys())
    lift = {w: np.log((n + 0.1) / len(toxic)) - np.log((in_clean[w] + 0.1) / len(clean)) if n > 1 else -9.0 for w, n in in_toxic.items()}
    folded = one_part(sorted({w for k in train for w in bags[k]}))
    usual = sorted((w for w in in_clean if w in folded), key=lambda w: (-in_clean[w], w))
    spread = usual[:1500] + usual[1500::max(1, (len(usual) - 1500) // 2500)][:2500]
    model = None
    for _ in range(ROUNDS):
        if model is None:
            value = lambda w: lift.get(w, -9.0)
        else:
            known = model.suspects({w for k in train for w in bags[k]})
            value = lambda w: known.get(w, HARMLESS)
        bad = Counter()
        for k in toxic:
            bad.update(sorted((w for w in bags[k] if w in folded), key=lambda w: (-value(w), w))[:2])
        if model is None:
            bad = Counter({w: n for w, n in bad.items() if lift.get(w, -9.0) > 1.0})
            hard = Counter()
        else:
            bad = Counter({w: n for w, n in bad.items() if lift.get(w, 0.0) > 0.5 or n > 1})
            hard = Counter(max((w for w in bags[k] if w in folded), key=lambda w: (value(w), w)) for k in clean if any(w in folded for w in bags[k]))
        if not bad:
            return Model(np.zeros((LETTERS,) * ORDER, np.float32), HARMLESS, (0.0, 0.0, -30.0))
        hard = [w for w, _ in hard.most_common(3000)]
        good = [w for w in dict.fromkeys([*spread, *hard]) if w not in bad]
        positive = [w for w, _ in bad.most_common(3000)]
        half = LANDMARKS // 2
        marks = positive[:half] + (hard[:half // 2] or spread[:half // 2]) + spread[::max(1, len(spread) // half)][:half]
        names = list(dict.fromkeys(marks))
        parts = first_parts(names)
        marks = [parts[w] for w in names]
        values, vectors = np.linalg.eigh(gram(names, marks))
        root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T  # K_mm^(-1/2)
        x = gram(positive + good, marks) @ root
        y = np.r_[np.ones(len(positive)), -np.ones(len(good))]
        cost = np.r_[np.full(len(positive), COST * len(good) / len(positive)), np.full(len(good), COST)]
        w = squared_hinge(x, y, np.minimum(cost, 4 * COST))
        model = Model(weight_table(marks, root @ w[:-1]), float(w[-1]), (1.0, 0.0, 0.0))
    rest = [k for k, c in enumerate(calibrate) if c and bags[k]] or train
    worst = model.worst([texts[k] for k in rest])
    model.calibration = tuple(logistic(worst, np.array([labels[k] for k in rest], float)).tolist())
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on the bounded sample of labelled documents outside the held-out fold."""
    fold_no = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS
    one = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"), fold_no.alias("fold"))
           .filter("fold <> 0 AND y IS NOT NULL").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top"), F.min("fold").alias("fold"))
           .filter("y = top").select("id", "y", "fold"))
    picked = None
    for y in (0, 1):
        part = one.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # At most 2 * sample ids by that limit: the bounded side goes to the documents.
    rows = texts.join(F.broadcast(picked), "id").select("id", "text", "y", "fold").orderBy("id", "text").collect()
    if len({r["y"] for r in rows}) < 2:
        return Model(np.zeros((LETTERS,) * ORDER, np.float32), HARMLESS, (0.0, 0.0, -30.0))
    return fit([r["text"] for r in rows], [r["y"] for r in rows], [r["fold"] == 1 for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns, or all) and score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.table.reshape((LETTERS,) * ORDER), model.bias, model.calibration))
    key = f"toxicity {sent.id if hasattr(sent, 'id') else sent._jbroadcast.id()}"
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_state(key, lambda: Model(*sent.value))
        for batch in batches:
            p = own.probability(own.worst(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p)], ["row", "score"])

    return src.mapInArrow(scan, f"row {src.schema['row'].dataType.simpleString()}, score double")
