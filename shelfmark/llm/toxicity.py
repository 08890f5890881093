"""Toxicity by a support vector machine on a subsequence string kernel with Nystroem landmarks.

Strings are the letters of a word: case is folded, what stands between letters of a word (digits, punctuation) is
dropped, and runs of three or more single letters count as one word, so that spelled-out insults are words again.
The kernel counts common subsequences of three and four letters, each weighted by decay to the power of its span in
either string, so gaps and inserted letters cost weight but not the match. It is taken on windows: the subsequences
that begin in eight consecutive letters of a word.

Training takes sentences of labelled documents. A clean document's sentences are clean; in a toxic document only
some are toxic, so witnesses are picked (multiple-instance learning): the windows around letter runs that several toxic
documents hold and, but for one in CLEAN_RATIO at most, no clean ones; a label that is wrong here and there loses no
insult. Witnesses stay; clean windows that score highest are added as hard negatives in each round. Landmarks are witnesses and clean windows; the machine is linear
in the whitened kernel values to the landmarks. As those are linear in the subsequences, the weights fold into one
table of subsequences, and a text's score is the highest window sum: a few table reads a letter, with no further
look at landmarks, exactly the machine's decision value. Logistic calibration turns it into 0 to 1.

The fit reads about SAMPLE_DOCS labelled documents a class at most, chosen by a hash of the id, and takes windows from
them up to the numbers in Bounds; it is the same on every run. Scoring reads every text.

Letters beyond a to z are told apart by the last six bits of their second byte, folded into 13 classes, and the byte
before it is dropped: scripts share these classes, so a word of one script can look like one of another.

Defined cases: a null or empty text, or one without letters, scores 0; without labels of both classes every text
scores the share of label 1 (0 if there is none); labels other than 0 and 1 are not read; repeated labels and rows
count once in the fit, two labels of one document count both; repeated rows get equal scores; an empty table gives an empty result; extra columns are kept by `score_documents` and, if
their names clash with its own, replaced.
"""

from __future__ import annotations

import itertools
import math
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_task, crc_fold, small_batches, text_chunks

SAMPLE_DOCS = {0: 3000, 1: 1500}
#: Toxic documents a clean one that holds a letter run, for the run to be a witness's.
CLEAN_RATIO = 20
DECAY = 0.75
#: Where between the highest clean text and the calibration's middle the score is one half.
LEAN = 0.7
#: Weight of errors on insults, of which there are far fewer than clean windows.
COST = {1: 30.0, -1: 10.0}
WINDOW = 8
#: Letter classes: 0 parts words, 1 to 26 are a to z, the rest fold the second bytes of other letters.
CLASSES = 40
SPAN = {3: 5, 4: 6}
SHARE = {3: 0.25, 4: 1.0}
TAIL = max(SPAN.values()) - 1
#: Lengths of letter runs, a word's start counting as a letter, by which first witnesses are found.
RUNS = range(4, 8)
_DROP = 255


@dataclass(frozen=True)
class Bounds:
    """Numbers of windows that the fit takes at most: witnesses, those that share one letter run, stretched ones, clean
    ones at first, clean ones added a round, and landmarks."""

    witnesses: int = 2000
    per_run: int = 40
    stretched: int = 4000
    clean: int = 6000
    hard: int = 1500
    landmarks: int = 256


_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")


def _class_table() -> np.ndarray:
    table = np.full(256, _DROP, np.uint8)
    table[list(b" \t\n\r\x0b\x0c\xff")] = 0
    for i in range(26):
        table[[65 + i, 97 + i]] = 1 + i
    rest = np.arange(0x80, 0xC0)
    table[rest] = 27 + (rest & 31) % (CLASSES - 27)
    return table


_CLASS_OF = _class_table()


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of all texts, one after the other, and where each begins; a 0 ends each text."""
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    classes = _CLASS_OF[joined]
    keep = classes != _DROP
    count = np.cumsum(keep)
    ends, classes = count[ends - 1], classes[keep]
    breaks = np.flatnonzero(classes == 0)
    single = np.diff(breaks, prepend=-1) == 2  # a word of one letter stands before this break
    if single.any():
        after = np.append(single[1:], False)
        run = single & after & (np.append(False, single[:-1]) | np.append(after[1:], False))
        run &= ~np.isin(breaks, ends - 1)
        if run.any():
            keep = np.ones(len(classes), bool)
            keep[breaks[run]] = False
            count = np.cumsum(keep)
            ends, classes = count[ends - 1], classes[keep]
    return classes, np.append(0, ends[:-1])


def _shapes(length: int) -> Iterator[tuple[int, list[tuple[int, ...]]]]:
    """(span, places of a subsequence's letters) of subsequences of this length, by span."""
    for span in range(length, SPAN[length] + 1):
        yield span, [(0, *inner, span - 1) for inner in itertools.combinations(range(1, span - 1), length - 2)]


def window_sums(classes: np.ndarray, tables: dict[int, np.ndarray]) -> np.ndarray:
    """For each place the sum over subsequences that begin in the WINDOW letters from it on, in the same word."""
    n = len(classes)
    padded = np.append(classes, np.zeros(TAIL + 1, np.uint8)).astype(np.int32)
    at = [padded[k : k + n] for k in range(TAIL + 1)]
    inside = [at[0] != 0]
    for k in range(1, TAIL + 1):
        inside.append(inside[-1] & (at[k] != 0))
    total = np.zeros(n, np.float32)
    for length, table in tables.items():
        for span, shapes in _shapes(length):
            part = np.zeros(n, np.float32)
            for shape in shapes:
                code = at[shape[0]]
                for place in shape[1:]:
                    code = code * CLASSES + at[place]
                part += table[code]
            part *= np.float32(DECAY**span)
            part[~inside[span - 1]] = 0
            total += part
    upto = np.append(0.0, np.cumsum(total, dtype=np.float64))
    breaks = np.flatnonzero(classes == 0)
    word_end = np.repeat(breaks, np.diff(breaks, prepend=-1))
    end = np.minimum(np.arange(n) + WINDOW, word_end)
    return upto[end] - upto[:-1]


def document_sums(texts: list[bytes], tables: dict[int, np.ndarray]) -> np.ndarray:
    """The highest window sum of each text; -inf without letters."""
    classes, begin = encode(texts)
    sums = window_sums(classes, tables)
    sums[classes == 0] = -np.inf
    return np.maximum.reduceat(sums, begin)


def _features(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, subsequence, weight) of the kernel's explicit features; equal pairs are summed later."""
    width = WINDOW + TAIL
    grid = np.zeros((len(windows), width + TAIL + 1), np.int64)
    for i, w in enumerate(windows):
        grid[i, : len(w)] = np.frombuffer(w, np.uint8)
    which, codes, weights = [], [], []
    offset = 0
    for length in SPAN:
        for span, shapes in _shapes(length):
            fits = (np.arange(WINDOW) + span)[None, :] <= np.array([len(w) for w in windows])[:, None]
            rows, places = np.nonzero(fits)
            for shape in shapes:
                code = np.zeros(len(rows), np.int64)
                for place in shape:
                    code = code * CLASSES + grid[rows, places + place]
                which.append(rows)
                codes.append(code + offset)
                weights.append(np.full(len(rows), DECAY**span * math.sqrt(SHARE[length])))
        offset += CLASSES**length
    return np.concatenate(which), np.concatenate(codes), np.concatenate(weights)


def _kernel(windows: list[bytes], landmarks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Kernel values of windows (rows) to landmarks, given as known subsequences and their dense weights."""
    known, dense = landmarks
    out = np.zeros((len(windows), dense.shape[1]), np.float32)
    for first in range(0, len(windows), 500):
        part = windows[first : first + 500]
        which, codes, weights = _features(part)
        place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        hit = known[place] == codes
        which, place, weights = which[hit], place[hit], weights[hit]
        matrix = np.zeros((len(part), len(known)), np.float32)
        np.add.at(matrix, (which, place), weights)
        out[first : first + 500] = matrix @ dense
    return out


def _landmark_features(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    which, codes, weights = _features(windows)
    known, place = np.unique(codes, return_inverse=True)
    dense = np.zeros((len(known), len(windows)), np.float32)
    np.add.at(dense, (place, which), weights)
    return known, dense


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> np.ndarray:
    """Squared-hinge support vector machine in the primal, by Newton steps; the last weight is the bias."""
    n = x.shape[1] + 1
    w = np.zeros(n)
    ridge = np.append(np.ones(n - 1), 1e-3)
    for _ in range(steps):
        grad, hess = ridge * w, np.diag(ridge)
        for first in range(0, len(x), 2000):  # in slices: the matrix is the largest thing here
            part = slice(first, first + 2000)
            xs = np.hstack([x[part].astype(np.float64), np.ones((len(y[part]), 1))])
            margin = 1 - y[part] * (xs @ w)
            live = margin > 0
            xs, cs = xs[live], cost[part][live]
            grad -= xs.T @ (cs * y[part][live] * margin[live])
            hess += (xs * cs[:, None]).T @ xs
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(f: np.ndarray, y: np.ndarray, toxic_share: float) -> tuple[float, float]:
    """Slope and shift of a calibration under the population's shares; a small ridge keeps parted classes finite."""
    weight = np.where(y == 1, toxic_share / max(1, y.sum()), (1 - toxic_share) / max(1, (1 - y).sum()))
    scale = float(np.std(f)) or 1.0
    a, b = 1.0 / scale, -float(np.median(f)) / scale
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -30, 30)))
        g = np.array([(weight * (p - y) * f).sum() + 1e-4 * a * scale**2, (weight * (p - y)).sum()])
        s = weight * p * (1 - p)
        h = np.array([[(s * f * f).sum() + 1e-4 * scale**2, (s * f).sum()], [(s * f).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / (1e-9 + np.abs(step).max() * max(1.0, scale)))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class ToxicityModel:
    """Folded weights: subsequence codes and values by length, the calibration, or a constant score."""

    codes: dict[int, np.ndarray]
    values: dict[int, np.ndarray]
    slope: float = 0.0
    shift: float = 0.0
    constant: float | None = None

    def tables(self) -> dict[int, np.ndarray]:
        out = {}
        for length, codes in self.codes.items():
            out[length] = np.zeros(CLASSES**length, np.float32)
            out[length][codes] = self.values[length]
        return out

    def scores(self, sums: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(sums), self.constant)
        z = np.where(np.isfinite(sums), self.slope * np.where(np.isfinite(sums), sums, 0) + self.shift, -np.inf)
        return np.where(np.isfinite(z), 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0.0)


def _words(classes: np.ndarray, begin: np.ndarray) -> list[list[bytes]]:
    raw = classes.tobytes()
    ends = np.append(begin[1:], len(classes))
    return [[w for w in raw[a:b].split(b"\0") if w] for a, b in zip(begin, ends)]


def _runs(word: bytes, n: int) -> set[bytes]:
    """Runs of n letters of a word; one at its start also with that start."""
    anchored = b"\0" + word
    return {anchored[k : k + n] for k in range(len(anchored) - n + 1)}


def _best_window(word: bytes, sums: np.ndarray) -> bytes:
    at = int(np.argmax(sums[: max(1, len(word) - 2)]))
    return word[at : at + WINDOW + TAIL]


def _sample(items: list, n: int, key) -> list:
    return sorted(items, key=key)[:n]


def _order(w: bytes) -> int:
    return zlib.crc32(w)


def fit(texts: list[bytes], labels: list[int], toxic_share: float | None = None, rounds: int = 4, bounds: Bounds = Bounds()) -> ToxicityModel:
    """Trains on whole texts with labels 0 and 1; toxic_share is the population's. Deterministic, whatever the order."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    texts, y = [texts[i] for i in order], np.array([labels[i] for i in order])
    if not len(y) or y.min() == y.max():
        return ToxicityModel({}, {}, constant=float(y.mean()) if len(y) else 0.0)
    toxic_share = float(y.mean()) if toxic_share is None else toxic_share
    # Sentences of each document; one that several documents share counts once.
    sentence_docs: dict[bytes, int] = {}
    for i, text in enumerate(texts):
        for s in _SENTENCE.findall(text.decode("utf-8", "replace")):
            sentence_docs.setdefault(s.encode(), i)
    toxic_words: dict[bytes, set[int]] = defaultdict(set)
    clean_words: dict[bytes, int] = {}  # in how many clean documents
    last_doc: dict[bytes, int] = {}
    sentences = list(sentence_docs.items())
    del sentence_docs
    for first in range(0, len(sentences), 5000):
        part = sentences[first : first + 5000]
        for words, (_, doc) in zip(_words(*encode([s for s, _ in part])), part):
            if y[doc]:
                for w in words:
                    toxic_words[w].add(doc)
            else:
                for w in words:
                    if last_doc.get(w) != doc:  # a document's sentences follow each other
                        last_doc[w] = doc
                        clean_words[w] = clean_words.get(w, 0) + 1
    del sentences, last_doc
    # Letter runs that toxic documents hold and clean ones next to never do, in more documents than chance explains. Lengths
    # are taken one by one and only counted first, to keep the table of runs small.
    by_doc: dict[int, list[bytes]] = defaultdict(list)
    for w, docs in toxic_words.items():
        for d in docs:
            by_doc[d].append(w)
    grams: dict[bytes, set[int]] = {}
    distinct = 0
    for n in RUNS:
        held: Counter = Counter()
        for ws in by_doc.values():
            held.update(set().union(*[_runs(w, n) for w in ws]))
        clean_held: Counter = Counter()
        for w, count in clean_words.items():
            for g in _runs(w, n):
                if g in held:
                    clean_held[g] += count
        for g, count in clean_held.items():
            if held[g] < CLEAN_RATIO * count:
                del held[g]
        distinct += len(held)
        often = {g for g, count in held.items() if count >= 2}
        del held
        grams |= {g: set() for g in often}
        for w, docs in toxic_words.items():
            for g in _runs(w, n) & often:
                grams[g] |= docs
    share = max(0.05, float(y.mean()))
    least = max(3, math.ceil(math.log(10 * (distinct + 1)) / -math.log(share)))
    seeds = {g: len(docs) for g, docs in grams.items() if len(docs) >= least}
    covered = set().union(*[grams[g] for g in seeds]) if seeds else set()
    rest = {g: left for g, docs in grams.items() if len(docs) >= 2 and g not in seeds and (left := docs - covered)}
    while rest:
        g = max(rest, key=lambda k: (len(rest[k]), k))
        if len(rest[g]) < max(3, least - 2):
            break
        seeds[g] = len(rest[g])
        gone = rest.pop(g)
        rest = {k: left for k, d in rest.items() if (left := d - gone)}
    by_seed: dict[bytes, set[bytes]] = defaultdict(set)
    for w in toxic_words:
        held = [g for n in RUNS for g in _runs(w, n) if g in seeds]
        if held:
            best = max(held, key=lambda g: (seeds[g], len(g), g))
            at = max(0, (b"\0" + w).index(best) - 2)
            by_seed[best].add(w[at : at + WINDOW + TAIL])
    witness = sorted(set().union(*[_sample(list(ws), bounds.per_run, _order) for ws in by_seed.values()])) if by_seed else []
    if not witness:
        return ToxicityModel({}, {}, constant=toxic_share)
    witness = _sample(witness, bounds.witnesses, _order)
    clean = sorted(w[: WINDOW + TAIL] for w in clean_words if len(w) >= 3)
    negative = set(_sample(clean, bounds.clean, _order))
    model = None
    for _ in range(rounds):
        # Insertions: what the machine must also tolerate.
        stretched = [w[:k] + bytes([1 + (w[0] * 7 + k * 5) % 26]) + w[k:] for w in witness for k in range(1, min(5, len(w)))]
        positive = sorted(set(witness) | set(_sample(stretched, bounds.stretched, _order)))
        negatives = sorted(negative - set(positive))
        marks = _sample(witness, bounds.landmarks // 2, _order) + _sample(negatives, bounds.landmarks // 2, _order)
        known, dense = _landmark_features(marks)
        gram = dense.T @ dense
        values, vectors = np.linalg.eigh(gram.astype(np.float64))
        keep = values > 1e-6 * values.max()
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        x = _kernel(positive + negatives, (known, dense)) @ whiten.astype(np.float32)
        target = np.append(np.ones(len(positive)), -np.ones(len(negatives)))
        cost = np.where(target > 0, COST[1], COST[-1])
        w = _svm(x, target, cost)
        folded = dense @ (whiten @ w[:-1])
        codes, vals, low = {}, {}, 0
        for length in SPAN:
            part = (known >= low) & (known < low + CLASSES**length)
            codes[length] = known[part] - low
            vals[length] = (folded[part] * math.sqrt(SHARE[length])).astype(np.float32)
            low += CLASSES**length
        model = ToxicityModel(codes, vals)
        tables = model.tables()
        # Hard negatives: the highest windows of clean words.
        words = sorted(clean_words)
        sums = np.concatenate([document_sums(words_as_texts(words[i : i + 20_000]), tables) for i in range(0, len(words), 20_000)])
        hard = [words[i] for i in np.argsort(-sums, kind="stable")[: bounds.hard]]
        before = len(negative)
        for word in hard:
            c = np.frombuffer(word + b"\0", np.uint8)
            negative.add(_best_window(word, window_sums(c, tables)))
        if len(negative) == before:
            break
    best = np.concatenate([document_sums(texts[i : i + 100], tables) for i in range(0, len(texts), 100)])
    seen = np.isfinite(best)
    model.slope, model.shift = _logistic(best[seen], y[seen].astype(float), toxic_share)
    # Where classes are parted, the middle lies far from clean texts; insults with inserted letters fall between.
    clean_top = float(np.quantile(best[seen & (y == 0)], 0.9995)) if (seen & (y == 0)).any() else -math.inf
    half = -model.shift / model.slope if model.slope > 0 else -math.inf
    if clean_top < half:
        model.shift = -model.slope * (clean_top + LEAN * (half - clean_top))
    return model


def words_as_texts(words: list[bytes]) -> list[bytes]:
    """Class strings back as bytes that `encode` maps to the same classes."""
    back = np.zeros(256, np.uint8)
    for code in range(1, 27):
        back[code] = 96 + code
    for byte in range(0x80, 0xA0):
        back[_CLASS_OF[byte]] = byte
    raw = back[np.frombuffer(b"\0".join(words), np.uint8)].tobytes()
    return raw.split(b"\0")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: dict[int, int] = SAMPLE_DOCS) -> tuple[DataFrame, float] | None:
    """Whole texts and labels (text, y) of about so many documents a class outside the held-out fold, chosen by a hash
    of the id, and the share of label 1 in all of that fold; None without labels."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold("doc_id") != 0))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts:
        return None
    steps = 1 << 20
    rate = {y: min(steps, math.ceil(steps * sample[y] / n)) for y, n in counts.items()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(steps))
    picked = known.filter(draw < F.coalesce(*[F.when(F.col("y") == y, F.lit(r)) for y, r in rate.items()]))
    # Repeated rows and labels count once. The few thousand rows that the sample should have are those of least hashes,
    # so the fit is the same on every run even where many rows share an id.
    picked = picked.distinct()
    most = 2 * sum(sample.values())
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)  # two numbers a row: safe to broadcast
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "y", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    return rows.orderBy(F.xxhash64("doc_id", "h"), "doc_id", "y", "h").limit(most).select("text", "y"), counts.get(1, 0) / sum(counts.values())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: dict[int, int] = SAMPLE_DOCS) -> ToxicityModel:
    """Fits in one task on the bounded sample, so that its working memory is an executor's, and brings the model back."""
    small_batches(docs.sparkSession)
    drawn = labelled_sample(docs, labels, label, sample)
    if drawn is None:
        return ToxicityModel({}, {}, constant=0.0)
    rows, share = drawn

    @arrow_task("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for batch in batches:
            texts += batch.column(0).cast(pa.binary()).to_pylist()
            y += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, y, share))], pa.binary())], names=["model"])

    fitted = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(fitted[0]["model"]) if fitted else ToxicityModel({}, {}, constant=share)


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All columns, then score and predicted; every whole text is read once, a few megabytes at a time."""
    small_batches(docs.sparkSession)
    kept = docs.drop(*[c for c in ("score", "predicted") if c in docs.columns])
    names = kept.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_task("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        for batch in batches:
            scores = []
            for first, end, data, offsets in text_chunks(batch.column(at), 1 << 20):
                raw = data.tobytes()
                scores.append(shared.value.scores(document_sums([raw[a:b] for a, b in zip(offsets, offsets[1:])], tables) if tables else np.zeros(end - first)))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, score double, predicted int")
