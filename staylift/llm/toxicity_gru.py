"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters as a word input and a character input; the network reads overlapping windows of words, and a text's
score is that of its worst window.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Windows: their words, and the words from one to the next. Characters: lengths of the n-grams, in bytes with a boundary.
WINDOW, STRIDE = 48, 24
GRAMS = (3, 4, 5, 6, 7)
#: Most word and n-gram entries with a vector of their own, vector length, hidden units per direction.
ENTRIES, WIDTH, HIDDEN = 4096, 3, 8
TABLE = 1 << 16
#: The fit reads at most so many documents per class, of at most so many characters each.
SAMPLE, SAMPLE_CHARS = 1500, 8_000
#: Toxic documents that must share a word or n-gram before it can get an entry.
LEAST = 3

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BREAKS = np.zeros(256, bool)
_BREAKS[[9, 10, 11, 12, 13, 32]] = True
#: ASCII punctuation is no part of a word here; letters are lower-cased; other bytes stay.
_DROPPED = np.array([chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), base, np.uint64)]))[:n]


class Words:
    """The words of many texts as hashes: one per word, and those of each word's n-grams.

    Bytes are hashed by running sums, so that any stretch costs one subtraction. A word is bounded by one blank on either
    side, which belongs to its n-grams.
    """

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
        kept = ~_DROPPED[raw]
        data, owner = _LOWER[raw[kept]], owner[kept]
        blank = _BREAKS[data]
        # Of each run of white space one blank stays.
        stay = ~blank | np.concatenate([[True], ~blank[:-1]])
        data, owner, blank = data[stay], owner[stay], blank[stay]
        if not len(data) or not blank[0]:
            data, owner, blank = np.concatenate([[32], data]), np.concatenate([[0], owner]), np.concatenate([[True], blank])
        at = np.flatnonzero(blank)
        self.start, self.end = at[:-1] + 1, at[1:]
        self.owner = owner[self.start] if len(self.start) else np.zeros(0, np.int64)
        values = np.where(blank, 1, data.astype(np.uint64) + 2)
        n = len(values)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_MULTIPLIER, n), dtype=np.uint64)])
        back = _powers(_INVERSE, n)
        self._sums, self._back = sums, back
        self.hashes = _mixed((sums[self.end] - sums[self.start]) * back[self.start]) if len(self.start) else np.zeros(0, np.uint64)

    def grams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all stretches of ``length`` bytes that lie in one word and its blanks, and their words (ascending)."""
        counts = np.maximum(self.end - self.start + 2 - length + 1, 0)
        words = np.repeat(np.arange(len(counts)), counts)
        first = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts) + (self.start - 1)[words]
        return _mixed((self._sums[first + length] - self._sums[first]) * self._back[first] + np.uint64(length)), words


@dataclass
class Lookup:
    """Hashes with an entry: two tables by low bits, checked by the full hash."""

    keys: np.ndarray
    entries: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> Lookup:
        """Earlier hashes win a place that two want; the other has no entry."""
        keys, entries = np.zeros(TABLE, np.uint64), np.zeros(TABLE, np.int32)
        for entry, h in list(enumerate(hashes.tolist(), 1))[::-1]:
            keys[h % TABLE], entries[h % TABLE] = h, entry
        return cls(keys, entries)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes & np.uint64(TABLE - 1)).astype(np.int64)
        return np.where(self.keys[place] == hashes, self.entries[place], 0)


def _evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Lower bound of the log odds of occurring in a toxic document: what is rare proves little."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return odds - 2.33 * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def _documents_with(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and in how many documents each occurs."""
    order = np.lexsort((owners, hashes))
    h, o = hashes[order], owners[order]
    if not len(h):
        return h, np.zeros(0, np.int64)
    once = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
    return np.unique(h[once], return_counts=True)


def _chunks(texts: list[str], at_once: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in stretches of about ``at_once`` characters, each with the place of its first."""
    held, size, first = [], 0, 0
    for k, text in enumerate(texts):
        held.append(text.encode())
        size += len(text)
        if size >= at_once or k == len(texts) - 1:
            yield first, held
            held, size, first = [], 0, k + 1


def _without_copies(texts: list[str], marks: int = 16, alike: int = 10) -> list[str]:
    """Texts that no earlier one resembles by min-hash marks of its words: else a copied text's every word gives evidence."""
    sketches = np.full((len(texts), marks), np.iinfo(np.uint64).max)
    for first, own in _chunks(texts):
        words = Words(own)
        starts = np.flatnonzero(np.diff(words.owner, prepend=-1))
        for k in range(marks if len(starts) else 0):
            sketches[words.owner[starts] + first, k] = np.minimum.reduceat(_mixed(words.hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))), starts)
    kept: list[int] = []
    for i in range(len(texts)):
        if not kept or (sketches[kept] == sketches[i]).sum(axis=1).max() < alike:
            kept.append(i)
    return [texts[i] for i in kept]


def _telling(toxic: list[str], clean: list[str], hashed) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that tell of toxic documents, strongest first, with their evidence; ``hashed`` gives hashes and owners."""
    kinds, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _, texts in _chunks(toxic):
        h, n = _documents_with(*hashed(Words(texts)))
        both, place = np.unique(np.concatenate([kinds, h]), return_inverse=True)
        kinds, counts = both, np.bincount(place, np.concatenate([counts, n]), len(both)).astype(np.int64)
    kinds, counts = kinds[counts >= LEAST], counts[counts >= LEAST]
    others = np.zeros(len(kinds), np.int64)
    for _, texts in _chunks(clean) if len(kinds) else ():
        h, owners = hashed(Words(texts))
        place = np.minimum(np.searchsorted(kinds, h), len(kinds) - 1)
        known = kinds[place] == h
        h, n = _documents_with(place[known].astype(np.uint64), owners[known])
        others[h.astype(np.int64)] += n
    force = _evidence(counts, others, len(toxic), len(clean))
    kinds, force = kinds[force > 0], force[force > 0]
    best = np.lexsort((kinds, -force))[:ENTRIES]
    return kinds[best], force[best]


@dataclass
class Model:
    words: Lookup
    grams: Lookup
    #: Value by which the strongest n-gram of a word is chosen.
    strength: np.ndarray
    weights: dict[str, np.ndarray]

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Entries of each word and of the strongest of its known n-grams (0: none)."""
        best, force = np.zeros(len(words.start), np.int32), np.zeros(len(words.start))
        for length in GRAMS:
            hashes, owners = words.grams(length)
            found = self.grams.find(hashes)
            hit = np.flatnonzero(found)
            entry, word = found[hit], owners[hit]
            order = np.argsort(self.strength[entry], kind="stable")
            entry, word = entry[order], word[order]
            stronger = self.strength[entry] > force[word]
            # Ascending strength: the last write of a word is its strongest n-gram.
            best[word[stronger]] = entry[stronger]
            force[word[stronger]] = self.strength[entry[stronger]]
        return self.words.find(words.hashes), best


def _windows(owners: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, words and text of each window; every text has one, blank ones of no words."""
    n = np.bincount(owners, minlength=texts)
    first = np.cumsum(n) - n
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(texts), count)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(turn * STRIDE, np.maximum(n - WINDOW, 0)[text])
    return first[text] + start, np.minimum(n, WINDOW)[text], text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(p: dict, word: np.ndarray, gram: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
    """Logits of windows. word, gram: entries, steps x windows; mask: 1 where a word stands."""
    steps, size = word.shape
    cache: dict = {"h": {}, "gates": {}}
    states = []
    for way in "fb":
        # Projections of all entries at once: the loop only looks them up.
        by_word = p["word"] @ p["Ww" + way]
        by_gram = p["gram"] @ p["Wg" + way]
        h, run = np.zeros((size, HIDDEN), np.float32), np.empty((steps, size, HIDDEN), np.float32)
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        for t in order:
            x = by_word[word[t]] + by_gram[gram[t]] + p["b" + way]
            u = h @ p["U" + way]
            z = _sigmoid(x[:, :HIDDEN] + u[:, :HIDDEN])
            r = _sigmoid(x[:, HIDDEN : 2 * HIDDEN] + u[:, HIDDEN : 2 * HIDDEN])
            new = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            m = mask[t][:, None]
            if keep:
                cache["gates"][way, t] = (h, u, z, r, new)
            h = h + m * z * (new - h)
            run[t] = h
        states.append(run)
    both = np.concatenate(states, axis=2)
    inner = np.tanh(both @ p["A"])
    score = inner @ p["a"]
    score = np.where(mask > 0, score, -30)
    share = np.exp(score - score.max(axis=0))
    share /= share.sum(axis=0)
    pooled = np.einsum("ts,tsh->sh", share, both)
    if keep:
        cache |= {"both": both, "inner": inner, "share": share, "pooled": pooled}
    return pooled @ p["v"] + p["c"][0], cache


def _backward(p: dict, word: np.ndarray, gram: np.ndarray, mask: np.ndarray, cache: dict, slope: np.ndarray) -> dict:
    """Gradients for the slope of the loss by each window's logit."""
    g = {k: np.zeros_like(v) for k, v in p.items()}
    both, inner, share, pooled = (cache[k] for k in ("both", "inner", "share", "pooled"))
    g["v"], g["c"][0] = pooled.T @ slope, slope.sum()
    d_pooled = slope[:, None] * p["v"]
    d_both = share[:, :, None] * d_pooled
    d_share = np.einsum("tsh,sh->ts", both, d_pooled)
    d_score = share * (d_share - (share * d_share).sum(axis=0)) * (mask > 0)
    g["a"] = np.einsum("tsk,ts->k", inner, d_score)
    d_inner = d_score[:, :, None] * p["a"] * (1 - inner**2)
    g["A"] = np.einsum("tsh,tsk->hk", both, d_inner)
    d_both += d_inner @ p["A"].T
    steps, size = word.shape
    for k, way in enumerate("fb"):
        d_run = d_both[:, :, k * HIDDEN : (k + 1) * HIDDEN]
        d_words, d_grams = np.zeros((len(p["word"]), 3 * HIDDEN), np.float32), np.zeros((len(p["gram"]), 3 * HIDDEN), np.float32)
        dh = np.zeros((size, HIDDEN), np.float32)
        order = range(steps - 1, -1, -1) if way == "f" else range(steps)
        for t in order:
            h, u, z, r, new = cache["gates"][way, t]
            dh = dh + d_run[t]
            m = mask[t][:, None]
            d_new, dz = dh * m * z * (1 - new**2), dh * m * (new - h) * z * (1 - z)
            dr = d_new * u[:, 2 * HIDDEN :] * r * (1 - r)
            dx = np.concatenate([dz, dr, d_new], axis=1)
            du = np.concatenate([dz, dr, d_new * r], axis=1)
            g["U" + way] += h.T @ du
            g["b" + way] += dx.sum(axis=0)
            np.add.at(d_words, word[t], dx)
            np.add.at(d_grams, gram[t], dx)
            dh = dh * (1 - m * z) + du @ p["U" + way].T
        g["Ww" + way] += p["word"].T @ d_words
        g["Wg" + way] += p["gram"].T @ d_grams
        g["word"] += d_words @ p["Ww" + way].T
        g["gram"] += d_grams @ p["Wg" + way].T
    return g


def _gathered(entries: np.ndarray, first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries as steps x windows, cut to the longest window, and the mask."""
    steps = max(1, int(words.max(initial=0)))
    place = first[None, :] + np.arange(steps)[:, None]
    mask = np.arange(steps)[:, None] < words[None, :]
    padded = np.append(entries, 0)
    return padded[np.where(mask, place, len(entries))], mask.astype(np.float32)


def _logits(model: Model, word: np.ndarray, gram: np.ndarray, first: np.ndarray, count: np.ndarray, at_once: int = 1024) -> np.ndarray:
    out, order = np.empty(len(first), np.float32), np.argsort(count, kind="stable")
    for k in range(0, len(order), at_once):
        own = order[k : k + at_once]
        w, mask = _gathered(word, first[own], count[own])
        out[own] = _forward(model.weights, w, _gathered(gram, first[own], count[own])[0], mask)[0]
    return out


def scores(model: Model, texts: list[str | None], at_once: int = 1 << 17) -> np.ndarray:
    """Probability of the worst window of each text. Memory follows ``at_once`` characters, or the longest text."""
    found = []
    for _, part in _chunks([t or "" for t in texts], at_once):
        words = Words(part)
        word, gram = model.inputs(words)
        first, count, text = _windows(words.owner, len(part))
        worst = np.full(len(part), -np.inf, np.float32)
        np.maximum.at(worst, text, _logits(model, word, gram, first, count))
        found.append(_sigmoid(worst.astype(np.float64)))
    return np.concatenate(found) if found else np.zeros(0)


def train(texts: list[str], label: list[int], epochs: int = 10, steps: int = 100, batch: int = 64, rate: float = 0.02, seed: int = 7) -> Model:
    """Fit on labelled texts, from the texts alone.

    Words and n-grams get an entry if documents give evidence for or against; the first number of a vector starts as that
    evidence. Each epoch scores all windows and learns from every text's worst one (by Adam); small samples get more
    epochs, ``steps`` updates at least. Without any toxic text, all texts score low.
    """
    rng = np.random.default_rng(seed)
    kinds = [_without_copies([t for t, own in zip(texts, label, strict=True) if own == k]) for k in (1, 0)]
    # Blank texts are clean by definition.
    kinds[1] += [""] * max(1, len(texts) // 50)
    toxic, clean = map(len, kinds)
    texts, y = [*kinds[0], *kinds[1]], np.repeat(np.array([1, 0], np.float32), [toxic, clean])
    def grams_of(length: int) -> Callable[[Words], tuple[np.ndarray, np.ndarray]]:
        def hashed(words: Words) -> tuple[np.ndarray, np.ndarray]:
            hashes, owners = words.grams(length)
            return hashes, words.owner[owners]

        return hashed

    word_hash, word_force = _telling(*kinds, lambda words: (words.hashes, words.owner))
    # One length at a time, so that no more than the n-grams of one length are held.
    found = [_telling(*kinds, grams_of(length)) for length in GRAMS]
    gram_hash, gram_force = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    best = np.lexsort((gram_hash, -gram_force))[:ENTRIES]
    gram_hash, gram_force = gram_hash[best], gram_force[best]

    def table(force: np.ndarray) -> np.ndarray:
        vectors = rng.normal(0, 0.05, (len(force) + 1, WIDTH)).astype(np.float32)
        vectors[1:, 0], vectors[0] = force, 0
        return vectors

    def matrix(*shape: int) -> np.ndarray:
        return (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {"word": table(word_force), "gram": table(gram_force), "A": matrix(2 * HIDDEN, HIDDEN), "a": matrix(HIDDEN), "v": matrix(2 * HIDDEN), "c": np.zeros(1, np.float32)}
    for way in "fb":
        p |= {"Ww" + way: matrix(WIDTH, 3 * HIDDEN), "Wg" + way: matrix(WIDTH, 3 * HIDDEN), "U" + way: matrix(HIDDEN, 3 * HIDDEN), "b" + way: np.zeros(3 * HIDDEN, np.float32)}
    model = Model(Lookup.of(word_hash), Lookup.of(gram_hash), np.concatenate([[0.0], gram_force]), p)
    if not toxic:
        # Nothing to tell apart: every text is clean, and surely so.
        p["v"][:], p["c"][:] = 0, -4
        return model
    parts, owners = [], []
    for at, own in _chunks(texts):
        words = Words(own)
        parts.append(model.inputs(words))
        owners.append(words.owner + at)
    word, gram = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
    first, count, text = _windows(np.concatenate(owners), len(texts))
    moment, square, turn = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    epochs = max(epochs, -(-steps // -(-len(y) // batch)))
    for epoch in range(epochs):
        logit = _logits(model, word, gram, first, count)
        order = np.lexsort((logit, text))
        worst = order[np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)]
        mixed = rng.permutation(len(worst))
        for k in range(0, len(mixed), batch):
            own = worst[mixed[k : k + batch]]
            w, mask = _gathered(word, first[own], count[own])
            g_, _ = _gathered(gram, first[own], count[own])
            logits, cache = _forward(p, w, g_, mask, keep=True)
            slope = ((_sigmoid(logits) - y[text[own]]) / len(own)).astype(np.float32)
            grads = _backward(p, w, g_, mask, cache, slope)
            turn += 1
            step = rate * min(1.0, 2 * (1 - epoch / epochs))
            norm = np.sqrt(sum(float((x**2).sum()) for x in grads.values()))
            for name, grad in grads.items():
                grad = grad / max(1.0, norm)
                moment[name] = 0.9 * moment[name] + 0.1 * grad
                square[name] = 0.99 * square[name] + 0.01 * grad**2
                p[name] -= (step * (moment[name] / (1 - 0.9**turn)) / (np.sqrt(square[name] / (1 - 0.99**turn)) + 1e-6)).astype(np.float32)
    return model


# --- on tables -----------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt: a third, by checksum of the id; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Model:
    """Train on labelled documents that are not held out: at most ``sample`` per class, of at most ``chars`` characters.

    The sample is the first by a hash of the id, chosen among the labels before any document is read; contradictory
    and null labels are left out. This bounds what comes to the driver, whatever the size of the tables.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    known = known.filter("toxic = most AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id")))
    chosen = [known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for kind in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("id"), "toxic")
    texts = docs.select("doc_id", "text").filter(F.length("text") <= chars)
    found = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["id"]).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sorted((r.doc_id, r.text, r.toxic) for r in found.collect())
    return train([r[1] for r in rows], [r[2] for r in rows])


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_hash and score of every document, over all overlapping windows of its whole text.

    Null and empty texts have one window without words. Equal texts have equal scores. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            values = pa.array(scores(shared.value, part["text"].to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["text_hash"], values], ["doc_id", "text_hash", "score"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(marked, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash LONG, score DOUBLE")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The documents whose score stays below ``threshold``, with all columns of ``docs`` whatever their names.

    Rows are judged where they are, without a shuffle. Null and empty texts stay unless the model thinks blank texts toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            yield part.filter(pa.array(scores(shared.value, part.column(place).to_pylist()) < threshold))

    return docs.mapInArrow(kept, docs.schema)
