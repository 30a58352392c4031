"""Toxicity scores by a convolutional text classifier trained in numpy.

A word's vector is the mean of hashed embeddings of the word and its character
n-grams (ends marked), so inflected forms share what they learn. Filters of
several widths slide over the words of a whole text; each filter's largest
response, if positive, enters a logistic output. The first embedding component
starts as smoothed log-odds of the hashed features, the rest at random;
everything is then trained by Adam on the log-loss, and the round that does best
on a quarter of the sample, kept out of training, stays.

That quarter also sets the threshold of each language, on the logit, by the
best F1 at the corpus's class shares; languages with few toxic texts take the
common one. A text's language is guessed from its words alone; the score is
1 / (1 + exp(threshold - logit)), so 0.5 is the language's threshold.

``fit`` learns from every labelled text. Up to ``TOXIC`` toxic and ``CLEAN`` other texts are
trained on as one table on the driver (``train``, which draws about that many of a larger corpus by a
hash of the id). Beyond that texts and labels are merged by id and written once. Spark counts the
features of all texts, and in each round every text is trained on in one of at most ``SHARDS`` tasks, each
reading its own part of the written table, whose networks are averaged; the quarter kept out
is counted by language and logit, in steps of 1 / ``STEPS``. Ids, languages, sources and labels are never
inputs of a score. Defined cases: null and empty texts have no words and score
by the output's bias; without labelled texts of both kinds every score is the share of
toxic labels (0 without labels); ties and repeated rows score alike; labels
that are neither 0 nor 1 and labels of unknown documents are not used. Extra
columns are carried by ``score`` and never read.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import dropped, mix64, release, small_batches, texts, whole_row, words, written

TOXIC, CLEAN = 3000, 5000
BUCKETS, DIM = 1 << 16, 12
WIDTHS, FILTERS = (1, 2, 3), 8
GRAMS = (4, 5)
EPOCHS, BATCH, RATE = 5, 64, 0.01
SMOOTHING = 8.0
#: Toxic texts of a language in the calibration quarter for a threshold of its own.
OWN_THRESHOLD = 12
#: Words kept per Python worker; beyond it the table starts anew.
WORDS_KEPT = 400_000
#: Tasks that train a round, at most, and the texts that make another one worthwhile.
SHARDS, SHARD_TEXTS = 16, 8000
#: Steps of a logit, between -30 and 30, by which texts kept out are counted.
STEPS = 256
#: Words scored at once in a task.
BLOCK = 300_000


def features(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, first place of each word's): hashes of each word and of its character n-grams with marked ends."""
    lengths = np.fromiter(map(len, new), dtype=np.int64, count=len(new)) + 2
    data = np.frombuffer(b"<%b>" % b"><".join(new), dtype=np.uint8).astype(np.uint64)
    ends = np.cumsum(lengths)
    counts = 1 + sum(np.maximum(lengths - n + 1, 0) for n in GRAMS)
    starts = np.concatenate([[0], np.cumsum(counts)])
    flat = np.empty(starts[-1], dtype=np.int32)
    flat[starts[:-1]] = np.fromiter(map(xxhash.xxh32_intdigest, new), dtype=np.int64, count=len(new)) % BUCKETS
    at = starts[:-1] + 1
    for n in GRAMS:
        own = np.maximum(lengths - n + 1, 0)
        last = np.cumsum(own)
        nth = np.arange(last[-1])
        places = np.repeat(ends - lengths - (last - own), own) + nth
        key = np.full(max(0, data.size - n + 1), n, dtype=np.uint64)
        for k in range(n):
            key <<= np.uint64(8)
            key |= data[k:k + key.size]
        flat[np.repeat(at - (last - own), own) + nth] = (mix64(key[places]) % np.uint64(BUCKETS)).astype(np.int32)
        at = at + own
    return flat, starts


def numbered(tokens: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words by first place, number of each word of all texts, ends of the texts)."""
    every = list(chain.from_iterable(tokens))
    own = list(dict.fromkeys(every))
    number = dict(zip(own, range(len(own))))
    return own, np.fromiter(map(number.__getitem__, every), dtype=np.int64, count=len(every)), np.cumsum([len(t) for t in tokens])


def stretches(flat: np.ndarray, starts: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the ``used`` words alone, and their first places."""
    lengths = (starts[1:] - starts[:-1])[used]
    own = np.concatenate([[0], np.cumsum(lengths)])
    return flat[np.repeat(starts[used] - own[:-1], lengths) + np.arange(own[-1])], own


class WordTable:
    """Numbers of words and their features, one after another."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(tokens) if w not in self.number]
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.parts.append(features(new))
        return np.fromiter(map(self.number.__getitem__, tokens), dtype=np.int32, count=len(tokens))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        sizes = np.cumsum([0] + [len(f) for f, _ in self.parts])
        starts = [s[:-1] + a for (_, s), a in zip(self.parts, sizes)]
        return np.concatenate([f for f, _ in self.parts]), np.append(np.concatenate(starts), sizes[-1])


def word_vectors(embedding: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean embedding of each word's features; every word has at least one."""
    out = np.empty((len(starts) - 1, embedding.shape[1]), dtype=np.float32)
    for a in range(0, len(out), 1 << 15):  # bounded in memory, whatever the vocabulary
        own = starts[a:a + (1 << 15) + 1]
        sums = np.add.reduceat(embedding.take(flat[own[0]:own[-1]], axis=0), own[:-1] - own[0], axis=0)
        out[a:a + len(own) - 1] = sums / np.diff(own)[:, None].astype(np.float32)
    return out


def summed(to: np.ndarray, of: np.ndarray, values: np.ndarray, like: np.ndarray) -> np.ndarray:
    """An array like ``like`` to whose rows ``to`` the rows ``of`` of ``values`` are added, in order: np.add.at, row by row."""
    out = np.zeros_like(like)
    order = np.argsort(to, kind="stable")
    first = np.flatnonzero(np.diff(to[order], prepend=-1))
    times = np.diff(np.append(first, to.size))
    often = np.argsort(-times, kind="stable")
    first, times, of = first[often], times[often], of[order]
    sums = np.zeros((first.size, like.shape[1]), dtype=like.dtype)
    for k in range(int(times.max(initial=0))):  # the nth row of each target that has so many
        some = np.searchsorted(-times, -k)
        sums[:some] = sums[:some] + values[of[first[:some] + k]]
    out[to[order][first]] = sums
    return out


class Network:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {"embedding": rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)}
        for k in WIDTHS:
            self.p[f"w{k}"] = rng.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32)
            self.p[f"b{k}"] = np.zeros(FILTERS, dtype=np.float32)
        self.p["out"] = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.p["bias"] = np.zeros(1, dtype=np.float32)

    def start_from(self, log_odds: np.ndarray, share: float) -> None:
        """The first filter of each width begins as the log-odds of its words."""
        p = self.p
        p["embedding"][:, 0] = log_odds
        for n, k in enumerate(WIDTHS):
            p[f"w{k}"][:, :, 0] = 0
            p[f"w{k}"][:, 0, 0] = 1
            p["out"][n * FILTERS] = 1
        p["bias"][0] = np.log(share / (1 - share)) - 1

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every place of padded word vectors."""
        out = []
        for k in WIDTHS:
            w = self.p[f"w{k}"]
            z = x[:len(x) - len(WIDTHS) + 1] @ w[0] + self.p[f"b{k}"]
            for j in range(1, k):
                z += x[j:len(x) - len(WIDTHS) + 1 + j] @ w[j]
            out.append(z)
        return out

    def logits(self, x: np.ndarray, starts: np.ndarray, empty: np.ndarray) -> np.ndarray:
        """``x``: word vectors, each text followed by zero rows; ``starts``: the first row of each text."""
        pooled = np.concatenate([np.maximum(np.maximum.reduceat(z, starts, axis=0), 0) for z in self.responses(x)], axis=1)
        pooled[empty] = 0
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradient(self, x: np.ndarray, bounds: list[tuple[int, int]], y: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted log-loss, and (row, gradient) of the word vectors that were largest."""
        grads = {k: np.zeros_like(v) for k, v in self.p.items() if k != "embedding"}
        zs = self.responses(x)
        at = [np.stack([a + z[a:b].argmax(axis=0) for a, b in bounds]) for z in zs]
        top = [np.take_along_axis(z, i, axis=0) for z, i in zip(zs, at)]
        pooled = np.maximum(np.concatenate(top, axis=1), 0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        d = (weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y)).astype(np.float32)
        grads["out"], grads["bias"][0] = d @ pooled, d.sum()
        back = d[:, None] * self.p["out"] * (pooled > 0)
        rows, own = [], []
        for n, k in enumerate(WIDTHS):
            part = back[:, n * FILTERS:(n + 1) * FILTERS]
            grads[f"b{k}"] = part.sum(axis=0)
            for j in range(k):
                seen = x[at[n] + j]  # text, filter, component
                grads[f"w{k}"][j] = np.einsum("tf,tfd->df", part, seen)
                rows.append((at[n] + j).ravel())
                own.append((part[:, :, None] * self.p[f"w{k}"][j].T[None]).reshape(-1, DIM))
        return grads, np.concatenate(rows), np.concatenate(own)


def padded(docs: list[np.ndarray], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors of texts, each followed by a zero row for every width; first rows."""
    pad = np.full(len(WIDTHS), len(vectors))
    whole = np.concatenate([part for d in docs for part in (d, pad)])
    starts = np.cumsum([0] + [len(d) + len(WIDTHS) for d in docs[:-1]])
    return np.concatenate([vectors, np.zeros((1, DIM), dtype=np.float32)])[whole], starts


def best_threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(threshold, F1) of the best weighted F1, halfway between two logits."""
    order = np.argsort(-logit, kind="stable")
    hits, taken = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    f1 = 2 * hits / (taken + (weight * y).sum())
    cut = np.append(logit[order][1:] < logit[order][:-1], True)  # ties stay together
    k = int(np.flatnonzero(cut)[f1[cut].argmax()])
    after = logit[order][k + 1] if k + 1 < len(order) else logit[order][k] - 2
    return float((logit[order][k] + after) / 2), float(f1[k])


class Classifier:
    """A trained network with language guesses and thresholds; small, whatever the corpus."""

    def __init__(self, rows: list[tuple[bytes, int, str]], shares: dict[int, float], seed: int = 1):
        """``rows``: (text, toxic, language) of the sample; ``shares``: part of each class that was sampled."""
        self.langs: list[str] = []
        self.constant: float | None = None
        y = np.array([t for _, t, _ in rows], dtype=np.float32)
        if not rows or y.min() == y.max():
            self.constant = float(y[0]) if rows else 0.0
            return
        table = WordTable()
        docs = [table(words(t)) for t, _, _ in rows]
        flat, starts = table.features()
        keep = np.array([xxhash.xxh32_intdigest(t) % 4 == 0 for t, _, _ in rows])
        if not (keep & (y == 1)).any() or not (keep & (y == 0)).any() or y[~keep].min() == y[~keep].max():
            keep = np.zeros(len(rows), dtype=bool)  # too few to keep any out
        own = np.flatnonzero(~keep)
        self._languages([(docs[i], rows[i][2]) for i in own], table, flat, starts)
        self.network = Network(seed)
        toxic, clean = own[y[own] == 1], own[y[own] == 0]
        seen = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
        for i in own:
            used = np.unique(docs[i])
            seen[int(y[i])][np.unique(np.concatenate([flat[starts[w]:starts[w + 1]] for w in used]))
                            if used.size else []] += 1
        base = SMOOTHING / len(own)
        odds = np.log((seen[1] / len(toxic) + base) / (seen[0] / len(clean) + base))
        self.network.start_from(np.clip(odds, -4, 4), len(toxic) / len(own))
        weight = np.array([1 / shares[int(t)] for t in y])
        held = np.flatnonzero(keep) if keep.any() else own
        best, stayed = -1.0, None
        rng, moments = np.random.default_rng(seed), {}
        steps = 0
        for epoch in range(EPOCHS + 1):
            if epoch:
                for batch in np.array_split(rng.permutation(own), max(1, len(own) // BATCH)):
                    steps += 1
                    self._step([docs[i] for i in batch], y[batch], flat, starts, moments, steps)
            logit = self._logits([docs[i] for i in held], flat, starts)
            f1 = best_threshold(logit, y[held], weight[held])[1]
            if f1 > best:
                best, stayed = f1, {k: v.copy() for k, v in self.network.p.items()}
        self.network.p = stayed
        logit = self._logits([docs[i] for i in held], flat, starts)
        common = best_threshold(logit, y[held], weight[held])[0]
        guess = self._guess([docs[i] for i in held], self._language_rows(flat, starts))
        self.thresholds = np.full(max(1, len(self.langs)), common)
        for k in range(len(self.langs)):
            at = guess == k
            if (y[held][at] == 1).sum() >= OWN_THRESHOLD and (y[held][at] == 0).any():
                self.thresholds[k] = best_threshold(logit[at], y[held][at], weight[held][at])[0]

    def _step(self, docs, y, flat, starts, moments, steps) -> None:
        used, inverse = np.unique(np.concatenate(docs), return_inverse=True)
        self._learn(inverse, np.cumsum([len(d) for d in docs]), y, *stretches(flat, starts, used), moments, steps)

    def _learn(self, inverse, ends, y, joined, own_starts, moments, steps) -> None:
        """One step of Adam on texts that end at ``ends`` of the word numbers ``inverse``; ``joined``: the words' features."""
        lengths, n = np.diff(own_starts), len(own_starts) - 1
        if not n:
            return
        vectors = word_vectors(self.network.p["embedding"], joined, own_starts)
        local = np.split(inverse, ends[:-1])
        pad = np.full(len(WIDTHS), n)
        place = np.concatenate([part for d in local for part in (d, pad)])
        x = np.concatenate([vectors, np.zeros((1, DIM), dtype=np.float32)])[place]
        firsts = np.cumsum([0] + [len(d) + len(WIDTHS) for d in local[:-1]])
        bounds = [(int(a), int(a + max(1, len(d)))) for a, d in zip(firsts, local)]
        grads, rows, own = self.network.gradient(x, bounds, y, np.full(len(y), 1 / len(y), dtype=np.float32))
        word = place[rows]
        real = (word < n) & own.any(axis=1)  # zeros change nothing
        word, own = word[real], own[real] / lengths[word[real]][:, None]
        each = lengths[word]
        # The features of each word that was largest: its stretch of ``joined``.
        ends = np.cumsum(each)
        at = np.repeat(own_starts[word] - (ends - each), each) + np.arange(ends[-1] if ends.size else 0)
        grads["embedding"] = summed(joined[at], np.repeat(np.arange(len(own)), each), own, self.network.p["embedding"])
        for k, g in grads.items():
            m, v, s, t = moments.setdefault(k, tuple(np.zeros_like(g) for _ in range(4)))
            # m += 0.1 * (g - m), v += 0.001 * (g * g - v), p -= RATE * m' / (sqrt(v') + 1e-8), without new arrays
            np.subtract(g, m, out=s)
            m += np.multiply(s, 0.1, out=s)
            np.multiply(g, g, out=s)
            s -= v
            v += np.multiply(s, 0.001, out=s)
            np.divide(m, 1 - 0.9**steps, out=s)
            s *= RATE
            np.sqrt(np.divide(v, 1 - 0.999**steps, out=t), out=t)
            t += 1e-8
            self.network.p[k] -= np.divide(s, t, out=s)

    def _logits(self, docs: list[np.ndarray], flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        vectors = word_vectors(self.network.p["embedding"], flat, starts)
        return self._score(docs, vectors)

    def _score(self, docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
        out, i = np.zeros(len(docs)), 0
        while i < len(docs):
            j, size = i, 0
            while j < len(docs) and (j == i or size + len(docs[j]) <= BLOCK):
                size, j = size + len(docs[j]), j + 1
            x, firsts = padded(docs[i:j], vectors)
            out[i:j] = self.network.logits(x, firsts, np.array([not len(d) for d in docs[i:j]]))
            i = j
        return out

    def _languages(self, rows, table, flat, starts) -> None:
        """Log-probabilities of hashed features by language, for guesses from words alone."""
        self.langs = sorted({lang for _, lang in rows if lang})
        counts = np.ones((BUCKETS, max(1, len(self.langs))))
        place = {lang: k for k, lang in enumerate(self.langs)}
        for lang in self.langs:
            number = Counter()
            for doc, la in rows:
                if la == lang:
                    number.update(doc.tolist())
            for w, n in number.items():
                np.add.at(counts[:, place[lang]], flat[starts[w]:starts[w + 1]], n)
        self.language = np.log(counts / counts.sum(axis=0)).astype(np.float32)

    def _language_rows(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return word_vectors(self.language, flat, starts)

    @staticmethod
    def _guess(docs: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        return np.array([int(rows[d].sum(axis=0).argmax()) if len(d) else 0 for d in docs])

    def scores(self, rows: list[bytes | None], kept: dict) -> list[float]:
        """Scores of whole texts; ``kept`` carries the word table from one call to the next."""
        if self.constant is not None:
            return [self.constant] * len(rows)
        logit, guess = self.judge(rows, kept)
        return (1 / (1 + np.exp(np.clip(self.thresholds[guess] - logit, -30, 30)))).tolist()

    def copied(self) -> Classifier:
        """A classifier with a network of its own, to be trained."""
        out = copy.copy(self)
        out.network = copy.copy(self.network)
        out.network.p = {k: v.copy() for k, v in self.network.p.items()}
        return out

    def judge(self, rows: list[bytes | None], kept: dict) -> tuple[np.ndarray, np.ndarray]:
        """(logit, guessed language) of whole texts."""
        if not kept or len(kept["number"]) > WORDS_KEPT:
            kept.update(number={}, vectors=np.zeros((0, DIM), np.float32), language=np.zeros((0, self.language.shape[1]), np.float32))
        number = kept["number"]
        size, new, docs = len(number), [], []
        for a in range(0, len(rows), BATCH):  # words are numbered among few texts first: small tables are fast
            own, at, ends = numbered([words(t) for t in rows[a:a + BATCH]])
            fresh = [w for w in own if w not in number]
            number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
            new += fresh
            docs += np.split(np.fromiter(map(number.__getitem__, own), dtype=np.int64, count=len(own))[at], ends[:-1])
        if new:
            flat, starts = features(new)
            for name, made in (("vectors", word_vectors(self.network.p["embedding"], flat, starts)), ("language", self._language_rows(flat, starts))):
                if len(number) > len(kept[name]):  # room for more, so that it is not copied at every call
                    kept[name] = np.concatenate([kept[name], np.empty((len(number), made.shape[1]), np.float32)])
                kept[name][size:len(number)] = made
        return self._score(docs, kept["vectors"][:len(number)]), self._guess(docs, kept["language"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          label_col: str = "toxic", toxic: int = TOXIC, clean: int = CLEAN) -> Classifier:
    """Fit on labelled documents; the caller leaves out the labels that may not be learned."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    sizes = {r["y"]: r["n"] for r in known.groupBy(F.col(label_col).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: min(1.0, bound / sizes[y]) for y, bound in ((0, clean), (1, toxic)) if sizes.get(y)}
    if not share:
        return Classifier([], {})
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    least = F.when(F.col(label_col) == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    # About ``toxic + clean`` rows of id and label: bounded by the parameters, so safe to broadcast.
    taken = known.filter(draw < least).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .join(F.broadcast(taken), "id").collect())
    ordered = sorted(((r["text"] or "").encode(), r["y"], r["lang"] or "") for r in rows)
    return Classifier(ordered, share)


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> DataFrame:
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    # Merged at every size, so that rows lie by a hash of their ids, however the input lies.
    return own.join(known.hint("merge"), "id").select("text", "y", "lang", (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("held"))


def _counted(rows: DataFrame) -> pa.Table:
    """(kind, bucket, n): texts of each class by feature ("0", "1") and words of each language by feature ("l" and its name)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sums: dict[str, np.ndarray] = {}
        for batch in small_batches(batches, 512):
            own, at, ends = numbered([words(t) for t in texts(batch.column(0))])
            if not own:
                continue
            flat, starts = features(own)
            for doc, y, lang in zip(np.split(at, ends[:-1]), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if not doc.size:
                    continue
                joined = stretches(flat, starts, doc)[0]
                times = np.bincount(joined, minlength=BUCKETS)
                kinds = sums.setdefault(str(y), np.zeros(BUCKETS, np.int64))
                kinds += times > 0
                if lang:
                    by = sums.setdefault(f"l{lang}", np.zeros(BUCKETS, np.int64))
                    by += times
        for kind, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * at.size, pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             names=["kind", "bucket", "n"])

    # Each task sends its sums: a bounded number of tasks sends a bounded table.
    found = rows.select("text", "y", "lang").coalesce(SHARDS).mapInArrow(run, "kind string, bucket int, n long")
    return found.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows a class and language


def _round(rows: DataFrame, model: Classifier, epoch: int, shards: int) -> dict[str, np.ndarray]:
    """The network after every text was trained on once: each shard goes through its texts, the results are averaged by size."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    order = F.xxhash64("text", F.lit(epoch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own, moments, steps, seen = shared.value.copied(), {}, 0, 0
        for batch in small_batches(batches, BATCH):
            used, at, ends = numbered([words(t) for t in texts(batch.column(0))])
            steps, seen = steps + 1, seen + batch.num_rows
            if used:
                own._learn(at, ends, np.array(batch.column(1), dtype=np.float32), *features(used), moments, steps)
        if seen:
            names = sorted(own.network.p)
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen], pa.int64()), pa.array([[own.network.p[k].astype(np.float32).tobytes() for k in names]], pa.list_(pa.binary()))],
                names=["n", "p"])

    # Rows lie by a hash of their ids already: a shard is some of the stored files, in another order each round. Nothing moves.
    own = rows.select("text", "y").coalesce(shards).sortWithinPartitions(order, "y")
    made = own.mapInArrow(run, "n long, p array<binary>").collect()  # at most SHARDS networks of a fixed size
    total = sum(r["n"] for r in made)
    out = {}
    for i, k in enumerate(sorted(model.network.p)):
        mean = sum(np.frombuffer(bytes(r["p"][i]), dtype=np.float32).astype(np.float64) * (r["n"] / total)
                   for r in sorted(made, key=lambda r: (r["n"], bytes(r["p"][i]))))
        out[k] = mean.astype(np.float32).reshape(model.network.p[k].shape)
    return out


def _judged(rows: DataFrame, model: Classifier) -> np.ndarray:
    """Rows (logit, language, toxic, texts) of the texts kept out, by logit in steps."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own, kept = shared.value, {}
        for batch in small_batches(batches, 512):
            logit, guess = own.judge(list(texts(batch.column(0))), kept)
            at = np.floor(np.clip(logit, -30, 30) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(guess.astype(np.int32)), batch.column(1)], names=["at", "lang", "y"])

    found = rows.select("text", "y").mapInArrow(run, "at int, lang int, y int")
    got = found.groupBy("at", "lang", "y").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by steps and languages
    return np.array(sorted(((r["at"] + 0.5) / STEPS, r["lang"], r["y"], r["n"]) for r in got))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic", toxic: int = TOXIC, clean: int = CLEAN) -> Classifier:
    """Fit on all labelled documents; the caller leaves out the labels that may not be learned."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    sizes = {r["y"]: r["n"] for r in known.groupBy(F.col(label_col).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if sizes.get(1, 0) <= toxic and sizes.get(0, 0) <= clean:
        return train(docs, labels, id_col, text_col, lang_col, label_col, toxic, clean)  # takes them all
    rows = written(_labelled(docs, labels, id_col, text_col, lang_col, label_col), "labelled")
    n = {(r["held"], r["y"]): r["n"] for r in rows.groupBy("held", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    both = [{y for h, y in n if h == held} == {0, 1} for held in (False, True)]
    own, held = (rows.filter("not held"), rows.filter("held")) if all(both) else (rows, rows)
    counts = {y: sum(v for (h, z), v in n.items() if z == y and not (all(both) and h)) for y in (0, 1)}
    if not counts[0] or not counts[1]:
        dropped(rows)
        return Classifier([(b"", y, "") for y in (0, 1) if counts[y]], {0: 1.0, 1: 1.0})
    model = Classifier([], {})
    model.constant, found = None, _counted(own)
    kind, bucket, number = (found.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "bucket", "n"))

    def column(k: str) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[bucket[kind == k]] = number[kind == k]
        return out

    model.langs = sorted(k[1:] for k in set(kind) if k[0] == "l")
    times = np.ones((BUCKETS, max(1, len(model.langs))))
    for i, lang in enumerate(model.langs):
        times[:, i] += column(f"l{lang}")
    model.language = np.log(times / times.sum(axis=0)).astype(np.float32)
    every, model.network = counts[0] + counts[1], Network(1)
    base = SMOOTHING / every
    odds = np.log((column("1") / counts[1] + base) / (column("0") / counts[0] + base))
    model.network.start_from(np.clip(odds, -4, 4).astype(np.float32), counts[1] / every)
    best, stayed, judged = -1.0, None, None
    for epoch in range(EPOCHS + 1):
        if epoch:
            model.network.p = _round(own, model, epoch, max(1, min(SHARDS, every // SHARD_TEXTS)))
        got = _judged(held, model)
        f1 = best_threshold(got[:, 0], got[:, 2], got[:, 3])[1]
        if f1 > best:
            best, stayed, judged = f1, model.network.p, got
    dropped(rows)
    model.network.p = stayed
    model.thresholds = np.full(max(1, len(model.langs)), best_threshold(judged[:, 0], judged[:, 2], judged[:, 3])[0])
    for k in range(len(model.langs)):
        part = judged[judged[:, 1] == k]
        if part[part[:, 2] == 1, 3].sum() >= OWN_THRESHOLD and (part[:, 2] == 0).any():
            model.thresholds[k] = best_threshold(part[:, 0], part[:, 2], part[:, 3])[0]
    return model


def score(docs: DataFrame, model: Classifier, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """score and predicted of every whole text, beside the ``keep`` columns (default: the whole row)."""
    kept = [whole_row(docs)] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS
    rows = docs.select(*kept, F.col(text_col).cast("string").alias("__text"))
    names, out = rows.columns[:-1], rows.drop("__text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own, table = shared.value, {}
        for batch in small_batches(batches, 512):
            values = own.scores(list(texts(batch.column(len(names)))), table)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values, pa.float64()), pa.array([int(v >= 0.5) for v in values], pa.int32())],
                names=[*names, "score", "predicted"])

    return rows.mapInArrow(run, out.add("score", "double").add("predicted", "integer"))
