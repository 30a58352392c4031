"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to ``ORDER`` bytes long counts
which byte followed each context in the training texts. The statistics are then
frozen, and a text's code length under a language is the exact sum over its
bytes of the bits that PPM spends: the byte's bits in the longest context that
has seen it, plus the escape bits of the longer contexts that have not (method
C: with n followers seen, d of them different, a byte seen k times costs
-log2(k / (n + d)), an escape -log2(d / (n + d)); a context never seen costs
nothing; below order 0 all 256 bytes are alike). The language with the
shortest code wins; the score is its share of the posterior, from bits per byte.

Since the statistics are frozen, the bits of a byte depend on it and the
``ORDER`` bytes before it alone, so the trees are flattened to tables of
byte strings (one per length) with one column of bits per language.

Training takes about ``SAMPLE`` texts of each language, chosen by a hash of the
id; everything else covers whole texts and all rows. Upper case is folded for
A-Z only. Defined cases: null texts and texts without a letter are ``und``
with score 0; ties go to the first language by code point; without any labelled
text all are ``und``. Rows repeated are scored alike; extra columns are
carried by ``detect`` and never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import release, small_batches, texts, whole_row

ORDER = 3
#: About so many training texts of each language, however large the table is.
SAMPLE = 400
UND = "und"
#: Bytes of text scored at once in a task.
BLOCK = 4 << 20
#: How sharply the score falls with the code length of the next best language, in bits per byte.
SHARPNESS = 8.0


def fold(ident: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(folds))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           per_lang: int = SAMPLE) -> list[tuple[str, bytes]]:
    """(lang, text): about ``per_lang`` texts of each language, the same ones at every run."""
    rows = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(1 << 30)) / float(1 << 30)).alias("draw"))
    # One row per language. The hash decides each text alone: no text moves and no language meets in one task.
    share = {r["lang"]: per_lang / r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return []
    shares = F.create_map(*[F.lit(x) for pair in sorted(share.items()) for x in pair])
    taken = rows.filter(F.col("text").isNotNull() & (F.col("draw") < shares[F.col("lang")]))
    return sorted((r["lang"], r["text"].encode()) for r in taken.select("lang", "text").collect())


class Model:
    """Frozen statistics: for each length 1..ORDER+1 the known byte strings, and the bits of each per language."""

    def __init__(self, rows: list[tuple[str, bytes]], order: int = ORDER):
        self.order, self.langs = order, sorted({lang for lang, _ in rows})
        width = len(self.langs)
        counts: list[dict[int, np.ndarray]] = [{} for _ in range(order + 2)]
        for j, lang in enumerate(self.langs):
            data = np.frombuffer(b"".join(pad(t, order) for la, t in rows if la == lang), dtype=np.uint8)
            for n in range(1, order + 2):
                keys, k = np.unique(grams(data, order, n), return_counts=True)
                counts[n][j] = np.stack([keys.astype(np.int64), k])
        self.keys: list[np.ndarray] = [np.zeros(0, np.int64)]
        #: bits[n][i, j]: the last byte of string i after the bytes before it, in language j.
        self.bits: list[np.ndarray] = [np.full((1, width), 8.0)]
        #: escapes[n][i, j]: bits to leave the context that is string i of length n; n = 0 is the empty context.
        self.escapes: list[np.ndarray] = []
        for n in range(1, order + 2):
            keys = np.unique(np.concatenate([c[0] for c in counts[n].values()])) if counts[n] else np.zeros(0, np.int64)
            seen = np.zeros((keys.size, width))
            for j, (own, k) in counts[n].items():
                seen[np.searchsorted(keys, own), j] = k
            context = keys >> 8
            above = self.keys[n - 1] if n > 1 else np.zeros(1, np.int64)
            at = np.searchsorted(above, context) if n > 1 else np.zeros(keys.size, np.int64)
            followers, different = np.zeros((above.size, width)), np.zeros((above.size, width))
            np.add.at(followers, at, seen)
            np.add.at(different, at, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(different > 0, -np.log2(different / (followers + different)), 0.0)
                bits = -np.log2(seen / (followers + different)[at])
            shorter = self._shorter(keys, n)
            self.escapes.append(escape)
            self.bits.append(np.where(seen > 0, bits, escape[at] + shorter))
            self.keys.append(keys)
        self.tables = [None] + [_Places(k) for k in self.keys[1:]]

    def _shorter(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Bits of the last byte of each string without its first byte (known for every string by construction)."""
        if n == 1:
            return np.repeat(self.bits[0], keys.size, axis=0)
        return self.bits[n - 1][np.searchsorted(self.keys[n - 1], keys & ((1 << 8 * (n - 1)) - 1))]

    def cost(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Bits per language of strings that need not be known."""
        if n == 0:
            return np.repeat(self.bits[0], keys.size, axis=0)
        at = self.tables[n].find(keys)
        out = self.bits[n].astype(np.float32)[at]
        new = np.flatnonzero(at < 0)
        if new.size:
            own = keys[new]
            out[new] = self.cost(own & ((1 << 8 * (n - 1)) - 1), n - 1)
            context = self.tables[n - 1].find(own >> 8) if n > 1 else np.zeros(own.size, np.int64)
            known = context >= 0
            out[new[known]] += self.escapes[n - 1][context[known]].astype(np.float32)
        return out

    def code_lengths(self, rows: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language, whatever its length."""
        out = np.zeros((len(rows), len(self.langs)))
        flat = self.bits[-1].astype(np.float32)
        i = 0
        while i < len(rows):
            j, size = i, 0
            while j < len(rows) and (j == i or size + len(rows[j]) <= BLOCK):
                size, j = size + len(rows[j]), j + 1
            block = [pad(t, self.order) for t in rows[i:j]]
            data = np.frombuffer(b"".join(block), dtype=np.uint8)
            owner = np.repeat(np.arange(i, j), [len(b) for b in block])
            starts = np.cumsum([0] + [len(b) for b in block[:-1]])
            padding = np.zeros(data.size, dtype=bool)
            padding[(starts[:, None] + np.arange(self.order)).ravel()] = True
            for a in range(0, max(0, data.size - self.order), BLOCK):  # a text longer than a block in parts
                part = data[a:a + BLOCK + self.order]
                keys, own = grams(part, self.order, self.order + 1), owner[a + self.order:a + self.order + BLOCK]
                at = self.tables[-1].find(keys)
                bits = flat[at]
                new = np.flatnonzero(at < 0)
                if new.size:
                    bits[new] = self.cost(keys[new], self.order + 1)
                bits[padding[a + self.order:a + self.order + len(own)]] = 0  # padding is context only
                starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                for k in range(len(self.langs)):
                    out[own[starts], k] += np.add.reduceat(bits[:, k], starts, dtype=np.float64)
            i = j
        return out

    def predict(self, rows: list[bytes]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return [UND] * len(rows), [0.0] * len(rows)
        bits = self.code_lengths(rows) / np.maximum(1, np.array([len(t) for t in rows]))[:, None]
        share = np.exp2(-SHARPNESS * (bits - bits.min(axis=1, keepdims=True)))
        best = bits.argmin(axis=1)
        return [self.langs[k] for k in best], (share[np.arange(len(rows)), best] / share.sum(axis=1)).tolist()


class _Places:
    """Place of a key in a sorted list by hashing: -1 for keys that are not in it."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(keys.size * 8).bit_length())
        self.keys = np.append(keys, -1)  # place -1 is this last one
        slot = self._slot(keys)
        self.first = np.full(1 << self.bits, -1, dtype=np.int32)
        self.first[slot[::-1]] = np.arange(keys.size - 1, -1, -1, dtype=np.int32)
        rest = np.flatnonzero(self.first[slot] != np.arange(keys.size))
        self.rest_slots = np.zeros(1 << self.bits, dtype=bool)
        self.rest_slots[slot[rest]] = True
        self.rest = keys[rest]
        self.rest_at = rest

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        at = self.first[slot]
        miss = np.flatnonzero(self.keys[at] != keys)
        if miss.size:
            at[miss] = -1
            again = miss[self.rest_slots[slot[miss]]]
            if again.size and self.rest.size:
                place = np.minimum(np.searchsorted(self.rest, keys[again]), self.rest.size - 1)
                hit = self.rest[place] == keys[again]
                at[again[hit]] = self.rest_at[place[hit]]
        return at


def pad(text: bytes, order: int) -> bytes:
    """A text begins after ``order`` line feeds, so that its first bytes have contexts too."""
    return b"\n" * order + text.lower()


def grams(data: np.ndarray, order: int, n: int) -> np.ndarray:
    """The last ``n`` bytes up to every place after the first ``order``, as one number each."""
    if data.size <= order:
        return np.zeros(0, np.int64)
    size = data.size - order
    out = np.zeros(size, dtype=np.int64)
    for k in range(n):
        out = out << 8 | data[order - n + 1 + k:order - n + 1 + k + size]
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = SAMPLE, order: int = ORDER) -> Model:
    return Model(sample(docs, id_col, text_col, lang_col, per_lang), order)


def detect(docs: DataFrame, model: Model, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """lang_pred and score of every whole text, beside the ``keep`` columns (default: the whole row)."""
    kept = [whole_row(docs)] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, not by the corpus
    letter = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    rows = docs.select(*kept, F.when(letter, F.col(text_col)).alias("__text"))
    names = rows.columns[:-1]
    out = rows.drop("__text").schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own = shared.value
        for batch in small_batches(batches, 512):
            data = list(texts(batch.column(len(names))))
            known = [i for i, t in enumerate(data) if t is not None]
            langs, scores = [UND] * len(data), [0.0] * len(data)
            for i, lang, value in zip(known, *own.predict([data[i] for i in known])):
                langs[i], scores[i] = lang, value
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*names, "lang_pred", "score"])

    return rows.mapInArrow(score, out.add("lang_pred", "string").add("score", "double"))


def crc(ident: int) -> int:
    """The fold hash outside Spark, for tests."""
    return zlib.crc32(str(ident).encode())
