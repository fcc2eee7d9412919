"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its subwords (runs of one to four characters within a word
and its two borders, hashed into buckets); a linear layer and a softmax give the languages. Both
are trained by stochastic gradient descent in numpy on a bounded sample. Scores under a threshold
calibrated on texts kept back from training are marked as rejected.

Null texts and texts without a letter are ``und`` with score 0. Rows, repeated or not, get one
result each. Without any labelled row everything is ``und``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.sampling import excerpt, id_remainder, sample_by_label

UNKNOWN = "und"
BUCKETS = 1 << 15
WIDTH = 16
LONGEST = 4
PER_LANGUAGE = 1_500
MOST_ROWS = 12_000
EXCERPT_CHARS = 2_000
EPOCHS = 6
RATE = 4.0
BATCH = 64
#: Characters looked at together; bounds the memory for very long texts.
BLOCK = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all subwords of the text, block by block; nothing without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    end = 0
    while end < len(codes):
        at, end = end, min(end + BLOCK, len(codes))
        if end < len(codes):  # cut behind the last character that is no letter
            gaps = np.flatnonzero(~_letters()[codes[at:end]])
            end = at + int(gaps[-1]) + 1 if len(gaps) else end
        part = codes[at:end]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = _letters()[part]
        c = np.zeros(len(part) + 2, np.uint32)
        c[1:-1] = np.where(inside[1:-1], part, 0)
        hashed, out = np.zeros(len(c), np.uint32), []
        plain = np.zeros(len(c), bool)
        for n in range(1, LONGEST + 1):
            hashed = (hashed[: len(c) - n + 1] * np.uint32(0x01000193)) ^ (c[n - 1 :] + np.uint32(n * 0x9E37))
            hashed = hashed * np.uint32(0x85EBCA6B)
            if n == 1:
                keep = inside
            elif n == 2:
                keep = inside[:-1] | inside[1:]
            else:
                plain = inside[1 : len(c) - n + 2].copy()
                for k in range(2, n - 1):
                    plain &= inside[k : len(c) - n + 1 + k]
                keep = plain
            out.append((hashed[keep] >> np.uint32(16)) ^ (hashed[keep] & np.uint32(0x7FFF)))
        yield np.concatenate(out) & np.uint32(BUCKETS - 1)


@dataclass
class LanguageModel:
    languages: list[str]
    #: Class scores of each bucket: embeddings times weights.
    table: np.ndarray
    bias: np.ndarray
    threshold: float

    def probabilities(self, text: str | None) -> np.ndarray | None:
        """One number per language; None for a text without letters."""
        total, count = np.zeros(len(self.languages)), 0
        for hashed in subwords(text):
            total += self.table[hashed].sum(axis=0, dtype=np.float64)
            count += len(hashed)
        if not count or not self.languages:
            return None
        z = total / count + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()


def fit(rows: Iterable[tuple[str, str]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> LanguageModel:
    """From ``(text, language)`` pairs in the given order. Every fifth text is kept back to find the
    threshold: the least score of a right answer among them, leaving out one in a thousand."""
    data = []
    for text, language in rows:
        parts = list(subwords(text))
        if parts and sum(map(len, parts)):
            buckets, counts = np.unique(np.concatenate(parts), return_counts=True)
            data.append((text, language, buckets, (counts / counts.sum()).astype(np.float32)))
    languages = sorted({x[1] for x in data})
    number, chance = {x: i for i, x in enumerate(languages)}, np.random.default_rng(seed)
    embedding = chance.normal(0, 1, (BUCKETS, WIDTH)).astype(np.float32) / WIDTH
    weights, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    train = [x for i, x in enumerate(data) if i % 5 or len(data) < 20]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = chance.permutation(len(train))
        for at in range(0, len(order), BATCH):
            batch = [train[i] for i in order[at : at + BATCH]]
            used, place = np.unique(np.concatenate([x[2] for x in batch]), return_inverse=True)
            shares = np.zeros((len(batch), len(used)), np.float32)
            row = np.repeat(np.arange(len(batch)), [len(x[2]) for x in batch])
            shares[row, place] = np.concatenate([x[3] for x in batch])
            mean = shares @ embedding[used]
            z = mean @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), [number[x[1]] for x in batch]] -= 1
            p /= len(batch)
            back = p @ weights.T
            weights -= step * (mean.T @ p)
            bias -= step * p.sum(axis=0)
            embedding[used] -= step * len(batch) * (shares.T @ back)
    model = LanguageModel(languages, (embedding @ weights).astype(np.float32), bias.astype(np.float64), 0.0)
    right = []
    for text, language, *_ in data[::5]:
        p = model.probabilities(text)
        if languages[int(p.argmax())] == language:
            right.append(float(p.max()))
    model.threshold = float(np.quantile(right, 0.001)) if right else 0.0
    return model


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST_ROWS, chars: int = EXCERPT_CHARS) -> list[tuple[str, str]]:
    """About ``per_language`` texts of each language, ``most`` in all, of each an excerpt of ``chars``
    characters, on the driver. Ids whose crc32 leaves 2 by 4 and null languages are left out."""
    known = docs.select("doc_id", "lang", excerpt(F.col("text"), chars).alias("text"))
    known = known.where((id_remainder(F.col("doc_id"), 4) != 2) & F.col("text").isNotNull())
    rows = sample_by_label(known, "lang", per_language, most).select("doc_id", "lang", "text").collect()
    return [(r["text"], r["lang"]) for r in rows]


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with ``out_col struct<lang_pred string, score double, rejected boolean>`` for the whole
    text; a column of that name is replaced. Rejected are scores under the model's threshold and
    texts without letters."""

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = [], []
            for text in texts:
                p = model.probabilities(text.as_py())
                names.append(UNKNOWN if p is None else model.languages[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            rejected = [n == UNKNOWN or s < model.threshold for n, s in zip(names, scores)]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["lang_pred", "score", "rejected"],
            )

    return docs.withColumn(out_col, predicted(F.col(text_col)))
