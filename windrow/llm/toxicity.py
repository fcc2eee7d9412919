"""Toxicity by compression distance.

Two pairs of zstandard dictionaries, one of each pair for toxic and one for ordinary text, compress
all windows of a text; the bytes that the toxic one saves are a window's distance. A logistic
calibration turns the distances of all windows of both kinds into a score.

The first pair is trained on toxic and on ordinary text as it is and compresses windows of WINDOW
words. Single words among many are lost in its noise, so there is a second pair for windows of one
word in a fixed frame. It shares a base trained on ordinary text; one goes on with word beginnings
over-represented in toxic texts by a z test, the other with as many typical of ordinary text. Words
recur, so the distance of each is kept in a bounded memo.

Null texts and texts without words have the score 0; texts of any length are read whole. Rows,
repeated or equal or not, get one result each, and equal texts equal scores. Without labels of both
kinds every other score is the share of toxic labels (0 without any). An empty table gives no rows.
Other columns are kept and never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.sampling import excerpt, id_remainder, sample_by_label

WORD = re.compile(r"[^\W\d_]+")
FRAME = "<<0123456789>>"
LEVEL = 3
WINDOW = 12
TEXT_BYTES = 64_000
BASE_BYTES = 16_000
LEAST_DOCS = 4
LEAST_Z = 6.5
PER_LABEL = 3_000
EXCERPT_CHARS = 10_000
STEPS = (1, 2, 3, 4, 5)
MEMO_WORDS = 200_000
TEXT_FEATURES = 4


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def beginnings(text: str) -> set[str]:
    """The word beginnings of a text, each with the space before it."""
    return {(" " + w)[:k] for w in set(words(text)) for k in range(5, min(13, len(w) + 2))}


def _typical(toxic: list[str], ordinary: list[str]) -> tuple[list[str], list[str]]:
    """Beginnings over-represented in toxic texts, and as many of the least so; by the z score of
    the difference in document shares. One that another holds nearly always is left to that one."""
    seen, n1, n0 = Counter(x for t in toxic for x in beginnings(t)), len(toxic), len(ordinary)
    seen = {k: v for k, v in seen.items() if v >= LEAST_DOCS}
    other = Counter(x for t in ordinary for x in beginnings(t) if x in seen)

    def z(k: str) -> float:
        share = (seen[k] + other[k]) / (n1 + n0)
        return (seen[k] / n1 - other[k] / n0) / max(1e-9, (share * (1 - share) * (1 / n1 + 1 / n0)) ** 0.5)

    order = sorted(seen, key=lambda k: (-z(k), k))
    high = [k for k in order if z(k) >= LEAST_Z]
    longer = Counter()
    for k in high:
        for n in range(5, len(k)):
            longer[k[:n]] = max(longer[k[:n]], seen[k])
    high = [k for k in high if longer[k] < 0.9 * seen[k]]
    return high, order[::-1][: len(high)]


def windows(found: list[str]) -> list[bytes]:
    """The words in windows of WINDOW, the last of what is left."""
    return [" ".join(found[i : i + WINDOW]).encode("utf-8", "surrogatepass") for i in range(0, len(found), WINDOW)]


def _coder(content: bytes, kind: int) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=kind)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)


class TextDistance:
    """Bytes that the toxic dictionary saves on each window of a text, by dictionaries in full form,
    or without both of them none."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.coders = [_coder(x, zstandard.DICT_TYPE_FULLDICT) for x in (ordinary, toxic)] if toxic and ordinary else []

    def __call__(self, found: list[str]) -> list[float]:
        if not self.coders or not found:
            return [0.0] * TEXT_FEATURES
        cut = windows(found)
        saved = np.array([len(self.coders[0].compress(x)) - len(self.coders[1].compress(x)) for x in cut], float)
        sizes = np.array([len(x) + 1 for x in cut])
        top = np.sort(saved)[-3:]
        return [
            float((saved / sizes).max()), float(saved.sum() / sizes.sum()),
            float(top.mean()), float((saved > 0).mean()),
        ]


class Distance(dict):
    """Word to the bytes saved; two generations of at most MEMO_WORDS words."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.older: dict[str, int] = {}
        self.coders = [_coder(x, zstandard.DICT_TYPE_RAWCONTENT) for x in (ordinary, toxic)]

    def __missing__(self, word: str) -> int:
        saved = self.older.get(word)
        if saved is None:
            window = f"{FRAME} {word} {FRAME}".encode("utf-8", "surrogatepass")
            saved = len(self.coders[0].compress(window)) - len(self.coders[1].compress(window))
        if len(self) >= MEMO_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = saved
        return saved


def features(distance: Distance, text_distance: TextDistance, text: str | None) -> list[float]:
    found = words(text)
    d = np.fromiter(map(distance.__getitem__, found), np.int32, len(found)) if found else np.zeros(1, np.int32)
    top = np.sort(d[np.argpartition(d, -3)[-3:]] if len(d) > 3 else d)[::-1]
    counts = [int((d >= k).sum()) for k in STEPS]
    return [
        float(top[0]), float(top.mean()), float(d.mean()), float(np.log(len(d))),
        *[float(np.log1p(c)) for c in counts],
        *[float(np.log1p(100 * c / len(d))) for c in counts],
        *text_distance(found),
    ]


@dataclass
class ToxicityModel:
    #: Dictionaries for single words, and for windows of text.
    toxic: bytes
    ordinary: bytes
    toxic_text: bytes
    ordinary_text: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float

    def reader(self) -> Callable[[str | None], list[float]]:
        """The features of a text by these dictionaries."""
        return partial(features, Distance(self.toxic, self.ordinary), TextDistance(self.toxic_text, self.ordinary_text))

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(((x - self.mean) / self.spread) @ self.weights + self.bias, -30, 30)
        return 1 / (1 + np.exp(-z))


def _trained(texts: list[str]) -> bytes:
    """A dictionary of the texts' windows; empty if they are too few to train on."""
    try:
        return zstandard.train_dictionary(TEXT_BYTES, [x for t in texts for x in windows(words(t))], k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    samples = [(" " + " ".join(w[i : i + 6])).encode() for t in ordinary for w in [words(t)] for i in range(0, len(w), 6)]
    try:
        base = zstandard.train_dictionary(BASE_BYTES, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary themselves
        base = b"".join(samples)[-BASE_BYTES:]
    high, low = (" ".join(x).encode() for x in _typical(toxic, ordinary))
    return base + high + FRAME.encode(), base + low[: len(high)].ljust(len(high)) + FRAME.encode()


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """``share`` is each row's part of all, 1 in total."""
    weights, bias = np.zeros(x.shape[1]), 0.0
    for _ in range(3_000):
        error = (1 / (1 + np.exp(-np.clip(x @ weights + bias, -30, 30))) - y) * share
        weights -= 0.5 * (x.T @ error + l2 * weights)
        bias -= 0.5 * float(error.sum())
    return weights, bias


def fit(rows: Iterable[tuple[str, int]], toxic_share: float | None = None) -> ToxicityModel:
    """From ``(text, toxic)`` pairs, in the given order. ``toxic_share`` is the share of toxic rows
    in the table that ``rows`` were sampled from; by default their share among ``rows``."""
    rows = [(t or "", int(y)) for t, y in rows]
    toxic, ordinary = [t for t, y in rows if y], [t for t, y in rows if not y]
    width = 4 + 2 * len(STEPS) + TEXT_FEATURES
    if toxic_share is None:
        toxic_share = len(toxic) / max(len(rows), 1)
    if min(len(toxic), len(ordinary)) < 2:
        share = min(max(toxic_share, 1e-13), 1 - 1e-13)
        return ToxicityModel(FRAME.encode(), FRAME.encode(), b"", b"", np.zeros(width), np.ones(width), np.zeros(width), float(np.log(share / (1 - share))))
    # Every third text calibrates; the dictionaries are trained on the others and don't know it.
    rest = lambda texts: [t for i, t in enumerate(texts) if i % 3 or len(texts) < 6]
    dictionaries = (*_dictionaries(rest(toxic), rest(ordinary)), _trained(rest(toxic)), _trained(rest(ordinary)))
    read = partial(features, Distance(*dictionaries[:2]), TextDistance(*dictionaries[2:]))
    x = np.array([read(t) for t in toxic[::3] + ordinary[::3]])
    sizes = [len(toxic[::3]), len(ordinary[::3])]
    y = np.repeat([1.0, 0.0], sizes)
    share = np.repeat([toxic_share / sizes[0], (1 - toxic_share) / sizes[1]], sizes)
    mean, spread = x.mean(axis=0), np.where(x.std(axis=0) < 1e-6, np.inf, x.std(axis=0))
    return ToxicityModel(*dictionaries, mean, spread, *_logistic((x - mean) / spread, y, share, max(1e-3, 1 / min(sizes))))


def _known(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the ids that are not held out: those whose crc32 does not leave 1 by 3."""
    known = labels.where(id_remainder(F.col("doc_id"), 3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.where("toxic in (0, 1)")


def toxic_share(docs: DataFrame, labels: DataFrame) -> float | None:
    """Share of toxic rows among all labelled rows of ``docs`` that are not held out, counted on the
    ids alone; None without such rows."""
    return docs.select("doc_id").join(_known(labels), "doc_id").agg(F.avg("toxic")).first()[0]


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, chars: int = EXCERPT_CHARS) -> list[tuple[str, int]]:
    """At most ``2 * per_label`` labelled texts, of each at most ``chars`` characters, on the driver.

    Ids whose crc32 leaves 1 by 3 are held out. Toxic and ordinary rows are sampled apart, so their
    share among the sampled rows is not that of all rows. Of rows that share an id one excerpt counts,
    the least, so the same rows are fitted in every run.
    """
    chosen = sample_by_label(_known(labels), "toxic", per_label, 2 * per_label)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("doc_id", F.coalesce(excerpt(F.col("text"), chars), F.lit("")).alias("text"), "toxic")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def trained(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel:
    """The model of a bounded sample, calibrated to the labels' shares in the whole table, so that a
    score means the same at every size."""
    return fit(training_rows(docs, labels, per_label), toxic_share(docs, labels))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col double`` from 0 to 1 for the whole text; a column of that name is
    replaced."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        read = model.reader()
        for texts in batches:
            x = np.array([read(t.as_py()) for t in texts]).reshape(len(texts), len(model.weights))
            wordless = np.array([not WORD.search(t.as_py() or "") for t in texts], bool)
            yield pa.array(np.where(wordless, 0.0, model.scores(x)), pa.float64())

    return docs.withColumn(score_col, scored(F.col(text_col)))
