"""Fill-in-middle by an indexable skip list.

A text's units stand in a skip list whose lanes carry two widths per node: units and code points to the
next node of that lane. Going down the lanes by accumulated units reaches a cut's rank in logarithmic
steps, and the code points gathered on the way are the cut's place in the text.

Two ranks drawn from a hash of the id cut a text into prefix, middle and suffix, which are put in the
order of the form drawn: ``psm``, ``spm``, or ``plain``, the text as it is. Null and empty texts and texts
that hold one of the marks are plain. A null id draws as empty text; rows of one id draw alike. Texts of
any length are cut whole; a task holds one batch of texts and one text's lists. Columns of the names
given to the results are replaced, all others and repeated rows stay; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.hashing import mix64

PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 42
#: Percent of the texts that are rearranged, and percent of those that put the suffix first.
FIM_PERCENT = 50
SPM_PERCENT = 80
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Each lane keeps about one in 2**LANE_BITS nodes of the lane below.
LANE_BITS = 2

CUT = "struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>"


def unit_ends(text: str) -> np.ndarray:
    """Code point ends of the units: white space with the word after it, and white space at the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = ~((points == 32) | ((points >= 9) & (points <= 13)))
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    return np.append(ends, len(points)) if len(points) else ends


class UnitList:
    """Indexable skip list over units given by their code point ends.

    ``lanes`` go from the bottom up. Each has, for its nodes in order, the units and the code points up to
    its next node or the end, and where the node stands in the lane below. The first node is on every
    lane; the height of the others comes from a hash of their rank.
    """

    def __init__(self, ends: np.ndarray):
        self.size = len(ends)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if self.size else np.empty(0, np.int64)
        total = int(ends[-1]) if self.size else 0
        towers = mix64(np.arange(self.size, dtype=np.uint64) + np.uint64(1))
        towers[:1] = 0
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ranks, below = np.arange(self.size), np.arange(self.size)
        while len(ranks):
            self.lanes.append((np.diff(ranks, append=self.size), np.diff(starts[ranks], append=total), below))
            mask = np.uint64((1 << LANE_BITS * len(self.lanes)) - 1)
            below = np.flatnonzero((towers[ranks] & mask) == 0)
            if len(below) == len(ranks):
                break
            ranks = ranks[below]

    def locate(self, rank: int) -> int:
        """The code points before the unit of this rank; all of them for the number of units."""
        if not 0 <= rank <= self.size:
            raise IndexError(f"rank {rank} of {self.size} units")
        lane, node, points = len(self.lanes) - 1, 0, 0
        while rank:
            units, chars, below = self.lanes[lane]
            if units[node] <= rank:
                rank -= int(units[node])
                points += int(chars[node])
                node += 1
            else:
                node, lane = int(below[node]), lane - 1
        return points


def _refuse_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be found again wherever the parts meet: none may begin as one of them ends."""
    for a in marks:
        for b in marks:
            if not a or (a is not b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"the marks {marks} are empty or overlap")
    if len(set(marks)) < 3:
        raise ValueError("three different marks are needed")


def cut_text(
    text: str | None, digest: str, fim_percent: int, spm_percent: int, marks: tuple[str, str, str]
) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text, drawn from its id's hex digest."""
    text = text or ""
    ends = unit_ends(text)
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or h3 % 100 >= fim_percent or any(mark in text for mark in marks):
        return len(ends), PLAIN, None, None, text
    units = UnitList(ends)
    first, last = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    start, end = units.locate(first), units.locate(last)
    before, between, after = marks
    prefix, middle, suffix = before + text[:start], between + text[end:], after + text[start:end]
    if h4 % 100 < spm_percent:
        return len(ends), SPM, start, end - start, middle + prefix + suffix
    return len(ends), PSM, start, end - start, prefix + middle + suffix


def rearrange(
    df: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    marks: tuple[str, str, str] = MARKS,
    text_col: str = "text",
    id_col: str = "doc_id",
    out_col: str = "fim",
) -> DataFrame:
    """``df`` with ``out_col``, a struct ``n, form, prefix_chars, middle_chars, output``.

    The numbers drawn are the first four groups of eight digits of the hex sha256 of ``seed:id``.
    """
    _refuse_marks(marks)

    @F.arrow_udf(CUT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, digests in batches:
            rows = [cut_text(t.as_py(), d.as_py(), fim_percent, spm_percent, marks) for t, d in zip(texts, digests)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.StructArray.from_arrays(arrays, ["n", "form", "prefix_chars", "middle_chars", "output"])

    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return df.withColumn(out_col, cut(F.col(text_col), F.sha2(drawn.cast("binary"), 256)))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``rearrange`` has cut, from its output and form alone."""
    parts = F.split(output, "|".join(map(re.escape, marks)))
    return (
        F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
