"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of bytes exactly one token can end its encoding: the token ``t`` whose
predecessor, the last token of the prefix before ``t``, stays apart from ``t`` when the two are
merged alone. A table of these last tokens grows byte by byte, so an append continues it and an
edit recomputes it only until it agrees with the old one again. The encoding is read off backwards.
For a short piece only those prefixes are settled that the last token asks for, from the end.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces kept in each of two generations, and pairs of tokens; both go with their task.
MEMO_PIECES = 200_000
MEMO_PAIRS = 250_000
# Longer pieces are not kept, so that the memo is bounded in bytes too.
KEPT_CHARS = 64
# Pieces of at most so many bytes are encoded from their end.
SHORT = 32
# Pieces of a long text that are held at once.
BLOCK_PIECES = 400_000
# A text of more characters is split block by block.
LONG_TEXT = 2_000_000
# Texts of a batch that are encoded at once: ids and bytes of a whole batch are several times its size.
SLICE = 250
NEVER = 1 << 60

# The usual split pattern written for ``re``, which is faster than ``regex``. Both cut alike where a
# text holds only characters of COMMON: no underscore, no digits outside 0-9, no odd separators.
# Words, the most frequent, come first; the order of the others is kept where two can match at one place.
# The letters listed are those of COMMON.
FAST_PATTERN = re.compile(
    " ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ]+" r"| ?\d+|'(?:[stmd]|re|ve|ll)| ?[^\s\w]+|\s+(?!\S)|\s+"
)
FAST_FOR = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNCOMMON = re.compile("[^\t-\r -\\^`-~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixBpe:
    """Encoder and decoder over one vocabulary; results equal merging by lowest rank first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        #: Finds the tokens that end at each byte, longest first; bytes stand as Latin-1 text.
        self.finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.finder.add_word(token.decode("latin-1"), rank)
        self.finder.make_automaton()
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.grown: dict[int, tuple[list, list] | None] = {}
        self.apart: dict[int, bool] = {}

    def merge(self, piece: bytes, below: int = NEVER) -> list[bytes]:
        """Plain merging by ranks under ``below``, lowest first, leftmost of equals; for short input."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def growth(self, rank: int) -> tuple[list, list] | None:
        """What the token's last part and its first part were while it grew from bytes, each with the
        rank that ended it. None for a token that merging never yields: it cannot end a prefix."""
        if rank not in self.grown:
            token = self.token_bytes[rank]
            halves = self.merge(token, rank) if len(token) > 1 else [token]
            parts = [self.growth(self.ranks[h]) for h in halves] if len(halves) == 2 else []
            if len(halves) > 2 or None in parts:
                self.grown[rank] = None
            else:
                last, first = [(token, NEVER)], [(token, NEVER)]
                if parts:
                    last += [(b, min(until, rank)) for b, until in parts[1][0]]
                    first += [(b, min(until, rank)) for b, until in parts[0][1]]
                self.grown[rank] = last, first
        return self.grown[rank]

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are their own encoding.

        They are not if the last part of the left and the first part of the right, as they were at
        some time, would have merged before either grew on. On a tie the left one grows first.
        """
        known = self.apart.get(left << 20 | right)
        if known is None:
            ranks, grown = self.ranks, self.growth(right)
            known = grown is not None and not any(
                ranks.get(a + b, NEVER) < a_until and ranks.get(a + b, NEVER) <= min(b_until, NEVER - 1)
                for a, a_until in self.growth(left)[0]
                for b, b_until in grown[1]
            )
            # The pairs met first are the frequent ones.
            if len(self.apart) < MEMO_PAIRS:
                self.apart[left << 20 | right] = known
        return known

    def extend(self, piece: bytes, table: list[int], upto: int | None = None) -> list[int]:
        """Continue ``table`` (last token of each nonempty prefix so far) to the prefix ``upto``."""
        judged, sizes, add, done = self.apart.get, self.sizes, table.append, len(table)
        upto = len(piece) if upto is None else upto
        for last, token in self.finder.iter(piece.decode("latin-1"), max(0, done - self.longest), upto):
            if last < done:
                continue
            at = last - sizes[token]
            if at >= 0:
                left = table[at]
                known = judged(left << 20 | token)
                if not (known or known is None and self.stays_apart(left, token)):
                    continue
            elif self.growth(token) is None:
                continue
            add(token)
            done += 1
        if done < upto:
            raise ValueError("a byte has no token in this vocabulary")
        return table

    def settle(self, piece: bytes, end: int, table: list[int]) -> int:
        """The last token of the prefix of ``end`` bytes. Fills ``table``, -1 where it is unknown, for that
        prefix and those before it that decide on it."""
        rank_of, judged = self.ranks.get, self.apart.get
        for at in range(end):
            token = rank_of(piece[at:end])
            if token is None:
                continue
            if at:
                left = table[at - 1]
                if left < 0:
                    left = self.settle(piece, at, table)
                known = judged(left << 20 | token)
                if known or known is None and self.stays_apart(left, token):
                    break
            elif self.growth(token) is not None:
                break
        else:
            raise ValueError("a byte has no token in this vocabulary")
        table[end - 1] = token
        return token

    def read_back(self, table: list[int]) -> list[int]:
        """The tokens of the longest prefix in ``table``."""
        out, at = [], len(table)
        while at:
            token = table[at - 1]
            out.append(token)
            at -= self.sizes[token]
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not 0 < len(piece) <= SHORT:
            return self.read_back(self.extend(piece, []))
        table = [-1] * len(piece)
        self.settle(piece, len(piece), table)
        return self.read_back(table)


def splitter(pattern: str):
    """A function from a text to lists of its pieces, several for a long text. A character the pattern
    leaves out is left out here too."""
    exact = regex.compile(pattern)

    def pieces(text: str) -> Iterator[list[str]]:
        fast = pattern == FAST_FOR and not UNCOMMON.search(text)
        if len(text) <= LONG_TEXT:
            yield FAST_PATTERN.findall(text) if fast else [m.group() for m in exact.finditer(text)]
            return
        found = (FAST_PATTERN if fast else exact).finditer(text)
        while block := [m.group() for m in islice(found, BLOCK_PIECES)]:
            yield block

    return pieces


class Memo(dict):
    """Piece to the bytes of its token ids, as 32-bit integers: smaller than tuples, and a text's are
    joined at once. Two generations of at most ``limit`` pieces; what is not used falls out."""

    def __init__(self, bpe: PrefixBpe, limit: int = MEMO_PIECES):
        self.bpe, self.limit, self.older = bpe, limit, {}

    def forget(self) -> None:
        """Drop all pieces, and the pairs that the encoder has judged."""
        self.clear()
        self.older = {}
        self.bpe.apart.clear()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.bpe.encode(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) < KEPT_CHARS:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def encode_text(text: str | None, pieces, memo: Memo) -> np.ndarray:
    """The ids of a whole text, gathered block by block."""
    return np.frombuffer(b"".join([b"".join(map(memo.__getitem__, b)) for b in pieces(text or "")]), np.int32)


class TokenBytes:
    """The bytes of all tokens in one table."""

    #: Ids that are decoded at once.
    BLOCK = 1 << 16

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens; an id that no token has is an error."""
        parts = []
        for at in range(0, len(ids), self.BLOCK):
            some = ids[at : at + self.BLOCK]
            if some.min() < 0 or some.max() >= len(self.sizes) or not self.sizes[some].all():
                raise KeyError("an id outside the vocabulary")
            sizes = self.sizes[some]
            shift = self.starts[some] - (np.cumsum(sizes) - sizes)
            parts.append(self.bytes[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes())
        return b"".join(parts)


class EditableEncoding:
    """A text with its encoding, kept exact through appends and edits.

    ``ids`` is the encoding. Pieces before an edit are kept; from there the text is cut again until
    a cut falls on an old one, and a piece that starts alike continues its old prefix table.
    """

    #: The pattern looks at most this many characters past a piece's end before it settles it.
    LOOK = 4

    def __init__(self, bpe: PrefixBpe, pattern: str, text: str = ""):
        self.bpe, self.exact, self.text = bpe, regex.compile(pattern), ""
        self.cuts: list[tuple[int, int]] = []
        self.tables: list[list[int]] = []
        self.replace(0, 0, text)

    @property
    def ids(self) -> list[int]:
        return list(chain.from_iterable(map(self._ids, self.cuts, self.tables)))

    def _ids(self, cut: tuple[int, int], table: list[int]) -> list[int]:
        whole = self.bpe.ranks.get(self.text[cut[0] : cut[1]].encode())
        return [whole] if whole is not None else self.bpe.read_back(table)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of ``text[start:end]``; returns how many pieces were encoded anew."""
        old_text, shift = self.text, len(new) - (end - start)
        self.text = old_text[:start] + new + old_text[end:]
        keep = 0
        while keep < len(self.cuts) and self.cuts[keep][1] <= start - self.LOOK:
            keep += 1
        # White space runs are looked through to their end, so one that reaches the edit is cut again.
        while keep and old_text[self.cuts[keep - 1][0] : start].isspace():
            keep -= 1
        old = {cut[0]: i for i, cut in enumerate(self.cuts) if i >= keep}
        cuts, tables, anew = self.cuts[:keep], self.tables[:keep], 0
        for piece in self.exact.finditer(self.text, cuts[-1][1] if cuts else 0):
            at, to = piece.span()
            same = old.get(at - shift)
            if same is not None and at >= start + len(new):
                cuts += [(a + shift, b + shift) for a, b in self.cuts[same:]]
                tables += self.tables[same:]
                break
            anew += 1
            data, table, before = self.text[at:to].encode(), [], old.get(at)
            if before is not None:
                old_data = old_text[slice(*self.cuts[before])].encode()
                alike = next((i for i, (a, b) in enumerate(zip(old_data, data)) if a != b), min(len(old_data), len(data)))
                table = self.tables[before][:alike]
            cuts.append((at, to))
            tables.append(self.bpe.extend(data, table))
        self.cuts, self.tables = cuts, tables
        return anew


@lru_cache(maxsize=1)
def _tables(ranks_file: str) -> tuple[Memo, TokenBytes]:
    """What a Python worker keeps from task to task: the vocabulary, and a memo that each task leaves empty."""
    ranks = read_ranks(SparkFiles.get(ranks_file))
    return Memo(PrefixBpe(ranks)), TokenBytes(ranks)


def _share(df: DataFrame, ranks_path: str) -> str:
    """Hand the rank file to every executor; returns the name it has there."""
    df.sparkSession.sparkContext.addFile(ranks_path)
    return ranks_path.rsplit("/", 1)[-1]


def _encoder(ranks_file: str, pattern: str, returns: str, both: bool):
    @F.arrow_udf(returns)
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo, token_bytes = _tables(ranks_file)
        pieces = splitter(pattern)
        try:
            for texts in (batch.slice(at, SLICE) for batch in batches for at in range(0, len(batch), SLICE)):
                rows = [encode_text(text.as_py(), pieces, memo) for text in texts]
                ends = np.cumsum([0, *map(len, rows)])
                flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                if not both:
                    yield ids
                    continue
                decoded = [token_bytes.decode(row) for row in rows]
                yield pa.StructArray.from_arrays([ids, pa.array(decoded, pa.binary())], ["ids", "decoded"])
        finally:
            # The worker may live on with other work, or idle beside it.
            memo.forget()
            pa.default_memory_pool().release_unused()

    return coded


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col array<int>``, the token ids of the whole ``text_col``, no special tokens.

    Null and empty texts have no tokens (an empty array). A column of the name ``ids_col`` is
    replaced, all others and repeated rows stay; an empty table gives no rows. Ties between merges go
    to the leftmost. A task holds one batch of texts, one block of pieces and the bounded memo; a text
    of any length is encoded whole.
    """
    coded = _encoder(_share(df, ranks_path), pattern, "array<int>", both=False)
    return df.withColumn(ids_col, coded(F.col(text_col)))


def round_trip(
    df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: ``df`` with ``ids_col`` and ``bytes_col``.

    The bytes are looked up from the ids, as ``decode`` does. Columns of the two names are replaced.
    """
    coded = _encoder(_share(df, ranks_path), pattern, "struct<ids: array<int>, decoded: binary>", both=True)
    both = df.withColumn(ids_col, coded(F.col(text_col)))
    return both.withColumns({ids_col: F.col(ids_col)["ids"], bytes_col: F.col(ids_col)["decoded"]})


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col binary``, the bytes of the tokens in ``ids_col``.

    Null or empty ids give empty bytes; an id outside the vocabulary fails the job. A column of the
    name ``bytes_col`` is replaced. Bytes need not be valid UTF-8, as ids may cut a character.
    """
    ranks_file = _share(df, ranks_path)

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, token_bytes = _tables(ranks_file)
        none = np.empty(0, np.int32)
        for ids in batches:
            rows = (row.values.to_numpy(zero_copy_only=False) if row.is_valid else none for row in ids)
            yield pa.array([token_bytes.decode(row) for row in rows], pa.binary())

    return df.withColumn(bytes_col, decoded(F.col(ids_col)))
