"""Token counts that follow edits.

A document's pre-tokens lie in blocks, and a segment tree over the blocks holds
sums of code points and tokens. An edit finds its block by the code points'
sums, splits the text anew from a little before the edit until a pre-token
begins where one began before, counts just those and corrects the sums on the
way to the root.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import slices, table, utf8
from fleethealth.llm.tokens import encoder

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 64
#: A block may grow to this many times its first size before the tree is built anew.
FULL = 4
#: Code points before an edit that can see it: the pattern looks at most this far beyond a match.
CONTEXT = 3
REMEMBERED = 400_000

Edit = tuple[int, int, str]


class Counter:
    """Tokens of a pre-token, remembered within a bound."""

    def __init__(self, path: str) -> None:
        self.encode, self.known = encoder(path).encode_ordinary, {}
        compiled = regex.compile(public_tokenizers.PATTERN)
        self.split, self.match = compiled.findall, compiled.match

    def __call__(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = len(self.encode(piece))
            if len(piece) <= 64:
                self.known[piece] = n
        return n


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


class Document:
    """A text, its pre-tokens' lengths and tokens in blocks, and a tree of the blocks' sums."""

    def __init__(self, text: str, count: Counter) -> None:
        self.text, self.count, self.recounted, self.builds = text, count, 0, 0
        pieces = count.split(text)
        get = count.known.get
        lengths = list(map(len, pieces))
        tokens = [get(x) or count(x) for x in pieces]
        self.blocks = [(lengths[i : i + BLOCK], tokens[i : i + BLOCK]) for i in range(0, len(pieces), BLOCK)] or [([], [])]
        self._build()

    def _build(self) -> None:
        """tree[1] is the root; the leaf of block b is tree[size + b]."""
        self.builds += 1
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.tree = [(0, 0)] * (2 * self.size)
        for b, (lengths, tokens) in enumerate(self.blocks):
            self.tree[self.size + b] = sum(lengths), sum(tokens)
        for i in range(self.size - 1, 0, -1):
            (a, b), (c, d) = self.tree[2 * i], self.tree[2 * i + 1]
            self.tree[i] = a + c, b + d

    def _corrected(self, first: int, last: int) -> None:
        """Corrects the sums of the leaves of blocks first to last and of what lies above them, level by level."""
        low, high = self.size + first, self.size + last
        for i in range(low, high + 1):
            lengths, tokens = self.blocks[i - self.size]
            self.tree[i] = sum(lengths), sum(tokens)
        while low > 1:
            low, high = low // 2, high // 2
            for i in range(low, high + 1):
                (a, b), (c, d) = self.tree[2 * i], self.tree[2 * i + 1]
                self.tree[i] = a + c, b + d

    def _place(self, at: int) -> tuple[int, int, int]:
        """Block and pre-token that hold code point ``at``, and where the pre-token begins; the end is in the last one."""
        i, begin = 1, 0
        while i < self.size:
            left = self.tree[2 * i][0]
            if at < begin + left or self.tree[2 * i + 1][0] == 0:
                i = 2 * i
            else:
                begin, i = begin + left, 2 * i + 1
        b = i - self.size
        lengths = self.blocks[b][0]
        for k, n in enumerate(lengths):
            if at < begin + n or k == len(lengths) - 1:
                return b, k, begin
            begin += n
        return b, 0, begin

    def tokens(self) -> int:
        return self.tree[1][1]

    def prefix_tokens(self, at: int) -> int:
        """Tokens of the pre-tokens that end at or before code point ``at``."""
        b, k, begin = self._place(at)
        total, i = sum(self.blocks[b][1][:k]), self.size + b
        if k < len(self.blocks[b][0]) and begin + self.blocks[b][0][k] <= at:
            total += self.blocks[b][1][k]
        while i > 1:
            if i % 2:
                total += self.tree[i - 1][1]
            i //= 2
        return total

    def edit(self, start: int, end: int, new: str) -> None:
        """Puts ``new`` in the place of code points start to end."""
        old_length = len(self.text)
        start = min(max(start, 0), old_length)
        end = min(max(end, start), old_length)
        self.text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        b, k, begin = self._place(max(0, start - CONTEXT))
        # old pre-tokens from there on, one after the other: (block, number, begin)
        ob, ok, old = b, k, begin
        at, lengths, tokens = begin, [], []
        while True:
            while old < end or old + shift < at:  # no old boundary before the edit's end, or behind the new one, can hold
                if ob == len(self.blocks):
                    break
                if ok < len(self.blocks[ob][0]):
                    old += self.blocks[ob][0][ok]
                    ok += 1
                if ok >= len(self.blocks[ob][0]):
                    ob, ok = ob + 1, 0
            if at == old + shift and old >= end or at == len(self.text):
                break
            piece = self.count.match(self.text, at).group()
            lengths.append(len(piece))
            tokens.append(self.count(piece))
            at += len(piece)
            self.recounted += len(piece)
        if at == len(self.text) and not (at == old + shift and old >= end):
            ob, ok = len(self.blocks), 0
        head, tail = self.blocks[b], self.blocks[ob] if ob < len(self.blocks) else ([], [])
        lengths = head[0][:k] + lengths + tail[0][ok:]
        tokens = head[1][:k] + tokens + tail[1][ok:]
        last = min(ob, len(self.blocks) - 1)
        size = -(-len(lengths) // (last - b + 1))
        if size <= FULL * BLOCK:  # the blocks that the edit touched share what is there now; some may become empty
            for i in range(b, last + 1):
                at = (i - b) * size
                self.blocks[i] = lengths[at : at + size], tokens[at : at + size]
            self._corrected(b, last)
        else:  # blocks overflow, after at least (FULL - 1) * BLOCK new pre-tokens for each: the tree is built anew from the blocks' sums, without a look at the text
            self.blocks[b : last + 1] = [(lengths[i : i + BLOCK], tokens[i : i + BLOCK]) for i in range(0, len(lengths), BLOCK)]
            self.blocks = [x for x in self.blocks if x[0]]
            self._build()


def sample_edits(n: int, text: str) -> list[Edit]:
    """The edits that the query applies one after the other: an insertion, a deletion and a replacement, each within 40 code points."""
    head = text[:40]
    return [(n // 2, n // 2, head), (n // 4, n // 4 + 20, ""), (3 * n // 4, 3 * n // 4 + 10, head[::-1])]


def counted(docs: DataFrame, edits=sample_edits, path: str | None = None) -> DataFrame:
    """Token counts before and after edits.

    docs: doc_id, text; other columns are ignored. ``edits`` gives, from the
    number of code points and the text, (start, end, new text) in code points;
    each edit sees what the ones before it left. Gives for each row: doc_id,
    n_chars, n_tokens, edited_sha256, edited_tokens, recounted_chars (code
    points that edits had split and counted anew). Null is empty; repeated rows
    come out as often; a null doc_id stays null. Places beyond the text's end
    are its end.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in slices(batches, "__text", 1 << 20):
            rows = []
            for x in utf8(batch.column("__text")):
                text = bytes(x).decode("utf-8")
                doc = Document(text, count)
                before = doc.tokens()
                for e in edits(len(text), text):
                    doc.edit(*e)
                rows.append((len(text), before, hashlib.sha256(doc.text.encode("utf-8")).hexdigest(), doc.tokens(), doc.recounted))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=["doc_id", "n_chars", "n_tokens", "edited_sha256", "edited_tokens", "recounted_chars"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, n_chars long, n_tokens long, edited_sha256 string, edited_tokens long, recounted_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents"))
