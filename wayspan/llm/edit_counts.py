"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

The leaves of the tree hold runs of pre-tokens, with their characters and tokens; inner nodes hold
the sums. An edit finds its leaves by the sums of characters; text is cut into pre-tokens again
from two leaves before the edit until a cut falls on the border of an untouched leaf, and only
these leaves and their ancestors change. Cuts before that stay, because a pre-token depends on
what follows it only up to the end of a run of blanks; cuts after it stay, because the pattern
never looks back.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF = 32
REMEMBERED = 400_000  # pre-tokens whose counts a task keeps
EDITS = "array<struct<start:int,length:int,insert:string>>"


@dataclass
class Counter:
    """Tokens of a pre-token, by the byte-pair ranks of the vocabulary."""

    pattern: str
    ranks: dict[bytes, int]
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.cut = regex.compile(self.pattern)
        self.coder = tiktoken.Encoding("counts", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    def tokens(self, part: str) -> int:
        n = self.known.get(part)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = self.known[part] = len(self.coder.encode_ordinary(part))
        return n


class CountTree:
    """The segment tree of one text."""

    def __init__(self, text: str, counter: Counter, leaf: int = LEAF):
        self.counter, self.leaf = counter, leaf
        self.recut = 0
        self._build(text)

    def _build(self, text: str) -> None:
        self.text = text
        parts = self.counter.cut.findall(text)
        count = self.counter.tokens
        each = np.fromiter(map(count, parts), np.int64, len(parts))
        chars = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.arange(0, len(parts), self.leaf)
        used = max(1, len(starts))
        self.size = 1 << (used - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)  # characters, tokens
        if len(parts):
            self.sums[self.size : self.size + used, 0] = np.add.reduceat(chars, starts)
            self.sums[self.size : self.size + used, 1] = np.add.reduceat(each, starts)
        level = self.size
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level:2 * level:2] + self.sums[level + 1:2 * level:2]
            level //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a character; the last one at the end."""
        node, start = 1, 0
        while node < self.size:
            left = int(self.sums[2 * node, 0])
            # an empty right side holds nothing, so the end of the text belongs to the left
            if place - start < left or not self.sums[2 * node + 1, 0]:
                node = 2 * node
            else:
                start += left
                node = 2 * node + 1
        return node - self.size, start

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters from ``start``; both are cut to the text."""
        start = min(max(0, start), len(self.text))
        length = min(max(0, length), len(self.text) - start)
        first, at = self._leaf_at(start)
        for _ in range(2):  # a run of blanks may be two pre-tokens, the first of which looks past the second
            if at:
                first, at = self._leaf_at(at - 1)
        last, after = self._leaf_at(start + length)
        after += int(self.sums[self.size + last, 0])
        shift = len(insert) - length
        self.text = self.text[:start] + insert + self.text[start + length :]
        lens, counts, place = [], [], at
        end = after + shift  # border of the next untouched leaf in the new text
        for m in self.counter.cut.finditer(self.text, at):
            while m.start() > end and last + 1 < self.size:
                last += 1
                end += int(self.sums[self.size + last, 0])
            if m.start() == end:
                break
            lens.append(m.end() - m.start())
            counts.append(self.counter.tokens(m.group()))
            place = m.end()
        while place > end and last + 1 < self.size:
            last += 1
            end += int(self.sums[self.size + last, 0])
        self.recut += len(lens)
        slots = last - first + 1
        if len(lens) > 4 * self.leaf * slots:
            self._build(self.text)
            return
        edges = [len(lens) * k // slots for k in range(slots + 1)]
        for k in range(slots):
            self._set(first + k, sum(lens[edges[k] : edges[k + 1]]), sum(counts[edges[k] : edges[k + 1]]))


def vocabulary(spark: SparkSession, path: str):
    """The byte-pair ranks, read on the driver and broadcast; as large as the vocabulary."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def recount(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", edits_col: str = "edits", leaf: int = LEAF) -> DataFrame:
    """All columns of ``docs`` but the edits, with n_tokens of the text, edited_tokens after its edits
    (start, length, insert; in order, places in the text as edited so far), recut (pre-tokens cut
    again), edited_chars and tree (token sums of the nodes, the root first).

    Null text is empty; null edits are none, null fields 0 or empty. Places outside the text are
    moved to its ends.
    """
    shared = vocabulary(docs.sparkSession, ranks_path)
    own = [c for c in docs.columns if c not in (edits_col, text_col, "n_tokens", "edited_tokens", "recut", "edited_chars", "tree")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*own).schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pattern, shared.value)
        for batch in batches:
            *kept, texts, edits = batch.columns
            before, after, recut, chars, trees = [], [], [], [], []
            for text, changes in zip(texts, edits, strict=True):
                tree = CountTree(text.as_py() or "", counter, leaf)
                before.append(tree.tokens)
                for e in changes.as_py() or ():
                    if e is not None:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["insert"] or "")
                after.append(tree.tokens)
                recut.append(tree.recut)
                chars.append(len(tree.text))
                trees.append(tree.sums[1:, 1])
            limits = np.cumsum([0] + [len(t) for t in trees])
            lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(np.concatenate(trees) if trees else [], pa.int64()))
            yield pa.record_batch(
                [*kept, pa.array(before, pa.int64()), pa.array(after, pa.int64()), pa.array(recut, pa.int64()), pa.array(chars, pa.int64()), lists],
                names=[*own, "n_tokens", "edited_tokens", "recut", "edited_chars", "tree"],
            )

    rows = docs.select(*own, text_col, F.col(edits_col).cast(EDITS).alias(edits_col))
    return rows.mapInArrow(read, schema + "n_tokens long, edited_tokens long, recut long, edited_chars long, tree array<long>")


def with_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the edits of an edit log (id, seq, start, length, insert) as an array by seq;
    rows that share an id get the same edits. Edits of one document fit in its task, like its text."""
    each = F.struct("seq", "start", "length", "insert")
    lists = edits.groupBy(F.col(id_col).alias("_id")).agg(F.array_sort(F.collect_list(each)).alias("_log"))
    ordered = F.transform("_log", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["insert"].alias("insert")))
    return docs.join(lists, F.col(id_col) == F.col("_id"), "left").withColumn("edits", ordered).drop("_id", "_log")
