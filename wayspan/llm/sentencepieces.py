"""SentencePiece encoding and decoding by matching all pieces against a suffix array.

A chunk of texts is cut where no piece can span, equal parts are kept once, and their joined text
is indexed by its suffixes, sorted as far as the longest piece reaches. Every piece finds its
range of suffixes by binary search; each suffix in it is an edge of the piece over the text. The
edges are sorted by where they end and relaxed from left to right: the model merges pairs by
rank, and the best path to a place ends with the one edge that would not have been merged
otherwise with the last piece before it. The result is the model's own encoding, piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from wayspan.llm import wordhash

BLANK = "▁"
REACH = 16  # characters of a suffix that are sorted, four to a key
SLOTS = 1 << 21  # remembered pairs
TEXT_AT_ONCE = 4 << 20


def _order(x: np.ndarray) -> np.ndarray:
    """Stable order of non-negative integers; 16 bits at a time, which numpy sorts by counting."""
    by = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    top, shift = int(x.max(initial=0)) >> 16, 16
    while top:
        by = by[np.argsort(((x >> shift) & 0xFFFF).astype(np.uint16)[by], kind="stable")]
        top, shift = top >> 16, shift + 16
    return by


@dataclass
class Pieces:
    """Numbered so that characters come first and merged pieces follow in the order of merging."""

    alphabet: np.ndarray  # sorted code points; code = place + 1, 0: in no piece
    keys: np.ndarray  # (pieces, 4) packed codes
    length: np.ndarray
    ids: np.ndarray  # of the model
    left: np.ndarray  # halves of the last merge; a character is its own half
    right: np.ndarray
    pair: np.ndarray  # sorted left * count + right
    merged: np.ndarray
    byte_id: np.ndarray
    blob: np.ndarray  # bytes of all model ids, one after the other, and where they start
    begin: np.ndarray
    prefix: bool


def _merge(text: str, number: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Pieces of ``text`` after all merges, and the two that were merged last."""
    parts, last = list(text), None
    while len(parts) > 1:
        best = min(((number[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in number), default=None)
        if best is None:
            break
        i = best[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = ["".join(last)]
    return parts, last


def _packed(codes: np.ndarray) -> np.ndarray:
    """Four neighbouring 16-bit codes in one key, for every place."""
    c = np.concatenate([codes, np.zeros(3, np.uint16)]).astype(np.uint64)
    n = len(codes)
    return (c[:n] << np.uint64(48)) | (c[1 : n + 1] << np.uint64(32)) | (c[2 : n + 2] << np.uint64(16)) | c[3 : n + 3]


def load(model: bytes) -> Pieces:
    """Tables of a merge model (fixed size, whatever the texts)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model)
    spec = proto.normalizer_spec
    if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not proto.trainer_spec.byte_fallback:
        raise ValueError("only merge models with byte fallback and without normalisation are supported")
    normal = {p.piece: (-p.score, i) for i, p in enumerate(proto.pieces) if p.type == 1}
    if any(p[i] != BLANK and p[i + 1] == BLANK for p in normal for i in range(len(p) - 1)) or max(map(len, normal)) > REACH:
        raise ValueError("pieces that span words or are too long are not supported")
    chars = sorted(p for p in normal if len(p) == 1)
    # characters that only longer pieces hold cannot be built up from pieces
    longer = sorted((p for p in normal if len(p) > 1), key=normal.get)
    number = {p: len(chars) + k for k, p in enumerate(longer)}
    known = {c: k for k, c in enumerate(chars)} | number
    kept, halves = list(chars), {}
    for p in longer:
        parts, last = _merge(p, number)
        if parts == [p] and last[0] in known and last[1] in known:
            kept.append(p)
            halves[p] = last
    at = {p: k for k, p in enumerate(kept)}
    count = len(kept)
    pairs = {}
    for p in kept[len(chars) :]:
        for i in range(1, len(p)):
            if p[:i] in at and p[i:] in at:
                pairs[at[p[:i]] * count + at[p[i:]]] = at[p]
    alphabet = np.array(sorted({ord(c) for p in kept for c in p}), np.uint32)
    code = {int(c): k + 1 for k, c in enumerate(alphabet)}
    keys = np.zeros((count, REACH // 4), np.uint64)
    for k, p in enumerate(kept):
        codes = np.array([code[ord(c)] for c in p] + [0] * (REACH - len(p)), np.uint16)
        keys[k] = _packed(codes)[::4]
    order = np.array(sorted(pairs), np.int64)
    surface, byte_id = [], np.zeros(256, np.int64)
    for i, p in enumerate(proto.pieces):
        if p.type == 6:
            byte_id[int(p.piece[3:5], 16)] = i
            surface.append(bytes([int(p.piece[3:5], 16)]))
        else:
            surface.append(p.piece.replace(BLANK, " ").encode() if p.type == 1 else proto.trainer_spec.unk_surface.encode() if p.type == 2 else b"")
    return Pieces(
        alphabet, keys, np.array([len(p) for p in kept]), np.array([normal[p][1] for p in kept]),
        np.array([at[halves[p][0]] if p in halves else at[p] for p in kept]), np.array([at[halves[p][1]] if p in halves else at[p] for p in kept]),
        order, np.array([pairs[int(k)] for k in order], np.int64), byte_id,
        np.frombuffer(b"".join(surface), np.uint8), np.cumsum([0] + [len(s) for s in surface]), spec.add_dummy_prefix,
    )


def stable_pairs(v: Pieces, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the model leaves piece ``one`` followed by piece ``two`` as they are: undo their
    merges from the latest on, and see that no earlier merge would have joined them."""
    one, two = one.copy(), two.copy()
    limit = np.full(len(one), np.iinfo(np.int64).max)
    out = np.ones(len(one), bool)
    alive = np.arange(len(one))
    count = len(v.ids)
    while len(alive):
        a, b, most = one[alive], two[alive], limit[alive]
        key = a * count + b
        spot = np.minimum(np.searchsorted(v.pair, key), len(v.pair) - 1)
        bad = (v.pair[spot] == key) & (v.merged[spot] < most)
        out[alive[bad]] = False
        can_a, can_b = v.right[a] != a, v.left[b] != b
        undo_a = can_a & ((a > b) | ~can_b)
        undo_b = ~undo_a & can_b
        one[alive[undo_a]], limit[alive[undo_a]] = v.right[a[undo_a]], a[undo_a]
        two[alive[undo_b]], limit[alive[undo_b]] = v.left[b[undo_b]], b[undo_b] + 1
        alive = alive[~bad & (undo_a | undo_b)]
    return out


class Encoder:
    def __init__(self, pieces: Pieces):
        self.v = pieces
        self.slot_key = np.full(SLOTS, -1, np.int64)
        self.slot_value = np.zeros(SLOTS, bool)

    def _stable(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = one * len(self.v.ids) + two
        slot = (wordhash._mix(key.astype(np.uint64)) % np.uint64(SLOTS)).astype(np.int64)
        out = self.slot_value[slot]
        missing = np.flatnonzero(self.slot_key[slot] != key)
        if len(missing):
            fresh, back = np.unique(key[missing], return_inverse=True)
            value = stable_pairs(self.v, fresh // len(self.v.ids), fresh % len(self.v.ids))
            out[missing] = value[back]
            self.slot_key[slot[missing]], self.slot_value[slot[missing]] = key[missing], out[missing]
        return out

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, piece) of every occurrence of every piece, sorted by end."""
        v, n = self.v, len(codes)
        key = _packed(np.concatenate([codes, np.zeros(REACH, np.uint16)]))
        _, rank = np.unique(key, return_inverse=True)
        # ranks of 4 characters make ranks of 8, and these the order of 16
        rank = np.concatenate([rank, np.zeros(8, rank.dtype)]).astype(np.uint64)
        _, rank8 = np.unique((rank[:-4] << np.uint64(32)) | rank[4:], return_inverse=True)
        rank8 = np.concatenate([rank8, np.zeros(8, rank8.dtype)]).astype(np.uint64)
        order = np.argsort((rank8[:n] << np.uint64(32)) | rank8[8 : n + 8], kind="stable")
        low = self._bound(key, order, v.keys)
        high = self._bound(key, order, self._above(), upto=True)
        found = high - low
        spot = order[np.repeat(low, found) + np.arange(int(found.sum())) - np.repeat(np.cumsum(found) - found, found)]
        piece = np.repeat(np.arange(len(found)), found)
        end = spot + v.length[piece]
        by = _order(end)
        return end[by], piece[by]

    def _above(self) -> np.ndarray:
        """Keys of the pieces filled up with the largest code."""
        shift = np.clip(np.arange(REACH // 4)[None, :] * -4 + self.v.length[:, None], 0, 4).astype(np.uint64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        return self.v.keys | np.where(shift == 4, np.uint64(0), full >> (np.minimum(shift, np.uint64(3)) * np.uint64(16)))

    @staticmethod
    def _bound(key: np.ndarray, order: np.ndarray, wanted: np.ndarray, upto: bool = False) -> np.ndarray:
        """Number of sorted suffixes below each wanted key, or up to it."""
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
        while (low < high).any():
            open_ = np.flatnonzero(low < high)
            mid = (low[open_] + high[open_]) // 2
            below, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for k in range(wanted.shape[1]):
                have, want = key[order[mid] + 4 * k], wanted[open_, k]
                below |= equal & (have < want)
                equal &= have == want
            below |= equal & upto
            low[open_[below]] = mid[below] + 1
            high[open_[~below]] = mid[~below]
        return low

    def parts(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, limits) of the parts [start, end) of ``codes``, which hold no code 0."""
        end, piece = self.edges(codes)
        size = len(codes) + 1
        first = np.zeros(size, np.int64)
        first[starts[1:]] = 1
        first = starts[np.cumsum(first[:-1])] if len(starts) else first[:-1]  # start of the part of each place
        begin = end - self.v.length[piece]
        inside = first[begin] == first[end - 1]  # a separator lies between parts, but be sure
        end, piece, begin = end[inside], piece[inside], begin[inside]
        last, back, depth = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        step = end - first[begin]
        by = _order(step)
        edge = np.searchsorted(step[by], np.arange(1, int(step.max(initial=0)) + 2))
        for lo, hi in zip(edge, edge[1:], strict=False):
            e = by[lo:hi]
            if not len(e):
                continue
            b, p = begin[e], piece[e]
            at_start = b == first[b]
            open_ = at_start | (last[b] >= 0)
            e, b, p, at_start = e[open_], b[open_], p[open_], at_start[open_]
            good = at_start.copy()
            inner = np.flatnonzero(~at_start)
            good[inner] = self._stable(last[b[inner]], p[inner])
            e, b, p = e[good], b[good], p[good]
            last[end[e]], back[end[e]], depth[end[e]] = p, b, np.where(b == first[b], 0, depth[b]) + 1
        count = depth[ends]
        limits = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(limits[-1]), np.int64)
        here, slot = ends.copy(), limits[1:] - 1
        alive = np.flatnonzero(here > starts)
        while len(alive):
            out[slot[alive]] = last[here[alive]]
            slot[alive] -= 1
            here[alive] = back[here[alive]]
            alive = alive[here[alive] > starts[alive]]
        return out, limits

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(model ids, limits by text)."""
        v = self.v
        marked = [(BLANK if v.prefix else "") + t if t else "" for t in texts]
        points = np.frombuffer("".join(marked).replace(" ", BLANK).encode("utf-32-le"), np.uint32)
        rows = np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)
        spot = np.minimum(np.searchsorted(v.alphabet, points), len(v.alphabet) - 1)
        codes = np.where(v.alphabet[spot] == points, spot + 1, 0).astype(np.uint16)
        blank, strange = points == ord(BLANK), codes == 0
        fresh = np.ones(len(points), bool)
        fresh[1:] = (blank[1:] & ~blank[:-1]) | strange[1:] | strange[:-1]
        inner = rows[(rows > 0) & (rows < len(points))]
        fresh[inner] = True
        start = np.flatnonzero(fresh)
        stop = np.append(start[1:], len(points))
        kind, rep = self._kinds(points, start, stop)
        ids, limits = self._encode_kinds(points, codes, start[rep], stop[rep])
        count = np.diff(limits)[kind]
        where = np.repeat(limits[:-1][kind], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        before = np.concatenate([[0], np.cumsum(count)])
        return ids[where], before[np.searchsorted(start, rows)]

    @staticmethod
    def _kinds(points: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(kind of each part, one part of each kind); parts of a kind are equal."""
        one, two = wordhash.word_hashes(points, start, stop, (0x9E3779B97F4A7C15, 0xD1342543DE82EF95))
        _, rep, kind = np.unique(one, return_index=True, return_inverse=True)
        odd = np.flatnonzero(two[rep[kind]] != two)  # the first hash met by chance: kinds of their own
        kind[odd] = len(rep) + np.arange(len(odd))
        return kind, np.append(rep, odd)

    def _encode_kinds(self, points: np.ndarray, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.v
        strange = np.flatnonzero(codes[start] == 0)
        plain = np.flatnonzero(codes[start] != 0)
        lens = (stop - start)[plain]
        begins = np.cumsum(lens + 1) - lens - 1
        joined = np.zeros(int((lens + 1).sum()), np.uint16)
        within = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        joined[np.repeat(begins, lens) + within] = codes[np.repeat(start[plain], lens) + within]
        found, limits = self.parts(joined, begins, begins + lens)
        spelled = [v.byte_id[list(chr(p).encode("utf-8", "surrogatepass"))] for p in points[start[strange]]]
        count = np.zeros(len(start), np.int64)
        count[plain] = np.diff(limits)
        count[strange] = [len(s) for s in spelled]
        total = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(int(total[-1]), np.int64)
        n = np.diff(limits)
        out[np.repeat(total[:-1][plain], n) + np.arange(len(found)) - np.repeat(limits[:-1], n)] = v.ids[found]
        for at, s in zip(total[:-1][strange], spelled, strict=True):
            out[at : at + len(s)] = s
        return out, total


def decode(v: Pieces, ids: np.ndarray, limits: np.ndarray) -> list[str]:
    """Texts of the runs of ids; bytes that are no UTF-8 become U+FFFD."""
    size = np.diff(v.begin)[ids]
    before = np.concatenate([[0], np.cumsum(size)])
    raw = v.blob[np.repeat(v.begin[:-1][ids], size) + np.arange(int(before[-1])) - np.repeat(before[:-1], size)].tobytes()
    cuts = before[limits]
    texts = (raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:]))
    return [t[1:] if v.prefix and t[:1] == " " else t for t in texts]


def _runs(texts: pa.Array, at_once: int = TEXT_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Rows that together have about ``at_once`` bytes."""
    row = 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    limits = np.concatenate([[0], np.cumsum(sizes)])
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(limits, limits[row] + at_once, "right")) - 1)
        yield row, end
        row = end


def model_tables(spark: SparkSession, path: str):
    """The tables, read on the driver and broadcast; they are as large as the model, not the data."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(load(f.read()))


def encode_column(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "piece_ids", exact_col: str = "round_trip", at_once: int = TEXT_AT_ONCE) -> DataFrame:
    """All rows and columns with the ids of the text, and whether these decode to the text again.

    ``at_once`` bytes of text are encoded together: fewer take less memory of a worker and somewhat more time.

    Null and empty texts have no ids and decode to the empty text. A text that holds the model's
    sign for blanks decodes with blanks there, so it is not exact. A column that has one of the
    new names is replaced. An empty table gives an empty result.
    """
    shared = model_tables(docs.sparkSession, model)
    own = [c for c in docs.columns if c not in (ids_col, exact_col)]
    spot = own.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*own).schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shared.value)
        for batch in batches:
            texts = batch.column(spot)
            for start, end in _runs(texts, at_once):
                plain = [t or "" for t in texts.slice(start, end - start).to_pylist()]
                ids, limits = coder.encode(plain)
                exact = [a == b for a, b in zip(plain, decode(coder.v, ids, limits), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([c.slice(start, end - start) for c in batch.columns] + [lists, pa.array(exact)], names=[*batch.schema.names, ids_col, exact_col])

    return docs.select(*own).mapInArrow(read, f"{schema}, `{ids_col}` array<int>, `{exact_col}` boolean")


def decode_column(rows: DataFrame, model: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """All rows and columns with the text of the ids; null ids are no ids."""
    shared = model_tables(rows.sparkSession, model)
    own = [c for c in rows.columns if c != text_col]
    spot = own.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*own).schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x or [] for x in batch.column(spot).to_pylist()]
            limits = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            texts = decode(shared.value, np.array([i for x in lists for i in x], np.int64), limits)
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return rows.select(*own).mapInArrow(read, f"{schema}, `{text_col}` string")
