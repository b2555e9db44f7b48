"""Byte-level BPE encoding by segment trees, and decoding.

A piece of text (a word with the space before it) starts as the tokens of its bytes. The leaves of a segment tree hold,
for each adjacent pair, its merge rank with its place as the low bits; inner nodes hold the smaller child. The root is
then the leftmost pair of lowest rank: it is merged, at most three leaves change, and each change climbs to the root in
logarithmic steps, until no pair can be merged. Pieces of like length share arrays, so numpy merges one pair of
thousands of pieces at a time; the few of a rare length go one by one over the same kind of tree.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.llm import text as T

# Fixed value: how byte-level vocabularies of this family cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.int64(1) << 62
_PLACE_BITS = 40


def _byte_characters() -> dict[str, int]:
    """The printable stand-ins of bytes in the vocabulary file: visible Latin-1 ones stand for themselves, the others
    follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """A vocabulary file's tokens, merges and special tokens, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        characters = _byte_characters()
        names = dict(spec["model"]["vocab"])
        bytes_of = {i: bytes(characters[c] for c in name) for name, i in names.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bytes_of |= {i: name.encode() for name, i in self.special.items()}
        size = max(bytes_of) + 1
        self.token_bytes = np.frombuffer(b"".join(bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(bytes_of.get(i, b"")) for i in range(size)])])
        self.of_byte = np.array([names[c] for c, _ in sorted(characters.items(), key=lambda x: x[1])], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        key = np.array([names[a] << 32 | names[b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.pair, self.rank = key[order], order
        self.merged = np.array([names[a + b] for a, b in merges], np.int64)
        self.rank_of = dict(zip(key.tolist(), range(len(key)), strict=True))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, -1 where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], -1)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_one(v: Vocabulary, piece: bytes) -> list[int]:
    """Tokens of one piece."""
    token = v.of_byte[list(piece)].tolist()
    n = len(token)
    leaves = 1 << max(n - 2, 0).bit_length()
    none, mask = int(_NONE), (1 << _PLACE_BITS) - 1

    def leaf(i: int, j: int) -> int:
        rank = v.rank_of.get(token[i] << 32 | token[j], -1)
        return none if rank < 0 else rank << _PLACE_BITS | i

    tree = [none] * leaves + [leaf(i, i + 1) for i in range(n - 1)] + [none] * (leaves - n + 1)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

    def put(i: int, value: int) -> None:
        node = leaves + i
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while n > 1 and (least := tree[1]) != none:
        i = least & mask
        j = after[i]
        token[i], token[j] = int(v.merged[least >> _PLACE_BITS]), -1
        after[i] = k = after[j]
        put(j, none) if j < n - 1 else None
        put(i, leaf(i, k) if k < n else none)
        if k < n:
            before[k] = i
        if before[i] >= 0:
            put(before[i], leaf(before[i], i))
    return [t for t in token if t >= 0]


def merge_many(v: Vocabulary, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of pieces whose sizes have the same tree: all tokens, and the offsets that part the pieces."""
    rows, longest = len(first), int(size.max())
    leaves = 1 << max(longest - 2, 0).bit_length()
    place = np.arange(longest)
    inside = place < size[:, None]
    token = np.where(inside, v.of_byte[data[np.minimum(first[:, None] + place, len(data) - 1)]], -1)
    tree = np.full((rows, 2 * leaves), _NONE)
    if longest > 1:
        rank = v.ranks(token[:, :-1], token[:, 1:])
        good = (rank >= 0) & inside[:, 1:]
        tree[:, leaves : leaves + longest - 1] = np.where(good, rank << _PLACE_BITS | place[:-1], _NONE)
    for node in range(leaves - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    after = np.broadcast_to(place + 1, (rows, longest)).copy()
    before = np.broadcast_to(place - 1, (rows, longest)).copy()

    def put(row: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
        node = leaves + i
        tree[row, node] = value
        while leaves > 1 and node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def leaf(row: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        there = j < size[row]
        rank = v.ranks(token[row, i], token[row, np.where(there, j, i)])
        return np.where(there & (rank >= 0), rank << _PLACE_BITS | i, _NONE)

    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row):
        least = tree[row, 1]
        i = least & ((1 << _PLACE_BITS) - 1)
        j = after[row, i]
        k = after[row, j]
        token[row, i], token[row, j] = v.merged[least >> _PLACE_BITS], -1
        after[row, i] = k
        follows = k < size[row]
        before[row[follows], k[follows]] = i[follows]
        pair = j < leaves
        if pair.any():
            put(row[pair], j[pair], np.full(int(pair.sum()), _NONE))
        put(row, i, leaf(row, i, k))
        led = before[row, i] >= 0
        if led.any():
            put(row[led], before[row, i][led], leaf(row[led], before[row, i][led], i[led]))
        row = row[tree[row, 1] != _NONE]
    left = token >= 0
    return token[left], np.concatenate([[0], np.cumsum(left.sum(axis=1))])


@cache
def _classes() -> np.ndarray:
    """Per code point: 1 letter, 2 number, 3 white space, 0 other."""
    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(0x110000, np.uint8)
    for k, pattern in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1):
        for found in regex.finditer(pattern, every):
            out[found.start() : found.end()] = k
    return out


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of ``PIECES`` start, for texts given as code points one after the other; ``first`` is where
    each non-empty text starts."""
    n = len(points)
    kind = _classes()[points]
    new = np.zeros(n + 1, bool)
    new[first] = new[n] = True
    # A run of one class starts a piece, unless the single space before it does.
    start = new.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    space = points == 0x20
    lead = np.zeros(n + 1, bool)
    lead[1:n] = start[1:n] & ~new[1:n] & (kind[1:] != 3) & space[:-1]
    # White space before other text: all but its last character are one piece, the last one is another.
    last = np.zeros(n, bool)
    last[:-1] = (kind[:-1] == 3) & start[1:n] & ~new[1:n]
    start[:-1] |= last
    start[lead] = False
    # Contractions, where the apostrophe starts a run and no space led it.
    for i in np.flatnonzero((points == 0x27) & start[:-1]).tolist():
        tail = bytes(min(p, 255) for p in points[i + 1 : i + 3].tolist())
        for end in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
            if tail.startswith(end) and not new[i + 1 : i + 1 + len(end)].any():
                start[i + 1 : i + 1 + len(end)] = False
                start[i + 1 + len(end)] = True
                break
    return np.flatnonzero(start[:-1])


class Encoder:
    """Encodes many texts at once. Tokens of pieces are remembered by the hash of the piece, in arrays of ``room`` bytes
    in all at most, which changes no result; the pieces of one call may take more, and are forgotten with the next."""

    def __init__(self, v: Vocabulary, room: int = 32 << 20, together: int = 16):
        self.v, self.room, self.together = v, room, together
        self.forget()

    def forget(self) -> None:
        # Pieces in the order of their hashes, and the slot of each; tokens by slot.
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.token, self.at = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.used, self._new = 0, []

    def remembered(self) -> int:
        """Bytes in use."""
        return self.hashes.nbytes + self.slots.nbytes + self.token.nbytes + self.at.nbytes

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of pieces, -1 for those not remembered."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.slots[place], -1)

    def _settle(self) -> None:
        """Sorts in the pieces that were appended."""
        hashes = np.concatenate([self.hashes, *self._new])
        slots = np.concatenate([self.slots, np.arange(len(self.hashes), len(hashes))])
        order = np.argsort(hashes)
        self.hashes, self.slots, self._new = hashes[order], slots[order], []

    def _learn(self, hashes: np.ndarray, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        """Merges new pieces, those of like length together."""
        kind = np.ceil(np.log2(np.maximum(size - 1, 1))).astype(int)
        for k in np.unique(kind):
            of_kind = np.flatnonzero(kind == k)
            # Rare lengths one by one; the temporary arrays of the others are kept small.
            step = 1 if len(of_kind) < self.together else max(1, (1 << 18) >> k)
            for some in (of_kind[a : a + step] for a in range(0, len(of_kind), step)):
                if len(some) == 1:
                    i = int(some[0])
                    token = np.array(merge_one(self.v, data[first[i] : first[i] + size[i]].tobytes()))
                    at = np.array([0, len(token)])
                else:
                    token, at = merge_many(self.v, data, first[some], size[some])
                self._append(hashes[some], token, at)

    def _append(self, hashes: np.ndarray, token: np.ndarray, at: np.ndarray) -> None:
        slot, self.used = self.used, self.used + len(hashes)
        end = int(self.at[slot])
        while len(self.token) < end + len(token):
            self.token = np.concatenate([self.token, np.zeros_like(self.token)])
        while len(self.at) < slot + len(at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.token[end : end + len(token)] = token
        self.at[slot : slot + len(at)] = end + at
        self._new.append(hashes)

    def _specials(self, raw: bytes, at: np.ndarray) -> list[tuple[int, int, int]]:
        """First byte, byte after the last and token of each special token in the texts, in order."""
        found = []
        for name, token in self.v.special.items():
            mark = name.encode()
            i = raw.find(mark)
            while i >= 0:
                inside = np.searchsorted(at, i, "right") == np.searchsorted(at, i + len(mark) - 1, "right")
                if inside:
                    found.append((i, i + len(mark), token))
                i = raw.find(mark, i + (len(mark) if inside else 1))
        return sorted(found)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts (UTF-8 bytes and offsets), and their offsets."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        raw = data.tobytes()
        specials = self._specials(raw, at)
        cuts = np.unique(np.concatenate([at, *[[a, b] for a, b, _ in specials]]).astype(np.int64))
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        first = lead[piece_starts(points, np.searchsorted(lead, cuts[cuts < len(data)]))]
        if specials:
            inside = np.zeros(len(data), bool)
            for a, b, _ in specials:
                inside[a + 1 : b] = True
            first = first[~inside[first]]
        after = np.append(first[1:], len(data))
        hashes, where, number = np.unique(T.span_hashes(data, first, after), return_index=True, return_inverse=True)
        if self.remembered() > self.room:
            self.forget()
        slot = self._find(hashes)
        new = slot < 0
        if new.any():
            for a, _, token in specials:
                i = int(number[np.searchsorted(first, a)])
                if new[i]:
                    self._append(hashes[i : i + 1], np.array([token]), np.array([0, 1]))
                    new[i] = False
            self._learn(hashes[new], data, first[where[new]], (after - first)[where[new]])
            self._settle()
            slot = self._find(hashes)
        slot = slot[number]
        token, offsets = T.gather(self.token, self.at[slot], self.at[slot + 1])
        return token, offsets[np.searchsorted(first, at)]


@cache
def encoder(path: str) -> Encoder:
    """Of this Python worker."""
    return Encoder(vocabulary(path))


def decode(v: Vocabulary, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The texts of tokens, special ones too, in UTF-8; bytes that are no UTF-8 become the replacement character."""
    ids = ids.astype(np.int64)
    data, token_at = T.gather(v.token_bytes, v.token_at[ids], v.token_at[ids + 1])
    raw, ends = data.tobytes(), token_at[at]
    return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, keep: list[str], full: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for whole in batches:
        for batch in T.pieces(whole):
            ids, at = enc.encode(*T.utf8(batch.column("text")))
            decoded = decode(enc.v, ids, at)
            raw = ids.astype("<u4").tobytes()
            out = {c: batch.column(c) for c in keep}
            out["n_tokens"] = pa.array(np.diff(at))
            if full:
                out["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                out["decoded"] = pa.array([d.decode() for d in decoded], pa.string())
            of_ids = (raw[a:b] for a, b in zip((4 * at[:-1]).tolist(), (4 * at[1:]).tolist(), strict=True))
            out["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in of_ids], pa.string())
            out["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    # The worker may serve other stages next.
    enc.forget()


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), full: bool = False) -> DataFrame:
    """``docs`` encoded whole and decoded again: the columns ``keep``, n_tokens, ids_sha256, decoded_sha256, and with
    ``full`` the ids and the decoded text.

    A null or empty text has no tokens and decodes to the empty text. Special tokens that stand in a text are encoded
    as such. Repeated rows each give a row, an empty table gives none; other columns are ignored.
    """
    work = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, "text"))])
    kept = {f.name: f.dataType.simpleString() for f in work.schema.fields if f.name in keep}
    schema = ", ".join(f"`{c}` {kept[c]}" for c in keep) + ", n_tokens long"
    schema += ", ids array<int>, decoded string" * full + ", ids_sha256 string, decoded_sha256 string"
    return work.mapInArrow(partial(_encode_batches, path=path, keep=list(keep), full=full), schema)
