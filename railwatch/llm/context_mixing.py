"""Language-model scoring by online logistic context mixing.

Counts. Blocks of documents send their distinct words with training counts, by group of documents (a hash of a column
such as the language), to slices of the vocabulary; a slice adds them up and later tells each block what it needs.

Spelling. The bytes of the running text, words and ends alike, are coded bit by bit. Predictors look up how often a bit
was 0 or 1 after the last one to five bytes, across words, in all of the training text; a gate, the longest context that
has been seen, picks the weights that mix them in the logistic domain, and an adaptive map refines the result. What they say
of a byte follows from the five bytes before it, so blocks ask about distinct grams (five bytes and the next one) and tell
how often each stands in their training text. Grams are kept in slices of their contexts' hashes, and ask slices of the
shorter contexts. Each slice trains weights and map online on the training text of its grams, batch after batch, each gram by
how often it is there and without the counts of one occurrence; the slices' results are averaged, in ``ROUNDS`` rounds.

Contexts. Blocks ask slices of hashes how often each pair and triple of consecutive tokens stands in the running text of the
training documents, so the one and two words before a token are contexts that foretell it. What a training document has
added itself does not count for its own tokens; one that occurs twice is told by its copy.

Text. Five predictors of the next word are mixed: the words of the groups, weighed by how well each group has foretold
the document so far; the spelling after the bytes before it; the words the document has had already; and the contexts of one and of two words. A
gate, the longest context that has been seen and how often, picks the weights; they start from a prior and follow, within each
document, what each has explained under that gate up to that word. The prior of the spelling is twice the share of
training tokens that are there once, the usual estimate of how often a new word comes. All of it depends on earlier words alone, so the
product is a probability of the text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.llm import exchange as X
from railwatch.llm import text as T
from railwatch.sources.tables import store

GROUPS = 64
ORDERS = 5
ROUNDS = 2
RECENT = 0.05
LEAST_NEW, MOST_NEW = 0.02, 0.5
PRIOR_WEIGHT = 20.0
_DELTA = 0.3
_PAIR, _TRIPLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PHRASE_BITS = ~np.uint64(0xFFFF)
#: Times a context has been seen, from which the next gate counts; and per gate what its predictor gets at first.
SEEN = (1, 2, 4, 16)
FIRST_TRUST = ((0.1, 0.2, 0.35, 0.5), (0.3, 0.4, 0.5, 0.6))
_END = 0x20
#: Contexts of ``ORDERS`` bytes; an odd number and its inverse, which spread them; and a gram of ends.
_CONTEXT = (np.uint64(1) << np.uint64(8 * ORDERS)) - np.uint64(1)
_ODD = np.uint64(0x9E3779B97F)
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 8 * ORDERS))
_ENDS = np.uint64(int.from_bytes(bytes([_END] * (ORDERS + 1)), "big"))
#: Of a byte that nothing is known of.
_EVEN = -8 * np.log(2)
# Arrays of a piece stay in a core's cache.
PIECE_BYTES = 1 << 17


# --- spelling ----------------------------------------------------------------------------------------------------


def _grams(text: np.ndarray) -> np.ndarray:
    """For bytes of running text, each with the ``ORDERS`` before it as one number, its own the lowest. What is before the
    first is ends."""
    wide = np.concatenate([np.full(ORDERS, _END, np.uint8), text, np.zeros(7 - ORDERS, np.uint8)])
    return np.ndarray((len(text),), ">u8", wide, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - ORDERS))


def _bases(gram: np.ndarray) -> list[np.ndarray]:
    """Per order, the hash of the context of each gram's last byte, its low byte 0."""
    context = gram >> np.uint64(8)
    masks = [(np.uint64(1) << np.uint64(8 * k)) - np.uint64(1) for k in range(1, ORDERS + 1)]
    return [T.mix((context & mask) * np.uint64(8) + np.uint64(k)) & ~np.uint64(0xFF) for k, mask in enumerate(masks, 1)]


def _events(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For bytes of words, each ended by a space: where words end, and per order the hash of the context of each, its
    low byte 0."""
    return np.flatnonzero(words == _END), _bases(_grams(words))


def _spread(gram: np.ndarray) -> np.ndarray:
    """Grams in an order of their own, by a hash of the context: one to one, the next byte the lowest as before."""
    context = gram >> np.uint64(8)
    context = ((context ^ context >> np.uint64(20)) * _ODD & _CONTEXT) << np.uint64(8)
    context |= gram & np.uint64(0xFF)
    return context


def _gathered(spread: np.ndarray) -> np.ndarray:
    """The grams again."""
    context = (spread >> np.uint64(8)) * _BACK & _CONTEXT
    return (context ^ context >> np.uint64(20)) << np.uint64(8) | spread & np.uint64(0xFF)


def _running(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The running text of documents in lower case, a space behind each word and one more behind each document, and the
    offsets of documents in it."""
    after = at[1:] + 2 * np.arange(1, len(at))
    wide = np.insert(data, np.repeat(at[1:], 2), _END)
    space = T.is_space(wide)
    wide[space] = _END
    # Of a stretch of white space the first stays, and the second that is put behind each document.
    space[1:] &= space[:-1]
    space[after - 1] = False
    keep = ~space
    return wide[keep], np.concatenate([[0], np.cumsum(np.add.reduceat(keep, np.concatenate([[0], after[:-1]]), dtype=np.int64))])


class _RunningGrams:
    """The distinct grams of some documents, spread and ascending; and which of them each byte of the running text is, sorted
    by it."""

    def __init__(self, t: _Tokens):
        text, self.at = _running(t.data, t.text_at)
        gram = _grams(text)
        # Nothing of the document before is context.
        for k in range(ORDERS):
            here = self.at[:-1] + k
            here = here[here < self.at[1:]]
            own = (np.uint64(1) << np.uint64(8 * (k + 1))) - np.uint64(1)
            gram[here] = gram[here] & own | _ENDS & ~own
        self.ends = np.flatnonzero(text == _END) + 1
        order, ascending = T.order(_spread(gram), 8 * (ORDERS + 1))
        self.order = order.astype(np.int32)
        self.lead = _lead(ascending)
        self.distinct = ascending[self.lead]

    def times(self, learned: np.ndarray) -> np.ndarray:
        """How often each stands in the documents that are learned from."""
        own = np.repeat(learned, np.diff(self.at))[self.order]
        return np.add.reduceat(own, self.lead, dtype=np.uint32) if len(self.lead) else np.zeros(0, np.uint32)

    def by_token(self, values: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each token of its grams' values."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = np.repeat(values, np.diff(np.append(self.lead, len(self.order))))
        return T.group_sums(out, np.concatenate([[0], self.ends]))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Ascending. A sort is far faster than ``np.unique`` where most are there once."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _lead(ascending: np.ndarray) -> np.ndarray:
    """Where each of ascending numbers is first."""
    new = np.ones(len(ascending), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return np.flatnonzero(new)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``np.searchsorted``, in the order of the keys, as far as upper bits and low byte tell: neighbours are looked up one
    after the other."""
    place = np.uint64(len(wanted).bit_length())
    packed = wanted >> (place + np.uint64(8)) << np.uint64(8) | wanted & np.uint64(0xFF)
    packed = packed << place | np.arange(len(wanted), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << place) - np.uint64(1))).view(np.int64)
    out = np.empty(len(wanted), np.int64)
    out[order] = np.searchsorted(keys, wanted[order])
    return out


def _slots(base: np.ndarray, node: np.ndarray) -> np.ndarray:
    return base | node.astype(np.uint64)


class BitCounts:
    """How often each byte came after each context, of which the counts of bits at any node of the byte follow."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n  # sorted contexts with their byte in the low byte, times seen

    def having(self, keys: np.ndarray) -> BitCounts:
        """With these, too, if only as never seen."""
        more = _distinct(keys)
        at = np.searchsorted(self.keys, more)
        more = more[np.append(self.keys, np.uint64(0))[at] != more] if len(self.keys) else more
        if not len(more):
            return self
        all_keys = np.concatenate([self.keys, more])
        order = np.argsort(all_keys)
        return BitCounts(all_keys[order], np.concatenate([self.n, np.zeros(len(more), np.int64)])[order])

    def odds(self, own: bool = False) -> np.ndarray:
        """Per key, log odds of a 1 at each bit of its byte (key, bit), by how often it was 0 and 1 after the same context
        and higher bits; ``own``: without one word that has the key."""
        out = np.empty((len(self.keys), 8))
        # Keys that share all but the bits below ``b``: first ones and sums.
        first, n = np.arange(len(self.keys)), self.n
        for b in range(8):
            node = self.keys[first] >> np.uint64(b)
            pair = node >> np.uint64(1)
            new = np.ones(len(first), bool)
            new[1:] = pair[1:] != pair[:-1]
            other = np.zeros(len(first), n.dtype)
            other[:-1] = n[1:] * ~new[1:]
            other[1:] += n[:-1] * ~new[1:]
            mine = np.maximum(n - 1, 0) if own else n
            odds = np.log((mine + _DELTA) / (other + _DELTA))
            np.negative(odds, out=odds, where=node & np.uint64(1) == 0)
            out[:, b] = odds if b == 0 else np.repeat(odds, np.diff(np.append(first, len(self.keys))))
            first, n = first[new], (n + other)[new]
        return out

    def __getitem__(self, slots: np.ndarray) -> np.ndarray:
        """Log odds of a 1 at any node of any context."""
        out = np.zeros(len(slots))
        total = np.concatenate([[0], np.cumsum(self.n)])
        for i, slot in enumerate(slots.tolist()):
            node, left = slot & 0xFF, 9 - (slot & 0xFF).bit_length()
            low = (slot & ~0xFF) + (node << left) - 256
            ends = [low, low + (1 << left - 1), low + (1 << left) - 1]
            sides = ("left", "left", "right")
            c = [total[np.searchsorted(self.keys, np.uint64(e), side)] for e, side in zip(ends, sides, strict=True)]
            out[i] = np.log((c[2] - c[1] + _DELTA) / (c[1] - c[0] + _DELTA))
        return out


def _sums(keys: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    lead = _lead(keys)
    return [keys[lead], np.add.reduceat(n[order], lead, dtype=np.int64) if len(lead) else n]


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams, how often each is there, and which each is."""
    distinct, number = T.numbered(grams, 8 * (ORDERS + 1))
    return distinct, np.bincount(number, minlength=len(distinct)), number


def _context_bytes(gram: np.ndarray, n: np.ndarray, orders: slice = slice(None)) -> list[np.ndarray]:
    """The distinct contexts of grams with their next byte, and how often each is there."""
    bases = _bases(gram)[orders]
    return _sums(np.concatenate([_slots(base, gram & np.uint64(0xFF)) for base in bases]), np.tile(n, len(bases)))


def count_bits(words: np.ndarray) -> BitCounts:
    return BitCounts(*_context_bytes(*_counted(_grams(words))[:2]))


def _gate(inputs: np.ndarray) -> np.ndarray:
    """The longest context that has been seen, for inputs (..., order, event)."""
    gate = np.zeros(inputs.shape[:-2] + inputs.shape[-1:], np.int8)
    for k in range(ORDERS):
        np.maximum(gate, (inputs[..., k, :] != 0) * np.int8(k + 1), out=gate)
    return gate


def _by_bit(odds: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Log odds by bit, order and event, of the keys at ``leaf`` (order, event)."""
    return np.ascontiguousarray(odds.take(leaf.ravel(), axis=0).T).reshape(8, *leaf.shape)


def _own(gate: np.ndarray) -> np.ndarray:
    """Where events find theirs in values by gate and event."""
    return gate * np.int64(gate.shape[-1]) + np.arange(gate.shape[-1])


@dataclass
class Mixer:
    weights: np.ndarray  # per gate and order
    refined: np.ndarray  # per gate and step of log odds, log odds of a 1

    @staticmethod
    def new() -> Mixer:
        return Mixer(np.full((ORDERS + 1, ORDERS), 0.4), np.tile((np.arange(49) - 24) / 2.0, (ORDERS + 1, 1)))

    def bits(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gate, mixed log odds and place in the map for inputs (order, event)."""
        gate = _gate(inputs)
        return gate, *self.mixed(inputs, gate)

    def mixed(self, inputs: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # By the weights of all gates, of which each event takes its own.
        every = (self.weights @ inputs).ravel()
        mixed = np.clip(every.take(_own(gate)), -12, 12)
        return mixed, np.round(mixed * 2).astype(np.int64) + 24

    def train(self, counts: BitCounts, words: np.ndarray) -> np.ndarray:
        """Learns from all of the running text ``words``; gives how often each gate and step of the map was met."""
        return self.learn(counts, *_counted(_grams(words))[:2])

    def learn(self, counts: BitCounts, gram: np.ndarray, n: np.ndarray, batch: int = 512) -> np.ndarray:
        """Learns online from text that has each gram ``n`` times, in an order that has nothing to do with the text. Gives how
        often each gate and step of the map was met in it."""
        gates, steps = self.refined.shape
        met = np.zeros(gates * steps)
        # Without what the occurrence itself has added.
        odds = counts.odds(own=True)
        order = np.argsort(T.mix(gram[n > 0]))
        gram, n = gram[n > 0][order], n[n > 0][order].astype(np.float64)
        leaf = np.stack([_find(counts.keys, _slots(base, gram & np.uint64(0xFF))) for base in _bases(gram)])
        for a in range(0, len(gram), batch):
            here = slice(a, a + batch)
            inputs, times = _by_bit(odds, leaf[:, here]), n[here]
            gate = _gate(inputs)
            own, row = _own(gate), gate * np.int64(steps) + steps // 2
            by_gate = gate[:, None] == np.arange(gates, dtype=np.int8)[:, None]
            # The mean over all occurrences moves as far as one of so many grams does.
            norm = np.sqrt(by_gate.sum(axis=2)) / np.maximum(by_gate @ times, 1)
            bits = (gram[here] >> np.arange(8, dtype=np.uint64)[:, None] & np.uint64(1)).astype(np.float64)
            for b in range(7, -1, -1):
                mixed = np.clip((self.weights @ inputs[b]).ravel().take(own[b]), -12, 12)
                place = row[b] + np.round(mixed * 2).astype(np.int64)
                error = (bits[b] - 1 / (1 + np.exp(-mixed))) * times
                self.weights += 0.02 * (by_gate[b] * error @ inputs[b].T) * norm[b][:, None]
                seen = (bits[b] - 1 / (1 + np.exp(-self.refined.ravel().take(place)))) * times
                here_met = np.bincount(place, times, gates * steps)
                share = 0.02 * np.bincount(place, minlength=gates * steps) / np.maximum(here_met, 1)
                self.refined += (share * np.bincount(place, seen, gates * steps)).reshape(gates, steps)
                met += here_met
        self.refined = np.clip(self.refined, -12, 12)
        return met.reshape(gates, steps)


@dataclass
class Speller(Mixer):
    counts: BitCounts

    @property
    def stretch(self) -> list[BitCounts]:
        """Per order, what gives the log odds of a slot."""
        return [self.counts] * ORDERS

    def log_probability(self, words: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability after those before it, its end included."""
        gram, _, number = _counted(_grams(words))
        return T.group_sums(self.of_grams(gram)[number], np.concatenate([[0], np.flatnonzero(words == _END) + 1]))

    def of_grams(self, gram: np.ndarray, few: int = 1 << 13) -> np.ndarray:
        """Natural log of the probability of each gram's last byte after the others; arrays of a ``few`` stay in a core's
        cache."""
        slots = np.stack([_slots(base, gram & np.uint64(0xFF)) for base in _bases(gram)])
        # Most, if not all, have been asked for.
        counts = self.counts.having(slots.ravel())
        leaf = np.stack([_find(counts.keys, some) for some in slots])
        odds_of = counts.odds().astype(np.float32)
        total = np.zeros(len(gram))
        for here in (slice(i, i + few) for i in range(0, len(gram), few)):
            inputs = _by_bit(odds_of, leaf[:, here])
            for place in range(7, -1, -1):
                gate, mixed, step = self.bits(inputs[place])
                odds = (mixed + self.refined[gate, step]) / 2
                # Log of 1 + e^odds for a 0, of 1 + e^-odds for a 1.
                odds *= 1 - 2.0 * (gram[here] >> np.uint64(place) & np.uint64(1))
                total[here] -= np.maximum(odds, 0) + np.log1p(np.exp(-np.abs(odds)))
        return total

    @staticmethod
    def fit(counts: BitCounts, words: np.ndarray) -> Speller:
        """Weights and map, trained online over ``words``; counts of all words."""
        mixer = Mixer.new()
        mixer.train(counts, words)
        return Speller(mixer.weights, mixer.refined, counts)


# --- blocks and slices -------------------------------------------------------------------------------------------


class _Tokens:
    """The tokens of some documents: hash per token, the end of a document being the empty word."""

    def __init__(self, docs: pa.Table):
        data, at = T.utf8(docs.column("text"))
        self.data, self.text_at = T.lower(data), at
        first, after, row = T.tokens(self.data, at)
        number = np.arange(len(first)) + row
        n = len(at) - 1
        self.at = np.concatenate([[0], np.searchsorted(first, at[1:]) + np.arange(1, n + 1)])
        self.first, self.after = np.zeros(len(first) + n, np.int64), np.zeros(len(first) + n, np.int64)
        self.first[number], self.after[number] = first, after
        self.row = np.repeat(np.arange(n), np.diff(self.at))
        self.key = T.span_hashes(self.data, self.first, self.after)


def _phrases(t: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each token with the one and the two before it, and whether there are two: the end of a document stands
    before the first token of the next, and, being the same in all, before that of the first."""
    end = T.span_hashes(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))
    # The upper 48 bits, as random bytes do not compress when sent: at a billion phrases, 1 in 280,000 meets another.
    pair = T.mix(np.concatenate([end, t.key[:-1]]) * _PAIR + t.key) & _PHRASE_BITS
    triple = T.mix(np.concatenate([end, pair[:-1]]) * _TRIPLE + t.key) & _PHRASE_BITS
    two = np.ones(len(pair), bool)
    two[t.at[:-1]] = False
    return pair, triple, two


def _pieces(docs: pa.Table) -> Iterator[pa.Table]:
    _, at = T.utf8(docs.column("text"))
    start = 0
    while start < docs.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + PIECE_BYTES, "right")) - 1)
        yield docs.slice(start, end - start)
        start = end


def _group_table(docs: pa.Table) -> np.ndarray:
    """Group per document, -1 for those not to learn from."""
    return docs.column("part").combine_chunks().fill_null(-1).to_numpy()


def _ask_words(docs: pa.Table, told: dict, slices: int) -> Iterator[pa.RecordBatch]:
    keys, groups, phrases, grams, gram_times = [], [], [], [], []
    for piece in _pieces(docs):
        t = _Tokens(piece)
        group = _group_table(piece) + 1
        running = _RunningGrams(t)
        grams.append(running.distinct)
        gram_times.append(running.times(group > 0))
        group = group[t.row]
        pair, triple, two = _phrases(t)
        # The lower bits of a phrase are free to tell whether it counts.
        learn = (group > 0).astype(np.uint64)
        phrases += [pair | learn, (triple | learn)[two]]
        keys.append(t.key)
        groups.append(group)
    order, ascending = T.order(np.concatenate(keys), 64)
    group = np.concatenate(groups)[order]
    lead = _lead(ascending)
    distinct = ascending[lead]
    number = np.repeat(np.arange(len(distinct)), np.diff(np.append(lead, len(order))))
    # Sparse counts, sorted by word and group.
    learn = group > 0
    cell = np.sort(number[learn] * GROUPS + group[learn] - 1)
    cells = _lead(cell)
    total = np.diff(np.append(cells, len(cell)))
    of_word, of_group = np.divmod(cell[cells], GROUPS)
    block = docs.column("block")[0].as_py()

    def row(s: int, **values) -> pa.RecordBatch:
        values |= {"block": block, "slice": s}
        return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in zip(_ASKED_NAMES, _ASKED_TYPES, strict=True)], _ASKED_NAMES)

    both = np.sort(np.concatenate(phrases))
    phrase = both & _PHRASE_BITS
    new = _lead(phrase)
    phrase = phrase[new]
    times = np.add.reduceat(both & ~_PHRASE_BITS, new).astype(np.uint32)
    for s, a, b in _cuts(phrase, slices):
        yield row(s, phrases=X.pack_ascending(phrase[a:b]), times=X.pack(times[a:b]))
    gram, times = _summed(np.concatenate(grams), np.concatenate(gram_times))
    for s, a, b in _cuts(gram << _GRAM_SHIFT, slices):
        yield row(s, grams=X.pack_ascending(gram[a:b]), times=X.pack(times[a:b].astype(np.uint32)))
    for s, a, b in _cuts(distinct, slices):
        i, j = np.searchsorted(of_word, [a, b])
        counted = (X.pack((of_word[i:j] - a).astype(np.uint32)), of_group[i:j].astype(np.uint8).tobytes(), X.pack(total[i:j].astype(np.uint32)))
        yield row(s, words=X.pack_ascending(distinct[a:b]), counted=pickle.dumps(counted))


def _summed(grams: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, ascending, and the sums of their times."""
    order, ascending = T.order(grams, 8 * (ORDERS + 1))
    lead = _lead(ascending)
    return ascending[lead], np.add.reduceat(times[order], lead, dtype=np.uint64) if len(lead) else times.astype(np.uint64)


def _cuts(keys: np.ndarray, slices: int) -> Iterator[tuple[int, int, int]]:
    """Slices of sorted keys, each with its first key and the one after its last."""
    number, at = X.cut(keys, slices)
    return zip(number.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)


_ASKED = "block int, slice int, words binary, counted binary, phrases binary, grams binary, times binary"
_ASKED_NAMES = [c.split()[0] for c in _ASKED.split(", ")]
_ASKED_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
_GRAM_SHIFT = np.uint64(64 - 8 * (ORDERS + 1))


_SLICED = "slice int, block int, words binary, phrases binary, grams binary, counts binary, places binary, n_types long, n_once long, n_tokens array<long>"
_SLICED_NAMES = [c.split()[0] for c in _SLICED.split(", ")]
_SLICED_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.int64(), pa.list_(pa.int64())]


def _add_up(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """For each block how often its phrases are there in all blocks, and counts by group of its words, and how many words the
    slice has; the distinct grams of the slice with how often each is there, and for each block the places of its own."""
    slice_ = rows.column("slice")[0].as_py()

    def row(**values) -> pa.RecordBatch:
        values["slice"] = slice_
        return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in zip(_SLICED_NAMES, _SLICED_TYPES, strict=True)], _SLICED_NAMES)

    def sent(kind: str) -> tuple[pa.Table, list[np.ndarray]]:
        some = rows.filter(rows.column(kind).is_valid())
        return some, [X.unpack_ascending(p, np.uint64) for p in some.column(kind).to_pylist()]

    def by_block(some: pa.Table, keys: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        at = np.cumsum([0, *map(len, keys)]).tolist()
        return zip(some.column("block").to_pylist(), at[:-1], at[1:], strict=True)

    def times(some: pa.Table) -> np.ndarray:
        return np.concatenate([X.unpack(n, np.uint32) for n in some.column("times").to_pylist()])

    some, phrases = sent("phrases")
    if phrases:
        keys = np.concatenate(phrases)
        # Those of a slice share upper bits, so place and key fit in one number.
        keys = (keys - keys.min()) >> np.uint64(16)
        order, keys = T.order(keys, int(keys.max()).bit_length())
        lead = _lead(keys)
        total = np.empty(len(keys), np.uint32)
        total[order] = np.repeat(np.add.reduceat(times(some)[order], lead).astype(np.uint32), np.diff(np.append(lead, len(keys))))
        for block, a, b in by_block(some, phrases):
            yield row(block=block, phrases=X.pack(total[a:b]))
    some, grams = sent("grams")
    if grams:
        distinct, number = T.numbered(np.concatenate(grams), 8 * (ORDERS + 1))
        total = np.bincount(number, times(some), len(distinct)).astype(np.uint64)
        yield row(grams=X.pack_ascending(distinct), counts=X.pack(total))
        for block, a, b in by_block(some, grams):
            yield row(block=block, places=X.pack(number[a:b].astype(np.uint32)))
    some, words = sent("words")
    if not words:
        return
    distinct, number = T.numbered(np.concatenate(words), 64)
    cell, count = [], []
    for raw, (_, a, _) in zip(some.column("counted").to_pylist(), by_block(some, words), strict=True):
        word, group, n = pickle.loads(raw)
        cell.append(np.frombuffer(group, np.uint8).astype(np.int64) * len(distinct) + number[a + X.unpack(word, np.uint32).astype(np.int64)])
        count.append(X.unpack(n, np.uint32))
    cells, where = np.unique(np.concatenate(cell), return_inverse=True)
    total = np.bincount(where, np.concatenate(count)) if len(cells) else np.zeros(0)
    of_group, of_word = np.divmod(cells, len(distinct))
    groups = np.unique(of_group).astype(np.uint8)
    table = np.zeros((len(groups), len(distinct)), np.uint64)
    table[np.searchsorted(groups, of_group), of_word] = total.astype(np.uint64)
    every = table.sum(axis=0)
    tokens = np.zeros(GROUPS, np.int64)
    tokens[groups] = table.sum(axis=1)
    yield row(n_types=int((every > 0).sum()), n_once=int((every == 1).sum()), n_tokens=tokens.tolist())
    for block, a, b in by_block(some, words):
        mine = table[:, number[a:b]].astype(np.uint32)
        has = np.flatnonzero(mine.any(axis=1))
        yield row(block=block, words=pickle.dumps((groups[has].tobytes(), [X.pack(m) for m in mine[has]])))


def _slice_grams(grams: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _gathered(X.unpack_ascending(grams, np.uint64)), X.unpack(counts, np.uint64).astype(np.int64)


#: A slice has all grams of its longest contexts; it asks for the shorter ones.
_ASKED_ORDERS, _OWN_ORDERS = slice(ORDERS - 1), slice(ORDERS - 1, None)


def _ask_contexts(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    """From each slice of grams to each slice of contexts: those of its grams, with how often each byte came then."""
    names = ["block", "slice", "contexts", "bytes", "counts"]
    for batch in batches:
        for slice_, grams, counts in zip(*(batch.column(c).to_pylist() for c in ("slice", "grams", "counts")), strict=True):
            # All grams ask, those to learn from count.
            keys, n = _context_bytes(*_slice_grams(grams, counts), _ASKED_ORDERS)
            for s, a, b in _cuts(keys, slices):
                context, size = np.unique(keys[a:b] >> np.uint64(8), return_counts=True)
                of = pickle.dumps((X.pack_ascending(context << np.uint64(8)), X.pack(size.astype(np.uint16))))
                values = (slice_, s, of, keys[a:b].astype(np.uint8).tobytes(), X.pack(n[a:b].astype(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _ASK_TYPES, strict=True)], names)


_ASK_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _add_contexts(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """To each slice of grams all bytes, with counts, that came after its shorter contexts."""
    asked, keys, counts = [], [], []
    for of, raw, count in zip(*(rows.column(c).to_pylist() for c in ("contexts", "bytes", "counts")), strict=True):
        context, size = pickle.loads(of)
        context = X.unpack_ascending(context, np.uint64)
        asked.append(context)
        keys.append(np.repeat(context, X.unpack(size, np.uint16)) | np.frombuffer(raw, np.uint8).astype(np.uint64))
        counts.append(X.unpack(count, np.uint64))
    distinct, total = _sums(np.concatenate(keys), np.concatenate(counts))
    total = total.astype(np.uint64)
    out = []
    for context in asked:
        first, after = np.searchsorted(distinct, context), np.searchsorted(distinct, context | np.uint64(0xFF), "right")
        at = T.gather(np.arange(len(distinct)), first, after)[0]
        out.append(pickle.dumps((X.pack_ascending(distinct[at]), X.pack(total[at]))))
    yield X.answer_batch(rows, out)


def _told(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, BitCounts]:
    """The grams of a slice, how often each is there, and the counts of all their contexts: those of the longest are its own,
    the others have been sent."""
    lead = rows.filter(rows.column("grams").is_valid()).to_pylist()[0]
    gram, n = _slice_grams(lead["grams"], lead["counts"])
    told = rows.filter(rows.column("payload").is_valid()).column("payload").to_pylist()
    keys, count = _context_bytes(gram, n, _OWN_ORDERS)
    some = [(keys, count), *((X.unpack_ascending(k, np.uint64), X.unpack(c, np.uint64).astype(np.int64)) for k, c in map(pickle.loads, told))]
    keys, count = (np.concatenate(x) for x in zip(*some, strict=True))
    order = np.argsort(keys)
    return gram, n, BitCounts(keys[order], count[order])


def _train(rows: pa.Table, shared) -> Iterator[pa.RecordBatch]:
    """Weights and map after all of the training text that a slice has grams of, times what each has met, by place."""
    gram, times, counts = _told(rows)
    mixer = pickle.loads(shared)
    met = mixer.learn(counts, gram, times)
    by_gate = np.repeat(met.sum(axis=1), ORDERS)
    n = np.concatenate([by_gate, met.ravel()])
    value = n * np.concatenate([mixer.weights.ravel(), mixer.refined.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(value), pa.array(n)], ["place", "value", "n"])


@dataclass
class Model:
    mixer: Mixer
    n_tokens: np.ndarray  # per group
    n_types: int
    n_once: int

    @property
    def prior(self) -> np.ndarray:
        """Of the words of the groups, the spelling, and the document's own words."""
        new = min(max(2 * self.n_once / max(int(self.n_tokens.sum()), 1), LEAST_NEW), MOST_NEW)
        return np.array([1 - new - RECENT, new, RECENT])


def _answer(rows: pa.Table, shared) -> Iterator[pa.RecordBatch]:
    """For each block the log probability of its grams' last bytes."""
    mixer = shared.value.mixer
    gram, _, counts = _told(rows)
    slice_ = rows.column("slice")[0].as_py()
    spelling = Speller(mixer.weights, mixer.refined, counts).of_grams(gram).astype(np.float32)
    for row in rows.filter(rows.column("places").is_valid()).select(["block", "places"]).to_pylist():
        raw = spelling[X.unpack(row["places"], np.uint32)].tobytes()
        columns = [pa.array([row["block"]], pa.int32()), pa.array([slice_], pa.int32()), pa.array([raw], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "slice", "payload"])


def mix_experts(experts: np.ndarray, at: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log of the mixed probability of each token, from logs by expert (expert, token); offsets part documents, or what of
    a document goes by the same weights. The prior is one of all tokens or, as (expert, token), of each; an expert that
    has none at a token has no say there."""
    prior = prior[:, None] if prior.ndim == 1 else prior
    with np.errstate(divide="ignore"):
        top = (experts + np.log(prior)).max(axis=0)
    # As multiples of the likeliest one's part; what has no say may be past all numbers.
    says = np.minimum(experts - top, 700)
    np.exp(says, out=says)
    share = says * prior
    share /= share.sum(axis=0)
    before = np.zeros((len(experts), experts.shape[1] + 1))
    np.cumsum(share, axis=1, out=before[:, 1:])
    weight = before[:, :-1] - np.repeat(before[:, at[:-1]], np.diff(at), axis=1)
    weight += prior * PRIOR_WEIGHT
    # Shares of tokens that had the expert are none of those that lack it.
    weight *= prior > 0
    return top + np.log(np.einsum("et,et->t", says, weight) / weight.sum(axis=0))


class _InRows:
    """Places in the order of their keys, rows ascending under each key: the distinct keys, how often each is there, how
    often the key of a place is in its row, and how often before it."""

    def __init__(self, key: np.ndarray, row: np.ndarray):
        self.order, ascending = T.order(key, 64)
        new = np.ones(len(key), bool)
        new[1:] = ascending[1:] != ascending[:-1]
        self.keys, first = ascending[new], np.flatnonzero(new)
        self.size = np.diff(np.append(first, len(key)))
        self.row = row[self.order]
        new[1:] |= self.row[1:] != self.row[:-1]
        lead = np.flatnonzero(new)
        size = np.diff(np.append(lead, len(key)))
        self.times = np.repeat(size.astype(np.int32), size)
        self._lead = lead.astype(np.int32), size

    @property
    def before(self) -> np.ndarray:
        return np.arange(len(self.order), dtype=np.int32) - np.repeat(*self._lead)

    def at_places(self, values: np.ndarray) -> np.ndarray:
        """Values in the order of keys, in that of places."""
        out = np.empty(len(values), values.dtype)
        out[self.order] = values
        return out

    def of_others(self, known: np.ndarray, learned: np.ndarray) -> np.ndarray:
        """Per place, the count of its key but for what its own row has added, if that is ``learned`` from."""
        return self.at_places(np.repeat(known, self.size) - learned.take(self.row) * self.times)


def _runs(row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by row and number, and where another of either begins."""
    bits = int(number.max(initial=0)).bit_length()
    order, both = T.order(row.astype(np.int64) << bits | number, bits + int(row.max(initial=0)).bit_length())
    new = np.ones(len(order), bool)
    new[1:] = both[1:] != both[:-1]
    return order, new


def _before(values: np.ndarray) -> np.ndarray:
    """Of the place before; of the first one, its own."""
    return np.concatenate([values[:1], values[:-1]])


def foretold(t: _Tokens, learned: np.ndarray, known: np.ndarray, n_docs: int, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the contexts of one and of two words before each token, how often they were seen and how often the token came
    then, both (2, token). ``known``: counts of the tokens, ``times``: of their pairs and triples (2, token), all in
    training; ``learned`` tells which documents are among that, whose own part is taken off."""
    keys = [_InRows(key, t.row) for key in (t.key, *_phrases(t)[:2])]
    own = learned[t.row]
    return _contexts(t, own, n_docs, *(n - own * x.at_places(x.times) for n, x in zip((known, *times), keys, strict=True)))


def _contexts(t: _Tokens, own: np.ndarray, n_docs: int, word: np.ndarray, pair: np.ndarray, triple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from how often others have each token, its pair and its triple: whatever is no end of a document is a
    context as often as it is there."""
    start = t.at[:-1]
    seen, came = np.empty((2, len(word)), np.int64), np.stack([pair, triple])
    seen[0, 1:], seen[1, 1:] = word[:-1], pair[:-1]
    seen[0, start] = n_docs - own[start]
    seen[1, start] = came[1, start] = 0
    return np.maximum(seen, 0), np.maximum(came, 0)


def gates(seen: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate of each token, and what the predictors get there at first (predictor, token)."""
    step = sum((seen >= n).astype(np.int8) for n in SEEN)
    gate = np.where(step[1] > 0, len(SEEN) * (1 + step[0]) + step[1], step[0])
    two = np.where(step[1] > 0, np.array((0, *FIRST_TRUST[1]))[step[1]], 0)
    one = (1 - two) * np.array((0, *FIRST_TRUST[0]))[step[0]]
    return gate, np.concatenate([prior[:, None] * (1 - one - two), one[None], two[None]])


def score_tokens(
    t: _Tokens, word: np.ndarray, had: np.ndarray, ratio: np.ndarray, logs: np.ndarray, spelling: np.ndarray, model: Model, seen: np.ndarray, came: np.ndarray
) -> np.ndarray:
    """Log probability of each token. ``word``: its place in ``ratio`` (by active group; ``logs``: none of 0); ``had``: how
    often the document has had it; ``spelling``: of its bytes; ``seen`` and ``came``: as from ``foretold``."""
    n_group = model.n_tokens[model.n_tokens > 0].astype(np.float64)
    size = np.diff(t.at)
    past = np.zeros((len(n_group), len(word) + 1))
    np.cumsum(logs.take(word, axis=1), axis=1, out=past[:, 1:])
    past = past[:, :-1] - np.repeat(past[:, t.at[:-1]], size, axis=1)
    past += np.log(n_group / n_group.sum())[:, None]
    past -= past.max(axis=0, initial=-1e300)
    weight = np.exp(past, out=past)
    with np.errstate(divide="ignore", invalid="ignore"):
        unigram = np.log(np.einsum("gt,gt->t", weight, ratio.take(word, axis=1)) / weight.sum(axis=0)) if len(n_group) else np.full(len(word), -np.inf)
        # Earlier tokens of the document that are the same word.
        recent = np.log(had / (np.arange(len(word)) - np.repeat(t.at[:-1], size)))
        contexts = np.log(came / np.maximum(seen, 1))
    recent[t.at[:-1]] = -np.inf
    gate, prior = gates(seen, model.prior)
    # Weights follow what was explained under the same gate of the same document.
    order, new = _runs(t.row, gate)
    experts = np.stack([unigram, spelling, recent, *contexts])
    out = np.empty(len(word))
    out[order] = mix_experts(experts.take(order, axis=1), np.append(np.flatnonzero(new), len(order)), prior.take(order, axis=1))
    return out


def _spelled(tokens: list[_Tokens], told: dict[int, bytes], slices: int) -> np.ndarray:
    """Log probability of the spelling of each token of a block after the bytes before it."""
    running = list(map(_RunningGrams, tokens))
    distinct, number = T.numbered(np.concatenate([r.distinct for r in running]), 8 * (ORDERS + 1))
    spelling = np.full(len(distinct), _EVEN, np.float32)
    for s, a, b in _cuts(distinct << _GRAM_SHIFT, slices):
        if s in told:
            spelling[a:b] = np.frombuffer(told[s], np.float32)
    at = np.cumsum([0, *(len(r.distinct) for r in running)])
    return np.concatenate([r.by_token(spelling[number[a:b]]) for r, a, b in zip(running, at[:-1], at[1:], strict=True)])


def _score(docs: pa.Table, told: dict, slices: int, shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    total = float(model.n_tokens.sum())
    active = np.flatnonzero(model.n_tokens > 0)
    pieces = list(_pieces(docs))
    tokens = list(map(_Tokens, pieces))
    cuts = np.cumsum([0, *(len(t.key) for t in tokens)])
    spelling = _spelled(tokens, told.get("bytes", {}), slices)
    row = np.concatenate([t.row + r for t, r in zip(tokens, np.cumsum([0, *(p.num_rows for p in pieces)]), strict=False)]).astype(np.int32)
    learned = _group_table(docs) >= 0
    words = _InRows(np.concatenate([t.key for t in tokens]), row)
    distinct = words.keys
    slice_number, at = X.cut(distinct, slices)
    counts = np.zeros((len(active), len(distinct)))
    for s, a, b in zip(slice_number.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        groups, mine, *_ = pickle.loads(told["words"][s])
        for g, m in zip(groups, mine, strict=True):
            counts[np.searchsorted(active, g), a:b] = X.unpack(m, np.uint32)
    known = counts.sum(axis=0).astype(np.int64)
    word = words.at_places(np.repeat(np.arange(len(distinct), dtype=np.int32), words.size))
    had, other = words.at_places(words.before), words.of_others(known, learned)
    del words
    pair, triple, two = map(np.concatenate, zip(*map(_phrases, tokens), strict=True))
    pairs, triples = _InRows(pair, row), _InRows(triple[two], row[two])
    phrase, number = T.numbered(np.concatenate([pairs.keys, triples.keys]), 64)
    times = np.zeros(len(phrase), np.int64)
    for s, a, b in _cuts(phrase, slices):
        times[a:b] = X.unpack(told["phrases"][s], np.uint32)
    pair = pairs.of_others(times[number[: len(pairs.keys)]], learned)
    # What begins before its document is no triple.
    triple = np.zeros(len(two), np.int64)
    triple[two] = triples.of_others(times[number[len(pairs.keys) :]], learned)
    del pairs, triples
    # Every document ends once.
    n_docs = int(known[word[cuts[1] - 1]])
    base = np.log10((known + 0.1) / (total + 0.1 * (model.n_types + 1)))
    n_group = model.n_tokens[active].astype(np.float64)[:, None]
    counts /= n_group
    logs = np.log(np.maximum(counts, 0.1 / n_group))
    for piece, t, a, b in zip(pieces, tokens, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        mine = word[a:b]
        seen, came = _contexts(t, learned[row[a:b]], n_docs, other[a:b], pair[a:b], triple[a:b])
        score = T.group_sums(score_tokens(t, mine, had[a:b], counts, logs, spelling[a:b], model, seen, came), t.at) / np.log(10)
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id").combine_chunks(),
                pa.array(np.diff(t.at)),
                pa.array(T.group_sums(known.take(mine) > 0, t.at)),
                pa.array(np.full(piece.num_rows, int(total), np.int64)),
                pa.array(T.group_sums(base.take(mine), t.at)),
                pa.array(score),
                pa.array(-score * np.log2(10) / np.maximum(np.diff(T.utf8(piece.column("text"))[1]), 1)),
            ],
            ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
        )


def score_documents(docs: DataFrame, learn: Column, group: Column | None = None, block_bytes: int = X.BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (log10 of the smoothed unigram), score (log10 of the mixed model) and bits_per_byte of the text.

    Words and one end per document are the tokens, A-Z in lower case. ``learn`` (over doc_id) tells what to learn from;
    ``group`` hints at kinds of text among that, such as the language; it is no input when scoring. A null text is an
    empty one, with only its end. Repeated rows count as often as they are there; without anything to learn from, the
    spelling alone predicts. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = X.number_of_blocks(docs, block_bytes)
    part = F.pmod(F.xxhash64(group if group is not None else F.lit(0)), F.lit(GROUPS)).cast("int")
    asking = docs.withColumn("part", F.when(learn, part))
    asking = X.stored_blocks(asking.select("doc_id", "text", "part"), n, block_bytes)
    asked = X.in_stored_blocks(asking, partial(_ask_words, slices=n), _ASKED)
    sliced = store(X.in_slices(asked, n, _add_up, _SLICED), "vocabulary")

    def answers_of(kind: str) -> DataFrame:
        return sliced.where(F.col(kind).isNotNull() & F.col("block").isNotNull()).select("block", "slice", F.col(kind).alias("payload"))

    sums = sliced.where("n_types is not null").agg(F.sum("n_types"), F.sum("n_once"), *[F.sum(F.col("n_tokens")[g]) for g in range(GROUPS)]).first()
    n_types, n_once, *n_tokens = (x or 0 for x in sums)
    lists = sliced.where("grams is not null").select("slice", "grams", "counts")
    places = sliced.where("places is not null").select("slice", "block", "places")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 8)
    schema = "block int, slice int, contexts binary, bytes binary, counts binary"
    contexts = X.in_slices(lists.coalesce(tasks).mapInArrow(partial(_ask_contexts, slices=n), schema), n, _add_contexts)
    contexts = contexts.select(F.col("block").alias("slice"), "payload")

    told = lists.unionByName(places, allowMissingColumns=True).unionByName(contexts, allowMissingColumns=True)
    told = X.stored_slices(told, n)
    mixer = Mixer.new()
    for _ in range(ROUNDS):
        # Every slice learns from all its training text; averages by what each has met go into the next round.
        work = partial(_train, shared=pickle.dumps(mixer))
        trained = X.in_stored_slices(told.where("places is null").drop("block", "places"), work, "place int, value double, n double")
        mean = {r.place: r.value / r.n for r in trained.groupBy("place").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).where("n > 0").collect()}
        flat = np.concatenate([mixer.weights.ravel(), mixer.refined.ravel()])
        flat[list(mean)] = list(mean.values())
        mixer = Mixer(flat[: mixer.weights.size].reshape(mixer.weights.shape), flat[mixer.weights.size :].reshape(mixer.refined.shape))
    model = Model(mixer, np.array(n_tokens, np.int64), n_types, n_once)
    shared = spark.sparkContext.broadcast(model)

    answers = store(X.in_stored_slices(told, partial(_answer, shared=shared), X.ANSWER), "bytes")
    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    work = partial(_score, slices=n, shared=shared)
    return X.in_stored_blocks(asking, work, schema, words=answers_of("words"), phrases=answers_of("phrases"), bytes=answers)
