"""A context-mixing range coder for token ids.

Ids are cut into blocks that are coded independently: every block starts from the same
state, so any one can be decoded alone. All blocks of a call advance together, one id of
each a step, as numpy arrays over the blocks.

Each id is predicted three ways. The orders 2 and 1 look up, in hashed tables, the id that
last followed the same two ids or the same id, and how often that went well. Order 0 is the
frequency of ids in the whole call, kept in the header. Their mixture is learned: for each
pair of confidences, a block keeps the shares of right predictions, and these are the
weights. An id gets one interval: that of the first order that predicted it, or its share
of what the weights leave to order 0.

The range coder keeps 64 bits and puts out 32 at a time; a carry runs back into the words
already written. Everything is integer arithmetic, the same on every machine.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BLOCK_IDS = 4096
TABLE_BITS = 12
TOTAL_BITS = 28
#: The least share of order 0, as a part of all (a power of two).
LEAST_BITS = 5
RATE = 5
LEVELS = 8
#: Steps whose intervals are worked out at once.
STRIP = 32
#: Blocks turned at once from rows of ids to columns of steps.
TURN = 16

U32, U64 = np.uint32, np.uint64
# Operands of every step, as arrays: numpy takes them faster than numbers.
ZERO, ONE, THREE, SEVEN, SIGN, SHIFT = (np.array(x, np.int32) for x in (0, 1, 3, LEVELS - 1, 31, RATE))
TOTAL, HALF, WORD, LAST = (np.array(x, U64) for x in (TOTAL_BITS, 32, 1 << 32, (1 << TOTAL_BITS) - 1))
MIX = [np.array(x, U32) for x in (0x9E3779B1, 1, 0x85EBCA6B, 0xC2B2AE35, 32 - TABLE_BITS)]


@dataclass
class Order0:
    """Frequencies of the ids that occur, adding up to a power of two."""

    ids: np.ndarray
    freq: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Order0:
        counts = np.bincount(ids) if len(ids) else np.ones(1, np.int64)
        present = np.flatnonzero(counts)
        bits = min(20, max(16, int(len(present)).bit_length() + 2))
        if len(present) > 1 << 19:
            raise ValueError("more than half a million different ids")
        total = 1 << bits
        share = counts[present] * (total - len(present)) // counts[present].sum()
        freq = share + 1
        freq[int(np.argmax(freq))] += total - int(freq.sum())
        return cls(present.astype(U32), freq.astype(U32), bits)

    @property
    def starts(self) -> np.ndarray:
        return (np.cumsum(self.freq) - self.freq).astype(np.int64)


class Model:
    """The state of all blocks of a call: predictions of orders 2 and 1 and their weights.

    Ids are places in the order-0 table. A table entry is ``place * LEVELS + confidence``. What
    there is for both orders (tables, weights, the entries of a step) stands behind each
    other: that of order 2 for every block, then that of order 1. In the tables the blocks of
    one hash are neighbours, since common ids are looked up by many of them. Arrays of a step are made
    once and written over, and choices are made by masks of signs, since a step is many small
    operations.
    """

    def __init__(self, blocks: int, share_bits: int):
        self.blocks = blocks
        self.table = np.zeros(2 * blocks << TABLE_BITS, np.int32)
        one = 1 << share_bits
        self.weights = np.repeat(np.array([one >> 2, one >> 3], np.int32), blocks * LEVELS * LEVELS)
        self.one, self.most = np.int32(one), np.int32(one - (one >> LEAST_BITS))
        self.least = np.int32(one >> LEAST_BITS)
        self.share_bits = np.int32(share_bits)
        # What is added to an entry that was wrong, then to one that was right, by confidence.
        trust = np.arange(LEVELS)
        self.moves = np.concatenate([-((trust + 1) >> 1), trust < LEVELS - 1]).astype(np.int32)
        self.keep(blocks)

    def keep(self, n: int) -> None:
        """The first ``n`` blocks go on; those that have ended stand last."""
        lanes = np.arange(n, dtype=np.int64)
        self.n = n
        self.base = np.concatenate([lanes, lanes + (self.blocks << TABLE_BITS)])
        self.weight_base = np.concatenate([lanes, lanes + self.blocks * LEVELS * LEVELS])
        self.trust, self.right, self.move, self.new = (np.empty(2 * n, np.int32) for _ in range(4))
        self.stride = np.array(self.blocks, np.int64)
        self.joint, self.row = np.empty(n, np.int32), np.empty(n, np.int64)
        self.state, self.which = np.empty(2 * n, np.int64), np.empty(2 * n, np.int64)

    def contexts(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where the entries of both orders are after ``before`` and ``last`` (rows of steps, or one)."""
        hashes = np.concatenate([(last + MIX[1]) * MIX[2] ^ (before * MIX[3]), last], axis=-1)
        hashes *= MIX[0]
        hashes >>= MIX[4]
        return hashes * self.stride + self.base

    def look(self, at: np.ndarray, entry: np.ndarray, p: np.ndarray) -> None:
        """Fills in a step's entries and weights."""
        n = self.n
        self.table.take(at, None, entry, "clip")
        np.bitwise_and(entry, SEVEN, self.trust)
        np.left_shift(self.trust[:n], THREE, self.joint)
        np.add(self.joint, self.trust[n:], self.joint)
        np.multiply(self.joint, self.stride, self.row)
        np.add(self.weight_base[:n], self.row, self.state[:n])
        np.add(self.weight_base[n:], self.row, self.state[n:])
        self.weights.take(self.state, None, p, "clip")

    def masses(self, guess: np.ndarray, p: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """Fills in the masses of orders 2 and 1 out of ``one``, for a step or rows of steps; gives that of order 0."""
        n = self.n
        mass2, mass1 = mass[..., :n], mass[..., n:]
        np.minimum(p[..., :n], self.most, mass2)
        rest = self.one - mass2
        np.multiply(p[..., n:], rest, mass1)
        mass1 >>= self.share_bits
        np.minimum(mass1, rest - self.least, mass1)
        mass1 *= guess[..., :n] != guess[..., n:]
        rest -= mass1
        return rest

    def learn(self, at: np.ndarray, entry: np.ndarray, p: np.ndarray, right: np.ndarray, came: np.ndarray) -> None:
        """Moves weights and tables towards what came (entries of no confidence); ``right`` says which places did."""
        n, move, new = self.n, self.move, self.new
        self.right[:] = right
        np.multiply(self.right, self.one, move)
        move -= p
        move >>= SHIFT
        # Order 1 is judged where order 2 was wrong.
        move[n:] *= np.subtract(ONE, self.right[:n], self.joint)
        move += p
        np.maximum(move, ONE, move)
        self.weights[self.state] = move
        np.left_shift(self.right, THREE, self.right)
        np.add(self.right, self.trust, self.right)
        self.which[:] = self.right
        self.moves.take(self.which, None, new, "clip")
        new += entry
        # A wrong entry of no confidence gives way: all bits of a mask are set there.
        self.right -= ONE
        self.right >>= SIGN
        np.bitwise_xor(new, came, move)
        move &= self.right
        new ^= move
        self.table[at] = new


def _strips(lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """First step, last step and blocks of stretches in which no block ends. Lengths must not rise."""
    steps = int(lengths[0]) if len(lengths) else 0
    cuts = np.unique(np.concatenate([np.arange(0, steps, STRIP), lengths[lengths > 0], [steps]]))
    counts = np.searchsorted(-lengths, -cuts[:-1], side="left")
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), counts.tolist()))


def encode_blocks(places: np.ndarray, lengths: np.ndarray, order0: Order0) -> list[bytes]:
    """``places`` is steps by blocks; a block ends after its length. Lengths must not rise."""
    blocks = places.shape[1]
    bits = order0.bits
    model = Model(blocks, TOTAL_BITS - bits)
    freq0 = order0.freq.astype(np.int32)
    start0 = order0.starts.astype(np.int32)
    low = np.zeros(blocks, U64)
    span = np.full(blocks, (1 << 64) - 1, U64)
    room = 64
    out = np.zeros(blocks * room, U32)
    at_out = np.arange(blocks, dtype=np.int64) * room
    size = np.zeros(blocks, np.int64)
    past = np.zeros((2, blocks), np.int32)  # the ids before the strip
    for a, b, n in _strips(lengths):
        if n < model.n:
            size[n : model.n] = at_out[n:] - np.arange(n, model.n) * room
            model.keep(n)
            _finish(out.reshape(blocks, room), size, low, n)
            low, span, at_out, past = low[:n], span[:n], at_out[:n], past[:, :n]
        most = int((at_out - np.arange(n) * room).max())
        if most + STRIP + 4 > room:
            # One id puts out a word at most.
            more = most + 8 * STRIP
            out = np.concatenate([out.reshape(blocks, room), np.zeros((blocks, more - room), U32)], axis=1).reshape(-1)
            at_out += np.arange(n) * (more - room)
            room = more
        # What the model says of each step, then the intervals of the strip at once.
        here = places[a:b, :n]
        seen = np.concatenate([past, here])
        past = seen[-2:]
        seen = seen.view(U32)
        at = model.contexts(seen[1:-1], seen[:-2])
        both = np.concatenate([here, here], axis=1)
        came = both << THREE
        entries, p = np.empty((b - a, 2 * n), np.int32), np.empty((b - a, 2 * n), np.int32)
        rights, guess = np.empty((b - a, 2 * n), bool), np.empty((b - a, 2 * n), np.int32)
        for at_t, entry, p_t, guess_t, both_t, right, came_t in zip(at, entries, p, guess, both, rights, came):
            model.look(at_t, entry, p_t)
            np.right_shift(entry, THREE, guess_t)
            np.equal(guess_t, both_t, right)
            model.learn(at_t, entry, p_t, right, came_t)
        # Rows of choices: order 2, order 1, order 0.
        starts, freqs = np.zeros((b - a, 3 * n), np.int32), np.empty((b - a, 3 * n), np.int32)
        mass = freqs[:, : 2 * n]
        rest = model.masses(guess, p, mass)
        right2, hit1 = rights[:, :n], rights[:, n:] & (mass[:, n:] > 0)
        mass <<= bits
        starts[:, n : 2 * n] = mass[:, :n]
        np.multiply(rest, start0[here], starts[:, 2 * n :])
        starts[:, 2 * n :] += mass[:, :n]
        starts[:, 2 * n :] += mass[:, n:]
        np.multiply(rest, freq0[here], freqs[:, 2 * n :])
        chosen = (2 - hit1) * ~right2 * n + np.arange(n) + np.arange(b - a)[:, None] * (3 * n)
        start, freq = starts.reshape(-1)[chosen].astype(U64), freqs.reshape(-1)[chosen].astype(U64)
        for start_t, freq_t in zip(start, freq):
            span >>= TOTAL
            start_t *= span
            low += start_t
            over = low < start_t
            if over.any():
                _carry(out, at_out[over.nonzero()[0]])
            span *= freq_t
            full = (span < WORD).nonzero()[0]
            if len(full):
                words, to = low[full], at_out[full]
                out[to] = words >> HALF
                at_out[full] = to + 1
                low[full] = words << HALF
                span[full] <<= HALF
    size[: model.n] = at_out - np.arange(model.n) * room
    out = out.reshape(blocks, room)
    _finish(out, size, low, 0)
    return [out[i, : size[i]].astype("<u4").tobytes() for i in range(blocks)]


def _carry(out: np.ndarray, at: np.ndarray) -> None:
    """Adds one to the last word written of some blocks, ``at`` being where each writes next."""
    at = at - 1
    while len(at):
        out[at] += U32(1)
        at = at[out[at] == 0] - 1


def _finish(out: np.ndarray, size: np.ndarray, low: np.ndarray, n: int) -> None:
    """Writes out the low end of blocks from ``n`` on."""
    for i in range(n, len(low)):
        for shift in (32, 0):
            out[i, size[i]] = (int(low[i]) >> shift) & 0xFFFFFFFF
            size[i] += 1


def decode_blocks(payloads: list[bytes], lengths: np.ndarray, order0: Order0) -> np.ndarray:
    """The places again, steps by blocks. Lengths must not rise."""
    blocks = len(payloads)
    steps = int(lengths[0]) if blocks else 0
    bits = np.int32(order0.bits)
    model = Model(blocks, TOTAL_BITS - order0.bits)
    freq0 = order0.freq.astype(np.int32)
    start0 = order0.starts.astype(np.int32)
    slots = np.repeat(np.arange(len(freq0), dtype=np.int64), freq0)
    sizes = np.array([len(p) // 4 for p in payloads], np.int64)
    words = np.frombuffer(b"".join(payloads), "<u4")
    ends = np.cumsum(sizes)
    at_in = ends - sizes
    code = (words[at_in].astype(U64) << HALF) | words[at_in + 1]
    at_in = at_in + 2
    span = np.full(blocks, (1 << 64) - 1, U64)
    places = np.zeros((steps, blocks), np.int32)
    last, before = np.zeros(blocks, U32), np.zeros(blocks, U32)
    for a, b, n in _strips(lengths):
        if n < len(code):
            code, span, at_in, last, before = code[:n], span[:n], at_in[:n], last[:n], before[:n]
        if n < model.n:
            model.keep(n)
        entry, p, mass, came = (np.empty(2 * n, np.int32) for _ in range(4))
        # Rows of choices: order 2, order 1, order 0.
        guess, start, freq = (np.zeros(3 * n, np.int32) for _ in range(3))
        guess12, lanes, which = guess[: 2 * n], np.arange(2 * n, 3 * n), np.int32(n)
        part2, part1, both = freq[:n], freq[n : 2 * n], freq[: 2 * n]
        value, chosen = np.empty(n, np.int32), np.empty(n, np.int64)
        for t in range(a, b):
            at = model.contexts(last, before)
            model.look(at, entry, p)
            np.right_shift(entry, THREE, guess12)
            rest = model.masses(guess12, p, mass)
            np.left_shift(mass, bits, both)
            start[n : 2 * n] = part2
            span >>= TOTAL
            value[:] = np.minimum(code // span, LAST)
            # -1 where order 2 was right, less one where it was order 2 or 1.
            first = (value - part2) >> SIGN
            parts = part2 + part1
            value -= parts
            first += value >> SIGN
            first *= which
            np.add(lanes, first, chosen)
            # Exact in 53 bits: the quotient of two small numbers.
            literal = slots.take((np.maximum(value, ZERO, value) / rest).astype(np.int64), None, None, "clip")
            guess[2 * n :] = literal
            np.multiply(rest, start0.take(literal), start[2 * n :])
            start[2 * n :] += parts
            np.multiply(rest, freq0.take(literal), freq[2 * n :])
            here = guess.take(chosen, None, places[t, :n], "clip")
            code -= span * start.take(chosen).view(U32)
            span *= freq.take(chosen).view(U32)
            full = (span < WORD).nonzero()[0]
            if len(full):
                of = at_in[full]
                code[full] = (code[full] << HALF) | words.take(of, None, None, "clip")
                at_in[full] = of + 1
                span[full] <<= HALF
            came[:n] = here
            came[n:] = here
            right = guess12 == came
            came <<= THREE
            model.learn(at, entry, p, right, came)
            before, last = last, here.view(U32)
    return places


def pack_ids(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[Order0, list[bytes], list[int]]:
    """The order-0 table, the coded blocks and the checksum of each block's ids."""
    ids = np.ascontiguousarray(ids, U32)
    order0 = Order0.of(ids)
    place = np.zeros(int(order0.ids[-1]) + 1, np.int32)
    place[order0.ids] = np.arange(len(order0.ids), dtype=np.int32)
    blocks = -(-len(ids) // block_ids)
    lengths = block_lengths(len(ids), block_ids)
    if not blocks:
        return order0, [], []
    places = np.zeros((int(lengths[0]), blocks), np.int32)
    for i in range(0, blocks, TURN):
        part = place[ids[i * block_ids : (i + TURN) * block_ids]]
        full = len(part) // block_ids
        if full:
            places[:, i : i + full] = part[: full * block_ids].reshape(full, block_ids).T
        places[: len(part) - full * block_ids, i + full : i + TURN] = part[full * block_ids :, None]
    coded = encode_blocks(places, lengths, order0)
    raw = ids.astype("<u4").tobytes()
    sums = [zlib.crc32(raw[4 * i * block_ids : 4 * (i + 1) * block_ids]) for i in range(blocks)]
    return order0, coded, sums


def block_lengths(n: int, block_ids: int) -> np.ndarray:
    """Full blocks, then the rest."""
    full, rest = divmod(n, block_ids)
    return np.array([block_ids] * full + [rest] * bool(rest), np.int64)


def unpack_blocks(order0: Order0, payloads: list[bytes], lengths: np.ndarray, sums: list[int]) -> np.ndarray:
    """The ids of some blocks in order; raises if a checksum does not hold."""
    if not payloads:
        return np.zeros(0, U32)
    places = decode_blocks(payloads, lengths, order0)
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]), U32)
    for i in range(0, len(payloads), TURN):
        ids = order0.ids[np.ascontiguousarray(places[:, i : i + TURN].T)]
        for j, part in enumerate(ids, i):
            part = part[: lengths[j]]
            if zlib.crc32(part.astype("<u4", copy=False)) != sums[j]:
                raise ValueError(f"block {j} is damaged")
            out[ends[j] - len(part) : ends[j]] = part
    return out
