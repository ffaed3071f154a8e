"""Texts scored by logistic mixing of hashed-context bit predictors.

A text is its words in lower case (A-Z) and one end mark. A word is coded byte by byte and bit by
bit, closed by a space; the end mark is one byte of its own. The bits of a byte are the steps down a
fixed tree, in which the bytes of common letters lie higher. Each of several predictors looks up the
counts of the next bit after its context, hashed to a slot of a table of fixed size. Contexts are the last
1, 2, 3 or 4 bytes of the running text, back to the start of the word before; the last 6; and the whole
word so far. The text starts as if after a space. A mixer adds the log odds of the predictors, weighted by a set that a gate picks
(step down the tree, and how far into the word), and learns online: after every STEP_WORDS stretches of
text the weights move along the coding error. Stretches are dealt
by hash to a fixed number of learners, each reads its own in the order of bytes, and their weights are
averaged, so neither the files nor the cluster change a score. An adaptive map then refines each probability from what came true at that gate and level. Last, while a text
is read, an online gate mixes this spelling model, the plain word frequencies, and the word
frequencies of each language, and follows those that coded the last tokens better. The language
of a text to be scored is not looked at; only the counts of training texts are kept by language.

The first three bytes of a word, its head, are coded after the last three of the word before it; together
they are a joint. Behind the head, a context of 4 bytes begins at the space before the word at the earliest, so what
is left depends on the word alone (there the context of 6 bytes is cut at that space). So
counts over the joints and the words of all training texts are those of reading the texts byte by byte, and it is
enough to count, learn and spell every distinct joint and word once, with its frequency. The texts
are cut into blocks that carry their own dictionary, and each is scored in its order, joint by joint. What is
gathered is the vocabulary and the joints, which
grow with the corpus; the tables of slots and weights have a fixed size and are broadcast.

Null or empty texts hold the end mark only. Texts of any length are scored whole, and extra columns
are not read. An empty table gives an empty one. Rows that agree in everything are scored each. A null
id counts as an empty text for the split and belongs to the held-out part. Without any training
row every word is unknown, and the score rests on the untrained model.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.workers import importable
from tidewheel.session import discard, free_shuffles, written

# Parameters of the model.
SLOT_BITS = 20  # slots of each predictor's table, as a power of two
ORDERS = 4  # contexts of the last 1 to ORDERS bytes of the text; one more is the whole word so far
FAR = 6  # bytes of the longest context, cut at the start of the word once a head is past
GATES = 8 * 4  # steps down the tree of bytes, and whether 0, 1, 2 or more bytes of the word are known
LEVELS = 33  # levels of the refining map, over log odds from -8 to 8
ROUNDS = 1  # times that the mixer reads the vocabulary
LEARNERS = 64  # parts of the vocabulary that are learned apart
STEP_WORDS = 8_192  # words of a step
RATE = 0.4  # step of the mixer
LANGUAGES = 6  # sets of word frequencies: the most frequent languages, and one for the others
MEMORY = 64  # tokens that the gate between the models looks back
FLOOR = 0.02  # share of the gate that is spread over all models
SMOOTH = 0.1  # added to the count of every word

FEW = 4_096  # stretches that are spelled at a time, so that their arrays stay in the cache

# Bounds of a block, whichever is met first.
BLOCK_WORDS = 250_000
BLOCK_TOKENS = 3_000_000

HEAD = ORDERS - 1  # bytes of a word from which a context of ORDERS reaches the word before
PREDICTORS = ORDERS + 2
SPACE, END = 0x20, 0x0A
END_TOKEN = bytes([END])
# Odd multipliers of the hashes: fixed values.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)

NODES = np.arange(1, 257, dtype=np.uint64) * MULTIPLIERS[2]
# How frequent bytes are in texts, about, per thousand; only how deep a byte lies in the tree depends on it.
FREQUENT = dict(zip(b" etaoinsrhdlucmfwgpybv,.k", (180, 102, 75, 65, 62, 57, 57, 53, 50, 50, 33, 33, 23, 22, 20, 18, 17, 16, 15, 14, 12, 8, 8, 8, 6), strict=True))


def _tree() -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """A prefix code of all bytes: for each depth, the node that each byte passes and its bit there; the depths."""
    heap = [(FREQUENT.get(byte, 0.05), byte, (byte,)) for byte in range(256)]
    heapify(heap)
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    for node in range(255):
        joined = [heappop(heap), heappop(heap)]
        for bit, (_, _, members) in enumerate(joined):
            for byte in members:
                paths[byte].insert(0, (node, bit))
        heappush(heap, (joined[0][0] + joined[1][0], 256 + node, joined[0][2] + joined[1][2]))
    depths = np.array([len(path) for path in paths])
    full = [path + [(0, 0)] * (depths.max() - len(path)) for path in paths]
    steps = np.array(full).transpose(2, 1, 0)
    return list(steps[0]), list(steps[1]), depths


PATHS, BITS, DEPTHS = _tree()
DEPTH = int(DEPTHS.max())
PLACES = (DEPTH - DEPTHS).astype(np.uint8)  # order of bytes by falling depth
BEFORE = np.array([(1 << 8 * k) - 1 for k in range(FAR + 1)], np.uint64)  # the lowest k bytes

# Words are joined by spaces, which they never hold; counts are by word and language. Binary columns are compressed.
BLOCK = """block long, words binary, bytes long, counts binary, ids binary, lengths array<int>,
    doc_ids array<long>, held_out array<boolean>"""


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole texts, each block with the dictionary its ids refer to."""
    task, made = TaskContext.get().partitionId(), 0

    def fresh():
        numbers = defaultdict()
        numbers.default_factory = numbers.__len__
        return numbers, [], [], [], []

    def block():
        counts = np.zeros((LANGUAGES, len(numbers)), np.int64)
        for language in range(LANGUAGES):
            told = zip(texts, helds, languages, strict=True)
            learned = [ids for ids, held, own in told if own == language and not held]
            if learned:
                counts[language] = np.bincount(np.concatenate(learned), minlength=len(numbers))
        words = b" ".join(numbers)
        # Equal places of all numbers side by side take less room.
        ids = np.ascontiguousarray(np.concatenate(texts).astype("<i4").view(np.uint8).reshape(-1, 4).T)
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([(task << 32) + made], pa.int64()),
                "words": pa.array([_packed(words)], pa.binary()),
                "bytes": pa.array([len(words)], pa.int64()),
                "counts": pa.array([_packed(counts.astype("<i8").tobytes())], pa.binary()),
                "ids": pa.array([_packed(ids.tobytes())], pa.binary()),
                "lengths": pa.array([[len(ids) for ids in texts]], pa.list_(pa.int32())),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "held_out": pa.array([helds], pa.list_(pa.bool_())),
            }
        )

    numbers, texts, helds, doc_ids, languages = fresh()
    tokens = 0
    for batch in batches:
        columns = (batch.column(n) for n in ("doc_id", "held_out", "language", "text"))
        for doc_id, held, language, text in zip(*columns, strict=True):
            words = (text.as_py() or b"").lower().split()
            texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            helds.append(held.as_py())
            doc_ids.append(doc_id.as_py())
            languages.append(language.as_py())
            tokens += len(words) + 1
            if tokens >= BLOCK_TOKENS or len(numbers) >= BLOCK_WORDS:
                yield block()
                numbers, texts, helds, doc_ids, languages = fresh()
                tokens, made = 0, made + 1
    if texts:
        yield block()


@dataclass
class Spelling:
    """Bytes to be coded, the stretch of text each belongs to, and what its contexts are."""

    codes: np.ndarray
    stretch: np.ndarray
    gate: np.ndarray
    contexts: list[np.ndarray]


def head(word: bytes) -> bytes:
    """The bytes of a word whose contexts reach into the word before it."""
    return word if word == END_TOKEN else (word + b" ")[:HEAD]


def joint(before: bytes, word: bytes) -> bytes:
    """The border of two words in a text; nothing stands before the first one."""
    return before[-HEAD:] + b" " + head(word)


def spell(stretches: list[bytes] | pa.Array) -> Spelling:
    """Joints, whose heads are coded, and words, whose bytes after the head are.

    Together they code a text: no context of ORDERS bytes reaches from behind the head into the word before.
    """
    told = _strings(stretches)
    at_space = pc.find_substring(told, " ")
    is_joint = pc.greater_equal(at_space, 0)
    closed = pc.binary_join_element_wise(b"", told, pc.if_else(pc.equal(told, END_TOKEN), b"", b" "), b" ")
    spaced = pc.if_else(is_joint, told, pc.binary_slice(closed, 0, -1))
    ends, codes = _flat(spaced)
    border = at_space.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    is_joint = border > 0
    border[~is_joint] = 1
    lengths, starts = np.diff(ends), ends[:-1]
    # Of the bytes before the first one that is coded, only those in its contexts are read.
    first = starts + border + np.where(is_joint, 0, HEAD)
    n = np.maximum(starts + lengths - first, 0)
    stretch = np.repeat(np.arange(len(n)), n)
    index = np.arange(len(stretch)) + (first - np.cumsum(n) + n)[stretch]
    at = index - starts[stretch]
    place = at - border[stretch]
    # The bytes before each one, the nearest in the lowest bits.
    padded = np.concatenate([np.zeros(8, np.uint8), codes])
    history = np.ndarray((len(codes),), ">u8", padded, strides=(1,))[index].astype(np.uint64) & BEFORE[np.minimum(at, FAR)]
    # The bytes of the word so far, as a sum that does not depend on what stands before.
    powers = np.cumprod(np.full(int(lengths.max(initial=1)), MULTIPLIERS[2], np.uint64))
    inside = np.arange(len(codes)) - np.repeat(starts + border, lengths)
    before = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[np.maximum(inside, 0)], out=before[1:])
    so_far = before[index] - before[starts + border][stretch]
    multiplier = MULTIPLIERS[1]
    contexts = [((history & BEFORE[k]) + np.uint64(k << 56)) * multiplier for k in (*range(1, ORDERS + 1), FAR)]
    contexts.append((so_far + np.uint64(PREDICTORS)) * multiplier)
    return Spelling(codes[index], stretch, np.minimum(place, 3), contexts)


def _strings(some: list[bytes] | pa.Array) -> pa.Array:
    return some if isinstance(some, pa.Array) else pa.array(some, pa.binary())


def _heads(words: pa.Array) -> pa.Array:
    """``head`` of each word."""
    begun = pc.binary_slice(words, 0, HEAD)
    closed = pc.binary_slice(pc.binary_join_element_wise(begun, b"", b" "), 0, HEAD)
    return pc.if_else(pc.equal(begun, END_TOKEN), END_TOKEN, closed)


def _flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each string begins in the bytes of all, and the end; and these bytes."""
    _, offsets, data = strings.buffers()
    kind = np.int64 if pa.types.is_large_binary(strings.type) else np.int32
    ends = np.frombuffer(offsets, kind)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    codes = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    return ends - ends[0], codes


def bits(spelling: Spelling) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each step down the tree of bytes: stretch, bit, gate, and the slot in each predictor's table."""
    # The bytes that lie deepest first, so that those which go on are the first ones at every step.
    order = np.argsort(PLACES[spelling.codes], kind="stable")
    codes, stretch, gate = (own[order] for own in (spelling.codes, spelling.stretch, spelling.gate))
    contexts = [context[order] for context in spelling.contexts]
    shift = np.uint64(64 - SLOT_BITS)
    deeper = len(codes) - np.cumsum(np.bincount(DEPTHS[codes], minlength=DEPTH + 1))
    for t in range(DEPTH):
        n = int(deeper[t])
        if not n:
            return
        own = codes[:n]
        node = NODES[PATHS[t]][own]
        slots = []
        for context in contexts:
            slot = context[:n] ^ node
            slot *= MULTIPLIERS[0]
            slot >>= shift
            slots.append(slot.view(np.int64))
        yield stretch[:n], BITS[t][own], gate[:n] + min(t, 7) * 4, slots


class Running:
    """The texts of a block, as the joints that their words form in their order."""

    def __init__(self, words: list[bytes] | pa.Array, ids: bytes | np.ndarray, lengths: list[int]):
        sizes = np.asarray(lengths, np.int64) + 1
        ends = np.cumsum(sizes) - 1
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        # The end mark has the number after the last word.
        self.words = np.full(int(sizes.sum()), len(words), np.int32)
        inside = np.ones(len(self.words), bool)
        inside[ends] = False
        self.words[inside] = ids if isinstance(ids, np.ndarray) else _unpacked(ids, 4 * int((sizes - 1).sum()), "<i4")
        told = _strings(words)
        heads = pa.concat_arrays([_heads(told), pa.array([END_TOKEN], told.type)]).dictionary_encode()
        tails = pa.concat_arrays([pc.binary_slice(told, -HEAD, None), pa.array([b""], told.type)]).dictionary_encode()
        before = np.roll(self.words, 1)
        before[ends - sizes + 1] = len(words)
        self.heads, self.tails = heads.dictionary, tails.dictionary
        head_of, tail_of = (own.indices.to_numpy().astype(np.int64) for own in (heads, tails))
        self.keys = tail_of[before] * len(self.heads) + head_of[self.words]

    def stretches(self, keys: np.ndarray) -> pa.Array:
        tails, heads = np.divmod(keys, len(self.heads))
        return pc.binary_join_element_wise(self.tails.take(pa.array(tails)), self.heads.take(pa.array(heads)), b" ")

    def joints(self, keys: np.ndarray) -> list[bytes]:
        return self.stretches(keys).to_pylist()


def _split(batch: pa.RecordBatch, number: int) -> pa.Array:
    """The words of a block."""
    packed, size = (batch.column(name)[number].as_py() for name in ("words", "bytes"))
    return pa.array(pa.decompress(packed, size, codec="zstd", asbytes=True).split(), pa.binary())


def _numbers(packed: bytes, lengths: list[int] | np.ndarray) -> np.ndarray:
    """The numbers of the words of a block's texts."""
    planes = _unpacked(packed, 4 * int(np.sum(lengths, dtype=np.int64)), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def _placed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of each block, and its place there."""
    for batch in batches:
        for number in range(batch.num_rows):
            words = _split(batch, number)
            of = np.full(len(words), batch.column("block")[number].as_py())
            yield pa.RecordBatch.from_pydict({"of": of, "place": np.arange(len(words), dtype=np.int32), "word": words})


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of each block, and how often it is in the training texts there by language."""
    for batch in batches:
        for number in range(batch.num_rows):
            words = _split(batch, number)
            counts = _unpacked(batch.column("counts")[number].as_py(), 8 * LANGUAGES * len(words), "<i8").reshape(LANGUAGES, -1)
            yield pa.RecordBatch.from_pydict({"word": words} | {f"n{n}": counts[n] for n in range(LANGUAGES)})


def _count_joints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each joint is in the training texts of a block."""
    for batch in batches:
        for number in range(batch.num_rows):
            lengths = batch.column("lengths")[number].values.to_numpy()
            running = Running(_split(batch, number), _numbers(batch.column("ids")[number].as_py(), lengths), lengths)
            learned = ~batch.column("held_out")[number].values.to_numpy(zero_copy_only=False)[running.text]
            keys, n = pa.array(running.keys[learned]).value_counts().flatten()
            # In their order they take less room.
            order = pc.array_sort_indices(keys)
            yield pa.RecordBatch.from_pydict({"word": running.stretches(keys.take(order).to_numpy()), "n": n.take(order)})


def batches_of(batches: Iterator[pa.RecordBatch], size: int = FEW) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words and their training counts, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield part.column("word"), part.column("c").to_numpy(zero_copy_only=False).astype(np.float64)


CHUNK = 1 << 16


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each bit followed, by slot; sums of this task, in chunks."""
    counts = np.zeros((PREDICTORS, 2 << SLOT_BITS))  # whole numbers, exact as such up to 2 ** 53
    seen = False
    for words, c in batches_of(batches):
        seen = True
        for stretch, bit, _, slots in bits(spell(words)):
            weights = c[stretch]
            for k, slot in enumerate(slots):
                np.add.at(counts[k], slot * 2 + bit, weights)
    if seen:
        for number, chunk in enumerate(counts.reshape(-1, CHUNK)):
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([number], pa.int32()), "counts": pa.array([_packed(chunk.tobytes())], pa.binary())}
            )


def _packed(raw: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def _unpacked(packed: bytes, size: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), kind)


def _add_chunks(table: pa.Table) -> pa.Table:
    total = sum(_unpacked(packed.as_py(), CHUNK * 8, np.float64) for packed in table.column("counts"))
    pairs = total.reshape(-1, 2)
    odds = np.log((pairs[:, 1] + 0.2) / (pairs[:, 0] + 0.2))
    return pa.table(
        {
            "chunk": table.column("chunk").slice(0, 1),
            "odds": pa.array([np.clip(np.rint(odds * 10), -127, 127).astype(np.int8).tobytes()], pa.binary()),
        }
    )


def squash(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


# Log odds by the unsigned byte that holds a signed one of tenths.
TENTHS = np.roll(np.arange(-128, 128, dtype=np.float32) / 10, -128)


class Mixer:
    """The tables of log odds (in tenths), the weights by gate, and the refining map."""

    def __init__(self, odds: np.ndarray, weights: np.ndarray, refined: np.ndarray):
        self.odds, self.weights, self.refined = odds, weights, refined

    def inputs(self, slots: list[np.ndarray]) -> list[np.ndarray]:
        return [TENTHS.take(self.odds[k].view(np.uint8).take(slot)) for k, slot in enumerate(slots)]

    def weighted(self) -> np.ndarray:
        """What each predictor adds to the sum, by gate and log odds in tenths as an unsigned byte."""
        return self.weights.T.astype(np.float32)[:, :, None] * TENTHS

    def summed(self, gate: np.ndarray, slots: list[np.ndarray], weighted: np.ndarray) -> np.ndarray:
        """The same as ``mixed`` of the inputs, by one look into a table for each predictor."""
        row = gate << 8
        total = np.zeros(len(gate), np.float32)
        for k, slot in enumerate(slots):
            total += weighted[k].take(row + self.odds[k].view(np.uint8).take(slot))
        return np.clip(total, -8, 8, out=total)

    def mixed(self, gate: np.ndarray, inputs: list[np.ndarray]) -> np.ndarray:
        weights = self.weights.T.astype(np.float32)
        total = weights[0].take(gate) * inputs[0]
        for k in range(1, PREDICTORS):
            total += weights[k].take(gate) * inputs[k]
        return np.clip(total, -8, 8, out=total)

    def learn(self, words: list[bytes] | pa.Array, c: np.ndarray) -> None:
        """One online step for each bit position of a block of words."""
        # Frequent words count more, but not so much that one of them makes the step alone.
        root = np.sqrt(c).astype(np.float32)
        for stretch, bit, gate, slots in bits(spell(words)):
            mass = root[stretch]
            inputs = self.inputs(slots)
            error = (bit - squash(self.mixed(gate, inputs))) * mass
            total = np.bincount(gate, mass, GATES)
            for k in range(PREDICTORS):
                step = np.bincount(gate, error * inputs[k], GATES)
                self.weights[:, k] += RATE * step / np.maximum(total, 1) * (total > 0)

    def outcomes(self, words: list[bytes] | pa.Array, c: np.ndarray) -> np.ndarray:
        """How often each bit came at each gate and level of log odds."""
        out, weighted = np.zeros(GATES * LEVELS * 2), self.weighted().reshape(PREDICTORS, -1)
        for stretch, bit, gate, slots in bits(spell(words)):
            mass = c[stretch]
            level = np.rint((self.summed(gate, slots, weighted) + 8) * 2).astype(np.int64)
            out += np.bincount((gate * LEVELS + level) * 2 + bit, mass, len(out))
        return out

    def score(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """log10 probability of each word at the start of a text."""
        return self.spelled(words) + self.begun(words)

    def begun(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """The part of that which is the head's."""
        joints = pc.binary_join_element_wise(b"", _heads(_strings(words)), b" ").dictionary_encode()
        return self.spelled(joints.dictionary).take(joints.indices.to_numpy())

    def spelled(self, stretches: list[bytes] | pa.Array) -> np.ndarray:
        """log10 probability of what each stretch codes."""
        told = stretches if isinstance(stretches, pa.Array) else pa.array(stretches, pa.binary())
        weighted = self.weighted().reshape(PREDICTORS, -1)
        parts = [self._spelled(told.slice(start, FEW), weighted) for start in range(0, len(told), FEW)]
        return np.concatenate([np.empty(0), *parts]) / math.log(10)

    def _spelled(self, stretches: pa.Array, weighted: np.ndarray) -> np.ndarray:
        out = np.zeros(len(stretches))
        for stretch, bit, gate, slots in bits(spell(stretches)):
            odds = self.summed(gate, slots, weighted)
            at = (odds + 8) * 2
            low = np.minimum(at.astype(np.int64), LEVELS - 2)
            part = at - low
            base = gate * LEVELS + low
            refined = self.refined.take(base) * (1 - part) + self.refined.take(base + 1) * part
            # The map and the mixer have a say each.
            odds = (refined + odds) / 2
            out -= np.bincount(stretch, np.log(1 + np.exp(np.where(bit == 1, -odds, odds))), len(stretches))
        return out

    def read(self, running: Running) -> np.ndarray:
        """log10 probability of the head of each word of the texts after the word before it."""
        told = pa.array(running.keys).dictionary_encode()
        return self.spelled(running.stretches(told.dictionary.to_numpy())).take(told.indices.to_numpy())


def _start_weights() -> np.ndarray:
    return np.full((GATES, PREDICTORS), 1 / PREDICTORS)


def _plain_map() -> np.ndarray:
    return np.tile(np.linspace(-8, 8, LEVELS), GATES)


def _tables(stretches: DataFrame) -> np.ndarray:
    """Log odds of every slot: PREDICTORS << SLOT_BITS bytes, whatever the size of the corpus."""
    parts = stretches.filter("c > 0").mapInArrow(_count_slots, "chunk int, counts binary")
    chunks = parts.groupBy("chunk").applyInArrow(_add_chunks, "chunk int, odds binary").collect()
    odds = np.zeros((PREDICTORS << SLOT_BITS) * 2 // CHUNK * (CHUNK // 2), np.int8).reshape(-1, CHUNK // 2)
    for row in chunks:
        odds[row["chunk"]] = np.frombuffer(row["odds"], np.int8)
    return odds.reshape(PREDICTORS, 1 << SLOT_BITS)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[pa.Array, np.ndarray]]]]:
    """Each learner with its words and their counts, STEP_WORDS at a time whatever the batches."""

    def runs():
        for batch in batches:
            learner = batch.column("learner").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(learner)) + 1).tolist(), len(learner)]
            for start, stop in pairwise(cuts):
                if stop > start:
                    yield int(learner[start]), batch.slice(start, stop - start)

    def together(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        return table.column("word").chunk(0), table.column("c").to_numpy().astype(np.float64)

    def steps(own):
        parts, missing = [], STEP_WORDS
        for _, run in own:
            while run.num_rows:
                parts.append(run.slice(0, missing))
                run = run.slice(missing)
                missing -= parts[-1].num_rows
                if not missing:
                    yield together(parts)
                    parts, missing = [], STEP_WORDS
        if parts:
            yield together(parts)

    for learner, own in groupby(runs(), key=lambda run: run[0]):
        yield learner, steps(own)


def _learn(stretches: DataFrame, tables: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refining map. Each learner learns online; after a round the weights are averaged."""
    learned = stretches.filter("c > 0")
    weights = _start_weights()
    for _ in range(ROUNDS):

        def run(batches, weights=weights):
            for learner, steps in _steps(batches):
                mixer, total = Mixer(tables.value, weights.copy(), _plain_map()), 0.0
                for words, c in steps:
                    mixer.learn(words, c)
                    total += float(np.sqrt(c).sum())
                flat = mixer.weights.astype("<f8").tobytes()
                yield pa.RecordBatch.from_pydict({"learner": pa.array([learner], pa.int32()), "w": pa.array([flat], pa.binary()), "total": [total]})

        dealt = learned.select("word", "c", F.pmod(F.xxhash64("word"), F.lit(LEARNERS)).cast("int").alias("learner"))
        dealt = dealt.repartition(LEARNERS, "learner").sortWithinPartitions("learner", "word")
        # One row per learner; added up in their order, as sums of floats depend on it.
        parts = sorted(dealt.mapInArrow(run, "learner int, w binary, total double").collect())
        total = sum(row["total"] for row in parts)
        if total:
            weights = sum(np.frombuffer(row["w"], "<f8") * row["total"] for row in parts).reshape(weights.shape) / total

    def observe(batches):
        mixer = Mixer(tables.value, weights, _plain_map())
        out = sum((mixer.outcomes(words, c) for words, c in batches_of(batches)), np.zeros(GATES * LEVELS * 2))
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(out)), pa.int32()), "n": out})

    seen = np.zeros(GATES * LEVELS * 2)
    for row in learned.mapInArrow(observe, "place int, n double").groupBy("place").agg(F.sum("n").alias("n")).collect():
        seen[row["place"]] = row["n"]
    pairs = seen.reshape(-1, 2)
    # The plain level counts as two bits seen.
    level = squash(_plain_map())
    refined = np.log((pairs[:, 1] + 2 * level) / (pairs[:, 0] + 2 * (1 - level)))
    return weights, refined


def _language(docs: DataFrame) -> Column:
    """The place of a row's language among the most frequent ones; LANGUAGES - 1 for all others."""
    other = F.lit(LANGUAGES - 1)
    if "lang" not in docs.columns:
        return other
    counts = docs.filter("lang IS NOT NULL").groupBy("lang").count()
    frequent = [row["lang"] for row in counts.orderBy(F.desc("count"), "lang").limit(LANGUAGES - 1).collect()]
    return F.coalesce(F.when(F.col("lang").isNull(), other), F.array_position(F.lit(frequent), F.col("lang")) - 1, other) if frequent else other


RESULT = """doc_id long, held_out boolean, n_tokens long, n_known long, base_score double,
    score double, bits_per_byte double"""


def score(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text); see the module.

    A row is held out if crc32 of its id, written as text, leaves remainder 0 by 10. If ``docs``
    has a column ``lang``, training words are also counted by its most frequent values.
    """
    spark = docs.sparkSession
    importable(spark)
    keyed = docs.select(
        "doc_id",
        _language(docs).alias("language"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True)).alias("held_out"),
        F.col("text").cast("binary").alias("text"),
    )
    blocks = written(keyed.mapInArrow(_cut_blocks, BLOCK), "blocks", compression="zstd")
    learned = F.size(F.filter("held_out", lambda held: ~held)).cast("long")
    trained = blocks.agg(F.coalesce(F.sum(learned), F.lit(0))).first()[0]
    by_language = [f"n{n}" for n in range(LANGUAGES)]
    counted = ", ".join(["word binary", *(f"{n} long" for n in by_language)])
    used = blocks.select("words", "bytes", "counts").mapInArrow(_counted_words, counted)
    words = used.groupBy("word").agg(*(F.sum(n).alias(n) for n in by_language))
    each = [F.col(f"n{n}") for n in range(LANGUAGES)]
    words = words.select("word", sum(each[1:], each[0]).alias("c"), F.array(*each).alias("each"))
    end = spark.range(1, numPartitions=1).select(
        F.lit(END_TOKEN).alias("word"), F.lit(trained).alias("c"), F.array_repeat(F.lit(0).cast("long"), LANGUAGES).alias("each")
    )
    vocabulary = written(words.unionByName(end), "vocabulary", compression="zstd")
    free_shuffles(spark)
    sums = [F.coalesce(F.sum(F.col("each")[n]), F.lit(0)) for n in range(LANGUAGES)]
    total, distinct, *sizes = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), *sums).first()

    context = spark.sparkContext
    # One task per core, whose counts are put together before they are dealt.
    few = blocks.select("words", "bytes", "ids", "lengths", "held_out").coalesce(context.defaultParallelism)
    joints = few.mapInArrow(_count_joints, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    stretches = written(vocabulary.select("word", "c").unionByName(joints), "stretches", compression="zstd")
    tables = context.broadcast(_tables(stretches))
    weights, refined = _learn(stretches, tables)
    discard(stretches)
    free_shuffles(spark)

    smoothing = SMOOTH * (distinct + 1)
    # The end mark has the same share in every language.
    end_share = trained / max(total, 1)
    sizes = np.array(sizes, np.float64)[:, None] / max(1 - end_share, 1e-9)

    def models_of(part: pa.RecordBatch, spelled: np.ndarray, behind: np.ndarray) -> pa.Array:
        """log10 probability of each word, as halves: behind its head when spelled, and in each language."""
        plain = (part.column("c").to_numpy() + SMOOTH) / (total + smoothing)
        each = part.column("each").flatten().to_numpy().astype(np.float64).reshape(-1, LANGUAGES).T.copy()
        each[:, pc.equal(part.column("word"), END_TOKEN).to_numpy(zero_copy_only=False)] = end_share * sizes
        likely = (plain + 10.0**spelled) / 2
        models = np.vstack([behind, np.log10((each + smoothing * likely) / (sizes + smoothing))])
        halves = pa.py_buffer(np.ascontiguousarray(models.T.astype(np.float16)).tobytes())
        return pa.Array.from_buffers(pa.binary(2 * (LANGUAGES + 1)), len(spelled), [None, halves]).cast(pa.binary())

    def spelled(batches):
        mixer = Mixer(tables.value, weights, refined)
        for batch in batches:
            for start in range(0, batch.num_rows, 50_000):
                part = batch.slice(start, 50_000)
                words = part.column("word")
                behind = mixer.spelled(words)
                yield pa.RecordBatch.from_arrays(
                    [words, part.column("c"), models_of(part, mixer.begun(words) + behind, behind)],
                    ["word", "c", "models"],
                )

    scored = written(vocabulary.mapInArrow(spelled, "word binary, c long, models binary"), "scored", compression="zstd")
    discard(vocabulary)
    end_models = scored.filter(F.col("word") == F.lit(END_TOKEN)).first()["models"]

    looked_up = (
        blocks.select("block", "words", "bytes")
        .mapInArrow(_placed_words, "of long, place int, word binary")
        .join(scored, "word")
        .select("of", "place", "c", "models")
    )

    def texts(block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.slice(0, 1).to_pylist()[0]
        place = found.column("place").to_numpy()
        at_end = len(place)
        words = _split(block, 0)
        running = Running(words, _numbers(row["ids"], row["lengths"]), row["lengths"])
        heads = Mixer(tables.value, weights, refined).read(running).astype(np.float32)
        size = np.append(pc.binary_length(words).to_numpy() + 1, 1)
        c = np.empty(at_end + 1)
        c[place], c[at_end] = found.column("c").to_numpy(), trained
        fixed = found.column("models").cast(pa.binary(2 * (LANGUAGES + 1))).combine_chunks()
        halves = np.frombuffer(fixed.buffers()[1], np.float16)[: at_end * (LANGUAGES + 1)] if at_end else np.empty(0)
        # A word's models side by side, as they are read together.
        models = np.empty((at_end + 1, LANGUAGES + 2), np.float32)
        models[:, 0] = np.log10((c + SMOOTH) / (total + smoothing))
        models[place, 1:] = halves.reshape(-1, LANGUAGES + 1)
        models[at_end, 1:] = np.frombuffer(end_models, np.float16)
        plain = np.log10((c + SMOOTH) / (total + smoothing))
        at = 0
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "score", "bits_per_byte")}
        for length in row["lengths"]:
            here = slice(at, at + length + 1)
            tokens, at = running.words[here], here.stop
            told = models.take(tokens, axis=0).T.copy()
            told[1] += heads[here]
            both = gated(told)
            out["n_tokens"].append(length + 1)
            out["n_known"].append(int((c[tokens] > 0).sum()))
            out["base_score"].append(float(plain[tokens].sum()))
            out["score"].append(both)
            out["bits_per_byte"].append(-both * math.log2(10) / float(size[tokens].sum()))
        out = {"doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held_out"], pa.bool_())} | out
        return pa.table(out)

    texts_only = blocks.select("block", "words", "bytes", "ids", "lengths", "doc_ids", "held_out")
    per_block = texts_only.groupBy("block").cogroup(looked_up.groupBy("of"))
    return per_block.applyInArrow(texts, RESULT).withColumn("train_tokens", F.lit(total).cast("long"))


def gated(models: np.ndarray) -> float:
    """log10 probability of tokens when an online gate mixes several models of each token.

    The log odds of the gate are what each model earned over the last MEMORY tokens; the gate for
    a token knows only the tokens before it.
    """
    earned = np.zeros((models.shape[0], models.shape[1] + 1))
    np.cumsum(models, axis=1, dtype=np.float64, out=earned[:, 1:])
    recent = earned[:, :-1].copy()
    recent[:, MEMORY:] -= earned[:, : max(models.shape[1] - MEMORY, 0)]
    recent -= recent.max(axis=0)
    shares = np.exp(recent * math.log(10))
    shares *= (1 - FLOOR) / shares.sum(axis=0)
    shares += FLOOR / len(models)
    shares *= np.exp(models.astype(np.float64) * math.log(10))
    return float(np.log10(shares.sum(axis=0)).sum())
