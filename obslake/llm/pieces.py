"""SentencePiece encoding with sampled segmentations, and decoding.

Method: forward filtering, backward sampling over the lattice of all pieces that spell a text. The weight of a
piece is its rank to the power of minus ALPHA (a vocabulary of merges has ranks in place of probabilities).
Forward sums give every lattice node its total weight; from the end, pieces are drawn in proportion to the weight
of all segmentations that end with them. Draws are a hash of the row's key, the word's number and the step, so a row
has the same segmentation in every run, on any task and in any order.

No piece crosses from a word's end to the space before the next one, nor between letters and other
characters (checked when the vocabulary is read), so the lattice of a text is a chain of words' lattices. Each
distinct word is filtered once while the cache holds it; draws for all words of a batch run together.

As the library does, a text gets one space in front, spaces become the vocabulary's mark, and a character
without a piece becomes its bytes. So does a mark that is in the text itself, which keeps decoding lossless.

Defined cases: a null or empty text has no pieces and decodes to an empty one; a null key is a key of its own; equal
rows get equal pieces; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from obslake.llm.common import Cache, documents, mix, sliced

MODEL = "piece_bpe_32k.model"
ALPHA = 1.0
MARK = "▁"
#: code of a mark that stands in the text itself
LITERAL = 0x110000
WORDS = 400_000
#: a draw is a number of so many bits, compared with cumulated probabilities as such numbers
BITS = 24
_GOLD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Table:
    """Numbers of 64-bit hashes; a hash that finds its slot taken goes to the next array of slots."""

    def __init__(self, numbers: dict[int, int], bits: int = 18):
        keys, values = np.array(list(numbers), np.uint64), np.array(list(numbers.values()), np.int32)
        self.bits, self.layers = bits, []
        while len(keys):
            slots = self._slots(keys, len(self.layers))
            _, first = np.unique(slots, return_index=True)
            layer = np.zeros(2**bits, np.uint64), np.full(2**bits, -2, np.int32)
            layer[0][slots[first]], layer[1][slots[first]] = keys[first], values[first]
            self.layers.append(layer)
            keys, values = np.delete(keys, first), np.delete(values, first)

    def _slots(self, hashes: np.ndarray, layer: int) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits - layer)).astype(np.int64) & (2**self.bits - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -2 where it has none."""
        out = np.full(len(hashes), -2, np.int32)
        left = np.arange(len(hashes))
        for number, (keys, values) in enumerate(self.layers):
            slots = self._slots(hashes[left], number)
            hit = keys[slots] == hashes[left]
            out[left[hit]] = values[slots[hit]]
            left = left[~hit & (values[slots] != -2)]
        return out


class Vocabulary:
    """Pieces, the logs of their weights, and the beginnings of pieces."""

    def __init__(self, path: str, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(self.size) if model.is_byte(i)}
        self.byte_ids = np.array([byte[i] for i in range(256)], np.int32)
        special = {i for i in range(self.size) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        self.pieces = {model.id_to_piece(i): i for i in range(self.size) if i not in special}
        self.shown = [b""] * self.size
        for piece, i in self.pieces.items():
            self.shown[i] = piece.replace(MARK, " ").encode()
        for value, i in byte.items():
            self.shown[i] = bytes([value])
        rank = {i: -model.get_score(i) for i in self.pieces.values()}
        self.weight = np.full(self.size, -alpha * np.log(self.size + 2.0))  # bytes and unranked pieces come last
        for i, value in rank.items():
            self.weight[i] = -alpha * np.log(2.0 + min(max(value, 0.0), self.size))
        self.byte_weight = self.weight[self.byte_ids[0]]
        letters = re.compile(r"[^\W\d_]")
        inner = [piece.lstrip(MARK) for piece in self.pieces]
        if any(MARK in piece or "\n" in piece[1:] or "\n" in piece and len(piece) > 1 for piece in inner):
            self.words = re.compile(r"(?s).+")
        elif any(len({bool(letters.match(c)) for c in piece}) > 1 for piece in inner):
            self.words = re.compile(r" *[^ \n]+| +|\n")
        else:
            self.words = re.compile(r" *(?:[^\W\d_]+|(?:[\d_]|[^\w \n])+)| +|\n")
        self.longest = max(map(len, self.pieces))
        self.beginnings = Table(self._beginnings())

    def _beginnings(self) -> dict[int, int]:
        """Hash of each beginning of a piece, to the piece itself or to -1."""
        known: dict[str, int] = {piece[:size]: -1 for piece in self.pieces for size in range(1, len(piece))} | self.pieces
        found = {}
        for length in range(1, self.longest + 1):
            some = [text for text in known if len(text) == length]
            codes = np.array([[ord(c) for c in text] for text in some], np.uint64).reshape(len(some), length)
            hashes = np.zeros(len(some), np.uint64)
            for column in codes.T:
                hashes = self.extended(hashes, column)
            found.update(zip(hashes.tolist(), map(known.__getitem__, some), strict=True))
        return found

    @staticmethod
    def extended(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(hashes * np.uint64(3) + codes.astype(np.uint64) + np.uint64(1))


class Lattices:
    """Filtered lattices of words: for each node the cumulated probabilities of the pieces that end there.

    Probabilities are thresholds in 2**-BITS parts, cumulated within their node only. So the piece that a draw falls on
    depends on the word and the draw, not on the node's number or on the words that a worker saw before.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.ends: dict[str, int] = {}  # a word's last node
        self.nodes = 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.joined = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def of(self, words: list[str]) -> np.ndarray:
        """The last node of each word's lattice."""
        if len(self.ends) > WORDS:
            self.clear()
        nodes = np.fromiter(map(self.ends.get, words, repeat(-1)), np.int64, len(words))
        if (unknown := np.flatnonzero(nodes < 0)).size:
            new = [words[i] for i in unknown.tolist()]
            self.add(list(dict.fromkeys(new)))
            nodes[unknown] = np.fromiter(map(self.ends.__getitem__, new), np.int64, len(new))
        return nodes

    def add(self, words: list[str]) -> None:
        vocabulary = self.vocabulary
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        codes = np.where(codes == ord(MARK), LITERAL, np.where(codes == 32, ord(MARK), codes))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        last = np.cumsum(sizes)
        place = np.arange(len(codes)) - np.repeat(last - sizes, sizes)
        left = np.repeat(sizes, sizes) - place
        starts, ends, ids = [], [], []
        at = np.arange(len(codes))
        hashes = np.zeros(len(codes), np.uint64)
        for length in range(1, vocabulary.longest + 1):
            hashes = vocabulary.extended(hashes, codes[at + length - 1])
            piece = vocabulary.beginnings.find(hashes)
            hit = piece >= 0
            starts.append(at[hit])
            ends.append(at[hit] + length - 1)
            ids.append(piece[hit].astype(np.int64))
            on = (piece >= -1) & (left[at] > length)
            at, hashes = at[on], hashes[on]
            if not len(at):
                break
        single = np.zeros(len(codes), bool)
        single[starts[0]] = True
        rest = np.flatnonzero(~single)
        start, end = np.concatenate([*starts, rest]), np.concatenate([*ends, rest])
        code = np.concatenate([*ids, vocabulary.size + codes[rest]])
        spelled = np.where(codes[rest] == LITERAL, 3, 1 + (codes[rest] > 0x7F) + (codes[rest] > 0x7FF) + (codes[rest] > 0xFFFF))
        weight = np.concatenate([vocabulary.weight[np.concatenate(ids)], vocabulary.byte_weight * spelled])

        order = np.lexsort((end, place[end]))
        start, end, code, weight = start[order], end[order], code[order], weight[order]
        total = np.zeros(len(codes) + 1)  # log of all weight up to a node; one more for a word's beginning
        before = np.where(place[start] > 0, start - 1, len(codes))
        steps = np.searchsorted(place[end], np.arange(place.max() + 2))
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            group = np.flatnonzero(np.diff(end[low:high], prepend=-1))
            value = total[before[low:high]] + weight[low:high]
            top = np.maximum.reduceat(value, group)
            node = end[low:high][group]
            sizes_in = np.diff(np.append(group, high - low))
            total[node] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, sizes_in)), group))
        share = np.exp(total[before] + weight - total[end])
        order = np.argsort(end, kind="stable")
        start, end, code, share = start[order], end[order], code[order], share[order]
        first = np.flatnonzero(np.diff(end, prepend=-1))
        lengths = np.diff(np.append(first, len(end)))
        cumulated, upto, more = np.empty(len(end)), np.zeros(len(first)), first
        for number in range(lengths.max()):  # the pieces that end at a node are as many as pieces have lengths
            going = lengths > number
            upto, lengths, more = upto[going] + share[more[going] + number], lengths[going], more[going]
            cumulated[more + number] = upto
        thresholds = np.minimum(np.rint(cumulated * (1 << BITS)).astype(np.int64), 1 << BITS)
        thresholds[np.append(first[1:], len(end)) - 1] = 1 << BITS
        previous = np.where(place[start] > 0, self.nodes + start - 1, -1)
        self.parts.append((((self.nodes + end) << BITS) + thresholds, previous, code.astype(np.int32)))
        self.ends.update(zip(words, (self.nodes + last - 1).tolist(), strict=True))
        self.nodes += len(codes)
        if sum(len(part[0]) for part in self.parts) > 0.25 * len(self.joined[0]):
            self.joined = tuple(np.concatenate([whole, *(part[i] for part in self.parts)]) for i, whole in enumerate(self.joined))
            self.parts.clear()

    def edges(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Previous node and piece of the edge that a point (node << BITS, plus a number of BITS bits) falls on."""
        if self.parts:
            self.joined = tuple(np.concatenate([whole, *(part[i] for part in self.parts)]) for i, whole in enumerate(self.joined))
            self.parts.clear()
        found = np.searchsorted(self.joined[0], points, "right")
        return self.joined[1][found], self.joined[2][found]


class Encoder:
    def __init__(self, path: str, alpha: float = ALPHA):
        self.vocabulary = Vocabulary(path, alpha)
        self.lattices = Lattices(self.vocabulary)

    def encode(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text, drawn with the text's seed."""
        words, numbers = [], []
        for text in texts:
            some = self.vocabulary.words.findall(" " + text) if text else []
            words += some
            numbers.append(len(some))
        numbers = np.array(numbers, np.int64)
        if not words:
            return [np.zeros(0, np.int32) for _ in texts]
        nodes = self.lattices.of(words)
        owner = np.repeat(np.arange(len(texts)), numbers)
        place = np.arange(len(words)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
        with np.errstate(over="ignore"):
            draws = mix(seeds[owner] + place.astype(np.uint64) * _GOLD)
        lane = np.argsort(nodes, kind="stable")  # equal words side by side
        node, draw = nodes[lane], draws[lane]
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        step = 0
        while len(lane):
            with np.errstate(over="ignore"):
                number = (mix(draw + np.uint64(step) * _STEP) >> np.uint64(64 - BITS)).astype(np.int64)
            previous, code = self.lattices.edges((node << BITS) + number)
            drawn.append((lane, code))
            more = previous >= 0
            lane, node, draw, step = lane[more], previous[more], draw[more], step + 1
        counts = np.zeros(len(words), np.int64)
        for lane, _ in drawn:
            counts[lane] += 1
        end = np.cumsum(counts)
        codes = np.empty(end[-1], np.int32)
        for back, (lane, code) in enumerate(drawn):
            codes[end[lane] - 1 - back] = code
        per_text = np.bincount(owner, counts, len(texts)).astype(np.int64)
        if (odd := np.flatnonzero(codes >= self.vocabulary.size)).size:
            codes, per_text = self._spelled(codes, odd, per_text)
        return np.split(codes, np.cumsum(per_text)[:-1])

    def _spelled(self, codes: np.ndarray, odd: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece replaced by the pieces of their bytes."""
        characters = codes[odd] - self.vocabulary.size
        spelling = [(MARK if c == LITERAL else chr(c)).encode() for c in characters.tolist()]
        sizes = np.ones(len(codes), np.int64)
        sizes[odd] = [len(s) for s in spelling]
        owner = np.repeat(np.arange(len(per_text)), per_text)
        at = np.repeat(sizes > 0, sizes)
        byte = np.zeros(len(codes), bool)
        byte[odd] = True
        out = np.repeat(codes, sizes)
        out[np.repeat(byte, sizes) & at] = self.vocabulary.byte_ids[np.frombuffer(b"".join(spelling), np.uint8)]
        return out, np.bincount(owner, sizes, len(per_text)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.shown.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


_ENCODERS = Cache(lambda key: Encoder(*key), 2)


def seeds(keys: list, salt: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(repr(key), salt) for key in keys], np.uint64)


def encoded(docs: DataFrame, path: str | None = None, alpha: float = ALPHA, salt: int = 0) -> DataFrame:
    """doc_id, n_pieces, ids, and whether decoding gives the text back, of every row."""
    path = path or model_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS[path, alpha]
        for batch in sliced(batches, 2_000_000):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = encoder.encode(texts, seeds(batch.column("doc_id").to_pylist(), salt))
            flat = pa.array(np.concatenate(ids), pa.int32())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            same = [encoder.decode(x) == text for x, text in zip(ids, texts, strict=True)]
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int32()), pa.ListArray.from_arrays(offsets, flat), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids", "lossless"])

    return documents(docs).mapInArrow(encode, "doc_id long, n_pieces int, ids array<int>, lossless boolean")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""
    path = path or model_path()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS[path, ALPHA]
        for batch in batches:
            texts = [encoder.decode(np.array(ids or [], np.int32)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
