"""Language identification by cross-parsing entropy.

Method: a suffix automaton of labelled text per language parses a document greedily into the
longest phrases that occur in that text; the language that needs the fewest phrases, each weighed
with the log of its reference length, wins.

The reference text is a bounded sample: from each language the DOCUMENTS texts with the smallest hash
of DOCUMENTS hash buckets, CHARS_EACH characters from each, so equal copies count once. Predictions
cover whole texts: a batch is cut into lanes of LANE symbols that walk all automata at once as table
look-ups, one array operation per symbol position. A phrase ends with its lane, which adds at most one
phrase in LANE symbols for every language alike.

Defined cases: null, empty and letterless texts are `und` with score 0; ties go to the alphabetically
first language; without labelled text every row is `und`; with one language the score is 1; repeated
rows are predicted as often as they occur; a null doc_id counts as not held out; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import documents, frugal, sliced

#: the learning sample's bounds: texts per language, characters of each, distinct letters
DOCUMENTS, CHARS_EACH, ALPHABET = 64, 400, 255
LANE = 2048
#: characters that a task walks at once
CHARS = 3_000_000
#: characters whose code points are looked up at once, which bounds a task's memory whatever a text's length
BLOCK = 100_000
UNKNOWN = "und"
SEPARATOR, OTHER = 0, 1


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string") if isinstance(doc_id, str) else doc_id) % 4 == 2, F.lit(False))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The edges of each state; state 0 accepts the empty string, every path spells a substring."""
    edges: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(edges)
        edges.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in edges[state]:
            edges[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = edges[state][symbol]
            if longest[target] == longest[state] + 1:
                link[new] = target
            else:
                copy = len(edges)
                edges.append(dict(edges[target]))
                longest.append(longest[state] + 1)
                link.append(link[target])
                while state >= 0 and edges[state].get(symbol) == target:
                    edges[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return edges


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # of each code point
    table: np.ndarray  # next row's start * 4 + phrases that end here
    starts: np.ndarray  # each automaton's root
    weights: np.ndarray  # log2 of the reference length

    @classmethod
    def of(cls, samples: dict[str, list[str]], alphabet: int = ALPHABET) -> Model:
        languages = sorted(samples)
        letters = Counter(c for texts in samples.values() for text in texts for c in text.lower() if c.isalpha())
        known = {c: 2 + i for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:alphabet])}
        symbols = np.zeros(0x110000, np.uint16)
        for code in range(0x110000):
            if (c := chr(code)).isalpha():
                symbols[code] = known.get(c.lower(), OTHER)
        width = len(known) + 2
        tables, starts, weights, size = [], [], [], 0
        for language in languages:
            parts = [_symbols_of(symbols, text) for text in samples[language]]
            sequence = [s for part in parts for s in (*part.tolist(), SEPARATOR)]
            edges = suffix_automaton(sequence)
            root = np.full(width, size * 4 + 1, np.int64)  # an unseen symbol is a phrase by itself
            for symbol, target in edges[0].items():
                root[symbol] = (size + target * width) * 4
            # where no edge leads on, a phrase ends and the next begins with the same symbol
            table = np.tile(np.where(root & 3, root + 1, root + 1), (len(edges), 1))
            table[0] = root
            for state, targets in enumerate(edges):
                for symbol, target in targets.items():
                    table[state, symbol] = (size + target * width) * 4
            tables.append(table.ravel())
            starts.append(size)
            weights.append(np.log2(max(2, len(sequence))))
            size += table.size
        table = np.concatenate(tables) if tables else np.zeros(0, np.int64)
        kind = np.int32 if size * 4 < 2**31 else np.int64
        return cls(languages, symbols, table.astype(kind), np.array(starts, kind), np.array(weights))

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts, a run of SEPARATOR as one and none before a text's first letter, and their number in each."""
        joined = "".join(texts)
        raw = np.empty(len(joined), self.symbols.dtype)
        for at in range(0, len(joined), BLOCK):
            raw[at : at + BLOCK] = self.symbols[np.frombuffer(joined[at : at + BLOCK].encode("utf-32-le"), np.uint32)]
        del joined
        sizes = np.array([len(text) for text in texts], np.int64)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        kept = raw != SEPARATOR
        after = kept[:-1].copy()
        after[starts[1:] - 1] = False
        kept[1:] |= after
        if len(starts):
            sizes[sizes > 0] = np.add.reduceat(kept, starts, dtype=np.int64)
        return raw[kept], sizes

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Weighted phrases of each text (row) in each language (column), and symbols of each text."""
        flat, sizes = self._flat(texts)
        last = np.cumsum(sizes)
        first = last - sizes
        lanes_of = -(-(last - first) // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes_of)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
        start = first[owner] + place * LANE
        length = np.minimum(LANE, last[owner] - start)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        counts = np.zeros((len(self.languages), len(owner)), self.table.dtype)
        state = np.repeat(self.starts[:, None], len(owner), axis=1)
        active = np.searchsorted(-length, -np.arange(LANE), "left")
        for step in range(int(length[0]) if len(length) else 0):
            live = active[step]
            value = self.table.take(state[:, :live] + flat[start[:live] + step])
            counts[:, :live] += value & 3
            state[:, :live] = value >> 2
        counts += state != self.starts[:, None]
        result = np.zeros((len(texts), len(self.languages)))
        for column, one in enumerate(counts):
            result[:, column] = np.bincount(owner, one, len(texts)) * self.weights[column]
        return result, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (relative distance of the runner-up) and bits per symbol of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        bits, sizes = self.phrases(texts)
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        runner_up = ordered[:, 1] if len(self.languages) > 1 else np.full(len(texts), np.inf)
        known = sizes > 0
        score = np.where(known, 1 - ordered[:, 0] / np.maximum(runner_up, 1e-9), 0.0)
        rate = ordered[:, 0] / np.maximum(sizes, 1)
        return [self.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)], score, rate


def _symbols_of(symbols: np.ndarray, text: str) -> np.ndarray:
    raw = symbols[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    return raw[(raw != SEPARATOR) | (np.concatenate([[SEPARATOR], raw[:-1]]) != SEPARATOR)]


def learn(labelled: DataFrame, documents_each: int = DOCUMENTS, chars_each: int = CHARS_EACH) -> Model:
    """A model from a bounded sample of the rows' text and lang."""
    rows = labelled.select(F.col("lang").alias("lang"), F.col("text").alias("text"), F.xxhash64("text").alias("hash"))
    rows = rows.where(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}"))
    bucket = F.pmod("hash", F.lit(documents_each)).alias("bucket")
    chosen = rows.groupBy("lang", bucket).agg(F.min("hash").alias("hash")).select("lang", "hash")
    texts = (
        rows.join(F.broadcast(chosen), ["lang", "hash"])  # documents_each rows per language
        .groupBy("lang", "hash")
        .agg(F.min(F.substring("text", 1, chars_each)).alias("text"))
        .orderBy("lang", "hash")
        .collect()
    )
    samples: dict[str, list[str]] = {}
    for row in texts:
        samples.setdefault(row["lang"], []).append(row["text"])
    return Model.of(samples)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and bits (per symbol, 0 for `und`) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHARS):
            found, score, rate = shared.value.predict([text or "" for text in batch.column("text").to_pylist()])
            columns = [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "bits"])

    return documents(docs).mapInArrow(frugal(predict), "doc_id long, lang_pred string, score double, bits double")


def identified(docs: DataFrame) -> DataFrame:
    """Every document's language, learned from the labelled documents that are not held out."""
    model = learn(docs.select("text", "lang", "doc_id").where(~held_out()))
    return predicted(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits")


#: a text that needs more bits per symbol than this in every language is in none of them
MOST_BITS = 9.0


def known_language(docs: DataFrame, most_bits: float = MOST_BITS) -> DataFrame:
    """The rows, with all their columns, whose text is in one of the learned languages.

    Rejected are letterless texts and texts that no language's reference describes.
    """
    model = learn(docs.select("text", "lang", "doc_id").where(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHARS):
            found, _, rate = shared.value.predict([text or "" for text in batch.column("text").to_pylist()])
            yield batch.filter(pa.array((np.array(found, object) != UNKNOWN) & (rate <= most_bits), pa.bool_()))

    return docs.mapInArrow(frugal(keep), docs.schema)
