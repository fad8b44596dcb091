"""Language-model scores by a hierarchical Pitman-Yor model of words.

Method: a word is drawn in the restaurant of its context, the word before it (a text begins after its end
token); every distinct word has its own. Every context restaurant has the same parent, whose customers are the tables
of all of them, and whose tables are the distinct words. The parent's base is continuous: what its discount leaves is
the probability of a word that training never saw, as the add-one base also takes all such words as one.
Discounts follow from the numbers of things seen once and twice. Gibbs sampling seats anew all customers of one
word in one restaurant at a time, given everyone else; after BURN_IN sweeps, the predictive probabilities of SAMPLES
sweeps are averaged and give each text's score, hence its perplexity.

At scale: tokens travel once, in packed blocks, to the bucket of their word, where all restaurants' counts
of the word meet; a word with more than a 1000th of all tokens (so at most 1000 words) is dealt over buckets by
context. Restaurants' totals and those of the dealt words are all that buckets have to share. A bucket sends
its part of its restaurants' totals, one number per context, to the part that the context's hash names; there they are
summed and each bucket gets back the totals of its own contexts, so no task holds all contexts. Sampled tables take the same
way after every sweep, so each sweep, and each sample's predictions, know the tables of all buckets as the sweep before
left them; only pairs of several customers, whose tables can change, travel for that. Buckets return sums per text, which
meet by chunk of texts.

Defined cases: a null or empty text has only its end token; a null doc_id is not held out; repeated rows count as often
as they occur; without training texts every probability is 1 and every score 0; an empty table gives no row;
other columns are ignored. Words and contexts are told apart by a 64-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.common import documents, frugal, mix, portions, staged, word_hashes  # noqa: F401 (word_hashes: the words of this module, one by one)
from obslake.session import staged_for

BURN_IN, SAMPLES = 2, 3
STRENGTH = 1.0
#: tokens of a bucket, the share that makes a word heavy, and texts of a chunk
BUCKET, HEAVY, CHUNK = 2_000_000, 1000, 60_000
#: pairs whose predictions are made at a time, so that sums of arrays as long as the bucket are not kept
PART = 1 << 17
#: customers that choose a table one by one; later ones choose in runs of a 32nd of those before
ONE_BY_ONE = 64

END = np.uint64(0x5851F42D4C957F2D)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _held(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _packed(values: np.ndarray) -> bytes:
    """First bytes of all values, then their second ones, and so on: upper bytes are much alike."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(code: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(code), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _range(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash; hashes in order have their parts in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of a batch's distinct words and END, the number among them of each text's words and its END, and the tokens of each text."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
    flat = words.flatten()
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # there is an empty word at the blank end of a text
    sizes = np.diff(np.concatenate([[0], np.cumsum(real)])[words.offsets.to_numpy() - words.offsets[0].as_py()]) + 1
    codes = flat.filter(pa.array(real)).dictionary_encode()
    distinct = codes.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    hashes = np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct)), END)
    tokens = np.full(sizes.sum(), len(distinct), np.int32)
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(sizes) - 1] = False
    tokens[inner] = codes.indices.to_numpy()
    return hashes, tokens, sizes


def _heavy_words(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of tokens, and the words with more than a HEAVY-th of them (at least half of that is certain)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 4_000_000):
            words, tokens, _ = _tokens(batch)
            counts = np.bincount(tokens, minlength=len(words))
            often = counts * 2 * HEAVY >= len(tokens)
            words, counts = words[often].view(np.int64), counts[often]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *words.tolist()], pa.int64()), pa.array([len(tokens), *counts.tolist()], pa.int64())], ["word", "tokens"]
            )

    counted = docs.mapInArrow(frugal(count), "word long, tokens long").groupBy("word").agg(F.sum("tokens").alias("tokens"))
    counted = staged(counted, "heavy")
    total = counted.where("word IS NULL").agg(F.sum("tokens")).first()[0] or 0
    heavy = counted.where(F.col("word").isNotNull() & (F.col("tokens") * 2 * HEAVY >= total)).select("word").collect()
    return total, np.sort(np.array([row["word"] for row in heavy], np.int64).view(np.uint64))  # at most 2 * HEAVY words


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


_BLOCK = "kind int, route int, chunk long, trained long, a binary, b binary, c binary, d binary, e binary"
_BLOCK_NAMES = [field.split()[0] for field in _BLOCK.split(", ")]


def _rows(rows: list[tuple], schema: str, names: list[str]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)], names)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: their binaries are large, so a batch is never copied whole."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield {name: column[row].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


def _dealt(heavy: np.ndarray, buckets: int):
    """Blocks (kind 0): a chunk's tokens for one bucket; headers (kind 1): a chunk's texts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for whole in portions(batches, 4_000_000):
            for batch in (whole.slice(at, CHUNK) for at in range(0, whole.num_rows, CHUNK)):
                chunk = (TaskContext.get().partitionId() << 32) + number
                number += 1
                ids = batch.column("doc_id").to_pylist()
                held = np.array([_held(i) for i in ids], bool)
                words, tokens, sizes = _tokens(batch)
                hashes = words[tokens]
                order = np.argsort(held, kind="stable")  # training texts first
                name = np.empty(len(ids), np.uint16)
                name[order] = np.arange(len(ids))
                text = np.repeat(name, sizes)
                before = np.concatenate([tokens[-1:], tokens[:-1]])  # the last token is an END
                with np.errstate(over="ignore"):
                    spread = mix(hashes ^ mix(words)[before] * _GOLD)
                key = np.where(_is_in(words, heavy)[tokens], spread, hashes)
                del spread, tokens
                contexts, context = np.unique(words, return_inverse=True)  # every token is before another one
                context = context[before]
                del before
                at = np.argsort(key, kind="stable")
                hashes, context, text = hashes[at], context[at], text[at]
                cuts = np.searchsorted(_range(key[at], buckets), np.arange(buckets + 1))
                del key, at
                trained = int((~held).sum())
                rows = []
                for bucket in range(buckets):
                    low, high = cuts[bucket], cuts[bucket + 1]
                    if low == high:
                        continue
                    some = hashes[low:high]
                    first = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
                    runs = np.diff(np.append(first, len(some))).astype(np.int32)
                    used, place = np.unique(context[low:high], return_inverse=True)
                    arrays = (some[first], runs, contexts[used], place.astype(np.int32), text[low:high])
                    rows.append((0, bucket, chunk, trained, *map(_packed, arrays)))
                known = np.array([i is not None for i in ids], np.uint8)[order]
                numbers = np.array([i or 0 for i in ids], np.int64)[order]
                rows.append((1, int(mix(np.array([chunk], np.uint64))[0] % np.uint64(buckets)), chunk, trained, *map(_packed, (numbers, known, sizes[order], held[order].astype(np.uint8))), None))
                yield _rows(rows, _BLOCK, _BLOCK_NAMES)

    return deal


_BUCKET = (
    f"{_BLOCK}, words binary, contexts binary, pair_word binary, "
    "pair_context binary, pair_count binary, pair_tokens binary, chunks binary, token_chunk binary, token_text binary, "
    "heavy_count array<long>, heavy_tables array<long>, totals array<long>"
)
_BUCKET_NAMES = [field.split()[0] for field in _BUCKET.split(", ")]


def _bucket_row(**values) -> pa.RecordBatch:
    return _rows([tuple(values.get(name) for name in _BUCKET_NAMES)], _BUCKET, _BUCKET_NAMES)


def _by_part(contexts: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """Where the ordered contexts of each part are."""
    cuts = np.searchsorted(_range(contexts, buckets), np.arange(buckets + 1))
    return [(part, slice(cuts[part], cuts[part + 1])) for part in range(buckets) if cuts[part] < cuts[part + 1]]


def _first_tables(count: np.ndarray) -> np.ndarray:
    """Tables before the first sweep."""
    return np.minimum(count, np.ceil(count**0.75)).astype(np.int64)


def _merged(heavy: np.ndarray, buckets: int):
    """One row per bucket: its words, the counts of words in restaurants, its tokens, and its totals; headers pass.

    Besides, its part of its restaurants' totals (kind 3), in as many parts as there are buckets, and what a sweep needs
    (kind 4): its pairs of several customers, with the contexts and the words of these alone.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[tuple] = []
        bucket = None

        def bucket_rows() -> Iterator[pa.RecordBatch]:
            words, contexts = (np.unique(np.concatenate([_unpacked(block[at], np.uint64) for block in blocks])) for at in (2, 4))
            ends = np.cumsum([0, *(zstandard.frame_content_size(block[6]) // np.uint16().itemsize for block in blocks)])
            key, text = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.uint16)
            chunk, train = np.empty(ends[-1], np.int32), np.empty(ends[-1], bool)
            names = np.array([block[0] for block in blocks], np.int64)
            for number in range(len(blocks)):
                _, trained, own_words, runs, own_contexts, places, texts = blocks[number]
                blocks[number] = None  # its tokens are in the arrays from here on
                part = slice(ends[number], ends[number + 1])
                key[part] = np.repeat(np.searchsorted(words, _unpacked(own_words, np.uint64)), _unpacked(runs, np.int32)) * len(contexts)
                key[part] += np.searchsorted(contexts, _unpacked(own_contexts, np.uint64))[_unpacked(places, np.int32)]
                text[part] = _unpacked(texts, np.uint16)
                chunk[part] = number
                train[part] = text[part] < trained
            at = np.argsort(key, kind="stable")
            key = key[at]
            text, chunk, train = text[at], chunk[at], train[at]
            del at
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            tokens = np.diff(np.append(first, len(key))).astype(np.int32)
            count = np.add.reduceat(train, first, dtype=np.int64)
            pair_word, pair_context = (x.astype(np.int32) for x in np.divmod(key[first], len(contexts)))
            del key, first, train
            tables = _first_tables(count)
            dealt = _is_in(words, heavy)
            place = np.searchsorted(heavy, words)
            word_count = np.bincount(pair_word, count, len(words)).astype(np.int64)
            word_tables = np.bincount(pair_word, tables, len(words)).astype(np.int64)
            sums = [np.zeros(len(heavy), np.int64) for _ in range(2)]
            for total, values in zip(sums, (word_count, word_tables), strict=True):
                total[place[dealt]] = values[dealt]
            own = word_tables[~dealt]
            totals = [word_count.sum(), (word_count[~dealt] > 0).sum(), (count == 1).sum(), (count == 2).sum(), (own == 1).sum(), (own == 2).sum(), tables.sum()]
            per_context = [np.bincount(pair_context, values, len(contexts)).astype(np.int64) for values in (count, tables)]
            arrays = (words, contexts, pair_word, pair_context, count, tokens, names, chunk, text)
            yield _rows([(0, bucket, None, None, *[None] * 5, *map(_packed, arrays), *(x.tolist() for x in sums), totals)], _BUCKET, _BUCKET_NAMES)
            rows = [(3, part, bucket, None, *(_packed(x[some]) for x in (contexts, *per_context)), *[None] * 14) for part, some in _by_part(contexts, buckets)]
            yield _rows(rows, _BUCKET, _BUCKET_NAMES)
            several = np.flatnonzero(count > 1)
            used, place = (list(x) for x in zip(*(np.unique(x[several], return_inverse=True) for x in (pair_word, pair_context)), strict=True))
            fixed = word_tables[used[0]] - np.bincount(place[0], tables[several], len(used[0])).astype(np.int64)
            yield _bucket_row(
                kind=4, route=bucket, words=_packed(words[used[0]]), contexts=_packed(contexts[used[1]]), pair_word=_packed(place[0].astype(np.int32)),
                pair_context=_packed(place[1].astype(np.int32)), pair_count=_packed(count[several]), a=_packed(tables[several].astype(np.int32)),
                b=_packed(fixed), c=_packed(used[1].astype(np.int64)), e=_packed(np.zeros(0, np.int32)),
            )

        for one in _each(batches):
            values = tuple(one[name] for name in "abcde")
            if one["kind"] == 1:
                yield _rows([(1, one["route"], one["chunk"], one["trained"], *values, *[None] * 12)], _BUCKET, _BUCKET_NAMES)
                continue
            if blocks and one["route"] != bucket:
                yield from bucket_rows()
                blocks = []
            bucket = one["route"]
            blocks.append((one["chunk"], one["trained"], *values))
        if blocks:
            yield from bucket_rows()

    return merge


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket's contexts in a part, in their order, sums over all buckets (kind 3): customers and tables, or changes of tables.

    Rows of kind 5 bring the changes of tables in all samples; these are added up too, for the contexts of the rows of kind 3.
    A context comes once from a bucket that has it, so a frequent one is no longer than others.
    """

    def part(number: int, rows: list[dict]) -> pa.RecordBatch:
        asking, moved = ([row for row in rows if row["kind"] == kind] for kind in (3, 5))
        contexts = [_unpacked(row["a"], np.uint64) for row in asking]
        ends = np.cumsum([len(one) for one in contexts])[:-1]
        distinct, at = np.unique(np.concatenate(contexts), return_inverse=True)
        found = []
        for name in "bc":
            if asking[0][name] is not None:
                total = np.bincount(at, np.concatenate([_unpacked(row[name], np.int64) for row in asking]), len(distinct)).astype(np.int64)
                found.append([_packed(x) for x in np.split(total[at], ends)])
        if moved:
            total = np.zeros((SAMPLES, len(distinct)), np.int64)
            for row in moved:
                total[:, np.searchsorted(distinct, _unpacked(row["a"], np.uint64))] += _unpacked(row["b"], np.int64).reshape(SAMPLES, -1)
            found.append([_packed(total[:, x].ravel()) for x in np.split(at, ends)])
        found += [[None] * len(asking)] * (5 - len(found))
        return _rows([(3, row["chunk"], number, None, *sums) for row, sums in zip(asking, zip(*found, strict=True), strict=True)], _BLOCK, _BLOCK_NAMES)

    number, rows = None, []
    for one in _each(batches):
        if rows and one["route"] != number:
            yield part(number, rows)
            rows = []
        number = one["route"]
        rows.append(one)
    if rows:
        yield part(number, rows)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


@dataclass
class Shared:
    """What all buckets know: totals of all restaurants together and of heavy words, and the discounts.

    Of each sample, the tables of all restaurants and of the heavy words; without samples the tables are scored as they are.
    """

    tokens: int
    distinct: int
    discount: float
    parent_discount: float
    tables: int
    heavy: np.ndarray
    heavy_count: np.ndarray
    heavy_tables: np.ndarray
    samples: tuple[tuple[int, np.ndarray], ...] = ()


def _over_buckets(rows: DataFrame, *names: str) -> list[np.ndarray]:
    """Sums over buckets by place in the arrays, which have a fixed length."""
    zipped = rows.select(F.posexplode(F.arrays_zip(*names)).alias("place", "one")).groupBy("place")
    found = zipped.agg(*(F.sum(f"one.{name}").alias(name) for name in names)).orderBy("place").collect()
    return [np.array([row[name] for row in found], np.int64) for name in names]


def _shared(rows: DataFrame, heavy: np.ndarray) -> Shared:
    heavy_count, heavy_tables = _over_buckets(rows, "heavy_count", "heavy_tables") if len(heavy) else (np.zeros(0, np.int64),) * 2
    (totals,) = _over_buckets(rows, "totals")
    if not len(totals):
        totals = np.zeros(7, np.int64)
    tokens, distinct, once, twice, parent_once, parent_twice, tables = totals.tolist()
    distinct += int((heavy_count > 0).sum())
    return Shared(tokens, distinct, _discount(once, twice), _discount(parent_once, parent_twice), tables, heavy, heavy_count, heavy_tables)


def seated(count: np.ndarray, opening: np.ndarray, slope: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of `count` customers of one word in one restaurant, seated one after the other.

    A customer opens a table with weight opening + slope * tables and joins one with weight
    (customers - discount * tables).
    """
    order = np.argsort(-count, kind="stable")
    count, opening, slope = count[order], opening[order], slope[order]
    tables = np.ones(len(count))
    done, most = 1, int(count[0]) if len(count) else 0
    while done < most:
        live = int(np.searchsorted(-count, -done, "left"))  # those with more customers than are seated
        run = 1 if done < ONE_BY_ONE else max(1, done // 32)
        new = opening[:live] + slope[:live] * tables[:live]
        chance = new / (new + done - discount * tables[:live])
        if run == 1:
            tables[:live] += rng.random(live) < chance
        else:
            tables[:live] += rng.binomial(np.minimum(run, count[:live] - done), chance)
        done += run
    out = np.empty(len(count))
    out[order] = tables
    return out


def _swept(model, sweep: int, buckets: int, strength: float = STRENGTH):
    """A bucket's pairs of several customers seated anew (kind 4), and what that changes in its restaurants' totals (kind 3, by part).

    A bucket's row comes after the totals of its contexts: at first the tables of all of them, then the changes since, in all
    buckets, of those whose tables can change here.
    """

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared: Shared = model.value
        d, d0 = shared.discount, shared.parent_discount
        parts: list[np.ndarray] = []
        for one in _each(batches):
            if one["kind"] == 3:
                parts.append(_unpacked(one["a"], np.int64))
                continue
            totals = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            parts = []
            kinds = {"words": np.uint64, "contexts": np.uint64, "pair_word": np.int32, "pair_context": np.int32, "pair_count": np.int64, "a": np.int32, "b": np.int64, "c": np.int64}
            words, contexts, word, context, count, tables, fixed, known = (_unpacked(one[name], kind) for name, kind in kinds.items())
            first = _first_tables(count)
            known, in_context = (totals[known],) * 2 if sweep == 0 else (known, known + totals)
            dealt = _is_in(words, shared.heavy)
            place = np.searchsorted(shared.heavy, words)[dealt]
            in_word = fixed + np.bincount(word, tables, len(words))
            in_word[dealt] = shared.heavy_tables[place]
            parent = np.maximum(in_word[word] - tables - d0, 1 - d0) / (strength + shared.tables)
            opening = (strength + d * (in_context[context] - tables)) * parent
            tables = seated(count, opening, d * parent, d, np.random.default_rng((one["route"], sweep))).astype(np.int32)
            change = tables - first
            heavy_change = np.zeros(len(shared.heavy), np.int64)
            heavy_change[place] = np.bincount(word, change, len(words))[dealt]
            if sweep >= BURN_IN:
                one["e"] = _packed(np.concatenate([_unpacked(one["e"], np.int32), tables]))
            state = {"kind": 4, "a": _packed(tables), "c": _packed(known), "heavy_tables": heavy_change.tolist(), "totals": [int(change.sum())]}
            yield _bucket_row(**one | state)
            moved = np.bincount(context, change, len(contexts)).astype(np.int64)
            for part, some in _by_part(contexts, buckets):
                yield _bucket_row(kind=3, route=part, chunk=one["route"], a=_packed(contexts[some]), b=_packed(moved[some]))

    return seat


def _moved(buckets: int):
    """The changes of tables in all samples (kind 5, by part)."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _each(batches):
            contexts, context = _unpacked(one["contexts"], np.uint64), _unpacked(one["pair_context"], np.int32)
            first = _first_tables(_unpacked(one["pair_count"], np.int64))
            samples = _unpacked(one["e"], np.int32).reshape(SAMPLES, -1)
            moved = np.stack([np.bincount(context, tables - first, len(contexts)).astype(np.int64) for tables in samples])
            for part, some in _by_part(contexts, buckets):
                yield _rows([(5, part, one["route"], None, _packed(contexts[some]), _packed(moved[:, some].ravel()), *[None] * 3)], _BLOCK, _BLOCK_NAMES)

    return move


def _scored(model, strength: float = STRENGTH):
    """Sums of each text's tokens in a bucket (kind 2); the model's, which are samples, in single precision.

    A bucket's row comes after its samples (kind 4) and the totals of its contexts (kind 3, by part, which is the contexts' order).
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared: Shared = model.value
        d, d0 = shared.discount, shared.parent_discount
        samples = shared.samples or ((shared.tables, shared.heavy_tables),)
        parts: list[tuple] = []
        seats = None
        for one in _each(batches):
            if one["kind"] == 4:
                seats = _unpacked(one["e"], np.int32).reshape(len(samples), -1)
                continue
            if one["kind"] == 3:
                start = _unpacked(one["b"], np.int64)
                moved = _unpacked(one["c"], np.int64).reshape(len(samples), -1) if one["c"] is not None else np.zeros((len(samples), len(start)), np.int64)
                parts.append((_unpacked(one["a"], np.int64), start + moved))
                continue
            customers, in_contexts = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
            parts = []
            kinds = {"words": np.uint64, "pair_word": np.int32, "pair_context": np.int32, "pair_count": np.int64, "pair_tokens": np.int32, "chunks": np.int64, "token_chunk": np.int32, "token_text": np.uint16}
            words, word, context, count, tokens, chunks, chunk, text = (_unpacked(one[name], kind) for name, kind in kinds.items())
            route = one["route"]
            one.clear()
            dealt = _is_in(words, shared.heavy)
            place = np.searchsorted(shared.heavy, words)[dealt]
            word_count = np.bincount(word, count, len(words))
            word_count[dealt] = shared.heavy_count[place]
            tables = _first_tables(count).astype(np.float64)
            several = np.flatnonzero(count > 1)
            total = strength + customers
            mean = np.zeros(len(word))
            for number, (everywhere, heavy_tables) in enumerate(samples):
                if seats is not None:
                    tables[several] = seats[number]
                in_word = np.bincount(word, tables, len(words))
                in_word[dealt] = heavy_tables[place]
                unseen = (strength + d0 * shared.distinct) / (strength + everywhere)
                parent = np.where(word_count > 0, (in_word - d0) / (strength + everywhere), unseen)
                joining = (strength + d * in_contexts[number]) / total
                for low in range(0, len(word), PART):
                    some = slice(low, low + PART)
                    n, u = count[some], context[some]
                    mean[some] += (n - d * tables[some]) * (n > 0) / total[u] + joining[u] * parent[word[some]]
            seats = None
            log = np.log10(mean / len(samples))
            base = np.log10((word_count + 1) / (shared.tokens + shared.distinct + 1))
            del context, count, mean, several, tables
            # tokens by chunk, whose texts have sums of their own
            pair = np.repeat(np.arange(len(word), dtype=np.int32), tokens)
            at = np.argsort(chunk, kind="stable").astype(np.int32)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(chunk, minlength=len(chunks)))])
            for number, name in enumerate(chunks.tolist()):
                part = at[cuts[number] : cuts[number + 1]]
                texts, own = np.unique(text[part], return_inverse=True)
                of = pair[part]
                sums = [np.bincount(own, x, len(texts)) for x in (log[of], base[word[of]], word_count[word[of]] > 0)]
                values = [texts, sums[0].astype(np.float32), sums[1], sums[2].astype(np.int32)]
                yield _rows([(2, route, name, None, *map(_packed, values), None)], _BLOCK, _BLOCK_NAMES)

    return score


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _met(train_tokens: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}

        def texts() -> pa.RecordBatch:
            ids, known, sizes, held = (_unpacked(x, k) for x, k in zip(state["head"], (np.int64, np.uint8, np.int64, np.uint8), strict=True))
            columns = [
                pa.array(ids, pa.int64(), mask=known == 0), pa.array(held.astype(bool)), pa.array(sizes), pa.array(state["known"]),
                pa.array(np.full(len(ids), train_tokens, np.int64)), pa.array(state["base"]), pa.array(state["score"]),
            ]
            return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in _SCORES.split(", ")])

        for one in _each(batches):
            if one["kind"] == 1:
                if state:
                    yield texts()
                size = len(_unpacked(one["a"], np.int64))
                state = {"head": [one[n] for n in "abcd"], "known": np.zeros(size, np.int64), "base": np.zeros(size), "score": np.zeros(size)}
                continue
            at = _unpacked(one["a"], np.uint16)
            for name, code, kind in (("score", "b", np.float32), ("base", "c", np.float64), ("known", "d", np.int32)):
                state[name][at] += _unpacked(one[code], kind)
        if state:
            yield texts()

    return meet


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """A query's shuffle goes when the query ends: what is run here is written or collected, never read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def scored(docs: DataFrame) -> DataFrame:
    """Scores (log10) of every document by the model and by the add-one base."""
    docs = documents(docs)
    with _shuffles_removed(docs.sparkSession):
        total, heavy = _heavy_words(docs)
        buckets = max(1, -(-total // BUCKET))
        blocks = docs.mapInArrow(frugal(_dealt(heavy, buckets)), _BLOCK).repartition(buckets, "route").sortWithinPartitions("kind", "route", "chunk")
        rows = staged(blocks.mapInArrow(frugal(_merged(heavy, buckets)), _BUCKET), "restaurants")
        counted = rows.where("kind = 0")
        shared = _shared(counted, heavy)
        context = docs.sparkSession.sparkContext
        asked = rows.where("kind = 3").select(*_BLOCK_NAMES)

        def totals(parts: DataFrame) -> DataFrame:
            return parts.repartition(buckets, "route").sortWithinPartitions("route").mapInArrow(frugal(_summed), _BLOCK).select("kind", "route", "chunk", *"abc")

        state, sent = rows.where("kind = 4"), totals(asked).withColumn("a", F.col("b"))
        now, samples, before = shared, [], ExitStack()
        for sweep in range(BURN_IN + SAMPLES):
            seat = frugal(_swept(context.broadcast(now), sweep, buckets))  # at most 2 * HEAVY numbers of words
            met = state.withColumn("kind", F.lit(0)).unionByName(sent.select("kind", "route", "chunk", "a"), allowMissingColumns=True)
            met = met.repartition(buckets, "route").sortWithinPartitions("route", F.desc("kind"), "chunk").mapInArrow(seat, _BUCKET)
            following = ExitStack()
            with before:  # a sweep's table goes when the next one is written
                swept = following.enter_context(staged_for(met, "sweep")) if sweep + 1 < BURN_IN + SAMPLES else staged(met, "sweep")
            before = following
            state, sent = swept.where("kind = 4"), totals(swept.where("kind = 3").select(*_BLOCK_NAMES))
            (change,), (heavy_change,) = _over_buckets(state, "totals"), _over_buckets(state, "heavy_tables") if len(heavy) else (np.zeros(0, np.int64),)
            now = replace(shared, tables=shared.tables + int(change.sum()), heavy_tables=shared.heavy_tables + heavy_change)
            if sweep >= BURN_IN:
                samples.append((now.tables, now.heavy_tables))
    model = context.broadcast(replace(shared, samples=tuple(samples)))
    sent = totals(asked.unionByName(state.mapInArrow(frugal(_moved(buckets)), _BLOCK)))
    packed = ["words", "pair_word", "pair_context", "pair_count", "pair_tokens", "chunks", "token_chunk", "token_text"]
    met = counted.select("kind", "route", "chunk", *packed).unionByName(sent, allowMissingColumns=True)
    met = met.unionByName(state.select("kind", "route", "e"), allowMissingColumns=True)
    met = met.repartition(buckets, "route").sortWithinPartitions("route", F.desc("kind"), "chunk")
    sums = met.mapInArrow(frugal(_scored(model)), _BLOCK)
    heads = rows.where("kind = 1").select(*_BLOCK_NAMES)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)
    met = heads.unionByName(sums).repartition(parts, "chunk").sortWithinPartitions("chunk", "kind")
    return met.mapInArrow(frugal(_met(shared.tokens)), _SCORES)


def perplexities(scores: DataFrame) -> DataFrame:
    """held_out, tokens, and perplexity by the base and by the model."""
    per_token = [F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens")) for name in ("base_score", "score")]
    return scores.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), *(p.alias(n) for p, n in zip(per_token, ("base_perplexity", "perplexity"), strict=True)))
