import gc
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from obslake.llm import packing


def test_encoder_equals_the_tokenizer():
    path = packing.tokenizer_path()
    encoder, plain = packing.Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(1)
    signs = [" ", "\n", "a", "é", "b.", ",", "<|endoftext|>", "'s", "12", "\t", "中", " ", "!?", "\r", "\x1c", "́", "🙂"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(3000)]
    for text in texts:
        expected = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text) == expected, repr(text)


@pytest.mark.parametrize("seed", range(5))
def test_plan_fills_every_rank_once(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 20), rng.randint(1, 60)]) for _ in range(rng.choice([3, 400])))
    places: dict[int, list] = {}
    ranks = Counter()
    for length, first, pieces, sequence, each, offset in packing.plan(dict(counts), 60):
        assert first == ranks[length]
        ranks[length] += pieces
        for i in range(pieces):
            places.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
    assert ranks == counts
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 60 and sum(3 * length > 60 for _, length in parts) <= 2
    total = sum(length * n for length, n in counts.items())
    assert len(places) <= 1.25 * max(-(-total // 60), sum(n for length, n in counts.items() if length > 30)) + 2


def test_pieces_and_places(corpus):
    rows = packing.packed_documents(corpus).toPandas()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = corpus.select("doc_id", "text").collect()
    expected = Counter()
    for row in texts:
        ids = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            expected[row["doc_id"], piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = Counter((None if r[0] != r[0] else int(r[0]), *map(int, r[1:])) for r in rows[key].itertuples(index=False))
    assert found == expected
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert (group.offset == group.length.cumsum() - group.length).all() and group.length.sum() <= 2048


def test_sequences_hold_the_ids(corpus):
    tokens = packing.tokenised(corpus).agg({"length": "sum"}).first()[0]
    rows = packing.sequences(corpus).collect()
    assert sum(len(row["ids"]) for row in rows) == tokens and max(len(row["ids"]) for row in rows) <= 2048


def test_empty_table(nothing):
    assert packing.packed_documents(nothing).count() == 0


def test_an_encoder_goes_with_its_task(monkeypatch):
    class Frame:
        def mapInArrow(self, function, schema):
            return function

    monkeypatch.setattr(packing, "documents", lambda docs: Frame())
    pieces = packing.tokenised(None)
    gc.collect()
    gc.disable()
    try:
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
        assert sum(part.num_rows for part in pieces(iter([batch]))) == 2
        assert not [x for x in gc.get_objects() if type(x) is packing.Encoder]
    finally:
        gc.enable()


def test_runs_are_read_without_python_workers(spark):
    pieces = spark.createDataFrame([(1, 0, 5, 7)], "doc_id long, start long, length long, ids_crc32 long")
    from_list = spark.createDataFrame([(1,)], "n long")
    seen = [rows._jdf.queryExecution().toString() for rows in (packing.pack(pieces.localCheckpoint()), from_list)]
    assert [text.count("run_length") > 0 for text in seen] == [True, False]
    assert "LocalRelation" in seen[0] and "LocalRelation" not in seen[1]
