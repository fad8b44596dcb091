import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from obslake.llm import tokenfile
from obslake.session import scratch_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenfile.tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def brute(tokenizer, rows):
    start, found = 0, []
    for doc_id, text in rows:
        ids = ids_of(tokenizer, text)
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(3)
    signs = ["the", "Él", "ÀB", "é", "́", "İ", "ß", "ﬁ", "Σς", "한", "一", "🙂", "'s", "'", "n't", "12", "٣", ",", ".", "!?", " ", " ", "  ", "\n", "\t", "\r\n",
             " ", " ", "\x1c", "\x85", "\x00", "‍", "<|endoftext|>", "<|startoftext|>", "<|", "#", "ǅ", "Ⅷ", "ª"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", "long " * 5000, "x" * 3000]
    parts = ["er", "ing", "th", "é", "ü", "qu", "x", "ß", "ŋ", "hy", "po", "Ž", "zz", "tion", "A", "ʼ", "b", "c", "ñ", "ö", "å"]
    texts += [" ".join("".join(rng.choices(parts, k=rng.randint(1, 9))) + rng.choice(["", ",", "!"]) for _ in range(2000)) for _ in range(20)]
    found = tokenfile.Encoder(tokenfile.tokenizer_path(), 500)
    for at in range(0, len(texts), 100):
        for text, code in zip(texts[at : at + 100], found.encode(texts[at : at + 100], 2), strict=True):
            assert np.frombuffer(code, "<u2").tolist() == ids_of(tokenizer, text), text


@pytest.mark.parametrize("sizes", [{}, {"length": 7, "batch": 3, "file_ids": 500}])
def test_documents_come_back(spark, corpus, tokenizer, sizes):
    folder = scratch_path(spark, "tokens-test")
    tokenfile.write_documents(corpus, folder, **sizes)
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    want = brute(tokenizer, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    found = tokenfile.read_documents(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    whole = tokenfile.read_documents(spark, folder).where("doc_id = 138").first()
    assert whole["ids"] == ids_of(tokenizer, dict(rows)[138])
    sequences = tokenfile.read_sequences(spark, folder).orderBy("file", "sequence").collect()
    length = sizes.get("length", 2048)
    assert all(len(r["ids"]) == len(r["mask"]) == length for r in sequences)
    files = {f.name: f for f in tokenfile.manifest(folder)}
    stream = {name: [i for r in sequences if r["file"] == name for i, m in zip(r["ids"], r["mask"]) if m] for name in files}
    assert [i for name in files for i in stream[name]] == [i for d in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for i in ids_of(tokenizer, d[1])]


def test_random_access_is_a_view_of_the_mapped_file(spark, tokenizer):
    docs = spark.createDataFrame([(n, f"word{n} light " * (n % 50)) for n in range(300)], "doc_id long, text string")
    folder = scratch_path(spark, "tokens-test")
    tokenfile.write_documents(docs.coalesce(1), folder, length=16, batch=4)
    for file in tokenfile.manifest(folder):
        source = tokenfile.TokenFile(folder, file)
        with pa.memory_map(tokenfile.located(f"{folder}/{file.name}")[1]) as mapped:
            batches = list(pa.ipc.open_stream(mapped))  # any reader of Arrow streams reads it
        every = [row for batch in batches for row in batch.to_pylist()]
        assert len(every) == len(source) > 20
        for number in random.Random(1).sample(range(len(source)), 20):
            ids, mask = source[number]
            assert not ids.flags.owndata and not ids.flags.writeable
            assert ids.tolist() == every[number]["ids"] and mask.to_pylist() == every[number]["mask"]
        with pytest.raises(IndexError):
            source[len(source)]


def test_only_committed_files_are_read(spark, tmp_path):
    path = str(tmp_path / "set")
    writer = tokenfile._Writer({"path": path, "width": 2}, overwrite=True)

    def attempt(part, attempt):
        out = tokenfile._FileWriter(path, f"{writer.prefix}-{attempt}", part, 8, 2, 100, 2)
        out.add(part, np.array([part, 2], "<u2").tobytes())
        out.end()
        return tokenfile.Task(out.files)

    lost, second, first = attempt(1, "a"), attempt(1, "b"), attempt(0, "a")
    writer.commit([second, None, first])
    assert [(f.part, f.start) for f in tokenfile.manifest(path)] == [(0, 0), (1, 2)]
    assert not (tmp_path / "set" / lost.files[0].name).exists()
    assert [r["ids"] for r in tokenfile.read_documents(spark, path).orderBy("start").collect()] == [[0, 2], [1, 2]]
    failed = tokenfile._Writer({"path": path, "width": 2}, overwrite=True)
    left = tokenfile._FileWriter(path, f"{failed.prefix}-a", 0, 8, 2, 100, 2)
    left.add(9, b"\x01\x00")
    left.end()
    failed.abort([])
    assert not (tmp_path / "set" / left.files[0].name).exists() and len(json.loads((tmp_path / "set" / "_manifest.json").read_text())) == 2
    later = tokenfile._Writer({"path": path, "width": 2}, overwrite=False)
    writer.prefix = later.prefix
    later.commit([attempt(0, "c")])
    assert [f.start for f in tokenfile.manifest(path)] == [0, 2, 4]


def test_no_documents(spark, nothing):
    assert tokenfile.placed(nothing).count() == 0
