import pyarrow as pa

from obslake.llm import common, neardup, quality


def test_words_of_a_task_go_with_it():
    def features(batches):
        for batch in batches:
            quality.text_features(batch.column("text").to_pylist())
            neardup._hashes("four more words here")
            assert len(common._WORDS) >= 5
            yield batch

    batch = pa.RecordBatch.from_pydict({"text": ["one text", "of words"]})
    assert list(common.frugal(features)(iter([batch]))) == [batch]
    assert not common._WORDS
