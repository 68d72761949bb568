"""What a worker holds beside the Java heap is bounded by texts at once and words remembered."""

import numpy as np
import pyarrow as pa

from millrace.llm import batches, langid, tokens, toxicity


def test_few_texts_are_worked_on_at_once():
    batch = pa.record_batch({"text": ["x"] * 1000})
    assert [p.num_rows for p in batches._pieces(batch, 0)] == [batches.ROWS] * 2
    for most in (toxicity.TEXTS, langid.TEXTS):
        parts = list(batches._pieces(batch, 0, most))
        assert max(p.num_rows for p in parts) <= batches.ROWS // 2
        assert sum(p.num_rows for p in parts) == 1000


def test_a_table_remembers_few_words_and_forgets_no_result():
    table = tokens.Table(lambda words: np.array([[float(w)] for w in words]), 1, words=tokens.FEW_WORDS)
    at_most = 0
    for start in range(0, 400_000, 20_000):
        text = [str(i) for i in (0, *range(start, start + 20_000))]
        values, places, ends = table.rows([text])
        np.testing.assert_array_equal(values[places, 0], np.array(text, np.float32))
        at_most = max(at_most, len(table.memo) + len(table.memo.old))
    assert at_most <= 2 * (tokens.FEW_WORDS + 20_001) < 200_000
