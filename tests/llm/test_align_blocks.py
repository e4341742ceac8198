"""Blocks of the tokenizer alignment are cut without copying the batch."""

import tracemalloc

import pyarrow as pa

from shopcast.llm import align as AL


def test_blocks_are_cut_without_a_copy_of_the_batch():
    texts = ["é" * 5000, None, "", "b" * (3 << 20)] + ["c" * 100_000] * 200
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "t"])
    tracemalloc.start()
    blocks = AL._blocks(iter([batch]))
    first = next(blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 << 20                                 # the batch has 23 MB
    got = [first, *blocks]
    assert [t for _, part in got for t in part] == texts
    assert [i for ids, _ in got for i in ids.to_pylist()] == list(range(len(texts)))
    assert all(len(part) == 1 or sum(len((t or "").encode()) for t in part) <= AL.BLOCK_BYTES for _, part in got)
