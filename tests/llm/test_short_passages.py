"""Operator 4 on the benchmark's passages of over 50 words, which have fewer bytes than the contract's strings."""

import re

from shopcast.llm import suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_passages_of_over_50_words_by_width(spark):
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    items = [t for t in items if len(WORD.findall(t)) > 50]
    sizes = [len(t.encode()) for t in items]
    assert len(items) > 20 and max(sizes) < suffixes.WIDTH
    rows = []
    for k, t in enumerate(items):  # each twice, between words of the row's own
        for copy, (a, b) in enumerate(("<>", "[]")):
            own = " ".join(f"{k * 7919 + j * 104729 + copy * 50:x}" for j in range(120))
            rows.append((2 * k + copy, f"{own}{a}{t}{b}{own[::-1]}"))
    long = items[0] + items[1]
    rows += [(1000, f"({long})"), (1001, f"{{{long}}}"), (1002, " ".join(f"{j * j:o}" for j in range(300)))]
    source = spark.createDataFrame(rows, "doc_id long, text string")

    def gone(width):
        return {r.doc_id: r.n_removed for r in suffixes.digest(source, width).collect()}

    at_contract, below = gone(suffixes.WIDTH), gone(min(sizes) // 8 * 8)
    assert len(long.encode()) >= suffixes.WIDTH
    assert at_contract == {i: len(long.encode()) if i in (1000, 1001) else 0 for i, _ in rows}
    assert all(below[i] == (0 if i == 1002 else len(long.encode()) if i >= 1000 else sizes[i // 2]) for i, _ in rows)
