"""What operator 6 sends through the shuffle."""

import contextlib
import io
import re

import numpy as np
import pyarrow as pa

from shopcast.llm import backoff
from shopcast.llm.words import Words, buffers


def test_only_ngrams_of_repeated_parts_are_sent():
    w = Words(*buffers(pa.array(["a b c x", None, "y a b c", "b c y a q", "a b"])))
    ends = {"a b c": 2, "b c x": 3, "y a b": 6, "b c y": 10}
    pairs = np.zeros(len(w.start))
    for last, n in ((1, 3), (2, 3), (3, 1), (5, 2), (6, 3), (7, 3), (9, 3), (10, 1), (11, 2), (12, 1), (14, 3)):
        pairs[last] = n
    sent = backoff._grams(w, 3, [np.ones(len(w.start)), pairs], 2)[1].tolist()
    assert sent == [2, 6, 7] and ends["b c x"] not in sent and ends["b c y"] not in sent


def test_texts_are_sent_once_and_compressed(spark, monkeypatch):
    seen, keep = [], backoff.table
    monkeypatch.setattr(backoff, "table", lambda df, name: seen.append(df) or keep(df, name))
    monkeypatch.setattr(backoff, "GROUP_BYTES", 3000)
    rows = [(i, f"the same few words of text number {i} " * 10) for i in range(40)]
    got = backoff.backoff_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    assert got.count() == 40
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            seen[0].select("*").explain("formatted")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert not re.search(r"Exchange\nInput \[\d+\]: \[[^\]]*\bt#", out.getvalue())


def test_groups_hold_every_row_in_order():
    rows = [(None, "x" * 50), (1, None), (2, ""), (3, "y" * 900), (4, "z"), (4, "z")] * 7
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()),
                                           pa.array([r[1] for r in part], pa.string())], ["id", "t"]) for part in (rows[:9], rows[9:9], rows[9:])]
    groups = list(backoff._deal(1000)(iter(batches)))
    back = [tuple(x.values()) for g in groups for x in backoff._rows(pa.Table.from_batches([g])).to_pylist()]
    assert back == rows and len(groups) > 5
    again = list(backoff._deal(1000)(iter(batches)))
    assert [g.to_pydict() for g in groups] == [g.to_pydict() for g in again]
