"""Rows that repeat id and text are one document to line dedup, however many."""

import pytest

from tessella.llm import linededup

TEXT = "\n".join(f"line {k} of some words here and there" for k in range(40))


@pytest.mark.parametrize("copies", [2, 3, 1000])
def test_repeated_rows(spark, copies):
    rows = [(1, TEXT)] * copies + [(2, f"a line of its own\n{TEXT}"), (None, None), (3, "")]
    out = linededup.remove_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string"), 30)
    found = {}
    for r in out.collect():
        found.setdefault((r.doc_id, r.text), []).append(r._removed)
    assert found == {(1, TEXT): [[]] * copies, (2, "a line of its own"): [list(range(1, 41))], (None, None): [[]], (3, ""): [[]]}


def test_ranks_are_dense_and_in_order(spark):
    named = spark.createDataFrame([(k, k % 50 // 2, k % 50 % 2 - 1) for k in range(120)] + [(999, 99, 99)], "id long, a long, b long")
    got = {r.id: r.r for r in linededup._ranked(named, ["id"]).collect()}
    assert got == {k: k % 50 + 1 for k in range(120)}
