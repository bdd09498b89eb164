import pytest

from llm.cases import frame, odd_rows
from shopgrain.llm import token_files as T


@pytest.mark.parametrize("block", [2, 6, 1 << 20])
def test_blocks_of_any_size_give_the_same_counts(spark, block):
    rows = [r for r in odd_rows() if len(r[1] or "") < 1000]
    rows += [(100 + i, "w " * (i % 9), "en", "s", 0) for i in range(60)]
    got = T.count_document_tokens(frame(spark, rows).coalesce(2), block=block).collect()
    want = [(r[0], len((r[1] or "").encode().split())) for r in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_spans_of_blocks(spark):
    rows = [(0, b, 1 + b % 3, [1] * (2 + b % 3)) for b in range(50)]
    scanned = spark.createDataFrame([(str(f), b, s, n) for f, b, s, n in rows],
                                    "file string, block bigint, separators bigint, lengths array<bigint>")
    one = T.document_lengths(scanned, span=4)
    assert one.exceptAll(T.document_lengths(scanned, span=1000)).count() == 0
    assert one.count() == sum(r[2] for r in rows) + 1


def test_long_text_and_empty_table(spark):
    got = {r["doc_id"]: r["n_tokens"] for r in T.count_document_tokens(frame(spark)).collect()}
    assert got[6] == 30_000 and got[4] == 0 and got[3] == 0
    assert T.count_document_tokens(frame(spark, [])).count() == 0
