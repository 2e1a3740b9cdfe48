import corpus_pipeline as P
from helpers import SF, clashing, components, docs, odd_rows
from test_text_operators import _line_dedup

from sluice.llm.decontam import normalised


def test_stages_match_brute_force(spark):
    """Language id keeps all of these documents; the stages after it are told by plain Python."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = _line_dedup([(r.doc_id, r.text) for r in rows])
    own = [(r.doc_id, t) for r, t in zip(rows, kept) if t or not r.text]
    label = components([t for _, t in own])
    own = [x for i, x in enumerate(own) if label[i] == i]
    own = {d for d, t in own if not any(i in normalised(t) for i in items)}
    got = P.run(spark, SF).collect()
    assert {r.doc_id for r in got} == own
    assert sum(r.length for r in got) <= 2048 * len({r.sequence_id for r in got})


def test_stages_keep_columns_and_survive_odd_rows(spark):
    d = clashing(docs(spark, odd_rows() + [(30 + i, f"line {i}\nsame one\nsame two\nsame three", "en", "s", 9) for i in range(4)]))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == d.columns, name
        d = out
    left = {r.doc_id: r.text for r in d.collect()}
    assert 1 not in left and 2 not in left and 9 not in left and left[7] is not None
    assert left[31] == "line 31\nsame one\nsame two\nsame three".split("\n")[0].replace("31", "1")
    assert P.packing(spark, d, SF).count() > 0


def test_one_row_of_a_group_stays(spark):
    rows = [(5, "a b c d e f", "en", "s", 1), (5, "a b c d e f", "en", "s", 1), (3, "A b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (8, "z", "en", "s", 1), (9, "", "en", "s", 1), (9, "", "en", "s", 1)]
    got = P.near_duplicates(spark, docs(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(3, "A b c d e f"), (8, "z"), (9, ""), (9, "")]


def test_empty_table_passes_through(spark):
    d = docs(spark, [])
    for _, stage in P.STAGES:
        d = stage(spark, d, SF)
    assert d.collect() == []
