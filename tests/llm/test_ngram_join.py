import numpy as np
import pytest
from helpers import SF, clashing, components, docs, family, odd_rows, shingles
from pyspark.sql import functions as F

from sluice.llm import ngram_join as N
from sluice.llm.queries import QUERIES


def _check(spark, texts, **kw):
    got = N.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **kw).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(components(texts)))
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("seed", range(2))
def test_families_match_brute_force(spark, seed):
    _check(spark, family(seed, 40) + family(seed + 10, 12, size=30, edits=2) + family(seed + 20, 10, size=9, edits=1))


def test_large_family_goes_through_pivots_and_cells(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL", 16)
    monkeypatch.setattr(N, "BEST", 1)
    _check(spark, family(5, 70, size=80, edits=9))


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_ngram_jaccard"](spark, SF).collect()}
    label = components([r.text for r in rows])
    assert got == {r.doc_id: (len(shingles(r.text)), rows[c].doc_id) for r, c in zip(rows, label)}


def test_odd_rows(spark):
    rows = odd_rows()
    got = N.jaccard_components(clashing(docs(spark))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_shingles == 0 and by[1].component_id == 1 and by[2].component_id == 2 and by[3].n_shingles == 0
    assert by[5].component_id == by[6].component_id == 5 and by[7].component_id == by[8].component_id == 7
    nameless = sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None and r.component_id is not None)
    assert nameless == [(1, 4)]  # the null id links with the rows of the same word


def test_empty_table(spark):
    assert N.jaccard_components(docs(spark, [])).collect() == []


def test_bands_cover_all_linked_sizes():
    bands = N.bands(5000, 80, 100)
    for a in (*range(4, 200), 399, 1000, 3999):
        for b in range(a, min(5000, a * 5 // 4) + 1):
            d = (20 * (a + b)) // 180
            if d:
                assert any(low <= a and b <= top and m - k >= d for low, top, m, k in bands)


def test_bands_fit_their_tag():
    assert len(N.bands(10**9, 80, 100)) <= 32


def test_hamming_is_a_lower_bound():
    draw = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(draw.integers(0, 1 << 63, draw.integers(1, 80)).astype(np.uint64))
        y = np.unique(np.concatenate([x[draw.random(len(x)) < 0.8], draw.integers(0, 1 << 63, draw.integers(1, 20)).astype(np.uint64)]))
        assert N.hamming(N.sketch(x), N.sketch(y)) <= len(np.setxor1d(x, y))


def test_components_of_a_chain(spark):
    from sluice.llm.components import connected_components

    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges, "a", "b").collect()
    assert {r.component for r in got} == {0} and sorted(r.node for r in got) == list(range(301))
