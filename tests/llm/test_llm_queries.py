import os
import zlib

import numpy as np
import pytest
from oracle_check import compare, database

import corpus_pipeline
from ripplelog.llm import catalog, decontam, neardup

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in catalog.QUERIES if n != "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    assert compare(spark, database(FOLDER), name, FOLDER) is None


def test_stages_equal_their_operators_brute_forced(spark):
    """Each stage over what the one before returned, against plain Python."""
    from test_decontam import brute as hits
    from test_mixing import targets
    from test_neardup import brute as groups
    from test_records import whole

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert 4 <= len(steps) <= 5

    clean = steps["toxicity"](spark, docs, FOLDER)
    kept = sorted(map(tuple, clean.collect()))
    assert clean.columns == names and set(kept) <= set(map(tuple, docs.collect()))

    single = steps["near_duplicates"](spark, spark.createDataFrame(kept, docs.schema), FOLDER)
    rows = sorted(map(tuple, single.collect()))
    want = [kept[i] for i in sorted({c for _, c in groups([r[1] for r in kept])})]
    assert rows == want

    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = steps["decontamination"](spark, spark.createDataFrame(rows, docs.schema), FOLDER)
    items = [(n, t) for n, t in bench]
    got = sorted(map(tuple, left.collect()))
    marked = {r.id for r in decontam.find_test_text(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("contaminated").collect()}
    assert got == [r for r in rows if r[0] not in marked]
    for r in [r for r in rows if r[0] in marked][:3]:
        assert hits(r[1], items, decontam.WINDOW)[2]

    mixed = steps["mixing"](spark, spark.createDataFrame(got, docs.schema), FOLDER)
    assert mixed.columns == names
    copies = [tuple(r) for r in mixed.collect()]
    source = sorted({r[3] for r in got})
    sizes = [sum(len(r[1].split()) for r in got if r[3] == s) for s in source]
    goal = targets(sizes, [i % 3 + 1 for i in range(len(source))])
    for i, s in enumerate(source):
        assert abs(sum(len(r[1].split()) for r in copies if r[3] == s) - goal[i]) <= 1

    table = steps["token_records"](spark, spark.createDataFrame(copies, docs.schema), FOLDER)
    ids = [np.array([*x, 2], "<u4") for x in whole([r[1] for r in copies])]
    want = sorted((r[0], len(x), zlib.crc32(x.tobytes())) for r, x in zip(copies, ids))
    rows = sorted(table.collect(), key=lambda r: r.start)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]


def test_stages_take_odd_rows_and_empty_tables(spark, odd):
    """Nulls, blank and long texts, equal rows and clashing columns through each stage."""
    steps = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    every = rows(odd)
    for name in ("toxicity", "near_duplicates", "decontamination", "mixing"):
        got = steps[name](spark, odd, FOLDER)
        assert got.columns == odd.columns, name
        kept = rows(got)
        assert set(kept) <= set(every) or name == "mixing"
        if name == "near_duplicates":
            # "One two" is in three rows: one without an id, which takes no part, and two of one id
            assert kept == every
        if name == "decontamination":
            assert kept == every
        if name == "mixing":
            assert all((r[1] or "").split() for r in kept)
        empty = steps[name](spark, odd.limit(0), FOLDER)
        assert empty.columns == odd.columns and empty.collect() == [], name
    table = steps["token_records"](spark, odd, FOLDER)
    assert table.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(repr, (r.doc_id for r in table.collect()))) == sorted(repr(r[0]) for r in every)
    assert steps["token_records"](spark, odd.limit(0), FOLDER).collect() == []


def test_the_package_is_not_needed_by_the_rest():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(f"{top}/ripplelog"):
        for name in files:
            if name.endswith(".py") and "/llm" not in folder:
                assert "llm" not in open(f"{folder}/{name}").read()
    assert neardup.THRESHOLD == (75, 100)
