"""Exact deduplication against a brute-force version, and its plan."""

import hashlib
import random
import re

import pytest

from llm_fixtures import documents  # noqa: F401  (fixture)
from raresift.llm import exact_dedup
from raresift.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def digest(text):
    return hashlib.sha256(WHITE.sub(" ", text or "").encode()).hexdigest()


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(digest(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[digest(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, digest(t)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def awkward():
    rng = random.Random(5)
    rows = [(i, f"text {i} " * rng.randint(1, 9)) for i in range(300)]
    rows += [(1000 + i, "one  hot\ttext") for i in range(400)] + [(2000 + i, "one hot text") for i in range(50)]
    rows += [(3000 + i, f"text {rng.randint(0, 299)} ") for i in range(200)]
    rows += [(4000, None), (4001, ""), (4002, " "), (4003, "\n\x0b\x0c\r\t "), (None, "only null id"), (None, "text 7 "), (5, "text 5 "), (5, "text 5 ")]
    rows += [(5000, "wide space"), (5001, "wide space"), (5002, "long " * 700_000), (5003, "long  " * 700_000)]
    return rows


@pytest.mark.parametrize("bound", [None, 0])
def test_every_row_against_brute_force(spark, monkeypatch, bound):
    if bound is not None:  # without a filter all rows are possible repeats
        monkeypatch.setattr(exact_dedup, "BROADCAST_BLOCKS", bound)
    rows = awkward()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(exact_duplicates(docs)) == expected(rows)


def test_cold_groups_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MOST_HOT", 3)
    rows = awkward()
    assert got(exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_rows_and_columns_survive(spark, documents):  # noqa: F811
    renamed = documents.withColumnsRenamed({"kept": "digest", "component": "block", "part": "id", "lang": "possible"})
    rows = [tuple(r) for r in renamed.collect()]
    left = [tuple(r) for r in drop_exact_duplicates(renamed).collect()]
    assert len(left) == len({digest(r[1]) for r in rows})
    assert set(left) <= set(rows)
    for r in left:
        ids = [x[0] for x in rows if digest(x[1]) == digest(r[1])]
        assert r[0] == min((x for x in ids if x is not None), default=None)


def test_one_row_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a  b", "x"), (2, "a b", "y"), (3, "c", "z")], "doc_id long, text string, row string")
    assert sorted((r.doc_id, r.row) for r in drop_exact_duplicates(docs).collect()) == [(1, "x"), (3, "z")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(docs).collect() == [] and drop_exact_duplicates(docs).collect() == []


def test_rows_without_an_equal_are_not_shuffled(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    plan = drop_exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Union")[1].split("+- ")[0:4]
    assert "Python" not in plan and "Arrow" not in plan
    assert not any("Exchange hashpartitioning" in x for x in first)


def test_the_filter_misses_nothing_and_passes_few(spark):
    n = 20_000
    rows = spark.range(n).selectExpr("id", "unhex(sha2(cast(if(id % 10 = 0, id - id % 20, id) as string), 256)) AS digest")
    tested, _ = exact_dedup._tested(rows, n)
    counts = {(r.repeat, r.possible): r["count"] for r in tested.selectExpr("id % 10 = 0 AS repeat", "possible").groupBy("repeat", "possible").count().collect()}
    assert counts.get((True, False), 0) == 0 and counts[True, True] == n // 10
    assert counts.get((False, True), 0) < n // 100
