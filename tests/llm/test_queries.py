"""The registered queries and the pipeline over the small test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from fareloom.llm import queries
from fareloom.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are absent")


def text_of(rows, columns):
    return sorted(tuple(f"{r[c]:.10g}" if isinstance(r[c], float) else str(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    answer = connection.execute(ORACLES[name])
    columns = [column[0] for column in answer.description]
    wanted = [dict(zip(columns, row)) for row in answer.fetchall()]
    got = driver.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert text_of([row.asDict() for row in got.collect()], columns) == text_of(wanted, columns)


def test_all_are_registered():
    names = driver.queries().keys()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and queries.QUERIES.keys() <= names


def test_held_out_labels_and_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    predicted = driver.queries()["op6_language_id"](spark, FOLDER).filter("held_out").join(docs, "doc_id")
    rows = predicted.select("lang", "lang_pred").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_held_out_quality(spark):
    """Documents of the held-out fold against their labels, on a table with some hundreds of them."""
    folder = FOLDER.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("quality IS NOT NULL")
    scored = driver.queries()["op5_quality_classifier"](spark, folder).filter("held_out").join(labels, "doc_id")
    rows = scored.select("quality", "predicted", "score").collect()
    assert len(rows) > 50 and sum(r.quality == r.predicted for r in rows) >= 0.9 * len(rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.95 * len(good) * len(bad)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, columns = docs, docs.columns
    counts = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, kept, FOLDER)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == columns
            kept = spark.createDataFrame(kept.collect(), docs.schema)
            counts.append(kept.count())
    assert counts[0] < docs.count() and counts[1] < counts[0] and counts[2] == counts[1]
    pieces = kept.groupBy("sequence_id").sum("length").toDF("s", "n")
    assert pieces.filter("n > 4096").count() == 0
    direct = corpus_pipeline.run(spark, FOLDER)
    fields = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, direct.select(fields).collect())) == sorted(map(tuple, kept.select(fields).collect()))


def test_one_row_of_each_class_stays(make_docs, prose):
    """Null ids, shared ids, exact and near copies: by brute force over five-word shingles."""
    base, other = prose(1, 200), prose(2, 200)
    near = base + " tail"
    rows = [(None, base), (None, base), (5, near), (5, other), (5, other + " x"), (6, other), (7, prose(7, 50)), (None, prose(8, 50))]
    rows += [(9, None), (9, ""), (None, "a b"), (3, "a b")]
    docs = make_docs(rows).withColumnRenamed("score", "stage class")
    kept = corpus_pipeline.one_of_each_class(docs.sparkSession, docs, FOLDER)
    assert kept.columns == docs.columns

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, component = [shingles(t) for _, t in rows], list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    component[i] = component[j] = min(component[i], component[j])
    wanted = []
    for c in set(component):
        wanted.append(min((k is None, k or 0, k, t) for (k, t), own in zip(rows, component) if own == c)[2])
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, wanted))
    texts = [r.text for r in kept.collect()]
    assert sum(t in (base, near) for t in texts) == 1 and sum(bool(t) and t.startswith(other) for t in texts) == 1
