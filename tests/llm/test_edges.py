"""Every dealt query and stage on nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns."""


import pytest

import corpus_pipeline
from check_oracles import digest
from tenurekit.llm import queries as Q

LONG = " ".join(f"word{i % 700} and {i}" for i in range(30_000))
ROWS = [
    (1, "The cat sat on the mat and the dog is in the house of the man that was with it for a long day.", "en", "a", 10),
    (1, "The cat sat on the mat and the dog is in the house of the man that was with it for a long day.", "en", "a", 10),
    (2, "The cat sat on the mat and the dog is in the house of the man that was with it for a long day.", "en", None, None),
    (3, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \n\t ", None, "b", 4),
    (None, "Mail anna@mail.example.com or +1 (555) 123-4567 from 10.0.0.255 now, card 4111 1111 1111 1111.", "en", "a", 5),
    (7, LONG, "en", "c", len(LONG)),
    (8, "Ärger über Öl: 1.2.3.4 und 999.1.1.1 sind Adressen\nund password=abc12345def6789 ist geheim", "de", "c", None),
    (9, "12345 !!! ###", None, "c", 13),
    (20, "a a a a a a a a a a a a a a a a a a a a a a a a", "fr", "z", 47),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, path, rows=ROWS, extra=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("n_words", "size", "kept", "component_id", "spans", "labels", "score", "id", "key", "taken", "learn", "chunk", "shard", "y"):
            df = df.selectExpr("*", f"'x' AS {c}")
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "the dog is in the house of the man that was"), (2, None), (3, ""), (4, "öl: 1"), (5, "öl: 1")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (9, 0, 0), (20, 0, None), (20, None, 0), (None, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    pages = [(1, "u", None), (1, None, ""), (None, "u", "<p>"), (3, "u", "<article><p>One &amp; two three.<p>Four</article>" * (300 if rows else 1)), (4, "u", "no tags at all")]
    spark.createDataFrame(pages if rows else [], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return str(path)


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("filled"))


@pytest.fixture(scope="module")
def shorter(spark, tmp_path_factory):
    """The same with a shorter long text: SQL copies the word list for each window."""
    rows = [r if r[0] != 7 else (7, LONG[:9000], *r[2:]) for r in ROWS]
    return write(spark, tmp_path_factory.mktemp("shorter"), rows)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), rows=[])


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_edges(spark, filled, name):
    df = Q.QUERIES[name](spark, filled)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name.startswith("op11_"):  # rows of groups of lang and source, not of documents
        assert {(r["lang"], r["source"]) for r in rows} <= {(r[2] or "", r[3] or "") for r in ROWS}
        return
    assert len(rows) == (5 if name.startswith("op9_") else len(ROWS))
    if name.startswith("op9_"):
        return
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    twins = [r for r in rows if r.doc_id == 1]
    assert twins[0] == twins[1]


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_empty_tables(spark, empty, name):
    assert Q.QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle_on_edges(spark, shorter, name):
    con = duck_on(shorter)
    got = Q.QUERIES[name](spark, shorter)
    cur = con.execute(Q.ORACLES[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(got.columns) == sorted(cols)
    assert digest(got.columns, rows) == digest(cols, want)


def duck_on(path):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
    return con


def test_pipeline_on_edges(spark, filled, empty):
    docs = spark.read.parquet(f"{filled}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, filled)
        assert out.columns == docs.columns, name
        out.collect()
    assert corpus_pipeline.run(spark, filled).count() >= 1
    assert corpus_pipeline.run(spark, empty).count() == 0


