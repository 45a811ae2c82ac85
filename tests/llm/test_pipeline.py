"""The pipeline against the operators' independent oracles, chained in DuckDB,
with redaction redone in Python."""

import os

import duckdb
import pytest

import corpus_pipeline
from check_oracles import digest
from tenurekit.llm import pii_weak
from tenurekit.llm import queries as Q

SF = "/root/testdata/sf0.01"


def redacted(text, spans):
    """Spans 'kind:start:end' cut out of the text, overlaps merged under the first one's kind."""
    if not spans:
        return text
    parts, upto = [], 0
    for s, e, k in sorted((int(x.split(":")[1]), int(x.split(":")[2]), f"[{x.split(':')[0].upper()}]") for x in spans.split(",")):
        if s >= upto:
            parts += [text[upto:s], k]
        upto = max(upto, e)
    return "".join([*parts, text[upto:]])


#: the near-duplicate stage takes five words, the contract's query four
FIVE_WORDS = Q.ORACLES["op4_near_dup"].replace("list_slice(w, i, i + 3)", "list_slice(w, i, i + 4)").replace("len(w) - 3", "len(w) - 4")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_pipeline_equals_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
    con.execute(f"CREATE TABLE documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    before = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    counts = []
    assert FIVE_WORDS.count("len(w) - 4") == 1 and "i + 4" in FIVE_WORDS
    for sql, keep in ((Q.ORACLES["op1_quality_rules"], "kept"), (FIVE_WORDS, "kept"), (Q.ORACLES["op7_decontamination"], "NOT contaminated")):
        con.execute(f"CREATE TABLE ids AS SELECT doc_id FROM ({sql}) WHERE {keep}")
        con.execute("CREATE OR REPLACE TABLE documents AS SELECT d.* FROM documents d SEMI JOIN ids USING (doc_id)")
        con.execute("DROP TABLE ids")
        counts.append(con.execute("SELECT count(*) FROM documents").fetchone()[0])
    assert before > counts[0] > counts[1] > counts[2] > 0

    rows = con.execute("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spans = {r.doc_id: r.spans for r in pii_weak.find_personal_data(docs).collect()}
    assert any(spans.values())
    texts = [(i, redacted(t, spans[i])) for i, t, *_ in rows]
    con.execute("CREATE TABLE redacted (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO redacted VALUES (?, ?)", texts)
    con.execute("CREATE OR REPLACE TABLE documents AS SELECT d.doc_id, r.text, lang, source, n_chars FROM documents d JOIN redacted r USING (doc_id)")
    cur = con.execute(f"""SELECT doc_id, r.text, x.size, x.source_size, x.target, x.copies, x.taken, unnest(range(1, x.copies + 1)) AS copy
                          FROM ({Q.ORACLES['op10_mixing']}) x JOIN redacted r USING (doc_id)""")
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()

    got = corpus_pipeline.run(spark, SF).drop("source")
    rows = got.collect()
    assert digest(got.columns, [tuple(r) for r in rows]) == digest(cols, want)
    # the decisions have taken effect: nothing untaken is left, and some documents stand twice
    left = {r.doc_id for r in rows}
    assert len(left) < len(texts) and all(r.copies >= r.copy >= 1 for r in rows) and any(r.copy == 2 for r in rows)


def test_mix_stage_repeats_what_it_takes(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 40), "en", f"s{i % 3}", 1) for i in range(600)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mix(spark, docs, "").collect()
    assert all(1 <= r.copy <= r.copies for r in got)
    assert sum(r.size for r in got) == sum(r.taken for r in got if r.copy == 1)
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)
