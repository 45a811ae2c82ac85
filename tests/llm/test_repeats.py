"""Repeated rows and ids: the mix comes near its targets, ids with several
texts join their components, nothing is lost."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tenurekit.llm import mixing, near_dup, quality_rules
from tenurekit.llm import queries as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def oracle(sql, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def mixed(spark, rows, parts=7):
    return mixing.mix(spark.createDataFrame(rows, DOCS).repartition(parts)).drop("source")


CASES = {
    "one row a thousand times": [(1, "a b c", "en", "s", 1)] * 1000 + [(2, "a b c d", "en", "t", 1)] * 500,
    "half of a source under one id": [(7 if i % 2 else i + 10, "w " * 5, "en", "s", 1) for i in range(1200)] + [(i + 5000, "w " * 9, "en", "t", 1) for i in range(300)],
    "null ids": [(None, "w " * (i % 4), None, None, 1) for i in range(900)] + [(i, "w w", "en", "s", 1) for i in range(400)],
    "sizes apart": [(i, "w " * (1 + i % 90), "en", f"s{i % 4}", 1) for i in range(800)],
    "no words": [(i, None, "en", "s", 1) for i in range(5)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_mix_with_repeated_rows(spark, case):
    rows = CASES[case]
    got = mixed(spark, rows).collect()
    cols, want = oracle(Q.OP10_SQL, rows)
    key = lambda r: tuple(str(r[c]) for c in ("doc_id", "size", "copies", "taken", "source_size"))
    assert sorted(map(key, got)) == sorted(key(dict(zip(cols, r))) for r in want)
    by = {}
    for r in got:
        by.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    for (_, target), rs in by.items():
        assert abs(sum(r.taken for r in rs) - target) <= max(r.size for r in rs) / 2 + 1e-6
    again = sorted(map(key, mixed(spark, rows, 3).collect()))
    assert again == sorted(map(key, got))


def test_mix_samples_with_unequal_probabilities(spark):
    rows = [(i, "w " * (5 if i % 2 else 60), "en", "s", 1) for i in range(4000)] + [(i + 10_000, "w " * 30, "en", f"t{i % 3}", 1) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).filter("source = 's'").collect()
    base = min(r.copies for r in got)
    share = {n: sum(r.copies - base for r in got if r["size"] == n) / sum(r["size"] == n for r in got) for n in (5, 60)}
    assert share[5] > share[60] + 0.1 and 0 < share[60] < share[5] < 1  # shorter ones are likelier, none certain


def test_take_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, "s", 3, i, "c", "t", 1.5, [1], "x") for i in range(50)],
                               "doc_id long, source string, size long, _u long, copies string, target string, _v double, _slice array<int>, `a b` string")
    got = mixing.take(df)
    assert got.columns == ["doc_id", "source", "size", "_u", "_v", "_slice", "a b", "source_size", "target", "copies", "taken"]
    assert all(r._u == r.doc_id and r._v == 1.5 and r._slice == [1] and r["a b"] == "x" for r in got.collect())


def words(seed, n=30):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_an_id_with_two_texts_joins_their_components(spark):
    rows = [(1, words(1)), (5, words(1)), (5, words(2)), (9, words(2)), (9, words(3)), (12, words(3)), (20, words(4)), (21, words(4) + " end")]
    full = [(i, t, "en", "s", 1) for i, t in rows]
    got = near_dup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    cols, want = oracle(Q.OP4_SQL, full)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(want)
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 5: 1, 9: 1, 12: 1, 20: 20, 21: 20}


def test_an_id_that_stays_loses_no_text(spark):
    rows = [(5, words(1), 3, "b"), (5, words(2), 1, "a"), (5, words(1), 2, "c"), (6, words(1), 1, "z"), (7, None, 1, "n"), (None, words(1), 1, "q"), (None, words(1), 1, "q")]
    got = near_dup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, n_chars long, source string").repartition(4))
    assert got.columns == ["doc_id", "text", "n_chars", "source"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(5, words(1), 2, "c"), (5, words(2), 1, "a"), (7, None, 1, "n"), (None, words(1), 1, "q"), (None, words(1), 1, "q")]))


def test_pipeline_shingles_have_five_words(spark):
    """Texts at 0.8 and more on four-word shingles but below it on five-word ones both stay."""
    a = [f"v{i}" for i in range(44)]
    b = list(a)
    b[20] = "other"  # of 41 four-word shingles 4 differ (37 / 45), of 40 five-word ones 5 (35 / 45)
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
    assert [r.component_id for r in near_dup.components(df).orderBy("doc_id").collect()] == [1, 1]
    assert near_dup.drop_near_duplicates(df).count() == 2


def test_stop_words_judge_only_their_languages(spark):
    finnish = "hyvää huomenta kaikille ystäville joita tapasin eilen kaupungin torilla missä myytiin tuoretta kalaa leipää juustoa marjoja hunajaa kukkia sekä kauniita käsitöitä monelle iloiselle kävijälle"
    rows = [(1, finnish, "fi"), (2, finnish, "en"), (3, finnish, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept, r.failed_rules) for r in quality_rules.quality_report(df).collect()}
    assert got == {1: (True, ""), 2: (False, "few_stop_words"), 3: (False, "few_stop_words")}
    assert [r.doc_id for r in quality_rules.apply_rules(df).collect()] == [1]


def test_measures_are_not_pushed_into_the_filter(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en", 3)], "doc_id long, text string, lang string, _q_kept int")
    plan = quality_rules.apply_rules(df.drop("_q_kept"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and all("regexp" not in line and "xxhash64" not in line for line in plan.splitlines() if line.strip(" :+-").startswith("Filter"))
    assert F is not None


@pytest.mark.parametrize("block", [2, 7])
def test_large_buckets_in_blocks_lose_no_pair(spark, monkeypatch, block):
    """Near misses and links of one template, compared in blocks of a few members."""
    import random

    from .test_brute_force import brute_components, near_texts
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rnd, base = random.Random(9), [f"t{i}" for i in range(90)]
    rows = near_texts(5)
    for i in range(60):  # a template with 1 to 12 words changed: some pairs link, most nearly do
        words = list(base[: rnd.choice([70, 80, 90])])
        for _ in range(rnd.randint(1, 12)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        rows.append((5000 + i, " ".join(words)))
    got = near_dup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(rows)
