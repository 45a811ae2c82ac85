"""Cases that a cap, a prefix or a size switch would lose."""

import random

from tenurekit.llm import decontam, lang_id, pii_weak, quality_fm

PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def test_span_mode_does_not_depend_on_the_number_of_parts(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    bench = [(1, PASSAGE)] + [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 40)))) for i in range(2, 40)]
    docs = [(1, f"start {PASSAGE} end"), (2, "clean text"), (3, None), (4, "")]
    docs += [(10 + i, " a ".join(rnd.choice(bench)[1] for _ in range(3))) for i in range(20)]
    b = spark.createDataFrame(bench, "item_id long, text string")
    d = spark.createDataFrame([(*r, [1], "x") for r in docs], "doc_id long, text string, _hits array<int>, _n_words string").repartition(3)
    one = decontam.decontaminate(d, b, mode="span")
    assert one.columns == d.columns
    one = {r.doc_id: r.text for r in one.collect()}
    assert one[1] == "start  end" and one[2] == "clean text" and one[3] is None and one[4] == ""
    for size in (2, 50):
        got = decontam.decontaminate(d, b, mode="span", max_part_windows=size)
        assert {r.doc_id: r.text for r in got.collect()} == one
        assert {r.doc_id for r in decontam.decontaminate(d, b, max_part_windows=size).collect()} == {2, 3, 4}


def test_language_with_two_short_rows_is_found_again(spark):
    english = ["the cat sat on the mat and the dog is in the house of the man"] * 50
    finnish = ["hyvää huomenta kaikille ystäville", "kissa istuu pöydän alla yksin"]
    rows = [(i, t, "en") for i, t in enumerate(english)] + [(100 + i, t, "fi") for i, t in enumerate(finnish)]
    model = lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(1, "huomenta kissa yksin"), (2, "kaikille pöydän alla"), (3, "the man and the dog")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert got[1][0] == got[2][0] == "fi" and got[3][0] == "en" and min(got[1][1], got[2][1]) > 0.9


def test_commonest_language_ties_by_name(spark):
    rows = [(1, "abcd", "zz"), (2, "efgh", "aa")]
    assert lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string")).commonest == "aa"


def test_filters_grow_with_the_kept_grams(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(200)), "en") for i in range(60)]
    model = lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert len(model.masks[0]) > lang_id.MIN_CELLS and model.false_rate.max() < 0.06


def test_long_quoted_value_is_redacted_whole(spark):
    value = "correct horse battery staple and then some more words that make this passphrase long"
    df = spark.createDataFrame([(1, f'password: "{value}" is it'), (2, f"my password = '{value}'\nnext line")], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in pii_weak.redact(df.withColumn("n_chars", df.doc_id)).collect()}
    assert "horse" not in texts[1] and "more words" not in texts[1] and texts[1].endswith(" is it")
    assert "horse" not in texts[2] and "more words" not in texts[2] and texts[2].endswith("next line")


def test_repeated_training_ids_count_once_and_alike(spark):
    rows = [(i, f"good text number {i} with words", i % 2) for i in range(40)]
    docs = [(i, t) for i, t, _ in rows for _ in range(3)] + [(0, "another text under the same id")]
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    a = quality_fm.train(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), labels, 40)
    b = quality_fm.train(spark.createDataFrame(docs[::-1], "doc_id long, text string").repartition(2), labels, 40)
    assert (a.w == b.w).all() and (a.v == b.v).all()


def test_redact_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "Mail anna@mail.example.com now", 30, "x", 5, [1]), (2, None, None, "y", 6, None)],
                               "doc_id long, text string, n_chars int, _pii_secret string, _pii_all int, `c 1` array<int>")
    got = pii_weak.redact(df)
    assert got.columns == df.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].text == "Mail [EMAIL] now" and rows[1].n_chars == 16 and (rows[1]._pii_secret, rows[1]._pii_all, rows[1]["c 1"]) == ("x", 5, [1])
    assert rows[2].text is None and (rows[2]._pii_secret, rows[2]._pii_all) == ("y", 6)
