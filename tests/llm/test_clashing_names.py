"""Columns named like those that operators add must pass through the pipeline's stages."""
from pyspark.sql import functions as F

from cellscope.llm import decontam, line_dedup, near_dup, passages

CLASH = ["_id", "_hash", "_gone", "_rest", "_left", "_row", "_kept", "_kept_id", "_doc", "_text", "_key", "r_id", "r_hash", "l", "k",
         "h", "w", "item_id", "seed", "at", "component_id", "a.b"]


def test_stages_keep_columns_of_any_name(spark, docs_of, words):
    block = "\n".join(words(12, 50 + i) for i in range(5))
    rows = [(1, words(60, 1)), (2, words(60, 2) + "\n" + block), (3, block + "\n" + words(60, 3)), (4, words(60, 1)), (None, words(9, 4)), (5, None)]
    plain = docs_of(rows)
    clash = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASH})
    benchmark = spark.createDataFrame([(1, words(60, 2))], "item_id long, text string")
    for stage in (line_dedup.dedup, passages.dedup, near_dup.keep_one, lambda d: decontam.clean(d, benchmark)):
        got, want = stage(clash), stage(plain)
        assert got.columns == clash.columns
        assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, want.collect()))
        for r in got.collect():
            assert all(r[c] == c + ("-" if r["doc_id"] is None else str(r["doc_id"])) for c in CLASH)


def test_one_id_with_several_texts_and_clashing_names(spark, docs_of, words):
    rows = [(1, words(40, 1)), (1, words(40, 2)), (2, words(40, 1)), (3, words(40, 3))]
    clash = docs_of(rows).withColumns({c: F.lit(c) for c in CLASH})
    assert sorted((r["doc_id"], r["text"]) for r in near_dup.keep_one(clash).collect()) == sorted([rows[0], rows[1], rows[3]])


def test_number_characters_are_no_letters(spark, docs_of, words):
    from cellscope.llm import langid

    rows = [(i, words(30, i), "en") for i in range(12)] + [(100 + k, t, None) for k, t in enumerate(["½", "²", "Ⅷ", "①②", "٣ 4", "_ - 7"])]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.train_and_identify(docs_of(rows)).collect()}
    assert all(got[100 + k] == ("und", 0.0) for k in range(6)) and got[1][0] == "en"


def test_models_do_not_depend_on_the_order_of_an_ids_texts(spark, docs_of, words):
    import numpy as np

    from cellscope.llm import mil_quality, rules

    rows = [(i, words(50, i)) for i in range(60)] + [(i, " ".join(w.upper() + "##" for w in words(50, 900 + i).split())) for i in range(60, 120)]
    rows += [(i, words(30, 500 + i)) for i in range(0, 120, 3)]
    labels = spark.createDataFrame([(i, 1 if i < 60 else 0, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    one, two = docs_of(rows), docs_of(rows[::-1], partitions=5)
    a, b = (mil_quality.fit(d, labels, epochs=2) if "epochs" in mil_quality.fit_bags.__code__.co_varnames else mil_quality.fit(d, labels) for d in (one, two))
    assert all(np.array_equal(x, y) for x, y in zip(a.__dict__.values(), b.__dict__.values()) if isinstance(x, np.ndarray))
    assert rules.fit(one, labels) == rules.fit(two, labels)
