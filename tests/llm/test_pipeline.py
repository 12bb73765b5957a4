"""The corpus pipeline: every stage against what it should do to its own input, then the run."""
import random

import pytest

import corpus_pipeline
from cellscope.llm import queries
from test_lines_and_leaks import brute_leaks, brute_lines
from test_near_dup import brute as brute_components


@pytest.fixture
def corpus(spark, words, tmp_path):
    """A folder with documents, labels and benchmark: good and junk documents, copies, repeated
    lines, benchmark passages, odd rows."""
    rng = random.Random(21)
    prose = lambda n, s: "\n".join(words(12, 1000 * s + k).capitalize() + "." for k in range(n))
    rows = [(i, prose(rng.randint(4, 9), i)) for i in range(150)]
    junk = [(200 + i, " ".join(f"{w.upper()}!!" for w in words(80, 7000 + i).split())) for i in range(50)]
    copies = []
    for i in range(20):
        w = rows[i][1].split(" ")
        w[3] = "changed"
        copies.append((300 + i, " ".join(w)))
    item = [(k, words(30, 9000 + k)) for k in range(4)]
    leaks = [(400 + i, f"{prose(3, 500 + i)}\n{item[i % 4][1]}\n{prose(2, 600 + i)}") for i in range(8)]
    shared = [(500 + i, f"{words(20, 800 + i)}\n{prose(4, 77)}\n{words(20, 900 + i)}") for i in range(6)]
    odd = [(601, None), (602, ""), (603, "short"), (None, prose(3, 611)), (604, prose(3, 612)), (604, prose(3, 612))]
    docs = rows + junk + copies + leaks + shared + odd
    labels = [(i, 1, 0) for i, _ in rows[:120]] + [(i, 0, 0) for i, _ in junk[:40]]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(item, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), item


def test_stages_and_run(spark, corpus):
    folder, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    before = rows(docs)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = f"{folder}/out-{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name == "packing":
            break
        after = rows(out)
        assert out.columns == columns
        if name == "quality":
            gone = {d for d, _ in before} - {d for d, _ in after}
            assert {d for d in gone if d is not None and d < 150} == set()
            assert len([d for d in gone if d is not None and 200 <= d < 250]) >= 48
        elif name == "lines":
            assert sorted(map(str, after)) == sorted(map(str, [(d, t) for d, t, _ in brute_lines(before)]))
        elif name == "near_duplicates":
            named = [(d, t) for d, t in before if d is not None]
            want = {d for d, (_, c) in brute_components(named).items() if c == d}
            assert sorted(d for d, _ in after if d is not None) == sorted(want)
            assert len([1 for d, _ in after if d is None]) == len([1 for d, _ in before if d is None])
        else:
            held = {d for d, _ in brute_leaks(before, item)}
            assert sorted(map(str, after)) == sorted(str(r) for r in before if r[0] not in held)
            assert held and all(400 <= d < 408 for d in held)
        docs, before = out, after
    pieces = out.collect()
    assert {r["doc_id"] for r in pieces} == {d for d, _ in before}
    assert all(len(r["ids"]) == r["length"] for r in pieces)
    # run() chains the same stages
    again = corpus_pipeline.run(spark, folder)
    key = lambda r: (r["doc_id"] or -1, r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, again.collect())) == sorted(map(key, pieces))


def test_pipeline_on_empty_tables(spark, corpus, tmp_path):
    folder, _ = corpus
    empty = str(tmp_path / "none")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_registered_queries():
    import __spark_entry__ as E

    names = set(E.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(cur.fetchall())
