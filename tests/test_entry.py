import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["cell_id", "cell_region", "cell_radio_tech"]


def test_every_query_matches_its_oracle(spark):
    # the corpus queries have tests of their own beside their operators
    res = compare(spark, SF, log=lambda *_: None, queries=E._QUERIES)
    bad = {k: v for k, v in res.items() if v != "ok"}
    assert set(res) == set(E._QUERIES) and not bad, bad
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_corpus_subpackage(monkeypatch):
    """The other queries stay registered where the subpackage or its pipeline is missing."""
    monkeypatch.setitem(sys.modules, "cellscope.llm", None)
    assert set(E.queries()) == set(E._QUERIES) and set(E.oracle_sql()) == set(E._QUERIES)
