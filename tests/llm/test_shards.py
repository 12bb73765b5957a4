"""Contiguous shards against prefix sums over the sorted table."""
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellscope.llm import shards

OTHER = {"_part": 1, "_at": "x", "size": 2, "shard": "none", "slot": 7,
         "_tie": 0, "_block": 0, "row": "r", "_number": 1}


def lits(columns):
    return {k: F.lit(v) for k, v in columns.items()}


def brute(rows, n):
    rows = sorted((r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    total, at, out, slots = sum(r[2] for r in rows), 0, [], {}
    for known, i, size, crc in rows:
        k = min(n - 1, (2 * at + size) * n // (2 * total))
        out.append((i if known else None, size, crc, k, slots.get(k, 0)))
        slots[k] = slots.get(k, 0) + 1
        at += size
    return out


def placed(df, n):
    return sorted((tuple(r) for r in shards.place(df, n).select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=str)


@pytest.mark.parametrize("n", [1, 16])
def test_equals_prefix_sums(spark, docs_of, words, n):
    rng = random.Random(4)
    rows = [(i, words(rng.randint(0, 60), i)) for i in rng.sample(range(-500, 5000), 700)]
    rows += [(9000 + i, rows[0][1]) for i in range(350)]                  # a third are copies
    assert placed(docs_of(rows, lits(OTHER), partitions=7), n) == sorted(brute(rows, n), key=str)


def test_sizes_are_near_equal_and_ranges_contiguous(spark, docs_of, words):
    rows = [(i, words(i % 90, i)) for i in range(1200)]
    got = shards.report(docs_of(rows)).collect()
    total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
    ids = {}
    for r in got:
        ids.setdefault(r["shard"], []).append(r)
    assert sorted(ids) == list(range(16)) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    for k, rs in ids.items():
        assert abs(sum(r["size"] for r in rs) - total / 16) <= most
        assert [r["slot"] for r in sorted(rs, key=lambda r: r["doc_id"])] == list(range(len(rs)))
        assert k == 15 or max(r["doc_id"] for r in rs) < min(r["doc_id"] for r in ids[k + 1])


def test_odd_rows_and_one_id_for_all(spark, docs_of, odd_rows):
    assert placed(docs_of(odd_rows, lits(OTHER)), 16) == sorted(brute(odd_rows, 16), key=str)
    same = [(1, "a b c")] * 500 + [(None, None)] * 20
    assert placed(docs_of(same, partitions=5), 16) == sorted(brute(same, 16), key=str)


def test_empty_table(spark, docs_of):
    assert shards.report(docs_of([])).count() == 0


def test_written_shards_hold_whole_rows_in_order(spark, docs_of, words, tmp_path):
    rows = [(i, words(20, i)) for i in range(300)]
    docs = docs_of(rows, {"shard": F.lit("own"), "_part": F.lit(3)})
    shards.write(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in back.select(*docs.columns).collect()) == sorted(tuple(r) for r in docs.collect())
    assert back.select("shard_").distinct().count() == 4
