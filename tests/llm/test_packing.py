"""Packing and token files against the tokenizer itself, as exact round trips."""
import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope.llm import common, packing, token_orc, tokens
from cellscope.llm.tokens import TextIds, tokenizer_path

ODD = ["", " ", "a  b\n\nc \n d\t\te  ", "it's 'S DON'T <|endoftext|> x y", "\x0b a\x0cb\xa0c", " x　y",
       "ÀÉ. İstanbul, ΑΣ ς. naïve café; éx 12ab3.4 _x_ --y ..z", " lead", "trail ", "日本 語。 x", "A.B c!? d.'s"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_librarys(name, words):
    ids = TextIds(tokenizer_path(name))
    rng = random.Random(1)
    texts = ODD + [words(50, i) for i in range(20)] + ["".join(rng.choices("aB. '\n\té,!s_1\x1f", k=60)) for _ in range(300)]
    for text in texts:
        want = ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == want, text


@pytest.mark.parametrize("name,end", [("word_bpe_49k.json", 49407), ("byte_bpe_50k.json", 50256)])
def test_added_tokens_are_encoded_as_by_the_plain_call(name, end, words):
    from tokenizers import Tokenizer

    plain, ids = Tokenizer.from_file(tokenizer_path(name)), TextIds(tokenizer_path(name))
    texts = ODD + ["<|endoftext|>", "a<|endoftext|>b", f"{words(20, 1)} <|endoftext|>\n{words(5, 2)}", "<|startoftext|> x",
                   "<|ENDOFTEXT|> <|endof text|> <|", "x <|endoftext|><|endoftext|>"]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == want, text
    assert np.frombuffer(ids.encode("<|endoftext|>"), "<u4").tolist() == [end]


@pytest.mark.parametrize("most", [None, 2000])
def test_ids_of_many_texts_at_once_are_the_librarys(words, monkeypatch, most):
    if most:
        monkeypatch.setattr(tokens, "MAX_BYTES", most)      # the table starts anew again and again
        monkeypatch.setattr(tokens, "MAX_KEPT", 5)
    ids = TextIds(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(2)
    kinds = ["aB. '\n\té,!s_1\x1f", "ab \n\r\t.'stvre-", "ÀÖ×öø÷ÿé. ,a9", "a\x00\x01 b\nĀā", "日本 a.　。…—", "İßΣς ªº½ .a", "a'S'LL'm. \U0001F600"]
    for k in range(25):
        texts = ["".join(rng.choices(kind, k=rng.randint(0, 50))) for kind in kinds for _ in range(9)]
        texts += ODD + ["", "<|endoftext|> a.b", "a<|EndOfText|>", words(50, k), "x" * 5000, " \n" * 99 + "a"]
        rng.shuffle(texts)
        flat, n = ids.encode_all(texts)
        at = 0
        for text, size in zip(texts, n.tolist(), strict=True):
            assert flat[at:at + size].tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids, text
            at += size
        assert at == len(flat)
    assert ids.encode_all([])[1].tolist() == [] and ids.encode_all(["", ""])[1].tolist() == [0, 0]


class Counted:
    """The library with its calls counted."""

    def __init__(self, of):
        self.of, self.calls = of, 0

    def __getattr__(self, name):
        def call(*args, **kinds):
            self.calls += 1
            return getattr(self.of, name)(*args, **kinds)
        return call


def test_orc_unseen_words_share_calls_of_the_library(monkeypatch):
    import pyarrow as pa

    class Docs:
        schema = {"doc_id": type("F", (), {"dataType": type("T", (), {"simpleString": lambda _: "bigint"})()})}

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run

    ids = TextIds(tokenizer_path("byte_bpe_50k.json"))
    plain, ids.tokenizer, ids.model = ids.tokenizer, Counted(ids.tokenizer), Counted(ids.model)
    monkeypatch.setattr(token_orc, "text_ids", lambda path: ids)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) + rng.choice(["", ".", "#1"]) for _ in range(40)) for _ in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": texts})
    out = pa.Table.from_batches(token_orc.encode(Docs())(iter([batch])))
    assert out["ids"].to_pylist() == [plain.encode(x, add_special_tokens=False).ids + [token_orc.END_ID] for x in texts]
    # a call for each of the 4,000 words would be the cost of the whole query
    assert ids.tokenizer.calls + ids.model.calls < 100


@pytest.mark.parametrize("most", [None, 2000])
def test_word_ids_of_many_texts_at_once_are_the_librarys(words, monkeypatch, most):
    if most:
        monkeypatch.setattr(tokens, "MAX_BYTES", most)      # the table starts anew again and again
        monkeypatch.setattr(tokens, "MAX_KEPT", 5)
    ids = TextIds(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(5)
    kinds = ["aB. '\n\té,!s_1\x1f", "HhAaTJ\u0331\u030c\u0300\u0304 .", "ÀÖ×öø÷ÿé. ,a9A", "a\x00\x01 b\nĀāB\x01", "日本 a.　。…—\xa0\x85B",
             "İßΣς ªº½ .aKſµ", "a'S'LL'm. \U0001F600'sRE", "<≠\u0338=a> ;\u037e`", "\x0b\x0c\r \x1c\x1d\u2028aB", "각ᄀᆨ\u0338 \u0301A.", "<|>\u0338endEND "]
    for k in range(25):
        texts = ["".join(rng.choices(kind, k=rng.randint(0, 50))) for kind in kinds for _ in range(9)]
        texts += ODD + ["", "<|endoftext|> A.b", " \nA<|endoftext|> ", "a<|EndOfText|>", words(50, k), "x" * 5000, " \n" * 99 + "A", "A", "\u0331", "\x01"]
        rng.shuffle(texts)
        flat, n = ids.encode_all(texts)
        at = 0
        for text, size in zip(texts, n.tolist(), strict=True):
            assert flat[at:at + size].tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids, text
            at += size
        assert at == len(flat)
    assert ids.encode_all([])[1].tolist() == [] and ids.encode_all(["", " \n"])[1].tolist() == [0, 0]


class Looked(dict):
    """A table with its lookups counted."""

    gets = 0

    def get(self, *key):
        self.gets += 1
        return super().get(*key)


def test_packing_looks_up_equal_words_once(monkeypatch):
    import pyarrow as pa

    class Docs:
        schema = {"doc_id": type("F", (), {"dataType": type("T", (), {"simpleString": lambda _: "bigint"})()})}

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run

    ids = TextIds(tokenizer_path("word_bpe_49k.json"))
    plain, ids.tokenizer, ids.words = ids.tokenizer, Counted(ids.tokenizer), Looked()
    monkeypatch.setattr(packing, "text_ids", lambda path: ids)
    monkeypatch.setattr(packing, "TaskContext", type("C", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda _: 0})())}))
    rng = random.Random(6)
    vocab = ["".join(rng.choices("abcdefgh", k=9)) + rng.choice(["", ".", "#1", "1"]) for _ in range(1000)]
    texts = [" ".join(rng.choices(vocab, k=40)) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": texts})
    found = defaultdict(list)
    for r in pa.Table.from_batches(packing.pack(Docs(), with_ids=True)(iter([batch]))).to_pylist():
        found[r["doc_id"]].append((r["start"], r["ids"]))
    for doc, text in enumerate(texts):
        assert [x for _, own in sorted(found[doc]) for x in own] == plain.encode(text, add_special_tokens=False).ids + [packing.END_ID]
    # a lookup for each of the 20,000 words, and a call for each unseen one, would be the cost of the whole query
    assert ids.words.gets < 3000 and ids.tokenizer.calls < 50


def ids_of(name, text, end):
    ids = TextIds(tokenizer_path(name))
    return ids.tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_make_up_the_documents(spark, docs_of, odd_rows, words):
    rows = odd_rows + [(100 + i, words(random.Random(i).randint(1, 900), i)) for i in range(60)]
    rows = [r for r in rows if r[0] not in (5, 6, None)] + [(5, words(30, 5)), (None, words(9, 1)), (None, words(9, 1))]
    got = packing.pack(docs_of(rows, extra={"start": F.lit(1), "ids": F.lit(2)}), with_ids=True).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    for doc, text in rows:
        want = ids_of("word_bpe_49k.json", text, packing.END_ID)
        own = sorted(pieces[doc], key=lambda r: r["start"])
        if doc is None:
            assert sum(r["length"] for r in own) == 2 * len(want) or doc is not None
            continue
        at = 0
        for r in own:
            assert r["start"] == at and r["ids"] == want[at:at + r["length"]] and r["ids_crc32"] == crc(r["ids"])
            assert r["doc_tokens"] == len(want)
            at += r["length"]
        assert at == len(want)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY


def test_little_padding(spark, docs_of, words):
    rows = [(i, words(random.Random(i).randint(20, 600), i % 50)) for i in range(1500)]
    got = packing.pack(docs_of(rows, partitions=1)).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    used = sum(r["n"] for r in got)
    assert used >= 0.98 * packing.CAPACITY * len(got)


@pytest.mark.parametrize("seed", range(6))
def test_differencing_keeps_parts_and_capacity(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, rng.choice([5, 60, 512])) for _ in range(rng.randint(1, 300))]
    k = rng.randint(1, 40)
    sums, windows = packing.differencing(np.array(sizes), k)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert sorted(sum(sizes[i] for i in w) for w in windows) == sorted(sums.tolist() + [0] * (len(windows) - len(sums)))
    packed = packing.pack_group(sizes, 600)
    assert all(sum(sizes[i] for i in w) <= 600 for w in packed)


def test_differencing_of_two_ways():
    sums, _ = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sums.tolist()) == [14, 16]      # the known result of the method for this example


def test_empty_table(spark, docs_of):
    assert packing.pack(docs_of([])).count() == 0
    assert token_orc.round_trip(docs_of([])).count() == 0


def test_orc_round_trip(spark, docs_of, odd_rows, words, tmp_path):
    rows = [r for r in odd_rows if r[0] not in (5, 6, None)] + [(50 + i, words(30 + i, i)) for i in range(100)]
    rows += [(20, words(9, 1)), (20, words(9, 1)), (20, words(9, 1))]
    random.Random(1).shuffle(rows)
    got = {}
    table = sorted((tuple(r) for r in token_orc.round_trip(docs_of(rows, extra={"ids": F.lit(1), "file": F.lit(2)})).collect()))
    at = 0
    for (doc, start, n, c), (want_doc, text) in zip(table, sorted(rows, key=lambda r: (r[0], r[1] is not None))):
        ids = ids_of("byte_bpe_50k.json", text, token_orc.END_ID)
        assert (doc, start, n, c) == (want_doc, at, len(ids), crc(ids)), doc
        at += n
    assert len(table) == len(rows) and not got


def test_orc_null_ids_come_first(spark, docs_of, words):
    rows = [(None, words(5, 1)), (3, words(6, 2)), (None, None)]
    got = sorted((tuple(r) for r in token_orc.round_trip(docs_of(rows)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 3]


def test_orc_reads_are_pruned(spark, docs_of, words, tmp_path):
    path = f"file://{tmp_path}/ids"
    token_orc.write(docs_of([(2 * i, words(20, i)) for i in range(300)]), path)
    plan = token_orc.lookup(spark, path, [40])._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "doc_id" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert [r["doc_id"] for r in token_orc.lookup(spark, path, [40, 41]).collect()] == [40]
    assert token_orc.between(spark, path, 10, 20).count() == 6
    import pyarrow.orc as po

    files = sorted(tmp_path.glob("ids/part-*.orc"))
    ids = [po.ORCFile(f).read(columns=["doc_id"]).column(0).to_pylist() for f in files]
    flat = [x for part in ids for x in part]
    assert flat == sorted(flat) and len(flat) == 300
    assert all(po.ORCFile(f).compression == "ZSTD" for f in files)


@pytest.mark.parametrize("module, file", [(packing, "word_bpe_49k.json"), (token_orc, "byte_bpe_50k.json")])
def test_a_worker_that_waits_keeps_no_large_table(monkeypatch, module, file):
    import pyarrow as pa

    class Docs:
        schema = {"doc_id": type("F", (), {"dataType": type("T", (), {"simpleString": lambda _: "bigint"})()})}

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run

    ids = TextIds(tokenizer_path(file))
    monkeypatch.setattr(module, "text_ids", lambda path: ids)
    monkeypatch.setattr(packing, "TaskContext", type("C", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda _: 0})())}))
    monkeypatch.setattr(tokens, "IDLE_BYTES", 100_000)
    freed = []
    monkeypatch.setattr(common, "give_back", lambda: freed.append(ids.held))
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(40)) for _ in range(100)]
    run = packing.pack(Docs()) if module is packing else token_orc.encode(Docs())
    few, many = ([pa.RecordBatch.from_pydict({"doc_id": list(range(len(x))), "text": x})] for x in (texts[:5], texts))
    list(run(iter(few)))
    assert ids.words and freed == [ids.held]        # a small table serves the next task
    again = list(run(iter(many)))
    assert not ids.words and freed[1:] == [0]
    assert list(run(iter(many))) == again


def test_memory_freed_by_arrow_goes_back_to_the_system():
    import subprocess
    import sys

    code = """
import pyarrow as pa
from cellscope.llm.common import giving_back

def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

def fn(batches):
    kept = []
    for batch in batches:
        kept += [pa.array([b"x" * 1000] * 1000, pa.binary()) for _ in range(200)], [bytes(300) + bytes([k % 250]) * 300 for k in range(100_000)]
        yield batch

batch = pa.RecordBatch.from_pydict({"a": [1]})
before = held()
assert list(giving_back(fn)(iter([batch]))) == [batch]
print(held() - before)
"""
    root = str(Path(tokens.__file__).resolve().parents[2])
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert int(out) < 100       # of more than 250 MB
