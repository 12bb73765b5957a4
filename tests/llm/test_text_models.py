"""Learned text operators: held-out accuracy, fixed results against plain versions, odd rows."""
import hashlib
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope.llm import langid, mil_quality, rules, secret_scan
from cellscope.llm.common import blocks

LABELS = "doc_id long, quality int, toxic int"


def held_out(i, mod):
    import zlib

    return zlib.crc32(str(i).encode()) % mod


@pytest.fixture
def graded(words):
    """Documents of two kinds and their labels: a bad one has a stretch of junk among good passages."""
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        text = ". ".join(words(12, 10 * i + k).capitalize() for k in range(8))
        if not good:
            junk = " ".join(f"{w.upper()}!!" if i % 2 else f"{w}$$#" for w in words(60, 7 * i).split())
            text = f"{text}. {junk}"
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_scores_held_out_documents(spark, docs_of, graded):
    rows, labels = graded
    truth = {i: q for i, q, _ in labels}
    df, lab = docs_of(rows, extra={"score": F.lit("x"), "label": F.lit(1), "bag": F.lit(2)}), spark.createDataFrame(labels, LABELS)
    got = {r["doc_id"]: r for r in mil_quality.classify(df, lab).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (held_out(i, 5) == 0) for i, r in got.items())
    unseen = [i for i in got if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in unseen) >= 0.95 * len(unseen)
    kept = mil_quality.keep_good(df, lab)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"] == 1}


def test_attention_falls_on_the_junk(graded):
    rows, labels = graded
    bags = [mil_quality.encode(t) for _, t in rows]
    model = mil_quality.fit_bags(bags, np.array([q for _, q, _ in labels]))
    bad = [b for b, (_, q, _) in zip(bags, labels) if q == 0 and len(b) > 1]
    hits = 0
    for b in bad:
        attention = model.forward((b - model.mean) / model.scale, np.array([0]))[4]
        hits += int(np.argmax(attention)) >= 1        # junk stands behind the first passage
    assert hits >= 0.8 * len(bad)


def test_gradient_is_that_of_the_loss():
    """One step of plain descent along the fitted direction lowers the loss."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(0, 1, (rng.integers(1, 5), mil_quality.N_FEATURES)).astype(np.float32) for _ in range(60)]
    y = np.array([float(b[:, 0].max() > 0.7) for b in bags])
    short, long = (mil_quality.fit_bags(bags, y, epochs=e) for e in (1, 40))
    loss = lambda m: -np.mean(np.log(np.where(y == 1, m.score(bags), 1 - m.score(bags)) + 1e-9))
    assert loss(long) < 0.5 * loss(short)


def test_quality_odd_rows_and_labels(spark, docs_of, odd_rows):
    lab = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 1, 0), (7, None, 0), (None, 1, 0), (8, 0, 0), (8, 0, 0)], LABELS)
    got = mil_quality.classify(docs_of(odd_rows), lab).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    none = mil_quality.classify(docs_of(odd_rows), lab.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert mil_quality.classify(docs_of([]), lab).count() == 0
    assert blocks("ab cd " * 10, 7) and "".join(blocks("ab cd " * 10, 7)) == "ab cd " * 10
    assert "".join(blocks("x" * 20, 7)) == "x" * 20
    assert mil_quality.encode("").shape == (1, mil_quality.N_FEATURES)


# rules -----------------------------------------------------------------------------------------

def brute_statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeat = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


@pytest.mark.parametrize("seed", range(5))
def test_statistics_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = "".join(rng.choices(["a", "b", "é", "#", " ", "\n", "\t", "\x0b", "\xa0", "<", "日", "a b c d e "], k=rng.randint(0, 80)))
        assert rules.statistics_of(text)[:5] == brute_statistics(text), text


def test_rules_find_the_labelled_kind(spark, docs_of, graded):
    rows, labels = graded
    truth = {i: q for i, q, _ in labels}
    df, lab = docs_of(rows, extra={"n_words": F.lit("x"), "kept": F.lit(1)}), spark.createDataFrame(labels, LABELS)
    learned = rules.fit(df, lab)
    assert learned and rules.describe(learned)[-1] == "otherwise keep"
    got = {r["doc_id"]: r for r in rules.apply_rules(df, learned).collect()}
    unseen = [i for i in got if held_out(i, 5) == 0]
    assert sum(got[i]["kept"] == bool(truth[i]) for i in unseen) >= 0.93 * len(unseen)
    for i, text in rows:
        r = got[i]
        assert tuple(r[c] for c in rules.COUNTS) == brute_statistics(text)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_learner_on_a_known_concept():
    rng = np.random.default_rng(1)
    x = rng.random((1500, len(rules.FEATURES)))
    bad = (x[:, 1] > 0.7) & (x[:, 4] < 0.4)
    learned = rules.learn(x, bad)
    found = np.zeros(len(x), bool)
    for r in learned:
        found |= rules._covers(r, x)
    assert (found & ~bad).mean() < 0.01 and (found & bad).sum() > 0.85 * bad.sum()
    assert rules.learn(x, np.zeros(len(x), bool)) == [] and rules.learn(x[:0], bad[:0]) == []


def test_rules_odd_rows(spark, docs_of, odd_rows):
    lab = spark.createDataFrame([(4, 1, 0), (5, 0, 0)], LABELS)
    got = rules.screen(docs_of(odd_rows), lab).collect()
    assert len(got) == len(odd_rows)
    want = Counter((i, *brute_statistics(t)) for i, t in odd_rows)
    assert Counter((r["doc_id"], *(r[c] for c in rules.COUNTS)) for r in got) == want
    assert rules.screen(docs_of([]), lab.limit(0)).count() == 0


# language --------------------------------------------------------------------------------------

VOCAB = {"en": "the of and to in is that it was for with as his on be at by had not are but from or have an they".split(),
         "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
         "fr": "le la les de des et à un une est que dans pour qui sur pas plus au avec ce il par ne se".split()}


def test_languages_of_held_out_documents(spark, docs_of):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(VOCAB))
        rows.append((i, " ".join(rng.choices(VOCAB[lang], k=rng.randint(5, 80))), lang))
    rows += [(900, "the of and", None), (901, "123 ... !!", "en"), (902, None, "fr"), (903, "", "de")]
    got = {r["doc_id"]: r for r in langid.train_and_identify(docs_of(rows, extra={"gram": F.lit(1), "n": F.lit(1)})).collect()}
    assert all(r["held_out"] == (held_out(i, 3) == 1) and 0 <= r["score"] <= 1 for i, r in got.items())
    unseen = [(i, lang) for i, _, lang in rows[:240] if held_out(i, 3) == 1]
    assert sum(got[i]["lang_pred"] == lang for i, lang in unseen) >= 0.95 * len(unseen)
    assert got[900]["lang_pred"] == "en" and all(got[i]["lang_pred"] == "und" for i in (901, 902, 903))


def brute_ngrams(text):
    out = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f"\1{w}\1"
        out.update(w)
        out.update(padded[k:k + 2] for k in range(len(padded) - 1))
        out.update(padded[k:k + 3] for k in range(len(padded) - 2))
    return out


@pytest.mark.parametrize("text", ["Hello, hello world1x", "é日本 語 a", "x", "..", "ABC abc_abc\nabc"])
def test_ngram_counts(text):
    keys, counts = langid.ngrams(text)
    unpack = lambda k: "".join(chr(k >> s & 0x1FFFFF) for s in (0, 21, 42) if k >> s & 0x1FFFFF)
    assert {unpack(int(k)): int(n) for k, n in zip(keys, counts)} == dict(brute_ngrams(text))


def test_out_of_place_distance_by_hand():
    p = langid.Profiles({"x": [ord("a"), ord("b")], "y": [ord("b"), ord("a")]}, size=2)
    p_text = "ba bb"        # b is its most frequent n-gram; the rest of the first two is by n-gram order
    top = langid._ranked(*langid.ngrams(p_text), 2).tolist()
    want = {}
    for lang, prof in (("x", [97, 98]), ("y", [98, 97])):
        want[lang] = sum(min(2, abs(prof.index(g) - k)) if g in prof else 2 for k, g in enumerate(top))
    lang, score = p.predict(p_text)
    assert lang == min(sorted(want), key=want.get) and score == pytest.approx(1 - want[lang] / 4)


def test_language_odd_rows(spark, docs_of, odd_rows):
    got = langid.train_and_identify(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 8)} == {"und"}
    assert langid.train_and_identify(docs_of([])).count() == 0
    none = docs_of(odd_rows).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.train_and_identify(none).collect()} == {"und"}


# secrets ---------------------------------------------------------------------------------------

def brute_spans(text):
    out = []
    for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def secret_rows(words):
    rng = random.Random(9)
    key = lambda k, n: "".join(rng.choices(k, k=n))
    alnum, rows = string.ascii_letters + string.digits, []
    for i in range(120):
        parts = [words(8, i), rng.choice(["password=", "Api_Key: '", 'TOKEN" = "', "secret:token:", "passwd  =  ", "ſecret="])
                 + key(alnum, rng.choice([6, 12, 30])), "é" * (i % 3), "AKIA" + key(string.ascii_uppercase + string.digits, rng.choice([8, 13, 14, 16])),
                 key("0123456789abcdef", rng.choice([10, 15, 16, 40])), words(8, 1000 + i)]
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n", ""]).join(parts)))
    return rows


def test_pattern_spans_and_digest(spark, docs_of, words):
    rows = secret_rows(words)
    got = {r["doc_id"]: r for r in secret_scan.train_and_scan(docs_of(rows, extra={"pair": F.lit(1), "spans": F.lit(2)})).collect()}
    for i, text in rows:
        want = brute_spans(text)
        written = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in want)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in want) for x in range(3))
        assert set(written.split(",")) - {""} <= set(r["spans"].split(","))


def test_markov_finds_random_tokens_only(spark, docs_of, words):
    rng = random.Random(3)
    alnum = string.ascii_letters + string.digits
    keys = {i: "".join(rng.choices(alnum, k=32)) for i in range(60)}
    plain = ["internationalization", "get_user_account_settings", "counterrevolutionaries", "zzzzzzzzzzzzzzzzzzzzzz"]
    prose = lambda i: " ".join(w.capitalize() if i % 7 == 0 else w
                               for w in random.Random(i).choices(VOCAB["en"] + VOCAB["de"] + VOCAB["fr"], k=120))
    rows = [(i, f"{prose(i)} value {keys[i]} {prose(i)[:40].replace(' ', '_')} " + " ".join(plain)) for i in range(60)]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.train_and_scan(docs_of(rows)).collect()}
    found = {i: [rows[i][1][int(a):int(b)] for k, a, b in (x.split(":") for x in s.split(",") if x)] for i, s in got.items()}
    assert sum(keys[i] in found[i] for i in keys) >= 57
    assert sum(len(set(found[i]) - {keys[i]}) for i in keys) <= 3


def test_secrets_odd_rows(spark, docs_of, odd_rows):
    got = secret_scan.train_and_scan(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all(r["spans"] == "" for r in got if r["doc_id"] in (1, 2, 3))
    assert secret_scan.train_and_scan(docs_of([])).count() == 0
