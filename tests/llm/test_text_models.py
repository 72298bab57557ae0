"""Toxicity, perplexity and unigram encoding against plain versions, round trips and held-out rows."""

import math
import random
import struct
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

from strata.llm import kneser_ney as kn  # noqa: E402
from strata.llm import toxicity, unigram  # noqa: E402
from strata.llm.queries import QUERIES, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def characters(spark):
    text = " ".join(["you are an idiot and a moron", "what a stupid and pathetic clown", "the quiet house by the river is a letter"] * 50)
    return toxicity.character_model(spark.createDataFrame([(text,)], "text string"))


@pytest.mark.parametrize("hidden,meant", [("1d10t", "idiot"), ("pathet!c", "pathetic"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("p@th3t1c", "pathetic"),
                                          ("idiiiiot", "idiot"), ("cl0wn", "clown"), ("$tup1d", "stupid")])
def test_decoding(characters, hidden, meant):
    assert toxicity.decode(hidden, characters) == meant


def _restored(characters, *texts):
    data, offsets = toxicity.bw.string_buffers(toxicity.pa.array(texts, toxicity.pa.string()))
    out = [set() for _ in texts]
    for t, words in zip(*toxicity.restored(data, offsets, characters, {})):
        out[t].update(words.split())
    return out


@pytest.mark.parametrize("text,meant", [("an id.iot here", "idiot"), ("stu-pid", "stupid"), ("s_tupid", "stupid"), ("i-d-i-o-t!", "idiot"), ("so i.d.i.o.t.", "idiot"),
                                        ("stu(pid", "stupid"), ("an idio+", "idiot"), ("id" + "i" * 60 + "ot", "idiot"), ("M" + "ö" * 30 + "ron", "moron"),
                                        ("http://a.example/" + "river/" * 20 + "m0r0n", "moron"), ("stupid,m0r0n", "moron")])
def test_odd_runs(characters, text, meant):
    assert meant in _restored(characters, "the river", None, text)[2], _restored(characters, text)


@pytest.mark.parametrize("text,meant", [("you i d i o t.", "idiot"), ("(i d i o t", "idiot"), ("m.o.r.o.n.", "moron"), ("m-o-r-o-n!", "moron"), ("such a s t u p i d", "stupid"),
                                        ("y o u i d i o t", "idiot"), ("y o u   i d i o t, yes", "idiot"), ("a n d", "and"), ("a - n - d", "and"),
                                        (" ".join("an" + "and" * 20 + "moron"), "moron"), ("I D 1 0 T", "idiot")])
def test_loose_runs(characters, text, meant):
    assert meant in _restored(characters, "a", text)[1], _restored(characters, text)


def test_trigram_counts(spark):
    cube = toxicity.character_model(spark.createDataFrame([("ab ab",), (None,), ("",)], "text string"))
    assert np.allclose(np.exp(cube).sum(axis=2), 1)
    assert cube[0, 1, 2] == cube[0, 1].max()  # b after a word's a


def _toxic_table(n=400):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = cases.prose(rng, 40)
        if bad:
            words = text.split()
            for w in rng.sample(["idiot", "moron", "pathetic"], 2):
                words.insert(rng.randrange(len(words)), w)
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, int(bad)))
    hidden = {1000: "you i d i o t", 1001: "such a m0r0n", 1002: "p@thet1c", 1003: "idiiiiiot!!"}
    return docs + [*hidden.items(), (1100, None), (1101, ""), (1102, "the river"), (None, "the river")], labels


def test_scores_restored_text(spark):
    docs, labels = _toxic_table()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int").where(~toxicity.held_out()))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    assert len(got) == len(docs) and all(0 <= s <= 1 for s in got.values())
    for i, y in labels:
        assert (got[i] >= 0.7) == bool(y)
    assert all(got[i] >= 0.7 for i in range(1000, 1004)), got
    assert all(got[i] < 0.2 for i in (1100, 1101, 1102, None))
    kept = toxicity.drop_toxic(d.withColumn("score", F.lit(1)), model)
    assert kept.columns == ["doc_id", "text", "score"] and {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.7}


def test_labels_of_one_kind_or_none(spark):
    docs, labels = _toxic_table(50)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for rows in ([(i, 0) for i, _ in labels], []):
        model = toxicity.fit(d, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert toxicity.score(d, model).where("score between 0 and 1").count() == len(docs)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.score(empty, toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rows = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.9 and hit / sum(r["toxic"] for r in rows) > 0.7


def _plain_symbols(text):
    return ["^"] * (kn.ORDER - 1) + [" " if x.isspace() or x < " " else "0" if x.isdecimal() else x.lower() if len(x.lower()) == 1 else x for x in text]


def _plain_model(texts):
    """Interpolated modified Kneser-Ney by its definition."""
    level = defaultdict(Counter)
    for t in texts:
        c = _plain_symbols(t)
        for i in range(kn.ORDER - 1, len(c)):
            level[kn.ORDER][tuple(c[i - kn.ORDER + 1:i + 1])] += 1
    for n in range(kn.ORDER - 1, 0, -1):
        for g in level[n + 1]:
            level[n][g[1:]] += 1
    cut = {}
    for n, grams in level.items():
        k = [sum(v == i for v in grams.values()) for i in (1, 2, 3, 4)]
        if k[0] and k[1]:
            y = k[0] / (k[0] + 2 * k[1])
            raw = [i + 1 - (i + 2) * y * k[i + 1] / k[i] if k[i] else 0.5 for i in range(3)]
            cut[n] = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]
        else:
            cut[n] = [0.5] * 3

    def p(n, g):
        if n == 0:
            return 1 / (len(level[1]) + 1)
        same = {h: v for h, v in level[n].items() if h[:-1] == g[:-1]}
        if not same:
            return p(n - 1, g[1:])
        d = lambda v: cut[n][min(v, 3) - 1]
        own = same[g] - d(same[g]) if g in same else 0
        return (own + sum(map(d, same.values())) * p(n - 1, g[1:])) / sum(same.values())

    return p


@pytest.mark.parametrize("slices", [1, 3])
def test_perplexity_equals_the_definition(spark, slices):
    train = ["the quiet river", "the stone house, 12 windows", "über die Brücke", "Тихая река 34\x00и дом", "静かな川", "the quiet river"]
    test = ["the river house", "zzz %%% 99", "", None, "the river house", "ТИХИЙ дом", "川の家 \U0010ffff", "über\tdie Brücke İ"]
    docs = spark.createDataFrame(list(enumerate(train + test)) + [(None, "the river"), (0, train[0])], "doc_id long, text string")
    seen = kn.grams(docs, spark.range(len(train)).where("id <> 5").selectExpr("cast(id as int) id"), slices)
    model = kn.train(seen)
    got = {(r["doc_id"], r["text"]): r["perplexity"] for r in docs.withColumn("key", F.xxhash64("doc_id", "text")).join(kn.perplexity(docs, seen, model, slices), "key").collect()}
    p = _plain_model(train[:5] + train[:1])  # the repeated row counts as it stands
    assert len(got) == len(train) + len(test) + 1
    for (_, t), x in got.items():
        if not t:
            assert x is None
            continue
        c = _plain_symbols(t)
        log = [math.log(p(kn.ORDER, tuple(c[j:j + kn.ORDER]))) for j in range(len(t))]
        assert math.isclose(x, math.exp(-sum(log) / len(log)), rel_tol=1e-9)


def test_parts_of_long_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcЖ川 1\n") for _ in range(rng.choice([1, 3, 40, 500]))) for _ in range(30)]
    table = kn.pa.table({"id": kn.pa.array(range(30)), "key": kn.pa.array(range(30)), "text": kn.pa.array(texts)})
    ids = kn.pa.table({"id": kn.pa.array([2, 3, 99])})
    key = (kn.pa.scalar(5),)
    whole = kn._slice_grams(key, table, ids)
    values = whole.append_column("log_p", kn.pa.array(np.linspace(-1, -9, whole.num_rows)))
    sums = kn._slice_sums(key, table, values)
    expected = Counter()
    for i in (2, 3):
        c = _plain_symbols(texts[i].replace("^", " "))
        expected.update("".join(c[j:j + kn.ORDER]).replace("^", chr(kn.BEGIN)) for j in range(len(texts[i])))
    assert {g: n for g, n in zip(whole["gram"].to_pylist(), whole["c"].to_pylist()) if n} == expected
    for part in (kn.ORDER - 1, 7, 100):
        monkeypatch.setattr(kn, "PART", part)
        assert kn._slice_grams(key, table, ids).equals(whole)
        again = kn._slice_sums(key, table, values)
        assert again["n"].equals(sums["n"]) and np.allclose(again["log_p"].to_numpy(), sums["log_p"].to_numpy())
    assert sums["n"].to_pylist() == [len(t) for t in texts]
    assert kn._slice_grams(key, table.slice(0, 0), ids).num_rows == 0


def test_other_scripts_are_told_apart(spark):
    """Good prose and gibberish of the same letters and word lengths, in Cyrillic and Greek."""
    rng = random.Random(4)
    words = {"ru": "тихая река течет мимо старого дома где каждое утро открывают окна сада".split(), "el": "το ήσυχο ποτάμι περνά δίπλα από παλιό σπίτι κάθε πρωί".split()}
    rows, bad = [], set()
    for i in range(2000):  # some 180 held-out rows a language set the quantiles
        lang = rng.choice(["ru", "el"])
        text = " ".join(rng.choice(words[lang]) for _ in range(40))
        if i % 10 == 0:
            bad.add(i)
            text = " ".join("".join(rng.choice("".join(words[lang])) for _ in w) for w in text.split())
        rows.append((i, text, lang))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in kn.quality(d, d.where("doc_id % 10 <> 0")).collect()}
    assert not any(got[i] for i in bad) and sum(got.values()) > 0.95 * (2000 - len(bad))


def test_quality_cases(spark):
    d = cases.frame(spark)
    got = kn.quality(d, d.where("doc_id < 40")).collect()
    assert len(got) == len(cases.documents())
    assert all(not r["kept"] and r["perplexity"] is None for r in got if r["n_symbols"] == 0)
    assert kn.quality(d, d.limit(0)).where("kept").count() == sum(bool(r[1]) for r in cases.documents())
    assert kn.quality(d.limit(0), d).count() == 0


def test_quality_separates_labels(spark):
    r = QUERIES["op7_kneser_ney"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    n = {(x["quality"], x["kept"]): x["count"] for x in r.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n[1, False]) > 0.95 and n[0, False] / (n[0, True] + n[0, False]) > 0.6


@pytest.fixture(scope="module")
def pieces():
    return unigram.Pieces.load(tokenizer_path("piece_bpe_32k.model"))


TEXTS = ["", "a", "  two  spaces ", "tab\there\r\nline", "日本語 漢字 é́", "😀 emoji", "x" * 3000, "The quick brown fox.", "naïve façade", " ", "\n"]


def _best_score(p, text):
    """Best path's score by the plain recurrence over the whole text."""
    t = (" " + text).replace(" ", unigram.MARK)
    known = {p.raw[i].decode(): s for i, s in enumerate(p.scores) if i not in set(p.byte_ids) and p.raw[i]}
    longest = max(map(len, known))
    best = [0.0] + [-math.inf] * len(t)
    for e in range(1, len(t) + 1):
        for b in range(max(0, e - longest), e):
            s = known.get(t[b:e], p.unknown if e - b == 1 else None)
            if s is not None:
                best[e] = max(best[e], best[b] + s)
    return best[-1]


def test_unigram_round_trip_and_best_paths(pieces):
    texts = TEXTS + pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()[:300]
    for t, ids in zip(texts, pieces.encode(texts)):
        ids = np.frombuffer(ids, "<u4")
        assert pieces.decode(ids, np.array([len(ids)])) == [t]
        if len(t) < 400:
            bytes_ = set(pieces.byte_ids)
            lost = "".join(c for c in t.replace(" ", unigram.MARK) if c.encode() not in set(pieces.raw[3 + 256:]))
            score = sum(pieces.scores[i] for i in ids.tolist() if i not in bytes_) + pieces.unknown * len(lost)
            assert not t or math.isclose(score, _best_score(pieces, t), rel_tol=1e-9, abs_tol=1e-6)


def test_unigram_of_long_words_and_texts(pieces, monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcdeé日😀 ▁\n") for _ in range(rng.randint(1, 900))) for _ in range(40)] + ["x" * 5000, "ab" * 3000 + " c", "", None, " " * 50]
    plain = pieces.encode(texts)
    for name, value in (("LONG", 5), ("WINDOW", 7), ("SEGMENT", 60)):
        monkeypatch.setattr(unigram, name, value)
        pieces.cache, pieces.held = {}, 0
        assert pieces.encode(texts) == plain
    monkeypatch.setattr(unigram, "CACHE", 10)
    assert [pieces.encode([t])[0] for t in texts] == plain and pieces.held < 1 << 20
    ids = [np.frombuffer(p or b"", "<u4") for p in plain]
    got = pieces.decode(np.concatenate(ids), np.cumsum([len(i) for i in ids]))
    assert got == [(t or "").replace("▁", " ") for t in texts]


def test_unigram_of_a_word_of_a_million_letters(pieces):
    import resource
    rng = random.Random(3)
    word = "".join(rng.choice("etaoinshr") for _ in range(1_000_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids = np.frombuffer(pieces.encode([word])[0], "<u4")
    assert pieces.decode(ids, np.array([len(ids)])) == [word]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB


def _unigram_proto(path, scores):
    """The model file with its kind set to unigram and these scores."""

    def vint(b, i):
        x = s = 0
        while True:
            x |= (b[i] & 127) << s
            s, i = s + 7, i + 1
            if b[i - 1] < 128:
                return x, i

    def out(x):
        r = b""
        while x > 127:
            r, x = r + bytes([x & 127 | 128]), x >> 7
        return r + bytes([x])

    def fields(b):
        i = 0
        while i < len(b):
            k, i = vint(b, i)
            if k & 7 == 0:
                v, i = vint(b, i)
            else:
                n, i = (4, i) if k & 7 == 5 else (8, i) if k & 7 == 1 else vint(b, i)
                v, i = b[i:i + n], i + n
            yield k >> 3, k & 7, v

    def put(f, w, v):
        return out(f << 3 | w) + (out(v) if w == 0 else out(len(v)) + v if w == 2 else v)

    r, k = b"", 0
    for f, w, v in fields(Path(path).read_bytes()):
        if f == 1:
            v, k = b"".join(put(a, b, struct.pack("<f", scores[k]) if a == 2 else c) for a, b, c in fields(v)), k + 1
        elif f == 2:
            v = b"".join(put(a, b, 1 if a == 3 else c) for a, b, c in fields(v))
        r += put(f, w, v)
    return r


def test_unigram_equals_the_library(pieces):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=_unigram_proto(tokenizer_path("piece_bpe_32k.model"), pieces.scores))
    texts = [t for t in TEXTS if t.strip()] + pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()
    score = lambda ids: pieces.scores[ids].sum()  # noqa: E731  equal scores may split a run of signs elsewhere
    for t, ids in zip(texts, pieces.encode(texts)):
        ids, want = np.frombuffer(ids, "<u4").tolist(), sp.encode(t)
        assert ids == want or (len(t) > 0 and math.isclose(score(ids), score(want), rel_tol=1e-5) and sp.decode(ids) == sp.decode(want)), t[:80]


def test_unigram_cases(spark, pieces):
    b = spark.sparkContext.broadcast(pieces)
    got = unigram.decode(unigram.encode(cases.frame(spark), b), b).collect()
    assert sorted(((r["doc_id"] or -1), r["text"] or "") for r in got) == sorted(((r[0] or -1), r[1] or "") for r in cases.documents())
    assert all(r["decoded"] == r["text"] and (r["ids"] is None) == (r["text"] is None) for r in got)
    assert unigram.encode(cases.frame(spark, []), b).count() == 0
