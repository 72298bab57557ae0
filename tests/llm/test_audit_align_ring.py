"""Filter audit, tokenizer alignment and ring shards against brute force."""

import hashlib
import itertools
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

from strata.llm import alignment, audit, ring  # noqa: E402
from strata.llm.queries import tokenizer_path  # noqa: E402

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


# --- filter audit


def _fails(rows):
    """Failed filters of each row, straight from the definition."""
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = cases.WORD.findall(t)
        out.append("".join(f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and i > least[t])) if bad))
    return out


def _audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    fails = _fails(rows)
    parts, out, shapley = defaultdict(list), {}, Counter()
    for r, f in zip(rows, fails):
        parts[r[2] or ""].append((r[0], f))
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in alive if x in d[1]]
                alive = [d for d in alive if x not in d[1]]
                out[part, order, step] = [len(alive), len(gone), sum(x in d[1] for d in docs) - len(gone), sum(d[1] == x for d in docs),
                                          sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
                shapley[part, x] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    rng = random.Random(5)
    rows = cases.documents()
    rows += [(600 + i, rng.choice(["ALL CAPS HERE " * 40, "cost $5 " * 60, cases.prose(rng, 150), rows[2][1]]), rng.choice(["en", "", None]), "s", 1, "x", 7, "c")
             for i in range(40)]
    ids = [r[0] for r in rows if r[0] is not None]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in rng.sample(ids, 60)] + [(600, 1, 0), (600, 0, 1), (None, 1, 1)]
    got = audit.filter_audit(cases.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = _audit(rows, labels)
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == want
    assert len(got) == len(want) == 120 * 5 * len({r[2] or "" for r in rows})
    assert all(any(x in f for f in _fails(rows)) for x in "ABCDE")


def test_audit_of_no_documents(spark):
    none = audit.filter_audit(cases.frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.collect() == []


def test_word_counts_in_slices(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(audit.bw, "SLICE", 7)
    for _ in range(200):
        raw = "".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 60))).encode()
        w = raw.split()
        assert audit._word_counts(raw) == (len(w), len(set(w)))


def test_removal_steps_are_the_first_failing_place():
    orders = np.array(list(itertools.permutations(range(4))))
    steps = audit.removal_steps(np.arange(16), np.argsort(orders, axis=1))
    for m, o in itertools.product(range(16), range(len(orders))):
        places = [s for s, f in enumerate(orders[o]) if m >> f & 1]
        assert steps[m, o] == (places[0] if places else np.inf)


# --- alignment


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


_KEEP = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _KEEP} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _KEEP)}


def _groups(tokenizers, text):
    """Groups [(a ids, b ids)] of a whole text by walking both token lists, or None."""
    a, b = tokenizers
    if not text:
        return None
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    xs = [bytes(_BYTE[c] for c in a.id_to_token(i)) for i in x]
    ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
    if b"".join(xs) != (" " + text).encode() or b"".join(ys) != (" " + text).encode():
        return None
    out, i, j = [], 0, 0
    while i < len(x):
        p, q, m, n = i, j, len(xs[i]), len(ys[j])
        while m != n:
            if m < n:
                i += 1
                m += len(xs[i])
            else:
                j += 1
                n += len(ys[j])
        i, j = i + 1, j + 1
        out.append((x[p:i], y[q:j]))
    return out


def _alignment(tokenizers, rows):
    groups = [_groups(tokenizers, t) for _, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for x in groups for g in x or [])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), x in zip(rows, groups):
        links = [(g[0][-1], g[1][-1]) for g in x or []]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in x or [])
        out.append((i, sum(len(g[0]) for g in x or []), sum(len(g[1]) for g in x or []), len(links), len(links),
                    sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if x else ""))
    return out


def test_alignment_equals_whole_texts(spark, tokenizers, monkeypatch):
    rng = random.Random(8)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "日本", "▁", "<|endoftext|>", "</s>", "<0x41>", "1", "23", ".", "...", " ", " ", "😀", "İ", "ﬁ", "́", "‍", "\x00", "\x1c", "\u0085", "Ж", "ع"]
    rows = [r[:2] for r in cases.documents()]
    rows += [(700 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30)))) for i in range(300)]
    rows += [(1100 + i, " ".join(rng.choice(["the", "weather", "don't", "x" * 300, "Straße"]) for _ in range(20))) for i in range(30)]
    monkeypatch.setattr(alignment, "SLICE", 4000)
    got = alignment.align_tokenizers(cases.frame(spark, [(*r, None, None, None, "x", 7, "c") for r in rows]), A, B).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = _alignment(tokenizers, rows)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert any(r[1] == 0 and t for r, (_, t) in zip(want, rows)) and any(r[5] < r[4] for r in want)


def test_pointer_jumping_labels_components():
    rng = np.random.default_rng(3)
    for _ in range(100):
        n = int(rng.integers(1, 60))
        a = np.append(np.flatnonzero(rng.random(n) < 0.4) + 1, n + 1)
        b = np.append(np.flatnonzero(rng.random(n) < 0.4) + 1, n + 1)
        label = alignment.terminal_tokens(alignment.overlap_successors(a, b))
        spans = [(0 if k == 0 else int(e[k - 1]), int(e[k])) for e in (a, b) for k in range(len(e))]
        up = list(range(len(spans)))
        for i, j in itertools.combinations(range(len(spans)), 2):
            if spans[i][0] < spans[j][1] and spans[j][0] < spans[i][1]:
                x, y = up[i], up[j]
                up = [x if u == y else u for u in up]
        assert len(set(zip(up, label.tolist()))) == len(set(up)) == len(set(label.tolist()))


def test_alignment_of_nothing(spark):
    assert alignment.align_tokenizers(cases.frame(spark, []), A, B).collect() == []
    none = alignment.align_tokenizers(cases.frame(spark, [(1, None, *[None] * 6), (2, "", *[None] * 6)]), A, B).collect()
    assert sorted(map(tuple, none)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pair_table_adds_up(spark, tokenizers):
    rows = [r[:2] for r in cases.documents()]
    got = alignment.pair_table(cases.frame(spark), A, B).collect()
    want = Counter((g[0][-1], g[1][-1]) for _, t in rows for g in _groups(tokenizers, t) or [])
    assert {(r["a_id"], r["b_id"]): r["links"] for r in got} == want


# --- ring


def _place(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:4], 16)


def _ring(rows, shards, vnodes):
    """shard -> rows in slot order, row by row."""
    nodes = sorted((_place(f"shard-{s}-{v}"), s * vnodes + v, s) for s in range(shards) for v in range(vnodes))
    ends = np.array([n[0] for n in nodes])
    arcs = defaultdict(list)
    for r in rows:
        mark = hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()
        p, raw = int(mark[:4], 16), (r[1] or "").encode()
        k = int(np.searchsorted(ends, p))
        arcs[k % len(nodes)].append((p - ring.RING if k == len(nodes) else p, zlib.crc32(raw) % ring.SUB, mark, len(raw) + 1, zlib.crc32(raw), r[0]))
    waiting = [(k, place, k, x) for k, own in arcs.items() for place, x in enumerate(sorted(own, key=lambda x: x[:5]))]
    room = {s: len(rows) // shards + (s < len(rows) % shards) for s in range(shards)}
    out = defaultdict(list)
    while waiting:
        rest = []
        for arc, place, node, x in sorted(waiting, key=lambda w: w[:2]):
            s = nodes[node][2]
            if len(out[s]) < room[s]:
                out[s].append(x)
            else:
                rest.append((arc, place, node, x))
        waiting = []
        for arc, place, node, x in rest:
            node = (node + 1) % len(nodes)
            while len(out[nodes[node][2]]) >= room[nodes[node][2]]:
                node = (node + 1) % len(nodes)
            waiting.append((arc, place, node, x))
    return out


@pytest.mark.parametrize("shards,vnodes", [(8, 128), (3, 4), (1, 1)])
def test_ring_equals_row_by_row(spark, shards, vnodes):
    rows = [r[:2] for r in cases.documents()] + [(7, "again and again")] * 60 + [(None, "x")] * 3
    got = ring.shard_documents(cases.frame(spark, [(*r, None, None, None, "x", 7, "c") for r in rows]), shards, vnodes=vnodes).collect()
    want = _ring(rows, shards, vnodes)
    mine = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["shard"], r["slot"])):
        assert r["slot"] == len(mine[r["shard"]])
        mine[r["shard"]].append((r["size"], r["text_crc32"], r["rest"]["doc_id"]))
    assert dict(mine) == {s: [x[3:] for x in own] for s, own in want.items() if own}
    assert Counter((r["rest"]["doc_id"], r["rest"]["text"]) for r in got) == Counter(rows)
    sizes = [len(mine[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_ring_of_repeated_rows_and_none(spark, monkeypatch):
    monkeypatch.setattr(ring, "PIECE", 50)
    got = ring.shard_documents(cases.frame(spark, [(1, "same", *[None] * 6)] * 1003), 8, ["doc_id"]).collect()
    assert Counter(r["shard"] for r in got) == {s: 126 if s < 3 else 125 for s in range(8)}
    assert len({(r["shard"], r["slot"]) for r in got}) == 1003
    assert ring.shard_documents(cases.frame(spark, []), 8).collect() == []


def test_a_further_shard_moves_few_rows(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    at = [{r["rest"]["doc_id"]: r["shard"] for r in ring.shard_documents(docs, n, ["doc_id"]).collect()} for n in (8, 9)]
    moved = sum(at[0][i] != at[1][i] for i in at[0]) / len(at[0])
    assert 1 / 9 - 0.01 < moved < 0.3  # 8/9 of the rows would move if shards were ids modulo their number


def test_written_shards_hold_all_columns(spark, tmp_path):
    docs = cases.frame(spark)
    ring.write_shards(docs, f"{tmp_path}/out", 4, vnodes=16)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert Counter(map(tuple, back.select("rest.*").collect())) == Counter(map(tuple, docs.collect()))
    assert [r["n"] - r["m"] for r in back.groupBy("shard").agg({"slot": "max", "*": "count"}).toDF("shard", "n", "m").collect()] == [1] * 4


def test_words_are_cut_alike_for_all_code_points(tokenizers):
    """The pattern and ranks that the aligner encodes by against the tokenizer itself."""
    a = alignment.Aligner(A, B).a
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}{chr(c)}.{chr(c)}" for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(texts), 2000):
        part = texts[at:at + 2000]
        for t, e in zip(part, tokenizers[0].encode_batch_fast(part, add_special_tokens=False)):
            assert a.encode_ordinary(t) == e.ids, t


def test_alignment_of_a_long_word(tokenizers):
    word = "".join(random.Random(4).choice("etaoinshr") for _ in range(200_000))
    (got,) = alignment.Aligner(A, B).align([f"one {word} two"])
    assert ";".join(c[3].decode() for c in got) == ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in _groups(tokenizers, f"one {word} two"))


def test_byte_alphabet_is_a_permutation():
    assert sorted(alignment.byte_alphabet().values()) == list(range(256))


def test_links_are_one_value_a_slice(spark):
    """Arrays would be read with all the slices of a file at once, and the levels of every link beside them."""
    rows = spark.read.parquet(alignment.write_slices(cases.frame(spark), A, B))
    assert rows.schema["link"].dataType.simpleString() == "binary"
    links, n_links = rows.selectExpr("sum(octet_length(link))", "sum(aggregate(n_links, 0L, (a, x) -> a + x))").first()
    assert links == 2 * n_links > 0


@pytest.mark.parametrize("n", [0, 1, 1 << 16, (1 << 16) + 1])
def test_links_to_any_number_of_pairs(n):
    import pyarrow as pa
    link = np.arange(n)[::-1].astype(alignment._place_type(n)).tobytes()
    half = n // 2
    slice_ = pa.table({"slice": [7], "doc_id": [[1, None]], "n_a": [[n, 0]], "n_b": [[n, 0]], "n_links": [[half, n - half]],
                       "groups_sha256": [["x", ""]], "link": [link]})
    stats = pa.table({"slice": pa.array([7] * n, "int64"), "place": pa.array(np.arange(n, dtype="int32")), "total": pa.array(np.arange(n)),
                      "best": pa.array(np.arange(n) % 2)})
    got = alignment._doc_rows(slice_, stats).to_pylist()
    assert [r["doc_id"] for r in got] == [1, None] and [r["n_links"] for r in got] == [half, n - half]
    assert [r["count_sum"] for r in got] == [sum(range(n - half, n)), sum(range(n - half))]
    assert sum(r["n_best"] for r in got) == half
