"""Document operators against brute force, with the cases of ``cases.documents``."""

import hashlib
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

from strata.llm import bytewords as bw  # noqa: E402
from strata.llm import packing, sketch, suffix, templates  # noqa: E402
from strata.llm.queries import tokenizer_path  # noqa: E402


def test_words_equal_the_pattern():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab\x0b\x1c \n\té ") for _ in range(rng.randint(0, 30))) for _ in range(200)] + ["x" * 50, ""]
    bw.SLICE, old = 16, bw.SLICE
    try:
        w = bw.split(*bw.string_buffers(pa.array(texts)))
    finally:
        bw.SLICE = old
    seen = {}
    for i, t in enumerate(texts):
        words = cases.WORD.findall(t)
        own = w.hashes[w.first[i]:w.first[i + 1]].tolist()
        assert [w.data[a:b].tobytes().decode() for a, b in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])] == words
        for word, h in zip(words, own):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def _brute_repeats(rows, window):
    texts = {i: cases.WORD.findall(t or "") for i, t in rows if i is not None}
    seen, out = set(), {}
    for i in sorted(texts):
        w = texts[i]
        gone = set()
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                gone.update(range(s, s + window))
            seen.add(k)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [20, 50])
def test_repeats_equal_brute_force(spark, window):
    rows = cases.documents()
    got = suffix.remove_repeats(cases.frame(spark), window=window).collect()
    want = _brute_repeats([r[:2] for r in rows], window)
    assert len(got) == len(rows)
    for r in got:
        assert r["kept_sha256"] == hashlib.sha256(" ".join(cases.WORD.findall(r["kept_text"])).encode()).hexdigest()
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]
        else:
            assert r["n_removed"] == 0
    assert any(r["n_removed"] for r in got)


def _shingles(text, k):
    w = cases.WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rows = cases.documents()
    sets = {i: _shingles(t, k) for i, t, *_ in rows if i is not None}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = cases.components(ids, links)
    got = sketch.near_duplicates(cases.frame(spark), k=k).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_chain_of_near_copies_without_a_common_centre(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[3 * i:3 * i + 100]) for i in range(60)]  # neighbours overlap, far ones don't
    rows = [(i, t, "en", "s", len(t), "x", 1, "c") for i, t in enumerate(texts)]
    sets = [_shingles(t, 5) for t in texts]
    links = [(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in sketch.near_duplicates(cases.frame(spark, rows)).collect()}
    assert got == cases.components(range(60), links) and set(got.values()) == {0}


def test_sketches_fill_every_bin_and_estimate_jaccard():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (0, 1, 2, 5, 96, 3000)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    s = sketch.sketches(np.concatenate(sets), first, 96)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (s[0] == empty).all() and (s[1:] != empty).all()
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate([a[:1800], rng.integers(0, 2**63, 200, dtype=np.uint64)])
    x = sketch.sketches(np.concatenate([a, b]), np.array([0, 2000, 4000]), 2048)
    assert abs((x[0] == x[1]).mean() - 1800 / 2200) < 0.04


def _brute_templates(rows, min_docs):
    """(text, line number) of the lines to drop, from the definition."""
    def mark(x):
        w = cases.WORD.findall(x)
        fields = ["<*>" if any(c in "0123456789" for c in v) else v for v in w]
        return tuple(fields if 2 * fields.count("<*>") <= len(w) else w)

    texts = [((i, t), [(n, mark(x), tuple(cases.WORD.findall(x))) for n, x in enumerate(t.split("\n")) if cases.WORD.findall(x)]) for i, t in rows if t is not None]
    rows_of = Counter(m for _, lines in texts for m in {m for _, m, _ in lines})
    template = {(key, n): m for key, lines in texts for n, m, _ in lines if rows_of[m] >= min_docs}
    # groups of the other long lines
    leaf = {}
    for key, lines in texts:
        for n, m, _ in lines:
            if (key, n) not in template and len(m) >= templates.LONG:
                leaf.setdefault((len(m), m[:templates.DEPTH]), []).append((key, n, m))
    for own in leaf.values():
        c = Counter((p, w) for _, _, m in own for p, w in enumerate(m))
        for j in reversed(range(templates.LEVELS)):
            shape = {(key, n): tuple(w if c[p, w] >= min_docs * 4 ** j else None for p, w in enumerate(m)) for key, n, m in own}
            size = Counter(shape[key, n] for key, n, _ in own)
            for key, n, m in own:
                x = shape[key, n]
                if size[x] >= min_docs and len(m) - x.count(None) >= templates.CONSTANT * len(m):
                    template[key, n] = (j, x)
    votes = {}
    for key, lines in texts:
        alone = [e for n, _, e in lines if (key, n) not in template]
        shared = [e for n, _, e in lines if (key, n) in template]
        own, common = sum(map(len, alone)), sum(map(len, shared))
        vote = (0, *sorted(alone)) if own >= common else (1, *sorted(alone + shared)) if common <= templates.FEW else None
        for n, _, _ in lines:
            if vote and (key, n) in template:
                votes.setdefault(template[key, n], set()).add(vote)
    return {at for at, m in template.items() if len(votes.get(m, ())) >= min_docs}


def _template_case(spark, rows, min_docs=10):
    """Rows dropped by the operator, after it has been held against brute force."""
    got = templates.drop_template_lines(cases.frame(spark, [(*r, None, None, None, "x", 7, "c") for r in rows]), min_docs=min_docs).collect()
    gone = _brute_templates(rows, min_docs)
    want = Counter((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if ((i, t), n) not in gone)) for i, t in rows)
    assert Counter((r["rest"]["doc_id"], r["text"]) for r in got) == want
    return got


def test_blocks_of_boilerplate_go_whole(spark):
    rng = random.Random(1)
    header, footer = "Home | About | Contact us\nToday's offers on this page", "All rights reserved by the owners\nRead our terms of use\nTel: 555-1234 555-9999"
    rows = [(i, f"{header}\n{cases.prose(rng, 60)}\n{cases.prose(rng, 40)}\n{footer}") for i in range(60)]
    got = _template_case(spark, rows)
    assert all(r["n_dropped"] == 5 and r["text"].count("\n") == 1 for r in got)


def test_documents_of_boilerplate_alone(spark):
    rows = [(i, f"copyright notice of this site for everyone\nPosted by {'alice bob carol dave'.split()[i % 4]}\nTel: 555-1234 555-{i:04}") for i in range(80)]
    rows += [(100 + i, f"{t}\nclick here to read more about gadgets {'abcdefghijklmnopqrstuvwxyz'[i % 26] * 4}{'xyz'[i % 3]} today\nPosted by alice") for i, (_, t) in enumerate(rows[:70])]
    got = _template_case(spark, rows)
    assert all("copyright" not in r["text"] and "Posted" not in r["text"] and "click" not in r["text"] for r in got)


def test_copies_switch_nothing_off_and_lose_nothing(spark):
    rng = random.Random(2)
    banner = "subscribe to our letter and never miss a story"
    body = "\n".join(cases.prose(rng, 12) for _ in range(9))
    rows = [(i, f"{cases.prose(rng, 50)}\n{banner}") for i in range(40)]
    rows += [(100 + i, f"{body}\n{banner}") for i in range(90)]  # copies
    lines = body.split("\n")
    for i in range(90):  # near copies, each with a line of its own
        own = list(lines)
        own[i % 9] = cases.prose(rng, 12)
        rows.append((300 + i, "\n".join([*own, banner])))
    for r in _template_case(spark, rows):
        assert r["n_dropped"] == 1 and banner not in r["text"]


def test_several_templates_in_a_crowded_leaf(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = {0: lambda: f"the user has {word()} left the red room at noon", 1: lambda: f"the user has come to {word()} the old house again",
            2: lambda: f"the user has {' '.join(word() for _ in range(7))}"}
    rows = [(i, f"{cases.prose(rng, 40)}\n{line[i % 3]()}") for i in range(150)]
    got = _template_case(spark, rows)
    assert Counter((r["rest"]["doc_id"] % 3, r["n_dropped"]) for r in got) == {(0, 1): 50, (1, 1): 50, (2, 0): 50}


def test_template_lines(spark):
    rows = [r[:2] for r in cases.documents()]
    _template_case(spark, rows)
    # with a page of their own the twelve pages stand for themselves: number line and shared passage go
    rng = random.Random(11)
    own = [(i, f"{t}\n{cases.prose(rng, 120)}" if i is not None and 300 <= i < 312 else t) for i, t in rows]
    assert sum(r["n_dropped"] for r in _template_case(spark, own)) == 24


def test_template_with_variable_words(spark):
    rng = random.Random(5)
    rows = []
    for i in range(30):
        line = f"login accepted for user {cases.prose(rng, 1)}{'q' * (i + 1)} from the host {rng.choice('pqrstuvw')}{rng.choice('abcdefgh')}x today at noon"
        rows.append((i, f"{cases.prose(rng, 12)}\n{line}\n{cases.prose(rng, 12)}", "en", "s", 0, "x", 1, "c"))
    got = templates.drop_template_lines(cases.frame(spark, rows), min_docs=10).collect()
    assert all(r["n_dropped"] == 1 and "logged" not in r["text"] and r["text"].count("\n") == 1 for r in got)


def test_copied_documents_keep_their_lines(spark):
    rng = random.Random(6)
    text = "\n".join(cases.prose(rng, 9) for _ in range(8))
    rows = [(i, text, "en", "s", 0, "x", 1, "c") for i in range(25)] + [(100 + i, cases.prose(rng, 50), "en", "s", 0, "x", 1, "c") for i in range(5)]
    assert sum(r["n_dropped"] for r in templates.drop_template_lines(cases.frame(spark, rows), min_docs=10).collect()) == 0


def test_packing_loses_no_token(spark):
    from tokenizers import Tokenizer
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = cases.documents()
    got = [r.asDict() for r in packing.pack_documents(cases.frame(spark), path).collect()]
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 2048):
            part = ids[s:s + 2048]
            want[(i, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")) for r in got) == want
    full = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert full.setdefault(r["sequence_id"], 0) == r["offset"]
        full[r["sequence_id"]] += r["length"]
    assert max(full.values()) <= 2048


def test_packing_fills_windows():
    rng = random.Random(1)
    lengths = [min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(3000)]
    sequences = packing.pack(lengths)
    assert sorted(i for _, s in sequences for i in s) == list(range(3000))
    used = [sum(lengths[i] for i in s) for _, s in sequences]
    assert all(u <= t and (u == t or t == 2048) for u, (t, _) in zip(used, sequences))
    assert sum(used) > 0.99 * sum(t for t, _ in sequences)


@pytest.mark.parametrize("operator", [
    lambda d: suffix.remove_repeats(d), lambda d: sketch.near_duplicates(d), lambda d: templates.drop_template_lines(d),
    lambda d: packing.pack_documents(d, tokenizer_path("word_bpe_49k.json"))])
def test_empty_table(spark, operator):
    assert operator(cases.frame(spark, [])).count() == 0
