"""Toxicity scores on text restored by noisy-channel decoding.

Writers hide words: ``1d10t``, ``i d i o t``, ``idiiiiot``, ``i.d.i.o.t``.  Words of letters alone pass as
they are.  A word with digits or signs among its letters, with a letter three times running, or a run
of single letters is a character lattice: every sign stands for itself, for letters that it
resembles, or for nothing; a repeated letter may be one or two.  A Viterbi search finds the letters
with the highest probability under a character trigram model (counted over all texts of the
input, by Spark) and the channel's costs.

The score rests on words and word beginnings: the log likelihood ratio of each between toxic and
other labelled documents weighs it, and a logistic curve over the largest weight and the sum of
weights in a document gives the probability.  The curve is fitted on evidence from the other half of
the labelled rows, so no row vouches for itself.  Learning reads at most ``SAMPLE`` labelled rows and
keeps ``TERMS`` terms, so what is broadcast has a fixed bound; the character model has 28³ numbers.

Null and empty texts are scored as texts without evidence; a null id counts as not held out.
Nothing but the text enters a score.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

from . import bytewords as bw

SAMPLE = 40_000
TERMS = 20_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
LEAST = 6.0  # log likelihood ratio of a term that counts
N_LETTERS = 28  # boundary, a-z, other letters

# Signs that stand for letters they resemble.
RESEMBLES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou", "%": "aeiou"}

_SPLIT = bytes(c for c in range(128) if not chr(c).isalnum())
_WORD_TABLE = bw.separators(_SPLIT)


def _fold_table() -> np.ndarray:
    """Class of each code point below 0x250: 0 none, 1-26 the base letter, 27 another letter."""
    table = np.zeros(0x250, np.int64)
    for cp in range(0x250):
        base = unicodedata.normalize("NFKD", chr(cp))[0].lower()
        table[cp] = ord(base) - 96 if "a" <= base <= "z" else 27 * chr(cp).isalpha()
    return table


FOLD = _fold_table()


def _count_rows(batches):
    """Character trigram counts (code, n) of the texts' words, summed per task."""
    total = np.zeros(N_LETTERS**3, np.int64)
    for batch in batches:
        for part in bw.slices(batch, "text", bw.SLICE):
            text = " ".join(t for t in part.column("text").to_pylist() if t)
            cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
            c = np.where(cp < len(FOLD), FOLD[np.minimum(cp, len(FOLD) - 1)], 27)
            c = np.concatenate([[0, 0], c, [0]])
            code = (c[:-2] * N_LETTERS + c[1:-1]) * N_LETTERS + c[2:]
            code = code[(c[1:-1] > 0) | (c[2:] > 0)]
            total += np.bincount(code, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log p(c | a, b) as a cube over letter classes (class 0: the word's boundary)."""
    rows = docs.select(F.col(text_col).alias("text")).where("text is not null").mapInArrow(_count_rows, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = np.zeros(N_LETTERS**3)
    for r in rows.collect():  # 28^3 rows at most
        counts[r["code"]] = r["n"]
    cube = counts.reshape(N_LETTERS, N_LETTERS, N_LETTERS)
    pair = cube.sum(axis=0)
    low = (pair + 0.5) / (pair + 0.5).sum(axis=1, keepdims=True)
    one = (cube + 2.0 * low[None]) / (cube.sum(axis=2, keepdims=True) + 2.0)
    return np.log(one)


# Costs of the channel, as log probabilities.
_AS_IS, _SIGN, _DROP, _REPEAT = 0.0, -0.7, -1.5, -0.4


# Longer runs of one letter or sign are cut to two.
_RUN = re.compile(r"(\D)\1{2,}")


def decode(word: str, model, breaks: float | None = None) -> str:
    """The letters most probably meant by ``word``: Viterbi over its lattice, with states of two letters.

    With ``breaks``, a sign may also end a word at this cost; the words are set apart by spaces.
    """
    best: dict = {(0, 0): (0.0, None)}  # state: score, path back
    last = ""
    for ch in _RUN.sub(r"\1\1", word.lower()):
        cls = int(FOLD[ord(ch)]) if ord(ch) < len(FOLD) else 27 * ch.isalpha()
        ways = []
        if cls:
            ways.append((cls, chr(96 + cls) if cls < 27 else ch, _AS_IS))
            if ch == last:
                ways.append((None, "", _REPEAT))
        else:
            ways += [(ord(x) - 96, x, _SIGN) for x in RESEMBLES.get(ch, "")]
            ways.append((None, "", _DROP if ch.isdigit() or ch in RESEMBLES else -0.1))
        between = breaks is not None and not ch.isalnum()
        last = ch
        now: dict = {}
        for (a, b), (score, path) in best.items():
            for cls, out, cost in ways:
                key, s = ((a, b), score + cost) if cls is None else ((b, cls), score + cost + model[a][b][cls])
                if key not in now or s > now[key][0]:
                    now[key] = (s, (path, out) if out else path)
            if between and b:
                s = score + breaks + model[a][b][0]
                if (b, 0) not in now or s > now[b, 0][0]:
                    now[b, 0] = (s, (path, " "))
        best = now
    path = max((score + (model[a][b][0] if b else 0), i, path) for i, ((a, b), (score, path)) in enumerate(best.items()))[2]
    out = []
    while path:
        path, x = path
        out.append(x)
    return "".join(reversed(out))


# Single letters set apart by signs, with no letter or apostrophe next to them.
_SINGLE = r"(?:[^\W_]|[@$!|+#%€£¡])"
_LOOSE = re.compile(rf"(?<![^\W_])(?<!['’]){_SINGLE}(?:[ \t.\-_*]{{1,3}}{_SINGLE}){{2,}}(?![^\W_])")
_APART = re.compile(r"[ \t.\-_*]+")
_BREAKS = (None, -1.5, 0.0, 2.0)  # a trigram model alone can't tell where words end: several costs of a break
_BEFORE, _AFTER = ".,;:?\"'()[]{}<>", ".,;:?\"'()[]{}<>!"
# Kinds of code points; those from 0x10000 on count as letters.
_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)] + [True])
_SIGNS = np.array([chr(c) in "0123456789@$!|+*#%€£¡" for c in range(0x10001)])
_WEAK = _SIGNS | np.array([chr(c) in "._-(<" for c in range(0x10001)])  # signs if letters are on both sides
_SPACE = np.array([c < 256 and chr(c).encode("latin-1") in bw.SPACES for c in range(0x10001)])
_ALNUM = np.array([chr(c).isalnum() for c in range(0x10000)] + [True])


def _words(span: str, model, breaks) -> str:
    """The different words restored from ``span``, decoded at each of the costs ``breaks``."""
    found = dict.fromkeys(w for c in breaks for w in decode(span, model, c).split(" "))
    return " ".join(w for w in found if len(w) > 2)


def _restore(span: str, model, cache: dict) -> str:
    """Words of an odd run, as one word and with its signs as breaks; with and without a last ``!``."""
    got = cache.get(span)
    if got is None:
        if len(cache) > 50_000:
            for key in [k for k in cache if isinstance(k, str)]:
                del cache[key]
        spans = dict.fromkeys((span.lstrip(_BEFORE).rstrip(_AFTER), span.strip(_BEFORE)))
        got = " ".join(_words(x, model, (None,) if x.isalnum() else (None, 0.0)) for x in spans if len(x) > 2)
        if len(span) <= 200:
            cache[span] = got
    return got


def _join(span: str, model) -> str:
    """Words of a run of single letters; gaps that are wider than its narrowest also end words."""
    gaps = _APART.findall(span)
    least = min(map(len, gaps))
    found = [_words(span, model, _BREAKS)]
    if max(map(len, gaps)) > least:
        wide = re.compile(rf"[ \t.\-_*]{{{least + 1},}}")
        found += [_words(x, model, (None,)) for x in wide.split(span) if len(x) > 2]
    return " ".join(dict.fromkeys(w for f in found for w in f.split()))


def restored(data: np.ndarray, offsets: np.ndarray, model: np.ndarray, cache: dict) -> tuple[list[int], list[str]]:
    """(text, words): what the odd spans of some texts stand for.

    Odd are runs without white space that have a sign or digit next to a letter, a point, dash or bracket between letters, or a
    letter three times running, however long; and runs of single letters.
    """
    owner: list[int] = []
    words: list[str] = []
    if len(data) < 3:
        return owner, words
    if ("cube",) not in cache:
        cache["cube",] = model.tolist()
    cube, raw, cuts = cache["cube",], data.tobytes(), offsets.tolist()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
    joined = "\n" + "\n".join(texts) + "\n"
    first = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])  # of each text in joined
    cp = np.minimum(np.frombuffer(joined.encode("utf-32-le"), np.uint32), 0x10000)
    letter, sign, weak, space = _LETTER[cp], _SIGNS[cp], _WEAK[cp], _SPACE[cp]
    before = np.maximum.accumulate(np.where(weak, 0, np.arange(len(cp))))  # the last character that is no sign
    odd = np.zeros(len(cp), bool)
    odd[1:] = letter[1:] & (sign[:-1] | weak[:-1] & letter[before[:-1]]) | sign[1:] & letter[:-1]
    odd[2:] |= letter[2:] & (cp[2:] == cp[1:-1]) & (cp[1:-1] == cp[:-2])
    at = np.flatnonzero(odd)
    if len(at):
        cuts = np.flatnonzero(space)
        k = np.unique(np.searchsorted(cuts, at))
        begin, end = cuts[k - 1] + 1, cuts[k]
        for b, e, t in zip(begin.tolist(), end.tolist(), (np.searchsorted(first, begin, "right") - 1).tolist()):
            got = _restore(joined[b:e], cube, cache)
            if got:
                owner.append(t)
                words.append(got)
    alone = _ALNUM[cp]
    lone = np.zeros(len(cp), bool)
    lone[1:-1] = (alone | sign)[1:-1] & ~alone[:-2] & ~alone[2:]
    at = np.flatnonzero(lone)
    near = np.diff(at) <= 4
    loose = at[:-2][near[:-1] & near[1:] & (letter[at[:-2]] | letter[at[1:-1]] | letter[at[2:]])] if len(at) > 2 else at[:0]
    for t in np.unique(np.searchsorted(first, loose, "right") - 1).tolist():
        for m in _LOOSE.finditer(texts[t]):
            got = _join(m.group(), cube) if any(c.isalpha() for c in m.group()) else ""
            if got:
                owner.append(t)
                words.append(got)
    return owner, words


def term_hashes(w: bw.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the words and word beginnings of each text."""
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    hashes, owner = [w.hashes], [text]
    own, gram = np.arange(len(text)), np.zeros(len(text), np.uint64)
    for j in range(max(PREFIXES)):
        more = w.ends[own] - w.starts[own] > j
        own, gram = own[more], gram[more]
        gram = gram * np.uint64(0x100000001B3) + _LOWER[w.data[w.starts[own] + j]]
        if j + 1 in PREFIXES:
            longer = w.ends[own] - w.starts[own] > j + 1
            hashes.append(bw.mix(gram[longer] + np.uint64(j)))
            owner.append(text[own[longer]])
    return np.concatenate(owner), np.concatenate(hashes)


_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64)


def _text_terms(part, model, cache):
    """(text, hash) of the terms of each text's words, plain and restored."""
    data, offsets = bw.string_buffers(part.column("text"))
    o, h = term_hashes(bw.split(data, offsets, lower=True, table=_WORD_TABLE))
    owner, extra = restored(data, offsets, model, cache)
    if extra:
        o2, h2 = term_hashes(bw.split(*bw.string_buffers(pa.array(extra)), lower=True, table=_WORD_TABLE))
        o, h = np.concatenate([o, np.array(owner)[o2]]), np.concatenate([h, h2])
    return o, h


def _term_rows(model, labels: dict[int, tuple[int, int]]):
    """(term, t0, c0, t1, c1): toxic and clean documents with a term in either half, summed per slice."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            batch = batch.filter(pa.array([i in labels for i in ids], pa.bool_()))
            for part in bw.slices(batch, "text"):
                half, toxic = np.array([labels[i] for i in part.column("doc_id").to_pylist()]).T
                o, h = _text_terms(part, model, cache)
                both = np.unique(np.rec.fromarrays([h, o]))
                term, at = np.unique(both.f0, return_inverse=True)
                kind = 2 * half[both.f1] + 1 - toxic[both.f1]
                n = np.bincount(at * 4 + kind, minlength=4 * len(term)).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), *(pa.array(n[:, j]) for j in range(4))], ["term", "t0", "c0", "t1", "c1"])

    return run


def _weights(rows: DataFrame, t, c, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights): the TERMS largest log likelihood ratios among terms that lean to toxic documents."""
    if not toxic or not clean:
        return np.zeros(0, np.uint64), np.zeros(0)
    p = toxic / (toxic + clean)
    n = t + c
    ratio = t * F.log(t / (n * p)) + F.when(c > 0, c * F.log(c / (n * (1 - p)))).otherwise(0.0)
    best = rows.select("term", t.alias("t"), (n * p).alias("e"), ratio.alias("w")).where(F.expr(f"t > 1 and t > e and w >= {LEAST}"))
    got = best.orderBy(F.desc("w"), "term").limit(TERMS).collect()
    got = sorted((r["term"] & 0xFFFFFFFFFFFFFFFF, r["w"]) for r in got)
    return np.array([g[0] for g in got], np.uint64), np.array([g[1] for g in got])


def _evidence(part, model, cache, known) -> np.ndarray:
    """Per text: log of 1 + the largest weight, and of 1 + the sum of weights, of each (terms, weights) of ``known``."""
    out = np.zeros((part.num_rows, 2 * len(known)))
    o, h = _text_terms(part, model, cache)
    for j, (terms, weights) in enumerate(known):
        if not len(terms):
            continue
        sieve = cache.get(("sieve", j))
        if sieve is None:  # most terms are unknown: they fall through here
            sieve = cache[("sieve", j)] = np.zeros(1 << 20, bool)
            sieve[(terms >> np.uint64(44)).astype(np.int64)] = True
        may = np.flatnonzero(sieve[(h >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(terms, h[may]), len(terms) - 1)
        hit = terms[place] == h[may]
        both = np.unique(o[may[hit]] * len(terms) + place[hit])
        if len(both):
            np.maximum.at(out[:, 2 * j], both // len(terms), weights[both % len(terms)])
            np.add.at(out[:, 2 * j + 1], both // len(terms), weights[both % len(terms)])
    return np.log1p(out)


def _evidence_rows(model, known, labels):
    def run(batches):
        cache: dict = {}
        for batch in batches:
            batch = batch.filter(pa.array([i in labels for i in batch.column("doc_id").to_pylist()], pa.bool_()))
            for part in bw.slices(batch, "text"):
                e = _evidence(part, model, cache, known).reshape(-1, 2, 2)
                half, y = np.array([labels[i] for i in part.column("doc_id").to_pylist()]).T
                e = e[np.arange(len(e)), 1 - half]  # evidence from the other half
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1]), pa.array(y.astype(np.int32))], ["top", "total", "y"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and weights by Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
    return beta


class Model:
    """What a scoring task needs: the character cube, at most TERMS terms and three numbers."""

    def __init__(self, characters, known, beta):
        self.characters, self.known, self.beta = characters, known, beta

    def score(self, part, cache: dict) -> np.ndarray:
        e = _evidence(part, self.characters, cache, [self.known])
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + e @ self.beta[1:], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from ``labels`` (id, 0/1); its rows are the training rows, cut to SAMPLE by a hash of the id."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")
    characters = character_model(d)
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
    sample = y.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(SAMPLE).collect()
    label = {r["doc_id"]: ((r["doc_id"] * 0x9E3779B97F4A7C15 >> 40) & 1, int(r["y"] > 0)) for r in sample}
    n = np.zeros((2, 2), int)
    for half, toxic in label.values():
        n[half, toxic] += 1
    if not label:
        return Model(characters, (np.zeros(0, np.uint64), np.zeros(0)), np.zeros(3))
    rows = d.mapInArrow(_term_rows(characters, label), "term long, t0 long, c0 long, t1 long, c1 long").groupBy("term").agg(
        *(F.sum(c).alias(c) for c in ("t0", "c0", "t1", "c1"))).where("t0 + t1 > 1")
    rows = cut_lineage(rows)
    halves = [_weights(rows, F.col(f"t{i}"), F.col(f"c{i}"), n[i, 1], n[i, 0]) for i in (0, 1)]
    known = _weights(rows, F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1"), n[:, 1].sum(), n[:, 0].sum())
    rows = d.mapInArrow(_evidence_rows(characters, halves, label), "top double, total double, y int").collect()
    x, y = np.array([(r["top"], r["total"]) for r in rows]).reshape(-1, 2), np.array([r["y"] for r in rows], float)
    beta = _logistic(x, y) if len(set(y.tolist())) == 2 else np.array([np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0, 0])
    return Model(characters, known, beta)


def _score_rows(model: Model):
    def run(batches):
        cache: dict = {}
        for batch in batches:
            score = [np.zeros(0)]
            for part in bw.slices(batch, "text"):
                score.append(model.score(part, cache))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(score))], ["doc_id", "score"])

    return run


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_score_rows(model), f"doc_id {dict(d.dtypes)['doc_id']}, score double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            for part in bw.slices(batch.append_column("text", batch.column(text_col)) if text_col != "text" else batch, "text"):
                yield part.select(batch.schema.names).filter(pa.array(model.score(part, cache) < threshold))

    return docs.mapInArrow(run, docs.schema)
