"""Whitening, line removal and alignment of tokens against plain versions."""

import bisect
import collections
import hashlib
import math
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from funnelworks.llm import alignment, line_dedup
from funnelworks.llm.alignment import align, alignment_scores, overlaps, terminals
from funnelworks.llm.line_dedup import dedup_lines
from funnelworks.llm.perfect_hash import PerfectHash, dump, load
from funnelworks.llm.whitening import whiten

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, h1 string, drop string, lines int, keeper int, pair int, row int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "h", "d", 1, 2, 3, 4) for i, t in rows], SCHEMA)


# ---- whitening ----------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, x int, n int, i int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)


def check_whitened(got, rows, limit):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in usable]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    rank = min(limit, int((e > e[0] * 1e-11).sum()))
    assert len(got) == n * rank
    by = collections.defaultdict(list)
    for r in got:
        by[r.component].append(r)
    deviations = collections.Counter((i, sum((n * r[j] - sums[j]) ** 2 for j in range(d))) for (i, _), r in zip(usable, x, strict=True))
    for k in range(1, rank + 1):
        own = by[k]
        assert collections.Counter((r.vec_id, int(r.deviation)) for r in own) == deviations
        want = centred @ axes[:, k - 1] / math.sqrt(e[k - 1])
        have = np.array([r.whitened for r in sorted(own, key=lambda r: (r.vec_id, r.deviation))])
        want = want[sorted(range(n), key=lambda j: (usable[j][0], sum((n * x[j][q] - sums[q]) ** 2 for q in range(d))))]
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
        assert all(r.n == n and abs(r.explained - e[k - 1] / e.sum()) < 1e-9 and r.identity_error < 1e-6 for r in own)


def test_whiten(ready):
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((20, 20)) * np.linspace(3, 0.1, 20)
    rows = [(i, [float(c) for c in v @ mix]) for i, v in enumerate(rng.standard_normal((300, 20)))]
    rows += [(7, rows[7][1]), (400, None), (401, [None] + [0.0] * 19), (402, [math.nan] * 20), (403, [math.inf] * 20)]
    check_whitened(whiten(vectors(ready, rows).repartition(4), 8).collect(), rows, 8)
    check_whitened(whiten(vectors(ready, rows), 32).collect(), rows, 32)


def test_whiten_low_rank_and_ties(ready):
    rows = [(i, [float(i), 2.0 * i, 5.0, float(i % 2) * 8]) for i in range(9)]
    check_whitened(whiten(vectors(ready, rows)).collect(), rows, 32)
    # two equal eigenvalues: any orthonormal pair will do
    corners = [(i, [float(a), float(b), 0.0]) for i, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    got = whiten(vectors(ready, corners)).collect()
    assert len(got) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-9 for r in got)
    assert whiten(vectors(ready, [(1, [2.0, 3.0])] * 3)).count() == 0  # no spread
    assert whiten(vectors(ready, [])).count() == 0
    assert whiten(vectors(ready, [(1, None), (2, [])])).count() == 0
    null_id = whiten(vectors(ready, [(None, [1.0]), (2, [3.0])])).collect()
    assert sorted((str(r.vec_id), int(r.deviation)) for r in null_id) == [("2", 128**2), ("None", 128**2)]
    with pytest.raises(Exception, match="vectors of"):
        whiten(vectors(ready, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


# ---- lines --------------------------------------------------------------------
def brute_lines(rows, min_chars, min_docs):
    def key(line):
        return re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))

    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(held[key(x)]) < min_docs or i == max(held[key(x)])]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return collections.Counter(out)


LINE = "This line stands in many documents"
LINE_ROWS = [
    (1, f"a\n{LINE}\nb"), (2, f"\t{LINE.upper()} \r\n{LINE}"), (3, f"{LINE}\n\n{LINE}\nend"), (4, None), (5, ""), (6, "\n \n"),
    (None, f"x\n{LINE}"), (7, "É" * 20 + "\n" + "é" * 20), (8, "É" * 20), (9, "É" * 20 + "\n" + "y" * 19), (10, "y" * 19),
    (11, "y" * 19), (12, "twice in two documents only\n"), (13, "twice in two documents only"), (13, "twice in two documents only"),
    (14, "\n".join(f"long text line number {i % 700}" for i in range(9000))), (15, "\n".join(f"Long text line number {i}" for i in range(500))),
    (16, "\n".join(f"long text line number {i} " for i in range(500))), (17, "\n".join(f" long text line number {i}" for i in range(600))),
]


@pytest.mark.parametrize("keys", [1 << 20, 64])
def test_dedup_lines(ready, monkeypatch, keys):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
    got = [tuple(r) for r in dedup_lines(table(ready, LINE_ROWS).repartition(3)).collect()]
    assert collections.Counter(got) == brute_lines(LINE_ROWS, 20, 3)
    got = [tuple(r) for r in dedup_lines(table(ready, LINE_ROWS), 5, 2).collect()]
    assert collections.Counter(got) == brute_lines(LINE_ROWS, 5, 2)
    assert dedup_lines(table(ready, [])).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 63, 5000):
        first, second = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        first[: n // 2] = 7  # the second hash alone tells them apart
        index = PerfectHash.build(first, second)
        assert sorted(index.slots(first, second).tolist()) == list(range(n))
        again, (column,) = load(dump(index, [first]), 1)
        assert np.array_equal(again.slots(first, second), index.slots(first, second)) and np.array_equal(column, first)
    with pytest.raises(ValueError):
        load(dump(index, [first])[:-1] + b"\x01", 1)


# ---- alignment ----------------------------------------------------------------
_A = Tokenizer.from_file(BYTES)
_A.encode_special_tokens = True
_B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
_BYTE = alignment.byte_letters()
_A_NAMES = {i: t for t, i in _A.get_vocab().items()}


def plain_tokens(text):
    if not text:
        return [], []
    whole = (" " + text).encode()
    a = [(i, bytes(_BYTE.get(c, 63) for c in _A_NAMES[i])) for i in _A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in _B.encode(text):
        name = _B.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if _B.is_byte(i) else name.replace("▁", " ").encode()))
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def ranges(tokens):
    at, out = 0, []
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute_align(rows):
    docs = []
    for doc, text in rows:
        a, b = (ranges(x) for x in plain_tokens(text))
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        sides = [collections.defaultdict(list), collections.defaultdict(list)]
        for side, tokens in zip(sides, (a, b), strict=True):
            for i, _, e in tokens:
                side[bisect.bisect_left(ends, e)].append(str(i))
        groups = ["|".join(",".join(side[g]) for side in sides) for g in range(len(ends))]
        links, lo = [], 0
        for i, s, e in a:
            while lo < len(b) and b[lo][2] <= s:
                lo += 1
            j = lo
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        docs.append((doc, len(a), len(b), len(groups), links, ";".join(groups)))
    count = collections.Counter(p for d in docs for p in set(d[4]))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return collections.Counter(
        (d, n_a, n_b, n_g, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
         hashlib.sha256(g.encode()).hexdigest() if g else "")
        for d, n_a, n_b, n_g, links, g in docs
    )


TEXTS = [
    (1, "Hello  world, unbelievably\ttokenized"), (2, None), (3, ""), (4, " "), (5, "  "), (6, "a "), (7, "a \n b\n  c \r\n"),
    (8, "x▁y has the sign"), (9, "<|endoftext|> <s></s> <0x41> <unk>"), (10, "été 日本語テキスト 🙂 ﬁ é    z\x1c \x85 q"),
    (11, "\x00\x01"), (None, "no id"), (12, "twice"), (12, "twice"), (13, "don't we'll   123456 7.8%"), (14, "\n"),
    (15, " ".join(f"word{i * 7919 % 3001}x" for i in range(5000))), (16, "q" * 3000), (17, "▁"), (18, "a  b 　 c"),
]


@pytest.mark.parametrize("hot", [1 << 20, 20])
def test_alignment(ready, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT", hot)
    rng = np.random.default_rng(11)
    letters = list("ab  \n\t\r,.'’é日▁0<|>x7  -_\x1f")
    rows = TEXTS + [(100 + i, "".join(rng.choice(letters, rng.integers(1, 40)))) for i in range(200)]
    got = [tuple(r) for r in alignment_scores(table(ready, rows).repartition(3), BYTES, PIECES).collect()]
    assert collections.Counter(got) == brute_align(rows)
    assert alignment_scores(table(ready, []), BYTES, PIECES).count() == 0


def test_alignment_of_given_documents(ready):
    docs = ready.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = [tuple(r) for r in alignment_scores(docs, BYTES, PIECES).collect()]
    assert collections.Counter(got) == brute_align(rows)


def test_align_texts(ready):
    got = align(table(ready, [(1, "Hello world"), (2, None)]), BYTES, PIECES).collect()
    one, two = sorted(got, key=lambda r: r.doc_id)
    assert one.n_groups == one.groups.count(b";") + 1 and sum(one.times) == one.n_links
    assert (two.n_a, two.groups, two.pairs) == (0, b"", [])


def test_pointer_jumping():
    rng = np.random.default_rng(4)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(size - 1) < q) + 1, size) for q in rng.random(2))
        ends = np.intersect1d(a, b)
        got = terminals(a, b)
        want = np.concatenate((np.searchsorted(ends, a), np.searchsorted(ends, b)))
        assert np.array_equal(np.unique(got, return_inverse=True)[1], want)
        pairs = {
            (i, j) for i in range(len(a)) for j in range(len(b))
            if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])
        }
        assert set(zip(*(x.tolist() for x in overlaps(a, b)), strict=True)) == pairs
