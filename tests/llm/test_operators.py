"""Every operator against a plain version, on small rows with nulls, empty and
long texts, ties, repeated rows, an empty table and clashing extra columns."""

import collections
import hashlib
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from funnelworks.llm import language_id, token_counts, toxicity
from funnelworks.llm.components import components
from funnelworks.llm.decontamination import contained_items, drop_contaminated
from funnelworks.llm.exact_dedup import drop_exact_copies, exact_groups
from funnelworks.llm.id_files import IdReader, _table, read_ids, write_ids
from funnelworks.llm.near_dedup import drop_near_copies, fast_similarity_sketch, near_duplicates
from funnelworks.llm.packing import fill, make_plan, pack
from funnelworks.llm.rans import decode_block, encode_block, scaled
from funnelworks.llm.url_rules import Rule, judge_urls
from funnelworks.llm.warc import archive_pages
from funnelworks.llm.words import find_letters, folded, slices

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i * 7919 % 3001}" for i in range(6000))
BASE = " ".join(f"b{i}" for i in range(200))
TEXTS = [
    (1, "Hello  world, hello\tWorld"), (2, "Hello world, hello World"), (3, None), (4, ""), (5, " \n "), (6, LONG),
    (7, LONG.replace("w19 ", "W19 ")), (8, BASE), (9, BASE.replace("b7 ", "x ")), (10, BASE.replace("b150 ", "y ")),
    (11, "one"), (12, "ONE"), (13, "a<|endoftext|>b  <|endoftext|> c"), (14, "été\u00a0\u2003déjà \u3000 vu\x1cx\x85 '$%s don't"),
    (15, "e\u0301 ſ Σς ÀÿŸ \x01 z\x01z"), (None, "no id"), (16, "twice"), (16, "twice"),
]
SCHEMA = "doc_id long, text string, lang string, digest string, run string, n int, row int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "d", "r", 1, 2) for i, t in rows], SCHEMA)


@pytest.fixture
def docs(ready):
    return table(ready, TEXTS).repartition(3)


@pytest.fixture
def nothing(ready):
    return table(ready, [])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_exact_groups(docs, nothing):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in TEXTS]
    groups = collections.defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    want = []
    for i, t in norm:
        least = min((x for x in groups[t] if x is not None), default=None)
        want.append((i, least, len(groups[t]), i == least, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in exact_groups(docs).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert exact_groups(nothing).count() == 0
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x) for x in {min((y for y in g if y is not None), default=None) for g in groups.values()})


def brute_components(rows, k):
    sets = {i: shingle_set(t, k) for i, t in rows if i is not None}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, nothing, k):
    rows = near_duplicates(docs, k).collect()
    assert len(rows) == len(TEXTS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == brute_components(TEXTS, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert near_duplicates(nothing, k).count() == 0


def test_near_duplicates_chain(ready):
    """A chain whose ends are far apart, and many members that no star links."""
    chain = [(100 + j, " ".join(("c" if i >= 6 * j else "d") + str(i) for i in range(120))) for j in range(8)]
    rng = np.random.default_rng(3)
    loose = []
    for j in range(60):
        own = [f"s{i}" for i in range(100)]
        for i in rng.choice(100, 7, replace=False):
            own[i] = f"q{j}x{i}"
        loose.append((500 - j, " ".join(own)))
    rows = chain + loose
    got = near_duplicates(table(ready, rows), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 2)
    kept = {r.doc_id for r in drop_near_copies(table(ready, rows), 2).collect()}
    assert kept == {c for _, c in brute_components(rows, 2).values()}


def test_texts_under_one_id_are_judged_each(ready):
    other = " ".join(f"o{i}" for i in range(90))
    rows = [(3, BASE.replace("b7 ", "x ")), (5, BASE), (5, other), (6, other.replace("o5 ", "x ")), (None, BASE + " z"), (None, "clean words of its own")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_duplicates(table(ready, rows), 2).collect() if r.doc_id}
    assert got == {(3, 199): 3, (5, 199): 3, (5, 89): 5, (6, 89): 5}
    left = drop_near_copies(table(ready, rows), 2)
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, (rows[0], rows[2], rows[4], rows[5])))
    bench = ready.createDataFrame([(1, " ".join(BASE.split()[20:60]))], "item_id long, text string")
    clean = drop_contaminated(table(ready, rows), bench)
    assert sorted(map(str, ((r.doc_id, r.text) for r in clean.collect()))) == sorted(map(str, (rows[2], rows[3], rows[5])))


def test_components(ready):
    rng = np.random.default_rng(5)
    path = [(i, i + 1) for i in range(1000, 1040)]
    star = [(2000, i) for i in range(2001, 2020)]
    mixed = [(int(a), int(b)) for a, b in rng.integers(0, 90, (70, 2))]
    for edges in (path, star, path + star + mixed + mixed[:5], []):
        least = {x: x for e in edges if e[0] != e[1] for x in e}
        for _ in edges:
            for a, b in edges:
                if a != b:
                    least[a] = least[b] = min(least[a], least[b])
        found = components(ready.createDataFrame(edges, "a long, b long")).collect()
        assert len(found) == len(least)
        assert {r.node: r.component for r in found} == least


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    a, b = np.sort(x[:900]), np.sort(x[100:])  # 800 of 1000
    s = fast_similarity_sketch(np.concatenate((a, b, x[:1])), np.array([0, 900, 1800, 1801]), 400)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.1


def letters(text):
    t = "".join(c.lower()[:1] for c in unicodedata.normalize("NFC", text or ""))
    t = regex.sub(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])", r" \1 ", t)
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", t)


def five(text):
    w = letters(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({("whole", *w)} if w else set())


def test_contained_items(ready, docs, nothing):
    items = [(1, "W0, w1918! " + " ".join(LONG.split()[2:14])), (2, " ".join(LONG.split()[50:70])), (3, "one"), (4, None), (5, ""), (6, "a b c d e f"), (2, " ".join(LONG.split()[50:70]))]
    bench = ready.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, n_shared int")
    want = set()
    for d, t in TEXTS:
        for i, q in items:
            own, item = five(t), five(q)
            if item and 100 * len(own & item) >= 80 * len(item):
                want.add((d, i, len(item), len(own & item)))
    got = [tuple(r) for r in contained_items(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 3
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == len([d for d, _ in TEXTS if d not in {x[0] for x in want}])
    assert contained_items(nothing, bench).count() == 0 and contained_items(docs, bench.limit(0)).count() == 0


def test_passages_are_found_in_any_dress(ready):
    """Case, composition, typographic marks, other spaces; scripts without spaces."""
    item = "l'été passé, le garçon naïf a dû élever très haut sa voix à côté de la forêt où l'œuvre fut créée"
    dresses = [item, item.upper(), unicodedata.normalize("NFD", item), item.replace("'", "\u2019").replace(",", "\u2014"), item.replace(" ", "\u00a0")]
    chinese = "一只敏捷的棕色狐狸跳过了那条懒惰的大狗"
    rows = [(i, f"avant, {t}; après tout") for i, t in enumerate(dresses)]
    rows += [(10, f"前面还有一些别的话{chinese}后面也有"), (11, "un autre texte sans rien de ce passage à côté de la forêt"), (12, "前面还有一些别的话")]
    bench = ready.createDataFrame([(1, item), (2, chinese)], "item_id long, text string")
    found = sorted((r.doc_id, r.item_id) for r in contained_items(table(ready, rows), bench).collect())
    assert found == [(i, 1) for i in range(len(dresses))] + [(10, 2)]
    assert sorted(r.doc_id for r in drop_contaminated(table(ready, rows), bench).collect()) == [11, 12]


@pytest.mark.parametrize("text", [*(t for _, t in TEXTS if t and t is not LONG), "中文字abc中d 1٣x", "ΣΑΣ İa ŒUVRE e\u0301 ﬁn", "ไทยab か゛カー", "a_b-c’d\u00adé\u200b"])
def test_letters(text):
    import pyarrow as pa

    (_, _, data, borders), = slices(folded(pa.array([None, text, "é", text])))
    w, flat = find_letters(data, borders), data.tobytes()
    got = [[flat[a:b].decode() for a, b in zip(w.start[lo:hi], w.end[lo:hi], strict=True)] for lo, hi in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [[], letters(text), ["é"], letters(text)]


@pytest.mark.parametrize("n", [1, 63, 1000, 70_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 40_000).astype("<u4")
    symbols, counts = np.unique(ids, return_counts=True)
    coded = scaled(symbols, counts)
    block = encode_block(ids, type(coded).load(coded.dump()), every=16)
    assert (decode_block(block, coded) == ids).all()
    for lo, hi in ((0, 1), (n // 3, n // 2 + 1), (n - 1, n)):  # from checkpoints
        assert (decode_block(block, coded, lo, hi) == ids[lo:hi]).all()
    if n > 100:
        broken = bytearray(block)
        broken[-2] ^= 1
        with pytest.raises(ValueError):
            decode_block(bytes(broken), coded)


def want_ids(text):
    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [1]


def test_id_files(ready, docs, nothing):
    written = write_ids(docs, WORDS)
    rows = sorted(read_ids(ready, written).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i))
    start, texts = 0, dict(TEXTS)
    for r in rows:
        ids = want_ids(texts[r.doc_id])
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)
    part = written.parts.orderBy(F.desc("n_tokens")).first()
    reader = IdReader(part.path, *_table(written.folder))
    whole = np.concatenate([ids for _, _, ids in reader.documents()])
    assert (reader.ids(5, 4000) == whole[5:4000]).all()
    assert read_ids(ready, write_ids(nothing, WORDS)).count() == 0


@pytest.mark.parametrize("hot", [1 << 21, 5])
def test_token_counts(docs, nothing, monkeypatch, hot):
    monkeypatch.setattr(token_counts, "HOT", hot)
    library = Tokenizer.from_file(BYTES)
    want = []
    for i, t in TEXTS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    got = [tuple(r) for r in token_counts.token_counts(docs, BYTES).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert token_counts.token_counts(nothing, BYTES).count() == 0


def test_plan_fills_windows():
    assert fill(10, {7: 1, 6: 1, 4: 1, 3: 2}) in ({6: 1, 4: 1}, {7: 1, 3: 1}, {4: 1, 3: 2})
    for histogram in ({1500: 1000}, {2047: 3, 1: 2}, {5: 3}, {700: 50, 900: 41, 3: 7}, {1: 5000}):
        plan = make_plan(histogram, 2048)
        fills = collections.defaultdict(list)
        for length, n in histogram.items():
            for rank in range(n):
                parts = list(plan.place(length, rank))
                assert [p[0] for p in parts] == np.cumsum([0] + [p[1] for p in parts])[:-1].tolist()
                assert sum(p[1] for p in parts) == length
                for _, size, sequence, offset in parts:
                    fills[sequence].append((offset, size))
        short = 0
        for parts in fills.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at == 2048 or at & (at - 1) == 0
            short += at if at < 2048 else 0
        assert short < 2048 and len(fills) == plan.sequences


def test_pack(docs, nothing):
    rows = pack(docs, WORDS, capacity=64).collect()
    texts, pieces, sequences = dict(TEXTS), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = want_ids(texts[r.doc_id])
        assert r.doc_tokens == len(ids) and np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, _ in TEXTS:
        copies = 2 if i == 16 else 1
        assert sum(n for _, n in pieces[i]) == copies * len(want_ids(texts[i]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    assert pack(nothing, WORDS).count() == 0


def test_warc(ready):
    big = "<p>é" + "x" * 1200
    rows = [(1, "http://a/b c\n", big), (2, None, big), (3, "u", ""), (4, "u", None), (5, "u", "same"), (6, "u", "same"), (7, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", big), (9, "v", big), (9, "v", big)]
    pages = ready.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, sha1 string").repartition(2)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        last = 9 if html == big and i is not None else i
        kind = ("revisit", last) if last != i else ("response", None)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), *kind))
    got = archive_pages(pages).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == collections.Counter(want)
    assert all(r.payload == (dict((x[0], x[2]) for x in rows)[r.page_id] or "").encode() for r in got if r.record_type == "response")
    assert archive_pages(pages.limit(0)).count() == 0


def test_url_rules(ready):
    rules = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("block", "", "/ads*/x"), Rule("block", "com", "/de/"), Rule("allow", "com", "/de/")]
    urls = {
        "http://example.org/es/a": ("example.org/es/", "block"), "http://WWW.Example.ORG/en/12?q": ("example.org/en/1", "block"),
        "x://notexample.org/es/": ("org/", "allow"), "http://example.org": (None, "allow"), "http://a.com/de/": ("com/de/", "block"),
        "http://a.comx/de/": (None, "allow"), None: (None, "allow"), "no scheme": (None, "allow"), "a://b.com#/de/": (None, "allow"), "http://éa.org/É": ("org/", "allow"),
    }
    pages = ready.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(None, "no scheme", "r")], "page_id long, url string, rule string")
    found = judge_urls(pages, rules[:3] + rules[4:]).collect()
    assert len(found) == len(urls) + 1
    for r in found:
        if r.page_id is not None:
            assert (r.rule, r.verdict) == list(urls.values())[r.page_id]
    wild = judge_urls(pages.selectExpr("page_id", "'http://org/adsense/x/1' AS url"), [Rule("block", "org", "/ads*/x")]).first()
    assert (wild.rule, wild.verdict) == ("org/ads*/x", "block")
    assert judge_urls(pages.limit(0), rules).count() == 0


def test_url_rules_host_with_space(ready):
    pages = ready.createDataFrame([(1, "http://a b.www.example.org/es/"), (2, "http://a b.notexample.org/es/ x.example.org/es/")], "page_id long, url string")
    found = judge_urls(pages, [Rule("block", "example.org", "/es/")]).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in found] == [("example.org/es/", "block"), (None, "allow")]


def plain_language(model, text):
    """Language, score and rejection of a text with a letter, run by run."""
    data = re.sub("[A-Z]+", lambda m: m[0].lower(), text).encode()
    sums, count = np.zeros(len(model.table)), 0
    for n in (2, 3, 4):
        for at in range(len(data) - n + 1):
            h = int.from_bytes(data[at : at + n], "little") ^ (0x9E3779B9 * n & 0xFFFFFFFF)
            h = h * 0x85EBCA6B & 0xFFFFFFFF
            h = (h ^ h >> 15) * 0xC2B2AE35 & 0xFFFFFFFF
            sums += model.table[:, h >> 17]
            count += 1
    sums /= max(count, 1)
    n = len(model.languages)
    z = (sums[:n] + model.bias) / model.temperature
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    best = int(p.argmax())
    return model.languages[best], p[best], bool(p[best] < model.threshold or sums[n + best] < model.floor)


def test_language_bounds_hold_for_any_number_of_rows():
    rng = np.random.default_rng(8)
    values = rng.normal(5, 2, 4000)
    assert (values < language_id.lowest(values)).mean() < 0.004
    odd = np.concatenate((values, np.full(40, -200.0)))
    assert abs(language_id.lowest(odd) - language_id.lowest(values)) < 1
    assert language_id.lowest(np.zeros(0)) == -np.inf and language_id.lowest(np.ones(1)) == 1
    for n in (0, 1, 5, 19, 20, 998, 999):
        model = language_id.Model(["x", "y"], np.zeros((4, 8), np.float32), np.zeros(2))
        labels = np.arange(n) % 2
        means = np.column_stack((3.0 - 2 * labels, 1.0 + 2 * labels, rng.normal(0, 1, n), rng.normal(0, 1, n)))
        language_id.calibrate(model, labels, means)
        assert model.temperature > 0 and 0 <= model.threshold <= 1


@pytest.mark.parametrize("missing", ["de", "en", "es", "fr"])
def test_language_id_rejects_a_language_left_out(ready, missing):
    """At least 0.8 of a language not learnt, at most 0.02 of the learnt ones; other scripts, code and digests."""
    rows = ready.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    model = language_id.fit(rows, F.col("lang") != missing)
    found = language_id.identify(rows, model).where(f"lang_pred <> '{language_id.UNKNOWN}'").join(rows.select("doc_id", "lang"), "doc_id")
    share = found.groupBy((F.col("lang") == missing).alias("out")).agg(F.avg(F.col("rejected").cast("int")).alias("share"))
    share = {r.out: r.share for r in share.collect()}
    assert share[True] > 0.8 and share[False] < 0.02, share
    strange = ["Мальчик пошел в школу со своей мамой", "少年は学校へ行きました", "for (int i = 0; i < n; i++) { sum += a[i]; }", hashlib.sha256(b"x").hexdigest()]
    assert all(r.rejected for r in language_id.identify(table(ready, list(enumerate(strange))), model).collect())


def test_language_id(ready, docs, nothing):
    table_ = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = language_id.fit(table_, own != 1)
    held = language_id.identify(table_, model).join(table_.where(own == 1).select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id in (3, 4, 5):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id is not None and r.doc_id != 16:
            lang, score, rejected = plain_language(model, dict(TEXTS)[r.doc_id])
            assert (r.lang_pred, r.rejected) == (lang, rejected) and abs(r.score - score) < 1e-5
    left = language_id.keep_identified(docs, model)
    assert left.columns == docs.columns and left.count() == sum(not r.rejected for r in rows)
    assert language_id.identify(nothing, model).count() == 0
    empty = language_id.fit(nothing, own != 1)
    assert {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}


def test_language_id_rejects_unlearnt(ready):
    """Two languages learnt of three; the best of two scores is 0.5 at least."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(6000):
        letters = list(("abcdefgh", "ijklmnop", "qrstuvwx")[i % 3])
        rows.append((i, " ".join("".join(rng.choice(letters, 5)) for _ in range(12)), "xyz"[i % 3]))
    all_ = ready.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(all_, F.col("lang") != "z", sample=600)
    assert model.languages == ["x", "y"]
    found = language_id.identify(all_, model).join(all_.select("doc_id", "lang"), "doc_id")
    rejected = {r.lang: r.share for r in found.groupBy("lang").agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert rejected["z"] > 0.9 and rejected["x"] < 0.01 and rejected["y"] < 0.01


def test_language_sample_is_dealt(ready):
    rows = [(i, "rare" if i % 500 == 0 else "often", "x") for i in range(10_000)]
    dealt = language_id._dealt(ready.createDataFrame([*rows, *rows[:3]], "doc_id long, lang string, text string"), 100, 50)
    got = {(r.held, r.lang): r["count"] for r in dealt.groupBy("held", "lang").count().collect()}
    assert got[False, "often"] + got[False, "rare"] == 100 and got[True, "often"] + got[True, "rare"] == 50
    assert got[False, "rare"] + got[True, "rare"] == 20 and dealt.select("id").distinct().count() == 150


def test_toxicity(ready, docs, nothing):
    rng = np.random.default_rng(2)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        own = list(rng.choice(plain, 60))
        bad = i % 4 == 0
        if bad:
            own[int(rng.integers(60))] = f"Vile{'abcdef'[i % 6]}"
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad), "t"))
    marks = ready.createDataFrame([*labels, (None, 1, "t"), (5, None, "t")], "doc_id long, toxic int, text string")
    model = toxicity.fit(table(ready, rows), marks, F.col("__id") % 5 != 0)
    scored = {r.doc_id: r for r in toxicity.tag_toxic(table(ready, rows), model).collect()}
    right = [(scored[i].score >= 0.5) == bool(y) for i, y, _ in labels if i % 5 == 0]
    assert np.mean(right) > 0.95
    text = dict(rows)[0].encode()
    assert [text[s.start : s.end].lower()[:4] for s in scored[0].spans] == [b"vile"]
    other = toxicity.tag_toxic(docs, model).collect()
    assert len(other) == len(TEXTS) and all(0 <= r.score < 0.5 for r in other)  # the long one too
    assert toxicity.tag_toxic(nothing, model).count() == 0
    none = toxicity.fit(nothing, marks, F.col("__id") % 5 != 0)
    assert toxicity.tag_toxic(docs, none).count() == len(TEXTS)


def test_toxicity_long_document(ready, monkeypatch):
    """A labelled text over the byte bound is skipped, the ones behind it are learnt."""
    rows = [(i, f"word{i} plain" if i % 2 else f"word{i} vile") for i in range(40)]
    rows = [(i, t * 4000) if i in (7, 20) else (i, t) for i, t in rows]
    marks = ready.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y: seen.append(sorted(texts.to_pylist())))
    toxicity.fit(table(ready, rows), marks, F.lit(True), max_bytes=20_000)
    assert seen == [sorted(t for i, t in rows if i not in (7, 20))]


def test_pipeline(ready):
    import corpus_pipeline

    path = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(ready, path).collect()
    source = [(r.doc_id, r.text) for r in ready.read.parquet(f"{path}/documents.parquet").collect()]
    model = language_id.fit(ready.read.parquet(f"{path}/documents.parquet"), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    first = {}
    for i, t in sorted(source):
        if re.search(r"[^\W\d_]", t or "") and not plain_language(model, t)[2]:
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    left = sorted(first.values())
    near = brute_components(left, 5)
    left = [(i, t) for i, t in left if near[i][1] == i]
    items = [five(r.text) for r in ready.read.parquet(f"{path}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in left if not any(q and 100 * len(q & five(t)) >= 80 * len(q) for q in items)]
    assert {r.doc_id for r in rows} == {i for i, _ in left}
    for i, t in left:
        ids = want_ids(t)
        for r in (r for r in rows if r.doc_id == i):
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(len(want_ids(t)) for _, t in left)


def test_archives_are_read_by_as_many_tasks(ready):
    """The index fits one partition; reading must not."""
    from funnelworks.llm.warc import normalise, read_records, write_monolithic

    rows = [(i, f"http://a.org/{i}", "x" * (400_000 if i == 7 else 50) + str(i)) for i in range(60)]
    pages = ready.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    folder = normalise(ready, write_monolithic(pages))
    n = ready.read.json(f"{folder}/*.idx.json").select("archive").distinct().count()
    found = read_records(ready, folder)
    assert n > 1 and found.rdd.getNumPartitions() == n
    assert {r.page_id: r.payload.decode() for r in found.collect()} == {i: t for i, _, t in rows}


def test_other_tokenizers_get_whole_texts(ready):
    """Chunks hold for the splits they were made for; others must not be cut."""
    from funnelworks.llm.tokens import coder

    texts = [t or "" for _, t in TEXTS]
    library = Tokenizer.from_file(BYTES)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert not coder(BYTES).chunks and coder(WORDS).chunks
    assert coder(BYTES).encode([t.encode() for t in texts]) == want
