"""Each operator against a brute-force version, on rows with nulls, ties, copies, long texts and clashing columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tollbook.llm import (
    components, decontaminate, langid, packing, partenum, parts, pii, ranking, repair, rules, substrings, suffixes, textstats,
    token_counts, tokenization)

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig long, pos long, score double"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}a" for x in rng.integers(0, vocabulary, n))


def sample() -> list[tuple]:
    base = words(1, 300)
    changed = base.split(" ")
    changed[150] = "other"
    near = [" ".join([*base.split(" ")[:k], f"new{k}", *base.split(" ")[k + 1 :]]) for k in range(0, 300, 12)]
    texts = [base, base, " ".join(changed), *near, None, "", " ", "\n\n", "a b", "a b", "A B c d", "a b c d",
             words(2, 60), words(3, 9000), "x " * 400, "é" * 300, "abcde" * 100, words(2, 60) + "\n" + words(4, 40),
             "<|endoftext|> a <|endoftext|>", "ß  two　 spaces \n x", "▁ mark", base + words(5, 30), "it's 'S 12 3.4\n\n5"]
    rows = [(i, t, "en", "s", 1, 2, 3, 0.5) for i, t in enumerate(texts)]
    return [*rows, (None, base, None, None, None, None, None, None), (5, near[2], "en", "s", 1, 2, 3, 0.5)]


@pytest.fixture(scope="module")
def docs(spark):
    from tollbook.llm.common import ship

    ship(spark)
    return spark.createDataFrame(sample(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_encoder_equals_library():
    texts = [t or "" for _, t, *_ in sample()]
    assert tokenization.ByteEncoder(BPE).encode(texts) == tokenization.ByteEncoder(BPE).whole(texts)
    counter = tokenization.PieceCounter(PIECES, tokenization.single_words(PIECES))
    assert counter.apart and counter.count(texts) == counter.whole(texts)


def test_texts_are_put_together_from_each_distinct_part_once(monkeypatch):
    """Also if parts were forgotten or lie in the older half of the memory; parts that give None leave out their texts alone."""
    asked = []

    def learn(parts):
        asked.extend(parts)
        return [None if p == "odd" else np.arange(len(p), dtype=np.uint32).tobytes() for p in parts]

    held = parts.Memory()
    texts = ["ab  c", "", "ab ab abc", "x odd", "ab", "c "]
    wanted = [None if "odd" in t else np.array([i for p in t.split(" ") for i in range(len(p))], np.uint32).tobytes() for t in texts]
    for block in (2, 1 << 17):
        monkeypatch.setattr(parts, "BLOCK", block)
        assert parts.put_together(texts, lambda own: held.values(own, learn)) == wanted
    assert sorted(asked) == ["", "ab", "abc", "c", "odd", "odd", "x"]
    monkeypatch.setattr(parts, "WORDS", 3)
    asked.clear()
    held.values(["ab", "new"], learn)
    assert asked == ["new"] and len(held.new) == 2
    first = lambda own: [b"1111" if p[:1] == " " else b"2222" for p in own]
    assert parts.put_together(["a a a", "", " a"], first, mark_first=True) == [b"111122222222", b"1111", b"11112222"]


def test_encoder_with_little_memory_equals_library(monkeypatch):
    monkeypatch.setattr(parts, "WORDS", 20)
    rng, pool = np.random.default_rng(3), ["a", "Foo", " ", "  ", "\n", "\n\n", "\t", "é", "日本", "\xa0", "...", "!?", "'s", "12", "<|endoftext|>", "_", "İ", "\r"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 14))) for _ in range(3000)]
    encoder = tokenization.ByteEncoder(BPE)
    assert [x for i in range(0, 3000, 30) for x in encoder.encode(texts[i : i + 30])] == encoder.whole(texts)


def test_numbers_of_words_end_at_any_white_space():
    rng, pool = np.random.default_rng(9), ["a", "Foo", " ", "  ", "\n", "\x1c", "\x85", "　", "é", "...", ",", "don't", "_", "Σ", "x²"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 14))) for _ in range(2000)]
    own = {w: i for i, w in enumerate(["a", "foo", "é", "dont", "x²", "fooa"])}
    for text, found in zip(texts, decontaminate.numbers(texts, decontaminate.Vocabulary(own))):
        assert found.tolist() == [own.get(p, -1) for w in text.split() if (p := decontaminate.plain(w))]


def test_language(spark, docs, none):
    text = {"en": "the cat and the dog of the house ", "de": "der hund und die katze das haus ", "fr": "le chien et la maison du chat "}
    rows = [(i, text[lang] * (1 + i % 5), lang) for i, lang in enumerate(list(text) * 30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "the dogs"), (2, "die hunde"), (3, None), (4, "12 ## !"), (None, "la maison")],
                                  "doc_id long, text string")
    found = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, None)] == ["en", "de", "und", "und", "fr"]
    assert found[3].score == 0 and 0 < found[1].score <= 1
    unlearned = langid.train(none.select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in langid.predict(docs, unlearned).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


def test_language_slices(monkeypatch):
    """Slices count every n-gram of the whole text once."""
    texts = ["abc def " * 50, "", "  ", "a", "é" * 97 + "  " * 60 + "x", "x" * 97 + " y", "\U00031000 z"]
    whole = [Counter(langid.grams(langid.letters(t)).tolist()) for t in texts]
    for size in (1, 2, 3, 97):
        monkeypatch.setattr(langid, "SLICE", size)
        assert [sum((Counter(p.tolist()) for p, _ in langid.gram_parts(t)), Counter()) for t in texts] == whole
    assert [any(letter for _, letter in langid.gram_parts(t)) for t in texts] == [True, False, False, True, True, True, True]


def test_language_equals_naive_bayes(spark, monkeypatch):
    """Counts, priors and posteriors by a plain naive Bayes over the same buckets, with more texts than fit into a batch."""
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rng = np.random.default_rng(6)
    alphabets = {"aa": "abcde ", "bb": "cdefg ", "cc": "efgab ", "rare": "xyz "}
    rows = [(i, "".join(rng.choice(list(alphabets[lang]), int(rng.integers(0, 60)))), lang)
            for i, lang in enumerate(["aa"] * 50 + ["bb"] * 30 + ["cc"] * 20 + ["rare"] * 2)]
    rows += [(900, None, "aa"), (901, "abc", None), (7, rows[7][1], "aa")]
    known = [(t, lang) for _, t, lang in rows if t is not None and lang in ("aa", "bb", "cc")]
    counts = {lang: Counter() for lang in ("aa", "bb", "cc")}
    for t, lang in known:
        counts[lang].update(langid.grams(langid.letters(t)).tolist())
    langs = sorted(counts)
    total = {lang: sum(counts[lang].values()) + 0.5 * langid.BUCKETS for lang in langs}

    def posterior(t):
        logs = [np.log(sum(x == lang for _, x in known) / len(known)) + sum(
            np.log((counts[lang][g] + 0.5) / total[lang]) for g in langid.grams(langid.letters(t)).tolist()) for lang in langs]
        return langs[int(np.argmax(logs))], 1 / sum(np.exp(x - max(logs)) for x in logs)

    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.predict(frame, langid.train(frame)).collect()
    assert len(found) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in found:
        t = texts[r.doc_id]
        if not (t or "").strip():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        name, score = posterior(t)
        assert r.lang_pred == name and abs(r.score - score) < 1e-9


def test_ids_round_trip(spark, docs, none, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "SHARD", 2000)
    path = str(tmp_path / "ids")
    repair.write_ids(docs, BPE, path)
    rows = repair.read_ids(spark, path, with_ids=True).collect()
    encoder = tokenization.ByteEncoder(BPE)
    wanted = Counter((i, e + bytes(4)) for (i, *_), e in zip(sample(), encoder.whole([t or "" for _, t, *_ in sample()])))
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == wanted
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens
    shard = spark.read.parquet(path).orderBy(F.desc("n_tokens")).first()
    flat = repair.expand(np.frombuffer(shard.body, "<u4").copy(), np.frombuffer(shard.rules, "<u4").reshape(-1, 2))
    assert len(flat) == shard.n_tokens
    for a, b in ((0, 5), (7, 7), (100, 900), (len(flat) - 2, len(flat))):
        assert repair.read_range(spark, path, shard.part, shard.shard, a, b) == flat[a:b].tolist()
    empty = str(tmp_path / "none")
    repair.write_ids(none, BPE, empty)
    assert repair.read_ids(spark, empty).count() == 0


@pytest.mark.parametrize("n, kinds", [(0, 1), (1, 1), (5000, 3), (5000, 40), (3000, 1)])
def test_grammar(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n).astype(np.uint32)
    body, rule, tokens = repair.compress(ids)
    assert (repair.expand(body.copy(), rule) == ids).all() and len(body) <= len(ids)
    assert (repair.expand_range(body, rule, tokens, n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def _plain_stats(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    three = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    hit = set()
    for i in range(len(found) - 2):
        if three[tuple(found[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_stats_equal_plain_ones():
    for _, text, *_ in sample():
        assert textstats.stats(text or "")[:5] == _plain_stats(text or "")
    assert textstats.repeat_words(np.array([0, 1, 2, 0, 1, 2]), 1 << 22) == 6


def test_rules(docs, none):
    rows = rules.judge(docs).collect()
    assert len(rows) == len(sample()) and all(r.quality is not None for r in rows)
    assert all(not r.kept for r in rows if r.n_words < 50)
    assert all(r.kept for r in rows if r.doc_id == 0)
    assert rules.judge(none).count() == 0


def test_rules_find_the_faulty_class():
    good, _ = rules.estimate(["+++++++++", "0++++++++", "--0++++++", "--+------", "++--+++++"], [800, 60, 40, 30, 20])
    assert good[0] > 0.9 and good[1] > 0.9 and good[2] < 0.5 and good[3] < 0.1


def test_token_counts(docs, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = Counter((i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 100)
                     for i, t, *_ in sample())
    assert Counter(map(tuple, token_counts.token_counts(docs, PIECES, limit=100).collect())) == wanted
    assert token_counts.token_counts(none, PIECES).count() == 0


def _components(rows, width, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)].append(doc)
    return Counter((doc, len(sets[i]), min(least[root(i)], default=None)) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("width, percent, bucket", [(4, 85, 8), (5, 80, 2), (4, 85, 2)])
def test_jaccard_join(docs, none, monkeypatch, width, percent, bucket):
    monkeypatch.setattr(partenum, "BUCKET", bucket)
    monkeypatch.setattr(partenum, "BLOCK", 4 * bucket - 5)
    rows = [(i, t) for i, t, *_ in sample()]
    assert Counter(map(tuple, partenum.classes(docs, width, percent).collect())) == _components(rows, width, percent)


def test_jaccard_join_of_nothing(none):
    assert partenum.classes(none).count() == 0


def test_signatures_meet():
    rng = np.random.default_rng(5)
    ends = partenum.bands(85, 1 << 16)
    for size in (1, 2, 6, 7, 12, 40, 150, 900):
        for _ in range(40):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * size + 4).astype(np.uint64))
            a = np.sort(rng.permutation(pool)[:size])
            drop, add = rng.integers(0, size // 6 + 1), rng.integers(0, size // 6 + 2)
            b = np.sort(np.r_[rng.permutation(a)[drop:], rng.permutation(np.setdiff1d(pool, a))[:add]])
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
                continue
            given = [{int(s) for sigs, on, _ in partenum.parts_of(x, 85, ends) for s in sigs[on]} for x in (a, b)]
            assert given[0] & given[1]


def test_signatures_meet_when_the_largest_are_left_out():
    """Both sets may leave out as many of their heavy signatures as they say, in any order that is the same for both."""
    rng = np.random.default_rng(11)
    met = 0
    for percent in (80, 85):
        ends = partenum.bands(percent, 1 << 16)
        for size in (3, 8, 25, 60, 130, 500, 1500):
            for _ in range(60):
                pool = np.unique(rng.integers(0, 1 << 64, 2 * size + 4, np.uint64))
                a = np.sort(rng.permutation(pool)[:size])
                drop, add = rng.integers(0, size // 5 + 1), rng.integers(0, size // 5 + 2)
                b = np.sort(np.r_[rng.permutation(a)[drop:], rng.permutation(np.setdiff1d(pool, a))[:add]])
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both):
                    continue
                met += 1
                left = [{int(s) for sigs, on, spare in partenum.parts_of(x, percent, ends) for s in sorted(sigs[on])[max(spare, 0) :]}
                        for x in (a, b)]
                assert left[0] & left[1]
    assert met > 300


def test_unrelated_sets_share_no_signature():
    """A set that may be the smaller one of a larger link gives no empty parts, which all sets of its size have in common."""
    rng = np.random.default_rng(12)
    ends, given = partenum.bands(80, 1 << 16), Counter()
    for size in range(100, 400):
        found = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
        given.update({int(s) for sigs, on, _ in partenum.parts_of(found, 80, ends) for s in sigs[on]})
    assert max(given.values()) == 1


def test_bitmaps_keep_links():
    rng = np.random.default_rng(8)
    for size in (1, 5, 40, 300, 20_000):
        for percent in (80, 85):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            for share in (0, 0.05, 0.1, 0.2):
                b = np.unique(np.r_[a[int(share * len(a)) :], rng.integers(0, 1 << 63, len(a) // 12).astype(np.uint64)])
                both = len(np.intersect1d(a, b))
                x = partenum.folded([partenum.parities(s, percent) for s in (a, b)])
                kept = partenum.may_link(x[0], len(a), x[1:], np.array([len(b)]), percent)[0]
                assert kept or 100 * both < percent * (len(a) + len(b) - both)


def test_buckets_over_many_batches(spark):
    """A bucket that goes on over batches gives each of its sets once, and the sizes of the others stay right."""
    rows = [(7, 2 * i) for i in range(5000)] * 2 + [(9, 2 * i) for i in range(3)] + [(8, 4)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 700)
    try:
        found = partenum.buckets(spark.createDataFrame(rows, "sig long, member long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.a for r in found if r.sig == 7) == [2 * i for i in range(5000)]
    assert sorted((r.a, r.b) for r in found if r.sig is None) == [(0, 2), (0, 4), (2, 4)]
    assert {r.sig for r in found} == {None, 7}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (50, 51), (51, 50), (60, 60), (-3, 52), (52, 51)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and found[100] == 0
    assert {found[i] for i in (50, 51, 52, -3)} == {-3} and 60 not in found


@pytest.mark.parametrize("n, kinds", [(1, 2), (60, 2), (2000, 3), (1500, 1)])
def test_suffix_order(n, kinds):
    text = np.random.default_rng(n).integers(97, 97 + kinds, n).astype(np.uint8)
    data, order = text.tobytes(), suffixes.suffix_order(text, 100)
    keys = [data[i : i + 100] for i in order]
    assert sorted(order) == list(range(n)) and keys == sorted(keys)


def without_repeats(rows) -> Counter:
    """Bytes that stay of (doc_id or -1, data), by brute force."""
    first: dict = {}
    rows = sorted(rows)
    for i, data in rows:
        for a in range(len(data) - 99):
            first.setdefault(data[a : a + 100], (i, a))
            first[data[a : a + 100]] = min(first[data[a : a + 100]], (i, a))
    wanted = Counter()
    for i, data in rows:
        out = np.zeros(len(data), bool)
        for a in range(len(data) - 99):
            if first[data[a : a + 100]] < (i, a):
                out[a : a + 100] = True
        spans = int((out & ~np.r_[False, out[:-1]]).sum()) if len(data) else 0
        kept = bytes(b for b, gone in zip(data, out) if not gone)
        wanted[None if i < 0 else i, len(data), int(out.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return wanted


def cleaned(docs) -> Counter:
    found = substrings.clean(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return Counter(map(tuple, found.collect()))


@pytest.mark.parametrize("group, shard", [(1 << 25, 1 << 22), (500, 300)])
def test_substrings(docs, none, monkeypatch, group, shard):
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "SHARD", shard)
    assert cleaned(docs) == without_repeats((-1 if i is None else i, (t or "").encode()) for i, t, *_ in sample())
    assert substrings.clean(none).count() == 0


def test_substrings_of_rows_that_share_an_id(spark):
    """Different texts of one id or without one, among them two whose CRC ends in the same 16 bits, and rows that repeat."""
    a, b = words(1, 60), words(2, 60)
    want, k = zlib.crc32(a.encode()) & 0xFFFF, 0
    while zlib.crc32(f"{b} {k}".encode()) & 0xFFFF != want:
        k += 1
    b = f"{b} {k}"
    shared = words(3, 40)
    rows = [(1, a), (5, a), (5, b), (5, b), (6, shared), (7, "x" + shared), (7, "yy" + shared), (None, words(4, 50)),
            (None, words(5, 50) + shared), (None, None), (None, ""), (9, b), (9, words(6, 50)), (9, None)]
    docs = spark.createDataFrame([(i, t, "", "", 0, 0, 0, 0.0) for i, t in rows], SCHEMA).repartition(3)
    got = cleaned(docs)
    assert got == without_repeats((-1 if i is None else i, (t or "").encode()) for i, t in rows)
    assert got[5, len(b), 0, 0, hashlib.sha256(b.encode()).hexdigest()] == 2


def test_ranking(spark, docs, none):
    good = [(i, words(i, 80)) for i in range(40)]
    bad = [(100 + i, " ".join(w + "###" for w in words(i, 80).split())) for i in range(20)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good + bad] + [(None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = ranking.train(ranking.labelled_sample(table, labels))
    scores = {r.doc_id: r.score for r in ranking.score(table, model).collect()}
    assert all((scores[i] >= ranking.TAKEN) == (i < 100) for i in scores)
    assert ranking.score(docs, model).filter("score between 0 and 1").count() == len(sample())
    assert ranking.train(ranking.labelled_sample(table, labels.filter("quality = 1"))) is None
    assert {r.score for r in ranking.score(docs, None).collect()} == {ranking.TAKEN}
    assert ranking.score(none, model).count() == 0
    kept = docs.filter(ranking.score_column(F.col("text"), model) >= 0).collect()
    assert len(kept) == len(sample())


def test_ranking_equals_gradient_descent(spark):
    """The weights against plain descent on the same pairs, the threshold against every cut of all labelled rows."""
    rng = np.random.default_rng(9)
    noisy = lambda i, share: " ".join(w + "##" * (rng.random() < share) for w in words(i, 60).split())
    rows = [(i, noisy(i, 0.15)) for i in range(60)] + [(100 + i, noisy(i, 0.35)) for i in range(60)] + [(3, "x y z")] * 9
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in {r[0] for r in rows}], "doc_id long, quality int, toxic int")
    w, at, spread = ranking.learn(table, labels)
    first = {i: min(t for j, t in rows if j == i) for i, _ in rows}
    order = sorted(first)
    x, y = np.array([ranking.features(first[i]) for i in order], float), np.array([int(i < 100) for i in order])
    scale = np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    pick = np.random.default_rng(7)
    z = x / scale
    d = z[pick.choice(np.flatnonzero(y == 1), ranking.PAIRS)] - z[pick.choice(np.flatnonzero(y == 0), ranking.PAIRS)]
    loss = lambda v: np.logaddexp(0, -(d @ v)).sum() + 5 * v @ v
    best = w * scale
    assert all(loss(best) <= loss(best + step) + 1e-6 for step in rng.normal(size=(60, len(best))) * 0.02)
    raw = np.array([np.dot(ranking.features(t), w) for _, t in rows])
    good = np.array([i < 100 for i, _ in rows])
    quality = lambda c: (raw[~good] < c).mean() - (raw[good] < c).mean()
    assert quality(at) >= max(map(quality, raw)) - 0.02 and spread > 0


def test_packing(docs, none):
    rows = packing.pack(docs, BPE, block=4096).collect()
    encoder, by_doc, by_window = tokenization.ByteEncoder(BPE), defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) and r.length > 0
        by_window[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, bytes(r.ids)))
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    end = np.array([1], "<u4").tobytes()
    for i, text, *_ in sample():
        if i not in (None, 5):
            assert b"".join(x for _, x in sorted(by_doc[i])) == encoder.whole([text or ""])[0] + end
    assert packing.pack(none, BPE).count() == 0


def test_packing_many_empty_texts(spark):
    """More one-id pieces than a block may hold."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).coalesce(1)
    rows = packing.pack(docs, BPE).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("c")).collect()
    assert sum(r.n for r in rows) == 40_000 and max(r.n for r in rows) <= packing.CAPACITY
    assert len(rows) <= -(-40_000 // packing.CAPACITY) + 3


def test_differencing_balances():
    sizes = np.random.default_rng(2).integers(20, 250, 800)
    total = np.bincount(packing.differencing(sizes, 50), sizes, 50)
    assert total.max() - total.min() <= 5
    assert sum(packing.cut(1999)) == 1999 and max(packing.cut(1999)) <= packing.PIECE
    assert len(packing.balance(np.full(4, 1500))) == 4 and len(set(packing.balance(np.full(4, 1500)))) == 4


def _base_by_pattern(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) < 256 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_patterns():
    rng = np.random.default_rng(4)
    parts = ["a@b.c", "@", "x.y@z", ".com", " ", "-", "+1 (555) 010-9999", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4",
             "999.1.1.1", ".5", "0001.02.3.255", "+", "12", "é", "a", "\n", "+49.30-12345678.", "1", "@a.b@c.d"]
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.integers(1, 9)))
        assert pii.base_spans(text) == _base_by_pattern(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_personal_data(spark, docs, none):
    secret = "0123456789abcdef0123456789abcdef01234567"
    rows = [(i, f"mail me{i}@example.com or 10.0.0.{i} now") for i in range(50)]
    rows += [(100 + i, f'so token = "{i:03d}{secret[3:]}" it is') for i in range(10)] + [(200, None), (201, "nothing here")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.detect(table).select("doc_id", pii.listed(F.col("spans")).alias("spans")).collect()}
    assert found[3].spans == "email:5:20,ip:24:32" and found[100].spans == "secret:12:52"
    assert found[200].spans == found[201].spans == ""
    accepted = pii.accepted_signatures(pii.span_rows(table))
    assert pii.mask_text(rows[3][1], accepted) == "mail [EMAIL] or [IP] now"
    masked = {r[0]: r[1] for r in table.select("doc_id", pii.masked(F.col("text"), accepted)).collect()}
    assert masked[200] is None and masked[201] == "nothing here" and secret[3:] not in masked[101]
    assert pii.detect(none).count() == 0 and pii.detect(docs).count() == len(sample())


def test_leaks(spark, docs, none):
    items = [(k, words(1000 + k, 30, 5000)) for k in range(30)] + [(90, None), (91, "!!"), (92, words(1003, 30, 5000))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    changed = items[5][1].split()
    changed[3] = changed[17] = "else"
    rows = [(1, words(1, 500) + " " + items[3][1].upper() + " " + words(2, 300)), (2, " ".join(changed)), (3, words(3, 400, 5000)),
            (4, None), (5, ""), (None, items[7][1]), (6, " ".join(items[9][1].split()[:12])), (1, items[3][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.leaks(table, benchmark).collect()
    pairs = Counter((r.doc_id, r.item_id) for r in found)
    assert pairs == Counter({(1, 3): 2, (1, 92): 2, (2, 5): 1, (None, 7): 1})
    assert decontaminate.leaks(none, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_leaks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    items = [(k, words(1000 + k, 30, 5000)) for k in range(30)]
    table = spark.createDataFrame([(k, words(k, 50) + " " + t) for k, t in items], "doc_id long, text string")
    found = decontaminate.leaks(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k, _ in items}


@pytest.mark.parametrize("n", [4, 6, 400, 5000])
def test_leaks_of_short_and_long_items(spark, n):
    """A copy word for word is found whatever the item's length, and only where it stands."""
    items = [(k, words(2000 + k, n, 9000)) for k in range(16 if n < 5000 else 2)]
    rows = [(k, words(k, 300, 9000) + " " + t + " " + words(50 + k, 300, 9000)) for k, t in items]
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter((k, k) for k, _ in items)
    assert all(r.lcs == 1.0 for r in found)


def test_leaks_are_those_of_whole_items(spark):
    """Words of an item behind the first 4,096 count."""
    item = words(1, 4096, 9000) + " " + words(2, 8000, 9000)
    table = spark.createDataFrame([(1, words(1, 4096, 9000))], "doc_id long, text string")
    assert decontaminate.leaks(table, spark.createDataFrame([(1, item)], "item_id long, text string")).count() == 0


def _longest(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_leaks_without_rare_words_equal_brute_force(spark):
    """Copies whose rarest words are replaced, next to words that no document holds, against LCS of every window."""
    rng = np.random.default_rng(4)
    common, rare = [f"c{x}x" for x in range(60)], [f"r{x}x" for x in range(4000)]
    items, rows = [], []
    for k in range(24):
        item = [str(w) for w in rng.choice(common, 24)] + [str(w) for w in rng.choice(rare, 8)]
        rng.shuffle(item)
        body, last = item[:26], item[26:]
        items.append((k, " ".join(body) + ". " + " ".join(last) + "."))
        gone = [i for i in range(26) if body[i] in rare][: 8 - k % 3]
        copy = [f"other{k}x{i}" if i in gone else w for i, w in enumerate(body)] + last
        around = [str(w) for w in rng.choice(common, 80)]
        rows.append((k, " ".join([*around[:40], *copy, *around[40:]])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in
             decontaminate.leaks(table, spark.createDataFrame(items, "item_id long, text string")).collect()}
    wanted, width = set(), decontaminate.close_width(32)
    for k, item in items:
        words_, last = [decontaminate.plain(w) for w in item.split()], {decontaminate.plain(w) for w in decontaminate.answer(item).split()}
        for doc, text in (rows[k], rows[(k + 1) % 24]):
            text = text.split()
            for a in range(len(text) - width + 1):
                share = _longest(words_, text[a : a + width]) / len(words_)
                if share >= 0.8 or share >= 0.6 and last <= set(text[a : a + width]):
                    wanted.add((doc, k))
                    break
    assert len(wanted) >= 24 and wanted <= found


def test_leaks_that_only_the_cosine_finds(spark):
    """The halves of an item change places and a third of its other words is replaced, its answer stays: too few words keep
    their order for the rule. Whoever has an answer alone, or the words without it, is none."""
    rng = np.random.default_rng(8)
    items, rows, clean = [], [], []
    for k in range(30):
        body, last = words(4000 + k, 28, 3000).split(), words(5000 + k, 8, 3000).split()
        items.append((k, f"{' '.join(body)}. {' '.join(last)}."))
        moved = body[14:] + body[:14]
        for place in rng.choice(28, 9, replace=False):
            moved[place] = f"other{place}"
        rows.append((k, " ".join([words(k, 90, 3000), *moved, *last, words(60 + k, 90, 3000)])))
        clean += [(100 + k, " ".join([words(k, 90, 3000), *last, words(60 + k, 90, 3000)])), (200 + k, " ".join(body[:14]))]
        item = [decontaminate.plain(w) for w in items[k][1].split()]
        assert _longest(item, rows[k][1].split()) < decontaminate.CLOSE * len(item)
    found = [(r.doc_id, r.item_id) for r in decontaminate.leaks(
        spark.createDataFrame(rows + clean, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert len(found) == len(set(found)) and set(found) <= {(k, k) for k, _ in items}
    assert len(found) >= 27  # recall of nine in ten


def test_windows_cover_every_word():
    rng = np.random.default_rng(5)
    weighted = rng.random((9, 3)).astype(np.float32)
    texts = [rng.integers(-1, 9, n).astype(np.int32) for n in (0, 1, 7, 8, 33, 100, 0, 64)]
    for widths in ([32], [8, 32], [8, 16, 32]):
        seen = {(w, t, a): v for w, text, start, vectors in decontaminate.Windows(weighted, widths).of(texts)
                for t, a, v in zip(text.tolist(), start.tolist(), vectors)}
        for w in widths:
            for t, text in enumerate(texts):
                for a in range(0, len(text), w // 2):
                    held = text[a : a + w]
                    wanted = weighted[held[held >= 0]].sum(axis=0)
                    assert np.allclose(seen.get((w, t, a), 0), wanted, atol=1e-4)


def test_lcs_equals_table():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = rng.integers(0, 6, 20).tolist(), rng.integers(0, 6, 35).tolist()
        masks: dict = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        table = np.zeros((21, 36), int)
        for i in range(20):
            for j in range(35):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.lcs(masks, 20, b) == table[-1, -1]


def test_added_spans_touch_nothing_taken():
    """Against a comparison with every span so far."""
    rng = np.random.default_rng(12)
    parts = ["a@b.c", " ", "call +1 (555) 010-9999 ", "4111 1111 1111 1111", "1.2.3.4", "token = \"" + "0a1b" * 10 + "\"", "[at]", "x (at) y (dot) z",
             "12345678901", " - ", "é", "0123456789ab0123456789ab", "\n"]
    for _ in range(800):
        text = "".join(rng.choice(parts, rng.integers(1, 12)))
        base = pii.base_spans(text)
        every = pii.extra_spans(text, [])
        found = pii.extra_spans(text, base)
        taken = [(a, b) for _, a, b in base]
        assert all(b <= x or a >= y for _, a, b in found for x, y in taken)
        for kind, a, b in every:
            clash = [(x, y) for x, y in taken + [s[1:] for s in found] if x < b and y > a and (x, y) != (a, b)]
            assert (kind, a, b) in found or clash or (a, b) in taken


def test_candidates_that_hold_no_leak_are_told_by_their_words():
    """Surroundings without the item's words, or without its last sentence, are not searched passage by passage."""
    rng = np.random.default_rng(4)
    items = [rng.integers(0, 60, n) for n in (20, 34, 50)]
    lasts, idf = [w[-6:].tolist() for w in items], rng.uniform(0.5, 4, 60)
    rule = decontaminate.Rule(items, lasts, idf)
    search = decontaminate.Search(items, idf, rng.standard_normal((60, 24)).astype(np.float32))
    texts = []
    for i in range(90):
        text = rng.integers(-1, 60, rng.integers(1, 300))
        copy = items[i % 3][rng.random(len(items[i % 3])) < 0.5 + 0.1 * (i % 6)]
        texts.append(np.r_[text, copy, text[:40]] if i % 2 else text)
    all_ = list(search.candidates(texts))
    left = list(search.likely(texts, rule))
    held = lambda spots: {s: found for s in spots if (found := search.near(s[1], texts[s[0]][s[2] : s[3]], rule))}
    assert held(all_) == held(left) != {}
    assert len(left) < len(all_)
    for t, k, first, end in all_:
        there = np.isin(items[k], texts[t][first:end])
        answered = np.isin(lasts[k], texts[t][first:end]) @ rule.rarity[k] >= decontaminate.ANSWER * rule.rarity[k].sum()
        assert (t, k, first, end) in left or there.mean() < 1 or not answered


def test_words_that_a_leak_must_hold_one_of():
    """Whatever has ANSWER of the last sentence has one of the words asked for; places are those of these words."""
    rng = np.random.default_rng(7)
    idf = rng.uniform(0.5, 4, 40)
    lasts = [rng.integers(0, 40, n).tolist() for n in (1, 2, 5, 9, 30)] + [[]]
    rule = decontaminate.Rule([rng.integers(0, 40, 20) for _ in lasts], lasts, idf)
    text = rng.integers(-1, 40, 200)
    asked = [set(rule.asked(k).tolist()) for k in range(len(lasts))]
    assert rule.where_asked(text).tolist() == [k * 201 + i for k in range(len(lasts)) for i in range(200) if text[i] in asked[k]]
    for k, last in enumerate(lasts[:-1]):
        assert asked[k] and asked[k] <= set(last)
        there = np.ones(41, bool)
        there[list(asked[k])] = False
        assert not rule.answered(k, there)


def test_grammar_expands_as_its_rules_say():
    """Rules within rules; a rank among counts as sorting gives it."""
    rng = np.random.default_rng(6)
    ids = np.tile(rng.integers(0, 40, 37), 900)[rng.random(37 * 900) < 0.98].astype(np.uint32)
    body, rules, tokens = repair.compress(ids)

    def whole(symbol):
        if symbol < repair.FIRST_RULE:
            return [int(symbol)]
        return [x for side in rules[symbol - repair.FIRST_RULE] for x in whole(side)]

    assert [x for s in body for x in whole(s)] == repair.expand(body, rules).tolist() == ids.tolist()
    assert tokens.max() > 4 and [len(whole(repair.FIRST_RULE + i)) for i in range(len(rules))] == tokens.tolist()
    for counts in (np.array([5, 5, 3, 0, 9]), rng.integers(0, 50, 3000)):
        for n in (1, 2, 4):
            assert repair.nth_largest(counts, n) == np.sort(counts)[-n]
