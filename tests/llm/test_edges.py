"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import base64
import functools
import random
import string
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from netwatch.llm import bpe, langid, links, mixing, outliers, pii, repeats, sentences, simhash, unigram, winnow
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, label int, n_words int, batch int"
ENGLISH = "The quick brown fox jumps over the lazy dog near the river bank. It was a sunny day and all was well. "
GERMAN = "Der schnelle braune Fuchs springt über den faulen Hund am Flussufer. Es war ein schöner Tag für alle. "


def rows_of(texts):
    """Rows with columns whose names the operators use too; ids rise, langs alternate, some are NULL."""
    return [(i, t, (None, "en", "de")[i % 3], None if i % 5 == 0 else "s", None, "x", 1, 7, 3) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    long_text = " ".join("".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(30_000))
    return [
        None, "", " ", "\n\n", "a", "ö", "....", "12345 678", ENGLISH * 8, ENGLISH * 8, GERMAN * 8, GERMAN * 8 + "end",
        long_text, long_text, "x" * 50_000, "aaa " * 9_000, "ab\n" * 400, "日本語 テキスト 😀 " * 60, "A@b.co +1 (743) 555-3824 1.2.3.4",
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ENGLISH), (2, None), (3, ""), (None, GERMAN), (4, "sunny day"), (5, ENGLISH)], "item_id long, text string")


def found(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: (r[0] is not None, r))


def own_tiktoken():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, empty, texts):
    own = own_tiktoken()
    encoded = bpe.encode(docs, PATH, PATTERN, ["doc_id"])
    got = found(encoded, "doc_id", "token_ids")
    assert [ids for _, ids in got] == [own.encode_ordinary(t or "") for t in texts]
    back = found(bpe.decode(encoded, PATH, ["doc_id"]), "doc_id", "decoded")
    assert [bytes(b) for _, b in back] == [(t or "").encode() for t in texts]
    assert bpe.round_trip(empty, PATH, PATTERN, ["doc_id"]).count() == 0


@functools.cache
def both_coders():
    return own_tiktoken(), bpe.Encoder(PATH, PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abcdefghé \n\t'sx1\x1c\x85  ", max_size=80))
def test_bpe_fuzz(text):
    own, coder = both_coders()
    assert coder.encode([text.encode()])[0] == own.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=12), max_size=6), st.integers(0, 9))
def test_replay_with_any_merges(words, seed):
    """Vocabularies whose tokens do not rise with their parts: the lowest pair, then the leftmost, comes first."""
    rng = random.Random(seed)
    words = [bytes(b % 3 for b in w) for w in words]
    longer = [bytes(rng.choices(range(3), k=rng.randint(2, 4))) for _ in range(12)]
    tokens = [bytes([b]) for b in range(256)] + list(dict.fromkeys(longer))
    ranks = {t: i for i, t in enumerate(tokens[:256])} | {t: 256 + i for i, t in enumerate(rng.sample(tokens[256:], len(tokens) - 256))}

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return tuple(ranks[p] for p in parts)
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    assert bpe.replay(words, ranks) == [plain(w) for w in words]


def test_encoder_keeps_little_of_a_word():
    coder = bpe.Encoder(PATH, PATTERN)
    rng = random.Random(5)
    text = " ".join("".join(rng.choices(string.ascii_lowercase, k=9)) for _ in range(30_000)).encode()
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    coder.split([text])
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 340 * len(coder.known)
    assert coder.encode([text, None, b""]) == [both_coders()[0].encode_ordinary(text.decode()), [], []]


def test_unigram(docs, empty, texts):
    ranks = bpe.read_ranks(PATH)
    scores = unigram.zipf_scores(ranks)
    words = sorted({w.encode() for w in brute.regex.findall(PATTERN, ENGLISH + GERMAN + "日本 😀 xyzzyq '' a-b")})
    counts = unigram.terminal_counts(words, unigram.backward(scores))
    assert counts == [brute.unigram_count(w, scores) for w in words]
    got = found(unigram.token_counts(docs, PATH, PATTERN, ["doc_id"]), "doc_id", "n_words", "n_tokens")
    assert [r[2] for r in got[:3]] == [0, 0, 1] and len(got) == len(texts)
    assert got[8][1:] == got[9][1:]
    assert unigram.token_counts(empty, PATH, PATTERN, ["doc_id"]).count() == 0


def test_language_id(docs, empty, texts):
    model = langid.train(docs)
    got = found(langid.identify(docs, model, ["doc_id", "label"]), "doc_id", "lang_pred", "score", "rejected")
    by_id = {r[0]: r for r in got}
    for i, text in enumerate(texts):
        if not brute.WORD.search(text or ""):
            assert by_id[i][1:] == ("und", 0.0, True)
    assert {by_id[i][1] for i in (8, 9, 10, 11)} <= {"en", "de"}
    nothing = langid.train(empty)
    assert langid.identify(empty, nothing, ["doc_id"]).count() == 0
    assert {r[1] for r in found(langid.identify(docs, nothing, ["doc_id"]), "doc_id", "lang_pred")} == {"und"}


def test_kneser_ney_sums_to_one():
    counts = {}
    for word in ("aba", "abb", "ba"):
        part = f"{langid.START}{word}{langid.END}"
        for stop in range(2, len(part) + 1):
            for start in range(max(0, stop - 3), stop):
                counts[part[start:stop]] = counts.get(part[start:stop], 0) + 1
    logs, freed = langid.kneser_ney(counts, 3)
    letters = {g for g in logs if len(g) == 1}
    for context in (c for c in freed if len(c) < 2):
        seen = sum(np.exp(logs[context + x]) for x in letters if context + x in logs)
        lower = {x: np.exp(logs[x]) for x in letters}
        rest = sum(np.exp(freed[context]) * lower[x] for x in letters if context + x not in logs)
        unseen = langid.LETTERS - len(letters)
        tail = np.exp(freed[""]) / langid.LETTERS * unseen * (np.exp(freed[context]) if context else 1)
        assert abs(seen + rest * bool(context) + tail - 1) < 1e-9


def test_known_words_of_a_language_model_are_small(monkeypatch):
    """In lists of new words and of known ones: sums as for each word alone, and little memory for each."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abcdefgh", k=rng.randint(6, 12))) for _ in range(40_000)})
    learned = [langid.kneser_ney({f"{langid.START}": 1, "a": n, "b": 2, "ab": n}, 2) for n in (3, 5, 7, 9)]
    grams, freed = zip(*learned)
    ones = np.ones(4)
    model = langid.Model(
        list("defg"), [langid.table(grams, n) for n in (1, 2)], [langid.table(freed, n) for n in (0, 1)], ones, ones, ones, ones
    )
    known = langid.Known(model)
    tracemalloc.start()
    found, letters = langid.entropies([words, []], known)
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept / len(words) < 150 and most / len(words) < 500  # 200 and 1,638 bytes a word before, 96 and 262 since
    assert letters.tolist() == [sum(map(len, words)) + len(words), 0]
    monkeypatch.setattr(langid, "KEPT_WORDS", 100)
    again = langid.entropies([words[:7], ["b", *words[:7], "b"]], known)
    assert list(known.places) != words and len(known.places) == 8
    sums = [model.words([word])[0][0] for word in (*words[:7], "b", "b")]
    assert np.allclose(-again[0][1] * again[1][1], np.sum(sums, axis=0), rtol=1e-12)
    assert np.allclose(-again[0][0] * again[1][0], np.sum(sums[:7], axis=0), rtol=1e-12)


def test_lm_scores(docs, empty, texts):
    held = F.col("doc_id") % 4 == 0
    got = found(mixing.score_texts(docs, held), "doc_id", "n_tokens", "n_known", "score", "held_out", "n_bytes")
    assert [r[1] for r in got] == [len(brute.SPACE.findall(brute.lower(t or ""))) + 1 for t in texts]
    assert [r[5] for r in got] == [len((t or "").encode()) for t in texts]
    assert got[9][3] == got[8][3] and all(r[3] < 0 for r in got)
    assert mixing.score_texts(empty, held).count() == 0
    untrained = mixing.score_texts(docs, F.lit(True)).collect()
    assert {r.base_score for r in untrained} == {0.0} and {r.train_tokens for r in untrained} == {0}
    assert {r.n_known for r in untrained} == {0}


def test_the_mixer_prices_every_word_by_its_occurrences(monkeypatch):
    """Frequent, rare and new words alike, in two languages: near their shares, and no more than one in all."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdef", k=rng.randint(3, 8))).encode() for _ in range(900)} | {b""})
    counts = np.array([[rng.choice((0, 0, 1, 2, 400)), rng.choice((0, 1, 30))] for _ in words])
    known = np.flatnonzero(counts.any(axis=1))
    monkeypatch.setattr(mixing, "WORDS_AT_ONCE", 50)
    tables, mixer = mixing.Tables(2), mixing.Mixer()
    held, often = [words[i] for i in known], counts[known]
    parts = list(mixing.blocks(held))
    assert len(parts) > 5 and [i for part in parts for i in range(part.start, part.stop)] == list(range(len(held)))
    for part in parts:
        tables.learn(held[part], often[part])
    bits = 8 * sum((len(w) + 1) * n for w, n in zip(held, often.sum(axis=1).tolist()))
    assert [table.sum() for table in tables.counts[:-1]] == [bits] * len(mixing.TABLE_BITS)
    for part in parts:
        mixer.learn(tables, held[part], often[part])
    p = 10.0 ** mixer.log10(tables, words, counts)
    assert p.shape == counts.shape and (p > 0).all()
    assert (p.sum(axis=0) < 1).all() and (p.sum(axis=0) > 0.9).all()
    frequent = counts >= 30
    ratio = (p * counts.sum(axis=0) / np.maximum(counts, 1))[frequent]
    assert 0.9 < np.median(ratio) < 1.1 and ratio.min() > 0.3 and ratio.max() < 2
    new = [b"abcabcabca", b"\xff\x00\xfe", b"abz"]
    assert (mixer.log10(tables, new, np.zeros((3, 2), np.int64)) < np.log10(p[frequent].min())).all()


def test_words_that_begin_alike_are_looked_up_once(monkeypatch):
    """At most one look-up a bit of each beginning (and of each next bit, where learning); the order of words is nothing."""
    words = sorted(f"together{i:03}".encode() for i in range(300))
    counts = np.array([[i % 3, 1 + i % 2] for i in range(300)])
    tables, mixer = mixing.Tables(2), mixing.Mixer()
    tables.learn(words, counts)
    asked = []
    whole = mixing.Mixer.odds
    monkeypatch.setattr(mixing.Mixer, "odds", lambda self, held, found, *rest: asked.append(len(found[0])) or whole(self, held, found, *rest))
    mixer.learn(tables, words, counts)
    branches = len({word[:n] for word in (w + b" " for w in words) for n in range(1, 13)})
    assert max(asked) == branches < sum(map(len, words)) / 5
    asked.clear()
    prices = mixer.log10(tables, words, counts)
    assert max(asked) <= branches
    turn = np.random.default_rng(3).permutation(300)
    assert np.array_equal(mixer.log10(tables, [words[i] for i in turn], counts[turn]), prices[turn])


def test_text_as_context(monkeypatch):
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 6, n) for n in (1, 9, 50, 2, 2, 11)]
    prices, share = rng.uniform(0.01, 0.3, (6, 3)), np.array([0.5, 0.3, 0.2])
    expected = []
    for at in own:
        by_lang = [1.0] * 3
        for i, one in enumerate(at.tolist()):
            weight = mixing.RECENT_MOST * i / (i + mixing.RECENT_HALF)
            recent = at[:i].tolist().count(one) / max(i, 1)
            by_lang = [p * ((1 - weight) * prices[one, k] + weight * recent) for k, p in enumerate(by_lang)]
        expected.append(np.log10(np.dot(share, by_lang)))
    for size in (1 << 16, 12):
        monkeypatch.setattr(mixing, "TOKENS_AT_ONCE", size)
        got = [score for block in mixing.in_blocks(own) for score in mixing.texts_log10(block, prices, share)]
        assert np.allclose(got, expected, rtol=1e-12)


def test_repeated_strings(spark, docs, empty, texts):
    for length, gram in ((200, 32), (12, 4)):
        got = repeats.without_repeats(docs.filter("doc_id not in (12, 13)"), length=length, gram=gram)
        rows = [r for r in enumerate(texts) if r[0] not in (12, 13)]
        own = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in got.collect()]
        assert sorted(own) == brute.repeated_strings(rows, length)
    assert repeats.without_repeats(empty).count() == 0
    twins = spark.createDataFrame([(None, ENGLISH * 4), (None, ENGLISH * 4), (7, "b" * 250), (7, "c" * 199)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in repeats.without_repeats(twins).collect())
    assert got == [(199, 0), (250, 250), (len(ENGLISH) * 4,) * 2, (len(ENGLISH) * 4,) * 2]


@pytest.mark.parametrize(("forms", "shared"), [(256, 50_000), (1, 50_000), (1, 2)])
def test_repeated_strings_of_few_letters(spark, monkeypatch, forms, shared):
    monkeypatch.setattr(repeats, "FORMS", forms)
    monkeypatch.setattr(repeats, "SHARED", shared)
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 300)))) for i in range(40)]
    rows += [(100 + i, rows[i][1][10:] + rows[i + 1][1][:90]) for i in range(20)]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=14, gram=4)
    own = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in got.collect()]
    assert sorted(own) == brute.repeated_strings(rows, 14)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 64)
    cutter = repeats.Cutter(20, 5)
    data = bytes(random.Random(1).choices(b"abcd", k=500))
    names, forms, first, last = cutter.segments(data)
    windows = [s for a, b in zip(first, last) for s in range(a, b + 1)]
    assert windows == list(range(len(data) - 19))


def test_sentence_spans(docs, empty, texts):
    got = found(sentences.without_repeated_spans(docs), "doc_id", "n_sentences", "n_removed", "kept")
    own = [(a, b, c, brute.sha(d or "")) for a, b, c, d in got]
    assert own == brute.sentence_spans(list(enumerate(texts)), sentences.RUN, sentences.FEWEST, sentences.WORDS, sentences.sentences)
    assert all("".join(sentences.sentences(t)) == t for t in texts if t and t.strip())
    assert sentences.without_repeated_spans(empty).count() == 0


def test_outliers(docs, empty, texts):
    frame = outliers.judged(docs, ["doc_id", "n_words"], "lang", "source").toDF(
        "doc_id", "own_n_words", *outliers.STATISTICS, "base_failed", "distance", "kept"
    )
    got = found(frame, "doc_id", *outliers.STATISTICS, "base_failed")
    assert got == [(i, *(s := brute.statistics(t)), brute.base_failed(s)) for i, t in enumerate(texts)]
    assert {r.own_n_words for r in frame.collect()} == {7}
    assert outliers.judged(empty, ["doc_id"]).count() == 0


def test_outliers_reject_far_rows_only(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(5_000)]
    clean = [" ".join(rng.choices(words, k=rng.randint(60, 300))) for _ in range(300)]
    odd = [" ".join(w + "###" for w in rng.choices(words, k=100)) for _ in range(30)]
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + odd)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in outliers.judged(frame, ["doc_id"]).filter("kept").collect()}
    assert kept == set(range(300))


def test_outliers_stand_with_two_fifths_junk(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(5_000)]
    clean = [" ".join(rng.choices(words, k=rng.randint(60, 300))) for _ in range(300)]
    odd = [" ".join(w + "###" for w in rng.choices(words, k=100)) for _ in range(200)]
    few = [" ".join(rng.choices(words, k=100)) for _ in range(45)]
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + odd)]
    rows += [(500 + i, t, "de", f"s{i % 3}") for i, t in enumerate(few * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in outliers.judged(frame, ["doc_id"]).filter("kept").collect()}
    assert kept == set(range(300)) | set(range(500, 590))


def plain_determinant(points):
    """Concentration in numpy with exact ranks, from the median start: which rows are near enough."""
    least = np.array([floor for _, floor in outliers.COORDINATES.values()])
    half = (len(points) + points.shape[1] + 1 + 1) // 2

    def squared(centre, cov):
        off = points - centre
        return np.einsum("ij,ij->i", off, np.linalg.solve(cov, off.T).T)

    def moments(rows):
        return rows.mean(axis=0), np.cov(rows.T, bias=True) + np.diag(least**2)

    centre = np.median(points, axis=0)
    spread = np.median(abs(points - centre), axis=0) / outliers.NORMAL_MEDIAN
    d = squared(centre, np.diag(spread**2 + least**2))
    for _ in range(50):
        d = squared(*moments(points[np.argsort(d, kind="stable")[:half]]))
    scale = max(np.median(d) / outliers.CHI_MEDIAN, 1)
    d = squared(*moments(points[d <= outliers.INNER * scale]))
    return d / max(np.median(d) / outliers.CHI_MEDIAN, 1)


def test_outliers_agree_with_plain_determinant(spark):
    """All verdicts but those of rows near the cutoff, which ranks by bins may turn."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "text", "'en' lang", "'s' source")
    got = outliers.judged(docs, ["doc_id"]).filter("NOT base_failed").selectExpr(
        "doc_id", "kept", *(f"{sql} AS {name}" for name, (sql, _) in outliers.COORDINATES.items())
    ).toPandas()
    own = plain_determinant(got[list(outliers.COORDINATES)].to_numpy(float))
    sure = (own < outliers.CUTOFF / 1.5) | (own > outliers.CUTOFF * 1.5)
    assert sure.mean() > 0.9
    assert (got["kept"].to_numpy() == (own <= outliers.CUTOFF))[sure].all()


def test_outliers_use_no_python(docs):
    plan = outliers.judged(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_pii_fuzz():
    rng = random.Random(4)
    pieces = ["@", "a", "b.c", "x-y", "1", "23", "256", ".", "..", "+", "+1", " ", "-", "(", ")", "é", "\n", "4494599396683407", "192.168.0.1", "%", "_"]
    for _ in range(3_000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 30)))
        own = [(s.start, s.kind, s.end) for s in pii.find_spans(text) if s.kind < 4]
        assert own == brute.base_spans(text), text


def test_pii_adds_and_masks(docs, empty, spark):
    text = "Account IBAN DE89 3704 0044 0532 0130 00 and call (743) 555-3824 now; SSN 078-05-1120. Order (743) 555-3824"
    kinds = [pii.KINDS[s.kind] for s in pii.find_spans(text)]
    assert kinds[0] == "iban" and "ssn" in kinds and kinds.count("national_phone") >= 1
    assert not [s for s in pii.find_spans("DE89 3704 0044 0532 0130 01") if pii.KINDS[s.kind] == "iban"]
    number = "DE89 3704 0044 0532 0130 00"
    for after in ("", " BIC COBADEFF", ", bank", " 12", " GB82 WEST 1234 5698 7654 32"):
        spans = pii.find_spans(f"IBAN {number}{after}")
        assert (spans[0].start, pii.KINDS[spans[0].kind], spans[0].end) == (5, "iban", 5 + len(number)), after
        assert len(spans) == 1 + after.startswith(" GB")
    masked = {r.doc_id: r for r in pii.mask_pii(docs).collect()}
    assert masked[0].text is None and masked[18].text == "<EMAIL> <PHONE>"  # the phone pattern takes in ` 1.2.3.4`: 15 digits
    assert pii.mask_pii(docs).columns == docs.columns
    assert pii.count_pii(empty, ["doc_id"]).count() == 0
    long_texts = ["a" * 300_000 + "@", "1" * 300_000, "+" * 100_000, "1 " * 150_000, "1." * 150_000, "a@" * 150_000]
    assert all(len(pii.find_spans(t)) >= 0 for t in long_texts)
    assert pii.find_pii(docs, ["doc_id"]).filter("doc_id = 18").first().pii[0].kind == "email"


def test_simhash(spark, docs, empty, texts):
    got = found(simhash.near_duplicates(docs, size=4), "doc_id", "fp", "component_id")
    own = [(a, f"{b % (1 << 64):016x}", c) for a, b, c in got]
    assert own == brute.simhash_classes(list(enumerate(texts)), 4, 4)
    assert simhash.near_duplicates(empty).count() == 0
    first = simhash.first_of_each(docs)
    assert first.columns == docs.columns
    twins = spark.createDataFrame([(None, "a"), (None, "a"), (5, "b c"), (5, "b c")], "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in simhash.first_of_each(twins).collect()) == [0, 0, 5]
    unlike = spark.createDataFrame([(5, "b c"), (5, ENGLISH), (5, ENGLISH), (6, ENGLISH)], "doc_id long, text string")
    assert sorted(r.text for r in simhash.first_of_each(unlike).collect()) == sorted(["b c", ENGLISH])


def near_copies():
    """Texts with some words replaced, a passage that all texts share, and a chain of copies of copies."""
    rng = random.Random(11)
    words = ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(3_000)]
    shared = rng.choices(words, k=60)
    out = []
    for _ in range(40):
        base = shared + rng.choices(words, k=200)
        out.append(base)
        for changed in (1, 3, 5, 8, 20):
            copy = list(base)
            for at in rng.sample(range(60, 260), changed):
                copy[at] = "new"
            out.append(copy)
    for _ in range(6):
        out.append([*out[-1]])
        out[-1][rng.randrange(60, 260)] = "link"
    return [" ".join(text) for text in out]


def test_texts_of_a_similarity_meet(spark, docs, empty, texts):
    rows = list(enumerate(near_copies()))
    expected = brute.similar_classes(rows, 5, 0.8)
    assert 40 < len({label for _, label in expected}) < len(rows) / 2
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(simhash.near_duplicates(frame, similar=0.8), "doc_id", "component_id") == expected
    kept = sorted(r.doc_id for r in simhash.first_of_each(frame).collect())
    assert kept == sorted({label for _, label in expected})
    edges = found(simhash.near_duplicates(docs, similar=0.8), "doc_id", "component_id")
    assert edges == brute.similar_classes(list(enumerate(texts)), 5, 0.8)
    assert simhash.near_duplicates(empty, similar=0.8).count() == 0


def test_samples_do_not_depend_on_order():
    hashed = np.random.default_rng(3).integers(0, 1 << 63, 40_000).astype(np.uint64)
    one = simhash.sample_fingerprints(hashed)
    assert (one == simhash.sample_fingerprints(np.concatenate([hashed[::-1], hashed]))).all()
    assert len(set(one.tolist())) == simhash.SAMPLES
    assert (simhash.sample_fingerprints(hashed[:0]) == 0).all()


def test_simhash_blocks_lose_no_link(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(30)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(12)]
    fps = sorted(set(base + near))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    filed = nodes.select("fp", F.explode(simhash.block_keys(F.col("fp"), 7, 4)).alias("k")).select("k.*", "fp")
    edges = simhash.bucket_links(filed.repartition(4, "choice", "bits").sortWithinPartitions("choice", "bits"), 4)
    label = {r.node: r.label for r in links.components(edges).collect()}
    root = {f: f for f in signed}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) % (1 << 64)).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert all(label.get(f, f) == find(f) for f in signed)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    edges = spark.createDataFrame(chain, "a long, b long")
    label = {r.node: r.label for r in links.components(edges).collect()}
    assert {label[i] for i in range(1, 61)} == {1} and {label[i] for i in range(100, 140)} == {100}
    assert label[200] == 200


def test_winnowing(docs, empty, benchmark, texts):
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    expected = brute.contamination(list(enumerate(texts)), items)
    for most in (1_000_000, 0):
        frame = winnow.contaminated(docs, benchmark, ["doc_id", "label"], broadcast_words=most)
        got = found(frame, "doc_id", "n_words", "n_hit", "item_ids")
        assert [(a, b, c, len(d), brute.sha(",".join(d)), c > 0) for a, b, c, d in got] == expected
    none = benchmark.filter("false")
    assert winnow.contaminated(docs, none, ["doc_id"]).filter("n_hit > 0").count() == 0
    assert winnow.contaminated(empty, benchmark, ["doc_id"], broadcast_words=0).count() == 0
    assert winnow.clean_only(docs, benchmark).columns == docs.columns


def test_winnowing_of_few_words(spark):
    rng = random.Random(6)
    make = lambda n: " ".join(rng.choices("abc", k=n))
    items = [(i, make(rng.randint(0, 16))) for i in range(12)]
    rows = [(i, make(rng.randint(0, 60))) for i in range(60)]
    frames = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (1_000_000, 0):
        got = found(winnow.contaminated(*frames, ["doc_id"], broadcast_words=most), "doc_id", "n_words", "n_hit", "item_ids")
        assert [(a, b, c, len(d), brute.sha(",".join(d)), c > 0) for a, b, c, d in got] == brute.contamination(rows, items)


def test_winnowing_of_items_with_one_id(spark):
    items = [(7, ENGLISH), (7, GERMAN), (8, ENGLISH), (None, GERMAN)]
    rows = [(1, f"so {ENGLISH} and {GERMAN}"), (2, GERMAN), (3, "nothing of these")]
    frames = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (1_000_000, 0):
        got = found(winnow.contaminated(*frames, ["doc_id"], broadcast_words=most), "doc_id", "item_ids")
        assert got == [(1, ["7", "8"]), (2, ["7"]), (3, [])]


def test_training_rows_keep_their_bound_without_ids(spark):
    rows = [(None, f"text {i}", "en") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert 300 < langid.training_rows(docs, 500, "lang", "text", "doc_id").count() < 700


def test_pipeline_stages_keep_columns(spark, docs, empty):
    folder = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert name == "tokens" or out.columns == docs.columns
        assert out.count() <= docs.count()
        assert stage(spark, empty, folder).count() == 0
