"""Operators of the llm subpackage against brute force, exact round trips and held-out accuracy, with the defined odd cases."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstrata.llm import bpe, chat, components, language_id, media, ngram_jaccard, packing, pii, quality_classifier, quality_rules, queries, site_style

public_tokenizers = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"
ODD = [(1, "a b c d e f g h i j"), (2, None), (3, ""), (4, "a b c d e f g h i j"), (4, "a b c d e f g h i j"), (None, "x y"), (5, "wörd " * 3000), (6, "\x00\n\n \t"), (7, "one"), (8, "😀 日本語 \U0001f600")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", len(t or ""), "clash", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, n int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# 1 chat


def least_cost(roles):
    """All ways of repair of a short sequence, by recursion."""
    known = [chat.role_of(r) for r in roles]

    def go(i, state):
        if i == len(known):
            return chat.ending(state)
        return min((cost + go(i + 1, b) for a, b, cost, *_ in chat.STEPS[known[i]] if a == state), default=chat.FAR)

    return go(0, chat.START)


def test_chat_costs_equal_brute_force(spark):
    pool = ["user", "assistant", "system", "bot", "weird", None]
    cases = [list(c) for n in (1, 2, 3) for c in itertools.product(pool, repeat=n)]
    random.seed(1)
    cases += [[random.choice(pool) for _ in range(5)] for _ in range(40)]
    rows = [(k, 300 * i, r, f"t{i}") for k, c in enumerate(cases) for i, r in enumerate(c)]
    out = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    cost = {r["conv_id"]: r["cost"] for r in out}
    assert len(out) == len(rows)
    assert cost == {k: least_cost(c) for k, c in enumerate(cases)}


def test_chat_renders_legal_sequences(spark):
    d = spark.read.parquet(f"{DATA}/conversations.parquet")
    rows = chat.repair(d).orderBy("conv_id", "stretch", "at").collect()
    assert len(rows) == d.distinct().count()
    whole = defaultdict(str)
    for r in rows:
        whole[r["conv_id"]] += r["rendered"]
    for text in whole.values():
        roles = [x.split("|>")[0] for x in text.split("<|end|>\n") if x]
        roles = [x.removeprefix("<|") for x in roles]
        state = chat.START
        for r in roles:
            state = chat.LEGAL[state][chat.ROLES.index(r)]


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, cost string"
    assert chat.repair(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, None, "x"), (1, 0, "user", "a", "x"), (1, 0, "user", "a", "y"), (1, -700, "system", "s", "x")]
    got = [(r["conv_id"], r["new_role"]) for r in chat.repair(spark.createDataFrame(rows, schema)).orderBy("conv_id", "stretch", "at").collect()]
    assert got == [(None, "user"), (1, "system"), (1, "user")]


def best_repairs(roles):
    """The least cost and the renderings that have it, by trying all; first that of the least end state, and of options in their order."""
    known = [chat.role_of(r) for r in roles]

    def go(i, state):
        if i == len(known):
            return [(chat.ending(state), state, [])] if chat.ending(state) < chat.FAR else []
        out = []
        for k, (a, b, cost, option, new, inserted) in enumerate(chat.STEPS[known[i]]):
            if a == state:
                out += [(cost + c, end, [(k, option, new, inserted), *way]) for c, end, way in go(i + 1, b)]
        return out

    def render(way):
        turns = []
        for (_, option, new, inserted), text in zip(way, (f"t{i}" for i in range(len(roles))), strict=True):
            if option == "merge":
                turns[-1][1] += "\n" + text
                continue
            if inserted is not None:
                turns.append([inserted, None])
            turns.append([new, text])
        if turns[-1][0] == 0:
            turns.append([1, None])
        return "".join(f"<|{chat.ROLES[r]}|>\n" + (t + "<|end|>\n" if t is not None else "<|end|>\n") for r, t in turns)

    all_ = sorted(go(0, chat.START), key=lambda x: (x[0], x[1], [w[0] for w in x[2]]))
    return all_[0][0], [render(way) for cost, _, way in all_ if cost == all_[0][0]]


@pytest.mark.parametrize("gap", [1, 97, 300])
def test_chat_renders_the_best_of_all_repairs(spark, gap):
    """Many turns in one stretch, some in each, and one in each: cost, ties and rendering are those of the whole search."""
    pool = ["user", "assistant", "system", "bot", "weird", None]
    rnd = random.Random(gap)
    cases = [list(c) for n in (1, 2) for c in itertools.product(pool, repeat=n)] + [[rnd.choice(pool) for _ in range(rnd.randint(3, 5))] for _ in range(60)]
    rows = [(k, gap * i, r, f"t{i}") for k, c in enumerate(cases) for i, r in enumerate(c)]
    out = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "stretch", "at").collect()
    whole, cost = defaultdict(str), {}
    for r in out:
        whole[r["conv_id"]] += r["rendered"]
        cost[r["conv_id"]] = r["cost"]
    for k, c in enumerate(cases):
        least, ways = best_repairs(c)
        assert cost[k] == least
        assert whole[k] in (ways if gap > 1 else ways[:1]), c


def test_chat_rows_without_conversation_and_piles_of_one_turn(spark):
    rows = [(None, 1, "user", f"q{i}") for i in range(700)] + [(1, 5, "user" if i % 2 == 0 else "assistant", f"{i:04d}") for i in range(900)] + [(1, None, "user", f"n{i:04d}") for i in range(600)]
    rows += [(2, i, "user" if i % 2 == 0 else "assistant", "x" * 2000) for i in range(2000)]
    out = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(out) == len(rows)
    alone = [r for r in out if r["conv_id"] is None]
    assert {(r["cost"], r["rendered"].count("<|end|>")) for r in alone} == {(0, 1)}
    one = sorted((r for r in out if r["conv_id"] == 1), key=lambda r: (r["stretch"], r["at"]))
    assert max(r["at"] for r in one) < chat.STRETCH
    order = [(r["turn"] is None, r["turn"] or 0, r["role"], r["rendered"].replace("<|end|>\n", "").split("\n")[-1]) for r in one]
    assert [o[:3] for o in order] == sorted(o[:3] for o in order)
    assert {r["cost"] for r in out if r["conv_id"] == 2} == {0}


# 2 quality, 4 language, 7 rules


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op2_quality_compression(spark, sf).collect()]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_classifier_odd_cases(spark, odd):
    none = quality_classifier.fit_texts([], [])
    assert {r["score"] for r in quality_classifier.score(odd, none).collect()} == {0.5}
    model = quality_classifier.fit_texts([f"good text number {i} of plain words" for i in range(20)], [f"### $$$ {i} %%% &&&" for i in range(20)])
    rows = quality_classifier.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    kept = quality_classifier.keep_good(odd, model)
    assert kept.columns == odd.columns
    assert quality_classifier.score(odd.limit(0), model).count() == 0


def test_classifier_scores_equal_brute_force(spark):
    """The score again, from the sizes of blocks by zstandard's plain interface and from the curve's formula."""
    import math

    import zstandard

    good = [f"plain words of text number {i} that say what they mean in sentences {i * 7}" for i in range(30)]
    bad = [f"buy $$$ {i} now *** click {'!' * (i % 5)} #{i} | | |" for i in range(30)]
    model = quality_classifier.fit_texts(good, bad)
    assert len(model.good) == len(model.bad)
    assert all(g[:16].encode() in model.good for g in good[::2]) and not any(g.encode() in model.good for g in good[1::2])
    texts = good[1::2] + bad[1::2] + ["é" * 700, "x", "\x00"]

    def size(content, data):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=quality_classifier.LEVEL)
        one = zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False)
        return sum(len(one.compress(data[i : i + quality_classifier.BLOCK_BYTES])) for i in range(0, len(data), quality_classifier.BLOCK_BYTES))

    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        a, b = size(model.good, t.encode()), size(model.bad, t.encode())
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(model.offset + model.slope * (b - a) / (a + b)))))
    assert min(got[i] for i in range(15)) > 0.5 > max(got[15 + i] for i in range(15))


def test_sample_is_bounded_and_takes_stretches_from_everywhere(spark):
    from quillstrata.llm.sample import sample_texts

    docs = spark.createDataFrame([(i, "".join(chr(0x4E00 + k) for k in range(400))) for i in range(300)], "doc_id long, text string")
    got = sample_texts(docs.select("doc_id", F.lit("a").alias("by")), docs, "by", 64, 50)
    assert 30 < len(got) <= 64 and all(len(t) == 50 for _, _, t in got)
    assert max(ord(t[0]) for _, _, t in got) > 0x4E00 + 250 and [i for _, i, _ in got] != sorted(i for _, i, _ in got)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op4_language_cross_parsing(spark, sf).collect() if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) / len(rows) > 0.97


def test_language_phrases_equal_brute_force():
    model = language_id.fit_texts({"a": ["abracadabra banana"], "b": ["lorem ipsum dolor"]})
    parser = language_id.Parser(model)

    def phrases(train, text):
        i = n = 0
        while i < len(text):
            j = i + 1
            while j <= len(text) and text[i:j] in train:
                j += 1
            i, n = max(i + 1, j - 1), n + 1
        return n

    random.seed(3)
    texts = ["".join(random.choice("abrcdnlopm ") for _ in range(random.randint(1, 80))) for _ in range(60)] + ["zzz", "ab?ab"]
    got = parser.entropies(texts)
    for k, (_, train) in enumerate(model.texts):
        for i, text in enumerate(texts):
            assert got[i, k] * len(text) / parser.bits[k] == pytest.approx(phrases(train, text))


@pytest.mark.parametrize("cells", [32_000_000, 1])
def test_languages_of_large_and_many_scripts(monkeypatch, cells):
    monkeypatch.setattr(language_id, "DENSE_CELLS", cells)  # with few cells the most frequent characters alone have columns
    random.seed(5)
    scripts = {"el": (0x3B1, 24), "hi": (0x905, 48), "ja": (0x3041, 80), "ko": (0xAC00, 900), "or": (0xB05, 45), "zh": (0x4E00, 1200), "zz": (0x20000, 300)}
    words = {lang: ["".join(chr(a + random.randrange(n)) for _ in range(3)) for _ in range(300)] for lang, (a, n) in scripts.items()}
    words["zh2"] = ["".join(chr(0x4E00 + random.randrange(1200)) for _ in range(3)) for _ in range(300)]  # the same characters in other words
    text = lambda lang, n: " ".join(random.choice(words[lang]) for _ in range(n))
    model = language_id.fit_texts({lang: [text(lang, 900) for _ in range(8)] for lang in words})
    parser = language_id.Parser(model)
    for lang in words:
        assert parser.predict([text(lang, 40) for _ in range(5)])[0] == [lang] * 5
    texts = ["".join(random.choice(random.choice(words["zh"]) + " ?") for _ in range(60)) + text("zh", 20) for _ in range(3)]
    got = parser.entropies(texts)
    for k, (_, train) in enumerate(model.texts):
        for t, own in zip(texts, got[:, k] / parser.bits[k], strict=True):
            i = n = 0
            while i < len(t):
                j = i + 1
                while j <= len(t) and t[i:j] in train:
                    j += 1
                i, n = max(i + 1, j - 1), n + 1
            assert own * len(t) == pytest.approx(n)


def test_language_odd_cases(spark, odd):
    rows = language_id.identify(odd, language_id.fit_texts({"en": ["a b c d the words of a text"], "xx": ["日本語 words"]})).collect()
    assert len(rows) == len(ODD)
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (2, 3, 6))
    assert {r["lang_pred"] for r in language_id.identify(odd, language_id.fit_texts({})).collect()} == {"und"}
    assert language_id.fit(odd.limit(0)).texts == ()
    numbers = spark.createDataFrame([(1, "²½ 12 ٣"), (2, "²½ a")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language_id.identify(numbers, language_id.fit_texts({"en": ["a b c d"]})).orderBy("doc_id").collect()] == ["und", "en"]
    tie = language_id.fit_texts({"b": ["same text"], "a": ["same text"]})
    assert language_id.Parser(tie).predict(["same text"])[0] == ["a"]


def test_rules_equal_brute_force(spark, docs):
    import re

    word = re.compile(r"[^ \t-\r]+")
    refs = quality_rules.fit(docs)
    own = {r["doc_id"]: r for r in quality_rules.judge(docs, refs).collect()}
    words_of_en = Counter(w for r in docs.where("lang = 'en'").collect() for w in word.findall(r["text"]))
    en = next(r for r in refs if r.lang == "en")
    assert en.total == sum(words_of_en.values())
    assert [n for _, n in en.words] == sorted(words_of_en.values(), reverse=True)[: quality_rules.COMMON_WORDS]
    for r in docs.collect():
        w, seen, dup = word.findall(r["text"]), set(), 0
        for line in r["text"].split("\n"):
            if word.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count, covered = Counter(windows), set()
        for i, x in enumerate(windows):
            if count[x] > 1:
                covered |= {i, i + 1, i + 2}
        got = own[r["doc_id"]]
        assert [got[c] for c in quality_rules.COUNTS] == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r["text"])), dup, len(covered)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        assert got["base_failed"] == failed
        assert not (failed and got["kept"])


def test_rules_verdict_equals_brute_force(spark):
    """Distances and verdicts again, text by text, with histograms of Counter and the divergence by its definition."""
    import math
    import unicodedata

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    refs = quality_rules.fit(docs)

    def distance(p, q):
        a, b = sum(p.values()), sum(q.values())
        total = 0.0
        for k in {*p, *q}:
            x, y = p.get(k, 0) / a, q.get(k, 0) / b
            m = (x + y) / 2
            total += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
        return math.sqrt(max(0.0, total / 2))

    def kind(ch):
        if ch == "\n":
            return "line"
        if ch.isspace():
            return "space"
        if ch in ".,;:!?'\"()-":
            return "stop"
        c = unicodedata.category(ch)
        return {"Ll": "lower", "Lu": "upper", "Lt": "upper", "Nd": "digit"}.get(c) or ("letter" if c in ("Lo", "Lm", "Mn", "Mc") else "symbol" if c[0] in "PS" else "other")

    own = {r["doc_id"]: r for r in quality_rules.judge(docs, refs).collect()}
    for r in docs.collect():
        got, n = own[r["doc_id"]], len(r["text"].encode().split())
        if not n:
            continue
        by_class = min(distance(Counter(map(kind, r["text"])), dict(zip(quality_rules.CLASSES, ref.classes, strict=True))) for ref in refs)
        by_word = 9.0
        for ref in refs:
            common = dict(ref.words)
            have = Counter(w if w in common else None for w in r["text"].encode().split())
            by_word = min(by_word, distance(have, {**common, None: ref.total - sum(common.values())}))
        assert got["class_distance"] == pytest.approx(by_class) and got["word_distance"] == pytest.approx(by_word)
        strays = by_class > quality_rules.CLASS_LIMIT + quality_rules.CLASS_SLACK / math.sqrt(n) or (n >= quality_rules.WORD_GUARD and by_word > quality_rules.WORD_LIMIT + quality_rules.WORD_SLACK / math.sqrt(n))
        assert got["kept"] == (not got["base_failed"] and not strays)


def test_rules_count_long_texts_by_pieces(monkeypatch):
    text = ("Ab1 #é😀\n" * 40).encode()
    whole = quality_rules.kinds_of(text)
    monkeypatch.setattr(quality_rules, "PIECE", 7)
    assert (quality_rules.kinds_of(text) == whole).all() and whole.sum() == len(text.decode())


def test_rules_odd_cases(spark, odd):
    rows = quality_rules.judge(odd, []).collect()
    assert len(rows) == len(ODD)
    assert [r for r in rows if r["doc_id"] in (2, 3, 6)][0]["n_words"] == 0
    assert quality_rules.keep_judged(odd, quality_rules.fit(odd)).columns == odd.columns
    assert quality_rules.fit(odd.limit(0)) == []


def test_rules_keep_a_reference_of_every_language(spark):
    rows = []
    for k in range(70):
        own = ["".join(chr(97 + (k * 7 + i * 3 + j * j) % 26) for j in range(4)) + chr(0x3B1 + k % 20) + str(k) for i in range(20)]
        rows += [(100 * k + d, f"l{k:02d}", " ".join(f"{own[(i * (d + 3)) % 20]} {own[(i * i + d) % 20]}" for i in range(100 - k // 2))) for d in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    refs = quality_rules.fit(docs)
    assert [r.lang for r in refs] == sorted({x[1] for x in rows})
    for ref in refs:
        words = Counter(w for _, lang, t in rows if lang == ref.lang for w in t.encode().split())
        assert ref.words == tuple(sorted(words.items(), key=lambda x: (-x[1], x[0]))[: quality_rules.COMMON_WORDS])
    assert max(r["word_distance"] for r in quality_rules.judge(docs, refs).collect()) < 0.4


def test_distance_is_symmetric_and_bounded():
    p, q = np.array([[1.0, 0, 0]]), np.array([0, 0, 1.0])
    assert quality_rules.distances(p, q)[0] == pytest.approx(1.0)
    assert quality_rules.distances(p, p[0])[0] == pytest.approx(0.0)


# 3 media


def test_media_round_trip_and_digests(spark, odd):
    for r in media.text_tiles(odd).collect():
        data = next((t or "").encode() for i, t in ODD if i == r["doc_id"])
        want = data + b" " * (-len(data) % 192 if data else 192)
        assert media.read_npy(bytes(r["tile"])).tobytes() == want
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-16:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(r["tile"]), hashlib.sha256(bytes(r["tile"])).hexdigest())


def test_area_resize_equals_direct_means():
    image = np.random.default_rng(0).integers(0, 256, (12, 20, 3))
    want = image.reshape(4, 3, 5, 4, 3).mean((1, 3))
    assert np.allclose(media.area_resize(image, 4, 5), want)


@pytest.mark.parametrize("data", [b"P1\n# c\n2 1\n1 0", b"P2\n2 1\n255\n0 255", b"P3 1 1 255 1 2 3", b"P4\n2 1\n\x80", b"P5 2 1 255\n\x00\xff", b"P6 1 1 255\n\x01\x02\x03"])
def test_netpbm_forms(data):
    image = media.decode(data)
    assert image.ndim == 3 and image.size in (2, 3)


def test_bmp_and_bad_images(spark):
    head = b"BM" + (70).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (2).to_bytes(4, "little") + b"\1\0" + (24).to_bytes(2, "little") + b"\0" * 24
    image = media.decode(head + b"\1\2\3\4\5\6\0\0" + b"\7\x08\x09\x0a\x0b\x0c\0\0")
    assert image.tolist() == [[[9, 8, 7], [12, 11, 10]], [[3, 2, 1], [6, 5, 4]]]
    d = spark.createDataFrame([(1, bytearray(b"P6 1 1 255\n\x01\x02\x03")), (2, bytearray(b"nothing")), (3, None)], "id long, data binary")
    got = {r["id"]: r["error"] for r in media.tiles(d, "id", "data").collect()}
    assert got[1] is None and got[2] and got[3]


def test_area_resize_at_broken_ratios():
    """Each target pixel is the mean of the source weighted by what it covers of each pixel."""
    image = np.random.default_rng(1).integers(0, 256, (7, 11, 2))

    def shares(n, m):
        out = np.zeros((m, n))
        for i in range(m):
            for j in range(n):
                out[i, j] = max(0.0, min((i + 1) * n / m, j + 1) - max(i * n / m, j)) * m / n
        return out

    want = np.einsum("ai,bj,ijc->abc", shares(7, 3), shares(11, 5), image)
    assert np.allclose(media.area_resize(image, 3, 5), want)
    grey = np.einsum("ai,bj,ijc->abc", shares(7, 8), shares(11, 9), image).mean(2)
    bits = "".join("1" if x > 0 else "0" for x in np.round(np.diff(grey, axis=1), 6).ravel())
    assert media.difference_hash(image) == f"{int(bits, 2):016x}"


def test_odd_images_are_refused_or_scaled(spark):
    assert media.decode(b"P2 3 1 4 0 2 4").ravel().tolist() == [0, 128, 255]
    assert media.decode(b"P5 1 1 1000 " + (500).to_bytes(2, "big"))[0, 0, 0] == 32768
    bad = [b"P2 2 1 255 0 300", b"P2 1 1 255 99999999999999999999999", b"P5 1 1 4 \x09", b"P2 99999999999 99999999999 255 1"]
    masks = b"BM" + b"\0" * 8 + (66).to_bytes(4, "little") + (40).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(4, "little") + b"\1\0" + (32).to_bytes(2, "little") + (3).to_bytes(4, "little") + b"\0" * 20 + (0xFF).to_bytes(4, "little") + (0xFF00).to_bytes(4, "little") + (0xFF0000).to_bytes(4, "little") + b"\1\2\3\4"
    d = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([*bad, masks])], "id long, data binary")
    assert all(r["error"] and r["tile"] is None for r in media.tiles(d, "id", "data").collect())
    assert media.tiles(d.limit(0), "id", "data").count() == 0


# 5 personal data


def test_surrogates(spark):
    rows = [(1, "Mail a.b7@mail.example.com, A.B7@mail.example.com; ip 10.1.2.3"), (2, "+1 (569) 555-7279 and 15695557279; card 4111 1111 1111 1111 or 4111111111111111"), (3, 'token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"'), (4, "Mr. James Smith saw Mary Jones; Mr Smith left"), (5, None), (6, ""), (7, "nothing here. 3 words")]
    out = {r["doc_id"]: r["text"] for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert out[5] is None and out[6] == "" and out[7] == rows[6][1]
    assert "mail.example" not in out[1] and "10.1.2.3" not in out[1] and "9c8b4543" not in out[3]
    a, b = [w.rstrip(",;") for w in out[1].split() if "@" in w]
    assert a == b.lower() and a.endswith(".example.org")
    cards = "".join(ch for ch in out[2].split("card ")[1] if ch.isdigit())
    assert cards[:16] == cards[16:]
    digits = [int(c) for c in reversed(cards[:16])]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    names = out[4].replace(";", "").split()
    assert names[1] in pii.MALE_NAMES and names[1] != "James" and names[4] in pii.FEMALE_NAMES
    assert names[2] == names[7] != "Smith"


def test_surrogates_stay_distinct_and_run_natively(spark, docs):
    found = pii.entities(docs).select("kind", "normal", F.col("found")).distinct()
    made = found.withColumn("new", pii.surrogate(F.col("kind"), F.col("found"), F.col("normal"), F.lit("k"), F.lit(0)))
    kinds = made.groupBy("kind").agg(F.count_distinct("normal").alias("a"), F.count_distinct(pii.normal_form(F.col("kind"), F.col("new"))).alias("b")).collect()
    assert kinds and all(r["a"] == r["b"] for r in kinds)
    plan = pii.replace(docs, "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_more_formats_of_personal_data(spark):
    phones = ["+1 555 123 4567", "555 123 4567", "+44 20 7946 0958", "+49 30 1234567", "+33 6 12 34 56 78", "020 7946 0958", "06 12 34 56 78"]
    secrets = ["access_token=Zx9qLmnopq", "client_secret: 'q8WvTTpzz'", "AWS_SECRET_ACCESS_KEY=abcDEF123+/x", '"api_key": "k3yk3yk3y"']
    other = ["2001:db8::1", "fe80::1ff:fe23:4567:890a", "2001:0DB8:0:0:0:0:0:1", "Emily Brown", "Andreas Schulz"]
    kinds = ["phone"] * len(phones) + ["secret"] * len(secrets) + ["ip"] * 3 + ["person"] * 2
    texts = phones + secrets + other
    clean = ["std::vector a::b", "at 12:30:45 on 2024-01-02", "12 345 678 items", "the tokens and secrets: few"]
    docs = spark.createDataFrame([(i, f"See {t} now") for i, t in enumerate(texts + clean)], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["_pii"]) for r in pii.replace(docs, "k").collect()}
    for i, (t, kind) in enumerate(zip(texts, kinds, strict=True)):
        assert got[i][1] == [kind] and t not in got[i][0] and got[i][0].startswith("See ") and got[i][0].endswith(" now"), (t, got[i])
    assert got[len(phones) + len(secrets)] == got[len(phones) + len(secrets) + 2]
    for i, t in enumerate(clean, len(texts)):
        assert got[i] == (f"See {t} now", [])


def test_colliding_surrogates_are_keyed_anew(spark):
    rows = [(i, f"a{i}@x.example.com b{i}@x.example.com {i}.1.1.1") for i in range(10)] * 20
    rows += [(1000 + i, f"{chr(97 + i % 26)}@x.example.com") for i in range(26)]
    out = pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").where("doc_id >= 1000").collect()
    assert len({r["text"] for r in out}) == 26


def test_coreference_script_gender_and_check_digits(spark):
    rows = [(1, "Jane Doe met Mr. Doe and Frau Олена Шевченко; Шевченко is known as Herr Шевченко"), (2, "Mr. 李 pays from GB82 WEST 1234 5698 7654 32 or GB82WEST12345698765432"), (3, "Frau Xandra Quast and Sir Quillon Quast")]
    rows += [(100 + i, f"Herr {a}{b}{c} wrote") for i, (a, b, c) in enumerate(itertools.product(("Ba", "Ce", "Di", "Fo", "Gu"), ("lan", "mer", "nit", "ros", "tul"), ("berg", "dorf", "feld", "haus", "mann")))]
    out = {r["doc_id"]: r["text"] for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    words = out[1].replace(";", "").split()
    assert words[1] == words[4] != "Doe" and words[0] in pii.FEMALE_NAMES
    assert words[7][-1] == "а" and words[8] == words[-1] and words[8] != "Шевченко" and "а" <= words[8].lower()[0] <= "я"
    assert "李" not in out[2] and "\u4e00" <= out[2].split()[1][0] <= "\u9fff"
    iban = out[2].split("from ")[1].replace(" or ", "|").replace(" ", "").split("|")
    assert iban[0] == iban[1] != "GB82WEST12345698765432"
    assert int("".join(str(int(ch, 36)) for ch in iban[0][4:] + iban[0][:4])) % 97 == 1
    female, male = out[3].split()[1], out[3].split()[5]
    assert female.endswith("a") and male.endswith("o")
    names = [out[i].split()[1] for i, _ in rows[3:]]
    assert len(set(names)) == len(names) and not set(names) & {t.split()[1] for _, t in rows[3:]}


def test_a_dense_format_keeps_distinct_surrogates(spark, monkeypatch):
    monkeypatch.setattr(pii, "LATE", 2)
    rows = [(i, f"call 555-{i:04d} now") for i in range(0, 10_000)] + [(20_000 + i, f"call 556-{i:04d} now") for i in range(0, 10_000, 100)]
    found = pii.entities(spark.createDataFrame(rows, "doc_id long, text string"))
    small = found.withColumn("normal", F.substring("normal", 4, 4)).where("doc_id < 10000").select("doc_id", "kind", "normal", F.substring("found", 5, 4).alias("found"))
    odd = pii.exceptions(small, "k")  # all ten thousand numbers of four digits: no free place
    made = small.join(odd, ["kind", "normal"], "left") if odd is not None else small.withColumn("attempt", F.lit(None).cast("int"))
    new = made.withColumn("new", pii.surrogate(F.col("kind"), F.col("found"), F.col("normal"), F.lit("k"), F.coalesce("attempt", F.lit(0))))
    assert new.select("new").distinct().count() == 10_000


def test_surrogates_odd_cases(spark, odd):
    extra = odd.withColumns({"_found": F.lit("own"), "_odd": F.lit(1), "_pii": F.lit("kept"), "d": F.lit(7)})
    out = pii.replace(extra, "k", None)
    assert out.columns == extra.columns
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, (tuple(r) for r in extra.collect())))
    with pytest.raises(ValueError, match="_pii"):
        pii.replace(extra, "k")
    assert pii.replace(odd.limit(0), "k").count() == 0
    long = spark.createDataFrame([(1, "word " * 200_000 + "a@b.example.com"), (1, "a@b.example.com"), (None, "a@b.example.com")], "doc_id long, text string")
    assert len({r["text"].split()[-1] for r in pii.replace(long, "k").collect()}) == 1


# 6 near duplicates


def brute_components(texts, size, share):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = list(sets)
    for a, b in itertools.combinations(ids, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= share * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("size", "share"), [(3, 90), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, size, share):
    monkeypatch.setattr(ngram_jaccard, "FREQUENT_FROM", 4)
    monkeypatch.setattr(ngram_jaccard, "BUCKET", 4)
    rnd = random.Random(size)
    words = [f"w{i}" for i in range(60)]
    lines = [" ".join(rnd.choice(words) for _ in range(12)) for _ in range(8)]
    texts = []
    for i in range(60):
        base = " ".join(rnd.choice(lines) for _ in range(rnd.randint(2, 6))).split()
        for _ in range(rnd.randint(0, 2)):
            base[rnd.randrange(len(base))] = f"new{rnd.randint(0, 500)}"
        texts.append(" ".join(base))
    family = " ".join(rnd.choice(words) for _ in range(90)).split()
    for _ in range(50):
        one = list(family)
        for _ in range(rnd.randint(0, 3)):
            one[rnd.randrange(len(one))] = f"x{rnd.randint(0, 9999)}"
        texts.append(" ".join(one))
    texts += [texts[0]] * 6 + ["Short one", "short ONE", "", "a b c d e f g h i j", "a b c d e f g h i j k"]
    rows = list(enumerate(texts)) + [(len(texts), None)]
    want = brute_components(rows, size, share)
    found = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size, share).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def executions(spark):
    return [e.executionId() for e in listed(spark._jsparkSession.sharedState().statusStore().executionsList())]


def rows_of_joins(spark, since):
    """The most rows that a join made in the queries after the first `since` ones."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store, most = spark._jsparkSession.sharedState().statusStore(), 0
    for k in executions(spark):
        if k > since:
            values = store.executionMetrics(k)
            for node in listed(store.planGraph(k).allNodes()):
                for metric in listed(node.metrics()) if "Join" in node.name() else ():
                    if metric.name() == "number of output rows" and (held := values.get(metric.accumulatorId())).isDefined():
                        most = max(most, int(held.get().replace(",", "")))
    return most


@pytest.mark.parametrize(("size", "share"), [(5, 80), (3, 90)])
def test_groups_beside_others_are_compared_once(spark, size, share):
    """A large group of near copies, and copies just too far from it that share many of its frequent shingles."""
    rnd = random.Random(size)
    base, texts = [f"w{i}" for i in range(150)], []
    for _ in range(500):
        one = list(base)
        for at in rnd.sample(range(5, 145, 9), rnd.choice((1, 1, 2, 2, 3, 6, 7, 8))):
            one[at] = f"{rnd.choice('ab')}{at}"
        texts.append(" ".join(one))
    rows = list(enumerate(texts))
    since = max(executions(spark), default=-1)
    found = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, share).collect()
    want = brute_components(rows, size, share)
    assert len({c for _, c in want.values()}) > 20
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert rows_of_joins(spark, since) < len(rows) ** 2


def test_frequent_names_are_those_of_a_plain_count(spark, monkeypatch):
    """Dealt once, and dealt on to parts within parts; from packed arrays as from a Counter."""
    rnd = random.Random(2)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.7)) % 300}" for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    want = Counter()
    for s in ngram_jaccard.Shingler(1)([t.encode() for t in texts]):
        want.update((s >> np.uint64(32)).tolist())
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    monkeypatch.setattr(ngram_jaccard, "COUNT_TOKENS", 50)
    for wide in (512, 4):
        monkeypatch.setattr(ngram_jaccard, "WIDE", wide)
        got = ngram_jaccard.frequent_names(docs, 1, sum(want.values()))
        assert sorted(got.tolist()) == sorted(n for n, c in want.items() if c > ngram_jaccard.FREQUENT_FROM)


def test_arrow_batches_are_bounded(spark):
    from quillstrata.llm import _batches

    before = spark.conf.get(_batches.BATCH_SETTING)
    try:
        for held, want in (("64m", "4194304b"), ("1m", "1m"), ("2MB", "2MB"), ("67108864b", "4194304b"), ("1g", "4194304b")):
            spark.conf.set(_batches.BATCH_SETTING, held)
            _batches.bounded_batches(spark)
            now = spark.conf.get(_batches.BATCH_SETTING)
            assert now.lower() == want.lower() or now == want.removesuffix("b")
    finally:
        spark.conf.set(_batches.BATCH_SETTING, before)


def test_short_texts_of_frequent_shingles(spark, monkeypatch):
    """Groups of copies make all shingles frequent; sets of 5 to 20 tokens then differ by one or two of them."""
    monkeypatch.setattr(ngram_jaccard, "FREQUENT_FROM", 2)
    rnd, rows = random.Random(8), []
    for k in range(40):
        words = [f"k{k}w{i}" for i in range(rnd.randint(9, 26))]
        cut = rnd.randrange(3)
        other = words[cut:] if rnd.random() < 0.5 else [*words[:-1], "else"] if rnd.random() < 0.5 else [*words, "more"]
        rows += [" ".join(words)] * 4 + [" ".join(other)] * 4
    rows = list(enumerate(rows))
    found = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(rows, 5, 80)


def test_small_sets_share_a_key_whatever_they_miss():
    rnd = random.Random(9)
    for share in (80, 90):
        for union in range(2, 40):
            for missing in range(0, union * (100 - share) // 100 + 1):
                for _ in range(8):
                    tokens = np.sort(np.array(rnd.sample(range(1, 10**6), union), np.uint64))
                    out = rnd.sample(range(union), missing)
                    split = rnd.randint(0, missing)
                    x, y = (np.delete(tokens, o) for o in (out[:split], out[split:]))
                    if min(len(x), len(y)):
                        rare = {int(t): rnd.random() < 0.15 for t in tokens}
                        a, b = (set(ngram_jaccard.keys_of(s, np.array([not rare[int(t)] for t in s]), share)[0].tolist()) for s in (x, y))
                        assert a & b, (share, union, missing, split)


def test_one_row_of_each_component_stays(spark):
    text, other = "one two three four five six seven", "quite other words that are in one row alone"
    rows = [(3, text, "a"), (5, text, "b"), (5, other, "c"), (None, text, "d"), (None, other + " here again", "e"), (7, "", "f"), (8, None, "g"), (7, "", "f"), (9, text, "h"), (3, text, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string")
    got = ngram_jaccard.keep_one(docs)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(3, text), (5, other), (None, other + " here again"), (7, ""), (7, ""), (8, None)], key=str)
    assert ngram_jaccard.keep_one(docs.limit(0)).count() == 0


def test_near_duplicates_odd_cases(spark, odd):
    rows = ngram_jaccard.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r["component_id"] == 1 for r in rows if r["doc_id"] == 4)
    assert all(r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] for r in rows if r["doc_id"] in (2, 3))
    assert ngram_jaccard.near_duplicates(odd.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 101)], "a long, b long")
    got = {r["v"]: r["c"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}


# 8 packing


def test_packing_is_exact_and_tight(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    p = queries.op8_packing_differencing(spark, DATA).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for doc_id, pieces in p.groupby("doc_id"):
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in pieces.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    q = p.sort_values(["sequence_id", "offset"])
    assert ((q.groupby("sequence_id")["length"].cumsum() - q["length"]) == q["offset"]).all()
    sums = p.groupby("sequence_id")["length"].sum()
    assert sums.max() <= 4096
    assert 1 - sums.sum() / (4096 * len(sums)) < 0.02


def test_partition_keeps_every_piece():
    rnd = random.Random(1)
    for windows in (1, 2, 7):
        sizes = [rnd.randint(1, 900) for _ in range(40)]
        sums, window = packing.partition(sizes, windows)
        assert np.bincount(window, weights=sizes, minlength=windows).tolist() == sums.tolist()
    assert len(packing.windows_of([])) == 0
    assert len(set(packing.windows_of([4096, 4096, 1]).tolist())) == 3


def test_tokenizer_equals_library_on_odd_texts():
    rnd = random.Random(2)
    letters = "ab'sreté é  \n\t\x0b\x0c\x1c\x85\xa0 ́ЀİßΣς日1२!?<|>_endoftx.,$*AB\U0001f600"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + ["A <|endoftext|>. <|ENDOFTEXT|>"]
    own = packing.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    got = own([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in own.library.encode_batch(texts, add_special_tokens=False)]


def test_packing_odd_cases(spark, odd):
    rows = packing.pack(odd, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sum(r["start"] == 0 for r in rows) == len(ODD)
    assert packing.pack(odd.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_rows_without_id_are_dealt_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_WINDOWS", 1)
    rows = [(None, f"word{i} " * 40) for i in range(800)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json")).toPandas()
    groups = out["sequence_id"].to_numpy() >> 32
    assert len(np.unique(groups)) > 8 and np.bincount(groups).max() < 0.3 * len(out)
    assert out.groupby("sequence_id")["length"].sum().max() <= 4096 and (out["start"] == 0).sum() == len(rows)


# 9 pages


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", []),
        ("<p>a &amp; b<p>c <b>d</b>e<br>f</p><div class='ad'>x</div><ul><li>1<li>2</ul>", ["a & b", "c de f", "1", "2"]),
        ("<nav>n</nav><article><header><h1>H</h1></header><p>x&nbsp; y</p><div class='comments'><p>bad</p></div></article><footer>f</footer>", ["H", "x y"]),
        ("<article><p><b>A<br></article><footer>f", ["A"]),
        ("<script>var t='</p>';</script><p title='a>b'>q</p><!-- c", ["q"]),
        ("plain < text > here", ["plain < text > here"]),
        ("<form>f</form><div style='display: none'>h</div><aside>s</aside><p>k</p>", ["k"]),
    ],
)
def test_page_blocks(html, want):
    assert site_style.Page(html).texts(set()) == want


def test_style_tree_removes_what_all_pages_say(spark):
    rows = [(i, "http://h.example/x", f"<body><div class='top'>Same words on all</div><div class='body'><p>Own words number {i} {i * 7}</p></div></body>", "clash") for i in range(8)]
    rows += [(100, "no host", None, "clash"), (101, None, "", "clash"), (102, "http://other.example", "<p>alone</p>", "clash")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got[3] == ("Own words number 3 21", 21)
    assert got[100] == got[101] == ("", 0) and got[102] == ("alone", 5)


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, "http://h.example/x", "<nav>m</nav><article><p>The same article</p></article>") for i in range(9)]
    assert {r["text"] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"The same article"}


def test_copies_of_a_page_without_article_are_no_template(spark):
    copy, own = "<body><div class='top'>Menu of all</div><div class='text'><p>{}</p></div></body>", [f"Own words {i} {i * 7}" for i in range(10)]
    rows = [(i, "http://h.example/x", copy.format("The copied words")) for i in range(90)] + [(100 + i, "http://h.example/x", copy.format(t)) for i, t in enumerate(own)]
    rows += [(200 + i, "http://same.example/x", "<body><div class='text'><p>One page alone</p></div></body>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[100 + i] for i in range(10)] == own
    assert got[0] == "The copied words" and got[200] == "One page alone"


def test_style_tree_decides_inside_and_beside_articles(spark):
    page = "<body><div class='top'>Menu of all</div><article><p>Own article {0}</p><div class='by'>Written by the house</div></article><div class='tail'>More of {0}</div></body>"
    rows = [(i, "http://h.example/x", page.format(i)) for i in range(8)] + [(100, "http://few.example/x", page.format(100))]
    got = {r["page_id"]: r["text"] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Own article 3\nMore of 3"
    assert got[100] == "Own article 100\nWritten by the house"


def test_an_article_on_many_pages_is_no_template(spark):
    rows = [(i, "http://h.example/x", f"<body><div class='day'>Day {i}</div><article><p>The same article</p></article></body>") for i in range(9)]
    texts = {r["text"] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("The same article" in t for t in texts)


class PlainTree:
    """A page by the standard library's parser, for well-formed pages: what each path says and which children it has, as texts and lists."""

    def __init__(self, html):
        from html.parser import HTMLParser

        tree = self
        self.nodes = defaultdict(lambda: [[], []])  # path -> texts, children

        class Walk(HTMLParser):
            def __init__(self):
                super().__init__()
                self.open = []

            def handle_starttag(self, tag, attrs):
                name = dict(attrs).get("class", "")
                path = (*(self.open[-1] if self.open else ()), f"{tag}.{name}")
                if self.open:
                    tree.nodes[self.open[-1]][1].append(path)
                self.open.append(path)

            def handle_endtag(self, tag):
                self.open.pop()

            def handle_data(self, data):
                if data.strip():
                    for path in self.open:
                        tree.nodes[path][0].append((self.open[-1], data))

        Walk().feed(html)


def test_style_tree_equals_plain_counts(spark):
    import math

    rnd, pages = random.Random(3), []
    for i in range(40):
        items = "".join(f"<li>{rnd.choice(['Home', 'News', 'Shop'])}</li>" for _ in range(rnd.randint(1, 3)))
        body = "".join(f"<p>{rnd.randint(0, 9)}</p>" if rnd.random() < 0.7 else f"<ul><li>{i}</li></ul>" for _ in range(rnd.randint(1, 3)))
        pages.append((f"h{i % 2}", f"<html><body><div class='top'><ul>{items}</ul></div><div class='text'>{body}</div><div class='end'>Same</div></body></html>"))
    pages += pages[:9]  # copies count once
    got = Counter()
    for r in site_style.style_tree(spark.createDataFrame(pages, "host string, html string")).collect():
        got[r["host"], r["pages"], round(r["presentation"], 9), round(r["content"], 9), round(r["importance"], 9)] += 1
    want = Counter()
    for host in ("h0", "h1"):
        nodes = defaultdict(list)
        for html in {h for k, h in pages if k == host}:
            for path, (texts, kids) in PlainTree(html).nodes.items():
                if texts:
                    nodes[path].append((tuple(sorted(texts)), tuple(kids)))
        for seen in nodes.values():
            n = len(seen)

            def entropy(k, seen=seen, n=n):
                return sum(-c / n * math.log(c / n, n) for c in Counter(x[k] for x in seen).values()) if n > 1 else 1.0

            damp = site_style.DAMPING ** len({x[1] for x in seen})
            want[host, n, round(entropy(1), 9) + 0.0, round(entropy(0), 9) + 0.0, round((1 - damp) * entropy(1) + damp * entropy(0), 9) + 0.0] += 1
    assert got == want


@pytest.mark.parametrize("html", ["<a" * 20_000, "<a" * 20_000 + ">", '<a "' * 20_000, "<!" * 20_000, "<div>" * 20_000 + "x", "<b>" * 20_000 + "<p>x", "</x>" * 20_000, "<script" * 20_000, "<ul>" * 5000 + "<li>a" * 5000])
def test_broken_pages_end_soon(html):
    import time

    began = time.time()
    site_style.Page(html).said()
    assert time.time() - began < 5


def test_pages_odd_cases(spark):
    schema = "page_id long, url string, html string, host string, text string"
    assert site_style.extract(spark.createDataFrame([], schema)).count() == 0
    long = "<p>" + "word " * 300_000 + "</p>"
    rows = [(1, "http://a/x", "<p>one</p>", "clash", "t"), (1, "http://a/x", "<p>one</p>", "clash", "t"), (None, None, long, None, None), (3, "nonsense", None, None, None), (4, "http://a/y", "<![CDATA[ <b>no ]]><p>\ud83d? \u00a0 x</p>".encode("utf-8", "replace").decode(), None, None)]
    got = sorted(((r["page_id"] or 0, r["n_chars"]) for r in site_style.extract(spark.createDataFrame(rows, schema)).collect()))
    assert got == [(0, 5 * 300_000 - 1), (1, 3), (1, 3), (3, 0), (4, 4)]


# 10 sentencepiece


def test_sentencepiece_equals_library():
    import sentencepiece

    from quillstrata.llm import sentencepiece_bpe

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.Encoder(sentencepiece_bpe.Model(path))
    rnd = random.Random(1)
    texts = ["", " ", "  a", "▁a ▁", "日本語", "\x00a​b", "a" * 300, "<s>hi</s>", "�", " \n a", "\n\n"] + [" " * n for n in range(1, 80)] + ["x" + " " * n + "y" for n in range(1, 60)]
    for letters in ("ab  \n\t▁cdethrn.,!日本é\U0001f600", "aehtin ", "aehtin"):
        texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 90))) for _ in range(600)]
    for text, (ids, decoded) in zip(texts, own([t.encode() for t in texts]), strict=True):
        want = library.encode(text)
        assert ids.decode() == ",".join(map(str, want))
        assert decoded.decode() == library.decode(want)
        assert own.model.decode(np.array(want, int)).decode() == library.decode(want)


def test_sentencepiece_odd_cases(spark, odd):
    from quillstrata.llm import sentencepiece_bpe

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = sentencepiece_bpe.encode(odd, path).collect()
    assert len(rows) == len(ODD) and all(r["n_tokens"] == 0 for r in rows if r["doc_id"] in (2, 3))
    back = sentencepiece_bpe.decode_ids(sentencepiece_bpe.encode_ids(odd, path), path).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t in ODD)


def test_merge_rounds_equal_one_merge_at_a_time():
    rnd = random.Random(4)
    pairs, size = {}, 40
    while len(pairs) < 60:
        pairs.setdefault((rnd.randrange(size), rnd.randrange(size)), (rnd.randrange(30), rnd.randrange(size)))
    table = bpe.MergeTable(size, [(a, b, r, c) for (a, b), (r, c) in pairs.items()])
    words = [[rnd.randrange(6) for _ in range(rnd.randint(1, 12))] for _ in range(200)]

    def slow(w):
        w = list(w)
        for _ in range(100):
            found = [(pairs[a, b][0], i) for i, (a, b) in enumerate(itertools.pairwise(w)) if (a, b) in pairs]
            if not found:
                return w
            i = min(found)[1]
            w[i : i + 2] = [pairs[w[i], w[i + 1]][1]]
        return w

    for long in (2048, 3):
        bpe.LONG = long
        try:
            symbols, word = table.merge(np.array([s for w in words for s in w], np.int32), np.repeat(np.arange(len(words)), [len(w) for w in words]))
        finally:
            bpe.LONG = 2048
        assert [symbols[word == k].tolist() for k in range(len(words))] == [slow(w) for w in words]


def test_long_words_equal_the_library_and_end_soon():
    import time

    import sentencepiece

    from quillstrata.llm import sentencepiece_bpe

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.Encoder(sentencepiece_bpe.Model(path))
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(letters) for _ in range(n)) for letters, n in (("etaoinshrdlu", 60_000), ("日本語aé", 20_000), ("a", 50_000), ("ab", 9_000), ("ing", 9_000))]
    began = time.time()
    got = own([t.encode() for t in texts])
    assert time.time() - began < 60
    for t, (ids, decoded) in zip(texts, got, strict=True):
        want = library.encode(t)
        assert ids.decode() == ",".join(map(str, want)) and decoded.decode() == library.decode(want)


def test_models_of_other_kinds_are_refused(tmp_path):
    import sentencepiece

    from quillstrata.llm import sentencepiece_bpe

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        whole = f.read()
    # a protocol buffer's later fields override: the normaliser's flag for extra blanks, and a piece of a user
    for more in (bytes([0x1A, 2, 0x20, 1]), bytes([0x0A, 5, 0x0A, 1, 0x7E, 0x18, 4])):
        (tmp_path / "m.model").write_bytes(whole + more)
        with pytest.raises(ValueError, match="BPE"):
            sentencepiece_bpe.Model(str(tmp_path / "m.model"))
    assert sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).get_piece_size() == 32000
