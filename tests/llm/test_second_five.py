"""Operators 3, 5, 7, 9 and 10 against brute force, exact round trips and held-out accuracy."""

import functools
import random
import re
import zlib
from collections import Counter
from math import log, log10

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import class_lm, language_id, piece_codec, toxicity, url_filter
from leafmill.llm.shared import LOWER_TABLE

SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m == 2


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("the of andin g \n\t  éñß▁\ue000"), st.characters(exclude_categories=["Cs"])), max_size=60), st.integers(0, 99))
def test_codec_round_trip(text, seed):
    for rate in (0.0, 0.3):
        own = piece_codec.PieceCodec.__new__(piece_codec.PieceCodec)
        own.__dict__ = piece_codec.codec(piece_codec.VOCABULARY, rate, 0).__dict__ | {"seed": seed, "_cache": {}}
        ids = own.encode(text)
        assert own.decode(ids) == text
        if rate == 0 and "▁" not in text and "\ue000" not in text:
            assert np.frombuffer(ids, "<u4").tolist() == SP.encode(text)


def test_codec(docs, rows, none):
    got = by_id(piece_codec.encode(docs))
    other = by_id(piece_codec.encode(docs, seed=5))
    back = by_id(piece_codec.decode(piece_codec.encode(docs)))
    for i, t in rows:
        assert got[i]["lossless"] and back[i]["text"] == (t or "") and 4 * got[i]["n_pieces"] == len(got[i]["ids"])
        assert got[i]["ids_crc32"] == zlib.crc32(got[i]["ids"])
    assert sum(got[i]["ids"] != other[i]["ids"] for i, _ in rows) > 20
    assert piece_codec.encode(none).count() == 0


def test_dropout_differs_between_occurrences_and_copies(spark):
    word = " internationalisation"
    df = spark.createDataFrame([(i, word[1:] + word * 39) for i in range(4)], "doc_id long, text string")
    got = by_id(piece_codec.encode(df, dropout=0.3))
    assert len({r["ids"] for r in got.values()}) == 4 and all(r["lossless"] for r in got.values())
    own = piece_codec.codec(piece_codec.VOCABULARY, 0.3, 1)
    pieces, seen, at = np.frombuffer(got[0]["ids"], "<u4").tolist(), set(), []
    for p in pieces:
        if own.raw[p].startswith(b" ") and at:
            seen.add(tuple(at))
            at = []
        at.append(p)
    assert len(seen) > 10


def test_merging_together_equals_one_agenda(rows):
    own = piece_codec.codec(piece_codec.VOCABULARY, 0.2, 3)
    texts = [t[:3000] for _, t in rows if t] + ["\ue000▁ a  b\n\n  ▁▁ 日本"]
    names = [str(k) for k in range(len(texts))]
    together = own.encode_all(texts, names)
    before, piece_codec.TOGETHER = piece_codec.TOGETHER, 1
    try:
        assert own.encode_all(texts, names) == together
    finally:
        piece_codec.TOGETHER = before
    assert [own.encode(t, k) for t, k in zip(texts, names)] == together


def brute_agenda(own, text, document):
    """Pieces by plain search: of all neighbours that merge and aren't skipped, the best by score, then the leftmost."""
    key = xxhash.xxh64_intdigest(f"{document}\0{text}".encode(), own.seed)
    vocabulary = {SP.id_to_piece(i): (-SP.get_score(i), i) for i in range(SP.get_piece_size()) if not (SP.is_byte(i) or SP.is_control(i) or SP.is_unknown(i))}
    parts = [[c, k] for k, c in enumerate((" " + text).replace(" ", "▁"))]
    while True:
        offers = []
        for k in range(len(parts) - 1):
            found = vocabulary.get(parts[k][0] + parts[k + 1][0])
            if found and own._draw(key, parts[k][1], found[1]) >= own.limit:
                offers.append((found[0], k))
        if not offers:
            return [p for p, _ in parts]
        k = min(offers)[1]
        parts[k : k + 2] = [[parts[k][0] + parts[k + 1][0], parts[k][1]]]


@pytest.mark.parametrize("rate", [0.0, 0.2, 0.6])
def test_dropout_is_the_plain_agenda(rate):
    own = piece_codec.codec(piece_codec.VOCABULARY, rate, 11)
    for k, text in enumerate(["the quick brown internationalisation of nations", "a  b", "reading and rereading the reader " * 3, "naïve café"]):
        got = [SP.id_to_piece(int(i)) for i in np.frombuffer(own.encode(text, str(k)), "<u4")]
        assert got == brute_agenda(own, text, str(k))


def brute_forward(word, table, vocabulary, k):
    alpha = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            piece = vocabulary.ids.get(word[i:j], vocabulary.unknown if i == j - 1 else None)
            if piece is not None:
                alpha[j] += alpha[i] * table[piece, k]
    return np.log(alpha[-1])


def test_forward_sums_all_segmentations():
    vocabulary = language_id.pieces(language_id.VOCABULARY)
    rng = np.random.default_rng(0)
    table = np.concatenate((rng.random((vocabulary.size, 2)) / 500, [[1e-7] * 2, [0] * 2]))
    words = ["▁" + w for w in "a the nation 日本語 naïve internationalisation ñandú".split()] + ["▁xyz" + str(k) for k in range(1000, 1040)] + ["▁" + "the" * 30]
    got = language_id.log_probabilities(words, vocabulary, table)
    for w, row in zip(words, got):
        assert np.allclose(row, [brute_forward(w, table, vocabulary, k) for k in (0, 1)])
    for piece, i in list(vocabulary.ids.items())[::37]:
        assert vocabulary.find(np.array([vocabulary.hash(piece)], np.uint64))[0] == i


def test_long_words_teach_alike(monkeypatch):
    vocabulary = language_id.pieces(language_id.VOCABULARY)
    rng = np.random.default_rng(1)
    table = np.concatenate((rng.random((vocabulary.size, 2)) / 500, [[1e-7] * 2, [0] * 2]))
    words = ["▁" + w for w in ["nation", "internationalisation", "日本語", "the" * 12]]
    weight = rng.random((4, 2)) * 5
    together = language_id.expected(words, weight, vocabulary, table)
    monkeypatch.setattr(language_id, "TOGETHER", 0)
    alone = language_id.expected(words, weight, vocabulary, table)
    assert np.allclose(together, alone) and together.sum() > 10
    long = language_id.expected(["▁" + "nation" * 500], np.ones((1, 2)), vocabulary, table)
    assert np.isfinite(long).all() and long.sum() > 500


def test_language_scores_are_brute_force(spark):
    words = "the house la maison das Haus internationalisation 日本語".split()
    rng = random.Random(3)
    made = [(i, " ".join(rng.choices(words, k=6)), "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    got = by_id(language_id.predict(df, model))
    vocabulary = language_id.pieces(model.vocabulary)
    for i, t, _ in made:
        total = np.array([sum(brute_forward("▁" + w, model.table, vocabulary, k) for w in t.split()) for k in range(3)])
        share = np.exp(total - total.max())
        assert got[i]["lang_pred"] == model.languages[int(total.argmax())] and np.isclose(got[i]["score"], share.max() / share.sum())


def test_language(spark, docs, rows, none):
    text = {"en": "the house is on the hill and it was there with them", "fr": "la maison est sur la colline et elle était là avec eux", "de": "das Haus steht auf dem Hügel und es war dort mit ihnen"}
    rng = random.Random(1)
    made = [(i, " ".join(rng.sample(text[k].split(), 8)), k) for i, k in enumerate(sorted(text) * 60)]
    made += [(500, None, "en"), (501, "", "fr"), (502, "12 34 !!", "de"), (503, "the and", None), (504, "x" * 70_000, None)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    got = by_id(language_id.predict(df, model))
    for i, t, k in made[:180]:
        assert got[i]["held_out"] == fold(i, 4) and got[i]["lang_pred"] == k and 0 <= got[i]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (500, 501, 502, 503)] == ["und"] * 3 + ["en"] and got[504]["lang_pred"] in text
    swapped = df.replace("en", "zz", ["lang"]).where(df.doc_id.isin([i for i in range(180) if fold(i, 4)]))
    again = language_id.fit(df.where(~df.doc_id.isin([i for i in range(180) if fold(i, 4)])).unionByName(swapped))
    assert np.allclose(again.table, model.table)  # held-out labels change nothing
    assert language_id.predict(none, language_id.fit(none)).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.fit(none)).collect()} == {"und"}


def test_chain_is_full_forward_backward():
    rng = np.random.default_rng(2)
    moves, bias = rng.normal(size=(2, 2)), -1.3
    at, emission, length = [0, 4, 5, 17], [1.0, 3.0, -0.5, 2.0], 40
    e = np.ones((length, 2))
    e[:, 1] = np.exp(bias)
    for a, x in zip(at, emission):
        e[a, 1] = np.exp(bias + x)
    step = np.exp(moves)
    forward, back = [e[0]], [np.ones(2)]
    for j in range(1, length):
        forward.append(forward[-1] @ step * e[j])
        back.append(step @ (e[length - j] * back[-1]))
    back = back[::-1]
    want = [forward[a][1] * back[a][1] / (forward[a] @ back[a]) for a in at]
    assert np.allclose(toxicity.Chain(bias, moves).marginals(at, emission, length), want)
    for shift in (1, 2):
        e2 = np.concatenate((np.tile([1.0, np.exp(bias)], (shift, 1)), e))
        f = [e2[0]]
        for j in range(1, len(e2)):
            f.append(f[-1] @ step * e2[j])
        want = [f[a + shift][1] * back[a][1] / (f[a + shift] @ back[a]) for a in at]
        assert np.allclose(toxicity.Chain(bias, moves).marginals([a + shift for a in at], emission, length + shift), want)


def test_training_expectations():
    rng = np.random.default_rng(4)
    emission, moves = rng.normal(size=(3, 4)), rng.normal(size=(2, 2))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 1, 1, 0]], bool)
    p1, pair = toxicity._expect(emission, moves, mask)
    total = np.zeros((2, 2))
    for r in range(3):
        n = int(mask[r].sum())
        z, own, both = 0, np.zeros(n), np.zeros((2, 2))
        for s in np.ndindex(*[2] * n):
            w = np.exp(sum(emission[r, j] * s[j] for j in range(n)) + sum(moves[s[j], s[j + 1]] for j in range(n - 1)))
            z += w
            own += w * np.array(s)
            for j in range(n - 1):
                both[s[j], s[j + 1]] += w
        assert np.allclose(p1[r, :n], own / z)
        total += both / z
    assert np.allclose(pair, total)


def test_toxicity(spark, docs, none):
    rng = random.Random(5)
    fine = "the garden house and river under some tall trees with birds".split()
    made, labels = [], []
    for i in range(400):
        words = [rng.choice(fine) for _ in range(40)]
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["blockhead", "scoundrel,", "dimwit"])
        made.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    made += [(900, None), (901, ""), (902, " ")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int"))
    got = by_id(toxicity.score(df, model))
    held = [i for i in range(400) if fold(i, 4)]
    assert all(got[i]["held_out"] for i in held) and np.mean([(got[i]["score"] >= 0.3) == (i % 3 == 0) for i in held]) > 0.97
    text = dict(made)
    for i in held:
        for s in got[i]["spans"]:
            assert text[i][s["start"] : s["end"]].rstrip(",") in ("blockhead", "scoundrel", "dimwit")
    assert got[900]["score"] == got[901]["score"] == got[902]["score"] < 0.3
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, empty).select("score").distinct().count() == 1


def test_short_words_are_learned_and_scores_are_brute_force(spark):
    rng = random.Random(9)
    fine = "garden house river trees birds a of to".split()
    made = []
    for i in range(300):
        ws = [rng.choice(fine) for _ in range(25)]
        if i % 3 == 0:
            ws[rng.randrange(25)] = ws[rng.randrange(25)] = "git!"
        made.append((i, " ".join(ws)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in made], "doc_id long, toxic int"))
    got = by_id(toxicity.score(df, model))
    assert "w:git" in model.features
    step = np.exp(model.moves)
    for i, t in made[:60]:
        seen = [[f for f in toxicity.token_features(w) if f in model.features] for w in t.split()]
        e = np.array([[1.0, np.exp(model.bias + sum(model.features[f] for f in fs))] for fs in seen])
        forward, back = [e[0]], [np.ones(2)]
        for j in range(1, len(e)):
            forward.append(forward[-1] @ step * e[j])
            back.insert(0, step @ (e[len(e) - j] * back[0]))
        p = [f[1] * b[1] / (f @ b) for f, b, fs in zip(forward, back, seen) if fs]
        z = np.dot(model.calibration, (1.0, *toxicity.summary(p)))
        assert np.isclose(got[i]["score"], 1 / (1 + np.exp(-z)))


def plain_class_scores(tokens, held):
    """The class model in plain loops over (id: tokens); units come from the exchange, moves of words from place(), both tested by themselves."""
    train = {i: ws for i, ws in tokens.items() if not held(i)}
    count = Counter(w for ws in train.values() for w in ws)
    level = lambda n: int(np.floor(np.log2(n) * 16))
    by_level, heads = Counter(level(n) for n in count.values()), []
    for k in sorted(by_level, reverse=True):
        if len(heads) + by_level[k] > class_lm.HEADS:
            break
        heads += [w for w in count if level(count[w]) == k]
    number = {w: k for k, w in enumerate(sorted(heads, key=lambda w: (-count[w], w)), 1)}
    unit = lambda w: number.get(w) or class_lm.tail_unit(w)
    units, side = class_lm.HEADS + class_lm.TAILS + 1, class_lm.CLASSES + 1
    pairs = np.zeros((units, units))
    for ws in train.values():
        for a, b in zip([0, *map(unit, ws)], map(unit, ws)):
            pairs[a, b] += 1
    first = np.zeros(units, int)
    first[1:] = 1 + class_lm.exchange(pairs[1:, 1:])
    grid = np.zeros((side, side))
    for a, b in np.argwhere(pairs):
        grid[first[a], first[b]] += pairs[a, b]
    of = {w: first[unit(w)] for ws in tokens.values() for w in ws}
    moved = dict(of)
    for w in count:
        if w not in number:
            before, after, loop = np.zeros((1, side - 1)), np.zeros((1, side - 1)), np.zeros(1)
            for ws in train.values():
                for a, b in zip(ws, ws[1:]):
                    if a == b == w:
                        loop[0] += 1
                    elif b == w:
                        before[0, of[a] - 1] += 1
                    elif a == w:
                        after[0, of[b] - 1] += 1
            moved[w] = 1 + class_lm.place(grid[1:, 1:], np.array([of[w] - 1]), before, after, loop)[0]
    grid = np.zeros((side, side))
    for ws in train.values():
        for a, b in zip([0, *(moved[w] for w in ws)], (moved[w] for w in ws)):
            grid[a, b] += 1
    types = Counter(moved[w] for w in count)
    follows = grid.sum(axis=0) + 0.1
    follows[0] = 0
    follows /= follows.sum()
    out = {}
    for i, ws in tokens.items():
        total, a = 0.0, 0
        for w in ws:
            c = moved[w]
            kinds = (grid[a] > 0).sum() + 1
            total += log10((grid[a, c] + kinds * follows[c]) / (grid[a].sum() + kinds)) + log10((count[w] + 1) / (grid[:, c].sum() + types[c] + 1))
            a = c
        out[i] = total
    return out


def test_class_scores_are_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{k}{e}" for k in range(120) for e in ("ing", "ed")]
    made = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(240)], k=50)) + (" rare%d" % i if i % 4 == 0 else "")) for i in range(60)]
    tokens = {i: [*t.split(), " "] for i, t in made}
    want = plain_class_scores(tokens, lambda i: fold(i, 7))
    got = by_id(class_lm.score(spark.createDataFrame(made, "doc_id long, text string").repartition(3)))
    for i in tokens:
        assert np.isclose(got[i]["score"], want[i])


@pytest.mark.parametrize("limit", [300, 10_000_000])
def test_class_model(spark, docs, rows, none, limit, monkeypatch):
    monkeypatch.setattr(class_lm, "BLOCK", limit)
    monkeypatch.setattr(class_lm.blocks, "__defaults__", (limit,))
    tokens = {i: [w.translate(LOWER_TABLE).decode() for w in (t or "").encode().split()] + [" "] for i, t in rows}
    count = Counter(w for i, ws in tokens.items() if not fold(i, 7) for w in ws)
    total = sum(count.values())
    got = by_id(class_lm.score(docs))
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (fold(i, 7), len(ws), total)
        assert r["n_known"] == sum(w in count for w in ws)
        assert np.isclose(r["base_score"], sum(log10((count[w] + 1) / (total + len(count) + 1)) for w in ws))
        assert r["score"] < 0
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())
    assert class_lm.score(none).count() == 0


def likelihood(pairs, of):
    member = np.eye(of.max() + 1)[of]
    x = lambda a: (a * np.log(np.maximum(a, 1e-12))).sum()
    grid = member.T @ pairs @ member
    return x(grid) - x(grid.sum(axis=0)) - x(grid.sum(axis=1))


def test_exchange_climbs_to_a_local_best():
    rng = np.random.default_rng(0)
    kind = rng.integers(0, 3, 40)
    pairs = rng.poisson(np.where((kind[:, None] + 1) % 3 == kind[None], 9.0, 0.4)).astype(float)
    of = class_lm.exchange(pairs, 3, 50)
    best = likelihood(pairs, of)
    assert best >= likelihood(pairs, kind) - 1e-6
    for u in range(40):
        for c in range(3):
            other = of.copy()
            other[u] = c
            assert likelihood(pairs, other) <= best + 1e-6


def test_place_is_the_best_move_of_each_word():
    rng = np.random.default_rng(3)
    classes, n = 4, 60
    pairs, of = rng.poisson(rng.random((n, n)) * 1.5).astype(float), rng.integers(0, 4, 60)
    member = np.eye(classes)[of]
    loop = np.diag(pairs).copy()
    apart = pairs - np.diag(loop)
    got = class_lm.place(member.T @ pairs @ member, of, apart.T @ member, apart @ member, loop)
    assert (got != of).sum() > 10
    for u in range(n):
        value = [likelihood(pairs, np.where(np.arange(n) == u, c, of)) for c in range(classes)]
        assert np.isclose(value[got[u]], max(value))


def test_words_beyond_the_heads_are_clustered(spark):
    """Rare words of two kinds with one ending: only their contexts tell them apart."""
    rng = random.Random(8)
    fronts = [[f"{a}front{k}" for k in range(4)] for a in "xy"]
    often = [[f"{a}often{k}" for k in range(4)] for a in "xy"]
    rare = [[f"{a}{k}ish" for k in range(30)] for a in "xy"]
    filler = [f"filler{k}" for k in range(class_lm.HEADS - 17)]  # with these, the heads are full
    text = [" ".join(rng.sample(filler, len(filler))) for _ in range(20)]
    for _ in range(10):
        for f, o, r in zip(fronts, often, rare):
            text.append(" ".join(f"{rng.choice(f)} {w} {rng.choice(f)}" for w in rng.sample(r + o * 60, len(r) + 240)))
    ids = [i for i in range(1000) if not fold(i, 7)]
    held = [i for i in range(1000) if fold(i, 7)][:2]
    own = " ".join(f"{fronts[0][0]} {w} {fronts[0][1]}" for w in rare[0])
    crossed = " ".join(f"{fronts[0][0]} {w} {fronts[0][1]}" for w in rare[1])
    df = spark.createDataFrame([*zip(ids, text), (held[0], own), (held[1], crossed)], "doc_id long, text string")
    got = by_id(class_lm.score(df))
    assert np.isclose(got[held[0]]["base_score"], got[held[1]]["base_score"])
    assert got[held[0]]["score"] > got[held[1]]["score"] + 10


def splits(s):
    return [[s]] + [[s[:k], *rest] for k in range(1, len(s)) for rest in splits(s[k:])]


def brute_words(html):
    text = re.sub(r"(?is)<(script|style)\b.*?</\1", "<", html or "")
    return [w for w in re.split("[^a-z]+", re.sub(r"<[^<>]*>?", " ", text).lower()) if len(w) >= 2]


def brute_model(pages, verdict_of):
    """Score of a URL by the same model: all splits of a run are tried, all counts are plain loops."""
    count = Counter(w for _, html in pages for w in brute_words(html))
    total = sum(count.values())
    mean = max(1, total // max(1, len(count)))

    def cost(w):
        n = max(mean, count[w]) if w in url_filter.SEEDS else count[w]
        return log(n / (total + 1)) if n else log(1 / (total + 1)) - url_filter.LETTER * len(w)

    @functools.cache
    def split(run):
        return max(splits(run), key=lambda s: (round(sum(map(cost, s)), 9), len(s[-1]) * -1))

    def tokens(url):
        host, path = parts(url)
        out = []
        for kind, text in (("h", host), ("p", path.lower())):
            for run in re.findall(r"[a-z]+|[0-9]+|[^\x00-\x7f]+", text):
                words = split(run) if "a" <= run[0] <= "z" else ["#"]
                out += [(kind, w) for w in words] + [(kind, "*")] * (kind == "h" and bool(url_filter.SEEDS & set(words)))
        return out

    seen = [(verdict_of(u), tokens(u)) for u, _ in pages if verdict_of(u)]
    by = {v: Counter(t for x, ts in seen if x == v for t in ts) for v in ("block", "allow")}
    n = {v: sum(x == v for x, _ in seen) for v in by}
    kinds = len({t for c in by.values() for t in c})
    weight = {t: log((by["block"][t] + 1) / (sum(by["block"].values()) + kinds)) - log((by["allow"][t] + 1) / (sum(by["allow"].values()) + kinds)) for c in by.values() for t in c}
    return lambda url: log((n["block"] + 1) / (n["allow"] + 1)) + sum(weight.get(t, 0) for t in tokens(url))


def parts(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_verdict(url):
    host, path = parts(url)
    fits = [(len(h + p), v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1] if fits else None


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(12)
    names = ["plainhouse", "cheapcasino", "garden", "housegarden", "m", "www", "xq"]
    urls = [
        None, "", "no scheme", "http://com/en/1", "https://A.Example.COM/en/7?x=1", "http://sub.net/de/1", "http://x.example.net/de/88#a",
        "http://example.network/de/", "ftp://b.org/es/?q", "http://cheapcasino.example.org/fr/1", "http://plainhouse.example.org/fr/2", "a://b://c/d",
        "http://ñandú.example.com/en/ñ1", "http://" + "house" * 400 + ".com/en/" + "x" * 3000, "http://plainhouse.example.org/fr/2",
    ]
    urls += [f"http://{rng.choice(names)}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.choice(['shop', 'a7', 'plain'])}" for _ in range(150)]
    html = "<p>cheap casino plain house <b>plain house garden</b></p><script>var plainhouse = '<p>'; zzz</script> example of a shop <style>p{}</style>" * 3
    return [(u, html if k % 3 else "<<<" * 50 + "unclosed <script> house") for k, u in enumerate(urls)]


def test_urls(spark, pages):
    df = spark.createDataFrame([(i, *p, "x", 1.0, "h") for i, p in enumerate(pages)] + [(None, *pages[9], "x", 1.0, "h")], "page_id long, url string, html string, rule string, score double, host string")
    got = {r["page_id"]: r for r in url_filter.judge(df, url_filter.fit(df)).collect()}
    assert len(got) == len(pages) + 1 and got[None]["score"] == got[9]["score"]
    short = [p for p in pages if len(p[0] or "") < 200]
    for i, (u, _) in enumerate(pages):
        host, path = parts(u)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["verdict"] == (rule_verdict(u) or ("block" if got[i]["score"] > 0 else "allow"))
    assert [got[i]["rule"] for i in range(3, 10)] == ["com/en/", "example.com/en/7", "net/de/", "example.net/de/8", None, "org/es/", None]
    small = df.where("url IS NULL OR length(url) < 200")
    scores = {r["page_id"]: r["score"] for r in url_filter.judge(small, url_filter.fit(small)).collect()}
    best = brute_model([*short, pages[9]], rule_verdict)
    for i, (u, _) in enumerate(pages):
        if i in scores:
            assert np.isclose(scores[i], best(u)), u
    none = df.where("false")
    assert url_filter.judge(none, url_filter.fit(none)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(df, url_filter.fit(none)).collect()} == {"allow", "block"}  # rules alone


def test_held_out_rule_verdicts_are_predicted(spark):
    rng = random.Random(4)
    urls = [f"http://{rng.choice(['shop', 'gardenhouse', 'm', 'news'])}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'es'])}/{rng.choice(['a', 'b', 'c'])}" for _ in range(600)]
    df = spark.createDataFrame([(i, u, "<p>garden house shop</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    model = url_filter.fit(df.where("page_id % 3 != 0"))
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(df.where("page_id % 3 = 0"), model, rules=()).collect()}
    right = [got[i] == rule_verdict(urls[i]) for i in got if rule_verdict(urls[i])]
    assert len(right) > 40 and np.mean(right) > 0.95


@pytest.mark.parametrize("run", ["cheapcasino", "plainhousea", "aplain", "xhouse", "q", "zzplain", "slotcasinob"])
def test_best_split_of_all(run):
    count = {"cheap": 5, "plain": 9, "house": 9, "aa": 50}
    total, mean = sum(count.values()), 18
    cost = lambda w: log(max(mean, count.get(w, 0)) / (total + 1)) if w in url_filter.SEEDS else log(count[w] / (total + 1)) if w in count else log(1 / (total + 1)) - url_filter.LETTER * len(w)
    found = [(i, run[i:j], count[run[i:j]]) for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in count]
    got = url_filter.best_split(run, found, total, mean)
    assert "".join(got) == run
    assert np.isclose(sum(map(cost, got)), max(sum(map(cost, s)) for s in splits(run)))
