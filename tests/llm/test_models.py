import math
import tracemalloc
import zlib

import numpy as np
import pytest

from quantloom.llm import language_id, toxicity
from quantloom.llm.lm_scoring import ORDER, Vocabulary, cross_entropy_difference, losses, trigrams

from . import cases
from .kneser_ney import back_off, interpolate

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language_id.train(documents.where(~language_id.held_out()))


COUNTS = {"x": {"^a": 3, "^ab": 2, "^b": 1, "aba": 2, "ab$": 1, "ba$": 4, "^ba": 1}, "y": {"^c": 5, "^ca": 2, "ca$": 2, "^c$": 3}}


def fitted(spark, counts, order, max_grams=400_000):
    rows = [("one", lang, gram, c) for lang, table in counts.items() for gram, c in table.items()]
    return language_id.fit(spark.createDataFrame(rows, "fit string, lang string, gram string, c long"), order, max_grams)["one"]


def agrees(model, counts, order, runs, kept=lambda lang: lambda gram: True):
    """The model's losses of the runs are those of the dictionaries, whose distributions add up to one."""
    symbols = sorted({g[-1] for table in counts.values() for g in table})
    uniform = 1 / (len(symbols) + 1)
    logs, events = model.log_probs(runs)
    assert events.tolist() == [len(r) + 1 for r in runs]
    for k, lang in enumerate(model.languages):
        probs, weights = interpolate(counts[lang], order, uniform, kept(lang))
        prob = lambda gram: back_off(gram, probs, weights, uniform)
        for context in {"", "^", "zz"[:order - 1], *(c for level in weights for c in level)}:
            assert math.isclose(sum(prob(context + s) for s in [*symbols, "\0"]), 1, rel_tol=1e-9), (lang, context)
        for r, run in enumerate(runs):
            framed = f"^{run}$"
            want = sum(math.log(prob(framed[max(0, i - order + 1):i + 1])) for i in range(1, len(framed)))
            assert math.isclose(logs[r, k], want, rel_tol=1e-9), (lang, run)


def test_probabilities_of_a_context_add_up(spark):
    """Over the whole alphabet and one unseen character, every language's distribution sums to one; look-ups in arrays give the same."""
    agrees(fitted(spark, COUNTS, 3), COUNTS, 3, ["ab", "ca", "zz"])


def test_grams_put_aside_leave_all_statistics_as_they_are(spark):
    """A language beyond the bound is fitted on all its grams; the rarest are put aside afterwards, and their shares go to their contexts."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), int(n), p=np.arange(8, 0, -1) / 36)) for n in rng.integers(1, 7, 400)]
    counts = {"few": {"^a": 3, "a$": 3}, "many": {}}
    for w in words:
        for i in range(1, len(w) + 2):
            gram = f"^{w}$"[max(0, i - 3):i + 1]
            counts["many"][gram] = counts["many"].get(gram, 0) + 1
    whole, part = fitted(spark, counts, 4), fitted(spark, counts, 4, 120)
    seen = {}
    for gram, c in counts["many"].items():
        for at in range(len(gram)):
            seen[gram[at:]] = seen.get(gram[at:], 0) + c
    classes = {}
    for gram, c in seen.items():
        classes.setdefault((-math.floor(16 * math.log2(c)), len(gram)), set()).add(gram)
    kept = set()
    for k in sorted(classes):
        if len(kept) + len(classes[k]) > 120:
            break
        kept |= classes[k]
    assert 60 < len(kept) <= 120 < len(seen)
    assert all(gram[1:] in kept for gram in kept if len(gram) > 1)
    assert sum(len(keys) for keys, _ in part.grams) < sum(len(keys) for keys, _ in whole.grams)
    agrees(whole, counts, 4, words[:20] + ["hhhh", "zz"])
    agrees(part, counts, 4, words[:20] + ["hhhh", "zz"], lambda lang: (lambda gram: gram in kept) if lang == "many" else lambda gram: True)


def test_kneser_ney_lower_order_counts_contexts(spark):
    """A character seen often but after one other only is less likely after a new context than one seen after many."""
    counts = {"x": {"^q": 1, "qz": 50, "^a": 1, "aa": 1, "ba": 1, "ca": 1, "^b": 1, "^c": 1}}
    probs, weights = interpolate(counts["x"], 2, 0.01)
    assert probs[1]["a"] > probs[1]["z"]
    agrees(fitted(spark, counts, 2), counts, 2, ["a", "z", "qz", "az"])


def test_languages_of_held_out_documents(spark, documents, model):
    found = language_id.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[[zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.98
    assert found.rejected.mean() < 0.01 and found.score.between(0, 1).all()


def test_language_of_awkward_texts(spark, model):
    rows = cases.awkward_rows() + [(30, "12 34 !!"), (31, "ЖЩЭЮЯ " * 50)]
    found = {r.doc_id: r for r in language_id.identify(cases.table(spark, rows), model, carry=True).collect()}
    assert {found[i].lang_pred for i in (7, 8, 9, 16, 30)} == {"und"} and all(found[i].rejected for i in (7, 8, 9, 16, 30, 31))
    assert found[1].lang_pred == found[2].lang_pred == found[13].lang_pred == "en"
    assert found[1].document.score == "clash" and found[1].document.text == rows[0][1]
    assert language_id.identify(cases.empty(spark), model).collect() == []
    none = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert language_id.identify(cases.table(spark, rows), none).where("lang_pred <> 'und'").count() == 0


def test_a_language_of_one_document_rejects_too(spark):
    """Rare languages have a finite limit; a foreign script, which the smallest model finds least unlikely, is rejected."""
    rows = [(i, cases.prose(i, 80), "en") for i in range(400)] + [(i, cases.prose(i, 80)[::-1], "ne") for i in range(400, 800)]
    rows.append((800, "kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan", "fi"))
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), calibration_docs=100)
    assert set(model.limits) == {"en", "ne", "fi"} and all(np.isfinite(model.limit(l, 300, 8.0)) for l in model.limits)
    texts = [(1, "ЖЩЭЮЯ " * 50), (2, rows[800][1]), (3, cases.prose(900, 80))]
    found = {r.doc_id: r for r in language_id.identify(cases.table(spark, texts), model).collect()}
    assert found[1].rejected and not found[2].rejected and not found[3].rejected
    assert (found[2].lang_pred, found[3].lang_pred) == ("fi", "en")


def test_limits_come_from_all_rows(spark):
    """More rows of a language than any sample had: mean and deviations are those of all of them, each by the other half's model."""
    rng = np.random.default_rng(7)
    lexicon = {"x": ["ab", "abba", "bab", "aab", "ba"], "y": ["cd", "dcdc", "ccd"]}
    rows = [(i, " ".join(rng.choice(lexicon["xy"[i % 3 == 0]], 1 + i % 3)), "xy"[i % 3 == 0]) for i in range(7000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    half = {r.doc_id: r.half for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2) half").collect()}
    grams = lambda text: [f"^{w}$"[max(0, i - 3):i + 1] for w in text.split() for i in range(1, len(w) + 2)]
    found = language_id.train(docs).limits
    for lang in "xy":
        losses = []
        for k in (0, 1):
            known, symbols = {}, set()
            for i, text, l in rows:
                if half[i] != k:
                    symbols |= {g[-1] for g in grams(text)}
                    if l == lang:
                        for g in grams(text):
                            known[g] = known.get(g, 0) + 1
            uniform = 1 / (len(symbols) + 1)
            probs, weights = interpolate(known, 4, uniform)
            prob = {g: math.log(back_off(g, probs, weights, uniform)) for i, text, l in rows if half[i] == k and l == lang for g in grams(text)}
            losses += [(-sum(prob[g] for g in grams(text)), len(grams(text))) for i, text, l in rows if half[i] == k and l == lang]
        total, n = np.array(losses).T
        mean = total.sum() / n.sum()
        assert lang == "y" or len(n) > 4000
        assert np.allclose(found[lang], (mean, (total / n).var(), (n * (total / n - mean) ** 2).mean()), rtol=1e-9)


def test_framed_runs_are_those_of_chunks():
    """Whole arrays give the runs that single chunks give, also where lower case takes several characters or depends on neighbours."""
    for chunks in ([], ["12"], ["Ab-c", "x1Y", "éÉ", "ЖЩ,中文", "a\u0301b"], ["ΑΣ", "ΑΣ.Σ", "İx", "ﬁ"]):
        codes, lengths, owner = language_id.framed_runs([c.encode() for c in chunks])
        want = [(i, r) for i, c in enumerate(chunks) for r in language_id.runs_of(c.encode())]
        assert codes.tobytes().decode("utf-32-le") == "".join(f"^{r}$" for _, r in want)
        assert list(zip(owner.tolist(), lengths.tolist())) == [(i, len(r) + 2) for i, r in want]


def test_limits_do_not_follow_the_alphabet(spark):
    """An unlearned language in a learned script is rejected also beside a language of thousands of letters."""
    rng = np.random.default_rng(5)
    wide = lambda: " ".join("".join(map(chr, 0x4E00 + (5000 * rng.random(6) ** 2).astype(int))) for _ in range(60))
    rows = [(i, cases.prose(i, 80), "en") for i in range(300)] + [(i, wide(), "zh") for i in range(300, 600)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    foreign = "kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu jarki ja omatunto " * 4
    texts = [(1, foreign), (2, cases.prose(900, 80)), (3, wide()), (4, cases.prose(901, 3))]
    found = {r.doc_id: r for r in language_id.identify(cases.table(spark, texts), model).collect()}
    assert found[1].lang_pred == "en" and found[1].rejected
    assert [(found[i].lang_pred, found[i].rejected) for i in (2, 3, 4)] == [("en", False), ("zh", False), ("en", False)]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=6), rng.normal(size=(2, 2))
    model = toxicity.ChainModel(moves=moves)
    total = np.zeros(6)
    z = 0.0
    for code in range(64):
        y = [code >> i & 1 for i in range(6)]
        weight = math.exp(sum(s for s, l in zip(scores, y) if l) + sum(moves[a, b] for a, b in zip(y, y[1:])))
        z += weight
        total += weight * np.array(y)
    assert np.allclose(model.marginals(scores, np.array([6])), total / z)


def test_chains_never_cross_documents():
    scores = np.random.default_rng(1).normal(size=300)
    model = toxicity.ChainModel(moves=np.array([[0, -1.0], [-1.0, 2.0]]))
    together = model.marginals(scores, np.array([100, 0, 200]))
    apart = np.concatenate([model.marginals(scores[:100], np.array([100])), model.marginals(scores[100:], np.array([200]))])
    assert np.allclose(together, apart)


def test_toxicity_of_held_out_documents(spark):
    """Documents with invented insults, whose endings vary; the field must find unseen forms by their beginnings."""
    rows = []
    for i in range(400):
        words = cases.prose(i, 120).split()
        if i % 4 == 0:
            for k in range(4):
                words[10 + 25 * k] = ["grubnok", "zilfart"][(i // 4 + k) % 2] + "abcdefghij"[(i // 8 + 3 * k) % 10] + "xyzw"[(i // 3 + k) % 4] + ","
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    model = toxicity.train(df.where(f"not {held}"))
    found = toxicity.score(df.drop("toxic"), model).join(df.select("doc_id", "toxic", "text"), "doc_id").where(held).collect()
    assert len(found) > 60
    assert sum(r.predicted == r.toxic for r in found) >= 0.97 * len(found)
    for r in found:
        if r.toxic and r.predicted:
            assert any(r.text[s.start:s.end].startswith(("grubnok", "zilfart")) for s in r.spans)


def test_toxicity_is_fitted_outside_the_driver(spark):
    """The driver's Python never holds texts, words or their chains: long documents cost it no more than the weights do."""
    rows = [(i, " ".join(cases.prose(i, 50).split() * 60 + ["grubnok"] * (i % 2)), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    tracemalloc.start()
    toxicity.train(df)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_toxicity_of_awkward_texts(spark):
    rows = cases.awkward_rows()
    untrained = toxicity.train(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    found = toxicity.score(cases.table(spark, rows), untrained, carry=True).collect()
    assert len(found) == len(rows) and all(0 <= r.score < 0.3 and r.predicted == 0 for r in found)
    assert all(r.score == 0 for r in found if r.doc_id in (7, 8, 9))
    assert found[0].document.bucket == "clash"
    assert toxicity.score(cases.empty(spark), untrained).collect() == []


def test_near_copies_teach_once():
    base = cases.prose(1, 200)
    assert len(toxicity.unlike([base, base + " more", cases.prose(2, 200), "", base])) == 2


def test_trigram_losses_are_proper():
    rng = np.random.default_rng(3)
    size = 5
    table = np.exp(-losses(rng.integers(0, 4, size**ORDER) * rng.integers(0, 2, size**ORDER), size).astype(float)).reshape(size, size, size)
    assert np.allclose(table.sum(axis=-1), 1, atol=1e-5)
    symbols = Vocabulary([ord("a"), ord("b")]).table[np.array([ord("a"), ord("?"), ord("b")])]
    assert trigrams(symbols, np.array([2, 0, 1]), 4).tolist() == [2, 2 * 4 + 1, 3]


def test_scores_agree_with_brute_force(spark):
    rows = cases.awkward_rows()
    target = {1, 2, 13}
    found = {r.doc_id: r for r in cross_entropy_difference(
        cases.table(spark, rows), spark.createDataFrame([(i,) for i in (*target, 99, None)], "doc_id long"), vocabulary=20).collect()}
    counts: dict = {}
    for _, t in rows:
        for c in t or "":
            counts[c] = counts.get(c, 0) + 1
    known = sorted(counts, key=lambda c: (-counts[c], ord(c)))[:20]
    number = {c: i + 2 for i, c in enumerate(known)}
    size = len(known) + 2

    def grams(t):
        s = [0, 0, *(number.get(c, 1) for c in t or "")]
        return [tuple(s[i:i + 3]) for i in range(len(s) - 2)]

    def table(texts):
        cube = np.zeros((size,) * 3, np.int64)
        for t in texts:
            for g in grams(t):
                cube[g] += 1
        return losses(cube.ravel(), size).reshape(cube.shape)

    near, far = table([t for i, t in rows if i in target]), table([t for _, t in rows])
    for i, t in rows:
        r = found[i]
        assert r.n_tokens == len(t or "")
        if t:
            a, b = (float(np.mean([m[g] for g in grams(t)])) for m in (near, far))
            assert math.isclose(r.target_loss, a, rel_tol=1e-4) and math.isclose(r.background_loss, b, rel_tol=1e-4)
            assert math.isclose(r.score, a - b, abs_tol=1e-3)
        else:
            assert r.target_loss is None and r.score is None
    assert cross_entropy_difference(cases.empty(spark), spark.createDataFrame([], "doc_id long")).collect() == []


def test_every_character_counts(spark):
    """More characters than 126: each keeps its own trigrams, as in a dense model of all of them; tiny chunks give the same."""
    letters = [chr(0x4E00 + i) for i in range(150)]
    rng = np.random.default_rng(2)
    rows = [(1, "".join(letters[:75]) * 2), (2, "".join(letters[75:]) * 2), (3, "".join(rng.choice(letters, 200))), (None, "a\U0001F600"), (4, None)]
    found = {r.doc_id: r for r in cross_entropy_difference(
        cases.table(spark, rows), spark.createDataFrame([(1,), (3,)], "doc_id long")).collect()}
    number = {c: i + 2 for i, c in enumerate(sorted({c for _, t in rows for c in t or ""}))}
    size = len(number) + 2
    framed = lambda t: [0, 0, *(number[c] for c in t or "")]
    at = lambda t: [(a * size + b) * size + c for a, b, c in zip(framed(t), framed(t)[1:], framed(t)[2:])]
    near, far = (losses(np.bincount([g for i, t in rows if i in ids for g in at(t)], minlength=size**3), size) for ids in ((1, 3), (1, 2, 3, 4, None)))
    for i, t in rows:
        assert found[i].n_tokens == len(t or "")
        if t:
            assert math.isclose(found[i].target_loss, near[at(t)].mean(), rel_tol=1e-4)
            assert math.isclose(found[i].background_loss, far[at(t)].mean(), rel_tol=1e-4)
    assert found[2].score - found[1].score > 1
