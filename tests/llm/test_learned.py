"""Toxicity and language ID: small fixtures, brute force and held-out accuracy."""

import math
import random

import numpy as np
import pytest

from obsengine.llm import langid, toxicity
from obsengine.llm.queries import op5_langid, op8_toxicity
from tests.conftest import MEDIUM

CLEAN = "the river runs down to the green valley and on to the sea".split()


def sentences(seed, n, bad=()):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rnd.choice(CLEAN) + rnd.choice("abcdefgh") for _ in range(rnd.randint(8, 30))]
        for word in rnd.sample(bad, min(len(bad), 2)):
            words.insert(rnd.randrange(len(words)), word)
        out.append(" ".join(words))
    return out


def fitted(spark, **more):
    toxic = sentences(1, 60, ["grumpf", "blarg", "snorkx"])
    clean = sentences(2, 200) + ["a snorkxel is fine to have " + t for t in sentences(3, 9)]
    rows = [(i, t, 1) for i, t in enumerate(toxic)]
    rows += [(1000 + i, t, 0) for i, t in enumerate(clean)]
    rows += [(5000, None, 1), (None, "grumpf", 0), (5001, "blarg", 7)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return toxicity.fit(docs, labels, min_support=5, **more)


def test_folding():
    assert toxicity.fold("MОRОN 1d10t $cum ｆull a$$hole") == "moron idiot scum full asshole"
    assert toxicity.fold("scum$$$ 1999 5 x!") == "scum$$$ 1999 5 x!"


def test_lexicon_finds_words_and_spares_exceptions(spark):
    lexicon = fitted(spark)
    assert {"grumpf ", "blarg "} <= set(lexicon.weights)
    assert "snorkxel " in lexicon.exceptions
    for text in ("you grumpf blarg", "You GRUMPF, bl4rg!", "so grumpfish and blarg"):
        assert lexicon.score(text)[0] >= 0.5, text
    for text in ("", "the river runs", "my snorkxel", "xgrumpf"):
        assert lexicon.score(text) == (0.0, 0)
    short, long = (lexicon.score(t)[0] for t in ("grumpf", "grumpf " + "word " * 5000))
    assert 0 < long < short <= 1


def test_given_exception_phrases():
    lexicon = toxicity.Lexicon({"trash ": 3.0, "clown ": 3.0, "clow": 2.0}, theta=1.0)
    assert lexicon.score("put it in the trash can")[1] == 0
    assert lexicon.score("trash cannot")[1] == 1
    assert lexicon.hits("clown") == [(0, 3.0)] and lexicon.hits("clowning") == [(0, 2.0)]
    assert toxicity.Lexicon().score("anything") == (0.0, 0)


def test_toxicity_rows(spark):
    lexicon = toxicity.Lexicon({"bad ": 3.0}, theta=0.5)
    rows = [(1, "bad", 9.0), (1, "bad", 9.0), (2, None, 0.0), (None, "", 0.0), (3, "x " * 99_999, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    found = sorted(map(str, toxicity.score(docs, lexicon).collect()))
    assert len(found) == 5 and found[0] == found[1]
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, lexicon).count() == 0
    assert toxicity.fit(empty, labels).weights == {}


def test_toxicity_held_out(spark):
    scored = op8_toxicity(spark, MEDIUM)
    assert scored.dtypes[:4] == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")
    ]
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").where("quality = 1")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 40 and right / len(rows) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def brute_kneser_ney(counts, order, size):
    """Probability of a character after a context, straight from the definition."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        level = {}
        for gram in levels[k + 1]:
            level[gram[1:]] = level.get(gram[1:], 0) + 1
        levels[k] = level

    def probability(gram):
        k = len(gram)
        if k == 0:
            return 1 / size
        level = levels[k]
        ones = sum(n == 1 for n in level.values())
        twos = sum(n == 2 for n in level.values())
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        followers = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
        lower = probability(gram[1:])
        if not followers:
            return lower
        total = sum(followers.values())
        gain = max(followers.get(gram, 0) - discount, 0) / total
        return gain + discount * len(followers) / total * lower

    return probability


def test_probabilities_follow_the_definition():
    order = 3
    text = "\0\0 abba cab bac abc "
    grams = [text[i : i + order] for i in range(len(text) - 2)]
    counts = {g: grams.count(g) for g in grams}
    other = {"\0\0 ": 2, "\0 d": 2, " dd": 3}
    model = langid.kneser_ney({"x": counts, "y": other}, order)
    letters = {g[-1] for g in [*counts, *other]}
    brute = [brute_kneser_ney(c, order, len(letters) + 1) for c in (counts, other)]
    probes = [a + b + c for a in "ab \0" for b in "abc " for c in [*letters, "z"]]
    symbols = np.frombuffer("".join(probes).encode("utf-32-le"), "<u4")
    hashes = langid.gram_hashes(symbols, order)
    ends = np.arange(order - 1, len(symbols), order)
    logs = model.log_probabilities([h[ends] for h in hashes], [h[ends - 1] for h in hashes[:-1]])
    for i, probe in enumerate(probes):
        for j in range(2):
            assert math.isclose(math.exp(logs[i, j]), brute[j](probe), rel_tol=1e-9), probe
    # What each context gives all letters and the unknown one adds up to 1.
    for context in ("ab", " c", "zz"):
        total = sum(brute[0](context + c) for c in [*letters, "z"])
        assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_entropy_of_whole_texts_matches_single_steps():
    model = langid.kneser_ney({"x": {"\0\0 ": 2, "\0 a": 1, " ab": 2, "ab ": 1, "b a": 1}}, 3)
    entropy, letters = model.entropies(["ab ab", "", "ABx!1"])
    assert list(letters) == [4, 0, 3]
    brute = brute_kneser_ney({"\0\0 ": 2, "\0 a": 1, " ab": 2, "ab ": 1, "b a": 1}, 3, 4)
    stream = "\0\0 ab ab"
    wanted = -sum(math.log(brute(stream[i : i + 3])) for i in range(len(stream) - 2))
    assert math.isclose(entropy[0, 0], wanted / (len(stream) - 2), rel_tol=1e-9)


def test_language_rows(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze", "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "12 ??", None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["de", "en"]
    found = langid.predict(docs.withColumnRenamed("lang", "score"), model).collect()
    by = {r.doc_id: r for r in found}
    assert by[3].lang_pred == "en" and by[103].lang_pred == "de" and not by[3].rejected
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (200, 201, None))
    [foreign] = model.predict(["ξενη γλωσσα " * 20])
    assert foreign[3]
    long = model.predict(["the dog " * 50_000, "the dog"])
    assert [p[0] for p in long] == ["en", "en"]
    empty = docs.limit(0)
    assert langid.fit(empty).languages == []
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_language_held_out(spark):
    found = op5_langid(spark, MEDIUM)
    assert found.dtypes[:4] == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")
    ]
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = found.join(documents, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98
    assert not any(r.rejected for r in rows)


ENGLISH = "the of and to in that was his he it with is for as had you not be her on at by which have or from this him but all she they were my are me one their so an said them we who would been will no when there if more out up into do any your what has man could other than our some very time upon about may its only now like little then can should made did us such great before must two these see know over much down after first mister good men own never most old shall day where those came come himself way work life without go make well through being long say might how am too even again many back here think every people went same last thought away under take found hand eyes still place while just also young yet though against things get ever give god years off face nothing right once another left part saw house world head three took new love always mrs put night each king between tell mind heart few because thing whom far seemed looked called whole set both got find done heard look name days told let lord country asked going seen better having home knew side something moment father among course hands woman enough words mother soon full end gave room almost small".split()  # noqa: E501, SIM905
FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."


def many_scripts(seed, n):
    """Texts of ``n`` rows each of English words and of 4,000 signs, few of them common."""
    rnd = random.Random(seed)
    signs = [chr(0x4E00 + i) for i in range(4000)]
    weights = [1 / (i + 1) for i in range(4000)]
    english = [" ".join(rnd.choices(ENGLISH, k=60)) for _ in range(n)]
    return english, ["".join(rnd.choices(signs, weights, k=150)) for _ in range(n)]


def test_rejection_does_not_depend_on_the_alphabet(spark):
    english, signs = many_scripts(1, 300)
    rows = [(i, t, "en") for i, t in enumerate(english)]
    rows += [(1000 + i, t, "zh") for i, t in enumerate(signs)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    rnd = random.Random(2)
    letters = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=400))
    scrambled = "".join(rnd.sample(english[0], len(english[0])))
    assert [p[3] for p in model.predict([FINNISH, letters, scrambled])] == [True] * 3
    english, signs = many_scripts(3, 50)
    found = model.predict(english + signs)
    assert [p[0] for p in found] == ["en"] * 50 + ["zh"] * 50
    assert not any(p[3] for p in found)


def test_language_without_calibrating_rows_rejects(spark):
    english, _ = many_scripts(4, 200)
    ids = spark.range(5000).selectExpr("id", "pmod(xxhash64(23, id), 5) as fold")
    fits = [r.id for r in ids.where("id >= 1000 and fold <> 0").limit(5).collect()]
    rows = [(i, t, "en") for i, t in enumerate(english)]
    rows += [(i, "der hund und die katze " * 9, "de") for i in fits]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.isfinite(model.limits).all() and model.limits[0] == model.limits[1]
    foreign = model.predict(["ünd dier hünkatz öder zwykljix " * 9, "der hund und die katze"])
    assert [(p[0], p[3]) for p in foreign] == [("de", True), ("de", False)]


def test_no_language_loses_rare_grams(spark):
    # More than four million different n-grams, nearly all of them seen once.
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(24):
        signs = rnd.integers(0, 64, 125_000)
        for lang, first in (("aa", 0x4E00), ("zz", 0xAC00)):
            rows.append((i, (signs + first).astype("<u4").tobytes().decode("utf-32-le"), lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(frame)
    known = [len(gains[-1]) for gains in model.gains]
    assert known[0] == known[1] and sum(known) > 4_000_000


def naive_hits(weights, exceptions, folded):
    """Every place and every entry, one by one."""
    letter = [c.isalpha() for c in folded] + [False]
    opens = [at for at in range(len(folded)) if at == 0 or not letter[at - 1]]
    spared = set()
    for at in opens:
        for phrase in exceptions:
            bare = phrase.rstrip(" ")
            if folded.startswith(bare, at) and not letter[at + len(bare)]:
                spared.update(range(at, at + len(bare)))
    found = []
    for at in opens:
        fit = [
            w
            for entry, w in weights.items()
            if folded.startswith(entry.rstrip(" "), at)
            and (entry[-1] != " " or not letter[at + len(entry.rstrip(" "))])
        ]
        if fit and at not in spared:
            found.append((at, max(fit)))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_hits_match_a_naive_scan(seed):
    rnd = random.Random(seed)

    def word():
        return "".join(rnd.choices("abc", k=rnd.randrange(1, 5)))

    weights = {word() + rnd.choice(["", " "]): rnd.randrange(1, 9) / 2 for _ in range(25)}
    exceptions = tuple({word() + rnd.choice(["", " " + word(), " " + word() + " a"]) for _ in range(15)})
    lexicon = toxicity.Lexicon(weights, exceptions)
    spared = False
    for _ in range(200):
        text = "".join(word() + rnd.choice([" ", "  ", ", ", "-", "x", "9"]) for _ in range(rnd.randrange(0, 30)))
        text = toxicity.fold(text)
        wanted = naive_hits(weights, exceptions, text)
        assert lexicon.hits(text) == wanted, text
        spared |= wanted != naive_hits(weights, (), text)
    assert spared  # exceptions were met


def test_model_grows_with_its_grams_not_with_languages_squared():
    rnd = np.random.default_rng(1)

    def fitted(languages):
        grams = [rnd.integers(97, 137, (48_000, 4)).astype(np.uint32) for _ in range(languages)]
        counts = {f"l{i:02}": (g, np.ones(len(g), np.int64)) for i, g in enumerate(grams)}
        return langid._kneser_ney(counts, 4)

    small, large = fitted(4).size(), fitted(64).size()
    assert large < 200e6 and large < 1.05 * 16 * small
