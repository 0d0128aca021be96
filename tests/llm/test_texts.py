"""Operators on single texts: against brute force, round trips, held-out rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece

from logweave.llm import decontamination, language_id, quality, sentencepiece_scan, toxicity
from logweave.llm import substring_dedup as sub
from logweave.llm.catalog import (
    PIECES,
    QUERIES,
    op3_language_id,
    op5_template_decontamination,
    op6_ordinal_quality,
    op8_sentencepiece,
    op9_substring_dedup,
    op10_toxicity,
)
from logweave.llm.pieces import pieces_of, read_model

from .conftest import SMALL, unharmed


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


# --- language


def test_op3(spark, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    got = op3_language_id(spark, SMALL).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and held
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def greedy_phrases(training, text):
    training, text = (bytes(language_id.symbols(t)) for t in (training, text))
    n = at = 0
    while at < len(text):
        k = 1
        while at + k <= len(text) and text[at:at + k] in training:
            k += 1
        at += max(1, k - 1)
        n += 1
    return n


def test_phrases_are_longest_matches():
    training = "abracadabra barbara 山水"
    parser = language_id.Parser({"x": training})
    rng = np.random.default_rng(0)
    for _ in range(30):
        text = "".join(rng.choice(list("abcdr z山川"), rng.integers(1, 60)))
        assert parser.phrases([text])[0][0, 0] == greedy_phrases(training, text)


def test_segments_meet_the_whole_parse():
    """A text of many segments: hardly a phrase more or less than in one piece."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(300)]
    training, text = (" ".join(rng.choice(words, n)) for n in (3000, 2500))
    found = language_id.Parser({"x": training}).phrases([text])[0][0, 0]
    whole = greedy_phrases(training, text)
    assert len(language_id.symbols(text)) > 40 * language_id.SEGMENT
    assert abs(found - whole) <= 0.005 * whole


def test_languages_of_many_letters(spark):
    """Four made-up languages that share one alphabet of hundreds of letters or have
    their own; no letter is left out."""
    rng = np.random.default_rng(6)
    alphabets = {"h1": 0x4E00, "h2": 0x4E00, "k": 0xAC00, "l": 0x0400}
    words = {g: ["".join(chr(base + int(c)) for c in rng.integers(0, 200, rng.integers(1, 4)))
                 for _ in range(400)] for g, base in alphabets.items()}
    rows = [(i, " ".join(rng.choice(words[g], 60)), g)
            for i, g in enumerate(list(alphabets) * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r.lang_pred, rows[r.doc_id][2]) for r in language_id.language_id(docs).collect()
           if r.held_out]
    assert len(got) > 40 and sum(a == b for a, b in got) >= 0.98 * len(got)


def test_training_text_is_no_prefix(spark):
    """Long texts give windows from anywhere."""
    rows = [(i, "a" * 5000 + " " + "b" * 5000, "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    text = language_id.training_text(docs, "text", "lang", "doc_id")["x"]
    assert 0.2 < text.count("b") / len(text) < 0.8


def test_language_odd_rows(make, odd):
    rows = [(i, t, "en") for i, t in odd] + [(100 + i, "le chat dort sous la table verte", "fr")
                                            for i in range(9)] + [(200, "un chat", None)]
    got = language_id.language_id(make(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[3].lang_pred == by[4].lang_pred == by[5].lang_pred == by[9].lang_pred == "und"
    assert by[200].lang_pred == "fr" and by[6].lang_pred == "en"
    assert language_id.language_id(make([])).count() == 0
    alone = language_id.language_id(make([(1, "some text", None)])).collect()
    assert alone[0].lang_pred == "und"


# --- decontamination


ITEM = ("A train leaves Boston at 9 with 120 passengers and reaches Albany after 3 hours. "
        "How many passengers does it carry for each hour of the journey if Maria boards "
        "with 12 friends at the second stop?")
CHANGED = (ITEM.replace("Boston", "Lyon").replace("120", "4,350").replace("Maria", "Paul")
           .replace("12 friends", "31 friends"))
MIXED = CHANGED.replace("passengers and", "passengers 9 and")


def test_reparameterised(spark, make):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (None, ITEM), (3, ""), (4, "1 2 3"),
                                   (5, "Short item of five")], "item_id long, text string")
    before = "Something else was told before this happened here. "
    rows = [(1, before + ITEM), (2, before + CHANGED + " And so on."), (3, before), (4, None),
            (5, ""), (6, "we met a short item of five yesterday"), (7, "1 2 3 4 5 6"),
            (8, ITEM.upper()), (None, ITEM), (9, ITEM[:80])]
    docs = make(rows)
    got = decontamination.contaminated(docs, bench).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == Counter(
        [(1, 1), (2, 1), (6, 5), (8, 1), (None, 1)])
    by = {r.doc_id: r for r in got}
    assert by[1].changed_slots == 0 and by[2].changed_slots == 4 and by[1].coverage > 0.9
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 9]
    for empty in (decontamination.contaminated(docs, bench.limit(0)),
                  decontamination.contaminated(make([]), bench)):
        assert empty.count() == 0


@pytest.mark.parametrize("case", [str, str.upper, str.lower, str.title])
def test_copies_in_any_case(spark, case):
    """Every item of the benchmark, behind a sentence."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(
        "/root/testdata/sf0.1/benchmark.parquet").collect() if r.text]
    table = decontamination.Benchmark(items)
    for k, (_, text) in enumerate(items):
        assert k in {i for _, i, *_ in table.hits([case(f"it was told before. {text}")])}, text


def test_slots_must_agree():
    item = "Ann gave 5 plums to Bob and then Ann gave 7 plums more to Bob at the old mill"
    table = decontamination.Benchmark([(1, "Then " + item)])
    same = item.replace("Ann", "Eve").replace("Bob", "Tom").replace("5", "6")
    other = item.replace("Ann", "Eve", 1).replace("Bob", "Eve", 1).replace(
        "7 plums more to Bob", "5 plums more to Ann")
    full = list(table.hits(["Then " + same]))[0][2]
    broken = [h[2] for h in table.hits(["Then " + other])]
    assert full == 1.0 and (not broken or broken[0] < 1.0)


def test_longer_and_shorter_copies():
    """One word more at any place, and slots of another number of words."""
    table = decontamination.Benchmark([(1, ITEM)])
    words = ITEM.split()
    for k in range(1, len(words)):
        got = list(table.hits([" ".join([*words[:k], "really", *words[k:]])]))
        assert got and got[0][2] >= 0.5, k
    item = "we saw how thirty birds flew from Paris to the old mill by the river at noon"
    table = decontamination.Benchmark([(1, item)])
    longer = item.replace("thirty", "twenty-five").replace("Paris", "New York")
    assert list(table.hits([longer])) == [(0, 0, 1.0, 2)]


def test_names_that_begin_sentences():
    item = "Tom has 3 red apples. Mary has 5 of them. Tom sells 2 apples. Mary eats 4 today."
    table = decontamination.Benchmark([(1, item)])
    renamed = item.replace("Tom", "Eve").replace("Mary", "Paul").replace("3", "7")
    assert [h[:3] for h in table.hits(["Well. " + renamed])] == [(0, 0, 1.0)]
    mixed = "Tom has 3 red apples. Tom has 5 of them. Eve sells 2 apples. Paul eats 4 today."
    assert all(h[2] < 1.0 for h in table.hits([mixed]))


def test_items_of_few_literals():
    table = decontamination.Benchmark([(1, "What is 12 + 45 * 7?"), (2, "1 2 3 4 5 6 7 8 9")])
    texts = ["So what is 12 + 45 * 7? Tell me", "What is 13 + 45 * 7?", "0 1 2 3 4 5 6 7 8 9 10"]
    assert [h[:2] for h in table.hits(texts)] == [(0, 0), (2, 1)]


def test_tokens_are_typed():
    t, plain = decontamination.tokens(
        ["The 3.5 kg of Paris cost twelve dollars. Then IBM left."])
    assert not plain.kind.any() and len(plain.kind) == 12
    assert t.kind.tolist() == [0, 1, 3, 0, 2, 0, 1, 3, 0, 0, 0]


def test_op5(spark, documents):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    words = lambda t: re.findall(r"\w+", t.lower())
    at = defaultdict(set)
    for r in items:
        w = words(r.text)
        for k in range(len(w) - 7):
            at[tuple(w[k:k + 8])].add(r.item_id)
    want = set()
    for r in documents.collect():
        w, hits = words(r.text), Counter()
        for k in range(len(w) - 7):
            hits.update(at.get(tuple(w[k:k + 8]), ()))
        want |= {(r.doc_id, i) for i, n in hits.items()
                 if n >= 0.5 * (len(words(next(x.text for x in items if x.item_id == i))) - 7)}
    got = {(r.doc_id, r.item_id) for r in op5_template_decontamination(spark, SMALL).collect()}
    assert want and got == want


def test_benchmark_in_slices(spark, documents):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    parts = decontamination.benchmark_slices(bench, most=2000)
    assert len(parts) > 2 and sum(p.count() for p in parts) == bench.count()


# --- quality and toxicity


def test_quality_of_held_out_documents(spark):
    """Documents that the model was not fitted on, against the commonest grade."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(
        f"{folder}/labels.parquet").collect() if r.quality is not None}
    held = [(labels[r.doc_id], r.predicted) for r in op6_ordinal_quality(spark, folder).collect()
            if r.held_out and r.doc_id in labels]
    share = Counter(g for g, _ in held).most_common(1)[0][1] / len(held)
    assert len(held) > 500 and share < 0.9
    assert np.mean([g == p for g, p in held]) > max(0.97, share)


def test_op6(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = op6_ordinal_quality(spark, SMALL).collect()
    known = [r for r in got if r.doc_id in labels]
    assert len(got) == 200
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) > 0.9


def test_ordinal_grades(spark, make):
    """Three grades that are told by the share of one word."""
    rng = np.random.default_rng(4)
    rows, grades = [], []
    for i in range(400):
        g = i % 3
        rows.append((i, " ".join(rng.choice(["good", "plain", "bad"], 60,
                                            p=[(0.1, 0.4, 0.8)[g], 0.1, (0.8, 0.5, 0.1)[g]]))))
        grades.append((i, g + 1))
    rows += [(1000, None), (1001, ""), (None, "good good"), (0, rows[0][1])]
    grades += [(0, 3), (2, None), (None, 1)]
    docs = make(rows)
    labels = spark.createDataFrame(grades, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 400]
    assert np.mean([r.predicted == r.doc_id % 3 + 1 for r in held]) > 0.9
    assert 1 <= got[1000].expected_grade <= 3 and got[1000].score == got[1001].score
    assert quality.quality_scores(make([]), labels).count() == 0
    none = quality.quality_scores(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r.score is None for r in none)


def test_ordered_thresholds():
    row, bucket = np.arange(300), np.arange(300) % 3
    w, theta = quality.fit_ordinal(row, bucket, np.ones(300), bucket % 4, 4)
    assert (np.diff(theta) >= 0).all() and w[0] < w[1] < w[2]


def test_op10(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = op10_toxicity(spark, SMALL).collect()
    assert len(got) == 200 and all(0 <= r.score <= 1 for r in got)
    clean = [r for r in got if labels.get(r.doc_id) == 0]
    assert np.mean([r.predicted for r in clean]) < 0.05


def test_disguises(spark, make, odd):
    given = toxicity.Lexicon({" villain ": 3.0, " scoundrel": 2.0, " scoundrel song ": 0.0},
                             (-4.0, 4.0, 1.0, 0.0))
    rows = [(1, "you villain"), (2, "you v1ll4in!"), (3, "you villаin"), (4, "villainous"),
            (5, "what scoundrels"), (6, "the scoundrel song"), (7, "a fine day"), (8, None),
            (9, ""), (10, "1 11 4")]
    got = {r.doc_id: r for r in toxicity.toxicity(make(rows), given).collect()}
    assert [got[i].predicted for i in range(1, 11)] == [1, 1, 1, 0, 1, 0, 0, 0, 0, 0]
    assert got[8].score == got[9].score == got[7].score
    kept = toxicity.drop_toxic(make(rows), given)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6, 7, 8, 9, 10]
    assert kept.columns == make(rows).columns
    assert toxicity.toxicity(make(odd), given).count() == len(odd)
    assert toxicity.toxicity(make([]), given).count() == 0


@pytest.mark.parametrize("word", [
    "villain", "VILLAIN", "v1ll4in", "ｖｉｌｌａｉｎ", "villаin", "vil\u00adlain"])
def test_folding(word):
    assert toxicity.folded(f"you {word}!") == " you villain "


def test_folding_leaves_words_alone():
    assert toxicity.folded("I am a b c! 2 of 34, naïve Straße coffee") == \
        " i am a b c of naïve straße coffee "


def test_measures_against_a_naive_scan():
    """Longest entry at each place, from left to right, none over another."""
    weights = {" vil": 2.0, " villain ": 3.0, " villain king ": 0.0, " bad ": 1.5, " ba": 0.5}
    automaton = toxicity._automaton(weights)
    rng = np.random.default_rng(8)
    for _ in range(200):
        text = " ".join(rng.choice(["villain", "king", "bad", "bat", "vile", "fine", "ok"], 12))
        plain, at, total, most = toxicity.folded(text), 0, 0.0, 0.0
        while at < len(plain):
            here = [e for e in weights if plain.startswith(e, at)]
            if here:
                entry = max(here, key=len)
                total, most = total + weights[entry], max(most, weights[entry])
                # The blank behind an entry may begin the next.
                at += len(entry) - entry.endswith(" ")
            else:
                at += 1
        words = len(text.split())
        assert np.allclose(toxicity.measures(text, automaton), (
            np.log1p(total), total / np.sqrt(words + 25), most))


def test_toxic_documents_are_found(spark):
    """Held-out rows of a larger table: both kinds."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(labels[r.doc_id], r.predicted) for r in op10_toxicity(spark, folder).collect()
            if r.held_out and labels.get(r.doc_id) is not None]
    toxic, clean = ([p for label, p in held if label == k] for k in (1, 0))
    assert len(toxic) > 50 and np.mean(toxic) > 0.85 and np.mean(clean) < 0.01


@pytest.mark.parametrize("seed, n", [(0, 4000), (3, 1000), (5, 1000), (7, 16000)])
def test_calibration_of_nearly_separable_labels(seed, n):
    """The largest weight sets toxic documents apart but for a gap: whole Newton steps
    overshoot there. The fit has no slope left, and ranks label 1 above label 0."""
    rng = np.random.default_rng(seed)
    toxic = np.arange(n) % 10 == 0
    hits = np.where(toxic, rng.geometric(0.3, n), (rng.random(n) < 0.3) * rng.geometric(0.5, n))
    weight = np.where(toxic, rng.uniform(5.7, 8.8, n), rng.uniform(1.5, 5.2, n))
    words = np.where(rng.random(n) < 0.05, rng.integers(1, 10, n), rng.integers(50, 300, n))
    total = np.where(toxic & (rng.random(n) < 0.05), hits * 20, hits) * weight
    rows = np.column_stack((np.log1p(total), total / np.sqrt(words + 25.0),
                            np.where(hits > 0, weight, 0.0)))
    bias, *w = toxicity._calibrated(rows, toxic.astype(float))
    z = bias + rows @ np.array(w)
    assert z[toxic].min() > z[~toxic].max()
    slope = np.column_stack((np.ones(n), rows)).T @ (1 / (1 + np.exp(-z)) - toxic)
    assert np.abs(slope + np.array([1e-6, .05, .05, .05]) * [bias, *w]).max() < 1e-3


def test_ordinal_fit_is_the_least_loss():
    """Shares and scores against a count by hand, the fit's gradient against finite
    differences of the likelihood."""
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["good", "plain", "bad"], 30, p=[(0.1, 0.4, 0.7)[g], 0.2,
                                                                  (0.7, 0.4, 0.1)[g]]))
             for g in [0, 1, 2] * 60]
    grade = np.array([0, 1, 2] * 60)
    row, bucket, value = quality.features(texts)
    counts = Counter((int(r), int(b)) for rs, bs in quality.occurrences(texts)
                     for r, b in zip(rs, bs, strict=True))
    totals = Counter()
    for (r, _), n in counts.items():
        totals[r] += n
    assert {(int(r), int(b)): v for r, b, v in zip(row, bucket, value, strict=True)} == {
        (r, b): pytest.approx(quality.SCALE * n / totals[r]) for (r, b), n in counts.items()}
    w, theta = quality.fit_ordinal(row, bucket, value, grade, 3)
    assert np.allclose(quality.linear_scores(texts, w), np.bincount(
        row, w[bucket] * value, len(texts)))
    low = (grade[:, None] <= np.arange(2)).astype(float)

    def loss(w, theta):
        z = theta[None, :] - np.bincount(row, w[bucket] * value, len(texts))[:, None]
        return (np.logaddexp(0, z) - low * z).sum(axis=1).mean() + quality.RIDGE * (w @ w) / 2

    start = loss(np.zeros_like(w), np.zeros(2))
    assert theta[0] < theta[1] and loss(w, theta) < 0.5 * start
    used = np.unique(bucket)
    for direction in rng.standard_normal((20, len(used))):
        move = np.zeros_like(w)
        move[used] = direction / np.linalg.norm(direction)
        slope = (loss(w + 1e-4 * move, theta) - loss(w - 1e-4 * move, theta)) / 2e-4
        assert abs(slope) < 0.02
    for k in range(2):
        move = np.eye(2)[k] * 1e-4
        assert abs(loss(w, theta + move) - loss(w, theta - move)) / 2e-4 < 0.02


def test_learned_lexicon(spark, make):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(["sun", "moon", "river", "stone", "grumbling"], 30))
        if i % 3 == 0:
            words[7] = str(rng.choice(["grumpod", "grumfix", "grumlar"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(700, None), (701, "")]
    labels += [(700, 1), (1, 0), (3, 0), (5, None)]
    docs = make(rows)
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs, given)
    assert lexicon.weights.get(" grumbling ", 0.0) == 0.0 and " grum" not in lexicon.weights
    got = [r for r in toxicity.toxicity(docs, lexicon).collect() if r.doc_id < 600 and r.held_out]
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in got)
    bare = toxicity.learn_lexicon(docs, given.limit(0), entries={"stone": 2.0})
    assert bare.weights == {" stone ": 2.0}


# --- substrings


def test_shared_passage_goes(make):
    rng = np.random.default_rng(6)
    vocabulary = [f"{a}{b}" for a in "ka lo mi ru te sa vo".split() for b in "na pi dor sel".split()]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, clean = text(60), [text(300) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, f"{text(80 + i)} {passage} {text(70)}") for i in range(12)]
    rows += [(300, rows[0][1]), (301, f"{text(40)} {passage} {passage} {text(9)}")]
    out = {r.doc_id: r for r in sub.substring_dedup(make(rows)).collect()}
    assert len(out) == len(rows)
    given = dict(rows)
    for i in [*range(20), 100]:
        assert out[i].text == given[i] and out[i].removed_spans is None
    grams = lambda t, n=51: {tuple(t.split()[k:k + n]) for k in range(len(t.split()) - n + 1)}
    seen = grams(out[100].text)
    for i in [*range(101, 112), 301]:
        assert not grams(out[i].text) & seen and out[i].removed_spans
        assert len(out[i].text.split()) >= len(given[i].split()) - 125
    assert out[300].text == ""


def test_phrases_of_several_documents_stay(make):
    """Text whose parts all occur before, but never together, is not a copy."""
    rng = np.random.default_rng(11)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 100_000, n))
    parts = [text(30) for _ in range(8)]
    rows = [(i, f"{text(50)} {p} {text(50)}") for i, p in enumerate(parts)]
    passage = text(50)
    rows += [(100, " ".join(parts)), (101, f"{text(50)} {passage} {text(50)}"),
             (102, f"{text(20)} {passage} {text(20)}")]
    out = {r.doc_id: r for r in sub.substring_dedup(make(rows)).collect()}
    for i, t in rows[:-1]:
        assert out[i].text == t and out[i].removed_spans is None
    assert passage not in out[102].text and len(out[102].text.split()) == 40


def test_substring_odd_rows(make, odd):
    docs = make(odd)
    got = sub.substring_dedup(docs)
    assert got.columns == [c for c in docs.columns if c != "removed_spans"] + ["removed_spans"]
    rows = got.collect()
    assert len(rows) == len(odd) and unharmed(rows)
    text = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert text[1] == odd[0][1] and text[3] is None and text[4] == "" and text[7] == "x"
    assert sub.substring_dedup(make([])).count() == 0


def brute_substrings(rows, size=50):
    """What is left of each text, as words: passages seen in an earlier document go,
    and those that ended in the same document before they begin again."""
    seen, out = set(), {}
    word = re.compile("[\u2e80-\U0010ffff]|[^\\s\u2e80-\U0010ffff]+")
    for i, text in sorted(rows):
        words = word.findall(text or "")
        passages = [tuple(words[k:k + size]) for k in range(len(words) - size + 1)]
        own, gone = {}, set()
        for k, p in enumerate(passages):
            if p in seen or k - own.setdefault(p, k) >= size:
                gone.update(range(k, k + size))
        seen.update(passages)
        out[i] = [w for k, w in enumerate(words) if k not in gone]
    return out


def test_op9_against_brute_force(spark, documents):
    """The query, on all words of all documents."""
    word = re.compile("[\u2e80-\U0010ffff]|[^\\s\u2e80-\U0010ffff]+")
    got = {r.doc_id: word.findall(r.text or "") for r in op9_substring_dedup(
        spark, SMALL).collect()}
    assert got == brute_substrings([(r.doc_id, r.text) for r in documents.collect()])


def test_every_planted_passage_is_found(make):
    """Passages of just 50 words, also of one, two or three words again and again,
    at any place between other words."""
    rng = np.random.default_rng(2)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 50_000, n))
    phrases = [word(50) for _ in range(40)] + ["De, " * 50, "ho ho hum " * 16 + "ho ho",
                                               "ab cd " * 25, "x y z w v " * 10]
    rows = []
    for i, phrase in enumerate(phrases):
        for k in range(3):
            rows.append((10 * i + k, f"{word(int(rng.integers(1, 60)))} {phrase} "
                                     f"{word(int(rng.integers(1, 60)))}"))
    got = {r.doc_id: r.text.split() for r in sub.substring_dedup(make(rows)).collect()}
    assert got == brute_substrings(rows)
    given = dict(rows)
    assert all(len(got[10 * i + k]) <= len(given[10 * i + k].split()) - 50
               for i in range(len(phrases)) for k in (1, 2))


def test_chunks_cover_and_resist_shifts(monkeypatch):
    rng = np.random.default_rng(7)
    text = " ".join(rng.choice(["sea", "wind", "rock", "gull", "foam", "tide"], 4000))
    starts, ends, digests, words = sub.chunks(text)
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] == ends[:-1]).all()
    assert words.sum() == 4000
    moved = sub.chunks("an insertion of words " + text)[2]
    assert len(set(digests) - set(moved)) <= 4
    monkeypatch.setattr(sub.textual, "SLICE", 900)
    cut = sub.chunks(text)
    assert (cut[0] == starts).all() and (cut[2] == digests).all() and (cut[3] == words).all()


# --- pieces


def whole(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.chunk):
        out[r.doc_id].append(r)
    return out


@pytest.mark.parametrize("size", [40, 333, 32768])
def test_encoding_is_the_models(spark, documents, make, odd, library, size):
    rng = np.random.default_rng(8)
    letters = list("aeinorst ▁  \néß日本語😀123.,")
    rows = [(i, t) for i, t in odd if i is not None and i != 2 and (size > 40 or i != 6)]
    rows += [(100 + i, "".join(rng.choice(letters, rng.integers(1, 400)))) for i in range(60)]
    rows += [(200, "nospacebetweenthesewords" * 40), (201, "aaaaaaaaaa" * 30), (202, " " * 200),
             (203, "日本語のテキスト" * 40), (204, "x" * 39), (205, "x" * 40)]
    got = whole(sentencepiece_scan.decode(
        sentencepiece_scan.encode(make(rows), PIECES, size=size), PIECES).collect())
    for i, text in rows:
        parts = got[i]
        if text is None:
            assert [(r.ids, r.text) for r in parts] == [(None, None)]
            continue
        assert len(parts) == max(r.chunks for r in parts)
        ids = [x for r in parts for x in r.ids]
        assert ids == library.encode(text), (i, text)
        assert "".join(r.text for r in parts) == text.replace("▁", " ")


def test_levels_of_the_scan(make, library):
    text = "the long winding riverbank walks " * 60
    rows = [(1, text), (2, text), (3, text[:700]), (2, text)]
    got = sentencepiece_scan.encode(make(rows), PIECES, size=50, fanout=3).collect()
    for i, n in ((1, 1), (2, 2), (3, 1)):
        parts = sorted((r.chunk, r.ids) for r in got if r.doc_id == i)
        assert [x for _, ids in parts[::n] for x in ids] == library.encode(dict(rows)[i])
        assert len(parts) == n * -(-(len(dict(rows)[i]) + 1) // 50)
    assert sentencepiece_scan.encode(make([]), PIECES).count() == 0


def test_products_are_associative():
    lattice = sentencepiece_scan.Lattice(pieces_of(read_model(PIECES)))
    text = sentencepiece_scan.marked("unbelievablyinternationalisations" * 9)
    cuts = [sentencepiece_scan.Chunk(lattice, *rest).matrix()
            for _, *rest in sentencepiece_scan._cuts(text, 16, 30)]
    one = sentencepiece_scan.compose(cuts)
    for k in range(1, len(cuts)):
        both = [sentencepiece_scan.compose(cuts[:k]), sentencepiece_scan.compose(cuts[k:])]
        assert sorted(sentencepiece_scan.compose(both)) == sorted(one) == [("", "")]


def test_op8(spark, documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = whole(op8_sentencepiece(spark, SMALL).collect())
    for i, text in texts.items():
        assert [x for r in got[i] for x in r.ids] == library.encode(text)
        assert "".join(r.text for r in got[i]) == text


def test_all_operators_are_there():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 11))
