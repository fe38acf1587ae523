"""The two networks against plain forward passes and finite differences, with noisy labels."""

import numpy as np
import pytest

from gridloom.llm import learning, quality, toxicity
from test_llm import rows_of


class Grab:
    """Keeps the gradients instead of taking a step."""

    def step(self, gradients):
        self.gradients = gradients


def trained(kind, module, n=200, epochs=2):
    return module.train(list(rows_of(kind, n, 1)), epochs=epochs)


def plain_toxicity(w, text):
    """The logit by loops over words, filters and places."""
    words = toxicity.words_of(text)
    vectors = [w["table"][toxicity.hashes_of(word)].sum(axis=0) for word in words]
    vectors += [np.zeros(toxicity.SIZE)] * max(toxicity.WIDTHS)
    pooled = []
    for width in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            best = max(
                sum(vectors[at + i] @ w[f"filter{width}"][i][:, f] for i in range(width)) + w[f"shift{width}"][f]
                for at in range(len(words) + 1)
            )
            pooled.append(max(best, 0))
    return np.array(pooled) @ w["out"] + w["bias"][0]


def plain_quality(w, text):
    """The logit by loops over places, halves and chunks."""
    data = quality.padded(text.encode())
    steps = [w["bytes"][list(data[at:at + quality.STEP])].reshape(-1) for at in range(0, len(data), quality.STEP)]
    steps.append(w["bytes"][[0] * quality.STEP].reshape(-1))
    responses = [np.maximum(a @ w["first"] + b @ w["second"] + w["shift"], 0) for a, b in zip(steps, steps[1:])]
    halves = [np.array(responses[at:at + quality.HALF]) for at in range(0, len(responses), quality.HALF)]
    values = []
    for a, b in zip(halves, halves[1:]):
        features = np.r_[np.maximum(a.max(axis=0), b.max(axis=0)), (a.mean(axis=0) + b.mean(axis=0)) / 2]
        values.append(np.maximum(features @ w["hidden"] + w["hidden_shift"], 0) @ w["value"])
    return np.array([max(values), np.mean(values), 1]) @ w["out"]


@pytest.mark.parametrize("kind, module, plain", [("toxic", toxicity, plain_toxicity), ("quality", quality, plain_quality)])
def test_scores_are_those_of_a_plain_forward_pass(kind, module, plain):
    model = trained(kind, module)
    texts = ["", "a", "two words", *(t for t, _, _ in rows_of(kind, 25, 4)), "é " * 300]
    scores = module._Scorer(model).scores(texts)
    wanted = [learning.sigmoid(plain(model.weights, t) - model.shift) for t in texts]
    assert np.allclose(scores, wanted, atol=1e-4)


@pytest.mark.parametrize("kind, module", [("toxic", toxicity), ("quality", quality)])
def test_a_score_does_not_depend_on_the_documents_beside_it(kind, module):
    model = trained(kind, module)
    texts = [t for t, _, _ in rows_of(kind, 150, 7)] + ["", "x"]
    scorer = module._Scorer(model)
    together, back = scorer.scores(texts), scorer.scores(texts[::-1])[::-1]
    alone = np.array([scorer.scores([t])[0] for t in texts])
    assert np.abs(together - alone).max() < 1e-5 and np.abs(back - alone).max() < 1e-5


def losses(module, w, docs, labels, weight):
    logits = np.array([(_logit_of(module, w, d)) for d in docs])
    p = learning.sigmoid(logits)
    return float((-weight * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / len(docs))


def _logit_of(module, w, doc):
    return module._logit(w, [doc])[0] if module is quality else module._raw(toxicity.Model(w), [doc])[0]


@pytest.mark.parametrize("kind, module", [("toxic", toxicity), ("quality", quality)])
def test_gradients_match_finite_differences(kind, module):
    rng = np.random.default_rng(2)
    w = trained(kind, module, 120, 1).weights
    rows = list(rows_of(kind, 12, 5))
    labels = np.array([r[1] for r in rows])
    grab = Grab()
    if module is quality:
        docs = [np.frombuffer(quality.padded(r[0].encode()), np.uint8) for r in rows]
        weight = np.where(labels == 1, 0.7, 1.6)
        quality._learn(w, grab, docs, labels, weight)
    else:
        docs = [np.array([toxicity.hashes_of(x) for x in toxicity.words_of(r[0])], np.int64) for r in rows]
        weight = np.where(labels == 1, 1.6, 0.7)
        toxicity._learn(toxicity.Model(w), grab, docs, labels, {0: 0.7, 1: 1.6})
    close = total = 0
    for name, g in grab.gradients.items():
        g = np.asarray(g)
        places = np.argwhere(np.abs(g) > 0.05 * np.abs(g).max())
        for at in map(tuple, places[rng.permutation(len(places))[:12]]):
            kept, step = w[name][at], 2e-3
            w[name][at] = kept + step
            up = losses(module, w, docs, labels, weight)
            w[name][at] = kept - step
            down = losses(module, w, docs, labels, weight)
            w[name][at] = kept
            total += 1
            close += abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-4
    assert close > 0.9 * total  # a step may cross a kink of a maximum


@pytest.mark.parametrize("flipped", [0.02, 0.05])
@pytest.mark.parametrize("kind, module, caught, least", [("toxic", toxicity, 1, 0.85), ("quality", quality, 0, 0.8)])
def test_noisy_labels_do_not_move_the_cut_away(kind, module, caught, least, flipped):
    rng = np.random.default_rng(6)
    rows = [(t, 1 - y if rng.random() < flipped else y, lang) for t, y, lang in rows_of(kind, 1500, 1)]
    model = module.train(rows)
    held = list(rows_of(kind, 400, 2))
    scores = module._Scorer(model).scores([h[0] for h in held])
    labels, cut = np.array([h[1] for h in held]), scores >= module.CUT
    assert (cut[labels == caught] == caught).mean() >= least
    assert (cut[labels != caught] != caught).mean() >= 0.97


def test_the_sparing_threshold_has_a_bound():
    scores, labels = np.r_[np.linspace(0, 1, 1000), np.linspace(2, 3, 1000)], np.repeat([0, 1], 1000)
    assert 1 < learning.sparing_threshold(scores, labels, 0.995, 0.9) < 2
    labels[-40:] = 0  # the highest scores are marked as label 0
    cut = learning.sparing_threshold(scores, labels, 0.995, 0.9)
    caught = (scores >= cut) & (labels == 1)
    assert cut < 2.15 and caught.sum() >= 0.9 * (labels == 1).sum() - 1


def test_words_of_few_documents_are_held_at_a_time(monkeypatch):
    monkeypatch.setattr(toxicity, "BATCH_WORDS", 10)
    held = list(toxicity._held_words(["a b c"] * 7 + ["d " * 30] + [""]))
    assert [(at, [len(d) for d in docs]) for at, docs in held] == [(0, [3, 3, 3]), (3, [3, 3, 3]), (6, [3]), (7, [30]), (8, [0])]


def test_toxicity_learns_from_rows_that_no_sample_holds(spark):
    """A word that only documents longer than the sample's show as toxic counts, and so do held-back rows."""
    rng = np.random.default_rng(4)
    calm = ["bade", "filo", "gumi", "kote", "rasu", "tive", "nolu", "dako"]
    rows, labels = [], []
    for i in range(700):
        long, toxic = i % 2 == 1, i // 2 % 2
        words = rng.choice(calm, 1800 if long else 40).tolist()
        if toxic:
            for at in rng.choice(len(words), 400 if long else 4, replace=False):
                words[at] = "zwormful" if long else "scoundrel"
        rows.append((i, " ".join(words), "en"))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert docs.where(f"octet_length(text) > {learning.SAMPLE_BYTES}").count() == 350
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = toxicity._Scorer(model).scores([" ".join(calm * 5), " ".join([*calm * 5, "scoundrel"]),
                                             " ".join([*calm * 5, "zwormful"])])
    assert scores[0] < toxicity.CUT <= min(scores[1:])


def test_cuts_by_counts_are_those_of_the_rows():
    rng = np.random.default_rng(3)
    labels = rng.random(5000) < 0.2
    bins = np.round(rng.standard_normal(5000) + 2 * labels, 1)
    values = np.unique(bins)
    ones, zeros = ([int((bins[labels == y] == v).sum()) for v in values] for y in (True, False))
    cut = learning.best_cut(values, np.array(zeros), np.array(ones))
    f1 = {v: 2 * (labels & (bins > v)).sum() / ((bins > v).sum() + labels.sum()) for v in values}
    assert (bins > cut).sum() == (bins > max(f1, key=f1.get)).sum()
    sparing = learning.sparing_cut(values, np.array(zeros), np.array(ones), 0.995, 0.9)
    best = bins[labels & (bins >= cut)]
    assert cut <= sparing and (best >= sparing).mean() >= 0.9


@pytest.fixture(scope="module")
def many(spark):
    """900 rows in two kinds of words, 700 of them labelled."""
    rng = np.random.default_rng(6)
    calm = ["bade", "filo", "gumi", "kote", "rasu", "tive", "nolu", "dako"]
    rows = [(i, " ".join(rng.choice([*calm, "scoundrel"] if i % 3 == 0 else calm, 20).tolist()), "en") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(700)], "doc_id long, toxic int")


def test_toxicity_moves_labelled_texts_only(spark, many, monkeypatch):
    """Labels beyond Spark's own bound for broadcasts, but few: no text without a label is shuffled."""
    plans, learn = [], toxicity._round

    def seen(weights, rows, balance):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return learn(weights, rows, balance)

    monkeypatch.setattr(toxicity, "_round", seen)
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.fit(*many)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert plans and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)
