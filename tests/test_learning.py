import math
import os

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gridloom.operators import batches, evaluate, gradient, networks, training
from gridloom.plans import flows


@pytest.fixture(scope="module")
def examples(spark):
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 4, 240)
    centres = rng.normal(0, 2, (4, 6))
    rows = [
        (i, (centres[y] + rng.normal(0, 1, 6)).tolist(), int(y)) for i, y in enumerate(labels)
    ]
    return spark.createDataFrame(rows, "i int, features array<double>, label int").repartition(5).cache()


def batch_of(df):
    rows = df.collect()
    return {
        "features": np.array([r["features"] for r in rows]),
        "label": np.array([r["label"] for r in rows]),
    }


@pytest.mark.parametrize("net", ["softmax", "hidden"])
def test_gradient_matches_finite_differences(spark, examples, net):
    rng = np.random.default_rng(1)
    if net == "softmax":
        model, grad = networks.softmax_model(6, 4), networks.softmax_gradient()
        model = {k: v + rng.normal(0, 0.1, v.shape) for k, v in model.items()}
    else:
        model, grad = networks.hidden_layer_model(6, 5, 4), networks.hidden_layer_gradient()
    batch = batch_of(examples)
    n = len(batch["label"])
    loss, grads, rows = gradient.loss_and_gradient(examples, model, grad)
    assert rows == n
    assert loss == pytest.approx(grad(batch, model)[0] / n)
    for name, value in model.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        moved = {k: v.copy() for k, v in model.items()}
        moved[name][at] += 1e-5
        up = grad(batch, moved)[0] / n
        moved[name][at] -= 2e-5
        down = grad(batch, moved)[0] / n
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_parameters_beyond_one_chunk(spark, examples, monkeypatch):
    monkeypatch.setattr(gradient, "CHUNK", 7)
    model, grad = networks.hidden_layer_model(6, 5, 4), networks.hidden_layer_gradient()
    batch = batch_of(examples)
    _, grads, n = gradient.loss_and_gradient(examples, model, grad)
    for name, value in grad(batch, model)[1].items():
        assert np.allclose(grads[name], value / n)


def test_zero_weights_lose_ln_classes(spark, examples):
    loss, _, _ = gradient.loss_and_gradient(
        examples, networks.softmax_model(6, 4), networks.softmax_gradient()
    )
    assert loss == pytest.approx(math.log(4))


def test_step(spark, examples):
    model, grad = networks.softmax_model(6, 4), networks.softmax_gradient()
    desc = gradient.gradient_descent(0.1)
    loss, grads, updated = gradient.step(examples, model, grad, desc)
    assert loss == pytest.approx(math.log(4))
    assert not model["w"].any()
    assert np.allclose(updated["w"], -0.1 * grads["w"])
    _, _, same = gradient.step(examples, model, grad, desc, do_desc=False)
    assert same is model
    half, _, _ = gradient.step(examples, model, grad, desc, count=480)
    assert half == pytest.approx(math.log(4) / 2)
    with pytest.raises(ValueError):
        gradient.step(examples.where("i < 0"), model, grad, desc)


def test_row_gradient_equals_batch_gradient(spark, examples):
    def one_row(row, params):
        batch = {"features": row["features"][None, :], "label": np.array([row["label"]])}
        return networks.softmax_gradient()(batch, params)

    model = networks.softmax_model(6, 4)
    by_batch = gradient.loss_and_gradient(examples, model, networks.softmax_gradient())
    by_row = gradient.loss_and_gradient(examples, model, gradient.row_gradient(one_row))
    assert by_row[0] == pytest.approx(by_batch[0])
    assert np.allclose(by_row[1]["w"], by_batch[1]["w"])


def test_gradient_shapes(spark, examples):
    model = networks.softmax_model(6, 4)

    def only_bias(batch, params):
        loss, grads = networks.softmax_gradient()(batch, params)
        return loss, {"b": grads["b"]}

    _, grads, _ = gradient.loss_and_gradient(examples, model, only_bias)
    assert grads["b"].any() and not grads["w"].any()
    with pytest.raises(Exception, match="shape"):
        gradient.loss_and_gradient(examples, model, lambda b, p: (0.0, {"b": np.zeros(3)}))
    with pytest.raises(Exception, match="unknown"):
        gradient.loss_and_gradient(examples, model, lambda b, p: (0.0, {"c": np.zeros(4)}))


def test_vector_features_are_accepted(spark, examples):
    as_vectors = examples.select(array_to_vector("features").alias("features"), "label")
    model, grad = networks.softmax_model(6, 4), networks.softmax_gradient()
    assert gradient.loss_and_gradient(as_vectors, model, grad)[2] == 240
    scored = evaluate.predict(as_vectors, model, lambda x, p: networks.log_softmax(x @ p["w"] + p["b"]))
    assert scored.first()["logp"] == pytest.approx([-math.log(4)] * 4)


def test_model_size_is_checked(spark, examples, monkeypatch):
    monkeypatch.setattr(gradient, "MODEL_BYTES_LIMIT", 100)
    with pytest.raises(ValueError, match="too large"):
        gradient.loss_and_gradient(examples, networks.softmax_model(6, 4), networks.softmax_gradient())


def test_momentum():
    desc = gradient.Momentum(0.1, 0.5)
    model, g = {"w": np.array([1.0])}, {"w": np.array([2.0])}
    model = desc(model, g)
    assert model["w"] == pytest.approx([0.8])
    assert desc(model, g)["w"] == pytest.approx([0.8 - 0.1 * 3.0])


def test_full_batch_training_lowers_the_loss(spark, examples):
    run = training.train_epochs(
        examples, networks.softmax_model(6, 4), networks.softmax_gradient(),
        gradient.gradient_descent(0.1), epochs=5,
    )
    losses = [h[4] for h in run.history]
    assert losses == sorted(losses, reverse=True)


def test_mini_batch_training(spark, examples):
    def train(seed):
        return training.train_epochs(
            examples, networks.hidden_layer_model(6, 8, 4, seed=2),
            networks.hidden_layer_gradient(), gradient.Momentum(0.1, 0.5),
            epochs=2, batch_size=64, key=["i"], seed=seed, log_interval=2,
        )

    run = train(3)
    history = run.history_frame(spark).collect()
    assert [(h["epoch"], h["batch"], h["rows_seen"]) for h in history] == [
        (1, 0, 0), (1, 2, 128), (2, 0, 0), (2, 2, 128),
    ]
    assert np.allclose(train(3).model["w1"], run.model["w1"])
    report = training.evaluate_epoch(examples, run.model, networks.hidden_layer_scores).first()
    assert report["total"] == 240 and report["accuracy"] > 70
    with pytest.raises(ValueError):
        training.train_epochs(
            examples, run.model, networks.hidden_layer_gradient(), gradient.Momentum(), batch_size=8
        )


def test_score_report_weighs_rows(spark):
    df = spark.createDataFrame(
        [([math.log(0.9), math.log(0.1)], 0), ([math.log(0.8), math.log(0.2)], 1)],
        "logp array<double>, label int",
    )
    row = evaluate.score_report(df).first()
    assert row["loss"] == pytest.approx(-(math.log(0.9) + math.log(0.2)) / 2)
    assert (row["correct"], row["total"], row["accuracy"]) == (1, 2, 50.0)


def test_precision_is_accuracy(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (1.0, 0), (2.0, 2)], "prediction double, label int")
    assert evaluate.precision(df) == pytest.approx(0.75)
    assert evaluate.accuracy(df).first()["accuracy"] == pytest.approx(0.75)


def test_train_and_evaluate_from_csv(spark, tmp_path):
    rng = np.random.default_rng(6)
    for name, n in (("train.csv", 300), ("test.csv", 100)):
        labels = rng.integers(0, 2, n)
        pixels = np.clip(labels[:, None] * 150 + rng.integers(0, 100, (n, 5)), 0, 255)
        lines = [",".join(map(str, [y, *row])) for y, row in zip(labels, pixels)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    fitted = flows.train_and_evaluate(
        spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"), [5, 4, 2], max_iter=50
    )
    assert fitted.precision > 0.95
    assert fitted.predictions.columns == ["prediction", "label"]


def test_batches_of_a_written_epoch(spark, tmp_path):
    rows = spark.range(1003).select("id", (F.col("id") % 7).alias("k")).repartition(5)
    folder = str(tmp_path / "epoch")
    written = batches.WrittenEpoch(rows, ["k"], 100, folder, seed=2, epoch=3)
    assert (written.total, written.n_batches) == (1003, 11)
    exact = batches.exact_batches(rows, ["k"], 100, seed=2, epoch=3)
    wanted = {}
    for r in exact.collect():
        wanted.setdefault(r["batch"], set()).add(r["id"])
    for b in range(11):
        own = written.batch(b)
        assert own.columns == rows.columns
        assert sorted(r["id"] for r in own.collect()) == sorted(wanted[b])
    plan = written.batch(4)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(__mark" in plan and "LessThanOrEqual(__mark" in plan
    assert batches.WrittenEpoch(rows.limit(0), ["k"], 100, str(tmp_path / "none")).n_batches == 0


def test_epochs_are_written_once_and_tested(spark, examples, monkeypatch):
    writes = []
    made = training.new_work_folder
    monkeypatch.setattr(training, "new_work_folder", lambda *a: writes.append(made(*a)) or writes[-1])
    train, test = examples.where("i % 4 <> 0"), examples.where("i % 4 = 0")
    run = training.train_epochs(
        train, networks.hidden_layer_model(6, 8, 4, seed=2), networks.hidden_layer_gradient(), gradient.Momentum(0.1, 0.5),
        epochs=3, batch_size=50, key=["i"], log_interval=1, test=test, scores=networks.hidden_layer_scores,
    )
    assert len(writes) == 3 and not any(os.path.exists(w) for w in writes)
    reports = run.report_frame(spark).collect()
    assert [r["epoch"] for r in reports] == [1, 2, 3] and {r["total"] for r in reports} == {60}
    last = training.evaluate_epoch(test, run.model, networks.hidden_layer_scores).first()
    assert tuple(reports[-1])[1:] == pytest.approx(tuple(last))
    lines = [r["line"] for r in run.log_lines(spark).orderBy("epoch", "batch").collect()]
    assert lines[1].startswith("Train Epoch: 1 [50/180 (25%)]\tLoss: ") and len(lines) == 12
    full = training.train_epochs(train, networks.softmax_model(6, 4), networks.softmax_gradient(), gradient.gradient_descent(0.1),
                                 epochs=2, test=test, scores=lambda x, p: networks.log_softmax(x @ p["w"] + p["b"]))
    assert len(full.reports) == 2 and full.total == 180
    with pytest.raises(ValueError):
        training.train_epochs(train, run.model, networks.hidden_layer_gradient(), gradient.Momentum(), test=test)
