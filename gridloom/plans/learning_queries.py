"""Gradients, training and evaluation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gridloom.functions.texts import score_text
from gridloom.operators import evaluate, gradient, networks, training
from gridloom.plans.tables import CELLS_SQL, rounded, table
from gridloom.session import persist

CLASSES = 10
HIDDEN = 6
BATCHES = 4
LEARNING_RATE = 0.5
MOMENTUM = 0.5
TEST_SHARE = 5  # one row in so many is a test row


def _examples(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("features"), "label"
    )


def _width(examples):
    """The width that all rows have."""
    least, most = examples.agg(F.min(F.size("features")), F.max(F.size("features"))).first()
    if least != most:
        raise ValueError(f"features of {least} to {most} values")
    return most


def _rule(rows, columns):
    """Weights set by a rule, which the SQL twins follow."""
    i, j = np.indices((rows, columns))
    return ((i * 7 + j * 5) % 13 - 6) / 12.0


def softmax_gradient(spark, sf_dir):
    """Mean gradient of the zero-weight classifier, one row per parameter."""
    examples = _examples(spark, sf_dir)
    model = networks.softmax_model(_width(examples))
    _, grads, _ = gradient.step(
        examples.select("features", "label"), model, networks.softmax_gradient(),
        gradient.gradient_descent(LEARNING_RATE), do_desc=False,
    )
    return _gradient_frame(spark, grads)


def _gradient_frame(spark, grads):
    rows = [
        ("w", int(i), int(k), float(v)) for (i, k), v in np.ndenumerate(grads["w"])
    ] + [("b", 0, int(k), float(v)) for k, v in enumerate(grads["b"])]
    frame = spark.createDataFrame(rows, "param string, row int, class int, value double")
    return frame.select("param", "row", "class", rounded("value"))


def _rule_network(width):
    return {
        "w1": _rule(width, HIDDEN), "b1": _rule(HIDDEN, 2)[:, 1],
        "w2": _rule(HIDDEN, CLASSES), "b2": _rule(CLASSES, 3)[:, 2],
    }


def hidden_layer_gradient(spark, sf_dir):
    """Mean gradient of the one-hidden-layer network at weights set by a rule."""
    examples = _examples(spark, sf_dir).select("features", "label")

    model = _rule_network(_width(examples))
    _, grads, _ = gradient.loss_and_gradient(examples, model, networks.hidden_layer_gradient())
    rows = [
        (name, int(at[0]), int(at[1]), float(v))
        for name, g in grads.items() for at, v in np.ndenumerate(np.atleast_2d(g))
    ]
    frame = spark.createDataFrame(rows, "param string, row int, col int, value double")
    return frame.select("param", "row", "col", rounded("value"))


def mini_batch_losses(spark, sf_dir):
    """One epoch of momentum descent over four shuffled batches."""
    examples = _examples(spark, sf_dir)
    run = training.train_epochs(
        examples, networks.softmax_model(_width(examples)), networks.softmax_gradient(),
        gradient.Momentum(LEARNING_RATE, MOMENTUM), epochs=1,
        batch_size=math.ceil(examples.count() / BATCHES), key=["vec_id"], log_interval=1,
    )
    return run.history_frame(spark).select("epoch", "batch", "rows_seen", rounded("loss"))


def _descend(spark, sf_dir, desc, steps):
    """Losses before each of the steps, and the model after them."""
    examples = persist(_examples(spark, sf_dir).select("features", "label"))
    try:
        model, losses = networks.softmax_model(_width(examples)), []
        for _ in range(steps):
            loss, _, model = gradient.step(examples, model, networks.softmax_gradient(), desc)
            losses.append(loss)
    finally:
        examples.unpersist()
    return losses, model


def _loss_frame(spark, losses):
    frame = spark.createDataFrame(
        [(i, float(v)) for i, v in enumerate(losses)], "step int, loss double"
    )
    return frame.select("step", rounded("loss"))


def softmax_losses(spark, sf_dir):
    desc = gradient.gradient_descent(LEARNING_RATE)
    return _loss_frame(spark, _descend(spark, sf_dir, desc, 3)[0])


def momentum_losses(spark, sf_dir):
    desc = gradient.Momentum(LEARNING_RATE, MOMENTUM)
    return _loss_frame(spark, _descend(spark, sf_dir, desc, 4)[0])


def softmax_predictions(spark, sf_dir):
    _, model = _descend(spark, sf_dir, gradient.gradient_descent(LEARNING_RATE), 1)
    scored = evaluate.predict(
        _examples(spark, sf_dir), model, lambda x, p: networks.log_softmax(x @ p["w"] + p["b"])
    )
    of_label = F.element_at("logp", F.col("label") + 1)
    return scored.select(
        "vec_id", "prediction", evaluate.is_correct().alias("correct"),
        (F.round(of_label, 6) + F.lit(0.0)).alias("logp"),
    )


def _scored_by_rule(spark, sf_dir):
    """Class scores of all values of a vector, by weights set by a rule."""
    examples = _examples(spark, sf_dir)
    model = {"w": _rule(_width(examples), CLASSES)}
    return evaluate.predict(examples, model, lambda x, p: networks.log_softmax(x @ p["w"]))


def evaluation_report(spark, sf_dir):
    report = evaluate.score_report(_scored_by_rule(spark, sf_dir))
    return report.select(rounded("loss"), "correct", "total", rounded("accuracy"))


def evaluation_text(spark, sf_dir):
    report = evaluate.score_report(_scored_by_rule(spark, sf_dir))
    return report.select(score_text("loss", "correct", "total", "accuracy").alias("line"))


def prediction_accuracy(spark, sf_dir):
    return evaluate.accuracy(_scored_by_rule(spark, sf_dir)).select(rounded("accuracy"))


def evaluator_precision(spark, sf_dir):
    value = evaluate.precision(_scored_by_rule(spark, sf_dir))
    return spark.createDataFrame([(float(value),)], "precision double").select(rounded("precision"))


def _batched(examples, model, grad, desc, **options):
    """Epochs of four batches each, logged batch by batch."""
    return training.train_epochs(
        examples, model, grad, desc, batch_size=math.ceil(examples.count() / BATCHES), key=["vec_id"], log_interval=1,
        **options,
    )


def hidden_layer_history(spark, sf_dir):
    examples = _examples(spark, sf_dir)
    run = _batched(examples, _rule_network(_width(examples)), networks.hidden_layer_gradient(),
                   gradient.Momentum(LEARNING_RATE, MOMENTUM), epochs=1)
    return run.history_frame(spark).select("epoch", "batch", "rows_seen", "percent", rounded("loss"))


def hidden_layer_full_batch(spark, sf_dir):
    examples = persist(_examples(spark, sf_dir).select("features", "label"))
    try:
        run = training.train_epochs(
            examples, _rule_network(_width(examples)), networks.hidden_layer_gradient(),
            gradient.Momentum(LEARNING_RATE, MOMENTUM), epochs=3,
        )
    finally:
        examples.unpersist()
    return run.history_frame(spark).select("epoch", "rows_seen", rounded("loss"))


def _linear_scores(x, params):
    return networks.log_softmax(x @ params["w"] + params["b"])


def _two_epochs(spark, sf_dir):
    """Two epochs on four fifths of the rows, each tested on the others."""
    examples, other = _examples(spark, sf_dir), F.col("vec_id") % TEST_SHARE == 0
    return _batched(
        examples.where(~other), networks.softmax_model(_width(examples)), networks.softmax_gradient(),
        gradient.Momentum(LEARNING_RATE, MOMENTUM), epochs=2, test=examples.where(other), scores=_linear_scores,
    )


def epoch_reports(spark, sf_dir):
    report = _two_epochs(spark, sf_dir).report_frame(spark)
    return report.select("epoch", rounded("loss"), "correct", "total", rounded("accuracy"))


def training_log_lines(spark, sf_dir):
    return _two_epochs(spark, sf_dir).log_lines(spark)


def perceptron_predictions(spark, sf_dir):
    """The perceptron on features that tell the classes apart: what it must predict is known."""
    marks = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda k: F.when(k == F.col("label"), 10.0).otherwise(0.0))
    examples = _examples(spark, sf_dir).select(
        "vec_id", F.col("label").cast("double").alias("label"),
        array_to_vector(F.concat(F.col("features").cast("array<double>"), marks)).alias("features"),
    )
    train = persist(examples)
    try:
        width = _width(_examples(spark, sf_dir)) + CLASSES
        model = training.fit_perceptron(train, [width, 16, CLASSES], max_iter=12)
    finally:
        train.unpersist()
    return model.transform(examples).select("vec_id", "label", "prediction")


QUERIES = {
    f.__name__: f
    for f in (
        softmax_gradient, hidden_layer_gradient, mini_batch_losses, softmax_losses, momentum_losses, softmax_predictions,
        evaluation_report, evaluation_text, prediction_accuracy, evaluator_precision, hidden_layer_history,
        hidden_layer_full_batch, epoch_reports, training_log_lines, perceptron_predictions,
    )
}


_WEIGHT = "(({i} * 7 + {j} * 5) % 13 - 6) / 12.0::DOUBLE"


def _inputs_sql(train: str, epochs: int) -> list[str]:
    """Common tables ``inputs`` and ``batches``.

    Weights and biases are one table: the bias is the weight of a cell that is
    always 1, in row -1. Batches are those of the rows that are trained on.
    """
    orders = "\nUNION ALL ".join(
        f"""SELECT vec_id, {e} AS epoch,
  row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || ':1:{e}')) - 1 AS position
  FROM embeddings WHERE {train}"""
        for e in range(1, epochs + 1)
    )
    return [
        CELLS_SQL,
        f"""classes AS (SELECT CAST(unnest(range({CLASSES})) AS INTEGER) AS k)""",
        f"""placed AS ({orders})""",
        f"""batches AS (
  SELECT vec_id, epoch, position // CAST(ceil((SELECT count(*) FROM embeddings WHERE {train}) / {BATCHES}.0) AS BIGINT) AS batch
  FROM placed
)""",
        """inputs AS (
  SELECT vec_id, label, col, x FROM cells
  UNION ALL SELECT vec_id, label, -1, 1.0 FROM embeddings
)""",
    ]


def _step_inputs(i: int, batched: bool) -> str:
    if not batched:
        return f"inputs{i} AS (SELECT * FROM inputs)"
    return f"""inputs{i} AS (SELECT inputs.* FROM inputs JOIN batches USING (vec_id)
  WHERE epoch = {i // BATCHES + 1} AND batch = {i % BATCHES})"""


def _loss_parts(i: int) -> list[str]:
    """``logp<i>`` and ``loss<i>`` from ``scores<i>``."""
    return [
        f"""logp{i} AS (SELECT vec_id, label, k, s - ln(sum(exp(s)) OVER (PARTITION BY vec_id)) AS logp
  FROM scores{i})""",
        f"""loss{i} AS (SELECT {i} AS step, avg(-logp) AS loss, count(*) AS rows_in_step
  FROM logp{i} WHERE k = label)""",
    ]


def _descent_sql(
    steps: int, rate: float, momentum: float, *, batched: bool = False, epochs: int = 1, train: str = "TRUE"
) -> str:
    """Common tables ``loss<i>``, ``grad<i>`` and ``model<i>`` of softmax descent.

    With ``batched`` step ``i`` sees one batch only, four to an epoch.
    """
    parts = [
        *_inputs_sql(train, epochs),
        """model0 AS (SELECT col, k, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v
  FROM (SELECT DISTINCT col FROM inputs), classes)""",
    ]
    for i in range(steps):
        parts += [
            _step_inputs(i, batched),
            f"""scores{i} AS (SELECT vec_id, label, k, sum(x * w) AS s
  FROM inputs{i} JOIN model{i} USING (col) GROUP BY vec_id, label, k)""",
            *_loss_parts(i),
            f"""grad{i} AS (SELECT col, k,
  sum(x * (exp(logp) - CASE WHEN k = p.label THEN 1 ELSE 0 END))
  / (SELECT rows_in_step FROM loss{i}) AS g
  FROM inputs{i} JOIN logp{i} p USING (vec_id) GROUP BY col, k)""",
            f"""model{i + 1} AS (SELECT col, k, w - {rate} * (g + {momentum} * v) AS w,
  g + {momentum} * v AS v FROM model{i} JOIN grad{i} USING (col, k))""",
        ]
    return "WITH " + ",\n".join(parts)


def _hidden_descent_sql(steps: int, *, batched: bool) -> str:
    """Common tables ``loss<i>`` of descent with one hidden layer from the rule's weights.

    The layer's biases are the weights of row -1, in which every input is 1.
    """
    parts = [
        *_inputs_sql("TRUE", 1),
        f"""units AS (SELECT CAST(unnest(range({HIDDEN})) AS INTEGER) AS j)""",
        f"""first0 AS (SELECT col, j, CASE WHEN col < 0 THEN {_WEIGHT.format(i="j", j="1")}
  ELSE {_WEIGHT.format(i="col", j="j")} END AS w, 0.0::DOUBLE AS v
  FROM (SELECT DISTINCT col FROM inputs), units)""",
        f"""second0 AS (SELECT j, k, CASE WHEN j < 0 THEN {_WEIGHT.format(i="k", j="2")}
  ELSE {_WEIGHT.format(i="j", j="k")} END AS w, 0.0::DOUBLE AS v
  FROM (SELECT j FROM units UNION ALL SELECT -1), classes)""",
    ]
    for i in range(steps):
        update = f"w - {LEARNING_RATE} * (g + {MOMENTUM} * v) AS w, g + {MOMENTUM} * v AS v"
        parts += [
            _step_inputs(i, batched),
            f"""hidden{i} AS (SELECT vec_id, label, j, sum(x * w) AS a, greatest(sum(x * w), 0) AS h
  FROM inputs{i} JOIN first{i} USING (col) GROUP BY vec_id, label, j
  UNION ALL SELECT DISTINCT vec_id, label, -1, 0.0, 1.0 FROM inputs{i})""",
            f"""scores{i} AS (SELECT vec_id, label, k, sum(h * w) AS s
  FROM hidden{i} JOIN second{i} USING (j) GROUP BY vec_id, label, k)""",
            *_loss_parts(i),
            f"""errors{i} AS (SELECT vec_id, k, exp(logp) - CASE WHEN k = label THEN 1 ELSE 0 END AS e FROM logp{i})""",
            f"""back{i} AS (SELECT vec_id, j, CASE WHEN any_value(a) > 0 THEN sum(e * w) ELSE 0 END AS d
  FROM hidden{i} JOIN errors{i} USING (vec_id) JOIN second{i} USING (j, k) WHERE j >= 0 GROUP BY vec_id, j)""",
            f"""first{i + 1} AS (SELECT col, j, {update} FROM first{i} JOIN (
  SELECT col, j, sum(x * d) / (SELECT rows_in_step FROM loss{i}) AS g
  FROM inputs{i} JOIN back{i} USING (vec_id) GROUP BY col, j) USING (col, j))""",
            f"""second{i + 1} AS (SELECT j, k, {update} FROM second{i} JOIN (
  SELECT j, k, sum(h * e) / (SELECT rows_in_step FROM loss{i}) AS g
  FROM hidden{i} JOIN errors{i} USING (vec_id) GROUP BY j, k) USING (j, k))""",
        ]
    return "WITH " + ",\n".join(parts)


def _losses_sql(steps: int, momentum: float) -> str:
    union = "\nUNION ALL ".join(
        f"SELECT CAST(step AS INTEGER) AS step, round(loss, 6) + 0.0 AS loss FROM loss{i}"
        for i in range(steps)
    )
    return f"{_descent_sql(steps, LEARNING_RATE, momentum)}\n{union}"


def _steps_sql(steps: int) -> str:
    """``(epoch, batch, rows_seen, loss, step)`` of all steps, four to an epoch."""
    union = "\nUNION ALL ".join(f"SELECT * FROM loss{i}" for i in range(steps))
    return f"""(SELECT step, CAST(step // {BATCHES} + 1 AS INTEGER) AS epoch, CAST(step % {BATCHES} AS INTEGER) AS batch, loss,
  CAST(coalesce(sum(rows_in_step) OVER (PARTITION BY step // {BATCHES} ORDER BY step
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rows_seen
FROM ({union}))"""


_TRAINED = f"vec_id % {TEST_SHARE} <> 0"


def _reports_sql() -> str:
    union = "\nUNION ALL ".join(
        f"""SELECT {e} AS epoch, avg(-own) AS loss, count(*) AS total,
  CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct
FROM (SELECT vec_id, label, max(CASE WHEN k = label THEN logp END) AS own, arg_max(k, logp) AS prediction
  FROM (SELECT vec_id, label, k, s - ln(sum(exp(s)) OVER (PARTITION BY vec_id)) AS logp
    FROM (SELECT vec_id, label, k, sum(x * w) AS s FROM inputs JOIN model{e * BATCHES} USING (col)
      WHERE NOT ({_TRAINED}) GROUP BY vec_id, label, k))
  GROUP BY vec_id, label)"""
        for e in (1, 2)
    )
    descent = _descent_sql(2 * BATCHES, LEARNING_RATE, MOMENTUM, batched=True, epochs=2, train=_TRAINED)
    return f"""{descent}
SELECT CAST(epoch AS INTEGER) AS epoch, round(loss, 6) + 0.0 AS loss, correct, total,
       round(correct * 100.0::DOUBLE / total, 6) + 0.0 AS accuracy FROM ({union})"""


def _log_lines_sql() -> str:
    descent = _descent_sql(2 * BATCHES, LEARNING_RATE, MOMENTUM, batched=True, epochs=2, train=_TRAINED)
    return f"""{descent}
SELECT epoch, batch, printf('Train Epoch: %d [%d/%d (%.0f%%)]' || chr(9) || 'Loss: %.6f', epoch, rows_seen,
  (SELECT count(*) FROM embeddings WHERE {_TRAINED}), batch * 100.0::DOUBLE / {BATCHES}, loss) AS line
FROM {_steps_sql(2 * BATCHES)}"""


_HIDDEN_SQL = f"""WITH {CELLS_SQL},
units AS (SELECT CAST(unnest(range({HIDDEN})) AS INTEGER) AS j),
classes AS (SELECT CAST(unnest(range({CLASSES})) AS INTEGER) AS k),
active AS (
  SELECT vec_id, label, j, sum(x * {_WEIGHT.format(i="col", j="j")}) + {_WEIGHT.format(i="j", j="1")} AS a
  FROM cells, units GROUP BY vec_id, label, j
),
hidden AS (SELECT vec_id, label, j, a, greatest(a, 0) AS h FROM active),
scores AS (
  SELECT vec_id, label, k, sum(h * {_WEIGHT.format(i="j", j="k")}) + {_WEIGHT.format(i="k", j="2")} AS s
  FROM hidden, classes GROUP BY vec_id, label, k
),
errors AS (
  SELECT vec_id, k, exp(s) / sum(exp(s)) OVER (PARTITION BY vec_id)
         - CASE WHEN k = label THEN 1 ELSE 0 END AS e FROM scores
),
back AS (
  SELECT vec_id, j, CASE WHEN any_value(a) > 0 THEN sum(e * {_WEIGHT.format(i="j", j="k")}) ELSE 0 END AS d
  FROM hidden JOIN errors USING (vec_id) GROUP BY vec_id, j
),
n AS (SELECT count(*) AS n FROM embeddings),
grads AS (
  SELECT 'w1' AS param, col AS row, j AS col, sum(x * d) AS g
    FROM cells JOIN back USING (vec_id) GROUP BY cells.col, j
  UNION ALL SELECT 'b1', 0, j, sum(d) FROM back GROUP BY j
  UNION ALL SELECT 'w2', j, k, sum(h * e) FROM hidden JOIN errors USING (vec_id) GROUP BY j, k
  UNION ALL SELECT 'b2', 0, k, sum(e) FROM errors GROUP BY k
)
SELECT param, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
       round(g / n, 6) + 0.0 AS value
FROM grads, n"""


_RULE_SCORES = f"""WITH {CELLS_SQL},
classes AS (SELECT CAST(unnest(range({CLASSES})) AS INTEGER) AS k),
scores AS (
  SELECT vec_id, label, k, sum(x * {_WEIGHT.format(i="col", j="k")}) AS s
  FROM cells, classes GROUP BY vec_id, label, k
),
logp AS (SELECT vec_id, label, k, s - ln(sum(exp(s)) OVER (PARTITION BY vec_id)) AS logp FROM scores),
scored AS (
  SELECT vec_id, label, max(CASE WHEN k = label THEN logp END) AS own,
         arg_max(k, logp) AS prediction
  FROM logp GROUP BY vec_id, label
)"""

SQL = {
    "softmax_gradient": f"""{_descent_sql(1, LEARNING_RATE, 0.0)}
SELECT CASE WHEN col < 0 THEN 'b' ELSE 'w' END AS param, CAST(greatest(col, 0) AS INTEGER) AS row,
       k AS class, round(g, 6) + 0.0 AS value
FROM grad0""",
    "hidden_layer_gradient": _HIDDEN_SQL,
    "mini_batch_losses": f"""{_descent_sql(BATCHES, LEARNING_RATE, MOMENTUM, batched=True)}
SELECT epoch, batch, rows_seen, round(loss, 6) + 0.0 AS loss FROM {_steps_sql(BATCHES)}""",
    "hidden_layer_history": f"""{_hidden_descent_sql(BATCHES, batched=True)}
SELECT epoch, batch, rows_seen, batch * 100.0::DOUBLE / {BATCHES} AS percent, round(loss, 6) + 0.0 AS loss
FROM {_steps_sql(BATCHES)}""",
    "hidden_layer_full_batch": f"""{_hidden_descent_sql(3, batched=False)}
SELECT CAST(step + 1 AS INTEGER) AS epoch, rows_in_step AS rows_seen, round(loss, 6) + 0.0 AS loss
FROM (SELECT * FROM loss0 UNION ALL SELECT * FROM loss1 UNION ALL SELECT * FROM loss2)""",
    "epoch_reports": _reports_sql(),
    "training_log_lines": _log_lines_sql(),
    "perceptron_predictions": """SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(label AS DOUBLE) AS prediction
FROM embeddings""",
    "softmax_losses": _losses_sql(3, 0.0),
    "momentum_losses": _losses_sql(4, MOMENTUM),
    "softmax_predictions": f"""{_descent_sql(2, LEARNING_RATE, 0.0)}
SELECT vec_id, CAST(arg_max(k, logp) AS INTEGER) AS prediction,
       arg_max(k, logp) = any_value(label) AS correct,
       round(max(CASE WHEN k = label THEN logp END), 6) + 0.0 AS logp
FROM logp1 GROUP BY vec_id""",
    "evaluation_report": f"""{_RULE_SCORES}
SELECT round(avg(-own), 6) + 0.0 AS loss,
       CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       count(*) AS total,
       round(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 6)
       + 0.0 AS accuracy
FROM scored""",
    "evaluation_text": f"""{_RULE_SCORES},
report AS (
  SELECT avg(-own) AS loss, count(*) AS total,
         CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct
  FROM scored
)
SELECT printf('Test set: Average loss: %.4f, Accuracy: %d/%d (%.0f%%)', loss, correct, total,
              correct * 100.0::DOUBLE / total) AS line FROM report""",
    "prediction_accuracy": f"""{_RULE_SCORES}
SELECT round(avg(CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0 END), 6) + 0.0 AS accuracy
FROM scored""",
    "evaluator_precision": f"""{_RULE_SCORES}
SELECT round(avg(CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0 END), 6) + 0.0 AS precision
FROM scored""",
}
