"""Views of the driver tables in the shapes the operators consume.

``events`` is read as a dialogue (user = view/click, model = purchase/error,
signup plays the unknown sender, value < 20 is a blank turn) and as evaluation
events of training runs. These adapters only project and number rows; the
work stays proportional to the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.spread import blocked_row_number

# Event types read as dialogue roles.
USER_EVENTS = ("view", "click")
MODEL_EVENTS = ("purchase", "error")
BLANK_BELOW = 20.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def value_text(value: F.Column) -> F.Column:
    """Engine-independent text for a 2-decimal double: hundredths as an integer."""
    return F.round(value * 100).cast("long").cast("string")


def events_as_dialogue(events: DataFrame) -> DataFrame:
    """Raw dialogue turns ``(conv_id, turn, role, content)`` from ``events``; content
    is '' for blank turns so blank handling can be applied per mode."""
    role = (
        F.when(F.col("event_type").isin(*USER_EVENTS), F.lit("user"))
        .when(F.col("event_type").isin(*MODEL_EVENTS), F.lit("model"))
    )
    text = F.when(F.col("value") < BLANK_BELOW, F.lit("")).otherwise(
        F.concat(F.col("event_type"), F.lit(":"), value_text(F.col("value")))
    )
    rows = events.select(F.col("user_id").alias("conv_id"), "ts", "event_id", role.alias("role"), text.alias("content"))
    numbered = _numbered(rows, "conv_id", "n").select("conv_id", (F.col("n") - 1).alias("turn"), "role", "content")
    return numbered.where(F.col("role").isNotNull())


def eval_events(events: DataFrame) -> DataFrame:
    """Evaluation events ``(run_id, step, eval_loss)``: run = user, step = 1-based order."""
    rows = events.select(F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("eval_loss"))
    return _numbered(rows, "run_id", "step").select("run_id", "step", "eval_loss")


def restarted_evals(events: DataFrame) -> DataFrame:
    """Evaluation events of restarted trainings ``(run_id, arrival, at, step, eval_loss)``: run =
    user, arrival = 1-based order, step = minute of the day, so steps go back every day."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    step = F.floor((seconds % 86_400) / 60).cast("long")
    rows = events.select(F.col("user_id").alias("run_id"), "ts", "event_id", step.alias("step"), F.col("value").alias("eval_loss"))
    return _numbered(rows, "run_id", "arrival").select("run_id", "arrival", F.col("ts").cast("timestamp").alias("at"), "step", "eval_loss")


# How event types stand in for trainer log metrics.
METRIC_OF_EVENT = {"view": "loss", "click": "grad_norm", "purchase": "eval_loss", "error": "learning_rate", "signup": "epoch"}


def run_metrics(events: DataFrame) -> DataFrame:
    """A trainer-log long table ``(run_id, step, metric, value)`` from ``events``."""
    metric = None
    for k, v in METRIC_OF_EVENT.items():
        metric = F.when(F.col("event_type") == k, F.lit(v)) if metric is None else metric.when(F.col("event_type") == k, F.lit(v))
    rows = events.select(F.col("user_id").alias("run_id"), "ts", "event_id", metric.alias("metric"), "value")
    return _numbered(rows, "run_id", "step").select("run_id", "step", "metric", "value")


# Fixed value: steps in one part of a trainer state, so that a file is bounded whatever the run's size.
STATE_STEPS = 10_000


def trainer_states(events: DataFrame) -> DataFrame:
    """``(path, content)``: the trainer state at half the steps and at the end of each run,
    with the whole history so far, in parts of ``STATE_STEPS`` steps (a file each);
    gradient norms under 20 are written as NaN."""
    m = run_metrics(events).where("run_id IS NOT NULL AND metric IS NOT NULL")
    number = F.when((F.col("metric") == "grad_norm") & (F.col("value") < BLANK_BELOW), F.lit("NaN")).otherwise(F.col("value").cast("string"))
    rec = F.concat(F.lit('{"step": '), F.col("step").cast("string"), F.lit(', "'), "metric", F.lit('": '), number, F.lit("}"))
    m = m.select("run_id", F.expr(f"(step - 1) div {STATE_STEPS}").alias("part"), "step", rec.alias("r"))
    parts = m.groupBy("run_id", "part").agg(F.sort_array(F.collect_list(F.struct("step", "r"))).alias("h"))
    # the last step of the run, from one row per part
    ends = m.groupBy("run_id", "part").agg(F.max("step").alias("last"))
    ends = ends.select("run_id", "part", F.max("last").over(Window.partitionBy("run_id")).alias("last"))
    at = F.explode(F.array_distinct(F.array(F.ceil(F.col("last") / 2), F.col("last")))).alias("at")
    docs = parts.join(ends, ["run_id", "part"]).select("run_id", "part", "h", at)
    docs = docs.select("run_id", "part", "at", F.filter("h", lambda x: x["step"] <= F.col("at")).alias("h")).where(F.size("h") > 0)
    path = F.concat(F.lit("runs/c"), F.col("run_id").cast("string"), F.lit("/checkpoint-"), F.col("at").cast("string"), F.lit("/trainer_state."), F.col("part").cast("string"), F.lit(".json"))
    body = F.array_join(F.transform("h", lambda x: x["r"]), ", ")
    return docs.select(path.alias("path"), F.concat(F.lit('{"log_history": ['), body, F.lit("]}")).alias("content"))


def _numbered(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Rows numbered per ``key`` by (ts, event_id), in blocks of a day."""
    return blocked_row_number(rows, key, ["ts", "event_id"], F.to_date("ts"), out)
