"""Model frames, and models behind one interface: columns ``*_Prob`` and ``wp``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsnap.plans.cuts import cut
from gridsnap.plans.order import Order, flag

# The classes in the order of their labels; scores of tries have no label.
CLASSES = ("Touchdown", "Opp_Touchdown", "Safety", "Opp_Safety", "No_Score")
CELL = ("yardline_50_simple", "yards_to_go_simple", "down")


def _labelled(df: DataFrame) -> DataFrame:
    label = F.coalesce(*[F.when(F.col("Next_Score_Half") == name, i) for i, name in enumerate(CLASSES)])
    return df.withColumns({"label": label, "Drive_Score_Dist": F.col("Drive_Score_Half") - F.col("drive_id"), "gap": F.abs("score_differential")})


def ep_counts(df: DataFrame) -> DataFrame:
    """Plays per cell, label, distance to the scoring drive, score gap and whether the play may train: all that weights,
    their extremes and the cells' frequencies depend on. A few thousand rows whatever the number of plays.
    """
    usable = (F.col("yardline_50").isNotNull() & F.col("yards_to_go").isNotNull()).alias("usable")
    return cut(_labelled(df).groupBy(*CELL, "label", "Drive_Score_Dist", "gap", usable).agg(F.count(F.lit(1)).alias("n")))


def _weighted(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Weights from the frame's extremes, two one-row aggregates of the counts; a range of zero gives null weights."""
    ends = counts.agg(F.max("Drive_Score_Dist").alias("d1"), F.min("Drive_Score_Dist").alias("d0"), F.max("gap").alias("g1"), F.min("gap").alias("g0"))

    def total(x: DataFrame) -> DataFrame:
        out = x.crossJoin(F.broadcast(ends)).withColumns({"Drive_Score_Dist_W": F.try_divide(F.col("d1") - F.col("Drive_Score_Dist"), F.col("d1") - F.col("d0")), "ScoreDiff_W": F.try_divide(F.col("g1") - F.col("gap"), F.col("g1") - F.col("g0"))})
        return out.withColumn("Total_W", F.col("Drive_Score_Dist_W") + F.col("ScoreDiff_W")).drop("d1", "d0", "g1", "g0")

    span = total(counts).agg(F.max("Total_W").alias("t1"), F.min("Total_W").alias("t0"))
    return total(df).crossJoin(F.broadcast(span)).withColumn("Total_W_Scaled", F.try_divide(F.col("Total_W") - F.col("t0"), F.col("t1") - F.col("t0"))).drop("t1", "t0")


def ep_frame(df: DataFrame) -> DataFrame:
    """Labels, one-hot downs and weights scaled by the whole frame's extremes; then plays with position and distance."""
    out = _weighted(_labelled(df), ep_counts(df)).drop("gap")
    return out.withColumns({f"down{i}": flag(F.col("down") == i) for i in range(5)}).where("yardline_50 is not null and yards_to_go is not null")


def wp_frame(df: DataFrame) -> DataFrame:
    """The winner of the game on every play, and whether the possessing team is it; ties count as lost."""
    home, away = F.col("home_team_score"), F.col("away_team_score")
    last = F.when(F.col("game_end") == 1, F.when(home > away, F.col("home_team")).when(home < away, F.col("away_team")).when(home == away, "TIE"))
    out = df.withColumn("Winner", last).withColumn("Winner", Order("index").after("Winner"))
    return out.withColumn("label", flag(F.col("posteam") == F.col("Winner")))


def _cell_sums(counts: DataFrame) -> DataFrame:
    """Weight of each class per cell of field half, distance bucket and down: at most 2 x 6 x 5 rows and the odd downs."""
    w = F.col("n") * F.col("Total_W_Scaled")
    sums = [F.sum(F.when(F.col("label") == i, w).otherwise(0.0)).alias(f"s{i}") for i in range(len(CLASSES))]
    return _weighted(counts, counts).where("usable and label is not null").groupBy(*CELL).agg(*sums, F.sum(w).alias("s"))


def ep_cells(counts: DataFrame) -> DataFrame:
    """Weighted class frequencies per cell."""
    return _cell_sums(counts).select(*CELL, *[F.try_divide(F.col(f"s{i}"), F.col("s")).alias(f"{name}_Prob") for i, name in enumerate(CLASSES)])


def score_ep(df: DataFrame, counts: DataFrame) -> DataFrame:
    """``df`` with the probabilities of its cell, or of the whole frame where the cell is empty.

    The model is some sixty rows, one per cell of field half, distance bucket and down: it passes through the driver and is broadcast.
    """
    sums = _cell_sums(counts)
    sums = df.sparkSession.createDataFrame(sums.collect(), sums.schema)
    names = [f"{name}_Prob" for name in CLASSES]
    whole = sums.agg(*[F.try_divide(F.sum(f"s{i}"), F.sum("s")).alias(f"all_{n}") for i, n in enumerate(names)])
    cells = sums.select(*[F.col(c).alias(f"c_{c}") for c in CELL], *[F.try_divide(F.col(f"s{i}"), F.col("s")).alias(f"c_{n}") for i, n in enumerate(names)])
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in CELL]
    out = df.join(F.broadcast(cells), same[0] & same[1] & same[2], "left").crossJoin(F.broadcast(whole))
    return out.withColumns({n: F.coalesce(f"c_{n}", f"all_{n}") for n in names}).drop(*[f"c_{c}" for c in (*CELL, *names)], *[f"all_{n}" for n in names])


def score_wp(df: DataFrame, weights: tuple[float, float, float] = (0.0, 0.18, 0.004)) -> DataFrame:
    """wp by a logistic of the score difference, weighted up as time runs out, and field position."""
    a, b, c = weights
    z = a + b * F.col("score_differential") * (1 + F.col("elapsed_share")) + c * (25 - F.col("yardline_50"))
    return df.withColumn("wp", 1 / (1 + F.exp(-z)))


EP_FEATURES = ("yardline_50", "yards_to_go", "down0", "down1", "down2", "down3", "down4")
WP_FEATURES = ("receive_2h_ko", "half_seconds_remaining", "game_seconds_remaining", "Diff_Time_Ratio", "score_differential", "down", "yards_to_go", "yardline_50")


def held_out(df: DataFrame, key: tuple[str, ...] = ("game_id", "play_id"), share: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the play's key: the same at every partitioning."""
    part = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(100)) < share
    return df.where(~part), df.where(part)


def _fit(frame: DataFrame, features: tuple[str, ...], learner, weight: str | None = None):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    rows = frame.select("label", *([weight] if weight else []), *features).na.drop().withColumn("label", F.col("label").cast("double"))
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), learner]).fit(rows)


def train_ep(frame: DataFrame, depth: int = 5, trees: int = 40):
    """A random forest over the expected-points features with the sample weights; its model adds a probability vector."""
    from pyspark.ml.classification import RandomForestClassifier

    return _fit(frame, EP_FEATURES, RandomForestClassifier(weightCol="Total_W_Scaled", maxDepth=depth, numTrees=trees, seed=42), "Total_W_Scaled")


def train_wp(frame: DataFrame, depth: int = 4, rounds: int = 20):
    """Boosted trees over the win-probability features."""
    from pyspark.ml.classification import GBTClassifier

    return _fit(frame, WP_FEATURES, GBTClassifier(stepSize=0.2, maxDepth=depth, maxIter=rounds, seed=42))


def _scored(df: DataFrame, model, features: tuple[str, ...]) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df.na.drop(subset=list(features))).withColumn("p", vector_to_array("probability"))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def trained_ep(df: DataFrame, model) -> DataFrame:
    """Probabilities of a trained model under the names score_ep gives; plays without features are left out."""
    return _scored(df, model, EP_FEATURES).withColumns({f"{n}_Prob": F.get("p", F.lit(i)) for i, n in enumerate(CLASSES)}).drop("p")


def trained_wp(df: DataFrame, model) -> DataFrame:
    """wp of a trained model under the name score_wp gives; plays without features are left out."""
    return _scored(df, model, WP_FEATURES).withColumn("wp", F.get("p", F.lit(1))).drop("p")


def evaluate(scored: DataFrame, probabilities: list, weight: Column | None = None) -> DataFrame:
    """(rows, log_loss, accuracy) of scored rows with a label: one row. probabilities: a column per class, in order of labels.

    Both are weighted; a class given probability 0 counts as 1e-15.
    """
    w = F.lit(1.0) if weight is None else weight
    given = F.get(F.array(*probabilities), F.col("label").cast("int"))
    p = F.when(given < 1e-15, 1e-15).otherwise(given)
    best = F.array_position(F.array(*probabilities), F.array_max(F.array(*probabilities))) - 1
    rows = scored.where("label is not null").select(p.alias("p"), w.alias("w"), (best == F.col("label")).cast("double").alias("hit")).where("p is not null and w is not null")
    return rows.agg(F.count(F.lit(1)).alias("rows"), (-F.sum(F.col("w") * F.log("p")) / F.sum("w")).alias("log_loss"), (F.sum(F.col("w") * F.col("hit")) / F.sum("w")).alias("accuracy"))


def importances(model, features: tuple[str, ...]) -> list[tuple[str, float]]:
    """(feature, share of the gain), largest first."""
    return sorted(zip(features, map(float, model.stages[-1].featureImportances.toArray())), key=lambda x: (-x[1], x[0]))


def search_ep(frame: DataFrame, space: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """(depth, trees, log loss on the held-out fifth) of every setting, best first; the frame should be cut before."""
    train, test = held_out(frame)
    tried = []
    for depth, trees in space:
        scored = trained_ep(test, train_ep(train, depth, trees))
        tried.append((depth, trees, float(evaluate(scored, [F.col(f"{n}_Prob") for n in CLASSES], F.col("Total_W_Scaled")).first()["log_loss"])))
    return sorted(tried, key=lambda x: x[2])


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
