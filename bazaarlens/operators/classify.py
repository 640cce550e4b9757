"""Text classification on precomputed vectors with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import ratio
from bazaarlens.functions.text import nfkc
from bazaarlens.operators.dedup import first_by, limit_by
from bazaarlens.operators.ranking import numbered

# Labels that stand for no label.
EMPTY_LABELS = ["none", "nan"]
#: Parts in which the rows of a label are first cut to its cap.
SHARES = 32


def clean_labelled(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """NFKC and lower case; rows without text or with an empty label go.

    ASCII rows need no normal form, so only the others go through Python.
    """
    out = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    for c in (text, label):
        low = F.lower(F.col(c).cast("string"))
        out = out.withColumn(c, F.coalesce(nfkc(F.when(low.rlike("[^\\x00-\\x7f]"), low)), low))
    return out.filter((F.col(text) != "") & (F.col(label) != "") & ~F.col(label).isin(EMPTY_LABELS))


def balance_labels(
    df: DataFrame, order: Sequence[str], min_count: int = 2, max_count: int = 100, text: str = "text", label: str = "label"
) -> DataFrame:
    """Labels with enough rows (counted before the dedup), one row per text, a cap per label.

    The cap is the operator's purpose: it balances the training set.
    """
    support = df.groupBy(label).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_count).select(label)
    ordered = [F.asc_nulls_last(c) for c in order]
    unique = first_by(df, [text, label], ordered).withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(SHARES)))
    # every task brings up to max_count texts of a label: few of the tasks meet at a time
    few = limit_by(limit_by(unique, max_count, [label, "_share"], ordered), max_count, [label], ordered).drop("_share")
    # a label stays or goes as a whole, so that the texts need not be dealt by label to be judged
    return few.join(support, label, "left_semi")


def label_map(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_id) by falling frequency, then label; one row per class."""
    from pyspark.sql import Window

    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("label_id", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(label))) - 1)


def split_exact(df: DataFrame, ids: Sequence[str], val: float = 0.1, test: float = 0.1, seed: int = 42) -> DataFrame:
    """Seeded train/val/test split with exactly int(val * n) and int(test * n) rows."""
    rows = numbered(df, ids, "_p", seed)
    n = F.col("_p_of")
    n_val, n_test = F.floor(F.lit(val) * n), F.floor(F.lit(test) * n)
    train = n - n_val - n_test
    part = F.when(F.col("_p") <= train, "train").when(F.col("_p") <= train + n_val, "val").otherwise("test")
    return rows.withColumn("split", part).drop("_p", "_p_of")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight 1 / class size on every row."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    return df.join(sizes, label).withColumn("weight", ratio(F.lit(1), "_n")).drop("_n")


def normalize_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Scale an array column to length one; a zero vector stays zero."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    scaled = F.transform(v, lambda x: F.coalesce(F.try_divide(x, F.col("_norm")), F.lit(0.0)))
    return df.withColumn("_norm", norm).withColumn(vector, scaled).drop("_norm")


def mean_pool(df: DataFrame, tokens: str, out: str = "embedding") -> DataFrame:
    """Mean of the token vectors of one row (array of arrays)."""
    width = F.size(F.get(F.col(tokens), F.lit(0)))
    mean = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda i: F.aggregate(F.col(tokens), F.lit(0.0), lambda acc, t: acc + F.get(t, i)) / F.size(F.col(tokens)),
    )
    return df.withColumn(out, F.when(width > 0, mean))


def train_classifier(
    train: DataFrame, classes: int, width: int, vector: str = "embedding", label: str = "label_id", kind: str = "mlp", seed: int = 42, epochs: int = 60
):
    """Classifier head: a perceptron d -> d/2 -> 256 -> k, or weighted logistic regression."""
    data = train.withColumn("features", array_to_vector(F.col(vector))).withColumn("_y", F.col(label).cast("double"))
    if kind == "mlp":
        model = MultilayerPerceptronClassifier(
            layers=[width, width // 2, 256, classes], labelCol="_y", featuresCol="features", seed=seed, maxIter=epochs
        )
    else:
        model = LogisticRegression(labelCol="_y", featuresCol="features", maxIter=epochs, family="multinomial")
        if "weight" in train.columns:
            model = model.setWeightCol("weight")
    return model.fit(data)


def topk_labels(df: DataFrame, labels: DataFrame, k: int, probability: str = "probability") -> DataFrame:
    """The k most probable labels per row of an array of probabilities, with scores rounded to four digits.

    Ties go to the smaller label id. ``labels`` has one row per class of a model, so it is a literal here.
    """
    names = F.create_map(*[F.lit(x) for r in labels.collect() for x in (int(r["label_id"]), str(r["label"]))])
    pairs = F.transform(probability, lambda p, i: F.struct((-p).alias("minus"), i.cast("int").alias("label_id")))
    top = F.slice(F.array_sort(pairs), 1, k)
    found = df.withColumn("_top", top)
    item = [F.get(F.col("_top"), F.lit(i)) for i in range(k)]
    out = {}
    for i, x in enumerate(item, 1):
        out[f"pred_{i}_label"] = F.coalesce(F.try_element_at(names, x["label_id"]), F.lit("unknown"))
        out[f"pred_{i}_score"] = F.bround(-x["minus"], 4)
    return found.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def predict_topk(model, df: DataFrame, labels: DataFrame, k: int = 2, vector: str = "embedding") -> DataFrame:
    """The k most probable labels per row by a model."""
    scored = model.transform(df.withColumn("features", array_to_vector(F.col(vector))))
    chances = scored.select(*df.columns, vector_to_array("probability").alias("_chances"))
    return topk_labels(chances, labels, k, "_chances").drop("_chances")


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))


def macro_metrics(df: DataFrame, truth: str = "label", guess: str = "prediction") -> DataFrame:
    """Macro accuracy (mean recall), precision, recall, F1.

    Works on the confusion counts, whose size is the number of classes squared. A class that
    occurs only among the guesses counts with zero in every mean.
    """
    cells = confusion(df, truth, guess)
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("guess").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)
    per = (
        cells.select(hit.alias("tp"), F.posexplode(sides).alias("side", "s"))
        .select("s.*", F.when(F.col("side") == 0, F.col("tp")).otherwise(0).alias("tp"))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
        .select(
            "label",
            "support",
            F.coalesce(ratio("tp", "predicted"), F.lit(0.0)).alias("p"),
            F.coalesce(ratio("tp", "support"), F.lit(0.0)).alias("r"),
        )
        .withColumn("f1", F.coalesce(ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0)))
    )
    return per.agg(
        F.sum("support").alias("n_samples"),
        F.count("*").alias("n_classes"),
        F.avg("r").alias("macro_accuracy"),
        F.avg("p").alias("macro_precision"),
        F.avg("r").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )
