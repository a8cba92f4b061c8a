"""Preprocessing and forests.

``train_random_forest`` and ``train_balanced_forest`` train at the sizes of the data contract; the
other queries, whose results say nothing of a forest's size, take small ones.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.functions import scoring as expressions
from orderlens.operators import (
    comparison,
    dictionary,
    evaluation,
    forest,
    schema,
    skew,
    splits,
    trees,
)
from orderlens.plans import scoring, training
from orderlens.queries.registry import over_lines, query, ratio6
from orderlens.queries.tables import BUCKET_SQL, FEATURE_SQL, MIN_COUNT
from orderlens.sources import layers, scratch, star
from orderlens.streaming import scoring as streaming

TREES, DEPTH = 10, 5
SETTINGS = training.ForestSettings(TREES, DEPTH, TREES, DEPTH)

_INDEXED = ["Product_Category", "Brand", "Country"]


def _ranked(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, {column} AS value, count(*) AS n, "
        f"cast(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS double) AS idx "
        f"FROM orders_v GROUP BY {column}"
    )


@query("string_index", over_lines(" UNION ALL ".join(_ranked(c) for c in _INDEXED)))
def string_index(spark, sf):
    lines = star.order_lines(spark, sf).select(_INDEXED)
    indexed = dictionary.encode(lines, dictionary.build(lines, _INDEXED))
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col(f"{c}_idx").alias("idx")
            )
            for c in _INDEXED
        ]
    )
    return (
        indexed.select(F.explode(pairs).alias("p"))
        .groupBy("p.column_name", "p.value", "p.idx")
        .agg(F.count("*").alias("n"))
    )


@query(
    "one_hot_vector",
    over_lines(
        f", ranked AS ({_ranked('Product_Category')}) "
        "SELECT value AS Product_Category, cast(idx AS int) AS slot, n, "
        "cast((SELECT count(*) FROM ranked) + 1 AS int) AS width FROM ranked"
    ),
)
def one_hot_vector(spark, sf):
    """Indicator slot and vector width of each category; the last slot is for unseen ones."""
    column = "Product_Category"
    lines = star.order_lines(spark, sf).select(column)
    values = dictionary.build(lines, [column])
    encoded = dictionary.one_hot(dictionary.encode(lines, values), values)
    slots = encoded.select(column, vector_to_array(f"{column}_ohe").alias("v"))
    return (
        slots.select(
            column,
            (F.array_position("v", 1.0) - 1).cast("int").alias("slot"),
            F.size("v").alias("width"),
        )
        .groupBy(column, "slot", "width")
        .agg(F.count("*").alias("n"))
    )


@query(
    "assemble_vector",
    over_lines(
        "SELECT Order_ID, Product_ID, cast(Quantity AS double) AS x0, Unit_Price AS x1, "
        "coalesce(Review_Rating, cast(-1 AS double)) AS x2 FROM orders_v"
    ),
)
def assemble_vector(spark, sf):
    """Nulls become NaN in the vector, shown as -1."""
    lines = star.order_lines(spark, sf).select(
        "Order_ID", "Product_ID", "Quantity", "Unit_Price", "Review_Rating"
    )
    vectors = forest.assembler([], ["Quantity", "Unit_Price", "Review_Rating"]).transform(lines)
    values = vectors.select("Order_ID", "Product_ID", vector_to_array("features").alias("v"))
    return values.select(
        "Order_ID",
        "Product_ID",
        *[F.nanvl(F.col("v")[i], F.lit(-1.0)).alias(f"x{i}") for i in range(3)],
    )


# order lines that the feature layer keeps, by split, for all oracles below
_ROWS_V = (
    ", f AS (SELECT Order_ID, "
    + ", ".join(f"{sql} AS {name}" for name, sql in FEATURE_SQL.items())
    + f", CASE WHEN {BUCKET_SQL} < {fields.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split"
    + " FROM orders_v), rows_v AS (SELECT * FROM f WHERE "
    + " AND ".join(f"{name} IS NOT NULL" for name in FEATURE_SQL)
    + ")"
)
_TRAINED_SQL = over_lines(
    f"{_ROWS_V} SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, "
    "count(*) FILTER (WHERE split = 'test') AS test_rows, "
    "count(*) FILTER (WHERE split = 'test' AND returned = 1) AS test_positives, "
    "true AS cells_add_up, true AS accuracy_agrees, true AS auc_in_range FROM rows_v"
)


def prepared_splits(spark, sf):
    """Feature layer of all order lines, split by order; both parts written."""
    path = scratch.scratch_path(spark, "splits")
    written = training.write_splits(star.order_lines(spark, sf), path, min_count=MIN_COUNT)
    scratch.release_shuffles(spark)
    return written


def _close(a, b):
    return F.abs(a - b) < 1e-9


def trained(model, train, test):
    """What must hold for any model: rows of both splits, and metrics that agree with the cells."""
    predictions = scratch.durable(
        forest.with_probability(forest.batch_predict(model, test)), "predictions"
    )
    cells = evaluation.confusion_counts(predictions, fields.LABEL, F.col("default_prediction"))
    tp, fp, tn, fn = (F.col(c) for c in evaluation.COUNTS)
    n = F.lit(predictions.count())
    metrics = training.evaluate_model(predictions)
    return cells.crossJoin(metrics).select(
        F.lit(train.count()).alias("train_rows"),
        n.alias("test_rows"),
        (tp + fn).alias("test_positives"),
        (tp + fp + tn + fn == n).alias("cells_add_up"),
        _close(F.col("test_accuracy"), (tp + tn) / n).alias("accuracy_agrees"),
        F.col("test_auc").between(0, 1).alias("auc_in_range"),
    )


@query("train_random_forest", _TRAINED_SQL)
def train_random_forest(spark, sf):
    """The forest of the data contract, at its full size."""
    train, test = prepared_splits(spark, sf)
    return trained(forest.train_random_forest(train), train, test)


@query("train_balanced_forest", _TRAINED_SQL)
def train_balanced_forest(spark, sf):
    """The balanced forest of the data contract, at its full size."""
    train, test = prepared_splits(spark, sf)
    return trained(forest.train_balanced_forest(train), train, test)


@query(
    "batch_predict",
    over_lines(
        f"{_ROWS_V} SELECT Order_ID AS order_id, returned, true AS consistent "
        "FROM rows_v WHERE split = 'test'"
    ),
)
def batch_predict(spark, sf):
    """Key and label of every test row, and whether prediction and probability agree."""
    train, test = prepared_splits(spark, sf)
    model = forest.train_random_forest(train, TREES, DEPTH)
    rows = forest.with_probability(forest.batch_predict(model, test, keep=[fields.SPLIT_KEY]))
    p, yes = F.col("return_probability"), F.col("default_prediction") == 1
    return rows.select(
        fields.SPLIT_KEY, fields.LABEL, (p.between(0, 1) & (yes == (p > 0.5))).alias("consistent")
    )


_WIDTH_SQL = " + ".join(
    f"count(DISTINCT {name}) + 1" for name in FEATURE_SQL if name in fields.CATEGORICAL_FEATURES
)


@query(
    "feature_importances",
    over_lines(
        f"{_ROWS_V} SELECT cast({_WIDTH_SQL} + "
        f"{sum(name in fields.NUMERIC_FEATURES for name in FEATURE_SQL)} AS bigint) AS features, "
        "true AS names_differ, true AS adds_up FROM rows_v WHERE split = 'train'"
    ),
)
def feature_importances(spark, sf):
    """One importance for each number, each category and each unseen category; they add up to 1."""
    train, _ = prepared_splits(spark, sf)
    found = forest.feature_importances(forest.train_random_forest(train, TREES, DEPTH), train)
    return found.agg(
        F.count("*").alias("features"),
        (F.count_distinct("feature") == F.count("*")).alias("names_differ"),
        _close(F.sum("importance"), F.lit(1.0)).alias("adds_up"),
    )


# --- one tree without sampling, whose splits SQL can search itself

# the band of a score that foretells returns stands in for an amount that the lines lack
_TREE_FEATURES = {
    "quarter": "cast(Quarter AS double)",
    "quantity": "cast(Quantity AS double)",
    "discount_percent": "cast(Discount_Percent AS double)",
    "profit_amount": "cast(floor(Score * 20) AS double)",
}
#: More bins than any of these features has values, so that every value is a bin.
_TREE = {"trees": 1, "depth": 2, "bootstrap": False, "featureSubsetStrategy": "all", "maxBins": 64}


def _tree_sql(balanced: bool) -> str:
    """The best Gini splits of two levels as SQL: views ``nodes`` (places as in a heap), ``t``.

    Thresholds lie between neighbouring values of the training rows; ties go to the first
    feature and the lowest threshold; leaves that decide alike are one leaf.
    """
    names = list(_TREE_FEATURES)
    weight = (
        "CASE WHEN Returned = 1 THEN count(*) OVER () / (2.0 * sum(Returned) OVER ()) "
        "ELSE count(*) OVER () / (2.0 * sum(1 - Returned) OVER ()) END"
        if balanced
        else "1.0"
    )
    values = ", ".join(f"{sql} AS {name}" for name, sql in _TREE_FEATURES.items())
    gini = "(CASE WHEN {0} + {1} > 0 THEN 1 - ({0} * {0} + {1} * {1}) / (({0} + {1}) * ({0} + {1})) ELSE 0 END)"
    parts = [
        f"t AS MATERIALIZED (SELECT Order_ID, Product_ID, Returned, {values}, "
        f"{BUCKET_SQL} < {fields.TRAIN_PERCENT} AS train FROM orders_v)",
        f"k AS MATERIALIZED (SELECT {', '.join(names)}, Returned, cast({weight} AS double) AS w "
        "FROM t WHERE train)",
        "u AS (" + " UNION ALL ".join(
            f"SELECT DISTINCT {i} AS f, {name} AS v FROM k" for i, name in enumerate(names)
        ) + ")",
        "b AS (SELECT f, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS t FROM u)",
    ]

    def search(level: str, rows: str) -> list[str]:
        long = " UNION ALL ".join(
            f"SELECT place, {i} AS f, {name} AS v, w, Returned FROM {rows}" for i, name in enumerate(names)
        )
        g = gini.format
        return [
            f"n{level} AS MATERIALIZED (SELECT place, count(*) AS n, "
            "coalesce(sum(w) FILTER (WHERE Returned = 0), 0) AS z, "
            f"coalesce(sum(w) FILTER (WHERE Returned = 1), 0) AS o FROM {rows} GROUP BY place)",
            f"c{level} AS (SELECT place, f, v, coalesce(sum(w) FILTER (WHERE Returned = 0), 0) AS z, "
            f"coalesce(sum(w) FILTER (WHERE Returned = 1), 0) AS o FROM ({long}) GROUP BY place, f, v)",
            f"l{level} AS (SELECT place, b.f, b.t, coalesce(sum(z), 0) AS lz, coalesce(sum(o), 0) AS lo "
            f"FROM b JOIN c{level} c ON c.f = b.f AND c.v <= b.t WHERE b.t IS NOT NULL GROUP BY place, b.f, b.t)",
            f"g{level} AS (SELECT place, f, t, {g('z', 'o')} "
            f"- (lz + lo) / (z + o) * {g('lz', 'lo')} "
            f"- (z + o - lz - lo) / (z + o) * {g('(z - lz)', '(o - lo)')} AS gain "
            f"FROM l{level} JOIN n{level} USING (place) WHERE z + o - lz - lo > 1e-9)",
            f"s{level} AS MATERIALIZED (SELECT place, f, t FROM g{level} WHERE gain > 1e-12 QUALIFY "
            "row_number() OVER (PARTITION BY place ORDER BY round(gain, 12) DESC, f, t) = 1)",
        ]

    value = "CASE f " + " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(names)) + " END"
    parts += ["k0 AS (SELECT 1 AS place, * FROM k)", *search("0", "k0")]
    parts.append(
        f"k1 AS MATERIALIZED (SELECT CASE WHEN {value} <= t THEN 2 ELSE 3 END AS place, k.* FROM k, s0)"
    )
    parts += search("1", "k1")
    parts += [
        f"k2 AS (SELECT CASE WHEN {value} <= s1.t THEN 2 * place ELSE 2 * place + 1 END AS place, w, Returned "
        "FROM k1 JOIN s1 USING (place))",
        "n2 AS (SELECT place, count(*) AS n, coalesce(sum(w) FILTER (WHERE Returned = 0), 0) AS z, "
        "coalesce(sum(w) FILTER (WHERE Returned = 1), 0) AS o FROM k2 GROUP BY place)",
        # the lower of two equal classes decides
        "grown AS (SELECT * FROM (SELECT * FROM n0 UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n2) "
        "LEFT JOIN (SELECT * FROM s0 UNION ALL SELECT * FROM s1) USING (place))",
        "cut1 AS (SELECT place // 2 AS place FROM n2 GROUP BY 1 HAVING min(cast(o > z AS int)) = max(cast(o > z AS int)))",
        "cut0 AS (SELECT 1 AS place FROM n1 HAVING min(cast(o > z AS int)) = max(cast(o > z AS int)) "
        "AND NOT EXISTS (SELECT * FROM s1 WHERE place NOT IN (SELECT place FROM cut1)))",
        "nodes AS MATERIALIZED (SELECT place, n, z, o, CASE WHEN place NOT IN (SELECT place FROM cut1) AND place NOT IN "
        "(SELECT place FROM cut0) THEN f END AS f, CASE WHEN place NOT IN (SELECT place FROM cut1) AND "
        "place NOT IN (SELECT place FROM cut0) THEN t END AS t FROM grown "
        "WHERE place // 2 NOT IN (SELECT place FROM cut1) AND place // 2 NOT IN (SELECT place FROM cut0) "
        "AND place // 4 NOT IN (SELECT place FROM cut0))",
    ]
    return ", " + ", ".join(parts)


def _leaf_sql() -> str:
    """Rows with the leaf they fall into, for a query over ``nodes`` and ``t``."""
    value = "CASE {0}.f " + " ".join(
        f"WHEN {i} THEN {name}" for i, name in enumerate(_TREE_FEATURES)
    ) + " END"
    root, child = value.format("r"), value.format("c")
    return (
        f", p1 AS (SELECT t.*, CASE WHEN r.f IS NULL THEN 1 WHEN {root} <= r.t THEN 2 ELSE 3 END AS first "
        "FROM t, (SELECT * FROM nodes WHERE place = 1) r), "
        f"p2 AS (SELECT p1.*, CASE WHEN first = 1 OR c.f IS NULL THEN first WHEN {child} <= c.t "
        "THEN 2 * first ELSE 2 * first + 1 END AS leaf FROM p1 JOIN nodes c ON c.place = first), "
        "scored AS (SELECT p2.*, o / (z + o) AS probability FROM p2 JOIN nodes ON nodes.place = leaf)"
    )


_NODES_SQL = (
    "SELECT place, CASE f "
    + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(_TREE_FEATURES))
    + " END AS feature, t AS threshold, n AS rows, round(z, 4) AS zeros, round(o, 4) AS ones FROM nodes"
)


def tree_lines(spark, sf):
    """Order lines with the features of the single tree, by the names that scoring expects."""
    lines = star.order_lines(spark, sf)
    return lines.select(
        F.col("Order_ID").alias("order_id"),
        F.col("Product_ID").alias("product_id"),
        F.col("Returned").alias(fields.LABEL),
        *[F.expr(sql).alias(name) for name, sql in _TREE_FEATURES.items()],
    )


def single_tree(spark, sf, balanced: bool):
    """The tree fitted on the training lines, and all lines with their split."""
    tagged = scratch.durable(splits.tag_split(tree_lines(spark, sf), ["order_id"]), "tree_lines")
    train = splits.take_split(tagged, splits.TRAIN).drop("order_id", "product_id")
    fit = forest.train_balanced_forest if balanced else forest.train_random_forest
    return fit(train, **_TREE), tagged


def _tree_nodes(spark, sf, balanced: bool):
    model, _ = single_tree(spark, sf, balanced)
    nodes = trees.paths(trees.saved_nodes(model, spark), _TREE["depth"])
    # the assembler takes numbers in the order of the data contract
    _, numeric = forest.feature_columns(tree_lines(spark, sf))
    return trees.named(nodes, numeric).select(
        F.col("place").cast("int").alias("place"),
        "feature",
        "threshold",
        "rows",
        F.round(F.col("stats")[0], 4).alias("zeros"),
        F.round(F.col("stats")[1], 4).alias("ones"),
    )


@query("tree_splits", over_lines(f"{_tree_sql(False)} {_NODES_SQL}"))
def tree_splits(spark, sf):
    """Splits and leaves of one tree, which SQL searches for itself."""
    return _tree_nodes(spark, sf, balanced=False)


@query("tree_splits_balanced", over_lines(f"{_tree_sql(True)} {_NODES_SQL}"))
def tree_splits_balanced(spark, sf):
    """The same with balanced classes, whose weights enter every split."""
    return _tree_nodes(spark, sf, balanced=True)


@query(
    "tree_predictions",
    over_lines(
        f"{_tree_sql(True)}{_leaf_sql()} SELECT Order_ID AS order_id, Product_ID AS product_id, "
        "Returned AS returned, cast(probability > 0.5 AS int) AS default_prediction, "
        "round(probability + 1e-9, 6) AS return_probability FROM scored WHERE NOT train"
    ),
)
def tree_predictions(spark, sf):
    """Every test row's prediction and probability: those of its leaf."""
    model, tagged = single_tree(spark, sf, balanced=True)
    test = splits.take_split(tagged, splits.TEST)
    rows = forest.with_probability(
        forest.batch_predict(model, test, keep=["order_id", "product_id"])
    )
    return rows.withColumn("return_probability", ratio6("return_probability"))


@query(
    "tree_scores",
    over_lines(
        f"{_tree_sql(True)}{_leaf_sql()}, r AS (SELECT *, probability AS p FROM scored) "
        "SELECT Order_ID AS order_id, Product_ID AS product_id, "
        f"CASE WHEN p >= {fields.SERVING_THRESHOLD} THEN 1 ELSE 0 END AS prediction, "
        "round(p, 6) AS return_probability, "
        f"cast({fields.SERVING_THRESHOLD} AS double) AS threshold, "
        "CASE WHEN p >= 0.75 THEN 'High return risk' WHEN p >= 0.5 THEN 'Likely return' "
        "WHEN p >= 0.3 THEN 'Moderate return risk' ELSE 'Low return risk' END AS risk_label FROM r"
    ),
)
def tree_scores(spark, sf):
    """Every line scored as a record: probability, decision and label of its leaf."""
    model, tagged = single_tree(spark, sf, balanced=True)
    return scoring.score_batch(
        model, tagged.drop(fields.LABEL), keep=["order_id", "product_id"]
    )


@query(
    "stored_importances",
    over_lines(
        "SELECT m AS model, cast(0 AS bigint) AS differing, true AS adds_up "
        "FROM (SELECT unnest(['plain', 'balanced']) AS m)"
    ),
)
def stored_importances(spark, sf):
    """Features whose importance in the stored nodes is not what the model itself says."""
    train, _ = prepared_splits(spark, sf)
    models = {
        "plain": forest.train_random_forest(train, TREES, DEPTH),
        "balanced": forest.train_balanced_forest(train, TREES, DEPTH),
    }
    rows = []
    for name, model in models.items():
        vector = model.stages[-1].featureImportances.toArray().tolist()
        said = spark.createDataFrame(list(enumerate(vector)), "feature int, said double")
        found = said.join(trees.importances(trees.saved_nodes(model, spark)), "feature", "left")
        importance = F.coalesce("importance", F.lit(0.0))
        rows.append(
            found.agg(
                F.count_if(F.abs(importance - F.col("said")) > 1e-9).alias("differing"),
                _close(F.sum(importance), F.lit(1.0)).alias("adds_up"),
            ).select(F.lit(name).alias("model"), "differing", "adds_up")
        )
    return rows[0].unionByName(rows[1])


@query(
    "model_save_load",
    over_lines(
        f"{_ROWS_V} SELECT count(*) AS n, cast(0 AS bigint) AS changed "
        "FROM rows_v WHERE split = 'test'"
    ),
)
def model_save_load(spark, sf):
    """Test rows, and how many of them a saved and loaded model scores differently."""
    train, test = prepared_splits(spark, sf)
    path = scratch.scratch_path(spark, "model")
    model = forest.train_random_forest(train, TREES, DEPTH)
    forest.save_model(model, path)
    before, after = (
        forest.with_probability(forest.batch_predict(m, test, keep=[fields.SPLIT_KEY]))
        for m in (model, forest.load_model(path))
    )
    return _differing(before, after)


def _differing(rows, others):
    """Rows of the first table, and rows that are in only one of both, as often as they are.

    Both are counted against each other in one grouping, which reads either once.
    """
    signed = rows.withColumn("sign__", F.lit(1)).unionByName(others.withColumn("sign__", F.lit(-1)))
    counted = signed.groupBy(*rows.columns).agg(
        F.count_if(F.col("sign__") > 0).alias("here__"), F.sum("sign__").alias("more__")
    )
    return counted.agg(
        F.coalesce(F.sum("here__"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.abs("more__")), F.lit(0)).alias("changed"),
    )


def _records(spark, sf):
    """All order lines as scoring records: raw values, no label needed."""
    return schema.lowercase_columns(star.order_lines(spark, sf)).withColumn(
        "country", F.upper("country")
    )


@query(
    "score_batch",
    over_lines(
        "SELECT Order_ID AS order_id, Product_ID AS product_id, "
        f"cast({fields.SERVING_THRESHOLD} AS double) AS threshold, true AS consistent FROM orders_v"
    ),
)
def score_batch(spark, sf):
    """Every record once, and whether decision and risk label agree with the probability."""
    train, _ = prepared_splits(spark, sf)
    model = forest.train_balanced_forest(train, TREES, DEPTH)
    scores = scoring.score_batch(model, _records(spark, sf), keep=["order_id", "product_id"])
    p, half_step = F.col("return_probability"), 1e-3  # the decision uses the unrounded value
    decided = F.when(F.col("prediction") == 1, p >= F.col("threshold") - half_step).otherwise(
        p <= F.col("threshold") + half_step
    )
    labelled = F.col("risk_label").isin(
        expressions.risk_label(p), expressions.risk_label(p - half_step),
        expressions.risk_label(p + half_step),
    )
    return scores.select("order_id", "product_id", "threshold", (decided & labelled).alias("consistent"))


@query(
    "score_labels",
    over_lines(
        "SELECT Order_ID, CASE WHEN Score >= 0.5 THEN 1 ELSE 0 END AS prediction, "
        "Score AS return_probability, cast(0.5 AS double) AS threshold, "
        "CASE WHEN Score >= 0.75 THEN 'High return risk' WHEN Score >= 0.5 THEN 'Likely return' "
        "WHEN Score >= 0.3 THEN 'Moderate return risk' ELSE 'Low return risk' END AS risk_label "
        "FROM orders_v"
    ),
)
def score_labels(spark, sf):
    """The output columns of scoring, over a score that needs no model."""
    return scoring.label_scores(
        star.order_lines(spark, sf), "Score", fields.SERVING_THRESHOLD, keep=["Order_ID"]
    )


@query(
    "stream_score",
    over_lines("SELECT count(*) AS n, cast(0 AS bigint) AS changed FROM orders_v"),
)
def stream_score(spark, sf):
    """Rows scored in batch, and rows that the stream scores differently."""
    with scratch.scope(spark):  # the model is all that is needed of the layers it is trained on
        train, _ = prepared_splits(spark, sf)
        model = forest.train_balanced_forest(train, TREES, DEPTH)
    scratch.release_shuffles(spark)
    records = scratch.durable(_records(spark, sf), "records")
    source = records.inputFiles()[0].rsplit("/", 1)[0]
    output, keep = scratch.scratch_path(spark, "scores"), ["order_id", "product_id"]
    running = streaming.stream_score(
        model,
        streaming.read_records(spark, source, records.schema),
        output,
        scratch.scratch_path(spark, "scores_checkpoint"),
        keep=keep,
    )
    running.awaitTermination()
    streamed = layers.read_layer(spark, output)
    return _differing(scoring.score_batch(model, records, keep=keep), streamed)


@query(
    "job_train_tune_compare",
    over_lines(
        f"{_ROWS_V}, n AS (SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, "
        "count(*) FILTER (WHERE split = 'test') AS test_rows FROM rows_v) "
        "SELECT m AS model_name, train_rows, test_rows, true AS cells_add_up, "
        "true AS rates_agree, true AS threshold_agrees FROM n, "
        f"(SELECT unnest(['{comparison.TUNED_MODEL['model_name']}', "
        f"'{comparison.BALANCED_MODEL['model_name']}']) AS m)"
    ),
)
def job_train_tune_compare(spark, sf):
    """Both models' rows; their rates, and the chosen threshold, recomputed from stored layers."""
    path = scratch.scratch_path(spark, "job")
    written = training.job_train_tune_compare(
        star.order_lines(spark, sf), path, SETTINGS, min_count=MIN_COUNT
    )
    best = evaluation.best_threshold(written["rf_threshold_metrics"]).select("threshold").scalar()
    tuned = F.col("model_name") == comparison.TUNED_MODEL["model_name"]
    tp, fp, tn, fn = (F.col(c) for c in evaluation.COUNTS)
    return written["rf_model_comparison"].select(
        "model_name",
        "train_rows",
        "test_rows",
        (tp + fp + tn + fn == F.col("test_rows")).alias("cells_add_up"),
        (
            _close(F.col("precision"), evaluation.ratio(tp, tp + fp))
            & _close(F.col("recall"), evaluation.ratio(tp, tp + fn))
            & _close(F.col("accuracy"), (tp + tn) / F.col("test_rows"))
        ).alias("rates_agree"),
        (
            F.col("decision_threshold")
            == F.when(tuned, best).otherwise(F.lit(fields.SERVING_THRESHOLD))
        ).alias("threshold_agrees"),
    )


FOLDS = 3


@query(
    "out_of_fold_scores",
    over_lines(
        f"{_ROWS_V}, g AS (SELECT r.*, cast(bucket % {FOLDS} AS int) AS fold FROM rows_v r JOIN "
        f"(SELECT DISTINCT Order_ID, {BUCKET_SQL} AS bucket FROM orders_v) USING (Order_ID) "
        "WHERE split = 'train') SELECT fold, count(*) AS scored, "
        "cast(sum(returned) AS bigint) AS positives, count(DISTINCT Order_ID) AS orders, "
        "(SELECT count(DISTINCT Order_ID) FROM g) - count(DISTINCT Order_ID) AS orders_learned, "
        "cast(0 AS bigint) AS seen_before FROM g GROUP BY fold"
    ),
)
def out_of_fold_scores(spark, sf):
    """Rows scored per fold, and how many of them the scoring model had seen: none, by a join."""
    train, _ = prepared_splits(spark, sf)
    scored, learned = training.out_of_fold(train, FOLDS, training.ForestSettings(3, 3))
    key = [fields.SPLIT_KEY, "fold"]
    seen = scored.join(learned, key, "left_semi").groupBy("fold").agg(F.count("*").alias("seen"))
    sizes = learned.groupBy("fold").agg(F.count("*").alias("orders_learned"))
    return (
        scored.groupBy("fold")
        .agg(
            F.count("*").alias("scored"),
            F.sum(F.col(fields.LABEL).cast("long")).alias("positives"),
            F.count_distinct(fields.SPLIT_KEY).alias("orders"),
        )
        .join(sizes, "fold")
        .join(seen, "fold", "left")
        .select(
            "fold", "scored", "positives", "orders", "orders_learned",
            F.coalesce("seen", F.lit(0)).cast("long").alias("seen_before"),
        )
    )


_SKEW_CATEGORIES = {"country": "Country", "payment_method": "Payment_Method", "brand": "Brand"}
_SKEW_NUMBERS = {
    "quantity": "cast(Quantity AS double)",
    "unit_price": "Unit_Price",
    "review_rating": "Review_Rating",
}


def _skew_sql() -> str:
    """Histograms of both parts, bin by bin; the batch has upper-cased countries and more items."""
    features = [*_SKEW_CATEGORIES, *_SKEW_NUMBERS]
    old = ", ".join(f"{sql} AS {name}" for name, sql in (_SKEW_CATEGORIES | _SKEW_NUMBERS).items())
    ends = ", ".join(f"min({n}) AS low_{n}, max({n}) AS high_{n}" for n in _SKEW_NUMBERS)
    bins = [f"SELECT part, '{n}' AS feature, coalesce({n}, '{skew.MISSING}') AS bin FROM s" for n in _SKEW_CATEGORIES]
    bins += [
        f"SELECT part, '{n}', CASE WHEN {n} IS NULL THEN '{skew.MISSING}' WHEN {n} < low_{n} THEN "
        f"'{skew.BELOW}' WHEN {n} > high_{n} THEN '{skew.ABOVE}' ELSE cast(cast(least(floor(({n} - low_{n}) "
        f"/ (high_{n} - low_{n}) * {skew.NUMBER_BINS}), {skew.NUMBER_BINS - 1}) AS bigint) AS varchar) END FROM s, e"
        for n in _SKEW_NUMBERS
    ]
    return (
        f", o AS (SELECT {old}, {BUCKET_SQL} < {fields.TRAIN_PERCENT} AS train FROM orders_v), "
        "s AS (SELECT CASE WHEN train THEN 'train' ELSE 'batch' END AS part, o.* REPLACE ("
        "CASE WHEN train THEN country ELSE upper(country) END AS country, "
        "CASE WHEN train THEN quantity ELSE quantity * 1.5 END AS quantity) FROM o), "
        f"e AS (SELECT {ends} FROM s WHERE part = 'train'), "
        f"b AS ({' UNION ALL '.join(bins)}), "
        "c AS (SELECT feature, bin, count(*) FILTER (WHERE part = 'train') AS t, "
        "count(*) FILTER (WHERE part = 'batch') AS n FROM b GROUP BY feature, bin), "
        "z AS (SELECT *, cast(sum(t) OVER w AS double) AS ts, cast(sum(n) OVER w AS double) AS ns FROM c "
        "WINDOW w AS (PARTITION BY feature)), "
        f"h AS (SELECT *, greatest(n / ns, {skew.LEAST_SHARE}) AS q, greatest(t / ts, {skew.LEAST_SHARE}) AS p FROM z) "
        "SELECT feature, cast(max(ns) AS bigint) AS records, "
        f"round(coalesce(sum(n) FILTER (WHERE bin = '{skew.MISSING}'), 0) / max(ns) + 1e-9, 6) AS missing_share, "
        f"round(coalesce(sum(n) FILTER (WHERE bin <> '{skew.MISSING}' AND t = 0), 0) / max(ns) + 1e-9, 6) "
        "AS unseen_share, round(sum((q - p) * ln(q / p)) + 1e-9, 6) AS stability FROM h GROUP BY feature"
    )


@query("skew_report", over_lines(_skew_sql()))
def skew_report(spark, sf):
    """A batch whose countries are in upper case and whose quantities grew, against training."""
    lines = star.order_lines(spark, sf)
    kinds = _SKEW_CATEGORIES | _SKEW_NUMBERS
    rows = lines.select("Order_ID", *[F.expr(sql).alias(name) for name, sql in kinds.items()])
    train, batch = splits.train_test_split(rows, ["Order_ID"])
    stored = scratch.durable(
        skew.histograms(train, list(_SKEW_CATEGORIES), list(_SKEW_NUMBERS)), "histograms"
    )
    changed = batch.withColumns(
        {"country": F.upper("country"), "quantity": F.col("quantity") * 1.5}
    )
    report = skew.skew_report(stored, changed)
    return report.withColumns({c: ratio6(c) for c in ("missing_share", "unseen_share", "stability")})


@query("random_split", over_lines("SELECT Returned, count(*) AS n FROM orders_v GROUP BY Returned"))
def random_split(spark, sf):
    """Both parts of Spark's own split hold every row once; which part is not fixed."""
    lines = star.order_lines(spark, sf).select("Order_ID", "Returned")
    return (
        splits.tagged_union(*splits.random_split(lines))
        .groupBy("Returned")
        .agg(F.count("*").alias("n"))
    )
