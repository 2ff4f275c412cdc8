"""Queries over the log of experiments, runs, tags, metrics, properties and objects.

Every query answers for all experiments, runs or parents at once. Log entries are reduced to one
row per run before they are joined, so a run with very many entries makes no join task long.
Entries are ordered by (written_at, id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import running_min_before
from ..functions.scalar import round_half_even
from .profile import MANIFEST

PUBLISHED, RETRACTED, INFERIOR = "published", "retracted", "inferior"
DEPLOYMENT = "status.deployment"


def _written() -> Column:
    return F.struct("written_at", "id")


def latest(entries: DataFrame, by=("run_id", "key"), value: str = "value") -> DataFrame:
    """Last write wins: one row per run and key."""
    return entries.groupBy(*by).agg(F.max_by(value, _written()).alias(value))


def first(entries: DataFrame, by=("run_id", "key"), value: str = "value") -> DataFrame:
    """First write wins, as a point lookup does."""
    return entries.groupBy(*by).agg(F.min_by(value, _written()).alias(value))


def round_metrics(metrics: DataFrame) -> DataFrame:
    """Metric values as they are stored: three decimals, halves to even."""
    return metrics.withColumn("value", round_half_even(F.col("value"), 3))


def current_tags(tags: DataFrame, updates: DataFrame | None = None) -> DataFrame:
    """Tags after all upserts: one row per run and key with the id of its first write, and value and time of the last."""
    log = tags if updates is None else tags.unionByName(updates)
    return log.groupBy("run_id", "key").agg(
        F.min_by("id", _written()).alias("id"),
        F.max_by("value", _written()).alias("value"),
        F.max("written_at").alias("written_at"),
        F.count(F.lit(1)).alias("writes"),
    )


def tagged(tags: DataFrame, key: str, value: str) -> DataFrame:
    """Runs whose current tag `key` is `value`, each once."""
    return latest(tags.where(F.col("key") == key)).where(F.col("value") == value).select("run_id")


def pivot_latest(entries: DataFrame, keys: list[str]) -> DataFrame:
    """One row per run and a column per listed key, last write wins."""
    wanted = entries.where(F.col("key").isin(*keys))
    return wanted.groupBy("run_id").agg(
        *[F.max_by("value", F.when(F.col("key") == k, _written())).alias(k) for k in keys]
    )


def _best_value(metrics: DataFrame, key: str) -> DataFrame:
    """Lowest value of a metric per run."""
    return metrics.where(F.col("key") == key).groupBy("run_id").agg(F.min("value").alias("value"))


def best_child(runs: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """(parent_id, name, value): child with the lowest metric per parent, first by id on a tie."""
    children = runs.where(F.col("parent_id").isNotNull()).select(F.col("id").alias("run_id"), "name", "parent_id")
    return (
        children.join(_best_value(metrics, key), "run_id")
        .groupBy("parent_id")
        .agg(F.min_by(F.struct("name", "value"), F.struct("value", "run_id")).alias("best"))
        .select("parent_id", "best.name", "best.value")
    )


def champions(runs: DataFrame, metrics: DataFrame, tags: DataFrame, key: str) -> DataFrame:
    """(experiment_id, name, value): run tagged status = champion with the lowest metric."""
    chosen = tagged(tags, "status", "champion")
    return (
        runs.select(F.col("id").alias("run_id"), "name", "experiment_id")
        .join(chosen, "run_id", "left_semi")
        .join(_best_value(metrics, key), "run_id")
        .groupBy("experiment_id")
        .agg(F.min_by(F.struct("name", "value"), F.struct("value", "run_id")).alias("best"))
        .select("experiment_id", "best.name", "best.value")
    )


def children(runs: DataFrame, parent_id: str | None = None) -> DataFrame:
    """(parent_id, id, name) of all children, or of one parent."""
    found = runs.where(F.col("parent_id").isNotNull()) if parent_id is None else runs.where(F.col("parent_id") == parent_id)
    return found.select("parent_id", "id", "name")


def fan_out(runs: DataFrame) -> DataFrame:
    return children(runs).groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_children"))


def objects_of_runs(objects: DataFrame) -> DataFrame:
    """(run_id, type, url), last write wins."""
    return latest(objects, ("run_id", "type"), "url")


def objects_under_parents(runs: DataFrame, objects: DataFrame) -> DataFrame:
    """(parent_id, type, url) over the children of each parent, last write wins."""
    last = objects.groupBy("run_id", "type").agg(F.max(F.struct("written_at", "id", "url")).alias("last"))
    members = children(runs).select(F.col("id").alias("run_id"), "parent_id")
    return (
        last.join(members, "run_id")
        .groupBy("parent_id", "type")
        .agg(F.max("last").alias("last"))
        .select("parent_id", "type", "last.url")
    )


def published_candidates(runs: DataFrame, tags: DataFrame) -> DataFrame:
    """(experiment_id, id, name) of the runs that are published now."""
    chosen = tagged(tags, DEPLOYMENT, PUBLISHED).withColumnRenamed("run_id", "id")
    return runs.join(chosen, "id", "left_semi").select("experiment_id", "id", "name")


def previously_published(
    runs: DataFrame, tags: DataFrame, properties: DataFrame, metrics: DataFrame, primary_metric: str
) -> DataFrame:
    """(experiment_id, intent, id, value): published run per intent with the lowest test metric of its children.

    An intent that was never published has no row; its previous score counts as infinite.
    """
    scores = (
        children(runs)
        .select(F.col("id").alias("run_id"), "parent_id")
        .join(_best_value(metrics, f"validation.test.{primary_metric}"), "run_id")
        .groupBy("parent_id")
        .agg(F.min("value").alias("value"))
    )
    intents = first(properties.where(F.col("key") == "name.intent")).select(
        F.col("run_id").alias("id"), F.col("value").alias("intent")
    )
    return (
        published_candidates(runs, tags)
        .join(intents, "id")
        .join(scores.withColumnRenamed("parent_id", "id"), "id")
        .groupBy("experiment_id", "intent")
        .agg(F.min(F.struct("value", "id")).alias("best"))
        .select("experiment_id", "intent", "best.id", "best.value")
    )


def tagged_best(runs: DataFrame, tags: DataFrame) -> DataFrame:
    """(parent_id, id, name) of the children tagged level = best, the first by id per parent."""
    return (
        children(runs)
        .join(tagged(tags, "level", "best").withColumnRenamed("run_id", "id"), "id", "left_semi")
        .groupBy("parent_id")
        .agg(F.min(F.struct("id", "name")).alias("best"))
        .select("parent_id", "best.id", "best.name")
    )


def run_by_name(runs: DataFrame, name: str) -> DataFrame:
    """(id, parent_id) of the runs with that name."""
    return runs.where(F.col("name") == name).select("id", "parent_id")


def first_property(properties: DataFrame, key: str) -> DataFrame:
    """(run_id, value), first write wins."""
    return first(properties.where(F.col("key") == key)).select("run_id", "value")


def intents(properties: DataFrame) -> DataFrame:
    return first_property(properties, "name.intent")


def stored_manifest(objects: DataFrame) -> DataFrame:
    """Typed input rows (run_id, name, type, min, max, available_values, values_path) of the stored JSON manifests."""
    stored = first(objects.where(F.col("type") == "transformation.allowed_columns"), ("run_id", "type"), "url")
    return stored.select("run_id", F.inline(F.from_json("url", MANIFEST)))


def nomination_history(
    runs: DataFrame, piece: Column | None = None, group=("experiment_id", "intent"), order=("written_at", "id")
) -> DataFrame:
    """Status of every nomination after the whole history.

    The first score of a group is published, and so is every score strictly below all earlier ones,
    which retracts the one before; the others are inferior. `piece` cuts the history along its order
    (see `running_min_before`).
    """
    seen = running_min_before(runs, list(group), list(order), "score", "best_before", piece)
    promoted = F.col("best_before").isNull() | (F.col("score") < F.col("best_before"))
    status = (
        F.when(~promoted, INFERIOR).when(F.col("group_best_before") < F.col("score"), RETRACTED).otherwise(PUBLISHED)
    )
    return seen.withColumn("status", status).drop("group_best_before")


def nominate(score: float, previous: float | None) -> tuple[str, str | None]:
    """Status of a new run, and the new status of the one published before (None: unchanged)."""
    if previous is None:
        return PUBLISHED, None
    return (PUBLISHED, RETRACTED) if score < previous else (INFERIOR, None)


def run_cards(runs: DataFrame, tags: DataFrame, properties: DataFrame, metrics: DataFrame) -> DataFrame:
    """(parent_id, part, key, text, number): properties overlaid by metrics, of each parent with a best child and of that child.

    Entries of other runs are left out before anything is aggregated.
    """
    pairs = tagged_best(runs, tags).select(
        "parent_id",
        F.inline(
            F.array(
                F.struct(F.lit("parent").alias("part"), F.col("parent_id").alias("run_id")),
                F.struct(F.lit("children").alias("part"), F.col("id").alias("run_id")),
            )
        ),
    )
    wanted = pairs.select("run_id")

    def cells(entries: DataFrame, layer: int, text: Column, number: Column) -> DataFrame:
        cell = F.struct(F.lit(layer).alias("layer"), text.cast("string").alias("text"), number.cast("double").alias("number"))
        return latest(entries.join(wanted, "run_id", "left_semi")).select("run_id", "key", cell.alias("cell"))

    none = F.lit(None)
    both = cells(properties, 0, F.col("value"), none).unionByName(cells(metrics, 1, none, F.col("value")))
    top = both.groupBy("run_id", "key").agg(F.max("cell").alias("cell"))
    return top.join(pairs, "run_id").select("parent_id", "part", "key", "cell.text", "cell.number")


def latest_per_base_stage(runs: DataFrame, stage: str = "production") -> DataFrame:
    """(base, stage, run_id, created): newest run of each base in a stage, the last by id among equals."""
    return (
        runs.where(F.col("stage") == stage)
        .groupBy("base", "stage")
        .agg(F.max(F.struct("created", "run_id")).alias("newest"))
        .select("base", "stage", "newest.run_id", "newest.created")
    )


def children_with_tags(runs: DataFrame, tags: DataFrame, wanted: dict[str, str], order_by: str = "id") -> DataFrame:
    """(parent_id, id, name) of the children that carry every wanted tag."""
    match = F.lit(False)
    for key, value in wanted.items():
        match = match | ((F.col("key") == key) & (F.col("value") == value))
    hits = (
        latest(tags.where(F.col("key").isin(*wanted)))
        .where(match)
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == len(wanted))
        .select(F.col("run_id").alias("id"))
    )
    return children(runs).join(hits, "id", "left_semi").select("parent_id", "id", "name").orderBy(order_by)
