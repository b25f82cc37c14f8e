"""Model versions as a table: lookup, registration, comparison and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.operators import ranked

# Names of the champion alias and of the stages, and the gain a candidate needs.
CHAMPION = "champion"
PRODUCTION = "Production"
ARCHIVED = "Archived"
MIN_GAIN = 0.02

MEASURES = ("accuracy", "precision", "recall", "f1_score", "auc_roc")

# Metrics assumed when a model's metric file has none.
DEFAULT_METRICS = {"auc": 0.85, "accuracy": 0.82, "f1": 0.75}


def version_number() -> Column:
    """Versions are text; they order as numbers."""
    return F.col("version").cast("long")


def registry_latest(registry: DataFrame) -> DataFrame:
    """Newest version per (model, stage)."""
    newest = Window.partitionBy("model_name", "stage").orderBy(version_number().desc())
    return (registry.withColumn("_rank", F.row_number().over(newest))
            .filter("_rank = 1").drop("_rank"))


def resolve_champion(registry: DataFrame, alias: str = CHAMPION, stage: str = PRODUCTION) -> DataFrame:
    """One version per model: by alias, else the newest of the stage, else the newest of all."""
    ranked = registry.select(
        "model_name", "version",
        F.when(F.col("alias") == alias, 0).when(F.col("stage") == stage, 1).otherwise(2).alias("_prio"))
    order = Window.partitionBy("model_name").orderBy("_prio", version_number().desc())
    reason = F.when(F.col("_prio") == 0, "alias").when(F.col("_prio") == 1, "stage").otherwise("latest")
    return (ranked.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
            .select("model_name", "version", reason.alias("reason")))


def _tagged(entries: str, kind: str) -> Column:
    named = F.transform_keys(entries, lambda k, _: F.concat(F.lit(f"{kind}."), k))
    return F.coalesce(named, F.create_map().cast("map<string,string>"))


def register_version(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Append candidates (model_name, run_id, params, metrics, source_path, ts) as next versions.

    Candidates of one model are numbered by time, those without one first, inside cells of
    time, so that a model with very many of them is not numbered by one task. Parameters
    and metrics become tags named ``param.x`` and ``metric.x``.
    """
    known = registry.groupBy("model_name").agg(F.max(version_number()).alias("_max"))
    placed = ranked.with_totals_below(
        candidates.withColumns({"_one": F.lit(1), "_at": F.struct("ts", "run_id")}),
        ["model_name"], "_at", ["_one"], ranked.time_bits(F.col("ts")))
    number = F.coalesce(F.col("_max"), F.lit(0)) + F.col("_one_below") + 1
    added = placed.join(known, "model_name", "left").select(
        "model_name", number.cast("string").alias("version"),
        F.lit(None).cast("string").alias("alias"), F.lit("None").alias("stage"), "run_id",
        F.col("ts").alias("creation_timestamp"), F.col("ts").alias("last_updated_timestamp"),
        F.col("source_path").alias("description"),
        F.map_concat(_tagged("params", "param"), _tagged("metrics", "metric")).alias("tags"))
    return registry.select(*added.columns).unionByName(added)


def promote_champion(registry: DataFrame, promotions: DataFrame) -> DataFrame:
    """New snapshot after promoting (model_name, version, ts), one version per model.

    The promoted version takes the stage and the alias; other versions of its
    model lose the alias, and those in the stage are archived.
    """
    moves = promotions.select("model_name", F.col("version").alias("_new"), F.col("ts").alias("_ts"))
    rows = registry.join(moves, "model_name", "left")
    touched = F.col("_new").isNotNull()
    chosen = touched & (F.col("version") == F.col("_new"))
    archived = touched & ~chosen & (F.col("stage") == PRODUCTION)
    return rows.select(
        "model_name", "version",
        F.when(chosen, CHAMPION).when(touched & (F.col("alias") == CHAMPION), None)
        .otherwise(F.col("alias")).alias("alias"),
        F.when(chosen, PRODUCTION).when(archived, ARCHIVED).otherwise(F.col("stage")).alias("stage"),
        "run_id", "creation_timestamp",
        F.when(chosen | archived, F.col("_ts")).otherwise(F.col("last_updated_timestamp"))
        .alias("last_updated_timestamp"),
        "description",
        F.when(chosen, F.map_concat(
            F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")),
                         lambda k, v: k != CHAMPION),
            F.create_map(F.lit(CHAMPION), F.lit("true")))).otherwise(F.col("tags")).alias("tags"))


def write_snapshot(registry: DataFrame, root: str, snapshot: str) -> str:
    """Write a registry snapshot to its own directory; readers switch by path."""
    path = f"{root.rstrip('/')}/{snapshot}"
    registry.write.mode("errorifexists").parquet(path)
    return path


def metrics_long_to_wide(df: DataFrame, names: tuple[str, ...], key: str = "model_name") -> DataFrame:
    """Rows of (model, metric, value) as one row per model with the named metrics and their map."""
    wide = df.groupBy(key).agg(*[
        F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    entries = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names])
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    return wide.withColumn("metrics", F.map_from_entries(present))


def champion_challenger(metrics: DataFrame, registry: DataFrame) -> DataFrame:
    """Champion measures beside those of every model's newest version.

    ``metrics`` has one row per (model_name, version).
    """
    champions = resolve_champion(registry).select("model_name", "version")
    newest = (registry.groupBy("model_name").agg(F.max(version_number()).cast("string").alias("version")))
    def side(picks: DataFrame, prefix: str) -> DataFrame:
        return picks.join(metrics, ["model_name", "version"], "left").select(
            "model_name", *[F.col(c).alias(f"{prefix}_{c}") for c in ("version", *MEASURES)])
    return side(champions, "champion").join(side(newest, "new"), "model_name", "left")


def should_promote(pair: DataFrame, min_gain: float = MIN_GAIN) -> DataFrame:
    """Strictly more than the gain in F1; a missing side promotes nothing."""
    new, old = F.col("new_f1_score"), F.col("champion_f1_score")
    return pair.withColumns({
        "improvement_score": new - old,
        "should_promote": F.coalesce(new > old + F.lit(min_gain), F.lit(False))})
