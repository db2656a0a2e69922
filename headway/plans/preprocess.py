"""First stage of a run: check the feeds, build the combo tables, report an outcome per feed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from headway.functions import run_id
from headway.operators.joins import anti_filter, feed_key, repeated_routes
from headway.operators.keys import LADDER, Ladder, key_choice
from headway.plans.combos import combo_rows, combos, valid_routes
from headway.schemas import FEED

# Messages of feeds that cannot be used.
NO_COMBOS = "No se encontraron combinaciones válidas."
REPEATED_ROUTES = "DataFrame index must be unique for orient='index'."
UNREADABLE = "Filas ilegibles en: "


class Preprocessed(NamedTuple):
    tables: dict[str, DataFrame]
    rows: DataFrame
    combos: DataFrame
    valid_routes: DataFrame
    outcomes: DataFrame


def outcomes(
    tables: dict[str, DataFrame], rows: DataFrame, execution_id: str | None = None, errors: DataFrame | None = None
) -> DataFrame:
    """One row per feed that has trips or routes, or read errors.

    A feed with a repeated route id, without any combo, or with ``errors`` (those of
    ``sources.tables.read_checked``) is an error row and not an exception.
    The routes themselves are in ``valid_routes``; here is their number.
    """
    feeds = tables["routes"].select(*FEED).union(tables["trips"].select(*FEED)).distinct()
    unread = None
    if errors is not None:
        unread = errors.groupBy(*FEED).agg(F.concat_ws(", ", F.array_sort(F.collect_set("table"))).alias("unread"))
        feeds = feeds.union(unread.select(*FEED)).distinct()
    repeated = repeated_routes(tables["routes"]).select(*FEED).distinct()
    usable = valid_routes(rows).groupBy(*FEED).agg(F.count("*").alias("n_routes"))
    joined = feeds.join(repeated.withColumn("repeated", F.lit(True)), list(FEED), "left").join(
        usable, list(FEED), "left"
    )
    if "shapes" in tables:
        drawn = tables["shapes"].select(*FEED).distinct().withColumn("has_shapes", F.lit(True))
        joined = joined.join(drawn, list(FEED), "left")
    else:
        joined = joined.withColumn("has_shapes", F.lit(False))

    joined = joined.withColumn("unread", F.lit(None).cast("string")) if unread is None else joined.join(unread, list(FEED), "left")
    message = F.when(F.col("unread").isNotNull(), F.concat(F.lit(UNREADABLE), F.col("unread"))).when(F.col("repeated"), F.lit(REPEATED_ROUTES)).when(
        F.col("n_routes").isNull(), F.lit(NO_COMBOS)
    )
    ok = F.col("message").isNull()
    folder = F.concat_ws(
        "/",
        F.lit("GTFS_TEMP/preprocessed"),
        *[F.concat(F.lit(f"{name}="), F.col(name)) for name in FEED],
        F.col("execution_id"),
    )
    return joined.withColumns({"message": message, "execution_id": run_id(execution_id)}).select(
        *FEED,
        "execution_id",
        F.when(ok, F.lit("success")).otherwise(F.lit("error")).alias("status"),
        "message",
        F.when(ok, folder).alias("temp_dir"),
        F.when(ok, F.col("n_routes")).alias("n_routes"),
        F.when(ok, F.coalesce("has_shapes", F.lit(False))).alias("has_shapes"),
        F.when(ok, F.lit(True)).alias("has_data"),
    )


def with_rung(outcomes: DataFrame, tables: dict[str, DataFrame], ladder: Ladder = LADDER) -> DataFrame:
    """Outcomes with the key spelling each feed's routes are matched by, and the ids common under it.

    ``none`` where no spelling gives a common id; null for feeds without trips and routes.
    """
    choice = key_choice(tables["trips"], tables["routes"], "route_id", ladder)
    named = choice.withColumnsRenamed({"rung": "key_rung", "n_common": "n_common_keys"})
    return outcomes.join(named, list(FEED), "left")


def preprocess(
    tables: dict[str, DataFrame], execution_id: str | None = None, errors: DataFrame | None = None
) -> Preprocessed:
    """Tables, combo rows, combos, valid routes and outcomes of all feeds.

    Feeds with repeated route ids have no combos, nor have those with read ``errors``.
    """
    bad = repeated_routes(tables["routes"])
    rows = combo_rows(tables["trips"], tables["stop_times"])
    good = anti_filter(rows, bad, FEED)
    return Preprocessed(
        tables=tables,
        rows=good,
        combos=combos(good, tables["routes"]),
        valid_routes=valid_routes(good),
        outcomes=with_rung(outcomes(tables, rows, execution_id, errors), tables),
    )


def row_totals(product: DataFrame, feeds: DataFrame) -> DataFrame:
    """Rows of a product per feed and whether any were produced."""
    counts = product.groupBy(*FEED).agg(F.count("*").alias("n_rows"))
    joined = feeds.select(*FEED).distinct().join(counts, feed_key(), "left")
    return joined.withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).withColumn(
        "produced", F.col("n_rows") > 0
    )
