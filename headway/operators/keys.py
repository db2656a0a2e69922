"""Join-key diagnosis and the ladder of key spellings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.functions import clean_id, lstrip_zeros, zfill
from headway.operators.columns import drop_null
from headway.operators.joins import reshuffled
from headway.schemas import FEED


class Rung(NamedTuple):
    """A way to spell a key: ``spell`` applied to its raw, clean, bare or neat form.

    Bare is the clean key without leading zeros, neat is the bare key cleaned again.
    """

    name: str
    form: str
    spell: Callable[[Column], Column]


def _as_is(c: Column) -> Column:
    return c


def _lower_pad(c: Column) -> Column:
    return zfill(F.lower(c))


# Spellings tried in turn.  The first that gives a feed any common key is used for all its keys.
LADDER: tuple[Rung, ...] = (
    Rung("exact", "raw", _as_is),
    Rung("lower", "clean", F.lower),
    Rung("pad", "clean", _lower_pad),
    Rung("strip", "bare", _as_is),
    Rung("strip_lower", "neat", F.lower),
    Rung("strip_lower_pad", "neat", _lower_pad),
)
# The shorter ladder of the shapes job.
MACRO_LADDER = LADDER[:3]

Ladder = Sequence[Rung]


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct non-null keys of the left side without a partner on the right."""
    keys = drop_null(left, on[-1:]).select(*on).distinct()
    return keys.join(right.select(*on).distinct(), list(on), "left_anti")


def _sides(left: DataFrame, right: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Distinct non-null keys of both sides with flags ``l`` and ``r``, from one aggregation."""
    parts = [
        df.select(*by, key, F.lit(side == 0).alias("l"), F.lit(side == 1).alias("r"))
        for side, df in enumerate((left, right))
    ]
    both = parts[0].unionByName(parts[1]).where(F.col(key).isNotNull())
    return both.groupBy(*by, key).agg(F.max("l").alias("l"), F.max("r").alias("r"))


def distinct_keys(df: DataFrame, keys: Sequence[str], by: Sequence[str] = FEED) -> DataFrame:
    """Exact number of distinct non-null values of each key per feed, one row per feed and key.

    Each key is counted from its distinct values, so a feed with most of the rows is spread as well.
    """
    long = df.select(*by, F.explode(F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("string"))])).alias("key", "value"))
    found = long.where("value is not null").distinct().groupBy(*by, "key").agg(F.count("*").alias("n_distinct"))
    return found


def key_sketches(df: DataFrame, keys: Sequence[str], by: Sequence[str] = FEED, lg_nom: int = 12) -> DataFrame:
    """A HyperLogLog sketch of each key per feed, one row per feed and key.

    Sketches of parts can be stored and put together by ``merge_sketches``.  Their relative error is
    about 1.04 / 2 ** (lg_nom / 2): 1.6 % by default, one standard deviation.
    """
    long = df.select(*by, F.explode(F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("string"))])).alias("key", "value"))
    return long.where("value is not null").groupBy(*by, "key").agg(F.hll_sketch_agg("value", lg_nom).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (*FEED, "key")) -> DataFrame:
    """One sketch for each value of ``by``, of fewer columns for wider groups, and its estimate."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("estimate", F.hll_sketch_estimate("sketch"))


def key_overlap(
    left: DataFrame,
    right: DataFrame,
    key: str,
    by: Sequence[str] = FEED,
    samples: int = 5,
) -> DataFrame:
    """Profile of a join key per feed: distinct, common and one-sided counts.

    Where nothing is common the smallest keys of each side are given as samples.
    """
    sides = _sides(left, right, key, by)
    is_left, is_right = F.col("l"), F.col("r")
    counts = sides.groupBy(*by).agg(
        F.count_if(is_left).alias("n_left"),
        F.count_if(is_right).alias("n_right"),
        F.count_if(is_left & is_right).alias("n_common"),
        F.count_if(is_left & ~is_right).alias("n_only_left"),
        F.count_if(~is_left & is_right).alias("n_only_right"),
    )
    # Spark cuts each group to ``samples`` rows before the shuffle, so a large feed is no matter.
    order = Window.partitionBy(*by, "l").orderBy(key)
    top = (
        sides.where(is_left != is_right)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= samples)
        .groupBy(*by)
        .agg(
            F.array_sort(F.collect_list(F.when(is_left, F.col(key)))).alias("sample_left"),
            F.array_sort(F.collect_list(F.when(is_right, F.col(key)))).alias("sample_right"),
        )
    )
    none = F.array().cast("array<string>")
    apart = F.col("n_common") == 0
    return counts.join(top, list(by), "left").withColumns(
        {
            name: F.when(apart, F.coalesce(F.col(name), none)).otherwise(none)
            for name in ("sample_left", "sample_right")
        }
    )


def _spelled(df: DataFrame, key: str, ladder: Ladder) -> DataFrame:
    """Each row once per rung, with the ``spelling`` of its key and the clean key ``resolved``."""
    # One step per form keeps the expressions from being written out again and again.
    forms = (
        df.where(F.col(key).isNotNull())
        .withColumn("raw", F.col(key).cast("string"))
        .withColumn("clean", clean_id("raw"))
        .withColumn("bare", lstrip_zeros("clean"))
        .withColumn("neat", clean_id("bare"))
    )
    rungs = F.array(
        *[
            F.struct(F.lit(i).alias("rung"), rung.spell(F.col(rung.form)).alias("spelling"))
            for i, rung in enumerate(ladder)
        ]
    )
    return forms.select(*df.columns, F.inline(rungs)).withColumn("resolved", clean_id("spelling"))


def _matches(
    left: DataFrame, right: DataFrame, key: str, ladder: Ladder, by: Sequence[str]
) -> DataFrame:
    """Pairs of a distinct left key and a right row that meet on some rung.

    A rung is tried on the spelling as it is, while the join itself ignores outer space.
    """
    keys = _spelled(left.select(*by, key).distinct(), key, ladder)
    rows = _spelled(right, key, ladder).withColumnRenamed("spelling", "other").drop(key)
    pairs = keys.join(rows, [*by, "rung", "resolved"])
    return pairs.withColumn("same", F.col("spelling") == F.col("other")).drop("spelling", "other")


def _best(matches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The first rung of each feed on which any spelling is common."""
    best = matches.where("same").groupBy(*by).agg(F.min("rung").alias("rung"))
    return reshuffled(best, by[-1])


def key_choice(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ladder: Ladder = LADDER,
    by: Sequence[str] = FEED,
) -> DataFrame:
    """The rung each feed uses and the keys common under it; ``none`` when no rung helps."""
    names = F.array(*[F.lit(rung.name) for rung in ladder])
    spelled = _spelled(_sides(left, right, key, by), key, ladder)
    common = (
        spelled.groupBy(*by, "rung", "spelling")
        .agg((F.max("l") & F.max("r")).alias("common"))
        .groupBy(*by, "rung")
        .agg(F.count_if("common").alias("n_common"))
    )
    best = F.min(F.when(F.col("n_common") > 0, F.struct("rung", "n_common")))
    return common.groupBy(*by).agg(best.alias("b")).select(
        *by,
        F.coalesce(F.get(names, "b.rung"), F.lit("none")).alias("rung"),
        F.coalesce("b.n_common", F.lit(0)).alias("n_common"),
    )


def lookup_for(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ladder: Ladder = LADDER,
    by: Sequence[str] = FEED,
) -> DataFrame:
    """The right table keyed by the raw keys of the left one, with the key as ``resolved``.

    Joining the left table to this on its raw key equals rewriting both sides and joining them,
    but leaves the (large) left table with one join.  All other work is on its distinct keys;
    nothing reaches the driver.
    """
    matches = _matches(left, right, key, ladder, by)
    return matches.join(_best(matches, by), [*by, "rung"]).drop("rung", "same")


def resolve_keys(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ladder: Ladder = LADDER,
    by: Sequence[str] = FEED,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the key rewritten to the spelling that makes their feed match.

    Keys of a feed without any match are only cleaned.
    """
    sides = _sides(left, right, key, by)
    best = _best(_matches(left, right.select(*by, key).distinct(), key, ladder, by), by)
    chosen = _spelled(sides.select(*by, key), key, ladder).join(best, [*by, "rung"])
    mapping = reshuffled(chosen.select(*by, key, "resolved"), key)

    def rewrite(df: DataFrame) -> DataFrame:
        joined = df.join(mapping, [*by, key], "left")
        return joined.withColumn(key, F.coalesce("resolved", clean_id(key))).select(*df.columns)

    return rewrite(left), rewrite(right)
