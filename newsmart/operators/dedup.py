"""Near-duplicate marking inside (country, day) blocks.

Rank order inside a block is tier, then newest publication, then article id. A row is a primary
unless an earlier primary of its block has a similar title; otherwise it points to the first such
primary.

How a block of any size is handled:

* Equal titles collapse first (partial aggregation before the shuffle), so copies of one title cost
  one row however many there are.
* No pair is ever a row. Work proceeds in waves: the first ``chunk_rows`` undecided titles of every
  block are resolved together, then the block's other undecided titles, spread over slots of bounded
  size, are compared with the primaries just found. Matched titles leave. A block up to the chunk
  size is done in the first wave, and a cluster of near copies disappears with its first primary. Chunks and slots
  double with every wave up to ``most_rows``, so small ones take few waves more, and a primary is sent to few slots.
* A title's place in its block comes from a sort over ranges, and the first titles of a wave from the
  counts of undecided titles in buckets of places: no task sorts or holds a block.
* A similarity of 0.75 bounds the lengths of two titles by 5/3. Titles are dealt by length bands of
  that ratio, and a primary only goes to its own band and the two beside it.
* Nothing is dropped or capped; a wave only bounds what one task holds.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmart.config import DEDUP, Dedup
from newsmart.functions import text as X
from newsmart.functions.similarity import assign, resolve
from newsmart.operators.ordering import placed
from newsmart.session import Counters, counted, cut

BLOCK = ["cc", "art_date"]
TASKS_PER_CORE = 6


def candidates(articles: DataFrame, recheck: bool = False) -> DataFrame:
    """Passed, titled and (unless ``recheck``) unmarked articles with block, title key and rank."""
    rows = articles.filter((F.col("filter_decision") == "passed") & F.col("title").isNotNull())
    if not recheck and "duplicate_of" in articles.columns:
        rows = rows.filter(F.col("duplicate_of").isNull())
    day = X.kst_day(F.col("published_at"), F.col("fetched_at")).cast("string")
    rank = F.struct(
        F.coalesce("tier", F.lit(-1)).alias("tier"),
        F.col("published_at").isNull().alias("undated"),
        F.coalesce(-F.unix_micros("published_at"), F.lit(0)).alias("age"),
        F.col("article_id").alias("id"),
    )
    return rows.select(
        "article_id",
        F.coalesce(F.nullif(F.col("primary_country_code"), F.lit("")), F.lit("GLOBAL")).alias("cc"),
        F.coalesce(day, F.lit("unknown")).alias("art_date"),
        X.title_key(F.col("title")).alias("title_key"),
        rank.alias("rank"),
    )


def distinct_titles(rows: DataFrame) -> DataFrame:
    """One row per block and non-empty title key: the rank of its first article and the copy count."""
    return (
        rows.filter(F.col("title_key") != "")
        .groupBy(*BLOCK, "title_key")
        .agg(F.min("rank").alias("rank"), F.count("*").alias("copies"))
    )


def mark_equal_titles(rows: DataFrame) -> DataFrame:
    """``article_id, duplicate_of`` when only equal title keys count as duplicates."""
    rows = cut(rows)  # narrow, and read twice: the articles behind it are not
    titles = cut(distinct_titles(rows))
    firsts = titles.select(*BLOCK, "title_key", F.col("rank.id").alias("first_id"))
    joined = _with_titles(rows, firsts, titles, DEDUP)
    return joined.select(
        "article_id", F.when(F.col("first_id") != F.col("article_id"), F.col("first_id")).alias("duplicate_of")
    )


_RESOLVED = "cc string, art_date string, title_key string, rank_id long, primary_id long"
_RANK = ["tier", "undated", "age", "id"]


def _tasks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-partition for heavy Python groups.

    The titles are few bytes but much work, so the number of tasks is named: adaptive execution
    would otherwise merge the small partitions into a few tasks. Several tasks a core even out groups of unequal size.
    """
    return df.repartition(_task_count(df.sparkSession), *keys)


def _task_count(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def _marked(pdf: pd.DataFrame, found: np.ndarray, primary_ids: np.ndarray) -> pd.DataFrame:
    """Rows with the id behind each found position; NULL where nothing was found."""
    primary = pd.Series(pd.NA, index=pdf.index, dtype="Int64")
    hit = found >= 0
    primary[hit] = primary_ids[found[hit]]
    return pdf[["cc", "art_date", "title_key"]].assign(rank_id=pdf["id"], primary_id=primary)


def _ranked(titles: DataFrame, *keys: str) -> DataFrame:
    return titles.select(*[F.col(key).alias(key) for key in (*keys, "title_key")], "rank.*")


def _resolve_heads(heads: DataFrame, threshold: float) -> DataFrame:
    """Greedy marking of a chunk of titles per block, one block per call."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(_RANK, ignore_index=True)
        return _marked(pdf, resolve(pdf["title_key"].tolist(), threshold), pdf["id"].to_numpy())

    return _tasks(_ranked(heads, *BLOCK), BLOCK).groupBy(*BLOCK).applyInPandas(run, _RESOLVED)


def _compare_rest(rest: DataFrame, primaries: DataFrame, threshold: float) -> DataFrame:
    """``primary_id`` of the undecided titles among new primaries, one slot of a block's length band per call."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values(_RANK, ignore_index=True)
        found = assign(right["title_key"].tolist(), left["title_key"].tolist(), threshold)
        return _marked(left, found, right["id"].to_numpy())

    keys = [*BLOCK, "band", "slot"]
    sides = [_tasks(_ranked(side, *keys), keys).groupBy(*keys) for side in (rest, primaries)]
    return sides[0].cogroup(sides[1]).applyInPandas(run, _RESOLVED)


def band_edges(threshold: float, longest: int = 1 << 31) -> list[int]:
    """First lengths of the length bands 1, 2, ...: titles two bands or more apart cannot reach ``threshold``.

    Of lengths a < b the ratio is 2a / (a + b) at most, so it misses the threshold t if b > a (2 - t) / t. Ratios are
    rounded, so t is taken a trifle lower.
    """
    if threshold <= 0:
        return []
    least = Fraction(threshold) * (1 - Fraction(1, 10**12))
    ratio, edges = (2 - least) / least, [1]
    while edges[-1] <= longest:
        edges.append(max(edges[-1] + 1, int(ratio * (edges[-1] - 1)) + 1))
    return edges


def _banded(titles: DataFrame, threshold: float) -> DataFrame:
    edges = ", ".join(f"{edge}L" for edge in band_edges(threshold))
    band = F.expr(f"size(filter(array({edges}), edge -> edge <= length(title_key)))") if edges else F.lit(0)
    return titles.withColumn("band", band)


def _cutoffs(open_titles: DataFrame, chunk: int) -> DataFrame:
    """Per block the last bucket of places whose titles, with all before them, are at most ``chunk``; and all its titles."""
    counts = open_titles.groupBy(*BLOCK, "bucket").agg(F.count("*").alias("titles"))
    whole = Window.partitionBy(*BLOCK)
    summed = counts.select(
        *BLOCK, "bucket", F.sum("titles").over(whole.orderBy("bucket")).alias("so_far"), F.sum("titles").over(whole).alias("all"),
    )
    fits = F.col("so_far") <= chunk
    return summed.groupBy(*BLOCK).agg(F.max(F.when(fits, F.col("bucket"))).alias("last"), F.max("all").alias("titles"))


def resolve_titles(titles: DataFrame, settings: Dedup = DEDUP) -> DataFrame:
    """``cc, art_date, title_key, rank_id, primary_id`` for distinct titles of all blocks.

    ``titles`` must be cheap to read again (a stored or checkpointed table).
    """
    largest = titles.groupBy(*BLOCK).count().agg(F.max("count")).first()[0] or 0
    if largest <= settings.chunk_rows:
        return _resolve_heads(titles, settings.threshold)
    # A bucket has no more titles than a chunk, so every wave takes one bucket of each block at least.
    width = max(settings.chunk_rows // 16, 1)
    numbered = placed(_banded(titles.select(*BLOCK, "title_key", "rank"), settings.threshold), BLOCK, ["rank"])
    open_titles = cut(numbered.withColumn("bucket", F.expr(f"place div {width}")).drop("place"))
    keys, done = [*BLOCK, "title_key"], []
    chunk, slot_rows = settings.chunk_rows, settings.slot_rows
    while True:
        cutoffs = cut(_cutoffs(open_titles, chunk))
        if (cutoffs.agg(F.max("titles")).first()[0] or 0) <= chunk:
            break
        split = open_titles.join(cutoffs.select(*BLOCK, "last"), BLOCK)
        heads = cut(split.filter(F.col("bucket") <= F.col("last")).drop("last"))
        resolved = cut(_resolve_heads(heads, settings.threshold))
        done.append(resolved)
        primaries = heads.join(resolved.filter(F.col("primary_id").isNull()).select(*keys), keys, "left_semi")
        rest = split.filter(F.col("bucket") > F.col("last")).drop("last")
        slots = cut(rest.groupBy(*BLOCK, "band").agg(F.ceil(F.count("*") / slot_rows).cast("int").alias("slots")))
        slot = F.pmod(F.xxhash64("title_key"), F.col("slots")).cast("int")
        near = F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1))
        every_slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1))
        sent = primaries.withColumn("band", near).join(slots, [*BLOCK, "band"]).withColumn("slot", every_slot)
        dealt = rest.join(slots, [*BLOCK, "band"]).withColumn("slot", slot)
        compared = cut(_compare_rest(dealt, sent, settings.threshold))
        done.append(compared.filter(F.col("primary_id").isNotNull()))
        still = compared.filter(F.col("primary_id").isNull()).select(*keys)
        open_titles = cut(rest.join(still, keys, "left_semi"))
        chunk, slot_rows = (max(rows, min(2 * rows, settings.most_rows)) for rows in (chunk, slot_rows))
    done.append(_resolve_heads(open_titles, settings.threshold))
    return reduce(DataFrame.unionByName, done)


def _with_titles(rows: DataFrame, resolved: DataFrame, titles: DataFrame, settings: Dedup) -> DataFrame:
    """Rows with their title's result. Rows with an empty key have none: they pass by the join, where they would
    all meet in one task per block."""
    empty = F.col("title_key") == ""
    found = _salted(rows.filter(~empty), resolved, titles, settings)
    return found.unionByName(rows.filter(empty), allowMissingColumns=True)


def _salted(rows: DataFrame, resolved: DataFrame, titles: DataFrame, settings: Dedup) -> DataFrame:
    """Join the rows with their title's result, spreading titles with very many copies.

    At most ``rows / hot_copies`` titles can be hot; they are counted before they are broadcast. More
    than the limit are left to the adaptive skew join.
    """
    keys = [*BLOCK, "title_key"]
    hot = titles.filter(F.col("copies") > settings.hot_copies).select(
        *keys, F.ceil(F.col("copies") / settings.hot_copies).cast("int").alias("salts")
    )
    count = hot.count()
    if count == 0 or count > settings.hot_titles_broadcast:
        return rows.join(resolved, keys, "left")
    hot = F.broadcast(hot)
    salts = F.coalesce(F.col("salts"), F.lit(1))
    salted = rows.join(hot, keys, "left").withColumn("salt", F.pmod(F.xxhash64("article_id"), salts).cast("int"))
    spread = resolved.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.drop("salts").join(spread.drop("salts"), [*keys, "salt"], "left")


def mark_duplicates(
    articles: DataFrame, recheck: bool = False, settings: Dedup = DEDUP, touched_by: DataFrame | None = None,
    counters: Counters | None = None,
) -> DataFrame:
    """``article_id, cc, art_date, duplicate_of`` for every checked article (NULL: not a duplicate).

    ``articles`` carries the source's ``primary_country_code`` and ``tier`` and the filter decision. With ``touched_by``
    (article ids) only the blocks of these articles are checked, with all their articles.
    """
    rows = cut(candidates(articles, recheck))  # narrow, and read twice: the articles behind it are not
    if touched_by is not None:
        rows = cut(rows.join(rows.join(touched_by, "article_id", "left_semi").select(*BLOCK).distinct(), BLOCK, "left_semi"))
    titles = cut(distinct_titles(rows))
    resolved = resolve_titles(titles, settings)
    joined = _with_titles(rows, resolved, titles, settings)
    primary = F.coalesce(F.col("primary_id"), F.col("rank_id"))
    marks = joined.select(
        "article_id", *BLOCK, F.when(primary != F.col("article_id"), primary).alias("duplicate_of")
    )
    if counters is None:
        return marks
    return counted(marks, "dedup", counters, checked=F.count(F.lit(1)), duplicates=F.count("duplicate_of"))
