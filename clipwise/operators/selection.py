"""Filters, rankings and set operations over manifests and reports.

Rankings that keep a few rows are ``orderBy`` and ``limit``, which Spark runs as a heap per task; places are numbered over those
few, or within a group. Every order ends in a unique key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwise.functions import text as T

from .tables import materialize

#: The bounds within which a clip may serve as a reference, or as a prompt.
REFERENCE = (5.0, 12.0, 0.85)
PROMPT = (6.0, 12.0, 0.9)


def kept(df: DataFrame) -> DataFrame:
    return df.where(F.col("decision") == "keep")


def english(clips: DataFrame, lexicon: list[str] | DataFrame, key: str = "clip", broadcast_rows: int = 100_000) -> DataFrame:
    """Adds ``english``, the share of a clip's tokens that are in a lexicon, 0 without tokens.

    A few words are compared in place. A table of ``word`` meets the tokens, by a broadcast only if it is small, and the shares
    the clips by their ``key``, which is unique and not null.
    """
    tokens = T.tokens(F.col("text"))
    if not isinstance(lexicon, DataFrame):
        return clips.withColumn("english", T.share_of(tokens, lexicon))
    known = lexicon.select("word").distinct().withColumn("_known", F.lit(1))
    known = F.broadcast(known) if known.count() <= broadcast_rows else known
    met = clips.select(key, F.explode(tokens).alias("word")).join(known, "word", "left")
    shares = met.groupBy(key).agg((F.count("_known") / F.count("*")).alias("english"))
    return clips.join(shares, key, "left").withColumn("english", F.coalesce("english", F.lit(0.0)))


def references(clips: DataFrame, lexicon: list[str] | DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Clips of 5 to 12 s whose words are English enough, but for the stems in ``excluded`` (column ``stem``)."""
    low, high, share = REFERENCE
    found = english(clips.where(F.col("dur").between(low, high)), lexicon).where(F.col("english") >= share).drop("english")
    return found if excluded is None else found.withColumn("stem", T.stem(F.col("audio"))).join(excluded.select("stem"), "stem", "left_anti").drop("stem")


def prompts(clips: DataFrame, lexicon: list[str] | DataFrame) -> DataFrame:
    """Clips of 6 to 12 s, English enough, without a hum or a bracketed note."""
    low, high, share = PROMPT
    clean = ~F.lower("text").contains("hmm") & ~F.col("text").contains("[")
    return english(clips.where(F.col("dur").between(low, high) & clean), lexicon).where(F.col("english") >= share).drop("english")


VIEWS: Mapping[str, str] = {"fail": "status = 'FAIL'", "unrev": "NOT reviewed", "ovr": "override"}


def view(df: DataFrame, name: str) -> DataFrame:
    """Rows of a review view, or all rows if it has none."""
    found = df.where(VIEWS[name])
    return df if found.isEmpty() else found


def parsed_ids(c: Column) -> Column:
    """Integers of a list separated by commas or blanks; other words are left out."""
    return F.transform(F.filter(F.split(c, r"[,\s]+"), lambda x: x.rlike(r"^\d+$")), lambda x: x.cast("bigint"))


def only(df: DataFrame, key: str, listed: str) -> DataFrame:
    """Rows whose key is in a list such as ``1,5 9``; an empty list keeps all."""
    ids = df.sparkSession.range(1).select(F.explode(parsed_ids(F.lit(listed))).alias(key))
    return df.join(F.broadcast(ids), key, "left_semi") if any(x.isdigit() for x in listed) else df


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows of an order; all of them for 0."""
    return df.orderBy(*order).limit(n) if n else df


def placed(df: DataFrame, *order: Column | str, keys: tuple[str, ...] = (), window_rows: int = 2_000_000) -> DataFrame:
    """Adds ``place``, from 1, in each group's order, which is total.

    Tables of at most ``window_rows`` rows are ranked by a window over the keys. In larger ones a group may be most of the table, so
    rows are dealt by ranges of keys and order, written, and ranked within their range. Only a range's first group can have begun in an
    earlier one, so the places to add are at most a row for each range, and are broadcast.
    """
    if df.count() <= window_rows:
        return _placed(df, *order, keys=keys)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = materialize(df.repartitionByRange(parts, *keys, *order).withColumn("_r", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    begun = ranged.groupBy(*keys, "_r").count().select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_r").alias("_s"), F.sum("count").over(before).alias("_start")).where("_start > 0")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_r") == F.col("_s"))
    ranked = _placed(ranged, *order, keys=(*keys, "_r")).join(F.broadcast(begun), same, "left")
    return ranked.withColumn("place", (F.col("place") + F.coalesce("_start", F.lit(0))).cast("int")).select(*df.columns, "place")


def _placed(df: DataFrame, *order: Column | str, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of an order with their ``place``; only these are ranked in one task."""
    return _placed(df.orderBy(*order).limit(n), *order)


def with_prefix(audio: Column, prefix: Column | str) -> Column:
    """``<prefix>/<file>`` of a path."""
    return F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, F.lit("/"), T.basename(audio))


def speech(words: DataFrame, word: str = "word") -> DataFrame:
    """Words without an aligner's noise marks and empty ones."""
    return words.where(~F.trim(F.col(word)).isin("<star>", ""))


def numbered(df: DataFrame, *order: str, prefix: Column | str = "", keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``n``, from 1 in each group's order, and ``id``: the prefix and the number with four digits or more."""
    ranked = placed(df, *order, keys=keys)
    ranked = ranked.withColumn("n", F.col("place")).drop("place")
    return ranked.withColumn("id", F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, F.format_string("%04d", "n")))


def sliced(df: DataFrame, low: int, high: int, *order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows at places ``low`` to ``high`` - 1, from 0, of each group's order."""
    return placed(df, *order, keys=keys).where(F.col("place").between(low + 1, high)).drop("place")


def middle(df: DataFrame, n: int, *order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """``n`` rows from the place count // 2 on, of each group's order."""
    ranked = placed(df, *order, keys=keys)
    sizes = ranked.groupBy(*keys).agg(F.floor(F.count("*") / 2).alias("_c"))
    near = ranked.join(sizes, list(keys)) if keys else ranked.crossJoin(sizes)  # a row of counts
    return near.where((F.col("place") > F.col("_c")) & (F.col("place") <= F.col("_c") + n)).select(*df.columns)


def missing(rows: DataFrame, done: DataFrame, key: str, shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rows without a counterpart, and the first few keys of them for a message."""
    left = rows.join(done.select(key), key, "left_anti")
    return left, left.select(key).orderBy(key).limit(shown)


def registered(rows: DataFrame, registry: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Rows with the registry's columns; a key that it lacks gets the default row."""
    joined = rows.join(registry.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) if v is not None else F.col(c) for c, v in defaults.items()})


def first_present(*readers: Callable[[], DataFrame]) -> DataFrame:
    """The first of several sources that exists; the last one's error, if none does."""
    for read in readers[:-1]:
        try:
            return read()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return readers[-1]()


def union_all(*sides: DataFrame) -> DataFrame:
    """All rows of tables of like columns, which are matched by name; absent ones are null."""
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def keys_of(*sides: DataFrame, key: str) -> DataFrame:
    """Keys of any side, once each."""
    return union_all(*[s.select(key) for s in sides]).distinct()


def unknown(named: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys that are named but not known, once each."""
    return named.select(key).distinct().join(known.select(key), key, "left_anti")


def ordered_distinct(df: DataFrame, column: str, *order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each value of a group once, with ``place``: its turn by first appearance."""
    first = df.groupBy(*keys, column).agg(F.min(F.struct(*order)).alias("_first"))
    return placed(first, "_first", keys=keys).drop("_first")
