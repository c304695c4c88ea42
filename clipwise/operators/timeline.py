"""Interval algebra over recordings: merges, range joins, runs, folds and padding.

Tables have ``lecture``, ``start`` and ``end`` (double); all work is partitioned by lecture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import greedy


#: The dyadic blocks that make up the bins from {low} to below {high}: at each level the ones at the rims that no wider block takes.
_COVER = """flatten(transform(sequence(0, length(bin({high} - {low})) - 1), k -> transform(
    filter(array(struct(-shiftright(-{low}, k) AS at, -shiftright(-{low}, k) % 2 <> 0 AS own),
                 struct(shiftright({high}, k) - 1 AS at, shiftright({high}, k) % 2 <> 0 AS own)),
           e -> e.own AND -shiftright(-{low}, k) < shiftright({high}, k)),
    e -> struct({side} AS side, k AS level, e.at AS at))))"""
#: All blocks around a bin, up to the widest of a span of so many bins.
_AROUND = "transform(sequence(0, length(bin({widest})) - 1), k -> struct({side} AS side, k AS level, shiftright({low}, k) AS at))"


def range_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], predicate: Column, width: float, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """Pairs of one key whose spans satisfy a predicate that only touching spans can.

    An equi-join on the key and a dyadic block of time bins, instead of a nested loop. Of two spans that touch, either the
    right one starts in the left one, or the left one in the right one and in a later bin. So each side is
    listed under the few blocks that make up its span, and its start under all blocks around it: a start lies in one block
    of a span at most, and a pair comes once. A span of n bins takes about 2 * log2(n) rows, a start log2 of
    the other side's longest span, whatever the width of a bin. Nulls in a span or key pair with nothing.
    """

    def binned(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        low, high = F.least(*span), F.greatest(*span)
        known = df.where(F.col(span[0]).isNotNull() & F.col(span[1]).isNotNull())
        return known.withColumn("_b0", F.floor(low / width)).withColumn("_b1", F.floor(high / width) + 1).withColumn("_b2", F.col("_b0") + 1)

    def listed(df: DataFrame, other: DataFrame, side: int, low: str) -> DataFrame:
        widest = other.agg(F.max(F.col("_b1") - F.col("_b0")).alias("w")).scalar()
        own = F.expr(f"IF(_b1 > {low}, {_COVER.format(low=low, high='_b1', side=side)}, array())")
        around = F.expr(_AROUND.format(widest="_w", low="_b0", side=1 - side))
        at = df.withColumn("_w", F.coalesce(widest, F.lit(1).cast("long"))).withColumn("_e", F.explode(F.concat(own, around)))
        # A block as one number: half the size of the struct in each of the rows that are shuffled.
        at = at.withColumn("_at", F.shiftleft("_e.at", 7) + F.col("_e.level") * 2 + F.col("_e.side"))
        return at.drop("_b0", "_b1", "_b2", "_w", "_e")

    l, r = binned(left, left_span), binned(right, right_span)
    return listed(l, r, 0, "_b0").join(listed(r, l, 1, "_b2"), [*keys, "_at"]).where(predicate).drop("_at")


def merge_gaps(turns: DataFrame, target: str, gap: float, *, veto: bool = True, width: float = 8.0) -> DataFrame:
    """Merged intervals of the target speaker: lecture, iv (from 1), start, end.

    A turn joins the interval before it if it starts at most ``gap`` after that one's end and, with ``veto``, no other
    speaker overlaps the gap. The end becomes the turn's own, even where turns nest, so the last turn's
    end always is the end before, and one window suffices. ``turns`` has a unique ``id`` besides.
    """
    order = Window.partitionBy("lecture").orderBy("start", "end", "id")
    own = turns.where(F.col("speaker") == target).withColumn("g0", F.lag("end").over(order))
    near = F.col("g0").isNotNull() & (F.col("start") - F.col("g0") <= gap)
    if veto:
        others = turns.where(F.col("speaker") != target).select("lecture", F.col("start").alias("o0"), F.col("end").alias("o1"))
        hit = range_join(own.where(near).select("lecture", "id", "g0", F.col("start").alias("g1")), others, ("g0", "g1"), ("o0", "o1"), (F.col("o0") < F.col("g1")) & (F.col("o1") > F.col("g0")), width)
        own = own.join(hit.select("lecture", "id").distinct().withColumn("_hit", F.lit(True)), ["lecture", "id"], "left")
        near = near & F.col("_hit").isNull()
    grouped = own.withColumn("iv", F.sum(F.when(near, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("lecture", "iv").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "end", "id")).alias("end"))


def covered(words: DataFrame, intervals: DataFrame, share: float = 0.9, width: float = 8.0) -> DataFrame:
    """Words with ``overlap``, their total overlap with intervals, and ``is_target``: it reaches ``share`` of the word."""
    iv = intervals.select("lecture", F.col("start").alias("s"), F.col("end").alias("e"))
    inside = F.greatest(F.lit(0.0), F.least("end", "e") - F.greatest("start", "s"))
    sums = range_join(words.select("lecture", "id", "start", "end"), iv, ("start", "end"), ("s", "e"), F.lit(True), width).groupBy("lecture", "id").agg(F.sum(inside).alias("overlap"))
    joined = words.join(sums, ["lecture", "id"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
    return joined.withColumn("is_target", F.col("overlap") / F.greatest(F.lit(1e-6), F.col("end") - F.col("start")) >= share)


def end_asof(points: DataFrame, intervals: DataFrame, slack: float = 1e-3, width: float = 8.0) -> DataFrame:
    """Points (lecture, id, t) with ``iv_end``: the end of the first interval around t, else t."""
    iv = intervals.select("lecture", F.col("start").alias("s"), F.col("end").alias("e"), (F.col("start") - slack).alias("_s"), (F.col("end") + slack).alias("_e"))
    inside = (F.col("s") - slack <= F.col("t")) & (F.col("t") <= F.col("e") + slack)
    ends = range_join(points.withColumn("_t", F.col("t")), iv, ("t", "_t"), ("_s", "_e"), inside, width).groupBy("lecture", "id").agg(F.min(F.struct("s", "e"))["e"].alias("_end"))
    return points.join(ends, ["lecture", "id"], "left").withColumn("iv_end", F.coalesce("_end", "t")).drop("_end")


def runs(df: DataFrame, flag: str, *order: str, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """Rows for which ``flag`` holds, with ``run``, the number of rows without it before them."""
    over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("run", F.sum(F.when(F.col(flag), 0).otherwise(1)).over(over)).where(F.col(flag))


def forward_fill(df: DataFrame, column: str, *order: str, keys: tuple[str, ...] = ("lecture",)) -> Column:
    return F.last(column, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def _fold(df: DataFrame, step: Column, keys: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """Applies a fold over each group's rows in order; a group is one lecture or run, and fits a task.

    The fold's state holds what it has put out so far and is copied at each step that adds to it, so cost grows with the
    square of a group's output: thousands of clips a lecture are well within it, a whole corpus as one group isn't.
    """
    rows = F.array_sort(F.collect_list(F.struct(*fields)))
    return df.groupBy(*keys).agg(rows.alias("_rows")).select(*keys, F.explode(step).alias("c")).select(*keys, "c.*")


def _by_length(rows: DataFrame, keys: tuple[str, ...], most: int, short, long) -> DataFrame:
    """``short`` of the groups of at most ``most`` rows and ``long`` of the others, if there are any."""
    large = rows.groupBy(*keys).count().where(F.col("count") > most).select(*keys)
    if large.isEmpty():
        return short(rows)
    return short(rows.join(large, list(keys), "left_anti")).unionByName(long(rows.join(large, list(keys), "left_semi")))


def greedy_clips(words: DataFrame, least: float = 9.0, most: float = 20.0, hard: tuple[float, float] = (4.0, 30.0), keys: tuple[str, ...] = ("lecture",), *, fold_rows: int = 20_000) -> DataFrame:
    """Clips of consecutive words: first, last (from 0), start, end.

    A clip is closed when it lasts ``most``, or ``least`` at the end of a sentence, and by the last word; those outside
    the hard bounds are dropped with their words. ``words`` has ``start`` (0 or later), ``end``, ``id`` and ``stops``. Recordings of
    at most ``fold_rows`` words are folded, longer ones cut by ``greedy``; both give the same clips.
    """
    return _by_length(words, keys, fold_rows, lambda w: _folded_clips(w, least, most, hard, keys), lambda w: _chained_clips(w, least, most, hard, keys))


def _chained_clips(words: DataFrame, least: float, most: float, hard: tuple[float, float], keys: tuple[str, ...]) -> DataFrame:
    rows = greedy.numbered(words.select(*keys, "start", "end", "id", "stops"), "start", "end", "id", keys=keys)
    found = greedy.first_reached(rows, [greedy.Rule(most), greedy.Rule(least, flag="stops")], after=0, keys=keys)
    ends = found.withColumn("at", F.coalesce("at", F.col("n") - 1)).withColumn("end", F.coalesce("hit_end", "last"))
    steps = ends.select(*keys, "i", F.when(F.col("at") < F.col("n") - 1, F.col("at") + 1).alias("next"), "at", "start", "end")
    clips = greedy.chain(steps, keys=keys).where((F.col("end") - F.col("start")).between(*hard))
    return clips.select(*keys, F.col("i").cast("int").alias("first"), F.col("at").cast("int").alias("last"), "start", "end")


def _folded_clips(words: DataFrame, least: float, most: float, hard: tuple[float, float], keys: tuple[str, ...]) -> DataFrame:
    state = "cast(null as int)", "cast(null as double)"
    step = F.expr(
        f"""
        filter(aggregate(
          transform(_rows, (x, i) -> struct(x.start AS start, x.end AS end, x.stops AS stops, i AS i)),
          struct(cast(array() as array<struct<first:int,last:int,start:double,end:double>>) AS out, {state[0]} AS first, {state[1]} AS start),
          (a, x) -> CASE
            WHEN x.end - coalesce(a.start, x.start) >= {most}D
              OR (x.stops AND x.end - coalesce(a.start, x.start) >= {least}D) OR x.i = size(_rows) - 1
            THEN struct(concat(a.out, array(struct(coalesce(a.first, x.i) AS first, x.i AS last, coalesce(a.start, x.start) AS start, x.end AS end))) AS out,
                        {state[0]} AS first, {state[1]} AS start)
            ELSE struct(a.out AS out, coalesce(a.first, x.i) AS first, coalesce(a.start, x.start) AS start) END,
          a -> a.out), c -> c.end - c.start BETWEEN {hard[0]}D AND {hard[1]}D)
        """
    )
    return _fold(words, step, keys, ("start", "end", "id", "stops"))


def pack_segments(segments: DataFrame, most: float = 15.0, hard: tuple[float, float] = (3.0, 30.0), keys: tuple[str, ...] = ("lecture",), *, fold_rows: int = 20_000) -> DataFrame:
    """Consecutive segments packed while the end stays within ``most`` of the start: start, end, parts.

    A longer segment stands alone; only packs within the hard bounds are kept. Starts are 0 or later. Recordings of at most
    ``fold_rows`` segments are folded, longer ones cut by ``greedy``.
    """
    return _by_length(segments, keys, fold_rows, lambda s: _folded_packs(s, most, hard, keys), lambda s: _chained_packs(s, most, hard, keys))


def _chained_packs(segments: DataFrame, most: float, hard: tuple[float, float], keys: tuple[str, ...]) -> DataFrame:
    rows = greedy.numbered(segments.select(*keys, "start", "end", "id"), "start", "end", "id", keys=keys)
    found = greedy.first_reached(rows, [greedy.Rule(most, strict=True)], after=1, keys=keys)
    ends = found.withColumn("end", F.when(F.col("at").isNull(), F.col("last")).otherwise(F.col("hit_before")))
    steps = ends.select(*keys, "i", F.col("at").alias("next"), (F.coalesce("at", "n") - F.col("i")).cast("int").alias("parts"), "start", "end")
    return greedy.chain(steps, keys=keys).where((F.col("end") - F.col("start")).between(*hard)).select(*keys, "start", "end", "parts")


def _folded_packs(segments: DataFrame, most: float, hard: tuple[float, float], keys: tuple[str, ...]) -> DataFrame:
    step = F.expr(
        f"""
        filter(aggregate(_rows,
          cast(array() as array<struct<start:double,end:double,parts:int>>),
          (a, x) -> CASE
            WHEN size(a) > 0 AND x.end - element_at(a, -1).start <= {most}D
            THEN concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start AS start, x.end AS end, element_at(a, -1).parts + 1 AS parts)))
            ELSE concat(a, array(struct(x.start AS start, x.end AS end, 1 AS parts))) END),
          c -> c.end - c.start BETWEEN {hard[0]}D AND {hard[1]}D)
        """
    )
    return _fold(segments, step, keys, ("start", "end", "id"))


def spaced_topk(rows: DataFrame, distance: float, k: int, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """Greedy picks, longest first, more than ``distance`` apart in ``tc``, ``k`` at most; ``rows`` has ``length``, ``tc``, ``id``."""
    step = F.expr(
        f"""
        aggregate(_rows, cast(array() as array<struct<id:bigint,tc:double,length:double>>),
          (a, x) -> IF(size(a) < {k} AND forall(a, p -> abs(x.tc - p.tc) > {distance}D),
                       concat(a, array(struct(x.id AS id, x.tc AS tc, -x.neg AS length))), a))
        """
    )
    return _fold(rows.withColumn("neg", -F.col("length")), step, keys, ("neg", "tc", "id"))


def pad(clips: DataFrame, lead: float = 0.15, tail: float = 0.15, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """Adds ``cut_start`` and ``cut_end``: the clip with pads that reach neither neighbour nor below 0."""
    order = Window.partitionBy(*keys).orderBy("start", "id")
    before = F.coalesce(F.lag("end").over(order), F.lit(0.0))
    after = F.coalesce(F.lead("start").over(order), F.col("end") + 1)
    return clips.withColumn("cut_start", F.greatest(F.col("start") - lead, before, F.lit(0.0))).withColumn(
        "cut_end", F.col("end") + F.least(F.lit(tail), F.greatest(F.lit(0.0), after - F.col("end")))
    )


def median3(df: DataFrame, column: str, *order: str, keys: tuple[str, ...] = ("lecture",)) -> Column:
    """Median of a value and its neighbours, nulls left out; the first and last row keep theirs."""
    w = Window.partitionBy(*keys).orderBy(*order)
    edge = F.lag(F.lit(1)).over(w).isNull() | F.lead(F.lit(1)).over(w).isNull()
    around = F.array_sort(F.array_compact(F.array(F.lag(column).over(w), F.col(column), F.lead(column).over(w))))
    n = F.size(around)
    middle = (F.get(around, F.floor((n - 1) / 2).cast("int")) + F.get(around, F.floor(n / 2).cast("int"))) / 2
    return F.when(edge, F.col(column)).otherwise(middle)


def octave_fix(f: Column, middle: Column, low: float = 75.0, above: float = 1.6) -> Column:
    """Halves a pitch while it is above ``above`` times the median and its half is at least ``low``."""
    k = F.greatest(F.lit(0), F.least(F.ceil(F.log2(f / (middle * above))), F.floor(F.log2(f / low))))
    return f / F.pow(F.lit(2.0), k)


def pad_runs(words: DataFrame, clips: DataFrame, intervals: DataFrame, lead: float = 0.15, tail: float = 0.15) -> DataFrame:
    """Clips of a run's words with ``cut_start`` and ``cut_end``, ``n`` words and the least and mean ``score`` of them.

    ``words`` has lecture, run, id, start, end and score, ``clips`` first and last, places in the run from 0. Pads reach
    neither the word before nor the one after; a run's first clip starts at most a second early, and no clip ends after the
    target's interval around its last word. Words meet their run's clips, so no run is compared with another.
    """
    keys = ("lecture", "run")
    order = Window.partitionBy(*keys).orderBy("start", "end", "id")
    near = words.select(*keys, "start", "end", "score", (F.row_number().over(order) - 1).alias("i"), F.lag("end").over(order).alias("_before"), F.lead("start").over(order).alias("_after"))
    met = near.join(clips.select(*keys, "first", "last"), list(keys)).where(F.col("i").between(F.col("first"), F.col("last")))
    at = lambda place, c: F.max(F.when(F.col("i") == F.col(place), F.col(c)))
    cut = met.groupBy(*keys, "first", "last").agg(
        at("first", "start").alias("start"), at("last", "end").alias("end"), at("first", "_before").alias("_before"), at("last", "_after").alias("_after"),
        F.count("*").alias("n"), F.min("score").alias("align_min"), F.avg("score").alias("align_mean"),
    )
    ends = end_asof(cut.withColumn("id", F.xxhash64("run", "first")).withColumn("t", F.col("end")), intervals)
    before = F.coalesce("_before", F.greatest(F.lit(0.0), F.col("start") - 1))
    padded = F.col("end") + F.least(F.lit(tail), F.greatest(F.lit(0.0), F.coalesce("_after", F.col("end") + 1) - F.col("end")))
    return ends.withColumn("cut_start", F.greatest(F.col("start") - lead, before, F.lit(0.0))).withColumn("cut_end", F.least(padded, F.col("iv_end"))).drop("_before", "_after", "id", "t", "iv_end")


#: A line that names its speaker.
HEADER = r"^\s*([A-Za-z][A-Za-z .]{1,30}):\s*(.*)$"


def target_lines(lines: DataFrame, target: str, *order: str, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """The target speaker's lines, from ``line``: all up to the first header; a header's own line gives what follows its colon.

    A header that matches ``target`` opens the speaker's turn, any other closes it.
    """
    line = F.col("line")
    header = line.rlike(HEADER)
    flagged = lines.withColumn("_own", F.when(header, line.rlike(target))).withColumn("_header", header)
    flagged = flagged.withColumn("_own", F.coalesce(forward_fill(flagged, "_own", *order, keys=keys), F.lit(True)))
    text = F.when(F.col("_header"), F.regexp_extract(line, HEADER, 2)).otherwise(line)
    return flagged.where("_own").withColumn("line", text).drop("_own", "_header")


def stable(df: DataFrame, bounds: dict[str, float], *order: str, reach: int = 3, least: int = 5, keys: tuple[str, ...] = ("lecture",)) -> Column:
    """Whether ``least`` frames around a row are measured, and each track's population deviation there is under its bound."""
    around = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-reach, reach)
    ok = F.lit(True)
    for track, bound in bounds.items():
        ok = ok & (F.count(track).over(around) >= least) & (F.stddev_pop(track).over(around) < bound)
    return F.coalesce(ok, F.lit(False))


def frame_energy(df: DataFrame, value: str, size: int, hop: int, *order: str, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """``db`` of every ``hop``-th window of ``size`` samples (from its first one on), below the group's loudest window."""
    group = Window.partitionBy(*keys)
    ahead = group.orderBy(*order).rowsBetween(0, size - 1)
    e = df.withColumn("_e", F.sqrt(F.avg(F.col(value) * F.col(value)).over(ahead))).withColumn("_i", F.row_number().over(group.orderBy(*order)) - 1)
    e = e.where(F.col("_i") % hop == 0).withColumn("_top", F.max("_e").over(group))
    return e.withColumn("frame", F.floor(F.col("_i") / hop)).withColumn("db", F.try_divide(F.col("_e"), F.col("_top"))).withColumn("db", 20 * F.log10(F.greatest("db", F.lit(1e-10)))).drop("_e", "_i", "_top")


def trailing_trim(df: DataFrame, value: str, keep: int, *order: str, threshold: float = -40.0, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """Samples up to ``keep`` after the last one above the peak's share."""
    group = Window.partitionBy(*keys)
    ranked = df.withColumn("_i", F.row_number().over(group.orderBy(*order))).withColumn("_p", F.max(F.abs(value)).over(group))
    loud = F.when(F.abs(value) > F.col("_p") * 10 ** (threshold / 20), F.col("_i"))
    last = F.coalesce(F.max(loud).over(group), F.max("_i").over(group))
    return ranked.withColumn("_last", last).where(F.col("_i") <= F.col("_last") + keep).drop("_i", "_p", "_last")


def interpolated(grid: DataFrame, points: DataFrame, x: str, y: str, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """``y`` at every x of a grid, on the line between the points around it; constant beyond the first and last.

    Grid and points are sorted together, up and down: each grid row sees the last point that came, a running value both times.
    """
    both = grid.select(*keys, x, F.lit(None).cast("double").alias("_y"), F.lit(1).alias("_g")).unionByName(
        points.select(*keys, x, F.col(y).cast("double").alias("_y"), F.lit(0).alias("_g"))
    )
    group = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    point = F.when(F.col("_y").isNotNull(), F.struct(F.col(x).alias("x"), F.col("_y").alias("y")))
    both = both.withColumn("_a", F.last(point, ignorenulls=True).over(group.orderBy(x, "_g")))
    both = both.withColumn("_b", F.last(point, ignorenulls=True).over(group.orderBy(F.desc(x), F.desc("_g"))))
    a, b = F.col("_a"), F.col("_b")
    line = a["y"] + (b["y"] - a["y"]) * F.try_divide(F.col(x) - a["x"], b["x"] - a["x"])
    value = F.when(a.isNull(), b["y"]).when(b.isNull() | (a["x"] == b["x"]), a["y"]).otherwise(line)
    return both.where("_g = 1").select(*keys, x, value.alias(y))


def interpolated_every(points: DataFrame, step: int, x: str, y: str, keys: tuple[str, ...] = ("lecture",)) -> DataFrame:
    """``interpolated`` at all multiples of ``step``, from the one below a group's first point to the one above its last.

    Only the points are dealt and sorted: each makes the part of the grid from itself up to the next one where it lies.
    Points without ``y`` extend the grid only.
    """
    group = Window.partitionBy(*keys).orderBy(x)
    point = F.when(F.col(y).isNotNull(), F.struct(F.col(x).alias("x"), F.col(y).cast("double").alias("y")))
    known = points.where(F.col(x).isNotNull()).select(*keys, x, point.alias("_p"))
    known = known.select(
        *keys,
        x,
        "_p",
        F.last("_p", ignorenulls=True).over(group.rowsBetween(Window.unboundedPreceding, 0)).alias("_a"),
        F.expr("lead(_p) IGNORE NULLS").over(group).alias("_b"),
        F.lag(x).over(group).alias("_before"),
        F.lead(x).over(group).alias("_after"),
    )
    above = F.ceil(F.col(x) / step)
    first = F.when(F.col("_before").isNull(), F.floor(F.col(x) / step)).otherwise(above)
    last = F.when(F.col("_after").isNull(), above).otherwise(F.ceil(F.col("_after") / step) - 1)
    grid = known.withColumn("_g", F.explode(F.when(first <= last, F.sequence(first, last)))).withColumn("_g", (F.col("_g") * step).cast("double"))

    at, ahead = F.col("_g"), F.col("_g") < F.col(x)
    a, b = F.when(~ahead, F.col("_a")), F.when(ahead, F.coalesce("_p", "_b")).otherwise(F.col("_b"))
    line = a["y"] + (b["y"] - a["y"]) * ((at - a["x"]) / (b["x"] - a["x"]))
    value = F.when(a.isNull(), b["y"]).when(b.isNull() | (a["x"] == at), a["y"]).otherwise(line)
    return grid.select(*keys, at.alias(x), value.alias(y))
