"""Abnormal measurements per source, by Kalman filters over time buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ledgerloom.operators.joins import small
from ledgerloom.session import cut

#: 1.4826 times the median absolute deviation estimates a standard deviation.
MAD_SIGMA = 1.4826
#: Steps of every source's filter, whatever its size: equal shares of its readings in time order.
STEPS = 32
#: Ratios of level noise to reading noise (q / r) that are tried for every source; the likeliest is taken.
DRIFTS = (0.0, 0.001, 0.01, 0.1, 1.0)
#: Log likelihood that a drift must gain over none: one more parameter.
DRIFT_COST = 2.0
#: The variance of a median of n readings is this share of r / n.
MEDIAN_LOSS = 1.5708
#: A source's readings one after another; what it leaves open are equal rows.
ORDER = ("at", "reading_id", "y", "delta")


def _filtered(steps: Column, drift: Column, threshold: float) -> Column:
    """One pass of a local-level filter: struct(x, p, gain, told), told[k] the forecast (b, x, p) for step k before its reading.

    Of the columns level (x's start), start (its variance, in units of r) and r.
    State x[k] = x[k-1] + N(0, drift * r); step k measures the median of n
    readings with variance r / n (times MEDIAN_LOSS). p is in units of r. A
    step whose standardised innovation is beyond `threshold` is withheld; one
    without a reading only forecasts. gain is the log likelihood, up to a constant.
    """
    r = F.col("r")
    start = F.struct(F.col("level").alias("x"), F.col("start").alias("p"), F.lit(0.0).alias("gain"), F.array().cast("array<struct<b:int,x:double,p:double>>").alias("told"))

    def step(acc: Column, c: Column) -> Column:
        p = acc["p"] + drift
        s = p + F.when(c["n"] > 1, MEDIAN_LOSS / c["n"]).otherwise(1.0)
        e = c["m"] - acc["x"]
        z2 = e * e / (s * r)
        taken = c["m"].isNotNull() & (z2 <= threshold * threshold)
        return F.struct(
            F.when(taken, acc["x"] + p / s * e).otherwise(acc["x"]).alias("x"), F.when(taken, p * (1 - p / s)).otherwise(p).alias("p"),
            (acc["gain"] - F.coalesce(0.5 * (F.log(s) + F.least(z2, F.lit(threshold * threshold))), F.lit(0.0))).alias("gain"),
            F.concat(acc["told"], F.array(F.struct(c["b"].cast("int").alias("b"), acc["x"].alias("x"), p.alias("p")))).alias("told"),
        )

    return F.aggregate(steps, start, step)


def _forecasts(steps: DataFrame, threshold: float, drifts: tuple[float, ...]) -> DataFrame:
    """(source, drift, forecasts): by step the level (x, p) as forecast from the steps before and after it, never from itself."""
    tried = F.transform(F.array(*[F.lit(float(x)) for x in drifts]), lambda d: F.struct((_filtered(F.col("steps"), d, threshold)["gain"] - F.when(d > 0, DRIFT_COST).otherwise(0.0)).alias("gain"), (-d).alias("minus")))
    fitted = steps.withColumn("drift", -F.array_max(tried)["minus"])
    ahead = _filtered(F.col("steps"), F.col("drift"), threshold)["told"]
    back = F.reverse(_filtered(F.reverse("steps"), F.col("drift"), threshold)["told"])
    both = F.transform(F.arrays_zip(ahead.alias("a"), back.alias("z")), lambda f: F.struct(f["a"]["b"].alias("b"), ((f["a"]["x"] / f["a"]["p"] + f["z"]["x"] / f["z"]["p"]) / (1 / f["a"]["p"] + 1 / f["z"]["p"])).alias("x"), (1 / (1 / f["a"]["p"] + 1 / f["z"]["p"])).alias("p")))
    return fitted.select("source", "drift", F.map_from_entries(F.transform(both, lambda f: F.struct(f["b"], F.struct(f["x"], f["p"])))).alias("forecasts"))


def _shrunk(mad: str, n: str, typical: Column, prior_rows: float) -> Column:
    """A standard deviation from a median deviation, drawn towards the typical one by `prior_rows` rows' worth."""
    return MAD_SIGMA * F.sqrt((F.col(n) * F.pow(F.coalesce(mad, F.lit(0.0)), 2) + prior_rows * F.pow(typical, 2)) / (F.col(n) + prior_rows))


def _typical(spread: DataFrame) -> Column:
    return spread.where("moving >= 8 and mad > 0").agg(F.coalesce(F.percentile_approx("mad", 0.5, 10000), F.lit(0.01)).alias("typical")).scalar()


def innovations(changes: DataFrame, threshold: float = 7.0, drifts: tuple[float, ...] = DRIFTS, prior_rows: float = 6.0, still_share: float = 0.5, chunk_rows: int = 4096) -> DataFrame:
    """Every reading's standardised innovation by its source's state-space model.

    changes(reading_id, source, at, y, delta). Adds innovation, sigma, drift
    (the fitted q / r) and moves (fewer than `still_share` of the source's rows have
    a difference of nil). Each source's readings are cut, in time order, into
    STEPS equal shares; a share's median is one measurement of the filter's
    level, so a source of any size is pre-aggregated by mergeable sketches and
    its filter has the same number of steps. q / r is fitted by likelihood per
    source. A reading's forecast comes from the shares before and after its own
    (a forward and a backward filter), so it never vouches for itself. The
    standard deviation is that of the source's own innovations, by their median,
    drawn towards the typical one by `prior_rows` readings' worth. Tables of a
    row per source are sent to the readings where counted small. chunk divides
    the work of `frozen`, not its result: 0 throughout a source of `chunk_rows`
    or less, else parts of about so many readings that follow one another in time.
    """
    moving = F.when(F.col("delta") != 0, F.col("y"))
    at = F.coalesce(F.unix_micros(F.col("at").cast("timestamp")), F.lit(0))
    shares = F.array(*[F.lit(i / STEPS) for i in range(1, STEPS)])
    level = cut(changes.groupBy("source").agg(F.percentile_approx(moving, 0.5, 10000).alias("level"), F.percentile_approx(at, shares, 2000).alias("bounds"), F.avg((F.col("delta") == 0).cast("double")).alias("still"), F.count(F.lit(1)).alias("all"), F.min(at).alias("first"), F.max(at).alias("last")))
    b = F.size(F.filter("bounds", lambda t: t < at))
    # Chunks of about chunk_rows within a share, in time order, null times first as `frozen` sorts them.
    low, high = F.coalesce(F.get("bounds", F.col("b") - 1), F.col("first")), F.coalesce(F.get("bounds", F.col("b")), F.col("last"))
    place = (at - low) / F.greatest(high - low + 1, F.lit(1)) * F.ceil(F.col("all") / STEPS / chunk_rows)
    chunk = F.when(F.col("all") <= chunk_rows, F.lit(0)).when(F.col("at").isNull(), F.lit(1)).otherwise(F.col("b") * 1_000_000 + F.greatest(F.floor(place), F.lit(0)) + 2)
    placed = changes.join(small(level), "source").withColumn("b", b).withColumn("chunk", chunk.cast("long")).withColumn("level", F.coalesce("level", F.lit(0.0))).withColumn("moves", F.col("still") < still_share)
    placed = cut(placed.select("reading_id", "source", "at", "y", "delta", "level", "moves", "b", "chunk"))
    apart = placed.groupBy("source").agg(F.count(moving).alias("moving"), F.percentile_approx(F.abs(moving - F.col("level")), 0.5, 10000).alias("mad"))
    r = apart.select("source", F.pow(_shrunk("mad", "moving", _typical(apart), prior_rows), 2).alias("r"))
    quarters = F.percentile_approx(moving, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000)
    medians = placed.groupBy("source", "b").agg(F.max("level").alias("level"), F.count(moving).alias("n"), quarters.alias("q")).withColumn("m", F.get("q", F.lit(1)))
    # Where a share holds enough readings, the noise around its own median is the reading noise: a drift doesn't swell it.
    wide = F.when(F.col("n") >= 8, F.pow((F.get("q", F.lit(2)) - F.get("q", F.lit(0))) / 1.349, 2))
    gathered = medians.groupBy("source").agg(F.max("level").alias("level"), F.avg(wide).alias("local"), F.percentile_approx(F.abs(F.col("m") - F.col("level")), 0.5, 1000).alias("apart"), F.array_sort(F.collect_list(F.struct("b", "n", "m"))).alias("steps"))
    fitted = gathered.join(r, "source").withColumn("r", F.when(F.col("local") > 0, F.least("r", "local")).otherwise(F.col("r")))
    # How far from the source's level the filter may start: as far as its steps lie.
    steps = fitted.withColumn("start", F.greatest(F.lit(1.0), F.pow(MAD_SIGMA * F.coalesce("apart", F.lit(0.0)), 2) / F.col("r")))
    told = cut(_forecasts(steps, threshold, drifts))
    f = F.try_element_at("forecasts", F.col("b"))
    met = placed.join(small(told), "source").withColumn("e", (F.col("y") - f["x"]) / F.sqrt(1 + f["p"])).drop("forecasts")
    spread = met.groupBy("source").agg(F.count(moving).alias("moving"), F.percentile_approx(F.when(F.col("delta") != 0, F.abs("e")), 0.5, 10000).alias("mad"))
    spread = cut(spread)
    sigma = cut(spread.select("source", _shrunk("mad", "moving", _typical(spread), prior_rows).alias("sigma")))
    return met.join(small(sigma), "source").select("reading_id", "source", "at", "y", "delta", "moves", "drift", "chunk", "sigma", (F.col("e") / F.col("sigma")).alias("innovation"))


def _still(by: WindowSpec, run: int, vanishing: float) -> Column:
    last = by.rowsBetween(1 - run, 0)
    return (F.count(F.lit(1)).over(last) == run) & (F.stddev_pop(F.col("y") / F.col("sigma")).over(last) < vanishing)


def frozen(told: DataFrame, run: int = 8, vanishing: float = 1e-3, wanted: Column | None = None) -> DataFrame:
    """Adds `frozen`: the reading lies in `run` readings of its source, one after another, whose innovations don't vary.

    Against a forecast held still over the run, their standard deviation is
    under `vanishing` of the source's (sigma). Runs are looked for within the
    chunks of `innovations`, so that no task sorts a whole hot source, and once
    more among the outermost `run` - 1 readings of each chunk of a source with
    several: a run across a border, or across many, lies in these alone. Only
    rows that are frozen or `wanted` (all, if not given) need be in the result.
    """
    by = W.partitionBy("source", "chunk").orderBy(*ORDER)
    ends = F.max("_ends").over(by.rowsBetween(0, run - 1)) == 1
    k = F.row_number().over(by)
    outer = (F.col("chunk") > 0) & ((k < run) | F.lead("source", run - 1).over(by).isNull())
    # Past this reading come some of its chunk that aren't among the outermost.
    parts = (k == run - 1) & F.lead("source", run).over(by).isNotNull()
    within = told.withColumn("_ends", _still(by, run, vanishing).cast("int")).withColumns({"frozen": ends, "_outer": outer, "_parts": parts})
    within = cut(within.where(F.coalesce(F.lit(True) if wanted is None else wanted, F.lit(False)) | F.col("frozen") | F.col("_outer")).drop("_ends"))
    on = W.partitionBy("source").orderBy(*ORDER)
    whole = ~F.coalesce(F.max("_parts").over(on.rowsBetween(1 - run, -1)), F.lit(False))
    across = within.where("_outer").withColumn("_ends", (whole & _still(on, run, vanishing)).cast("int"))
    across = across.withColumn("frozen", F.col("frozen") | (F.max("_ends").over(on.rowsBetween(0, run - 1)) == 1)).drop("_ends")
    return within.where("not _outer").unionByName(across).drop("_outer", "_parts")


def abnormal(readings: DataFrame, threshold: float = 7.0, drifts: tuple[float, ...] = DRIFTS, run: int = 8, magnitude_sigmas: float = 10.0) -> DataFrame:
    """Spikes, stuck values and impossible readings of paired measurements.

    readings(reading_id, source, at, old_value, new_value, may_be_negative).
    Returns one row per abnormal reading: (reading_id, source, reason,
    innovation), reason `impossible`, `stuck` or `spike`, in this order of
    precedence. y is log10 |new/old|.

    - impossible: negative where that isn't allowed, or a magnitude more than
      `magnitude_sigmas` robust deviations above the median magnitude of all
      rows (on the log scale). These rows don't enter any filter.
    - stuck: vanishing innovation variance in a source that otherwise moves.
      Either of a pair's own two readings, whose one innovation (new against
      the forecast that it stays) is nil to the last digit, or of `run` and
      more readings of the source one after another (see `frozen`).
    - spike: a standardised innovation of the source's filter beyond
      `threshold`; flagged steps are withheld from its level.

    Every row is judged, in tasks that hold no whole hot source. Both values nil
    count as stuck; one nil value against another is judged as a change from or
    to a millionth. Rows with a null value, source or id give no reading and are
    never flagged, a null time counts as the earliest; repeated readings are
    each judged; an empty table gives no rows. Further columns are ignored.
    """
    rows = readings.where("reading_id is not null and source is not null and old_value is not null and new_value is not null").select(
        F.col("reading_id").cast("long").alias("reading_id"), F.col("source").cast("string").alias("source"), "at",
        F.col("old_value").cast("double").alias("o"), F.col("new_value").cast("double").alias("n"), (F.col("old_value") - F.col("new_value")).cast("double").alias("delta"),
        F.coalesce(F.col("may_be_negative"), F.lit(False)).alias("signed"),
    )
    size = F.log10(F.greatest(F.abs("o"), F.abs("n"), F.lit(0.01)))
    middle = rows.agg(F.percentile_approx(size, 0.5, 10000).alias("middle"))
    spread = rows.withColumn("middle", middle.scalar()).agg(F.max("middle").alias("middle"), F.percentile_approx(F.abs(size - F.col("middle")), 0.5, 10000).alias("spread"))
    bound = spread.select((F.col("middle") + magnitude_sigmas * MAD_SIGMA * F.greatest("spread", F.lit(0.1))).alias("bound"))
    ratio = F.log10(F.greatest(F.abs("n"), F.lit(1e-6)) / F.greatest(F.abs("o"), F.lit(1e-6)))
    judged = rows.withColumn("bound", bound.scalar()).withColumn("impossible", (size > F.col("bound")) | (~F.col("signed") & ((F.col("o") < 0) | (F.col("n") < 0)))).withColumn("y", ratio)
    judged = cut(judged.select("reading_id", "source", "at", "y", "delta", "impossible"))
    same, far = F.col("delta") == 0, F.abs("innovation") > threshold
    told = frozen(innovations(judged.where("not impossible"), threshold, drifts).drop("drift"), run, wanted=(F.col("moves") & same) | far)
    reason = F.when(F.col("moves") & (same | F.col("frozen")), "stuck").when(far, "spike")
    out = told.withColumn("reason", reason).where("reason is not null").select("reading_id", "source", "reason", "innovation")
    return out.unionByName(judged.where("impossible").select("reading_id", "source", F.lit("impossible").alias("reason"), F.lit(None).cast("double").alias("innovation")))
