"""Skew-safe per-series ordering primitives.

A per-ticker window (``partitionBy("ticker")``) puts a whole series in one
task: one hot ticker holding a third of the rows would serialise the job.
The primitives here never do that:

* :func:`with_ordinal` numbers the rows of each series with a small count
  table (rows per (series, calendar period)) whose running sum gives each
  period's offset; the row number itself is a window over
  (series, period) only.
* :func:`blocked` cuts every series into fixed row blocks and copies the
  ``back`` rows before (and ``fwd`` rows after) each block into it as a
  halo, so any window that looks at most ``back`` rows back / ``fwd`` rows
  ahead is exact when partitioned by (series, block).
* :func:`ewm` evaluates an exponentially weighted mean (adjust=False,
  seeded with the first value) inside a block with relative weights; the
  halo is long enough that older rows weigh less than ``EWM_TOL``.
* :func:`ewm_columns` evaluates the same mean over the whole history and with
  NULLs as pandas has them: a block is an affine map of the state that enters
  it, such maps compose associatively, and a prefix composition over the block
  table gives each block its entering state.  No halo, no tolerance.
* :func:`running_sums` gives an exact unbounded cumulative sum: local
  cumulative sum plus the running total of the (tiny) per-block table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORD = "_ord"       # 0-based position inside the series
BLK = "_blk"       # block id inside the series
HOME = "_home"     # row belongs to this block (not a halo copy)
REL = "_rel"       # position relative to the block's first (halo) row


def with_ordinal(df: DataFrame, by: list[str], order: str, *, period: str = "month",
                 tiebreak: tuple[str, ...] = (), with_count: bool = False) -> DataFrame:
    """Add ``_ord`` (0-based row position inside each ``by`` group).

    ``period`` is a ``date_trunc`` unit bounding the rows a single window
    partition sees (daily bars: a month is <= 31 rows).  With
    ``with_count`` the group size is added as ``_n``.
    """
    per = "_per"
    d = df.withColumn(per, F.date_trunc(period, F.col(order)))
    counts = d.groupBy(*by, per).agg(F.count(F.lit(1)).alias("_cnt"))
    wo = Window.partitionBy(*by).orderBy(per)
    offs = counts.select(
        *by, per,
        (F.sum("_cnt").over(wo.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cnt")).alias("_off"),
        *([F.sum("_cnt").over(Window.partitionBy(*by)).alias("_n")] if with_count else []),
    )
    # offs has one row per (series, period): the optimizer broadcasts it
    # when its measured size allows, otherwise a shuffle join.
    # NULL tickers and dates are series and periods of their own
    offs = offs.select(*[F.col(c).alias(f"_{c}_o") for c in (*by, per)], *[c for c in offs.columns if c not in (*by, per)])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_o")) for c in (*by, per)]
    d = d.join(offs, same).drop(*[f"_{c}_o" for c in (*by, per)])
    rn = F.row_number().over(Window.partitionBy(*by, per).orderBy(order, *tiebreak))
    return d.withColumn(ORD, F.col("_off") + rn - 1).drop("_off", per)


def max_block_rows(alphas, back: int, fwd: int, cap: int = 4096) -> int:
    """Largest power-of-two block so relative EWM weights cannot overflow.

    Inside a partition the weight (1-a)^-j reaches (1-a)^-(B+back+fwd);
    keep the exponent under e^650.
    """
    worst = max([-math.log(1.0 - a) for a in alphas if 0 < a < 1] or [1e-9])
    limit = int(650.0 / worst) - back - fwd
    b = 64
    while b * 2 <= min(limit, cap):
        b *= 2
    while b > max(limit, 1):  # very fast decay: short blocks
        b //= 2
    return b


def blocked(df: DataFrame, by: list[str], block: int, back: int, fwd: int) -> DataFrame:
    """Explode each row into its home block and the blocks it is halo for.

    Adds ``_blk`` (block id), ``_home`` (true for the home copy) and
    ``_rel`` (position from the first row of the block's partition).
    Row duplication is ``(back + fwd) / block``.
    """
    o = F.col(ORD)
    lo = F.floor((o - F.lit(fwd)) / block).cast("long")
    hi = F.floor((o + F.lit(back)) / block).cast("long")
    lo = F.greatest(lo, F.lit(0).cast("long"))
    d = df.withColumn(BLK, F.explode(F.sequence(lo, hi)))
    start = F.greatest(F.col(BLK) * block - back, F.lit(0))
    return d.withColumn(HOME, F.floor(o / block) == F.col(BLK)).withColumn(REL, o - start)


def block_window(by: list[str]):
    return Window.partitionBy(*by, BLK).orderBy(ORD)


def cumulative(by: list[str]):
    return block_window(by).rowsBetween(Window.unboundedPreceding, 0)


def rolling(by: list[str], n: int):
    return block_window(by).rowsBetween(-(n - 1), 0)


def gated_rolling(agg, x: Column, by: list[str], n: int) -> Column:
    """Rolling aggregate with pandas ``min_periods = n``: NULL unless the
    last ``n`` rows exist and are all non-null."""
    w = rolling(by, n)
    return F.when(F.count(x).over(w) == n, agg(x).over(w))


def ewm(x: Column, alpha: float, by: list[str], *, seed_ord: int = 0) -> Column:
    """EWM mean, adjust=False: y = a*x + (1-a)*y_prev, seeded y = x at row
    ``seed_ord`` (earlier rows NULL).

    y_t = sum_i c_i q^(t-i) with q = 1-a, evaluated as
    (running sum of c_i q^-rel_i) * q^rel_t inside the block partition.
    """
    # One shared decay rate L = -ln q, so q^-rel_i * q^rel_t =
    # exp(L*(rel_i-rel_t)) and the rounding of L cancels for the dominant
    # (recent) terms.  L = L1 + L2 with L1 on a 2^-20 grid: rel*L1 is exact
    # in double (rel < 2^13), so exp() never sees a rounded large argument.
    lam = -math.log1p(-alpha)
    l1 = math.floor(lam * 2.0 ** 20) / 2.0 ** 20
    l2 = lam - l1
    o = F.col(ORD)
    c = F.when(o == seed_ord, x).when(o > seed_ord, x * F.lit(alpha))
    rel = F.col(REL).cast("double")

    def grow(sign: float) -> Column:
        return F.exp(rel * F.lit(sign * l1)) * F.exp(rel * F.lit(sign * l2))

    s = F.sum(c * grow(1.0)).over(cumulative(by))
    return F.when(o >= seed_ord, s * grow(-1.0))


# ---------------------------------------------------------------------------
# Exponential averages over the whole history, as prefix states of blocks
# ---------------------------------------------------------------------------
_SUPER = 512  # blocks whose states are composed in one list


def _rate(alpha: float) -> tuple[float, float]:
    """-ln(1 - alpha), split so that position * first part is exact."""
    lam = -math.log1p(-alpha)
    l1 = math.floor(lam * 2.0 ** 20) / 2.0 ** 20
    return l1, lam - l1


def _weights(gap: Column, alpha: Column) -> tuple[Column, Column]:
    """What the old mean and the new value count after ``gap`` rows: pandas
    lets the old weight decay over NULL rows too and renormalises."""
    old = F.when(gap == 1, 1.0 - alpha).otherwise(F.pow(1.0 - alpha, gap.cast("double")))
    total = F.when(gap == 1, F.lit(1.0)).otherwise(old + alpha)
    return old / total, alpha / total


def _enter(w: Column, last: Column, t: Column, alpha: Column) -> Column:
    """The mean after the first value of block ``t``, entered with ``w``."""
    old, new = _weights(t["f"] - last, alpha)
    return F.when(w.isNull(), t["v"]).otherwise(old * w + new * t["v"])


def _compose(a: Column, b: Column) -> Column:
    """State map of block ``a`` followed by ``b``.  A block's map: ordinals of
    its first and last value (f, l), its first value v, and p, r: the mean
    after its last value is p * (mean after its first one) + r."""
    old, new = _weights(b["f"] - a["l"], b["alpha"])
    both = F.struct(a["alpha"].alias("alpha"), a["f"].alias("f"), a["v"].alias("v"), b["l"].alias("l"), (a["p"] * old * b["p"]).alias("p"),
                    (b["p"] * (old * a["r"] + new * b["v"]) + b["r"]).alias("r"))
    return F.when(a["f"].isNull(), b).when(b["f"].isNull(), a).otherwise(both)


def _entering(states: DataFrame, by: list[str]) -> DataFrame:
    """(by, spec, block, w, last): the mean that enters each block and the
    ordinal of the last value before it, from (by, spec, block, t)."""
    none = F.lit(None).cast("struct<alpha:double,f:bigint,v:double,l:bigint,p:double,r:double>")
    empty = F.struct(none.alias("acc"), F.array().cast("array<struct<block:bigint,t:struct<alpha:double,f:bigint,v:double,l:bigint,p:double,r:double>>>").alias("before"))

    def step(s, x):
        t = x["t"]
        return F.struct(F.when(s["acc"].isNull(), t).otherwise(_compose(s["acc"], t)).alias("acc"),
                        F.concat(s["before"], F.array(F.struct(x["block"].alias("block"), s["acc"].alias("t")))).alias("before"))

    super_ = F.floor(F.col("block") / _SUPER).alias("super")
    lists = states.groupBy(*by, "spec", super_).agg(F.sort_array(F.collect_list(F.struct("block", "t"))).alias("ts"))  # at most _SUPER entries
    lists = lists.select(*by, "spec", "super", F.aggregate("ts", empty, step).alias("s"))
    # one entry for each _SUPER blocks of a series
    zero = F.struct(F.lit(None).cast("double").alias("w"), F.lit(None).cast("bigint").alias("last"),
                    F.array().cast("array<struct<super:bigint,w:double,last:bigint>>").alias("out"))

    def walk(s, x):
        t = x["t"]
        w = F.when(t["f"].isNull(), s["w"]).otherwise(t["p"] * _enter(s["w"], s["last"], t, t["alpha"]) + t["r"])
        return F.struct(w.alias("w"), F.coalesce(t["l"], s["last"]).alias("last"),
                        F.concat(s["out"], F.array(F.struct(x["super"].alias("super"), s["w"].alias("w"), s["last"].alias("last")))).alias("out"))

    tops = lists.groupBy(*by, "spec").agg(F.sort_array(F.collect_list(F.struct("super", F.col("s.acc").alias("t")))).alias("ts"))
    tops = tops.select(*[F.col(c).alias(f"_{c}_t") for c in by], F.col("spec").alias("_spec_t"), F.explode(F.aggregate("ts", zero, walk)["out"]).alias("top"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_t")) for c in by] + [F.col("spec") == F.col("_spec_t"), F.col("super") == F.col("top.super")]
    rows = lists.join(tops, same).select(*by, "spec", "top", F.explode("s.before").alias("b"))
    t, w, last = F.col("b.t"), F.col("top.w"), F.col("top.last")
    inside = t.isNotNull() & t["f"].isNotNull()
    return rows.select(*by, "spec", F.col("b.block").alias("block"),
                       F.when(inside, t["p"] * _enter(w, last, t, t["alpha"]) + t["r"]).otherwise(w).alias("w"),
                       F.when(inside, t["l"]).otherwise(last).alias("last"))


def ewm_columns(df: DataFrame, by: list[str], specs: dict[str, tuple[str, float]]) -> DataFrame:
    """Adds exponential means ``{output: (input, alpha)}`` over the whole
    history of each series, equal to pandas ``ewm(alpha, adjust=False).mean()``
    with NULL inputs (leading NULLs give NULL; a NULL inside repeats the last
    mean, and the next value's weight is renormalised).

    ``df`` must be home rows of a blocked layout, blocks no longer than
    :func:`max_block_rows` allows.  Inside a block the mean is an affine
    function of the mean after the block's first value; the block table (one
    row a block and mean) is composed to prefix states in two levels, so no
    task sees more than one row for each ``_SUPER`` blocks of a series."""
    w = cumulative(by)
    past = block_window(by).rowsBetween(Window.unboundedPreceding, -1)
    o, inputs = F.col(ORD), sorted({x for x, _ in specs.values()})
    at = {x: F.when(F.col(x).isNotNull(), o) for x in inputs}
    d = df.select("*", *[c for x in inputs for c in (
        F.min(at[x]).over(w).alias(f"_f_{x}"), F.max(at[x]).over(w).alias(f"_l_{x}"), F.max(at[x]).over(past).alias(f"_g_{x}"),
        F.first(x, ignorenulls=True).over(w).alias(f"_v_{x}"), F.last(x, ignorenulls=True).over(w).alias(f"_x_{x}"))])
    numbered = list(enumerate(specs.items()))
    later = {x: F.col(x).isNotNull() & F.col(f"_g_{x}").isNotNull() for x in inputs}

    def total(x, alpha):  # q^gap + alpha, 1 without a NULL between
        gap = o - F.col(f"_g_{x}")
        return F.when(gap > 1, F.pow(F.lit(1.0 - alpha), gap.cast("double")) + alpha).otherwise(1.0)

    d = d.select("*", *[F.sum(F.when(later[x], F.log(total(x, a))).otherwise(0.0)).over(w).alias(f"_z{i}") for i, (_, (x, a)) in numbered])

    def grow(k, alpha, sign):
        l1, l2 = _rate(alpha)
        return F.exp(k * F.lit(sign * l1)) * F.exp(k * F.lit(sign * l2))

    local = []
    for i, (_, (x, a)) in numbered:
        first, last = F.col(f"_f_{x}"), F.col(f"_l_{x}")
        if a >= 1.0:  # nothing of the past stays
            alone = last == first
            local += [F.when(alone, 1.0).otherwise(0.0).alias(f"_p{i}"), F.when(alone, 0.0).otherwise(F.col(f"_x_{x}")).alias(f"_r{i}")]
            continue
        term = F.when(later[x], F.lit(a) / total(x, a) * F.col(x)) * grow((o - first).cast("double"), a, 1.0) * F.exp(F.col(f"_z{i}"))
        p = grow((last - first).cast("double"), a, -1.0) * F.exp(-F.col(f"_z{i}"))
        local += [p.alias(f"_p{i}"), (p * F.coalesce(F.sum(term).over(w), F.lit(0.0))).alias(f"_r{i}")]
    d = d.select("*", *local)
    maps = [F.struct(F.lit(i).alias("spec"), F.struct(
        F.lit(a).alias("alpha"), F.col(f"_f_{x}").alias("f"), F.col(f"_v_{x}").alias("v"), F.col(f"_l_{x}").alias("l"),
        F.col(f"_p{i}").alias("p"), F.col(f"_r{i}").alias("r")).alias("t")) for i, (_, (x, a)) in numbered]
    states = d.groupBy(*by, F.col(BLK).alias("block")).agg(F.max_by(F.array(*maps), ORD).alias("m"))
    states = states.select(*by, "block", F.explode("m").alias("m")).select(*by, "block", "m.spec", "m.t")
    back = _entering(states, by).groupBy(*[F.col(c).alias(f"_{c}_e") for c in by], F.col("block").alias("_block_e")).agg(
        *[F.max(F.when(F.col("spec") == i, F.col(c))).alias(f"_{c}{i}_e") for i, _ in numbered for c in ("w", "last")])
    d = d.join(back, [F.col(c).eqNullSafe(F.col(f"_{c}_e")) for c in by] + [F.col(BLK) == F.col("_block_e")])
    out = []
    for i, (name, (x, a)) in numbered:
        t = {"f": F.col(f"_f_{x}"), "v": F.col(f"_v_{x}")}
        seed = _enter(F.col(f"_w{i}_e"), F.col(f"_last{i}_e"), t, F.lit(a))
        out.append(F.when(t["f"].isNull(), F.col(f"_w{i}_e")).otherwise(F.col(f"_p{i}") * seed + F.col(f"_r{i}")).alias(name))
    return d.select(*df.columns, *out)


def running_sums(df: DataFrame, cols: dict[str, str], by: list[str],
                 totals: dict[str, str] | None = None) -> DataFrame:
    """Exact unbounded cumulative sums (``{input: output}``) over each series.

    ``df`` must be home rows of a blocked layout.  Block totals form a table
    of (rows / block) entries; their running sum is the carry added to the
    in-block cumulative sum (one small aggregation + one join for all
    columns).  ``totals`` (``{input: output}``) adds whole-series sums from
    the same table (e.g. complete rows per series).
    """
    totals = totals or {}
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    tot = df.groupBy(*by, BLK).agg(*[F.sum(z(x)).alias(f"_t_{o}") for x, o in {**cols, **totals}.items()])
    wb = Window.partitionBy(*by).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(*by, BLK,
                       *[F.coalesce(F.sum(f"_t_{o}").over(wb), F.lit(0.0)).alias(f"_c_{o}") for o in cols.values()],
                       *[F.sum(f"_t_{o}").over(Window.partitionBy(*by)).alias(o) for o in totals.values()])
    d = df.select("*", *[F.sum(z(x)).over(cumulative(by)).alias(f"_l_{o}") for x, o in cols.items()])
    d = d.join(carry, [*by, BLK], "left")
    return d.select(*[c for c in d.columns if not c.startswith(("_l_", "_c_"))],
                    *[(F.col(f"_c_{o}") + F.col(f"_l_{o}")).alias(o) for o in cols.values()])
