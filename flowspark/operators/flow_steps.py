"""Runs of packets as functions kept in rows, composed by range joins.

A run of packets maps the state of the flow open before it to the state after it. For a given number of FINs seen, the
map is a step function of the flow's start time; here every step is a row (from, to, outcome), so a run with very many
steps is many rows and never one value. Neighbouring runs are composed `fan_in` at a time, level by level: outcomes of the
first look up the second's step by an as-of join (a union in time order and the last step before), and a step that leaves
the entry flow open is split at the second's steps. Going down again, the known state before a span gives the state before
each of its parts. Nothing but rows is held: sorts spill, and levels are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions import cuts
from flowspark.session import materialize

LEAST, MOST = -(1 << 63), (1 << 63) - 1
OUT = ["pkt", "ts", "dir", "fins", "flows"]
STEP = ["seen", "low", "high", *OUT]
STATE = [f"e_{c}" for c in OUT]


def rows_of(tables: DataFrame, key: list[str], steps: str = "steps") -> DataFrame:
    """(key, blk, max_before, step) rows from packed tables: for 0, 1 and 2 FINs seen, thresholds and five outcome arrays."""
    def of(seen: int) -> Column:
        thr, outs = F.col(steps)[6 * seen], [F.col(steps)[6 * seen + 1 + i] for i in range(5)]
        low, high = F.concat(F.array(F.lit(LEAST)), thr), F.concat(thr, F.array(F.lit(MOST)))
        zipped = F.arrays_zip(low.alias("low"), high.alias("high"), *[o.alias(n) for o, n in zip(outs, OUT, strict=True)])
        return F.transform(zipped, lambda x: F.struct(F.lit(seen).cast("bigint").alias("seen"), *[x[c].alias(c) for c in STEP[1:]]))

    return tables.select(*key, "blk", "max_before", F.inline(F.concat(*map(of, range(3)))))


def _after(first_open: Column, given: list[Column], then: list[Column]) -> list[Column]:
    """Outcome of a second run: its own if it starts a flow, else the first's with the FINs it has seen since."""
    moved = then[4] > 0
    ended = [F.when(moved, n).otherwise(g) for n, g in zip(then[:3], given[:3], strict=True)]
    return [*ended, then[3], F.when(first_open, then[4]).otherwise(given[4] + then[4])]


def _compose(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Steps of `first` followed by `second` where a span has one; both hold at most one run of each (key, span)."""
    by = [*key, "span"]
    given = F.struct(*STEP, "max_before")
    asked = first.where("flows > 0").select(*by, F.col("fins").alias("state"), F.col("ts").alias("at"), F.lit(1).alias("asks"), given.alias("q"))
    told = second.select(*by, F.col("seen").alias("state"), F.col("low").alias("at"), F.lit(0).alias("asks"), F.struct(*OUT).alias("r"))
    before = Window.partitionBy(*by, "state").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = asked.unionByName(told, allowMissingColumns=True).withColumn("r", F.last("r", ignorenulls=True).over(before)).where("asks = 1")
    new = _after(F.lit(False), [F.col(f"q.{c}") for c in OUT], [F.col(f"r.{c}") for c in OUT])
    outs = [F.when(F.col("r").isNull(), F.col(f"q.{c}")).otherwise(n).alias(c) for c, n in zip(OUT, new, strict=True)]
    ended = met.select(*by, F.col("q.max_before").alias("max_before"), *[F.col(f"q.{c}").alias(c) for c in STEP[:3]], *outs)

    # One open step for each number of FINs seen: split at the second's steps above it, up to where no flow can have begun.
    open_ = first.where("flows = 0").alias("f")
    split = open_.join(second.alias("s"), [*[F.col(f"f.{c}") == F.col(f"s.{c}") for c in by], F.col("f.fins") == F.col("s.seen"),
                                           F.col("s.high") > F.col("f.low"), F.col("s.low") <= F.col("f.max_before")], "left")
    none = [F.col(f"f.{c}") for c in OUT]
    new = _after(F.lit(True), none, [F.col(f"s.{c}") for c in OUT])
    opened = split.select(
        *[F.col(f"f.{c}").alias(c) for c in (*by, "max_before", "seen")], F.greatest("f.low", F.coalesce("s.low", "f.low")).alias("low"),
        F.coalesce("s.high", "f.high").alias("high"),
        *[F.when(F.col("s.flows").isNull(), g).otherwise(n).alias(c) for c, g, n in zip(OUT, none, new, strict=True)])
    return ended.unionByName(opened)


def _child(level: DataFrame, fan_in: int, number: int) -> DataFrame:
    return level.where(F.pmod("blk", F.lit(fan_in)) == number).withColumn("span", F.expr(f"blk div {fan_in}")).drop("blk")


def _applied(state: DataFrame, run: DataFrame, key: list[str]) -> DataFrame:
    """state (key, span, e_..) after the run of its span; spans without a run keep their state."""
    by = [*key, "span"]
    hit = state.alias("e").join(run.alias("f"), [
        *[F.col(f"e.{c}") == F.col(f"f.{c}") for c in by], F.least("e.e_fins", F.lit(cuts.CLOSED)) == F.col("f.seen"),
        F.col("f.low") <= F.col("e.e_ts"), F.col("e.e_ts") < F.col("f.high")], "left")
    moved = F.col("f.flows") > 0
    now = [F.when(moved, F.col(f"f.{c}")).otherwise(F.col(f"e.e_{c}")) for c in OUT[:3]]
    now += [F.coalesce("f.fins", "e.e_fins"), F.col("e.e_flows") + F.coalesce("f.flows", F.lit(0))]
    return hit.select(*[F.col(f"e.{c}") for c in by], *[n.alias(c) for n, c in zip(now, STATE, strict=True)])


def entry_states(runs: DataFrame, key: list[str], first: tuple, fan_in: int) -> DataFrame:
    """(key, blk, e_pkt, e_ts, e_dir, e_fins, e_flows) before each run of runs (written step rows); `first` before all."""
    levels, top = [runs], runs.agg(F.max("blk")).first()[0] or 0
    while top:
        below = levels[-1]
        made = _child(below, fan_in, 0)
        for number in range(1, fan_in):
            # A span's first parts may be missing: it then begins with the first that is there.
            part = _child(below, fan_in, number)
            have = made.select(*key, "span").distinct()
            made = _compose(made, part, key).unionByName(part.join(have, [*key, "span"], "left_anti"))
        levels.append(materialize(made.withColumnRenamed("span", "blk"), "composed"))
        top //= fan_in
    state = levels[-1].select(*key, "blk").distinct().select(
        *key, "blk", *[F.lit(v).cast("bigint").alias(c) for v, c in zip(first, STATE, strict=True)])
    for level in reversed(levels[:-1]):
        at, out = state.withColumnRenamed("blk", "span"), None
        parts = level.select(*key, "blk").distinct()
        for number in range(fan_in):
            here = at.withColumn("blk", F.col("span") * fan_in + number).drop("span")
            out = here if out is None else out.unionByName(here)
            if number + 1 < fan_in:
                at = _applied(at, _child(level, fan_in, number), key)
        state = materialize(out.join(parts, [*key, "blk"], "left_semi"), "states")
    return state
