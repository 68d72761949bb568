"""Exact quantiles and order statistics without sorting the table or filling one reducer.

``percentile`` keeps every distinct value of a column in one reducer, which is fine for a million
values and fatal for a billion.  Past ``IN_MEMORY`` values we bracket each wanted rank with the
mergeable quantile sketch (whose rank error is guaranteed), count what lies below the bracket and
narrow it until the few remaining values fit on the driver.  Each round is two map-side-combined
aggregates over the whole table and the answer is exact.
"""

from __future__ import annotations

import math
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import num

IN_MEMORY = 1_000_000
COLLECT_LIMIT = 100_000
SKETCH_ACCURACY = 10_000


def order_statistics(
    df: DataFrame,
    values: Mapping[str, Column],
    ranks: Mapping[str, Iterable[int]],
    collect_limit: int | None = None,
    accuracy: int | None = None,
) -> dict[str, dict[int, float]]:
    """The values at the given 0-based ranks of each expression (nulls ignored)."""
    collect_limit = COLLECT_LIMIT if collect_limit is None else collect_limit
    accuracy = SKETCH_ACCURACY if accuracy is None else accuracy
    names = list(values)
    slim = df.select(*[values[n].alias(f"v{i}") for i, n in enumerate(names)])
    counts = slim.agg(*[F.count(f"v{i}").alias(f"v{i}") for i in range(len(names))]).collect()[0]
    found: dict[str, dict[int, float]] = {n: {} for n in names}
    # one open target per wanted rank: the open bracket, the rows at or below its lower end, the rows inside
    targets = []
    for i, name in enumerate(names):
        for rank in sorted(set(ranks[name])):
            if not 0 <= rank < counts[i]:
                raise ValueError(f"rank {rank} outside 0..{counts[i] - 1} for {name}")
            targets.append({"i": i, "rank": rank, "lo": None, "hi": None, "below": 0, "inside": counts[i], "slack": 2.0 / accuracy})

    def inside(t) -> Column:
        v = F.col(f"v{t['i']}")
        keep = v.isNotNull()
        if t["lo"] is not None:
            keep = keep & (v > F.lit(t["lo"])) & (v < F.lit(t["hi"]))
        return keep

    open_targets = targets
    while open_targets:
        small, total = [], 0
        for t in open_targets:
            if t["inside"] <= collect_limit and total + t["inside"] <= 4 * collect_limit:
                small.append(t)
                total += t["inside"]
        if small:
            tagged = slim.select(
                F.explode(
                    F.filter(
                        F.array(
                            *[
                                F.when(inside(t), F.struct(F.lit(j).alias("t"), F.col(f"v{t['i']}").alias("v")))
                                for j, t in enumerate(small)
                            ]
                        ),
                        lambda e: e.isNotNull(),
                    )
                ).alias("e")
            )
            rows = tagged.groupBy("e.t", "e.v").count().collect()
            by_target: dict[int, list] = {}
            for r in rows:
                by_target.setdefault(r["t"], []).append((r["v"], r["count"]))
            for j, t in enumerate(small):
                seen = t["below"]
                for v, n in sorted(by_target[j]):
                    seen += n
                    if t["rank"] < seen:
                        found[names[t["i"]]][t["rank"]] = v
                        break
            open_targets = [t for t in open_targets if t not in small]
            continue
        sketches = []
        for j, t in enumerate(open_targets):
            p = (t["rank"] - t["below"] + 1) / t["inside"]
            v = F.when(inside(t), F.col(f"v{t['i']}"))
            sketches.append(
                F.percentile_approx(
                    v, F.array(F.lit(max(0.0, p - t["slack"])), F.lit(min(1.0, p + t["slack"]))), F.lit(accuracy)
                ).alias(f"s{j}")
            )
        bounds = slim.agg(*sketches).collect()[0]
        checks = []
        for j, t in enumerate(open_targets):
            v = F.col(f"v{t['i']}")
            lo, hi = bounds[j]
            checks.append(F.count_if(v < F.lit(lo)).alias(f"b{j}"))
            checks.append(F.count_if(v == F.lit(lo)).alias(f"l{j}"))
            checks.append(F.count_if((v > F.lit(lo)) & (v < F.lit(hi))).alias(f"m{j}"))
            checks.append(F.count_if(v == F.lit(hi)).alias(f"h{j}"))
        seen = slim.agg(*checks).collect()[0]
        still = []
        for j, t in enumerate(open_targets):
            lo, hi = bounds[j]
            # the ends are settled by their own counts and left out of the next bracket, so a value
            # held by any share of the rows cannot keep a bracket from shrinking
            below = seen[f"b{j}"]
            if below <= t["rank"] < below + seen[f"l{j}"]:
                found[names[t["i"]]][t["rank"]] = lo
                continue
            below += seen[f"l{j}"]
            if below + seen[f"m{j}"] <= t["rank"] < below + seen[f"m{j}"] + seen[f"h{j}"]:
                found[names[t["i"]]][t["rank"]] = hi
                continue
            if not below <= t["rank"] < below + seen[f"m{j}"]:
                t["slack"] *= 8  # the sketch missed: ask for a wider bracket of the same range
                still.append(t)
                continue
            t.update(lo=lo, hi=hi, below=below, inside=seen[f"m{j}"])
            still.append(t)
        open_targets = still
    return found


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    counts: Mapping[str, int] | None = None,
    in_memory: int | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns, exact at any size."""
    columns = list(wanted)
    if not columns:
        return {}
    in_memory = IN_MEMORY if in_memory is None else in_memory
    slim = df.select(*[num(df, c).alias(f"q{i}") for i, c in enumerate(columns)])
    if counts is None:
        row = slim.agg(*[F.count(f"q{i}").alias(f"q{i}") for i in range(len(columns))]).collect()[0]
        counts = {c: row[i] for i, c in enumerate(columns)}
    out: dict[str, list[float | None]] = {}
    small = [(i, c) for i, c in enumerate(columns) if counts[c] <= in_memory]
    if small:
        row = slim.agg(
            *[
                F.percentile(F.col(f"q{i}"), F.array(*[F.lit(float(p)) for p in wanted[c]])).alias(f"q{i}")
                for i, c in small
            ]
        ).collect()[0]
        for i, c in small:
            out[c] = list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(wanted[c])
    large = [(i, c) for i, c in enumerate(columns) if counts[c] > in_memory]
    if large:
        ranks = {}
        for i, c in large:
            places = [(counts[c] - 1) * float(p) for p in wanted[c]]
            ranks[c] = {math.floor(h) for h in places} | {math.ceil(h) for h in places}
        got = order_statistics(slim, {c: F.col(f"q{i}") for i, c in large}, ranks)
        for i, c in large:
            answers = []
            for p in wanted[c]:
                h = (counts[c] - 1) * float(p)
                lo, hi = got[c][math.floor(h)], got[c][math.ceil(h)]
                answers.append(float(lo + (h - math.floor(h)) * (hi - lo)))
            out[c] = answers
    return {c: out[c] for c in columns}
