"""Pacing by tokens in a trailing window: as a window query over a usage log, and as a replay in which waiting moves later requests."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotarium.settings import Settings


class TokenPacer:
    """Decides when the next request may go. Times are micro-seconds and come from the caller."""

    def __init__(self, budget: int, window_us: int = 60_000_000, history: int = 5):
        self.budget, self.window_us = max(int(budget), 1), window_us
        self.used: deque[tuple[int, int]] = deque()
        self.total, self.recent = 0, deque(maxlen=history)

    def resume(self, used: list[tuple[int, int]], sizes: list[int]) -> None:
        """Takes over what was used before, in order of time, and the sizes of those requests."""
        for at, tokens in used:
            self.used.append((at, tokens))
            self.total += tokens
        self.recent.extend(n for n in sizes if n > 0)

    def estimate(self) -> int:
        return max(int(sum(self.recent) / len(self.recent)) if self.recent else 0, 1)

    def wait_us(self, now: int) -> int:
        """0 if a request may go now; else how long to wait before asking again, a second at least."""
        while self.used and self.used[0][0] < now - self.window_us:
            self.total -= self.used.popleft()[1]
        if not self.used or self.total + self.estimate() <= self.budget:
            return 0
        return max(self.used[0][0] + self.window_us - now, 1_000_000)

    def record(self, now: int, tokens: int) -> None:
        if tokens > 0:
            self.used.append((now, tokens))
            self.total += tokens
            self.recent.append(tokens)


def window_usage(usage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """usage (lane, seq, ts_us, tokens) with used (tokens of earlier requests in the trailing window), oldest_us, estimate (mean of the last few sizes), admitted and wait_us.

    A request exactly as old as the window still counts. Each lane, such as one worker's share of the quota, is a window of its own.

    A lane is cut into spans as long as the window, which tasks take one by one. A row comes in its own span and goes in the next one, a window later, so what a request finds is
    what of the span before hasn't gone yet and what came before it in its own span: running sums over one sorted pass, however many rows a window holds. The last
    sizes before a span are handed on from the few rows that each span has at its end.
    """
    log = _spans(usage, settings)
    rows = _estimated(_used(log, settings), log, settings)
    admitted = F.col("oldest_us").isNull() | (F.col("used") + F.col("estimate") <= settings.token_budget)
    wait = F.greatest(F.col("oldest_us") + settings.window_seconds * 1_000_000 - F.col("ts_us"), F.lit(1_000_000))
    return rows.select("lane", "seq", "ts_us", "tokens", "used", "oldest_us", "estimate", admitted.alias("admitted"), F.when(admitted, F.lit(0)).otherwise(wait).cast("long").alias("wait_us"))


def used_before(usage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lane, seq, ts_us, tokens, used and oldest_us of window_usage, in one shuffle and one sort: no last sizes are gathered or joined, and no step has only a task for each lane."""
    return _used(_spans(usage, settings), settings).select("lane", "seq", "ts_us", "tokens", "used", "oldest_us")


def estimates(usage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lane, seq, ts_us, tokens and estimate of window_usage, without what is used."""
    log = _spans(usage, settings)
    return _estimated(log, log, settings).select("lane", "seq", "ts_us", "tokens", "estimate")


def _spans(usage: DataFrame, settings: Settings) -> DataFrame:
    return usage.filter("tokens > 0 and ts_us is not null").withColumn("span", F.floor(F.col("ts_us") / (settings.window_seconds * 1_000_000)))


def _used(log: DataFrame, settings: Settings) -> DataFrame:
    """The rows of log with used and oldest_us. A row finds nothing in its window where oldest_us is null."""
    window = settings.window_seconds * 1_000_000
    turns = log.select("lane", "seq", "ts_us", "tokens", "span", F.explode(F.array(F.lit(0), F.lit(1))).alias("gone"))
    turns = turns.withColumns({"span": F.col("span") + F.col("gone"), "at": F.col("ts_us") + F.col("gone") * window})
    in_order = Window.partitionBy("lane", "span").orderBy("at", "gone", "seq")
    before, whole = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    come, gone = F.col("gone") == 0, F.col("gone") == 1
    known = lambda x: F.coalesce(x, F.lit(0))
    used = known(F.sum(F.when(gone, F.col("tokens"))).over(whole)) + known(F.sum(F.when(gone, -F.col("tokens")).otherwise(F.col("tokens"))).over(before))
    next_to_go = F.expr("lead(if(gone = 1, ts_us, null)) ignore nulls over (partition by lane, span order by at, gone, seq)")
    oldest = F.coalesce(next_to_go, F.min(F.when(come, F.col("ts_us"))).over(before))
    return turns.withColumns({"used": used, "oldest_us": oldest}).filter(come)


def _estimated(rows: DataFrame, log: DataFrame, settings: Settings) -> DataFrame:
    """rows, which are those of log, with estimate."""
    own, sizes = rows.alias("r"), _sizes_before(log, settings.history).alias("s")
    rows = own.join(sizes, F.col("r.lane").eqNullSafe(F.col("s.lane")) & (F.col("r.span") == F.col("s.span"))).select("r.*", "s.sizes")
    inside = Window.partitionBy("lane", "span").orderBy("ts_us", "seq").rowsBetween(-settings.history, -1)
    last = _last(F.concat("sizes", F.collect_list("tokens").over(inside)), settings.history)
    return rows.withColumn("last", last).withColumn("estimate", F.greatest(F.when(F.size("last") > 0, F.expr("aggregate(last, 0L, (a, x) -> a + x) div size(last)")).otherwise(F.lit(0)), F.lit(1)).cast("long"))


def _last(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)


def _sizes_before(log: DataFrame, history: int) -> DataFrame:
    """lane, span, sizes: the last few sizes before each span that has rows. Only a few rows of each span are gathered; a lane has one row for each span then."""
    back = F.row_number().over(Window.partitionBy("lane", "span").orderBy(F.col("ts_us").desc(), F.col("seq").desc()))
    tails = log.withColumn("back", back).filter(F.col("back") <= history).groupBy("lane", "span").agg(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("back"), F.col("tokens").cast("long").alias("n")))), lambda x: x["n"]).alias("tail"))
    before = Window.partitionBy("lane").orderBy("span").rowsBetween(-history, -1)
    return tails.select("lane", "span", _last(F.flatten(F.collect_list("tail").over(before)), history).alias("sizes"))


def replay(usage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lane, seq, ts_us, tokens and sent_us: when each request goes if each waits for the quota and for the one before.

    The feedback can't be a window expression. Rows of a lane come sorted and are read batch by batch, with the window as the only state, so a
    lane of any length needs little memory; lanes run side by side.
    """
    budget, window_us, history = settings.token_budget, settings.window_seconds * 1_000_000, settings.history

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, pacer, clock = None, None, 0
        for b in batches:
            sent = []
            for own, ts, tokens in zip(b["lane"], b["ts_us"], b["tokens"]):
                if pacer is None or own != lane:
                    lane, pacer, clock = own, TokenPacer(budget, window_us, history), 0
                clock = max(clock, int(ts))
                while wait := pacer.wait_us(clock):
                    clock += wait
                pacer.record(clock, int(tokens))
                sent.append(clock)
            yield b.assign(sent_us=sent)

    rows = usage.select("lane", "seq", F.col("ts_us").cast("long").alias("ts_us"), F.col("tokens").cast("long").alias("tokens"))
    kind = dict(rows.dtypes)
    dealt = rows.repartition("lane").sortWithinPartitions("lane", "ts_us", "seq")
    return dealt.mapInPandas(run, f"lane {kind['lane']}, seq {kind['seq']}, ts_us long, tokens long, sent_us long")
