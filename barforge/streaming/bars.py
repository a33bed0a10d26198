"""Live dollar bars: a stateful stream with one open bar per symbol.

Ticks are folded in ``seq`` order within a micro-batch; a tick that is not newer than the last one
of its symbol is late and dropped. The state is the open bar, so it does not grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barforge.operators.bars import StandardKernel

STATE = "bar_id long, last_seq long, open double, high double, low double, close double, theta double, buy double, usd double, qty double, ticks double, ticks_buy double, start_seq long, start_time timestamp, is_open boolean"
OUT = "symbol string, bar_id long, start_seq long, end_seq long, open double, high double, low double, close double, theta double, buy double, usd double, qty double, ticks long, ticks_buy long"
_FIELDS = ("open", "high", "low", "close", "theta", "buy", "usd", "qty", "ticks", "ticks_buy")


def dollar_bars(ticks: DataFrame, threshold: float) -> DataFrame:
    """Finished bars of a stream ``(symbol, seq, time, price, qty, side, net)``, in append mode."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kernel, last = StandardKernel(key[0], threshold=threshold), -1
        if state.exists:
            kept = state.get
            kernel.bar_id, last = kept[0], kept[1]
            if kept[14]:
                kernel.open = dict(zip(_FIELDS, kept[2:12], strict=True)) | {"start_seq": kept[12], "start_time": pd.Timestamp(kept[13]).to_datetime64(), "end_seq": last, "end_time": None}
        rows = pd.concat(list(frames)).sort_values("seq")
        rows = rows[rows["seq"] > last].drop_duplicates("seq")
        if len(rows):
            made = kernel.push(rows)
            last = int(rows["seq"].iloc[-1])
            own = kernel.open
            held = tuple(float(own[f]) for f in _FIELDS) + (int(own["start_seq"]), pd.Timestamp(own["start_time"]).to_pydatetime(), True) if own else (0.0,) * 10 + (0, pd.Timestamp(0).to_pydatetime(), False)
            state.update((kernel.bar_id, last, *held))
            if made is not None and len(made):
                out = made.assign(ticks=made["ticks"].astype("int64"), ticks_buy=made["ticks_buy"].astype("int64"))
                yield out[[f.split()[0] for f in OUT.split(", ")]]

    return ticks.groupBy("symbol").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
