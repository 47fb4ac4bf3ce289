"""Structured Streaming: run state folded from events, a throttled journal, and resumable file sources."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT_SCHEMA = "event string, site string, phase string, rows bigint, committed bigint, total bigint, bytes bigint, at double"


def event_stream(spark: SparkSession, folder: str, schema: str = EVENT_SCHEMA, files_per_batch: int = 100) -> DataFrame:
    """JSON event lines as they are written; the query's checkpoint remembers which files were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


#: Lines of a site's log that are kept.
LOG_LINES = 400
_STATE = "status string, observed bigint, committed bigint, total bigint, warnings bigint, updated double, phases string, log string"
_FOLD = "site string, status string, observed bigint, committed bigint, total bigint, warnings bigint, updated double, phases map<string,string>, log array<string>, rate double, eta double"


def _number(value) -> int | None:
    return None if value is None or value != value else int(value)


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    status, observed, committed, total, warnings, updated, phases, log = state.get if state.exists else ("new", 0, 0, -1, 0, 0.0, "{}", "[]")
    phase_of, lines = json.loads(phases), json.loads(log)
    began = phase_of.pop("_began", None)
    for pdf in frames:
        for e in pdf.sort_values("at", kind="stable").to_dict("records"):
            status = e["event"] if e["at"] >= updated else status
            # producers' clocks may run back: time never does
            updated = max(updated, e["at"])
            began = e["at"] if began is None else min(began, e["at"])
            # counters only grow: a replayed batch changes nothing
            observed, committed, total = (max(old, new) if (new := _number(e[c])) is not None else old for old, c in ((observed, "rows"), (committed, "committed"), (total, "total")))
            warnings += e["event"] == "warning"
            if e["phase"] is not None and e["phase"] == e["phase"]:
                phase_of[e["phase"]] = e["event"]
            lines.append(f"{e['at']:.3f} {e['event']}" + (f" {e['phase']}" if e["phase"] else ""))
    lines = lines[-LOG_LINES:]
    state.update((status, observed, committed, total, warnings, updated, json.dumps({**phase_of, "_began": began}), json.dumps(lines)))
    # a rate of what was committed in this run; the time left only where the total is known
    rate = committed / (updated - began) if began is not None and updated - began >= 0.25 and committed > 0 else None
    eta = (total - committed) / rate if rate and total >= committed else None
    yield pd.DataFrame([(key[0], status, observed, committed, total, warnings, updated, phase_of, lines, rate, eta)], columns=[f.split()[0] for f in _FOLD.split(", ")])


def run_state(events: DataFrame) -> DataFrame:
    """State of every site over all phases: totals found in one phase hold for the next ones, so the key is the site.

    With the status of each phase, the last LOG_LINES lines, the rate, and the time left where there is a true total.
    """
    slim = events.select("site", "event", "phase", "rows", "committed", "total", "at")
    return slim.groupBy("site").applyInPandasWithState(_fold, _FOLD, _STATE, "update", GroupStateTimeout.NoTimeout)


_THROTTLED = "event string, site string, phase string, at double, bytes bigint, merged bigint"


def _held(seconds: float):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held, merged = state.get if state.exists else (-1e18, 0, 0)
        out = []
        for pdf in frames:
            for e in pdf.sort_values("at", kind="stable").to_dict("records"):
                held, merged = held + (_number(e["bytes"]) or 0), merged + 1
                if e["at"] - last >= seconds:
                    out.append((*key, e["at"], held, merged))
                    last, held, merged = e["at"], 0, 0
        state.update((last, held, merged))
        yield pd.DataFrame(out, columns=["event", "site", "phase", "at", "bytes", "merged"])

    return step


def throttled(events: DataFrame, seconds: float = 0.4) -> DataFrame:
    """At most one row in ``seconds`` since the last one of its event kind, site and phase, with the bytes of all it stands for."""
    slim = events.select("event", "site", "phase", "at", "bytes")
    return slim.groupBy("event", "site", "phase").applyInPandasWithState(_held(seconds), _THROTTLED, "last double, held bigint, merged bigint", "append", GroupStateTimeout.NoTimeout)


def append_once(sink: str):
    """A foreachBatch sink that writes each batch into its own folder, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return write
