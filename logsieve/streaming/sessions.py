"""Sessions with their longest failure run, over a watermarked stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from logsieve.operators.sessions import is_failure
from logsieve.schema import AUTH_FAILURE_CODES, SESSION_GAP_SECONDS, SLOW_ATTACK_MIN_RUN

#: Groups that IPs are hashed into. A checkpoint goes on only under the number it began with.
STREAM_BUCKETS = 1024

_OUT = (
    "ip_address string, session_start long, session_end long, total long, auth_failures long,"
    " longest_run long, run_start long, run_end long"
)
_STATE = "names string, open binary, pending binary"


def stream_slow_attacks(
    stream: DataFrame, min_run: int = SLOW_ATTACK_MIN_RUN, gap_seconds: int = SESSION_GAP_SECONDS,
    codes: Sequence[int] = AUTH_FAILURE_CODES, buckets: int = STREAM_BUCKETS,
) -> DataFrame:
    """`detect_slow_attacks` on a stream: a session is emitted, final, once the
    watermark is more than `gap_seconds` past its last row.

    What is kept for an IP is one running summary of its open session, and the
    counts of the seconds that the watermark has not passed yet, as rows may
    still come before them. So the state of an IP that never rests, and sends
    a third of all rows, is as small as that of any other: at most one entry
    for each second that the watermark has not passed. Rows behind the
    watermark are not counted.

    A group is not an IP but one of `buckets` hash ranges of them, whose IPs
    are worked on together as arrays: a call and a state row for every IP
    cost a thousand times what its rows do.
    """

    def step(key, batches, state):
        # self-contained, so that it travels to the workers by value
        import json

        import numpy as np
        import pandas as pd

        none = np.iinfo(np.int64).min
        # first, last, total, failures, run, its start and end, best run, its start and end
        fresh = np.array([none, none, 0, 0, 0, none, none, 0, none, none])

        def folded(parts):
            """Rows of IP, second, successes and failures in order, one for a second of an IP."""
            rows = np.concatenate(parts)
            rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            if not len(rows):
                return rows
            at = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            return np.column_stack([rows[at, :2], np.add.reduceat(rows[:, 2:], at)])

        names, held, pending = [], np.empty((0, 10), np.int64), np.empty((0, 4), np.int64)
        if state.exists:
            names, held, pending = state.get
            names = json.loads(names)
            held, pending = np.frombuffer(held, np.int64).reshape(-1, 10), np.frombuffer(pending, np.int64).reshape(-1, 4)
        place = {name: k for k, name in enumerate(names)}
        parts, waiting, limit = [pending], 0, 100_000
        for batch in batches:
            batch = batch[batch["s"].notna()]
            which, distinct = pd.factorize(batch["ip_address"], use_na_sentinel=False)
            own = [place.setdefault(None if pd.isna(x) else x, len(place)) for x in distinct]
            bad = batch["failed"].to_numpy(np.int64)
            rows = np.column_stack([np.array(own, np.int64)[which], batch["s"].to_numpy(np.int64), 1 - bad, bad])
            parts.append(folded([rows]))
            waiting += len(parts[-1])
            if waiting > limit:
                parts, waiting = [folded(parts)], 0
                limit = max(limit, len(parts[0]))
        pending = folded(parts)
        held = np.concatenate([held, np.full((len(place) - len(held), 10), none)])

        passed = state.getCurrentWatermarkMs() // 1000  # seconds before it are complete
        ready = pending[:, 1] < passed
        now, pending = pending[ready], pending[~ready]
        closed = []
        if len(now):
            ip, s, ok, bad = np.ascontiguousarray(now.T)
            first = np.r_[True, ip[1:] != ip[:-1]]
            before = np.where(first, held[ip, 1], np.r_[none, s[:-1]])
            near = (before != none) & (s - before <= gap_seconds)
            begins = first | ~near
            begun = first & ~near & (before != none)  # closes the session that was open
            closed.append((ip[begun], held[ip[begun]]))

            at = np.flatnonzero(begins)
            owner, ends, part = ip[at], np.r_[at[1:], len(ip)] - 1, np.cumsum(begins) - 1
            old = np.where(near[at][:, None], held[owner], fresh)
            new = old.copy()
            new[:, 0] = np.where(near[at], old[:, 0], s[at])
            new[:, 1] = s[ends]
            new[:, 2] += np.add.reduceat(ok + bad, at)
            new[:, 3] += np.add.reduceat(bad, at)

            # runs: a second with a success begins one, a session's first may go on from before
            starts = np.flatnonzero(begins | (ok > 0))
            of = part[starts]
            goes_on = begins[starts] & (ok[starts] == 0)
            length = np.add.reduceat(bad, starts) + np.where(goes_on, old[of, 4], 0)
            run_start = np.minimum.reduceat(np.where(bad > 0, s, np.iinfo(np.int64).max), starts)
            run_start = np.where(goes_on & (old[of, 5] != none), old[of, 5], run_start)
            run_start = np.where(length > 0, run_start, none)
            run_end = np.maximum.reduceat(np.where(bad > 0, s, none), starts)
            runs = np.column_stack([length, run_start, run_end])
            new[:, 4:7] = runs[np.r_[of[1:] != of[:-1], True]]
            order = np.lexsort((np.arange(len(of)), -length, of))
            top = runs[order[np.r_[True, of[order][1:] != of[order][:-1]]]]
            better = top[:, 0] > old[:, 7]
            new[better, 7:10] = top[better]

            last = np.r_[owner[1:] != owner[:-1], True]
            closed.append((owner[~last], new[~last]))
            held[owner[last]] = new[last]
        over = (held[:, 0] != none) & (held[:, 1] + gap_seconds < passed)
        closed.append((np.flatnonzero(over), held[over]))
        held[over] = none

        names = np.array([*place, None], dtype=object)[:-1]
        is_open = held[:, 0] != none
        kept = is_open.copy()
        kept[pending[:, 0]] = True
        if kept.any():
            due = [int(pending[:, 1].min()) + 1] if len(pending) else []
            due += [int(held[is_open, 1].min()) + gap_seconds + 1] if is_open.any() else []
            pending[:, 0] = (np.cumsum(kept) - 1)[pending[:, 0]]
            state.update((json.dumps(names[kept].tolist()), held[kept].tobytes(), pending.tobytes()))
            state.setTimeoutTimestamp(max(min(due) * 1000, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()

        ips, rows = np.concatenate([c[0] for c in closed]), np.concatenate([c[1] for c in closed])
        hit = rows[:, 7] >= min_run
        ips, rows = ips[hit], rows[hit]
        out = {"ip_address": names[ips]}
        columns = ["session_start", "session_end", "total", "auth_failures", "longest_run", "run_start", "run_end"]
        for name, k in zip(columns, (0, 1, 2, 3, 7, 8, 9)):
            out[name] = pd.arrays.IntegerArray(rows[:, k].copy(), rows[:, k] == none)
        yield pd.DataFrame(out)

    rows = stream.select(
        F.pmod(F.xxhash64("ip_address"), F.lit(buckets)).alias("bucket"), "ip_address", "timestamp",
        F.unix_seconds("timestamp").alias("s"), is_failure(codes).cast("int").alias("failed"),
    )
    found = rows.groupBy("bucket").applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    times = ("session_start", "session_end", "run_start", "run_end")
    return found.withColumns({c: F.timestamp_seconds(c) for c in times})
