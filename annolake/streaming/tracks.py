"""Track rules as streams: one state per video, frames in order; a frame that is not after the last one seen is dropped.

Both rules have a batch twin (hotstart.prune_tracks, occlusion.occlusion_suppress) with the same results on the same frames. A frame has to come
whole within a micro-batch. States hold a few numbers for each track of a video.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

_STATE = "last long, memory string"


def _stateful(rows: DataFrame, step: Callable[[int, int, pd.DataFrame, dict], list[tuple]], schema: str, columns: list[str]) -> DataFrame:
    """Run step(video, frame, rows, memory) over each video's frames; memory is a dictionary that lives from frame to frame."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, memory = state.get if state.exists else (None, "{}")
        memory, out = json.loads(memory), []
        for frame, part in pd.concat(list(batches)).sort_values("frame_idx").groupby("frame_idx"):
            if last is None or frame > last:
                out += step(int(key[0]), int(frame), part, memory)
                last = int(frame)
        if last is not None:
            state.update((last, json.dumps(memory)))
        yield pd.DataFrame(out, columns=columns)

    return rows.groupBy("video_id").applyInPandasWithState(run, schema, _STATE, "append", "NoTimeout")


def stream_occlusion(objects: DataFrame, overlap: float = 0.7) -> DataFrame:
    """video_id, frame_idx, track_id of suppressed objects; see occlusion_suppress."""

    def step(video: int, frame: int, part: pd.DataFrame, last: dict) -> list[tuple]:
        rows = part.sort_values("track_id")[["track_id", "x", "y", "w", "h"]].to_numpy().tolist()
        hidden = {int(t) for t, _, _, w, h in rows if w <= 0 or h <= 0}
        there = [(int(t), x, y, x + w, y + h) for t, x, y, w, h in rows if int(t) not in hidden]
        gone = set()
        for k, (a, ax, ay, ar, ab) in enumerate(there):
            for b, bx, by, br, bb in there[k + 1 :]:
                inter = max(0.0, min(ar, br) - max(ax, bx)) * max(0.0, min(ab, bb) - max(ay, by))
                union = (ar - ax) * (ab - ay) + (br - bx) * (bb - by) - inter
                if union > 0 and inter / union >= overlap:
                    i, j = last.get(str(a), -1), last.get(str(b), -1)
                    if i > j > -1:
                        gone.add(a)
                    elif j > i > -1:
                        gone.add(b)
        last |= {str(t): frame for t in hidden | gone}
        return [(video, frame, t) for t in sorted(gone)]

    return _stateful(objects, step, "video_id long, frame_idx long, track_id long", ["video_id", "frame_idx", "track_id"])


def stream_removals(events: DataFrame, delay: int = 15, unmatch: int = 8, dup: int = 8) -> DataFrame:
    """video_id, track_id, frame_idx, reason of removed tracks, each once; see prune_tracks."""

    def step(video: int, frame: int, part: pd.DataFrame, memory: dict) -> list[tuple]:
        first, missed, pairs, removed = (memory.setdefault(k, {}) for k in ("first", "missed", "pairs", "removed"))
        rows = [(int(t), None if pd.isna(d) else int(d), kind) for t, d, kind in part[["track_id", "det_id", "kind"]].itertuples(index=False)]
        out: dict[int, str] = {}
        for t, _, _ in rows:
            first.setdefault(str(t), frame)
        young = {t for t, _, _ in rows if first[str(t)] > frame - delay}
        for t, _, kind in rows:
            if kind == "unmatched":
                missed[str(t)] = missed.get(str(t), 0) + 1
                if missed[str(t)] == unmatch and t in young:
                    out[t] = "unmatched"
        shared: dict[int, list[int]] = {}
        for t, d, kind in rows:
            if kind in ("matched", "new") and d is not None:
                shared.setdefault(d, []).append(t)
        for own in shared.values():
            earlier = min(own, key=lambda t: (first[str(t)], t))
            for t in own:
                if t != earlier:
                    key = f"{earlier},{t}"
                    pairs[key] = pairs.get(key, 0) + 1
                    if pairs[key] == dup and t in young:
                        out[t] = "duplicate"
        out = {t: why for t, why in out.items() if str(t) not in removed}
        removed |= {str(t): frame for t in out}
        return [(video, t, frame, why) for t, why in sorted(out.items())]

    return _stateful(events, step, "video_id long, track_id long, frame_idx long, reason string", ["video_id", "track_id", "frame_idx", "reason"])
