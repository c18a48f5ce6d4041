"""Change monitor (inventory C3): reasons by field, and the confirmation rules over a listing's snapshots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

FIELDS = ("price", "posted", "updated", "status", "title")
#: Channels that need two equal observations.
TWO_HIT = ("midland", "house730")
STATE = "source_id string, seq long, reasons array<string>, changed boolean, pending boolean, change_count long, reextract_needed boolean, reextract_candidate boolean"


def change_reasons(old: dict[str, Column], new: dict[str, Column], same: Column) -> Column:
    """The fields that differ, in order; ``fingerprint_changed`` where only the fingerprint does."""
    found = F.filter(F.array(*[F.when(~old[f].eqNullSafe(new[f]), F.lit(f"{f}_changed")) for f in FIELDS if f in old]), lambda r: r.isNotNull())
    return F.when(same, F.array().cast("array<string>")).when(F.size(found) > 0, found).otherwise(F.array(F.lit("fingerprint_changed")))


class State:
    """What is remembered of a listing: its last snapshot, a change that waits, and how many were confirmed."""

    def __init__(self, previous: tuple | None = None, pending: str | None = None, count: int = 0):
        self.previous, self.pending, self.count = previous, pending, count

    def step(self, channel: str, confidence: str, print_: str, fields: tuple, mode: str) -> tuple:
        """Take the next snapshot in; reasons, changed, pending, change_count, reextract_needed, reextract_candidate."""
        reasons: list[str] = []
        changed = candidate = False
        new = (print_, *fields)
        if self.previous is None:
            reasons, self.previous = ["initial_monitor"], new
        elif print_ == self.previous[0]:
            self.pending = None
        else:
            reasons = [f"{f}_changed" for f, a, b in zip(FIELDS, fields, self.previous[1:], strict=True) if a != b] or ["fingerprint_changed"]
            if confidence == "high" or channel not in TWO_HIT or (mode == "intended" and self.pending == print_):
                changed, self.pending, self.count = True, None, self.count + 1
            else:
                self.pending, candidate = print_, True
                reasons = [f"pending:{x}" for x in reasons]
            if mode == "reference" or changed:
                self.previous = new
        return reasons, changed, self.pending is not None, self.count, changed, candidate


OUT = ["source_id", "seq", "reasons", "changed", "pending", "change_count", "reextract_needed", "reextract_candidate"]


def _advance(state: State, pdf: pd.DataFrame, mode: str) -> list[tuple]:
    found = []
    for r in pdf.sort_values("seq").itertuples(index=False):
        found.append((r.source_id, r.seq, *state.step(r.channel, r.confidence, r.fingerprint, tuple(getattr(r, f) for f in FIELDS), mode)))
    return found


def fold(snapshots: DataFrame, mode: str = "reference") -> DataFrame:
    """States after each snapshot (source_id, channel, seq, confidence, fingerprint and the five fields).

    In mode ``reference`` the fingerprint is replaced before confirmation, so a two-hit channel never
    confirms; ``intended`` keeps the old one while a change is pending.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_advance(State(), pdf, mode), columns=OUT)

    return snapshots.groupBy("source_id").applyInPandas(run, STATE)


#: What a stream keeps of a listing between batches.
KEPT = "fingerprint string, price string, posted string, updated string, status string, title string, pending string, change_count long"


def fold_stream(snapshots: DataFrame, mode: str = "reference") -> DataFrame:
    """``fold`` over a stream: a listing's state is kept between batches, and snapshots of a batch are taken by seq.

    Snapshots of a listing must come in order from batch to batch; the state of a listing is one small row.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state = State()
        if held.exists:
            *previous, pending, count = held.get
            state = State(tuple(previous), pending, count)
        rows = _advance(state, pd.concat(list(frames)), mode)
        held.update((*state.previous, state.pending, state.count))
        yield pd.DataFrame(rows, columns=OUT)

    return snapshots.groupBy("source_id").applyInPandasWithState(run, STATE, KEPT, "append", "NoTimeout")
